"""Each stage of the pipeline against a plain version over what the stage before kept."""

import re

from pyspark.sql import functions as F

import corpus_pipeline
from indicata.llm import pfair, quality_rules

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(docs):
    sets = {}
    for d in docs:
        w = WORD.findall((d.text or "").lower())
        sets[d.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def without_repeats(docs):
    seen, kept = set(), {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        w = WORD.findall(d.text or "")
        gone = set()
        for i in range(len(w) - 19):
            window = tuple(w[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept[d.doc_id] = [x for i, x in enumerate(w) if i not in gone]
    return kept


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], FOLDER).write.parquet(f"{folder}/{k}")
        tables.append(spark.read.parquet(f"{folder}/{k}"))
        if k < 4:
            assert tables[-1].columns == docs.columns
    start, good, single, cut, mixed, coded = [t.collect() for t in tables]
    measured = docs.select("doc_id", quality_rules.signals(F.col("text")).alias("s"))
    verdicts = quality_rules.judge(measured, quality_rules.fit(measured)).where("kept").collect()
    assert sorted(d.doc_id for d in good) == sorted(r.doc_id for r in verdicts)
    assert 0 < len(good) < len(start)
    roots = components(good)
    assert sorted(d.doc_id for d in single) == sorted(set(roots.values()))
    assert {d.doc_id: WORD.findall(d.text) for d in cut} == without_repeats(single)
    assert all(d.n_chars == len(d.text) for d in cut)
    assert sorted(map(tuple, mixed), key=repr) == sorted(map(tuple, cut), key=repr)
    assert sorted(d.doc_id for d in coded) == sorted(d.doc_id for d in mixed)
    assert all(r.round_trip for r in coded)
    again = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, coded), key=repr)


def test_rows_have_their_place_in_the_mixture(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").drop("text").withColumn("text", F.lit("a b"))
    schedule = [r.doc_id for r in pfair.mix(docs).orderBy("mix_slot", "mix_row").collect()]
    mixed = corpus_pipeline.mixture(spark, docs.repartition(7), FOLDER)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxRecordsPerFile": "97"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        mixed.write.parquet(f"{folder}/mixed")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    again = spark.read.parquet(f"{folder}/mixed")
    coded = corpus_pipeline.tokens(spark, again, FOLDER).collect()
    assert len(again.inputFiles()) > 4
    assert sorted(r.mix_place for r in coded) == list(range(len(schedule)))
    assert [r.doc_id for r in sorted(coded, key=lambda r: r.mix_place)] == schedule
    assert schedule != sorted(schedule)


def test_odd_documents(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    for rows in ([], [(None, None, None, None, None), (1, "", "en", None, 0), (1, "a b", None, "s", 3)]):
        docs = spark.createDataFrame(rows, schema)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            found = stage(spark, docs, FOLDER).collect()
            assert len(found) == (0 if k == 0 or not rows else len(rows))


def test_stages_with_columns_named_like_their_outputs(spark, folder):
    """Every output name of the operators is taken; stages pass those columns on, and the last one gives its own."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    taken = ["token_ids", "n_tokens", "round_trip", "mix_place", "mix_slot", "mix_row", "kept", "base_failed", "n_words"]
    taken += ["quality_probability", "kept_text", "n_removed", "component_id", "other_id", "_path", "_row", "row", "source_", "key"]
    wide = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id")) for c in taken})
    tables, plain = [wide], [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for name, found in (("wide", tables), ("plain", plain)):
            stage(spark, found[-1], FOLDER).write.parquet(f"{folder}/{name}-{k}")
            found.append(spark.read.parquet(f"{folder}/{name}-{k}"))
        if k < 4:
            assert tables[-1].columns == wide.columns
            bad = [tables[-1].where(F.col(c) != F.concat(F.lit(f"{c} "), F.col("doc_id"))).count() for c in taken]
            assert not any(bad)
    assert tables[-1].columns == plain[-1].columns
    wanted, got = [sorted(map(tuple, t.drop("mix_place").collect()), key=repr) for t in (plain[-1], tables[-1])]
    assert wanted == got
    places = sorted(r.mix_place for r in tables[-1].collect())
    assert places == list(range(len(places)))
