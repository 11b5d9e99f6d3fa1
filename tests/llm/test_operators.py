"""Queries against their SQL, schedules and shards against their laws, and edge rows of every operator."""

import zlib
from collections import Counter
from fractions import Fraction
from math import floor
from random import Random

import compare
import pytest
from pyspark.sql import functions as F

from indicata.llm import chat_tree, ngram_join, pfair, queries, sharding, substring_dedup, topk_search, url_filter, warc_revisit

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    result = queries.QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in result.collect()]
    names, expected = compare.sql_rows(FOLDER, queries.ORACLE_SQL[name])
    assert rows
    assert compare.difference(result.columns, rows, names, expected) is None
    assert compare.type_difference(result.dtypes, FOLDER, queries.ORACLE_SQL[name]) == {}


def test_shards_match_counts_and_mixture(spark):
    rows = sharding.op10_sharding(spark, FOLDER).collect()
    docs = {d.doc_id: d for d in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    shards = {}
    for r in rows:
        data = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        shards.setdefault(r.shard, []).append(r)
    assert sorted(shards) == list(range(40))
    sizes = Counter(d.source for d in docs.values())
    for own in shards.values():
        assert len(own) in (len(docs) // 40, -(-len(docs) // 40))
        assert sorted(r.slot for r in own) == list(range(len(own)))
        for source, n in Counter(docs[r.doc_id].source for r in own).items():
            assert abs(n - sizes[source] / 40) <= 2


def test_a_schedule_written_in_parts_is_the_same(spark, monkeypatch):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.floor(F.sqrt("id") / 30)).alias("source"))
    whole = {r.doc_id: tuple(r) for r in pfair.mix(df, block_rows=4, period=50).collect()}
    monkeypatch.setattr(pfair, "HELD_NUMBERS", 40)
    monkeypatch.setattr(pfair, "BLOCKS_IN_TASK", 500)
    parts = pfair.mix(df, block_rows=4, period=50)
    assert {r.doc_id: tuple(r) for r in parts.collect()} == whole
    assert len(whole) == 30_000


def packs_of(spark, rows, pack_chars):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string, turns int")
    conf = "spark.sql.shuffle.partitions"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "1")
    try:
        convs = chat_tree.conversations(df)
        packs = chat_tree.pack(convs, pack_chars).collect()
        read = chat_tree.members(convs).join(chat_tree.read_back(chat_tree.pack(convs, pack_chars)), "key").collect()
    finally:
        spark.conf.set(conf, before)
    return packs, {r.conv_id: r for r in read}


def test_a_long_first_turn_is_repeated_a_few_times_only(spark):
    first = "x" * 40_000
    rows = [(i, t, r, s, "k", 1) for i in range(50) for t, (r, s) in enumerate([("system", first), ("user", f"question {i}")])]
    packs, read = packs_of(spark, rows, chat_tree.PACK_CHARS)
    assert sum(len(p.text) for p in packs) < 3 * 43_000
    assert len(read) == 50 and all(r.n_turns == 2 for r in read.values())


@pytest.mark.parametrize("pack_chars", [1, 200, 5000])
def test_packs_have_at_most_twice_the_text_of_the_tree(spark, pack_chars):
    rand = Random(4)
    rows, distinct = [], {}
    for i in range(150):
        path = ()
        for t in range(rand.randrange(1, 6)):
            path += (("user", "assistant")[t % 2] + "-" + "y" * rand.choice([3, 3, 400]) + str(rand.randrange(2)),)
            distinct[path] = len(chat_tree.format_turn(*path[-1].split("-"))[0])
            rows.append((i, t, *path[-1].split("-"), "k", 1))
    packs, read = packs_of(spark, rows, pack_chars)
    total = sum(len(p.text) for p in packs)
    longest = max(sum(distinct[p[: k + 1]] for k in range(len(p))) for p in distinct)
    assert total <= 2 * sum(distinct.values()) + longest
    assert max(len(p.text) for p in packs) <= max(pack_chars, longest) + 2 * longest
    assert sorted(read) == list(range(150))
    assert len({r.n_turns for r in read.values()}) > 2


def test_schedule_stays_within_a_block():
    weights = {"a": 5.0, "b": 1.5, "c": 0.2, "d": 3.3}
    blocks = {"a": 40, "b": 30, "c": 2, "d": 9}
    rows = pfair.phases(blocks, weights, period=50)
    taken = {}
    for name, begin, count, share, span, first, slots in rows:
        for j in range(count):
            slot = first + j // share * span + slots[j % share]
            assert slot not in taken
            taken[slot] = (name, begin + j)
            assert first + j * span // share <= slot < first + -(-(j + 1) * span // share)
    assert sorted(taken) == list(range(sum(blocks.values())))
    assert Counter(n for n, _ in taken.values()) == blocks
    starts = sorted({r[5] for r in rows})
    for start, end in zip(starts, [*starts[1:], len(taken)]):
        share = {r[0]: Fraction(r[3], r[4]) for r in rows if r[5] == start}
        seen = Counter()
        for t in range(start, end):
            seen[taken[t][0]] += 1
            for name, w in share.items():
                assert abs(seen[name] - w * (t - start + 1)) < 1


def test_schedule_keeps_to_the_given_weights():
    many = {f"s{i:02}": 32.0 for i in range(19)} | {"most": 139.58}
    for weights in (many, {"a": 0.9, "b": 0.05, "c": 0.05}, {"a": 1.0, "b": 1e-4, "c": 3**0.5}):
        total = sum(map(Fraction, weights.values()))
        exact = {k: Fraction(w) / total for k, w in weights.items()}
        n = 30 * pfair.PERIOD
        blocks = {k: int(w * n) + 2 for k, w in exact.items()}
        taken, seen = {}, Counter()
        for piece in pfair.pieces(blocks, weights):
            for name, block, slot, release, deadline in pfair.listed(*piece):
                assert release <= slot < deadline
                taken[slot] = (name, block)
        assert sorted(taken) == list(range(sum(blocks.values())))
        for t in range(n):
            name, block = taken[t]
            assert block == seen[name]
            seen[name] += 1
            assert abs(seen[name] - exact[name] * (t + 1)) < 1
            if t % 997 == 0:
                assert all(abs(seen[k] - w * (t + 1)) < 1 for k, w in exact.items())


def test_mixture_of_documents(spark):
    rows = pfair.op7_pfair_mixing(spark, FOLDER).collect()
    assert len(rows) == 1000 and len({r.doc_id for r in rows}) == 1000
    assert len({(r.mix_slot, r.mix_row) for r in rows}) == 1000
    for r in rows:
        assert r.mix_release <= r.mix_slot < r.mix_deadline
    blocks = Counter((r.source, r.mix_block) for r in rows)
    assert {r.mix_slot for r in rows} == set(range(len(blocks)))


def test_mix_and_shard_edges(spark):
    schema = "doc_id long, source string, slot int, mix_slot int"
    rows = [(1, None, 1, 1), (1, None, 1, 1), (None, "a", None, None), (2, "", 2, 2), (3, "a", 3, 3)]
    table = spark.createDataFrame(rows, schema)
    mixed = pfair.mix(table, block_rows=2)
    assert "_mix_slot" in mixed.columns and len(mixed.collect()) == 5
    placed = sharding.interleave(table, shards=2)
    assert sorted(Counter(r.shard for r in placed.collect()).values()) == [2, 3]
    assert "_slot" in placed.columns
    assert sorted(map(tuple, pfair.in_mixed_order(table, block_rows=1).collect()), key=repr) == sorted(rows, key=repr)
    for made in (pfair.mix(table.where("false")), sharding.interleave(table.where("false"))):
        assert made.collect() == []
    with pytest.raises(ValueError):
        pfair.mix(table, weights={"a": 1})


def test_url_edges(spark):
    urls = [None, "", "no host", "HTTPS://A.NET/x", "http://x.example.net/en/?q", "ftp://://", "http://org/fr/", "http://É.org/fr", "http://w.example.com/de/a#b"]
    table = spark.createDataFrame([(u, "h") for u in [*urls, urls[3]]], "url string, host string")
    listed = spark.createDataFrame([("w.example.com/de/a",), (None,), ("",)], "canonical string")
    found = {r.url: r for r in url_filter.judge_urls(table, listed).collect()}
    assert (found[None]._host, found[None].path, found[None].verdict) == ("", "", "allow")
    assert (found["HTTPS://A.NET/x"]._host, found["HTTPS://A.NET/x"].rule) == ("a.net", "net/")
    assert found[urls[4]].rule == "example.net/en/" and found[urls[4]].verdict == "allow"
    assert found["http://É.org/fr"]._host == "É.org" and found["http://É.org/fr"].rule is None
    assert found[urls[8]].listed and found[urls[8]].verdict == "block"
    assert url_filter.judge_urls(table.where("false"), listed).collect() == []
    assert {r.verdict for r in url_filter.judge_urls(table.where("url = 'no host'"), listed.where("false")).collect()} == {"allow"}


def test_bloom_has_no_false_negatives(spark):
    listed = spark.range(5000).selectExpr("concat('h', id * 3) AS canonical")
    table = spark.range(15000).selectExpr("concat('h', id) AS k")
    for most in (1, 4, 1 << 18):
        marked = url_filter.mark_listed(table, "k", listed, "canonical", max_blocks=most)
        assert marked.where("listed AND NOT possible").count() == 0
        assert marked.where("listed").count() == 5000
    assert marked.where("possible AND NOT listed").count() < 1000


def test_chat_edges(spark):
    said = ["", "<|im_end|>", "<\\|im_start|>\n", "a<|<||>", "é🙂" * 5000]
    for text in said:
        assert chat_tree.unescape(chat_tree.escape(text)) == text
        assert chat_tree.parse(chat_tree.format_turn("u\n\\n<|", text)[0]) == [("u\n\\n<|", text)]
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 0, "user", "hi"), (2, 1, "assistant", None), (None, None, None, "x"), (3, 0, "user", "hi"), (3, 0, "user", "hi")]
    convs = chat_tree.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    packs = chat_tree.pack(convs, pack_chars=40)
    back = {r.conv_id: r for r in chat_tree.members(convs).join(chat_tree.read_back(packs), "key").collect()}
    assert {k: r.n_turns for k, r in back.items()} == {1: 2, 2: 2, 3: 2, None: 1}
    whole = chat_tree.pack(convs.where("conv_id < 4").coalesce(1), pack_chars=1 << 20).collect()
    for p in whole:
        assert sum(n.end - n.begin for n in p.nodes) == len(p.text)
        for n in p.nodes:
            above = p.nodes[n.parent] if n.parent >= 0 else None
            assert n.position == (above.position + above.end - above.begin if above else 0)
            assert sum(a.end - a.begin for a in n.attends) == n.position + n.end - n.begin
    assert chat_tree.pack(convs.where("false")).collect() == []


def test_topk_edges(spark):
    nan = float("nan")
    rows = [(0, [0.5, 0.25]), (0, [0.5, 0.25]), (1, [0.5, 0.0]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [1.0]), (None, [1.0, 1.0]), (6, [0.5, 0.0]), (7, [-1.0, -1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    found = topk_search.top_k(table, F.col("vec_id") == 0, k=2).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [(0, 1, 1, 1024), (0, 2, 6, 1024)]
    every = topk_search.top_k(table, F.col("vec_id") == 0, k=50).collect()
    assert sorted(r.vec_id for r in every) == [1, 6, 7]
    assert topk_search.top_k(table.where("false"), F.col("vec_id") == 0).collect() == []


def test_topk_takes_all_rows(spark):
    random = Random(5)

    def some(size, length=3):
        return [random.randint(-size, size) / 64 for _ in range(length)]

    rows = [(i, some(200)) for i in range(60)] + [(100 + i, some(10**6, 5)) for i in range(40)]
    rows += [(200 + i, some(3 * 10**8)) for i in range(30)] + [(300 + i, some(3, 1)) for i in range(20)]
    rows += [(400, []), (401, []), (405, [16384.0, 0.0, 1.0]), (405, [-20000.5, 1e5, 1.0]), (405, [1.0, 2.0, 3.0])]
    rows += [(406, [float(2**25 + 1)] * 3), (407, [float(2**25 + 1), float(2**25 + 1), float(2**25 - 1)])]
    rows += rows[40:70] * 2 + [rows[-1]] * 30
    rows += [(500 + i, some(3, 1) + some(10**8, 5) + some(1, 1)) for i in range(9)] + [(510, [2.0**54] + [0.0] * 6), (511, [0.0] * 6 + [2.0**56])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, tuple(floor(64 * x) for x in v)) for i, v in rows]
    expected = {}
    for q, v in sorted({(i, v) for i, v in whole if i % 5 == 0}):
        near = [(-sum(a * b for a, b in zip(v, w)), c) for c, w in whole if c != q and len(w) == len(v)]
        expected.setdefault(q, []).extend(near)
    expected = [(q, k + 1, c, -s) for q, near in expected.items() for k, (s, c) in enumerate(sorted(near)[:8])]
    found = topk_search.top_k(table, F.col("vec_id") % 5 == 0, k=8, tile_queries=7, tile_vectors=16).collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_dedup_and_join_edges(spark):
    long = " ".join(f"w{i}" for i in range(40))
    near = long.replace("w39", "W39x")
    rows = [(1, long, "k"), (2, near, None), (3, f"a\n{long} b", "k"), (4, None, "k"), (5, "", "k"), (6, long, "k"), (6, long, "k"), (None, f"{long} {long}", "k"), (7, "x " * 100, "k"), (8, "a b", "k"), (9, "A B", "k")]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    cut = substring_dedup.dedup(table).collect()
    by = {r.doc_id: r for r in cut if r.doc_id not in (6,)}
    assert len(cut) == len(rows)
    assert (by[1].n_removed, by[1].kept_text) == (0, long)
    assert (by[2].n_removed, by[2].kept_text) == (39, "W39x")
    assert (by[3].n_removed, by[3].kept_text) == (40, "a\nb")
    assert by[4].kept_text is None and by[5].kept_text == ""
    assert {r.n_removed for r in cut if r.doc_id == 6} == {40}
    assert by[None].n_removed == 40
    assert by[7].n_removed == 99
    linked = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link(table).collect()]
    assert len(linked) == len(rows)
    assert {(1, 36, 1), (2, 36, 1), (3, 38, 1), (4, 0, 4), (5, 0, 5), (6, 36, 1), (8, 1, 8), (9, 1, 8)} <= set(linked)
    assert {c for d, _, c in linked if d is None} == {None}
    assert substring_dedup.dedup(table.where("false")).collect() == []
    assert ngram_join.link(table.where("false")).collect() == []
    assert sorted(r.doc_id or 0 for r in ngram_join.one_of_each(table).collect()) == [0, 1, 4, 5, 7, 8]


def test_revisit_edges(spark):
    schema = "record_id long, url string, time long, status int, digest string, headers array<struct<name:string,value:string>>"
    tag = [("ETag", '"a"'), ("Content-Type", "text/html")]
    rows = [
        (1, "u", 10, 200, "d1", tag),
        (2, "u", 20, 200, "d2", [("ETag", '"b"')]),
        (3, "u", 20, 304, None, [("etag", 'W/"a"'), ("X-Y", "no"), ("Vary", "z")]),
        (4, "u", 21, 304, None, [("etag", '"a"')]),
        (5, "u", 21, 304, None, []),
        (6, None, 21, 304, None, tag),
        (7, "u", None, 304, None, None),
        (8, "v", 5, 304, None, tag),
    ]
    found = {r.record_id: r for r in warc_revisit.resolve(spark.createDataFrame(rows, schema)).collect()}
    assert [found[i].outcome for i in range(3, 9)] == ["resolved", "mismatch", "unverified", "unmatched", "unmatched", "unmatched"]
    assert found[3].response_id == 1 and found[3].digest == "d1"
    assert [tuple(h) for h in found[3].headers] == [("Content-Type", "text/html"), ("Vary", "z"), ("etag", 'W/"a"')]
    assert warc_revisit.resolve(spark.createDataFrame([], schema)).collect() == []


def test_of_responses_at_one_time_the_largest_record_counts(spark):
    schema = "record_id long, url string, time long, status int, digest string, headers array<struct<name:string,value:string>>, key int"
    rows = [(r, "u", 10, 200, f"d{r}", [("ETag", f'"{r}"')], 0) for r in (5, 9, 2)] + [(None, "u", 10, 200, "none", [], 0)]
    rows += [(20, "u", 10, 304, None, [("ETag", '"9"')], 0), (21, "u", 11, 304, None, [("ETag", '"9"')], 0)]
    rows += [(22, "u", 11, 304, None, [("ETag", '"5"')], 0)]
    found = {r.record_id: r for r in warc_revisit.resolve(spark.createDataFrame(rows, schema)).collect()}
    assert found[20].outcome == "unmatched"  # not earlier
    assert (found[21].outcome, found[21].response_id, found[21].digest) == ("resolved", 9, "d9")
    assert found[22].outcome == "mismatch"


def test_equally_long_rules_block_and_long_urls_are_read_whole(spark):
    rules = [url_filter.Rule("allow", "b.net", "/x/"), url_filter.Rule("block", "net", "/x/yy"), url_filter.Rule("allow", "net", "/x/")]
    assert len(rules[0].text) == len(rules[1].text)
    tail = "a" * 300_000
    urls = ["http://a.b.net/x/yy", "http://A.net/x/q", f"http://c.net/{tail}", f"http://c.net/{tail}/end", f"http://{tail}.net/x/1"]
    table = spark.createDataFrame([(u, 1) for u in urls], "url string, rule int")
    listed = spark.createDataFrame([(f"c.net/{tail}/end",)], "canonical string")
    found = {r.url: r for r in url_filter.judge_urls(table, listed, rules=rules).collect()}
    assert (found[urls[0]]._rule, found[urls[0]].verdict) == ("net/x/yy", "block")
    assert [found[u].verdict for u in urls[1:]] == ["allow", "allow", "block", "allow"]
    assert found[urls[4]].host == f"{tail}.net" and found[urls[1]].rule == 1


def test_shards_of_long_texts_and_clashing_columns(spark):
    rows = [(i, "s", "t" * (400_000 if i == 3 else i), 7, "x") for i in range(9)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string, shard int, fraction string")
    placed = sharding.interleave(table, shards=4).collect()
    assert sorted(r.doc_id for r in placed) == list(range(9))
    assert {(r.shard, r.fraction) for r in placed} == {(7, "x")}
    assert sorted(Counter(r._shard for r in placed).values()) == [2, 2, 2, 3]
    assert max(len(r.text) for r in placed) == 400_000
