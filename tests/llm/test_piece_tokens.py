"""Best scores against a plain search, exact round trips, and edge rows."""

import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from indicata.llm import piece_tokens as P

FOLDER = "/root/testdata/sf0.01"
PIECES = P.Pieces.load()
SCORES = {i: s for _, s, i in PIECES.pieces}
KNOWN = {p: s for p, s, _ in PIECES.pieces}


def best_score(word):
    best = [0.0]
    for end in range(1, len(word) + 1):
        ways = [best[end - 1] + PIECES.unknown]
        ways += [best[start] + KNOWN[word[start:end]] for start in range(end) if word[start:end] in KNOWN]
        best.append(max(ways))
    return best[-1]


def score_of(ids):
    total, spelled = 0.0, b""
    for i in ids:
        if i in SCORES:
            total += SCORES[i]
        else:
            spelled += PIECES.raw[i]
    return total + PIECES.unknown * len(spelled.decode())


def test_scores_are_the_best(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()
    words = sorted({"▁" + w for d in docs for w in (d.text or "").split()})
    random.seed(3)
    chosen = sorted([*random.sample(words, 1500), "▁", "▁▁▁x", "日本語", "▁naïve…", "🙂🙃"])
    flat, ends = P.Search(PIECES).ids(chosen)
    for word, begin, end in zip(chosen, [0, *ends], ends):
        ids = flat[begin:end]
        assert b"".join(PIECES.raw[i] for i in ids).decode() == word.replace("▁", " ")
        assert abs(score_of(ids) - best_score(word)) < 1e-3, word


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t▁\0é日")), max_size=4))
def test_texts_split_at_once_have_the_ids_of_their_words(texts):
    encoder = P.Encoder(PIECES)
    flat, offsets = encoder.encode(pa.array(texts, pa.string()))
    for text, begin, end in zip(texts, offsets, offsets[1:]):
        expected = []
        for word in encoder._parts(text or ""):
            expected += PIECES.spelled("▁") if word is None else P.Search(PIECES).ids([word])[0]
        assert flat[begin:end].tolist() == expected


def test_words_are_forgotten_and_found_again(monkeypatch):
    texts = pa.array(["a word", "日本 a word", None, "an other\nword  twice"] * 3)
    expected = P.Encoder(PIECES).encode(texts)
    monkeypatch.setattr(P, "KEPT_BYTES", 0)
    encoder = P.Encoder(PIECES)
    for _ in range(3):
        for found, wanted in zip(encoder.encode(texts), expected):
            assert found.tolist() == wanted.tolist()


def test_round_trip_of_every_document(spark):
    rows = P.op9_piece_tokens(spark, FOLDER)
    assert rows.count() == 1000
    assert rows.where("NOT round_trip OR n_tokens = 0 OR n_tokens IS NULL").count() == 0


def test_odd_texts(spark):
    texts = [None, "", " ", "  a  b ", "a\n\nb\t", "▁a▁ ▁", "\0", "🙂 日本 é", "x" * 200_000, "a " * 50_000, "same", "same"]
    table = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "n_tokens long, text string, token_ids int")
    rows = P.tokenized(table, PIECES).orderBy("n_tokens").collect()
    assert all(r.round_trip for r in rows)
    assert rows[0]._token_ids is None and rows[1]._token_ids == []
    assert [r._n_tokens for r in rows[:2]] == [None, 0]
    assert rows[-1]._token_ids == rows[-2]._token_ids
    assert P.tokenized(table.where("false"), PIECES).collect() == []
    plain = spark.createDataFrame([("a b",)], "t string").select(P.decode(P.encode(F.col("t"), PIECES), PIECES).alias("t"))
    assert plain.first().t == "a b"
