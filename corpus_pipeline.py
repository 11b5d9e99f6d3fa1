"""A corpus pipeline of five stages, each written as Parquet and read again by the next.

``STAGES`` lists (name, function); a function takes (spark, docs, folder of tables) and returns a DataFrame. All
but the last return the columns of ``documents``; the last gives each row's place in the mixture. Nulls, empty tables and
clashing columns are handled as the operators' modules state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.llm import common, ngram_join, pfair, piece_tokens, quality_rules, substring_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the label model judges good."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand earlier; ``n_chars`` follows the text."""
    cut = substring_dedup.dedup(docs)
    text = common.fresh(docs, "n_words", "n_removed", "kept_text")[2]
    changed = {"text": F.col(text), "n_chars": F.coalesce(F.length(text).cast("long"), F.col("n_chars"))}
    return cut.withColumns(changed).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in the order in which sources mix to their weights."""
    return pfair.in_mixed_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's text and its place in the mixture; sorting by ``mix_place`` gives the mixture."""
    (place,) = common.fresh(docs, "mix_place")
    own = pfair.placed(docs, place).select("doc_id", "source", "text", F.col(place).alias("mix_place"))
    coded = piece_tokens.tokenized(own, piece_tokens.Pieces.load())
    return coded.select("doc_id", "source", "n_tokens", "token_ids", "round_trip", "mix_place")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing to target weights", mixture),
    ("SentencePiece encoding", tokens),
]

#: EM and the mixture's schedule iterate on data, which SQL does not express; tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; intermediate tables go to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return done
        done.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
