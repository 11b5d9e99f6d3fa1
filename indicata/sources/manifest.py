"""Manifest files: one ``title :table id`` line per table, and batch runs over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.sources.tables import is_complete


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Read a manifest as ``title``, ``table_id``; blank lines are skipped, a line without id has a null one."""
    parts = F.split("value", ":")
    return (
        spark.read.text(path)
        .where(F.trim("value") != "")
        .select(F.trim(F.get(parts, F.lit(0))).alias("title"), F.trim(F.get(parts, F.lit(1))).alias("table_id"))
    )


def run_manifest(
    manifest: DataFrame,
    step: Callable[[str], str | None],
    output_path: Callable[[str], str] | None = None,
) -> DataFrame:
    """Run ``step(table_id)`` for every manifest row; return ``table_id``, ``status``.

    Each step is itself a Spark job; what it has to remark on its rows stands behind its status. A failing table is
    reported and does not stop the others. With ``output_path``, tables whose output is complete are skipped; one that
    was only begun is made again.
    """
    spark = manifest.sparkSession
    statuses = []
    for row in manifest.select("title", "table_id").toLocalIterator():
        identifier = row["table_id"]
        if not identifier:
            statuses.append((identifier, f"No table id: {row['title']}"))
            continue
        if output_path is not None and is_complete(spark, output_path(identifier)):
            statuses.append((identifier, "Skipped"))
            continue
        try:
            remark = step(identifier)
        except (PySparkException, OSError, ValueError, KeyError) as error:
            statuses.append((identifier, f"{type(error).__name__}: {error}"))
        else:
            statuses.append((identifier, f"Successful ({remark})" if remark else "Successful"))
    return spark.createDataFrame(statuses, "table_id string, status string")
