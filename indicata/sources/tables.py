"""CSV and Parquet tables, and the schema sidecars stored beside them."""

from __future__ import annotations

import json
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system that a path's scheme names, and the path on it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system its scheme names."""
    system, jvm_path = _located(spark, path)
    return system.exists(jvm_path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing the folder ``path``: its last act is to put ``_SUCCESS`` there."""
    return path_exists(spark, f"{path}/_SUCCESS")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, if it is there."""
    system, jvm_path = _located(spark, path)
    system.delete(jvm_path, True)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Move a finished folder to where readers look, in place of what is there."""
    system, source = _located(spark, staged)
    _, target = _located(spark, path)
    system.mkdirs(target.getParent())
    if system.exists(target):
        system.delete(target, True)
    if not system.rename(source, target):
        raise OSError(f"could not move {staged} to {path}")


def mark_complete(spark: SparkSession, path: str) -> None:
    """Put ``_SUCCESS`` into a folder."""
    system, jvm_path = _located(spark, f"{path}/_SUCCESS")
    system.create(jvm_path, True).close()


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders directly in ``path`` that start with ``prefix``."""
    system, jvm_path = _located(spark, path)
    names = [f.getPath().getName() for f in system.listStatus(jvm_path) if f.isDirectory()]
    return [name for name in names if name.startswith(prefix)]


def has_suffix(spark: SparkSession, path: str, suffix: str) -> bool:
    """Whether the folder ``path``, or one in it, holds a file whose name ends in ``suffix``."""
    system, jvm_path = _located(spark, path)
    if not system.exists(jvm_path):
        return False
    files = system.listFiles(jvm_path, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(suffix):
            return True
    return False


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    header: bool = True,
    keep_text: tuple[str, ...] = ("REF_DATE",),
    malformed: str | None = None,
) -> DataFrame:
    """Read a CSV file, directory, glob or list of them.

    With no ``schema`` the types are inferred from all rows, except that the ``keep_text`` columns
    stay strings: inference would turn year-month text into timestamps. Columns are taken by position, so each
    file's header must name them in the schema's order; a file of another header fails the query by its name.
    ``malformed`` names a column that gets the text of lines that do not fit the schema; what fits of these is read.
    """
    if schema is None:
        inferred = spark.read.csv(path, header=header, inferSchema=True).schema
        schema = T.StructType(
            [
                T.StructField(f.name, T.StringType() if f.name in keep_text else f.dataType)
                for f in inferred
            ]
        )
    options = {"header": header, "mode": "PERMISSIVE", "enforceSchema": not header}
    if malformed is not None:
        schema = T.StructType([*schema, T.StructField(malformed, T.StringType())])
        options["columnNameOfCorruptRecord"] = malformed
    return spark.read.csv(path, schema=schema, **options)


def read_series_files(
    spark: SparkSession, path: str | list[str], names: list[str] | None = None
) -> DataFrame:
    """Read one-series CSV files as one long table: ``series``, ``DATE``, ``VALUE``.

    The series is the file's name without its extension. All files are one scan, whatever their
    number and whatever each calls its value column.
    """
    from indicata.sources.schemas import series_schema

    raw = spark.read.csv(path, schema=series_schema(), header=True, enforceSchema=True)
    rows = raw.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("series"),
        F.try_to_date(F.col("DATE"), "yyyy-MM-dd").alias("DATE"),
        "VALUE",
    )
    return rows if names is None else rows.where(F.col("series").isin(list(names)))


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    sort_by: str | list[str] | None = None,
    single_file: bool = False,
    files: int | None = None,
    rebalanced: bool = False,
    partition_by: str | list[str] | None = None,
    sidecar: str | None = None,
) -> None:
    """Write ``df`` as Parquet or as CSV with a header.

    ``single_file`` gathers a small result into one file; keep it for report-sized results. ``files`` asks for a
    number of files, and ``rebalanced`` for files of the session's advisory size, by ``partition_by`` if given. All
    three go through a shuffle of the final rows, so the work before stays as wide as it is.
    """
    if single_file:
        df = df.repartition(1)
        if sort_by is not None:
            df = df.sortWithinPartitions(sort_by)
    else:
        if files is not None:
            df = df.repartition(files) if sort_by is None else df.repartitionByRange(files, *_listed(sort_by))
        elif rebalanced and sort_by is None:
            df = df.hint("rebalance", *[F.col(c) for c in _listed(partition_by)])
        if sort_by is not None:
            df = df.orderBy(sort_by) if files is None else df.sortWithinPartitions(sort_by)
    writer = df.write.mode(mode)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if fmt == "csv":
        writer.csv(path, header=True)
    else:
        writer.format(fmt).save(path)
    if sidecar is not None:
        save_schema(df.sparkSession, df.schema, sidecar)


def _listed(names: str | list[str] | None) -> list[str]:
    return [] if names is None else [names] if isinstance(names, str) else list(names)


def write_published(df: DataFrame, path: str, replace: bool = True, **layout: object) -> None:
    """``write_table`` to a folder beside ``path`` that takes its place once it is complete.

    So ``path`` is never half written: a job that dies leaves what was there. Without ``replace`` a complete ``path``
    is an error; one that is not complete, left by some other writer, is always replaced.
    """
    spark = df.sparkSession
    if not replace and is_complete(spark, path):
        raise FileExistsError(f"{path} already exists")
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    try:
        write_table(df, staged, **layout)
        publish(spark, staged, path)
    finally:
        discard(spark, staged)


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Store a schema as JSON text, through Spark's own file access."""
    spark.createDataFrame([(schema.json(),)], "value string").repartition(1).write.mode(
        "overwrite"
    ).text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """Load a schema stored by ``save_schema`` or as a plain JSON file."""
    text = spark.read.text(path, wholetext=True).where(F.length("value") > 0).first()
    return T.StructType.fromJson(json.loads(text["value"]))
