"""Zip archives of CSV text."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from fnmatch import fnmatchcase

import pandas as pd
from pyarrow import ArrowInvalid
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.sources import tables

_ENTRIES = "archive string, member string, position int, bytes long"
_LINES = "archive string, member string, line_number long, line string"
_BATCH = 10_000
#: Hadoop's names of schemes that Arrow knows by another one.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _arrow_uri(path: str) -> str:
    scheme, colon, rest = path.partition(":")
    return f"{_SCHEMES.get(scheme, scheme)}{colon}{rest}"


def streamed(path: str) -> bool:
    """Whether Arrow can open what a path's scheme names, so that tasks read from the file as they go."""
    try:
        arrow_fs.FileSystem.from_uri(_arrow_uri(path))
    except (ArrowInvalid, NotImplementedError, OSError):
        return False
    return True


def _opened(path: str, content: bytes | None) -> zipfile.ZipFile:
    if content is not None:
        return zipfile.ZipFile(io.BytesIO(content))
    system, location = arrow_fs.FileSystem.from_uri(_arrow_uri(path))
    return zipfile.ZipFile(system.open_input_file(location))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of each archive and, where only Hadoop's file systems can open it, its ``content`` (up to 2 GB)."""
    files = spark.read.format("binaryFile").load(path)
    some = files.select("path").first()
    if some is None or streamed(some["path"]):
        return files.select("path", F.lit(None).cast("binary").alias("content"))
    return files.select("path", "content")


def _directory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with _opened(path, content) as archive:
                entries = [e for e in archive.infolist() if not e.is_dir()]
            rows = [(path, e.filename, i, e.file_size) for i, e in enumerate(entries)]
            yield pd.DataFrame(rows, columns=["archive", "member", "position", "bytes"])


def list_entries(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """The entries of every archive under ``path``, from the archives' directories: ``archive``, ``member``, ``position``, ``bytes``.

    ``member`` is a name or pattern (``*``, ``?``); without one it is the first entry of each archive.
    """
    entries = _files(spark, path).mapInPandas(_directory, schema=_ENTRIES)
    if member is None:
        return entries.where("position = 0")
    matches = F.pandas_udf(lambda names: names.map(lambda name: fnmatchcase(name, member)), "boolean")
    return entries.where(matches("member"))


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content, members in zip(batch["path"], batch["content"], batch["members"]):
            with _opened(path, content) as archive:
                for member in members:
                    yield from _entry_lines(archive, path, member)


def _entry_lines(archive: zipfile.ZipFile, path: str, member: str) -> Iterator[pd.DataFrame]:
    lines: list[str] = []
    start = 0
    with archive.open(member) as text:
        for raw in text:
            first = start == 0 and not lines
            lines.append(raw.decode("utf-8-sig" if first else "utf-8").rstrip("\r\n"))
            if len(lines) == _BATCH:
                yield _frame(path, member, start, lines)
                start += len(lines)
                lines = []
    if lines:
        yield _frame(path, member, start, lines)


def _frame(path: str, member: str, start: int, lines: list[str]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "archive": path,
            "member": member,
            "line_number": range(start, start + len(lines)),
            "line": lines,
        }
    )


def _chosen_lines(spark: SparkSession, path: str, entries: list[tuple[str, str]]) -> DataFrame:
    """The lines of (archive, member) entries; each is a task of its own where tasks can stream from the file."""
    shape = "path string, content binary, members array<string>"
    if all(streamed(archive) for archive, _ in entries[:1]):
        rows = [(archive, None, [member]) for archive, member in entries]
        units = spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), shape)
    else:
        listed = spark.createDataFrame(entries, "path string, member string")
        members = listed.groupBy("path").agg(F.collect_list("member").alias("members"))
        units = _files(spark, path).join(members, "path").select("path", "content", "members")
    return units.mapInPandas(_lines, schema=_LINES)


def _names(entries: DataFrame) -> list[tuple[str, str]]:
    """(archive, member) of entries: names only, as many as a manifest has tables."""
    return [(r["archive"], r["member"]) for r in entries.orderBy("archive", "position").collect()]


def read_archives(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """The entries of every archive under ``path`` as numbered text lines, chosen as by ``list_entries``.

    A deflate stream can only be read from its start, so the unit of work is the entry. Each task streams its
    entry in fixed-size batches. An archive on a file system that only Hadoop knows is read whole by Spark first.
    """
    return _chosen_lines(spark, path, _names(list_entries(spark, path, member)))


def table_name(member: str) -> str:
    """An entry's file name without its folder and extension."""
    return re.sub(r"\.[^.]*$", "", member.rpartition("/")[2])


def extract_archives(
    spark: SparkSession, path: str, output: str, member: str | None = None, replace: bool = True
) -> list[str]:
    """Write each chosen entry as text under ``output/member=<name>/``; return the names written.

    Names are those of ``table_name``; two entries of one name are refused. An entry is read by one task, and the
    sort within that task keeps its lines, header first, in their order. What is written takes its place, with
    ``_SUCCESS``, only when all of it is there. Without ``replace``, entries already complete are not read again.
    Whatever else is in ``output`` stays.
    """
    found: dict[str, tuple[str, str]] = {}
    for archive, name in _names(list_entries(spark, path, member)):
        table = table_name(name)
        if table in found:
            raise ValueError(f"{name!r} of {archive} and {found[table][1]!r} of {found[table][0]} would both be {table!r}")
        found[table] = (archive, name)
    if not replace:
        found = {t: e for t, e in found.items() if not tables.is_complete(spark, f"{output}/member={t}")}
    if not found:
        return []
    staged = f"{output}/_staged-{uuid.uuid4().hex}"
    names = spark.createDataFrame([(*e, t) for t, e in found.items()], "archive string, member string, name string")
    lines = _chosen_lines(spark, path, list(found.values())).join(F.broadcast(names), ["archive", "member"])  # a row per entry
    try:
        (
            lines.sortWithinPartitions("name", "line_number")
            .select("line", F.col("name").alias("member"))
            .write.partitionBy("member")
            .text(staged)
        )
        for folder in tables.folders(spark, staged, "member="):
            tables.mark_complete(spark, f"{staged}/{folder}")
            tables.publish(spark, f"{staged}/{folder}", f"{output}/{folder}")
    finally:
        tables.discard(spark, staged)
    return list(found)
