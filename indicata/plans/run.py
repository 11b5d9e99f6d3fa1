"""Run jobs by name from files to files.

    python -m indicata.plans.run --input /data --output /results [--csv] [--resume] [job ...]

Input folder: ``<table id>/`` per observation table (Parquet if it holds Parquet, else CSV), and
``stock.csv``, ``countries/*.csv``, ``macro.csv``, ``development.csv``. Every result is stored as
Parquet under ``<output>/tables/<name>``; a job that builds on another reads that, so each result is
computed once and a lost executor costs no more than the job it was running. Jobs that do not build on each
other run side by side, and one that fails stops only those that build on it. A table that several jobs
total or average is scanned once, into a summary under ``<output>/summaries``. ``--csv`` also exports
each result as CSV under ``<output>/csv/<name>``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from functools import partial
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from indicata.functions import fixed_values as V
from indicata.operators import filters
from indicata.operators.partials import summary
from indicata.plans import jobs
from indicata.session import spark_session
from indicata.sources import schemas, tables
from indicata.sources.archive import extract_archives
from indicata.sources.manifest import read_manifest, run_manifest


@dataclass(frozen=True)
class Job:
    """One result: its inputs (observation subjects, files or earlier results) and how to build it.

    ``single_file`` exports it as one sorted CSV file, which suits reports but not row-level results.
    """

    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    sort_by: str | None = None
    exported: bool = field(default=True)
    single_file: bool = field(default=True)


JOBS = (
    Job("covid_cases", ("covid",), jobs.covid_cases, single_file=False),
    Job("provincial_cases", ("covid_cases",), jobs.provincial_cases, "Week Number"),
    Job("GDP_output", ("gdp",), jobs.gdp_output, "REF_DATE"),
    Job("MT_output", ("merchandise_trade",), jobs.trade_output, "YEAR"),
    Job("GDP+MT_output", ("GDP_output", "MT_output"), jobs.gdp_trade_output, "REF_DATE"),
    Job("Retail1_output", ("retail",), jobs.retail_by_province, "REF_DATE"),
    Job("Retail2_output", ("retail",), jobs.retail_by_industry, "REF_DATE"),
    Job("Yahoo_output", ("stock",), jobs.stock_output, "REF_DATE"),
    Job("Retail+YahooStock", ("Retail2_output", "Yahoo_output"), jobs.retail_stock_output, "REF_DATE"),
    Job("IMF_output", ("macro",), jobs.macro_output),
    Job("FDindex_output", ("development",), jobs.development_output),
    Job("Canada_CPI_output", ("cpi",), jobs.cpi_output, "YEAR"),
    Job("monthly_productivity", ("gdp", "hours"), jobs.monthly_productivity, exported=False),
    Job("GDP_hours_worked_output", ("monthly_productivity",), jobs.hours_worked_output, "YEAR"),
    Job("Labour_productivity_output", ("monthly_productivity",), jobs.labour_productivity_output, "YEAR"),
    Job("tsx_totals", ("tsx",), jobs.tsx_totals, exported=False),
    Job("TSX_output", ("tsx_totals",), jobs.tsx_output, "REF_DATE"),
    Job("TSX60_output", ("tsx_totals",), jobs.tsx60_output, "REF_DATE"),
    Job("TSX-yearly", ("TSX_output",), jobs.tsx_yearly, "REF_DATE"),
    Job("BIndicator_output", ("leading_indicators",), jobs.leading_indicator_output, "YEAR"),
    Job("Retail_Trade_output", ("gdp", "retail"), jobs.retail_trade_output, "YEAR"),
    Job(
        "healthcare_analysis",
        ("covid_cases", "GDP_output", "cpi", "Retail2_output", "MT_output"),
        jobs.healthcare_analysis,
        "Month",
    ),
    Job("household_consumption_output", ("spending",), jobs.household_consumption_output, "YEAR"),
    Job("gdp_countries_output", ("countries",), jobs.gdp_countries_output, "DATE"),
    Job(
        "gdp_pred_input",
        ("GDP_hours_worked_output", "Canada_CPI_output", "GDP+MT_output", "household_consumption_output"),
        jobs.prediction_input,
        "YEAR",
    ),
)


# observation tables several jobs total or average, and the columns those jobs look at
SUMMARISED = {
    "gdp": ["REF_DATE", "GEO", "Seasonal adjustment", "Prices", V.NAICS],
    "retail": ["REF_DATE", "GEO", V.NAICS, "Adjustments"],
}


def read_input(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input by its subject or file name."""
    if name == "stock":
        return tables.read_csv(spark, f"{folder}/stock.csv", schemas.STOCK_SCHEMA)
    if name == "countries":
        return tables.read_series_files(spark, f"{folder}/countries/*.csv", list(V.COUNTRY_SERIES))
    if name == "macro":
        return tables.read_csv(spark, f"{folder}/macro.csv", schemas.MACRO_SCHEMA)
    if name == "development":
        return tables.read_csv(spark, f"{folder}/development.csv", schemas.DEVELOPMENT_SCHEMA)
    identifier = schemas.table_id(name)
    path = f"{folder}/{identifier}"
    if tables.has_suffix(spark, path, ".parquet"):
        return spark.read.parquet(path)
    return tables.read_csv(spark, path, schemas.observation_schema(identifier))


MALFORMED = "_malformed"
#: In a cleansed table, the text of months that are none.
MONTH_TEXT = "REF_DATE_TEXT"


def cleanse_table(
    spark: SparkSession, raw_path: str, output: str, identifier: str, month_dates: bool = True, by_year: bool = False
) -> str | None:
    """Cleanse one raw CSV table to Parquet under ``output/<table id>`` with a schema sidecar.

    A complete output is an error and the raw input is never touched. Months of a known table are stored as
    dates; a table without a known schema keeps its text. ``by_year`` stores a folder per year of the date, and
    windows then read only theirs. Rows are counted as they are written. Lines that do not fit the schema (what fits
    is read) and rows whose month is none (the date is null, the text stays in ``REF_DATE_TEXT``) go to
    ``output/quarantine/<table id>`` as well; the result says how many there are of each.
    """
    known = identifier in V.OBSERVATION_TABLES
    schema = schemas.observation_schema(identifier) if known else None
    raw = tables.read_csv(spark, raw_path, schema, malformed=MALFORMED)
    text = known and month_dates and raw.schema["REF_DATE"].dataType.typeName() == "string"
    read, kept = Observation(), Observation()
    rows = jobs.cleansed(
        raw.observe(read, F.count(MALFORMED).alias("malformed")),
        month_dates=month_dates and known,
        text_name=MONTH_TEXT if text else None,
    )
    if text:
        rows = rows.observe(kept, F.count(MONTH_TEXT).alias("months"))
    rows = rows.drop(MALFORMED)
    if by_year and text:
        rows = rows.withColumn(filters.YEAR_PARTITION, F.year("REF_DATE"))
    partition = filters.YEAR_PARTITION if filters.YEAR_PARTITION in rows.columns else None
    tables.write_published(
        rows,
        f"{output}/{identifier}",
        replace=False,
        sidecar=f"{output}/schema/{identifier}.json",
        partition_by=partition,
        rebalanced=partition is not None,
    )
    malformed, months = read.get["malformed"], kept.get["months"] if text else 0
    if malformed or months:
        odd = jobs.cleansed(raw, month_dates=month_dates and known, text_name=MONTH_TEXT if text else None)
        reasons = [(raw, F.col(MALFORMED).isNotNull(), "malformed line")]
        if text:
            reasons.append((odd, F.col(MONTH_TEXT).isNotNull(), "no month"))
        parts = [df.where(found).withColumn("reason", F.lit(name)) for df, found, name in reasons]
        quarantine = parts[0] if len(parts) == 1 else parts[0].unionByName(_month_as_text(parts[1]))
        tables.write_published(quarantine, f"{output}/quarantine/{identifier}")
    counts = ((malformed, "malformed lines"), (months, "months not read"))
    return ", ".join(f"{n} {what}" for n, what in counts if n) or None


def _month_as_text(rows: DataFrame) -> DataFrame:
    """Rows of a cleansed table as they were read."""
    return rows.withColumn("REF_DATE", F.col(MONTH_TEXT)).drop(MONTH_TEXT)


def ingest(
    spark: SparkSession,
    manifest_path: str,
    raw: str,
    output: str,
    archives: str | None = None,
    month_dates: bool = True,
    member: str | None = None,
    by_year: bool = False,
) -> DataFrame:
    """Cleanse every table a manifest lists; return ``table_id``, ``status``.

    Raw tables are ``raw/<table id>.csv``. With ``archives``, the zip files of that folder are first
    unpacked under ``raw`` (their first entries, or those that ``member`` names) and read from there, unless every
    listed table is complete there or cleansed. Tables complete under ``output`` are skipped; what an earlier run
    left half done is done again.
    """
    manifest = read_manifest(spark, manifest_path)
    location = f"{raw}/{{}}.csv"
    if archives is not None:
        location = f"{raw}/member={{}}"
        present = [
            tables.is_complete(spark, f"{output}/{row['table_id']}")
            or tables.is_complete(spark, location.format(row["table_id"]))
            for row in manifest.toLocalIterator()
        ]
        if not all(present):
            extract_archives(spark, archives, raw, member, replace=False)
    return run_manifest(
        manifest,
        lambda identifier: cleanse_table(spark, location.format(identifier), output, identifier, month_dates, by_year),
        lambda identifier: f"{output}/{identifier}",
    )


def run(
    spark: SparkSession,
    folder: str,
    output: str,
    names: Sequence[str] | None = None,
    csv: bool = False,
    parallel: int = 4,
    resume: bool = False,
) -> DataFrame:
    """Run the named jobs (all by default) and those they build on; return ``job``, ``status``.

    Up to ``parallel`` jobs whose inputs are there run side by side. A job that fails is reported; those that build
    on it are not run, and all others are. A result takes its place only once it is complete. With ``resume``, jobs
    whose results are complete are not run again.
    """
    by_name = {job.name: job for job in JOBS}
    wanted: set[str] = set()
    pending = list(by_name if names is None else names)
    while pending:
        name = pending.pop()
        if name in by_name and name not in wanted:
            wanted.add(name)
            pending.extend(by_name[name].inputs)
        elif name not in by_name and names is not None and name in names:
            raise KeyError(name)
    stored = {name: f"{output}/tables/{name}" for name in wanted}
    finished = {name for name in wanted if resume and tables.is_complete(spark, stored[name])}
    left = wanted - finished
    # a table several jobs look at is summarised first, as a step of its own that they build on
    summaries = {
        name: f"{output}/summaries/{name}"
        for name in SUMMARISED
        if sum(name in by_name[job].inputs for job in left) > 1
    }

    def table(name: str) -> DataFrame:
        path = stored.get(name) or summaries.get(name)
        return read_input(spark, folder, name) if path is None else spark.read.parquet(path)

    def summarise(name: str) -> None:
        tables.write_published(summary(read_input(spark, folder, name), SUMMARISED[name]), summaries[name])

    def build(name: str) -> None:
        job = by_name[name]
        result = job.build(*[table(n) for n in job.inputs])
        layout = {} if job.single_file else {"rebalanced": True}
        tables.write_published(result, stored[name], sidecar=f"{output}/schema/{name}.json", **layout)
        if csv and job.exported:
            kept = spark.read.parquet(stored[name])
            layout = {"single_file": True} if job.single_file else {"rebalanced": True}
            tables.write_published(kept, f"{output}/csv/{name}", fmt="csv", sort_by=job.sort_by, **layout)

    needs = {name: [n for n in by_name[name].inputs if n in left or n in summaries] for name in left}
    steps = {name: partial(build, name) for name in left}
    steps.update({name: partial(summarise, name) for name in summaries})
    outcome = _run_steps(spark, steps, needs, parallel)
    outcome.update(dict.fromkeys(finished, "Skipped"))
    report = [(job.name, outcome[job.name]) for job in JOBS if job.name in wanted]
    return spark.createDataFrame(report, "job string, status string")


def _run_steps(
    spark: SparkSession, steps: Mapping[str, Callable[[], None]], needs: Mapping[str, list[str]], parallel: int
) -> dict[str, str]:
    """The status of every step: run once all that it needs has been, or not run where one of these was not."""
    order = TopologicalSorter({name: needs.get(name, ()) for name in steps})
    order.prepare()
    outcome: dict[str, str] = {}
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        while order.is_active():
            for name in order.get_ready():
                lacking = [n for n in needs.get(name, ()) if outcome[n] != "Successful"]
                if lacking:
                    outcome[name] = f"Not run: needs {', '.join(lacking)}"
                    order.done(name)
                else:
                    running[pool.submit(inheritable_thread_target(spark)(steps[name]))] = name
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                name, error = running.pop(future), future.exception()
                outcome[name] = "Successful" if error is None else f"{type(error).__name__}: {error}"
                order.done(name)
    return outcome


def main() -> None:
    parser = argparse.ArgumentParser(description="Run indicator jobs.")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--csv", action="store_true")
    parser.add_argument("jobs", nargs="*")
    parser.add_argument("--resume", action="store_true", help="keep the results that are complete")
    options = parser.parse_args()
    status = run(
        spark_session(), options.input, options.output, options.jobs or None, options.csv, resume=options.resume
    )
    status.show(100, False)
    if status.where("status NOT IN ('Successful', 'Skipped')").count():
        raise SystemExit(1)


if __name__ == "__main__":
    main()
