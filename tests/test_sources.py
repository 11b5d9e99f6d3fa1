"""Files in, files out."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from indicata.functions import fixed_values as V
from indicata.plans import jobs, run
from indicata.sources import archive, manifest, schemas, tables


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)
    return path


def test_observation_schemas_share_their_columns():
    for identifier, (subject, dimensions, _) in V.OBSERVATION_TABLES.items():
        schema = schemas.observation_schema(identifier)
        assert schema.names[:3] == ["REF_DATE", "GEO", "DGUID"]
        assert schema.names[3 : 3 + len(dimensions)] == dimensions
        assert schema.names[-5:] == ["VALUE", "STATUS", "SYMBOL", "TERMINATED", "DECIMALS"]
        assert schemas.table_id(subject) == identifier
    with pytest.raises(KeyError):
        schemas.table_id("nothing")


def test_schema_sidecar_round_trip(spark, folder):
    schema = schemas.observation_schema("13100781")
    tables.save_schema(spark, schema, f"{folder}/s.json")
    assert tables.load_schema(spark, f"{folder}/s.json") == schema
    plain = write(f"{folder}/plain.json", json.dumps(json.loads(schema.json()), indent=2))
    assert tables.load_schema(spark, plain) == schema


def test_inferred_csv_keeps_month_text(spark, folder):
    path = write(f"{folder}/t.csv", "REF_DATE,VALUE,NAME\n2010-01,1.5,a\n2010-02,2,b\n")
    df = tables.read_csv(spark, path)
    assert df.dtypes == [("REF_DATE", "string"), ("VALUE", "double"), ("NAME", "string")]
    assert df.count() == 2


def test_write_modes_and_layouts(spark, folder):
    df = spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("p")).repartition(5)
    tables.write_table(df, f"{folder}/c", fmt="csv", sort_by="k", single_file=True)
    files = [f for f in os.listdir(f"{folder}/c") if f.endswith(".csv")]
    assert len(files) == 1
    with open(f"{folder}/c/{files[0]}") as text:
        assert text.read().splitlines()[:3] == ["k,p", "0,x", "1,x"]
    tables.write_table(df, f"{folder}/f", files=2)
    assert len([f for f in os.listdir(f"{folder}/f") if f.endswith(".parquet")]) == 2
    tables.write_table(df, f"{folder}/p", partition_by="p")
    assert os.path.isdir(f"{folder}/p/p=x")
    with pytest.raises(Exception, match="already exists"):
        tables.write_table(df, f"{folder}/f", mode="errorifexists")
    tables.write_table(df, f"{folder}/f", mode="ignore")
    assert spark.read.parquet(f"{folder}/f").count() == 100


def test_manifest_run_reports_and_skips(spark, folder):
    path = write(f"{folder}/list.txt", "One, with comma (x) :1\nTwo :2\n\nThree :3")
    listed = manifest.read_manifest(spark, path)
    assert [tuple(r) for r in listed.collect()] == [("One, with comma (x)", "1"), ("Two", "2"), ("Three", "3")]
    write(f"{folder}/out/2/_SUCCESS", "")
    write(f"{folder}/out/1/_temporary/0/part", "half written")

    def step(identifier):
        if identifier == "3":
            spark.read.parquet(f"{folder}/missing").count()

    status = dict(tuple(r) for r in manifest.run_manifest(listed, step, lambda i: f"{folder}/out/{i}").collect())
    assert status["1"] == "Successful" and status["2"] == "Skipped"
    assert "AnalysisException" in status["3"]


def test_archives_are_extracted_in_order(spark, folder):
    os.makedirs(f"{folder}/zips")
    for name, count in (("100", 25_000), ("200", 3)):
        with zipfile.ZipFile(f"{folder}/zips/{name}.zip", "w", zipfile.ZIP_DEFLATED) as out:
            body = "﻿REF_DATE,VALUE\r\n" + "".join(f"2010-01,{i}\r\n" for i in range(count))
            out.writestr(f"{name}.csv", body)
            out.writestr(f"{name}_MetaData.csv", "not,this\n")
    lines = archive.read_archives(spark, f"{folder}/zips")
    assert lines.groupBy("member").count().orderBy("member").collect() == [("100.csv", 25_001), ("200.csv", 4)]
    archive.extract_archives(spark, f"{folder}/zips", f"{folder}/text")
    df = tables.read_csv(spark, f"{folder}/text/member=100")
    assert df.columns == ["REF_DATE", "VALUE"]
    assert df.agg(F.count("*"), F.sum("VALUE")).first() == (25_000, sum(range(25_000)))
    (part,) = [f for f in os.listdir(f"{folder}/text/member=100") if f.endswith(".txt")]
    with open(f"{folder}/text/member=100/{part}") as text:
        numbers = [line.split(",")[1] for line in text.read().splitlines()[1:]]
    assert numbers == [str(i) for i in range(25_000)]


def zipped(path, entries):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name, text in entries.items():
            out.writestr(name, text)


def test_entries_are_units_and_can_be_chosen(spark, folder):
    zipped(f"{folder}/zips/a.zip", {"d/": "", "d/1.csv": "A\n1\n", "1_MetaData.csv": "m\n"})
    zipped(f"{folder}/zips/b.zip", {"2.csv": "A\n2\n3\n", "2_MetaData.csv": "n\n", "empty.csv": ""})
    first = archive.list_entries(spark, f"{folder}/zips").orderBy("member")
    assert [(r.member, r.position, r.bytes) for r in first.collect()] == [("2.csv", 0, 6), ("d/1.csv", 0, 4)]
    every = archive.read_archives(spark, f"{folder}/zips", "*")
    assert every.rdd.getNumPartitions() == 5
    assert every.groupBy("member").count().count() == 4
    meta = archive.read_archives(spark, f"{folder}/zips", "*_MetaData.csv")
    assert sorted(r.line for r in meta.collect()) == ["m", "n"]
    done = archive.extract_archives(spark, f"{folder}/zips", f"{folder}/text", "*.csv")
    assert sorted(done) == ["1", "1_MetaData", "2", "2_MetaData", "empty"]
    assert sorted(os.listdir(f"{folder}/text")) == ["member=1", "member=1_MetaData", "member=2", "member=2_MetaData"]
    assert archive.extract_archives(spark, f"{folder}/zips", f"{folder}/text", "?.csv", replace=False) == []
    assert tables.read_csv(spark, f"{folder}/text/member=2").agg(F.sum("A")).first()[0] == 5


def test_two_entries_of_one_name_are_refused(spark, folder):
    zipped(f"{folder}/zips/a.zip", {"1.csv": "A\n1\n"})
    zipped(f"{folder}/zips/b.zip", {"x/1.csv": "A\n2\n"})
    assert archive.read_archives(spark, f"{folder}/zips").select("archive").distinct().count() == 2
    with pytest.raises(ValueError, match="a.zip and .*b.zip|b.zip and .*a.zip"):
        archive.extract_archives(spark, f"{folder}/zips", f"{folder}/text")
    assert not os.path.exists(f"{folder}/text")


def test_archives_that_only_hadoop_can_open(spark, folder, monkeypatch):
    zipped(f"{folder}/zips/a.zip", {"1.csv": "A\n1\n", "2.csv": "A\n2\n"})
    monkeypatch.setattr(archive, "streamed", lambda path: False)
    lines = archive.read_archives(spark, f"{folder}/zips", "*").orderBy("member", "line_number")
    assert [(r.member, r.line) for r in lines.collect()] == [("1.csv", "A"), ("1.csv", "1"), ("2.csv", "A"), ("2.csv", "2")]


def test_schemes_that_arrow_streams_from():
    assert archive.streamed("file:/x/a.zip")
    assert archive._arrow_uri("s3a://bucket/a.zip") == "s3://bucket/a.zip"
    assert not archive.streamed("other://bucket/a.zip")


def test_a_half_extracted_table_is_extracted_again(spark, folder):
    zipped(f"{folder}/zips/a.zip", {"1.csv": "A\n1\n"})
    write(f"{folder}/text/member=1/_temporary/0/part", "half")
    write(f"{folder}/text/member=1/part-old.txt", "A")
    assert archive.extract_archives(spark, f"{folder}/zips", f"{folder}/text", replace=False) == ["1"]
    assert "_temporary" not in os.listdir(f"{folder}/text/member=1")
    assert tables.read_csv(spark, f"{folder}/text/member=1").collect() == [(1,)]


def test_a_table_appears_only_when_it_is_complete(spark, folder):
    df = spark.range(10)
    os.makedirs(f"{folder}/t/_temporary")
    tables.write_published(df, f"{folder}/t", replace=False)
    assert tables.is_complete(spark, f"{folder}/t") and spark.read.parquet(f"{folder}/t").count() == 10
    with pytest.raises(FileExistsError, match="already exists"):
        tables.write_published(df, f"{folder}/t", replace=False)
    fails = df.select(F.raise_error(F.lit("stop")).cast("int").alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.write_published(fails, f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 10
    tables.write_published(spark.range(3), f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 3 and os.listdir(folder) == ["t"]


def test_files_of_a_table_sized_result_leave_the_work_wide(spark, folder):
    wide = spark.range(0, 1000, 1, 8).where("id % 2 = 0")
    tables.write_table(wide, f"{folder}/f", files=2)
    assert len([f for f in os.listdir(f"{folder}/f") if f.endswith(".parquet")]) == 2
    tables.write_table(wide, f"{folder}/s", files=2, sort_by="id")
    parts = sorted(f for f in os.listdir(f"{folder}/s") if f.endswith(".parquet"))
    firsts = [[r.id for r in spark.read.parquet(f"{folder}/s/{p}").collect()] for p in parts]
    assert len(parts) == 2 and firsts[0] + firsts[1] == list(range(0, 1000, 2))
    tables.write_table(wide, f"{folder}/r", rebalanced=True)
    assert len([f for f in os.listdir(f"{folder}/r") if f.endswith(".parquet")]) == 1  # far below the advisory size


def test_a_file_of_another_header_fails_by_name(spark, folder):
    schema = schemas.struct({"A": "int", "B": "int"})
    write(f"{folder}/t/good.csv", "A,B\n1,2\n")
    assert tables.read_csv(spark, f"{folder}/t", schema).collect() == [(1, 2)]
    write(f"{folder}/t/turned.csv", "B,A\n4,3\n")
    with pytest.raises(Exception, match="turned.csv"):
        tables.read_csv(spark, f"{folder}/t", schema).collect()


def test_partitioned_parquet_is_read_as_parquet(spark, folder):
    path = f"{folder}/{schemas.table_id('gdp')}"
    tables.write_table(spark.createDataFrame([("2010-01", 1, 2010)], "REF_DATE string, VALUE int, y int"), path, partition_by="y")
    assert run.read_input(spark, folder, "gdp").count() == 1


def test_series_files_are_one_scan(spark, folder):
    write(f"{folder}/c/Canada.csv", "DATE,AAA\n1999-01-01,2000000000\n2000-01-01,3000000000\n")
    write(f"{folder}/c/US.csv", "DATE,BBB\n1999-09-30,9.5\n2000-09-30,10.5\n1930-06-30,1\n")
    write(f"{folder}/c/Other.csv", "DATE,CCC\n1999-01-01,5\n")
    rows = tables.read_series_files(spark, f"{folder}/c/*.csv", ["Canada", "US"])
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    specs = {k: V.COUNTRY_SERIES[k] for k in ("Canada", "US")}
    panel = jobs.gdp_countries_output(rows, specs).orderBy("DATE")
    assert [tuple(r) for r in panel.collect()] == [(1999, 2.0, 9.5), (2000, 3.0, 10.5)]


COMMON = {"DGUID": "", "UOM": "u", "UOM_ID": "1", "SCALAR_FACTOR": "units", "SCALAR_ID": "0", "VECTOR": "v"}


def observation_csv(folder, subject, rows):
    identifier = schemas.table_id(subject)
    names = schemas.observation_schema(identifier).names
    lines = [",".join(f'"{n}"' for n in names)]
    for row in rows:
        cells = {**COMMON, **row}
        lines.append(",".join(f'"{cells[n]}"' if cells.get(n) not in (None, "") else "" for n in names))
    write(f"{folder}/{identifier}/part.csv", "\n".join(lines) + "\n")


def months(first, last):
    return [f"{y}-{m:02d}" for y in range(first, last + 1) for m in range(1, 13)]


@pytest.fixture
def inputs(folder):
    root = f"{folder}/in"
    gdp, hours, retail, cpi, trade, spending, tsx, leading = [], [], [], [], [], [], [], []
    for i, month in enumerate(months(2009, 2020)):
        gdp += [
            {"REF_DATE": month, "GEO": "Canada", "Seasonal adjustment": adj, "Prices": "p", V.NAICS: n, "VALUE": 1000 + i + k}
            for adj in ("Seasonally adjusted at annual rates", "Trading-day adjusted")
            for k, n in enumerate(["All industries [T001]", V.RETAIL_TRADE, "Health care [62]", "Cannabis production [111C]"])
        ]
        hours += [
            {"REF_DATE": month, "GEO": "Canada", V.NAICS: n, "Statistics": s, "VALUE": 500.9 + i}
            for n in ("Total actual hours worked, all industries", "Wholesale and retail trade [41]")
            for s in ("Estimate", "Standard error")
        ]
        retail += [
            {"REF_DATE": month, "GEO": g, V.NAICS: n, "Adjustments": "Seasonally adjusted", "VALUE": 10 + i + k}
            for g in ("Canada", "Ontario", "Toronto, Ontario")
            for k, n in enumerate([V.RETAIL_TRADE, V.HEALTH_STORES, "Cannabis stores [453993]"])
        ]
        cpi += [
            {"REF_DATE": month, "GEO": g, "Products and product groups": p, "VALUE": 100.25 + i}
            for g in ("Canada", "Ontario", "Toronto, Ontario")
            for p in ("All-items", "Other health goods")
        ]
        trade += [
            {"REF_DATE": month, "Trade": t, "Basis": b, "Seasonal adjustment": "Seasonally adjusted",
             V.NAPCS: V.PHARMA_PRODUCTS, "VALUE": 200.0 + i}
            for t in ("Import", "Export")
            for b in ("Customs", "Balance of payments")
        ]
        if i % 3 == 0:
            spending.append(
                {"REF_DATE": month, "GEO": "Canada", "Prices": "Current prices",
                 "Seasonal adjustment": "Seasonally adjusted at quarterly rates",
                 "Estimates": "Household final consumption expenditure", "VALUE": 900 + i}
            )
        tsx += [
            {"REF_DATE": month, "GEO": "Canada", "Toronto Stock Exchange Statistics": s, "UOM": u, "VALUE": 99 + k}
            for k, s in enumerate([V.TSX_60, "Composite"])
            for u in ("Index", "Dollars")
        ]
        leading += [
            {"REF_DATE": month, "GEO": "Canada", "Leading indicators": "Housing", "Composite index": c, "VALUE": v}
            for c in ("Smoothed", "Unsmoothed")
            for v in (5, 0, -3)
        ]
    for subject, rows in {
        "gdp": gdp, "hours": hours, "retail": retail, "cpi": cpi, "merchandise_trade": trade,
        "spending": spending, "tsx": tsx, "leading_indicators": leading,
    }.items():
        observation_csv(root, subject, rows)
    cases = []
    for case, values in enumerate([(2, 10, 12, 1), (2, 10, 12, 2), (3, 14, None, 9)]):
        codes = {"Region": values[0], "Episode week": values[1], "Recovery week": values[2], "Recovered": values[3],
                 "Age group": 1, "Death": 2, "Occupation": 1, "Hospital status": 3}
        cases += [
            {"REF_DATE": 2020, "GEO": "Canada", V.CASE_ID: case, V.CASE_ATTRIBUTE: a, "VALUE": v}
            for a, v in codes.items()
        ]
    observation_csv(root, "covid", cases)
    write(f"{root}/stock.csv", "REF_DATE,Open,High,Low,Close,Adj Close,Volume\n2009-12,1,1,1,1,1,1\n2010-01,1,3,2,1,1,7\n")
    for name in V.COUNTRY_SERIES:
        day = "09-30" if name == "US" else "01-01"
        write(f"{root}/countries/{name}.csv", f"DATE,X\n1998-{day},1\n1999-{day},5000000000\n2020-{day},7000000000\n")
    header = [*V.MACRO_TEXT_COLUMNS, *V.MACRO_YEARS, "Estimates Start After"]
    line = ",".join(["GDP", "Units", "", "", *["1.5"] * 23, "2019"])
    partial = ",".join(["Gap", "Units", "", "", *["1.5"] * 12, "", *["1.5"] * 10, "2019"])
    write(f"{root}/macro.csv", "\n".join([",".join(header), line, line, partial, line.replace("Units", "")]) + "\n")
    lines = ["ifs,code,country,imf_region,imf_income,year," + ",".join(V.DEVELOPMENT_INDICES)]
    for country in ("Canada", "Chad"):
        lines += [f"1,CAN,{country},r,i,{y}," + ",".join([f"0.{y % 100}"] * 9) for y in range(2009, 2020)]
    write(f"{root}/development.csv", "\n".join(lines) + "\n")
    return root


def test_all_jobs_from_files_to_files(spark, folder, inputs):
    out = f"{folder}/out"
    status = run.run(spark, inputs, out, csv=True)
    assert status.count() == len(run.JOBS)

    def result(name):
        return spark.read.parquet(f"{out}/tables/{name}")

    gdp = result("GDP_output")
    assert {r[0] for r in gdp.select("NAICS").distinct().collect()} == {
        "All industries [T001]", V.RETAIL_TRADE, "Health care [62]"
    }
    assert gdp.select("REF_DATE").distinct().count() == 130
    assert result("MT_output").columns == ["YEAR", "NAPCS", "Trade", "Basis", "Total Merch Trade Value"]
    assert result("GDP+MT_output").count() == 130
    assert result("Retail1_output").columns == ["REF_DATE", "Ontario"]
    assert result("Retail2_output").columns == ["REF_DATE", V.HEALTH_STORES, V.RETAIL_TRADE]
    assert [tuple(r)[1:] for r in result("Yahoo_output").collect()] == [(7.0, 3.0, 2.0)]
    (row,) = result("Retail+YahooStock").collect()
    assert row["TotalRetailTradePrice"] == (10 + 12) + (11 + 12)
    assert [tuple(r) for r in result("IMF_output").collect()] == [("GDP", *[1.5] * 10)]
    development = result("FDindex_output")
    assert development.columns == ["year", *[str(y) for y in range(2010, 2019)]]
    assert development.count() == 9 and development.first()["2012"] == "0.12"
    assert result("Canada_CPI_output").columns == ["YEAR", "Canada", "Ontario"]
    cpi_2010 = result("Canada_CPI_output").where("YEAR = 2010").first()
    assert cpi_2010["Canada"] == round(100.25 + 12 + 5.5, 2)
    hours = result("GDP_hours_worked_output").where("YEAR = 2010 AND NAICS = 'All industries'").first()
    assert hours["HOURS_WORKED"] == 500 + 12 + 5.5
    assert result("Labour_productivity_output").columns == ["YEAR", "All industries", "Wholesale and retail trade"]
    assert result("TSX_output").count() == 0
    assert result("TSX60_output").count() == 144
    assert {r[2] for r in result("BIndicator_output").collect()} == {5.0}
    assert result("BIndicator_output").count() == 12
    assert result("Retail_Trade_output").columns == ["YEAR", "RETAIL_GDP*(10^3)", "RETAIL_TRADE_SALES *(10^6)"]
    assert result("household_consumption_output").count() == 11
    assert [tuple(r) for r in result("gdp_countries_output").orderBy("DATE").select("DATE", "US", "UK").collect()] == [
        (1999, 5000000000.0, 5.0), (2020, 7000000000.0, 7.0)
    ]
    health = result("healthcare_analysis")
    assert health.columns[-1] == "Month" and "GDP of Health care [62] x10^6 (in CAD)" in health.columns
    assert health.count() == 22
    march = health.where("Month = '2020-03-01'").first()
    assert (march["New cases"], march["Recovered cases"], march["Deaths"]) == (2, 1, None)
    weeks = {r["Week Number"]: r for r in result("provincial_cases").collect()}
    assert weeks[10]["Total New cases"] == 2 and weeks[10]["Recovered cases"] == 0
    features = result("gdp_pred_input")
    assert tuple(features.columns) == V.FEATURE_COLUMNS and features.count() == 11
    with open(f"{out}/csv/GDP_output/" + [f for f in os.listdir(f"{out}/csv/GDP_output") if f.endswith(".csv")][0]) as f:
        assert f.readline().strip() == "REF_DATE,NAICS,Total GDP Value"
    assert tables.load_schema(spark, f"{out}/schema/GDP_output.json") == gdp.schema


def test_cleansed_dates_give_the_same_results(spark, folder, inputs):
    clean = f"{folder}/clean"
    for subject in ("gdp", "hours", "covid"):
        identifier = schemas.table_id(subject)
        run.cleanse_table(spark, f"{inputs}/{identifier}", clean, identifier)
    stored = run.read_input(spark, clean, "gdp")
    assert dict(stored.dtypes)["REF_DATE"] == "date"
    assert stored.where("year(REF_DATE) < 2010").count() == 0
    by_date = jobs.gdp_output(stored)
    by_text = jobs.gdp_output(run.read_input(spark, inputs, "gdp"))
    assert sorted(map(tuple, by_date.collect())) == sorted(map(tuple, by_text.collect()))
    plan = by_date._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(REF_DATE,2010-01-01)" in plan
    assert dict(run.read_input(spark, clean, "covid").dtypes)["REF_DATE"] == "int"
    with pytest.raises(Exception, match="already exists"):
        run.cleanse_table(spark, f"{inputs}/36100434", clean, "36100434")


def test_unknown_table_keeps_its_text(spark, folder):
    path = write(f"{folder}/raw.csv", "REF_DATE,VALUE\n2015,1\n2009,2\n2016,3\n")
    run.cleanse_table(spark, path, f"{folder}/clean", "99999999")
    stored = spark.read.parquet(f"{folder}/clean/99999999")
    assert sorted(tuple(r) for r in stored.collect()) == [("2015", 1), ("2016", 3)]


GDP_LINE = "{},Canada,,Trading-day adjusted,p,All industries [T001],u,1,units,0,v,1.1,{},,,,0"


def odd_gdp(folder):
    header = ",".join(f'"{n}"' for n in schemas.observation_schema("36100434").names)
    lines = [("2015-01", 5), ("2015-05-01", 7), ("2015", 8), ("2015-13", 9), ("2009-01", 1), ("2016-02", "x")]
    text = "\n".join([header, *[GDP_LINE.format(*x) for x in lines], "2017-01,Canada"])
    return write(f"{folder}/raw/36100434.csv", text + "\n")


@pytest.mark.parametrize("by_year", [False, True])
def test_rows_that_cannot_be_read_are_counted_and_kept(spark, folder, by_year):
    odd_gdp(folder)
    listed = write(f"{folder}/list.txt", "GDP :36100434\n")
    status = run.ingest(spark, listed, f"{folder}/raw", f"{folder}/clean", by_year=by_year)
    assert [tuple(r) for r in status.collect()] == [("36100434", "Successful (2 malformed lines, 3 months not read)")]
    stored = spark.read.parquet(f"{folder}/clean/36100434")
    assert {r.REF_DATE_TEXT for r in stored.where("REF_DATE IS NULL").collect()} == {"2015-05-01", "2015", "2015-13"}
    assert stored.count() == 6 and "_malformed" not in stored.columns
    odd = spark.read.parquet(f"{folder}/clean/quarantine/36100434")
    assert sorted((r.reason, r.REF_DATE) for r in odd.collect()) == [
        ("malformed line", "2016-02"), ("malformed line", "2017-01"),
        ("no month", "2015"), ("no month", "2015-05-01"), ("no month", "2015-13"),
    ]
    assert "2017-01,Canada" in {r._malformed for r in odd.collect()}
    assert [r.status for r in run.ingest(spark, listed, f"{folder}/raw", f"{folder}/clean").collect()] == ["Skipped"]


def test_windows_read_only_the_years_they_need(spark, folder, inputs):
    run.cleanse_table(spark, f"{inputs}/36100434", folder, "36100434", by_year=True)
    stored = run.read_input(spark, folder, "gdp")
    result = jobs.gdp_output(stored, window=("2012-03", "2013-02"))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(REF_YEAR" in plan and ">= 2012" in plan and "<= 2013" in plan
    by_text = jobs.gdp_output(run.read_input(spark, inputs, "gdp"), window=("2012-03", "2013-02"))
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, by_text.collect()))
    files = {f.split("REF_YEAR=")[1][:4] for f in stored.inputFiles()}
    assert files == {str(y) for y in range(2010, 2021)}


def test_a_failing_job_stops_only_those_that_build_on_it(spark, folder, inputs):
    os.rename(f"{inputs}/{schemas.table_id('tsx')}", f"{folder}/elsewhere")
    write(f"{inputs}/macro.csv", "not,the,columns\n1,2,3\n")
    status = dict(tuple(r) for r in run.run(spark, inputs, f"{folder}/out").collect())
    assert len(status) == len(run.JOBS)
    assert "Exception" in status["tsx_totals"] and "Exception" in status["IMF_output"]
    assert status["TSX_output"] == "Not run: needs tsx_totals" and status["TSX-yearly"] == "Not run: needs TSX_output"
    rest = set(status) - {"tsx_totals", "IMF_output", "TSX_output", "TSX60_output", "TSX-yearly"}
    assert {status[name] for name in rest} == {"Successful"}
    again = dict(tuple(r) for r in run.run(spark, inputs, f"{folder}/out", resume=True).collect())
    assert {again[name] for name in rest} == {"Skipped"} and again["TSX_output"] == status["TSX_output"]


def test_selected_jobs_bring_their_inputs(spark, folder, inputs):
    status = run.run(spark, inputs, f"{folder}/o", ["TSX-yearly"])
    assert [r["job"] for r in status.collect()] == ["tsx_totals", "TSX_output", "TSX-yearly"]
    with pytest.raises(KeyError):
        run.run(spark, inputs, f"{folder}/o", ["no such job"])


def test_ingest_from_archives(spark, folder, inputs):
    os.makedirs(f"{folder}/zips")
    for identifier in ("36100434", "10100125"):
        with zipfile.ZipFile(f"{folder}/zips/{identifier}.zip", "w", zipfile.ZIP_DEFLATED) as out:
            out.write(f"{inputs}/{identifier}/part.csv", f"{identifier}.csv")
    listed = write(f"{folder}/list.txt", "GDP :36100434\nTSX :10100125\nLost :33100111\n")
    kept = write(f"{folder}/raw/member=other/part.txt", "kept\n")
    options = (spark, listed, f"{folder}/raw", f"{folder}/clean", f"{folder}/zips")
    status = dict(tuple(r) for r in run.ingest(*options).collect())
    assert status["36100434"] == status["10100125"] == "Successful"
    assert "AnalysisException" in status["33100111"]
    again = dict(tuple(r) for r in run.ingest(*options).collect())
    assert again["36100434"] == again["10100125"] == "Skipped"
    assert os.path.exists(kept)
    clean = jobs.gdp_output(run.read_input(spark, f"{folder}/clean", "gdp"))
    assert clean.count() == jobs.gdp_output(run.read_input(spark, inputs, "gdp")).count() > 0


def test_gdp_can_be_narrowed_to_one_price_basis(spark, inputs):
    gdp, hours, retail = (run.read_input(spark, inputs, name) for name in ("gdp", "hours", "retail"))
    assert jobs.monthly_productivity(gdp, hours, gdp_where={"Prices": "other"}).count() == 0
    assert jobs.retail_trade_output(gdp, retail, {"Prices": "p"}).count() == 11


def test_bad_manifest_lines_are_reported(spark, folder):
    with open(f"{folder}/list.txt", "w") as handle:
        handle.write("Good :1\nno id here\nEmpty :\n")
    ran = []
    listed = manifest.read_manifest(spark, f"{folder}/list.txt")
    statuses = manifest.run_manifest(listed, ran.append).collect()
    assert ran == ["1"]
    assert [row["status"] for row in statuses] == ["Successful", "No table id: no id here", "No table id: Empty"]
