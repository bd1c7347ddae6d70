from __future__ import annotations

import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fumeline.operators.stats import describe, distinct_count, group_mean, quantiles
from fumeline.plans.air import air, air_from_file
from fumeline.session import stage
from fumeline.sources.readings import MISSING, read_readings

HEADER = "FIPS,Date,pm25_daily_average(ug/m3),note"


@pytest.fixture
def gz(tmp_path):
    def write(*lines):
        path = tmp_path / "daily.txt.gz"
        with gzip.open(path, "wt") as f:
            f.write("\n".join([HEADER, *lines]) + "\n")
        return str(path)
    return write


def test_gzip_scan_keeps_codes_as_text(spark, gz):
    df = read_readings(spark, gz("010010201001,2020-01-01,7.5,x"))
    assert dict(df.dtypes) == {"FIPS": "string", "Date": "string", "pm25": "double", "note": "string"}
    assert df.first()["FIPS"] == "010010201001"


def test_missing_texts_become_null(spark, gz):
    cells = [m for m in MISSING if m]
    df = read_readings(spark, gz(*[f"{m},{m},{m},x" for m in cells], ',"",,x'))
    assert df.count() == len(MISSING)
    assert df.filter("FIPS is not null or Date is not null or pm25 is not null").count() == 0


def test_quoted_cells(spark, gz):
    df = read_readings(spark, gz('"0101","a ""b"", c","1.5",x'))
    assert tuple(df.first())[:3] == ("0101", 'a "b", c', 1.5)


def test_bad_number_fails(spark, gz):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_readings(spark, gz("01,d,abc,x")).collect()


def test_another_header_fails(spark, gz):
    path = gz("2020-01-01,01,7.5,x")
    names = ["Date", "FIPS", "pm25_daily_average(ug/m3)", "note"]
    with pytest.raises(Exception, match="header"):
        read_readings(spark, path, columns=names).collect()
    assert read_readings(spark, path, columns=HEADER.split(",")).count() == 1


@pytest.mark.parametrize("line", ["01,d,7.5,x,extra", "01,d,7.5"])
def test_rows_of_another_width_fail(spark, gz, line):
    path = gz("01,d,7.5,x", line)
    for columns in (None, HEADER.split(",")):
        with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
            read_readings(spark, path, columns=columns).collect()
        with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
            read_readings(spark, path, columns=columns).select("Date").collect()


def test_missing_file_is_reported(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_readings(spark, "/nowhere/daily.txt.gz")


def test_named_columns_and_spread(spark, gz):
    path = gz(*[f"{i},d,1.0,x" for i in range(50)])
    df = read_readings(spark, path, columns=HEADER.split(","), spread=5)
    assert df.count() == 50 and df.rdd.getNumPartitions() == 5


def test_distinct_count_counts_missing_once(spark):
    def n(*days):
        return distinct_count(spark.createDataFrame([(d,) for d in days], "d string"), "d").first()[0]
    assert n("x", "y", None) == 3
    assert n("x", "x", None, None) == 2
    assert n("x", "y") == 2
    assert distinct_count(spark.createDataFrame([], "d string"), "d").first()[0] == 0


def test_group_mean_edges(spark):
    rows = [("a", float("nan")), ("a", 4.0), ("b", None), (None, 9.0)]
    got = group_mean(spark.createDataFrame(rows, "k string, v double"), "k", "v").collect()
    assert {r["k"]: r["v"] for r in got} == {"a": 4.0, "b": None}


def test_group_mean_in_key_order(spark):
    df = spark.createDataFrame([(f"{i * 37 % 100:03}", float(i)) for i in range(100)], "k string, v double")
    keys = [r["k"] for r in group_mean(df.repartition(4), "k", "v", ordered=True).collect()]
    assert keys == sorted(keys) and len(keys) == 100


def test_describe(spark):
    def stats(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        rows = describe(df, "v").collect()
        assert [r["stat"] for r in rows] == ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
        return {r["stat"]: r["value"] for r in rows}
    got = stats(1.0, 2.0, 3.0, 10.0, None)
    assert got == {
        "count": 4, "mean": 4, "std": pytest.approx(4.08248290463863), "min": 1, "max": 10,
        "25%": 1.75, "50%": 2.5, "75%": 4.75,
    }
    lone = stats(7.0)
    assert lone["std"] is None and lone["25%"] == lone["75%"] == 7.0
    for empty in (stats(), stats(None, None)):
        assert empty.pop("count") == 0 and set(empty.values()) == {None}


def test_quantiles_with_a_hot_value(spark):
    """Half of the rows hold one value; the rest spread over many."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, 500.0).otherwise((F.col("id") * 7919) % 1000 / 1.0).alias("v")
    )
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    want = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0]
    got = {r["prob"]: r["value"] for r in quantiles(df, "v", probs).collect()}
    assert [got[p] for p in probs] == pytest.approx(want)


def test_whole_air_job(spark, gz):
    path = gz("01,2020-01-01,1.0,x", "01,2020-01-02,3.0,x", "02,2020-01-01,5.0,x", "03,,NA,x")
    got = {r["stat"]: r["value"] for r in air_from_file(spark, path).collect()}
    assert got["days"] == 3 and got["count"] == 2
    assert (got["min"], got["50%"], got["max"]) == (2.0, 3.5, 5.0)


def test_the_air_job_unpacks_its_file_once(spark, gz, monkeypatch):
    path = gz("01,2020-01-01,1.0,x", "02,2020-01-01,5.0,x")
    rows = read_readings(spark, path)
    scans = []

    def staged(df, label):
        scans.append((label, df._jdf.queryExecution().executedPlan().toString().count("FileScan csv")))
        return stage(df, label)

    monkeypatch.setattr("fumeline.plans.air.stage", staged)
    result = air(rows)
    assert scans == [("readings", 1)]
    assert "FileScan csv" not in result._jdf.queryExecution().executedPlan().toString()
