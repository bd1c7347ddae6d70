from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from fumeline.functions.columns import line_length, number_text, parse_codes, route_key
from fumeline.functions.predicates import major_roads, major_roads_text, with_traffic
from fumeline.operators import numbering
from fumeline.operators.numbering import number
from fumeline.operators.stats import dissolve_attributes
from fumeline.sources.features import PATHS_TYPE

CODES = [(4, None), (4, 99999), (4, 1), (1, None), (None, 1), (5, 1), (2, 99999)]
KEPT = {(4, 1), (1, None), (2, 99999)}


def test_major_roads(spark):
    df = spark.createDataFrame(CODES, "F_SYSTEM int, URBAN_CODE int")
    assert set(map(tuple, major_roads(df).collect())) == KEPT


@pytest.mark.parametrize("names", [("F_SYSTEM", "URBAN_ID"), ("Field6", "Field8")])
def test_major_roads_text(spark, names):
    rows = [tuple(None if v is None else str(v) for v in r) for r in CODES]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    want = {tuple(None if v is None else str(v) for v in r) for r in KEPT}
    assert set(map(tuple, major_roads_text(df, *names).collect())) == want


def test_with_traffic(spark):
    nan = float("nan")
    rows = [(0.0, 1.0), (-1.0, 1.0), (None, 1.0), (nan, 1.0), (1.0, 0.0), (1.0, None), (1.0, nan),
            (1.0, 2.0)]
    df = spark.createDataFrame(rows, "AADT double, Shape_Length double")
    assert [tuple(r) for r in with_traffic(df).collect()] == [(1.0, 2.0)]


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "roads")
    spark.createDataFrame([(1, 2, 3, 1.0, "x")],
                          "F_SYSTEM int, URBAN_CODE int, AADT int, Shape_Length double, other string"
                          ).write.parquet(path)
    plan = with_traffic(major_roads(spark.read.parquet(path))).select("AADT")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(AADT,0)" in text and "In(F_SYSTEM" in text
    assert "other" not in text


def test_line_length(spark):
    def length(*paths):
        data = [([[tuple(map(float, p)) for p in path] for path in paths],)]
        return spark.createDataFrame(data, f"paths {PATHS_TYPE}").select(line_length()).first()[0]
    assert length([(0, 0), (3, 4), (3, 5)]) == 6.0
    assert length([(0, 0), (3, 4)], [(10, 0), (10, 2)]) == 7.0
    assert length([(1, 1)]) == 0.0 and length([]) == 0.0 and length() == 0.0


NUMBERS = [1200.0, 0.0, 0.5, -3.25, 1e7, 12345678.0, 12345678.25, 9007199254740993.0, 1e15, 1e16,
           1.5e16, 1e22, 2.5e300, 1e-3, 1e-4, 1.25e-4, 1e-5, 1.5e-7, 123.456, 1e100,
           math.inf, -math.inf, math.nan]


def test_number_text_matches_python(spark):
    df = spark.createDataFrame([(n,) for n in NUMBERS], "v double")
    got = [r[0] for r in df.select(number_text(F.col("v"), "double")).collect()]
    assert got == [str(n) for n in NUMBERS]


def test_keys(spark):
    rows = [(None, 5), ("1", 23), ("12", 3), ("None", 5)]
    df = spark.createDataFrame(rows, "r string, a int")
    plain = [r["key"] for r in route_key(df, "r", "a", null_route="None").collect()]
    assert plain == ["None5", "123", "123", "None5"]
    strict = [r["key"] for r in route_key(df, "r", "a", null_route="None", strict=True).collect()]
    assert len(set(strict)) == 4


def test_text_keys_keep_the_text(spark):
    df = spark.createDataFrame([("7", "1200"), ("7", "01200"), (None, "5")], "RouteID string, AADT string")
    assert [r["key"] for r in route_key(df, "RouteID", "AADT").collect()] == ["71200", "701200", None]


def test_parse_codes(spark):
    rows = [("1200", "1"), (" 7 ", "2"), ("12x", "1"), ("1200.0", "1"), ("", "1"), (None, "1"),
            ("5", "40000"), ("5", None), ("99999999999", "1")]
    df = spark.createDataFrame(rows, "AADT string, F string")
    casts = {"n": ("AADT", "int"), "c": ("F", "short")}
    good, rejects = parse_codes(df, casts, required=("n",))
    assert [tuple(r)[2:] for r in good.collect()] == [(1200, 1), (7, 2), (5, None)]
    assert [tuple(r) for r in rejects.collect()] == [rows[i] for i in (2, 3, 4, 5, 6, 8)]
    assert dict(good.dtypes)["c"] == "smallint"


def test_first_keeps_a_missing_first_value(spark):
    rows = [("k", 2, "z", 5), ("k", 1, None, 7), ("k", 3, "y", None)]
    df = spark.createDataFrame(rows, "key string, OBJECTID long, v string, a int").repartition(3)
    got = dissolve_attributes(df, ["key"], {"first_v": "v"}, {"mean_a": "a"}).first()
    assert tuple(got) == ("k", None, 6.0)


def test_attribute_groups_hash(spark):
    df = spark.createDataFrame([("k", 1, 2, 5)], "key string, OBJECTID long, v int, a int")
    plan = dissolve_attributes(df, ["key"], {"f": "v"}, {"m": "a"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text
    assert text.count("Exchange") == 1 and "partial_min_by" in text


def test_number_is_dense_per_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 9), ("a", 2), ("b", 8)], "s string, v int")
    got = sorted(map(tuple, number(df, ["s"], ["v"]).collect()))
    assert got == [("a", 1, 1), ("a", 2, 2), ("a", 3, 3), ("b", 8, 1), ("b", 9, 2)]


def test_number_spreads_a_hot_group(spark, monkeypatch):
    """One group holds most rows; its numbers run on through all slices."""
    staged = {}
    kept = numbering.stage
    monkeypatch.setattr(
        numbering, "stage", lambda df, label: staged.setdefault(label, kept(df, label))
    )
    df = spark.range(30_000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.col("id").cast("string")).alias("s"),
        F.col("id").alias("v"),
    ).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = number(df, ["s"], ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = got.filter("s = 'hot'").agg(
        F.count("*"), F.count_distinct("ID"), F.min("ID"), F.max("ID")
    ).first()
    assert tuple(hot) == (24_000, 24_000, 1, 24_000)
    assert got.filter("s <> 'hot' and ID <> 1").count() == 0
    slices = staged["sorted"].groupBy(F.shiftright("_at", 33)).count().collect()
    assert len(slices) >= 4 and max(r["count"] for r in slices) < 15_000


def test_number_without_groups_and_with_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "s string, v int")
    assert sorted(r["ID"] for r in number(df, [], ["s", "v"]).collect()) == [1, 2, 3]
    assert sorted((r["s"] or "", r["ID"]) for r in number(df, ["s"], ["v"]).collect()) == [
        ("", 1), ("", 2), ("a", 1)]


def test_number_reads_its_input_once_and_sorts_narrow_rows(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    wide = spark.range(5000).selectExpr("id", "id % 3 as g", "repeat('x', 100) as body").mapInArrow(
        counted, "id long, g long, body string")
    got = number(wide, ["g"], ["id"], "place")
    assert got.count() == 5000 and seen.value == 5000
    assert got.columns == ["id", "g", "body", "place"]


def test_number_by_expressions_writes_no_column_for_them(spark, monkeypatch):
    staged = {}
    kept = numbering.stage
    monkeypatch.setattr(numbering, "stage", lambda df, label: staged.setdefault(f"{label}{len(staged)}", kept(df, label)))
    df = spark.range(50).selectExpr("id % 2 as g", "array(-id, 0) as path", "-id as only")
    for order, drop, left in (([F.col("path")[0]], (), ["g", "path", "only"]), (["only"], ("only",), ["g", "path"])):
        got = number(df, ["g"], order, "place", drop=drop)
        table = [t for label, t in staged.items() if label.startswith("sorted")][-1]
        assert table.columns == [*left, "_at"] and got.columns == [*left, "place"]
        assert all(r["place"] == 25 + r["path"][0] // -2 * -1 for r in got.filter("g = 0").collect())
