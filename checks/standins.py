"""Inputs for the operators, derived from the given tables by Spark.

The given tables hold no readings and no roads, so each is read as one: events are
readings, line items and orders are road segments between numbered vertices.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fumeline.functions.columns import line_length
from fumeline.operators.numbering import number
from fumeline.session import stage_root
from fumeline.sources.features import list_sources
from fumeline.sources.readings import AREA, DAY, READING, read_readings

_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings_file(spark: SparkSession, sf_dir: str) -> str:
    """Write the events as daily readings in gzip-compressed text; returns the folder.

    Every seventh reading is missing, told by one text or another.
    """
    slot = (spark.sparkContext.applicationId, sf_dir, "readings")
    if slot not in _written:
        path = f"{stage_root(spark)}/readings-{uuid.uuid4().hex}.txt.gz"
        event = F.col("event_id")
        table(spark, sf_dir, "events").select(
            F.lpad(F.col("user_id").cast("string"), 12, "0").alias(AREA),
            F.col("ts").cast("date").cast("string").alias(DAY),
            F.when(event % 14 == 0, "NA").when(event % 7 == 0, "")
            .otherwise(F.col("value").cast("string")).alias(READING),
        ).write.option("header", True).option("compression", "gzip").csv(path)
        _written[slot] = path
    return _written[slot]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_readings(spark, readings_file(spark, sf_dir), columns=[AREA, DAY, READING])


def segment_columns(rows: DataFrame) -> DataFrame:
    """Line items as road segments of 2020, each from vertex n1 to vertex n2."""
    supplier = F.col("l_suppkey") % 25
    n1, n2 = (F.col("l_partkey") % 40).cast("double"), (F.col("l_orderkey") % 40).cast("double")
    ends = F.array(*[F.struct(n.alias("x"), (n * n).alias("y")) for n in (n1, n2)])
    carried = [c for c in ("OBJECTID",) if c in rows.columns]
    return rows.select(
        *carried,
        (F.col("l_orderkey") % 5).cast("int").alias("State_Code"),
        F.col("l_linenumber").alias("F_SYSTEM"),
        F.when(supplier == 0, 99999).when(supplier != 1, supplier.cast("int")).alias("URBAN_CODE"),
        F.col("l_suppkey").cast("string").alias("Route_ID"),
        F.col("l_quantity").cast("int").alias("AADT"),
        F.array(ends).alias("paths"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of 2020 straight from the table, for operators that need no row order."""
    rows = segment_columns(table(spark, sf_dir, "lineitem"))
    a, b = F.col("paths")[0][0], F.col("paths")[0][1]
    return rows.withColumn("Shape_Length", F.hypot(b["x"] - a["x"], b["y"] - a["y"]))


def text_segments(df: DataFrame) -> DataFrame:
    """Segments of 2020 as segments of 2023: other names, all text, both layouts' columns."""
    named = F.col("State_Code") < 3
    cls, urban = F.col("F_SYSTEM").cast("string"), F.col("URBAN_CODE").cast("string")
    carried = [c for c in ("OBJECTID", "feature_class") if c in df.columns]
    return df.select(
        *carried,
        F.col("State_Code").cast("string").alias("StateID"),
        F.when(named, cls).alias("F_SYSTEM"), F.when(named, urban).alias("URBAN_ID"),
        F.when(~named, cls).alias("Field6"), F.when(~named, urban).alias("Field8"),
        F.col("Route_ID").alias("RouteID"), F.col("AADT").cast("string").alias("AADT"),
        "paths", "Shape_Length",
    )


def feature_classes(spark: SparkSession, sf_dir: str, year: int) -> str:
    """Write the segments as one feature class per state; returns the workspace folder.

    Written once per session and table folder, as the road job's input on disk.
    """
    slot = (spark.sparkContext.applicationId, sf_dir, str(year))
    if slot in _written:
        return _written[slot]
    root = f"{stage_root(spark)}/workspace-{year}-{uuid.uuid4().hex}"
    if year == 2020:
        order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                 "l_extendedprice"]
        lines = table(spark, sf_dir, "lineitem").select(*order)
        numbered = number(lines, [], order, "OBJECTID", staged=True, drop=("l_extendedprice",))
        rows = segment_columns(numbered).withColumn(
            "Shape_Length", line_length("paths")
        )
        # A class at a time: writing all at once would sort whole segments by class.
        state = (F.col("l_orderkey") % 5).cast("int").alias("state")
        for own, in lines.select(state).distinct().filter("state is not null").orderBy("state").collect():
            rows.filter(F.col("State_Code") == own).write.parquet(f"{root}/feature_class=state{own}_2020")
    else:
        for at, name in list_sources(spark, feature_classes(spark, sf_dir, 2020), "*_2020"):
            other = ("F_SYSTEM", "URBAN_ID") if name in ("state3_2020", "state4_2020") else ("Field6", "Field8")
            text_segments(spark.read.parquet(at)).drop(*other).write.parquet(
                f"{root}/feature_class={name.replace('_2020', '_2023')}")
    _written[slot] = root
    return root


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as long lines: the n-th order of a priority is the edge n to n+1.

    Every 97th key gives an edge of no length, which cuts the line there.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey")
    n = F.col("n").cast("double")
    end = n + F.when(F.col("o_orderkey") % 97 == 0, 0).otherwise(1)
    points = [F.struct(x.alias("x"), F.lit(0.0).alias("y")) for x in (n, end)]
    return number(orders, ["o_orderpriority"], ["o_orderkey"], "n", staged=True).select(
        F.col("o_orderpriority").alias("k"), F.array(F.array(*points)).alias("paths")
    )


def nested_classes(spark: SparkSession, sf_dir: str) -> str:
    """The segments of 2020 in two dataset folders, with dots in names, equal names, and mixed columns.

    Traffic is an int, a double or a long by state; one state has no length, one a null one.
    """
    slot = (spark.sparkContext.applicationId, sf_dir, "nested")
    if slot not in _written:
        root = f"{stage_root(spark)}/workspace-nested-{uuid.uuid4().hex}"
        rows = spark.read.parquet(feature_classes(spark, sf_dir, 2020)).drop("feature_class")
        for state in range(5):
            own = rows.filter(F.col("State_Code") == state)
            own = own.withColumn("AADT", F.col("AADT").cast(("int", "double", "long")[state % 3]))
            if state == 3:
                own = own.drop("Shape_Length")
            elif state == 4:
                own = own.withColumn("Shape_Length", F.lit(None).cast("double"))
            own.write.parquet(f"{root}/d{state % 2}/St.{state // 2}_2020")
        _written[slot] = root
    return _written[slot]


def spoiled_segments(rows: DataFrame) -> DataFrame:
    """Segments of 2023 of which some have texts that are no numbers, no route, or spaces to trim."""
    n = F.col("OBJECTID")
    return rows.withColumns({
        "AADT": F.when(n % 11 == 0, F.concat("AADT", F.lit("x"))).when(n % 7 == 0, F.concat(F.lit(" "), "AADT"))
        .otherwise(F.col("AADT")),
        "RouteID": F.when(n % 13 != 0, F.col("RouteID")),
        "StateID": F.when(n % 17 == 0, "CA").when(n % 5 == 0, F.concat("StateID", F.lit(" "))).otherwise(F.col("StateID")),
        "URBAN_ID": F.when(n % 19 == 0, "5y").otherwise(F.col("URBAN_ID")),
    })


def order_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as features of two paths with a vertex halfway, every other one drawn backwards.

    Orders whose key is a multiple of 97 have no length, which cuts the line there.
    """
    line = F.col("paths")[0]
    a, b = line[0]["x"], line[1]["x"]

    def path(*xs):
        return F.array(*[F.struct(x.alias("x"), F.lit(0.0).alias("y")) for x in xs])

    middle = (a + b) / 2
    forward = F.array(path(a, middle), path(middle, b))
    backward = F.array(path(b, middle, a), path(a, a))
    return order_lines(spark, sf_dir).withColumn("paths", F.when(a % 2 == 0, forward).otherwise(backward))


def order_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as straight lines that lie on seven supporting lines per priority and overlap there.

    Line j starts at (10000 j, 0) and has its own direction; every third order is drawn backwards.
    """
    key = F.col("o_orderkey")
    steps = [F.array(*[F.lit(float(d)) for d in way]) for way in ((1, 0, 1, 2, 1, 3, 1), (0, 1, 1, -1, 2, 1, -3))]
    j = (key % 7).cast("int")
    from_ = F.col("o_custkey") % 500

    def at(place):
        return F.struct((j * 10000 + place * steps[0][j]).cast("double").alias("x"),
                        (place * steps[1][j]).cast("double").alias("y"))

    ends = [at(from_), at(from_ + 1 + key % 5)]
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("k"),
        F.array(F.when(key % 3 == 0, F.array(*ends[::-1])).otherwise(F.array(*ends))).alias("paths"))


def order_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines whose ends miss each other by up to 0.01: the n-th of a priority runs from about n to n + 1.

    Those whose key is a multiple of 97 are left out.
    """
    key = F.col("o_orderkey")
    orders = number(table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey"), ["o_orderpriority"], ["o_orderkey"], "n",
                    staged=True)
    n = F.col("n").cast("double")
    ends = [n + (key % 5 - 2).cast("double") * 0.002, n + 1 + (key % 7 - 3).cast("double") * 0.002]
    points = [F.struct(x.alias("x"), F.lit(0.0).alias("y")) for x in ends]
    return orders.filter(key % 97 != 0).select(F.col("o_orderpriority").alias("k"), F.array(F.array(*points)).alias("paths"))
