"""Road job: segments of all states to numbered single-part lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fumeline.functions.columns import parse_codes, route_key, with_length
from fumeline.functions.predicates import major_roads, major_roads_text, with_traffic
from fumeline.operators.clustering import snap
from fumeline.operators.lines import chain_vertices, single_part
from fumeline.operators.numbering import number
from fumeline.operators.stats import dissolve_attributes
from fumeline.sinks.features import export, labelled
from fumeline.sources.features import (
    read_layouts, read_matching, source_value, with_source_value,
)

KEYS = ["source", "key"]
FIRST = {"first_state_code": "state_code", "first_urban_code": "urban_code",
         "first_f_system": "f_system"}
MEAN = {"mean_aadt": "aadt"}
KEPT = ["source", "OBJECTID", "key", "state_code", "urban_code", "f_system", "aadt", "paths"]


def kept_2020(df: DataFrame, strict_key: bool = False) -> DataFrame:
    """Major segments with traffic and their dissolve key, numeric columns."""
    rows = route_key(
        with_traffic(major_roads(with_length(df))), "Route_ID", "AADT", null_route="None", strict=strict_key
    )
    names = {"State_Code": "state_code", "URBAN_CODE": "urban_code", "F_SYSTEM": "f_system",
             "AADT": "aadt"}
    return rows.withColumnsRenamed(names).select(*KEPT)


def kept_2023(df: DataFrame, strict_key: bool = False) -> tuple[DataFrame, DataFrame]:
    """The same from text columns (R2, R4-R7, R9-R12), and the rows that did not parse."""
    rows, no_count = parse_codes(
        major_roads_text(with_length(df)), {"aadt_num": ("AADT", "int")}, required=("aadt_num",)
    )
    rows = with_traffic(rows, "aadt_num")
    no_route = rows.filter("RouteID is null").drop("aadt_num")
    rows, no_code = parse_codes(
        rows.filter("RouteID is not null"),
        # A state number from here on: numeric FIRST values keep the group-by a hash aggregate.
        {"class_num": ("F_SYSTEM", "short"), "urban_num": ("URBAN_ID", "int"), "state_num": ("StateID", "double")},
    )
    rows = route_key(rows, "RouteID", "AADT", strict=strict_key)
    good = rows.select(
        "source", "OBJECTID", "key",
        F.col("state_num").alias("state_code"),
        F.col("urban_num").alias("urban_code"), F.col("class_num").alias("f_system"),
        F.col("aadt_num").alias("aadt"), "paths",
    )
    return good, no_count.unionByName(no_route).unionByName(no_code.drop("aadt_num"))


def dissolve(kept: DataFrame) -> DataFrame:
    """Numbered single-part lines with their groups' attributes."""
    lines = single_part(kept, dissolve_attributes(kept, KEYS, FIRST, MEAN), KEYS)
    # A line is told from the others of its group by its first step.
    start = [F.element_at("path", i)[c] for i in (1, 2) for c in "xy"]
    return number(lines, ["source"], ["key", *start])


def roads(
    spark: SparkSession, root: str, year: int, value_field: str, recursive: bool = False,
    strict_key: bool = False, wide_ids: bool = False, tolerance: float | None = None,
    fmt: str = "parquet", schema: str | None = None,
) -> DataFrame:
    """The whole job: every feature class ``*_<year>`` under ``root`` to exported lines.

    ``value_field`` names the column whose first value labels a source's output.
    ``wide_ids`` numbers lines in 64 bits, ``tolerance`` moves vertices that nearly meet together first,
    and ``fmt`` (with ``schema`` for 2020) reads features from another format.
    """
    if year == 2020:
        rows = read_matching(spark, root, f"*_{year}", recursive, fmt, schema)
        kept = kept_2020(rows, strict_key)
    else:
        rows = read_layouts(spark, root, f"*_{year}", recursive, fmt)
        kept, _ = kept_2023(rows, strict_key)
    if tolerance:
        kept = snap(kept, tolerance)
    return labelled(export_labelled(dissolve(kept), source_value(rows, value_field), wide_ids))


def road_vertices(
    spark: SparkSession, root: str, recursive: bool = False, strict_key: bool = False,
    tolerance: float | None = None,
) -> DataFrame:
    """The dissolved lines of 2020 as one row per vertex, for lines too long for a row."""
    kept = kept_2020(read_matching(spark, root, "*_2020", recursive), strict_key)
    return chain_vertices(snap(kept, tolerance) if tolerance else kept, KEYS)


def rejected(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    """The 2023 rows :func:`roads` leaves out because a text of theirs did not parse."""
    return kept_2023(read_layouts(spark, root, "*_2023", recursive))[1]


def export_labelled(lines: DataFrame, labels: DataFrame, wide_ids: bool = False) -> DataFrame:
    return export(with_source_value(lines, labels), wide_ids)
