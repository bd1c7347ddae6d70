"""Entry points: the flagship query, every registered query, and each one's SQL."""

from __future__ import annotations

import importlib.util
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The entry file may be loaded from anywhere.
sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import standins  # noqa: E402
from checks.oracles import oracles  # noqa: E402
from fumeline.functions.columns import line_length, parse_codes, route_key  # noqa: E402
from fumeline.functions.predicates import major_roads, major_roads_text, with_traffic  # noqa: E402
from fumeline.operators.clustering import snap  # noqa: E402
from fumeline.operators.lines import chain_vertices, chains, distinct_edges, single_part  # noqa: E402
from fumeline.operators.numbering import number  # noqa: E402
from fumeline.operators.stats import describe, dissolve_attributes, distinct_count  # noqa: E402
from fumeline.plans.air import air, area_means  # noqa: E402
from fumeline.plans.roads import FIRST, KEYS, MEAN, dissolve, export_labelled, kept_2020, kept_2023, roads  # noqa: E402
from fumeline.session import stage_root  # noqa: E402
from fumeline.sinks.features import feature_documents, feature_json, labelled, write_json, write_tables  # noqa: E402
from fumeline.sources.features import (  # noqa: E402
    layout_of, list_sources, read_features, read_layouts, read_matching, source_value,
)

# The operators of training-data pipelines stand by themselves and may be left out.
llm = None
if importlib.util.find_spec("fumeline.llm") and importlib.util.find_spec("corpus_pipeline"):
    from fumeline.llm import queries as llm  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def _path_text(path: Column) -> Column:
    points = F.transform(
        path, lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))
    )
    return F.array_join(points, ",")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _drawn(df: DataFrame) -> DataFrame:
    """Geometry as text, to be compared as a value."""
    return df.withColumn("path", _path_text(F.col("paths")[0])).drop("paths")


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_matching(spark, standins.feature_classes(spark, sf_dir, 2020), "*_2020")


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_2020(_features(spark, sf_dir))


def _layout(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    """The 2023 feature classes of one layout."""
    root = standins.feature_classes(spark, sf_dir, 2023)
    found = [at for at, _ in list_sources(spark, root, "*_2023")]
    return read_features(spark, [at for at in found if layout_of(spark.read.parquet(at).columns) == layout])


def _segments_2023(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_layouts(spark, standins.feature_classes(spark, sf_dir, 2023), "*_2023")


_SEGMENT = ["State_Code", "F_SYSTEM", "URBAN_CODE", "Route_ID", "AADT", "path"]


def road_scan(spark, sf_dir):
    return _rounded(_drawn(_features(spark, sf_dir)), "Shape_Length")


def road_sources(spark, sf_dir):
    return _features(spark, sf_dir).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.min("OBJECTID").alias("first_id")
    )


def road_filter_2020(spark, sf_dir):
    return _drawn(major_roads(standins.segments(spark, sf_dir))).select(*_SEGMENT)


def road_positive(spark, sf_dir):
    return _drawn(with_traffic(major_roads(standins.segments(spark, sf_dir)))).select(*_SEGMENT)


def road_length(spark, sf_dir):
    rows = standins.segments(spark, sf_dir).withColumn("length", F.round(line_length("paths"), 6))
    return _drawn(rows).select("State_Code", "Route_ID", "path", "length")


def road_key_2020(spark, sf_dir):
    rows = route_key(standins.segments(spark, sf_dir), "Route_ID", "AADT", null_route="None")
    return rows.select("State_Code", "Route_ID", "AADT", "key")


def road_key_strict(spark, sf_dir):
    kept = kept_2020(_features(spark, sf_dir), strict_key=True)
    return kept.groupBy("source", "key").agg(F.count(F.lit(1)).alias("n"))


def road_filter_2023(spark, sf_dir):
    rows = major_roads_text(_layout(spark, sf_dir, "named"))
    return rows.select("source", "OBJECTID", "F_SYSTEM", "URBAN_ID", "RouteID", "AADT")


def road_filter_2023_pos(spark, sf_dir):
    rows = major_roads_text(_layout(spark, sf_dir, "positional"), "Field6", "Field8")
    return rows.select("source", "OBJECTID", "Field6", "Field8", "RouteID", "AADT")


def road_casts(spark, sf_dir):
    casts = {"aadt_num": ("AADT", "int"), "class_num": ("F_SYSTEM", "short"),
             "urban_code": ("URBAN_ID", "int")}
    good, _ = parse_codes(_segments_2023(spark, sf_dir), casts)
    return good.select(
        "source", "OBJECTID", "aadt_num", F.col("class_num").alias("f_system"), "urban_code"
    )


def road_key_2023(spark, sf_dir):
    return route_key(_segments_2023(spark, sf_dir), "RouteID", "AADT").select(
        "source", "OBJECTID", "key"
    )


def road_layouts(spark, sf_dir):
    return _segments_2023(spark, sf_dir).select(
        "source", "OBJECTID", "StateID", "F_SYSTEM", "URBAN_ID", "RouteID", "AADT"
    )


def road_dissolve_attrs(spark, sf_dir):
    return _rounded(dissolve_attributes(_kept(spark, sf_dir), KEYS, FIRST, MEAN), "mean_aadt")


def road_ids(spark, sf_dir):
    groups = dissolve_attributes(_kept(spark, sf_dir), KEYS, FIRST, MEAN)
    return number(groups.select(*KEYS), ["source"], ["key"])


def road_union_edges(spark, sf_dir):
    return distinct_edges(_kept(spark, sf_dir), KEYS)


def road_chains(spark, sf_dir):
    return chains(_kept(spark, sf_dir), KEYS).withColumn("path", _path_text(F.col("path")))


def road_singlepart(spark, sf_dir):
    kept = _kept(spark, sf_dir)
    groups = dissolve_attributes(kept, KEYS, FIRST, MEAN)
    parts = single_part(kept, groups, KEYS).drop("ring")
    return _rounded(parts.withColumn("path", _path_text(F.col("path"))), "mean_aadt")


def road_chains_long(spark, sf_dir):
    vertices = chain_vertices(standins.order_lines(spark, sf_dir), ["k"])
    return vertices.groupBy("k", "chain", "ring").agg(
        F.min("x").alias("from_x"), F.max("x").alias("to_x"),
        F.max("place").cast("int").alias("edges"), F.count(F.lit(1)).alias("vertices"),
    ).drop("chain")


def road_chains_paths(spark, sf_dir):
    vertices = chain_vertices(standins.order_paths(spark, sf_dir), ["k"])
    x, at = F.col("x") * 2, F.col("place")
    return vertices.groupBy("k", "chain", "ring").agg(
        F.min("x").alias("from_x"), F.max("x").alias("to_x"), F.max("place").cast("int").alias("edges"),
        F.count(F.lit(1)).alias("vertices"),
        # One if the places run along the line, vertex by vertex.
        F.least(F.count_distinct(x + at), F.count_distinct(x - at)).alias("steps"),
    ).drop("chain")


def road_overlap_edges(spark, sf_dir):
    return distinct_edges(standins.order_overlaps(spark, sf_dir), ["k"])


def road_overlaps(spark, sf_dir):
    path = F.col("path")
    ends = {f"{n}{c}": F.element_at(path, at)[c] for n, at in (("a", 1), ("b", -1)) for c in "xy"}
    return chains(standins.order_overlaps(spark, sf_dir), ["k"]).select(
        "k", *[c.alias(n) for n, c in ends.items()], (F.size(path) - 1).alias("edges"))


def road_tolerance(spark, sf_dir):
    path = F.col("path")
    joined = chains(snap(standins.order_gaps(spark, sf_dir), 0.05), ["k"])
    return _rounded(joined.select("k", F.element_at(path, 1)["x"].alias("from_x"), F.element_at(path, -1)["x"].alias("to_x"),
                                  (F.size(path) - 1).alias("edges")), "from_x", "to_x")


def road_rejects(spark, sf_dir):
    return kept_2023(standins.spoiled_segments(_segments_2023(spark, sf_dir)))[1].select("source", "OBJECTID")


def road_sources_nested(spark, sf_dir):
    rows = read_matching(spark, standins.nested_classes(spark, sf_dir), "*_2020", recursive=True)
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("OBJECTID").alias("first_id"))


def road_mixed_types(spark, sf_dir):
    rows = read_matching(spark, standins.nested_classes(spark, sf_dir), "*_2020", recursive=True)
    return kept_2020(rows).select("source", "OBJECTID", "key", "aadt")


def road_documents(spark, sf_dir):
    return feature_documents(_exported(spark, sf_dir), wkid=4269)


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir)
    return labelled(export_labelled(dissolve(kept_2020(rows)), source_value(rows, "State_Code")))


def _written(spark: SparkSession, write) -> str:
    out = f"{stage_root(spark)}/out-{uuid.uuid4().hex}"
    write(out)
    return out


def _file_name() -> Column:
    return F.url_decode(F.substring_index(F.col("_metadata.file_path"), "/", -1))


def _document_pieces(spark: SparkSession, at: str) -> DataFrame:
    """The written documents' lines, one row per file and slice of it: no task holds a document."""
    line, row = F.col("value"), F.col("row")
    attributes = "struct<state_code:double,urban_code:double,f_system:string,aadt:double,ID:int>"
    opens, closes = line.startswith('{"geometryType"'), line == "]}"
    comma, strict = line.startswith(","), {"mode": "FAILFAST"}
    lines = spark.read.text(at).select(
        _file_name().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value")
    read = lines.select(
        "file", "block", "row", opens.alias("opens"), closes.alias("closes"), (~opens & ~closes & ~comma).alias("bare"),
        F.from_json(F.when(opens, F.concat(line, F.lit("]}"))), "geometryType string, features array<string>", strict)["geometryType"].alias("kind"),
        F.from_json(F.when(~opens & ~closes, F.when(comma, F.substring(line, 2, 1 << 30)).otherwise(line)),
                    f"attributes {attributes}", strict)["attributes"].alias("a"))
    place = F.col("a.ID") - row  # one number if the features follow one another
    return read.groupBy("file", "block").agg(
        F.count("a").alias("features"), F.count("a.ID").alias("numbered"), F.sum("a.aadt").alias("aadt"), F.max("kind").alias("kind"),
        F.min("a.ID").alias("low"), F.max("a.ID").alias("high"), (F.min(place) == F.max(place)).alias("steady"),
        F.count_if("opens").alias("opened"), F.count_if("closes").alias("closed"), F.count_if("bare").alias("bare"),
        F.min(F.when(F.col("bare"), F.col("a.ID"))).alias("first"),
        F.coalesce(F.min(F.when(F.col("opens"), row)) == F.min("row"), F.lit(True)).alias("begins"),
        F.coalesce(F.max(F.when(F.col("closes"), row)) == F.max("row"), F.lit(True)).alias("ends"))


def _documents(spark: SparkSession, at: str) -> DataFrame:
    """One row per value: its features, whether they are whole and in order, and their traffic."""
    # Slices of a document, a few rows each; a value's further documents count with its first.
    in_file = Window.partitionBy("file").orderBy("block")
    last = F.max("high").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    slices = _document_pieces(spark, at).withColumn("before", last).withColumn(
        "fits", F.coalesce(F.col("low") == F.col("before") + 1, F.lit(True)) & F.coalesce("steady", F.lit(True)) & F.col("begins") & F.col("ends"))
    files = slices.groupBy("file").agg(
        F.sum("features").alias("features"), F.sum("numbered").alias("numbered"), F.sum("aadt").alias("aadt"), F.max("kind").alias("kind"),
        F.min("low").alias("low"), F.max("high").alias("high"), (F.bool_and("fits") & (F.sum("opened") == 1) & (F.sum("closed") == 1)
         & (F.sum("bare") == 1) & (F.min("first") == F.min("low"))
         & (F.min_by("opened", "block") == 1) & (F.max_by("closed", "block") == 1)).alias("whole"))
    part = F.regexp_extract("file", r"^HPMS2020_[^_]*_(\d+)\.json$", 1)  # none in a value's first
    documents = files.withColumns({
        "name": F.regexp_replace("file", r"^(HPMS2020_[^_]*)_\d+\.json$", "$1.json"),
        "part": F.coalesce(part.try_cast("int"), F.lit(1))})
    follows = F.max("high").over(Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return documents.withColumn("follows", F.col("low") == F.coalesce(follows, F.lit(0)) + 1).groupBy("name").agg(
        F.sum("features").cast("int").alias("features"), F.max("kind").alias("kind"),
        # In order, and none missing.
        (F.bool_and(F.col("whole") & F.col("follows")) & (F.sum("numbered") == F.max("high")) & (F.sum("features") == F.max("high"))).alias("in_order"),
        F.round(F.sum("aadt"), 3).alias("aadt"))


def road_json_files(spark, sf_dir):
    return _documents(spark, _written(spark, lambda at: write_json(_exported(spark, sf_dir), at, 2020, wkid=4269)))


def road_tables(spark, sf_dir):
    lines = _unlabelled(spark, sf_dir)
    out = _written(spark, lambda at: write_tables(lines.filter("value is null or value < '1'"), at, 2020))
    refused = 0
    write_tables(lines.filter("value > '0' or value = ''"), out, 2020)  # other values, beside the first
    try:
        write_tables(lines, out, 2020)
    except FileExistsError:
        refused = 1
    rows = read_matching(spark, out, "HPMS2020_*_forJSON")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("ID").alias("last")).withColumn("refused", F.lit(refused))


def _unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported lines, those of state 3 with an empty label and those of state 4 without one."""
    rows = _features(spark, sf_dir)
    labels = source_value(rows, "State_Code").withColumn(
        "value", F.when(F.col("value") == "3", "").when(F.col("value") != "4", F.col("value")))
    return export_labelled(dissolve(kept_2020(rows)), labels)


def road_unlabelled(spark, sf_dir):
    return labelled(_unlabelled(spark, sf_dir)).groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.max("ID").alias("last"))


def road_export(spark, sf_dir):
    return _rounded(_drawn(_exported(spark, sf_dir)), "aadt")


def road_features_json(spark, sf_dir):
    return _exported(spark, sf_dir).select("value", feature_json().alias("feature"))


def _roads(year: int, value_field: str) -> Query:
    def run(spark, sf_dir):
        root = standins.feature_classes(spark, sf_dir, year)
        return _rounded(_drawn(roads(spark, root, year, value_field)), "aadt")
    return run


def _summary(describe_means) -> Query:
    return lambda spark, sf_dir: _rounded(
        describe_means(standins.readings(spark, sf_dir)), "value"
    )


def entry(spark: SparkSession) -> DataFrame:
    """The whole 2020 road job on the smallest tables."""
    return queries()["roads_2020"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per operator or job; each takes (spark, table folder)."""
    return {
        "pm_scan": standins.readings,
        "pm_distinct_days": lambda s, d: distinct_count(standins.readings(s, d), "Date"),
        "pm_group_mean": lambda s, d: _rounded(area_means(standins.readings(s, d)), "pm25"),
        "pm_describe": _summary(lambda r: describe(area_means(r), "pm25")),
        "pm_describe_ranked": _summary(lambda r: describe(area_means(r), "pm25")),
        "air_summary": _summary(air),
        "road_scan": road_scan,
        "road_sources": road_sources,
        "source_value": lambda s, d: source_value(_features(s, d), "State_Code"),
        "road_layouts": road_layouts,
        "road_filter_2020": road_filter_2020,
        "road_filter_2023": road_filter_2023,
        "road_filter_2023_pos": road_filter_2023_pos,
        "road_positive": road_positive,
        "road_length": road_length,
        "road_key_2020": road_key_2020,
        "road_key_2023": road_key_2023,
        "road_key_strict": road_key_strict,
        "road_casts": road_casts,
        "road_dissolve_attrs": road_dissolve_attrs,
        "road_union_edges": road_union_edges,
        "road_chains": road_chains,
        "road_chains_long": road_chains_long,
        "road_chains_paths": road_chains_paths,
        "road_overlap_edges": road_overlap_edges,
        "road_overlaps": road_overlaps,
        "road_tolerance": road_tolerance,
        "road_rejects": road_rejects,
        "road_sources_nested": road_sources_nested,
        "road_mixed_types": road_mixed_types,
        "road_documents": road_documents,
        "road_singlepart": road_singlepart,
        "road_ids": road_ids,
        "road_export": road_export,
        "road_features_json": road_features_json,
        "road_json_files": road_json_files,
        "road_tables": road_tables,
        "road_unlabelled": road_unlabelled,
        "roads_2020": _roads(2020, "State_Code"),
        "roads_2023": _roads(2023, "StateID"),
        **(llm.queries() if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {**oracles(), **(llm.oracle_sql() if llm else {})}
