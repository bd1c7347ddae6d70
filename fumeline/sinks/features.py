"""Export of dissolved lines: field mapping, feature tables, JSON documents (K1-K5)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fumeline.session import stage, unstage

# The exported fields with their JSON field types, the longest text
# kept, and the names given to the outputs of a year and value.
FIELDS = {
    "state_code": "esriFieldTypeDouble",
    "urban_code": "esriFieldTypeDouble",
    "f_system": "esriFieldTypeString",
    "aadt": "esriFieldTypeDouble",
    "ID": "esriFieldTypeInteger",
}
TEXT_LENGTH = 255
TABLE_NAME, JSON_NAME = "HPMS{year}_{value}_forJSON", "HPMS{year}_{value}.json"

DOCUMENT_FEATURES = 10_000_000  # that a JSON document holds at most


def export(df: DataFrame, wide_ids: bool = False) -> DataFrame:
    """Map dissolved lines to the exported fields plus geometry and ``value`` (K1).

    ``ID`` is a 32-bit number; a source with more lines fails here rather than wrap
    around, unless ``wide_ids`` asks for 64 bits.
    """
    return df.select(
        F.col("first_state_code").cast("double").alias("state_code"),
        F.col("first_urban_code").cast("double").alias("urban_code"),
        F.substring(F.col("first_f_system").cast("string"), 1, TEXT_LENGTH).alias("f_system"),
        F.col("mean_aadt").cast("double").alias("aadt"),
        F.col("ID").cast("long" if wide_ids else "int").alias("ID"),
        F.array("path").alias("paths"),
        "value",
    )


def labelled(df: DataFrame) -> DataFrame:
    """Only lines whose source has a value to name the output by (K5)."""
    return df.filter("value is not null and value <> ''")


def _name(form: str, year: int) -> Column:
    before, after = form.format(year=year, value="\0").split("\0")
    # Never null, so that writing keeps the rows' order within each name.
    return F.coalesce(F.concat(F.lit(before), F.col("value"), F.lit(after)), F.lit(""))


def _refuse_shared(rows: DataFrame) -> list[str]:
    """The values of labelled lines, refusing one that two sources share. One short row per value comes to the driver."""
    values = rows.groupBy("value").agg(F.count_if(F.col("ID") == 1).alias("sources")).collect()
    for r in values:
        if r["sources"] > 1:
            raise ValueError(f"two sources share the value {r['value']!r}")
    return [r["value"] for r in values]


def _files(spark: SparkSession, at: str):
    """The file system of a path, and a function that makes paths."""
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return to_path(at).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to_path


def _escaped(spark: SparkSession, name: str) -> str:
    """A name as Spark spells it in folders."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)


def _refuse_existing(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        files, to_path = _files(spark, path)
        if files.exists(to_path(path)):
            raise FileExistsError(path)


def write_tables(df: DataFrame, out: str, year: int) -> None:
    """One feature table per value, beside those of other values, overwriting none (K2, K4, K5)."""
    rows, spark = labelled(df), df.sparkSession
    names = [_escaped(spark, TABLE_NAME.format(year=year, value=v)) for v in _refuse_shared(rows)]
    _refuse_existing(spark, [f"{out.rstrip('/')}/name={n}" for n in names])
    rows.withColumn("name", _name(TABLE_NAME, year)).drop("value").write.mode("append").partitionBy("name").parquet(out)


def feature_json(paths: str = "paths") -> Column:
    """One line as a JSON feature: null attributes kept, coordinates as they came."""
    points = F.transform(F.col(paths), lambda path: F.transform(
        path, lambda p: F.array(p["x"], p["y"])))
    return F.to_json(
        F.struct(F.struct(*FIELDS).alias("attributes"),
                 F.struct(points.alias("paths")).alias("geometry")),
        {"ignoreNullFields": "false"},
    )


def _opening(wkid: int | None, wide_ids: bool) -> str:
    kinds = {**FIELDS, "ID": "esriFieldTypeBigInteger"} if wide_ids else FIELDS
    fields = [
        {"name": n, "type": t, "alias": n}
        | ({"length": TEXT_LENGTH} if t == "esriFieldTypeString" else {})
        for n, t in kinds.items()
    ]
    head = {
        "geometryType": "esriGeometryPolyline",
        "spatialReference": {"wkid": wkid} if wkid else {},
        "fields": fields,
    }
    return json.dumps(head, separators=(",", ":"))[:-1] + ',"features":['


def _document_lines(rows: DataFrame, wkid: int | None, most: int | None) -> DataFrame:
    """(value, part, place, line) of labelled lines: a part is a whole document of up to ``most`` features."""
    wide = dict(rows.dtypes)["ID"] == "bigint"
    place = F.col("ID").cast("long")
    part = F.floor((place - 1) / F.lit(most)) if most else F.lit(0).cast("long")
    first = (place - 1) % most == 0 if most else place == 1
    numbered = rows.withColumns({"part": part, "place": place})
    features = numbered.select("value", "part", "place", F.concat(
        F.when(first, F.lit("")).otherwise(F.lit(",")), feature_json()).alias("line"))
    edges = numbered.groupBy("value", "part").agg(F.min("place").alias("low"), F.max("place").alias("high")).select(
        "value", "part", F.inline(F.array(
            F.struct((F.col("low") - 1).alias("place"), F.lit(_opening(wkid, wide)).alias("line")),
            F.struct((F.col("high") + 1).alias("place"), F.lit("]}").alias("line")),
        )))
    return features.unionByName(edges)


def feature_documents(df: DataFrame, wkid: int | None = None) -> DataFrame:
    """The lines of each value's JSON document as (value, place, line) rows (K3).

    Place 0 opens the document, places 1..n are its features, the last closes it.
    IDs must run 1..n within each value.
    """
    return _document_lines(labelled(df), wkid, None).drop("part")


def write_json(df: DataFrame, out: str, year: int, wkid: int | None = None, most: int | None = DOCUMENT_FEATURES) -> None:
    """One JSON file per value in ``out``, overwriting none (K3-K5).

    A document is one text, so one task writes it, streaming its sorted lines; features are made
    into text before, by all tasks. A value of more than ``most`` features becomes several documents,
    each whole and named by its number after the first, so that no task writes more than that.
    Files are written aside and moved when all are there: a run that fails leaves nothing.
    """
    spark, out = df.sparkSession, out.rstrip("/")
    rows = stage(labelled(df), "exported")
    _refuse_existing(spark, [f"{out}/{_escaped(spark, JSON_NAME.format(year=year, value=v))}" for v in _refuse_shared(rows)])
    own = F.when(F.col("part") == 0, F.col("value")).otherwise(F.concat_ws("_", "value", F.col("part") + 1))
    lines = _document_lines(rows, wkid, most).withColumn("value", own).withColumn("name", _name(JSON_NAME, year))
    aside = f"{out}/_writing-{uuid.uuid4().hex}"
    files, to_path = _files(spark, aside)
    try:
        lines.repartition("name").sortWithinPartitions("name", "place").select("line", "name").write.partitionBy("name").text(aside)
        _publish(files, to_path, aside, out)
    finally:
        files.delete(to_path(aside), True)
        unstage(rows)


def _publish(files, to_path, aside: str, out: str) -> None:
    """Move each folder's only file to the folder's name in ``out``; all of them, or none."""
    moves = []
    for folder in files.listStatus(to_path(aside)):
        name = folder.getPath().getName()
        if name.startswith("name="):
            parts = [f.getPath() for f in files.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            if len(parts) != 1:
                raise RuntimeError(f"{len(parts)} files for {name}")
            moves.append((parts[0], to_path(f"{out}/{name.removeprefix('name=')}")))
    done = []
    try:
        for part, target in moves:
            if files.exists(target):
                raise FileExistsError(target.toString())
            if not files.rename(part, target):
                raise OSError(f"could not move {part.toString()} to {target.toString()}")
            done.append(target)
    except BaseException:
        for target in done:
            files.delete(target, False)
        raise
