"""Line-feature tables, one per source, and their column layouts."""

from __future__ import annotations

import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fumeline.session import stage

PATHS_TYPE = "array<array<struct<x:double,y:double>>>"

# The columns that mark the positional layout of 2023, and what
# each layout calls the road class and the urban code.
POSITIONAL_MARKS = ("Field6", "Field8")
LAYOUTS = {
    "named": {"F_SYSTEM": "F_SYSTEM", "URBAN_ID": "URBAN_ID"},
    "positional": {"Field6": "F_SYSTEM", "Field8": "URBAN_ID"},
}


def _location(spark: SparkSession, path: str) -> str:
    """A path as files report it: with its scheme, local ones as ``file:/``."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:/", system.makeQualified(at).toString()).rstrip("/")


def _plain(path: Column) -> Column:
    """A file's reported path without URL escapes."""
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def _name(component: str) -> str:
    """The feature class that a folder or file holds: ``CA_2020``, ``CA_2020.parquet``, ``name=CA_2020``."""
    return re.sub(r"\.(parquet|json)$", "", component.rpartition("=")[2])


def _globs(root: str, pattern: str, recursive: bool) -> str:
    """Feature classes named ``pattern``, also one dataset folder down if asked."""
    forms = [pattern, f"{pattern}.parquet", f"{pattern}.json", f"*={pattern}"]
    if recursive:
        forms += [f"*/{f}" for f in forms]
    return f"{root.rstrip('/')}/{{{','.join(forms)}}}"


def list_sources(
    spark: SparkSession, root: str, pattern: str, recursive: bool = False
) -> list[tuple[str, str]]:
    """(folder or file, name) of each feature class under ``root``.

    A feature class is the first folder or file below ``root`` whose name matches, whatever
    its own files are called. Names that several have get their dataset folder before them.
    Only file metadata is read, and one row per feature class comes back. Nothing that
    matches gives an empty list.
    """
    base = _location(spark, root)
    try:
        files = spark.read.format("binaryFile").load(_globs(root, pattern, recursive))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    path = F.regexp_replace("path", "^file:/+", "file:/")
    below = F.split(F.substring(path, len(base) + 2, 1 << 20), "/")
    rows = files.select(F.slice(below, 1, 2).alias("below")).distinct().collect()
    forms = [pattern, f"{pattern}.parquet", f"{pattern}.json", f"*={pattern}"]
    found = set()
    for r in rows:
        steps = [r["below"][0]]
        if recursive and not any(fnmatchcase(steps[0], f) for f in forms):
            steps = r["below"]
        found.add("/".join(steps))
    names = Counter(_name(f.rpartition("/")[2]) for f in found)
    out = []
    for f in found:
        folder, _, own = f.rpartition("/")
        name = _name(own)
        out.append((f"{base}/{f}", name if names[name] == 1 or not folder else f"{folder}/{name}"))
    return sorted(out, key=lambda s: (s[1], s[0]))


def _some_sources(spark: SparkSession, root: str, pattern: str, recursive: bool) -> list[tuple[str, str]]:
    found = list_sources(spark, root, pattern, recursive)
    if not found:
        raise FileNotFoundError(f"no feature class named {pattern!r} in {root}")
    return found


def _literal(path: str) -> str:
    """A path that a reader takes as it is, not as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_features(
    spark: SparkSession,
    at: str | list[str],
    fmt: str = "parquet",
    schema: str | None = None,
    names: list[str] | None = None,
) -> DataFrame:
    """One DataFrame over one or many feature tables, with a ``source`` column (S3).

    ``names`` are the tables' names where they are not their folders'. Tables whose
    columns differ in type are scanned apart, and each column gets a type that holds all:
    numbers a double, else text. Parquet tables of one schema and folder depth are one scan.
    """
    paths = [_location(spark, p) for p in ([at] if isinstance(at, str) else at)]
    called = dict(zip(paths, names)) if names else {p: _name(p.rpartition("/")[2]) for p in paths}

    def look(path: str) -> str:
        return schema or spark.read.format(fmt).load(_literal(path)).schema.json()

    with ThreadPoolExecutor(8) as pool:
        kinds = list(pool.map(look, paths))
    scans: dict[tuple, list[str]] = {}
    for path, kind in zip(paths, kinds):
        scans.setdefault((kind, path.count("/")), []).append(path)
    tables = []
    for (_, depth), group in scans.items():
        reader = spark.read.format(fmt)
        rows = (reader.schema(schema) if schema else reader).load([_literal(p) for p in group])
        own = F.substring_index(_plain(F.col("_metadata.file_path")), "/", depth + 1)
        if all(called[p] == p.rpartition("/")[2] for p in group):
            source = F.substring_index(own, "/", -1)  # plain cuts, as this runs on every row
        else:
            source = F.create_map(*[F.lit(x) for p in group for x in (p, called[p])])[own]
        tables.append(rows.withColumn("source", source))
    return _together(tables)


def _together(tables: list[DataFrame]) -> DataFrame:
    """Tables put together by column name, each column cast to a type that holds all of its own."""
    kinds: dict[str, set] = {}
    for df in tables:
        for f in df.schema:
            kinds.setdefault(f.name.lower(), set()).add(f.dataType)
    mixed = {
        name: T.DoubleType() if all(isinstance(k, T.NumericType) for k in own) else T.StringType()
        for name, own in kinds.items() if len(own) > 1
    }

    def cast(df: DataFrame) -> DataFrame:
        return df.select(*[
            F.col(f"`{c}`").cast(mixed[c.lower()]).alias(c) if c.lower() in mixed else F.col(f"`{c}`")
            for c in df.columns])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(cast, tables))


def read_matching(
    spark: SparkSession, root: str, pattern: str, recursive: bool = False, fmt: str = "parquet",
    schema: str | None = None,
) -> DataFrame:
    """Every feature class named ``pattern``, in one scan if their columns agree."""
    found = _some_sources(spark, root, pattern, recursive)
    return read_features(spark, [at for at, _ in found], fmt, schema, [name for _, name in found])


def layout_of(columns: list[str]) -> str:
    """``positional`` if all marking columns exist, else ``named``."""
    present = {c.lower() for c in columns}
    return "positional" if all(m.lower() in present for m in POSITIONAL_MARKS) else "named"


def unify_layouts(tables: list[DataFrame]) -> DataFrame:
    """Give every table the named layout's columns and put them together."""

    def named(df: DataFrame) -> DataFrame:
        renames = LAYOUTS[layout_of(df.columns)]
        return df.withColumnsRenamed({old: new for old, new in renames.items() if old != new})

    return _together([named(df) for df in tables])


def read_layouts(
    spark: SparkSession, root: str, pattern: str, recursive: bool = False, fmt: str = "parquet",
) -> DataFrame:
    """Matching feature classes of mixed layouts, unified; one scan per layout and schema.

    Planning looks at each feature class's column names, which is metadata only.
    """
    found = _some_sources(spark, root, pattern, recursive)
    with ThreadPoolExecutor(8) as pool:
        layouts = list(pool.map(
            lambda f: layout_of(spark.read.format(fmt).load(_literal(f[0])).columns), found))
    by_layout: dict[str, list[tuple[str, str]]] = {}
    for source, layout in zip(found, layouts):
        by_layout.setdefault(layout, []).append(source)
    return unify_layouts([
        read_features(spark, [at for at, _ in group], fmt, None, [name for _, name in group])
        for group in by_layout.values()
    ])


def source_value(df: DataFrame, field: str) -> DataFrame:
    """The label of each source: ``field`` of its first row.

    The first row's number is a hash aggregate, and that row is then looked up: an
    aggregate that carries a text would sort the whole input. A source without any
    numbered row has no label.
    """
    firsts = df.groupBy(F.col("source").alias("_source")).agg(F.min("OBJECTID").alias("_first"))
    firsts = stage(firsts, "firsts")  # a short row per source; its size decides how it is joined
    rows = df.select("source", "OBJECTID", F.col(field).cast("string").alias("value")).join(
        firsts, (F.col("source") == F.col("_source")) & (F.col("OBJECTID") == F.col("_first")))
    found = rows.groupBy("source").agg(F.min("value").alias("value"))
    return firsts.select(F.col("_source").alias("source")).join(found, "source", "left")


def with_source_value(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Put each source's label on its rows.

    Labels are staged: one short row per source, whose size on disk decides
    between a broadcast and a shuffled join.
    """
    return df.join(stage(labels, "labels"), "source", "left")
