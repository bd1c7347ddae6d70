"""Session settings, and tables staged in the cluster's shared folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

_local_roots: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def stage_root(spark: SparkSession) -> str:
    """The folder for staged tables: ``spark.checkpoint.dir`` where it is set.

    A local session without the setting gets a folder of its own, removed on exit. A cluster must
    name a shared one, or executors could not read each other's tables.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="fumeline-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    This cuts the lineage: an executor lost later costs a re-read, not a re-run.
    The scan also gives the planner true sizes, so it broadcasts a staged table
    only when the files are under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    spark = tables[0].sparkSession
    jvm = spark.sparkContext._jvm
    for table in tables:
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            root = jvm.org.apache.hadoop.fs.Path(stage_root(spark))
            if path.getParent().toUri().getPath() != root.toUri().getPath():
                raise ValueError(f"not a staged table: {folder}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free(spark: SparkSession) -> None:
    """Let go of the shuffles and broadcasts of data frames that are no longer held.

    Their files go when the JVM collects the objects that name them, so it is asked to: a
    driver with little to do would keep them for long. Python's bridge tells the JVM only
    about once a second which objects Python has dropped, and files go in the background.
    """
    gc.collect()
    for _ in range(2):
        time.sleep(2)
        spark.sparkContext._jvm.System.gc()
    time.sleep(1)


def stage_counting(df: DataFrame, label: str, **sums: Column) -> tuple[DataFrame, dict]:
    """:func:`stage`, and aggregates of the rows taken while they are written."""
    seen = Observation()
    staged = stage(df.observe(seen, *[c.alias(n) for n, c in sums.items()]), label)
    return staged, seen.get
