"""Delimited readings files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value in a delimited file.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Column names of the published daily file.
AREA, DAY, READING = "FIPS", "Date", "pm25_daily_average(ug/m3)"


def read_readings(
    spark: SparkSession,
    path: str | list[str],
    value_col: str = READING,
    name: str = "pm25",
    missing: tuple[str, ...] = MISSING,
    columns: list[str] | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Scan delimited text, plain or gzip-compressed, with a header row.

    Every column stays text (so area codes keep their leading zeros) except
    ``value_col``, which becomes a double called ``name``. ``columns`` names the
    file's columns in order and saves the look at the header. A file whose header is
    another, and a row with too many or too few cells, fails the read.

    A gzip file cannot be split, so one task unpacks it. The air job needs no
    help: its partial aggregates run in that task and shrink the rows before the
    first shuffle. For other uses ``spread`` deals the rows out to that many
    partitions.
    """
    # Rows are checked whole, so their width is seen whatever columns are used.
    reader = spark.read.options(
        header=True, escape='"', enforceSchema=False, mode="FAILFAST", columnPruning=False)
    if columns:
        reader = reader.schema(
            T.StructType([T.StructField(c, T.StringType()) for c in columns])
        )
    rows = reader.csv(path)
    rows = typed_readings(rows, value_col, name, missing)
    return rows.repartition(spread) if spread else rows


def typed_readings(
    rows: DataFrame, value_col: str, name: str = "pm25", missing: tuple[str, ...] = MISSING
) -> DataFrame:
    """Turn missing-value texts into nulls and ``value_col`` into a double."""

    def column(c: str):
        cell = F.col(f"`{c}`")
        kept = F.when(~cell.isin(*missing), cell)
        return kept.cast("double").alias(name) if c == value_col else kept.alias(c)

    return rows.select(*[column(c) for c in rows.columns])
