"""Air job: daily readings to annual means per area and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fumeline.operators.stats import describe, distinct_count, group_mean
from fumeline.session import stage
from fumeline.sources.readings import AREA, DAY, read_readings


def area_means(readings: DataFrame, value: str = "pm25") -> DataFrame:
    return group_mean(readings, AREA, value)


def air(readings: DataFrame, value: str = "pm25") -> DataFrame:
    """Days covered, then the summary of the areas' means, as (stat, value) rows.

    The three columns are staged first, so a compressed file is unpacked once.
    """
    readings = stage(readings.select(AREA, DAY, value), "readings")
    days = distinct_count(readings, DAY).select(
        F.lit("days").alias("stat"), F.col("n").cast("double").alias("value")
    )
    return days.unionByName(describe(area_means(readings, value), value))


def air_from_file(spark: SparkSession, path: str) -> DataFrame:
    """The whole job from the compressed file on."""
    return air(read_readings(spark, path))
