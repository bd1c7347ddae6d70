"""Column expressions over road segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line_length(paths: str = "paths") -> Column:
    """Planar length of a polyline, all its paths together."""

    def step(a: Column, b: Column) -> Column:
        # zip_with pads the shorter side with null, which the sum skips.
        return F.coalesce(F.hypot(b["x"] - a["x"], b["y"] - a["y"]), F.lit(0.0))

    def along(path: Column) -> Column:
        steps = F.zip_with(path, F.slice(path, 2, F.greatest(F.size(path), F.lit(1))), step)
        return F.aggregate(steps, F.lit(0.0), lambda total, s: total + s)

    return F.aggregate(F.transform(F.col(paths), along), F.lit(0.0), lambda total, s: total + s)


def with_length(df: DataFrame, paths: str = "paths", name: str = "Shape_Length") -> DataFrame:
    """Each line's length: the table's own, or computed where the table or the row has none."""
    own = [F.col(c) for c in df.columns if c.lower() == name.lower()]
    return df.withColumn(name, F.coalesce(*own, line_length(paths)))


def number_text(c: Column, dtype: str) -> Column:
    """A number as the text a dissolve key holds.

    Whole numbers are plain digits. Doubles are the shortest digits that read
    back the same, in positional form from 0.0001 up to 1e16 where Spark's own
    text turns to exponents at 0.001 and 1e7, and as ``1.5e+16`` beyond.
    """
    if dtype not in ("float", "double"):
        return c.cast("string")
    d = c.cast("double")
    size = F.abs(d)
    digits = F.regexp_replace(d.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    text = d.cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(text, r"^(.*)E", 1), r"\.0$", "")
    power = F.regexp_extract(text, r"E(.*)$", 1).try_cast("int")
    exponent = F.concat(
        mantissa, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(power).cast("string"),
    )
    return (
        F.when((size >= 1e-3) & (size < 1e7) | (size == 0), text)
        .when((size >= 1e-4) & (size < 1e16), digits)
        .when(F.isnan(d), F.lit("nan"))
        .when(size == float("inf"), F.when(d > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .otherwise(exponent)
    )


def route_key(
    df: DataFrame, route: str, aadt: str, null_route: str | None = None, strict: bool = False,
    name: str = "key",
) -> DataFrame:
    """The dissolve key: route text followed by traffic text.

    ``null_route`` is the text a missing route turns into (``None`` in 2020); left
    out, a missing route gives a missing key. The plain key has no separator, so
    different routes can share one; ``strict`` keeps every (route, traffic) pair
    apart.
    """
    kinds = {n.lower(): t for n, t in df.dtypes}
    route_text = number_text(F.col(route), kinds[route.lower()])
    aadt_text = number_text(F.col(aadt), kinds[aadt.lower()])
    if strict:
        # Traffic text holds no "|" and a present route starts with "=", so the
        # pair can be read back from the key.
        present = F.concat(F.lit("="), route_text)
        head = F.coalesce(present, F.lit("")) if null_route is not None else present
        return df.withColumn(name, F.concat(head, F.lit("|"), aadt_text))
    head = F.coalesce(route_text, F.lit(null_route)) if null_route is not None else route_text
    return df.withColumn(name, F.concat(head, aadt_text))


def parse_codes(df: DataFrame, casts: dict[str, tuple[str, str]], required: tuple[str, ...] = ()):
    """Turn text columns into numbers (R9-R11); returns (good, rejects).

    ``casts`` maps a new column to (text column, type). A row is rejected when a
    text does not fit its type, or when a ``required`` result is missing.
    """
    failed = F.lit(False)
    new = {}
    for name, (text, kind) in casts.items():
        number = F.trim(F.col(text)).try_cast(kind)
        new[name] = number
        bad = number.isNull() if name in required else number.isNull() & F.col(text).isNotNull()
        failed = failed | bad
    return df.filter(~failed).withColumns(new), df.filter(failed)
