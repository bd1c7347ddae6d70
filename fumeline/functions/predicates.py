"""Which road segments take part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classes always kept, the class kept only in urban areas, and the
# urban code that means "rural".
MAJOR, URBAN_ONLY, RURAL = (1, 2, 3), 4, 99999


def _major(cls: Column, urban: Column, literal) -> Column:
    return cls.isin(*map(literal, MAJOR)) | (
        (cls == literal(URBAN_ONLY)) & (urban != literal(RURAL))
    )


def major_roads(df: DataFrame, cls: str = "F_SYSTEM", urban: str = "URBAN_CODE") -> DataFrame:
    """Major roads, both columns numeric."""
    return df.filter(_major(F.col(cls), F.col(urban), int))


def major_roads_text(df: DataFrame, cls: str = "F_SYSTEM", urban: str = "URBAN_ID") -> DataFrame:
    """Major roads, both columns text, under either layout's names."""
    return df.filter(_major(F.col(cls), F.col(urban), str))


def with_traffic(df: DataFrame, aadt: str = "AADT", length: str = "Shape_Length") -> DataFrame:
    """Segments with traffic and a length.

    Spark ranks NaN above every number, so a floating column needs the extra test.
    """
    kinds = {n.lower(): t for n, t in df.dtypes}
    keep = F.lit(True)
    for name in (aadt, length):
        keep = keep & (F.col(name) > 0)
        if kinds[name.lower()] in ("float", "double"):
            keep = keep & ~F.isnan(name)
    return df.filter(keep)
