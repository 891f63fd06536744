"""Scaling against global scalars.

Each scalar is an uncorrelated scalar subquery: nothing runs while the plan
is built, and Catalyst drops the subquery when the scaled column is not
used. With ``eager`` it is gathered in one action and used as a literal,
for frames that several later jobs read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def minmax_stats(df: DataFrame, col: str) -> DataFrame:
    """One-row (min, max)."""
    c = F.col(f"`{col}`").cast("double")
    return df.agg(F.min(c).alias("__mn"), F.max(c).alias("__mx"))


def _rounded(v: Column, scale: int | None) -> Column:
    return v if scale is None else F.round(v, scale)


def minmax_scale(df: DataFrame, col: str, out: str, eps: float = 1e-9,
                 domain: DataFrame | None = None, scale: int | None = None, eager: bool = False,
                 bounds: tuple | None = None) -> DataFrame:
    """M7/M8: (x - min) / (max - min + eps).

    ``domain`` is the frame min/max are taken from (M8 uses the raw staging
    table, M7 the frame itself). ``scale`` rounds half-up (SQL ROUND).
    ``bounds`` = (min, max) already known (e.g. observed while the domain
    was written) skips the aggregate altogether.
    """
    if bounds is None:
        stats = minmax_stats(df if domain is None else domain, col).select(F.struct("__mn", "__mx").alias("s"))
        bounds = stats.first()["s"] if eager else stats.scalar()
    mn, mx = (F.lit(bounds[i]).cast("double") for i in (0, 1)) if isinstance(bounds, tuple) else \
        (bounds["__mn"], bounds["__mx"])
    x = F.col(f"`{col}`").cast("double")
    return df.withColumn(out, _rounded((x - mn) / (mx - mn + F.lit(eps)), scale))


def max_scale(df: DataFrame, col: str, out: str, eps: float = 1e-4, scale: int | None = 4,
              domain: DataFrame | None = None, eager: bool = False, known_max=None) -> DataFrame:
    """M9: x / (max + eps), rounded half-up (``eager`` as in minmax_scale;
    ``known_max`` skips the aggregate)."""
    if known_max is None:
        stats = (df if domain is None else domain).agg(F.max(F.col(f"`{col}`").cast("double")).alias("__mx"))
        known_max = stats.first()["__mx"] if eager else stats.scalar()
    mx = known_max if isinstance(known_max, Column) else F.lit(known_max).cast("double")
    return df.withColumn(out, _rounded(F.col(f"`{col}`") / (mx + F.lit(eps)), scale))
