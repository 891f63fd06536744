"""Column-name handling.

These run on ``df.columns`` / ``df.dtypes`` on the driver, which is plan
metadata, not data; only ``yes_no_columns`` looks at values and does so in
one distributed aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_TYPES = ("string", "varchar", "char")
NUMERIC_PREFIXES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def normalize_name(name: str, dash_to_underscore: bool = True) -> str:
    """strip, lower-case, space -> '_' and optionally '-' -> '_' (M3)."""
    out = name.strip().lower()
    if dash_to_underscore:
        out = out.replace("-", "_")
    return out.replace(" ", "_")


def normalize_names(df: DataFrame, dash_to_underscore: bool = True) -> DataFrame:
    """Rename every column with ``normalize_name`` (metadata only)."""
    return df.toDF(*[normalize_name(c, dash_to_underscore) for c in df.columns])


def _matcher(spec) -> Callable[[str], bool]:
    if callable(spec):
        return spec
    if isinstance(spec, str):
        spec = (spec,)
    parts = [s.lower() for s in spec]
    return lambda c: all(p in c.lower() for p in parts)


def resolve(columns: Iterable[str], spec, default=None, exact: bool = False):
    """First column whose lower-cased name contains every substring.

    ``spec`` is a substring, a tuple of substrings (all must occur) or a
    predicate. ``exact`` compares the whole lower-cased name instead.
    Returns ``default`` when nothing matches.
    """
    cols = list(columns)
    if exact:
        target = spec.lower()
        return next((c for c in cols if c.lower() == target), default)
    match = _matcher(spec)
    return next((c for c in cols if match(c)), default)


def resolve_all(columns: Iterable[str], spec) -> list[str]:
    """Every column matching ``spec`` in schema order."""
    match = _matcher(spec)
    return [c for c in columns if match(c)]


def col_or_lit(df: DataFrame, name: str | None, default, dtype: str | None = None):
    """Column if present, else a typed literal (P2 fallback, P8)."""
    c = F.col(f"`{name}`") if name is not None and name in df.columns else F.lit(default)
    return c.cast(dtype) if dtype else c


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Column names whose type is ``text`` or ``numeric``."""
    if kind == "text":
        return [c for c, t in df.dtypes if t.startswith(TEXT_TYPES)]
    if kind == "numeric":
        return [c for c, t in df.dtypes if t.startswith(NUMERIC_PREFIXES)]
    raise ValueError(f"unknown kind {kind!r}")


def yes_no_flags(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One-row frame, a boolean per text column telling whether every
    value is yes/no (case-insensitive). NULL counts as not yes/no, so a
    column with any NULL is excluded. One distributed aggregate.
    """
    cols = columns if columns is not None else columns_of_kind(df, "text")
    if not cols:
        return df.sparkSession.createDataFrame([()], "")
    aggs = [
        F.coalesce(F.bool_and(F.coalesce(F.lower(F.col(f"`{c}`")).isin("yes", "no"), F.lit(False))),
                   F.lit(True)).alias(c)
        for c in cols
    ]
    return df.agg(*aggs)


def yes_no_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """Names of yes/no columns; triggers one aggregate job returning one row."""
    cols = columns if columns is not None else columns_of_kind(df, "text")
    if not cols:
        return []
    row = yes_no_flags(df, cols).first()
    return [c for c in cols if row[c]]


def schema_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column -> position, type, as a DataFrame (metadata only)."""
    rows = [(i, c, t) for i, (c, t) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "cid int, name string, type string")
