"""Cleaning operators: de-duplication, null handling, range/IQR filters,
timestamp parsing (A11, A12, A14-A18, F1-F11, M10, M26, M27)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from healthmart import schemas
from healthmart.functions.columns import columns_of_kind
from healthmart.functions.features import parse_timestamp
from healthmart.operators.quantiles import quantiles


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# -- de-duplication -----------------------------------------------------------

def dedupe_full_row(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (hash aggregate with map-side combine,
    so a hot duplicated row collapses before the shuffle)."""
    return df.dropDuplicates()


def dedupe_keep_first(df: DataFrame, keys, order_by=None) -> DataFrame:
    """One row per key, the first by ``order_by``.

    ``keys`` are column names or ``(name, Column)`` pairs for derived keys
    (A17); derived keys are added as columns and kept. Ties on
    ``order_by`` are broken by every remaining column, so the pick is
    deterministic. Planned as ``groupBy(keys).agg(min(struct(order,
    payload)))``: partial aggregation keeps at most one row per key per
    task before the shuffle, so a key holding a third of all rows costs no
    more than any other key.
    """
    derived = [k for k in keys if not isinstance(k, str)]
    if derived:
        df = df.withColumns({name: expr for name, expr in derived})
    key_names = [k if isinstance(k, str) else k[0] for k in keys]
    cols = df.columns
    order = [c for c in (order_by or []) if c not in key_names]
    rest = [c for c in cols if c not in key_names and c not in order]
    ordered = order + rest
    if not ordered:
        return df.select(*[_q(k) for k in key_names]).dropDuplicates()
    packed = F.min(F.struct(*[_q(c).alias(f"_{i}") for i, c in enumerate(ordered)])).alias("_first")
    agg = df.groupBy(*[_q(k) for k in key_names]).agg(packed)
    out = [F.col(f"_first._{ordered.index(c)}").alias(c) if c in ordered else _q(c) for c in cols]
    return agg.select(*out)


def duplicate_key_count(df: DataFrame, keys) -> DataFrame:
    """Number of rows beyond the first per key (NULL keys group
    together). One-row frame ``duplicates``."""
    per_key = df.groupBy(*[_q(k) for k in keys]).count()
    return per_key.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates"))


# -- nulls -------------------------------------------------------------------

def drop_null(df: DataFrame, cols) -> DataFrame:
    """drop rows with NULL in any of ``cols``."""
    return df.na.drop(subset=list(cols)) if cols else df


def fill_text(df: DataFrame, value: str = schemas.UNKNOWN_TEXT, cols=None) -> DataFrame:
    """NULL text -> constant, all text columns by default."""
    cols = columns_of_kind(df, "text") if cols is None else list(cols)
    if not cols:
        return df
    return df.withColumns({c: F.coalesce(_q(c), F.lit(value)) for c in cols})


def median_stats(df: DataFrame, cols) -> DataFrame:
    """One-row frame holding the exact median of every column."""
    return quantiles(df, {c: [0.5] for c in cols}).select(*[_q(c)[0].alias(c) for c in cols])


def fill_median(df: DataFrame, cols=None, null_counts: dict | None = None, eager: bool = False) -> DataFrame:
    """NULL numeric -> the column's median (NULLs skipped).

    ``null_counts`` (column -> NULLs, e.g. observed while the input was
    written) leaves out complete columns. The medians are one uncorrelated
    scalar subquery; ``eager`` gathers them in one action and fills with
    literals, for frames that several later jobs read.
    """
    cols = columns_of_kind(df, "numeric") if cols is None else list(cols)
    if null_counts is not None:
        cols = [c for c in cols if null_counts.get(c, 1) > 0]
    if not cols:
        return df
    stats = median_stats(df, cols).select(F.struct(*[_q(c).alias(f"m{i}") for i, c in enumerate(cols)]).alias("m"))
    if eager:
        row = stats.first()["m"]
        medians = [F.lit(m) for m in row]
    else:
        row = stats.scalar()
        medians = [row[f"m{i}"] for i in range(len(cols))]
    return df.withColumns({c: F.coalesce(_q(c), m.cast(df.schema[c].dataType)) for c, m in zip(cols, medians, strict=True)})


# -- timestamps ----------------------------------------------------------------

def parse_dates(df: DataFrame, cols, drop_unparsed: bool = True) -> DataFrame:
    """M10 + F1: parse text timestamps (errors -> NULL) and drop rows where
    any of them is NULL."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    df = df.withColumns({c: parse_timestamp(df, c) for c in present})
    return drop_null(df, present) if drop_unparsed else df


# -- predicates ------------------------------------------------------------------

def range_filter(df: DataFrame, col: str, lo=None, hi=None, keep_null: bool = False) -> DataFrame:
    """closed-range filter; NULL dropped unless ``keep_null``."""
    c = _q(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= lo)
    if hi is not None:
        cond = cond & (c <= hi)
    if keep_null:
        cond = c.isNull() | cond
    return df.filter(cond)


def out_of_range(col: str, lo, hi) -> Column:
    """``NOT BETWEEN`` predicate (NULL is not counted)."""
    return ~_q(col).between(lo, hi)


def membership_filter(df: DataFrame, col: str, values, negate: bool = False) -> DataFrame:
    """F8: keep rows whose value is (not) in ``values``."""
    cond = _q(col).isin(*values)
    return df.filter(~cond if negate else cond)


def iqr_bounds(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """One-row frame (q1, q3, lo, hi), quartiles by linear interpolation."""
    q1, q3 = F.col("q")[0], F.col("q")[1]
    return quantiles(df, {col: [0.25, 0.75]}).select(_q(col).alias("q")).select(
        q1.alias("q1"), q3.alias("q3"),
        (q1 - F.lit(k) * (q3 - q1)).alias("lo"), (q3 + F.lit(k) * (q3 - q1)).alias("hi"))


def iqr_filter(df: DataFrame, col: str, k: float = 1.5, eager: bool = False) -> DataFrame:
    """keep rows with Q1 - k*IQR <= x <= Q3 + k*IQR (closed; NULL dropped).

    Quartiles are computed over ``df`` itself, as one uncorrelated scalar
    subquery; ``eager`` gathers the two bounds in one action and filters
    with literals.
    """
    b = iqr_bounds(df, col, k).select(F.struct("lo", "hi").alias("b"))
    if eager:
        lo, hi = (F.lit(x).cast("double") for x in b.first()["b"])
    else:
        row = b.scalar()
        lo, hi = row["lo"], row["hi"]
    return df.filter(_q(col).between(lo, hi))
