"""Data-quality rules.

``check_*`` return a report DataFrame (rule, column, item, n, share): the
counts come from one aggregate pass plus one grouped pass for key
uniqueness, never from per-rule driver loops. ``enforce`` applies the
filtering rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from healthmart.operators.clean import dedupe_keep_first, duplicate_key_count

REPORT_SCHEMA = "rule string, column string, item string, n long, share double"
VALID_SOURCES = ("no_show", "disease")


def _row(rule, column, item, n, share=None):
    return F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.lit(item).alias("item"),
                    n.cast("long").alias("n"), F.lit(share).cast("double").alias("share") if share is None
                    else share.cast("double").alias("share"))


def null_counts(df: DataFrame, cols) -> DataFrame:
    """One-row frame, number of NULLs per column, one pass."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])


def relative_frequency(df: DataFrame, col: str, scale: int = 4, out: str = "share") -> DataFrame:
    """Value counts normalised by the total, rounded.

    The total is a one-row aggregate of the counts, broadcast back; no
    single-partition window, so a high-cardinality column stays spread."""
    counts = df.groupBy(F.col(col)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("__total"))
    return (counts.crossJoin(F.broadcast(total))
                  .withColumn(out, F.round(F.col("n") / F.col("__total"), scale)).drop("__total"))


def check_conformed(df: DataFrame, key: str = "record_id", required=("record_id", "source", "age"),
                    age: str = "age", lo: float = 0, hi: float = 120,
                    source: str = "source", valid_sources=VALID_SOURCES) -> DataFrame:
    """V1-V8 report over the conformed layout (reporting only)."""
    a = F.col(f"`{age}`")
    s = F.col(f"`{source}`")
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"__null_{c}") for c in required]
    aggs.append(F.count_if(a.isNotNull() & ~a.between(lo, hi)).alias("__range"))
    aggs.append(F.count_if(~F.coalesce(s.isin(*valid_sources), F.lit(False))).alias("__badsrc"))
    for c, t in (("record_id", "bigint"), ("gender_code", "int"), ("outcome_flag", "int")):
        if c in df.columns:
            aggs.append(F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast({c} AS {t})").isNull()).alias(f"__type_{c}"))
    one = df.agg(*aggs)
    dups = duplicate_key_count(df, [key])
    one = one.crossJoin(dups)
    rows = [_row("V1", key, "duplicates", F.col("duplicates"))]
    rows += [_row("V2", c, "nulls", F.col(f"__null_{c}")) for c in required]
    rows.append(_row("V3", age, f"outside [{lo:g},{hi:g}]", F.col("__range")))
    rows += [_row("V4", c, "not coercible", F.col(f"__type_{c}"))
             for c in ("record_id", "gender_code", "outcome_flag") if c in df.columns]
    rows.append(_row("V5", source, "invalid", F.col("__badsrc")))
    rows.append(_row("V7", "*", "rows", F.col("__rows")))
    report = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    dist = relative_frequency(df, source).select(
        F.lit("V6").alias("rule"), F.lit(source).alias("column"), F.col(source).cast("string").alias("item"),
        F.col("n").cast("long"), F.col("share").cast("double"))
    return report.unionByName(dist)


def enforce(df: DataFrame, key: str = "record_id", order_by=None, required=("record_id", "source"),
            age: str = "age", lo: float = 0, hi: float = 120, source: str = "source",
            valid_sources=VALID_SOURCES, report: dict | None = None) -> DataFrame:
    """V1-V5 as filters: one row per key, no NULL key/source, age NULL or in
    range, codes coerced (gender -> -1, outcome -> 0), source valid.

    ``report`` maps (rule, column) -> violations from ``check_conformed``;
    a rule with no violation is skipped, so a clean frame costs no
    de-duplicating shuffle."""
    def hits(rule, column):
        return report is None or report.get((rule, column), 1) > 0

    out = df
    if hits("V1", key):
        out = dedupe_keep_first(out, [key], order_by)
    if report is None or any(report.get(("V2", c), 1) > 0 for c in required):
        out = out.na.drop(subset=list(required))
    a = F.col(f"`{age}`")
    if hits("V3", age):
        out = out.filter(a.isNull() | a.between(lo, hi))
    coerce = {}
    if "gender_code" in out.columns:
        coerce["gender_code"] = F.coalesce(F.expr("try_cast(gender_code AS INT)"), F.lit(-1))
    if "outcome_flag" in out.columns:
        coerce["outcome_flag"] = F.coalesce(F.expr("try_cast(outcome_flag AS INT)"), F.lit(0))
    coerce[key] = F.expr(f"try_cast(`{key}` AS BIGINT)")
    out = out.withColumns(coerce)
    if hits("V5", source):
        out = out.filter(F.col(f"`{source}`").isin(*valid_sources))
    return out


def removed_rows(report: dict) -> int:
    """Upper bound of rows ``enforce`` removes, from the collected report."""
    return sum(v for (rule, _), v in report.items() if rule in ("V1", "V3", "V5")) + \
        max([v for (rule, c), v in report.items() if rule == "V2" and c in ("record_id", "source")] or [0])


def report_dict(report: DataFrame) -> dict:
    """Collect the (small, fixed-size) rule rows of a report."""
    return {(r["rule"], r["column"]): r["n"] for r in report.filter(F.col("rule") != "V6").collect()}


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key is not in the dimension (``NOT IN``).

    ``NOT IN`` semantics: a NULL fact key never qualifies, a NULL in the
    dimension makes every row fail the predicate, and an empty dimension
    lets every row pass. The two facts about the dimension are one row; the
    rest is a plain anti join, which may shuffle, so neither side has to
    fit into a broadcast.
    """
    d = dim.select(F.col(dim_key or key).alias("__k"))
    about = d.agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col("__k").isNull()).alias("__nulls"))
    left = fact.join(d, F.col(key) == F.col("__k"), "left_anti")
    ok = (F.col("__n") == 0) | (F.col(key).isNotNull() & (F.col("__nulls") == 0))
    return left.crossJoin(about).where(ok).drop("__n", "__nulls")


def orphans_anti(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """J7 when neither side has NULL keys: plain left-anti join."""
    return fact.join(dim.select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left_anti")


def check_fact(star) -> DataFrame:
    """ELT checks over a star: total rows, NULL age, age NOT BETWEEN 0 AND
    120, source ids not in the dimension, counts by source and by outcome."""
    f = star.fact
    one = f.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("age").isNull()).alias("null_age"),
        F.count_if(~F.col("age").between(0, 120)).alias("out_range"),
    )
    invalid = orphans_anti(f.filter(F.col("source_id").isNotNull()), star.dim_source, "source_id") \
        .agg(F.count(F.lit(1)).alias("invalid"))
    # NULL source ids never match NOT IN either: they are counted as invalid only
    # by the ETL rule, so the ELT report leaves them out like the SQL does.
    base = one.crossJoin(invalid).select(F.explode(F.array(
        _row("V1", "*", "rows", F.col("total")),
        _row("V2", "age", "nulls", F.col("null_age")),
        _row("V3", "age", "outside [0,120]", F.col("out_range")),
        _row("V4", "source_id", "not in dim_source", F.col("invalid")),
    )).alias("r")).select("r.*")
    by_source = (f.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
                  .join(F.broadcast(star.dim_source), "source_id")
                  .select(F.lit("V5").alias("rule"), F.lit("source_name").alias("column"),
                          F.col("source_name").alias("item"), F.col("n").cast("long"),
                          F.lit(None).cast("double").alias("share")))
    by_outcome = (f.groupBy("outcome_id").agg(F.count(F.lit(1)).alias("n"))
                   .join(F.broadcast(star.dim_outcome), "outcome_id")
                   .select(F.lit("V6").alias("rule"), F.lit("outcome_label").alias("column"),
                           F.col("outcome_label").alias("item"), F.col("n").cast("long"),
                           F.lit(None).cast("double").alias("share")))
    return reduce(DataFrame.unionByName, [base, by_source, by_outcome])
