"""Rows judged by rules and set apart with their reasons (V1-V5).

Every row gets a bit mask of the rules it breaks, and kept and rejected rows
go into one table with a folder each, in a single write that also counts the
violations of every rule. Copies of one row are one row with a number
(``times``), so that no group of copies, however large, is dealt to a task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from healthmart.sources import versions

#: Rules in the order of their bits.
RULES = ("V1 duplicate key", "V2 missing value", "V3 out of range", "V4 not coercible", "V5 unknown source")
DUPLICATE, MISSING, RANGE, CODE, SOURCE = (1 << i for i in range(5))


@dataclass
class Rules:
    """What a table's rows must fulfil. ``codes`` maps a column to its type
    and the code that takes the place of what cannot be cast to it: such rows
    are repaired and stay, unless they break another rule."""
    key: str
    order_by: tuple = ()                          # which of several rows with one key comes first
    required: tuple = ()                          # beside the key
    ranges: dict = field(default_factory=dict)    # column -> (lowest, highest); NULL passes
    codes: dict = field(default_factory=dict)     # column -> (type, code)
    sources: dict = field(default_factory=dict)   # column -> allowed values; NULL does not pass


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def judge(df: DataFrame, rules: Rules) -> DataFrame:
    """``df`` with coded columns repaired, plus broken (mask of ``RULES``),
    times (rows that are equal to this one in every column) and rejected.

    Of rows with one key the first by ``order_by`` and then all columns is
    no duplicate (NULLs come first); of its own copies, one is none. A row
    without key breaks V2 only. No group is gathered: copies are counted, the
    first row of a key is a combinable minimum, and only keys with several
    distinct rows meet their rows in a join, which adaptive execution splits
    where one key is hot.
    """
    cols = df.columns
    order = F.struct(*[_q(c) for c in (*rules.order_by, *[c for c in cols if c not in rules.order_by])])
    rows = df.groupBy(*[_q(c) for c in cols]).agg(F.count(F.lit(1)).alias("__n"))
    several = (rows.where(_q(rules.key).isNotNull()).groupBy(_q(rules.key).alias("__key"))
               .agg(F.min(order).alias("__first"), F.count(F.lit(1)).alias("__rows")).where("__rows > 1"))
    rows = rows.join(several, _q(rules.key) == F.col("__key"), "left")
    later = F.col("__first").isNotNull() & ~order.eqNullSafe(F.col("__first"))

    def bit(condition: Column, mask: int) -> Column:
        return F.when(condition, mask).otherwise(0)

    def any_of(conditions: list[Column]) -> Column:
        out = F.lit(False)
        for c in conditions:
            out = out | F.coalesce(c, F.lit(False))
        return out

    own = (bit(any_of([_q(c).isNull() for c in (rules.key, *rules.required)]), MISSING)
           + bit(any_of([~_q(c).between(lo, hi) for c, (lo, hi) in rules.ranges.items()]), RANGE)
           + bit(any_of([_q(c).isNotNull() & _q(c).try_cast(t).isNull() for c, (t, _) in rules.codes.items()]), CODE)
           + bit(any_of([_q(c).isNull() | ~_q(c).isin(list(v)) for c, v in rules.sources.items()]), SOURCE))
    # the first of a keyed row's copies, then the rest of them
    keyed = _q(rules.key).isNotNull()
    copies = F.expr("filter(array(named_struct('copy', false, 'times', if(__keyed, 1L, __n)), "
                    "named_struct('copy', true, 'times', __n - 1)), c -> not c.copy or (__keyed and c.times > 0))")
    rows = (rows.withColumns({"__own": own, "__later": later, "__keyed": keyed})
                .withColumn("__c", F.explode(copies)))
    broken = F.col("__own") + bit(F.col("__later") | (F.col("__c.copy")), DUPLICATE)
    repaired = {c: F.coalesce(_q(c).try_cast(t), F.lit(code).cast(t)) for c, (t, code) in rules.codes.items()}
    return rows.select(*[repaired[c].alias(c) if c in repaired else _q(c) for c in cols], broken.cast("int").alias("broken"),
                       F.col("__c.times").alias("times"), broken.bitwiseAND(~CODE).cast("boolean").alias("rejected"))


def reasons(mask: Column) -> Column:
    """The names of the rules in a mask."""
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(1 << i) > 0, r) for i, r in enumerate(RULES)]))


def quarantine(df: DataFrame, rules: Rules, base: str, name: str) -> tuple[DataFrame, DataFrame, dict]:
    """Write the judged rows as table ``name``; returns (kept rows with the
    columns of ``df``, rejected rows with broken, times and reasons, rows by
    rule). Kept rows and counts come from the one write."""
    spark = df.sparkSession
    seen = versions.replace_table(judge(df, rules), base, name, partition_by=("rejected",), metrics={
        r[:2]: F.coalesce(F.sum(F.when(F.col("broken").bitwiseAND(1 << i) > 0, F.col("times"))), F.lit(0)) for i, r in enumerate(RULES)})
    stored = versions.read_version(spark, base, name)
    kept = stored.where("not rejected")  # no two of them have one key: times is 1
    rejected = stored.where("rejected").withColumn("reasons", reasons(F.col("broken")))
    return kept.select(*[_q(c) for c in df.columns]), rejected.drop("rejected"), {r[:2]: seen[r[:2]] for r in RULES}
