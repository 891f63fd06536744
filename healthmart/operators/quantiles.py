"""Exact quantiles by linear interpolation (A11, A12) in bounded memory.

No task keeps the distinct values of a column. Rows are counted in buckets
by a function that never decreases with the value (first scan); what lies in
a bucket that holds a wanted rank is counted by value (second scan, a
thirty-second part of an octave of the column), and that is cut into finer
buckets until one is a single value. The finer levels read the second scan's
shuffle again, not the input, and are chained in one plan with no action in
between; each holds at most ``BINS`` buckets per rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets a level cuts one bucket into.
BINS = 1 << 16
#: Buckets per power of two at the first level.
STEPS = 32
#: Levels after the first. A first bucket holds at most 2**48 doubles
#: (2**52 in a power of two), so that three cuts by 2**16 leave one each.
LEVELS = 3


def _first(v: Column) -> Column:
    """Coarse bucket of a double: its sign and logarithm; infinities and NaN
    (which Spark sorts last) have buckets of their own."""
    inf = float("inf")
    log = F.floor((F.log2(F.abs(v)) + 1100) * STEPS) + 1
    return (F.when(F.isnan(v), F.lit(1 << 30)).when(v == inf, F.lit(1 << 29)).when(v == -inf, F.lit(-(1 << 29)))
            .when(v == 0, F.lit(0)).when(v > 0, log).otherwise(-log)).cast("long")


def _finer(v: Column, lo: Column, hi: Column) -> Column:
    """Bucket of a double between ``lo`` and ``hi``, 0 if these are equal."""
    return F.when(lo == hi, F.lit(0)).otherwise(F.floor((v - lo) / (hi - lo) * BINS)).cast("long")


def quantiles(df: DataFrame, probs: dict[str, list[float]]) -> DataFrame:
    """One-row frame with an array column per entry of ``probs`` (column ->
    probabilities), of NULLs where the column has no value.

    A quantile at p lies at the place (n - 1) * p of the n sorted non-NULL
    values, between two neighbours on the straight line through them.
    """
    names = list(probs)
    value = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("v"))
                                for i, c in enumerate(names)])).alias("x")
    rows = df.select(value).select("x.c", "x.v").where("v is not null")

    hist = rows.groupBy("c", _first(F.col("v")).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    whole = Window.partitionBy("c")
    hist = hist.withColumns({"upto": F.sum("n").over(whole.orderBy("b")), "total": F.sum("n").over(whole)})
    # both neighbours of every place: q counts them within a column
    asked = F.array(*[F.array(*[F.lit(float(p)) for p in probs[c]]) for c in names])
    place = F.posexplode(F.element_at(asked, F.col("c") + 1)).alias("q", "p")
    hist = hist.select("*", place).withColumn("at", (F.col("total") - 1) * F.col("p"))
    hist = hist.withColumn("rank", F.explode(F.array(F.floor("at"), F.ceil("at"))))
    hit = (F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto"))
    key = ["c", "q", "at", "rank"]
    found = hist.where(hit).select(*key, "lo", "hi", (F.col("rank") - F.col("upto") + F.col("n")).alias("left")).distinct()

    # ``found`` has one row per rank: two per probability asked for
    side = found.select(F.col("c").alias("c0"), "q", "at", "rank", "lo", "hi", "left")
    near = rows.join(F.broadcast(side), (F.col("c") == F.col("c0")) & F.col("v").between(F.col("lo"), F.col("hi")))
    # with the value as a key every level below has this very exchange in its plan, which is run once
    values = near.groupBy(*key, "lo", "hi", "left", "v").agg(F.count(F.lit(1)).alias("n"))
    for level in range(LEVELS):
        if level:
            side = found.select(*[F.col(k).alias(f"{k}0") for k in key], F.col("lo").alias("lo0"), F.col("hi").alias("hi0"), F.col("left").alias("left0"))
            same = F.lit(True)
            for k in key:
                same = same & (F.col(k) == F.col(f"{k}0"))
            inner = values.join(F.broadcast(side), same & F.col("v").between(F.col("lo0"), F.col("hi0"))).select(
                *key, "v", "n", F.col("lo0").alias("lo"), F.col("hi0").alias("hi"), F.col("left0").alias("left"))
        else:
            inner = values
        fine = inner.groupBy(*key, "left", _finer(F.col("v"), F.col("lo"), F.col("hi")).alias("b")).agg(
            F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        fine = fine.withColumn("upto", F.sum("n").over(Window.partitionBy(*key).orderBy("b")))
        hit = (F.col("left") >= F.col("upto") - F.col("n")) & (F.col("left") < F.col("upto"))
        found = fine.where(hit).select(*key, "lo", "hi", (F.col("left") - F.col("upto") + F.col("n")).alias("left"))

    ends = found.groupBy("c", "q", "at").agg(F.min_by("lo", "rank").alias("low"), F.max_by("lo", "rank").alias("high"))
    part = F.col("at") - F.floor("at")  # one neighbour stands for both where they are equal
    ends = ends.withColumn("v", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        (F.ceil("at") - F.col("at")) * F.col("low") + part * F.col("high")))
    return ends.agg(*[F.array(*[F.max(F.when((F.col("c") == i) & (F.col("q") == j), F.col("v")))
                                for j in range(len(probs[c]))]).alias(c) for i, c in enumerate(names)])
