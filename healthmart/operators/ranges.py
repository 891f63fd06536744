"""Lookup of values in a range table that is data.

Ranges may overlap, leave gaps and be many. In order of their lower bounds,
a range that reaches no further than an earlier one is never the first to
hold a value; the others, kept, have rising upper bounds, so the only
candidate for a value is the first kept range that reaches it. A search tree
over the upper bounds finds it: nodes of ``FAN`` entries, the bounds of the
topmost ``TOP`` nodes at most in a ``Bucketizer``, every lower level an equi
join of one value with one node. What a value meets is ``FAN`` entries a
level, however many ranges lie over each other.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from healthmart.operators.materialize import checkpoint

FAN = 16             # entries of a node
TOP = 1 << 14        # nodes of the topmost level at most
BROADCAST = 1 << 20  # entries of a level up to which it is broadcast


def kept(ranges: DataFrame, lo: str, hi: str, take: list[str]) -> tuple[DataFrame, int]:
    """(__pos, __lo, __hi, __row) of the ranges that no earlier one covers, in
    the order of (lower bound, upper bound, ``take``), numbered from 0; with
    it their number. ``__row`` holds ``take``. Ranges with a NULL or NaN
    bound, or none between their bounds, hold no value and are left out.

    Running maximum and numbers are prefix sums over range partitions, as in
    ``conform.dense_ids``: no task holds more than its own range.
    """
    r = ranges.select(F.col(f"`{lo}`").cast("double").alias("__lo"), F.col(f"`{hi}`").cast("double").alias("__hi"),
                      F.struct(*[F.col(f"`{c}`") for c in take]).alias("__row"))
    r = r.where("__lo <= __hi and not isnan(__lo) and not isnan(__hi)").groupBy("__lo", "__hi").agg(F.min("__row").alias("__row"))
    placed = checkpoint(r.repartitionByRange("__lo", "__hi").sortWithinPartitions("__lo", "__hi").withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__p", F.shiftright("__at", 33))
    parts = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("__p").agg(F.max("__hi").alias("__top")).select("__p", F.max("__top").over(parts).alias("__before"))
    inside = Window.partitionBy("__p").orderBy("__at")
    reach = F.greatest(F.max("__hi").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col("__before"))
    first = (placed.join(F.broadcast(before), "__p").withColumn("__reach", reach).where("__reach is null or __hi > __reach")
             .select("__p", F.row_number().over(inside).alias("__nth"), "__lo", "__hi", "__row"))
    first, seen = checkpoint(first, observe={"n": F.count(F.lit(1))})
    offsets = first.groupBy("__p").agg(F.count(F.lit(1)).alias("__n")).select("__p", F.coalesce(F.sum("__n").over(parts), F.lit(0)).alias("__off"))
    out = first.join(F.broadcast(offsets), "__p").select((F.col("__off") + F.col("__nth") - 1).alias("__pos"), "__lo", "__hi", "__row")
    return out, seen["n"]


def nodes(table: DataFrame, level: int) -> DataFrame:
    """(node, held) of a level of the tree over ``kept`` ranges: held are the
    ranges (hi, lo, row) of a node of level 1, above it the greatest upper
    bounds (hi) of the nodes below, in their order; ``FAN`` at most."""
    if level == 1:
        entry, below = F.struct(F.col("__hi").alias("hi"), F.col("__lo").alias("lo"), F.col("__row").alias("row")), table
    else:
        entry, below = F.struct(F.col("__hi").alias("hi")), _greatest(table, level - 1)
    return (below.groupBy(F.expr(f"__pos div {FAN}").alias("node"))
            .agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col("__pos").alias("pos"), entry.alias("entry")))), lambda e: e["entry"]).alias("held")))


def _greatest(table: DataFrame, level: int) -> DataFrame:
    return table.groupBy(F.expr(f"__pos div {FAN ** level}").alias("__pos")).agg(F.max("__hi").alias("__hi"))


def _top_node(df: DataFrame, table: DataFrame, n: int, depth: int) -> DataFrame:
    """``df`` with ``__node``: the topmost node whose greatest upper bound is
    the first to reach ``__v``. Buckets are closed below, nodes above, so
    both sides change sign. Beyond all bounds, and for NaN, no node is met."""
    m = -(-n // FAN ** depth)
    if m == 1:
        return df.withColumn("__node", F.lit(0).cast("long"))
    bounds = [0.0 - r["__hi"] for r in _greatest(table, depth).orderBy(F.desc("__pos")).collect()]  # TOP at most
    beyond = [-math.inf] if bounds[0] > -math.inf else []
    search = Bucketizer(splits=[*beyond, *bounds, math.inf], inputCol="__key", outputCol="__bucket", handleInvalid="keep")
    out = search.transform(df.withColumn("__key", F.lit(0.0) - F.col("__v")))
    return out.withColumn("__node", F.lit(m - 1 + len(beyond)) - F.col("__bucket").cast("long")).drop("__key", "__bucket")


def range_lookup(df: DataFrame, value: str, ranges: DataFrame, lo: str, hi: str, take: list[str],
                 default: dict | None = None, broadcast: int = BROADCAST) -> DataFrame:
    """``df`` with the ``take`` columns of the first range that holds
    ``value`` (lo <= value <= hi): the one with the smallest lower bound, then
    the smallest upper one, then the smallest ``take``. Where none does, and
    for a NULL value, ``default`` or NULL. An input column named like a taken
    one gives way."""
    table, n = kept(ranges, lo, hi, take)
    others = [F.col(f"`{c}`") for c in df.columns if c not in take]
    if not n:
        kinds = dict(ranges.dtypes)
        return df.select(*others, *[F.lit((default or {}).get(c)).cast(kinds[c]).alias(c) for c in take])
    depth = 1
    while -(-n // FAN ** depth) > TOP:
        depth += 1
    out = _top_node(df.withColumn("__v", F.col(f"`{value}`").cast("double")), table, n, depth)
    for level in range(depth, 0, -1):
        side = nodes(table, level).withColumnsRenamed({"node": f"__n{level}", "held": f"__h{level}"})
        few = n // FAN ** (level - 1) <= broadcast
        out = out.join(F.broadcast(side) if few else side, F.col("__node") == F.col(f"__n{level}"), "left")
        if level > 1:
            passed = F.size(F.filter(f"__h{level}", lambda r: r["hi"] < F.col("__v")))
            out = out.withColumn("__node", F.col("__node") * FAN + passed).drop(f"__n{level}", f"__h{level}")
    first = F.get(F.filter("__h1", lambda r: r["hi"] >= F.col("__v")), 0)
    out = out.withColumn("__first", F.when(first["lo"] <= F.col("__v"), first))
    return out.select(*others, *[F.coalesce(F.col("__first.row")[c], F.lit((default or {}).get(c))).alias(c) for c in take])
