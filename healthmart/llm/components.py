"""Connected components as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from healthmart.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); label is the smallest
    node of its component.

    Each round hooks every label to its smallest neighbouring label, which
    makes a forest, then halves the depth of that forest until it is flat,
    and rewrites the edges by the new labels. Rounds grow with the logarithm
    of the components. All steps are joins and combinable minima on cut
    tables; nothing is collected but counts.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    live = cut(pairs)
    labels = None
    while not live.isEmpty():
        up = cut(live.groupBy("hi").agg(F.min("lo").alias("to")))
        while True:  # up: hi -> to, to < hi
            step = up.alias("u").join(up.alias("v"), F.col("u.to") == F.col("v.hi"), "left").select(
                F.col("u.hi"), F.coalesce("v.to", "u.to").alias("to"), F.col("v.to").isNotNull().alias("moved"))
            step = cut(step)
            up = step.drop("moved")
            if step.where("moved").isEmpty():
                break
        new = up.select(F.col("hi").alias("node"), F.col("to").alias("label"))
        if labels is not None:  # nodes below a label that was hooked follow it
            moved = labels.join(up, F.col("label") == F.col("hi"), "left").select("node", F.coalesce("to", "label").alias("label"))
            new = moved.unionByName(new).groupBy("node").agg(F.min("label").alias("label"))
        labels = cut(new)
        live = cut(_relabel(live, up))
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0)
    roots = labels.select(F.col("label").alias("node"), "label").distinct()
    return cut(labels.unionByName(roots).groupBy("node").agg(F.min("label").alias("label")))


def _relabel(live: DataFrame, up: DataFrame) -> DataFrame:
    one = live.join(up.select(F.col("hi").alias("h1"), F.col("to").alias("t1")), F.col("hi") == F.col("h1"), "left").select(
        F.coalesce("t1", "hi").alias("x"), "lo")
    two = one.join(up.select(F.col("hi").alias("h2"), F.col("to").alias("t2")), F.col("lo") == F.col("h2"), "left").select(
        "x", F.coalesce("t2", "lo").alias("y"))
    return two.where("x <> y").select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct()
