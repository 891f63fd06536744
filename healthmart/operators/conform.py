"""Conformed layout, unions and dense surrogate ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from healthmart import schemas
from healthmart.operators.materialize import checkpoint

# Typed defaults for a column a source does not have.
CONFORM_DEFAULTS = {
    "gender_code": -1,
    "outcome_flag": 0,
    "disease_name": schemas.NOT_AVAILABLE,
}


def conform(df: DataFrame, source_name: str, mapping: dict[str, str] | None = None,
            layout=schemas.CONFORMED, keep=()) -> DataFrame:
    """Project ``df`` onto ``layout``.

    ``mapping`` maps a layout column to the source column that feeds it
    (identity when the names agree). Missing columns become the typed
    default (NULL, -1, 0 or 'N/A'); ``source`` is the literal tag. Columns
    in ``keep`` ride along (order keys for id assignment). Values stay on
    their own rows: this is a plain projection.
    """
    mapping = mapping or {}
    out = []
    for f in layout.fields:
        if f.name == "source":
            out.append(F.lit(source_name).cast(f.dataType).alias("source"))
            continue
        src = mapping.get(f.name, f.name)
        if src is not None and src in df.columns:
            out.append(F.col(f"`{src}`").try_cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(CONFORM_DEFAULTS.get(f.name)).cast(f.dataType).alias(f.name))
    out += [F.col(f"`{k}`") for k in keep if k not in layout.fieldNames()]
    return df.select(*out)


def union_all(*dfs: DataFrame, allow_missing: bool = True) -> DataFrame:
    """UNION ALL by column name, NULL-filling missing columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def dense_ids(df: DataFrame, order_by, id_col: str, partitions: int | None = None,
              start: int = 1, observe: dict | None = None):
    """Dense ids start..start+n-1 following a total order ``order_by``.

    Distributed prefix sum: range-partition on the order (sampled bounds,
    so a skewed leading column still splits on the later ones), sort within
    partitions and tag every row with (partition, position). The tagged
    frame is checkpointed so both passes see the same partitioning. Pass
    one counts rows per partition (one row per partition), a running sum
    over that tiny table gives each partition's offset, pass two adds the
    broadcast offset to the position. No task ever holds more than its
    own range. With ``observe`` (name -> aggregate Column) the result is
    (frame, values), the values observed while the tagged frame is written.
    """
    order = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_by]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn("__mid", F.monotonically_increasing_id()))
    seen = None
    if observe:
        tagged, seen = checkpoint(tagged, observe=observe)
    else:
        tagged = checkpoint(tagged)
    part = F.shiftright(F.col("__mid"), 33)
    counts = tagged.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    pos = F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))
    out = (tagged.join(F.broadcast(offsets), part == F.col("__p"))
                 .withColumn(id_col, (F.col("__off") + pos + F.lit(start)).cast("long")))
    out = out.select(id_col, *[F.col(f"`{c}`") for c in df.columns if c != id_col])
    return (out, seen) if observe else out


def renumber_dense(df: DataFrame, dense_col: str, id_col: str, bucket_rows: int | None = None,
                   start: int = 1, max_buckets: int = 1 << 16) -> DataFrame:
    """W3 for a frame whose ``dense_col`` holds unique integers with gaps
    (rows removed after numbering): new ids start..start+n-1 in the same
    order.

    Buckets are fixed-width slices of ``dense_col`` (each holds at most
    ``bucket_rows`` rows, since the values are unique), so no sampling or
    checkpoint is needed: count per bucket, running sum over the bucket
    table, row_number within each bucket. Without ``bucket_rows`` the width
    is chosen from the value range (one aggregate) so that the bucket table
    -- the only broadcast side -- never exceeds ``max_buckets`` rows.
    """
    if bucket_rows is None:
        rng = df.agg(F.min(dense_col).alias("lo"), F.max(dense_col).alias("hi")).first()
        span = 0 if rng.lo is None else int(rng.hi) - int(rng.lo) + 1
        bucket_rows = max(1 << 20, -(-span // max_buckets))
    b = F.floor(F.col(dense_col) / F.lit(bucket_rows)).cast("long")
    tagged = df.withColumn("__b", b)
    counts = tagged.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__b", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    within = Window.partitionBy("__b").orderBy(dense_col)
    out = (tagged.join(F.broadcast(offsets), "__b")
                 .withColumn(id_col, (F.col("__off") + F.row_number().over(within) + F.lit(start - 1)).cast("long")))
    return out.select(id_col, *[F.col(f"`{c}`") for c in df.columns if c != id_col])
