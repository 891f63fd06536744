"""Lineage cuts between pipeline stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from healthmart.session import ensure_checkpoint_dir


def checkpoint(df: DataFrame, eager: bool = True, observe: dict | None = None):
    """Cut lineage by writing ``df`` as a Parquet table under the shared
    checkpoint folder (``spark.checkpoint.dir``) and reading it back.

    Used where several scalars (medians, quartiles, min/max) or two passes
    (dense ids) read the same intermediate: every later read is a plain
    columnar scan instead of a recomputation of joins and shuffles, and a
    lost executor never sends the job back to the raw inputs. Compared to
    ``Dataset.checkpoint`` this is one job (no second evaluation to save
    the RDD), stores columns compressed, and the read-back carries file
    sizes for the optimizer. ``eager`` is accepted for API symmetry; the
    write always happens now.

    ``observe`` maps names to aggregate Columns computed while the rows are
    written (Spark ``Observation``): statistics a later step needs come out
    of the same job instead of another pass over the table. With it, the
    result is ``(frame, {name: value})``.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{uuid.uuid4().hex}"
    obs = None
    if observe:
        from pyspark.sql import Observation
        obs = Observation(f"cut_{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, *[c.alias(n) for n, c in observe.items()])
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    return (out, dict(obs.get)) if obs is not None else out
