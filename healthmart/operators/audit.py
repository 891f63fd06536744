"""Stage audit.

The flows record what their own writes observed (rows, before, after,
removed) and the wall-clock time around them; no row is counted by a pass of
its own. ``stage_counts`` and ``before_after`` count any frames, by a pass.
Stage records of differing layouts are united by name.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_counts(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, rows, cols) for each named frame, counted on the
    executors; each count is a global aggregate with partial counts per
    task."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("rows"))
               .select(F.lit(name).alias("stage"), "rows", F.lit(len(df.columns)).alias("cols"))
             for name, df in stages]
    return reduce(DataFrame.unionByName, parts)


def before_after(stage: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """(stage, before, after, removed) from two frames."""
    b = before.agg(F.count(F.lit(1)).cast("long").alias("before"))
    a = after.agg(F.count(F.lit(1)).cast("long").alias("after"))
    return b.crossJoin(a).select(F.lit(stage).alias("stage"), "before", "after",
                                 (F.col("before") - F.col("after")).alias("removed"))


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, NULLs, distinct count (approximate
    sketch, bounded memory), from one aggregate pass."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        q = F.col(f"`{c}`")
        aggs += [F.count_if(q.isNull()).alias(f"__n{i}"), F.approx_count_distinct(q).alias(f"__d{i}")]
    one = df.agg(*aggs)
    types = dict(df.dtypes)
    rows = [F.struct(F.lit(i).alias("cid"), F.lit(c).alias("name"), F.lit(types[c]).alias("type"),
                     F.col("__rows").cast("long").alias("rows"), F.col(f"__n{i}").cast("long").alias("nulls"),
                     F.col(f"__d{i}").cast("long").alias("approx_distinct"))
            for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


class StageLog:
    """Collects stage records (any keys) and renders them as one frame."""

    def __init__(self):
        self.records: list[dict] = []

    def log(self, stage: str, **detail):
        """Add a record, or add to the stage's own where that has none of
        these details yet."""
        mine = next((r for r in self.records if r["stage"] == stage and not set(detail) & set(r)), None)
        if mine is None:
            mine = {"stage": stage}
            self.records.append(mine)
        mine.update(timestamp=time.strftime("%Y-%m-%dT%H:%M:%S"), **detail)
        return mine

    def timed(self, stage: str, fn, spark: SparkSession | None = None, **detail):
        """Run ``fn`` as stage ``stage``: its Spark jobs carry the stage name
        as job description (event logs and status trackers show it) and
        the wall time is recorded."""
        spark = spark or SparkSession.getActiveSession()
        sc = spark.sparkContext if spark is not None else None
        if sc is not None:
            sc.setJobDescription(stage)
        t0 = time.perf_counter()
        try:
            out = fn()
        finally:
            if sc is not None:
                sc.setJobDescription(None)
        self.log(stage, duration_s=round(time.perf_counter() - t0, 3), **detail)
        return out

    def rows(self, stage: str, rows: int, before: int | None = None):
        """Row counts of a stage, as the job that wrote it observed them:
        ``rows``, and with ``before`` also before, after and removed."""
        if before is None:
            return self.log(stage, rows=rows)
        return self.log(stage, rows=rows, before=before, after=rows, removed=before - rows)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The records, one frame per layout, united by name (missing
        -> NULL). Whole numbers are long, other numbers double, the rest (and
        a key whose values disagree) text."""
        def kind(values) -> str:
            known = {bool if isinstance(v, bool) else type(v) for v in values if v is not None}
            return "long" if known == {int} else "double" if known and known <= {int, float} else "string"

        if not self.records:
            return spark.createDataFrame([], "stage string, timestamp string")
        keys = list(dict.fromkeys(k for r in self.records for k in r))
        types = {k: kind([r.get(k) for r in self.records]) for k in keys}
        cast = {"long": int, "double": float, "string": str}
        layouts: dict[tuple, list] = {}
        for n, r in enumerate(self.records):
            layouts.setdefault(tuple(r), []).append((n, *[None if v is None else cast[types[k]](v) for k, v in r.items()]))
        frames = [spark.createDataFrame(rows, ", ".join(["nr int", *[f"`{k}` {types[k]}" for k in layout]]))
                  for layout, rows in layouts.items()]
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return union.orderBy("nr").select(*[F.col(f"`{k}`") for k in keys])

    def write(self, spark: SparkSession, base: str, name: str = "audit") -> DataFrame:
        """The records as a stored table and as one CSV file beside it
        (``<name>_csv``); returns the stored table."""
        from healthmart.sources import files
        frame = self.to_frame(spark).coalesce(1)
        files.write_table(frame, base, name)
        files.write_csv(frame, base, f"{name}_csv", null_text="")
        return files.read_table(spark, base, name)
