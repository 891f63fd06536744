"""Exact top-k search by inner product with a pivot-distance index.

Vectors of integers are lifted by one coordinate so that the largest inner
product becomes the smallest Euclidean distance: with M the largest norm,
x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give |x' - q'|^2 = |q|^2 + M^2 - 2 q.x.
Every vector is keyed by its nearest pivot and the distance to it; sorted by
that key and cut into blocks, each block is a piece of an annulus around one
pivot. Queries start with the annuli around their own key, which yields k
candidates and so a radius; the triangle inequality then says which other
annuli can still hold a vector within it, |d(q, p) - d(x, p)| <= radius, and
only those are scanned. Scores are exact integers; bounds carry a margin for
rounding, and an annulus that could hold a tie is scanned.

Nothing about all vectors is broadcast or collected but the largest norm.
Blocks have bounded rows, so one vector that a third of all rows repeat is
many blocks. Pivots come from a bounded sample (``PIVOTS`` rows with the
smallest id hashes); they steer speed only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from healthmart.llm.common import cut, quoted, table

PIVOTS, BLOCK, TOP = 32, 1024, 20
SCALE, EVERY = 64, 20


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v array<long>) of the rows whose vector can be used: not NULL,
    without NULL or non-finite components. An empty vector scores 0."""
    x = F.col(quoted(vector_col)).cast("array<double>")
    ok = F.coalesce(F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))), F.lit(False))
    return (df.select(F.col(quoted(id_col)).cast("long").alias("id"), x.alias("x")).where(ok & F.col("id").isNotNull())
            .select("id", F.transform("x", lambda c: F.floor(c * scale)).alias("v")))


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of an array column as a matrix; shorter vectors end in zeros,
    which changes no inner product."""
    rows = [np.asarray(v, np.int64) for v in col.to_pylist()]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


def _width(a: np.ndarray, n: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, n - a.shape[1]))) if a.shape[1] < n else a


def _keyed(pivots: np.ndarray, largest: float):
    """Nearest pivot and distance to it, and distances of the vector as a
    query to all pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.astype(float)
        lift = np.sqrt(np.maximum(largest - (p * p).sum(1), 0))
        for b in batches:
            x = _width(_matrix(b.column(1)), p.shape[1]).astype(float)
            norm = (x * x).sum(1)
            flat = norm[:, None] + (p * p).sum(1) - 2 * x @ p.T
            up = np.sqrt(np.maximum(largest - norm, 0))
            d = np.sqrt(np.maximum(flat + (up[:, None] - lift) ** 2, 0))
            near = d.argmin(1)
            q = np.sqrt(np.maximum(flat + lift ** 2, 0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]),
                 pa.array(list(q), pa.list_(pa.float64()))], ["id", "v", "pivot", "dist", "seen"])
    return run


_INDEX = "block string, pivot int, lo double, hi double, ids binary, vecs binary, dim int"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to blocks of one pivot and at most ``BLOCK`` rows."""
    from pyspark import TaskContext
    part, nth = TaskContext.get().partitionId(), 0
    for b in batches:
        x, pivot, dist = _matrix(b.column(1)), b.column(2).to_numpy(), b.column(3).to_numpy()
        ids = b.column(0).to_numpy()
        heads = np.flatnonzero(np.append(True, pivot[1:] != pivot[:-1])) if len(ids) else []
        for i, j in zip(heads, [*heads[1:], len(ids)], strict=True):
            for a in range(i, j, BLOCK):
                z = min(a + BLOCK, j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{part}-{nth}"]), pa.array([int(pivot[a])], pa.int32()), pa.array([dist[a:z].min()]), pa.array([dist[a:z].max()]),
                     pa.array([ids[a:z].tobytes()], pa.binary()), pa.array([x[a:z].tobytes()], pa.binary()), pa.array([x.shape[1]], pa.int32())],
                    ["block", "pivot", "lo", "hi", "ids", "vecs", "dim"])
                nth += 1


def _scan(top: int):
    """Best ``top`` of a block for every query of a query block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                dim = max(row["qdim"], row["dim"])
                q = _width(np.frombuffer(row["qvecs"], np.int64).reshape(-1, row["qdim"]), dim)
                x = _width(np.frombuffer(row["vecs"], np.int64).reshape(-1, row["dim"]), dim)
                qid, xid = np.frombuffer(row["qids"], np.int64), np.frombuffer(row["ids"], np.int64)
                score = _product(q, x)
                out = []
                for i in range(len(qid)):
                    s, ids = score[i], xid
                    if len(s) > 2 * top:  # everything that ties with the last place stays
                        k = s >= np.partition(s, len(s) - top - 1)[len(s) - top - 1]
                        s, ids = s[k], ids[k]
                    other = ids != qid[i]
                    s, ids = s[other], ids[other]
                    by = np.lexsort((ids, -s))[:top]
                    out.append((np.full(len(by), qid[i]), ids[by], s[by]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[c] for o in out])) for c in range(3)],
                                                 ["query_id", "vec_id", "score"])
    return run


def _product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products; by way of floating point where those are
    exact too."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(q.shape[1], 1)
    if most < 2.0 ** 53:
        return np.rint(q.astype(float) @ x.astype(float).T).astype(np.int64)
    return q @ x.T


def _best(rows: DataFrame, top: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def top_k(rows: DataFrame, queries, top: int = TOP, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` largest inner products of
    every query row (``queries``: a condition on id) with all other rows;
    ties go to the smaller id. ``rows`` are (id, v array<long>). Rows that
    repeat an id with the same vector count once."""
    rows = cut(rows)
    largest, n = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))), F.count(F.lit(1))).first()
    if not n:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")).limit(0)
    sample = rows.select("v").orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    p = _matrix(pa.array([r["v"] for r in sample], pa.list_(pa.int64())))
    keyed = cut(rows.mapInArrow(_keyed(p, float(largest)), "id long, v array<long>, pivot int, dist double, seen array<double>")
                .repartitionByRange("pivot", "dist", "id").sortWithinPartitions("pivot", "dist", "id")
                .withColumn("is_query", queries))
    index = cut(keyed.select("id", "v", "pivot", "dist").mapInArrow(_blocks, _INDEX))
    ask = keyed.where("is_query")
    # query blocks: neighbours by key, so their annuli are alike
    asked = cut(ask.select("id", "v", "pivot", "dist").mapInArrow(_blocks, _INDEX)
                .select(F.concat(F.lit("q"), "block").alias("qblock"), F.col("pivot").alias("qpivot"), F.col("lo").alias("qlo"), F.col("hi").alias("qhi"),
                        F.col("ids").alias("qids"), F.col("vecs").alias("qvecs"), F.col("dim").alias("qdim")))
    ids = asked.mapInArrow(_members, "qblock string, id long")
    spread = cut(ask.select("id", F.posexplode("seen").alias("pivot", "d")).join(ids, "id")
                 .groupBy("qblock", "pivot").agg(F.min("d").alias("dlo"), F.max("d").alias("dhi")))
    directory = index.select("block", "pivot", "lo", "hi")

    def scan(pairs: DataFrame) -> DataFrame:
        work = pairs.join(asked.drop("qpivot", "qlo", "qhi"), "qblock").join(index.drop("pivot", "lo", "hi"), "block")
        return work.select("qids", "qvecs", "qdim", "ids", "vecs", "dim").mapInArrow(_scan(top), "query_id long, vec_id long, score long")

    # first annuli: those of the queries' own pivot that meet their own distances
    near = (asked.select("qblock", "qpivot", "qlo", "qhi").join(directory, F.col("qpivot") == F.col("pivot"))
            .where("lo <= qhi and hi >= qlo").select("qblock", "block"))
    near = cut(near)
    first = cut(_best(scan(near), top))
    bound = (first.where(F.col("rank") == top).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
             .join(ask.select("id", "v"), "id")
             .select("id", (F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")) + F.lit(float(largest))
                            - 2.0 * F.col("kth")).alias("r2")))
    # a query without k candidates so far has no bound; one in a block frees the whole block
    radius = (ids.join(bound, "id", "left").groupBy("qblock").agg(F.max(F.coalesce("r2", F.lit(float("inf")))).alias("r2"))
              .select("qblock", (F.sqrt(F.greatest("r2", F.lit(0.0))) * (1 + 1e-9) + 1e-6 * (1 + float(largest) ** 0.5)).alias("r")))
    rest = (spread.join(radius, "qblock").join(directory, "pivot").where("lo <= dhi + r and hi >= dlo - r")
            .select("qblock", "block").join(near, ["qblock", "block"], "left_anti"))
    return _best(first.drop("rank").unionByName(scan(rest)), top).select("query_id", "rank", "vec_id", "score")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for name, ids in zip(b.column(0).to_pylist(), b.column(b.schema.get_field_index("qids")).to_pylist(), strict=True):
            m = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(m), pa.string()), pa.array(m)], ["qblock", "id"])


def op2_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest by inner product of every twentieth embedding."""
    rows = quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(rows, F.pmod(F.col("id"), F.lit(EVERY)) == 0)


OP2_SQL = f"""
WITH usable AS (
  SELECT vec_id, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored) WHERE r <= {TOP}
"""
