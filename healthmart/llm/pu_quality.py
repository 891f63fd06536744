"""Quality classifier by positive-unlabelled learning.

A logistic model over byte-class features is fitted to the non-negative
unbiased risk ``p R+(P) + max(0, R-(U) - p R-(P))``: P are texts trusted to
be good, U unlabelled web text, p the class prior. The prior is the share
of good rows among the labels of the learning fold. Fitting uses at most
``MAX_POSITIVE`` and ``MAX_UNLABELLED`` rows, those with the smallest id
hashes; scoring reads every whole text in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from healthmart.llm.common import held_out, lean, pack, table, text_bytes, unpack

MAX_POSITIVE, MAX_UNLABELLED = 4000, 8000
FOLDS, HELD = 5, 0
THRESHOLD = 0.3
BLOCK = 1 << 20  # bytes of text that are counted at once


def _byte_classes() -> np.ndarray:
    """256 bytes to 16 classes: lower, upper, digit, blank, newline, seven
    single marks, quotes and brackets, symbols, control, beyond ASCII."""
    c = np.full(256, 13, np.uint8)
    for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r",
                               ".", ",", "!", "?", "|", ":;", "-_/", "\"'()[]{}<>")):
        c[[ord(x) for x in chars]] = k
    c[:32] = np.where(np.isin(np.arange(32), (10, 13)), 4, 14)
    c[127] = 14
    c[128:] = 15
    return c


CLASSES = _byte_classes()
N_FEATURES = 16 + 256 + 3


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Square roots of the shares of byte classes and of pairs of classes,
    log length, log mean run between blanks and the share of word pairs that
    are the first of their kind; an empty text has zeros and a share of 1."""
    n = len(off) - 1
    size = np.diff(off)
    pair = np.zeros((n, 256))
    flat = pair.reshape(-1)
    for a in range(0, len(data), BLOCK):  # long texts are counted block by block
        part = CLASSES[data[a:a + BLOCK + 1]]
        m = min(BLOCK, len(part))
        doc = np.searchsorted(off, np.arange(a, a + m), "right") - 1 if n < 2 else np.repeat(
            np.arange(n), np.clip(off[1:], a, a + m) - np.clip(off[:-1], a, a + m))
        nxt = np.append(part[1:m + 1], 0)[:m] if len(part) <= m else part[1:m + 1]
        key = part[:m].astype(np.int64) * 16 + nxt
        last = off[1:][size > 0] - 1  # a pair never reaches into the next text: it pairs with a blank
        inside = last[(last >= a) & (last < a + m)] - a
        key[inside] = part[inside].astype(np.int64) * 16 + 3
        flat += np.bincount(doc * 256 + key, minlength=n * 256)
    total = np.maximum(size, 1)[:, None]
    single = pair.reshape(n, 16, 16).sum(2)
    gap = np.log((size + 1) / (single[:, 3] + single[:, 4] + 1))
    fresh = np.ones(n)
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        w = data[a:b].tobytes().split()
        if len(w) > 1:
            fresh[i] = len(set(zip(w, w[1:], strict=False))) / (len(w) - 1)
    return np.hstack([np.sqrt(single / total), np.sqrt(pair / total), np.log1p(size)[:, None] / 10, gap[:, None],
                      fresh[:, None]])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(((x - self.mean) / self.scale) @ self.w + self.b, -40, 40)
        return 1 / (1 + np.exp(-z))


def fit_nnpu(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int = 400, rate: float = 0.02,
             decay: float = 1e-3) -> Model:
    """Full-batch Adam on the non-negative risk with logistic loss. Where the
    negative part of the risk falls below zero, the step undoes it instead,
    as the estimator prescribes. Without positives or unlabelled rows the
    model is the prior."""
    d = xp.shape[1] if xp.size else xu.shape[1] if xu.size else N_FEATURES
    if not len(xp) or not len(xu):
        return Model(np.zeros(d), np.ones(d), np.zeros(d), float(np.log(prior / (1 - prior))), prior)
    mean, scale = xu.mean(0), xu.std(0) + 0.02
    p, u = (xp - mean) / scale, (xu - mean) / scale
    w, b = np.zeros(d), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(d + 1), np.zeros(d + 1)
    for t in range(1, steps + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(x @ w + b, -40, 40))) for x in (p, u))
        negative = -np.log(1 - su + 1e-12).mean() + prior * np.log(1 - sp + 1e-12).mean()
        # gradients by the margin: of R+(P), and of R-(U) - prior R-(P)
        gp, gn_p, gn_u = -prior * (1 - sp) / len(p), -prior * sp / len(p), su / len(u)
        if negative < 0:
            gp, gn_p, gn_u = 0 * gp, -gn_p, -gn_u
        at_p = gp + gn_p
        g = np.append(p.T @ at_p + u.T @ gn_u + decay * w, at_p.sum() + gn_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(mean, scale, w, float(b), prior)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(*text_bytes(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["kind", "x"])


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Fit on (doc_id, text) and (doc_id, quality), learning fold only. An
    id with several labels counts as good if any of them is 1."""
    learn = lambda df: df.where(~held_out(F.col("doc_id"), FOLDS, HELD))
    marks = learn(labels).where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n1, n = marks.agg(F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)), F.count(F.lit(1))).first()
    prior = ((n1 or 0) + 1) / (n + 2)
    order = F.xxhash64("doc_id")
    ids = learn(docs.select("doc_id")).where("doc_id is not null").distinct()
    good = ids.join(marks.where("quality = 1"), "doc_id", "left_semi").orderBy(order).limit(max_positive)
    plain = ids.join(marks, "doc_id", "left_anti").orderBy(order).limit(max_unlabelled)
    chosen = good.withColumn("kind", F.lit(1)).unionByName(plain.withColumn("kind", F.lit(0)))
    # at most max_positive + max_unlabelled ids: a bounded broadcast
    rows = docs.join(F.broadcast(chosen), "doc_id").select("kind", "text").mapInArrow(lean(_featurise), "kind int, x array<double>").toArrow()
    kind = rows["kind"].to_numpy()
    x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
    x = x[o := np.lexsort((*x.T[:8], kind))]  # row order must not depend on task order
    kind = kind[o]
    return fit_nnpu(x[kind == 1], x[kind == 0], prior)


def score_quality(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` plus score (0 to 1) and predicted (score >= 0.3). NULL texts
    count as empty and are scored; other columns pass through untouched."""
    packed = pack(df, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            s = shared.value.score(features(*text_bytes(batch.column(at))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["row", "score"])

    schema = StructType([packed.schema["row"], StructField("score", DoubleType())])
    out = packed.select("row", "text").mapInArrow(lean(run), schema)
    return unpack(out, df, added={"score": F.col("score"), "predicted": (F.col("score") >= THRESHOLD).cast("int")})


def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "score", "predicted")
