"""Language identification by a byte convolutional network.

Filters of widths 2, 3 and 4 slide over a fixed-length window of bytes; each
filter keeps its maximum over the window, and a softmax layer turns the
maxima into languages. Trained with numpy (Adam, cross entropy) on at most
``MAX_PER_LANG`` documents per language, those with the smallest id hashes,
one window each. A text is cut into overlapping windows that cover all its
bytes; its language has the largest mean probability, windows weighted by
letters.

Bytes are discrete, so a filter is a table per byte offset; tables of two
neighbouring bytes are summed beforehand, and a window position costs three
table reads instead of nine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql import Window as W

from healthmart.llm.common import held_out, pack, table, text_bytes, unpack

WINDOW, FILTERS, WIDTHS = 192, 8, (2, 3, 4)
STRIDE = WINDOW - max(WIDTHS) + 1
MAX_PER_LANG = 1500
STRATUM = 500  # documents of one language and stratum; Spark cuts a group before its shuffle up to a rank of 1000
BATCH = 2048  # windows that are evaluated at once
FOLDS, HELD = 3, 1

LETTER = np.zeros(256, np.float32)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


@dataclass
class Net:
    langs: list[str]
    conv: list[np.ndarray]  # per width: (width, 256, FILTERS)
    bias: np.ndarray        # (3 * FILTERS,)
    out: np.ndarray         # (3 * FILTERS, languages)
    out_bias: np.ndarray

    def __post_init__(self):
        two, three, four = self.conv
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        self.head = np.hstack([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])]).astype(np.float32)
        self.third = three[2].astype(np.float32)
        self.tail = pair(four[2], four[3]).astype(np.float32)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(n, WINDOW) bytes to (n, languages)."""
        x = np.ascontiguousarray(windows.T)
        code = x[:-1].astype(np.int64) * 256 + x[1:]
        f, n = FILTERS, x.shape[1]
        best = np.full((n, 3 * f), -np.inf, np.float32)
        for p in range(len(x) - 3):
            act = self.head[code[p]]
            act[:, f:2 * f] += self.third[x[p + 2]]
            act[:, 2 * f:] += self.tail[code[p + 2]]
            np.maximum(best, act, out=best)
        z = np.maximum(best + self.bias, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def cut_windows(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, start) of the windows that cover every text; an empty text
    has none."""
    size = np.diff(off)
    per = np.where(size > 0, np.maximum(1, -(-(size - (WINDOW - STRIDE)) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(size)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    return doc, off[doc] + nth * STRIDE


def read_windows(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bytes of windows, zero beyond ``end``."""
    at = start[:, None] + np.arange(WINDOW)
    got = data[np.minimum(at, len(data) - 1)]
    got[at >= end[:, None]] = 0
    return got


def fit(windows: np.ndarray, langs: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Net:
    names = sorted(set(langs.tolist()))
    y = np.searchsorted(names, langs)
    rng = np.random.default_rng(seed)
    conv = [rng.normal(0, 0.3, (w, 256, FILTERS)) for w in WIDTHS]
    k = len(WIDTHS) * FILTERS
    params = [*conv, np.zeros(k), rng.normal(0, 0.3, (k, len(names))), np.zeros(len(names))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    weight = len(y) / (len(names) * np.bincount(y, minlength=len(names)))  # languages count alike
    t = 0
    for _ in range(epochs if len(names) > 1 else 0):
        order = rng.permutation(len(y))
        for a in range(0, len(y), batch):
            idx = order[a:a + batch]
            x, n = windows[idx].astype(np.int64), len(idx)
            best, arg = [], []
            for w, c in zip(WIDTHS, params[:3], strict=True):
                act = sum(c[o][x[:, o:WINDOW - w + 1 + o]] for o in range(w))
                arg.append(act.argmax(1))
                best.append(act.max(1))
            h = np.hstack(best) + params[3]
            r = np.maximum(h, 0)
            z = r @ params[4] + params[5]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), y[idx]] -= 1
            p *= weight[y[idx]][:, None] / n
            gh = (p @ params[4].T) * (h > 0)
            grads = []
            for i, (w, c) in enumerate(zip(WIDTHS, params[:3], strict=True)):
                g = np.zeros_like(c)
                up = gh[:, i * FILTERS:(i + 1) * FILTERS]
                for o in range(w):
                    np.add.at(g[o], (x[np.arange(n)[:, None], arg[i] + o], np.arange(FILTERS)[None, :]), up)
                grads.append(g)
            grads += [gh.sum(0), r.T @ p, p.sum(0)]
            t += 1
            for q, g, (m, v) in zip(params, grads, moments, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                q -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Net(names, params[:3], params[3].astype(np.float32), params[4].astype(np.float32), params[5].astype(np.float32))


def _one_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, off = text_bytes(b.column(2))
        size = np.diff(off)
        lot = b.column(0).to_numpy().astype(np.uint64)
        start = off[:-1] + (lot % np.maximum(size - WINDOW + 1, 1).astype(np.uint64)).astype(np.int64)
        win = read_windows(data, start, off[1:]) if len(data) else np.zeros((len(size), WINDOW), np.uint8)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([w.tobytes() for w in win], pa.binary())],
                                         ["lot", "lang", "win"])


def train(docs: DataFrame, max_per_lang: int = MAX_PER_LANG) -> Net | None:
    """Fit on (doc_id, text, lang) of the learning fold; None if it has no
    labelled text."""
    learn = docs.where(~held_out(F.col("doc_id"), FOLDS, HELD) & F.col("lang").isNotNull() & (F.length("text") > 0))
    # equal shares of hashed strata: a share this small lets Spark cut each
    # group before the shuffle, so a hot language never meets in one task
    strata = -(-max_per_lang // STRATUM)
    rank = F.row_number().over(W.partitionBy("lang", F.pmod("lot", F.lit(strata))).orderBy("lot", "doc_id"))
    ids = learn.select("doc_id", "lang", F.xxhash64("doc_id").alias("lot"))
    chosen = (ids.withColumn("rank", rank).where(F.col("rank") <= max_per_lang // strata)
              .select("doc_id", "lot").distinct())
    # at most max_per_lang ids of each language: a bounded broadcast
    got = (learn.join(F.broadcast(chosen), "doc_id").select("lot", "lang", "text")
           .mapInArrow(_one_window, "lot long, lang string, win binary").toArrow())
    if not got.num_rows:
        return None
    win = np.frombuffer(b"".join(got["win"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    langs, lot = np.array(got["lang"].to_pylist()), got["lot"].to_numpy()
    order = np.lexsort((*win.T[:4], lot))  # row order must not depend on task order
    return fit(win[order], langs[order])


def identify(df: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` plus lang_pred and score. A NULL text, or one without a letter,
    is ``und`` with score 0; so is every text if nothing could be learned."""
    packed = pack(df, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for b in batches:
            text = b.column(b.schema.get_field_index("text"))
            data, off = text_bytes(text)
            lettered = np.array(pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_pylist(), bool)
            n, names = len(off) - 1, net.langs if net else ["und"]
            total, weight = np.zeros((n, len(names))), np.zeros(n)
            doc, start = cut_windows(data, off)
            for a in range(0, len(doc) if net else 0, BATCH):
                d, s = doc[a:a + BATCH], start[a:a + BATCH]
                win = read_windows(data, s, off[1:][d])
                letters = LETTER[win].sum(1) + 1e-3
                np.add.at(total, d, net.probabilities(win) * letters[:, None])
                np.add.at(weight, d, letters)
            mean = total / np.maximum(weight, 1e-9)[:, None]
            known = lettered & (weight > 0)
            pred = np.where(known, np.array(names)[mean.argmax(1)] if n else "und", "und")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pred.tolist(), pa.string()), pa.array(np.where(known, np.minimum(mean.max(1), 1.0), 0.0) if n else [], pa.float64())],
                ["row", "lang_pred", "score"])

    schema = StructType([packed.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    out = packed.select("row", "text").mapInArrow(run, schema)
    return unpack(out, df, added={"lang_pred": F.col("lang_pred"), "score": F.col("score")})


def op7_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    net = train(docs.select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), net).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "lang_pred", "score")
