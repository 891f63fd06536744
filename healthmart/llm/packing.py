"""Vector best-fit packing of token sequences.

A piece is a vector of resources: tokens, documents (1) and attention cost
(tokens squared). All three follow from its length, so the pieces of one
length are interchangeable and the whole problem is the histogram of
lengths: at most ``capacity`` counts, whatever the table. The driver packs
that histogram, longest first: of the open bins (grouped by what is left of
every resource) that can take the piece under every constraint, it selects
by weighted residual norm (smallest norm of what would be left) or by weighted
dot-product (largest match of piece and what is left). All three residuals,
as shares of their capacities, select with equal weights unless told
otherwise: among bins that the piece fills about alike, the ones short of
documents or attention go first. A sequence of ``capacity`` tokens cannot hold
more documents or attention cost than the default bounds, so only tokens bind
unless smaller bounds are given. Runs of equal pieces go into runs of equal
bins, so a plan is a short list of (length, ranks, sequences, offset) runs.

The rows never meet in one place: pieces are range-sorted by (length, id,
piece), numbered within (partition, length), shifted by counts per partition,
and each finds its run by binary search in the plan. A hot length is many
range partitions, not one group.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import LongType, StructField, StructType

from healthmart.llm.common import cut, lean, quoted, table

CAPACITY = 2048
WEIGHTS = (1.0, 1.0, 1.0)  # of the residual tokens, documents and attention
_PLACE = ("sequence_id", "offset", "slot")


class Encoder:
    """Ids of the byte-level BPE vocabulary in ``vocab`` (tokenizers JSON).
    With ``ranks`` and ``pattern`` (the same vocabulary as merge ranks) the
    faster public reader of those is used; texts that hold a special token's
    string, and texts it refuses, go through the JSON."""

    def __init__(self, vocab: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(vocab)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks and pattern:
            import base64

            import tiktoken
            with open(ranks, "rb") as f:
                merge = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merge, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                return self.fast.encode_ordinary(text)
            except (KeyboardInterrupt, SystemExit, GeneratorExit):
                raise
            except BaseException:  # noqa: BLE001 - its regex engine panics on some very long runs, which is no Exception
                pass
        return self.slow.encode(text, add_special_tokens=False).ids


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(*key) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all of ``capacity``
    but the first, which takes the remainder."""
    k = max(1, -(-n // capacity))
    first = n - (k - 1) * capacity
    return [(0, first)] + [(first + i * capacity, capacity) for i in range(k - 1)]


def token_pieces(df: DataFrame, vocab: str, ranks: str | None = None, pattern: str | None = None,
                 capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = True,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, crc[, ids]) of every row; NULL text counts
    as empty, an empty text is one piece holding ``end_id``."""
    kind = df.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab, ranks, pattern)
        for b in batches:
            at, out = [], defaultdict(list)
            for row, text in enumerate(b.column(1).to_pylist()):
                ids = np.array(enc(text or "") + [end_id], "<u4")
                for piece, (start, n) in enumerate(cut_points(len(ids), capacity)):
                    part = ids[start:start + n]
                    at.append(row)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(n)
                    out["crc"].append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        out["ids"].append(part.astype(np.int32))
            cols = [b.column(0).take(pa.array(at, pa.int64())), pa.array(out["piece"], pa.int32())]
            cols += [pa.array(out[c], pa.int64()) for c in ("start", "length", "crc")]
            if with_ids:
                cols.append(pa.array(out["ids"], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, ["id", "piece", "start", "length", "crc", "ids"][:len(cols)])

    schema = f"id {kind}, piece int, start long, length long, crc long" + (", ids array<int>" if with_ids else "")
    return df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string")).mapInArrow(lean(encode), schema)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY, max_docs: int | None = None,
              max_attention: int | None = None, weights: tuple[float, float, float] = WEIGHTS,
              rule: str = "norm") -> list[tuple[int, int, int, int, int, int]]:
    """Pack ``counts`` pieces of each length. Returns runs (length, first
    rank, count, first bin, offset, slot): piece ``rank + i`` of that length
    goes to bin ``bin + i``. ``slot`` is its place among the bin's documents.

    Constraints: tokens <= capacity, documents <= max_docs, sum of squared
    lengths <= max_attention (None: no bound beyond what tokens imply).
    Lengths over a bound cannot be packed and raise ValueError.
    """
    docs = max_docs or capacity
    att = max_attention or capacity * capacity
    cap = np.array([capacity, docs, att], float)
    w = np.array(weights, float)
    # open bins by (tokens, documents, attention) left: runs of bin numbers
    bins: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    runs, n_bins = [], 0
    for length in sorted(counts, reverse=True):
        need = (length, 1, length * length)
        if length < 1 or any(n > c for n, c in zip(need, cap, strict=True)):
            raise ValueError(f"a piece of {length} tokens is beyond the capacities")
        rank, left = 0, counts[length]
        states = [s for s in bins if all(a >= b for a, b in zip(s, need, strict=True))]
        if states:
            rest = (np.array(states, float) - need) / cap
            if rule == "dot":
                score = -(np.array(states, float) / cap * (np.array(need) / cap) * w).sum(1)
            else:
                score = (w * rest * rest).sum(1)
            order = sorted(range(len(states)), key=lambda i: (score[i], states[i]))
            heap = [(score[i], states[i]) for i in order]
        else:
            heap = []
        while left:
            if heap:
                _, state = heap.pop(0)
            else:  # open as many new bins as this length can use at most
                per = min(capacity // length, docs, att // (length * length))
                fresh = -(-left // per)
                state = (capacity, docs, att)
                bins.setdefault(state, []).append((n_bins, fresh))
                n_bins += fresh
            pool, nxt = bins.pop(state), tuple(a - b for a, b in zip(state, need, strict=True))
            moved = []
            while pool and left:
                first, n = pool.pop(0)
                take = min(n, left)
                runs.append((length, rank, take, first, capacity - state[0], docs - state[1]))
                moved.append((first, take))
                rank, left = rank + take, left - take
                if take < n:
                    pool.insert(0, (first + take, n - take))
            if pool:
                bins[state] = pool
            if moved and nxt[0] > 0 and nxt[1] > 0 and nxt[2] > 0:
                bins.setdefault(nxt, []).extend(moved)
                if left and all(a >= b for a, b in zip(nxt, need, strict=True)):
                    rest = (np.array(nxt, float) - need) / cap
                    s = -(np.array(nxt) / cap * (np.array(need) / cap) * w).sum() if rule == "dot" else (w * rest * rest).sum()
                    heap = [x for x in heap if x[1] != nxt]
                    bisect.insort(heap, (float(s), nxt))
    return runs


def best_fit_pack(pieces: DataFrame, capacity: int = CAPACITY, max_docs: int | None = None,
                  max_attention: int | None = None, weights: tuple[float, float, float] = WEIGHTS,
                  rule: str = "norm") -> DataFrame:
    """``pieces`` (id, piece, length and whatever else) plus sequence_id,
    offset and slot; an input column of such a name gives way. Ties of equal
    lengths go by (id, piece); repeated rows are packed each. An empty table
    gives no rows."""
    spark = pieces.sparkSession
    # all input columns travel in one struct, whatever their names
    rows = pieces.select(F.struct(*[F.col(quoted(c)) for c in pieces.columns]).alias("row"), "length", "id", "piece")
    placed = cut(rows.repartitionByRange("length", "id", "piece").withColumn("part", F.spark_partition_id()))
    per = placed.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # range partitions: a length spans neighbours, so there are at most
    # partitions + capacity such counts
    before = per.withColumn("before", F.sum("n").over(
        W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    ranked = (placed.withColumn("rank", F.row_number().over(W.partitionBy("part", "length").orderBy("id", "piece")) - 1)
              .join(before.drop("n"), ["part", "length"])
              .select("row", F.col("length").cast("long").alias("length"), (F.col("rank") + F.coalesce("before", F.lit(0))).cast("long").alias("rank")))
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(plan_bins(counts, capacity, max_docs, max_attention, weights, rule) or np.empty((0, 6)), np.int64)
    runs = runs.reshape(-1, 6)[np.lexsort((runs.reshape(-1, 6)[:, 1], runs.reshape(-1, 6)[:, 0]))]
    shared = spark.sparkContext.broadcast(runs)  # runs depend on the lengths that occur, not on the rows
    stride = max(counts.values(), default=0) + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = shared.value
        key = r[:, 0] * stride + r[:, 1]
        for b in batches:
            length, rank = b.column(1).to_numpy(), b.column(2).to_numpy()
            k = np.searchsorted(key, length * stride + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(r[k, 3] + rank - r[k, 1]), pa.array(r[k, 4]), pa.array(r[k, 5])],
                                             ["row", *_PLACE])

    schema = StructType([ranked.schema["row"], *[StructField(c, LongType()) for c in _PLACE]])
    out = ranked.mapInArrow(lean(place), schema)
    return out.select(*[F.col("row")[c].alias(c) for c in pieces.columns if c not in _PLACE], *_PLACE)


def _vocab() -> tuple[str, str, str]:
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def pack_documents(df: DataFrame, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text",
                   **limits) -> DataFrame:
    """Tokenise and pack the texts of ``df``: one row per piece with its
    ids, sequence and place there."""
    pieces = token_pieces(df, *_vocab(), capacity=limits.get("capacity", CAPACITY), with_ids=with_ids,
                          id_col=id_col, text_col=text_col)
    return best_fit_pack(pieces if not with_ids else pieces, **limits)


def op1_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences."""
    return pack_rows(table(spark, sf_dir, "documents"))


def pack_rows(docs: DataFrame) -> DataFrame:
    pieces = token_pieces(docs, *_vocab(), with_ids=False)
    # tokenise once: the range sort reads its input twice
    return best_fit_pack(cut(pieces)).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"),
        "sequence_id", "offset", "slot")
