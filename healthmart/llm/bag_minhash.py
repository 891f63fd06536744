"""Near-duplicate documents by BagMinHash signatures of word shingles.

A document is a multiset of shingles of five words. For every shingle,
Poisson processes run over its discretised weight: the ranges (0, 1],
(1, 2], (2, 4], (4, 8] ... have one process each, of the rate of their
width, seeded by shingle and range, so documents that share a shingle share
its points up to the smaller weight. A point carries a time, a signature
place and a weight level; a range that the weight only partly covers keeps
the points whose level lies below it. Each signature place keeps its
earliest point: two signatures agree at a place with a probability of the
weighted Jaccard similarity. Processes are followed only until their next
point is later than the latest place, so a long text costs about one point
per shingle and a short one a few hundred.

Signatures are banded. Texts with the same words are one class from the
start. In every bucket members are compared with one leader at a time, first
with the member that shares most buckets with others: each round keeps at
most one pair per document, verifies it by the exact multiset overlap of the
texts and merges the classes, so a group of copies costs its size, not its
square. What bucket mates of different classes have left untested is then
searched in full: buckets are dealt into blocks of bounded size, pairs of
blocks compare whole signatures, pairs whose signatures agree in nearly
enough places (``SLACK`` standard deviations below the threshold) compare
their shingles there and then, and only what passes leaves the block, to be
verified on the texts like any other pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart.llm.bloom_dedup import mark_repeats, repeat_filter
from healthmart.llm.common import cut, lean, mix64, pack, table, text_bytes, unpack
from healthmart.llm.components import components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 4
ROUNDS = 3
SLACK = 3.5
MATES = 1024  # documents of one bucket in a block
LOOK = 64     # signature places that blocks compare
LONG = 1 << 12  # shingles beyond which a text is not carried in blocks but goes straight to verification
BLOCK = 1 << 20  # bytes of text whose signatures are made at once

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), 32]] = True
_BYTE = mix64(np.arange(256) + 1000)
_POWER = mix64(np.arange(1 << 16) + 5000) | np.uint64(1)
_TURN = [np.uint64(int(x) | 1) for x in mix64(np.arange(16) + 9000)]


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit hash) of every word, in order; A-Z are folded."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    solid = ~_SPACE[data]
    first = np.zeros(len(data), bool)
    first[off[:-1][np.diff(off) > 0]] = True
    start = np.flatnonzero(solid & (first | ~np.append(False, solid[:-1])))
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    word = np.cumsum(np.bincount(start, minlength=len(data)))[solid] - 1
    at = np.flatnonzero(solid)
    term = _BYTE[_FOLD[data[at]]] * _POWER[(at - start[word]) & 0xFFFF]
    edges = np.searchsorted(at, start)
    return np.searchsorted(off, start, "right") - 1, mix64(np.add.reduceat(term, edges))


def shingles(doc: np.ndarray, word: np.ndarray, n_docs: int, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every shingle; a text of fewer words has one of
    them all, a text without words none."""
    count = np.bincount(doc, minlength=n_docs)
    begin = np.cumsum(count) - count
    n = len(word)
    total = np.zeros(n, np.uint64)
    left = (begin + count)[doc] - np.arange(n)  # words from here to the end of the text
    for j in range(size):
        inside = left > j
        shifted = np.zeros(n, np.uint64)
        shifted[:n - j] = word[j:] if j else word
        total += np.where(inside, shifted * _TURN[j], np.uint64(0))
    keep = (left >= size) | ((np.arange(n) == begin[doc]) & (count[doc] < size))
    return doc[keep], mix64(total[keep])


def weighted(doc: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, element, multiplicity)."""
    order = np.lexsort((element, doc))
    d, e = doc[order], element[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (e[1:] != e[:-1])
    at = np.flatnonzero(new)
    return d[at], e[at], np.diff(np.append(at, len(d)))


def bag_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, places: int) -> np.ndarray:
    """(n_docs, places) earliest times; infinite where a document is empty.
    ``weight`` in units of the discretisation, at least 1."""
    best = np.full(n_docs * places, np.inf)
    # one process per element and weight range that its weight reaches
    d, seed, rate, low, top, w = [], [], [], [], [], []
    j = 0
    live = np.arange(len(doc))
    while len(live):
        lo, width = (0.0, 1.0) if j == 0 else (2.0 ** (j - 1), 2.0 ** (j - 1))
        live = live[weight[live] > lo]
        if len(live):
            d.append(doc[live])
            seed.append(mix64(element[live] ^ mix64(np.array([j + 77]))[0]))
            for out, x in ((rate, width), (low, lo), (top, lo + width)):
                out.append(np.full(len(live), x))
            w.append(weight[live])
        j += 1
    if not d:
        return best.reshape(n_docs, places)
    d, seed, rate, low, top, w = (np.concatenate(x) for x in (d, seed, rate, low, top, w))
    time = np.zeros(len(d))
    golden = np.uint64(0x9E3779B97F4A7C15)
    while len(d):
        seed = seed + golden
        a = mix64(seed)
        b = mix64(a ^ golden)
        time = time - np.log(((a >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53) / rate
        level = low + (top - low) * ((b >> np.uint64(32)).astype(np.float64) * 2.0 ** -32)
        at = d * places + (b & np.uint64(0xFFFFFFFF)).astype(np.int64) % places
        ok = level < w
        np.minimum.at(best, at[ok], time[ok])
        go = time < best.reshape(n_docs, places).max(1)[d]
        d, seed, rate, low, top, w, time = (x[go] for x in (d, seed, rate, low, top, w, time))
    return best.reshape(n_docs, places)


def _blocks(off: np.ndarray) -> Iterator[tuple[int, int]]:
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + BLOCK, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def _signatures(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for a, b in _blocks(off):
                n = b - a
                doc, word = word_hashes(data[off[a]:off[b]], off[a:b + 1] - off[a])
                sd, se = shingles(doc, word, n, size)
                total = np.bincount(sd, minlength=n)
                best = bag_minhash(*weighted(sd, se), n, bands * rows).view(np.uint64).reshape(n, bands, rows)
                key = np.broadcast_to(mix64(np.arange(bands) + 300), (n, bands)).copy()
                for r in range(rows):
                    key = mix64(key ^ best[:, :, r])
                place = mix64(best.reshape(n, -1)[:, ::max(1, bands * rows // LOOK)]).astype(np.uint8)
                look = np.hstack([place, key.astype(np.uint32).view(np.uint8).reshape(n, -1)])
                nth = np.arange(len(doc)) - (np.cumsum(np.bincount(doc, minlength=n)) - np.bincount(doc, minlength=n))[doc]
                same = []
                for salt in (11, 12):
                    s = np.zeros(n, np.uint64)
                    np.add.at(s, doc, mix64(word ^ mix64(nth * 2 + salt)))
                    same.append(pa.array(s.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), *same, pa.array(total.astype(np.int64)),
                     pa.array(list(key.view(np.int64)), pa.list_(pa.int64())),
                     pa.array([x.tobytes() for x in look], pa.binary())], ["id", "s1", "s2", "n", "keys", "look"])
    return run


def _alike(bands: int, least: float):
    """Pairs of two blocks of one bucket that may be similar: of different
    classes and near sizes, signatures and shingles alike, and no common
    bucket earlier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for band, i, j, group in zip(*batch.columns, strict=True):
                band, rows = band.as_py(), group.values
                blk, size = rows.field("blk").to_numpy(), rows.field("n").to_numpy()
                look = np.frombuffer(b"".join(rows.field("look").to_pylist()), np.uint8).reshape(len(blk), -1)
                places = look.shape[1] - 4 * bands
                sign, keys = look[:, :places], np.ascontiguousarray(look[:, places:]).view(np.uint32)
                enough = places * least - SLACK * np.sqrt(places * least * (1 - least))
                label = rows.field("label").dictionary_encode().indices.to_numpy()
                bags = [None if b is None else np.frombuffer(b, np.uint16) for b in rows.field("bag").to_pylist()]
                x, y = np.flatnonzero(blk == i.as_py()), np.flatnonzero(blk == j.as_py())
                found = []
                for a in range(0, len(x), 64):  # a few rows against the whole other block
                    p, q = np.meshgrid(x[a:a + 64], y, indexing="ij")
                    p, q = p.reshape(-1), q.reshape(-1)
                    for test in (lambda p, q: label[p] != label[q],
                                 lambda p, q: (p < q) if i.as_py() == j.as_py() else np.ones(len(p), bool),
                                 lambda p, q: np.minimum(size[p], size[q]) >= least * np.maximum(size[p], size[q]) - 1e-9,
                                 lambda p, q: (sign[p] == sign[q]).sum(1) >= enough,
                                 lambda p, q: ~(keys[p, :band] == keys[q, :band]).any(1),
                                 lambda p, q: np.array([_overlap(bags[u], bags[v], least) for u, v in zip(p, q, strict=True)], bool)):
                        ok = test(p, q)
                        p, q = p[ok], q[ok]
                    found.append((p, q))
                p, q = (np.concatenate([f[k] for f in found] or [np.empty(0, np.int64)]) for k in (0, 1))
                ids = rows.field("id")
                a, b = ids.take(pa.array(p)), ids.take(pa.array(q))
                yield pa.RecordBatch.from_arrays([pc.max_element_wise(a, b), pc.min_element_wise(a, b)], ["a", "b"])
    return run


def _overlap(a: np.ndarray | None, b: np.ndarray | None, least: float) -> bool:
    """Whether two bags (sorted, of distinct elements) may be similar."""
    if a is None or b is None:
        return True
    if not len(a) or not len(b):
        return False
    at = np.searchsorted(a, b)
    both = (a[np.minimum(at, len(a) - 1)] == b).sum()
    return bool(both >= (least - 0.02) * (len(a) + len(b) - both))


def _bags(size: int):
    """Shingles numbered by occurrence, hashed to 16 bits and sorted; NULL
    for long texts. Chance equals only let more pairs go on to the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for a, b in _blocks(off):
                sd, se = shingles(*word_hashes(data[off[a]:off[b]], off[a:b + 1] - off[a]), b - a, size)
                d, e, w = weighted(sd, se)
                nth = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
                d, e = np.repeat(d, w), mix64(np.repeat(e, w) + mix64(nth)).astype(np.uint16)
                ends = np.cumsum(np.bincount(d, minlength=b - a))
                bags = [None if hi - lo > LONG else np.unique(e[lo:hi]).tobytes() for lo, hi in zip([0, *ends[:-1]], ends, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(bags, pa.binary())], ["id", "bag"])
    return run


def _similar(size: int, least: float):
    def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        off = np.array([0, len(data)])
        _, e, w = weighted(*shingles(*word_hashes(data, off), 1, size))
        return e, w

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_text, b_text = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep, last = [], (None, None)
            for i, (x, y) in enumerate(zip(a_text, b_text, strict=True)):
                if last[0] != y:  # neighbours often share the leader
                    last = (y, bag(y))
                (e1, w1), (e2, w2) = bag(x), last[1]
                _, p, q = np.intersect1d(e1, e2, assume_unique=True, return_indices=True)
                both = np.minimum(w1[p], w2[q]).sum()
                if both >= least * (w1.sum() + w2.sum() - both) - 1e-9:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(keep, pa.int64())) for c in batch.columns[:2]], ["a", "b"])
    return run


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                 least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, rounds: int = ROUNDS) -> DataFrame:
    """``df`` plus class_id (smallest id of the class) and kept (it is that
    row). Classes are the connected components of verified links.

    Words are split at ASCII blanks and lower-cased (A-Z). Rows with a NULL
    or blank text have no shingles and are alone in their class; so are rows
    with a NULL id (class_id NULL, kept). Rows that repeat an id count as
    one document with several texts and share its class; all of them are
    kept if the id is. An empty table gives no rows.
    """
    base = pack(df, id_col, text_col)
    kind = base.schema["id"].dataType.simpleString()
    texts = base.select("id", "text").where("id is not null")
    sig = cut(texts.mapInArrow(lean(_signatures(size, bands, rows)), f"id {kind}, s1 long, s2 long, n long, keys array<long>, look binary")
              .where("n > 0"))
    # texts with the same words: one representative goes on
    same = sig.groupBy("s1", "s2").agg(F.min("id").alias("rep"), F.max("id").alias("last"))
    copies = sig.join(same.where("rep <> last"), ["s1", "s2"]).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    copies = cut(copies)
    reps = sig.join(same.select(F.col("s1").alias("r1"), F.col("s2").alias("r2"), "rep"),
                    (F.col("s1") == F.col("r1")) & (F.col("s2") == F.col("r2")) & (F.col("id") == F.col("rep"))).select("id", "n", "keys", "look")
    reps = cut(reps)
    keyed = reps.select("id", "n", F.posexplode("keys").alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("mates"))
    shared = shared.where("lo <> hi").select("key", "mates")
    bucket = keyed.join(shared, "key").dropDuplicates(["key", "id"])
    known = bucket.groupBy("id").agg(F.sum("mates").alias("known"))
    bucket = cut(bucket.join(known, "id"))
    pool = _among(texts, bucket.select("id").distinct())
    pool = cut(pool)

    def linked(pairs: DataFrame) -> DataFrame:
        some = _among(pool, pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
        left = pairs.join(some.select(F.col("id").alias("a"), F.col("text").alias("x")), "a")
        both = left.join(some.select(F.col("id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
        return cut(both.mapInArrow(lean(_similar(size, least)), f"a {kind}, b {kind}").distinct())

    near = F.least("n", "m") >= least * F.greatest("n", "m") - 1e-9
    edges, tested, label = None, None, None
    for r in range(rounds + 1):
        at = bucket if label is None else bucket.join(label, F.col("id") == F.col("node"), "left").drop("node")
        at = at.withColumn("label", F.col("id") if label is None else F.coalesce("label", "id"))
        if r < rounds:
            turn = -F.col("known") if r == 0 else F.xxhash64("id", F.lit(r))
            lead = at.groupBy("key").agg(F.min(F.struct(turn.alias("t"), "id", "n", "label")).alias("l"),
                                         F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
            lead = lead.select("key", F.col("l.id").alias("b"), F.col("l.n").alias("m"), F.col("l.label").alias("other"))
            pairs = at.join(lead, "key").where("label <> other").where(near).select(F.col("id").alias("a"), "b")
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            votes = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("votes"))
            pairs = votes.groupBy("a").agg(F.max_by("b", F.struct("votes", F.col("b"))).alias("b"))
        else:
            mixed = at.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
            mine = at.join(mixed, "key").join(reps.select("id", "look"), "id")
            inside = _among(pool, mine.select("id").distinct())
            bags = inside.mapInArrow(lean(_bags(size)), f"id {kind}, bag binary").dropDuplicates(["id"])
            mine = mine.join(bags, "id")
            # a block meets every other of its bucket once: rows go to all pairs of blocks they are in
            n_blk = F.ceil(F.col("mates") / MATES).cast("int")
            dealt = (mine.withColumn("blk", F.pmod(F.xxhash64("id"), n_blk).cast("int"))
                     .withColumn("other", F.explode(F.sequence(F.lit(0), n_blk - 1))))
            block = dealt.groupBy("key", "band", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j")).agg(
                F.collect_list(F.struct("blk", "id", "n", "label", "look", "bag")).alias("rows"))
            pairs = block.select("band", "i", "j", "rows").mapInArrow(lean(_alike(bands, least)), f"a {kind}, b {kind}")
            pairs = pairs.distinct().join(tested, ["a", "b"], "left_anti")
        pairs = cut(pairs)
        if pairs.isEmpty():
            if r < rounds and label is None:
                break
            continue
        found = linked(pairs)
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tested = both if tested is None else tested.unionByName(both)
        edges = found if edges is None else edges.unionByName(found)
        label = components(edges)
    every = components(copies if edges is None else copies.unionByName(edges))
    whole = base.join(every, F.col("id") == F.col("node"), "left")
    of = F.coalesce("label", "id")
    return unpack(whole, df, added={"class_id": of, "kept": of.eqNullSafe(F.col("id"))})


def _among(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose id is in ``ids``; a bounded bit filter spares
    most others the shuffle of their text."""
    ids = cut(ids)
    twice = ids.select("id").union(ids.select("id"))
    some = mark_repeats(texts, "id", repeat_filter(twice, "id"), name="maybe").where("maybe").drop("maybe")
    return some.join(ids, "id", "left_semi")


def op5_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    out = near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "class_id", "kept")
