"""Repeated passages by suffix arrays built in two stages.

Every 100-byte string that also starts earlier in the table is removed
(earlier: smaller id, or the same document further left).

1. *Routing.* Each window of 100 bytes is assigned to the smallest hash among
   its 24-byte grams; neighbouring windows with the same smallest gram form
   one strip of at most 176 bytes. Equal windows have equal smallest grams,
   so equal windows always meet under one anchor. Strips travel as (anchor,
   digest, place), packed into arrays by anchor bucket; a strip that repeats
   inside one batch is settled there and does not travel.
2. *Settling.* Of strips with the same anchor and digest all but the first
   are repeats as a whole. Only where an anchor has different strips, at the
   edges of shared passages, are bytes needed: the first strip of each kind.
3. *Suffix arrays.* Those strips are fetched and gathered by anchor into
   buckets of bounded bytes, each split by anchor into texts of bounded bytes.
   The suffixes of a text are sorted in two stages: suffixes smaller than
   their successors directly, the others induced by scanning the buckets of
   first bytes in ascending order. Adjacent common prefixes of 100 bytes or
   more give the groups of equal windows; all but the earliest go.
4. *Removal.* Spans meet their documents by bucket of the id.

Bucket counts grow with the bytes of the table, so a task's share does not.
Anchors with many strips are found by a sample of digests and settled by
(anchor, digest); only those of at most ``HOT`` kinds then meet by anchor.
Of the others the digests of all windows are dealt out first, equal windows of
a block of strips combined; only windows whose digest occurs at two places get
a place in a suffix array. Documents travel as rows: the pieces of a batch for
every bucket would grow with the square of the table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from healthmart.llm.common import cut, give_back, lean, mix64, quoted, table, text_bytes

MATCH, GRAM = 100, 24
SPAN = MATCH - GRAM + 1
BLOCK = 1_000_000          # bytes hashed at once; places in a block fit 20 bits
SHARE = 8 << 20            # bytes of text per bucket of anchors or documents
SORTED = 1 << 19           # bytes of strips per suffix array
GATHERED = 8 * SORTED      # bytes of strips per bucket of suffix arrays
HOT = 4096                 # different strips of one anchor that stay together

_ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_ODD), -1, 1 << 64))
_BYTE = mix64(np.arange(256) + 77)
_powers: list[np.ndarray] = []


def powers() -> list[np.ndarray]:
    """Powers of the hash base and of its inverse, made once per worker."""
    if not _powers:
        n = BLOCK + 2 * MATCH
        for base in (_ODD, _INV):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers


def _prefix_hash(data: np.ndarray) -> np.ndarray:
    up, _ = powers()
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=prefix[1:])
    return prefix


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by prefix and suffix minima of
    blocks of that width."""
    n = len(x) - width + 1
    pad = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    pad[:len(x)] = x
    grid = pad.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def strips(data: np.ndarray, off: np.ndarray):
    """(text, start, windows, anchor, digest) of all strips of a block of at
    most ``BLOCK`` + ``MATCH`` bytes; start counts from the text's begin."""
    n_win = np.maximum(np.diff(off) - MATCH + 1, 0)
    if not n_win.any():  # too short to hash: fewer bytes than a gram, or than grams that make a window
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    _, down = powers()
    n = len(data)
    prefix = _prefix_hash(data)
    gram = mix64((prefix[GRAM:] - prefix[:-GRAM]) * down[:n - GRAM + 1])
    place = np.uint64((1 << 20) - 1)
    least = sliding_min((gram & ~place) | np.arange(len(gram), dtype=np.uint64), SPAN)
    doc = np.repeat(np.arange(len(n_win)), n_win)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n_win) - n_win, n_win) + off[:-1][doc]
    anchor = (least[at] & place).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(at)))
    start = at[head]
    stop = start + count + MATCH - 1
    digest = mix64(mix64((prefix[stop] - prefix[start]) * down[start]) + (count * 256 + anchor[head] - start).astype(np.uint64))
    return doc[head], start - off[:-1][doc[head]], count, gram[anchor[head]], digest


def _pieces(off: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Blocks of whole texts (first, last + 1, 0, bytes); a longer text comes
    in overlapping parts (i, i + 1, from, to) that share no window."""
    a, n = 0, len(off) - 1
    while a < n:
        size = off[a + 1] - off[a]
        if size > BLOCK:
            for s in range(0, int(size) - MATCH + 1, BLOCK - MATCH):
                yield a, a + 1, s, int(min(size, s + BLOCK - 1))
            a += 1
        else:
            b = max(a + 1, int(np.searchsorted(off, off[a] + BLOCK, "right")) - 1)
            yield a, b, 0, int(off[b] - off[a])
            a = b


def _ids(col: pa.Array) -> np.ndarray:
    """Ids as int64; NULL comes before all others."""
    return col.cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


_LOW = 0xFFFFFFFF
_FACTORS = 0x5851F42D, 0x6C078965, 0x7FEB352D  # below 2^31: a product with 32 bits does not overflow


def _bucket(x: np.ndarray, n: int) -> np.ndarray:
    """Bucket of hashes, or (int64) of document ids as ``_id_bucket``."""
    if x.dtype != np.int64:
        return (mix64(x) % np.uint64(n)).astype(np.int64)
    low, (a, b, c) = np.uint64(_LOW), map(np.uint64, _FACTORS)
    x = x.view(np.uint64)
    h = (x & low) * a ^ (x >> np.uint64(32)) * b
    h = ((h ^ h >> np.uint64(31)) & low) * c
    return ((h ^ h >> np.uint64(29)) % np.uint64(n)).astype(np.int64)


def _id_bucket(x: Column, n: int) -> Column:
    a, b, c = _FACTORS
    x = F.coalesce(x, F.lit(-(1 << 63)))
    h = (x.bitwiseAND(F.lit(_LOW)) * F.lit(a)).bitwiseXOR(F.shiftrightunsigned(x, 32) * F.lit(b))
    h = h.bitwiseXOR(F.shiftrightunsigned(h, 31)).bitwiseAND(F.lit(_LOW)) * F.lit(c)
    return (h.bitwiseXOR(F.shiftrightunsigned(h, 29)) % F.lit(n)).cast("int")


def _split(bucket: np.ndarray, cols: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row per bucket that holds its part of every array as bytes."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    heads = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else np.empty(0, np.int64)
    ends = np.append(heads[1:], len(b)) if len(b) else heads
    out = [pa.array(b[heads].astype(np.int32))]
    for c in cols:
        c = c[order]
        out.append(pa.array([c[i:j].tobytes() for i, j in zip(heads, ends, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays(out, ["bucket", *names])


def _join(t: pa.Table | pa.RecordBatch, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(t[name].to_pylist()), dtype)


def _first(keys: list[np.ndarray], doc: np.ndarray, start: np.ndarray):
    """Sort by (*keys, doc, start); (order, group number in that order, rows
    strictly later than the first of their group)."""
    order = np.lexsort((start, doc, *keys[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    group = np.cumsum(new) - 1
    head = order[np.flatnonzero(new)][group] if len(order) else order
    later = (doc[order] > doc[head]) | ((doc[order] == doc[head]) & (start[order] > start[head]))
    return order, group, later


_SPANS = ["doc", "start", "length"]


def _route(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch.column(0))
            data, off = text_bytes(batch.column(1))
            got = []
            for a, b, lo, hi in _pieces(off):
                at = off[a:b + 1] - off[a] if lo == 0 and hi == off[b] - off[a] else np.array([0, hi - lo])
                doc, start, count, anchor, digest = strips(data[off[a] + lo:off[a] + hi], at)
                got.append((ids[a + doc], start + lo, count + MATCH - 1, anchor, digest))
            if not got:
                continue
            doc, start, length, anchor, digest = (np.concatenate(x) for x in zip(*got, strict=True))
            order, _, later = _first([anchor, digest], doc, start)
            gone, stay = order[later], order[~later]
            yield _packed(0, n_buckets, anchor, np.sort(stay), doc, start, length, anchor, digest)
            yield _packed(1, n_buckets, doc, np.sort(gone), doc, start, length)
    return run


def _packed(gone: int, n_buckets: int, by: np.ndarray, rows: np.ndarray, doc: np.ndarray, start: np.ndarray,
            length: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
    """``rows`` by bucket of ``by``: spans to remove (gone) or strips with
    their anchor and digest (or hot mark)."""
    o = _split(_bucket(by[rows], n_buckets), [doc[rows].astype(np.int64), start[rows].astype(np.uint32),
                                              length[rows].astype(np.uint32), *(m[rows] for m in more)],
               [*_SPANS, "anchor", "digest"][:3 + len(more)])
    none = pa.array([b""] * o.num_rows, pa.binary())
    pair = o.columns[4:] if more else [none, none]
    return pa.RecordBatch.from_arrays([o.column(0), pa.array(np.full(o.num_rows, gone, np.int32)), *pair, *o.columns[1:4]],
                                      ["bucket", "gone", "anchor", "digest", *_SPANS])


_PACKED = "bucket int, gone int, anchor binary, digest binary, doc binary, start binary, length binary"


def _strips(t: pa.Table | pa.RecordBatch):
    """doc, start, length, anchor and digest of packed strips."""
    return tuple(_join(t, c, k) for c, k in zip([*_SPANS, "anchor", "digest"],
                                                (np.int64, np.uint32, np.uint32, np.uint64, np.uint64), strict=True))


def _sampled(rate: int):
    """Strips per anchor among those with one of ``rate`` digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, digest = _join(batch, "anchor", np.uint64), _join(batch, "digest", np.uint64)
            yield from _per_anchor([anchor[_bucket(digest, rate) == 0]])
    return run


def _deal(n_buckets: int, crowded):
    """Strips of crowded anchors (gone = 2) go by anchor and digest, all
    others stay in the bucket of their anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, start, length, anchor, digest = _strips(batch)
            apart = np.isin(anchor.view(np.int64), crowded.value)
            yield _packed(0, n_buckets, anchor, np.flatnonzero(~apart), doc, start, length, anchor, digest)
            yield _packed(2, n_buckets, anchor ^ mix64(digest), np.flatnonzero(apart), doc, start, length, anchor, digest)
    return run


def _kinds(n_buckets: int):
    """Of strips with one anchor and digest the first stays (gone = 2)."""
    def run(t: pa.Table) -> pa.Table:
        doc, start, length, anchor, digest = _strips(t)
        gone, head = _repeats(doc, start, anchor, digest)
        return pa.Table.from_batches([_packed(1, n_buckets, doc, gone, doc, start, length),
                                      _packed(2, n_buckets, anchor, head, doc, start, length, anchor, digest)])
    return run


def _per_anchor(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for a in arrays:
        anchor, n = np.unique(a, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n)], ["anchor", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _per_anchor(_join(b, "anchor", np.uint64) for b in batches)


def _sift(n_buckets: int, hot):
    """First strips of hot anchors are wanted as they are (gone = 2), by
    document; those of all others go to the bucket of their anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, start, length, anchor, digest = _strips(batch)
            apart = np.isin(anchor.view(np.int64), hot.value)
            yield _packed(0, n_buckets, anchor, np.flatnonzero(~apart), doc, start, length, anchor, digest)
            yield _packed(2, n_buckets, doc, np.flatnonzero(apart), doc, start, length, anchor, np.ones(len(doc), np.uint8))
    return run


def _repeats(doc: np.ndarray, start: np.ndarray, anchor: np.ndarray, digest: np.ndarray):
    """Strips later than the first of their anchor and digest, and those
    firsts in order of the anchor."""
    order, group, later = _first([anchor, digest], doc, start)
    head = order[np.flatnonzero(np.append(True, group[1:] != group[:-1]))] if len(order) else order
    return order[later], head


def _settle(n_buckets: int):
    def run(t: pa.Table) -> pa.Table:
        doc, start, length, anchor, digest = _strips(t)
        gone, head = _repeats(doc, start, anchor, digest)
        # first strips of anchors that have several kinds
        a = anchor[head]
        new = np.append(True, a[1:] != a[:-1]) if len(a) else np.zeros(0, bool)
        kinds = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] if len(a) else np.zeros(0, np.int64)
        return pa.Table.from_batches([_packed(1, n_buckets, doc, gone, doc, start, length),
                                      _packed(0, n_buckets, doc, head[kinds > 1], doc, start, length, anchor, np.zeros(len(doc), np.uint8))])
    return run


_STRIPS = "bucket int, what int, doc binary, start binary, length binary, key binary, bytes binary"
TO_SORT, TO_REMOVE, DIGESTS, WHOLE = range(4)  # what rows of _STRIPS hold


def _bytes_at(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of all spans, one after the other."""
    some, out = 1 << 14, [np.empty(0, np.uint8)]
    for i in range(0, len(at), some):
        a, n = at[i:i + some], length[i:i + some]
        out.append(data[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())])
    return np.concatenate(out)


def _by_bucket(what: int, bucket: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray,
               key: np.ndarray, data: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Strips and their bytes (from places ``at`` of ``data``) by bucket."""
    order = np.argsort(bucket, kind="stable")
    rows = _split(bucket[order], [doc[order], start[order].astype(np.uint32), length[order].astype(np.uint32), key[order]], [*_SPANS, "key"])
    text, ends = _bytes_at(data, at[order], length[order]), np.append(0, np.cumsum(length[order]))
    ends = ends[np.append(np.unique(bucket[order], return_index=True)[1], len(order))]
    packed = [zlib.compress(text[a:b].tobytes(), 1) for a, b in zip(ends, ends[1:], strict=False)]
    return pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.full(rows.num_rows, what, np.int32)), *rows.columns[1:],
                                       pa.array(packed, pa.binary())], ["bucket", "what", *_SPANS, "key", "bytes"])


def _bare(what: int, bucket: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    """Places without bytes by bucket."""
    rows = _split(bucket, [doc, start.astype(np.uint32), length.astype(np.uint32), key], [*_SPANS, "key"])
    return pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.full(rows.num_rows, what, np.int32)), *rows.columns[1:],
                                       pa.nulls(rows.num_rows, pa.binary())], ["bucket", "what", *_SPANS, "key", "bytes"])


def _part(key: np.ndarray) -> np.ndarray:
    """What splits the strips of a bucket of suffix arrays."""
    return (mix64(key) >> np.uint64(32)).astype(np.uint32)


def _blocks(data: np.ndarray, at: np.ndarray, length: np.ndarray):
    """All windows of strips, by blocks that can be hashed at once: (strip,
    window in it, its digest, text of the block, place of the window there)."""
    some, (_, down) = BLOCK // (MATCH + SPAN), powers()
    for i in range(0, len(at), some):
        a, n = at[i:i + some], length[i:i + some]
        text, count = _bytes_at(data, a, n), n - MATCH + 1
        strip = np.repeat(np.arange(len(a)), count)
        j = np.arange(len(strip)) - np.repeat(np.cumsum(count) - count, count)
        place = (np.cumsum(n) - n)[strip] + j
        prefix = _prefix_hash(text)
        yield i + strip, j, mix64((prefix[place + MATCH] - prefix[place]) * down[place]), text, place


def _dealt(n_buckets: int, n_windows: int, doc: np.ndarray, start: np.ndarray, length: np.ndarray, data: np.ndarray,
           at: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Strips of hot anchors as they are, by document, and the digests of
    their windows. Of equal windows of a block only the first travels."""
    yield _by_bucket(WHOLE, _bucket(doc, n_buckets), doc, start, length, np.zeros(len(doc), np.uint8), data, at)
    for strip, j, digest, text, place in _blocks(data, at, length):
        d, s = doc[strip], start[strip] + j
        order, group, later = _first([digest], d, s)
        head = order[np.flatnonzero(np.append(True, group[1:] != group[:-1]))][group]
        twin = np.flatnonzero(order != head)
        twin = twin[common_prefix(text, place[order[twin]], place[head[twin]])] if len(twin) else twin
        stay = np.ones(len(order), bool)
        stay[twin] = False
        gone, stay = order[twin[later[twin]]], order[stay]
        none = np.zeros(len(stay), np.uint8)
        yield _bare(DIGESTS, _bucket(digest[stay], n_windows), d[stay], s[stay], none, digest[stay])
        yield _bare(TO_REMOVE, _bucket(d[gone], n_buckets), d[gone], s[gone], np.full(len(gone), MATCH), np.zeros(len(gone), np.uint8))


def _fetch(n_sorted: int, n_buckets: int, n_windows: int):
    """Bytes of the strips that are needed, by bucket of their anchor; what
    ``_dealt`` gives of the strips of hot anchors."""
    def run(docs: pa.Table, want: pa.Table) -> pa.Table:
        doc, start, length = _join(want, "doc", np.int64), _join(want, "start", np.uint32).astype(np.int64), _join(want, "length", np.uint32).astype(np.int64)
        anchor, hot = _join(want, "anchor", np.uint64), _join(want, "digest", np.uint8).astype(bool)
        by = np.argsort(doc, kind="stable")
        out = [_bare(TO_REMOVE, *[np.empty(0, np.int64)] * 4, np.empty(0, np.uint8))]
        for batch in docs.select(["_id", "_t"]).to_batches() if len(doc) else ():
            ids = _ids(batch.column(0))
            data, off = text_bytes(batch.column(1))
            lo, hi = np.searchsorted(doc[by], ids, "left"), np.searchsorted(doc[by], ids, "right")
            n = hi - lo
            k, i = by[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())], np.repeat(np.arange(len(ids)), n)
            at = off[i] + start[k]
            own = at + length[k] <= off[i + 1]  # else a strip of another text that repeats this id
            k, at = k[own], at[own]
            cold = ~hot[k]
            c = k[cold]
            out.append(_by_bucket(TO_SORT, _bucket(anchor[c], n_sorted), doc[c], start[c], length[c], _part(anchor[c]), data, at[cold]))
            if not cold.all():
                h = k[~cold]
                out += _dealt(n_buckets, n_windows, doc[h], start[h], length[h], data, at[~cold])
        return _settled(pa.Table.from_batches(out))
    return run


def _pairs(n_buckets: int):
    """Places of windows whose digest occurs at several, by document."""
    def run(t: pa.Table) -> pa.Table:
        doc, start, digest = _join(t, "doc", np.int64), _join(t, "start", np.uint32), _join(t, "key", np.uint64)
        order, group, later = _first([digest], doc, start)
        several = np.zeros(group[-1] + 1 if len(group) else 0, bool)
        several[group[later]] = True
        rows = order[several[group]]
        return _settled(pa.Table.from_batches([_split(_bucket(doc[rows], n_buckets), [doc[rows], start[rows]], ["doc", "start"])]))
    return run


def _again(n_sorted: int):
    """Bytes of the windows of hot anchors that may repeat, by digest."""
    def run(t: pa.Table, pairs: pa.Table) -> pa.Table:
        doc, start, length = _join(t, "doc", np.int64), _join(t, "start", np.uint32).astype(np.int64), _join(t, "length", np.uint32).astype(np.int64)
        data = np.frombuffer(b"".join(zlib.decompress(x) for x in t["bytes"].to_pylist()), np.uint8)
        of, at = np.unique(_join(pairs, "doc", np.int64), return_inverse=True)
        wanted = at << 32 | _join(pairs, "start", np.uint32)
        out = [_bare(TO_SORT, *[np.empty(0, np.int64)] * 4, np.empty(0, np.uint32))]
        for strip, j, digest, text, place in _blocks(data, np.cumsum(length) - length, length) if len(of) else ():
            d, s = doc[strip], start[strip] + j
            nth = np.minimum(np.searchsorted(of, d), len(of) - 1)
            w = np.flatnonzero((of[nth] == d) & np.isin(nth << 32 | s, wanted))
            out.append(_by_bucket(TO_SORT, _bucket(digest[w], n_sorted), d[w], s[w], np.full(len(w), MATCH), _part(digest[w]), text, place[w]))
        return _settled(pa.Table.from_batches(out))
    return run


def _settled(out: pa.Table) -> pa.Table:
    """Give unused memory back before the next group comes."""
    give_back()
    return out


def suffix_array(text: np.ndarray, depth: int = MATCH) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes (at least), by two-
    stage sorting. The end of the text is smaller than any byte."""
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64)
    t = text.astype(np.int16)
    step = np.append(np.sign(t[1:] - t[:-1]), -1)
    nxt = np.minimum.accumulate(np.where(step != 0, np.arange(n), n - 1)[::-1])[::-1]
    direct = step[nxt] > 0  # smaller than its successor; runs go with their end
    order = _sort_direct(text, np.flatnonzero(direct), depth)
    firsts = text[order]
    edges = np.searchsorted(firsts, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        wave = np.concatenate(induced[c]) if induced[c] else np.empty(0, np.int64)
        here = [wave]
        while len(wave):  # runs of one byte: predecessors in the same bucket
            wave = wave[wave > 0] - 1
            wave = wave[text[wave] == c]
            here.append(wave)
        here.append(order[edges[c]:edges[c + 1]])
        scan = np.concatenate(here)
        out.append(scan)
        before = scan[scan > 0] - 1
        first = text[before]
        before, first = before[first > c], first[first > c]
        by = np.argsort(first, kind="stable")
        ends = np.searchsorted(first[by], np.arange(257))
        for f in np.unique(first).tolist():
            induced[f].append(before[by[ends[f]:ends[f + 1]]])
    return np.concatenate(out)


def _words(text: np.ndarray) -> np.ndarray:
    """Eight bytes from every place as one big-endian number."""
    pad = np.append(text, np.zeros(8 + MATCH, np.uint8))
    n = len(text) + MATCH
    w = np.zeros(n, np.uint64)
    for j in range(8):
        w <<= np.uint64(8)
        w |= pad[j:j + n]
    return w


def _sort_direct(text: np.ndarray, which: np.ndarray, depth: int) -> np.ndarray:
    """``which`` in order of the first ``depth`` bytes: words are ranked once,
    then the group so far and the ranks of the next words are one number."""
    words = _words(text)
    by = np.argsort(words)
    rank = np.empty(len(words), np.uint64)
    rank[by] = np.cumsum(np.append(False, words[by][1:] != words[by][:-1]))
    bits = len(words).bit_length()
    ahead = 64 // bits - 1
    order, group, lo, todo = which.copy(), np.zeros(len(which), np.int64), 0, np.arange(len(which))
    while lo < depth and len(todo):
        at, key = order[todo], group[todo].astype(np.uint64)
        for _ in range(ahead):
            # beyond the end there is a smaller nothing
            key = key << np.uint64(bits) | rank[np.minimum(at + lo, len(words) - 1)]
            lo += 8
        by = np.argsort(key)
        order[todo], key = at[by], key[by]
        head = np.append(True, key[1:] != key[:-1])
        # positions are unique, so a group is renamed by the place of its head
        group[todo] = todo[np.maximum.accumulate(np.where(head, np.arange(len(todo)), 0))]
        twin = ~head
        twin[:-1] |= ~head[1:]
        todo = todo[twin]
    return order


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, least: int = MATCH) -> np.ndarray:
    """Whether the texts from places a and b share ``least`` bytes."""
    words = _words(text)
    same = np.ones(len(a), bool)
    for lo in [*range(0, least - 8, 8), least - 8]:
        live = np.flatnonzero(same)
        same[live] = words[a[live] + lo] == words[b[live] + lo]
    return same


def repeated_windows(text: np.ndarray, begin: np.ndarray, length: np.ndarray, rank: np.ndarray):
    """(strip, window) of the windows that also start earlier: strips lie at
    ``begin`` in ``text``, ``rank`` orders them."""
    n = len(text)
    ok = np.zeros(n + 1, np.int8)
    ok[begin] = 1
    ok[begin + length - MATCH + 1] = -1
    valid = np.cumsum(ok[:n], dtype=np.int8) > 0
    strip = np.repeat(np.arange(len(begin), dtype=np.int32), length + 1)
    sa = suffix_array(text)
    sa = sa[valid[sa]]
    if not len(sa):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.append(True, ~common_prefix(text, sa[:-1], sa[1:]))
    s = strip[sa]
    key = rank[s] * 256 + (sa - begin[s])
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(key, heads)[np.cumsum(new) - 1]
    later = key > least
    return s[later], (sa - begin[s])[later]


def _repeats_in(doc: np.ndarray, start: np.ndarray, length: np.ndarray, raw: np.ndarray):
    """(doc, start, length) of the spans that occur earlier among strips whose
    bytes lie in ``raw`` one after the other."""
    # a byte between strips keeps them apart
    text = np.zeros(len(raw) + len(length), np.uint8)
    begin = np.cumsum(length + 1) - length - 1
    body = np.ones(len(text), bool)
    body[begin + length] = False
    text[body] = raw
    order = np.lexsort((start, doc))
    new = np.append(False, (doc[order][1:] != doc[order][:-1]) | (start[order][1:] != start[order][:-1]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new[:len(order)])
    s, w = repeated_windows(text, begin, length, rank)
    by = np.lexsort((w, s))
    s, w = s[by], w[by]
    head = np.flatnonzero(np.append(True, (s[1:] != s[:-1]) | (w[1:] != w[:-1] + 1))) if len(s) else np.empty(0, np.int64)
    count = np.diff(np.append(head, len(s)))
    return doc[s[head]], start[s[head]] + w[head], count + MATCH - 1


def _sort(n_buckets: int):
    def run(t: pa.Table) -> pa.Table:
        doc, start, length = _join(t, "doc", np.int64), _join(t, "start", np.uint32).astype(np.int64), _join(t, "length", np.uint32).astype(np.int64)
        raw = np.frombuffer(b"".join(zlib.decompress(x) for x in t["bytes"].to_pylist()), np.uint8)
        at = np.cumsum(length) - length
        part = _join(t, "key", np.uint32) % np.uint32(max(1, -(-len(raw) // SORTED)))
        order = np.argsort(part, kind="stable")
        got = [tuple(np.empty(0, np.int64) for _ in _SPANS)]
        for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            got.append(_repeats_in(doc[rows], start[rows], length[rows], _bytes_at(raw, at[rows], length[rows])))
        d, s, n = (np.concatenate(x) for x in zip(*got, strict=True))
        o = _split(_bucket(d, n_buckets), [d, s.astype(np.uint32), n.astype(np.uint32)], _SPANS)
        return _settled(pa.Table.from_batches([o]))
    return run


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans (sorted by start)."""
    if not len(start):
        return start, stop
    reach = np.maximum.accumulate(stop)
    head = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return start[head], reach[np.append(head[1:] - 1, len(start) - 1)]


def _whole_characters(data: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Shrink spans so that no UTF-8 character loses a part of itself."""
    middle = lambda i: i < len(data) and (data[i] & 0xC0) == 0x80
    out = []
    for a, b in zip(start.tolist(), stop.tolist(), strict=True):
        while a < b and middle(a):
            a += 1
        while b > a and middle(b):
            b -= 1
        if b > a:
            out.append((a, b))
    return out


def _remove(texts: bool):
    def run(docs: pa.Table, spans: pa.Table) -> pa.Table:
        doc, start, length = _join(spans, "doc", np.int64), _join(spans, "start", np.uint32).astype(np.int64), _join(spans, "length", np.uint32)
        by = np.lexsort((start, doc))
        doc, start, stop = doc[by], start[by], (start + length)[by]
        out = []
        for batch in docs.drop_columns(["bucket"]).to_batches():
            ids = _ids(batch.column(0))
            data, off = text_bytes(batch.column(1))
            lo, hi = np.searchsorted(doc, ids, "left"), np.searchsorted(doc, ids, "right")
            size, removed, runs, digest, kept = np.diff(off), [], [], [], []
            given = batch.column(1).to_pylist() if texts else None
            for i in range(len(ids)):
                t = data[off[i]:off[i + 1]]
                a, b = merged(start[lo[i]:hi[i]], np.minimum(stop[lo[i]:hi[i]], len(t)))
                removed.append(int((b - a).sum()))
                runs.append(len(a))
                rest, at = [], 0
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    rest.append(t[at:x].tobytes())
                    at = y
                digest.append(hashlib.sha256(b"".join([*rest, t[at:].tobytes()])).hexdigest())
                if texts:
                    if len(a):
                        rest, at = [], 0
                        for x, y in _whole_characters(t, a, b):
                            rest.append(t[at:x].tobytes())
                            at = y
                        given[i] = b"".join([*rest, t[at:].tobytes()]).decode("utf-8", "replace")
            cols = list(batch.columns)
            if texts:
                cols[1] = pa.array(given, batch.schema.field(1).type)
            else:
                cols = cols[2:]
            stats = [pa.array(size), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())]
            out.append((cols, stats, batch.schema))
        names = (out[0][2].names if texts else out[0][2].names[2:]) + ["_s0", "_s1", "_s2", "_s3"]
        return pa.concat_tables([pa.Table.from_arrays([*c, *s], names) for c, s, _ in out])
    return run


def _crowds(strips_: DataFrame, n_buckets: int):
    """(strips to settle by anchor, strips wanted window by window or None,
    tables with spans to remove, number of strips of hot anchors).

    A sample of digests shows which anchors may have more than ``HOT`` kinds
    (it decides the way a strip takes, never whether it is settled). Their
    strips are settled by anchor and digest, and kinds per anchor counted,
    before any meet by their anchor. An anchor of ``HOT`` kinds has 64 in the
    sample and is missed if 32 or fewer show, with about 1e-5."""
    rate = max(1, HOT // 64)
    total = F.sum("n").alias("n")
    seen = strips_.select("anchor", "digest").mapInArrow(lean(_sampled(rate)), "anchor long, n long").groupBy("anchor").agg(total)
    crowded = seen.where(F.col("n") > HOT // (2 * rate)).select("anchor").toPandas()  # at most one for HOT / 2 strips
    if not len(crowded):
        return strips_, None, [], 0
    share = strips_.sparkSession.sparkContext.broadcast
    dealt = strips_.mapInArrow(lean(_deal(n_buckets, share(crowded["anchor"].to_numpy(np.int64)))), _PACKED)
    kinds = cut(dealt.where("gone = 2").groupBy("bucket").applyInArrow(_kinds(n_buckets), _PACKED))
    firsts = kinds.where("gone = 2")
    per = firsts.select("anchor").mapInArrow(lean(_counted), "anchor long, n long").groupBy("anchor").agg(total)
    hot = per.where(F.col("n") > HOT).toPandas()  # at most one for HOT strips
    sifted = firsts.mapInArrow(lean(_sift(n_buckets, share(hot["anchor"].to_numpy(np.int64)))), _PACKED)
    by_anchor = dealt.where("gone = 0").unionByName(sifted.where("gone = 0"))
    apart = sifted.where("gone = 2").drop("gone") if len(hot) else None
    return by_anchor, apart, [kinds.where("gone = 1")], int(hot["n"].sum())


def _placed(docs: DataFrame, n_buckets: int):
    """Documents grouped by the bucket of their id."""
    return docs.withColumn("bucket", _id_bucket(F.col("_id"), n_buckets)).groupBy("bucket")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """``df`` plus n_bytes, n_removed, n_spans and kept_sha256 of the bytes
    that stay. With ``with_text`` the text loses the removed bytes, but for
    those of characters that go only in part; without it the text column is
    left out.

    Ids are integers; NULL ids come before all others, and rows that repeat
    an id lie at one place: they do not remove each other's bytes. NULL text
    counts as empty and stays NULL. Input columns named like an added one
    give way. An empty table gives no rows.
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rest = [c for c in df.columns if c not in added and c != text_col]
    texts = df.select(F.col(quoted(id_col)).cast("long").alias("_id"), F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("_t"))
    total = texts.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    n_buckets = max(16, -(-total // SHARE))
    routed = texts.mapInArrow(lean(_route(n_buckets)), _PACKED)
    routed = cut(routed)
    by_anchor, apart, gone, n_hot = _crowds(routed.where("gone = 0"), n_buckets)
    settled = cut(by_anchor.groupBy("bucket").applyInArrow(_settle(n_buckets), _PACKED))
    want = settled.where("gone = 0").drop("gone")
    n_edge = want.agg(F.sum(F.length("doc"))).first()[0] or 0
    n_sorted = max(16, -(-(n_edge // 8 * (MATCH + SPAN // 2)) // GATHERED))
    n_windows = max(16, -(-n_hot * (SPAN // 2) * 20 // SHARE))  # digest, document and start of each
    if apart is not None:
        want = want.unionByName(apart)
    strips_ = _placed(texts, n_buckets).cogroup(want.groupBy("bucket")).applyInArrow(_fetch(n_sorted, n_buckets, n_windows), _STRIPS)
    span_type = "bucket int, doc binary, start binary, length binary"
    sort = lambda rows: rows.where(F.col("what") == TO_SORT).groupBy("bucket").applyInArrow(_sort(n_buckets), span_type)
    if apart is None:
        found = sort(strips_)
    else:
        strips_ = cut(strips_)
        is_ = lambda what: strips_.where(F.col("what") == what)
        pairs = cut(is_(DIGESTS).groupBy("bucket").applyInArrow(_pairs(n_buckets), "bucket int, doc binary, start binary"))
        n_pairs = pairs.agg(F.sum(F.length("doc"))).first()[0] or 0
        again = is_(WHOLE).groupBy("bucket").cogroup(pairs.groupBy("bucket")).applyInArrow(_again(max(16, -(-(n_pairs // 8 * MATCH) // GATHERED))), _STRIPS)
        found = sort(strips_).unionByName(sort(again))
        gone.append(is_(TO_REMOVE))
    spans = found
    for more in (settled.where("gone = 1"), routed.where("gone = 1"), *gone):
        spans = spans.unionByName(more.select(found.columns))
    carried = [F.col(quoted(c)).alias(f"_c{i}") for i, c in enumerate(rest)]
    packed = df.select(F.col(quoted(id_col)).cast("long").alias("_id"), F.col(quoted(text_col)).cast("string").alias("_t"), *carried)
    names = ["_id", "_t", *[f"_c{i}" for i in range(len(rest))]] if with_text else [f"_c{i}" for i in range(len(rest))]
    schema = StructType([*[packed.schema[c] for c in names], *[StructField(f"_s{i}", LongType()) for i in range(3)], StructField("_s3", StringType())])
    done = _placed(packed, n_buckets).cogroup(spans.groupBy("bucket")).applyInArrow(_remove(with_text), schema)
    at = {c: f"_c{i}" for i, c in enumerate(rest)}
    cols = [F.col("_t").alias(c) if c == text_col else F.col(at[c]).alias(c) for c in df.columns
            if c not in added and (with_text or c != text_col)]
    return done.select(*cols, *[F.col(f"_s{i}").alias(c) for i, c in enumerate(added)])


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes from every document, and the digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, with_text=False)
