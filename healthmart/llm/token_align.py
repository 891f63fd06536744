"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenisations of one text are two sorted lists of byte ends. Merging them
shows where both end; those places cut the text into groups, and every A
token of a group is linked with every B token of it.

A text's merge is a path through the grid of its two lists. Diagonals every
``work`` steps cross that path once, found by binary search on each diagonal
alone, so a giant text falls into independent pieces of equal work that any
task may take. A piece emits the groups that lie inside it as one unit, and
what lies before its first and after its last common end as fragments; runs
of fragments between two closed pieces are stitched into one group, which is
a unit of its own. Texts of at most ``work`` steps are one piece and one unit.

Units hold whole groups, so all that follows runs on them alone, in blocks of
bounded size, each one row with its ids compressed: every block lists its
distinct id pairs with the number of its documents that hold them (documents
of several units are made distinct by a shuffle first), sums of these are the
corpus counts, and every block gets back the counts of just the pairs it
listed. No table of counts is broadcast but the highest count per A id,
bounded by the vocabulary of A.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from healthmart.llm.common import cut, give_back, lean, quoted, table
from healthmart.llm.packing import Encoder

WORK = 16384           # merge steps of a piece
BLOCK_TOKENS = 1 << 20  # tokens of both kinds in a block
TOGETHER = 1 << 18     # tokens of a block laid out at a time
LINKS = 1 << 20        # links laid out at a time
HEAD, MIDDLE, TAIL, WHOLE = 0, 1, 2, 3
# how a block's entry is cut: a document without tokens, a whole document, a
# whole stitched group, or (above 1) one of that many pieces of a document
NONE, SINGLE, STITCHED = 0, 1, -1
SIZES, IDS = b"s", b"i"  # how a block keeps its ids of B


class Tokenizers:
    """Both tokenizers with the bytes of every id (ids below 65,536)."""

    def __init__(self, vocab: str, ranks: str | None, pattern: str | None, model: str):
        import sentencepiece
        self.a = Encoder(vocab, ranks, pattern)
        self.a.special = []  # strings of special tokens are plain text
        self.a.slow.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        plain = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
        byte_of = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}
        names = [self.a.slow.id_to_token(i) for i in range(self.a.slow.get_vocab_size())]
        self.a_bytes = [bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in names]
        self.b_bytes = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_len = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_len = np.array([len(t) for t in self.b_bytes], np.int64)
        self.a_said = pa.array(self.a_bytes, pa.binary())
        # bytes to id of B; where a character has a piece, its byte's piece is not used
        plain_first = sorted(range(len(self.b_bytes)), key=lambda i: (self.b.is_byte(i), self.b.is_control(i) or self.b.is_unknown(i), i))
        named = {self.b_bytes[i]: i for i in reversed(plain_first)}
        self.b_said, self.b_id = pa.array(list(named), pa.binary()), np.array(list(named.values()), "<u2")

    def b_of(self, a: np.ndarray, sizes: np.ndarray) -> np.ndarray | None:
        """Ids of B from those of A and the sizes of B's pieces in bytes;
        None if some piece has no id."""
        text = self.a_said.take(pa.array(a)).buffers()[2]
        off = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(off), text if text is not None else pa.py_buffer(b"")])
        at = pc.index_in(pieces, value_set=self.b_said)
        return None if at.null_count else self.b_id[at.to_numpy()]

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def __call__(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """(ids of A, ids of B) per text; None for an empty text and where the
        bytes of either side are not a blank and the text."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1) if texts else []):
            raw = (" " + text).encode()
            a = self.a(" " + text) if text else []
            same = text and b"".join([self.b_bytes[i] for i in b]) == raw and b"".join([self.a_bytes[i] for i in a]) == raw
            out.append((a, b) if same else None)
        return out


_LOADED: dict[tuple, Tokenizers] = {}


def tokenizers(*key) -> Tokenizers:
    """One pair per Python worker and files."""
    if key not in _LOADED:
        _LOADED[key] = Tokenizers(*key)
    return _LOADED[key]


def merge_path(a: np.ndarray, b: np.ndarray, work: int) -> list[tuple[int, int, int, int]]:
    """Pieces (a from, a to, b from, b to) of the merge of two increasing
    arrays, ``work`` steps each. On the diagonal of step d the split (i, d - i)
    is the only one with a[i - 1] <= b[j] and b[j - 1] < a[i]; all diagonals
    are searched at once. Equal ends stay in one piece."""
    d = np.arange(work, len(a) + len(b), work, dtype=np.int64)
    lo, hi = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (lo < hi).any():
        live = lo < hi
        mid = (lo + hi) // 2
        first = np.zeros(len(d), bool)
        first[live] = a[mid[live]] <= b[d[live] - 1 - mid[live]]
        lo = np.where(live & first, mid + 1, lo)
        hi = np.where(live & ~first, mid, hi)
    i, j = lo, d - lo
    tie = (i > 0) & (j < len(b))
    tie[tie] = a[i[tie] - 1] == b[j[tie]]
    j = j + tie
    i, j = [0, *i.tolist(), len(a)], [0, *j.tolist(), len(b)]
    return [p for p in zip(i, i[1:], j, j[1:]) if p[1] > p[0] or p[3] > p[2]]


def _in(x: np.ndarray, sorted_y: np.ndarray) -> np.ndarray:
    if not len(sorted_y):
        return np.zeros(len(x), bool)
    return sorted_y[np.minimum(np.searchsorted(sorted_y, x), len(sorted_y) - 1)] == x


class Units:
    """The groups of a run of units, all laid out on flat arrays."""

    def __init__(self, t: Tokenizers, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray):
        self.a, self.b = a, b
        self.a_off, self.b_off = (np.concatenate([[0], np.cumsum(n, dtype=np.int64)]) for n in (n_a, n_b))
        a_end, b_end = np.cumsum(t.a_len[self.a]), np.cumsum(t.b_len[self.b])
        self.a_last, self.b_last = _in(a_end, b_end), _in(b_end, a_end)
        self.ga, self.gb = np.cumsum(self.a_last) - self.a_last, np.cumsum(self.b_last) - self.b_last
        self.n_groups = int(self.a_last.sum())
        self.a_in, self.b_in = np.bincount(self.ga, minlength=self.n_groups), np.bincount(self.gb, minlength=self.n_groups)
        self.a_from, self.b_from = np.cumsum(self.a_in) - self.a_in, np.cumsum(self.b_in) - self.b_in
        ends = np.concatenate([[0], np.cumsum(self.a_last)])
        self.group_off = ends[self.a_off]

    def per_unit(self) -> tuple[np.ndarray, np.ndarray]:
        """(groups, links) of every unit."""
        links = np.concatenate([[0], np.cumsum(self.a_in * self.b_in)])
        return np.diff(self.group_off), np.diff(links[self.group_off])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (unit << 32 | a << 16 | b), sorted, and their links."""
        size = self.a_in * self.b_in
        unit = np.repeat(np.arange(len(self.group_off) - 1), np.diff(self.group_off))
        big = size > LINKS
        keys, weights = [], []
        g = np.flatnonzero(~big)
        edge = np.searchsorted(np.cumsum(size[g]), np.arange(0, int(size[g].sum()) + LINKS, LINKS), side="right") if len(g) else [0]
        for x, y in zip(edge, [*edge[1:], len(g)]):
            k = self._expand(g[x:y], size, unit)
            if len(k):
                k.sort()
                new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
                keys.append(k[new])
                weights.append(np.diff(np.concatenate([new, [len(k)]])))
        for h in np.flatnonzero(big):  # a long group: distinct ids with their numbers, a few ids of A at a time
            a, n = np.unique(self.a[self.a_from[h]:self.a_from[h] + self.a_in[h]], return_counts=True)
            b, m = np.unique(self.b[self.b_from[h]:self.b_from[h] + self.b_in[h]], return_counts=True)
            for at in range(0, len(a), max(1, LINKS // len(b))):
                part = slice(at, at + max(1, LINKS // len(b)))
                keys.append(((unit[h] << 32) + (a[part].astype(np.int64)[:, None] << 16) + b.astype(np.int64)[None, :]).ravel())
                weights.append((n[part][:, None] * m[None, :]).ravel())
        if not keys:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if len(keys) == 1:
            return keys[0], weights[0]
        k, w = np.concatenate(keys), np.concatenate(weights)
        order = np.argsort(k, kind="stable")
        k, w = k[order], w[order]
        new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        return k[new], np.add.reduceat(w, new)

    def _expand(self, g: np.ndarray, size: np.ndarray, unit: np.ndarray) -> np.ndarray:
        n = size[g]
        if not n.sum():
            return np.empty(0, np.int64)
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(self.b_in[g], n)
        a = self.a[np.repeat(self.a_from[g], n) + at // width].astype(np.int64)
        b = self.b[np.repeat(self.b_from[g], n) + at % width].astype(np.int64)
        return (np.repeat(unit[g], n) << 32) + (a << 16) + b

    def written(self) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of ``a,a|b;a|b,b``; a unit's text is
        ``bytes[offsets[u]:offsets[u + 1] - 1]``."""
        n = len(self.a) + len(self.b)
        ids, sep = np.empty(n, np.uint16), np.full(n, ord(","), np.uint8)
        pa_ = np.arange(len(self.a)) + self.b_from[self.ga]
        pb = np.arange(len(self.b)) + (self.a_from + self.a_in)[self.gb]
        ids[pa_], ids[pb] = self.a, self.b
        sep[pa_[self.a_last]], sep[pb[self.b_last]] = ord("|"), ord(";")
        digits = 1 + sum((ids >= 10 ** k).astype(np.int64) for k in range(1, 5))
        start = np.concatenate([[0], np.cumsum(digits + 1)])
        out = np.empty(int(start[-1]), np.uint8)
        rest = ids.astype(np.int64)
        for k in range(5):
            here = digits > k
            out[(start[:-1] + digits - 1 - k)[here]] = rest[here] % 10 + ord("0")
            rest //= 10
        out[start[1:] - 1] = sep
        return out, start[self.a_off + self.b_off]


def _slices(t: Tokenizers, a: np.ndarray, b: np.ndarray, a0: int, b0: int, piece: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(part, a, b) of one piece whose lists start at bytes a0 and b0."""
    a_end, b_end = a0 + np.cumsum(t.a_len[a]), b0 + np.cumsum(t.b_len[b])
    hit_a, hit_b = np.flatnonzero(_in(a_end, b_end)), np.flatnonzero(_in(b_end, a_end))
    if not len(hit_a):
        return [(WHOLE, a, b)]
    i0, j0 = (hit_a[0] + 1, hit_b[0] + 1) if piece else (0, 0)
    i1, j1 = hit_a[-1] + 1, hit_b[-1] + 1
    return [(HEAD, a[:i0], b[:j0]), (MIDDLE, a[i0:i1], b[j0:j1]), (TAIL, a[i1:], b[j1:])]


_COLUMNS = ("doc", "piece", "pieces", "a0", "b0", "n_a", "n_b")
_BLOCK = "block long, id array<{kind}>, " + ", ".join(f"{c} array<long>" for c in _COLUMNS) + ", a binary, b binary"


class Block:
    """Entries (pieces of documents) being gathered into one row."""

    def __init__(self, number: int):
        self.number, self.tokens = number, 0
        self.ids, self.entries, self.a, self.b = [], [], [], []

    def add(self, id_: pa.Array, entry: tuple, a: np.ndarray, b: np.ndarray) -> None:
        self.ids.append(id_)
        self.entries.append((*entry, len(a), len(b)))
        self.a.append(a)
        self.b.append(b)
        self.tokens += len(a) + len(b)

    def row(self, t: Tokenizers) -> pa.RecordBatch:
        """One row. Given A, the sizes of B's pieces tell their ids; where
        they should not (each block is tried), the ids are kept."""
        n = len(self.entries)
        lists = [pa.concat_arrays(self.ids), *[pa.array(c, pa.int64()) for c in zip(*self.entries)]]
        a, b = np.concatenate(self.a).astype("<u2"), np.concatenate(self.b).astype("<u2")
        sizes = t.b_len[b]
        aligned = int(t.a_len[a].sum()) == int(sizes.sum()) and int(sizes.max(initial=0)) < 256
        same = aligned and (got := t.b_of(a, sizes)) is not None and np.array_equal(got, b)
        shrink = zstandard.ZstdCompressor(level=3).compress
        packed = [shrink(a.tobytes()), SIZES + shrink(sizes.astype(np.uint8).tobytes()) if same else IDS + shrink(b.tobytes())]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.number], pa.int64()), *[pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), c) for c in lists],
             *[pa.array([p], pa.binary()) for p in packed]], ["block", "id", *_COLUMNS, "a", "b"])


class Entries:
    """One row of a block, unpacked."""

    def __init__(self, t: Tokenizers, batch, i: int):
        self.block = batch.column("block")[i].as_py()
        self.id = batch.column("id")[i].values
        for c in _COLUMNS:
            setattr(self, c, batch.column(c)[i].values.to_numpy())
        a, b = (batch.column(c)[i].as_py() for c in "ab")
        expand = zstandard.ZstdDecompressor().decompress
        self.a, raw = np.frombuffer(expand(a), "<u2"), expand(b[1:])
        self.b = t.b_of(self.a, np.frombuffer(raw, np.uint8)) if b[:1] == SIZES else np.frombuffer(raw, "<u2")
        self.a_off, self.b_off = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))

    def parts(self, t: Tokenizers) -> Iterator[tuple[int, list[tuple[int, np.ndarray, np.ndarray]]]]:
        """(entry, its parts) of the entries that are pieces of a document."""
        for k in np.flatnonzero(self.pieces > 1).tolist():
            yield k, _slices(t, self.a[self.a_off[k]:self.a_off[k + 1]], self.b[self.b_off[k]:self.b_off[k + 1]],
                             int(self.a0[k]), int(self.b0[k]), int(self.piece[k]))

    def units(self, t: Tokenizers, tokens: int = TOGETHER) -> Iterator[tuple[slice, "Units"]]:
        """Runs of entries of about ``tokens`` tokens and their whole groups;
        pieces lose what lies before their first and after their last common
        end."""
        keep_a, keep_b = np.ones(len(self.a), bool), np.ones(len(self.b), bool)
        n_a, n_b = self.n_a.copy(), self.n_b.copy()
        for k, parts in self.parts(t):
            sizes = {p: (len(x), len(y)) for p, x, y in parts}
            head, middle = sizes.get(HEAD, (0, 0)), sizes.get(MIDDLE, (0, 0))
            for keep, off, at, n in ((keep_a, self.a_off, 0, n_a), (keep_b, self.b_off, 1, n_b)):
                keep[off[k]:off[k] + head[at]] = False
                keep[off[k] + head[at] + middle[at]:off[k + 1]] = False
                n[k] = middle[at]
        upto = self.a_off + self.b_off
        lo = 0
        while lo < len(self.doc):
            hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + tokens, "right")) - 1)
            x, y = (slice(off[lo], off[hi]) for off in (self.a_off, self.b_off))
            yield slice(lo, hi), Units(t, self.a[x][keep_a[x]], n_a[lo:hi], self.b[y][keep_b[y]], n_b[lo:hi])
            lo = hi


def _entries(t: Tokenizers, batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Entries(t, batch, i)


def _tokenise(key: tuple, work: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(*key)
        task = TaskContext.get().partitionId() << 32
        doc, block = task, Block(task)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for lo in range(0, len(texts), 256):
                for k, ab in enumerate(t(texts[lo:lo + 256]), lo):
                    doc += 1
                    a, b = (np.array(x, "<u2") for x in (ab or ((), ())))
                    ends = (np.cumsum(t.a_len[a]), np.cumsum(t.b_len[b]))
                    pieces = merge_path(*ends, work) if len(a) + len(b) > work else [(0, len(a), 0, len(b))]
                    for p, (i, i1, j, j1) in enumerate(pieces):
                        place = (doc, p, len(pieces) if ab else NONE, int(ends[0][i - 1]) if i else 0, int(ends[1][j - 1]) if j else 0)
                        block.add(batch.column(0).slice(k, 1), place, a[i:i1], b[j:j1])
                        if block.tokens > block_tokens or len(block.entries) >= 100_000:
                            yield block.row(t)
                            block = Block(block.number + 1)
        if block.entries:
            yield block.row(t)
    return run


def _fragments(key: tuple):
    """What pieces hold outside their own whole groups, and where a piece
    closes a group: its TAIL is there even when it is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(*key)
        for e in _entries(t, batches):
            found = [(k, p, a.tobytes(), b.tobytes()) for k, parts in e.parts(t) for p, a, b in parts if p != MIDDLE]
            if found:
                at, part, a, b = zip(*found)
                at = np.array(at)
                yield pa.RecordBatch.from_arrays([e.id.take(pa.array(at)), pa.array(e.doc[at]), pa.array(e.piece[at]), pa.array(part, pa.int32()),
                                                  pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["id", "doc", "piece", "part", "a", "b"])
    return run


def _stitched(key: tuple, block_tokens: int):
    """Blocks of stitched groups (id, doc, piece, a, b)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(*key)
        block = Block(-1 - (TaskContext.get().partitionId() << 32))
        for batch in batches:
            for k, (doc, piece, a, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc", "piece", "a", "b")))):
                block.add(batch.column("id").slice(k, 1), (doc, piece, STITCHED, 0, 0), np.frombuffer(a, "<u2"), np.frombuffer(b, "<u2"))
                if block.tokens > block_tokens:
                    yield block.row(t)
                    block = Block(block.number - 1)
        if block.entries:
            yield block.row(t)
    return run


def _listed(key: tuple):
    """(block, pair, n, doc): the pairs of every block, n of its whole
    documents hold them; and without block, the pairs of every entry that is
    only a part of document ``doc``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(*key)
        for e in _entries(t, batches):
            seen, of_docs = [], []
            docs, nth = np.unique(e.doc, return_inverse=True)
            for at, u in e.units(t):
                keys, _ = u.pairs()
                entry, pair = (keys >> 32) + at.start, keys & 0xFFFFFFFF
                whole = e.pieces[entry] == SINGLE
                found, where = np.unique(pair, return_inverse=True)
                seen.append((found, np.bincount(where, weights=whole, minlength=len(found)).astype(np.int64)))
                of_docs.append(np.unique((nth[entry[~whole]] << 32) + pair[~whole]))
            found, where = np.unique(np.concatenate([f for f, _ in seen]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([n for _, n in seen]), minlength=len(found)).astype(np.int64)
            parts = np.unique(np.concatenate(of_docs))  # once a document, not once a piece of it
            doc, rest = docs[parts >> 32], parts & 0xFFFFFFFF
            block = pa.array(np.concatenate([np.full(len(found), e.block), np.zeros(len(rest), np.int64)]), mask=np.arange(len(found) + len(rest)) >= len(found))
            doc = pa.array(np.concatenate([np.zeros(len(found), np.int64), doc]), mask=np.arange(len(found) + len(rest)) < len(found))
            yield pa.RecordBatch.from_arrays([block, pa.array(np.concatenate([found, rest])), pa.array(np.concatenate([n, np.zeros(len(rest), np.int64)])), doc],
                                             ["block", "pair", "n", "doc"])
    return run


def _runs(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)


def _scored(key: tuple, with_groups: bool):
    def run(blocks: pa.Table, counts: pa.Table) -> pa.Table:
        t = tokenizers(*key)
        order = np.argsort(counts["pair"].to_numpy(), kind="stable")
        pair, count, best = (counts[c].to_numpy()[order] for c in ("pair", "count", "best"))
        out = []
        for e in _entries(t, blocks.to_batches()):
            for at, u in e.units(t):
                keys, links = u.pairs()
                place, unit = np.searchsorted(pair, keys & 0xFFFFFFFF), keys >> 32
                n, kind = at.stop - at.start, e.pieces[at]
                sums = [np.zeros(n, np.int64), np.zeros(n, np.int64)]
                first = _runs(unit)
                if len(first):
                    for s, value in zip(sums, (links * best[place].astype(np.int64), links * count[place])):
                        s[unit[first]] = np.add.reduceat(value, first)
                groups, n_links = u.per_unit()
                text, off = u.written()
                said = [text[x:max(x, y - 1)].tobytes() for x, y in zip(off, off[1:])]
                single = (kind == SINGLE) | (kind == NONE)
                shown = pa.array([s if with_groups or not one else None for s, one in zip(said, single)], pa.binary())
                digest = pa.array([(hashlib.sha256(s).hexdigest() if s else "") if one else None for s, one in zip(said, single)], pa.string())
                rows = pa.table({"id": e.id[at.start:at.stop], "doc": e.doc[at], "single": single, "piece": e.piece[at],
                                 "part": np.where(kind == STITCHED, TAIL, MIDDLE).astype(np.int32), "n_a": np.diff(u.a_off), "n_b": np.diff(u.b_off),
                                 "n_groups": groups, "n_links": n_links, "n_best": sums[0], "count_sum": sums[1], "groups": shown, "sha": digest})
                out.append(rows.filter(pa.array(single | (groups > 0))))
        give_back()
        return pa.concat_tables(out)
    return run


def align(df: DataFrame, vocab: str, model: str, ranks: str | None = None, pattern: str | None = None, work: int = WORK,
          block_tokens: int = BLOCK_TOKENS, with_groups: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Units of all documents: id, doc (tells repeated ids apart), single (the
    document is this unit), piece and part (their order in a document), n_a,
    n_b, n_groups, n_links, n_best, count_sum, groups (``a,a|b;a|b,b`` in
    bytes) and, of single units, its SHA-256. ``with_groups=False`` leaves
    ``groups`` out where the digest is there.

    A NULL or empty text, and one that either side does not give back byte
    for byte, has one unit without tokens, its groups empty. Rows with one id
    are documents of their own, also a NULL id. Other columns, whatever their
    names, are not read. An empty table gives no rows. A group of any length
    is held whole; texts of any length are encoded in one call and then cut
    into pieces.
    """
    key = (vocab, ranks, pattern, model)
    kind = df.schema[id_col].dataType.simpleString()
    texts = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string"))
    blocks = cut(texts.mapInArrow(lean(_tokenise(key, work, block_tokens)), _BLOCK.format(kind=kind)))
    fragments = cut(blocks.where(F.exists("pieces", lambda p: p > 1))
                    .mapInArrow(lean(_fragments(key)), f"id {kind}, doc long, piece long, part int, a binary, b binary"))
    order = W.partitionBy("doc").orderBy("piece", "part").rowsBetween(W.unboundedPreceding, 0)
    closed = F.coalesce(F.last(F.when(F.col("part") == TAIL, F.col("piece")), ignorenulls=True).over(order), F.lit(-1).cast("long"))

    def joined(side: str):
        return F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p[side])), "")).alias(side)

    stitched = (fragments.withColumn("after", closed).groupBy("doc", "after")
                .agg(F.first("id").alias("id"), F.sort_array(F.collect_list(F.struct("piece", "part", "a", "b"))).alias("parts"))
                .select("id", "doc", F.col("after").alias("piece"), joined("a"), joined("b")).where("length(a) > 0")
                .mapInArrow(lean(_stitched(key, block_tokens)), _BLOCK.format(kind=kind)))
    blocks = blocks.unionByName(cut(stitched))

    listed = cut(blocks.mapInArrow(lean(_listed(key)), "block long, pair long, n long, doc long"))
    of_docs = listed.where("block is null").select("doc", "pair").distinct()
    listed = listed.where("block is not null")
    counts = (listed.select("pair", "n").unionByName(of_docs.select("pair", F.lit(1).cast("long").alias("n")))
              .groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.shiftright("pair", 16)))
    counts = cut(counts)
    highest = counts.groupBy(F.col("a").alias("of")).agg(F.max("count").alias("most"))  # at most one row per id of A
    known = counts.join(F.broadcast(highest), F.col("a") == F.col("of")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = listed.select("block", "pair").join(known, "pair").select("block", "pair", "count", "best")
    fields = {"id": kind, "doc": "long", "single": "boolean", "piece": "long", "part": "int", "n_a": "long", "n_b": "long", "n_groups": "long",
              "n_links": "long", "n_best": "long", "count_sum": "long", "groups": "binary", "sha": "string"}
    return (blocks.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_scored(key, with_groups), ", ".join(f"{c} {k}" for c, k in fields.items())))


def _hash_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, sha) from (doc, groups) rows, a document's in order: one running hash."""
    doc, h = None, None
    for b in batches:
        docs, hashes = [], []
        for d, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if d != doc:
                if doc is not None:
                    docs.append(doc)
                    hashes.append(h.hexdigest())
                doc, h = d, hashlib.sha256(s)
            else:
                h.update(b";" + s)
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(hashes, pa.string())], ["hdoc", "sha"])
    if doc is not None:
        yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([h.hexdigest()], pa.string())], ["hdoc", "sha"])


def by_document(units: DataFrame) -> DataFrame:
    """One row per document of ``align``: sums, and the digest of all its groups."""
    units = cut(units)
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    one = units.where("single").select("id", *sums, "sha")
    many = units.where("not single")
    sha = (many.select("doc", "piece", "part", "groups").repartition("doc").sortWithinPartitions("doc", "piece", "part")
           .select("doc", "groups").mapInArrow(_hash_documents, "hdoc long, sha string"))
    total = many.groupBy("doc").agg(F.first("id").alias("id"), *[F.sum(c).alias(c) for c in sums])
    return one.unionByName(total.join(sha, F.col("doc") == F.col("hdoc")).select("id", *sums, "sha"))


def op13_merge_path_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment figures of every document under both public vocabularies."""
    import public_tokenizers as P
    units = align(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"),
                  P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_groups=False)
    return by_document(units).select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                     F.col("sha").alias("groups_sha256"))
