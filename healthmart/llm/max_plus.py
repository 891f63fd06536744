"""SentencePiece encoding and decoding by a max-plus scan over chunks.

The encoding of a text is the way to cut it into vocabulary pieces with the
largest sum of scores. A giant text is cut into chunks of fixed length that
any task may take. The state at a chunk border is how many characters of the
piece that spans it lie before the border (0: the border is a piece's end).

1. Each chunk yields a matrix: the best sum from every state at its left
   border to every state at its right one. The matrices of a run of chunks
   are combined by the max-plus product, which is associative, in one group
   per run; a text's few run matrices are scanned, and from the vector at its
   start every run derives those at its inner borders: the best sums at the
   places before each chunk, as one pass over the whole text would have them.
2. From these, every chunk has back pointers of its own and is traced back
   from each of its few right states: that gives the left state it leads to,
   and what the chunk's pieces are in that case. The first, as a matrix of
   zeros, is scanned the same way from the right, and the state found there
   picks the second. So a giant text is shuffled once.

Of cuts with equal sums the one whose last piece is longest wins, at every
place; as the sums before a chunk are exact, ids do not depend on where the
text was cut (scores of this kind of vocabulary are whole numbers).

Inside a chunk the recurrence runs over units, a run of blanks and what
follows up to the next one: no piece of such a vocabulary goes on from a
letter to a blank, so between units the state is 0; line ends, which no
piece holds, stand alone. Equal units of a batch are solved once, many at a
time, place by place, on arrays. Characters that the vocabulary lacks become
byte pieces, scored ``UNKNOWN`` below the least piece.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart.llm.common import cut, lean, mix64, quoted, table

CHUNK = 16384
UNKNOWN = 10.0
BLANK = "▁"
RUN = 32             # chunks whose matrices are combined in one group
SHORT = 48           # characters up to which units are solved on arrays
TOGETHER = 1 << 22   # characters whose units are looked through at a time
SLOTS = 1 << 20      # of the hash table of piece prefixes
_UNIT = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
_NO = -np.inf


@dataclass
class Pieces:
    """A vocabulary with scores; ``byte_ids`` are the ids of the 256 bytes."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    longest: int
    least: float
    whole_units: bool  # no piece has a blank after another character, or a line end

    def __post_init__(self):
        self.spelled = {i: p.replace(BLANK, " ").encode() for p, i in self.ids.items()}
        self.spelled |= {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        self.said = pa.array([self.spelled.get(i, b"") for i in range(max(self.spelled) + 1)], pa.large_binary())
        # prefixes of all pieces by rolling hash, open addressing; a score marks whole pieces
        prefixes: dict[int, tuple[float, int]] = {}
        for piece, score in self.scores.items():
            h = np.zeros(1, np.uint64)
            for n, c in enumerate(piece):
                h = _roll(h, np.array([ord(c)], np.uint64))
                prefixes[int(h[0])] = (score, self.ids[piece]) if n == len(piece) - 1 else prefixes.get(int(h[0]), (_NO, -1))
        self.keys, self.values, self.names, self.probes = np.zeros(SLOTS, np.uint64), np.full(SLOTS, _NO), np.full(SLOTS, -1, np.int32), 1
        for h, (score, name) in prefixes.items():
            at, tries = h % SLOTS, 1
            while self.keys[at]:
                at, tries = (at + 1) % SLOTS, tries + 1
            self.keys[at], self.values[at], self.names[at] = h, score, name
            self.probes = max(self.probes, tries)

    @classmethod
    def load(cls, model_file: str) -> Pieces:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids, scores, byte_ids = {}, {}, [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                ids[piece], scores[piece] = i, sp.get_score(i)
        # scores far below the rest mark pieces to be avoided, not measured
        usual = [s for s in scores.values() if s > -1e8]
        least = min(usual, default=0.0)
        scores = {p: max(s, least - UNKNOWN + 1) for p, s in scores.items()}
        return cls(ids, scores, byte_ids, max(map(len, ids), default=1), least - UNKNOWN,
                   not any(re.search(f"[^{BLANK}]{BLANK}|\n", p) for p in ids))

    def paths(self, text: str, lo: int, hi: int, begin: dict[int, float], known: int | None = None) -> tuple[list[float], list[int]]:
        """Best sums at places lo..hi of ``text`` and the length of the last
        piece there, from the sums that ``begin`` gives (by place; places
        after lo are ends of pieces that began before it). Up to ``known``
        these are final."""
        best, back = [_NO] * (hi - lo + 1), [0] * (hi - lo + 1)
        for p, s in begin.items():
            best[p - lo] = s
        score, longest, least = self.scores.get, self.longest, self.least
        for i in range((lo if known is None else known) + 1, hi + 1):
            top, length = best[i - lo], 0
            for n in range(min(longest, i - lo), 0, -1):
                before = best[i - lo - n]
                if before == _NO:
                    continue
                s = score(text[i - n:i])
                if s is None:
                    if n > 1:
                        continue
                    s = least
                if before + s > top:
                    top, length = before + s, n
            best[i - lo], back[i - lo] = top, length
        return best, back

    def emit(self, piece: str) -> list[int]:
        got = self.ids.get(piece)
        return [got] if got is not None else [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]

    def trace(self, text: str, lo: int, back: list[int], end: int) -> list[int]:
        """Ids of the pieces from the last begin of a path to ``end``."""
        out: list[list[int]] = []
        while end > lo and back[end - lo]:
            n = back[end - lo]
            out.append(self.emit(text[end - n:end]))
            end -= n
        return [i for ids in reversed(out) for i in ids]

    def solve(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units one after the other, number of ids of each): all
        places of all units at once, from the first characters to the last,
        and back."""
        size = np.array(list(map(len, units)))
        order = np.argsort(-size, kind="stable")
        size = size[order]
        chars = np.frombuffer("".join([units[i] for i in order.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        start = np.cumsum(size) - size
        left = np.repeat(start + size, size) - np.arange(len(chars))
        step = np.full((self.longest, len(chars)), _NO)  # score of the piece of n + 1 characters that begins here
        name = np.full((self.longest, len(chars)), -1, np.int32)  # and its id
        at, h = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
        for n in range(self.longest):
            go = left[at] > n
            at, h = at[go], h[go]
            if not len(at):
                break
            h = _roll(h, chars[at + n])
            slot = (h % np.uint64(SLOTS)).astype(np.int64)
            known = np.zeros(len(at), bool)
            for probe in range(self.probes):
                p = (slot + probe) % SLOTS
                hit = np.flatnonzero(self.keys[p] == h)
                step[n, at[hit]], name[n, at[hit]], known[hit] = self.values[p[hit]], self.names[p[hit]], True
            at, h = at[known], h[known]
        step[0][step[0] == _NO] = self.least
        best = np.full((int(size.max()) + 1, len(units)), _NO)
        back = np.zeros(best.shape, np.uint8)
        best[0] = 0.0
        for i in range(1, len(best)):
            k = int(np.searchsorted(-size, -i, "right"))  # units at least this long come first
            top, length = best[i, :k], back[i, :k]
            for n in range(min(self.longest, i), 0, -1):
                s = best[i - n, :k] + step[n - 1, start[:k] + i - n]
                better = s > top
                top[better] = s[better]
                length[better] = n
        unit, begin, piece = [], [], []
        j, end = np.arange(len(units)), size
        while len(j):
            n = back[end, j].astype(np.int64)
            end = end - n
            unit.append(j)
            begin.append(end)
            piece.append(name[n - 1, start[j] + end])
            j, end = j[end > 0], end[end > 0]
        unit, begin, piece = order[np.concatenate(unit)], np.concatenate(begin), np.concatenate(piece)
        order = np.lexsort((begin, unit))
        unit, begin, piece = unit[order], begin[order], piece[order]
        strange = np.flatnonzero(piece < 0)  # characters that go by their bytes
        spelt = [self.emit(units[unit[i]][begin[i]]) for i in strange.tolist()]
        width = np.ones(len(piece), np.int64)
        width[strange] = [len(x) for x in spelt]
        ids, first = np.repeat(piece, width), np.cumsum(width) - width
        for i, x in zip(strange.tolist(), spelt, strict=True):
            ids[first[i]:first[i] + len(x)] = x
        return ids, np.bincount(unit, weights=width, minlength=len(units)).astype(np.int64)

    def spell(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all units one after the other, number of ids of each,
        whether its ids spell the unit). Equal units are solved once."""
        if not units:
            return np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, bool)
        coded = pa.array(units, pa.large_string()).dictionary_encode()
        code, names = coded.indices.to_numpy(), coded.dictionary
        distinct, size = names.to_pylist(), pc.utf8_length(names).to_numpy()
        order = np.argsort(size, kind="stable")
        short = order[size[order] <= SHORT]
        parts, counts = [], np.zeros(len(distinct), np.int64)
        for a in range(0, len(short), 8192):
            some = short[a:a + 8192]
            ids, counts[some] = self.solve([distinct[i] for i in some.tolist()])
            parts.append(ids)
        for i in order[len(short):].tolist():
            u = distinct[i]
            ids = np.array(self.trace(u, 0, self.paths(u, 0, len(u), {0: 0.0})[1], len(u)), np.int32)
            counts[i] = len(ids)
            parts.append(ids)
        flat = np.concatenate(parts)
        begin = np.empty(len(distinct), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        same = self._spelt(names.take(pa.array(order)), flat, counts[order])[np.argsort(order)]
        n = counts[code]
        return flat[np.repeat(begin[code] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n, same[code]

    def _spelt(self, units: pa.Array, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Whether the ids of every unit spell it: all bytes at once, and unit
        by unit only if something differs."""
        plain = pc.replace_substring(units, BLANK, " ").cast(pa.large_binary())
        said = self.said.take(pa.array(ids))
        ends = np.cumsum(counts)
        upto = np.frombuffer(said.buffers()[1], np.int64)[said.offset + ends]
        if np.array_equal(upto, np.cumsum(pc.binary_length(plain).to_numpy())) and \
                memoryview(said.buffers()[2] or b"") == memoryview(plain.buffers()[2] or b"")[:int(upto[-1])]:
            return np.ones(len(units), bool)
        each = zip(plain.to_pylist(), (ends - counts).tolist(), ends.tolist(), strict=True)
        return np.array([b"".join(said[a:b].to_pylist()) == u for u, a, b in each], bool)

    def units(self, text: str) -> list[str]:
        return _UNIT.findall(text) if self.whole_units else [text]

    def encode(self, text: str) -> list[int]:
        """Ids of a text that is one chunk."""
        return self.spell(self.units(prepared(text)))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "surrogatepass")

    # -- chunks ---------------------------------------------------------

    def entries(self, text: str, lo: int, hi: int, state: int) -> dict[int, float]:
        """Where a path that enters at ``lo`` in ``state`` first ends a piece."""
        if state == 0:
            return {lo: 0.0}
        out = {}
        for e in range(lo + 1, min(lo - state + self.longest, hi) + 1):
            s = self.scores.get(text[lo - state:e]) if lo >= state else None
            if s is not None:
                out[e] = s
        return out

    def _borders(self, text: str, lo: int, hi: int) -> tuple[int, int]:
        """First and last place in a chunk where a unit begins; equal to
        (hi, hi) if none does."""
        if not self.whole_units:
            return hi, hi
        begins = [m.start() for m in re.finditer(f"(?<!{BLANK}){BLANK}", text[max(lo - 1, 0):hi])]
        begins = [b + max(lo - 1, 0) for b in begins if b + max(lo - 1, 0) >= lo]
        return (begins[0], begins[-1]) if begins else (hi, hi)

    def matrix(self, text: str, lo: int, hi: int) -> np.ndarray:
        """(state at lo, state at hi) to the best sum over the chunk
        text[lo:hi]; text holds ``longest - 1`` characters before lo. Where
        units begin in the chunk, all paths meet at the first and the last of
        them; the sum between those is the same in every cell and left out."""
        n = self.longest
        out = np.full((n, n), _NO)
        first, last = self._borders(text, lo, hi)
        exits = range(min(n, hi - lo + 1))
        if first == hi:
            for s in range(min(n, lo + 1)):
                best, _ = self.paths(text, lo, hi, self.entries(text, lo, hi, s))
                for t in exits:
                    out[s, t] = best[hi - t - lo]
            return out
        tail, _ = self.paths(text, last, hi, {last: 0.0})
        for s in range(min(n, lo + 1)):
            head = self.paths(text, lo, first, self.entries(text, lo, first, s))[0][first - lo] if first > lo else (0.0 if s == 0 else _NO)
            for t in exits:
                if hi - t >= last:
                    out[s, t] = head + tail[hi - t - last]
        return out

    def head(self, text: str, lo: int, end: int, before: np.ndarray) -> tuple[int, list[float], list[int]]:
        """(first place looked at, best sums, lengths of last pieces) up to
        ``end``; before[s] is the best sum at the place lo - s."""
        a = max(0, lo - len(before) + 1)
        begin = {lo - s: float(before[s]) for s in range(lo - a + 1) if before[s] != _NO}
        return (a, *self.paths(text, a, end, begin, known=lo))

    def outcomes(self, text: str, lo: int, hi: int, before: np.ndarray) -> tuple[np.ndarray, bool, list[tuple[int, list[int], bool] | None]]:
        """The pieces that end in the chunk text[lo:hi] (the one that spans
        the left border is its own): ids that come first whatever the right
        state, whether they spell their part, and for every right state the
        left state that the best path there comes from, the ids that follow
        and whether these spell theirs; None where no path ends."""
        first, last = self._borders(text, lo, hi)
        a, best, back = self.head(text, lo, first, before)

        def spells(ids: list[int], x: int, y: int) -> bool:
            return self.decode(ids) == text[x:y].replace(BLANK, " ")

        def traced(at: int) -> tuple[int, list[int]]:
            rest = []
            while at > lo:
                n = back[at - a]
                rest.append(self.emit(text[at - n:at]))
                at -= n
            return at, [i for ids in reversed(rest) for i in ids]

        exits, out = range(min(self.longest, hi - lo + 1)), []
        if first == hi:
            for t in exits:
                begin, ids = traced(hi - t) if best[hi - t - a] != _NO else (0, None)
                out.append(None if ids is None else (lo - begin, ids, spells(ids, begin, hi - t)))
            return np.empty(0, "<u4"), True, out
        begin, ids = traced(first)
        middle, _, same = self.spell(self.units(text[first:last]))
        tail, back_tail = self.paths(text, last, hi, {last: 0.0})
        for t in exits:
            end = hi - t
            more = self.trace(text, last, back_tail, end) if end >= last and tail[end - last] != _NO else None
            out.append(None if more is None else (lo - begin, more, spells(more, last, end)))
        return np.concatenate([np.array(ids, "<u4"), middle.astype("<u4")]), bool(same.all()) and spells(ids, begin, first), out


def _roll(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    return mix64(h * np.uint64(31) + c + np.uint64(1))


def prepared(text: str) -> str:
    """Blanks become marks and one is put in front, as the vocabulary has
    it; the empty text stays empty."""
    return BLANK + text.replace(BLANK, " ").replace(" ", BLANK) if text else ""


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(1)


def _cells(binary: bytes) -> np.ndarray:
    x = np.frombuffer(binary, np.float64)
    side = int(len(x) ** 0.5)
    return x.reshape(side, side)


def _ordered(t: pa.Table, by: str) -> tuple[pa.Table, list[np.ndarray]]:
    t = t.sort_by(by)
    return t, [_cells(c) for c in t["cells"].to_pylist()]


def scan(matrices: DataFrame, run: int = RUN) -> DataFrame:
    """(row, chunk, before): for every chunk the max-plus product, from state
    0, of the matrices of the chunks before it. ``matrices``: (row, chunk,
    cells), in the order of chunk. Products of runs in parallel, a scan over
    the few products of a row, inner vectors of the runs in parallel."""
    m = matrices.withColumn("run", F.floor(F.col("chunk") / F.lit(run)).cast("long"))

    def product(t: pa.Table) -> pa.Table:
        t, ms = _ordered(t, "chunk")
        while len(ms) > 1:  # a tree of products
            ms = [max_plus(*ms[i:i + 2]) if i + 1 < len(ms) else ms[i] for i in range(0, len(ms), 2)]
        return pa.table({"row": t["row"][:1], "run": t["run"][:1], "cells": pa.array([ms[0].tobytes()], pa.binary())})

    def vectors(start: np.ndarray, ms: list[np.ndarray]) -> list[np.ndarray]:
        out = [start]
        for x in ms[:-1]:
            out.append((out[-1][:, None] + x).max(0))
        return out

    def starts(t: pa.Table) -> pa.Table:
        t, ms = _ordered(t, "run")
        got = vectors(np.where(np.arange(len(ms[0])) == 0, 0.0, _NO), ms)
        return pa.table({"row": t["row"], "run": t["run"], "start": pa.array([v.tobytes() for v in got], pa.binary())})

    def inner(t: pa.Table, s: pa.Table) -> pa.Table:
        t, ms = _ordered(t, "chunk")
        got = vectors(np.frombuffer(s["start"][0].as_py(), np.float64), ms)
        return pa.table({"row": t["row"], "chunk": t["chunk"], "before": pa.array([v.tobytes() for v in got], pa.binary())})

    products = m.groupBy("row", "run").applyInArrow(product, "row long, run long, cells binary")
    begun = products.groupBy("row").applyInArrow(starts, "row long, run long, start binary")
    return m.groupBy("row", "run").cogroup(begun.groupBy("row", "run")).applyInArrow(inner, "row long, chunk long, before binary")


_LOADED: dict[str, Pieces] = {}


def pieces(model_file: str) -> Pieces:
    if model_file not in _LOADED:
        _LOADED[model_file] = Pieces.load(model_file)
    return _LOADED[model_file]


def _chunks(model_file: str, size: int):
    """Prepared texts as chunks, each with the characters before it that a
    spanning piece may need."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        keep = pieces(model_file).longest - 1
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = [[], [], [], [], [], []]
            for i, text in enumerate(batch.column(1).to_pylist()):
                t = prepared(text or "")
                n = max(1, -(-len(t) // size))
                for k in range(n):
                    lo = max(0, k * size - keep)
                    for c, x in zip(out, (i, row, k, n, k * size - lo, t[lo:(k + 1) * size]), strict=True):
                        c.append(x)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64()), pa.array(out[5], pa.string())],
                ["id", "row", "chunk", "n", "lo", "text"])
    return run


def _groups(texts: list[str], size: int = TOGETHER) -> Iterator[list[str]]:
    """Texts in runs of about ``size`` characters, whose units are solved
    together."""
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t)
        if n >= size:
            yield run
            run, n = [], 0
    if run:
        yield run


def _encoded(model_file: str, with_ids: bool):
    """Ids of texts that are one chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_file)
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            out: list[tuple[np.ndarray, bool]] = []
            for group in _groups(cols["text"].to_pylist()):
                cuts = [p.units(text) for text in group]
                ids, n, same = p.spell([u for units in cuts for u in units])
                ids, per = ids.astype("<u4"), np.array([len(c) for c in cuts])
                ends = np.concatenate([[0], np.cumsum(per)])
                token, wrong = (np.concatenate([[0], np.cumsum(x)])[ends].tolist() for x in (n, ~same))
                out += [(ids[a:b], v == w) for a, b, v, w in zip(token, token[1:], wrong, wrong[1:], strict=False)]
            yield _result([cols["id"], cols["row"], cols["chunk"]], out, with_ids)
    return run


def _result(keys: list[pa.Array], out: list[tuple[np.ndarray, bool]], with_ids: bool) -> pa.RecordBatch:
    done = [*keys, pa.array([len(x) for x, _ in out], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x, _ in out], pa.int64()),
            pa.array([bool(s) for _, s in out], pa.bool_())]
    if with_ids:
        done.append(pa.array([x.astype(np.int32) for x, _ in out], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(done, ["id", "row", "chunk", "n_tokens", "ids_crc32", "round_trip", "ids"][:len(done)])


def encode_texts(df: DataFrame, model_file: str, chunk: int = CHUNK, with_ids: bool = True,
                 id_col: str = "doc_id", text_col: str = "text", run: int = RUN) -> DataFrame:
    """One row per chunk: id, row (tells repeated ids apart), chunk (from 0),
    n_tokens, ids_crc32, round_trip (decoding gives back the characters that
    the chunk's pieces cover) and ids. A text's ids are its chunks' in order,
    the same for any ``chunk`` (not less than the longest piece) and ``run``.

    NULL and empty texts have one chunk without tokens. A blank mark in a
    text counts as a blank. Repeated rows are encoded each; an empty table
    gives no rows. Other columns are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()
    chunk = max(chunk, pieces(model_file).longest)
    texts = df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))
    schema = f"id {kind}, row long, chunk long, n long, lo long, text string"
    out = f"id {kind}, row long, chunk long, n_tokens long, ids_crc32 long, round_trip boolean" + (", ids array<int>" if with_ids else "")
    # a text of one chunk starts and ends in state 0; only giant texts need the scans
    short = texts.where(F.coalesce(F.length("text"), F.lit(0)) < chunk).mapInArrow(lean(_chunks(model_file, chunk)), schema)
    giant = cut(texts.where(F.length("text") >= chunk).mapInArrow(lean(_chunks(model_file, chunk)), schema).withColumn("row", -1 - F.col("row")))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_file)
        for b in batches:
            cells = [p.matrix(t, lo, len(t)).tobytes() for t, lo in zip(b.column(3).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cells, pa.binary())], ["row", "chunk", "cells"])

    def outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per chunk: which left state each right one comes from
        (transposed and counted backwards, for a scan from the right), and
        the result in the case of each right state."""
        p = pieces(model_file)
        for b in batches:
            cols = {f.name: b.column(i) for i, f in enumerate(b.schema)}
            cells, cases = [], []
            for text, lo, before in zip(*(cols[c].to_pylist() for c in ("text", "lo", "before")), strict=True):
                m, case = np.full((p.longest, p.longest), _NO), []
                common, spelt, rest = p.outcomes(text, lo, len(text), np.frombuffer(before, np.float64))
                crc = zlib.crc32(common.tobytes())
                for t, x in enumerate(rest):
                    more = np.array(x[1] if x else [], "<u4")
                    if x:
                        m[t, x[0]] = 0.0
                    one = {"n_tokens": len(common) + len(more), "ids_crc32": zlib.crc32(more.tobytes(), crc), "round_trip": bool(x and spelt and x[2])}
                    case.append(one | ({"ids": np.concatenate([common, more]).astype(np.int32)} if with_ids else {}))
                cells.append(m.tobytes())
                cases.append(case)
            fields = [("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("round_trip", pa.bool_()), *([("ids", pa.list_(pa.int32()))] if with_ids else [])]
            yield pa.RecordBatch.from_arrays([cols["id"], cols["row"], cols["chunk"], pa.array(cells, pa.binary()),
                                              pa.array(cases, pa.list_(pa.struct(fields)))], ["id", "row", "chunk", "cells", "cases"])

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            state = [int(np.frombuffer(v, np.float64).argmax()) for v in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(-b.column(1).to_numpy()), pa.array(state, pa.int64())], ["row", "chunk", "leave"])

    before = scan(giant.select("row", "chunk", "lo", "text").mapInArrow(lean(matrices), "row long, chunk long, cells binary"), run)
    case = "struct<n_tokens: bigint, ids_crc32: bigint, round_trip: boolean" + (", ids: array<int>>" if with_ids else ">")
    known = cut(giant.join(before, ["row", "chunk"]).select("id", "row", "chunk", "lo", "text", "before")
                .mapInArrow(lean(outcomes), f"id {kind}, row long, chunk long, cells binary, cases array<{case}>"))
    leave = scan(known.select("row", (-F.col("chunk")).alias("chunk"), "cells"), run).mapInArrow(left, "row long, chunk long, leave long")
    long = known.join(leave, ["row", "chunk"]).select("id", "row", "chunk", F.get("cases", F.col("leave").cast("int")).alias("case"))
    short = short.select("id", "row", "chunk", "text").mapInArrow(lean(_encoded(model_file, with_ids)), out)
    return short.unionByName(long.select("id", "row", "chunk", "case.*"))


def op6_max_plus_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding of every whole text of ``documents``, by chunk."""
    import public_tokenizers as P
    out = encode_texts(table(spark, sf_dir, "documents"), P.path("piece_bpe_32k.model"), with_ids=False)
    return out.select(F.col("id").alias("doc_id"), "chunk", "n_tokens", "ids_crc32", "round_trip")
