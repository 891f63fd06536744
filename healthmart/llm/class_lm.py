"""Language-model scoring by a Brown class-based bigram model.

P(w | previous) = MIX * P(class(w) | class(previous)) * P(w | class(w))
                + (1 - MIX) * P_base(w).

Classes come from exchange clustering of every word of the learning fold:
from all its bigrams each word's counts with every class are summed, and a
word moves to the class that raises the class-bigram likelihood most. Half
of the words may move per round (the halves alternate), so moves decided on
the same counts do not undo each other. Only words that the learning fold
lacks take the class that its words with the same last two bytes mostly
have. Class transitions and class sizes are counted over every token of the
learning fold.

Within a class, a share of the probability is set aside for unseen words:
the share of its tokens whose word occurs once. All unseen words are one
event, as in the base.

Texts are tokenised once, into blocks (one per Arrow batch): the block's
distinct words, ordered by their crc32, and its tokens as places among them.
Words live in parts, ranges of crc32, whose number grows with the input; a
part knows which of its words each block holds. Every round the parts tell
the blocks the classes of their words, and the blocks send back counts of
words with classes, packed per part. Scoring is told counts and classes the
same way. The driver gets class-by-class counts and one class per ending.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart.llm.common import cut, give_back, held_out, lean, quoted, table

FOLDS, HELD = 5, 1
CLASSES, SWEEPS = 64, 6  # at most 128 classes: one bit of a byte marks the words on turn
MIX, PRIOR = 0.8, 2.0
ENTRIES = 1 << 17  # words of blocks that one part holds, on average
CHUNK = 1024  # words whose gains are computed at a time

END = b""  # the end token; no word is empty


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"),
                     held_out(F.col(quoted(id_col)), FOLDS, HELD).alias("held_out"))


def _packed(x: np.ndarray, kind: type = np.int32) -> bytes:
    """Compressed by byte planes: most high bytes are zero."""
    x = np.ascontiguousarray(x, kind)
    return zlib.compress(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes(), 1)


def _unpacked(blob: bytes, kind: type = np.int32) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).view(kind).reshape(-1)


def _joined(words: list[bytes]) -> bytes:
    """Compressed; no word holds a blank."""
    return zlib.compress(b" ".join(words), 1)


def _split(blob: bytes) -> list[bytes]:
    return zlib.decompress(blob).split(b" ")


def _crcs(vocab: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, vocab), np.int64, len(vocab))


_BLOCKS = "block long, size int, id array<{kind}>, learned int, lens binary, learn binary, rest binary, words binary, n binary"


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per batch, texts of the learning fold first. Words are ordered
    by crc32, so the end token (crc32 0) is word 0."""
    from pyspark import TaskContext
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        if not len(batch):
            continue
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        batch = batch.take(pa.array(np.argsort(held, kind="stable")))
        lists = pc.ascii_split_whitespace(pc.ascii_lower(batch.column(1).fill_null("")))  # exactly A-Z, and \x20, \x09-\x0D
        flat = lists.flatten()
        word = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
        text = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))[word]
        coded = flat.filter(pa.array(word)).dictionary_encode()
        vocab = [END, *coded.dictionary.cast(pa.binary()).to_pylist()]
        lens = np.bincount(text, minlength=len(batch)) + 1
        inner = np.ones(lens.sum(), bool)
        inner[np.cumsum(lens) - 1] = False
        tokens = np.zeros(len(inner), np.int64)
        tokens[inner] = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        order = np.argsort(_crcs(vocab), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        tokens = place[tokens]
        learned = len(held) - int(held.sum())
        at = int(lens[:learned].sum())
        n = np.bincount(tokens[:at], minlength=len(vocab))
        ids = pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), batch.column(0))
        yield pa.RecordBatch.from_arrays([
            pa.array([block]), pa.array([len(vocab)], pa.int32()), ids, pa.array([learned], pa.int32()),
            *(pa.array([x], pa.binary()) for x in (_packed(lens), _packed(tokens[:at]), _packed(tokens[at:]),
                                                  _joined([vocab[i] for i in order]), _packed(n, np.int64))),
        ], ["block", "size", "id", "learned", "lens", "learn", "rest", "words", "n"])
        block += 1


def _part_of(crc: np.ndarray, parts: int) -> np.ndarray:
    return crc * parts >> 32


_DEALT = "part int, block long, size int, words binary, n binary"


def _dealt(parts: int):
    """The words of every block, a row per part of the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, words, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words, n = _split(words), _unpacked(n, np.int64)
                part = _part_of(_crcs(words), parts)
                at = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
                cuts = list(zip(at, [*at[1:], len(words)], strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[at], pa.int32()), pa.array(np.full(len(at), block)), pa.array([e - a for a, e in cuts], pa.int32()),
                    pa.array([_joined(words[a:e]) for a, e in cuts], pa.binary()),
                    pa.array([_packed(n[a:e], np.int64) for a, e in cuts], pa.binary())], ["part", "block", "size", "words", "n"])
    return run


_SHELVES = "part int, words binary, n binary, block array<long>, sizes array<int>, slots binary"


def _shelved(t: pa.Table) -> pa.Table:
    """One part: its distinct words with their counts, and the words of each
    block as places among them."""
    t = t.sort_by("block")
    coded = pa.array([w for blob in t["words"].to_pylist() for w in _split(blob)], pa.binary()).dictionary_encode()
    slots = coded.indices.to_numpy(zero_copy_only=False)
    n = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(n, slots, np.concatenate([_unpacked(x, np.int64) for x in t["n"].to_pylist()]))
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.combine_chunks())
    blob = lambda x: pa.array([x], pa.binary())
    out = pa.table({"part": t["part"].slice(0, 1), "words": blob(_joined(coded.dictionary.to_pylist())), "n": blob(_packed(n, np.int64)),
                    "block": one(t["block"]), "sizes": one(t["size"]), "slots": blob(_packed(slots))})
    give_back()
    return out


def _first_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cls = [(_crcs(_split(words)) % CLASSES).astype(np.uint8).tobytes() for words in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cls, pa.binary())], ["part", "cls"])


def _said(turn: int | None):
    """To every block, from every part: the classes of the block's words.
    The high bit marks the words on turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, blocks, sizes, slots, cls in zip(*(c.to_pylist() for c in b.columns), strict=True):
                cls = np.frombuffer(cls, np.uint8).copy()
                if turn is not None:
                    cls[turn::2] |= 128
                ends = np.cumsum(sizes)
                said = cls[_unpacked(slots)].tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(blocks, pa.int64()), pa.array(np.full(len(blocks), part), pa.int32()),
                    pa.array([said[e - s:e] for s, e in zip(sizes, ends.tolist(), strict=True)], pa.binary())], ["block", "part", "said"])
    return run


def _heard(right: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """What the parts said to one block: in the order of its words."""
    right = right.sort_by("part")
    blobs = right["said"].to_pylist()
    return right, np.frombuffer(b"".join(blobs), np.uint8), np.cumsum([0, *map(len, blobs)])


def _transitions(left: pa.Table, right: pa.Table) -> pa.Table:
    """Counts of neighbouring classes; a text starts after an end."""
    cls = _heard(right)[1]
    c = cls[_unpacked(left["learn"][0].as_py())].astype(np.int64)
    joint = np.bincount(np.append(cls[:1], c[:-1]).astype(np.int64) * CLASSES + c, minlength=CLASSES ** 2) if len(c) else np.zeros(1, np.int64)
    cell = np.flatnonzero(joint)
    return pa.table({"cell": pa.array(cell), "n": pa.array(joint[cell], pa.int64())})


def _neighbours(left: pa.Table, right: pa.Table) -> pa.Table:
    """Counts of one block's words on turn with classes after and before
    them, packed per part: word of the part times classes plus class."""
    right, said, bounds = _heard(right)
    cls, turn = (said & 127).astype(np.int64), said > 127
    words = _unpacked(left["learn"][0].as_py()).astype(np.int64)
    prev = np.append(np.zeros(min(1, len(words)), np.int64), words[:-1])
    out = {"part": right["part"].combine_chunks(), "block": right["block"].combine_chunks()}
    for side, (a, z) in {"after": (prev, words), "before": (words, prev)}.items():
        on = turn[a]
        code, n = np.unique(a[on] * CLASSES + cls[z[on]], return_counts=True)
        at = np.searchsorted(code, bounds * CLASSES)
        out[side] = pa.array([_packed(np.concatenate([np.diff(code[lo:hi], prepend=b * CLASSES), n[lo:hi]]))
                              for lo, hi, b in zip(at[:-1], at[1:], bounds[:-1], strict=True)], pa.binary())
    give_back()
    return pa.table(out)


def _xlogx(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return x * np.log(np.where(x > 0, x, 1))


def _gains(after: tuple[np.ndarray, ...], before: tuple[np.ndarray, ...], own: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """Change of the log likelihood for every word (rows) and class if the
    word left its own class for that one. ``after`` and ``before``: (word,
    class, count) of the cells that are not 0, ordered by word."""
    out = np.zeros((len(own), CLASSES))
    for (word, z, n), m in ((after, joint), (before, joint.T)):
        rows, sums = m.sum(1), np.bincount(word, n, len(own))
        out += (_xlogx(rows) - _xlogx(rows + sums[:, None])) + (_xlogx(rows[own]) - _xlogx(rows[own] - sums))[:, None]
        if not len(word):
            continue
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        kinds, kind = np.unique(n.astype(np.int64) * CLASSES + z, return_inverse=True)  # few: most counts are small
        to = m.T[kinds % CLASSES]
        join = _xlogx(to + (kinds // CLASSES)[:, None]) - _xlogx(to)
        was = m[own[word], z]
        out[word[starts]] += (np.add.reduceat(join[kind], starts) + np.add.reduceat(_xlogx(was - n) - _xlogx(was), starts)[:, None])
    out[np.arange(len(own)), own] = 0
    return out


def _moved(joint: np.ndarray):
    """The classes of one part after its words on turn have moved."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        cls = np.frombuffer(left["cls"][0].as_py(), np.uint8).copy()
        blocks, sizes = left["block"][0].as_py(), left["sizes"][0].as_py()
        slots, start = _unpacked(left["slots"][0].as_py()), dict(zip(blocks, np.cumsum([0, *sizes]).tolist(), strict=False))
        sides = []
        for side in ("after", "before"):
            codes, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for block, blob in zip(right["block"].to_pylist(), right[side].to_pylist(), strict=True):
                delta, n = _unpacked(blob).astype(np.int64).reshape(2, -1)
                code = np.cumsum(delta)
                codes.append(slots[start[block] + code // CLASSES].astype(np.int64) * CLASSES + code % CLASSES)
                counts.append(n)
            code, at = np.unique(np.concatenate(codes), return_inverse=True)
            sides.append((code // CLASSES, code % CLASSES, np.bincount(at, np.concatenate(counts), len(code))))
        words = np.union1d(sides[0][0], sides[1][0])
        own = cls.astype(np.int64)
        for lo in range(0, len(words), CHUNK):
            some = words[lo:lo + CHUNK]
            cells = []
            for word, z, n in sides:
                a, e = np.searchsorted(word, [some[0], some[-1] + 1])
                cells.append((np.searchsorted(some, word[a:e]), z[a:e], n[a:e]))
            gain = _gains(*cells, own[some], joint)
            go = gain.max(1) > 1e-9
            cls[some[go]] = gain.argmax(1)[go]
        give_back()
        return pa.table({"part": left["part"].slice(0, 1), "cls": pa.array([cls.tobytes()], pa.binary())})
    return run


def _ending(w: bytes) -> int:
    return w[-1] * 256 + w[-2] if len(w) > 1 else w[0] * 256 if w else 0


def _endings(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_ending, words), np.int64, len(words))


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens, words and words that occur once, by ending and class; the end
    token has the ending -1."""
    for b in batches:
        for words, n, cls in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
            words, n, cls = _split(words), _unpacked(n, np.int64), np.frombuffer(cls, np.uint8).astype(np.int64)
            ending = np.where(np.array([bool(w) for w in words]), _endings(words), -1)
            known = n > 0
            key, at = np.unique((ending * CLASSES + cls)[known], return_inverse=True)
            sums = lambda x: pa.array(np.bincount(at, x[known], len(key)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(key // CLASSES), pa.array(key % CLASSES), sums(n), sums(known), sums(n == 1)],
                                             ["ending", "cls", "n", "words", "once"])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, words, n, cls in zip(*(c.to_pylist() for c in b.columns), strict=True):
            n = _unpacked(n, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(n), pa.int32()), pa.array(_split(words), pa.binary()), pa.array(n),
                                              pa.array(np.frombuffer(cls, np.uint8).astype(np.int32))], ["part", "w", "n", "cls"])


class Lexicon:
    """(count, class) of a word of the learning fold, read part by part."""

    def __init__(self, listed: DataFrame, parts: int):
        self.listed, self.parts, self.read = listed, parts, {}

    def __getitem__(self, w: bytes) -> tuple[int, int]:
        part = int(_part_of(np.int64(zlib.crc32(w)), self.parts))
        if part not in self.read:
            rows = self.listed.where((F.col("part") == part) & (F.col("n") > 0)).collect()
            self.read = {part: {bytes(r["w"]): (r["n"], r["cls"]) for r in rows}}
        return self.read[part][w]


@dataclass
class Model:
    known: Lexicon                       # count and class of every learned word
    ending: np.ndarray                   # class by the last two bytes
    step: np.ndarray                     # P(class | class)
    size: np.ndarray                     # tokens per class
    spare: np.ndarray                    # probability of an unseen word per class
    tokens: int
    distinct: int

    @property
    def base_of(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)


class Corpus:
    """Blocks of encoded texts and the parts of their words, both kept on
    the executors' disks by block and by part until ``close``."""

    def __init__(self, texts: DataFrame):
        n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.kind = texts.schema["id"].dataType.simpleString()
        self.blocks = (texts.mapInArrow(lean(_encoded), _BLOCKS.format(kind=self.kind))
                       .repartition(n, "block").persist(StorageLevel.DISK_ONLY))
        self.parts = 1 + (self.blocks.agg(F.sum("size")).first()[0] or 0) // ENTRIES
        self.shelves = (self.blocks.select("block", "words", "n").mapInArrow(lean(_dealt(self.parts)), _DEALT)
                        .groupBy("part").applyInArrow(_shelved, _SHELVES).repartition(n, "part").persist(StorageLevel.DISK_ONLY))
        self.classes = cut(self.shelves.select("part", "words").mapInArrow(_first_classes, "part int, cls binary"))

    def shelf(self, *columns: str) -> DataFrame:
        return self.shelves.select("part", *columns).join(self.classes, "part")

    def ask(self, columns: list[str], fn, schema: str, said: DataFrame) -> DataFrame:
        """``fn`` of every block and what the parts say to it."""
        return self.blocks.select("block", *columns).groupBy("block").cogroup(said.groupBy("block")).applyInArrow(fn, schema)

    def said(self, turn: int | None = None) -> DataFrame:
        return self.shelf("block", "sizes", "slots").mapInArrow(lean(_said(turn)), "block long, part int, said binary")

    def transitions(self) -> np.ndarray:
        """Class-by-class counts of all tokens of the learning fold."""
        cells = self.ask(["learn"], _transitions, "cell long, n long", self.said()).groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        joint = np.zeros(CLASSES ** 2)
        joint[cells["cell"]] = cells["n"]
        return joint.reshape(CLASSES, CLASSES)

    def exchange(self, sweeps: int = SWEEPS) -> None:
        """Rounds of moves. What reaches the driver are class-by-class counts."""
        for t in range(sweeps):
            sums = self.ask(["learn"], _neighbours, "part int, block long, after binary, before binary", self.said(t % 2))
            self.classes = cut(self.shelf("block", "sizes", "slots").groupBy("part").cogroup(sums.groupBy("part"))
                               .applyInArrow(_moved(self.transitions()), "part int, cls binary"))

    def close(self) -> None:
        self.shelves.unpersist()
        self.blocks.unpersist()


def _fit(corpus: Corpus) -> Model:
    corpus.exchange()
    joint = corpus.transitions()
    tally = cut(corpus.shelf("words", "n").mapInArrow(lean(_tallied), "ending long, cls long, n long, words long, once long")
                .groupBy("ending", "cls").agg(*(F.sum(c).alias(c) for c in ("n", "words", "once"))))
    by_class = tally.groupBy("cls").agg(*(F.sum(c).alias(c) for c in ("n", "words", "once")),
                                        F.sum(F.when(F.col("ending") >= 0, F.col("n")).otherwise(0)).alias("votes")).toPandas()
    mostly = tally.where("ending >= 0").groupBy("ending").agg(F.max_by("cls", F.struct("n", -F.col("cls"))).alias("cls")).toPandas()  # at most 65,536
    votes, once = np.zeros(CLASSES), np.zeros(CLASSES)
    votes[by_class["cls"]], once[by_class["cls"]] = by_class["votes"], by_class["once"]
    ending = np.full(65536, votes.argmax(), np.uint8)
    ending[mostly["ending"]] = mostly["cls"]
    size, total = joint.sum(0), max(joint.sum(), 1)
    step = (joint + PRIOR * size / total) / np.maximum(joint.sum(1, keepdims=True) + PRIOR, 1e-9)
    listed = corpus.shelf("words", "n").mapInArrow(lean(_listed), "part int, w binary, n long, cls int")
    return Model(Lexicon(listed, corpus.parts), ending, step, size, np.where(size > 0, once / np.maximum(size, 1), 0.0),
                 int(by_class["n"].sum()), int(by_class["words"].sum()))


def train(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the table (w, n) of all word counts it is based on."""
    model = _fit(Corpus(texts))
    return model, model.known.listed.where("n > 0").select("w", "n")


def _told(ending: np.ndarray):
    """To every block, from every part: classes and counts of its words. A
    word that was not learned has the class of its ending."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, words, n, blocks, sizes, slots, cls in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n, slots, ends = _unpacked(n, np.int64), _unpacked(slots), np.cumsum(sizes).tolist()
                cls = np.where(n > 0, np.frombuffer(cls, np.uint8), ending[_endings(_split(words))])[slots].tobytes()
                n = n[slots]
                yield pa.RecordBatch.from_arrays([
                    pa.array(blocks, pa.int64()), pa.array(np.full(len(blocks), part), pa.int32()),
                    pa.array([cls[e - s:e] for s, e in zip(sizes, ends, strict=True)], pa.binary()),
                    pa.array([_packed(n[e - s:e], np.int64) for s, e in zip(sizes, ends, strict=True)], pa.binary())], ["block", "part", "said", "n"])
    return run


def _score(step: np.ndarray, size: np.ndarray, spare: np.ndarray, of: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right, cls, _ = _heard(right)
        cls = cls.astype(np.int64)
        n = np.concatenate([_unpacked(x, np.int64) for x in right["n"].to_pylist()])
        words = np.concatenate([_unpacked(left[c][0].as_py()) for c in ("learn", "rest")])
        lens = _unpacked(left["lens"][0].as_py())
        starts = np.cumsum(lens) - lens
        emit, unseen = MIX * (1 - spare[cls]) * n / np.maximum(size[cls], 1), MIX * step @ spare
        base, known = (n + 0.5) / of, n > 0
        c = cls[words]
        prev = np.append(cls[:1], c[:-1])  # a text starts after an end
        p = np.where(known[words], step[prev, c] * emit[words], unseen[prev]) + (1 - MIX) * base[words]
        out = pa.table({
            "id": pc.list_flatten(left["id"]), "held_out": pa.array(np.arange(len(lens)) >= left["learned"][0].as_py()),
            "n_tokens": pa.array(lens, pa.int64()), "n_known": pa.array(np.add.reduceat(known[words].astype(np.int64), starts)),
            "base_score": pa.array(np.add.reduceat(np.log10(base)[words], starts)), "score": pa.array(np.add.reduceat(np.log10(p), starts))})
        give_back()
        return out
    return run


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every row; scores are log10 probabilities of the whole text and its end.

    NULL text counts as empty: its one token is the end. A NULL id falls in
    the learning fold. Repeated rows are scored each. A text is encoded in
    one task, whatever its length. If nothing can be learned (no rows in the
    fold) every token is the unseen event, with a base probability of 1.
    Other columns are not read.
    """
    corpus = Corpus(_texts(df, id_col, text_col))
    try:
        model = _fit(corpus)
        told = corpus.shelf("words", "n", "block", "sizes", "slots").mapInArrow(lean(_told(model.ending)), "block long, part int, said binary, n binary")
        scored = cut(corpus.ask(["id", "learned", "lens", "learn", "rest"], _score(model.step, model.size, model.spare, model.base_of),
                                f"id {corpus.kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double", told))
    finally:
        corpus.close()
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                         "base_score", "score")


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-model and base log probability of every whole text."""
    return score_texts(table(spark, sf_dir, "documents"))
