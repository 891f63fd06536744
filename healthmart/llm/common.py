"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart.operators.materialize import checkpoint

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Arrow batches handed to Python hold at most this many bytes, whatever
#: the length of the texts in them.
ARROW_BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; Arrow batches are bounded by bytes from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the cut that
    several later passes read, and that survives a lost executor."""
    return checkpoint(df)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does exactly that on pure
    ASCII; other texts go through the slower ``translate``."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``, equals ``fold``.
    A NULL id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds) == fold


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def give_back() -> None:
    """Return memory that nothing uses to the system: a Python worker lives
    on and would keep it through the stages that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``fn`` for ``mapInArrow``, giving memory back after every batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(batches):
            yield out
            del out
            give_back()
        give_back()
    return run


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without a Python object per text;
    text i is ``bytes[offsets[i]:offsets[i + 1]]``, NULL texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator, element-wise."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words(text: str) -> list[bytes]:
    """Tokens ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z: bytes methods
    fold and split on exactly those ASCII characters."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def pack(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, text): all input columns go into one struct, so whatever
    their names they cannot clash with an operator's own columns."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"),
                     F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))


def unpack(packed: DataFrame, like: DataFrame, replaced: dict[str, Column] | None = None,
           added: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``like`` out of ``row``, some replaced, then the added
    ones; an input column named like an added one gives way."""
    replaced, added = replaced or {}, added or {}
    return packed.select(*[replaced[c].alias(c) if c in replaced else F.col("row")[c].alias(c)
                           for c in like.columns if c not in added], *[v.alias(c) for c, v in added.items()])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
