"""Exact deduplication by two-pass Bloom filtering (DataFrame functions only).

Pass 1 hashes every normalised text to SHA-256 and counts, per bit position
of a Bloom filter, how many texts fall on it; positions hit at least twice
form the *repeat filter*. Pass 2 tests every row against that filter: rows
with a position that nobody else hit are certainly unique and pass straight
through; only the rest shuffle, to be grouped exactly by digest.

The texts are read once. What follows works on (id, digest) rows cut to the
shared folder. The repeat filter is broadcast: it has at most ``bits / 64``
rows of 16 bytes, whatever the input, so the broadcast is bounded by the
parameter. With more rows than bits the filter lets more rows through to the
shuffle, never fewer, so results are the same at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart.llm.common import LOWER, UPPER, ascii_lower, cut, table

BITS = 1 << 26
HASHES = 2


def _position(digest: Column, j: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(j)), F.lit(bits))


def repeat_filter(keys: DataFrame, key: str, bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """Bit words (word, mask) of the positions that at least two rows hit."""
    hit = keys.select(F.explode(F.array(*[_position(F.col(key), j, bits) for j in range(hashes)])).alias("p"))
    twice = hit.groupBy("p").count().where("count > 1")
    return (twice.select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
            .groupBy("word").agg(F.expr("bit_or(bit)").alias("mask")))


def mark_repeats(df: DataFrame, key: str, filt: DataFrame, bits: int = BITS, hashes: int = HASHES,
                 name: str = "maybe_repeated") -> DataFrame:
    """Add ``name``: true where every position of ``key`` is in the filter."""
    out, ok = df, F.lit(True)
    for j in range(hashes):
        f = F.broadcast(filt.select(F.col("word").alias(f"_w{j}"), F.col("mask").alias(f"_m{j}")))
        pos = _position(F.col(key), j, bits)
        out = out.withColumn(f"_p{j}", pos)
        out = out.join(f, F.shiftright(f"_p{j}", 6) == F.col(f"_w{j}"), "left")
        ok = ok & F.coalesce(F.expr(f"getbit(_m{j}, cast(_p{j} & 63 as int)) = 1"), F.lit(False))
    return out.withColumn(name, ok).drop(*[f"_{c}{j}" for c in "pwm" for j in range(hashes)])


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """One decision row per input row: ``id_col``, keep_id, group_size, kept,
    text_sha256.

    Texts are equal when identical after lower-casing A-Z; a NULL text
    counts as empty, so NULL and empty texts form one group. Of equal texts
    the row with the largest id stays. A NULL id loses to any other; rows
    that share the winning id (repeated rows) are all marked kept, and a
    group of NULL ids only keeps its rows with keep_id NULL. Other columns,
    whatever their names, are not read. An empty table gives no rows.
    """
    norm = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    keys = cut(df.select(F.col(id_col).alias("id"), F.sha2(norm.cast("binary"), 256).alias("digest")))
    marked = mark_repeats(keys, "digest", repeat_filter(keys, "digest", bits, hashes), bits, hashes)
    once = marked.where(~F.col("maybe_repeated")).select("id", F.col("id").alias("keep_id"),
                                                         F.lit(1).cast("long").alias("group_size"), "digest")
    some = marked.where("maybe_repeated").select("id", "digest")
    groups = some.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    grouped = some.join(groups, "digest").select("id", "keep_id", "group_size", "digest")
    return once.unionByName(grouped).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def op9_bloom_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact-copy decisions for every row of ``documents``."""
    return exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_SQL = f"""
WITH digests AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""
