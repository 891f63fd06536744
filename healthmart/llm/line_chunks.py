"""Line deduplication by content-defined chunks (DataFrame functions only).

A text is split at newlines; every line is hashed, and a polynomial rolling
hash over the last ``window`` line hashes ends a chunk where it is 0 modulo
``divisor``. Boundaries therefore depend on nearby lines only: lines
inserted elsewhere shift no other boundary, and a passage shared by two
documents is cut alike in both. Chunks of at least two lines whose bytes
occur more than once in the whole table are removed everywhere but at their
first place (smallest id, then chunk number).

Plan: one pass writes narrow (id, chunk, hash) rows; hashes that repeat make
a bounded repeat filter, as in ``bloom_dedup``. A second pass sends only the
bytes of chunks that pass the filter through the shuffle, where they are
grouped by their whole text, which is the byte comparison. The texts meet
the list of chunks to drop in one join on the id. A passage held by a third
of all documents is combined before its shuffle; in the join it is a skewed
key that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart.llm.bloom_dedup import mark_repeats, repeat_filter
from healthmart.llm.common import cut, pack, quoted, table, unpack

WINDOW = 2
DIVISOR = 3
BASE = 31
MODULUS = 1_000_003


def with_chunks(df: DataFrame, text_col: str, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """Add ``_chunks``: array of (k, n, body) in order. Joining the bodies
    with newlines gives back the text; NULL counts as empty."""
    # oldest line first: value = sum of hash * BASE^age, over at most `window` lines
    rolled = " + ".join(f"if(i >= {a}, element_at(hs, greatest(i + 1 - {a}, 1)) % {MODULUS} * {BASE ** a}, 0L)"
                        for a in range(window))

    def let(value: str, name: str, body: str) -> str:
        """``body`` with ``name`` bound to ``value``, evaluated once a row."""
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    cut_after = f"filter(sequence(0, size(hs) - 1), i -> i = size(hs) - 1 or ({rolled}) % {divisor} = 0)"
    chunk = """transform(ends, (e, k) -> named_struct(
        'k', k, 'n', e - if(k = 0, -1, element_at(ends, greatest(k, 1))),
        'body', array_join(slice(lines, if(k = 0, 0, element_at(ends, greatest(k, 1)) + 1) + 1,
                                 e - if(k = 0, -1, element_at(ends, greatest(k, 1)))), '\n')))"""
    hashed = "transform(lines, l -> cast(conv(substr(md5(cast(l as binary)), 1, 8), 16, 10) as bigint))"
    text = f"split(coalesce(cast({quoted(text_col)} as string), ''), '\n', -1)"
    return df.withColumn("_chunks", F.expr(let(text, "lines", let(hashed, "hs", let(cut_after, "ends", chunk)))))


def _many(df: DataFrame, id_col: str, least: int, body: bool) -> DataFrame:
    c = df.select(F.col(id_col).alias("id"), F.inline("_chunks")).where(F.col("n") >= least)
    return c.select("id", "k", F.xxhash64("body").alias("h"), *(["body"] if body else []))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                divisor: int = DIVISOR, least: int = 2) -> DataFrame:
    """``df`` with ``text_col`` replaced by what remains, plus n_lines,
    n_chunks, n_removed (chunks) and lines_removed (an input column of such
    a name is replaced).

    Rows, ids and all other columns stay as they are. NULL text stays NULL
    if nothing is removed from it (it has one empty line, a single chunk
    that is never removed). Line ends are ``\\n`` only; ``\\r`` belongs to
    its line. Repeated rows with one id count as one place per (id, chunk):
    a chunk stays in all of them or in none. NULL ids sort first. A document
    whose chunks all go keeps its row with an empty text.
    """
    base = pack(df, id_col, text_col)
    src = with_chunks(base.select("id", "text"), "text", window, divisor)
    narrow = cut(_many(src, "id", least, body=False))
    filt = repeat_filter(narrow, "h")
    some = mark_repeats(_many(src, "id", least, body=True), "h", filt).where("maybe_repeated").drop("maybe_repeated")
    place = F.struct(F.col("id"), F.col("k"))
    # whole bodies are the grouping key: equal hashes with other bytes stay apart
    first = some.groupBy("h", "body").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where(~F.col("first").eqNullSafe(F.col("last"))).drop("last")
    drop = (some.join(first, ["h", "body"]).where(~place.eqNullSafe(F.col("first")))
            .groupBy(F.col("id").alias("drop_id")).agg(F.collect_set("k").alias("drop")))
    joined = base.join(drop, F.col("id").eqNullSafe(F.col("drop_id")), "left")
    whole = with_chunks(joined, "text", window, divisor)
    kept = F.array_join(F.expr("transform(filter(_chunks, c -> not array_contains(drop, c.k)), c -> c.body)"), "\n")
    gone = F.expr("aggregate(filter(_chunks, c -> array_contains(drop, c.k)), 0L, (s, c) -> s + c.n)")
    stats = {"n_lines": F.expr("aggregate(_chunks, 0L, (s, c) -> s + c.n)"), "n_chunks": F.size("_chunks"), "n_removed": F.coalesce(F.size("drop"), F.lit(0)),
             "lines_removed": F.when(F.col("drop").isNull(), F.lit(0)).otherwise(gone)}
    return unpack(whole, df, {text_col: F.when(F.col("drop").isNull(), F.col("text")).otherwise(kept)},
                  {c: v.cast("long") for c, v in stats.items()})


def op4_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, chunks, what went, and the digest of the rest."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed", "lines_removed",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def sql(documents: str, tail: str) -> str:
    """The same in DuckDB SQL over ``documents`` (a table or subquery);
    ``tail`` selects from doc(doc_id, ..., kept)."""
    rolled = " + ".join(f"CASE WHEN i >= {a} THEN lag(h, {a}, 0) OVER doc % {MODULUS} * {BASE ** a} ELSE 0 END" if a else f"h % {MODULUS}"
                        for a in range(WINDOW))
    return f"""
WITH src AS (SELECT * FROM {documents}),
line AS (
  SELECT doc_id, i, l, CAST('0x' || substr(md5(l), 1, 8) AS BIGINT) AS h
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i FROM src)),
cutpoint AS (
  SELECT doc_id, i, l, ({rolled}) % {DIVISOR} = 0 AS ends FROM line WINDOW doc AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT doc_id, i, l, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM cutpoint),
chunk AS (SELECT doc_id, k, count(*) AS n, string_agg(l, chr(10) ORDER BY i) AS body FROM numbered GROUP BY doc_id, k),
judged AS (
  SELECT *, n >= 2 AND row_number() OVER (PARTITION BY body, n >= 2 ORDER BY doc_id, k) > 1 AS gone FROM chunk),
doc AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_lines, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed,
         CAST(coalesce(sum(n) FILTER (gone), 0) AS BIGINT) AS lines_removed,
         coalesce(string_agg(body, chr(10) ORDER BY k) FILTER (NOT gone), '') AS kept FROM judged GROUP BY doc_id)
{tail}"""


OP4_SQL = sql("documents", "SELECT doc_id, n_lines, n_chunks, n_removed, lines_removed, sha256(kept) AS kept_sha256 FROM doc")
