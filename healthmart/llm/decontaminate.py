"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

An item's windows (``window`` consecutive words, or the whole item if it has
fewer) are sets of shingles of ``shingle`` words, shorter for shorter windows.
A document holds a window only if it holds every shingle of it, so with the
shingles of a window ordered by rarity its first one is the necessary prefix:

1. One scan of the texts finds where shingles of any item occur and keeps the
   words around each place; all other places are gone before any shuffle.
2. Occurrences are counted per shingle. A window with a shingle that occurs
   nowhere is out; every other window keeps its rarest shingle as its prefix.
3. Occurrences meet the windows by prefix alone. The place of the shingle in
   the window gives the place of the window in the document (positional
   bound), which must fit between its first and last word (length bound).
4. What is left is verified word by word over the document's window of the
   item's size.

Equal items are one class and equal windows one row, so copies of an item
multiply nothing; documents that hold the same set of windows look up their
items once. The table of item shingles is broadcast up to ``BROADCAST`` rows
(of one long); beyond that places meet it in a shuffle join, and the texts
that have any are read again for the words around them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from healthmart.llm.common import LOWER, UPPER, ascii_lower, cut, quoted, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 5
BROADCAST = 1 << 20


def words_of(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; NULL has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def _places(words: str, sizes: list[int]) -> str:
    """SQL: array of (p, h), one for every run of ``size`` words of ``words``
    for every size; the size is part of the hash."""
    parts = [f"""if(size({words}) >= {s}, transform(sequence(0, greatest(size({words}) - {s}, 0)),
                 i -> named_struct('p', i, 'h', xxhash64(slice({words}, i + 1, {s}), {s}))),
                 cast(array() as array<struct<p: int, h: bigint>>))""" for s in sizes]
    return f"concat({', '.join(parts)})"


def item_windows(items: DataFrame, item_id: str, item_text: str, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(classes, windows): classes (c, ids) are the distinct word sequences
    with the ids that have them; windows (wid, win, classes, grams) the
    distinct windows, grams being (o, s, h): offset, size and hash."""
    named = items.select(F.coalesce(F.col(quoted(item_id)).cast("string"), F.lit("")).alias("item"),
                         words_of(F.col(quoted(item_text))).alias("w")).where("size(w) > 0")
    classes = cut(named.groupBy("w").agg(F.collect_set("item").alias("ids"))
                  .withColumn("c", F.sha2(F.array_join("w", " ").cast("binary"), 256)))
    each = classes.select("c", F.expr(f"""explode(array_distinct(transform(
        sequence(0, greatest(size(w) - {window}, 0)), i -> slice(w, i + 1, {window}))))""").alias("win"))
    size = f"least(size(win), {shingle})"
    grams = F.expr(f"""transform(sequence(0, size(win) - {size}), o -> named_struct(
        'o', o, 's', {size}, 'h', xxhash64(slice(win, o + 1, {size}), {size})))""")
    windows = (each.groupBy("win").agg(F.collect_set("c").alias("classes"))
               .select(F.sha2(F.array_join("win", " ").cast("binary"), 256).alias("wid"), "win", "classes", grams.alias("grams")))
    return classes.select("c", "ids"), cut(windows)


def _occurrences(docs: DataFrame, grams: DataFrame, sizes: list[int], window: int, shingle: int, broadcast: int) -> DataFrame:
    """(id, key, n, p, h, lo, around): a row with p = -1 for every document,
    and one for every place p whose shingle some item has; ``around`` are the
    words from ``lo`` on that any window over that place can reach."""
    lo = F.greatest(F.col("p") - (window - shingle), F.lit(0))
    around = F.when(F.col("p") >= 0, F.slice("w", lo + 1, F.col("p") - lo + window))
    none = "array(named_struct('p', -1, 'h', 0L))"
    if grams.count() <= broadcast:
        at = docs.select("id", "key", "n", "w", F.expr(f"inline(concat({none}, {_places('w', sizes)}))"))
        found = at.join(F.broadcast(grams.select(F.col("h").alias("known"))), F.col("h") == F.col("known"), "left")
        found = found.where("p = -1 or known is not null")
    else:
        at = docs.select("id", "key", F.expr(f"inline({_places('w', sizes)})")).join(grams, "h", "left_semi")
        held = at.groupBy(F.col("id").alias("hid"), F.col("key").alias("hkey")).agg(F.collect_set(F.struct("p", "h")).alias("held"))
        found = docs.join(held, F.col("id").eqNullSafe(F.col("hid")) & (F.col("key") == F.col("hkey")), "left").select(
            "id", "key", "n", "w", F.expr(f"inline(concat({none}, coalesce(held, array())))"))
    return found.select("id", "key", "n", "p", "h", lo.alias("lo"), around.alias("around"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                 broadcast: int = BROADCAST) -> DataFrame:
    """One row per document: ``id_col``, n_words, spans (array of first word
    and number of words of the maximal hit runs, in order) and items (sorted
    ids, as strings, of the items with an occurring window).

    A document without hits has empty arrays; NULL and empty texts have no
    words. Items without words have no windows. Rows with one item id are one
    item with the windows of all of them; a NULL item id reads ''. Repeated
    documents, and documents with a NULL id, each keep their row. Texts are
    taken whole at any length. Columns of other names are not read. An empty
    table of documents gives no rows, one of items no hits.
    """
    src = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("t"))
    src = src.select("id", F.xxhash64("t").alias("key"), words_of(F.col("t")).alias("w")).withColumn("n", F.size("w"))
    classes, windows = item_windows(items, item_id, item_text, window, shingle)
    grams = windows.select("wid", F.inline("grams"))
    sizes = sorted(r["s"] for r in grams.select("s").distinct().collect()) or [shingle]  # at most `shingle` of them
    occ = cut(_occurrences(src, grams.select("h").distinct(), sizes, window, shingle, broadcast))

    found = occ.where("p >= 0")
    often = found.groupBy("h").agg(F.count(F.lit(1)).alias("often"))
    rarest = (grams.join(often, "h", "left").groupBy("wid")
              .agg(F.min(F.struct("often", "h", "o")).alias("first"), F.every(F.col("often").isNotNull()).alias("all"))
              .where("all").select("wid", "first.h", "first.o"))
    prefixed = cut(rarest.join(windows.select("wid", "win"), "wid").select("h", "o", "wid", "win"))
    start = F.col("p") - F.col("o")
    fits = (start >= 0) & (start + F.size("win") <= F.col("n"))
    same = F.slice("around", F.greatest(start - F.col("lo"), F.lit(0)) + 1, F.size("win")) == F.col("win")
    hits = cut(found.join(prefixed, "h").where(fits).where(same)
               .select("id", "key", start.alias("start"), F.size("win").alias("len"), "wid").distinct())

    doc = W.partitionBy("id", "key")
    ends = F.max(F.col("start") + F.col("len")).over(doc.orderBy("start", "len").rowsBetween(W.unboundedPreceding, -1))
    runs = (hits.select("id", "key", "start", "len").distinct()
            .withColumn("new", F.when(F.col("start") > ends, 1).otherwise(0))
            .withColumn("run", F.sum("new").over(doc.orderBy("start", "len").rowsBetween(W.unboundedPreceding, 0)))
            .groupBy("id", "key", "run").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("len")).alias("end")))
    spans = runs.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("start", (F.col("end") - F.col("start")).alias("n")))).alias("spans"))
    held = (hits.groupBy("id", "key").agg(F.sort_array(F.collect_set("wid")).alias("wids"))
            .withColumn("kind", F.sha2(F.array_join("wids", " ").cast("binary"), 256)))
    held = cut(held.join(spans, (held["id"].eqNullSafe(spans["id"])) & (held["key"] == spans["key"]))
               .select(held["id"].alias("hid"), held["key"].alias("hkey"), "spans", "wids", "kind"))
    kinds = held.groupBy("kind").agg(F.first("wids").alias("wids")).select("kind", F.explode("wids").alias("wid"))
    of_kind = (kinds.join(windows.select("wid", F.explode("classes").alias("c")), "wid").select("kind", "c").distinct()
               .join(classes, "c").groupBy("kind").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items")))
    known = held.join(of_kind, "kind").drop("wids")
    every = occ.where("p = -1").select("id", "key", "n")
    out = every.join(known, F.col("id").eqNullSafe(F.col("hid")) & (F.col("key") == F.col("hkey")), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"),
                      F.coalesce("spans", F.expr("cast(array() as array<struct<start: int, n: int>>)")).alias("spans"),
                      F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))


def op12_prefix_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words in occurrences of benchmark windows, the
    items those belong to, as a count and a digest."""
    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("aggregate(spans, 0L, (a, s) -> a + s.n)")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.size("spans") > 0).alias("contaminated"))


def _sql_words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{WORD}')"


OP12_SQL = f"""
WITH item AS (SELECT item_id, {_sql_words('text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, list_slice(w, s, s + least(len(w), {WINDOW}) - 1) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS s FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_sql_words('text')} AS w FROM documents),
place AS (
  SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, n, item_id FROM place JOIN win USING (n, win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hit)) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
