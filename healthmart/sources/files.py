"""File zones and table IO.

A zone is a directory under a base path (``landing``, ``lake``,
``warehouse``, ``marts``); a table in it is versioned Parquet (``versions``):
a write that dies leaves the table as it was. CSV copies and exports are
plain folders.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from healthmart.sources import versions

#: Doubled quotes inside quoted text, and the same on write.
CSV_QUOTES = {"quote": '"', "escape": '"'}
#: What stands for NULL in a landed CSV copy.
CSV_NULL = "\\N"


def read_csv(spark: SparkSession, path: str, schema=None, infer: bool = False, multiline: bool = True) -> DataFrame:
    """CSV with header; explicit schema, or inference when asked.

    Columns of ``schema`` are found by their header name, in whatever order
    the files have them; a missing one, or files whose headers differ, fail.
    Quoted text may hold doubled quotes and line ends. ``multiline=False``
    lets Spark split large files that have no line ends inside quotes.
    """
    r = spark.read.option("header", True).options(**CSV_QUOTES).option("multiLine", multiline)
    if schema is None:
        return (r.option("inferSchema", True) if infer else r).csv(path)
    header = r.csv(path).columns
    missing = [c for c in schema.fieldNames() if c not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    as_read = StructType([schema[c] if c in schema.fieldNames() else StructField(c, StringType()) for c in header])
    return r.option("enforceSchema", False).schema(as_read).csv(path).select(*[f"`{c}`" for c in schema.fieldNames()])


def with_row_order(df: DataFrame, col: str = "_row") -> DataFrame:
    """Tag rows with their input order (file, then position in the file).

    For "keep the first occurrence" semantics on files without a key: rows of
    a file source are ordered by file path, then by the place of the split in
    the file, then inside the split. Spark deals splits by size, so the id
    alone would not follow the files. A frame that is not read from files
    has its rows in partition order.
    """
    within = F.monotonically_increasing_id()
    try:
        return df.withColumn(col, F.struct(F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.file_block_start").alias("start"), within.alias("nth")))
    except AnalysisException:
        return df.withColumn(col, within)


def _placed(df: DataFrame, per_file: bool, broadcast: int) -> DataFrame:
    """``df``, a plain read of files, with ``__file`` and ``__place``: how
    many rows (of the file, or of all files) come before."""
    at = df.select(F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
                   F.monotonically_increasing_id().alias("__nth"), *[F.col(f"`{c}`") for c in df.columns])
    splits = at.groupBy("__file", "__start").agg(F.count(F.lit(1)).alias("__n"), F.min("__nth").alias("__first"))
    order = Window.partitionBy("__file").orderBy("__start") if per_file else Window.orderBy("__file", "__start")
    before = F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select(F.col("__file").alias("__f"), F.col("__start").alias("__s"), "__first", F.coalesce(before, F.lit(0)).alias("__off"))
    few = df.rdd.getNumPartitions() <= broadcast
    out = at.join(F.broadcast(offsets) if few else offsets, (F.col("__file") == F.col("__f")) & (F.col("__start") == F.col("__s")))
    return out.withColumn("__place", (F.col("__off") + F.col("__nth") - F.col("__first")).cast("long"))


def with_file_ids(df: DataFrame, id_col: str, start: int = 1, broadcast: int = 1 << 18) -> DataFrame:
    """Dense ids start..start+n-1 in the order of ``with_row_order``,
    given while the files are read: no row is sorted or shuffled.

    ``df`` is a plain read of files. A split is read by one task in order, so
    a row's place in its split is its running number less the split's first
    one. One pass counts the rows of every split; the running sum over that
    table (a row per split) gives the splits' offsets, which meet the rows in
    a broadcast join up to ``broadcast`` read tasks, in an ordinary one
    beyond. Both passes plan the same splits, as they share one listing.
    """
    out = _placed(df, False, broadcast)
    return out.select((F.col("__place") + F.lit(start)).alias(id_col), *[F.col(f"`{c}`") for c in df.columns if c != id_col])


def with_place(df: DataFrame, col: str, broadcast: int = 1 << 18) -> DataFrame:
    """``df``, a plain read of files, with ``col``: struct (file, row), the
    file's name and the row in it, from 1. As ``with_file_ids``."""
    out = _placed(df, True, broadcast)
    place = F.struct(F.element_at(F.split("__file", "/"), -1).alias("file"), (F.col("__place") + 1).alias("row"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], place.alias(col))


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A stored table by name, in its last published state."""
    return versions.read_version(spark, base, name)


def write_table(df: DataFrame, base: str, name: str, metrics: dict | None = None, schema: StructType | None = None) -> dict:
    """Full replace of table ``name`` (drop-and-recreate), all or
    nothing. Returns the number of ``rows`` and aggregate ``metrics`` (name
    -> aggregate Column), both observed by the write job itself. With
    ``schema`` other columns or types, and NULLs where it allows none, are
    refused and the table stays as it was."""
    return versions.replace_table(df, base, name, schema, metrics)


def write_csv(df: DataFrame, base: str, name: str, null_text: str = CSV_NULL) -> str:
    """A CSV folder with headers and quotes. NULL is written as
    ``null_text``, which sets it apart from empty text."""
    path = os.path.join(base, name)
    w = df.write.mode("overwrite").option("header", True).options(**CSV_QUOTES).option("nullValue", null_text)
    if null_text:  # blanks at the ends, line ends of any kind: everything is quoted
        w = w.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, quoteAll=True)
    w.csv(path)
    return path


def land(df: DataFrame, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Verbatim landing copy; returns the landed table read back, so
    later stages read the copy and not the source again. A CSV copy keeps
    quotes, commas, line ends, blanks, empty text and NULL apart; a text
    that is itself ``CSV_NULL`` is the one that comes back as NULL."""
    if fmt == "csv":
        path = write_csv(df, base, name)
        back = df.sparkSession.read.option("header", True).options(**CSV_QUOTES).option("multiLine", True)
        return back.option("nullValue", CSV_NULL).schema(df.schema).csv(path)
    write_table(df, base, name)
    return read_table(df.sparkSession, base, name)


def table_exists(spark: SparkSession, base: str, name: str) -> bool:
    return bool(versions.versions(spark, base, name))


def seed_dimension(spark: SparkSession, base: str, name: str, rows: DataFrame,
                   name_col: str, id_col: str) -> DataFrame:
    """Insert-if-absent by unique name (``INSERT OR IGNORE`` with an
    auto-increment id). Names already stored keep their id, new names get
    the next ids in the order of ``rows`` (by their proposed id). Returns
    the stored dimension. The new state is published last, so a run that
    dies leaves the stored one; nothing is written when no name is new.

    New names are numbered by a prefix sum over range partitions, so that a
    dimension of any size will do.
    """
    from healthmart.operators.conform import dense_ids

    if not table_exists(spark, base, name):
        write_table(rows, base, name)
        return read_table(spark, base, name)
    existing = read_table(spark, base, name).select(*rows.columns)
    fresh = rows.join(existing.select(name_col), name_col, "left_anti")
    if fresh.isEmpty():
        return existing
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).first()["top"]
    numbered = dense_ids(fresh, [id_col, name_col], "__id", start=top + 1)
    numbered = numbered.withColumn(id_col, F.col("__id").cast(rows.schema[id_col].dataType)).select(*rows.columns)
    write_table(existing.unionByName(numbered), base, name)
    return read_table(spark, base, name).select(*rows.columns)


def export_reports(reports: dict, out_dir: str, isolate_errors: bool = True,
                   spark: SparkSession | None = None, concurrent: bool = True) -> DataFrame:
    """Write each named report (a callable returning a DataFrame or
    a DataFrame) to ``out_dir/name``. Reports are small aggregates, so each
    is written as one file; they are independent jobs and are submitted
    together. With ``isolate_errors`` a failing report is recorded and the
    others still run. Returns (name, status, rows, error) in input order.
    """
    def one(name, rep):
        try:
            df = (rep() if callable(rep) else rep).cache()
            try:
                n = df.count()
                write_csv(df.coalesce(1), out_dir, name, null_text="")
            finally:
                df.unpersist()
            return (name, "ok", n, None)
        except Exception as e:  # noqa: BLE001 - isolation is the feature
            if not isolate_errors:
                raise
            return (name, "failed", None, str(e) or type(e).__name__)

    items = list(reports.items())
    if concurrent and len(items) > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=min(8, len(items))) as pool:
            results = list(pool.map(lambda kv: one(*kv), items))
    else:
        results = [one(n, r) for n, r in items]
    spark = spark or SparkSession.getActiveSession()
    return spark.createDataFrame(results, "name string, status string, rows long, error string")
