"""Files whose column types are found in the data (S1), with a place for
what does not fit.

Every value is tried against each type of a small lattice; the counts of
hits are sums, so each split's are merged with all others'. A column takes
the narrowest type that all its values, or all but a stated share, can be
cast to. The rest is not lost: the typed column is NULL there and the text
is kept in a rescue column, with the file and the row it came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart.sources import files

#: Narrowest first; every type but the last may fail on some text.
LATTICE = ("bigint", "double", "boolean", "date", "timestamp", "string")
BROKEN = "__line"
#: Every text that can be cast matches (others may). A cast that fails throws
#: inside Spark, which takes a hundred times as long as a look at the text.
MAY_FIT = {"bigint": r"(?is)^[^0-9a-z]*[0-9]+[^0-9a-z]*$",
           "double": r"(?is)^[^0-9a-z]*([0-9][0-9a-fx.]*(p?[+-]?[0-9]+[fd]?)?|inf|infinity|nan)[^0-9a-z]*$",
           "boolean": r"(?is)^[^0-9a-z]*(t|true|y|yes|1|f|false|n|no|0)[^0-9a-z]*$"}


def _fits(value: Column, kind: str) -> Column:
    """``value`` as ``kind``, NULL if it cannot be cast."""
    cast = value.try_cast(kind)
    return F.when(value.rlike(MAY_FIT[kind]), cast) if kind in MAY_FIT else cast


def infer_types(raw: DataFrame, tolerance: float = 0.0) -> dict[str, str]:
    """The type of every text column of ``raw``: the first of ``LATTICE`` that
    fits all but at most ``tolerance`` of its values. A column without values
    is text. Values are tried column by column, as rows: one aggregate over
    all columns and types at once is a method too long for the JVM to compile.
    A row of counts a column reaches the driver."""
    tried = LATTICE[:-1]
    if not raw.columns:
        return {}
    tall = raw.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(raw.columns)])).alias("r")).select("r.*")
    counts = tall.groupBy("i").agg(F.count("value").alias("n"), *[F.count(_fits(F.col("value"), t)).alias(t) for t in tried])
    seen = {r["i"]: r for r in counts.collect()}
    out = {}
    for i, c in enumerate(raw.columns):
        n = seen[i]["n"] if i in seen else 0
        fits = [t for t in tried if n and n - seen[i][t] <= tolerance * n]
        out[c] = fits[0] if fits else LATTICE[-1]
    return out


def read_inferred(spark: SparkSession, path: str, tolerance: float = 0.0, rescue: str = "_rescued",
                  types: dict[str, str] | None = None) -> DataFrame:
    """A CSV folder with headers, its columns typed by ``infer_types`` (or as
    ``types`` says, for later files of one feed), plus ``rescue``: NULL, or
    struct (file, row, fields) of a row that does not fit. row counts the
    file's rows from 1; fields maps a column to the text that could not be
    cast, and '' to the whole line if it has too many or too few fields.
    No line end may stand inside quotes, so that files are read in splits.
    """
    names = files.read_csv(spark, path, multiline=False).columns
    layout = ", ".join(f"`{c}` string" for c in [*names, BROKEN])
    raw = spark.read.option("header", True).options(**files.CSV_QUOTES).option("columnNameOfCorruptRecord", BROKEN).schema(layout).csv(path)
    typed = types or infer_types(raw.select(*[f"`{c}`" for c in names]), tolerance)
    placed = files.with_place(raw, "__at")
    cast = {c: F.col(f"`{c}`").try_cast(typed[c]) for c in names}
    wrong = [F.when(F.col(f"`{c}`").isNotNull() & cast[c].isNull(), F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").alias("value"))) for c in names]
    wrong.append(F.when(F.col(BROKEN).isNotNull(), F.struct(F.lit("").alias("key"), F.col(BROKEN).alias("value"))))
    fields = F.array_compact(F.array(*wrong))
    out = placed.select(*[cast[c].alias(c) for c in names], F.when(F.size(fields) > 0, F.struct(
        F.col("__at.file").alias("file"), F.col("__at.row").alias("row"), F.map_from_entries(fields).alias("fields"))).alias(rescue))
    return out
