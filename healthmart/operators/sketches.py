"""Profiles that merge (S18, A20): per column a row of counts, bounds and
sketches, made in one pass over a batch and stored with it. A later batch
reads its own rows only; the profile of the whole is the merge of the stored
rows, whatever their order or number.

Distinct values: HyperLogLog with 2**``LG_K`` registers, standard error
1.04 / 2**(LG_K / 2), 1.6 %. Quantiles: KLL with ``KLL_K``, a rank is off by
at most 1.33 % of the rows with 99 % confidence at 200, less above. Frequent
values: counts of at most ``TRACKED`` values, never above nor, by more than
the rows over 0.75 * ``TRACKED``, below the truth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart.sources import versions

LG_K = 12
KLL_K = 400
TRACKED = 1000
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def profile_part(df: DataFrame) -> DataFrame:
    """One row per column of ``df``: column, kind, rows, nulls, least and
    greatest (of numbers), and the sketches distinct, ranks (of numbers) and
    frequent (of the values as text). One aggregate with partial sketches
    per task."""
    aggs, rows = [F.count(F.lit(1)).alias("__rows")], []
    for i, (c, kind) in enumerate(df.dtypes):
        q, number = F.col(f"`{c}`"), kind in NUMBERS or kind.startswith("decimal")
        as_double = q.cast("double")
        text = f"cast(`{c.replace('`', '``')}` as string)"
        aggs += [F.count(q).alias(f"__n{i}"), F.hll_sketch_agg(F.expr(text), LG_K).alias(f"__d{i}"),
                 F.expr(f"approx_top_k_accumulate({text}, {TRACKED})").alias(f"__t{i}")]
        if number:
            aggs += [F.min(as_double).alias(f"__lo{i}"), F.max(as_double).alias(f"__hi{i}"),
                     F.kll_sketch_agg_double(as_double, KLL_K).alias(f"__q{i}")]
        rows.append(F.struct(
            F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col("__rows").alias("rows"), (F.col("__rows") - F.col(f"__n{i}")).alias("nulls"),
            *[(F.col(f"__{x}{i}") if number else F.lit(None).cast(t)).alias(name)
              for x, name, t in (("lo", "least", "double"), ("hi", "greatest", "double"), ("q", "ranks", "binary"))],
            F.col(f"__d{i}").alias("distinct"), F.col(f"__t{i}").alias("frequent")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def merged(parts: DataFrame) -> DataFrame:
    """Rows of ``profile_part`` of any number of batches as one row a column."""
    return parts.groupBy("column", "kind").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.kll_merge_agg_double("ranks", KLL_K).alias("ranks"), F.hll_union_agg("distinct").alias("distinct"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"))


def shown(profile: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75), top: int = 3) -> DataFrame:
    """A profile to read: column, kind, rows, nulls, least, greatest,
    n_distinct, quantiles and frequent (array of item, count)."""
    quantiles = F.kll_sketch_get_quantile_double("ranks", F.array(*[F.lit(float(p)) for p in probs]))
    return profile.select("column", "kind", "rows", "nulls", "least", "greatest", F.hll_sketch_estimate("distinct").alias("n_distinct"),
                          F.when(F.col("least").isNotNull(), quantiles).alias("quantiles"),
                          F.expr(f"approx_top_k_estimate(frequent, {top})").alias("frequent"))


def keep_profile(df: DataFrame, base: str, name: str, batch: str) -> DataFrame:
    """Put the profile of one batch into table ``name`` (in place of an
    earlier one of that batch) and return the merge of all that is stored."""
    versions.append_batch(profile_part(df).coalesce(1), base, name, batch)
    return stored_profile(df.sparkSession, base, name)


def stored_profile(spark: SparkSession, base: str, name: str) -> DataFrame:
    return merged(versions.read_version(spark, base, name))
