"""Star schema: literal dimensions, lookups, outcome mapping, fact
(S8-S10, J4-J6, O7, M24)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart import schemas
from healthmart.functions.features import age_group_case


def dim_source(spark: SparkSession, with_description: bool = True) -> DataFrame:
    df = spark.createDataFrame(schemas.SOURCES, schemas.DIM_SOURCE)
    return df if with_description else df.drop("description")


def dim_outcome(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(schemas.OUTCOMES, schemas.DIM_OUTCOME)


def dim_age_group(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(schemas.AGE_GROUPS, schemas.DIM_AGE_GROUP)


@dataclass
class Star:
    """The mart: one fact and three dimensions."""
    fact: DataFrame
    dim_source: DataFrame
    dim_outcome: DataFrame
    dim_age_group: DataFrame
    summary: DataFrame | None = None

    @classmethod
    def with_literal_dims(cls, fact: DataFrame, with_description: bool = True) -> "Star":
        spark = fact.sparkSession
        return cls(fact, dim_source(spark, with_description), dim_outcome(spark), dim_age_group(spark))


def code_lookup(df: DataFrame, dim: DataFrame, on: str, dim_key: str, dim_value: str,
                out: str, default=None, small_dim: bool = False) -> DataFrame:
    """Value -> id through a dimension, missing -> ``default``.

    Left join onto the dimension. ``small_dim`` declares the dimension
    bounded (the literal dimensions of this library are a handful of rows)
    and broadcasts it, so the fact is never shuffled; otherwise the join is
    left to Spark, whose broadcast threshold and AQE runtime statistics
    decide from the actual size.
    """
    d = dim.select(F.col(dim_key).alias("__k"), F.col(dim_value).alias("__v"))
    joined = df.join(F.broadcast(d) if small_dim else d, F.col(f"`{on}`") == F.col("__k"), "left")
    val = F.coalesce(F.col("__v"), F.lit(default)) if default is not None else F.col("__v")
    return joined.withColumn(out, val).drop("__k", "__v")


def const_join(df: DataFrame, dim: DataFrame, name_col: str, name: str, take: list[str]) -> DataFrame:
    """Join every row to the one dimension row selected by a constant
    condition (``JOIN dim ON dim.name = 'x'``). A one-row broadcast side
    turns into a nested-loop join that copies the columns."""
    pick = dim.filter(F.col(name_col) == F.lit(name)).select(*take)
    return df.crossJoin(F.broadcast(pick))


def outcome_id(flag: Column, source: Column | None = None, mode: str = "source_aware") -> Column:
    """Outcome flag -> outcome_id.

    ``source_aware`` (default): no-show 1 -> 1 (No-Show), else 2;
    disease 1 -> 2 (Positive), else 1. ``flag`` maps 1 -> 2, else 1 for
    every source (the one-mapping form).
    """
    positive_two = F.when(flag == 1, 2).otherwise(1)
    if mode == "flag" or source is None:
        return positive_two
    return F.when(source == F.lit("no_show"), F.when(flag == 1, 1).otherwise(2)).otherwise(positive_two)


def age_group_id(age: Column, default: int = 3, null_value=None) -> Column:
    """Range lookup into the age-group dimension, first match by
    age_min; gaps (e.g. 12.5) -> ``default``, NULL -> ``null_value``."""
    return age_group_case(age, default=default, null_value=null_value)


def build_fact(conformed: DataFrame, source_ids: DataFrame, outcome_mode: str = "source_aware",
               age_default: int = 3, age_null=None, fact_id: Column | None = None) -> DataFrame:
    """Conformed rows -> fact columns in warehouse types.

    ``source_ids`` is the source dimension (name -> id, default 1).
    ``fact_id`` is an expression for the surrogate key when ids are already
    assigned upstream.
    """
    f = code_lookup(conformed, source_ids, "source", "source_name", "source_id", "source_id", default=1,
                    small_dim=True)
    f = f.withColumns({
        "outcome_id": outcome_id(F.col("outcome_flag"), F.col("source"), outcome_mode).cast("int"),
        "age_group_id": age_group_id(F.col("age"), age_default, age_null),
        "source_id": F.col("source_id").cast("int"),
    })
    if fact_id is not None:
        f = f.withColumn("fact_id", fact_id.cast("long"))
    cols = [c for c in schemas.FACT_COLUMNS if c in f.columns]
    return f.select(*cols)
