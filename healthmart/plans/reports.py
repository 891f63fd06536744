"""The report set over the star schema (Q1-Q13 plus the logged variants).

Every report is a function ``Star -> DataFrame`` over the star's summary
(one grouped pass over the fact, see ``build_summary``). Dimensions are
literal frames of at most five rows and are broadcast.
Results carry the dashboard column names; ``pipeline`` adds the tag
column of the ELT exports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from healthmart.functions.features import day_type_name, gender_name, wait_bucket, weekday_name
from healthmart.operators.star import Star

NO_SHOW_SOURCE_ID = 1
DISEASE_SOURCE_ID = 2


def _tag(df: DataFrame, pipeline: str | None) -> DataFrame:
    return df.withColumn("pipeline", F.lit(pipeline)) if pipeline else df


# -- the shared summary --------------------------------------------------------
# Every report groups the fact by a few low-cardinality attributes and
# aggregates counts, sums, minima and maxima, which compose exactly; a mean is
# a sum over a count. One pass groups the fact by two sets of keys: all the
# small ones together, and, apart from them, disease names, an open domain
# that would multiply the others. The summary of a new batch is further rows
# of the same table: reports add them up.

CALENDAR_KEYS = ["source_id", "outcome_id", "age_group_id", "appt_month", "is_weekend", "appt_day_of_week",
                 "wait_bucket", "gender_code"]
DISEASE_KEYS = ["source_id", "disease_name"]


def build_summary(star: Star) -> DataFrame:
    """One aggregate pass over the fact (partial aggregation per task), by id
    keys only; ``part`` tells the grouping set.

    The attributes of the three dimensions are joined to the groups, not to
    the fact rows (left broadcast joins of a few literal rows), so every
    report reads one table and joins nothing; a group without a dimension
    match keeps NULL attributes and is left out exactly where the star join
    would drop it."""
    flag = F.col("outcome_flag").cast("double")
    keyed = star.fact.withColumn("wait_bucket", F.when(F.col("wait_days").isNotNull(), wait_bucket("wait_days")))
    groups = keyed.groupingSets([CALENDAR_KEYS, DISEASE_KEYS], *CALENDAR_KEYS, "disease_name").agg(
        F.when(F.grouping("disease_name") == 1, "calendar").otherwise("disease").alias("part"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("outcome_flag") == 1).alias("n_flag1"),
        F.count_if(F.col("outcome_flag") == 0).alias("n_flag0"),
        F.sum(flag).alias("sum_flag"), F.count(flag).alias("n_flag"),
        F.sum("age").alias("sum_age"), F.count("age").alias("n_age"),
        F.min("age").alias("min_age"), F.max("age").alias("max_age"),
        F.sum("wait_days").alias("sum_wait"), F.count("wait_days").alias("n_wait"),
        F.min("wait_days").alias("min_wait"),
        F.sum(F.col("comorbidity_count").cast("double")).alias("sum_com"),
        F.count("comorbidity_count").alias("n_com"),
    )
    return (groups.join(F.broadcast(star.dim_source.select("source_id", "source_name")), "source_id", "left")
                  .join(F.broadcast(star.dim_outcome.select("outcome_id", "outcome_label")), "outcome_id", "left")
                  .join(F.broadcast(star.dim_age_group.select("age_group_id", "age_group_name", "age_min", "age_max")),
                        "age_group_id", "left"))


def summary(star: Star, part: str = "calendar") -> DataFrame:
    """One part of the star's report summary: of the stored one if set, else
    planned from the star (then every report is one fact scan).

    The summary keeps its partitions and every report merges it by an
    ordinary shuffle on its own keys."""
    whole = star.summary if getattr(star, "summary", None) is not None else build_summary(star)
    return whole.where(F.col("part") == part)


def _named(star: Star, attr: str) -> DataFrame:
    """Summary rows that joined the dimension carrying ``attr``."""
    return summary(star).filter(F.col(attr).isNotNull())


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(count))


def _rate() -> Column:
    return _mean("sum_flag", "n_flag")


def _rate_pct() -> Column:
    """A10: ROUND(AVG(flag) * 100, 2)."""
    return F.round(_rate() * F.lit(100.0), 2)


def _cnt(col: str = "n") -> Column:
    return F.coalesce(F.sum(col), F.lit(0)).cast("long")


def _no_show(star: Star) -> DataFrame:
    return summary(star).filter(F.col("source_id") == NO_SHOW_SOURCE_ID)


def _small_sorted(df: DataFrame, *cols) -> DataFrame:
    """Total order of a result over a small key domain (months, days, age
    groups)."""
    return df.orderBy(*cols)


def kpi_summary(star: Star, pipeline: str | None = None, source_id: int | None = None) -> DataFrame:
    """One-row KPI summary (A2, A3, A6, A7). ``source_id`` limits it
    to one source (X16); by default it spans all rows."""
    s = summary(star) if source_id is None else summary(star).filter(F.col("source_id") == source_id)
    out = s.agg(
        _cnt().alias("total_pasien"),
        F.round(_rate(), 4).alias("no_show_rate"),
        F.round(_mean("sum_age", "n_age"), 1).alias("avg_usia"),
        F.round(_mean("sum_wait", "n_wait"), 1).alias("avg_wait_days"),
        _cnt("n_flag1").alias("total_no_show"),
        _cnt("n_flag0").alias("total_show"),
    )
    return _tag(out, pipeline)


def q1_source_totals(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q1: rows per source."""
    out = _named(star, "source_name").groupBy(F.col("source_name").alias("sumber")).agg(_cnt().alias("total"))
    return _tag(out, pipeline)


def q2_outcome_share(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q2: rows and percent of all fact rows per outcome."""
    s = summary(star)
    total = s.agg(_cnt().alias("__all"))
    per = (s.filter(F.col("outcome_label").isNotNull())
            .groupBy(F.col("outcome_label").alias("outcome")).agg(_cnt().alias("total")))
    out = (per.crossJoin(F.broadcast(total))
              .withColumn("persen", F.round(F.col("total") * F.lit(100.0) / F.col("__all"), 2))
              .drop("__all"))
    return _tag(out, pipeline)


def q3_age_by_outcome(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q3: mean/min/max age per outcome over rows with an age."""
    out = (_named(star, "outcome_label").filter(F.col("n_age") > 0)
               .groupBy(F.col("outcome_label").alias("outcome"))
               .agg(F.round(_mean("sum_age", "n_age"), 2).alias("rata_rata_usia"),
                    F.min("min_age").alias("usia_min"), F.max("max_age").alias("usia_max")))
    return _tag(out, pipeline)


def q4_age_groups(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q4: rows and rate per age group, ordered by age_min."""
    out = (_named(star, "age_group_name")
               .groupBy(F.col("age_group_name").alias("kelompok_usia"), "age_min", "age_max")
               .agg(_cnt().alias("total"), F.round(_rate(), 4).alias("no_show_rate")))
    return _tag(_small_sorted(out, "age_min"), pipeline)


def q5_monthly_rate(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q5: no-show rate per month."""
    out = (_no_show(star).filter(F.col("appt_month").isNotNull())
               .groupBy(F.col("appt_month").alias("bulan"))
               .agg(_cnt().alias("total"), F.sum("sum_flag").cast("long").alias("jumlah_no_show"),
                    _rate_pct().alias("no_show_rate_persen")))
    return _tag(_small_sorted(out, "bulan"), pipeline)


def q6_comorbidity_by_age(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q6: mean comorbidity per age group over rows that have one (J3, F2,
    A3, A24, O2)."""
    out = (_named(star, "age_group_name").filter(F.col("n_com") > 0)
               .groupBy(F.col("age_group_name").alias("kelompok_usia"), "age_min")
               .agg(F.round(_mean("sum_com", "n_com"), 3).alias("rata_comorbidity"), _cnt("n_com").alias("total")))
    return _tag(_small_sorted(out, "age_min"), pipeline)


def q7_weekend_rate(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q7: weekday vs weekend."""
    out = (_no_show(star).filter(F.col("is_weekend").isNotNull())
               .groupBy("is_weekend").agg(_cnt().alias("total"), _rate_pct().alias("no_show_rate_persen"))
               .select(day_type_name("is_weekend").alias("jenis_hari"), "total", "no_show_rate_persen"))
    return _tag(out, pipeline)


def q8_top_diseases(star: Star, k: int = 15, pipeline: str | None = None) -> DataFrame:
    """Q8: top-k diseases by cases, ties by name descending.

    The limit is the feature; planned as TakeOrderedAndProject over the
    per-disease counts."""
    out = (summary(star, "disease").filter((F.col("source_id") == DISEASE_SOURCE_ID) & (F.col("disease_name") != "N/A"))
               .groupBy(F.col("disease_name").alias("penyakit")).agg(_cnt().alias("jumlah_kasus"))
               .orderBy(F.desc("jumlah_kasus"), F.desc("penyakit")).limit(k))
    return _tag(out, pipeline)


def q9_wait_by_outcome(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q9: mean waiting days per outcome."""
    out = (_named(star, "outcome_label").filter(F.col("n_wait") > 0)
               .groupBy(F.col("outcome_label").alias("outcome"))
               .agg(F.round(_mean("sum_wait", "n_wait"), 2).alias("avg_wait")))
    return _tag(out, pipeline)


def q11_weekday_rate(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q11: rate per weekday, Sunday=0 names."""
    out = (_no_show(star).filter(F.col("appt_day_of_week").isNotNull())
               .groupBy("appt_day_of_week").agg(_cnt().alias("total"), _rate_pct().alias("no_show_rate_persen"))
               .select(weekday_name("appt_day_of_week").alias("hari"),
                       F.col("appt_day_of_week").alias("urutan"), "total", "no_show_rate_persen"))
    return _tag(_small_sorted(out, "urutan"), pipeline)


def q12_wait_bucket_rate(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q12: rate per waiting-time bucket, ordered by the bucket's smallest
    wait (M22, A22, A10, O3)."""
    out = (_no_show(star).filter(F.col("wait_bucket").isNotNull())
               .groupBy(F.col("wait_bucket").alias("kategori_tunggu"))
               .agg(_cnt().alias("total"), _rate_pct().alias("no_show_rate_persen"),
                    F.min("min_wait").alias("__min")))
    return _tag(_small_sorted(out, "__min").drop("__min"), pipeline)


def q13_gender_rate(star: Star, pipeline: str | None = None) -> DataFrame:
    """Q13: rate per gender code."""
    out = (_no_show(star).groupBy("gender_code")
               .agg(_cnt().alias("total"), _rate_pct().alias("no_show_rate_persen"))
               .select(gender_name("gender_code").alias("gender"), "total", "no_show_rate_persen"))
    return _tag(out, pipeline)


def dashboard(star: Star, pipeline: str | None = None) -> dict:
    """The exported report set: name -> thunk returning the DataFrame."""
    return {
        "kpi_summary": lambda: kpi_summary(star, pipeline),
        "q1_total_per_sumber": lambda: q1_source_totals(star, pipeline),
        "q2_distribusi_outcome": lambda: q2_outcome_share(star, pipeline),
        "q3_usia_per_outcome": lambda: q3_age_by_outcome(star, pipeline),
        "q4_distribusi_usia": lambda: q4_age_groups(star, pipeline),
        "q5_noshow_per_bulan": lambda: q5_monthly_rate(star, pipeline),
        "q6_comorbidity_per_usia": lambda: q6_comorbidity_by_age(star, pipeline),
        "q7_noshow_weekend": lambda: q7_weekend_rate(star, pipeline),
        "q8_top_penyakit": lambda: q8_top_diseases(star, 15, pipeline),
        "extra_wait_outcome": lambda: q9_wait_by_outcome(star, pipeline),
        "extra_noshow_per_hari": lambda: q11_weekday_rate(star, pipeline),
        "extra_wait_days_distribusi": lambda: q12_wait_bucket_rate(star, pipeline),
        "extra_gender_noshow": lambda: q13_gender_rate(star, pipeline),
    }


# -- the eight analytic queries each pipeline logs ---------------------------

def analytic_queries(star: Star) -> dict:
    """The pipelines' own query list (shorter columns, rates as fractions)."""
    s = summary(star)
    rate4 = F.round(_rate(), 4)
    ns = s.filter(F.col("source_id") == NO_SHOW_SOURCE_ID)
    return {
        "source_totals": lambda: _named(star, "source_name").groupBy("source_name").agg(_cnt().alias("total")),
        "outcome_totals": lambda: _named(star, "outcome_label").groupBy("outcome_label").agg(_cnt().alias("total")),
        "avg_age_by_outcome": lambda: _named(star, "outcome_label").filter(F.col("n_age") > 0)
            .groupBy("outcome_label").agg(F.round(_mean("sum_age", "n_age"), 2).alias("avg_age")),
        "age_group_totals": lambda: _small_sorted(
            _named(star, "age_group_name").groupBy("age_group_name", "age_min").agg(_cnt().alias("total")),
            "age_min").drop("age_min"),
        "monthly_rate": lambda: _small_sorted(
            ns.filter(F.col("appt_month").isNotNull()).groupBy("appt_month").agg(rate4.alias("no_show_rate")),
            "appt_month"),
        "comorbidity_by_age": lambda: _named(star, "age_group_name").filter(F.col("n_com") > 0)
            .groupBy("age_group_name").agg(F.round(_mean("sum_com", "n_com"), 2).alias("avg_comorbidity")),
        "weekend_rate": lambda: ns.filter(F.col("is_weekend").isNotNull())
            .groupBy("is_weekend").agg(rate4.alias("no_show_rate"), _cnt().alias("total")),
        "top10_diseases": lambda: summary(star, "disease").filter(F.col("source_id") == DISEASE_SOURCE_ID).groupBy("disease_name")
            .agg(_cnt().alias("total")).orderBy(F.desc("total"), F.desc("disease_name")).limit(10),
        "avg_wait_by_outcome": lambda: _named(star, "outcome_label").filter(F.col("n_wait") > 0)
            .groupBy("outcome_label").agg(F.round(_mean("sum_wait", "n_wait"), 2).alias("avg_wait")),
    }


def star_rollup(star: Star) -> DataFrame:
    """Flagship: the fact joined to all three dimensions, rolled up to
    (source, outcome, age group) with count, mean age and rate."""
    s = summary(star).filter(F.col("source_name").isNotNull() & F.col("outcome_label").isNotNull()
                             & F.col("age_group_name").isNotNull())
    return (s.groupBy("source_name", "outcome_label", "age_group_name")
             .agg(_cnt().alias("total"), F.round(_mean("sum_age", "n_age"), 4).alias("avg_age"),
                  F.round(_rate(), 4).alias("rate")))
