"""The registered queries: one Spark DataFrame per operator or report, each
reading the driver's tables, with the matching oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Every query runs over whole tables; nulls, blanks and mixed case that the
driver tables lack are made inside the query (CASE / NULLIF), identically
in the SQL.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart.functions import columns as C
from healthmart.functions import encode as E
from healthmart.functions import features as X
from healthmart.operators import audit, clean, conform as cf, quality, scale, star as st
from healthmart.plans import oracle_sql as O
from healthmart.plans import pipelines as P
from healthmart.plans import reports as R
from healthmart.plans.report_sql import LOG_SQL, REPORT_SQL, STAR_ROLLUP
from healthmart.sources import files
from healthmart.sources.tables import APPOINTMENTS_SQL, PROFILES_SQL, appointments, disease_profiles, table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _t(spark, sf, name) -> DataFrame:
    return table(spark, sf, name)


# =============================================================================
# Star and reports (ELT fact over the role views)
# =============================================================================

def elt_star(spark: SparkSession, sf: str, assign_ids: bool = False) -> st.Star:
    ns, ds = appointments(spark, sf), disease_profiles(spark, sf)
    return P.run_elt(ns, ds, P.Options(checkpoint=False), assign_ids=assign_ids).star


def etl_result(spark: SparkSession, sf: str) -> P.Result:
    ns, ds = appointments(spark, sf), disease_profiles(spark, sf)
    return P.run_etl(ns, ds, P.Options())


REPORT_FN = {
    "q10_kpi_summary": R.kpi_summary,
    "q1_source_totals": R.q1_source_totals,
    "q2_outcome_share": R.q2_outcome_share,
    "q3_age_by_outcome": R.q3_age_by_outcome,
    "q4_age_groups": R.q4_age_groups,
    "q5_monthly_rate": R.q5_monthly_rate,
    "q6_comorbidity_by_age": R.q6_comorbidity_by_age,
    "q7_weekend_rate": R.q7_weekend_rate,
    "q8_top10": lambda s: R.q8_top_diseases(s, 10),
    "q8_top15": lambda s: R.q8_top_diseases(s, 15),
    "q9_wait_by_outcome": R.q9_wait_by_outcome,
    "q11_weekday_rate": R.q11_weekday_rate,
    "q12_wait_bucket_rate": R.q12_wait_bucket_rate,
    "q13_gender_rate": R.q13_gender_rate,
}

for _name, _fn in REPORT_FN.items():
    register(_name, O.with_(O.ELT_FACT, REPORT_SQL[_name]))(
        lambda spark, sf, _f=_fn: _f(elt_star(spark, sf)))

register("kpi_summary", O.with_(O.ELT_FACT, REPORT_SQL["q10_kpi_summary"]))(
    lambda spark, sf: R.kpi_summary(elt_star(spark, sf)))

# Reports over the ETL flow's star as well.
for _name in ("q1_source_totals", "q10_kpi_summary", "q4_age_groups"):
    register(f"etl_{_name}", O.with_(O.ETL_FACT, REPORT_SQL[_name]))(
        lambda spark, sf, _f=REPORT_FN[_name]: _f(etl_result(spark, sf).star))

@register("star_rollup", O.with_(O.ELT_FACT, STAR_ROLLUP))
def q_star_rollup(spark, sf):
    """Flagship (J1 J2 J3 A1 A3): the star rolled up over all three dims."""
    return R.star_rollup(elt_star(spark, sf))


# The analytic queries each flow logs, over its own star.
for _k, _sql in LOG_SQL.items():
    register(f"log_{_k}", O.with_(O.ELT_FACT, _sql))(
        lambda spark, sf, _q=_k: R.analytic_queries(elt_star(spark, sf))[_q]())
    register(f"etl_log_{_k}", O.with_(O.ETL_FACT, _sql))(
        lambda spark, sf, _q=_k: R.analytic_queries(etl_result(spark, sf).star)[_q]())


# =============================================================================
# Pipelines, stages and the fact
# =============================================================================

@register("fact_build", O.with_(O.ELT_FACT_IDS, "SELECT * FROM fact_ids"))
def q_fact_build(spark, sf):
    """The ELT fact with dense fact ids."""
    ns, ds = appointments(spark, sf), disease_profiles(spark, sf)
    return P.run_elt(ns, ds, P.Options(), assign_ids=True).star.fact


@register("etl_fact", O.with_(O.ETL_FACT, "SELECT * FROM fact"))
def q_etl_fact(spark, sf):
    """The ETL flow end to end: clean, standardise, enrich, conform, ids,
    validate, load (record and fact ids dense)."""
    return etl_result(spark, sf).star.fact


@register("conform_union", O.with_(O.ETL_CONFORMED, "SELECT * FROM conformed"))
def q_conform_union(spark, sf):
    """Both sources in the 17-column layout with
    record ids."""
    return etl_result(spark, sf).conformed


@register("elt_clean_no_show", O.with_(O.ELT_CLEAN, "SELECT * FROM clean_ns"))
def q_elt_clean_no_show(spark, sf):
    """SQL-style cleaning of appointments."""
    return P.elt_clean_appointments(appointments(spark, sf), P.Options())


@register("dedupe_expr_key", O.with_(O.ELT_CLEAN, "SELECT * FROM clean_ds"))
def q_dedupe_expr_key(spark, sf):
    """One row per (disease, CAST age, CASE gender) -- clean_disease."""
    return P.elt_clean_profiles(disease_profiles(spark, sf), P.Options())


@register("elt_enriched_no_show", O.with_(O.ELT_ENRICH, "SELECT * FROM enr_ns"))
def q_elt_enriched_no_show(spark, sf):
    """enriched_no_show."""
    opts = P.Options()
    return P.elt_enrich_appointments(P.elt_clean_appointments(appointments(spark, sf), opts), opts)


@register("elt_enriched_disease", O.with_(O.ELT_ENRICH, "SELECT * FROM enr_ds"))
def q_elt_enriched_disease(spark, sf):
    """enriched_disease."""
    opts = P.Options()
    return P.elt_enrich_profiles(P.elt_clean_profiles(disease_profiles(spark, sf), opts), opts)


@register("quality_report", O.with_(O.ELT_FACT, """
SELECT 'V1' AS rule, '*' AS "column", 'rows' AS item, count(*) AS n, CAST(NULL AS DOUBLE) AS share FROM fact
UNION ALL SELECT 'V2', 'age', 'nulls', count(*) FILTER (WHERE age IS NULL), NULL FROM fact
UNION ALL SELECT 'V3', 'age', 'outside [0,120]', count(*) FILTER (WHERE age NOT BETWEEN 0 AND 120), NULL FROM fact
UNION ALL SELECT 'V4', 'source_id', 'not in dim_source',
                 count(*) FILTER (WHERE source_id NOT IN (SELECT source_id FROM dim_source)), NULL FROM fact
UNION ALL SELECT 'V5', 'source_name', s.source_name, count(*), NULL FROM fact f JOIN dim_source s ON f.source_id = s.source_id
          GROUP BY s.source_name
UNION ALL SELECT 'V6', 'outcome_label', o.outcome_label, count(*), NULL FROM fact f JOIN dim_outcome o ON f.outcome_id = o.outcome_id
          GROUP BY o.outcome_label"""))
def q_quality_report(spark, sf):
    """V2 V3 V5 V6 V7 J7 A2 (report-only rules over the ELT fact)."""
    return quality.check_fact(elt_star(spark, sf))


@register("etl_quality_report", O.with_(O.ETL_CONFORMED, """
SELECT 'V1' AS rule, 'record_id' AS "column", 'duplicates' AS item,
       CAST(coalesce((SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM conformed GROUP BY record_id)), 0) AS BIGINT) AS n,
       CAST(NULL AS DOUBLE) AS share
UNION ALL SELECT 'V2', 'record_id', 'nulls', count(*) FILTER (WHERE record_id IS NULL), NULL FROM conformed
UNION ALL SELECT 'V2', 'source', 'nulls', count(*) FILTER (WHERE source IS NULL), NULL FROM conformed
UNION ALL SELECT 'V2', 'age', 'nulls', count(*) FILTER (WHERE age IS NULL), NULL FROM conformed
UNION ALL SELECT 'V3', 'age', 'outside [0,120]', count(*) FILTER (WHERE age IS NOT NULL AND NOT age BETWEEN 0 AND 120), NULL FROM conformed
UNION ALL SELECT 'V4', 'record_id', 'not coercible', 0, NULL
UNION ALL SELECT 'V4', 'gender_code', 'not coercible', 0, NULL
UNION ALL SELECT 'V4', 'outcome_flag', 'not coercible', 0, NULL
UNION ALL SELECT 'V5', 'source', 'invalid', count(*) FILTER (WHERE source IS NULL OR source NOT IN ('no_show', 'disease')), NULL FROM conformed
UNION ALL SELECT 'V7', '*', 'rows', count(*), NULL FROM conformed
UNION ALL SELECT 'V6', 'source', source, n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 4)
          FROM (SELECT source, count(*) AS n FROM conformed GROUP BY source)"""))
def q_etl_quality_report(spark, sf):
    """ETL rules over the conformed rows."""
    return etl_result(spark, sf).quality


@register("etl_end_to_end", O.with_(O.ETL_FACT, "SELECT * FROM fact"))
def q_etl_end_to_end(spark, sf):
    """Whole ETL flow with its zones: landing copies, lake snapshot, star
    written to the warehouse; returns the stored fact read back."""
    base = P.scratch_base(spark, f"etl-{uuid.uuid4().hex}")
    ns, ds = appointments(spark, sf), disease_profiles(spark, sf)
    return P.run_etl(ns, ds, P.Options(), base=base).star.fact


@register("elt_end_to_end", O.with_(O.ELT_FACT_IDS, "SELECT * FROM fact_ids"))
def q_elt_end_to_end(spark, sf):
    """Whole ELT flow with its zones: raw lake landing, staging tables,
    star written to the warehouse; returns the stored fact read back."""
    base = P.scratch_base(spark, f"elt-{uuid.uuid4().hex}")
    ns, ds = appointments(spark, sf), disease_profiles(spark, sf)
    return P.run_elt(ns, ds, P.Options(), base=base).star.fact


# =============================================================================
# Operators, one query each
# =============================================================================

LI_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
           "l_partkey", "l_suppkey"]


@register("dedupe_full_row", """
SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem""")
def q_dedupe_full_row(spark, sf):
    """A14."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return clean.dedupe_full_row(li)


@register("dedupe_keep_first", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_partkey, l_suppkey
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_partkey, l_suppkey) AS rn
      FROM lineitem) WHERE rn = 1""")
def q_dedupe_keep_first(spark, sf):
    """First line per (order, line number) by ship date."""
    li = _t(spark, sf, "lineitem").select(*LI_COLS, "l_shipdate")
    return clean.dedupe_keep_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).drop("l_shipdate")


@register("having_filter", """
SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) >= 6""")
def q_having_filter(spark, sf):
    """Filter after aggregation."""
    li = _t(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 6)


@register("dup_key_report", """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def q_dup_key_report(spark, sf):
    """A19 V1."""
    return clean.duplicate_key_count(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("drop_null_keys", """
SELECT l_orderkey, l_linenumber, k FROM (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS k FROM lineitem)
WHERE k IS NOT NULL""")
def q_drop_null_keys(spark, sf):
    """F1."""
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_orderkey")).alias("k"))
    return clean.drop_null(li, ["k"])


CUST_V = "CASE WHEN c_nationkey = 0 THEN NULL ELSE c_acctbal END"


def _cust_v(spark, sf):
    return _t(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") == 0, None).otherwise(F.col("c_acctbal")).alias("v"))


@register("null_or_range", f"""
SELECT c_custkey, v FROM (SELECT c_custkey, {CUST_V} AS v FROM customer) WHERE v IS NULL OR v BETWEEN 0 AND 5000""")
def q_null_or_range(spark, sf):
    """F5 V3 (ETL form): NULL or inside the closed range."""
    return clean.range_filter(_cust_v(spark, sf), "v", 0, 5000, keep_null=True)


@register("range_violations", f"""
SELECT count(*) FILTER (WHERE v NOT BETWEEN 0 AND 5000) AS out_range FROM (SELECT {CUST_V} AS v FROM customer)""")
def q_range_violations(spark, sf):
    """F6 V3 (SQL form): NOT BETWEEN, NULL not counted."""
    return _cust_v(spark, sf).agg(F.count_if(clean.out_of_range("v", 0, 5000)).alias("out_range"))


@register("range_filter", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def q_range_filter(spark, sf):
    """lower bound (drops negatives)."""
    return clean.range_filter(_t(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", lo=0)


@register("between_filter", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 40")
def q_between_filter(spark, sf):
    """closed range."""
    return clean.range_filter(_t(spark, sf, "part").select("p_partkey", "p_size"), "p_size", 10, 40)


@register("membership_filter", """
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P') AND o_orderpriority != '3-MEDIUM'""")
def q_membership_filter(spark, sf):
    """IN, NOT IN and != predicates (pushed to the scan)."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    o = clean.membership_filter(o, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    o = clean.membership_filter(o, "o_orderstatus", ["P"], negate=True)
    return o.filter(F.col("o_orderpriority") != "3-MEDIUM")


@register("guarded_case", """
SELECT l.l_orderkey, l.l_linenumber,
       CASE WHEN sd IS NOT NULL AND l.l_shipdate IS NOT NULL
            THEN abs(epoch_us(l.l_shipdate) - epoch_us(sd)) / CAST(86400000000 AS DOUBLE) END AS wait
FROM lineitem l JOIN (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS sd
                      FROM orders) o ON l.l_orderkey = o.o_orderkey""")
def q_guarded_case(spark, sf):
    """Value only when both operands are present."""
    o = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", None).otherwise(F.col("o_orderdate")).alias("sd"))
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    w = F.when(F.col("sd").isNotNull() & F.col("l_shipdate").isNotNull(),
               X.wait_days(F.col("sd").cast("timestamp"), F.col("l_shipdate").cast("timestamp"), None))
    return j.select("l_orderkey", "l_linenumber", w.alias("wait"))


@register("rounding_modes", """
SELECT l_orderkey, l_linenumber, l_quantity / 8 AS x8, round(l_quantity / 8, 2) AS up2, round_even(l_quantity / 8, 2) AS even2,
       round(l_quantity / 4, 1) AS up1, round_even(l_quantity / 4, 1) AS even1
FROM lineitem""")
def q_rounding_modes(spark, sf):
    """SQL ROUND (half up) vs banker's rounding on exact halves."""
    li = _t(spark, sf, "lineitem")
    x8, x4 = F.col("l_quantity") / 8, F.col("l_quantity") / 4
    return li.select("l_orderkey", "l_linenumber", x8.alias("x8"), E.round_half_up(x8, 2).alias("up2"),
                     E.round_half_even(x8, 2).alias("even2"), E.round_half_up(x4, 1).alias("up1"),
                     E.round_half_even(x4, 1).alias("even1"))


@register("head_n", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, l_shipdate
LIMIT 5""")
def q_head_n(spark, sf):
    """First five rows of a total order (TakeOrderedAndProject)."""
    li = _t(spark, sf, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return li.orderBy(*order).limit(5).select(*LI_COLS[:6])


@register("iqr_filter", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""")
def q_iqr_filter(spark, sf):
    """1.5 x IQR fence, exact linear-interpolated quartiles."""
    return clean.iqr_filter(_t(spark, sf, "events").select("event_id", "value"), "value", 1.5)


@register("fill_text_unknown", """
SELECT c_custkey, coalesce(CASE WHEN c_nationkey = 1 THEN NULL ELSE c_mktsegment END, 'Unknown') AS seg,
       coalesce(CASE WHEN c_nationkey = 2 THEN NULL ELSE c_name END, 'Unknown') AS name, c_acctbal
FROM customer""")
def q_fill_text_unknown(spark, sf):
    """Every text column's NULLs -> 'Unknown'."""
    c = _t(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") == 1, None).otherwise(F.col("c_mktsegment")).alias("seg"),
        F.when(F.col("c_nationkey") == 2, None).otherwise(F.col("c_name")).alias("name"),
        "c_acctbal")
    return clean.fill_text(c)


@register("fill_median", """
WITH t AS (SELECT c_custkey, CASE WHEN c_nationkey < 3 THEN NULL ELSE c_acctbal END AS bal FROM customer)
SELECT c_custkey, coalesce(bal, (SELECT median(bal) FROM t)) AS bal FROM t""")
def q_fill_median(spark, sf):
    """NULL -> exact median of the column."""
    c = _t(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") < 3, None).otherwise(F.col("c_acctbal")).alias("bal"))
    return clean.fill_median(c, ["bal"])


_STATUS_TXT_SQL = f"""CASE o_orderpriority WHEN '1-URGENT' THEN lower(o_orderstatus)
                     WHEN '2-HIGH' THEN ' ' || o_orderstatus || chr(9) WHEN '3-MEDIUM' THEN NULL
                     ELSE o_orderstatus END"""


@register("encode_gender", f"""
SELECT o_orderkey, CASE upper(trim({_STATUS_TXT_SQL}, {O.WS})) WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE -1 END AS code
FROM orders""")
def q_encode_gender(spark, sf):
    """Two-way code with a -1 default after trimming and case folding."""
    o = _t(spark, sf, "orders")
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    txt = (F.when(p == "1-URGENT", F.lower(s)).when(p == "2-HIGH", F.concat(F.lit(" "), s, F.lit("\t")))
            .when(p == "3-MEDIUM", F.lit(None)).otherwise(s))
    return o.select("o_orderkey", E.encode_gender(txt, male="O", female="F", case="upper").alias("code"))


@register("encode_binary", f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN lower(trim(CASE l_returnflag WHEN 'R' THEN ' Yes' WHEN 'A' THEN 'YES' || chr(10) ELSE 'no' END, {O.WS})) = 'yes'
            THEN 1 ELSE 0 END AS flag
FROM lineitem""")
def q_encode_binary(spark, sf):
    """Yes -> 1, anything else -> 0."""
    r = F.col("l_returnflag")
    txt = F.when(r == "R", " Yes").when(r == "A", "YES\n").otherwise("no")
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", E.encode_binary(txt).alias("flag"))


@register("encode_ordinal", f"""
SELECT o_orderkey,
       CASE lower(trim(CASE o_orderpriority WHEN '1-URGENT' THEN 'High' WHEN '2-HIGH' THEN ' HIGH'
                                            WHEN '3-MEDIUM' THEN 'normal' WHEN '5-LOW' THEN 'Low' ELSE NULL END, {O.WS}))
            WHEN 'low' THEN 0 WHEN 'normal' THEN 1 WHEN 'high' THEN 2 ELSE 1 END AS level
FROM orders""")
def q_encode_ordinal(spark, sf):
    """M6: low/normal/high -> 0/1/2, unknown -> 1."""
    p = F.col("o_orderpriority")
    txt = (F.when(p == "1-URGENT", "High").when(p == "2-HIGH", " HIGH").when(p == "3-MEDIUM", "normal")
            .when(p == "5-LOW", "Low"))
    return _t(spark, sf, "orders").select("o_orderkey", E.encode_ordinal(txt).alias("level"))


@register("minmax_scale", """
WITH mm AS (SELECT min(CAST(p_size AS DOUBLE)) AS mn, max(CAST(p_size AS DOUBLE)) AS mx FROM part)
SELECT p_partkey, p_size, (CAST(p_size AS DOUBLE) - mn) / (mx - mn + CAST(1e-9 AS DOUBLE)) AS p_size_norm FROM part, mm""")
def q_minmax_scale(spark, sf):
    """Min-max over the frame itself, eps 1e-9."""
    return scale.minmax_scale(_t(spark, sf, "part").select("p_partkey", "p_size"), "p_size", "p_size_norm", 1e-9)


@register("minmax_scale_raw", """
WITH mm AS (SELECT min(CAST(p_size AS DOUBLE)) AS mn, max(CAST(p_size AS DOUBLE)) AS mx FROM part)
SELECT p_partkey, p_size,
       round((CAST(p_size AS DOUBLE) - mn) / (mx - mn + CAST(0.0001 AS DOUBLE)), 4) AS p_size_norm
FROM part, mm WHERE p_type != 'PROMO'""")
def q_minmax_scale_raw(spark, sf):
    """min/max over the raw table, scaled rows filtered, eps 1e-4, 4 digits."""
    raw = _t(spark, sf, "part")
    kept = raw.filter(F.col("p_type") != "PROMO").select("p_partkey", "p_size")
    return scale.minmax_scale(kept, "p_size", "p_size_norm", 1e-4, domain=raw, scale=4)


@register("max_scale", """
SELECT event_id, value, round(value / ((SELECT max(value) FROM events) + CAST(0.0001 AS DOUBLE)), 4) AS value_norm
FROM events""")
def q_max_scale(spark, sf):
    """M9: x / (max + 1e-4), 4 digits."""
    return scale.max_scale(_t(spark, sf, "events").select("event_id", "value"), "value", "value_norm")


@register("parse_timestamp", """
SELECT event_id, epoch_us(p) // 1000000 AS epoch_s FROM (
  SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'Unknown' WHEN event_type = 'view' THEN NULL
                                 ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS p
  FROM events)
WHERE p IS NOT NULL""")
def q_parse_timestamp(spark, sf):
    """Text -> timestamp, unparseable and NULL dropped."""
    ev = _t(spark, sf, "events")
    et = F.col("event_type")
    txt = (F.when(et == "error", "Unknown").when(et == "view", F.lit(None))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    df = clean.parse_dates(ev.select("event_id", txt.alias("p")), ["p"])
    return df.select("event_id", F.unix_seconds("p").alias("epoch_s"))


ANCHOR = "2024-01-15 00:00:00"


@register("wait_days", f"""
SELECT event_id, round_even(abs(epoch_us(ts) - epoch_us(TIMESTAMP '{ANCHOR}')) / CAST(86400000000 AS DOUBLE), 1) AS wait
FROM events""")
def q_wait_days(spark, sf):
    """|difference| in days, banker's rounding to 0.1."""
    anchor = F.to_timestamp(F.lit(ANCHOR))
    return _t(spark, sf, "events").select("event_id", X.wait_days(anchor, F.col("ts").cast("timestamp"), 1).alias("wait"))


@register("wait_days_unrounded", f"""
SELECT event_id, abs(epoch_us(ts) - epoch_us(TIMESTAMP '{ANCHOR}')) / CAST(86400000000 AS DOUBLE) AS wait FROM events""")
def q_wait_days_unrounded(spark, sf):
    """Exact fractional days (julian-day difference)."""
    anchor = F.to_timestamp(F.lit(ANCHOR))
    return _t(spark, sf, "events").select("event_id", X.wait_days(anchor, F.col("ts").cast("timestamp"), None).alias("wait"))


@register("wait_days_calendar", f"""
SELECT event_id, CAST(abs(date_diff('day', DATE '2024-01-15', CAST(ts AS DATE))) AS DOUBLE) AS wait FROM events""")
def q_wait_days_calendar(spark, sf):
    """X13 variant: whole calendar days."""
    anchor = F.to_timestamp(F.lit(ANCHOR))
    return _t(spark, sf, "events").select("event_id", X.wait_days_calendar(anchor, "ts").alias("wait"))


@register("calendar_parts", """
SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS dow_mon0, CAST(dayofweek(ts) AS INTEGER) AS dow_sun0,
       CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour,
       CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM events""")
def q_calendar_parts(spark, sf):
    """M13-M17."""
    ev = _t(spark, sf, "events")
    dow = X.day_of_week("ts", "sunday")
    return ev.select("event_id", X.day_of_week("ts", "monday").alias("dow_mon0"), dow.alias("dow_sun0"),
                     X.month_of("ts").alias("month"), X.hour_of("ts").alias("hour"),
                     X.weekend_flag(dow, "sunday").alias("is_weekend"))


@register("row_sum", """
SELECT l_orderkey, l_linenumber,
       CAST(coalesce(TRY_CAST(CASE WHEN l_returnflag = 'R' THEN 'abc' ELSE CAST(l_linenumber AS VARCHAR) END AS DOUBLE), 0)
            + coalesce(TRY_CAST(CAST(l_discount > 0.05 AS INTEGER) AS DOUBLE), 0)
            + coalesce(TRY_CAST(CASE WHEN l_linestatus = 'F' THEN NULL ELSE 2 END AS DOUBLE), 0) AS INTEGER) AS total
FROM lineitem""")
def q_row_sum(spark, sf):
    """Numeric-coerced row sum, junk/NULL -> 0."""
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", "abc").otherwise(F.col("l_linenumber").cast("string")).alias("a"),
        (F.col("l_discount") > 0.05).cast("int").alias("b"),
        F.when(F.col("l_linestatus") == "F", None).otherwise(F.lit(2)).alias("c"))
    return li.select("l_orderkey", "l_linenumber", X.row_sum(["a", "b", "c"]).alias("total"))


@register("yes_count", f"""
SELECT "Disease", "Age",
       (CASE WHEN lower("Fever") = 'yes' THEN 1 ELSE 0 END) + (CASE WHEN lower("Cough") = 'yes' THEN 1 ELSE 0 END)
       + (CASE WHEN lower("Fatigue") = 'yes' THEN 1 ELSE 0 END)
       + (CASE WHEN lower("Difficulty Breathing") = 'yes' THEN 1 ELSE 0 END) AS symptoms
FROM ({PROFILES_SQL})""")
def q_yes_count(spark, sf):
    """Number of 'yes' answers per row."""
    pr = disease_profiles(spark, sf)
    return pr.select("Disease", "Age", X.yes_count(["Fever", "Cough", "Fatigue", "Difficulty Breathing"]).alias("symptoms"))


@register("flag_sum", """
SELECT l_orderkey, l_linenumber, CAST(l_discount > 0.05 AS INTEGER) + CAST(l_tax > 0.04 AS INTEGER) AS flags FROM lineitem""")
def q_flag_sum(spark, sf):
    """M20."""
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     X.flag_sum([(F.col("l_discount") > 0.05).cast("int"), (F.col("l_tax") > 0.04).cast("int")])
                     .alias("flags"))


@register("bucket_age", f"""
SELECT l_orderkey, l_linenumber, x, {O.age_group('x', 5, 5)} AS g_elt, {O.age_group('x', 3, 3)} AS g_etl
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 4 + 0.5 END AS x FROM lineitem)""")
def q_bucket_age(spark, sf):
    """Age groups, gaps (12.5) and NULL to the default group."""
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_quantity") / 4 + 0.5).alias("x"))
    return li.select("l_orderkey", "l_linenumber", "x", st.age_group_id(F.col("x"), 5, 5).alias("g_elt"),
                     st.age_group_id(F.col("x"), 3, 3).alias("g_etl"))


@register("bucket_wait", """
SELECT bucket, count(*) AS n, min(w) AS min_wait FROM (
  SELECT CASE WHEN w = 0 THEN '0 hari (sama hari)' WHEN w <= 7 THEN '1-7 hari' WHEN w <= 30 THEN '8-30 hari'
              WHEN w <= 60 THEN '31-60 hari' ELSE '> 60 hari' END AS bucket, w
  FROM (SELECT abs(epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate)) / CAST(86400000000 AS DOUBLE) AS w
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey))
GROUP BY bucket""")
def q_bucket_wait(spark, sf):
    """Waiting-time buckets grouped by their label."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    w = X.wait_days(F.col("o_orderdate").cast("timestamp"), F.col("l_shipdate").cast("timestamp"), None)
    j = li.join(o, li.l_orderkey == o.o_orderkey).select(w.alias("w"))
    return j.groupBy(X.wait_bucket("w").alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("min_wait"))


@register("decode_labels", """
SELECT CASE dayofweek(l_shipdate) WHEN 0 THEN 'Minggu' WHEN 1 THEN 'Senin' WHEN 2 THEN 'Selasa' WHEN 3 THEN 'Rabu'
            WHEN 4 THEN 'Kamis' WHEN 5 THEN 'Jumat' WHEN 6 THEN 'Sabtu' ELSE 'Unknown' END AS hari,
       CASE CASE l_linestatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 END WHEN 0 THEN 'Laki-laki' WHEN 1 THEN 'Perempuan'
            ELSE 'Lainnya' END AS gender,
       CASE WHEN dayofweek(l_shipdate) IN (0, 6) THEN 'Akhir Pekan' ELSE 'Hari Kerja' END AS jenis_hari,
       count(*) AS n
FROM lineitem GROUP BY ALL""")
def q_decode_labels(spark, sf):
    """Code -> label decodes, grouped by label."""
    li = _t(spark, sf, "lineitem")
    dow = X.day_of_week("l_shipdate", "sunday")
    g = F.when(F.col("l_linestatus") == "O", 0).when(F.col("l_linestatus") == "F", 1)
    return (li.groupBy(X.weekday_name(dow).alias("hari"), X.gender_name(g).alias("gender"),
                       X.day_type_name(X.weekend_flag(dow)).alias("jenis_hari"))
              .agg(F.count(F.lit(1)).alias("n")))


@register("yesno_columns", f"""
SELECT {", ".join(f'coalesce(bool_and(coalesce(lower("{c}") IN (\'yes\', \'no\'), false)), true) AS "{c}"'
                  for c in ["Disease", "Fever", "Cough", "Fatigue", "Difficulty Breathing", "Gender", "Blood Pressure",
                            "Cholesterol Level", "Outcome Variable"])}
FROM ({PROFILES_SQL})""")
def q_yesno_columns(spark, sf):
    """Per text column, whether every value is yes/no."""
    return C.yes_no_flags(disease_profiles(spark, sf))


@register("profile_columns", """
SELECT * FROM (VALUES (0, 'c_custkey', 'bigint'), (1, 'c_name', 'string'), (2, 'c_nationkey', 'int'),
                      (3, 'c_acctbal', 'double'), (4, 'c_mktsegment', 'string')) t(cid, name, type)
CROSS JOIN (SELECT count(*) AS rows FROM customer)
JOIN (SELECT 0 AS cid, count(*) - count(c_custkey) AS nulls FROM customer
      UNION ALL SELECT 1, count(*) - count(c_name) FROM customer
      UNION ALL SELECT 2, count(*) - count(c_nationkey) FROM customer
      UNION ALL SELECT 3, count(*) - count(c_acctbal) FROM customer
      UNION ALL SELECT 4, count(*) - count(c_mktsegment) FROM customer) n USING (cid)""")
def q_profile_columns(spark, sf):
    """Column, type, rows and NULLs from one aggregate pass."""
    return audit.profile(_t(spark, sf, "customer")).drop("approx_distinct")


@register("code_lookup_default", """
SELECT o_orderkey, coalesce(d.id, 9) AS status_id
FROM orders LEFT JOIN (VALUES ('F', 1), ('O', 2)) d(code, id) ON o_orderstatus = d.code""")
def q_code_lookup_default(spark, sf):
    """Key lookup with a default for missing codes."""
    dim = spark.createDataFrame([("F", 1), ("O", 2)], "code string, id int")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return st.code_lookup(o, dim, "o_orderstatus", "code", "id", "status_id", default=9,
                          small_dim=True).drop("o_orderstatus")


BANDS = [(1, -1000, 0), (2, 0.01, 2500), (3, 2500.01, 5000), (4, 5000.01, 10000)]


@register("range_lookup", f"""
SELECT c_custkey, CAST(CASE WHEN v IS NULL THEN 0 WHEN v BETWEEN -1000 AND 0 THEN 1 WHEN v BETWEEN 0.01 AND 2500 THEN 2
                           WHEN v BETWEEN 2500.01 AND 5000 THEN 3 WHEN v BETWEEN 5000.01 AND 10000 THEN 4 ELSE 9 END
                      AS INTEGER) AS band
FROM (SELECT c_custkey, {CUST_V} AS v FROM customer)""")
def q_range_lookup(spark, sf):
    """Theta lookup into ordered ranges, gaps -> default, NULL -> own value."""
    return _cust_v(spark, sf).select("c_custkey", X.bucket_by_ranges("v", BANDS, default=9, null_value=0).alias("band"))


@register("const_join", """
SELECT o_orderkey, d.source_id FROM orders JOIN (VALUES (1, 'no_show'), (2, 'disease')) d(source_id, source_name)
  ON d.source_name = 'no_show'""")
def q_const_join(spark, sf):
    """Every row joined to the one dimension row a constant picks."""
    o = _t(spark, sf, "orders").select("o_orderkey")
    return st.const_join(o, st.dim_source(spark), "source_name", "no_show", ["source_id"])


@register("anti_join_orphans", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def q_anti_join_orphans(spark, sf):
    """NOT IN subquery (null-aware anti join)."""
    good = _t(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return quality.orphans(o, good, "o_custkey", "c_custkey")


@register("outcome_mapping", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linestatus = 'O' THEN (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 2 END)
            ELSE (CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END) END AS outcome_id,
       CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS outcome_id_flag
FROM lineitem""")
def q_outcome_mapping(spark, sf):
    """Source-aware and one-mapping outcome ids."""
    li = _t(spark, sf, "lineitem")
    flag = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    src = F.when(F.col("l_linestatus") == "O", "no_show").otherwise("disease")
    return li.select("l_orderkey", "l_linenumber", st.outcome_id(flag, src).alias("outcome_id"),
                     st.outcome_id(flag, src, mode="flag").alias("outcome_id_flag"))


@register("relative_frequency", """
SELECT l_returnflag, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 4) AS share
FROM lineitem GROUP BY l_returnflag""")
def q_relative_frequency(spark, sf):
    """Normalised value counts, 4 digits."""
    return quality.relative_frequency(_t(spark, sf, "lineitem"), "l_returnflag")


@register("share_of_total", """
SELECT o_orderpriority, count(*) AS total,
       round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM orders), 2) AS persen
FROM orders GROUP BY o_orderpriority""")
def q_share_of_total(spark, sf):
    """Group count as a percentage of a scalar total."""
    o = _t(spark, sf, "orders")
    total = o.agg(F.count(F.lit(1)).alias("__all"))
    per = o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("total"))
    return (per.crossJoin(F.broadcast(total))
               .withColumn("persen", F.round(F.col("total") * F.lit(100.0) / F.col("__all"), 2)).drop("__all"))


@register("dense_ids", """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rid, o_orderkey FROM orders""")
def q_dense_ids(spark, sf):
    """Dense ids over a total order without a single-task window."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return cf.dense_ids(o, ["o_orderdate", "o_orderkey"], "rid").select("rid", "o_orderkey")


@register("renumber_dense", """
SELECT row_number() OVER (ORDER BY o_orderkey) AS rid, o_orderkey FROM orders WHERE o_orderstatus != 'P'""")
def q_renumber_dense(spark, sf):
    """W3 after removals: unique integers with gaps -> 1..n, same order."""
    o = _t(spark, sf, "orders").filter(F.col("o_orderstatus") != "P").select("o_orderkey")
    return cf.renumber_dense(o, "o_orderkey", "rid", bucket_rows=4096).select("rid", "o_orderkey")


@register("stage_audit", """
SELECT 'lineitem' AS stage, count(*) AS rows, 11 AS cols FROM lineitem
UNION ALL SELECT 'unique_lines', count(*), 8 FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
UNION ALL SELECT 'orders', count(*), 6 FROM orders""")
def q_stage_audit(spark, sf):
    """Rows and columns per stage, counted on the executors."""
    li = _t(spark, sf, "lineitem")
    uniq = clean.dedupe_keep_first(li.select(*LI_COLS), ["l_orderkey", "l_linenumber"])
    return audit.stage_counts([("lineitem", li), ("unique_lines", uniq), ("orders", _t(spark, sf, "orders"))])


@register("before_after", """
SELECT 'dedupe' AS stage, (SELECT count(*) FROM lineitem) AS before,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS after,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS removed""")
def q_before_after(spark, sf):
    """Before / after / removed around a stage."""
    li = _t(spark, sf, "lineitem")
    return audit.before_after("dedupe", li, clean.dedupe_keep_first(li.select(*LI_COLS), ["l_orderkey", "l_linenumber"]))


@register("column_resolve", f"""
SELECT "AppointmentID" AS appointment_id, "Gender" AS gender, "Age" AS age, "No-show" AS no_show,
       "Neighbourhood" AS neighbourhood
FROM ({APPOINTMENTS_SQL})""")
def q_column_resolve(spark, sf):
    """Normalised names, substring resolution, projection."""
    df = C.normalize_names(appointments(spark, sf))
    cols = df.columns
    pick = {
        "appointment_id": C.resolve(cols, ("appointment", "id")),
        "gender": C.resolve(cols, "gender"),
        "age": C.resolve(cols, "age", exact=True),
        "no_show": C.resolve(cols, ("no", "show")),
        "neighbourhood": C.columns_of_kind(df, "text")[1],
    }
    return df.select(*[F.col(f"`{v}`").alias(k) for k, v in pick.items()])


@register("seed_dimension", """
WITH segs AS (SELECT DISTINCT c_mktsegment AS seg FROM customer),
ex AS (SELECT CAST(row_number() OVER (ORDER BY seg) AS INTEGER) AS seg_id, seg FROM segs WHERE seg < 'G'),
allr AS (SELECT CAST(row_number() OVER (ORDER BY seg) AS INTEGER) AS seg_id, seg FROM segs),
nw AS (SELECT CAST((SELECT coalesce(max(seg_id), 0) FROM ex) + row_number() OVER (ORDER BY seg_id) AS INTEGER) AS seg_id, seg
       FROM allr WHERE seg NOT IN (SELECT seg FROM ex))
SELECT seg_id, seg FROM ex UNION ALL SELECT seg_id, seg FROM nw""")
def q_seed_dimension(spark, sf):
    """Insert-if-absent by unique name with auto-increment ids, twice
    (the second run inserts nothing)."""
    from pyspark.sql import Window
    segs = _t(spark, sf, "customer").select(F.col("c_mktsegment").alias("seg")).distinct()
    numbered = segs.select(F.row_number().over(Window.orderBy("seg")).cast("int").alias("seg_id"), "seg")
    base = P.scratch_base(spark, f"seed-{uuid.uuid4().hex}")
    existing = numbered.filter(F.col("seg") < "G").select(
        F.row_number().over(Window.orderBy("seg")).cast("int").alias("seg_id"), "seg")
    files.write_table(existing, base, "dim_segment")
    files.seed_dimension(spark, base, "dim_segment", numbered, "seg", "seg_id")
    return files.seed_dimension(spark, base, "dim_segment", numbered, "seg", "seg_id")


@register("landing_roundtrip", f"""
SELECT *, CASE "Age" % 6 WHEN 0 THEN 'say "hi", you' WHEN 1 THEN 'two' || chr(10) || 'lines' WHEN 2 THEN '' WHEN 4 THEN ' blanks ' WHEN 5 THEN 'a,b\\' END AS "Note"
FROM ({PROFILES_SQL})""")
def q_landing_roundtrip(spark, sf):
    """Land the profile view as CSV with a header,
    read it back with the schema; texts with quotes, commas, line ends,
    blanks, empty and NULL ones stay apart."""
    kind = F.col("Age") % 6
    note = (F.when(kind == 0, 'say "hi", you').when(kind == 1, "two\nlines").when(kind == 2, "")
             .when(kind == 4, " blanks ").when(kind == 5, "a,b\\"))
    base = P.scratch_base(spark, f"landing-{uuid.uuid4().hex}")
    return files.land(disease_profiles(spark, sf).withColumn("Note", note), base, "raw_disease", fmt="csv")


EXPORT_ORDER = [
    ("kpi_summary", "q10_kpi_summary"), ("q1_total_per_sumber", "q1_source_totals"),
    ("q2_distribusi_outcome", "q2_outcome_share"), ("q3_usia_per_outcome", "q3_age_by_outcome"),
    ("q4_distribusi_usia", "q4_age_groups"), ("q5_noshow_per_bulan", "q5_monthly_rate"),
    ("q6_comorbidity_per_usia", "q6_comorbidity_by_age"), ("q7_noshow_weekend", "q7_weekend_rate"),
    ("q8_top_penyakit", "q8_top15"), ("extra_wait_outcome", "q9_wait_by_outcome"),
    ("extra_noshow_per_hari", "q11_weekday_rate"), ("extra_wait_days_distribusi", "q12_wait_bucket_rate"),
    ("extra_gender_noshow", "q13_gender_rate"),
]


@register("export_roundtrip", O.with_(O.ELT_FACT, "\nUNION ALL\n".join(
    f"SELECT '{n}' AS name, 'ok' AS status, (SELECT count(*) FROM ({REPORT_SQL[k]})) AS rows, "
    f"CAST(NULL AS VARCHAR) AS error" for n, k in EXPORT_ORDER)))
def q_export_roundtrip(spark, sf):
    """Export the report set (one CSV each, error isolation),
    return the status table."""
    base = P.scratch_base(spark, f"marts-{uuid.uuid4().hex}")
    return P.write_reports(elt_star(spark, sf), base, pipeline="ELT")
