"""Registered queries of the stored tables and of the operators on them:
appends, named stages, the flows' audit, quarantine, range tables, file
order."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from healthmart.operators import quarantine as qr
from healthmart.operators import ranges, sketches
from healthmart.plans import oracle_sql as O
from healthmart.plans import pipelines as P
from healthmart.plans import reports as R
from healthmart.plans.checks import EXPORT_ORDER, _t, elt_star, register
from healthmart.plans.report_sql import REPORT_SQL, STAR_ROLLUP
from healthmart.sources import files, inferred, versions
from healthmart.sources.tables import APPOINTMENTS_SQL, PROFILES_SQL, appointments, disease_profiles


FILE_ROWS = 500_000  # rows of a file that one task sorts and writes


def _base(spark, name: str) -> str:
    return P.scratch_base(spark, f"{name}-{uuid.uuid4().hex}")


def _in_files(df, order: list[str]):
    """``df`` dealt to files in ``order``: three, and more as it grows."""
    return df.repartitionByRange(max(3, -(-df.count() // FILE_ROWS)), *order).sortWithinPartitions(*order)


# -- S10 S9 X17: batches ---------------------------------------------------------

@register("append_batches", O.with_(O.ELT_FACT_IDS, "SELECT * FROM fact_ids"))
def q_append_batches(spark, sf):
    """The sources loaded as two batches, the second one twice: the
    stored fact is that of one load, ids included."""
    base = _base(spark, "append")
    ns, ds = appointments(spark, sf), disease_profiles(spark, sf)
    P.run_elt(ns, ds.limit(0), P.Options(), base=base, batch="appointments")
    for _ in range(2):
        star = P.run_elt(ns.limit(0), ds, P.Options(), base=base, batch="profiles").star
    return star.fact


@register("append_state", f"""
WITH early AS (SELECT count(*) AS n FROM orders WHERE o_orderpriority < '3'), late AS (SELECT count(*) AS n FROM orders WHERE o_orderpriority >= '3')
SELECT 'high' AS batch, early.n AS rows, CAST(1 AS BIGINT) AS first_id, early.n AS last_id FROM early
UNION ALL SELECT 'low', late.n, early.n + 1, early.n + late.n FROM early, late""")
def q_append_state(spark, sf):
    """Rows and id range of every batch, as stored with the rows, after
    the batches were loaded high, low, high."""
    from healthmart.operators.conform import dense_ids
    base = _base(spark, "append-state")
    o = _t(spark, sf, "orders")
    of = {"high": o.where("o_orderpriority < '3'"), "low": o.where("o_orderpriority >= '3'")}
    for batch in ("high", "low", "high"):
        versions.append_batch(of[batch].select("o_orderkey", "o_orderdate"), base, "orders", batch, id_col="id",
                              number=lambda df, start: dense_ids(df, ["o_orderdate", "o_orderkey"], "id", start=start))
    parts = [versions.read_version(spark, base, "orders", batches=[b]).select(F.lit(b).alias("batch"), "id") for b in of]
    return parts[0].unionByName(parts[1]).groupBy("batch").agg(
        F.count(F.lit(1)).alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


# -- S7: tables stored by name ------------------------------------------------------

def _stored(name: str):
    def run(spark, sf):
        base = _base(spark, "stored")
        P.run_elt(appointments(spark, sf), disease_profiles(spark, sf), P.Options(), base=base)
        return files.read_table(spark, f"{base}/warehouse", name)
    run.__doc__ = f"S7: {name} as the SQL flow stored it in the warehouse, read back."
    return run


for _name, _ctes, _rel in (("clean_no_show", O.ELT_CLEAN, "clean_ns"), ("clean_disease", O.ELT_CLEAN, "clean_ds"),
                           ("enriched_no_show", O.ELT_ENRICH, "enr_ns"), ("enriched_disease", O.ELT_ENRICH, "enr_ds")):
    register(f"stored_{_name}", O.with_(_ctes, f"SELECT * FROM {_rel}"))(_stored(_name))


# -- S15 S16 S17 A26 U3: audit ---------------------------------------------------------

def _audit(spark, sf, flow):
    base = _base(spark, "audit")
    flow(appointments(spark, sf), disease_profiles(spark, sf), P.Options(), base=base)
    log = files.read_table(spark, base, "audit")
    return log.where("rows is not null").select("stage", "rows", *[F.col(c).cast("double").alias(c) for c in ("before", "after", "removed")])


def _audit_sql(counts: str, stages: list[tuple[str, str, str | None]]) -> str:
    return counts + "\nUNION ALL\n".join(
        f"SELECT '{stage}' AS stage, {rows} AS rows, CAST({before or 'NULL'} AS DOUBLE) AS before, "
        f"CAST({rows if before else 'NULL'} AS DOUBLE) AS after, CAST({f'({before}) - {rows}' if before else 'NULL'} AS DOUBLE) AS removed FROM n"
        for stage, rows, before in stages)


@register("elt_audit", O.with_(O.ELT_FACT, _audit_sql(f"""
SELECT * FROM (WITH n AS (SELECT (SELECT count(*) FROM ({APPOINTMENTS_SQL})) AS ns, (SELECT count(*) FROM ({PROFILES_SQL})) AS ds,
  (SELECT count(*) FROM clean_ns) AS cns, (SELECT count(*) FROM clean_ds) AS cds, (SELECT count(*) FROM fact) AS f)
""", [("extract_no_show", "ns", None), ("extract_disease", "ds", None), ("clean_no_show", "cns", "ns"), ("clean_disease", "cds", "ds"),
      ("enrich_no_show", "cns", None), ("enrich_disease", "cds", None), ("load_fact", "f", None)]) + ")"))
def q_elt_audit(spark, sf):
    """What the SQL flow's writes observed, as stored."""
    return _audit(spark, sf, P.run_elt)


@register("etl_audit", O.with_(O.ETL_FACT, _audit_sql(f"""
SELECT * FROM (WITH n AS (SELECT (SELECT count(*) FROM ({APPOINTMENTS_SQL})) AS ns, (SELECT count(*) FROM ({PROFILES_SQL})) AS ds,
  (SELECT count(DISTINCT "AppointmentID") FROM ({APPOINTMENTS_SQL})) AS dns, (SELECT count(*) FROM (SELECT DISTINCT * FROM ({PROFILES_SQL}))) AS dds,
  (SELECT count(*) FROM conformed WHERE source = 'no_show') AS cns, (SELECT count(*) FROM conformed WHERE source = 'disease') AS cds,
  (SELECT count(*) FROM fact) AS f)
""", [("extract_no_show", "ns", None), ("extract_disease", "ds", None), ("dedupe_no_show", "dns", "ns"), ("dedupe_disease", "dds", "ds"),
      ("clean_no_show", "cns", "dns"), ("clean_disease", "cds", "dds"), ("validate", "f", "cns + cds"), ("load_fact", "f", None)]) + ")"))
def q_etl_audit(spark, sf):
    """What the transform-first flow's writes observed."""
    return _audit(spark, sf, P.run_etl)


# -- V1-V5: quarantine -----------------------------------------------------------------

FAULTY_SQL = """
SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey * 8 + l_linenumber END AS id, l_quantity * 3 - 10 AS age,
       CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN 'F?' WHEN l_linestatus = 'F' THEN NULL ELSE CAST(l_linenumber % 2 AS VARCHAR) END AS gender,
       CASE WHEN l_discount > 0.09 THEN 'web' WHEN l_discount < 0.01 THEN NULL WHEN l_tax > 0.04 THEN 'disease' ELSE 'no_show' END AS source
FROM lineitem"""


def faulty(spark, sf):
    li = _t(spark, sf, "lineitem")
    line, disc = F.col("l_linenumber"), F.col("l_discount")
    return li.select(
        F.when(line == 7, None).otherwise(F.col("l_orderkey") * 8 + line).alias("id"), (F.col("l_quantity") * 3 - 10).alias("age"),
        F.when((F.col("l_returnflag") == "A") & (line == 2), "F?").when(F.col("l_linestatus") == "F", None)
         .otherwise((line % 2).cast("string")).alias("gender"),
        F.when(disc > 0.09, "web").when(disc < 0.01, None).when(F.col("l_tax") > 0.04, "disease").otherwise("no_show").alias("source"))


RULES = qr.Rules(key="id", order_by=("age",), ranges={"age": (0, 120)}, codes={"gender": ("int", -1)}, sources={"source": ("no_show", "disease")})

_JUDGED_SQL = f"""
WITH rows AS ({FAULTY_SQL}),
same AS (SELECT id, age, gender, source, count(*) AS n FROM rows GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY age, gender NULLS FIRST, source NULLS FIRST) AS place FROM same),
each AS (
  SELECT *, FALSE AS copy, CASE WHEN id IS NULL THEN n ELSE 1 END AS times FROM ranked
  UNION ALL SELECT *, TRUE, n - 1 FROM ranked WHERE id IS NOT NULL AND n > 1),
judged AS (
  SELECT id, age, coalesce(TRY_CAST(gender AS INTEGER), -1) AS gender, source, times,
         id IS NOT NULL AND (place > 1 OR copy) AS v1, id IS NULL AS v2, age NOT BETWEEN 0 AND 120 AS v3,
         gender IS NOT NULL AND TRY_CAST(gender AS INTEGER) IS NULL AS v4, source IS NULL OR source NOT IN ('no_show', 'disease') AS v5 FROM each)
"""


@register("quarantine_rejected", _JUDGED_SQL + """
SELECT CAST(id AS VARCHAR) AS id, age, gender, source, times, CAST(v1::INT + 2 * v2::INT + 4 * v3::INT + 8 * v4::INT + 16 * v5::INT AS INTEGER) AS broken,
       concat_ws('; ', CASE WHEN v1 THEN 'V1 duplicate key' END, CASE WHEN v2 THEN 'V2 missing value' END, CASE WHEN v3 THEN 'V3 out of range' END,
                 CASE WHEN v4 THEN 'V4 not coercible' END, CASE WHEN v5 THEN 'V5 unknown source' END) AS reasons
FROM judged WHERE v1 OR v2 OR v3 OR v5""")
def q_quarantine_rejected(spark, sf):
    """V1-V5 V8: rejected rows with the mask and names of what they break."""
    _, rejected, _ = qr.quarantine(faulty(spark, sf), RULES, _base(spark, "quarantine"), "judged")
    return rejected.withColumns({"id": F.col("id").cast("string"), "reasons": F.array_join("reasons", "; ")})


@register("quarantine_kept", _JUDGED_SQL + "SELECT id, age, gender, source FROM judged WHERE NOT (v1 OR v2 OR v3 OR v5)")
def q_quarantine_kept(spark, sf):
    """Rows that pass, codes repaired (V4)."""
    return qr.quarantine(faulty(spark, sf), RULES, _base(spark, "quarantine"), "judged")[0]


@register("quarantine_counts", _JUDGED_SQL + "\nUNION ALL\n".join(
    f"SELECT 'V{i}' AS rule, CAST(sum(times) FILTER (v{i}) AS BIGINT) AS rows FROM judged" for i in range(1, 6)))
def q_quarantine_counts(spark, sf):
    """V1-V5: rows that break each rule, counted by the write itself; none is 0."""
    _, _, counts = qr.quarantine(faulty(spark, sf), RULES, _base(spark, "quarantine"), "judged")
    return spark.createDataFrame(list(counts.items()), "rule string, rows long")


# -- J6 O7: range table ------------------------------------------------------------------

@register("range_table_lookup", """
WITH band AS (
  SELECT o_orderkey AS band, o_totalprice AS lo,
         o_totalprice + (o_orderkey % 97) / 2 + CASE WHEN o_orderkey % 1000 = 0 THEN 20000 ELSE 0 END AS hi FROM orders),
line AS (SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER () AS r FROM lineitem),
best AS (SELECT r, arg_min(band, row(lo, hi, band)) AS band FROM line JOIN band ON l_extendedprice BETWEEN lo AND hi GROUP BY r)
SELECT l_orderkey, l_linenumber, l_extendedprice, coalesce(band, -1) AS band FROM line LEFT JOIN best USING (r)""")
def q_range_table_lookup(spark, sf):
    """Every line's price in a table of overlapping price ranges, one
    an order: the first that holds it, else -1."""
    key = F.col("o_orderkey")
    band = _t(spark, sf, "orders").select(
        key.alias("band"), F.col("o_totalprice").alias("lo"),
        (F.col("o_totalprice") + (key % 97) / 2 + F.when(key % 1000 == 0, 20000).otherwise(0)).alias("hi"))
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ranges.range_lookup(li, "l_extendedprice", band, "lo", "hi", ["band"], default={"band": -1})


# -- W2 S1: file order -----------------------------------------------------------------------

@register("file_order_ids", """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                   l_returnflag, l_linestatus, l_shipdate) AS id, l_orderkey, l_linenumber, l_extendedprice
FROM lineitem""")
def q_file_order_ids(spark, sf):
    """Ids in the order of the lines of several CSV files, read in
    several splits, without a shuffle of rows."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]
    li = _t(spark, sf, "lineitem").select(*order)
    base = _base(spark, "file-order")
    path = files.write_csv(_in_files(li, order), base, "lines")
    back = spark.read.option("header", True).schema(li.schema).csv(path)
    return files.with_file_ids(back, "id").select("id", "l_orderkey", "l_linenumber", "l_extendedprice")


# -- S1: inferred types, rescued values ------------------------------------------------------

ORDER_TEXT = """
SELECT row_number() OVER (ORDER BY o_orderkey) AS id, CAST(o_orderkey AS VARCHAR) AS k,
       CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS cust,
       CASE WHEN o_orderkey % 90 = 1 THEN 'free, "gratis"' ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END AS price,
       CASE WHEN o_orderkey % 110 = 5 THEN '1995-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
       CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS done, o_orderpriority AS priority FROM orders"""


def order_text(spark, sf):
    o, k = _t(spark, sf, "orders"), F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("k"), F.when(k % 50 == 0, "n/a").when(k % 7 == 0, None).otherwise(F.col("o_custkey").cast("string")).alias("cust"),
        F.when(k % 90 == 1, 'free, "gratis"').otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(k % 110 == 5, "1995-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("done"), F.col("o_orderpriority").alias("priority"))


def _inferred(spark, sf):
    """The order texts as CSV files in key order, read back with inferred types."""
    rows = order_text(spark, sf).withColumn("__k", F.col("k").cast("long"))
    rows = _in_files(rows, ["__k"]).drop("__k")
    return inferred.read_inferred(spark, files.write_csv(rows, _base(spark, "inferred"), "orders", null_text=""), tolerance=0.05)


@register("inferred_scan", f"""
SELECT CAST(k AS BIGINT) AS k, TRY_CAST(cust AS BIGINT) AS cust, TRY_CAST(price AS DOUBLE) AS price,
       CAST(TRY_CAST(day AS DATE) AS VARCHAR) AS day, CAST(done AS BOOLEAN) AS done, priority FROM ({ORDER_TEXT}) WHERE cust IS NOT NULL AND cust <> 'n/a'""")
def q_inferred_scan(spark, sf):
    """Types found in the data, a few values of a column notwithstanding."""
    return (_inferred(spark, sf).where("cust is not null")
            .select("k", "cust", "price", F.col("day").cast("string").alias("day"), "done", "priority"))


@register("rescued_values", f"""
SELECT k, column_name, value FROM (
  SELECT CAST(k AS BIGINT) AS k, 'cust' AS column_name, cust AS value FROM ({ORDER_TEXT}) WHERE cust IS NOT NULL AND TRY_CAST(cust AS BIGINT) IS NULL
  UNION ALL SELECT CAST(k AS BIGINT), 'price', price FROM ({ORDER_TEXT}) WHERE TRY_CAST(price AS DOUBLE) IS NULL
  UNION ALL SELECT CAST(k AS BIGINT), 'day', day FROM ({ORDER_TEXT}) WHERE TRY_CAST(day AS DATE) IS NULL)""")
def q_rescued_values(spark, sf):
    """What did not fit the inferred types."""
    return (_inferred(spark, sf).where("_rescued is not null")
            .select("k", F.explode("_rescued.fields").alias("column_name", "value")))


@register("rescued_places", f"""
SELECT count(*) AS rows, count(DISTINCT id) AS places, CAST(sum(id) AS BIGINT) AS place_sum FROM ({ORDER_TEXT})
WHERE (cust IS NOT NULL AND TRY_CAST(cust AS BIGINT) IS NULL) OR TRY_CAST(price AS DOUBLE) IS NULL OR TRY_CAST(day AS DATE) IS NULL""")
def q_rescued_places(spark, sf):
    """Files and rows of what was rescued: the files before a row's own
    and its number there add up to its place in key order."""
    df = _inferred(spark, sf)
    size = files.with_place(spark.read.option("header", True).csv(df.inputFiles()), "at").groupBy("at.file").agg(F.max("at.row").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    before = size.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = df.where("_rescued is not null").select("_rescued.file", "_rescued.row").join(before, "file").select(
        (F.col("row") + F.col("before")).alias("place"))
    return place.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("place").alias("places"), F.sum("place").alias("place_sum"))


# -- S18 A20: profile that merges --------------------------------------------------------------

PROFILED = ("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")


@register("merged_profile", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, {f"min({c})::DOUBLE" if number else "0::DOUBLE"} AS least,
        {f"max({c})::DOUBLE" if number else "0::DOUBLE"} AS greatest, TRUE AS distinct_close, TRUE AS quartiles_close, TRUE AS frequent_close FROM lineitem"""
    for c, number in zip(PROFILED, (1, 1, 1, 0, 0))))
def q_merged_profile(spark, sf):
    """Profile of three batches, one of them loaded twice, against
    exact figures of the whole: distinct values within 5 %, quartiles within
    2 % of the rows, the most frequent value's count within its bound."""
    li = _t(spark, sf, "lineitem").select(*PROFILED)
    base = _base(spark, "profile")
    for flag in ("A", "N", "N", "R"):
        profile = sketches.keep_profile(li.where(F.col("l_returnflag") == flag), base, "profile", flag)
    shown = sketches.shown(profile, top=1)
    exact = [li.agg(F.lit(c).alias("__c"), F.count_distinct(c).alias("nd"), F.count(F.lit(1)).alias("n")) for c in PROFILED]
    most = [li.groupBy(F.col(c).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("times")).agg(
        F.lit(c).alias("__m"), F.max("times").alias("most")) for c in PROFILED]
    truth = exact[0]
    for e in exact[1:]:
        truth = truth.unionByName(e)
    top = most[0]
    for m in most[1:]:
        top = top.unionByName(m)
    numbers = PROFILED[:3]
    q = shown.where(F.col("column").isin(*numbers)).select(F.col("column").alias("__q"), F.posexplode("quantiles").alias("i", "x"))
    tall = li.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in numbers])).alias("r")).select("r.*")
    rank = (tall.join(F.broadcast(q), F.col("c") == F.col("__q")).groupBy("__q", "i")
            .agg(F.avg((F.col("v") < F.col("x")).cast("double")).alias("below"), F.avg((F.col("v") <= F.col("x")).cast("double")).alias("upto"))
            .withColumn("p", (F.col("i") + 1) * 0.25).groupBy("__q").agg(F.every((F.col("below") <= F.col("p") + 0.02) & (F.col("upto") >= F.col("p") - 0.02)).alias("ok")))
    out = (shown.join(truth, F.col("column") == F.col("__c")).join(top, F.col("column") == F.col("__m"))
                .join(rank, F.col("column") == F.col("__q"), "left"))
    slack = F.col("n") / (0.75 * sketches.TRACKED)
    return out.select("column", "rows", "nulls", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("least", "greatest")],
                      (F.abs(F.col("n_distinct") - F.col("nd")) <= 0.05 * F.col("nd")).alias("distinct_close"),
                      F.coalesce("ok", F.lit(True)).alias("quartiles_close"),
                      F.coalesce(F.abs(F.get("frequent", F.lit(0))["count"] - F.col("most")) <= slack, F.col("most") <= slack).alias("frequent_close"))


# -- J1-J3 O4 O5: a summary that is kept up ------------------------------------------------------

def _kept(report):
    def run(spark, sf):
        base = _base(spark, "kept")
        ns, ds = appointments(spark, sf), disease_profiles(spark, sf)
        star = P.run_elt(ns, ds.limit(0), P.Options(), base=base, batch="appointments").star
        P.with_summary(star, base, "appointments")
        for _ in range(2):
            star = P.run_elt(ns.limit(0), ds, P.Options(), base=base, batch="profiles").star
            star = P.with_summary(star, base, "profiles")
        return report(star)
    run.__doc__ = "J1-J3 S10: a report over the summary kept up through appends, one of them repeated."
    return run


register("kept_star_rollup", O.with_(O.ELT_FACT, STAR_ROLLUP))(_kept(R.star_rollup))
register("kept_top_diseases", O.with_(O.ELT_FACT, REPORT_SQL["q8_top15"]))(_kept(lambda s: R.q8_top_diseases(s, 15)))


# -- S12: exported values ------------------------------------------------------------------------

def _exported(name: str):
    def run(spark, sf):
        base = _base(spark, "marts")
        thunk = R.dashboard(elt_star(spark, sf))[name]
        files.export_reports({name: thunk}, base, spark=spark)
        return files.read_csv(spark, f"{base}/{name}", schema=thunk().schema)
    run.__doc__ = f"S12: the values of {name} as exported, read back from its CSV."
    return run


for _name, _key in EXPORT_ORDER:
    register(f"exported_{_name}", O.with_(O.ELT_FACT, REPORT_SQL[_key]))(_exported(_name))
