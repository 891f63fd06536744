"""Operators on hand-made rows: duplicates, NULLs, ties, empty input,
dense ids, quality rules."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from healthmart import schemas
from healthmart.operators import clean, conform as cf, quality, scale, star as st
from healthmart.plans import reports as R
from healthmart.sources import files


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else [tuple(r) for r in df.collect()]


def _first_by_window(df, keys, order_by):
    """Keep-first as SQL writes it, every key's rows in one task."""
    w = Window.partitionBy(*keys).orderBy(*order_by, *[c for c in df.columns if c not in (*keys, *order_by)])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def _numbered_in_one_task(df, order_by, id_col):
    """ROW_NUMBER() OVER (ORDER BY ...), as SQL writes it."""
    return df.withColumn(id_col, F.row_number().over(Window.orderBy(*order_by)).cast("long"))


def test_keep_first_by_order_column(spark):
    df = spark.createDataFrame([(1, 40.0, 2), (1, 30.0, 1), (2, 50.0, 1), (None, 9.0, 1), (None, 8.0, 2)],
                               "id long, age double, seq int")
    out = clean.dedupe_keep_first(df, ["id"], ["seq"])
    assert rows(out, "id") == [(None, 9.0, 1), (1, 30.0, 1), (2, 50.0, 1)]
    # idempotent and equal to the row_number form
    assert rows(clean.dedupe_keep_first(out, ["id"], ["seq"]), "id") == rows(out, "id")
    assert rows(_first_by_window(df, ["id"], ["seq"]), "id") == rows(out, "id")
    assert rows(clean.drop_null(out, ["id"]), "id") == [(1, 30.0, 1), (2, 50.0, 1)]


def test_keep_first_derived_key_and_full_row(spark):
    df = spark.createDataFrame([("Flu", "19", "Female", 1), ("Flu", "19.0", "female", 2), ("Flu", "19", "Female", 1)],
                               "d string, a string, g string, o int")
    full = clean.dedupe_full_row(df)
    assert full.count() == 2
    keyed = clean.dedupe_keep_first(df, ["d", ("ak", F.col("a").cast("double")), ("gk", F.lower("g"))], [])
    assert keyed.count() == 1


def test_duplicate_key_count(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k long")
    assert clean.duplicate_key_count(df, ["k"]).first()[0] == 3


def test_fills(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (3.0, "c"), (10.0, "d")], "x double, t string")
    out = clean.fill_median(clean.fill_text(df), ["x"])
    assert rows(out) == [(1.0, "a"), (3.0, "Unknown"), (3.0, "c"), (10.0, "d")]
    complete = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert clean.fill_median(complete, ["x"], null_counts={"x": 0}) is complete  # nothing to fill, nothing computed


def test_iqr_quartiles_linear(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4]], "x double")
    b = clean.iqr_bounds(df, "x").first()
    assert (b.q1, b.q3) == (1.75, 3.25)
    df2 = spark.createDataFrame([(None if v is None else float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100, None]], "x double")
    assert sorted(r[0] for r in clean.iqr_filter(df2, "x").collect()) == [1, 2, 3, 4, 5, 6, 7, 8]


def test_range_filters(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (115.0,), (120.0,), (121.0,), (None,)], "a double")
    assert clean.range_filter(df, "a", 0, 120).count() == 3
    assert clean.range_filter(df, "a", 0, 120, keep_null=True).count() == 4
    assert df.filter(clean.out_of_range("a", 0, 120)).count() == 2
    assert clean.range_filter(df, "a", lo=0).count() == 4


def test_minmax_constant_column_is_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "a double")
    assert [r[0] for r in scale.minmax_scale(df, "a", "n").select("n").collect()] == [0.0, 0.0]
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "a double")
    vals = [r[0] for r in scale.minmax_scale(df, "a", "n").select("n").collect()]
    assert all(0.0 <= v <= 1.0 for v in vals)


def test_dense_ids_skewed_leading_column(spark):
    # a third of the rows share the leading order value
    data = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(data, "a long, b long")
    out = cf.dense_ids(df, ["a", "b"], "rid", partitions=6)
    ids = [r.rid for r in out.orderBy("a", "b").collect()]
    assert ids == list(range(1, 3001))
    ref = _numbered_in_one_task(df, ["a", "b"], "rid")
    assert rows(out.select("rid", "a", "b"), "rid") == rows(ref.select("rid", "a", "b"), "rid")


def test_renumber_after_removal(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 2001) if i % 7 != 0], "rid long")
    out = cf.renumber_dense(df, "rid", "fid", bucket_rows=100)
    got = rows(out.select("rid", "fid"), "rid")
    assert [f for _, f in got] == list(range(1, len(got) + 1))


def test_quality_rules(spark):
    df = spark.createDataFrame(
        [(1, "no_show", 30.0, 0, 1), (1, "no_show", 31.0, 1, 0), (2, None, 40.0, 0, 0),
         (3, "disease", 121.0, 1, 1), (4, "other", None, 0, 0), (5, "disease", None, 1, 1)],
        "record_id long, source string, age double, gender_code int, outcome_flag int")
    rep = quality.check_conformed(df)
    d = quality.report_dict(rep)
    assert d[("V1", "record_id")] == 1
    assert d[("V2", "source")] == 1 and d[("V2", "age")] == 2
    assert d[("V3", "age")] == 1
    assert d[("V5", "source")] == 2  # NULL and 'other'
    shares = {r.item: r.share for r in rep.filter("rule = 'V6'").collect()}
    assert abs(sum(shares.values()) - 1.0) < 1e-3
    kept = quality.enforce(df, order_by=["age"], report=d)
    assert sorted(r.record_id for r in kept.collect()) == [1, 5]


def test_not_in_null_semantics(spark):
    fact = spark.createDataFrame([(1,), (3,), (None,)], "k long")
    dim = spark.createDataFrame([(1,), (2,)], "k long")
    assert [r.k for r in quality.orphans(fact, dim, "k").collect()] == [3]
    dim_null = spark.createDataFrame([(1,), (None,)], "k long")
    assert quality.orphans(fact, dim_null, "k").count() == 0


def test_empty_input(spark):
    fact = spark.createDataFrame([], "fact_id long, record_id long, source_id int, outcome_id int, "
                                     "age_group_id int, age double, age_norm double, gender_code int, outcome_flag int, "
                                     "comorbidity_count double, wait_days double, appt_month double, "
                                     "appt_day_of_week double, is_weekend double, symptom_count double, "
                                     "has_fever double, has_cough double, bp_encoded double, cholesterol_enc double, "
                                     "disease_name string")
    star = st.Star.with_literal_dims(fact)
    for name, thunk in R.dashboard(star).items():
        out = thunk().collect()
        if name == "kpi_summary":
            assert len(out) == 1 and out[0].total_pasien == 0 and out[0].avg_usia is None
        else:
            assert out == [], name
    assert clean.dedupe_keep_first(fact, ["record_id"]).count() == 0


def test_top_k_ties_by_name_desc(spark):
    facts = [(2, n) for n, k in [("A", 2), ("B", 2), ("C", 2), ("D", 1)] for _ in range(k)] + [(1, "N/A")]
    fact = spark.createDataFrame(facts, "source_id int, disease_name string")
    layout = {f.name: f.dataType for f in schemas.CONFORMED.fields}
    fact = fact.select(*[F.col(c) if c in fact.columns else
                         F.lit(0 if c == "outcome_flag" else None).cast(layout.get(c, "long")).alias(c)
                         for c in schemas.FACT_COLUMNS])
    star = st.Star.with_literal_dims(fact)
    assert [tuple(r) for r in R.q8_top_diseases(star, 2).collect()] == [("C", 2), ("B", 2)]


def test_seed_dimension_idempotent(spark, scratch):
    first = spark.createDataFrame([(1, "b"), (2, "d")], "id int, name string")
    files.write_table(first, scratch, "dim")
    wanted = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    out = rows(files.seed_dimension(spark, scratch, "dim", wanted, "name", "id"), "id")
    assert out == [(1, "b"), (2, "d"), (3, "a"), (4, "c")]
    again = files.seed_dimension(spark, scratch, "dim", wanted, "name", "id")
    assert rows(again, "id") == out


def test_code_lookup_default_and_const_join(spark):
    dim = st.dim_source(spark)
    df = spark.createDataFrame([("no_show",), ("disease",), ("x",)], "source string")
    out = st.code_lookup(df, dim, "source", "source_name", "source_id", "sid", default=1)
    assert sorted(tuple(r) for r in out.collect()) == [("disease", 2), ("no_show", 1), ("x", 1)]
    cj = st.const_join(df, dim, "source_name", "disease", ["source_id"])
    assert {r.source_id for r in cj.collect()} == {2}


def test_relative_frequency_rounding(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "s string")
    got = {r.s: r.share for r in quality.relative_frequency(df, "s").collect()}
    assert got == {"a": 0.6667, "b": 0.3333}


def test_exact_statistics_of_distinct_values(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 1001)] + [(None,)], "x double")
    filled = clean.fill_median(df, ["x"])
    assert sorted(r.x for r in filled.collect())[500] == 500.5
    b = clean.iqr_bounds(df, "x").first()
    assert (b.q1, b.q3) == (250.75, 750.25)
    assert clean.iqr_filter(df, "x").count() == 1000
    none = spark.createDataFrame([(None,)], "x double")
    assert clean.fill_median(none, ["x"]).first().x is None and clean.iqr_filter(none, "x").count() == 0
