"""Both flows on hand-made appointment rows (CSV text form) and profile
rows, including duplicates, NULL keys, bad dates and out-of-range ages."""

import pytest
from pyspark.sql import functions as F

from healthmart import schemas
from healthmart.operators import audit
from healthmart.plans import pipelines as P
from healthmart.plans import reports as R
from healthmart.sources import files

A = [
    # PatientId, AppointmentID, Gender, ScheduledDay, AppointmentDay, Age, Neighbourhood,
    # Scholarship, Hipertension, Diabetes, Alcoholism, Handcap, SMS, No-show
    ("p1", 10, "F", "2016-04-29T18:38:08Z", "2016-04-29T00:00:00Z", 62.0, "A", "0", "1", "0", "0", "0", "0", "No"),
    ("p1", 10, "F", "2016-04-29T18:38:08Z", "2016-04-29T00:00:00Z", 99.0, "A", "0", "1", "0", "0", "0", "0", "No"),
    ("p2", 11, " M ", "2016-04-20T08:00:00Z", "2016-04-30T00:00:00Z", 30.0, "B", "1", "0", "abc", "0", "3", "1", "Yes"),
    ("p3", 12, "f", "2016-04-25T08:00:00Z", "2016-05-01T00:00:00Z", 8.0, None, "0", "0", "0", "0", "0", "0", " yes "),
    ("p4", None, "F", "2016-04-25T08:00:00Z", "2016-05-02T00:00:00Z", 40.0, "C", "0", "0", "0", "0", "0", "0", "No"),
    ("p5", 13, "X", "garbage", "2016-05-02T00:00:00Z", 40.0, "C", "0", "0", "0", "0", "0", "0", "No"),
    ("p6", 14, "M", None, "2016-05-03T00:00:00Z", 40.0, "C", "0", "0", "0", "0", "0", "0", "No"),
    ("p7", 15, "M", "2016-05-01T08:00:00Z", "2016-05-03T00:00:00Z", -1.0, "C", "0", "0", "0", "0", "0", "0", "No"),
    ("p8", 16, None, "2016-05-01T08:00:00Z", "2016-06-03T00:00:00Z", None, "C", "0", "1", "1", "1", "0", "0", "maybe"),
    ("p9", 17, "F", "2016-03-01T08:00:00Z", "2016-06-03T00:00:00Z", 45.0, "C", "0", "0", "1", "0", "0", "0", "Yes"),
    ("p10", 18, "M", "2016-05-31T08:00:00Z", "2016-06-08T00:00:00Z", 17.0, "D", "0", "0", "0", "0", "0", "0", "No"),
]
D = [
    ("Asthma", "Yes", "No", "Yes", "No", 25.0, "Female", "High", "Normal", "Positive"),
    ("Asthma", "Yes", "No", "Yes", "No", 25.0, "Female", "High", "Normal", "Positive"),
    ("Asthma", "No", "No", "No", "No", 25.0, "Female", "Low", "Low", "Negative"),
    ("Flu", "Yes", "Yes", "Yes", "Yes", 70.0, "Male", "Normal", "High", "Negative"),
]


@pytest.fixture(scope="module")
def inputs(spark):
    ns = files.with_row_order(spark.createDataFrame(A, schemas.APPOINTMENTS))
    ds = files.with_row_order(spark.createDataFrame(D, schemas.DISEASE_PROFILES))
    return ns, ds


def test_etl_clean_rules(spark, inputs):
    ns, _ = inputs
    opts = P.Options(order_col="_row", outlier="range")
    out = P.etl_clean_appointments(ns, opts)
    ids = sorted(r.appointmentid for r in out.collect())
    # dup 10 -> first kept; NULL id, 'garbage' and NULL dates, age -1 dropped;
    # NULL age filled with the median and kept
    assert ids == [10, 11, 12, 16, 17, 18]
    first = out.filter("appointmentid = 10").first()
    assert first.age == 62.0
    assert out.filter("appointmentid = 16").first().gender == "Unknown"


def test_etl_flow(spark, inputs, scratch):
    ns, ds = inputs
    res = P.run_etl(ns, ds, P.Options(order_col="_row", outlier="range"), base=scratch)
    fact = res.star.fact
    assert fact.columns == schemas.FACT_COLUMNS
    rows = {r.record_id: r for r in fact.collect()}
    assert sorted(rows) == list(range(1, len(rows) + 1))
    assert [r.fact_id for r in sorted(rows.values(), key=lambda r: r.record_id)] == sorted(rows)
    ns_rows = [r for r in rows.values() if r.source_id == 1]
    same_day = [r for r in ns_rows if r.wait_days is not None and r.wait_days < 1][0]
    assert same_day.wait_days == 0.8 and same_day.outcome_id == 2
    sat = [r for r in ns_rows if r.appt_day_of_week == 6.0][0]
    assert sat.is_weekend == 1.0 and sat.comorbidity_count == 4.0 and sat.outcome_id == 1
    ds_rows = [r for r in rows.values() if r.source_id == 2]
    assert len(ds_rows) == 3 and all(r.disease_name != "N/A" for r in ds_rows)
    assert {r.symptom_count for r in ds_rows} == {0.0, 2.0, 4.0}
    # stored star and exported reports
    status = P.write_reports(res.star, f"{scratch}/marts")
    assert {r.status for r in status.collect()} == {"ok"}
    back = spark.read.option("header", True).csv(f"{scratch}/marts/q1_total_per_sumber")
    assert {r.sumber: int(r.total) for r in back.collect()} == {"no_show": 6, "disease": 3}
    audit_rows = {r.stage: r.rows for r in res.audit().collect()}
    assert audit_rows["extract_no_show"] == 11 and audit_rows["fact"] == 9
    assert res.log.to_frame(spark).count() == len(res.log.records)


def test_elt_flow(spark, inputs, scratch):
    ns, ds = inputs
    res = P.run_elt(ns, ds, P.Options(order_col="_row"), base=scratch)
    fact = res.star.fact
    assert "record_id" not in fact.columns and len(fact.columns) == 19
    got = sorted(r.fact_id for r in fact.collect())
    assert got == list(range(1, len(got) + 1))
    # SQL form: NULL id and -1 / NULL ages out (0..120 filter), dup 10 first kept
    assert fact.filter("source_id = 1").count() == 7  # ids 10-14, 17, 18 (bad dates stay)
    assert fact.filter("source_id = 2").count() == 2  # (disease, age, gender) groups
    w = {r.outcome: r.avg_wait for r in R.q9_wait_by_outcome(res.star).collect()}
    assert set(w) <= {"No-Show / Negative", "Show / Positive"}
    checks = {(r.rule, r.item): r.n for r in res.quality.collect()}
    assert checks[("V1", "rows")] == 9 and checks[("V4", "not in dim_source")] == 0


def test_flows_agree_under_the_same_options(spark, inputs):
    """What both flows derive from the disease rows is the same when the
    options are, and ELT follows every one of them."""
    ns, ds = inputs
    opts = P.Options(order_col="_row", outlier="range", symptoms="detect", outcome_mode="flag", scale_eps=1e-4,
                     age_group_default=2, age_group_null=None, elt_disease_key="full_row")
    shared = ["disease_name", "age", "gender_code", "outcome_flag", "outcome_id", "age_group_id", "symptom_count",
              "has_fever", "has_cough", "bp_encoded", "cholesterol_enc"]
    etl, elt = P.run_etl(ns, ds, opts).star.fact, P.run_elt(ns, ds, opts).star.fact
    got = [sorted(tuple(r) for r in f.where("source_id = 2").select(*shared).collect()) for f in (etl, elt)]
    assert len(got[0]) == 3 and got[0] == got[1]
    both = [{r.wait: (r.outcome_id, r.age_group_id) for r in f.where("source_id = 1 and wait_days is not null and age is not null")
             .selectExpr("round(wait_days, 1) as wait", "outcome_id", "age_group_id").collect()} for f in (etl, elt)]
    same = both[0].keys() & both[1].keys()
    assert same and all(both[0][k] == both[1][k] for k in same)


def test_elt_keeps_its_own_choices(spark, inputs):
    _, ds = inputs
    opts = P.Options(order_col="_row")
    assert P.etl_clean_profiles(ds, opts).count() == 3 and P.elt_clean_profiles(ds, opts).count() == 2
    fence = P.Options(order_col="_row", outlier="iqr", checkpoint=False)
    assert P.elt_clean_appointments(inputs[0], fence).where("age < 0 or age is null").count() == 0


def test_stage_counts_conserve(spark, inputs):
    ns, _ = inputs
    opts = P.Options(order_col="_row", outlier="range", checkpoint=False)
    cleaned = P.etl_clean_appointments(ns, opts)
    ba = audit.before_after("clean", ns, cleaned).first()
    assert ba.before == ba.after + ba.removed and ba.removed == 5
    prof = audit.profile(ns).filter(F.col("name") == "AppointmentID").first()
    assert prof.nulls == 1 and prof.rows == 11


def test_bucket_counts_sum_to_filtered_total(spark, inputs, scratch):
    ns, ds = inputs
    star = P.run_elt(ns, ds, P.Options(order_col="_row")).star
    buckets = sum(r.total for r in R.q12_wait_bucket_rate(star).collect())
    direct = star.fact.filter("source_id = 1 AND wait_days IS NOT NULL").count()
    assert buckets == direct
    months = sum(r.total for r in R.q5_monthly_rate(star).collect())
    assert months == star.fact.filter("source_id = 1 AND appt_month IS NOT NULL").count()


def test_record_ids_follow_input_order(spark, inputs):
    ns, ds = inputs
    res = P.run_etl(ns, ds, P.Options(order_col="_row", outlier="range"))
    ids = [r.record_id for r in res.conformed.filter("source = 'no_show'").orderBy("record_id").collect()]
    ages = [r.age for r in res.conformed.filter("source = 'no_show'").orderBy("record_id").collect()]
    # input order of the kept appointments (ids 10, 11, 12, 16, 17, 18)
    assert ages[:3] == [62.0, 30.0, 8.0] and ids == list(range(1, len(ids) + 1))


@pytest.mark.parametrize("opts", [
    dict(wait="calendar", outcome_mode="flag", symptoms="fever_cough", checkpoint=False),
    dict(outlier="iqr", staging_copy=True, elt_disease_key="full_row", age_group_default=5),
])
def test_option_variants_run(spark, inputs, scratch, opts):
    ns, ds = inputs
    o = P.Options(order_col="_row", **opts)
    etl = P.run_etl(ns, ds, o, base=f"{scratch}/etl")
    elt = P.run_elt(ns, ds, o, base=f"{scratch}/elt")
    for star in (etl.star, elt.star):
        assert star.fact.count() > 0
        assert len(R.q12_wait_bucket_rate(star).collect()) >= 1
    if opts.get("outcome_mode") == "flag":
        flags = {(r.outcome_flag, r.outcome_id) for r in etl.star.fact.collect()}
        assert flags <= {(1, 2), (0, 1)}
    if opts.get("wait") == "calendar":
        assert all(r.wait_days == int(r.wait_days) for r in etl.star.fact.filter("wait_days IS NOT NULL").collect())
