"""Properties on random inputs, checked against a plain-Python brute force
on small fixtures."""

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from healthmart.operators import clean, conform as cf
from healthmart.operators.quantiles import quantiles

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(-5, 5)), min_size=0, max_size=40)


@SETTINGS
@given(rows_strategy)
def test_keep_first_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, v int")
    got = sorted(tuple(r) for r in clean.dedupe_keep_first(df, ["k"], ["o"]).collect())
    best = {}
    for k, o, v in rows:
        if k not in best or (o, v) < best[k][1:]:
            best[k] = (k, o, v)
    assert got == sorted(best.values())
    again = sorted(tuple(r) for r in clean.dedupe_keep_first(spark.createDataFrame(got, "k int, o int, v int"),
                                                            ["k"], ["o"]).collect())
    assert again == got


@SETTINGS
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_dense_ids_match_sorted_rank(spark, lead):
    # leading column heavily repeated, second column makes the order total
    rows = [(a, i) for i, a in enumerate(lead)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = {(r.a, r.b): r.rid for r in cf.dense_ids(df, ["a", "b"], "rid", partitions=3).collect()}
    expected = {key: i + 1 for i, key in enumerate(sorted(rows))}
    assert got == expected


@SETTINGS
@given(st.sets(st.integers(1, 500), min_size=1, max_size=60))
def test_renumber_keeps_order_and_is_dense(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "rid long")
    got = sorted((r.rid, r.fid) for r in cf.renumber_dense(df, "rid", "fid", bucket_rows=16).collect())
    assert [f for _, f in got] == list(range(1, len(ids) + 1))


@settings(SETTINGS, phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False, width=64), st.sampled_from([0.0, 1.0, 1e-310])),
                min_size=1, max_size=60, unique=True), st.lists(st.integers(0, 3), min_size=60, max_size=60))
def test_quantiles_match_percentile(spark, values, repeats):
    rows = [(v,) for v, n in zip(values, repeats) for _ in range(n + 1)] + [(None,)]
    df = spark.createDataFrame(rows, "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = quantiles(df, {"x": probs}).first()["x"]
    assert got == df.selectExpr("percentile(x, array(0.0D, 0.25D, 0.5D, 0.75D, 1.0D)) AS p").first()["p"]
