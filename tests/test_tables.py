"""Stored tables: replacement, batches, refusals, writers that die; audit,
quarantine, range tables, file order, inferred scans, merged profiles."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from healthmart import schemas
from healthmart.operators import conform as cf
from healthmart.operators import quarantine as qr
from healthmart.operators import ranges, sketches
from healthmart.operators.audit import StageLog
from healthmart.plans import pipelines as P
from healthmart.plans import table_checks
from healthmart.sources import files, inferred, versions


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def die(*_, **__):
    raise KeyboardInterrupt("the driver is gone")


# ---- versions

def test_a_writer_that_dies_leaves_the_former_state(spark, scratch, monkeypatch):
    versions.replace_table(spark.range(5), scratch, "t")
    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", die)  # all rows are written, the manifest is not switched
        with pytest.raises(KeyboardInterrupt):
            versions.replace_table(spark.range(100), scratch, "t")
    assert versions.read_version(spark, scratch, "t").count() == 5
    with monkeypatch.context() as m:
        m.setattr(versions, "_write_part", die)
        with pytest.raises(KeyboardInterrupt):
            versions.append_batch(spark.range(100), scratch, "t", "b")
    assert versions.read_version(spark, scratch, "t").count() == 5
    versions.replace_table(spark.range(7), scratch, "t")
    assert versions.read_version(spark, scratch, "t").count() == 7
    assert versions.read_version(spark, scratch, "t", version=1).count() == 5
    assert versions.vacuum(spark, scratch, "t") == 2  # the former state's folder and the dead writer's
    assert versions.versions(spark, scratch, "t") == [2] and versions.read_version(spark, scratch, "t").count() == 7


def test_a_task_that_fails_leaves_the_former_state(spark, scratch):
    versions.replace_table(spark.range(5), scratch, "t")
    bad = spark.range(100).select((F.col("id") + F.expr("if(id = 77, raise_error('no'), 0)")).alias("id"))
    with pytest.raises(Exception, match="no"):
        versions.replace_table(bad, scratch, "t")
    assert versions.read_version(spark, scratch, "t").count() == 5


def test_of_two_writers_one_fails(spark, scratch):
    versions.replace_table(spark.range(3), scratch, "t")
    state = versions.manifest(spark, scratch, "t")
    late = versions.Manifest(state.version + 1, state.schema, state.parts)
    versions.replace_table(spark.range(4), scratch, "t")
    with pytest.raises(versions.Conflict):
        versions._publish(spark, scratch, "t", late)
    assert versions.read_version(spark, scratch, "t").count() == 4


def test_refused_before_and_after_the_write(spark, scratch):
    layout = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.StringType())])
    good = spark.createDataFrame([(1, "a")], "k long, v string")
    versions.replace_table(good, scratch, "t", layout)
    for wrong in (good.select(F.col("k").cast("int"), "v"), good.select("k"), good.withColumn("x", F.lit(1)),
                  spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")):
        with pytest.raises(versions.Refused):
            versions.replace_table(wrong, scratch, "t", layout)
    with pytest.raises(versions.Refused):
        versions.append_batch(good.withColumnRenamed("v", "w"), scratch, "t", "b")  # the stored layout holds
    assert rows(versions.read_version(spark, scratch, "t")) == [(1, "a")]


def test_batches_are_idempotent_and_ids_go_on(spark, scratch):
    def load(batch, names):
        df = spark.createDataFrame([(n,) for n in names], "name string")
        return versions.append_batch(df, scratch, "t", batch, id_col="id",
                                     number=lambda d, start: cf.dense_ids(d, ["name"], "id", start=start))

    def stored():
        return rows(versions.read_version(spark, scratch, "t").select("id", "name"))

    load("mon", "cab")
    load("tue", "ed")
    want = [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]
    assert stored() == want
    assert load("mon", "cab")["first_id"] == 1 and stored() == want
    assert load("tue", "ed")["first_id"] == 4 and stored() == want
    load("mon", "xy")  # shrunk: its own ids are enough
    assert stored() == [(1, "x"), (2, "y"), (4, "d"), (5, "e")]
    load("mon", "abcd")  # grown into those of tuesday: new ones
    assert stored() == [(4, "d"), (5, "e"), (6, "a"), (7, "b"), (8, "c"), (9, "d")]
    assert versions.append_batch(spark.createDataFrame([], "name string"), scratch, "t", "wed", id_col="id",
                                 number=lambda d, s: cf.dense_ids(d, ["name"], "id", start=s))["rows"] == 0
    assert [p.batch for p in versions.manifest(spark, scratch, "t").parts] == ["mon", "tue", "wed"]


def test_seeding_a_dimension_survives_a_dead_writer(spark, scratch, monkeypatch):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    files.write_table(first, scratch, "dim")
    wanted = spark.createDataFrame([(1, "b"), (2, "c")], "id int, name string")
    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", die)
        with pytest.raises(KeyboardInterrupt):
            files.seed_dimension(spark, scratch, "dim", wanted, "name", "id")
    assert rows(files.read_table(spark, scratch, "dim")) == [(1, "a"), (2, "b")]
    assert rows(files.seed_dimension(spark, scratch, "dim", wanted, "name", "id")) == [(1, "a"), (2, "b"), (3, "c")]
    before = versions.versions(spark, scratch, "dim")
    files.seed_dimension(spark, scratch, "dim", wanted, "name", "id")
    assert versions.versions(spark, scratch, "dim") == before  # nothing new, nothing written


# ---- flows: batches, stored stages, audit

@pytest.fixture(scope="module")
def sources(spark):
    ns, ds = P.driver_inputs(spark, "/root/testdata/sf0.001")
    return ns, ds


def test_etl_in_batches(spark, sources, scratch):
    """A source loaded in two periods, the second twice and once cut off."""
    ns, ds = sources
    opts = P.Options(outlier="range")
    parts = {"early": (ns.where("ScheduledDay < '1996-01-01'"), ds), "late": (ns.where("ScheduledDay >= '1996-01-01'"), ds.limit(0))}
    for batch in ("early", "late", "late"):
        star = P.run_etl(*parts[batch], opts, base=scratch, batch=batch).star
    ids = sorted(r["fact_id"] for r in star.fact.select("fact_id").collect())
    assert ids == list(range(1, len(ids) + 1))
    assert len(ids) == sum(P.run_etl(*p, opts).star.fact.count() for p in parts.values())
    assert star.dim_age_group.count() == len(schemas.AGE_GROUPS) and star.dim_source.count() == len(schemas.SOURCES)
    assert files.read_table(spark, f"{scratch}/landing", "raw_no_show").count() == ns.count()


def test_a_flow_that_dies_leaves_the_star(spark, sources, scratch, monkeypatch):
    ns, ds = sources
    before = rows(P.run_elt(ns, ds, base=scratch).star.fact, "fact_id")
    publish = versions._publish

    def partly(spark, base, name, state):
        if name.startswith("fact"):
            die()
        publish(spark, base, name, state)

    with monkeypatch.context() as m:
        m.setattr(versions, "_publish", partly)
        with pytest.raises(KeyboardInterrupt):
            P.run_elt(ns.where("Age > 30"), ds, base=scratch)
    assert rows(files.read_table(spark, f"{scratch}/warehouse", "fact_medical_elt"), "fact_id") == before


def test_runs_of_one_session_have_views_of_their_own(spark, sources, scratch):
    ns, ds = sources
    one = P.run_elt(ns, ds, base=f"{scratch}/1")
    two = P.run_elt(ns.where("Age > 30"), ds, base=f"{scratch}/2")
    assert spark.table(one.views["stg_no_show"]).count() == ns.count() > spark.table(two.views["stg_no_show"]).count()
    for name in ("clean_no_show", "clean_disease", "enriched_no_show", "enriched_disease"):
        assert files.read_table(spark, f"{scratch}/1/warehouse", name).count() > 0


def test_audit_is_stored_with_its_csv(spark, sources, scratch):
    ns, ds = sources
    res = P.run_etl(ns, ds, base=scratch)
    stored = {r["stage"]: r for r in files.read_table(spark, scratch, "audit").collect()}
    for s, n in (("no_show", ns.count()), ("disease", ds.count())):
        assert stored[f"extract_{s}"]["rows"] == n == stored[f"dedupe_{s}"]["before"]
        assert stored[f"clean_{s}"]["before"] - stored[f"clean_{s}"]["removed"] == stored[f"clean_{s}"]["rows"]
    assert stored["load_fact"]["rows"] == res.star.fact.count()
    text = spark.read.option("header", True).csv(f"{scratch}/audit_csv")
    assert {r["stage"]: r["rows"] for r in text.collect()} == {k: None if r["rows"] is None else str(r["rows"]) for k, r in stored.items()}


def test_records_of_differing_layouts(spark):
    log = StageLog()
    log.log("a", rows=3)
    log.log("b", share=0.5, note="x")
    log.log("c", rows=None, note=7)
    log.log("a", duration_s=1.5)
    got = log.to_frame(spark)
    assert dict(got.dtypes) == {"stage": "string", "timestamp": "string", "rows": "bigint", "duration_s": "double", "share": "double", "note": "string"}
    assert [(r["stage"], r["rows"], r["duration_s"], r["note"]) for r in got.collect()] == [("a", 3, 1.5, None), ("b", None, None, "x"), ("c", None, None, "7")]
    assert StageLog().to_frame(spark).count() == 0


# ---- landing as CSV

def test_csv_copy_keeps_every_text_apart(spark, scratch):
    texts = ['say "hi", you', "two\nlines", "dos\r\nlines", "old\rmac", "", None, " blanks ", '"', "a,b", "\\", "tab\t", "é 日本", "null", "N"]
    df = spark.createDataFrame([(i, t, float(i) if i % 3 else None) for i, t in enumerate(texts)], "i int, t string, `x y` double")
    assert rows(files.land(df, scratch, "raw", fmt="csv"), "i") == rows(df, "i")


# ---- quarantine

def test_quarantine(spark, scratch):
    data = [(1, 5.0, "1", "a"), (1, 5.0, "1", "a"), (1, 4.0, "x", "a"), (2, 500.0, "1", "a"), (None, 1.0, "1", "a"), (None, 1.0, "1", "a"),
            (3, None, None, "b"), (4, 1.0, "?", "z"), (5, -1.0, "2", None), (6, 2.0, "7", "b")]
    df = spark.createDataFrame(data * 1, "id int, age double, code string, source string")
    rules = qr.Rules("id", order_by=("age",), ranges={"age": (0, 120)}, codes={"code": ("int", -1)}, sources={"source": ("a", "b")})
    kept, rejected, counts = qr.quarantine(df, rules, scratch, "q")
    assert rows(kept, "id") == [(1, 4.0, -1, "a"), (3, None, None, "b"), (6, 2.0, 7, "b")] or \
        rows(kept, "id") == [(1, 4.0, -1, "a"), (3, None, -1, "b"), (6, 2.0, 7, "b")]
    got = {(r["id"], r["age"], r["broken"]): (r["times"], r["reasons"]) for r in rejected.collect()}
    dup, miss, rng, code, src = (qr.DUPLICATE, qr.MISSING, qr.RANGE, qr.CODE, qr.SOURCE)
    assert got == {(1, 5.0, dup): got[1, 5.0, dup], (2, 500.0, rng): (1, [qr.RULES[2]]), (None, 1.0, miss): (2, [qr.RULES[1]]),
                   (4, 1.0, code | src): (1, [qr.RULES[3], qr.RULES[4]]), (5, -1.0, rng | src): (1, [qr.RULES[2], qr.RULES[4]])}
    assert sum(r["times"] for r in rejected.where("id = 1").collect()) == 2
    assert counts == {"V1": 2, "V2": 2, "V3": 2, "V4": 2, "V5": 2}
    assert kept.count() + sum(r["times"] for r in rejected.collect()) == len(data)
    none = qr.quarantine(df.limit(0), rules, scratch, "none")
    assert none[0].count() == none[1].count() == 0 and set(none[2].values()) == {0}


# ---- range tables

def _first_range(v, table):
    hit = [r for r in table if v is not None and not math.isnan(v) and r[0] <= v <= r[1]]
    return min(hit)[2] if hit else -1


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_range_lookup(spark, broadcast):
    rng = random.Random(3)
    table = []
    for i in range(300):
        lo = rng.choice([rng.uniform(-50, 50), rng.randint(-50, 50), rng.uniform(-1e6, 1e6)])
        table.append((float(lo), float(lo + rng.choice([0, 0.001, 1, 5, 30, 4000, 1e6])), i))
    table += [(7.0, 6.0, 900), (1.0, 2.0, 901), (1.0, 2.0, 902), (-math.inf, -9e6, 903), (9e6, math.inf, 904)]
    values = [rng.uniform(-60, 60) for _ in range(300)] + [r[0] for r in table[:100]] + [r[1] for r in table[:100]] + [None, math.nan, 1e7, -1e7, 8.5e6, math.inf, -math.inf]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    of = spark.createDataFrame([*table, (None, 1.0, 905), (math.nan, math.nan, 906)], "lo double, hi double, band int")
    out = ranges.range_lookup(df, "v", of, "lo", "hi", ["band"], default={"band": -1}, broadcast=broadcast)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r["band"] for r in out.orderBy("i").collect()] == [_first_range(v, table) for v in values]
    none = ranges.range_lookup(df, "v", of.limit(0), "lo", "hi", ["band"], default={"band": -1})
    assert {r["band"] for r in none.collect()} == {-1}


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_range_lookup_of_ranges_over_each_other(spark, broadcast, monkeypatch):
    monkeypatch.setattr(ranges, "TOP", 3)  # several levels of the tree
    table = [(i / 8, i / 8 + 500 + i % 3, i) for i in range(1500)] + [(0.0, 3.0, 2000 + i) for i in range(50)] + [(900.0, math.inf, 3000)]
    of = spark.createDataFrame(table, "lo double, hi double, band int")
    values = [-1.0, -0.0, 0.0, 3.0, 3.5, 499.9, 500.0, 500.01, 502.0, 640.0625, 687.5, 687.6, 688.0, 689.5, 800.0, 1e300, math.inf, math.nan, None] + [i * 0.37 for i in range(2000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    out = ranges.range_lookup(df, "v", of, "lo", "hi", ["band"], default={"band": -1}, broadcast=broadcast)
    assert [r["band"] for r in out.orderBy("i").collect()] == [_first_range(v, table) for v in values]
    kept, n = ranges.kept(of, "lo", "hi", ["band"])
    assert n > 20 * ranges.FAN  # every value between 190 and 500 lies in all of them
    for level in (1, 2):  # what one value meets stays small
        assert ranges.nodes(kept, level).agg(F.max(F.size("held"))).first()[0] <= ranges.FAN


# ---- file order

def test_ids_in_file_order_without_a_shuffle(spark, scratch):
    source = spark.range(20_000).select(F.col("id").alias("k"), F.lit("some text to fill a split").alias("t"))
    path = files.write_csv(source.repartition(3), scratch, "lines")
    small = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = spark.read.option("header", True).schema("k long, t string").csv(path)
        assert df.rdd.getNumPartitions() > 6
        ids = files.with_file_ids(df, "id", start=5)
        plan = ids._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(__file" in plan and plan.count("SinglePartition") >= 1
        scan_side = plan.split("BroadcastExchange")[0]
        assert "Exchange" not in scan_side and "Sort [" not in scan_side
        got = {r["k"]: r["id"] for r in ids.select("k", "id").collect()}
        want = cf.dense_ids(files.with_row_order(df), ["_row"], "id", start=5)
        assert got == {r["k"]: r["id"] for r in want.select("k", "id").collect()} and len(got) == 20_000
        place = files.with_place(df, "at").groupBy("at.file").agg(F.min("at.row"), F.max("at.row"), F.count_distinct("at.row"))
        assert all(lo == 1 and hi == n for _, lo, hi, n in place.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small[0])
        spark.conf.set("spark.sql.files.openCostInBytes", small[1])


def test_files_in_order_stay_small(spark, scratch, monkeypatch):
    monkeypatch.setattr(table_checks, "FILE_ROWS", 1000)
    source = spark.range(9_500).select(F.pmod(F.col("id") * 7919, 9_500).alias("k"))
    df = spark.read.option("header", True).schema("k long").csv(files.write_csv(table_checks._in_files(source, ["k"]), scratch, "lines"))
    per_file = [r["count"] for r in df.groupBy("_metadata.file_path").count().collect()]
    assert len(per_file) >= 9 and max(per_file) < 2500
    assert files.with_file_ids(df, "id", start=0).where("id <> k").count() == 0 and df.count() == 9_500
    assert table_checks._in_files(source.limit(5), ["k"]).rdd.getNumPartitions() == 3


# ---- inferred scan

def test_inferred_types_and_rescue(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,x,flag,day,t,none\n1,1.5,true,2024-01-01,a,\n2,2,false,2024-02-30,b,\nthree,3,true,2024-03-01,c,\n")
    (tmp_path / "b.csv").write_text("n,x,flag,day,t,none\n4,1e3,false,2024-04-01,5,\n5,6,true\n6,7,false,2024-05-01,d,,extra\n")
    strict = dict(inferred.read_inferred(spark, str(tmp_path)).dtypes)
    assert [strict[c] for c in ("n", "x", "flag", "day", "t", "none")] == ["string", "double", "boolean", "string", "string", "string"]
    df = inferred.read_inferred(spark, str(tmp_path), tolerance=0.25)
    kinds = dict(df.dtypes)
    assert [kinds[c] for c in ("n", "x", "flag", "day", "t")] == ["bigint", "double", "boolean", "date", "string"]
    bad = {(r["_rescued"]["file"], r["_rescued"]["row"]): r["_rescued"]["fields"] for r in df.where("_rescued is not null").collect()}
    assert bad == {("a.csv", 2): {"day": "2024-02-30"}, ("a.csv", 3): {"n": "three"}, ("b.csv", 2): {"": "5,6,true"},
                   ("b.csv", 3): {"": "6,7,false,2024-05-01,d,,extra"}}
    again = inferred.read_inferred(spark, str(tmp_path), types=dict.fromkeys(["n", "x", "flag", "day", "t", "none"], "string"))
    assert again.where("_rescued is not null").count() == 2  # only the lines that are broken


def test_the_look_before_a_cast_loses_no_value(spark):
    texts = ["1", " 12 ", "\t-3\n", "+4", "\x00 5\x1f", "5.", ".5", "1.5", "-1.5e-3", "1E5", "1e+5", "2f", "2.5D", "1e3f", "0x1p3", "0x1.8p-3", "0xAp1f", "NaN", " nan", "-Infinity", "+inf",
             "inf", "INF", "t", "TRUE", " yes ", "n", "No", "0", "tr", "1-URGENT", "1996-01-02", "1995-02-30", "n/a", 'free, "x"', "", " ", "-", "e", "1e", "1 2", "9" * 30, "\u0661", "1\u00a0", "\u20031", "1\u2028", "true\u2003", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for kind in inferred.LATTICE:
        bad = df.where(~inferred._fits(F.col("v"), kind).eqNullSafe(F.col("v").try_cast(kind)))
        assert bad.collect() == [], kind
    unfit = df.where(F.col("v").isin("1-URGENT", "1996-01-02", "n/a"))  # the common misfits are not cast at all
    assert unfit.where(" or ".join(f"v rlike r'{m}'" for m in inferred.MAY_FIT.values())).count() == 0


# ---- profiles that merge

def test_profile_of_batches_is_the_profile_of_all(spark, scratch):
    df = spark.range(6000).select((F.col("id") % 1500).alias("k"), F.when(F.col("id") % 10 > 0, F.col("id") / 7).alias("x"),
                                  F.when(F.col("id") % 3 == 0, "often").otherwise(F.col("id").cast("string")).alias("s"), F.lit(None).cast("string").alias("e"))
    for batch, part in (("1", df.where("k < 700")), ("2", df.where("k >= 700")), ("1", df.where("k < 700"))):
        merged = sketches.keep_profile(part, scratch, "profile", batch)
    got = {r["column"]: r for r in sketches.shown(merged).collect()}
    one = {r["column"]: r for r in sketches.shown(sketches.merged(sketches.profile_part(df))).collect()}
    for c in df.columns:
        for f in ("kind", "rows", "nulls", "least", "greatest"):
            assert got[c][f] == one[c][f]
        assert got[c]["n_distinct"] == pytest.approx(one[c]["n_distinct"], rel=0.05)
    assert got["k"]["n_distinct"] == pytest.approx(1500, rel=0.05) and got["x"]["nulls"] == 600
    assert got["k"]["quantiles"][1] == pytest.approx(750, abs=40) and got["s"]["quantiles"] is None
    assert got["s"]["frequent"][0]["item"] == "often" and got["s"]["frequent"][0]["count"] == pytest.approx(2000, abs=8)
    assert got["e"]["n_distinct"] == 0 and got["e"]["nulls"] == 6000
