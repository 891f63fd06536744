"""Transform-then-load (ETL) and load-then-transform (ELT): two
compositions of the same operators.

Both take the two inputs as DataFrames with their original column names
(the medical CSVs, or the role views over the driver tables) and return a
``Star`` plus the conformed rows, a quality report and a stage audit.
Columns are found by name rules, so the same code runs on either input.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from healthmart import schemas
from healthmart.functions.columns import normalize_names, resolve, yes_no_columns
from healthmart.functions.encode import encode_binary, encode_codes, encode_gender, encode_ordinal
from healthmart.functions.features import (
    age_group_case, day_of_week, flag_sum, hour_of, month_of, parse_timestamp, row_sum, wait_days,
    wait_days_calendar, weekend_flag, yes_count,
)
from healthmart.operators import clean, conform as cf, quality, scale, star as st
from healthmart.operators.audit import StageLog, stage_counts
from healthmart.operators.materialize import checkpoint
from healthmart.sources import files, versions

# The appointment columns summed into comorbidity_count.
COMORBIDITY_COLUMNS = ("hipertension", "diabetes", "alcoholism", "handcap", "scholarship")
DATE_COLUMNS = ("scheduledday", "appointmentday")


@dataclass
class Options:
    """Choices where the two reference flows differ (see README). None, or
    'flow' for the group of a NULL age, takes what the flow itself does."""
    outlier: str | None = None        # 'iqr' (quartile fence, ETL) or 'range' (0..120 only, ELT)
    iqr_k: float = 1.5
    scale_eps: float | None = None    # 1e-9 in ETL, 1e-4 in ELT
    symptoms: str | None = None       # 'detect': every yes/no column (ETL); 'fever_cough': two flags (ELT)
    wait: str = "timestamp"           # 'timestamp' difference or 'calendar' days
    outcome_mode: str = "source_aware"  # or 'flag' (1 -> Show / Positive for every source)
    age_group_default: int | None = None  # 3 in ETL, 5 in ELT
    age_group_null: int | str | None = "flow"  # no group in ETL, the default one in ELT
    order_col: str | None = None      # explicit input order for keep-first picks
    comorbidity_columns: tuple = COMORBIDITY_COLUMNS
    checkpoint: bool = True           # cut lineage after the de-duplicating shuffles
    staging_copy: bool = False        # ELT: physical staging copy instead of tables over the lake files
    store_enriched: bool = True       # ELT with a base: enriched tables are stored by name as well
    elt_disease_key: str = "group"    # ELT: 'group' = one row per (disease, age, gender); 'full_row' = distinct rows


def _of_etl(opts: Options) -> Options:
    return _settled(opts, outlier="iqr", scale_eps=1e-9, symptoms="detect", age_group_default=3, age_group_null=None)


def _of_elt(opts: Options) -> Options:
    null = 5 if opts.age_group_default is None else opts.age_group_default
    return _settled(opts, outlier="range", scale_eps=1e-4, symptoms="fever_cough", age_group_default=5, age_group_null=null)


def _settled(opts: Options, **of_flow) -> Options:
    """``opts`` with the choices it leaves open made as the flow makes them."""
    return replace(opts, **{k: v for k, v in of_flow.items() if getattr(opts, k) == ("flow" if k == "age_group_null" else None)})


@dataclass
class Result:
    star: st.Star
    conformed: DataFrame | None = None
    quality: DataFrame | None = None
    stages: dict = field(default_factory=dict)
    log: StageLog = field(default_factory=StageLog)
    views: dict = field(default_factory=dict)

    def audit(self) -> DataFrame:
        return stage_counts(list(self.stages.items()))


def _order(df: DataFrame, opts: Options) -> list[str]:
    return [opts.order_col] if opts.order_col and opts.order_col in df.columns else []


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _cut_counting_nulls(df: DataFrame, opts: Options, log: StageLog | None = None, stage: str = "",
                        before: int | None = None) -> tuple[DataFrame, list[str], dict | None]:
    """Lineage cut that also counts its rows (into ``log``) and the NULLs of
    the numeric columns while writing (input of the median fill); returns
    (frame, numeric columns, NULL counts or None when no cut is taken)."""
    numeric = [c for c, t in df.dtypes if t in NUMERIC_TYPES and c != opts.order_col]
    if not opts.checkpoint:
        return df, numeric, None
    out, seen = checkpoint(df, observe={"rows": F.count(F.lit(1)), **{
        f"null_{i}": F.count_if(F.col(f"`{c}`").isNull()) for i, c in enumerate(numeric)}})
    if log is not None:
        log.rows(stage, seen["rows"], before)
    return out, numeric, {c: seen[f"null_{i}"] for i, c in enumerate(numeric)}


# =============================================================================
# ETL
# =============================================================================

def _appointment_id(columns: list[str]) -> str:
    """The column named after appointment and id; the second (or only) one
    if there is none."""
    return resolve(columns, ("appointment", "id"), default=columns[:2][-1])


def etl_clean_appointments(df: DataFrame, opts: Options, log: StageLog | None = None, before: int | None = None) -> DataFrame:
    """names -> keep-first by id -> drop NULL id -> text fill -> median fill
    -> parse dates, drop unparsed -> age >= 0 -> outlier filter."""
    opts = _of_etl(opts)
    df = normalize_names(df, dash_to_underscore=True)
    id_col = _appointment_id(df.columns)
    df = clean.dedupe_keep_first(df, [id_col], _order(df, opts))
    df = clean.drop_null(df, [id_col])
    df = clean.fill_text(df)  # before date parsing: a NULL date becomes text that fails to parse
    df, numeric, nulls = _cut_counting_nulls(df, opts, log, "dedupe_no_show", before)
    df = clean.fill_median(df, numeric, null_counts=nulls, eager=opts.checkpoint)
    df = clean.parse_dates(df, DATE_COLUMNS)
    if "age" in df.columns:
        df = clean.range_filter(df, "age", lo=0)
        if opts.outlier == "iqr":
            df = clean.iqr_filter(df, "age", opts.iqr_k, eager=opts.checkpoint)
        else:
            df = clean.range_filter(df, "age", 0, 120)
    return df


def etl_clean_profiles(df: DataFrame, opts: Options, log: StageLog | None = None, before: int | None = None) -> DataFrame:
    """names -> full-row distinct -> text fill -> median fill -> age >= 0."""
    df = normalize_names(df, dash_to_underscore=False)
    if opts.order_col and opts.order_col in df.columns:
        df = clean.dedupe_keep_first(df, [c for c in df.columns if c != opts.order_col], [opts.order_col])
    else:
        df = clean.dedupe_full_row(df)
    df = clean.fill_text(df)
    df, numeric, nulls = _cut_counting_nulls(df, opts, log, "dedupe_disease", before)
    df = clean.fill_median(df, numeric, null_counts=nulls, eager=opts.checkpoint)
    if "age" in df.columns:
        df = clean.range_filter(df, "age", lo=0)
    return df


def etl_standardize_appointments(df: DataFrame, opts: Options) -> DataFrame:
    """age_norm (min-max over the cleaned rows), no_show_flag, gender_code, source."""
    if "age" in df.columns:
        df = scale.minmax_scale(df, "age", "age_norm", eps=_of_etl(opts).scale_eps, eager=opts.checkpoint)
    ns = resolve(df.columns, ("no", "show"))
    cols = {}
    if ns:
        cols["no_show_flag"] = encode_binary(ns, "yes")
    if "gender" in df.columns:
        cols["gender_code"] = encode_gender("gender", male="M", female="F", case="upper")
    cols["source"] = F.lit("no_show")
    return df.withColumns(cols)


def etl_standardize_profiles(df: DataFrame, opts: Options) -> DataFrame:
    """age_norm, outcome_code, gender_code, source."""
    if "age" in df.columns:
        df = scale.minmax_scale(df, "age", "age_norm", eps=_of_etl(opts).scale_eps, eager=opts.checkpoint)
    oc = resolve(df.columns, "outcome")
    cols = {}
    if oc:
        cols["outcome_code"] = encode_binary(oc, "positive")
    if "gender" in df.columns:
        cols["gender_code"] = encode_gender("gender", male="male", female="female")
    cols["source"] = F.lit("disease")
    return df.withColumns(cols)


def enrich_appointments(df: DataFrame, opts: Options, rounded: bool = True) -> DataFrame:
    """wait_days, calendar parts (Sunday=0), weekend flag, hour,
    comorbidity_count."""
    cols = {}
    sched = resolve(df.columns, "scheduled")
    appt = resolve(df.columns, "appointmentday") or resolve(df.columns, "appointment_day")
    if sched and appt:
        if opts.wait == "calendar":
            cols["wait_days"] = wait_days_calendar(sched, appt)
        else:
            cols["wait_days"] = wait_days(sched, appt, 1 if rounded else None)
        dow = day_of_week(appt, "sunday")
        cols["appt_day_of_week"] = dow
        cols["appt_month"] = month_of(appt)
        cols["appt_hour"] = hour_of(sched)
        cols["is_weekend"] = weekend_flag(dow, "sunday")
    med = [c for c in df.columns if c in opts.comorbidity_columns]
    cols["comorbidity_count"] = row_sum(med)
    return df.withColumns(cols)


def enrich_profiles(df: DataFrame, opts: Options) -> DataFrame:
    """symptom_count over the yes/no columns, fever/cough flags, blood
    pressure and cholesterol levels."""
    opts = _of_etl(opts)
    fever = resolve(df.columns, "fever")
    cough = resolve(df.columns, "cough")
    cols = {}
    if opts.symptoms == "detect":
        # Which text columns hold only yes/no -- one aggregate returning one row
        bool_cols = yes_no_columns(df, [c for c, t in df.dtypes if t == "string"])
        cols["symptom_count"] = yes_count(bool_cols)
    cols["has_fever"] = F.when(F.lower(F.col(fever)) == "yes", 1).otherwise(0) if fever else F.lit(0)
    cols["has_cough"] = F.when(F.lower(F.col(cough)) == "yes", 1).otherwise(0) if cough else F.lit(0)
    bp = resolve(df.columns, ("blood", "pressure"))
    if bp:
        cols["bp_encoded"] = encode_ordinal(bp, whitespace=False)
    chol = resolve(df.columns, "cholesterol")
    if chol:
        cols["cholesterol_encoded"] = encode_ordinal(chol, whitespace=False)
    df = df.withColumns(cols)
    if opts.symptoms != "detect":
        df = df.withColumn("symptom_count", flag_sum(["has_fever", "has_cough"]))
    return df


def conform_sources(ns: DataFrame, ds: DataFrame, order_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sources in the 17-column layout, plus the order keys for ids:
    source rank, then input order when an order column is given (the
    reference numbers rows in file order), else the appointment id."""
    def key(df, fallback):
        place = lambda nth: F.struct(F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("start"),
                                     nth.alias("nth"))
        if order_col and order_col in df.columns:
            by_file = df.schema[order_col].dataType.typeName() == "struct"
            return F.col(order_col) if by_file else place(F.col(order_col).cast("long"))
        return place(F.col(fallback).try_cast("long") if fallback and fallback in df.columns else F.lit(None).cast("long"))

    ns_c = cf.conform(ns.withColumn("__key", key(ns, "appointmentid")).withColumn("__rank", F.lit(0)),
                      "no_show", {"outcome_flag": "no_show_flag", "is_weekend": "is_weekend"},
                      keep=("__rank", "__key"))
    disease = resolve([c for c in ds.columns if c != order_col], "disease")
    ds_c = cf.conform(ds.withColumn("__key", key(ds, None)).withColumn("__rank", F.lit(1)),
                      "disease", {"outcome_flag": "outcome_code", "cholesterol_enc": "cholesterol_encoded",
                                  "disease_name": disease},
                      keep=("__rank", "__key"))
    return ns_c, ds_c


def record_order() -> list[str]:
    return ["__rank", "__key"] + [c for c in schemas.CONFORMED.fieldNames() if c not in ("record_id", "source")]


def run_etl(appointments: DataFrame, profiles: DataFrame, opts: Options | None = None,
            base: str | None = None, batch: str | None = None) -> Result:
    """Extract -> clean -> standardise -> enrich -> conform -> validate ->
    snapshot -> load -> (reports run over ``result.star``).

    With ``base`` the stages are written: ``landing/`` copies,
    ``lake/transformed``, ``warehouse/{fact_medical,dim_*}`` and ``audit``
    (rows, before, after, removed of every stage, as its write observed
    them). With ``batch`` as well, the rows are one batch of these tables:
    added to what is stored, or in place of an earlier load of that batch;
    dimensions keep what they have.
    """
    opts = _of_etl(opts or Options())
    log = StageLog()
    spark = appointments.sparkSession
    stages = {"extract_no_show": appointments, "extract_disease": profiles}
    n_ns = n_ds = None
    if base:
        (n_ns, appointments), (n_ds, profiles) = log.timed("landing", lambda: parallel([
            lambda: _land(appointments, f"{base}/landing", "raw_no_show", batch),
            lambda: _land(profiles, f"{base}/landing", "raw_disease", batch)]))
        log.rows("extract_no_show", n_ns["rows"])
        log.rows("extract_disease", n_ds["rows"])
        n_ns, n_ds = n_ns["rows"], n_ds["rows"]
    ns = log.timed("clean_no_show", lambda: etl_clean_appointments(appointments, opts, log, n_ns))
    ds = log.timed("clean_disease", lambda: etl_clean_profiles(profiles, opts, log, n_ds))
    stages.update(clean_no_show=ns, clean_disease=ds)
    ns = etl_standardize_appointments(ns, opts)
    ds = etl_standardize_profiles(ds, opts)
    ns = enrich_appointments(ns, opts)
    ds = log.timed("enrich_disease", lambda: enrich_profiles(ds, opts))
    ns_c, ds_c = conform_sources(ns, ds, opts.order_col)
    merged = cf.union_all(ns_c, ds_c)
    merged, seen = log.timed("assign_record_ids", lambda: cf.dense_ids(
        merged, record_order(), "record_id",
        observe={s: F.count_if(F.col("source") == s) for s in ("no_show", "disease")}))
    deduped = {r["stage"]: r["rows"] for r in log.records if r["stage"].startswith("dedupe_")}
    for s in ("no_show", "disease"):
        log.rows(f"clean_{s}", seen[s], deduped.get(f"dedupe_{s}"))
    merged = merged.drop("__rank", "__key").select(*schemas.CONFORMED.fieldNames())
    stages["conformed"] = merged
    report = quality.check_conformed(merged)
    # the rule rows are a fixed handful; collecting them decides which
    # filters have anything to remove (as the reference only drops on a hit)
    counts = log.timed("validate", lambda: quality.report_dict(report))
    valid = quality.enforce(merged, order_by=["source"], report=counts)
    stages["validated"] = valid
    dims = st.Star.with_literal_dims(valid)
    fact = st.build_fact(valid, dims.dim_source, opts.outcome_mode, opts.age_group_default, opts.age_group_null)
    if quality.removed_rows(counts) == 0:
        # nothing removed: record ids are already dense in insertion order
        fact = fact.withColumn("fact_id", F.col("record_id")).select(*schemas.FACT_COLUMNS)
    else:
        fact = cf.renumber_dense(fact, "record_id", "fact_id").select(*schemas.FACT_COLUMNS)
    star = st.Star(fact, dims.dim_source, dims.dim_outcome, dims.dim_age_group)
    if base:
        def snapshot():
            got = _store(valid, f"{base}/lake", "transformed", batch)
            log.rows("validate", got["rows"], seen["no_show"] + seen["disease"])

        # snapshot and star come from the same cut and do not wait for each other
        _, star = parallel([lambda: log.timed("snapshot", snapshot),
                            lambda: load_star(star, f"{base}/warehouse", "fact_medical", log, batch, schemas.FACT)])
    stages["fact"] = star.fact
    if base:
        log.write(spark, base)
    return Result(star, merged, report, stages, log)


def _store(df: DataFrame, base: str, name: str, batch: str | None, metrics: dict | None = None) -> dict:
    """Replace a table, or put a batch into it; returns what was observed."""
    if batch is None:
        return files.write_table(df, base, name, metrics)
    return versions.append_batch(df, base, name, batch, metrics=metrics)


def _land(df: DataFrame, base: str, name: str, batch: str | None, metrics: dict | None = None) -> tuple[dict, DataFrame]:
    """Landing copy: (observed, the copied rows read back)."""
    got = _store(df, base, name, batch, metrics)
    return got, versions.read_version(df.sparkSession, base, name, batches=None if batch is None else [batch])


def load_star(star: st.Star, warehouse: str, fact_name: str, log: StageLog | None = None, batch: str | None = None,
              schema=None) -> st.Star:
    """Write dims and fact, return the stored star.

    A full replace, or with ``batch`` an idempotent append: the batch's fact
    ids go on from the stored ones, and dimensions get the rows whose names
    they lack. The fact is held to ``schema``. The four writes are
    independent jobs and are submitted together."""
    spark = star.fact.sparkSession
    log = log or StageLog()
    dims = [("dim_source", star.dim_source, "source_name", "source_id"), ("dim_outcome", star.dim_outcome, "outcome_label", "outcome_id"),
            ("dim_age_group", star.dim_age_group, "age_group_name", "age_group_id")]

    def fact():
        if batch is None:
            got = files.write_table(star.fact, warehouse, fact_name, schema=schema)
        else:
            got = versions.append_batch(star.fact, warehouse, fact_name, batch, schema, "fact_id",
                                        lambda df, start: df.withColumn("fact_id", F.col("fact_id") + F.lit(start - 1).cast("long")))
        log.rows("load_fact", got["rows"])

    def dim(name, rows, name_col, id_col):
        if batch is None:
            return files.write_table(rows.coalesce(1), warehouse, name)
        return files.seed_dimension(spark, warehouse, name, rows, name_col, id_col)

    log.timed("load", lambda: parallel([fact, *[lambda d=d: dim(*d) for d in dims]]))
    return st.Star(*[files.read_table(spark, warehouse, n) for n in (fact_name, *[d[0] for d in dims])])


def parallel(thunks: list) -> list:
    """Run independent Spark actions concurrently from driver threads (the
    scheduler interleaves their tasks); results in input order."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, len(thunks))) as pool:
        return [f.result() for f in [pool.submit(t) for t in thunks]]


# =============================================================================
# ELT
# =============================================================================

def _qc(name):
    return F.col(f"`{name}`")


def elt_clean_appointments(stg: DataFrame, opts: Options, age_bounds: tuple | None = None) -> DataFrame:
    """clean_no_show: resolved columns, scaled age (min/max over the raw
    staging rows, eps 1e-4, 4 digits), NULL-id and 0..120 age filter, one
    row per appointment id (first by order)."""
    opts = _of_elt(opts)
    cols = stg.columns
    ns = resolve(cols, ("no", "show"))
    appt = _appointment_id(cols)
    sched = resolve(cols, "scheduled")
    apptday = resolve(cols, "appointmentday")
    gender = resolve(cols, "gender")
    age = resolve(cols, "age", exact=True)
    age_expr = F.expr(f"try_cast(`{age}` AS DOUBLE)") if age else F.lit(None).cast("double")
    med = [c for c in cols if c.lower() in opts.comorbidity_columns]
    staged = stg.withColumn("__age", age_expr)
    out = staged.select(
        _qc(appt).alias("appointment_id"),
        F.col("__age").alias("age"),
        (encode_codes(gender, {"F": 1, "M": 0}, default=-1, case="upper", whitespace=False)
         if gender else F.lit(-1)).alias("gender_code"),
        (encode_binary(ns, "yes", whitespace=False) if ns else F.lit(0)).alias("no_show_flag"),
        (_qc(sched) if sched else F.lit(None)).alias("scheduled_day"),
        (_qc(apptday) if apptday else F.lit(None)).alias("appointment_day"),
        F.lit("no_show").alias("source"),
        row_sum(med).alias("comorbidity_count"),
        *([_qc(opts.order_col)] if opts.order_col in cols else []),
    ).filter(F.col("appointment_id").isNotNull())
    if opts.outlier == "iqr":
        out = clean.dedupe_keep_first(out, ["appointment_id"], _order(out, opts))
        out = clean.iqr_filter(clean.range_filter(out, "age", lo=0), "age", opts.iqr_k)
    else:
        out = clean.range_filter(out, "age", 0, 120)
        out = clean.dedupe_keep_first(out, ["appointment_id"], _order(out, opts))
    if age:
        out = scale.minmax_scale(out, "age", "age_norm", eps=opts.scale_eps, scale=4,
                                 domain=staged.select(F.col("__age").alias("age")), bounds=age_bounds)
    else:
        out = out.withColumn("age_norm", F.lit(None).cast("double"))
    return out.select("appointment_id", "age", "age_norm", "gender_code", "no_show_flag", "scheduled_day",
                      "appointment_day", "source", "comorbidity_count")


def elt_clean_profiles(stg: DataFrame, opts: Options, age_bounds: tuple | None = None) -> DataFrame:
    """clean_disease: encoded columns, one row per (disease, age, gender)
    group (first by order), scaled age over the raw staging rows."""
    opts = _of_elt(opts)
    cols = stg.columns
    disease = resolve(cols, "disease", default=cols[0])
    age = resolve(cols, "age", exact=True)
    gender = resolve(cols, "gender")
    outcome = resolve(cols, "outcome")
    fever, cough = resolve(cols, "fever"), resolve(cols, "cough")
    bp, chol = resolve(cols, ("blood", "pressure")), resolve(cols, "cholesterol")
    age_expr = F.expr(f"try_cast(`{age}` AS DOUBLE)") if age else F.lit(None).cast("double")
    staged = stg.withColumn("__age", age_expr)
    flag = lambda c, pos: (encode_binary(c, pos, whitespace=False) if c else F.lit(0))
    lvl = lambda c: (encode_ordinal(c, whitespace=False) if c else F.lit(1))
    out = staged.select(
        _qc(disease).alias("disease_name"),
        F.col("__age").alias("age"),
        (encode_gender(gender, male="male", female="female", whitespace=False) if gender else F.lit(-1))
        .alias("gender_code"),
        flag(outcome, "positive").alias("outcome_flag"),
        flag(fever, "yes").alias("has_fever"),
        flag(cough, "yes").alias("has_cough"),
        lvl(bp).alias("bp_encoded"),
        lvl(chol).alias("cholesterol_enc"),
        F.lit("disease").alias("source"),
        *([yes_count(yes_no_columns(stg, [c for c, t in stg.dtypes if t == "string"])).alias("symptom_count")]
          if opts.symptoms == "detect" else []),
        *([_qc(opts.order_col)] if opts.order_col in cols else []),
    ).filter(F.col("disease_name").isNotNull())
    order = _order(out, opts)
    if opts.elt_disease_key == "full_row":
        # distinct profiles (X6 alternative): patients that share disease,
        # age and gender but differ elsewhere stay separate rows
        raw_cols = [c for c in cols if c != opts.order_col]
        first = clean.dedupe_keep_first(stg, raw_cols, _order(stg, opts))
        return elt_clean_profiles(first, Options(**{**opts.__dict__, "elt_disease_key": "none"}), age_bounds)
    if opts.elt_disease_key == "group":
        out = clean.dedupe_keep_first(out, ["disease_name", "age", "gender_code"], order)
    if age:
        out = scale.minmax_scale(out, "age", "age_norm", eps=opts.scale_eps, scale=4,
                                 domain=staged.select(F.col("__age").alias("age")), bounds=age_bounds)
    else:
        out = out.withColumn("age_norm", F.lit(None).cast("double"))
    return out.select("disease_name", "age", "age_norm", "gender_code", "outcome_flag", "has_fever",
                      "has_cough", "bp_encoded", "cholesterol_enc", "source",
                      *[c for c in out.columns if c == "symptom_count"])


def elt_enrich_appointments(clean_ns: DataFrame, opts: Options, age_max=None) -> DataFrame:
    """enriched_no_show: exact |julian-day difference|, month, Sunday=0
    weekday, weekend flag (NULL date -> 0), age / (max age + 1e-4)."""
    sd = parse_timestamp(clean_ns, "scheduled_day")
    ad = parse_timestamp(clean_ns, "appointment_day")
    df = clean_ns.withColumns({"__sd": sd, "__ad": ad})
    w = wait_days_calendar("__sd", "__ad") if opts.wait == "calendar" else wait_days("__sd", "__ad", None)
    dow = day_of_week("__ad", "sunday")
    df = df.withColumns({
        "wait_days": F.when(F.col("__sd").isNotNull() & F.col("__ad").isNotNull(), w),
        "appt_month": month_of("__ad"),
        "appt_day_of_week": dow,
        "is_weekend": weekend_flag(dow, "sunday"),
    }).drop("__sd", "__ad")
    return scale.max_scale(df, "age", "age_norm_elt", eps=1e-4, scale=4, known_max=age_max)


def elt_enrich_profiles(clean_ds: DataFrame, opts: Options, age_max=None) -> DataFrame:
    """enriched_disease: symptom_count = fever + cough, unless every yes/no
    column was counted before; age_norm_elt."""
    df = clean_ds
    if "symptom_count" not in df.columns:
        df = df.withColumn("symptom_count", flag_sum(["has_fever", "has_cough"]))
    return scale.max_scale(df, "age", "age_norm_elt", eps=1e-4, scale=4, known_max=age_max)


def elt_fact(enr_ns: DataFrame, enr_ds: DataFrame, dim_source: DataFrame, opts: Options,
             assign_ids: bool = True) -> DataFrame:
    """fact_medical_elt: both branches in fact layout (source id by a
    constant join, outcome id, CASE age groups), unioned; fact ids dense
    over the union."""
    opts = _of_elt(opts)
    group = age_group_case("age", default=opts.age_group_default, null_value=opts.age_group_null).alias("age_group_id")

    def outcome(flag):
        return st.outcome_id(F.col(flag), F.col("source"), opts.outcome_mode).alias("outcome_id")

    ns = st.const_join(enr_ns, dim_source, "source_name", "no_show", ["source_id"])
    ns = ns.select(
        F.col("source_id").cast("int").alias("source_id"),
        outcome("no_show_flag"),
        group,
        "age", "age_norm", "gender_code", F.col("no_show_flag").alias("outcome_flag"),
        *[F.col(c).cast("double").alias(c) for c in
          ("comorbidity_count", "wait_days", "appt_month", "appt_day_of_week", "is_weekend")],
        *[F.lit(None).cast("double").alias(c) for c in
          ("symptom_count", "has_fever", "has_cough", "bp_encoded", "cholesterol_enc")],
        F.lit(schemas.NOT_AVAILABLE).alias("disease_name"),
        F.col("appointment_id").try_cast("long").alias("__key"),
    )
    ds = st.const_join(enr_ds, dim_source, "source_name", "disease", ["source_id"])
    ds = ds.select(
        F.col("source_id").cast("int").alias("source_id"),
        outcome("outcome_flag"),
        group,
        "age", "age_norm", "gender_code", "outcome_flag",
        *[F.lit(None).cast("double").alias(c) for c in
          ("comorbidity_count", "wait_days", "appt_month", "appt_day_of_week", "is_weekend")],
        *[F.col(c).cast("double").alias(c) for c in
          ("symptom_count", "has_fever", "has_cough", "bp_encoded", "cholesterol_enc")],
        "disease_name",
        F.lit(None).cast("long").alias("__key"),
    )
    fact = cf.union_all(ns, ds)
    elt_cols = [c for c in schemas.FACT_COLUMNS if c != "record_id"]
    if not assign_ids:
        return fact.select(*[c for c in elt_cols if c != "fact_id"])
    first = ["source_id", "__key", "disease_name", "age", "gender_code"]
    rest = [c for c in elt_cols if c != "fact_id" and c not in first]  # makes the order total
    fact = cf.dense_ids(fact, first + rest, "fact_id")
    return fact.select(*elt_cols)


def run_elt(appointments: DataFrame, profiles: DataFrame, opts: Options | None = None,
            base: str | None = None, assign_ids: bool = True, batch: str | None = None) -> Result:
    """Extract -> land raw in the lake -> staging -> dimensions -> clean ->
    enrich -> fact -> checks -> (reports over ``result.star``).

    With ``base``: ``lake/raw_*``, ``warehouse/{clean_*,enriched_*,
    fact_medical_elt,dim_*}`` and ``audit``; the staging views have names of
    their own in every run (``Result.views``). ``batch`` as in ``run_etl``.
    """
    opts = _of_elt(opts or Options())
    log = StageLog()
    spark = appointments.sparkSession
    stages = {"extract_no_show": appointments, "extract_disease": profiles}
    stg = {"no_show": appointments, "disease": profiles}
    sources = tuple(stg)
    bounds, raw_rows, clean_rows, views = {}, {}, {}, {}
    warehouse = f"{base}/warehouse"
    if base:
        # landing the raw rows also yields their number and the raw age range
        # the scaling needs (observed during the write, no second pass)
        def land_raw(s):
            age = resolve(stg[s].columns, "age", exact=True)
            number = F.expr(f"try_cast(`{age}` AS DOUBLE)") if age else None
            got, back = _land(stg[s], f"{base}/lake", f"raw_{s}", batch, {"mn": F.min(number), "mx": F.max(number)} if age else None)
            if age and got["mn"] is not None:
                bounds[s] = (got["mn"], got["mx"])
            raw_rows[s] = got["rows"]
            return back

        stg = dict(zip(sources, log.timed("lake_raw", lambda: parallel([lambda s=s: land_raw(s) for s in sources]))))
        for s in sources:
            log.rows(f"extract_{s}", raw_rows[s])
        if opts.staging_copy:
            stg = dict(zip(sources, log.timed("staging", lambda: parallel([
                lambda s=s: files.land(stg[s], warehouse, f"stg_{s}") for s in sources]))))
        # otherwise staging tables are the landed lake files themselves
        # (external tables): no second copy of the raw rows
        run = uuid.uuid4().hex
        for s in sources:
            views[f"stg_{s}"] = f"stg_{s}_{run}"
            stg[s].createOrReplaceTempView(views[f"stg_{s}"])
    dims = st.Star.with_literal_dims(stg["no_show"], with_description=False)
    cleaned = {"no_show": elt_clean_appointments(stg["no_show"], opts, bounds.get("no_show")),
               "disease": elt_clean_profiles(stg["disease"], opts, bounds.get("disease"))}
    top = {}
    if opts.checkpoint:
        # the stored (or cut) clean table also yields its rows and max(age),
        # the scale of age_norm_elt
        def keep(s):
            want = {"mx": F.max(F.col("age").cast("double"))}
            if base:
                got, back = _land(cleaned[s], warehouse, f"clean_{s}", batch, want)
            else:
                back, got = checkpoint(cleaned[s], observe={"rows": F.count(F.lit(1)), **want})
            top[s], clean_rows[s] = got["mx"], got["rows"]
            return back

        cleaned = dict(zip(sources, log.timed("clean", lambda: parallel([lambda s=s: keep(s) for s in sources]))))
        for s in sources:
            log.rows(f"clean_{s}", clean_rows[s], raw_rows.get(s))
    stages.update(clean_no_show=cleaned["no_show"], clean_disease=cleaned["disease"])
    enriched = {"no_show": elt_enrich_appointments(cleaned["no_show"], opts, top.get("no_show")),
                "disease": elt_enrich_profiles(cleaned["disease"], opts, top.get("disease"))}
    if base and opts.store_enriched:
        done = log.timed("enrich", lambda: parallel([lambda s=s: _land(enriched[s], warehouse, f"enriched_{s}", batch) for s in sources]))
        for s, (got, back) in zip(sources, done):
            log.rows(f"enrich_{s}", got["rows"])
            enriched[s] = back
    stages.update(enriched_no_show=enriched["no_show"], enriched_disease=enriched["disease"])
    fact = log.timed("fact", lambda: elt_fact(enriched["no_show"], enriched["disease"], dims.dim_source, opts, assign_ids))
    star = st.Star(fact, dims.dim_source, dims.dim_outcome, dims.dim_age_group)
    if base:
        star = load_star(star, warehouse, "fact_medical_elt", log, batch, schemas.FACT_ELT if assign_ids else None)
        log.write(spark, base)
    stages["fact"] = star.fact
    report = quality.check_fact(star)
    return Result(star, None, report, stages, log, views)


def with_summary(star: st.Star, base: str | None = None, batch: str | None = None, fact_name: str = "fact_medical_elt") -> st.Star:
    """Materialise the report summary once (one pass over the fact) so the
    whole report set reads a table bounded by the report key domains. With
    ``base`` it is stored as ``marts/report_summary``; otherwise it is
    checkpointed. With ``batch`` only the rows of that batch of the stored
    fact are read: their summary becomes (or takes the place of) that batch
    of the stored one, which stays the summary of the whole fact."""
    from healthmart.plans.reports import build_summary
    spark = star.fact.sparkSession
    if batch is not None:
        mine = versions.read_version(spark, f"{base}/warehouse", fact_name, batches=[batch])
        summ = build_summary(st.Star(mine, star.dim_source, star.dim_outcome, star.dim_age_group))
    else:
        summ = build_summary(star)
    if base:
        _store(summ, f"{base}/marts", "report_summary", batch)
        summ = files.read_table(spark, f"{base}/marts", "report_summary")
    else:
        summ = checkpoint(summ)
    return st.Star(star.fact, star.dim_source, star.dim_outcome, star.dim_age_group, summ)


def write_reports(star: st.Star, out_dir: str, pipeline: str | None = None) -> DataFrame:
    """Export the dashboard report set, one CSV folder each, all
    computed from one materialised summary of the fact."""
    from healthmart.plans.reports import dashboard
    if star.summary is None:
        star = with_summary(star)
    return files.export_reports(dashboard(star, pipeline), out_dir, isolate_errors=True,
                                spark=star.fact.sparkSession)


def driver_inputs(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from healthmart.sources.tables import appointments, disease_profiles
    return appointments(spark, sf_dir), disease_profiles(spark, sf_dir)


def scratch_base(spark, name: str) -> str:
    """A folder for pipeline zones in the shared checkpoint folder, for
    callers that give none."""
    from healthmart.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/zones-{name}"
