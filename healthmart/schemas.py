"""Input, conformed, fact and dimension layouts plus dimension literals."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Raw inputs -----------------------------------------------------------

APPOINTMENTS = T.StructType([
    T.StructField("PatientId", T.StringType()),
    T.StructField("AppointmentID", T.LongType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("ScheduledDay", T.StringType()),
    T.StructField("AppointmentDay", T.StringType()),
    T.StructField("Age", T.DoubleType()),
    T.StructField("Neighbourhood", T.StringType()),
    T.StructField("Scholarship", T.StringType()),
    T.StructField("Hipertension", T.StringType()),
    T.StructField("Diabetes", T.StringType()),
    T.StructField("Alcoholism", T.StringType()),
    T.StructField("Handcap", T.StringType()),
    T.StructField("SMS_received", T.StringType()),
    T.StructField("No-show", T.StringType()),
])

DISEASE_PROFILES = T.StructType([
    T.StructField("Disease", T.StringType()),
    T.StructField("Fever", T.StringType()),
    T.StructField("Cough", T.StringType()),
    T.StructField("Fatigue", T.StringType()),
    T.StructField("Difficulty Breathing", T.StringType()),
    T.StructField("Age", T.DoubleType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Blood Pressure", T.StringType()),
    T.StructField("Cholesterol Level", T.StringType()),
    T.StructField("Outcome Variable", T.StringType()),
])

# --- Conformed layout (17 columns) -----------------------------------------
# Measures that only one source has are nullable and stored as DOUBLE, as
# the warehouse declares them REAL; ids, codes and flags present for every
# row stay integers.

CONFORMED = T.StructType([
    T.StructField("record_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("age", T.DoubleType()),
    T.StructField("age_norm", T.DoubleType()),
    T.StructField("gender_code", T.IntegerType()),
    T.StructField("outcome_flag", T.IntegerType()),
    T.StructField("comorbidity_count", T.DoubleType()),
    T.StructField("wait_days", T.DoubleType()),
    T.StructField("appt_month", T.DoubleType()),
    T.StructField("appt_day_of_week", T.DoubleType()),
    T.StructField("is_weekend", T.DoubleType()),
    T.StructField("symptom_count", T.DoubleType()),
    T.StructField("has_fever", T.DoubleType()),
    T.StructField("has_cough", T.DoubleType()),
    T.StructField("bp_encoded", T.DoubleType()),
    T.StructField("cholesterol_enc", T.DoubleType()),
    T.StructField("disease_name", T.StringType()),
])

MEASURES = [f.name for f in CONFORMED.fields if f.name not in ("record_id", "source")]

FACT_KEYS = ["fact_id", "record_id", "source_id", "outcome_id", "age_group_id"]
FACT_COLUMNS = FACT_KEYS + MEASURES

# The stored fact: what the warehouse refuses to be without is not nullable.
# The SQL flow has no record_id.
FACT = T.StructType([
    T.StructField("fact_id", T.LongType(), False),
    T.StructField("record_id", T.LongType(), False),
    T.StructField("source_id", T.IntegerType(), False),
    T.StructField("outcome_id", T.IntegerType(), False),
    T.StructField("age_group_id", T.IntegerType()),
    *[CONFORMED[c] for c in MEASURES],
])
FACT_ELT = T.StructType([f for f in FACT.fields if f.name != "record_id"])

# --- Dimension literals ----------------------------------------------------
# Ids, names and bounds must equal the reference's star schema.

SOURCES = [
    (1, "no_show", "No-Show Appointments Brazil"),
    (2, "disease", "Disease Symptoms & Patient Profile"),
]

OUTCOMES = [
    (1, "No-Show / Negative"),
    (2, "Show / Positive"),
]

AGE_GROUPS = [
    (1, "0-12 (Anak)", 0, 12),
    (2, "13-17 (Remaja)", 13, 17),
    (3, "18-35 (Dewasa Muda)", 18, 35),
    (4, "36-59 (Dewasa)", 36, 59),
    (5, "60+ (Lansia)", 60, 120),
]

DIM_SOURCE = T.StructType([
    T.StructField("source_id", T.IntegerType(), False),
    T.StructField("source_name", T.StringType(), False),
    T.StructField("description", T.StringType()),
])
DIM_OUTCOME = T.StructType([
    T.StructField("outcome_id", T.IntegerType(), False),
    T.StructField("outcome_label", T.StringType(), False),
])
DIM_AGE_GROUP = T.StructType([
    T.StructField("age_group_id", T.IntegerType(), False),
    T.StructField("age_group_name", T.StringType(), False),
    T.StructField("age_min", T.IntegerType()),
    T.StructField("age_max", T.IntegerType()),
])

# Report labels (weekday names Sunday=0 .. Saturday=6, gender,
# day type and waiting-time buckets) as the reference's dashboards print them.
WEEKDAY_NAMES = ["Minggu", "Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu"]
WEEKDAY_UNKNOWN = "Unknown"
GENDER_NAMES = {0: "Laki-laki", 1: "Perempuan"}
GENDER_OTHER = "Lainnya"
DAY_TYPE = {1: "Akhir Pekan", 0: "Hari Kerja"}
WAIT_BUCKETS = [
    (0, "0 hari (sama hari)", "eq"),
    (7, "1-7 hari", "le"),
    (30, "8-30 hari", "le"),
    (60, "31-60 hari", "le"),
]
WAIT_BUCKET_ELSE = "> 60 hari"
NOT_AVAILABLE = "N/A"
UNKNOWN_TEXT = "Unknown"
