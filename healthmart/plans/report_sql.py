"""Oracle SQL of the reports: every report aggregates ``fact`` by ids first and
looks labels up in small tables afterwards.

The bodies follow the CTEs of ``oracle_sql`` (``fact`` and the dimensions).
Output column names and labels are fixed values of the reports.
"""

from __future__ import annotations

# Report labels.
WEEKDAYS = ("Minggu", "Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu")
DAY_TYPES = ("Hari Kerja", "Akhir Pekan")
GENDERS = ("Laki-laki", "Perempuan")
# Label of a waiting time above the first and up to the second bound.
WAITS = (("0 hari (sama hari)", -1, 0), ("1-7 hari", 0, 7), ("8-30 hari", 7, 30),
         ("31-60 hari", 30, 60), ("> 60 hari", 60, "'infinity'"))


def _labels(names) -> str:
    """A table (code, label) numbering ``names`` from 0."""
    return "(VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(names)) + ") AS l(code, label)"


def _per(keys: str, where: str = "true") -> str:
    """The fact by ``keys``: rows, and sum and count of each measure."""
    return f"""(SELECT {keys}, count(*) AS n, sum(outcome_flag) AS flags, count(outcome_flag) AS flag_n,
        sum(age) AS ages, count(age) AS age_n, min(age) AS age_lo, max(age) AS age_hi,
        sum(wait_days) AS waits, count(wait_days) AS wait_n,
        sum(comorbidity_count) AS ills, count(comorbidity_count) AS ill_n
 FROM fact WHERE {where} GROUP BY {keys}) AS g"""


def _mean(total: str, count: str, digits: int) -> str:
    return f"round({total} / nullif({count}, 0), {digits})"


SHARE = _mean("flags", "flag_n", 4)
PERCENT = "round(flags / nullif(flag_n, 0) * CAST(100 AS DOUBLE), 2)"
SOURCE = f"dim_source JOIN {_per('source_id')} USING (source_id)"
OUTCOME = f"dim_outcome JOIN {_per('outcome_id')} USING (outcome_id)"
AGES = f"dim_age_group JOIN {_per('age_group_id')} USING (age_group_id)"


def _appointments(key: str) -> str:
    return _per(key, f"source_id = 1 AND {key} IS NOT NULL")


def _top(k: int, where: str, name: str, count: str) -> str:
    return f"""SELECT disease_name AS {name}, n AS {count} FROM {_per('disease_name', where)}
QUALIFY row_number() OVER (ORDER BY n DESC, disease_name DESC) <= {k}"""


KPI = f"""SELECT n AS total_pasien, {SHARE} AS no_show_rate, {_mean('ages', 'age_n', 1)} AS avg_usia,
       {_mean('waits', 'wait_n', 1)} AS avg_wait_days, yes AS total_no_show, no AS total_show
FROM (SELECT count(*) AS n, sum(outcome_flag) AS flags, count(outcome_flag) AS flag_n,
             count(*) FILTER (outcome_flag = 1) AS yes, count(*) FILTER (outcome_flag = 0) AS no,
             sum(age) AS ages, count(age) AS age_n, sum(wait_days) AS waits, count(wait_days) AS wait_n FROM fact)"""

WAIT_TABLE = "(VALUES " + ", ".join(f"('{n}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for n, a, b in WAITS) + ") AS w(label, above, upto)"

REPORT_SQL = {
    "q10_kpi_summary": KPI,
    "q1_source_totals": f"SELECT source_name AS sumber, n AS total FROM {SOURCE}",
    "q2_outcome_share": f"""SELECT outcome_label AS outcome, n AS total, persen
FROM dim_outcome JOIN (SELECT outcome_id, n, round(n * CAST(100 AS DOUBLE) / sum(n) OVER (), 2) AS persen
                       FROM {_per('outcome_id')}) USING (outcome_id)""",
    "q3_age_by_outcome": f"""SELECT outcome_label AS outcome, {_mean('ages', 'age_n', 2)} AS rata_rata_usia,
       age_lo AS usia_min, age_hi AS usia_max FROM {OUTCOME} WHERE age_n > 0""",
    "q4_age_groups": f"""SELECT age_group_name AS kelompok_usia, age_min, age_max, n AS total, {SHARE} AS no_show_rate
FROM {AGES} ORDER BY age_min""",
    "q5_monthly_rate": f"""SELECT appt_month AS bulan, n AS total, CAST(flags AS BIGINT) AS jumlah_no_show,
       {PERCENT} AS no_show_rate_persen FROM {_appointments('appt_month')} ORDER BY bulan""",
    "q6_comorbidity_by_age": f"""SELECT age_group_name AS kelompok_usia, age_min,
       {_mean('ills', 'ill_n', 3)} AS rata_comorbidity, ill_n AS total FROM {AGES} WHERE ill_n > 0 ORDER BY age_min""",
    "q7_weekend_rate": f"""SELECT label AS jenis_hari, n AS total, {PERCENT} AS no_show_rate_persen
FROM {_appointments('is_weekend')} JOIN {_labels(DAY_TYPES)} ON code = is_weekend""",
    "q8_top10": _top(10, "source_id = 2 AND disease_name <> 'N/A'", "penyakit", "jumlah_kasus"),
    "q8_top15": _top(15, "source_id = 2 AND disease_name <> 'N/A'", "penyakit", "jumlah_kasus"),
    "q9_wait_by_outcome": f"""SELECT outcome_label AS outcome, {_mean('waits', 'wait_n', 2)} AS avg_wait
FROM {OUTCOME} WHERE wait_n > 0""",
    "q11_weekday_rate": f"""SELECT coalesce(label, 'Unknown') AS hari, appt_day_of_week AS urutan, n AS total,
       {PERCENT} AS no_show_rate_persen
FROM {_appointments('appt_day_of_week')} LEFT JOIN {_labels(WEEKDAYS)} ON code = appt_day_of_week ORDER BY urutan""",
    "q12_wait_bucket_rate": f"""SELECT label AS kategori_tunggu, CAST(sum(n) AS BIGINT) AS total,
       round(sum(flags) / nullif(sum(flag_n), 0) * CAST(100 AS DOUBLE), 2) AS no_show_rate_persen
FROM {_appointments('wait_days')} JOIN {WAIT_TABLE} ON wait_days > above AND wait_days <= upto
GROUP BY label, above ORDER BY above""",
    "q13_gender_rate": f"""SELECT coalesce(label, 'Lainnya') AS gender, n AS total, {PERCENT} AS no_show_rate_persen
FROM {_per('gender_code', 'source_id = 1')} LEFT JOIN {_labels(GENDERS)} ON code = gender_code""",
}

STAR_ROLLUP = f"""SELECT source_name, outcome_label, age_group_name, n AS total,
       {_mean('ages', 'age_n', 4)} AS avg_age, {SHARE} AS rate
FROM {_per('source_id, outcome_id, age_group_id')}
JOIN dim_source USING (source_id) JOIN dim_outcome USING (outcome_id) JOIN dim_age_group USING (age_group_id)"""

LOG_SQL = {
    "source_totals": f"SELECT source_name, n AS total FROM {SOURCE}",
    "outcome_totals": f"SELECT outcome_label, n AS total FROM {OUTCOME}",
    "avg_age_by_outcome": f"SELECT outcome_label, {_mean('ages', 'age_n', 2)} AS avg_age FROM {OUTCOME} WHERE age_n > 0",
    "age_group_totals": f"SELECT age_group_name, n AS total FROM {AGES} ORDER BY age_min",
    "monthly_rate": f"SELECT appt_month, {SHARE} AS no_show_rate FROM {_appointments('appt_month')} ORDER BY appt_month",
    "comorbidity_by_age": f"SELECT age_group_name, {_mean('ills', 'ill_n', 2)} AS avg_comorbidity FROM {AGES} WHERE ill_n > 0",
    "weekend_rate": f"SELECT is_weekend, {SHARE} AS no_show_rate, n AS total FROM {_appointments('is_weekend')}",
    "top10_diseases": _top(10, "source_id = 2", "disease_name", "total"),
    "avg_wait_by_outcome": f"SELECT outcome_label, {_mean('waits', 'wait_n', 2)} AS avg_wait FROM {OUTCOME} WHERE wait_n > 0",
}
