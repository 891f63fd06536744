"""Row-level feature expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from healthmart import schemas
from healthmart.functions.encode import _c

MICROS_PER_DAY = 86_400_000_000.0


def parse_timestamp(df: DataFrame, name: str, fmt: str | None = None) -> Column:
    """Text -> timestamp, unparseable -> NULL (session zone is UTC).

    A column that already is a timestamp is passed through, a date is
    widened.
    """
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp")
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp")
    text = F.btrim(c.cast("string"))
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def wait_days(start, end, scale: int | None = 1) -> Column:
    """|end - start| in days; banker's rounding to ``scale`` digits
    (None keeps the exact value, as the SQL julian-day form)."""
    delta = F.abs(F.unix_micros(_c(end)) - F.unix_micros(_c(start))) / F.lit(MICROS_PER_DAY)
    return F.bround(delta, scale) if scale is not None else delta


def wait_days_calendar(start, end) -> Column:
    """X13 variant: |calendar days between the two dates|."""
    return F.abs(F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))).cast("double")


def day_of_week(c, base: str = "sunday") -> Column:
    """Day of week, Sunday=0..Saturday=6 or Monday=0..Sunday=6."""
    if base == "monday":
        return F.weekday(_c(c))
    return F.dayofweek(_c(c)) - 1


def month_of(c) -> Column:
    """M15."""
    return F.month(_c(c))


def hour_of(c) -> Column:
    """M16."""
    return F.hour(_c(c))


def weekend_flag(dow: Column, base: str = "sunday") -> Column:
    """1 for Saturday/Sunday, 0 otherwise and for NULL."""
    days = (0, 6) if base == "sunday" else (5, 6)
    return F.when(dow.isin(*days), 1).otherwise(0)


def row_sum(cols: list[str]) -> Column:
    """Row-wise sum of numeric-coerced columns, unparseable/NULL -> 0,
    truncated to int."""
    if not cols:
        return F.lit(0)
    parts = [F.coalesce(F.expr(f"try_cast(`{c}` AS DOUBLE)"), F.lit(0.0)) for c in cols]
    return reduce(lambda a, b: a + b, parts).cast("int")


def yes_count(cols: list[str]) -> Column:
    """Number of columns whose lower-cased text is 'yes'."""
    if not cols:
        return F.lit(0)
    parts = [F.when(F.lower(F.col(f"`{c}`")) == "yes", 1).otherwise(0) for c in cols]
    return reduce(lambda a, b: a + b, parts)


def flag_sum(cols: list) -> Column:
    """Plain sum of flag columns (NULL propagates)."""
    return reduce(lambda a, b: a + b, [_c(c) for c in cols])


def bucket_by_ranges(c, ranges, default=None, null_value=None) -> Column:
    """First closed range [lo, hi] containing the value, scanned
    by ascending lower bound; NULL -> ``null_value``; no match -> ``default``.

    ``ranges`` is a list of (id, lo, hi). Built as one CASE: the dimension
    is a fixed literal table, so nothing is collected or joined.
    """
    x = _c(c)
    out = F.when(x.isNull(), F.lit(null_value))
    for gid, lo, hi in sorted(ranges, key=lambda r: r[1]):
        out = out.when(x.between(lo, hi), F.lit(gid))
    return out.otherwise(F.lit(default)).cast("int")


def age_group_case(c, default=5, null_value=None) -> Column:
    """Age -> age_group_id over the fixed age-group dimension."""
    ranges = [(gid, lo, hi) for gid, _, lo, hi in schemas.AGE_GROUPS]
    return bucket_by_ranges(c, ranges, default=default, null_value=null_value)


def wait_bucket(c) -> Column:
    """Waiting-days label: =0, <=7, <=30, <=60, else."""
    x = _c(c)
    out = None
    for bound, label, op in schemas.WAIT_BUCKETS:
        cond = (x == bound) if op == "eq" else (x <= bound)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(schemas.WAIT_BUCKET_ELSE)


def decode(c, mapping: dict, default) -> Column:
    """Simple CASE decode of a code to a label."""
    x = _c(c)
    out = None
    for k, v in mapping.items():
        out = F.when(x == k, v) if out is None else out.when(x == k, v)
    return out.otherwise(default)


def weekday_name(c) -> Column:
    return decode(c, dict(enumerate(schemas.WEEKDAY_NAMES)), schemas.WEEKDAY_UNKNOWN)


def gender_name(c) -> Column:
    return decode(c, schemas.GENDER_NAMES, schemas.GENDER_OTHER)


def day_type_name(c) -> Column:
    return F.when(_c(c) == 1, schemas.DAY_TYPE[1]).otherwise(schemas.DAY_TYPE[0])
