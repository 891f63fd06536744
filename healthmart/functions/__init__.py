"""Column-level building blocks: name handling and scalar expressions."""

from healthmart.functions.columns import (  # noqa: F401
    normalize_names, resolve, resolve_all, columns_of_kind, yes_no_columns, schema_table,
)
from healthmart.functions.encode import (  # noqa: F401
    strip_text, norm_text, encode_binary, encode_codes, encode_gender, encode_ordinal,
    round_half_up, round_half_even,
)
from healthmart.functions.features import (  # noqa: F401
    parse_timestamp, wait_days, wait_days_calendar, day_of_week, month_of, hour_of, weekend_flag,
    row_sum, yes_count, flag_sum, bucket_by_ranges, age_group_case, wait_bucket, decode,
    weekday_name, gender_name, day_type_name,
)
