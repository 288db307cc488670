"""Column -> Column building blocks shared by the operators."""

from tidewater.functions.metrics import (
    age_band,
    age_years,
    int_div,
    remainder_percent,
    truncated_percent,
)
from tidewater.functions.text import (
    all_script_tokens_match,
    all_tokens_match,
    doc_id,
    json_field,
    mask_phone,
    script_keyword_tokens,
    script_tokens,
    token_list,
    tokens,
)
from tidewater.functions.time import (
    date_part_of,
    day_after,
    day_before,
    day_bounds_ms,
    day_bounds_ts,
    epoch_ms,
    format_datetime,
    hour_part_of,
    log_date,
    log_hour,
    minute_key,
    ms_to_timestamp,
    or_default,
    today,
)

__all__ = [
    "age_band", "age_years", "int_div", "remainder_percent", "truncated_percent",
    "all_script_tokens_match", "all_tokens_match", "doc_id", "json_field", "mask_phone", "script_keyword_tokens",
    "script_tokens", "token_list", "tokens",
    "date_part_of", "day_after", "day_before", "day_bounds_ms", "day_bounds_ts", "epoch_ms",
    "format_datetime", "hour_part_of", "log_date", "log_hour", "minute_key",
    "ms_to_timestamp", "or_default", "today",
]
