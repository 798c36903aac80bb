from clickmart.functions.expressions import (
    cents,
    day_diff,
    default_text,
    guarded_ratio,
    is_type,
    minute_diff,
    money_avg,
    money_sum,
    pad_id,
    pick,
    safe_float,
    safe_int,
    segment,
    strength,
)
from clickmart.functions.sql_helpers import register_helpers
from clickmart.functions.variants import parameter, with_json, with_variant

__all__ = [
    "cents",
    "day_diff",
    "default_text",
    "guarded_ratio",
    "is_type",
    "minute_diff",
    "money_avg",
    "money_sum",
    "pad_id",
    "parameter",
    "pick",
    "register_helpers",
    "safe_float",
    "safe_int",
    "segment",
    "strength",
    "with_json",
    "with_variant",
]
