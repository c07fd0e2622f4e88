from orderlens.functions.agg import collect_counted, concat_distinct, exact_avg, expand_counted
from orderlens.functions.text import extract_number, list_length, list_tokens, nullify
from orderlens.functions.time import elapsed_minutes, week_bucket, weekday_name

__all__ = [
    "collect_counted", "concat_distinct", "exact_avg", "expand_counted",
    "extract_number", "list_length", "list_tokens", "nullify",
    "elapsed_minutes", "week_bucket", "weekday_name",
]
