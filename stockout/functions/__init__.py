"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from stockout.functions.dates import day_after, month_days, month_days_of, parse_minute, yesterday
from stockout.functions.sizes import ordered_size_string, size_sort_key, strip_paren
from stockout.functions.text import broadcast_time_text, option_detail

__all__ = ["day_after", "month_days", "month_days_of", "parse_minute", "yesterday", "ordered_size_string",
           "size_sort_key", "strip_paren", "broadcast_time_text", "option_detail"]
