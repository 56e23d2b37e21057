"""Column builders made of Spark built-ins only, so every plan stays in generated code."""

from tallybook.functions.dates import day_parts, month_key, month_label, parse_date, parse_timestamp
from tallybook.functions.numbers import (
    money_text,
    not_negative,
    parse_number,
    ratio,
    round2,
    share_pct,
)
from tallybook.functions.text import (
    blank_to_null,
    sanitize,
    strip,
    title_case,
    truncate,
    upper_code,
)

__all__ = [
    "blank_to_null",
    "day_parts",
    "money_text",
    "month_key",
    "month_label",
    "not_negative",
    "parse_date",
    "parse_number",
    "parse_timestamp",
    "ratio",
    "round2",
    "sanitize",
    "share_pct",
    "strip",
    "title_case",
    "truncate",
    "upper_code",
]
