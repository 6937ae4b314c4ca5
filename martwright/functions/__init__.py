from .casts import null_if_token, strict_cast, text_or_empty, timestamp_or_null
from .names import title_case, title_case_columns
from .points import parse_point
from .text import count_or_zero, remove_literal, trailing_year
from .times import literal_like, month_of, year_of

__all__ = [
    "count_or_zero",
    "literal_like",
    "month_of",
    "null_if_token",
    "parse_point",
    "remove_literal",
    "strict_cast",
    "text_or_empty",
    "timestamp_or_null",
    "title_case",
    "title_case_columns",
    "trailing_year",
    "year_of",
]
