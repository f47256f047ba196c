"""Column functions: text patterns, safe numerics, display formats."""

from veritab.functions.display import count_text, money_text, percent_text
from veritab.functions.numeric import money_sum, ratio
from veritab.functions.text import (
    ADDRESS_PATTERN,
    ZIP_PATTERN,
    extract_first,
    not_matching,
    strip_pattern,
)

__all__ = [
    "ADDRESS_PATTERN", "ZIP_PATTERN", "count_text", "extract_first",
    "money_sum", "money_text", "not_matching", "percent_text", "ratio", "strip_pattern",
]
