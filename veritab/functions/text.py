"""Text-pattern column functions (all JVM-side regex, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The postcode shape (four digits, a space, two capital letters),
# the full address layout "street, number, postcode" that the format check
# accepts, and the leading/trailing comma left behind once a postcode is cut out.
ZIP_PATTERN = r"\d{4} [A-Z]{2}"
ADDRESS_PATTERN = r"^[A-Za-z0-9-\s]+, \d+, \d{4} [A-Z]{2}$"
EDGE_COMMAS = r"^,\s*|,\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_first(c, pattern: str = ZIP_PATTERN) -> Column:
    """First match of ``pattern`` anywhere in ``c``; '' when none, null on null."""
    return F.regexp_extract(_col(c), f"({pattern})", 1)


def strip_pattern(c, pattern: str = ZIP_PATTERN) -> Column:
    """``c`` with every match of ``pattern`` (and a comma right after it) removed,
    then leading/trailing commas and spaces tidied away."""
    removed = F.regexp_replace(_col(c), pattern + r",?\s*", "")
    return F.trim(F.regexp_replace(removed, EDGE_COMMAS, ""))


def not_matching(c, pattern: str = ADDRESS_PATTERN) -> Column:
    """True where ``c`` is null or does not match ``pattern``."""
    c = _col(c)
    return c.isNull() | ~c.rlike(pattern)
