"""Display formatting as a last projection.

Java ``Formatter`` patterns (rounding HALF_UP on the shortest decimal form of a
double). A null value stays null instead of becoming the text "null".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three display patterns of the reports.
MONEY_FORMAT = "%,.2f"
PERCENT_FORMAT = "%.2f %%"
COUNT_FORMAT = "%,d"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fmt(pattern: str, c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string(pattern, c))


def money_text(c) -> Column:
    """1234.5 -> '1,234.50'."""
    return _fmt(MONEY_FORMAT, _col(c).cast("double"))


def percent_text(c) -> Column:
    """75.0 -> '75.00 %'."""
    return _fmt(PERCENT_FORMAT, _col(c).cast("double"))


def count_text(c) -> Column:
    """1500 -> '1,500'."""
    return _fmt(COUNT_FORMAT, _col(c).cast("bigint"))
