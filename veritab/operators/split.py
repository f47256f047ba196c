"""Pattern split of a text column into (rest, match)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from veritab.functions.text import ZIP_PATTERN, extract_first, strip_pattern


def split_pattern(df: DataFrame, column: str, into: str, pattern: str = ZIP_PATTERN) -> DataFrame:
    """Add ``into`` = first match of ``pattern`` in ``column`` ('' if none) and
    replace ``column`` by the text with every match removed. Both are computed
    from the original value in a single projection."""
    return df.withColumns({into: extract_first(column, pattern),
                           column: strip_pattern(column, pattern)})
