"""Explicit schemas for the three logical tables (no inference at read time).

Ids and counts are 64-bit so that derived keys (order key * 10 + line number)
and per-person totals never overflow at large scale factors.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

EMPLOYEE_CALLS = "Employee_calls"
EMPLOYEE_DETAILS = "Employee_details"
SALES_DETAILS = "Sales_details"

CALLS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("area", T.StringType()),
        T.StructField("calls_made", T.LongType()),
        T.StructField("calls_successful", T.LongType()),
    ]
)

DETAILS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("sales_amount", T.DoubleType()),
    ]
)

SALES_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("caller_id", T.LongType()),
        T.StructField("company", T.StringType()),
        T.StructField("recipient", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("product_sold", T.StringType()),
        T.StructField("quantity", T.LongType()),
    ]
)


@dataclass(frozen=True)
class DatasetSpec:
    """Contract of one input table: its schema plus what the basic checks expect."""

    name: str
    schema: T.StructType
    key: str = "id"
    expected_rows: int | None = None
    non_negative: tuple[str, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


# The expected row counts and non-negative columns of the
# original call-centre input contract.
CALLS_SPEC = DatasetSpec(EMPLOYEE_CALLS, CALLS_SCHEMA, expected_rows=1000,
                         non_negative=("calls_made", "calls_successful"))
DETAILS_SPEC = DatasetSpec(EMPLOYEE_DETAILS, DETAILS_SCHEMA, expected_rows=1000,
                           non_negative=("sales_amount",))
SALES_SPEC = DatasetSpec(SALES_DETAILS, SALES_SCHEMA, expected_rows=10000,
                         non_negative=("quantity", "age"))

SPECS = {s.name: s for s in (CALLS_SPEC, DETAILS_SPEC, SALES_SPEC)}


def require_columns(df, columns, where: str = "DataFrame") -> None:
    """Raise ``ValueError`` naming every column of ``columns`` missing from ``df``.

    Uses the analysed schema only, so no Spark job runs.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{where} has no column {', '.join(missing)}")
