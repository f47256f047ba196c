"""What the operators on conversations share: rows as turns, in one order, streamed by key.

A conversation's digests are taken over its turns one after another, so its rows meet in one
task; they pass through it sorted (Spark's sort spills), and a task holds a row at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import aliased

ROWS = 256   # rows of whole texts that a Python worker is handed at a time


def turn_rows(df: DataFrame, null_text: str = "") -> DataFrame:
    """``(conv, conv_id, turn, role, text, a, b)`` of every row: ``conv`` is the conversation's key
    (null ids are one conversation), ``a`` and ``b`` hash role and text. Null roles and texts
    become ``null_text``. Turns are ordered by ``turn`` (nulls first), then ``a`` and ``b``."""
    rows, at, _ = aliased(df)
    rows = rows.select(F.col(at["conv_id"]).alias("conv_id"), F.col(at["turn"]).alias("turn"),
                       *[F.coalesce(F.col(at[c]), F.lit(null_text)).alias(c) for c in ("role", "text")])
    return rows.select(conv_key().alias("conv"), "*", F.xxhash64("role", "text").alias("a"),
                       F.xxhash64(F.lit(1), "text", "role").alias("b"))


def conv_key():
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def rows_of(batches, columns):
    """The rows of Arrow batches, one by one."""
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in columns])


def by_key(rows, width: int = 1):
    """Runs of neighbouring rows that agree in their first ``width`` values: ``(key, rows)``. A run's
    rows are read as they come; what is left of them is skipped before the next run."""
    from itertools import groupby

    yield from groupby(rows, key=lambda r: r[:width])


def write_batches(rows, schema, size: int = 4096):
    """Arrow batches of up to ``size`` rows."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(schema)

    def batch(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(zip(*held), fields)], schema=fields)

    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch(held)
            held = []
    if held:
        yield batch(held)
