"""Row-level quality checks on files as they arrive (Structured Streaming).

The batch job checks whole tables. When the inputs arrive as a stream of
files, the row-level checks (non-null, non-negative, row rules, text patterns)
are additive over micro-batches, so each batch is checked on its own with the
same evaluator and the results are appended to a Parquet table, one folder
per batch. Checks that need the whole table at once (uniqueness, row count,
referential integrity) are rejected here; run them with the batch suite.

Each batch overwrites only its own ``batch_id=<n>`` folder, so a batch that is
re-run after a failure replaces its earlier output instead of doubling it; the
stream's checkpoint (in the shared checkpoint folder) records progress.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from veritab.operators.quality import ROW_LEVEL, Check, evaluate
from veritab.sources.files import make_dir, parse_cells, shared_dir


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                max_files_per_trigger: int | None = None, malformed: bool = False) -> DataFrame:
    """A file stream over ``path`` with a fixed schema.

    CSV files must carry a header with the columns of ``schema`` in that order - a
    file with another header fails its batch, it is never loaded by position - and their
    cells are read as in batch (``malformed`` lists those that are no value of their type)."""
    reader = spark.readStream.format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt != "csv":
        return reader.schema(schema).load(path)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = reader.schema(texts).option("header", True).option("enforceSchema", False).load(path)
    return parse_cells(raw, schema, malformed)


def watch(stream: DataFrame, dataset: str, checks: Sequence[Check], results_path: str,
          checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start checking every micro-batch of ``stream``; returns the running query."""
    checks = list(checks)
    wrong = [c.name for c in checks if c.kind not in ROW_LEVEL or c.dataset != dataset]
    if wrong:
        raise ValueError(f"not row-level checks of {dataset}: {', '.join(wrong)}")
    spark = stream.sparkSession
    checkpoint = checkpoint or shared_dir(spark, "quality-stream")
    make_dir(spark, results_path)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = evaluate({dataset: batch}, checks)
        out.write.mode("overwrite").parquet(os.path.join(results_path, f"batch_id={batch_id}"))

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


_RESULT_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("check_name", T.StringType()),
    T.StructField("column_name", T.StringType()), T.StructField("total", T.LongType()),
    T.StructField("violations", T.LongType()), T.StructField("passed", T.BooleanType()),
])


def totals(spark: SparkSession, results_path: str) -> DataFrame:
    """Violations and rows per check summed over every batch written so far. The results
    folder must exist (``watch`` makes it); one without a batch gives no rows."""
    try:
        results = spark.read.parquet(results_path)
    except AnalysisException as exc:
        if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":   # a folder without a file
            raise
        results = spark.createDataFrame([], _RESULT_SCHEMA)
    return (results
            .groupBy("dataset", "check_name", "column_name")
            .agg(F.sum("total").alias("total"), F.sum("violations").alias("violations"),
                 F.count(F.lit(1)).alias("batches"))
            .withColumn("passed", F.col("violations") == 0))
