"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.sources.files import materialize_at, remove_dir, shared_dir

# Fixed value: what separates words in the size and shingle definitions
# (space and the ASCII controls 9 to 13).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Fixed value: rows with this remainder of crc32(doc_id as text) mod 4 are never learned from.
HELD_OUT = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read whole."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def held_out(doc_id="doc_id"):
    """True for rows kept out of every training sample (null ids count as '')."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 4 == HELD_OUT


def words(text: str) -> list[str]:
    return re.findall(WORD_PATTERN, text)


def bounded_sample(df: DataFrame, keys: list[str], per_key: int, order: list) -> DataFrame:
    """At most ``per_key`` rows of each key combination, chosen by ``order``.

    A rank filter directly on the window lets Spark cut every map task's
    rows to ``per_key`` a key before the shuffle, so a key that holds most of
    the table never meets in one task."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(w))
            .where(F.col("_rank") <= per_key).drop("_rank"))


def aliased(df: DataFrame):
    """``(renamed, names, back)``: ``df`` with its columns named by place, so that columns
    an operator adds never clash with any of them; where each name went (the first
    of that name); and a function that selects the columns under their names again."""
    plain = [f"_{i}" for i in range(len(df.columns))]
    names: dict[str, str] = {}
    for name, alias in zip(df.columns, plain):
        names.setdefault(name, alias)

    def back(result: DataFrame, **replaced) -> DataFrame:
        return result.select(*[replaced.get(n, F.col(p)).alias(n) for n, p in zip(df.columns, plain)])

    return df.toDF(*plain), names, back


class Scratch:
    """Tables that an operator writes to the shared folder on its way; ``drop`` removes
    those that nothing will read any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, list[str]] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_dir(self.spark, name)
        self.paths.setdefault(name, []).append(path)
        return materialize_at(df, path)

    def drop(self, *names: str) -> None:
        for name in names:
            for path in self.paths.pop(name, []):
                remove_dir(self.spark, path)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(a, b)`` of longs.

    Returns ``(id, component_id)`` for every node of at least one edge, the
    component being its smallest node. Alternates the large-star and small-star
    steps until every component is a star around its smallest node. Each step is
    an aggregate and a join on the node (a hub is pre-aggregated by map tasks and
    its join partition can be split); each round is written to the shared
    checkpoint folder, so the lineage stays short and a lost executor costs a
    re-read. Nothing but two counters reaches the driver.
    """
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    scratch = Scratch(edges.sparkSession)
    cur = scratch.keep(edges.select(lo.alias("lo"), hi.alias("hi"))
                       .where("lo <> hi").distinct(), "edges-0")
    for k in range(max_rounds):
        tangled = (cur.groupBy("hi").agg(F.count("*").alias("n")).where("n > 1")
                   .select(F.col("hi").alias("x"))
                   .unionByName(cur.join(cur.select(F.col("hi").alias("lo")), "lo", "left_semi")
                                .select(F.col("lo").alias("x"))))
        if tangled.limit(1).count() == 0:
            break
        both = cur.unionByName(cur.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        # large star: every larger neighbour of a node points to the node's smallest neighbour
        least = both.groupBy("lo").agg(F.min("hi").alias("m"))
        large = (both.join(least, "lo").where("hi > lo")
                 .select(F.least("m", "lo").alias("lo"), "hi").distinct())
        # small star: a node and its smaller neighbours point to the smallest of them
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        linked = large.join(down, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        cur = scratch.keep(linked.unionByName(down.select(F.col("m").alias("lo"), "hi"))
                           .where("lo <> hi").distinct(), f"edges-{k + 1}")
        scratch.drop(f"edges-{k}")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (cur.select(F.col("hi").alias("id"), F.col("lo").alias("component_id"))
            .unionByName(cur.select(F.col("lo").alias("id"), F.col("lo").alias("component_id"))
                         .distinct()))


TASK_ROWS = 1024   # rows whose texts and results a Python worker holds at a time

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once per application),
    so a caller need not have it on the cluster's path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(root):
        name = os.path.basename(root)
        archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, files in os.walk(root):
                for f in sorted(files):
                    if f.endswith(".py"):
                        path = os.path.join(folder, f)
                        z.write(path, os.path.join(name, os.path.relpath(path, root)))
        sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


_CACHES: list = []


def worker_cache(make):
    """``make(path)``, kept by a Python worker for its next tasks (the last one only)."""
    kept = lru_cache(1)(make)
    _CACHES.append((make.__module__, kept))
    return kept


def lean(run, module: str | None = None):
    """A function of Arrow batches whose tasks leave little in their worker, which Spark uses again for
    whatever comes next: what other modules' caches keep goes first, and at the end memory
    that is free goes back to the system."""
    module = module or run.__module__

    def work(batches):
        import sys

        for owner, kept in list(getattr(sys.modules.get("veritab.llm.common"), "_CACHES", [])):
            if owner != module:
                kept.cache_clear()
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()
    return work


def give_back() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):   # another C library
        pass


def map_texts(df: DataFrame, make, schema: str, keep=("doc_id",), text: str = "text",
              extra=()) -> DataFrame:
    """Run a text function over every row in Arrow batches.

    ``make()`` is called once in each task and returns a function from a list of whole
    texts (null as '') - and a list for each column of ``extra`` - to a list for each
    field of ``schema``. The ``keep`` columns pass through as they are."""
    from pyspark.sql import types as T

    added = T.StructType.fromDDL(schema)
    kept = T.StructType([df.schema[c] for c in keep])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(T.StructType(kept.fields + added.fields))
        work = make()
        for whole in batches:
            for lo in range(0, whole.num_rows, TASK_ROWS):
                batch = whole.slice(lo, TASK_ROWS)
                texts = ["" if x is None else x for x in batch.column(text).to_pylist()]
                got = work(texts, *[batch.column(c).to_pylist() for c in extra])
                arrays = [batch.column(c) for c in keep]
                arrays += [x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                           for x, f in zip(got, list(fields)[len(keep):])]
                yield pa.RecordBatch.from_arrays(
                    [a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, fields)],
                    schema=fields)
            whole = batch = texts = got = arrays = None
            pa.default_memory_pool().release_unused()

    ship(df.sparkSession)
    columns = list(dict.fromkeys([*keep, text, *extra]))
    return df.select(*columns).mapInArrow(lean(run, make.__module__), T.StructType(kept.fields + added.fields))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within it, Spark hands Python workers at most ``rows`` rows at a time: for actions
    on rows that are large by themselves. The session's own setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def chunks(texts: list[str], chars: int = 4_000_000):
    """Lists of neighbouring texts of about ``chars`` characters; a longer text is a
    list of its own. Bounds what a task holds of words at a time."""
    held: list[str] = []
    size = 0
    for t in texts:
        if held and size + len(t) > chars:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held
