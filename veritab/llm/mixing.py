"""Mixing sources to target weights: exponential keys, sorted within a source and
prefix-summed to the source's word budget (Efraimidis-Spirakis), after complete epochs.

Only DataFrame functions run here. A source may hold a third of all rows, so its rows
are never one group: keys are cut into buckets, word counts are summed per (source,
bucket) map-side, running sums go over the bucket totals, and only rows of one bucket are
sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import WORD_PATTERN, aliased
from veritab.sources.files import materialize

WEIGHTS = (5, 2, 1)   # by source in code point order, null last, repeating
MAX_REPEATS = 3       # no source is taken more often than this
BUCKETS = 4096        # key buckets of a source
SEED = "mix-1"
BROADCAST_ROWS = 500_000   # up to so many keys of repeated rows are broadcast; else they are joined by shuffle

# quality label -> weight of a document's key; unlabelled documents lie between
GOOD, UNLABELLED, POOR = 1.0, 0.5, 0.25


def word_count(text: str | Column = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def quality_weight(labels: DataFrame) -> DataFrame:
    """``(doc_id, weight)``, one row per labelled document."""
    return (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
            .groupBy("doc_id").agg(F.max("quality").alias("q"))
            .select("doc_id", F.when(F.col("q") >= 1, GOOD).otherwise(POOR).alias("weight")))


def _uniform(doc_id: str, seed: str) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone: reruns agree."""
    text = F.concat(F.lit(seed + "|"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    n = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (n.cast("double") + 1.0) / F.lit(float(2 ** 52 + 2))


def key_bucket(key: str, buckets: int = BUCKETS) -> Column:
    """Which of ``buckets`` ranges a key lies in, in the order of keys. Keys of weight w are below k with
    probability 1 - exp(-w k); the mean of that over the weights deals documents of any of them
    into buckets of like size."""
    below = 1.0 - sum((F.exp(F.col(key) * -w) for w in (GOOD, UNLABELLED, POOR)), F.lit(0.0)) / 3
    return F.least(F.floor(below * buckets), F.lit(buckets - 1)).cast("int")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    The weights share the total; what a capped source leaves is shared again by weight.
    That process ends at one level: target = min(cap, level * weight). Sorted by
    cap / weight, the level is read off running sums of integers. One row per source
    meets in these windows - the mix's own table, not the documents."""
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = (sizes.withColumn("place", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("w", w.cast("bigint"))
        .withColumn("cap", F.col("source_size") * max_repeats))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    level = ((F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             .cast("double")
             / F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)).cast("double"))
    leveled = (ranked.withColumn("level", level)
               .withColumn("fits", F.col("level") * F.col("w") <= F.col("cap"))
               .withColumn("at", F.row_number().over(by_ratio))
               .withColumn("final", F.min(F.when(F.col("fits"), F.struct("at", "level")))
                           .over(all_rows)["level"]))
    return leveled.select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"),
                F.coalesce(F.col("final") * F.col("w"), F.col("cap").cast("double"))).alias("target"))


def mix(docs: DataFrame, weight: DataFrame | None = None, *, seed: str = SEED,
        split_last: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, source, text_hash, size, source_size, target, taken)`` for every row of ``docs``.

    ``docs`` needs ``doc_id, text, source``; other columns are ignored. ``weight``
    is ``(doc_id, weight)``: a larger weight makes an early place, so the fractional
    part of the mix, likelier. A source takes ``floor(target / source_size)`` whole
    epochs of each document, then documents by ascending key until the rest of its
    budget is reached. The document on the edge gives only the words still missing
    (``split_last``), or comes whole if at least half of it fits.

    Null or empty texts have size 0 and are taken with 0 words; a null source is a
    source of its own; a null id draws the key of an empty id; equal keys are ordered
    by id, size and a hash of the text, so that a rerun takes the same words; an empty table
    gives an empty result.
    """
    base = docs.select("doc_id", "source", word_count().alias("size"),
                       F.xxhash64("text").alias("text_hash"))
    if weight is None:
        base = base.withColumn("weight", F.lit(UNLABELLED))
    else:
        base = (base.join(weight.select("doc_id", "weight"), "doc_id", "left")
                .withColumn("weight", F.coalesce("weight", F.lit(UNLABELLED))))
    key = -F.log(_uniform("doc_id", seed)) / F.col("weight")
    base = base.withColumn("key", key)
    base = materialize(base.withColumn("bucket", key_bucket("key", buckets)).drop("weight"), "mix-keys")

    # one row per (source, bucket): the words before it, and its source's target
    totals = base.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(totals.groupBy("source").agg(F.sum("words").alias("source_size")))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (totals.withColumn("start", F.coalesce(F.sum("words").over(upto), F.lit(0)))
              .alias("b").join(targets.alias("t"),
                               F.col("b.source").eqNullSafe(F.col("t.source")))
              .select(F.col("b.source").alias("s"), F.col("b.bucket").alias("k"),
                      "start", "source_size", "target"))
    joined = base.join(starts, F.col("source").eqNullSafe(F.col("s"))
                       & (F.col("bucket") == F.col("k")))
    inside = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "text_hash")
              .rowsBetween(Window.unboundedPreceding, -1))
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    placed = (joined
              .withColumn("epochs", F.least(epochs, F.lit(MAX_REPEATS)).cast("bigint"))
              .withColumn("budget", F.round(F.col("target")).cast("bigint")
                          - F.col("epochs") * F.col("source_size"))
              .withColumn("left", F.col("budget") - F.col("start")
                          - F.coalesce(F.sum("size").over(inside), F.lit(0))))
    part = F.greatest(F.lit(0), F.least("size", "left")) if split_last else \
        F.when(F.col("left") * 2 >= F.col("size"), F.col("size")).otherwise(0)
    return placed.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + part).cast("bigint").alias("taken"))


def repeat_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` with each row as often as a whole-document mix takes it (0 to 3 times). Documents without
    words take no budget and stay once.

    Rows equal in id, text and source are taken as often as all of them together; where they
    differ in another column, it is one of them that is repeated. They are few keys, whose
    rows tasks cut to one each before any shuffle."""
    key = ["doc_id", "source", "text_hash"]
    once = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(1)
    times = materialize(mixed.groupBy(*key).agg(F.sum(once).cast("int").alias("times"), F.count("*").alias("rows")),
                        "mix-times")
    rows, at, back = aliased(docs)
    rows = rows.withColumn("hash", F.xxhash64(at["text"]))

    def taken(some: DataFrame) -> DataFrame:
        return rows.join(some, F.col(at["doc_id"]).eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
                         & F.col(at["source"]).eqNullSafe(F.col("source"))).where("times > 0")

    out = taken(times.where("rows = 1"))
    several = times.where("rows > 1")
    n = several.count()
    if n:
        if n <= BROADCAST_ROWS:
            several = F.broadcast(several)
        out = out.unionByName(taken(several).dropDuplicates(["doc_id", "source", "text_hash"]))
    return back(out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))))
