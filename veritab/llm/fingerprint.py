"""Document fingerprints: a homomorphic multiset hash over paragraphs.

Every paragraph is hashed to a wide vector; a document's fingerprint is the sum of its
paragraphs' vectors, each lane modulo a power of two. The order of paragraphs does not
matter, a paragraph is inserted or deleted by adding or subtracting its vector
(``combine``), and equal multisets have equal fingerprints. Only DataFrame functions
run here.

Layout: the number of paragraphs modulo 2^60, two sums of whole hashes modulo 2^60
(these make equality safe), then 60 words that each hold two counters modulo 2^30 of one
hash bit. A counter says how many paragraphs have that bit, so two fingerprints also
estimate how much of their multisets is common (``likeness``): with 120 counters the estimate's
standard error is at most 0.1.

So that an edit within a long paragraph leaves most of it as it was, a paragraph of more than
``LONG`` characters counts as runs of words: a run ends after a word whose hash says so, about
every ``RUN`` words, wherever else the text was changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A paragraph ends at a line break; long lines are cut after a sentence's end as well.
PARAGRAPH_BREAK = r"[\r\n]+|(?<=[.!?])[ \t]+"
LONG = 80                                        # characters of a paragraph that is one run
RUN = 8                                          # words of a run of a longer one, on average

SHIFTS = 30                                      # of each of the two hashes: bits k and k + 30
_ONES = 1 | 1 << 30
_LOW = (1 << 30) - 1
_SUM = (1 << 60) - 1
WORDS = 3 + 2 * SHIFTS
LANE = 6                                         # bits of a counter while up to BLOCK paragraphs are counted
BLOCK = 2 ** LANE - 1
_LANES = sum(1 << k for k in range(0, 2 * SHIFTS, LANE))
HEX = 15                                         # hex digits of one word


def paragraphs(text: Column) -> Column:
    whole = F.filter(F.split(text, PARAGRAPH_BREAK), lambda p: F.trim(p) != "")
    ends = lambda w: F.pmod(F.xxhash64(w), F.lit(RUN)) == 0
    runs = lambda p: F.split(F.array_join(F.transform(
        F.split(p, "[ \t]+"), lambda w: F.concat(w, F.when(ends(w), "\n").otherwise(" "))), ""), "\n")
    cut = F.flatten(F.transform(whole, lambda p: F.when(F.char_length(p) > LONG, runs(p)).otherwise(F.array(p))))
    return F.filter(F.transform(cut, lambda p: F.trim(p)), lambda p: p != "")


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` made once, however often ``use`` names it: Spark makes what
    stands in several array functions anew for each."""
    return F.transform(F.array(value), use)[0]


def fingerprint_words(text: Column) -> Column:
    """``array<bigint>`` of ``WORDS`` words for a text (null counts as empty)."""
    parts = paragraphs(F.coalesce(text, F.lit("")))
    hashes = F.transform(parts, lambda p: F.struct(F.xxhash64(p).alias("h"),
                                                   F.xxhash64(p, F.lit(1)).alias("g")))
    zero = F.lit(0).cast("bigint")

    def sums(acc: Column, x: Column) -> Column:
        return F.struct(*[(acc[c] + x[c].bitwiseAND(F.lit(_SUM))).bitwiseAND(F.lit(_SUM)).alias(c) for c in "hg"])

    def narrow(acc: Column, x: Column) -> Column:
        """Word k of each hash's ``LANE`` counts bits k, k + ``LANE``, ... in counters of ``LANE`` bits."""
        return F.array(*[acc[j * LANE + k] + F.shiftrightunsigned(x[c], k).bitwiseAND(F.lit(_LANES))
                         for j, c in enumerate("hg") for k in range(LANE)])

    def wide(acc: Column) -> Column:
        return F.array(*[F.shiftrightunsigned(acc[j * LANE + k % LANE], k - k % LANE).bitwiseAND(F.lit(BLOCK * _ONES))
                         for j in range(2) for k in range(SHIFTS)])

    def words(hashes: Column) -> Column:
        n = F.size(hashes)

        def block(i: Column) -> Column:
            some = F.slice(hashes, i * BLOCK + 1, F.lit(BLOCK))
            return _once(F.aggregate(some, F.array_repeat(zero, 2 * LANE), narrow), wide)

        # no text has so many paragraphs that a wide counter would reach the next before the end
        counted = F.aggregate(F.sequence(F.lit(0), F.floor(n / BLOCK).cast("int")), F.array_repeat(zero, 2 * SHIFTS),
                              lambda acc, i: F.zip_with(acc, block(i), lambda a, b: a + b))
        total = F.aggregate(hashes, F.struct(zero.alias("h"), zero.alias("g")), sums)
        return _once(total, lambda t: F.concat(F.array(n.cast("bigint"), t["h"], t["g"]), counted))

    return _once(hashes, words)


def _lanes(words: Column, one, two) -> Column:
    """``one`` of the three sums, ``two`` of every pair of counters."""
    return F.concat(F.transform(F.slice(words, 1, 3), one), F.transform(F.slice(words, 4, 2 * SHIFTS), two))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of two multisets together (``sign=1``) or of ``a`` without
    ``b`` (``sign=-1``): lane-wise sum modulo each lane's power of two."""
    if sign < 0:   # a + (2^k - b), lane by lane
        both = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
        low = lambda t: (t["x"].bitwiseAND(F.lit(_LOW)) + F.lit(_LOW + 1) - t["y"].bitwiseAND(F.lit(_LOW))
                         ).bitwiseAND(F.lit(_LOW))
        high = lambda t: (F.shiftright(t["x"], 30) + F.lit(_LOW + 1) - F.shiftright(t["y"], 30)
                          ).bitwiseAND(F.lit(_LOW))
        return _lanes(both, lambda t: (t["x"] + F.lit(_SUM + 1) - t["y"]).bitwiseAND(F.lit(_SUM)),
                      lambda t: F.shiftleft(high(t), 30).bitwiseOR(low(t)))
    summed = F.zip_with(a, b, lambda x, y: x + y)
    return _lanes(summed, lambda x: x.bitwiseAND(F.lit(_SUM)), lambda x: x.bitwiseAND(F.lit(_SUM)))


def to_text(words: Column) -> Column:
    """Lowercase hex, ``HEX`` digits a word."""
    return F.lower(F.array_join(F.transform(words, lambda w: F.lpad(F.hex(w), HEX, "0")), ""))


def counters(words: Column) -> Column:
    """The bit counters, each as twice its value less the number of paragraphs (a sum of signs)."""
    n = words[0]
    return F.flatten(F.transform(F.slice(words, 4, 2 * SHIFTS), lambda w: F.array(
        *[(c * 2 - n).cast("double") for c in (w.bitwiseAND(F.lit(_LOW)), F.shiftright(w, 30))])))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(words_a: str, words_b: str, signs_a: str, signs_b: str) -> Column:
    """0 to 1: estimated share of common paragraphs (2 common / both); 1 for equal
    fingerprints, 0 when just one is empty."""
    a, b = F.col(signs_a), F.col(signs_b)
    both = _dot(a, a) + _dot(b, b)
    estimate = F.when(both > 0, 2 * _dot(a, b) / both).otherwise(0.0)
    return (F.when(F.col(words_a) == F.col(words_b), 1.0)
            .when((F.col(words_a)[0] == 0) | (F.col(words_b)[0] == 0), 0.0)
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate))))


def fingerprint(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` for every row; a null text counts as empty."""
    return docs.select("doc_id", to_text(fingerprint_words(F.col("text"))).alias("fingerprint"))


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``(doc_id, text, next_text)``: each document with the text of the next one by descending id,
    after the last one the first. Equal ids are ordered by a hash of the text; null ids come last.

    No global window: ids are cut at approximate quantiles into buckets (found by halving), null
    ids by their texts' hash; a window runs inside each, and the last row of a bucket gets the
    first of the next non-empty one. What is broadcast is one id and hash a bucket."""
    spark = docs.sparkSession
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = base.select(F.percentile_approx(
        "doc_id", [i / n for i in range(1, n)], max(10000, 4 * n)).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    inner = F.array(*[F.lit(int(c)) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, len(cuts).bit_length())))])
    # how many cuts lie below the id: steps of half the size each that stay below it
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(inner, at + step - 1) < F.col("doc_id"), at + step).otherwise(at))
    base = base.withColumn("tie", F.xxhash64("text"))
    # null ids under all of them, by ranges of the hash
    null = F.floor(F.col("tie") / F.lit(float(2 ** 63 / n))).cast("int") - n - 1
    base = base.withColumn("bucket", F.when(F.col("doc_id").isNull(), null).otherwise(below))

    first = F.max(F.struct("doc_id", "tie"))
    heads = base.groupBy("bucket").agg(first.alias("head"))
    order = Window.orderBy(F.col("bucket").desc())   # one row a bucket
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = (heads.withColumn("after", F.coalesce(
        F.lead("bucket").over(order), F.first("bucket").over(everything)))
        .select("bucket", F.col("after")))
    head_texts = (base.alias("d").join(
        F.broadcast(heads.select(F.col("bucket").alias("hb"), F.col("head.doc_id").alias("hd"),
                                 F.col("head.tie").alias("ht"))),
        (F.col("d.bucket") == F.col("hb")) & F.col("d.doc_id").eqNullSafe(F.col("hd"))
        & (F.col("d.tie") == F.col("ht")))
        .dropDuplicates(["hb"])
        .select("hb", F.col("text").alias("head")))
    next_heads = (follows.join(head_texts, F.col("after") == F.col("hb"))
                  .select(F.col("bucket").alias("nb"), "head"))
    inside = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(),
                                                  F.col("tie").desc())
    rows = base.withColumn("inner_next", F.lead("text").over(inside))
    return (rows.join(next_heads, F.col("bucket") == F.col("nb"))
            .select("doc_id", "text", F.coalesce("inner_next", "head").alias("next_text")))


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half (rounded
    down) is replaced by the beginning of the next document."""
    d = with_next(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = (d.withColumn("edited", F.concat(
            F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
            F.substring("next_text", F.lit(1), half)))
         .withColumns({w: fingerprint_words(F.col(c)) for w, c in (("fw", "text"), ("ew", "edited"), ("nw", "next_text"))}))
    d = d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                 "fw", "ew", "nw", counters(F.col("fw")).alias("fs"),
                 counters(F.col("ew")).alias("es"), counters(F.col("nw")).alias("ns"))
    return d.select(
        "doc_id", "n_chars", "edited_sha256",
        to_text(F.col("fw")).alias("fingerprint"), to_text(F.col("ew")).alias("edited_fingerprint"),
        likeness("fw", "ew", "fs", "es").alias("near_edited"),
        likeness("fw", "nw", "fs", "ns").alias("near_next"))
