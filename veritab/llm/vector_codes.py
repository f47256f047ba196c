"""Product codes of integer vectors, with an exact nearest-entry search by slices and bitmasks.

A vector is cut into equal parts, each part replaced by the index of the nearest entry of its
position's codebook. A codebook has at most 64 entries, so a set of entries is one 64-bit
word. Along every dimension the entries' coordinates stand sorted, and beside each place the
mask of all entries before it: the entries within a radius of a coordinate are a slice of that
order, and its mask is that of the slice's end without that of its start. Masks of all
dimensions are ANDed; what is left are the only entries that can lie within the radius.

The initial radius is the distance of the best of a few entries, each the neighbour of the
part along one dimension. The nearest entry lies within it in every dimension, so no second
radius is ever needed; all arithmetic is on integers, and ties go to the lower index.

Training reads all vectors in every round: tasks assign their parts and send sums and counts
of the entries' cells, whose size does not depend on the rows. Only the codebooks, ``parts x
entries`` rows of sums and a few counters reach the driver.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.llm.common import Scratch, aliased, lean, ship

PARTS = 16
ENTRIES = 64               # of a codebook: the bits of a mask
ROUNDS = 2
SCALE = 256                # a component x becomes floor(SCALE * x)
LARGEST = 2 ** 26          # bound of a scaled component: squared distances stay below 2^63
BLOCK = 4096               # parts whose masks are held at a time
BROADCAST_ROWS = 500_000   # up to so many labels are broadcast; else they are joined by shuffle


class Slices:
    """A codebook (entries x dimensions, integers) ready to be searched."""

    def __init__(self, book: np.ndarray):
        self.book = book = np.asarray(book, np.int64)
        entries, dims = book.shape
        if not 0 < entries <= 64:
            raise ValueError("a codebook has 1 to 64 entries")
        self.order = np.argsort(book, axis=0, kind="stable")
        self.along = np.take_along_axis(book, self.order, axis=0)
        self.prefix = np.zeros((entries + 1, dims), np.uint64)
        np.bitwise_or.accumulate(np.uint64(1) << self.order.astype(np.uint64), axis=0, out=self.prefix[1:])
        self.all = np.uint64(2 ** entries - 1)

    def radius(self, x: np.ndarray) -> np.ndarray:
        """No less than the distance of each part's nearest entry."""
        best = np.full(len(x), np.iinfo(np.int64).max)
        for d in range(x.shape[1]):
            at = np.searchsorted(self.along[:, d], x[:, d])
            for place in (at - 1, at):
                near = self.book[self.order[place.clip(0, len(self.book) - 1), d]]
                np.minimum(best, ((x - near) ** 2).sum(1), out=best)
        return np.sqrt(best).astype(np.int64) + 1 if x.shape[1] else np.zeros(len(x), np.int64)

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each part, the mask of entries within the radius along every dimension."""
        mask = np.full(len(x), self.all)
        for d in range(x.shape[1]):
            lo = np.searchsorted(self.along[:, d], x[:, d] - radius, "left")
            hi = np.searchsorted(self.along[:, d], x[:, d] + radius, "right")
            mask &= self.prefix[hi, d] & ~self.prefix[lo, d]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each part's nearest entry (the lowest of those) and its squared distance."""
        index = np.zeros(len(x), np.int64)
        best = np.full(len(x), np.iinfo(np.int64).max)
        for at in range(0, len(x), BLOCK):
            some = x[at:at + BLOCK]
            mask = self.candidates(some, self.radius(some))
            for e in range(len(self.book)):
                rows = np.flatnonzero(mask & np.uint64(1 << e))
                squared = ((some[rows] - self.book[e]) ** 2).sum(1)
                closer = squared < best[at + rows]
                rows = at + rows[closer]
                index[rows], best[rows] = e, squared[closer]
        return index, best


def assign(x: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``(rows x parts)`` indexes and squared distances."""
    parts = x.reshape(len(x), len(books), -1)
    found = [Slices(b).nearest(np.ascontiguousarray(parts[:, p])) for p, b in enumerate(books)]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _matrix(batch, width: int) -> np.ndarray:
    """The scaled integers of a batch's vectors."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, width)


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str | None,
           parts: int = PARTS) -> tuple[DataFrame, int]:
    """``(vec_id, label, v)`` of the vectors that get a code, and their length.

    Not those that are null or empty or hold null or non-finite components, nor those of a length
    that cannot be cut into the parts or differs from the most frequent one (the least of
    those)."""
    rows, at, _ = aliased(vectors)
    kept = rows.select(
        F.col(at[vec_id]).alias("vec_id"),
        (F.col(at[label]) if label else F.lit(None).cast("int")).alias("label"),
        F.col(at[embedding]).cast("array<double>").alias("v")).where(
        (F.size("v") > 0) & (F.size("v") % parts == 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    sizes = (kept.groupBy(F.size("v").alias("width"))
             .agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("most"))
             .orderBy(F.col("n").desc(), "width").limit(1).collect())
    if not sizes:
        return kept, 0
    width, _, most = sizes[0]
    if most * SCALE >= LARGEST or width // parts > 256:
        raise ValueError(f"components reach {most}, parts have {width // parts}: their squared distances "
                         "would not fit into 64 bits")
    return kept.where(F.size("v") == width), width


def learn(kept: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks, one for each part position, as lists of integer entries.

    They start as the parts of the vectors of least id (rows without an id come last, rows of
    one id in the order of their vectors); a round assigns all parts and moves every entry
    that is used to the floor of the mean of its parts."""
    first = (kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v")
             .limit(entries).collect())
    start = np.floor(np.array([r["v"] for r in first]) * SCALE).astype(np.int64)
    books = list(start.reshape(len(start), parts, -1).transpose(1, 0, 2))
    part_width, size = width // parts, len(first)

    def sums(books):
        def run(batches):
            import pyarrow as pa

            count = np.zeros((parts, size), np.int64)
            total = np.zeros((parts, size, part_width), np.int64)
            for batch in batches:
                x = _matrix(batch, width)
                index, _ = assign(x, books)
                x = x.reshape(len(x), parts, part_width)
                for p in range(parts):
                    count[p] += np.bincount(index[:, p], minlength=size)
                    np.add.at(total[p], index[:, p], x[:, p])
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, part_width)), pa.array(np.tile(np.arange(part_width), len(used))),
                 pa.array(total.reshape(-1, part_width)[used].ravel()),
                 pa.array(np.repeat(count.ravel()[used], part_width))], names=["cell", "place", "s", "n"])
        return run

    for _ in range(rounds):
        cells = (kept.select("v").mapInArrow(lean(sums(books)), "cell bigint, place bigint, s bigint, n bigint")
                 .groupBy("cell", "place").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())
        moved = np.array(books)
        for r in cells:
            moved[r["cell"] // size, r["cell"] % size, r["place"]] = r["s"] // r["n"]
        books = list(moved)
    return books


def books_digest(books: list[np.ndarray]) -> str:
    """Hash of all components by part, entry and place within the part."""
    return sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def encode(kept: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``(vec_id, label, code, error)``: two hex digits a part, and the squared distances
    summed over parts."""
    parts, width = len(books), len(books) * books[0].shape[1]
    out = T.StructType([kept.schema["vec_id"], kept.schema["label"],
                        T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            index, squared = assign(_matrix(batch, width), books)
            text = index.astype(np.uint8).tobytes().hex()
            codes = [text[k:k + 2 * parts] for k in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()),
                 pa.array(squared.sum(1))], names=["vec_id", "label", "code", "error"])

    return kept.mapInArrow(lean(run), out)


def decode(code: str, books: list[np.ndarray]) -> np.ndarray:
    """The integer vector a code stands for."""
    return np.concatenate([b[i] for b, i in zip(books, bytes.fromhex(code))])


def report(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
           label: str = "label") -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every vector that gets a code
    (see ``usable``). Repeated rows get a row each; null labels are one label; other columns
    are ignored; an empty table gives an empty result."""
    spark = vectors.sparkSession
    ship(spark)
    kept, width = usable(vectors, vec_id, embedding, label)
    if not width:
        return kept.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"),
                           F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = learn(kept, width)
    codes = Scratch(spark).keep(encode(kept, books), "vector-codes")
    total = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    if total.count() <= BROADCAST_ROWS:
        total = F.broadcast(total)
    return codes.join(total, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
