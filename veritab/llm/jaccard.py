"""N-gram Jaccard join: shingles are hashed into groups, a document's group counts are a
point, an R-tree over points bounds overlaps by summed coordinate minima, and the pairs that
survive are verified on the whole sets.

Which points meet in a tree is decided by a partitioning that loses no link: shingles get one
global order, those with rare words first, and two sets that link must share one of the first
``n - ceil(0.85 n) + 1`` shingles of each. So every shingle of these prefixes is a cell, and
pairs are sought within cells only. Components need connections, not all pairs:

1. each member of a cell is paired with the cell's first and last member, the pairs are
   bounded, verified, and joined to components - this connects groups of copies of any size
   in time linear in their rows;
2. cells that still hold several components are searched with R-trees for pairs across
   components, whose survivors are verified in the same way. A large cell is dealt into
   hashed tiles, and a task searches one pair of tiles; first each tile by itself, then pairs
   of tiles at growing distances, with the components joined anew before each pass, so that
   what earlier passes have linked is not searched again.

A pair is to be found in the first cell it shares only. There, its places in the two sets bound
what can be common (this cell and what is left of the smaller rest), and a pair that has one
of the ``BACK`` shingles before the cell in common as well is passed over: it was in an
earlier cell.

Whole sets are made twice rather than written: once for the points and prefixes of all documents,
once more, from their texts, for those of the pairs that have to be verified.

Equal sets are one node throughout. Shingles are told apart by 44 bits of a hash (and the
rarity class): two given sets of 1000 shingles agree by chance in one with probability 6e-8.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.llm.common import Scratch, aliased, arrow_rows, components, lean, map_texts, ship
from veritab.sources.files import materialize

WORDS = 4                  # words of a shingle, unless a caller says otherwise
PERCENT = 85               # sets link from this percentage of common shingles, likewise
GROUPS = 64                # coordinates of a point; of a long text's, four times as many, or 16 ...
PER_GROUP = 24             # ... so that no more shingles than this fall into a group on average
LEAF = 16                  # points of a tree's leaf
COMMON_WORDS = 200_000     # bound: words with a rarity class; all others are rarest
LOCAL_MIN = 4              # uses within a task from which a word is counted
WORD_CACHE = 200_000       # words whose hash a worker remembers (memory only)
BROADCAST_ROWS = 500_000   # up to so many 8-byte ids are broadcast; else they are joined by shuffle
KEY_BYTES = 6
CELL_ROWS = 2048           # members from which a cell is dealt into tiles of about so many
PAIR_ROWS = 16_384         # pairs a search holds before it writes them
SET_ROWS = 256             # sets, or pairs of sets, that a Python worker is handed at a time
MANY = 64                  # members of a cell from which likeliest partners are verified before all pairs
BACK = 16                  # shingles before a cell by which pairs of earlier cells are known


def split_words(text: str) -> list[bytes]:
    """A-Z in lower case; words between space and the controls 9 to 13 (what splitting
    and lower-casing of byte strings do)."""
    return text.encode().lower().split()


# -------------------------------------------------------------- rarity classes

def word_levels(docs: DataFrame, bound: int = COMMON_WORDS) -> dict[int, int]:
    """Word hash to rarity class 1 to 15 of the ``bound`` words that most documents have:
    doubling document counts from the rarest of them. All texts are counted. The classes
    only order shingles: any order gives the same links, this one small cells."""
    schema = T.StructType.fromDDL("word bigint, n bigint")

    def count(batches):
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        held: Counter = Counter()

        def flush():
            rows = [(xxh64_intdigest(w), n) for w, n in held.items() if n >= LOCAL_MIN]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array([r[0] for r in rows], np.uint64).view(np.int64)),
                 pa.array([r[1] for r in rows], pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column("text"):
                held.update(set(split_words(text.as_py() or "")))
                if len(held) > 250_000:
                    yield flush()
        yield flush()

    ship(docs.sparkSession)
    top = (docs.select("text").mapInArrow(lean(count), schema).groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.col("n").desc(), "word").limit(bound).toArrow())
    if not top.num_rows:
        return {}
    n = top.column("n").to_numpy()
    level = np.minimum(15, 1 + np.log2(n // n.min()).astype(np.int64))
    return dict(zip(top.column("word").to_numpy().view(np.uint64).tolist(), level.tolist()))


# ------------------------------------------------------------------- shingles

class Shingler:
    """Sorted distinct shingle keys of a text: the class of its rarest word, then a hash."""

    def __init__(self, levels: dict[int, int], words: int = WORDS):
        from xxhash import xxh64_intdigest

        self.words = words

        class Known(dict):
            def __missing__(self, word):
                if len(self) > WORD_CACHE:
                    self.clear()
                h = xxh64_intdigest(word)
                self[word] = v = (h & ~15) | levels.get(h, 0)
                return v
        self.known = Known()

    def __call__(self, text: str) -> np.ndarray:
        words = split_words(text)
        h = np.array(list(map(self.known.__getitem__, words)), np.uint64)
        if not len(h):
            return h
        level = h & np.uint64(15)
        n = min(self.words, len(h))
        last = len(h) - n + 1
        low, mix = level[:last], np.full(last, n, np.uint64)
        for k in range(n):
            low = np.minimum(low, level[k:k + last])
            mix = mix * np.uint64(0x9E3779B97F4A7C15) + h[k:k + last]
        mix ^= mix >> np.uint64(31)
        mix *= np.uint64(0xBF58476D1CE4E5B9)
        mix ^= mix >> np.uint64(29)
        return np.unique((low << np.uint64(60)) | (mix >> np.uint64(4)))


def to_bytes(keys: np.ndarray) -> bytes:
    """The upper six bytes of each key, big-endian: order is kept."""
    return keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def from_bytes(data: bytes) -> np.ndarray:
    raw = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    raw[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return raw.view(">u8")[:, 0].astype(np.int64)


def point(keys: np.ndarray) -> np.ndarray:
    """How many shingles fall into each group. By chance two texts of n shingles have
    common minima of about n - 0.56 sqrt(n * groups): a bound that tells them apart needs
    groups in proportion to n."""
    groups = GROUPS
    while groups * PER_GROUP < len(keys):
        groups *= 4
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.bincount((mixed >> np.uint64(65 - groups.bit_length())).astype(np.int64),
                       minlength=groups).astype("<u4")


def fold(data: bytes, groups: int = GROUPS) -> np.ndarray:
    """A point's counts over fewer groups: each takes up a run of the finer ones."""
    fine = np.frombuffer(data, "<u4")
    return fine if len(fine) == groups else fine.reshape(groups, -1).sum(1)


def most_common(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Summed minima of pairs of points, over the groups of the coarser one of each."""
    out = np.zeros(len(a), np.int64)
    size = np.array([min(len(x), len(y)) // 4 for x, y in zip(a, b)], np.int64)
    for groups in np.unique(size):
        for some in np.array_split(at := np.flatnonzero(size == groups), 1 + len(at) * int(groups) // 500_000):
            x, y = (np.array([fold(p[i], int(groups)) for i in some]).reshape(-1, int(groups)) for p in (a, b))
            out[some] = np.minimum(x, y).sum(1)
    return out


def prefix_size(n, percent: int = PERCENT):
    return n - (percent * n + 99) // 100 + 1


def overlap_needed(total, percent: int = PERCENT):
    """Least common shingles of two linked sets with ``total`` shingles together."""
    return -(-percent * total // (100 + percent))


def linked(a: np.ndarray, b: np.ndarray, na: int, nb: int, percent: int = PERCENT) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (na + nb - common)


# --------------------------------------------------------------------- R-tree

class Tree:
    """A bulk-loaded R-tree: halves along the widest coordinate, boxes of greatest counts,
    least size and whether one component fills it."""

    __slots__ = ("top", "least", "most", "rows", "kids", "only")

    def __init__(self, points, sizes, comps, rows):
        here = points[rows]
        self.top = here.max(0)
        self.least, self.most = int(sizes[rows].min()), int(sizes[rows].max())
        first = comps[rows[0]]
        self.only = int(first) if (comps[rows] == first).all() else None
        self.rows, self.kids = rows, ()
        if len(rows) > LEAF:
            axis = int((self.top - here.min(0)).argmax())
            order = rows[np.argsort(here[:, axis], kind="stable")]
            half = len(order) // 2
            self.kids = (Tree(points, sizes, comps, order[:half]), Tree(points, sizes, comps, order[half:]))

    def apart(self, other: "Tree", percent: int) -> bool:
        """True if no link can join the two boxes."""
        if self.only is not None and self.only == other.only:
            return True
        if 100 * self.most < percent * other.least or 100 * other.most < percent * self.least:
            return True
        most = int(np.minimum(self.top, other.top).sum())
        return most < overlap_needed(self.least + other.least, percent)


def search(points: np.ndarray, sizes: np.ndarray, comps: np.ndarray,
           percent: int = PERCENT, split: int | None = None):
    """Yields rows of the pairs that may link and lie in different components, about
    ``PAIR_ROWS`` at a time; with ``split``, those between the rows before it and the others."""
    if not len(points) or split in (0, len(points)):
        return
    cut = [np.arange(len(points))] if split is None else np.split(np.arange(len(points)), [split])
    roots = [Tree(points, sizes, comps, rows) for rows in cut]
    found, held, todo = [], 0, [(roots[0], roots[-1])]
    while todo:
        a, b = todo.pop()
        if a.apart(b, percent):
            continue
        if a is b and a.kids:
            x, y = a.kids
            todo += [(x, x), (y, y), (x, y)]
        elif a.kids or b.kids:
            if a.kids and (not b.kids or len(a.rows) >= len(b.rows)):
                todo += [(k, b) for k in a.kids]
            else:
                todo += [(a, k) for k in b.kids]
        else:
            i, j = a.rows[:, None], b.rows[None, :]
            common = np.minimum(points[a.rows][:, None, :], points[b.rows][None, :, :]).sum(2)
            ok = (common >= overlap_needed(sizes[i] + sizes[j], percent)) & (comps[i] != comps[j])
            if a is b:
                ok &= i < j
            r, c = np.nonzero(ok)
            if len(r):
                found.append((a.rows[r], b.rows[c]))
                held += len(r)
            if held >= PAIR_ROWS:
                yield tuple(np.concatenate(x) for x in zip(*found))
                found, held = [], 0
    if found:
        yield tuple(np.concatenate(x) for x in zip(*found))


# ----------------------------------------------------------------------- join

def restrict(table: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``table`` with (``left_semi``) or without (``left_anti``) their key among
    ``keys``, joined on all columns of the latter; keys are broadcast while they are few,
    else joined by shuffle."""
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return table.join(keys, keys.columns, how)


def matched(table: DataFrame, keyed: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``table`` joined with a written table that has one row a key: broadcast while that is small,
    else by a shuffle in which Spark can split a key that most rows of ``table`` have."""
    return table.join(F.broadcast(keyed) if keyed.count() <= BROADCAST_ROWS // 2 else keyed, on, how)


def bounded(pairs: DataFrame, points: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose points allow a link."""
    def keep(batches):
        import pyarrow as pa

        for b in batches:
            n = [b.column(c).to_numpy() for c in ("na", "nb")]
            if not len(n[0]):
                continue
            p = [b.column(c).to_pylist() for c in ("pa", "pb")]
            ok = ((most_common(*p) >= overlap_needed(n[0] + n[1], percent))
                  & (100 * np.minimum(*n) >= percent * np.maximum(*n)))
            yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(ok)) for c in ("a", "b")],
                                             names=["a", "b"])

    one = points.select(F.col("uid").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    two = points.select(F.col("uid").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(lean(keep), "a bigint, b bigint")


def whole_sets(rows: DataFrame, wanted: DataFrame, levels: dict[int, int], words: int) -> DataFrame:
    """``(uid, n, keys)`` of the sets of ``wanted(uid, k1, k2)``, made from the texts of ``rows`` again; of
    repeated rows a task makes the first."""
    schema = T.StructType([T.StructField("uid", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("keys", T.BinaryType())])

    def make(batches):
        import pyarrow as pa

        shingles, seen = Shingler(levels, words), set()
        for b in batches:
            out = []
            for k, uid in enumerate(b.column("uid").to_pylist()):
                if uid not in seen:
                    seen.add(uid)
                    keys = shingles(b.column("text")[k].as_py() or "")
                    out.append((uid, len(keys), to_bytes(keys)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(
                    zip(*out), (pa.int64(), pa.int64(), pa.binary()))], names=schema.names)

    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    return (rows.select("text", "k1", "k2").join(wanted, ["k1", "k2"]).select("uid", "text")
            .mapInArrow(lean(make), schema).dropDuplicates(["uid"]))


def verified(pairs: DataFrame, sets: "Sets", scratch: Scratch, percent: int = PERCENT) -> DataFrame:
    """The pairs that link, compared on their whole sets. Only sets of these pairs are made and move,
    and a task holds one batch of pairs."""
    pairs = scratch.keep(pairs, "join-pairs")

    def keep(batches):
        import pyarrow as pa

        held: tuple = (None, None)
        for b in batches:
            cols = [b.column(c) for c in ("a", "b", "na", "nb")]
            a, c, na, nb = [x.to_pylist() for x in cols]
            ok = []
            for i in range(len(a)):
                if held[0] != a[i]:
                    held = (a[i], from_bytes(b.column("sa")[i].as_py()))
                ok.append(linked(held[1], from_bytes(b.column("sb")[i].as_py()), na[i], nb[i],
                                 percent))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([x.filter(mask) for x in cols[:2]], names=["a", "b"])

    ids = scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct(), "join-ids")
    wanted = scratch.keep(restrict(sets.table.select("uid", "k1", "k2"), ids, "left_semi"), "join-wanted")
    with arrow_rows(sets.table.sparkSession, SET_ROWS):
        some = scratch.keep(whole_sets(sets.rows, wanted, sets.levels, sets.words), "join-sets")
        one = some.select(F.col("uid").alias("a"), F.col("n").alias("na"), F.col("keys").alias("sa"))
        two = some.select(F.col("uid").alias("b"), F.col("n").alias("nb"), F.col("keys").alias("sb"))
        links = pairs.join(one, "a").join(two, "b").mapInArrow(lean(keep), "a bigint, b bigint")
        links = scratch.keep(links, "join-links")
    scratch.drop("join-pairs", "join-ids", "join-wanted", "join-sets")
    return links


def passes(tiles: int):
    """Least and greatest distance of the tiles searched in each pass: 0, 1, 2 to 3, 4 to 7 ...
    Tiles stand in a ring, so that none is farther than half of them from another."""
    lo, hi = 0, 0
    while lo <= tiles // 2:
        yield lo, hi
        lo, hi = hi + 1, 2 * hi + 1


def tiled(cells: DataFrame, lo: int, hi: int) -> DataFrame:
    """``cells(cell, uid, members, ..)`` with the pairs of tiles ``(a, b)`` each member is
    searched in, and ``mine``, its own tile: those of distance ``lo`` to ``hi``. A cell of up
    to ``CELL_ROWS`` members is one tile."""
    tiles = F.ceil(F.col("members") / CELL_ROWS).cast("int")
    far = lambda t: F.least(F.pmod(t - F.col("mine"), tiles), F.pmod(F.col("mine") - t, tiles))
    return (cells.where(F.floor(tiles / 2) >= lo)
            .withColumn("mine", F.pmod(F.xxhash64("uid"), tiles).cast("int"))
            .withColumn("other", F.explode(F.filter(F.sequence(F.lit(0), tiles - 1),
                                                    lambda t: far(t).between(lo, hi))))
            .withColumn("a", F.least("mine", "other")).withColumn("b", F.greatest("mine", "other")).drop("other"))


def cross_pairs(cells: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs of ``tile_pairs``."""
    return tile_pairs(cells, percent)


def nearest_pairs(cells: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of ``tile_pairs``, for every set its likeliest partner only. What these connect is not searched
    again: many near copies give as many pairs, not the square of it."""
    return tile_pairs(cells, percent, True)


def tile_pairs(cells: DataFrame, percent: int, nearest: bool = False) -> DataFrame:
    """R-tree search within every pair of tiles of ``(cell, a, b, mine, uid, n, point, comp, place, back)``
    for pairs across components whose first common cell this can be. A task holds one pair of
    tiles, and writes pairs as they are found."""
    def run(batches):
        import pyarrow as pa

        def pairs(rows):
            if not rows:
                return
            uid, n, comp = (np.array([r[k] for r in rows], np.int64) for k in (4, 5, 7))
            rest = n - np.array([r[8] for r in rows], np.int64)   # of each set, from this shingle on
            back = np.full((len(rows), BACK), -1, np.int64)
            for k, r in enumerate(rows):
                back[k, :len(r[9]) // KEY_BYTES] = from_bytes(r[9])
            other_back = np.where(back < 0, -2, back)
            own, other = rows[0][1:3]
            split = None if own == other else sum(r[3] == own for r in rows)
            for i, j in search(np.array([fold(r[6]) for r in rows]), n, comp, percent, split):
                ok = np.minimum(rest[i], rest[j]) >= overlap_needed(n[i] + n[j], percent)
                i, j = i[ok], j[ok]
                met = [(back[i[at:at + 4096], :, None] == other_back[j[at:at + 4096], None, :]).any((1, 2))
                       for at in range(0, len(i), 4096)]
                new = ~np.concatenate(met) if met else np.zeros(0, bool)
                i, j = i[new], j[new]
                fine = most_common([rows[k][6] for k in i], [rows[k][6] for k in j])
                ok = fine >= overlap_needed(n[i] + n[j], percent)
                i, j, fine = i[ok], j[ok], fine[ok]
                if nearest and len(i):
                    both, at = np.concatenate([i, j]), np.tile(np.arange(len(i)), 2)
                    order = np.lexsort((-(fine / (n[i] + n[j]))[at], both))
                    first = np.unique(both[order], return_index=True)[1]
                    i, j = i[keep := np.unique(at[order][first])], j[keep]
                r, c = uid[i], uid[j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(r, c)), pa.array(np.maximum(r, c))],
                                                 names=["a", "b"])

        tile, held = None, []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in columns]):
                if row[:3] != tile:
                    yield from pairs(held)
                    tile, held = row[:3], []
                held.append(row)
        yield from pairs(held)

    columns = ["cell", "a", "b", "mine", "uid", "n", "point", "comp", "place", "back"]
    return (cells.select(*columns).repartition("cell", "a", "b")
            .sortWithinPartitions("cell", "a", "b", "mine").mapInArrow(lean(run), "a bigint, b bigint"))


@dataclass
class Sets:
    """The shingle sets of some rows: ``table`` has for each row its ``uid``, the ``keep`` columns, the set's
    size ``n``, ``same`` (a 128-bit hash of it), ``prefix`` and ``point``, and the row's key ``(k1, k2)``, by
    which ``rows`` has its text."""

    table: DataFrame
    rows: DataFrame
    levels: dict[int, int]
    words: int


def row_keys(doc_id, text) -> dict:
    return {"k1": F.xxhash64(doc_id, text), "k2": F.xxhash64(F.lit(1), text, doc_id)}


def shingle_table(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, keep=("doc_id",)) -> Sets:
    """The sets of ``docs(text, k1, k2, ..)``; the table is written to the shared folder."""
    levels = word_levels(docs)

    def make():
        from xxhash import xxh3_128_digest

        shingles = Shingler(levels, words)

        def work(texts):
            out = []
            for t in texts:
                keys = shingles(t)
                cut = to_bytes(keys)
                out.append((len(keys), xxh3_128_digest(keys.tobytes()),
                            cut[:KEY_BYTES * prefix_size(len(keys), percent)] if len(keys) else b"",
                            point(from_bytes(cut)).tobytes()))
            return [list(c) for c in zip(*out)] if out else [[]] * 4
        return work

    made = map_texts(docs, make, "n bigint, same binary, prefix binary, point binary",
                     keep=[*keep, "k1", "k2"])
    table = materialize(made.withColumn("uid", F.monotonically_increasing_id()), "shingles")
    return Sets(table, docs, levels, words)


def members(unique: DataFrame) -> DataFrame:
    """``(cell, uid, place)``: a row for every shingle of every prefix, with its place in the set."""
    def explode(batches):
        import pyarrow as pa

        for b in batches:
            held = [from_bytes(data) for data in b.column("prefix").to_pylist()]
            if held:
                size = [len(x) for x in held]
                uid = np.repeat(b.column("uid").to_numpy(), size)
                place = np.arange(len(uid)) - np.repeat(np.cumsum([0, *size[:-1]]), size)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held)), pa.array(uid), pa.array(place)],
                                                 names=["cell", "uid", "place"])

    return unique.select("uid", "prefix").mapInArrow(lean(explode), "cell bigint, uid bigint, place bigint")


def classes(sets: Sets, percent: int = PERCENT) -> DataFrame:
    """``(uid, class)`` of every set that is not empty; the class is the least uid that is
    reachable by links."""
    spark = sets.table.sparkSession
    scratch = Scratch(spark)
    ship(spark)
    some = sets.table.where("n > 0")
    first = scratch.keep(some.groupBy("same").agg(F.min("uid").alias("rep"), F.count("*").alias("rows"))
                         .where("rows > 1").select("same", "rep"), "join-same")
    node = materialize(matched(some.select("uid", "same"), first, "same", "left")
                       .select("uid", F.coalesce("rep", "uid").alias("rep")), "set-nodes")
    scratch.drop("join-same")
    unique = restrict(some, node.where("uid <> rep").select("uid"), "left_anti")
    points = unique.select("uid", "n", "point", "prefix")
    back = F.expr(f"substring(prefix, greatest(0, place - {BACK}) * {KEY_BYTES} + 1, least(place, {BACK}) * {KEY_BYTES})")

    member = members(unique)
    cells = scratch.keep(member.groupBy("cell").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi"),
                                                    F.count("*").alias("members")).where("members > 1"), "join-cells")
    # all that is left to search, and little of it: most shingles are in one set only
    entries = scratch.keep(matched(member, cells, "cell"), "join-entries")
    # of up to three members these are all pairs
    pair = F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("uid").alias("b")),
                             F.struct(F.col("uid").alias("a"), F.col("hi").alias("b"))))
    stars = entries.select(pair.alias("p")).select("p.a", "p.b").where("a <> b").distinct()
    one = verified(bounded(stars, points, percent), sets, scratch, percent)

    links = one
    largest = cells.agg(F.max("members")).first()[0] or 0
    comp = F.coalesce("c", "uid")
    for lo, hi in passes(-(-largest // CELL_ROWS)):
        least = CELL_ROWS if lo else 3
        for search_of, members_over in ((nearest_pairs, max(least, MANY)), (cross_pairs, least)):
            if largest <= members_over:
                continue
            comps = components(links).select(F.col("id").alias("uid"), F.col("component_id").alias("c"))
            large = (entries.where(F.col("members") > members_over).select("cell", "uid", "place", "members")
                     .join(comps, "uid", "left").withColumn("comp", comp).drop("c"))
            mixed = scratch.keep(large.groupBy("cell").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
                                 .where("c0 <> c1").select("cell"), "join-mixed")
            labelled = (matched(large, mixed, "cell").join(points, "uid")
                        .withColumn("back", back.cast("binary")).drop("prefix"))
            with arrow_rows(spark, CELL_ROWS):
                across = scratch.keep(search_of(tiled(labelled, lo, hi), percent), "join-across")
            links = links.unionByName(verified(across.distinct(), sets, scratch, percent))
            scratch.drop("join-mixed", "join-across")

    final = components(links).select(F.col("id").alias("rep"), F.col("component_id").alias("class"))
    scratch.drop("join-cells", "join-entries", "join-links")
    return node.join(final, "rep", "left").select("uid", F.coalesce("class", "rep").alias("class"))


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row.

    Null and empty texts, and texts without words, have no shingles and are alone; repeated
    rows link as equal sets; the component is its smallest id that is not null. Other
    columns are ignored; an empty table gives an empty result."""
    scratch = Scratch(docs.sparkSession)
    rows, at, _ = aliased(docs)
    doc_id, text = F.col(at["doc_id"]), F.col(at["text"])
    rows = rows.select(doc_id.alias("doc_id"), text.alias("text")).withColumns(row_keys(F.col("doc_id"), F.col("text")))
    sets = shingle_table(rows, words, percent)
    own = scratch.keep(sets.table.select("uid", "doc_id", "n").join(classes(sets, percent), "uid", "left"), "join-classes")
    # most classes are one row, whose id is the answer; only the others are joined
    least = scratch.keep(own.where("class IS NOT NULL").groupBy("class")
                         .agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
                         .where("rows > 1").select("class", "least", F.lit(True).alias("several")), "join-least")
    return matched(own, least, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("several"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of linked texts: that of least id (rows without
    an id come last; of rows equal in id and text any one). Texts without words stay.

    Only ids and 128-bit row keys go through the join; the rows themselves are read again
    and lose those whose key is on the list to drop."""
    scratch = Scratch(docs.sparkSession)
    rows, at, back = aliased(docs)
    doc_id, text = F.col(at["doc_id"]), F.col(at["text"])
    rows = rows.withColumns(row_keys(doc_id, text))
    sets = shingle_table(rows.select(doc_id.alias("doc_id"), text.alias("text"), "k1", "k2"), words, percent)
    keyed = sets.table.select("uid", "doc_id", "k1", "k2").join(classes(sets, percent), "uid")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid", "k1", "k2"))
    best = keyed.groupBy("class").agg(first.alias("w")).select("w.k1", "w.k2")
    counted = keyed.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    counted = scratch.keep(counted.join(best.withColumn("best", F.lit(True)), ["k1", "k2"], "left"), "row-keys")
    left = restrict(rows, counted.where("best IS NULL").select("k1", "k2"), "left_anti")
    repeated = counted.where("best AND copies > 1").select("k1", "k2")
    once = restrict(left, repeated, "left_anti")
    return back(once.unionByName(restrict(left, repeated, "left_semi").dropDuplicates(["k1", "k2"])))
