"""Embedding near-duplicates: int8 tile products with rigorous per-vector error bounds.

Every vector is scaled to length 1 and rounded to int8 on a scale of its own; how far the
rounded vector is from the true one is measured in double precision. Products of rounded
tiles are exact integers, and with the measured errors they bound every cosine from both
sides. Pairs that cannot reach the threshold are passed over, pairs that must reach it are
links, and only those in between are computed in double precision.

Equal vectors are one node with a count. Nodes are dealt at random into tiles of bounded
size; a task compares one pair of tiles and returns, per linked node, how many vectors it
links to and one edge to its root within the pair - never the pairs themselves. The
comparison of all with all is the method; nothing of it meets in one task or the driver.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import components, ship
from veritab.sources.files import materialize

THRESHOLD = 0.9
TILE = 8192      # nodes of a tile at most, about; two tiles are in a task's memory
STRIP = 512      # rows of a tile product that are held at once


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(q, scale, length, error)`` of rows of length 1: ``scale * q`` is within
    ``error`` of the row and has the given length."""
    scale = np.abs(x).max(1) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    # a little more than measured, for the rounding of the measurement itself
    return q, scale, np.linalg.norm(back, axis=1) * (1 + 1e-12), \
        np.linalg.norm(x - back, axis=1) + 1e-12


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows: partial sums stay below 2^24, where float32
    still holds every integer."""
    step = 2 ** 24 // (127 * 127)
    out = a[:, :step].astype(np.float32) @ b[:, :step].astype(np.float32).T
    for lo in range(step, a.shape[1], step):
        out = out.astype(np.float64) + a[:, lo:lo + step].astype(np.float32) \
            @ b[:, lo:lo + step].astype(np.float32).T
    return out


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return np.einsum("ij,ij->i", x, y) / np.sqrt(
        np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def link_strips(x: np.ndarray, y: np.ndarray, threshold: float, same: bool):
    """Yields ``(first row, rows, columns)`` of the links between rows of ``x`` and of
    ``y`` (with ``same``, of unequal places), a strip at a time."""
    unit = [v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None] for v in (x, y)]
    qx, sx, nx, ex = quantise(unit[0])
    qy, sy, ny, ey = quantise(unit[1])
    n_top, e_top = ny.max(), ey.max()
    for lo in range(0, len(x), STRIP):
        hi = min(lo + STRIP, len(x))
        raw = products(qx[lo:hi], qy) * sy.astype(np.float32)
        # a bound for the whole row first; float32's own rounding is in the last term
        floor = (threshold - ex[lo:hi] * n_top - (nx[lo:hi] + ex[lo:hi]) * e_top) / sx[lo:hi]
        r, c = np.nonzero(raw >= (floor - 1e-5 * np.abs(floor) - 1e-3)[:, None])
        if same:
            r, c = r[r + lo != c], c[r + lo != c]
        if not len(r):
            continue
        near = np.einsum("ij,ij->i", qx[lo + r].astype(np.int32), qy[c].astype(np.int32)) \
            * sx[lo + r] * sy[c]
        slack = ex[lo + r] * ny[c] + nx[lo + r] * ey[c] + ex[lo + r] * ey[c] + 1e-12
        sure = near - slack >= threshold
        open_ = np.flatnonzero(~sure & (near + slack >= threshold))
        for k in range(0, len(open_), 200_000):
            some = open_[k:k + 200_000]
            sure[some] = cosines(x[lo + r[some]], y[c[some]]) >= threshold
        if sure.any():
            yield lo, r[sure], c[sure]


def _roots(pairs_r: np.ndarray, pairs_c: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable from each of ``n`` nodes."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, pairs_r, root[pairs_c])
        np.minimum.at(root, pairs_c, root[pairs_r])
        root = root[root]
        if np.array_equal(before, root):
            return root


def compare_tiles(uid_x, x, count_x, uid_y, y, count_y, threshold: float, same: bool):
    """``(uid, links, root uid)`` of the nodes of two tiles that have a link in them."""
    links_x, links_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    shift = 0 if same else len(x)
    every_r, every_c = [], []
    for lo, r, c in link_strips(x, y, threshold, same):
        links_x += np.bincount(lo + r, count_y[c], len(x)).astype(np.int64)
        if not same:
            links_y += np.bincount(c, count_x[lo + r], len(y)).astype(np.int64)
        # a strip's links in short: every node with its root within the strip
        nodes, at = np.unique(np.concatenate([lo + r, shift + c]), return_inverse=True)
        root = _roots(at[:len(r)], at[len(r):], len(nodes))
        every_r.append(nodes)
        every_c.append(nodes[root])
    if not every_r:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    uid = uid_x if same else np.concatenate([uid_x, uid_y])
    links = links_x if same else np.concatenate([links_x, links_y])
    root = _roots(np.concatenate(every_r), np.concatenate(every_c), len(uid))
    own = np.flatnonzero(links > 0)
    return uid[own], links[own], uid[root[own]]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id,
    embedding)``; other columns are ignored.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do vectors of different lengths. Repeated rows are vectors of their own.
    A row without an id is answered with a null component and not kept."""
    spark = vectors.sparkSession
    value = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.select("vec_id", value.alias("v")).withColumn(
        "usable", F.coalesce(
            (F.size("v") > 0)
            & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
            & F.exists("v", lambda c: c != 0), F.lit(False)))
    usable = rows.where("usable").select("vec_id", "v", F.xxhash64("v").alias("h1"),
                                         F.xxhash64("v", F.lit(1)).alias("h2"))
    nodes = materialize(
        usable.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.count("*").alias("copies"),
                                       F.min("vec_id").alias("least"))
        .withColumn("uid", F.monotonically_increasing_id()), "vector-nodes")
    n = nodes.count()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = max(1, ceil(n / tile), min(ceil(sqrt(2 * width)), ceil(n / 64)))
    mine = F.pmod(F.xxhash64("uid"), F.lit(tiles)).cast("int")
    dealt = (nodes.select("uid", "copies", "v", F.size("v").alias("dim"), mine.alias("mine"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
             .withColumn("pair", F.struct("dim", F.least("mine", "other").alias("a"),
                                          F.greatest("mine", "other").alias("b")))
             .select("pair", "mine", "uid", "copies", "v"))
    schema = "uid bigint, links bigint, root bigint"

    def compare(key, table):
        import pyarrow as pa

        pair = key[0].as_py()
        mine = table.column("mine").to_numpy()
        uid = table.column("uid").to_numpy()
        copies = table.column("copies").to_numpy()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(len(uid), pair["dim"])
        left = np.flatnonzero(mine == pair["a"])
        same = pair["a"] == pair["b"]
        right = left if same else np.flatnonzero(mine == pair["b"])
        if not len(left) or not len(right):
            found = (np.zeros(0, np.int64),) * 3
        else:
            found = compare_tiles(uid[left], x[left], copies[left],
                                  uid[right], x[right], copies[right], threshold, same)
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("uid", "links", "root"), found)})

    ship(spark)
    part = materialize(dealt.repartitionByRange(tiles * (tiles + 1) // 2, "pair")
                       .groupBy("pair").applyInArrow(compare, schema), "vector-links")
    groups = components(part.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    least = (groups.join(nodes.select(F.col("uid").alias("id"), "least"), "id")
             .groupBy("component_id").agg(F.min("least").alias("component_least")))
    links = part.groupBy("uid").agg(F.sum("links").alias("links"))
    answers = (nodes.select("h1", "h2", "uid", "copies", "least")
               .join(links, "uid", "left")
               .join(groups.withColumnRenamed("id", "uid"), "uid", "left")
               .join(least, "component_id", "left")
               .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("component_least", "least").alias("component")))
    linked = usable.select("vec_id", "h1", "h2").join(answers, ["h1", "h2"]).select(
        "vec_id", "n_links", "component")
    alone = rows.where(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component"))
    return linked.unionByName(alone).select(
        "vec_id", "n_links",
        F.when(F.col("vec_id").isNotNull(), F.col("component")).cast("bigint").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"))
