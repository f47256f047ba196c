"""Embedding near-duplicates: against double-precision cosines, the bounds, odd inputs."""

import numpy as np
import pytest

from veritab.llm import embed_dedup as e

SCHEMA = "vec_id long, embedding array<float>"


def clusters(rng, n, dim=16):
    """Random vectors, some with neighbours at cosines around the threshold."""
    x = rng.normal(size=(n, dim)).astype(np.float32)
    for k in range(0, n - 3, 4):
        x[k + 1] = x[k] + rng.normal(size=dim).astype(np.float32) * 0.45 * rng.random()
        x[k + 2] = x[k] * 3 + rng.normal(size=dim).astype(np.float32)
    return x


def brute(ids, x, threshold=0.9):
    x = np.asarray(x, np.float64)
    n = np.sqrt((x * x).sum(1))
    link = (x @ x.T) / np.outer(n, n) >= threshold
    np.fill_diagonal(link, False)
    comp = np.array(ids)
    while True:
        new = np.array([min(comp[k], comp[link[k]].min() if link[k].any() else comp[k]) for k in range(len(x))])
        if (new == comp).all():
            return link.sum(1), comp
        comp = new


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x = clusters(rng, 300).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    q, scale, length, error = e.quantise(unit)
    near = (q.astype(int) @ q.T.astype(int)) * np.outer(scale, scale)
    slack = np.outer(error, length) + np.outer(length, error) + np.outer(error, error) + 1e-12
    assert (np.abs(unit @ unit.T - near) <= slack).all() and slack.max() < 0.1
    wide = rng.integers(-127, 128, (5, 3000)).astype(np.int8)
    assert (e.products(wide, wide) == wide.astype(np.int64) @ wide.T.astype(np.int64)).all()


@pytest.mark.parametrize("same", [True, False])
def test_strips_find_just_the_links(same, monkeypatch):
    monkeypatch.setattr(e, "STRIP", 37)
    rng = np.random.default_rng(2)
    x = clusters(rng, 200).astype(np.float64)
    y = x if same else clusters(rng, 150).astype(np.float64)
    if not same:
        y[:40] = x[:40] * 2 + rng.normal(size=(40, 16)) * 0.5
    cos = (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    want = {(a, b) for a, b in zip(*np.nonzero(cos >= 0.9)) if not same or a != b}
    got = [(lo + a, b) for lo, r, c in e.link_strips(x, y, 0.9, same) for a, b in zip(r, c)]
    assert set(got) == want and len(got) == len(want) > 20


@pytest.mark.parametrize("tile", [50, 10_000])
def test_all_rows_match_brute_force(spark, tile):
    rng = np.random.default_rng(3)
    x = clusters(rng, 260)
    x[100:130] = x[100]                    # equal vectors
    x[200:240] = x[200] * 5 + rng.normal(size=(40, 16)).astype(np.float32) * 0.05   # a crowd
    ids = rng.permutation(1000)[:260]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA)
    n, comp = brute(ids, x)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in e.near_duplicates(df, tile=tile).collect()}
    assert got == {int(i): (int(a), int(c), bool(i == c)) for i, a, c in zip(ids, n, comp)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1e-20, 0.0]), (11, [-1.0, 0.0]), (12, [1e30, 0.0]),
            (13, [1.0, 0.0]), (13, [1.0, 0.0]), (None, [0.0, 1.0]), (-5, [-0.0, -1.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", uid int, copies int")
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in e.near_duplicates(df).collect())
    linked = {1, 2, 10, 12, 13}
    want = [(str(i), 5 if i in linked else 0, 1 if i in linked else i, i is not None and (i == 1 or i not in linked))
            for i, _ in rows]
    assert got == sorted(want)
    assert e.near_duplicates(df.limit(0)).collect() == []
