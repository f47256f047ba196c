"""Vector codes: the bitmask search and the whole training against a plain version, odd inputs."""

from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veritab.llm import vector_codes as v

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_nearest(x, book):
    d = ((x[:, None, :] - book[None]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 64), st.integers(1, 6), st.integers(0, 10 ** 6), st.sampled_from([2, 40, 10 ** 6]))
def test_search_is_exact(entries, dims, seed, spread):
    rng = np.random.default_rng(seed)
    book = rng.integers(-spread, spread, (entries, dims))
    book[rng.integers(entries)] = book[0]                       # a repeated entry: the lower index wins
    x = np.concatenate([rng.integers(-2 * spread, 2 * spread, (40, dims)), book])
    index, squared = v.Slices(book).nearest(x)
    want = plain_nearest(x, book)
    assert (index == want[0]).all() and (squared == want[1]).all()


def test_masks_leave_out_what_is_far():
    rng = np.random.default_rng(3)
    book = rng.integers(-1000, 1000, (64, 4))
    s = v.Slices(book)
    x = rng.integers(-1000, 1000, (500, 4))
    masks = s.candidates(x, s.radius(x))
    left = [int(m).bit_count() for m in masks]
    assert min(left) >= 1 and np.mean(left) < 24
    inside = (np.abs(x[:, None, :] - book[None]) <= s.radius(x)[:, None, None]).all(2)
    assert [int(m) for m in masks] == [sum(1 << int(e) for e in np.flatnonzero(r)) for r in inside]


def plain(rows, parts=16, entries=64, rounds=2):
    """The whole contract with Python integers."""
    kept = [(i, [int(np.floor(float(c) * 256)) for c in x], lab) for i, x, lab in rows
            if x and all(c is not None and np.isfinite(c) for c in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[r[1][p * w:(p + 1) * w] for p in range(parts)] for r in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        got = [[near(p, c[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, g in zip(cut, got) if g[p] == k]
                if mine:
                    books[p][k] = [sum(col) // len(mine) for col in zip(*mine)]
    final = [[near(p, c[p]) for p in range(parts)] for c in cut]
    error = [sum(f[0] for f in one) for one in final]
    by_label = {}
    for r, e in zip(kept, error):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    text = ",".join(str(c) for b in books for e in b for c in e)
    return sorted(((r[0], "".join(f"{f[1]:02x}" for f in one), e, by_label[r[2]], sha256(text.encode()).hexdigest())
                   for r, one, e in zip(kept, final, error)), key=str)


@pytest.mark.parametrize("n", [7, 300])
def test_training_and_codes_against_plain_python(spark, n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 32)).astype(np.float32)
    x[n // 2:] = x[:n - n // 2] + rng.normal(size=(n - n // 2, 32)).astype(np.float32) * 0.1
    rows = [(int(k) * 3 - 50, [float(c) for c in x[k]], None if k % 5 == 0 else int(k % 3)) for k in range(n)]
    rows += [rows[3], rows[4], (900, None, 1), (901, [], 1), (902, [1.0] * 31 + [None], 2),
             (903, [float("nan")] * 32, 2), (904, [float("inf")] + [0.0] * 31, None), (None, [0.5] * 32, 7)]
    got = v.report(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_clashing_columns_other_lengths_and_an_empty_table(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=16).tolist(), 1, "x", 2.0) for k in range(5)] + [(9, [1.0] * 48, 1, "x", 2.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, v string, code double")
    df = df.withColumn("error", df.code).toDF("vec_id", "embedding", "label", "v", "v", "code")
    got = v.report(df).collect()
    assert sorted(r["vec_id"] for r in got) == [0, 1, 2, 3, 4]
    assert all(r["code"] == f"{r['vec_id']:02x}" * 16 and r["error"] == 0 for r in got)
    empty = v.report(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0


def test_components_beyond_the_bound_are_an_error(spark):
    rows = [(1, [1e9] * 16, 1)]
    with pytest.raises(ValueError, match="64 bits"):
        v.report(spark.createDataFrame(rows, SCHEMA))


def test_decode(spark):
    books = [np.array([[1, 2], [3, 4]]), np.array([[5, 6], [7, 8]])]
    assert v.decode("0100", books).tolist() == [3, 4, 5, 6]
