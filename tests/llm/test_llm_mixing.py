"""Mixing sources: against a plain Python mix, its properties, and odd inputs."""

import hashlib
import math
import re

import pytest

from oracle import compare, duck
from veritab.llm import mixing, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string"


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share, stop at the cap, share the excess again, until nothing is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, open_ = float(sum(sizes.values())), [s for s in order if sizes[s]]
    while left > 1e-9 and open_:
        total, over = sum(w[s] for s in open_), 0.0
        for s in open_:
            target[s] += left * w[s] / total
        for s in open_:
            if target[s] > cap * sizes[s]:
                over += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
        open_ = [s for s in open_ if target[s] < cap * sizes[s]]
        left = over
    return target


def brute(rows, weights, split_last=True):
    """rows of (doc_id, text, source) -> sorted (doc_id, size, source_size, target, taken)"""
    docs = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]
    sizes = {}
    for _, n, s in docs:
        sizes[s] = sizes.get(s, 0) + n
    target, out = brute_targets(sizes), []
    for s, total in sizes.items():
        def key(doc):
            text = "mix-1|" + ("" if doc[0] is None else str(doc[0]))
            u = (int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 1) / (2 ** 52 + 2)
            return -math.log(u) / weights.get(doc[0], 0.5), doc[0] is not None, doc[0] or 0, doc[1]
        epochs = min(3, int(target[s] // total)) if total else 0
        left = math.floor(target[s] + 0.5) - epochs * total
        for i, n, _ in sorted((d for d in docs if d[2] == s), key=key):
            part = max(0, min(n, left)) if split_last else (n if left * 2 >= n else 0)
            out.append((i, n, total, target[s], epochs * n + part))
            left -= n
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"])
                   for r in df.collect()), key=str)


def close(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:3] + g[4:] == w[:3] + w[4:] and g[3] == pytest.approx(w[3])


ROWS = ([(i, "w " * (1 + i * 7 % 13), "abcde"[i % 5]) for i in range(60)]
        + [(i, "w " * 40, "hot") for i in range(100, 180)]
        + [(200, None, "a"), (201, "", "b"), (None, "x y", "c"), (None, "z", None), (203, " \t\n", None),
           (204, "one two", None), (205, "dup", "a"), (205, "dup", "a"), (206, "w " * 5000, "long"),
           (207, "", "nothing")])


def test_mix_matches_a_plain_version(spark):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (3, 0, 0), (101, 0, 1), (None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(ROWS, SCHEMA)
    weight = mixing.quality_weight(labels)
    weights = {3: 1.0, 4: 0.25, 101: 0.25}
    close(rows_of(mixing.mix(docs, weight)), brute(ROWS, weights))
    close(rows_of(mixing.mix(docs, weight, split_last=False, buckets=8)), brute(ROWS, weights, False))


def test_targets_stop_at_three_times_and_are_met(spark):
    got = mixing.mix(spark.createDataFrame(ROWS, SCHEMA)).join(
        spark.createDataFrame([(r[0], r[2]) for r in ROWS], "id long, source string").distinct(),
        mixing.F.col("doc_id").eqNullSafe(mixing.F.col("id"))).collect()
    assert all(r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] + 1e-9 for r in got)
    again = mixing.mix(spark.createDataFrame(ROWS[::-1], SCHEMA).repartition(5))
    assert rows_of(again) == rows_of(mixing.mix(spark.createDataFrame(ROWS, SCHEMA)))


def test_likelier_documents_come_first(spark):
    rows = [(i, "w w", "a") for i in range(4000)] + [(9999, "w " * 60000, "b")]
    heavy = spark.createDataFrame([(i, 1.0 if i % 2 else 0.1) for i in range(4000)], "doc_id long, weight double")
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs, heavy).where("doc_id < 4000").collect()
    extra = [r["taken"] - 2 * int(r["target"] // r["source_size"]) for r in got]
    odd = sum(x for x, r in zip(extra, got) if r["doc_id"] % 2)
    assert sum(extra) == 0 or odd >= 0.7 * sum(extra)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).collect() == []
    assert mixing.repeat_rows(empty, mixing.mix(empty)).collect() == []
    docs = spark.createDataFrame([(1, "a b", "s", 5, "k", 9, 2), (2, None, None, 6, "l", 8, 1)],
                                 SCHEMA + ", size int, key string, times int, copy int")
    mixed = mixing.mix(docs, split_last=False)
    assert mixed.count() == 2
    out = mixing.repeat_rows(docs, mixed)
    assert out.columns == docs.columns and sorted(r["size"] for r in out.collect()) == [5, 6]


def test_repeat_rows_follow_the_mix(spark):
    rows = [r for r in ROWS if r[0] is not None]
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = mixing.mix(docs, split_last=False)
    want = {}
    for i, n, _, _, taken in brute(rows, {}, False):   # rows of one id and text count together
        want[i] = want.get(i, 0) + (taken // n if n else 1)
    got = {}
    for r in mixing.repeat_rows(docs, mixed).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {i: n for i, n in want.items() if n}


def test_query_matches_its_sql(spark):
    problems, n, _ = compare(spark, duck(SF), queries.QUERIES["op5_mixing"], queries.ORACLE_SQL["op5_mixing"], SF)
    assert not problems and n


def test_equal_rows_are_repeated_as_often_as_all_of_them_are_taken(spark):
    ten = "w " * 10
    rows = [(1, ten, "a", k) for k in range(7)] + [(2, "x " * 14, "b", 0)]   # a's share of 84 words is 60
    docs = spark.createDataFrame(rows, SCHEMA + ", more int")
    mixed = mixing.mix(docs, split_last=False).cache()
    assert mixed.where("source = 'a'").agg({"taken": "sum"}).first()[0] == 60
    out = mixing.repeat_rows(docs, mixed).collect()
    assert sum(r["doc_id"] == 1 for r in out) == 6 and len({r["more"] for r in out if r["doc_id"] == 1}) == 1
    # one id and text in two sources: each as its own source has it
    both = spark.createDataFrame([(1, ten, "a", 0), (1, ten, "b", 1), (3, "y " * 40, "b", 2)], SCHEMA + ", more int")
    mixed = mixing.mix(both, split_last=False)
    times = {r["source"]: r["taken"] // r["size"] for r in mixed.where("doc_id = 1").collect()}
    got = [r["source"] for r in mixing.repeat_rows(both, mixed).where("doc_id = 1").collect()]
    assert {s: got.count(s) for s in times} == times


def test_equal_ids_and_sizes_are_drawn_alike_in_a_rerun(spark):
    rows = [(1, f"w{k} w", "a") for k in range(40)] + [(2, "x " * 10, "b")]
    draws = [sorted((r["text_hash"], r["taken"]) for r in mixing.mix(
        spark.createDataFrame(rows[::step], SCHEMA).repartition(n)).collect()) for n, step in ((1, 1), (7, -1))]
    assert draws[0] == draws[1] and len({t for _, t in draws[0]}) > 1


def test_buckets_of_a_hot_source_are_alike(spark):
    docs = spark.range(300_000).withColumn("u", mixing._uniform("id", "seed")).selectExpr(
        "-ln(u) / element_at(array(0.25D, 0.5D, 1D), CAST(id % 3 AS INT) + 1) AS key")
    sizes = sorted(r["count"] for r in docs.groupBy(mixing.key_bucket("key", 128)).count().collect())
    assert len(sizes) == 128 and sizes[-1] <= 3 * sizes[64]
    order = docs.withColumn("b", mixing.key_bucket("key", 128)).groupBy("b").agg({"key": "min"}).orderBy("b").collect()
    assert [r[1] for r in order] == sorted(r[1] for r in order)
