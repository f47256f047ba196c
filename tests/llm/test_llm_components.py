"""Connected components against plain Python, on chains, hubs and random graphs."""

import random

from veritab.llm.common import chunks, components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {x: find(x) for x in root}


def test_components(spark):
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(100, 160)]
    hub = [(500, k) for k in range(501, 560)] + [(k, 499) for k in range(540, 545)]
    graph = [(rng.randint(1000, 1080), rng.randint(1000, 1080)) for _ in range(60)]
    edges = chain + hub + graph + [(7, 7), (9, 8), (8, 9), (9, 8)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["id"]: r["component_id"] for r in got.collect()} == brute(edges)
    assert got.count() == len(brute(edges))
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_chunks_keep_every_text_in_order():
    texts = ["a" * n for n in (3, 9, 0, 2, 30, 1)]
    assert list(chunks(texts, 10)) == [["a" * 3], ["a" * 9, "", ][:2], ["aa"], ["a" * 30], ["a"]]
    assert list(chunks([])) == []
