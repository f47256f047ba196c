"""N-gram Jaccard join: against all pairs in plain Python, the tree's bound, odd inputs."""

import itertools
import random
import re

import numpy as np
import pytest

from veritab.llm import jaccard as j

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}


def brute(rows, words=4, percent=85):
    """Per row: (doc_id, set size, least id reachable); and each row's class."""
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).append(i)
    out = [(i, len(sets[k]), i if not sets[k] else min((x for x in least[find(k)] if x is not None), default=None))
           for k, (i, _) in enumerate(rows)]
    return out, [find(k) for k in range(len(rows))]


def corpus(seed, copies):
    """Originals, copies with some words changed - so that some link and some just do
    not - passages shared by many, and short texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(900)] + ["the", "of", "and", "to"] * 60
    passage = [rng.choice(words) for _ in range(40)]
    rows = []
    for _ in range(25):
        text = [rng.choice(words) for _ in range(rng.randint(5, 150))]
        if rng.random() < 0.5:
            text[3:3] = passage
        for _ in range(rng.randint(1, copies)):
            new = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 35))):
                new[rng.randrange(len(new))] = rng.choice(words)
            rows.append(" ".join(x.upper() if rng.random() < 0.05 else x for x in new))
    rows += ["a", "a", "A b c", "a b c d", "a b c d e", "", None, " \t", "x\x0by", "x y", "İ i", "é É"]
    rng.shuffle(rows)
    return [(i * 3 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed, copies", [(1, 4), (2, 14)])
def test_join_matches_all_pairs(spark, seed, copies):
    rows = corpus(seed, copies)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute(rows)
    assert len({x[2] for x in want}) < len(rows) - 10
    assert sorted(tuple(r) for r in j.join(docs).collect()) == sorted(want)


def test_keep_one_of_each_group_with_other_words_and_threshold(spark):
    rows = corpus(3, 6) + [(None, "lone text without an id"), (9001, "lone text without an id")]
    docs = spark.createDataFrame([(*r, 1, "p", 2) for r in rows], "doc_id long, text string, n int, point string, uid int")
    kept = j.keep_one(docs, words=5, percent=80)
    assert kept.columns == docs.columns
    _, group = brute(rows, 5, 80)
    best = {}
    for (i, t), g in zip(rows, group):
        best.setdefault(g, []).append((i is None, i, t))
    want = sorted(str(min(v, key=lambda x: (x[0], x[1] or 0))[1:]) for v in best.values())
    assert sorted(str(tuple(r)[:2]) for r in kept.collect()) == want


def test_links_hold_exactly_at_the_threshold(spark):
    base = [f"t{k}" for k in range(40)]              # 37 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base + [f"u{k}" for k in range(6)])),   # 37 of 43: 86 %
            (3, " ".join(base + [f"v{k}" for k in range(7)]))]                        # 37 of 44: 84 %
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in j.join(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_repeated_rows_null_ids_long_texts_and_empty_tables(spark):
    long = " ".join(f"q{k % 5003}" for k in range(60_000))
    rows = [(4, "same words again here"), (4, "same words again here"), (None, "Same words again HERE"),
            (7, None), (8, ""), (9, long), (10, long + " tail")]
    docs = spark.createDataFrame([(*r, 3, "c") for r in rows], "doc_id long, text string, class int, keys string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in j.join(docs).collect())
    assert got == sorted((str(i), n, c) for i, n, c in brute(rows)[0])
    assert j.join(docs.limit(0)).collect() == [] and j.keep_one(docs.limit(0)).collect() == []


def test_likeliest_partners_first_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(j, "MANY", 4)
    rows = corpus(4, 10)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in j.join(docs).collect()) == sorted(brute(rows)[0])


def test_tree_search_loses_no_link():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(40):
        own = rng.integers(0, 2 ** 40, rng.integers(1, 200))
        for _ in range(rng.integers(1, 6)):
            new = own.copy()
            hit = rng.random(len(new)) < 0.06
            new[hit] = rng.integers(0, 2 ** 40, hit.sum())
            sets.append(np.unique(new))
    points = np.array([j.fold(j.point(s).tobytes()) for s in sets])
    sizes = np.array([len(s) for s in sets])
    comps = np.arange(len(sets)) // 2 * 2     # some are connected already
    found = {tuple(sorted((int(a), int(b)))) for r, c in j.search(points, sizes, comps) for a, b in zip(r, c)}
    for a, b in itertools.combinations(range(len(sets)), 2):
        if comps[a] != comps[b] and j.linked(sets[a], sets[b], sizes[a], sizes[b]):
            assert (a, b) in found
    assert all(comps[a] != comps[b] for a, b in found)
    every = len(sets) * (len(sets) - 1) // 2
    assert len(found) < every / 5


def test_points_of_any_size_bound_the_overlap():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2 ** 40, 9000)
    sets = [np.unique(np.concatenate([base[:n], rng.integers(0, 2 ** 40, n // 5)]))
            for n in (1, 40, 1500, 1600, 6000, 6500, 9000)] + [np.zeros(0, np.int64)]
    points = [j.point(s).tobytes() for s in sets]
    assert len({len(p) for p in points}) == 3 and [j.fold(p).sum() for p in points] == [len(s) for s in sets]
    pairs = list(itertools.product(range(len(sets)), repeat=2))
    most = j.most_common([points[a] for a, _ in pairs], [points[b] for _, b in pairs])
    for (a, b), m in zip(pairs, most):
        assert len(np.intersect1d(sets[a], sets[b])) <= m <= min(len(sets[a]), len(sets[b]))
    far = [np.unique(rng.integers(0, 2 ** 40, 9000)) for _ in range(2)]
    assert j.most_common(*[[j.point(s).tobytes()] for s in far])[0] < j.overlap_needed(18_000)


def test_prefixes_of_linked_sets_meet():
    rng = random.Random(6)
    for _ in range(300):
        both = rng.randint(1, 60)
        a = set(range(both)) | {100 + k for k in range(rng.randint(0, 8))}
        b = set(range(both)) | {200 + k for k in range(rng.randint(0, 8))}
        if 100 * len(a & b) >= 85 * len(a | b):
            order = {x: rng.random() for x in a | b}
            first = [set(sorted(s, key=order.get)[:j.prefix_size(len(s))]) for s in (a, b)]
            assert first[0] & first[1]


def test_key_bytes_keep_order_and_value():
    keys = np.unique(np.random.default_rng(1).integers(0, 2 ** 64, 500, np.uint64))
    back = j.from_bytes(j.to_bytes(keys))
    assert (back == (keys >> np.uint64(16)).astype(np.int64)).all()


def test_large_cells_are_searched_by_pairs_of_tiles(spark, monkeypatch):
    monkeypatch.setattr(j, "CELL_ROWS", 8)
    cells = spark.createDataFrame([(c, u, m) for c, m in ((1, 100), (2, 41), (3, 8), (4, 16)) for u in range(m)],
                                  "cell long, uid long, members long")
    met, held = {}, {}
    for lo, hi in j.passes(13):
        groups = {}
        for r in j.tiled(cells, lo, hi).collect():
            groups.setdefault((r["cell"], r["a"], r["b"]), []).append((r["uid"], r["mine"]))
        for (c, a, b), rows in groups.items():
            held[c] = max(held.get(c, 0), len(rows))
            for (u, s), (v, t) in itertools.combinations(rows, 2):
                if a == b or s != t:
                    met.setdefault(c, []).append(frozenset((u, v)))
    for c, m in ((1, 100), (2, 41), (3, 8), (4, 16)):     # every two members once, in groups of bounded size
        assert len(met[c]) == len(set(met[c])) == m * (m - 1) // 2
    assert held[1] < 50 and held[3] == 8


def test_tiles_lose_no_link_of_a_shared_passage(spark, monkeypatch):
    monkeypatch.setattr(j, "CELL_ROWS", 12)
    sizes = []
    cross = j.cross_pairs
    monkeypatch.setattr(j, "cross_pairs", lambda cells, percent: (
        sizes.append([r["count"] for r in cells.groupBy("cell", "a", "b").count().collect()]), cross(cells, percent))[1])
    rng = random.Random(8)
    words = [f"w{k}" for k in range(2000)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for k in range(30):               # one passage is most of each: just too little for a link, but for near copies
        text = passage + [rng.choice(words) for _ in range(8)]
        for _ in range(rng.randint(1, 3)):
            new = list(text)
            new[-1] = rng.choice(words)
            rows.append((len(rows), " ".join(new)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute(rows)
    assert sorted(tuple(r) for r in j.join(docs).collect()) == sorted(want)
    assert len({x[2] for x in want}) > 15
    assert len(sizes) > 2 and all(0 < max(s) < 0.75 * len(rows) for s in sizes)


def test_search_hands_out_pairs_before_it_is_done(monkeypatch):
    monkeypatch.setattr(j, "PAIR_ROWS", 500)
    points, sizes = np.full((300, j.GROUPS), 2, np.int64), np.full(300, 2 * j.GROUPS)
    lots = list(j.search(points, sizes, np.arange(300)))
    assert sum(len(r) for r, _ in lots) == 300 * 299 // 2 and max(len(r) for r, _ in lots) < 1000
    between = [(a, b) for r, c in j.search(points, sizes, np.arange(300), j.PERCENT, 100) for a, b in zip(r, c)]
    assert len(set(between)) == len(between) == 100 * 200 and all(a < 100 <= b for a, b in between)


def test_a_pair_is_written_in_the_first_cell_it_shares(spark, monkeypatch):
    cross, written = j.cross_pairs, []

    def counted(cells, percent):
        pairs = cross(cells, percent).cache()
        written.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(j, "cross_pairs", counted)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(5000)]
    passage = [rng.choice(words) for _ in range(150)]      # most of each text: dozens of cells are shared by all
    rows = [(k, " ".join(passage + [rng.choice(words) for _ in range(rng.randint(8, 30))])) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute(rows)
    assert sorted(tuple(r) for r in j.join(docs).collect()) == sorted(want)
    assert written[0][1] > 10 and written[0][0] <= 1.05 * written[0][1]
