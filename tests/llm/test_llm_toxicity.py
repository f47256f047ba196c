"""Toxicity: the recursions against all labellings, what is learned, held-out accuracy, odd inputs."""

import itertools
import math
import random

import numpy as np
import pytest

from veritab.llm import toxicity as t
from veritab.llm.common import table

SF = "/root/testdata/sf0.1"


def brute(scores, start, trans):
    total, toxic, steps = 0.0, np.zeros(len(scores)), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=len(scores)):
        s = start * y[0] + sum(e * v for e, v in zip(scores, y)) + sum(trans[a][b] for a, b in zip(y, y[1:]))
        w = math.exp(s)
        total += w
        toxic += w * np.array(y)
        for a, b in zip(y, y[1:]):
            steps[a][b] += w
    return toxic / total, steps / total


def test_marginals_match_all_labellings():
    rng = random.Random(2)
    seqs = [np.array([rng.uniform(-4, 4) for _ in range(n)]) for n in (0, 1, 2, 5, 5, 9)]
    trans = np.array([[0.3, -1.2], [0.4, 1.1]])
    got, steps = t.marginals(seqs, 0.7, trans, pairs=True)
    want = [brute(s, 0.7, trans) for s in seqs if len(s)]
    for g, (w, _) in zip([g for g in got if len(g)], want):
        assert g == pytest.approx(w)
    assert steps == pytest.approx(sum(w for _, w in want))
    assert len(got[0]) == 0


def corpus(n, seed=1):
    rng = random.Random(seed)
    clean = [f"w{rng.randint(0, 400)}x" for _ in range(3000)]
    rows = []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(20, 90))]
        if toxic := i % 4 == 0:
            for _ in range(3):
                words[rng.randrange(len(words))] = "gruz" + rng.choice(["ab", "eck", "ilo", "um"])
        rows.append((" ".join(words), toxic))
    return rows


def test_learned_words_and_spans():
    model = t.fit(corpus(400))
    tag = t.Tagger(model)
    (high, spans), (low, none) = tag(["w1x gruzoma Gruzab w2x", "w1x w3x w4x"])
    assert high >= 0.3 > low and none == []
    assert spans == [(4, 18)]   # an unseen ending, another case, next to each other
    got = tag([x for x, _ in corpus(200, seed=5)])
    assert sum((g[0] >= 0.3) == y for g, (_, y) in zip(got, corpus(200, seed=5))) >= 196
    assert t.fit(corpus(400)[::-1]).weights == model.weights


def test_copies_do_not_make_a_word_toxic():
    base = corpus(200)
    copied = [("odd " * 3 + base[0][0], True)] * 60
    texts = [t.WORD.findall(x) for x, _ in base + copied]
    assert "w:odd" not in t.label_words(texts, [y for _, y in base + copied])
    assert sum(t.originals(texts)[200:]) <= 1


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3, "s"), (2, "", 3, "s"), (3, "gruzab " * 4, 3, "s"), (3, "gruzab " * 4, 3, "s"),
                                  (None, "... !", 3, "s"), (6, "w1x " * 60_000 + "gruzum gruzab", 3, "s")],
                                 "doc_id long, text string, score int, spans string")
    model = t.fit(corpus(400))
    got = t.predict(docs, model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 and r["score"] is not None for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[3]["predicted"] == 1 and by[3]["spans"] == "0:27" and by[1]["predicted"] == 0 == by[2]["predicted"]
    assert by[6]["spans"].endswith(f"{240000}:{240013}")
    kept = t.keep_clean(docs, model)
    assert kept.columns == docs.columns and 3 not in {r["doc_id"] for r in kept.collect()}
    assert t.predict(docs.limit(0), model).collect() == []
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["predicted"] for r in t.predict(docs, t.learn(docs, labels)).collect()} == {0}


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    sample, _ = t.training_sample(docs, labels)
    assert sample.count() > 1000
    got = t.predict(docs, t.learn(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    clean = [r for r in got if not r["toxic"]]
    # junk documents of this table lost the words that made them toxic
    toxic = [r for r in got if r["toxic"] and r["quality"]]
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic) > 0
