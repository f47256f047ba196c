"""Language id: the vectorised classifier against plain Python, held-out accuracy, odd inputs."""

import random
from collections import Counter

import pytest

from veritab.llm import langid as g
from veritab.llm.common import table

SF = "/root/testdata/sf0.01"


def brute(text, profiles, size, document):
    """Counts, ranks and distances with dictionaries; letters of no profile are one letter."""
    alphabet = {c for p in profiles.values() for x in p for c in x if c != "_"}
    padded = "".join(c if c == "_" or c in alphabet else "\0" for c in g.letters_only(text))
    if set(padded) <= {"_"}:
        return "und"
    counts = Counter()
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            x = padded[i:i + n]
            if x != "_" and not (n == 3 and x[1] == "_"):
                counts[x] += 1
    rank = {"_": 0, "\0": 1} | {c: i + 2 for i, c in enumerate(sorted(alphabet))}
    mine = sorted(counts, key=lambda x: (-counts[x], len(x), [rank[c] for c in x]))[:document]
    far = {}
    for lang, p in profiles.items():
        at = {x: i for i, x in enumerate(p)}
        far[lang] = sum(min(abs(i - at[x]), size) if x in at else size for i, x in enumerate(mine))
    best = min(sorted(far), key=far.get)
    return best, pytest.approx(1 - far[best] / (len(mine) * size))


def test_classifier_matches_a_plain_version():
    rng = random.Random(4)
    words = {"aa": "the of and was with thing oner".split(), "bb": "der und nicht größe über ßen".split(),
             "cc": "que los ción ñez ó para".split()}
    profiles = {k: [x for x, _ in sorted(sum((g.grams(" ".join(rng.choice(w) for _ in range(60))) for _ in range(5)),
                                             Counter()).items(), key=lambda y: (-y[1], y[0]))][:50]
                for k, w in words.items()}
    classify = g.Classifier(profiles, size=50, document=30)
    bits = sum(words.values(), []) + ["Ж", "中文", "1234", "!!", "\n", "ΑΣ", "İ", "x-y", "É"]
    for _ in range(400):
        text = " ".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))
        want = brute(text, profiles, 50, 30)
        assert classify(text) == (want if want != "und" else ("und", 0.0)), text


def test_no_letter_is_und_and_nothing_learned_is_und(spark):
    rows = [(1, None, "en", 0, 1), (2, "", "en", 0, 1), (3, "12 !!", None, 0, 1), (4, "the thing " * 9, "en", 0, 1),
            (4, "the thing " * 9, "en", 0, 1), (None, "word " * 100_000, None, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, held_out int")
    got = g.predict(docs, g.learn(docs)).collect()
    assert len(got) == 6 and [r["lang_pred"] for r in sorted(got, key=lambda r: r["doc_id"] or 99)][:3] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in g.predict(docs, {}).collect()} == {"und"}
    assert g.predict(docs.limit(0), g.learn(docs.limit(0))).collect() == []


def test_held_out_accuracy_and_no_held_out_text_learned(spark):
    docs = table(spark, SF, "documents")
    sample = g.training_sample(docs, 50)
    assert sample.where(g.held_out()).count() == 0
    assert all(r["count"] < 90 for r in sample.groupBy("lang").count().collect())
    got = g.predict(docs, g.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.97 * len(got) > 0
