"""Toxicity: a linear-chain conditional random field tags toxic spans, its marginals make
document scores and offending offsets.

Two states (clean, toxic) over a text's words. A word's toxic score is the sum of the
weights of its features (itself, its prefixes and its suffix); transitions let a span go on.
Labels are given by document, so words are labelled first: a word of a toxic document is
toxic if it, or a prefix of it, is far more frequent in toxic documents than in others.
The marginals of a document's words go through a logistic regression to its score. The field is fitted to a bounded sample; scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import aliased, chunks, held_out, map_texts

SAMPLE_TOXIC = 800       # bound: toxic documents that are learned from
SAMPLE_CLEAN = 1600      # bound: other documents that are learned from
SAMPLE_CHARS = 20_000    # bound: longer documents are not learned from
THRESHOLD = 0.3          # a document with this score or more is predicted toxic
RATE, SURE = 12, 9      # how much more frequent, and how sure, a toxic feature must be
USES = 8                 # uses of a feature within one document that count
SPAN = 0.5               # marginal from which a word belongs to a toxic span
FAINT = 0.4              # marginal from which a word counts for its document's score
PREFIXES = (3, 4, 5, 6)
SUFFIX = 3
ROUNDS = 40
RIDGE, RIDGE_OWN = 0.05, 0.02   # the latter times the number of toxic words
SKETCH = 16              # words by which copies within the sample are told
WORD = re.compile(r"\w+")
_CELLS = 300_000         # words, with padding, that go through the recursions together


def training_sample(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC,
                    clean: int = SAMPLE_CLEAN) -> tuple[DataFrame, float]:
    """``(text, toxic)`` of labelled documents, none of them held out, at most about
    the given numbers of each, drawn by a hash of the id; and how much thinner the
    clean ones were drawn."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    counts = {r["toxic"]: r["count"] for r in
              known.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    share = {t: min(1.0, n / max(1, counts.get(t, 0))) for t, n in ((True, toxic), (False, clean))}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1_000_000))
    limit = F.when(F.col("toxic") > 0, int(1_000_000 * share[True]) + 1
                   ).otherwise(int(1_000_000 * share[False]) + 1)
    drawn = known.where(draw < limit)   # as few rows as the bounds say
    return (docs.select("doc_id", "text").where(F.char_length("text") <= SAMPLE_CHARS)
            .join(F.broadcast(drawn), "doc_id").select("text", "toxic"),
            share[True] / share[False])


def features(word: str) -> list[str]:
    low = word.lower()
    out = ["w:" + low]
    out += [f"p{n}:{low[:n]}" for n in PREFIXES if len(low) > n]
    if len(low) > SUFFIX + 1:
        out.append("s:" + low[-SUFFIX:])
    return out


@dataclass
class Field:
    """A fitted field: feature weights of the toxic state, a bias and transitions.

    ``trans[i, j]`` scores a step from state i to j, ``start`` a toxic first word."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    start: float = 0.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: np.ndarray = field(default_factory=lambda: np.array([-30.0, 0.0, 0.0, 0.0]))

    def emission(self, word: str) -> float:
        w = self.weights
        return min(30.0, max(-30.0, self.bias + sum(w.get(f, 0.0) for f in features(word))))


def _groups(order: list[int], sizes: list[int]):
    """Runs of texts, sorted by length, whose padded words stay within ``_CELLS``."""
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * sizes[order[end]] <= _CELLS:
            end += 1
        yield order[at:end]
        at = end


def marginals(scores: list[np.ndarray], start: float, trans: np.ndarray,
              pairs: bool = False):
    """Forward-backward over sequences of toxic scores: each word's probability of the
    toxic state; with ``pairs`` also the expected number of each transition.

    With two states the recursions run on odds; texts of like length go side by side."""
    t = np.exp(trans)
    out: list = [None] * len(scores)
    steps = np.zeros((2, 2))
    order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
    for group in _groups(order, [len(s) for s in scores]):
        n = np.array([len(scores[i]) for i in group])
        if n[-1] == 0:
            for i in group:
                out[i] = scores[i]
            continue
        e = np.full((n[-1], len(group)), -30.0)
        for k, i in enumerate(group):
            e[:n[k], k] = scores[i]
        e = np.exp(e)
        first = np.searchsorted(n, np.arange(n[-1]), side="right")  # texts from here on go on
        f = np.empty_like(e)
        f[0] = e[0] * np.exp(start)
        for s in range(1, n[-1]):
            a, o = first[s], f[s - 1]
            f[s, :a] = 0.0
            f[s, a:] = e[s, a:] * (t[0, 1] + o[a:] * t[1, 1]) / (t[0, 0] + o[a:] * t[1, 0])
        b = np.ones_like(e)
        for s in range(n[-1] - 2, -1, -1):
            a = first[s + 1]
            x = e[s + 1, a:] * b[s + 1, a:]
            b[s, a:] = (t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x)
        odds = f * b
        p = odds / (1 + odds)
        for k, i in enumerate(group):
            out[i] = p[:n[k], k]
        if pairs and n[-1] > 1:
            inside = np.arange(1, n[-1])[:, None] < n[None, :]
            x = e[1:] * b[1:]
            joint = np.stack([t[0, 0] * np.ones_like(x), t[0, 1] * x,
                              t[1, 0] * f[:-1], t[1, 1] * f[:-1] * x])
            joint /= joint.sum(0)
            steps += (joint * inside).sum((1, 2)).reshape(2, 2)
    return (out, steps) if pairs else out


def originals(texts: list[list[str]]) -> list[bool]:
    """False for a text that shares half of its sketch (the words of least hash) with
    one before it."""
    sketches: dict[str, list[int]] = {}
    out = []
    for i, words in enumerate(texts):
        sketch = sorted(set(words), key=lambda w: (crc32(w.encode()), w))[:SKETCH]
        shared = Counter(j for w in sketch for j in sketches.get(w, ()))
        out.append(not any(n * 2 >= len(sketch) for n in shared.values()))
        if out[-1]:
            for w in sketch:
                sketches.setdefault(w, []).append(i)
    return out


def label_words(texts: list[list[str]], toxic: list[bool]) -> set[str]:
    """Features that mark a word of a toxic document as toxic: in at least a fiftieth of
    the toxic documents, many times more frequent there than elsewhere, and in too many
    of them for chance. Copies of a document count once, or their rare words would pass."""
    fresh = [(w, bool(t)) for w, t, new in zip(texts, toxic, originals(texts)) if new]
    n1 = sum(t for _, t in fresh)
    n0 = len(fresh) - n1
    if not n0 or not n1:
        return set()
    counts = [(Counter(words), t) for words, t in fresh]
    # first what is common among the toxic; only that is counted further
    common = Counter(f for words, t in counts if t for f in {f for w in words for f in features(w)})
    common = {f for f, k in common.items() if k >= max(3, 0.02 * n1)}
    # whole words first, then prefixes from the longest: a prefix is judged by the words that
    # nothing longer has marked, or a common beginning of clean words would pass with them
    marks: set[str] = set()
    for kind in ["w:", *(f"p{n}:" for n in sorted(PREFIXES, reverse=True))]:
        docs, uses = (Counter(), Counter()), (Counter(), Counter())
        for words, t in counts:
            once: Counter = Counter()
            for w, n in words.items():
                fs = features(w)
                f = next((f for f in fs if f.startswith(kind)), None)
                if f in common and marks.isdisjoint(fs):
                    once[f] += n
            for f, n in once.items():
                docs[t][f] += 1
                uses[t][f] += min(n, USES)
        for f, k in docs[True].items():
            expected = (k + docs[False][f]) * n1 / (n0 + n1)
            rate = (uses[True][f] / n1) / ((uses[False][f] + 0.5) / n0)
            if rate >= RATE and k * np.log(k / expected) - (k - expected) >= SURE:
                marks.add(f)
    return marks


def document_features(p: np.ndarray) -> np.ndarray:
    """What a document's score is made from: the expected number of toxic words, the
    chance of two or more, and their share of the words. Words below ``FAINT`` do not count:
    thousands of them, in a long text, would make up for none that is toxic."""
    q = np.minimum(p[p >= FAINT], 1 - 1e-9)
    if not len(q):
        return np.array([1.0, 0.0, 0.0, 0.0])
    none = np.exp(np.log1p(-q).sum())
    two = 1 - none * (1 + (q / (1 - q)).sum())
    n = q.sum()
    return np.array([1.0, np.log1p(n), max(0.0, two), min(1.0, 20 * n / len(p))])


def calibrate(rows: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    beta = np.zeros(rows.shape[1])
    ridge = np.diag([0.01, 0.1, 0.1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        hess = (rows * (weight * p * (1 - p))[:, None]).T @ rows + ridge
        step = np.linalg.solve(hess, rows.T @ (weight * (truth - p)) - ridge @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(rows: list[tuple[str, bool]], rounds: int = ROUNDS, clean_weight: float = 1.0) -> Field:
    """The field that fits the labelled words best, by full-batch adaptive gradient
    steps on the regularised likelihood, and the regression from its marginals to the
    document labels. ``clean_weight`` says how many documents a clean one of the sample
    stands for, by a toxic one. Same rows in any order: same field."""
    rows = sorted((t, bool(x)) for t, x in rows if t)
    texts = [WORD.findall(t) for t, _ in rows]
    toxic = [x for _, x in rows]
    marks = label_words(texts, toxic)
    model = Field()
    if not marks:
        return model
    names: dict[str, int] = {}
    word_ids: dict[str, int] = {}
    feats: list[list[int]] = []
    flagged: list[bool] = []
    for w in sorted({w for ws in texts for w in ws}):
        fs = features(w)
        word_ids[w] = len(feats)
        feats.append([names.setdefault(f, len(names)) for f in fs])
        flagged.append(any(f in marks for f in fs))
    flat = np.concatenate([np.array(f) for f in feats])
    owner = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    flags = np.array(flagged)
    ids = [np.array([word_ids[w] for w in ws], np.int32) for ws in texts]
    del texts, word_ids
    truth = [flags[i] & x for i, x in zip(ids, toxic)]
    everything = np.concatenate(ids)
    del rows
    gold = np.bincount(everything, np.concatenate(truth).astype(float), len(feats))
    gold_steps = np.zeros((2, 2))
    for y in truth:
        if len(y) > 1:
            k = np.bincount(2 * y[:-1].astype(int) + y[1:], minlength=4)
            gold_steps += k.reshape(2, 2)
    gold_start = sum(bool(y[0]) for y in truth if len(y))

    theta = np.zeros(len(names) + 6)   # features, bias, start, four transitions
    theta[-6] = model.bias
    speed = np.full(len(theta), 1e-8)
    # features that few words share are held back, so that prefixes carry the weight
    own = tuple(f"p{n}:" for n in PREFIXES[2:]) + ("w:", "s:")
    ridge = np.array([RIDGE_OWN * gold.sum() if f.startswith(own) else RIDGE for f in names] + [RIDGE] * 6)
    for _ in range(rounds):
        emit = np.bincount(owner, theta[flat], len(feats)) + theta[-6]
        emit = np.clip(emit, -30, 30)
        trans = theta[-4:].reshape(2, 2)
        p, steps = marginals([emit[i] for i in ids], theta[-5], trans, pairs=True)
        miss = gold - np.bincount(everything, np.concatenate(p), len(feats))
        grad = np.concatenate([
            np.bincount(flat, miss[owner], len(names)),
            [miss.sum(), gold_start - sum(x[0] for x in p if len(x))],
            (gold_steps - steps).ravel()])
        grad -= ridge * theta
        speed += grad * grad
        theta += 0.7 * grad / np.sqrt(speed)
    kept = {name: float(theta[i]) for name, i in names.items() if abs(theta[i]) > 0.01}
    truth = np.array(toxic, float)
    beta = calibrate(np.array([document_features(x) for x in p]), truth,
                     np.where(truth > 0, 1.0, clean_weight))
    return Field(kept, float(theta[-6]), float(theta[-5]), theta[-4:].reshape(2, 2).copy(), beta)


def learn(docs: DataFrame, labels: DataFrame) -> Field:
    """Fits on the bounded sample, which alone reaches the driver."""
    drawn, clean_weight = training_sample(docs, labels)
    return fit([(r["text"], r["toxic"] > 0) for r in drawn.collect()], clean_weight=clean_weight)


class Tagger:
    def __init__(self, model: Field):
        self.model = model

        class Scores(dict):
            def __missing__(self, word):
                if len(self) > 200_000:   # memory only: forgotten words are scored again
                    self.clear()
                self[word] = s = model.emission(word)
                return s
        self.scores = Scores()

    def __call__(self, texts: list[str]) -> list[tuple[float, list[tuple[int, int]]]]:
        """Each text's score and its toxic spans (code points, end exclusive)."""
        look = self.scores.__getitem__
        rows = [np.array(list(map(look, WORD.findall(t))), np.float64) for t in texts]
        out = []
        for text, p in zip(texts, marginals(rows, self.model.start, self.model.trans)):
            spans: list[tuple[int, int]] = []
            if len(p) and p.max() >= SPAN:
                at = [m.span() for m in WORD.finditer(text)]
                last = -2
                for i in np.flatnonzero(p >= SPAN):
                    if i == last + 1:
                        spans[-1] = (spans[-1][0], at[i][1])
                    else:
                        spans.append(at[i])
                    last = i
            z = float(document_features(p) @ self.model.document)
            out.append((1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), spans))
        return out


SPANS = "array<struct<start:bigint,end:bigint>>"


def score(docs: DataFrame, model: Field, keep=("doc_id",), text: str = "text") -> DataFrame:
    """The ``keep`` columns, ``score`` (from the words' marginals) and ``spans``.

    Null and empty texts, and texts without words, get the score of a text without any
    toxic word and no spans; so does every text if the labels taught nothing. Repeated
    rows are scored each."""
    def make():
        tag = Tagger(model)

        def work(texts):
            got = []
            for some in chunks(texts):
                got += tag(some)
            return [[g[0] for g in got],
                    [[{"start": a, "end": b} for a, b in g[1]] for g in got]]
        return work

    return map_texts(docs, make, f"score double, spans {SPANS}", keep=keep, text=text)


def predict(docs: DataFrame, model: Field, threshold: float = THRESHOLD) -> DataFrame:
    got = score(docs, model)
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return got.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"),
                      spans.alias("spans"))


def keep_clean(docs: DataFrame, model: Field, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    rows, at, back = aliased(docs)
    return back(score(rows, model, keep=tuple(rows.columns), text=at["text"]).where(F.col("score") < threshold))
