"""Language identification by rank-order profiles: a document's most frequent n-grams are
compared with each language's by the out-of-place distance.

A profile lists a language's most frequent 1- to 3-grams of letters, words padded with a
separator, learned from a bounded sample of labelled documents. A document's own list is
made from its whole text; the distance to a language sums how far each of its n-grams is
from its place in the profile, an absent one counting as the profile's length.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import held_out, map_texts, worker_cache

PROFILE = 400          # n-grams in a language's profile
DOCUMENT = 300         # n-grams of a document that are compared
PER_LANGUAGE = 2000    # bound: documents that a language's profile is learned from
SAMPLE_CHARS = 50_000  # bound: longer documents are not learned from
UNKNOWN = "und"


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """About ``per_language`` labelled documents of each language at most, none of them
    held out, drawn by a hash of the id: a few counts decide the fraction."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit("lang")), F.lit(1_000_000))
    limit = F.lit(0)
    for lang, n in sorted(counts.items()):
        limit = F.when(F.col("lang") == lang, int(1_000_000 * min(1, per_language / n)) + 1
                       ).otherwise(limit)
    return (known.where((draw < limit) & (F.char_length("text") <= SAMPLE_CHARS))
            .select("doc_id", "text", "lang"))


def letters_only(text: str) -> str:
    """Lower case, with one separator in place of anything between letters."""
    low = [c.lower()[0] for c in text]
    return "_" + "_".join("".join(c if c.isalpha() else " " for c in low).split()) + "_"


def grams(text: str) -> Counter:
    """1- to 3-grams of the padded words; none spans two words."""
    padded = letters_only(text)
    out: Counter = Counter()
    if len(padded) > 2:
        for n in (1, 2, 3):
            out.update(zip(*[padded[i:] for i in range(n)]))
    return Counter({"".join(g): c for g, c in out.items()
                    if g != ("_",) and not (len(g) == 3 and g[1] == "_")})


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, size: int = PROFILE) -> dict:
    """``{language: [n-gram, ...]}`` by falling frequency, equal ones in code point order."""
    def make():
        def work(texts, langs):
            by: dict[str, Counter] = {}
            for t, g in zip(texts, langs):
                by.setdefault(g, Counter()).update(grams(t))
            rows = [[(g, k, n) for k, n in c.items()] for g, c in by.items()]
            first = [x for r in rows for x in r]
            return [[[{"lang": a, "gram": b, "n": n} for a, b, n in first]]
                    + [[]] * (len(texts) - 1)] if texts else [[]]
        return work

    counted = map_texts(training_sample(docs, per_language), make,
                        "grams array<struct<lang:string,gram:string,n:bigint>>",
                        keep=("doc_id",), extra=("lang",))
    total = (counted.select(F.inline("grams")).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    place = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = (total.withColumn("place", F.row_number().over(place)).where(F.col("place") <= size))
    profiles: dict[str, list] = {}
    for r in sorted(top.select("lang", "place", "gram").collect()):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


@lru_cache(1)
def letters() -> list[tuple[int, str]]:
    """Every code point whose lower case is a letter, with the latter."""
    lows = ((code, chr(code).lower()[0]) for code in range(0x110000))
    return [(code, low) for code, low in lows if low.isalpha()]


class Classifier:
    """Predicts from whole texts. Letters that no profile has count as one letter."""

    def __init__(self, profiles: dict[str, list], size: int = PROFILE, document: int = DOCUMENT):
        self.langs = sorted(profiles)
        self.size, self.document = size, document
        alphabet = sorted({c for p in profiles.values() for g in p for c in g if c != "_"})
        self.bits = max(4, (len(alphabet) + 2).bit_length())
        self.dtype = np.uint32 if 3 * self.bits + 2 <= 32 else np.uint64
        ids = {c: i + 2 for i, c in enumerate(alphabet)}   # 0 separator, 1 any other letter
        self.table = np.zeros(0x110000, self.dtype)
        for code, low in letters():
            self.table[code] = ids.get(low, 1)
        every = sorted({self._key([0 if c == "_" else ids[c] for c in g])
                        for p in profiles.values() for g in p})
        self.keys = np.array(every, self.dtype)
        self.places = np.full((len(every), len(self.langs)), -1, np.int64)
        at = {k: i for i, k in enumerate(every)}
        for j, lang in enumerate(self.langs):
            for place, g in enumerate(profiles[lang]):
                self.places[at[self._key([0 if c == "_" else ids[c] for c in g])], j] = place

    def _key(self, ids: list[int]) -> int:
        key = len(ids)
        for i in ids:
            key = (key << self.bits) | i
        # the length sits above three letters whatever the n-gram's own
        return (len(ids) << (3 * self.bits)) | (key & ((1 << (len(ids) * self.bits)) - 1))

    def __call__(self, text: str) -> tuple[str, float]:
        ids = self.table[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
        if not self.langs or not ids.any():
            return UNKNOWN, 0.0
        ids = np.concatenate([np.zeros(1, self.dtype), ids, np.zeros(1, self.dtype)])
        keep = ids != 0
        keep[1:] |= ids[:-1] != 0
        keep[0] = True
        ids = ids[keep]
        b, top = self.dtype(self.bits), 3 * self.bits
        tag = [self.dtype(n << top) for n in (1, 2, 3)]
        two = (ids[:-1] << b) | ids[1:]
        three = ((two[:-1] << b) | ids[2:])[ids[1:-1] != 0]
        keys = np.concatenate([ids[ids != 0] | tag[0], two | tag[1], three | tag[2]])
        keys.sort()
        edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(edge, len(keys)))
        best = np.argsort(-counts, kind="stable")[:self.document]
        mine = keys[edge[best]]
        at = np.searchsorted(self.keys, mine)
        at[at == len(self.keys)] = 0
        known = (self.keys[at] == mine)[:, None]
        places = self.places[at]
        off = np.abs(places - np.arange(len(mine))[:, None])
        distance = np.where(known & (places >= 0), np.minimum(off, self.size), self.size).sum(0)
        j = int(distance.argmin())
        return self.langs[j], float(1 - distance[j] / (len(mine) * self.size))


@worker_cache
def _classifier(profiles: tuple) -> Classifier:
    return Classifier({lang: list(p) for lang, p in profiles})


def predict(docs: DataFrame, profiles: dict[str, list]) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row from its whole text.

    Null texts and texts without a letter are ``und`` with score 0, and so is
    every text when nothing was learned. Equal distances go to the language first
    in code point order. Repeated rows are predicted each; other columns are ignored."""
    fixed = tuple((lang, tuple(p)) for lang, p in sorted(profiles.items()))

    def make():
        classify = _classifier(fixed)   # kept by a worker from task to task

        def work(texts):
            got = [classify(t) if t else (UNKNOWN, 0.0) for t in texts]
            return [[g[0] for g in got], [g[1] for g in got]]
        return work

    got = map_texts(docs, make, "lang_pred string, score double")
    return got.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
