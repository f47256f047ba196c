"""SentencePiece encoding and decoding: against the library, a plain Viterbi, odd inputs."""

import random
from zlib import crc32

import numpy as np
import pytest
import sentencepiece

from veritab.llm import pieces as p


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=p.model_path())


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def odd_texts():
    rng = random.Random(8)
    letters = "abcdeéñßzç 　▁\n\t.,!?0123ABCüЖ中文日🙂́ﬁ "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    names = [x.replace(p.MARK, " ") for x in p.Model(p.model_path()).pieces[300:]]
    texts += ["".join(rng.choice(names) for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    return texts + ["", " ", "   ", " a", "a ", "a  b", "▁", "a▁b", "<0x0A>", "<s> </s> <unk>", " " * 100,
                    "a" * 700, "the" * 300, "\x00a", "then " * 3000]


def test_ids_and_texts_match_the_library(library):
    texts = odd_texts()
    encode, decode = p.Encoder(p.model_path()), p.Decoder(p.model_path())
    for text, got in zip(texts, encode(texts)):
        assert ids(got) == library.encode(text), text
        assert decode(ids(got)) == library.decode(ids(got)), text


def test_order_and_batches_do_not_matter(monkeypatch):
    texts = odd_texts()[:800]
    want = p.Encoder(p.model_path())(texts)
    monkeypatch.setattr(p, "WORD_CACHE", 50)
    monkeypatch.setattr(p, "PAIR_CACHE", 50)
    small = p.Encoder(p.model_path())
    assert [small([t])[0] for t in reversed(texts)] == want[::-1]


def test_a_shared_prefix_is_walked_once(monkeypatch):
    encode, steps = p.Encoder(p.model_path()), []
    step = encode._last_bpe
    monkeypatch.setattr(encode, "_last_bpe", lambda w, i, last: steps.append((w, i)) or step(w, i, last))
    encode(["thinking thinker thinks think"])
    assert len(steps) == len({w[:i] for w, i in steps})   # no prefix twice


def test_unigram_models_take_the_best_sum(monkeypatch):
    rng = random.Random(3)
    encode = p.Encoder(p.model_path())
    m = encode.model
    m.kind = p.UNIGRAM
    names = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "bb", "aba"]
    m.ids = {x: i for i, x in enumerate(names)}
    m.scores = [-rng.uniform(1, 5) for _ in names]
    m.longest = 3
    m.joined = {x[k:k + 2] for x in names for k in range(len(x) - 1)}

    def best(word):
        if not word:
            return 0.0, []
        options = [(s + m.scores[m.ids[word[j:]]], path + [word[j:]])
                   for j in range(len(word)) if word[j:] in m.ids for s, path in [best(word[:j])]]
        return max(options)

    for _ in range(200):
        word = "".join(rng.choice("ab") for _ in range(rng.randint(1, 9)))
        got = [names[i] for i in ids(encode([word])[0])]
        assert "".join(got) == "▁" + word
        assert sum(m.scores[m.ids[x]] for x in got) == pytest.approx(best("▁" + word)[0])   # ties are free
        encode.known.clear()
        encode.segments.clear()


def test_odd_rows(spark, library):
    rows = [(1, "the thing"), (2, None), (3, ""), (1, "the thing"), (None, "a  b\n"), (5, "word " * 60_000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, ids int, n_tokens string")
    got = p.report(docs).collect()
    want = sorted(str((i, len(x), x, crc32(np.array(x, "<u4").tobytes()), True))
                  for i, t in rows for x in [library.encode(t or "")])
    assert sorted(str(tuple(r)) for r in got) == want
    assert p.report(docs.limit(0)).collect() == []
    back = p.decode(p.encode(docs)).collect()
    assert sorted(str(tuple(r)) for r in back) == sorted(str((i, t or "")) for i, t in rows)
