"""Token-id files: against the tokenizers library, single-document access, odd inputs."""

import random
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from veritab.llm import token_store as t
from veritab.sources.files import shared_dir


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(t.tokenizer_path())


def whole(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [t.END_ID]


def test_word_encoder_matches_whole_texts(library, monkeypatch):
    rng = random.Random(9)
    letters = "abcDEéñß 　\n\t\r.,!?'0123ÜΣЖ中🙂́ﬁ \x1c\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2500)]
    pieces = ["The", "straße", "ÀÉ", "ÿ", "don't", "!!", "(", "<|", "|>", "endoftext", "_", "x", "9", "'s", "ª", "×", "ÇA"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 4))) for _ in range(2500)]
    texts += ["don't we'll 's", "ΑΣ ΟΔΟΣ ΑΣ.", "<|endoftext|> ab<|startoftext|>c", "ab</w> c", "İstanbul", "e ́", ""]
    monkeypatch.setattr(t, "WORD_CACHE", 300)
    monkeypatch.setattr(t, "RUN_CACHE", 100)
    encode = t.WordEncoder(t.tokenizer_path())
    assert encode.plain
    for lo in range(0, len(texts), 100):
        for text, got in zip(texts[lo:lo + 100], encode(texts[lo:lo + 100])):
            assert np.frombuffer(got, "<u4").tolist() == whole(library, text), text


def test_blob_gives_one_document_and_checks_its_dictionary():
    import hashlib

    import zstandard

    ids = [np.arange(k, dtype="<u4") for k in (1, 700, 3)]
    frames = [zstandard.ZstdCompressor().compress(x.tobytes()) for x in ids]
    rows = [(None, 1, frames[0]), (5, 700, frames[1]), (9, 3, frames[2])]
    blob = t.Blob(t.pack(rows, hashlib.sha256(b"").digest()), b"")
    assert (blob.ids(1) == ids[1]).all() and (blob.ids(2) == ids[2]).all()
    assert blob.index["null"].tolist() == [1, 0, 0] and blob.index["doc_id"].tolist() == [0, 5, 9]
    with pytest.raises(ValueError, match="dictionary"):
        t.Blob(t.pack(rows, hashlib.sha256(b"x").digest()), b"")
    with pytest.raises(ValueError, match="shard"):
        t.Blob(b"something else" * 9, b"")


def rows_of(n):
    rng = random.Random(4)
    rows = [(i * 7 % 1009, " ".join(rng.choice(["thing", "ouch", "Zwölf", "12,5"]) for _ in range(rng.randint(0, 60))))
            for i in range(n)]
    return rows + [(3000, None), (3001, ""), (2, "twice"), (2, "twice"), (2, "other thing"), (None, "no id"),
                   (-8, "below"), (3002, "long " * 50_000)]


def test_store_round_trip(spark, library, monkeypatch):
    monkeypatch.setattr(t, "SHARD_BYTES", 2000)
    rows = rows_of(300)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start int, frame string")
    path = t.write_store(docs, shared_dir(spark, "store"))
    got = sorted(t.read_store(spark, path).collect(), key=lambda r: r["start"])
    coded = sorted((-10 ** 9 if i is None else i, len(x), x) for i, tx in rows for x in [whole(library, tx)])
    assert [(-10 ** 9 if r["doc_id"] is None else r["doc_id"], r["n_tokens"]) for r in got] == [c[:2] for c in coded]
    assert sorted((r["n_tokens"], r["ids"]) for r in got) == sorted(c[1:] for c in coded)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    digests = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in t.read_digests(spark, path).collect()}
    assert digests == {(r["doc_id"], r["start"]): crc32(np.array(r["ids"], "<u4").tobytes()) for r in got}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert t.digest_report(docs).collect() == []
