"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text's words, each with its space marks, are taken once per batch, cut where no piece of
the model has the two characters side by side, sorted and walked depth-first as a trie: the
forward scores of a prefix are computed once and reused by everything that begins with it.
No piece crosses a cut, nor a mark after another character, so what is encoded apart can be
joined.

The forward state of a prefix is its best path's score and last piece. For a unigram model
a path's score is the sum of its pieces' scores. For a BPE model a path counts only if each
pair of neighbours stands - merging the two pieces' characters by rank gives the same two
back - which leaves exactly one path, the one that merging by rank ends with: the
segmentation of a whole is the segmentation of what precedes its last piece, and that piece.
Characters without a piece fall back to their UTF-8 bytes.
"""

from __future__ import annotations

import re
from os.path import commonprefix
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame

from veritab.llm.common import chunks, map_texts, worker_cache

MARK = "▁"          # fixed value: stands for a space
UNIGRAM, BPE = 1, 2      # fixed values: model types in a model file
WORD_CACHE = 200_000     # words, and segments, whose ids a worker remembers (memory only)
PAIR_CACHE = 500_000     # neighbours whose standing a worker remembers (memory only)

_MARKED = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _wire(data: bytes) -> dict[int, list]:
    """Fields of one protocol-buffer message: numbers, and byte strings."""
    out: dict[int, list] = {}
    at = 0

    def number() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            value = number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            value = data[at:at + size]
            at += size
        out.setdefault(key >> 3, []).append(value)
    return out


class Model:
    """Pieces, scores and normaliser settings of a SentencePiece model file."""

    NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6   # fixed values: piece types

    def __init__(self, path: str):
        with open(path, "rb") as f:
            top = _wire(f.read())
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.ids: dict[str, int] = {}
        self.bytes = [-1] * 256
        self.unknown = 0
        self.control: set[int] = set()
        for i, raw in enumerate(top[1]):
            m = _wire(raw)
            piece = m[1][0].decode()
            kind = m.get(3, [self.NORMAL])[0]
            self.pieces.append(piece)
            self.scores.append(float(np.frombuffer(m.get(2, [b"\0\0\0\0"])[0], "<f4")[0]))
            if kind == self.BYTE:
                self.bytes[int(piece[3:5], 16)] = i
            elif kind == self.UNKNOWN:
                self.unknown = i
            elif kind == self.CONTROL:
                self.control.add(i)
            elif kind == self.USER:
                raise ValueError("user-defined pieces are not supported")
            else:
                self.ids[piece] = i
        trainer, normalizer = _wire(top[2][0]), _wire(top[3][0])
        self.kind = trainer.get(3, [UNIGRAM])[0]
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("a unigram or BPE model is needed")
        if normalizer.get(2, [b""])[0] or normalizer.get(4, [1])[0]:
            raise ValueError("only models that leave texts as they are are supported")
        self.dummy_prefix = bool(normalizer.get(3, [1])[0])
        self.longest = max(map(len, self.ids))
        ends: dict[str, set[int]] = {}       # by last three characters, the pieces' lengths
        for p in self.ids:
            if len(p) > 2:
                ends.setdefault(p[-3:], set()).add(len(p))
        self.lengths = {e: sorted(n, reverse=True) for e, n in ends.items()}
        # characters that stand side by side in some piece; between any others no piece crosses
        self.joined = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses a word's beginning")

    def merged(self, text: str) -> list[str]:
        """Merging by rank: best score first, leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.scores[k] > best):
                    best, at = self.scores[k], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts


class Encoder:
    """Encodes lists of whole texts; remembers words between lists."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.known: dict[str, bytes] = {}       # words without their first mark
        self.segments: dict[str, bytes] = {}    # words' segments between cuts
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}

    # ---- forward steps

    def _stands(self, left: str, right: str) -> bool:
        key = (left, right)
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            ok = self.pairs[key] = self.model.merged(left + right) == [left, right]
        return ok

    def _piece(self, text: str) -> bool:
        """True if merging a piece's characters gives the piece."""
        ok = self.whole.get(text)
        if ok is None:
            ok = self.whole[text] = self.model.merged(text) == [text]
        return ok

    def _last_bpe(self, word: str, i: int, last: list[str]) -> str:
        ids, lengths, pairs = self.model.ids, self.model.lengths, self.pairs
        for n in lengths.get(word[i - 3:i] if i > 2 else "", ()):
            if n > i:
                continue
            piece = word[i - n:i]
            if piece in ids:
                if n == i:
                    ok = self._piece(piece)
                else:
                    ok = pairs.get((last[i - n], piece))
                    if ok is None:
                        ok = self._stands(last[i - n], piece)
                if ok:
                    return piece
        piece = word[i - 2:i] if i > 1 else ""
        if piece in ids and (self._stands(last[i - 2], piece) if i > 2 else self._piece(piece)):
            return piece
        return word[i - 1:i]

    def _walk(self, words: list[str]) -> None:
        """Depth-first over the trie of sorted ``words``: ``last[i]`` is the last piece
        of the best path to each prefix; what two neighbours share is kept."""
        model, end = self.model, self._last_bpe
        last: list = [""]
        score = [0.0]
        before = ""
        for word in words:
            shared = len(commonprefix((before, word)))
            del last[shared + 1:]
            if model.kind == BPE:
                for i in range(shared + 1, len(word) + 1):
                    last.append(end(word, i, last))
            else:
                del score[shared + 1:]
                for i in range(shared + 1, len(word) + 1):
                    top, piece = self._best_unigram(word, i, score)
                    score.append(top)
                    last.append(piece)
            before = word
            path, i = [], len(word)
            while i:
                path.append(last[i])
                i -= len(last[i])
            self.segments[word] = self._to_bytes(reversed(path))

    def _best_unigram(self, word: str, i: int, score: list[float]) -> tuple[float, str]:
        model = self.model
        unknown = min(model.scores) - 10.0
        best, piece = None, word[i - 1:i]
        for j in range(max(0, i - model.longest), i):
            k = model.ids.get(word[j:i])
            if k is None and j < i - 1:
                continue
            s = score[j] + (unknown if k is None else model.scores[k])
            if best is None or s > best:
                best, piece = s, word[j:i]
        return best, piece

    def _to_bytes(self, path) -> bytes:
        model, out = self.model, []
        for piece in path:
            k = model.ids.get(piece)
            if k is not None:
                out.append(k)
            elif model.bytes[0] >= 0:
                out += [model.bytes[b] for b in piece.encode()]
            else:
                out.append(model.unknown)
        return np.array(out, "<u4").tobytes()

    # ---- texts

    def _cut(self, word: str) -> list[str]:
        joined = self.model.joined
        at = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in joined]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)])] if at else [word]

    def words(self, text: str) -> list[str]:
        """A text's words without their first mark."""
        if not text:
            return []
        if self.model.dummy_prefix and not (
                "  " in text or text[0] == " " or text[-1] == " " or MARK in text):
            return text.split(" ")
        marked = (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)
        found = _MARKED.findall(marked)
        if found and found[0][0] != MARK:     # only without a dummy prefix
            raise ValueError("models without a dummy prefix are not supported")
        return [w[1:] for w in found]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self.words(t) for t in texts]
        wanted = set().union(*parts) if parts else set()
        new = {w: self._cut(MARK + w) for w in wanted if w not in self.known}
        if len(self.known) + len(new) > WORD_CACHE:
            self.known = {w: self.known[w] for w in wanted if w in self.known}
        if len(self.segments) > WORD_CACHE:
            self.segments.clear()
        self._walk(sorted({s for cut in new.values() for s in cut if s not in self.segments}))
        made = self.segments.__getitem__
        self.known.update((w, b"".join(map(made, cut))) for w, cut in new.items())
        look = self.known.__getitem__
        return [b"".join(map(look, p)) for p in parts]


class Decoder:
    """Ids back to text: marks become spaces, runs of bytes their characters."""

    def __init__(self, path: str):
        model = Model(path)
        table = [p.replace(MARK, " ") for p in model.pieces]
        for b, i in enumerate(model.bytes):
            if i >= 0:
                table[i] = chr(b) if b < 128 else chr(0xDC00 + b)
        for i in model.control:
            table[i] = ""
        table[model.unknown] = " ⁇ "   # fixed value: how the format shows an unknown piece
        self.table, self.dummy_prefix = table, model.dummy_prefix

    def __call__(self, ids: list[int]) -> str:
        text = "".join(map(self.table.__getitem__, ids))
        if self.dummy_prefix and text[:1] == " ":
            text = text[1:]
        return text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


@worker_cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@worker_cache
def _decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, path: str | None = None, keep=("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``ids`` (``array<int>``) of every row's whole text.

    Null and empty texts have no ids; repeated rows are encoded each; other columns are
    ignored. No shuffle: distinct words are shared within a task."""
    path = path or model_path()

    def make():
        run = _encoder(path)

        def work(texts):
            import pyarrow as pa

            coded = [x for some in chunks(texts) for x in run(some)]
            ends = np.cumsum([0, *(len(x) // 4 for x in coded)])
            flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]
        return work

    return map_texts(docs, make, "ids array<int>", keep=keep)


def decode(coded: DataFrame, path: str | None = None, keep=("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``text`` from ``ids``; null ids give a null text."""
    path = path or model_path()

    def make():
        run = _decoder(path)
        return lambda rows: [[None if x == "" else run(x) for x in rows]]

    return map_texts(coded, make, "text string", keep=keep, text="ids")


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: ``n_tokens``, the ``ids``, their checksum (as little-endian unsigned
    32-bit integers) and whether decoding them gives the text back (a mark in the text
    itself counts as a space)."""
    path = path or model_path()

    def make():
        run, back = _encoder(path), _decoder(path)

        def work(texts):
            import pyarrow as pa

            coded, same = [], []
            for some in chunks(texts):
                got = run(some)
                coded += got
                same += [back(np.frombuffer(x, "<u4").tolist()) == t.replace(MARK, " ")
                         for x, t in zip(got, some)]
            sizes = [len(x) // 4 for x in coded]
            flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat))
            return [sizes, ids, [crc32(x) for x in coded], same]
        return work

    return map_texts(docs, make, "n_tokens bigint, ids array<int>, ids_crc32 bigint, round_trip boolean")
