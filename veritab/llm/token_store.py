"""Token ids as binary files: every document's ids are compressed on their own with one
shared zstandard dictionary, behind an offset index for access to single documents.

A store is a folder with two tables, so any file system that Spark writes to will do, and
Spark's committer makes a retried task's shard replace the lost one:

* ``dictionary``: one row, the trained dictionary and its SHA-256;
* ``shards``: one row a shard: its number, first and last id, counts and the blob.

A blob is: magic, 32 bytes of dictionary hash, number of documents, then per document its
id (with a null flag), its number of token ids and the offset of its frame, then the
frames. Numbers are little-endian. Documents are in ascending id order across the shards.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.llm.common import Scratch, chunks, map_texts, ship, worker_cache
from veritab.sources.files import shared_dir

MAGIC = b"TIDS0001"
END_ID = 1                 # appended to each document
END = END_ID.to_bytes(4, "little")
SAMPLE_DOCS = 2000         # bound: documents the dictionary is trained on
SAMPLE_IDS = 4000          # bound: longer id arrays are not trained on
DICTIONARY_BYTES = 65536
LEVEL = 3
SHARD_BYTES = 4 << 20      # a shard is closed beyond this many bytes of frames
BROADCAST_SHARDS = 200_000  # up to so many, the shards' 16-byte starts are broadcast
WORD_CACHE = 300_000       # parts, and runs of letters, whose ids a worker remembers
RUN_CACHE = 400_000        # (memory only)

_HEAD = np.dtype([("magic", "S8"), ("hash", "S32"), ("n", "<u4")])
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n_tokens", "<u8"), ("offset", "<u8")])


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# A run of letters, each one code point with a lower case of one, among ASCII punctuation.
_PLAIN = re.compile(r"([!-&(-/:-@\[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_PROBES = ["Abc", "ÉTÉ", "x!!", "(Zß)", "##a_", "größe,", "</w>", "the:the"]


class WordEncoder:
    """``Tokenizer.encode`` of whole texts by way of their distinct words.

    The tokenizer drops white space and never joins across it, so a text's ids are those of
    its parts between blanks and line breaks, each encoded once by the library. It also
    separates letters from punctuation and ignores case; so where a part is one run of letters
    among punctuation, the run's lower case goes to the library's model alone, which costs a
    third, and is remembered for every spelling. A tokenizer that differs on the probes is
    asked for whole parts only."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Parts(self.part)
        self.runs: dict[str, bytes] = {}       # lower-case letters, or punctuation
        letters = [chr(c) for c in range(0xDF, 0x100) if chr(c) != "÷"]
        self.mapped = str.maketrans({c: "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c))
                                     for c in letters}) if self.tokenizer.pre_tokenizer else {}
        self.plain = bool(self.mapped) and all(self._by_runs(p) in (None, self._whole([p])[0]) for p in _PROBES)

    def _whole(self, parts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in coded]

    def _letters(self, run: str) -> bytes:
        got = self.runs.get(run)
        if got is None:
            mapped = run if run.isascii() else run.translate(self.mapped)
            got = self.runs[run] = array("I", [x.id for x in self.tokenizer.model.tokenize(mapped)]).tobytes()
        return got

    def _signs(self, run: str) -> bytes:
        if not run:
            return b""
        got = self.runs.get(run)
        if got is None:
            got = self.runs[run] = self._whole([run])[0]
        return got

    def _by_runs(self, part: str) -> bytes | None:
        """The ids of a part of letters among punctuation; None for any other part."""
        m = _PLAIN.fullmatch(part)
        if m is None or "<|" in part:          # special tokens look so
            return None
        before, letters, after = m.groups()
        return self._signs(before) + self._letters(letters.lower()) + self._signs(after)

    def part(self, part: str) -> bytes:
        """The ids of a text without blanks and line breaks."""
        if self.plain:
            if part.isascii() and part.isalpha():
                return self._letters(part.lower())
            if (got := self._by_runs(part)) is not None:
                return got
        return self._whole([part])[0]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, end id included, as little-endian unsigned 32-bit integers."""
        if len(self.runs) > RUN_CACHE:
            self.runs.clear()
        look = self.known.__getitem__
        return [b"".join([*map(look, t.replace("\n", " ").split(" ")), END]) for t in texts]


class Parts(dict):
    """Parts of texts with their ids, made when first asked for."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, part: str) -> bytes:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[part] = ids = self.make(part)
        return ids


@worker_cache
def _encoder(path: str) -> WordEncoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordEncoder(path)


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """A dictionary trained on the id arrays of a bounded sample, drawn by id hash; empty
    where the sample is too small to train on."""
    import zstandard

    n = docs.count()
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit("dictionary")), F.lit(1_000_000))
    share = int(1_000_000 * min(1.0, SAMPLE_DOCS / max(1, n))) + 1
    sample = docs.where((draw < share) & (F.char_length("text") <= SAMPLE_IDS)).limit(2 * SAMPLE_DOCS)

    def make():
        encode = _encoder(path)
        return lambda texts: [encode(texts)]

    rows = [r["ids"] for r in map_texts(sample, make, "ids binary").select("ids").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(rows)).as_bytes()
    except zstandard.ZstdError:
        return b""


def _zstd_dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def pack(rows: list[tuple], digest: bytes) -> bytes:
    """A blob from ``(doc_id or None, n_tokens, frame)`` in order."""
    index = np.zeros(len(rows), INDEX)
    index["doc_id"] = [0 if r[0] is None else r[0] for r in rows]
    index["null"] = [r[0] is None for r in rows]
    index["n_tokens"] = [r[1] for r in rows]
    sizes = np.array([len(r[2]) for r in rows], np.uint64)
    index["offset"] = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if rows else 0
    head = np.array([(MAGIC, digest, len(rows))], _HEAD)
    return b"".join([MAGIC, digest, int(head["n"][0]).to_bytes(4, "little"), index.tobytes(),
                     *[r[2] for r in rows]])


class Blob:
    """Reads one shard's blob; ``ids(i)`` decompresses that document alone."""

    def __init__(self, blob: bytes, dictionary: bytes):
        import zstandard

        if blob[:8] != MAGIC:
            raise ValueError("not a token shard")
        if blob[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        n = int.from_bytes(blob[40:44], "little")
        self.index = np.frombuffer(blob, INDEX, n, 44)
        self.data, self.base = blob, 44 + n * INDEX.itemsize
        self.ends = np.append(self.index["offset"][1:], len(blob) - self.base).astype(np.int64)
        zd = _zstd_dictionary(dictionary)
        self.unpack = zstandard.ZstdDecompressor(dict_data=zd).decompress if zd else \
            zstandard.ZstdDecompressor().decompress

    def ids(self, i: int) -> np.ndarray:
        lo = self.base + int(self.index["offset"][i])
        return np.frombuffer(self.unpack(self.data[lo:self.base + int(self.ends[i])]), "<u4")


SHARD_SCHEMA = ("first_id bigint, last_id bigint, n_docs bigint, n_ids bigint, "
                "rank bigint, blob binary")


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None) -> str:
    """Encode every whole text of ``docs(doc_id, text)`` into a new store at ``path``.

    Null and empty texts become the end id alone. Rows come in ascending id order, null
    ids first, equal ids by their frames, so repeated rows are all kept; an empty table
    makes a store without shards. Frames, not texts, go through the one shuffle (a range
    partitioning by id); they are written to the shared folder first, so neither its sampling
    pass nor a lost executor encodes a text again."""
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path()
    dictionary = train_dictionary(docs, tokenizer)
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(bytearray(dictionary), digest.hex())], "dictionary binary, sha256 string"
                          ).coalesce(1).write.parquet(os.path.join(path, "dictionary"))

    def make():
        import zstandard

        encode, zd = _encoder(tokenizer), _zstd_dictionary(dictionary)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zd, write_content_size=True)

        def work(texts):
            sizes, frames = [], []
            for some in chunks(texts):
                for ids in encode(some):
                    sizes.append(len(ids) // 4)
                    frames.append(press.compress(ids))
            return [sizes, frames]
        return work

    scratch = Scratch(spark)
    frames = scratch.keep(map_texts(docs.select("doc_id", "text"), make,
                                   "n_tokens bigint, frame binary"), "token-frames")
    ordered = (frames.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("n_tokens"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n_tokens", "frame"))

    def shards(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, rank = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        held = 0

        def close():
            blob = pack(rows, digest)
            ids = [r[0] for r in rows]
            return pa.RecordBatch.from_pydict({
                "first_id": pa.array([ids[0]], pa.int64()), "last_id": pa.array([ids[-1]], pa.int64()),
                "n_docs": pa.array([len(rows)], pa.int64()),
                "n_ids": pa.array([sum(r[1] for r in rows)], pa.int64()),
                "rank": pa.array([(part << 32) | rank], pa.int64()),
                "blob": pa.array([blob], pa.binary())})

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame")]):
                rows.append(row)
                held += len(row[2])
                if held >= SHARD_BYTES:
                    yield close()
                    rows, held, rank = [], 0, rank + 1
        if rows:
            yield close()

    ship(spark)
    ordered.mapInArrow(shards, T.StructType.fromDDL(SHARD_SCHEMA)).write.parquet(
        os.path.join(path, "shards"))
    scratch.drop("token-frames")
    return path


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of a store; ``start`` counts all ids before."""
    return _read(spark, path, "ids array<bigint>", lambda ids: ids.astype(np.int64).tolist())


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``, the checksum of each document's ids as
    little-endian unsigned 32-bit integers, end id included."""
    return _read(spark, path, "ids_crc32 bigint", lambda ids: crc32(ids.tobytes()))


def _read(spark: SparkSession, path: str, field: str, view) -> DataFrame:
    shards = spark.read.parquet(os.path.join(path, "shards"))
    dictionary = bytes(spark.read.parquet(os.path.join(path, "dictionary")).first()["dictionary"])
    # one small row a shard: the ids before it (a single ordered window over shard counts)
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("rank", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    if shards.count() <= BROADCAST_SHARDS:   # else a join that shuffles the blobs
        starts = F.broadcast(starts)
    schema = T.StructType.fromDDL(f"doc_id bigint, start bigint, n_tokens bigint, {field}")

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(schema)
        for batch in batches:
            for blob, base in zip(batch.column("blob"), batch.column("before").to_pylist()):
                b = Blob(blob.as_py(), dictionary)
                n = b.index["n_tokens"].astype(np.int64)
                got = []
                for i in range(len(n)):
                    ids = b.ids(i)
                    if len(ids) != n[i]:
                        raise ValueError("a frame has another length than its index")
                    got.append(view(ids))
                yield pa.RecordBatch.from_arrays([
                    pa.array(b.index["doc_id"], mask=b.index["null"].astype(bool)),
                    pa.array(base + np.cumsum(n) - n), pa.array(n),
                    pa.array(got, fields.field(3).type)], schema=fields)

    ship(spark)
    return (shards.select("rank", "blob").join(starts, "rank").select("blob", "before")
            .mapInArrow(run, schema))


def digest_report(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    return read_digests(spark, write_store(docs, shared_dir(spark, "tokens")))
