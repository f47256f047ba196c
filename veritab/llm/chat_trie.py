"""Chat formatting over a prefix tree of conversations.

Every turn is written by a template that marks its role and its end; control strings inside
texts and roles are escaped reversibly. Conversations that share their first turns share
those nodes of the tree: a sequence holds the tokens of a part of the tree, each node's once, in
depth-first order. A node has the position id of its first token (the others follow), and the
attention intervals of its ancestors: runs of tokens of the same sequence. A token sees these
intervals and its own node up to itself, which is just what it would see alone.

How the tree is cut into sequences is decided on hashes alone. Prefixes are told apart by chained
128-bit hashes; a prefix belongs to the least conversation that has it, and a conversation's own
turns are the rest of its path. Sorted by the places where conversations leave their owners
(deepest first, as the owner's own turns come before what branches off them), conversations
stand in depth-first order; that order is dealt into ranges and cut into sequences of about
``SEQUENCE`` characters. A prefix shared by any number of conversations is a node of one sequence
after another, not a group in a task: the first conversation of a sequence brings its whole
path, every other one its own turns only. Copies of a conversation bring nothing.

A sequence row holds at most about ``PIECE`` tokens; a conversation beyond that goes on in further
rows of its sequence, where intervals count on. Reading back walks a sequence once and keeps the
digests of the path on a stack, at those nodes only where conversations end or branch off.
"""

from __future__ import annotations

import re
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.llm.common import Scratch, aliased, arrow_rows, lean, ship, worker_cache
from veritab.llm.turns import ROWS, by_key, rows_of, turn_rows, write_batches

# The template's control strings.
OPEN = {"system": "<<SYS>>", "user": "[INST]", "assistant": "<s>"}
CLOSE = {"system": "<</SYS>>", "user": "[/INST]", "assistant": "</s>"}
ROLE_OPEN, ROLE_CLOSE, OTHER_CLOSE = "[ROLE]", "[/ROLE]", "</s>"   # of any other role
CONTROL = [*OPEN.values(), *CLOSE.values(), ROLE_OPEN, ROLE_CLOSE]
SAMPLE_TEXT = "</s>[INST] ok [/INST]"   # fixed value: what both turns of conversation -1 say

SEQUENCE = 131_072         # characters of a sequence's own turns, about
PIECE = 262_144            # tokens of a sequence row, about
SPLIT = 100_000            # characters that the tokenizer is handed at a time
BROADCAST_ROWS = 500_000   # up to so many conversations' places are broadcast; else joined by shuffle

_ESCAPED = re.compile(r"\\|[\[<](?=" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")")

_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    r"""A backslash after the first character of every control string, and after every backslash;
    no control string is left. (``[INST]`` becomes ``[\INST]``, ``\`` becomes ``\\``.)"""
    return _ESCAPED.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    r"""The inverse: of ``\`` and the character after it, the latter."""
    return _ESCAPE.sub(r"\1", text) if "\\" in text else text


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """A turn as the template has it: what stands before its text, the text, and after it."""
    if role in OPEN:
        return OPEN[role], escape(text), CLOSE[role]
    return ROLE_OPEN + escape(role) + ROLE_CLOSE, escape(text), OTHER_CLOSE


def parse_turn(formatted: str) -> tuple[str, str]:
    """``(role, text)`` of one formatted turn."""
    for role, opens in OPEN.items():
        if formatted.startswith(opens) and formatted.endswith(CLOSE[role]):
            return role, unescape(formatted[len(opens):-len(CLOSE[role])])
    if not (formatted.startswith(ROLE_OPEN) and formatted.endswith(OTHER_CLOSE)):
        raise ValueError(f"no turn of the template: {formatted[:40]!r}")
    role, _, text = formatted[len(ROLE_OPEN):-len(OTHER_CLOSE)].partition(ROLE_CLOSE)
    return unescape(role), unescape(text)


@worker_cache
def tokenizer(path: str):
    """A byte-level tokenizer of ranked byte strings; nothing of a text is special to it."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def encode(tok, text: str) -> list[int]:
    out: list[int] = []
    for at in range(0, len(text), SPLIT):
        out += tok.encode_ordinary(text[at:at + SPLIT])
    return out


# ----------------------------------------------------------------------- tree

PREFIXES = T.StructType([T.StructField("conv", T.StringType()), T.StructField("k", T.LongType()),
                         T.StructField("h", T.BinaryType()), T.StructField("size", T.LongType()),
                         T.StructField("turn", T.LongType()), T.StructField("run", T.LongType())])


def prefixes(rows: DataFrame) -> DataFrame:
    """``(conv, k, h, size, turn, run)`` of every row: its place in the conversation, the hash of the
    conversation up to it, its characters, its turn, and the place of that turn's first row.
    Conversations stream through their tasks; only hashes are shuffled."""
    columns = ["conv", "turn", "a", "b", "size"]
    size = F.length("text") + F.length("role") + 16

    def chained(rows):
        from struct import pack

        from xxhash import xxh3_128_digest

        for _, turns in by_key(rows):
            h, run, before = b"", 0, None
            for k, (conv, turn, a, b, size) in enumerate(turns):
                h = xxh3_128_digest(h + pack("<qq", a, b))
                run = run if k and turn == before else k
                before = turn
                yield conv, k, h, size, turn, run

    def work(batches):
        yield from write_batches(chained(rows_of(batches, columns)), PREFIXES)

    narrow = (rows.select("conv", F.col("turn").cast("bigint").alias("turn"), "a", "b",
                          size.cast("bigint").alias("size")).repartition("conv")
              .sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "a", "b").select(columns))
    return narrow.mapInArrow(lean(work), PREFIXES)


def paths(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """A row for each conversation: ``path``, the owners of its prefixes with the places from ``lo`` to
    ``hi`` each owns, and of what it owns itself (null: nothing) the first place ``own``, that row's
    ``turn``, the place ``run`` of that turn's first row, and the characters ``chars``."""
    turns = scratch.keep(prefixes(rows), "chat-prefixes")
    # only prefixes of several conversations: all others own themselves. Written first, so that both
    # sides of the join come fresh to it and Spark can split a prefix that most conversations share
    owner = scratch.keep(turns.groupBy("h", "k").agg(F.min("conv").alias("owner"), F.count("*").alias("n"))
                         .where("n > 1").select("h", "k", "owner"), "chat-owners")
    if owner.count() <= BROADCAST_ROWS:
        owner = F.broadcast(owner)
    spans = (turns.join(owner, ["h", "k"], "left").withColumn("owner", F.coalesce("owner", "conv"))
             .groupBy("conv", "owner")
             .agg(F.min(F.struct("k", "turn", "run")).alias("first"), F.max("k").alias("hi"),
                  F.sum("size").alias("chars")))
    path = F.array_sort(F.collect_list(F.struct(F.col("first.k").alias("lo"), "hi", "owner")))
    mine = F.max(F.when(F.col("owner") == F.col("conv"), F.struct("first", "chars")))
    return (spans.groupBy("conv").agg(path.alias("path"), mine.alias("mine"))
            .select("conv", "path", F.col("mine.first.k").alias("own"), F.col("mine.first.turn").alias("turn"),
                    F.col("mine.first.run").alias("run"), F.col("mine.chars").alias("chars")))


def places(path: DataFrame, scratch: Scratch) -> DataFrame:
    """``(conv, seq, place, leads, own, own_turn, run)`` of every conversation with turns of its own: its
    sequence, its place in it, and whether it is the sequence's first."""
    order = F.transform("path", lambda p: F.struct((-p["lo"]).alias("up"), p["owner"].alias("owner")))
    ranged = scratch.keep(
        path.where("own IS NOT NULL")
        .select("conv", "own", F.col("turn").alias("own_turn"), "run", "chars", order.alias("order"))
        .repartitionByRange("order").withColumn("part", F.spark_partition_id()), "chat-order")
    along = Window.partitionBy("part").orderBy("order")
    before = F.coalesce(F.sum("chars").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    seq = F.col("part").cast("bigint") * 2 ** 32 + F.floor(F.col("before") / SEQUENCE)
    return (ranged.withColumn("before", before).withColumn("place", F.row_number().over(along))
            .withColumn("seq", seq)
            .withColumn("leads", F.coalesce(F.lag("seq").over(along) != F.col("seq"), F.lit(True)))
            .select("conv", "seq", "place", "leads", "own", "own_turn", "run"))


def marks(path: DataFrame) -> DataFrame:
    """``(conv, k)`` of the nodes, by owner and place, where conversations end or branch off."""
    last = F.element_at("path", -1)
    fork = F.element_at("path", -2)
    ends = path.select(last["owner"].alias("conv"), last["hi"].alias("k"))
    forks = path.where("own > 0").select(fork["owner"].alias("conv"), fork["hi"].alias("k"))
    return ends.unionByName(forks).distinct()


# ------------------------------------------------------------------ sequences

_LONG = T.LongType()
INTERVAL = T.StructType([T.StructField("start", _LONG), T.StructField("end", _LONG)])
NODE = T.StructType([
    T.StructField("conv", T.StringType()),      # who brought it
    T.StructField("turn", _LONG),               # its depth
    T.StructField("start", _LONG),              # its tokens' place in the sequence
    T.StructField("length", _LONG),
    T.StructField("position", _LONG),           # the position id of its first token
    T.StructField("loss_from", _LONG),          # which of its tokens are under the loss mask
    T.StructField("loss_to", _LONG),
    T.StructField("mark", T.BooleanType()),     # conversations end or branch off here
    T.StructField("again", T.BooleanType()),    # the node's first copy is in another sequence
    T.StructField("ancestors", T.ArrayType(INTERVAL))])
SEQUENCES = T.StructType([
    T.StructField("seq", _LONG), T.StructField("piece", _LONG), T.StructField("last", T.BooleanType()),
    T.StructField("tokens", T.ArrayType(T.IntegerType())), T.StructField("nodes", T.ArrayType(NODE))])


class Branch:
    """The path to the node written last: its depth, position and runs of tokens."""

    __slots__ = ("turn", "position", "runs", "begin", "end")

    def __init__(self, turn=0, position=0, runs=(), begin=0, end=0):
        self.turn, self.position, self.runs, self.begin, self.end = turn, position, runs, begin, end

    def ancestors(self) -> list[tuple[int, int]]:
        """All tokens of the path as runs, in order. (Runs are linked to those before them.)"""
        found = [(self.begin, self.end)] if self.end > self.begin else []
        runs = self.runs
        while runs:
            runs, *own = runs
            found.append(tuple(own))
        return found[::-1]

    def copy(self) -> "Branch":
        return Branch(self.turn, self.position, self.runs, self.begin, self.end)


def lay_out(rows, path: str):
    """Sequence rows of ``(seq, place, head, k, conv, leads, own, own_turn, run, role, text)`` in order:
    of each conversation its marks (``head`` 0, with ``k``), then its turns."""
    tok = tokenizer(path)
    short = {c: encode(tok, c) for c in CONTROL}

    def tokens(text):
        return short[text] if text in short else encode(tok, text)

    for (seq,), conversations in by_key(rows):
        at, piece, held, nodes, first = 0, 0, [], [], 0
        tip, forks = Branch(), []
        for _, turns in by_key(conversations, 2):
            marked, k, done = [], None, 0
            for _, _, head, mark, conv, leads, own, own_turn, run, role, text in turns:
                if head == 0:
                    marked.append(mark)
                    continue
                if k is None:     # its first turn: go back to where it branches off
                    k = 0 if leads or own_turn is None else run
                    while forks and forks[-1].turn > own:
                        forks.pop()
                    if leads or own == 0:
                        tip, forks = Branch(begin=at, end=at), []
                    else:
                        tip = forks[-1].copy()
                        tip.runs, tip.begin, tip.end = (tip.runs, tip.begin, tip.end), at, at
                if k >= own or leads:
                    pre, body, post = map(tokens, turn_parts(role, text))
                    whole = pre + body + post
                    while done < len(marked) and marked[done] < k:
                        done += 1
                    again = k < own
                    mark = again or done < len(marked) and marked[done] == k
                    loss = (len(pre), len(pre) + len(body)) if role == "assistant" else (0, 0)
                    nodes.append((conv, k, at, len(whole), tip.position, *loss, mark, again, tip.ancestors()))
                    held += whole
                    at += len(whole)
                    tip.turn, tip.position, tip.end = k + 1, tip.position + len(whole), at
                    if mark:
                        forks.append(tip.copy())
                    if at - first >= PIECE:
                        yield seq, piece, False, np.array(held, np.int32), nodes
                        piece, held, nodes, first = piece + 1, [], [], at
                k += 1
        yield seq, piece, True, np.array(held, np.int32), nodes


def sequences(rows: DataFrame, place: DataFrame, mark: DataFrame, path: str) -> DataFrame:
    """The packed prefix tree (see ``SEQUENCES``) of ``turn_rows``."""
    columns = ["seq", "place", "head", "k", "conv", "leads", "own", "own_turn", "run", "role", "text"]
    if place.count() <= BROADCAST_ROWS:
        place = F.broadcast(place)
    texts = (rows.select("conv", F.col("turn").cast("bigint").alias("turn"), "a", "b", "role", "text")
             .join(place, "conv").where("leads OR own_turn IS NULL OR turn >= own_turn")
             .withColumn("head", F.lit(1)).withColumn("k", F.lit(0).cast("bigint")))
    none = {c: F.lit(None).cast(t) for c, t in (("turn", "bigint"), ("a", "bigint"), ("b", "bigint"),
                                                ("role", "string"), ("text", "string"))}
    heads = mark.join(place, "conv").withColumn("head", F.lit(0)).withColumns(none)

    def work(batches):
        yield from write_batches(lay_out(rows_of(batches, columns), path), SEQUENCES, 1)

    return (texts.unionByName(heads).repartition("seq")
            .sortWithinPartitions("seq", "place", "head", "k", F.col("turn").asc_nulls_first(), "a", "b")
            .select(columns).mapInArrow(lean(work), SEQUENCES))


def model_inputs(tokens: list[int], nodes: list) -> dict:
    """A whole sequence as a trainer takes it: token ids, position ids, the loss mask, and for each
    token the intervals it attends to."""
    position, loss, sees = [], [], []
    for n in nodes:
        position += range(n["position"], n["position"] + n["length"])
        loss += [n["loss_from"] <= k < n["loss_to"] for k in range(n["length"])]
        above = [tuple(a) for a in n["ancestors"]]
        sees += [above + [(n["start"], n["start"] + k + 1)] for k in range(n["length"])]
    return {"input_ids": list(tokens), "position_ids": position, "loss_mask": loss, "attention": sees}


# ------------------------------------------------------------------ read back

DIGEST = T.StructType([
    T.StructField("owner", T.StringType()), T.StructField("hi", _LONG), T.StructField("n_turns", _LONG),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", _LONG),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", _LONG)])


class Digest:
    """What is known of a path after its last node."""

    __slots__ = ("end", "n", "turns", "chars", "loss", "formatted")

    def __init__(self):
        self.end, self.n, self.chars, self.formatted = 0, 0, 0, 0
        self.turns, self.loss = sha256(), sha256()

    def copy(self) -> "Digest":
        new = Digest.__new__(Digest)
        new.end, new.n, new.chars, new.formatted = self.end, self.n, self.chars, self.formatted
        new.turns, new.loss = self.turns.copy(), self.loss.copy()
        return new

    def add(self, before: str, masked: str, after: str, end: int) -> None:
        whole = before + masked + after
        role, text = parse_turn(whole)
        self.turns.update(f"{role}\n{text}\n".encode())
        masked = unescape(masked)
        self.loss.update(masked.encode())
        self.n, self.chars, self.formatted, self.end = self.n + 1, self.chars + len(masked), \
            self.formatted + len(whole), end


def sequence_rows(batches):
    """``(seq, piece, tokens, nodes)`` of Arrow batches of sequences; tokens are an array."""
    for batch in batches:
        seq, piece = (batch.column(c).to_pylist() for c in ("seq", "piece"))
        tokens, nodes = batch.column("tokens"), batch.column("nodes")
        for k in range(batch.num_rows):
            yield seq[k], piece[k], tokens[k].values.to_numpy(zero_copy_only=False), nodes[k].as_py()


def read_digests(rows, path: str):
    """Digests of the conversations' last nodes, from sequence rows in order."""
    tok = tokenizer(path)
    for _, pieces in by_key(rows):
        tip, kept, first = Digest(), [], 0
        for _, _, tokens, nodes in pieces:
            for n in nodes:
                above = n["ancestors"]
                if sum(a["end"] - a["start"] for a in above) != n["position"]:
                    raise ValueError(f"the ancestors of {n['conv']}:{n['turn']} do not reach its position")
                if not above:
                    tip, kept = Digest(), []
                elif above[-1]["end"] != tip.end:
                    while kept[-1].end != above[-1]["end"]:
                        kept.pop()
                    tip = kept[-1].copy()
                at = n["start"] - first
                cuts = [at, at + n["loss_from"], at + n["loss_to"], at + n["length"]]
                parts = [tok.decode_bytes(tokens[a:b].tolist()).decode() for a, b in zip(cuts, cuts[1:])]
                tip.add(*parts, n["start"] + n["length"])
                if n["mark"]:
                    kept.append(tip.copy())
                    if not n["again"]:
                        yield (n["conv"], n["turn"], tip.n, tip.turns.hexdigest(), tip.chars,
                               tip.loss.hexdigest(), tip.formatted)
            first += len(tokens)


def digests(packed: DataFrame, path: str) -> DataFrame:
    """``DIGEST`` rows of a packed table. A sequence of one row is read where it lies; the rows of
    longer ones are brought together in order."""
    columns = ["seq", "piece", "tokens", "nodes"]

    def work(batches):
        yield from write_batches(read_digests(sequence_rows(batches), path), DIGEST, 1024)

    whole = F.col("last") & (F.col("piece") == 0)
    longer = packed.where(~whole).select(columns).repartition("seq").sortWithinPartitions("seq", "piece")
    return (packed.where(whole).select(columns).mapInArrow(lean(work), DIGEST)
            .unionByName(longer.mapInArrow(lean(work), DIGEST)))


def pack(rows: DataFrame, scratch: Scratch, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(packed, members)`` of ``turn_rows``: the sequences, and each conversation's last node."""
    path = path or default_tokenizer()
    ship(rows.sparkSession)
    way = scratch.keep(paths(rows, scratch), "chat-paths")
    place = scratch.keep(places(way, scratch), "chat-places")
    with arrow_rows(rows.sparkSession, ROWS):
        packed = scratch.keep(sequences(rows, place, marks(way), path), "chat-sequences")
    last = F.element_at("path", -1)
    return packed, way.select("conv", last["owner"].alias("owner"), last["hi"].alias("hi"))


def report(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` of every conversation,
    read back from the packed sequences.

    Null texts and roles are empty; null ids are one conversation; rows of one turn stand in the
    order of their hashes, repeated rows are turns of their own; other columns are ignored; an
    empty table gives an empty result."""
    path = path or default_tokenizer()
    rows = turn_rows(conversations)
    scratch = Scratch(conversations.sparkSession)
    packed, members = pack(rows, scratch, path)
    with arrow_rows(conversations.sparkSession, 1):
        read = scratch.keep(digests(packed, path), "chat-digests")
    scratch.drop("chat-prefixes", "chat-owners", "chat-order", "chat-places", "chat-sequences")
    conv_id = F.expr("substring(conv, 2)").cast(rows.schema["conv_id"].dataType)
    return members.join(read, ["owner", "hi"]).select(
        F.when(F.col("conv") != "", conv_id).alias("conv_id"), *DIGEST.names[2:])


def with_sample(conversations: DataFrame) -> DataFrame:
    """The rows and conversation -1, whose two turns are control strings."""
    columns = ["conv_id", "turn", "role", "text"]
    rows, at, _ = aliased(conversations)
    rows = rows.select(*[F.col(at[c]).alias(c) for c in columns])
    sample = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", SAMPLE_TEXT), (-1, 1, "assistant", SAMPLE_TEXT)],
        "conv_id bigint, turn bigint, role string, text string")
    return rows.unionByName(sample.select(*[F.col(c).cast(rows.schema[c].dataType) for c in columns]))
