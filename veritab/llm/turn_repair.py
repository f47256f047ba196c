"""Conversation structure repair by Knuth's lightest-derivation agenda.

A repair takes every row of a conversation by one edit - Keep, Rerole, Delete - and may Insert
turns between them; the roles that are left must read ``(s?(ua)+)?``. It is found as a
lightest derivation. Items are

* ``("edit", i, e)``: row ``i`` can be edited by ``e`` (axioms, weighted by the edit's cost);
* ``("insert", r)``: a turn of role ``r`` can be inserted (axioms);
* ``("row", i, q)``: rows before ``i`` are repaired, the roles so far leave the grammar in state
  ``q``, and nothing was inserted since;
* ``("gap", i, q)``: the same, and inserts after the last row are done;
* ``("goal",)``: the whole conversation is repaired.

Hyperedges derive an item from one or two others: ``gap(i, q) + edit(i, e) -> row(i + 1, q')``,
``gap(i, q) + insert(r) -> gap(i, q')``, ``row(i, q) -> gap(i, q)``, ``gap(n, q) -> goal``. A weight is
``(cost, audit)``; a hyperedge adds costs and joins audits. That is superior (never less than
any antecedent) and monotone: two audits of one item never begin with one another, as each
determines the state it reaches. So the agenda pops items in order of weight, each final when
popped, and stops when the goal is.

Rows pass in order; after every ``CHUNK`` of them only the four ``row`` items are kept, their audits
replaced by their rank (no audit of theirs begins another, so the rank decides as they do)
and linked to what came before. A conversation of any length holds its letters and one chunk.
"""

from __future__ import annotations

from hashlib import sha256
from heapq import heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.llm.common import Scratch, aliased, arrow_rows, lean, ship
from veritab.llm.turns import ROWS, by_key, conv_key, rows_of, turn_rows, write_batches

# What edits cost, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
# state and role initial -> state
GRAMMAR = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
           (USER, "a"): ASSISTANT}
ENDS = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
CHUNK = 512
CACHE = 50_000   # short conversations whose repair a worker remembers by their rows' kinds
NONE = "."       # the initial of a row whose role starts with none of s, u, a


def edits(kind: str) -> list[tuple[int, str, str | None]]:
    """``(cost, letter, role initial)`` of the edits of a row. Its kind is its role's initial, in
    upper case if the text is truncated, or ``x`` if it has to go."""
    if kind == "x":
        return [(DELETE, "D", None)]
    more = TRUNCATED if kind.isupper() or kind == "," else 0
    found = [(DELETE, "D", None)]
    own = kind.lower()
    if own in "sua":
        found.append((more, "K", own))
    found += [(REROLE + more, "R", r) for r in ROLES if r != own]
    return found


def lightest(kinds: str, begin: dict[int, tuple[int, str]], last: bool):
    """The agenda over some rows, from ``row`` items with the weights ``begin``. With ``last`` the goal's
    ``(cost, audit)``, else those of the ``row`` items after the last row, by state."""
    n = len(kinds)
    agenda: list = []
    final: dict = {}
    partners: dict = {}   # places of final items that wait for a second antecedent

    def push(weight, item):
        if item not in final:
            heappush(agenda, (weight, item))

    for q, weight in begin.items():
        push(weight, ("row", 0, q))
    for role in ROLES:
        push((INSERT, "I"), ("insert", role))
    for i, kind in enumerate(kinds):
        for cost, letter, role in edits(kind):
            push((cost, letter), ("edit", i, letter, role or ""))

    def join(place, state, edit):
        """The hyperedge of a ``gap`` item and an edit or an insert, if the grammar allows it."""
        role = edit[-1]
        after = state if not role else GRAMMAR.get((state, role))
        if after is not None:
            (c0, a0), (c1, a1) = final["gap", place, state], final[edit]
            to = ("gap", place, after) if edit[0] == "insert" else ("row", place + 1, after)
            push((c0 + c1, a0 + a1), to)

    ends = {}
    while agenda:
        weight, item = heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if item[0] == "goal":
            return weight
        if item[0] == "row":
            if item[1] == n and not last:
                ends[item[2]] = weight
                if len(ends) == 4:
                    break
                continue
            push(weight, ("gap", *item[1:]))
        elif item[0] == "gap":
            _, i, q = item
            if i == n and q in ENDS:
                push(weight, ("goal",))
            for edit in partners.get(("edits", i), ()):
                join(i, q, edit)
            for edit in partners.get("inserts", ()):
                join(i, q, edit)
            partners.setdefault(("gaps", i), []).append(q)
            partners.setdefault("gaps", []).append((i, q))
        elif item[0] == "edit":
            for q in partners.get(("gaps", item[1]), ()):
                join(item[1], q, item)
            partners.setdefault(("edits", item[1]), []).append(item)
        else:
            for i, q in partners.get("gaps", ()):
                join(i, q, item)
            partners.setdefault("inserts", []).append(item)
    return ends


class Repair:
    """Takes a conversation's rows in order (``add`` their kinds), then gives ``(cost, audit)``."""

    known: dict[str, tuple[int, str]] = {}

    def __init__(self):
        self.kinds: list[str] = []
        # state: (cost, linked audit), in the order of the audits
        self.states: dict[int, tuple[int, tuple]] = {START: (0, ())}

    def add(self, kind: str) -> None:
        if len(self.kinds) == CHUNK:
            self._fold()
        self.kinds.append(kind)

    def _begin(self):
        """The states' weights with ranks in place of audits, and the audits by rank."""
        return {q: (cost, chr(k)) for k, (q, (cost, _)) in enumerate(self.states.items())}, \
            [link for _, link in self.states.values()]

    def _fold(self):
        begin, links = self._begin()
        ends = lightest("".join(self.kinds), begin, False)
        self.states = {q: (cost, (links[ord(audit[0])], audit[1:]))
                       for q, (cost, audit) in sorted(ends.items(), key=lambda end: end[1][1])}
        self.kinds = []

    def result(self) -> tuple[int, str]:
        kinds = "".join(self.kinds)
        if list(self.states.items()) != [(START, (0, ()))]:
            begin, links = self._begin()
            cost, audit = lightest(kinds, begin, True)
            return cost, _text(links[ord(audit[0])]) + audit[1:]
        if kinds not in self.known:
            if len(self.known) > CACHE:
                self.known.clear()
            self.known[kinds] = lightest(kinds, {START: (0, "")}, True)
        return self.known[kinds]


def _text(link: tuple) -> str:
    pieces = []
    while link:
        link, piece = link
        pieces.append(piece)
    return "".join(reversed(pieces))


def edited(rows, audit: str):
    """``(role, text, letter)`` of a conversation's repaired turns; ``rows`` gives ``(role, text)``."""
    state = START
    rows = iter(rows)
    for letter in audit:
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter != "K":
            role = ROLES["a" if state == USER else "u"]
        state = GRAMMAR[state, role[:1]]
        yield role, text, letter


# ----------------------------------------------------------------------- plan

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
PLAN = T.StructType([T.StructField("conv", T.StringType()),
                     *[T.StructField(c, T.LongType()) for c in COUNTS],
                     T.StructField("audit", T.StringType())])


def plans(rows: DataFrame) -> DataFrame:
    """A row for each conversation of ``rows`` (see ``turn_rows``): its faults and its lightest repair.

    Only hashes, role initials and what was found in the texts is shuffled."""
    initial = F.substring("role", 1, 1)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    again = Window.partitionBy("conv", "a", "b").orderBy(F.col("turn").asc_nulls_first())
    columns = ["conv", "turn", "initial", "blank", "whole", "again"]
    narrow = (rows.select("conv", "turn", "a", "b", initial.alias("initial"), blank.alias("blank"),
                          whole.alias("whole"))
              .repartition("conv").withColumn("again", F.row_number().over(again) > 1)
              .sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "a", "b").select(columns))

    def plan(turns):
        repair = Repair()
        blank = duplicate = truncated = illegal = distinct = 0
        least = most = before = None
        for _, turn, initial, is_blank, whole, again in turns:
            if turn is not None and turn != most:
                least = turn if least is None else least
                most, distinct = turn, distinct + 1
            illegal += before is not None and before + initial not in LEGAL
            before = initial
            kind = initial if initial in ("s", "u", "a") else NONE
            if is_blank:
                blank += 1
                kind = "x"
            elif again:
                duplicate += 1
                kind = "x"
            elif not whole:
                truncated += 1
                kind = "," if kind == NONE else kind.upper()
            repair.add(kind)
        cost, audit = repair.result()
        gaps = most - least + 1 - distinct if distinct else 0
        return gaps, blank, duplicate, truncated, illegal, cost, audit

    def run(batches):
        found = ((key[0], *plan(turns)) for key, turns in by_key(rows_of(batches, columns)))
        yield from write_batches(found, PLAN)

    ship(rows.sparkSession)
    return narrow.mapInArrow(lean(run), PLAN)


def planned_rows(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Every conversation's plan, then its rows in order: ``(conv, head, counts, audit, role, text)``."""
    counts = F.array(*COUNTS)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "bigint"), ("a", "bigint"), ("b", "bigint"),
                                                         ("role", "string"), ("text", "string"))]
    heads = plan.select("conv", F.lit(0).alias("head"), counts.alias("counts"), "audit", *nothing)
    texts = rows.select("conv", F.lit(1).alias("head"), F.lit(None).cast("array<bigint>").alias("counts"),
                        F.lit(None).cast("string").alias("audit"), F.col("turn").cast("bigint").alias("turn"),
                        "a", "b", "role", "text")
    return (heads.unionByName(texts).repartition("conv")
            .sortWithinPartitions("conv", "head", F.col("turn").asc_nulls_first(), "a", "b")
            .select("conv", "head", "counts", "audit", "role", "text"))


def _repaired(batches):
    """``(conv, counts, audit, turns)`` of each conversation in a stream of ``planned_rows``."""
    columns = ["conv", "head", "counts", "audit", "role", "text"]
    for key, rows in by_key(rows_of(batches, columns)):
        _, _, counts, audit, _, _ = next(rows)
        yield key[0], counts, audit, edited((r[4:] for r in rows), audit)


def repaired_turns(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired conversations: ``(conv, place, role, text, edit)``, places from 0."""
    schema = T.StructType.fromDDL("conv string, place bigint, role string, text string, edit string")

    def run(batches):
        found = ((conv, k, *turn) for conv, _, _, turns in _repaired(batches) for k, turn in enumerate(turns))
        yield from write_batches(found, schema, ROWS)

    return planned_rows(rows, plan).mapInArrow(lean(run), schema)


def digests(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The plans with the hash of the repaired ``role:text`` lines. Turns are hashed as they come."""
    schema = T.StructType(PLAN.fields + [T.StructField("repaired_sha256", T.StringType())])

    def digest(turns):
        h = sha256()
        for k, (role, text, _) in enumerate(turns):
            h.update((("\n" if k else "") + role + ":" + text).encode())
        return h.hexdigest()

    def run(batches):
        found = ((conv, *counts, audit, digest(turns)) for conv, counts, audit, turns in _repaired(batches))
        yield from write_batches(found, schema)

    return planned_rows(rows, plan).mapInArrow(lean(run), schema)


def report(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every
    different ``conv_id`` of ``conversations`` (null is one of them), from its rows in ``rows``.

    Null roles and texts are one space. Rows of one turn are taken in the order of their hashes;
    repeated rows are duplicates. A conversation without rows has zeros, an empty audit and the
    hash of the empty string. Other columns are ignored; an empty table gives an empty result."""
    spark = rows.sparkSession
    turns = turn_rows(rows, " ")
    scratch = Scratch(spark)
    plan = scratch.keep(plans(turns), "repair-plans")
    with arrow_rows(spark, ROWS):
        found = scratch.keep(digests(turns, plan), "repair-digests")
    scratch.drop("repair-plans")
    ids, at, _ = aliased(conversations)
    ids = ids.select(F.col(at["conv_id"]).alias("conv_id")).distinct().withColumn("conv", conv_key())
    empty = {**{c: 0 for c in PLAN.names[1:-1]}, "audit": "", "repaired_sha256": sha256(b"").hexdigest()}
    return ids.join(found, "conv", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in empty.items()])


def damage(conversations: DataFrame) -> DataFrame:
    """The rows as a faulty export leaves them: by crc32 of ``conv_id:turn`` modulo 20 a row is
    dropped (0), loses its text (1) or its ``[.!?]`` (2), comes twice (3) or gets the role user (4).
    Nulls count as one space, in that key as well."""
    rows, at, _ = aliased(conversations)
    c = {n: F.col(at[n]) for n in ("conv_id", "turn", "role", "text")}
    space = lambda x: F.coalesce(x.cast("string"), F.lit(" "))
    rows = rows.select(c["conv_id"].alias("conv_id"), c["turn"].alias("turn"),
                       space(c["role"]).alias("role"), space(c["text"]).alias("text"),
                       (F.crc32(F.concat(space(c["conv_id"]), F.lit(":"), space(c["turn"])).cast("binary")) % 20)
                       .alias("roll"))
    roll = F.col("roll")
    text = (F.when(roll == 1, "").when(roll == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    return (rows.where("roll <> 0")
            .withColumn("times", F.explode(F.array_repeat(F.lit(1), F.when(roll == 3, 2).otherwise(1))))
            .select("conv_id", "turn", F.when(roll == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text")))
