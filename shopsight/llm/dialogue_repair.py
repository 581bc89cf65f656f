"""Conversation structure repair by a Viterbi search whose survivors coalesce.

A conversation's roles must read `(s?(ua)+)?` by their initials. Every turn is kept
(0), given another role (3) or deleted (4; required if blank or a repetition), turns
without text are inserted (3), and a cut-off turn costs 3 unless deleted. The cheapest
edits win, among equals the ASCII-least string of their initials.

`Survivors` is the search: one survivor per state of the pattern, in a tree of
backpointers with reference counts. As soon as all survivors share an ancestor the
edits up to it are emitted and freed; a tie is decided by comparing the whole
unresolved strings back to the common ancestor.

Turns are range-sorted by conversation and turn, so that one conversation may span
many tasks, and cut into blocks of at most `BLOCK_ROWS` turns. A conversation within
one block is solved there. For every block of the others the search gives the best
edits from each state to each state; a second search over these, block by block with
no texts, joins them, and the edits go back to the blocks. Only the digest of a
whole conversation (one hash over all of its text) reads it in sequence, as a stream.

Defined cases: a null role or text is one space; turns are ordered by number (null
first), then role and text; a null identifier names one conversation; repeated rows
are repetitions; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.sources.scratch import materialize

BLOCK_ROWS = 1024
BLOCK_BYTES = 1 << 20
PART_BYTES = 64 << 20
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
CUT_OFF = 3
LEGAL = {"su", "ua", "au"}

# States of the pattern: nothing yet, after the system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT, END = range(5)
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)
_NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {"u": "user", "a": "assistant"}
Option = tuple[int, int, int, str]
# What it costs at most to go on from the first state as if it were the second: inserted turns lead to a user or
# assistant turn; what may follow SYSTEM or ASSISTANT may follow EMPTY; after ASSISTANT, a system turn that EMPTY
# would keep is deleted. A survivor that costs more than another and this can never win, not even by a tie.
_STAND_IN = {
    (EMPTY, SYSTEM): 0, (EMPTY, USER): 3, (EMPTY, ASSISTANT): 0,
    (SYSTEM, EMPTY): 10, (SYSTEM, USER): 3, (SYSTEM, ASSISTANT): 6,
    (USER, EMPTY): 7, (USER, SYSTEM): 3, (USER, ASSISTANT): 3,
    (ASSISTANT, EMPTY): 4, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): 3,
}


class _Node:
    __slots__ = ("label", "parent", "users")

    def __init__(self, label: str, parent: _Node | None):
        self.label, self.parent, self.users = label, parent, 0


class Survivors:
    """The cheapest, ASCII-least way to each state, fed step by step; see the module."""

    def __init__(self, start: int):
        self.root = _Node("", None)
        self.best = {start: (0, self.root)}

    def step(self, options: list[Option]) -> list[str]:
        """Go on by (from, to, cost, label); the labels that are settled by now, one per step."""
        found: dict[int, tuple[int, _Node, str]] = {}
        for source, target, cost, label in options:
            if source in self.best:
                before, node = self.best[source]
                here = found.get(target)
                if here is None or before + cost < here[0] or before + cost == here[0] and _less(node, label, *here[1:]):
                    found[target] = (before + cost, node, label)
        old = [node for _, node in self.best.values()]
        self.best = {}
        for target, (cost, node, label) in found.items():
            if any(found[other][0] + extra < cost for (other, as_), extra in _STAND_IN.items() if as_ == target and other in found):
                continue
            node.users += 1
            self.best[target] = (cost, _Node(label, node))
        for node in old:
            while node.users == 0 and node.parent is not None:  # a way that no survivor uses
                parent, node.parent = node.parent, None
                parent.users -= 1
                node = parent
        return self._settled()

    def _settled(self) -> list[str]:
        if self.root.users != 1:
            return []
        tips = {id(node) for _, node in self.best.values()}
        way, node = [], next(iter(self.best.values()))[1]
        while node is not self.root:
            way.append(node)
            node = node.parent
        labels = []
        while way and self.root.users == 1 and id(self.root) not in tips:
            self.root = way.pop()
            self.root.parent = None
            labels.append(self.root.label)
        return labels

    def rest(self, state: int) -> list[str]:
        """The labels on the way to `state` that are not settled."""
        labels, node = [], self.best[state][1]
        while node is not self.root:
            labels.append(node.label)
            node = node.parent
        return labels[::-1]


def _less(a: _Node, label_a: str, b: _Node, label_b: str) -> bool:
    """Whether the way over `a` reads less than the one over `b`, from their common ancestor on."""
    ends_a, ends_b = [label_a], [label_b]
    while a is not b:
        ends_a.append(a.label)
        ends_b.append(b.label)
        a, b = a.parent, b.parent
    return "".join(reversed(ends_a)) < "".join(reversed(ends_b))


def _after_inserts(state: int) -> list[tuple[int, str]]:
    """States within reach of inserted turns, each with the least number of them."""
    found, inserts = {state: ""}, ""
    while True:
        state = _NEXT.get((state, "u"), _NEXT.get((state, "a")))
        inserts += INSERT
        if state in found:
            return list(found.items())
        found[state] = inserts


def turn_options(initial: str, fault: str | None) -> list[Option]:
    """What may be done with a turn. An insert before a deletion never reads less than one after it."""
    options = [(state, state, COSTS[DELETE], DELETE) for state in STATES]
    if fault in ("blank", "duplicate"):
        return options
    extra = CUT_OFF if fault == "truncated" else 0
    for state in STATES:
        for between, inserts in _after_inserts(state):
            for edit, letters in ((KEEP, initial), (REROLE, "ua")):
                for letter in letters:
                    if (between, letter) in _NEXT:
                        cost = COSTS[INSERT] * len(inserts) + COSTS[edit] + extra
                        options.append((state, _NEXT[between, letter], cost, inserts + edit))
    return options


CLOSING: list[Option] = [
    (state, END, COSTS[INSERT] * len(inserts), inserts)
    for state in STATES
    for between, inserts in _after_inserts(state)
    if between in (EMPTY, ASSISTANT)
]
_OPTIONS = {
    (initial, fault): turn_options(initial, fault)
    for initial in ("s", "u", "a", "")
    for fault in (None, "blank", "duplicate", "truncated")
}


def options_of(role: str, fault: str | None) -> list[Option]:
    return _OPTIONS.get((role[:1], fault)) or _OPTIONS["", fault]


def fault_of(text: str, repeated: bool) -> str | None:
    body = text.rstrip(BLANKS)
    return "blank" if not body else "duplicate" if repeated else None if body[-1] in ".!?" else "truncated"


def apply_edits(turns: list[tuple[str, str]], edits: str, state: int = EMPTY) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that stay; `state` is the one before the first of them."""
    rows = iter(turns)
    for edit in edits:
        role, text = ("", "") if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        letter = role[:1] if edit == KEEP else "a" if state == USER else "u"
        state = _NEXT[state, letter]
        yield edit, role if edit == KEEP else ROLES[letter], text


# Blocks of consecutive turns of one conversation.

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PATH = "struct<start: int, finish: int, cost: bigint, edits: string>"
BLOCKS = (
    "conv_id long, name string, part int, seq int, whole boolean, turns array<struct<role: string, text: string>>, "
    + "".join(f"{c} long, " for c in _COUNTS)
    + "first_turn long, last_turn long, n_turns long, first_initial string, last_initial string, "
    + f"paths array<{_PATH}>"
)
_BLOCK_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("name", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_())]
    + [("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]
    + [(c, pa.int64()) for c in (*_COUNTS, "first_turn", "last_turn", "n_turns")]
    + [("first_initial", pa.string()), ("last_initial", pa.string())]
    + [("paths", pa.list_(pa.struct([("start", pa.int32()), ("finish", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])))]
)


def solve(steps: list[list[Option]], start: int, closed: bool) -> list[dict]:
    """The best edits from `start` to every state after the steps, or to the end of the conversation."""
    search, edits = Survivors(start), []
    for options in [*steps, *([CLOSING] if closed else [])]:
        edits += search.step(options)
    return [
        {"start": start, "finish": state, "cost": cost, "edits": "".join(edits + search.rest(state))}
        for state, (cost, _) in search.best.items()
    ]


def _block(turns: list[dict], seq: int, whole: bool, starts: tuple[int, ...]) -> dict:
    faults = [t["fault"] for t in turns]
    initials = [t["role"][:1] for t in turns]
    known = [t["turn"] for t in turns if t["turn"] is not None]
    steps = [options_of(t["role"], fault) for t, fault in zip(turns, faults)]
    return {
        **{name: turns[0][name] for name in ("conv_id", "name", "part")},
        "seq": seq,
        "whole": whole,
        "turns": [{"role": t["role"], "text": t["text"]} for t in turns],
        **{fault: faults.count(fault) for fault in _COUNTS[:3]},
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first_turn": min(known, default=None),
        "last_turn": max(known, default=None),
        "n_turns": len(set(known)),
        "first_initial": initials[0],
        "last_initial": initials[-1],
        "paths": [path for start in starts for path in solve(steps, start, whole)],
    }


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Sorted turns with their first fault; a row equal to the one before it is a repetition."""
    last = None
    for batch in batches:
        for turn in batch.to_pylist():
            here = (turn["name"], turn["turn"], turn["role"], turn["text"])
            turn["fault"] = fault_of(turn["text"], turn["later"] or here == last)
            last = here
            yield turn


def _pieces(turns: Iterator[dict], block_rows: int) -> Iterator[list[dict]]:
    held, size = [], 0
    for turn in turns:
        if held and (len(held) >= block_rows or size >= BLOCK_BYTES):
            yield held
            held, size = [], 0
        held.append(turn)
        size += len(turn["text"])
    yield held


def _cut(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a sorted partition. Only its first and last conversations may go on in other partitions."""
    out: list[dict] = []
    pending: tuple[list[dict], int] | None = None  # the last block of the conversation at hand
    first = True

    def ready(closes: bool) -> None:
        turns, seq = pending
        inside = seq == 0 and not first
        out.append(_block(turns, seq, inside and closes, (EMPTY,) if inside else STATES))

    for _, turns in groupby(_turns(batches), key=lambda t: t["name"]):
        if pending:
            ready(closes=True)
            first = False
        pending = None
        for seq, piece in enumerate(_pieces(turns, block_rows)):
            if pending:
                ready(closes=False)
            pending = (piece, seq)
        if len(out) >= 500:
            yield from pa.Table.from_pylist(out, _BLOCK_SCHEMA).to_batches()
            out = []
    if pending:
        ready(closes=False)
    if out:
        yield from pa.Table.from_pylist(out, _BLOCK_SCHEMA).to_batches()


def blocks(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The stored blocks of all conversations (columns conv_id, turn, role, text are read); see BLOCKS."""
    spark = conversations.sparkSession
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("conv_id").cast("long").cast("string"), space).alias("name"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    keyed = rows.withColumn("said", said)
    again = keyed.groupBy("name", "said").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = materialize(again.drop("n"), "repair-repeated")  # the planner sees its size
    marked = keyed.join(again, ["name", "said"], "left").withColumn("later", F.coalesce(place > F.col("first"), F.lit(False)))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, 1 + total // PART_BYTES)
    order = ["name", "turn", "role", "text"]
    ranged = marked.select("conv_id", *order, "later").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialize(ranged.withColumn("part", F.spark_partition_id()).mapInArrow(lambda b: _cut(b, block_rows), BLOCKS), "repair-blocks")


# Conversations of several blocks: a search over blocks.

_SETTLED = "name string, part int, seq int, state int, edits string, " + "".join(f"{c} long, " for c in _COUNTS) + "gaps long, cost long"
_LAST = 2**31 - 1  # where a conversation's closing row stands


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For sorted blocks: the edits of each as they settle, then one row of totals per conversation."""
    schema = pa.schema(
        [("name", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("state", pa.int32()), ("edits", pa.string())]
        + [(c, pa.int64()) for c in (*_COUNTS, "gaps", "cost")]
    )
    rows = (row for batch in batches for row in batch.to_pylist())
    for name, group in groupby(rows, key=lambda r: r["name"]):
        search, waiting, state = Survivors(EMPTY), [], EMPTY
        totals = dict.fromkeys(_COUNTS, 0)
        first = last = initial = None
        n_turns, n_blocks = 0, 0

        def settled(labels: list[str]) -> Iterator[dict]:
            nonlocal state
            for edits in labels:
                part, seq = waiting.pop(0)
                yield {"name": name, "part": part, "seq": seq, "state": state, "edits": edits}
                state = finishes.pop(0).get((state, edits), END)

        finishes: list[dict[tuple[int, str], int]] = []
        for row in group:
            options = [(p["start"], p["finish"], p["cost"], p["edits"]) for p in row["paths"]]
            finishes.append({(p["start"], p["edits"]): p["finish"] for p in row["paths"]})
            waiting.append((row["part"], row["seq"]))
            for c in _COUNTS:
                totals[c] += row[c]
            if n_blocks and initial + row["first_initial"] not in LEGAL:
                totals["illegal"] += 1
            initial = row["last_initial"]
            if row["n_turns"]:
                n_turns += row["n_turns"] - (row["first_turn"] == last)
                first, last = row["first_turn"] if first is None else first, row["last_turn"]
            n_blocks += 1
            yield from _batches(list(settled(search.step(options))), schema)
        waiting.append((_LAST, 0))
        finishes.append({})
        out = list(settled(search.step(CLOSING) + search.rest(END)))
        out[-1] |= totals | {"gaps": 0 if first is None else last - first + 1 - n_turns, "cost": search.best[END][0]}
        yield from _batches(out, schema)


def _batches(rows: list[dict], schema: pa.Schema) -> list[pa.RecordBatch]:
    return pa.Table.from_pylist(rows, schema).to_batches() if rows else []


# Output: blocks with their edits applied.

_PIECE_FIELDS = "conv_id long, name string, part int, seq int, edits string, turns array<struct<edit: string, role: string, text: string>>"
PIECES = _PIECE_FIELDS + ", closes boolean, " + "".join(f"{c} long, " for c in _COUNTS) + "gaps long, cost long"
_PIECE_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("name", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("edits", pa.string())]
    + [("turns", pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])))]
    + [("closes", pa.bool_())]
    + [(c, pa.int64()) for c in (*_COUNTS, "gaps", "cost")]
)


def _stay(row: dict) -> Iterator[tuple[str, str, str]]:
    return apply_edits([(t["role"], t["text"]) for t in row["turns"] or []], row["edits"], row["state"])


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            row["turns"] = [{"edit": e, "role": r, "text": t} for e, r, t in _stay(row)]
            out.append({name: row[name] for name in _PIECE_SCHEMA.names})
        yield from _batches(out, _PIECE_SCHEMA)


def _decided(conversations: DataFrame, block_rows: int) -> DataFrame:
    """Blocks with their edits, the state before them and, on a conversation's last row, its totals."""
    cut = blocks(conversations, block_rows)
    one = cut.where("whole").select(
        "conv_id", "name", "part", "seq", F.col("paths")[0]["edits"].alias("edits"), "turns", F.lit(EMPTY).alias("state"),
        F.lit(True).alias("closes"), *_COUNTS,
        F.coalesce(F.expr("last_turn - first_turn + 1 - n_turns"), F.lit(0)).cast("long").alias("gaps"),
        F.col("paths")[0]["cost"].alias("cost"),
    )
    many = cut.where("not whole")
    stream = many.drop("turns", "conv_id").repartition("name").sortWithinPartitions("name", "part", "seq")
    settled = materialize(stream.mapInArrow(_combined, _SETTLED), "repair-settled")
    bodies = many.select("conv_id", "name", "part", "seq", "turns")
    placed = settled.join(bodies, ["name", "part", "seq"], "left").select(
        F.expr("cast(nullif(name, ' ') as bigint)").alias("conv_id"),
        "name", "part", "seq", "edits", "turns", "state", F.expr(f"part = {_LAST}").alias("closes"), *_COUNTS, "gaps", "cost",
    )
    return one.unionByName(placed.repartition("name").sortWithinPartitions("name", "part", "seq"))


def repair(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired conversations in pieces, ordered by (part, seq) within each.

    Rows: conv_id, name, edits (initials), turns (edit, role, text; deleted ones left out), and on the row that
    `closes` a conversation its faults and cost.
    """
    return _decided(conversations, block_rows).mapInArrow(_applied, PIECES)


AUDITED = "conv_id long, " + "".join(f"{c} long, " for c in ("gaps", *_COUNTS, "cost")) + "audit string, repaired_sha256 string"


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(c, pa.int64()) for c in ("conv_id", "gaps", *_COUNTS, "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
    )
    hashed, audit, separator = hashlib.sha256(), [], ""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            for _, role, text in _stay(row):
                hashed.update(f"{separator}{role}:{text}".encode())
                separator = "\n"
            audit.append(row["edits"])
            if row["closes"]:
                out.append({n: row.get(n) for n in schema.names[:-2]})
                out[-1] |= {"audit": "".join(audit), "repaired_sha256": hashed.hexdigest()}
                hashed, audit, separator = hashlib.sha256(), [], ""
        yield from _batches(out, schema)


def audit(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation: its faults, cost, edits and a digest of its repaired turns."""
    return _decided(conversations, block_rows).mapInArrow(_audited, AUDITED)


def damaged(conversations: DataFrame) -> DataFrame:
    """Faults put in by a hash of conversation and turn: of 20 remainders, 0 drops a turn, 1 empties it, 2 takes
    its sentence ends away, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    as_text = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(as_text[0], F.lit(":"), as_text[1]).cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = conversations.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text")).where("kind <> 0")
    bare = F.regexp_replace("text", "[.!?]", "")
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("*", copies.alias("copy")).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, bare).otherwise(F.col("text")).alias("text"),
    )
