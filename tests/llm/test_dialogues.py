"""Conversation repair against a search from the end, which needs no coalescence."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from shopsight.llm import dialogue_repair as repair
from shopsight.llm import queries
from shopsight.sources.scratch import materialize
from tests.llm import tables

TURN = "conv_id bigint, turn bigint, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def brute(rows):
    """The contract's columns for (turn, role, text) rows; nulls are None."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [t for t, _, _ in rows if t is not None]
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(BLANK)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, out, inserts):
        """Least (cost, initials) from row i on, with `out` the role initials so far, cut to what matters."""
        found = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", out):
            found.append((0, ""))

        def add(cost, label, j, more, n):
            grown = out + more
            if not re.fullmatch("s?(ua)*u?", grown):
                return
            body = grown.lstrip("s")
            rest = best(j, grown[: len(grown) - len(body)] + ("u" if len(body) % 2 else "ua" if body else ""), n)
            if rest is not None:
                found.append((cost + rest[0], label + rest[1]))

        if inserts < 4:
            for letter in "ua":
                add(3, "I", i, letter, inserts + 1)
        if i < len(rows):
            add(4, "D", i + 1, "", 0)
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                if rows[i][1][:1] in ("s", "u", "a"):
                    add(extra, "K", i + 1, rows[i][1][:1], 0)
                for letter in "ua":
                    add(3 + extra, "R", i + 1, letter, 0)
        return min(found, default=None)

    for i in range(len(rows), -1, -1):  # from the end, so that no call goes deep
        for out in ("", "s", "su", "sua", "u", "ua"):
            best(i, out, 0)
    cost, edits = best(0, "", 0)
    lines, i = [], 0
    for edit in edits:
        role, text = ("", "") if edit == "I" else rows[i][1:]
        i += edit != "I"
        if edit != "D":
            letter = "a" if lines and lines[-1][0][:1] == "u" else "u"
            lines.append((role if edit == "K" else {"u": "user", "a": "assistant"}[letter], text))
    initials = [r[:1] for _, r, _ in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": edits,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    }


def conversations(seed, n, longest):
    random_ = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for i in range(random_.randint(1, longest)):
            role = random_.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = random_.choice(["Yes.", "No!", "cut", " ", None, "", f"one {i}.", f"two {i}", "a\tb? \n", "é."])
            rows.append((conv, random_.choice([i, i, i, i + 2, None]), role, text))
    return rows


def compare(spark, rows, block_rows, extra=False):
    df = spark.createDataFrame(rows, TURN)
    if extra:
        df = df.selectExpr("*", "'x' as name", "1 as part", "2 as seq", "'y' as fault", "0 as later", "3 as first")
    stored = materialize(df, "test-turns")
    found = {r["conv_id"]: r for r in tables.rows(repair.audit(stored, block_rows))}
    by_conv = {}
    for conv, *turn in rows:
        by_conv.setdefault(conv, []).append(tuple(turn))
    assert set(found) == set(by_conv)
    for conv, turns in by_conv.items():
        assert found[conv] == {"conv_id": conv, **brute(turns)}, turns
    pieces = {}
    for r in sorted(tables.rows(repair.repair(stored, block_rows)), key=lambda r: (r["part"], r["seq"])):
        pieces.setdefault(r["conv_id"], []).append(r)
    for conv, parts in pieces.items():
        assert "".join(p["edits"] for p in parts) == found[conv]["audit"] and [p["closes"] for p in parts].index(True) == len(parts) - 1
        text = "\n".join(f"{t['role']}:{t['text']}" for p in parts for t in p["turns"])
        assert hashlib.sha256(text.encode()).hexdigest() == found[conv]["repaired_sha256"]
    return pieces


@pytest.mark.parametrize(("seed", "block_rows", "extra"), [(1, 1024, False), (2, 1, True), (3, 3, False)])
def test_against_brute_force(spark, seed, block_rows, extra):
    """Blocks of one turn, of some, or of whole conversations give the same rows."""
    compare(spark, conversations(seed, 250, 9), block_rows, extra)


def test_one_conversation_over_many_tasks(spark):
    """A third and more of all rows in one conversation: several partitions hold it."""
    random_ = random.Random(4)
    hot = [(7, i, random_.choice(["user", "assistant"]), random_.choice([f"t{i}.", "again.", f"cut {i}", ""])) for i in range(900)]
    pieces = compare(spark, hot + conversations(5, 100, 6), 50)
    assert len({p["part"] for p in pieces[7]}) > 2


def test_equal_turns_and_empty_table(spark):
    compare(spark, [(1, 0, "user", "Hi.")] * 5 + [(2, None, None, None)] * 3 + [(3, 5, "system", "S.")], 2)
    empty = spark.createDataFrame([], TURN)
    assert repair.audit(empty).count() == 0 and repair.repair(empty).count() == 0


def test_survivors_emit_early_and_hold_little():
    """On a long regular conversation all but the last few edits are settled at any time."""
    search, out = repair.Survivors(repair.EMPTY), []
    for i in range(5000):
        out += search.step(repair.options_of("user" if i % 2 == 0 else "assistant", None))
        assert i + 1 - len(out) < 8
    assert set(out) == {"K"}


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    by_conv = {}
    for conv, turn, role, text in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect():
        kept = by_conv.setdefault(conv, [])
        kind = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    found = tables.rows(queries.op13_dialogue_repair(spark, folder))
    assert {r["conv_id"]: r for r in found} == {c: {"conv_id": c, **brute(turns)} for c, turns in by_conv.items()}
    assert len(found) == len(by_conv)
