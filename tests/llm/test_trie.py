"""The prefix trie and its contraction against plain recursion."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shopsight.llm import prefix_trie
from shopsight.sources.scratch import materialize
from tests.llm import tables

TURN = "conv_id bigint, turn bigint, role string, text string"
FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = {}
    ends = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        new = own.get(conv - conv % 100, [])[:h] + turns[h:]
        ends.setdefault(tuple(new), []).append(conv)
        for d in range(len(new) + 1):
            members.setdefault(tuple(new[:d]), []).append(conv)
    found = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        leaf = {m: all(len(k) != len(m) + 1 or k[: len(m)] != m for k in below) for m in below}
        found.append(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                sum(len(k) == len(node) + 1 for k in below), sum(leaf.values()),
                sum((len(members[m]) - 1) * len(m[-1][1].decode()) for m in below if m),
                hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def built(spark, rows, extra=False):
    df = spark.createDataFrame(rows, TURN)
    if extra:
        df = df.selectExpr("*", "1 as node", "2 as parent", "3 as part", "'x' as digest", "4 as pos", "5 as n")
    found = prefix_trie.build_trie(materialize(df, "test-conversations")).select(*FIELDS)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("extra", [False, True])
def test_trie_against_brute_force(spark, extra):
    random_ = random.Random(8)
    rows = []
    for conv in [None, *random_.sample(range(400), 120), 1000, 1001]:
        for i in range(random_.randint(1, 9)):
            text = random_.choice(["a", "é日", None, "", "long text"])
            rows.append((conv, random_.choice([i, i, i, None]), random_.choice(["user", "assistant", None]), text))
    assert built(spark, rows + rows[:30], extra) == brute(rows + rows[:30])


def test_many_copies_and_one_long_conversation(spark):
    """Equal conversations end in one node; a conversation longer than a run is aggregated in pieces."""
    rows = [(c, t, "user", f"same {t}") for c in range(200, 260) for t in range(3)]
    rows += [(500, t, "user", f"same {t % 7}") for t in range(90)]
    assert built(spark, rows) == brute(rows)


def test_runs_do_not_change_names(spark, monkeypatch):
    rows = [(500 + c, t, "user", f"x{min(t, c)}") for c in range(3) for t in range(40)]
    whole = built(spark, rows)
    monkeypatch.setattr(prefix_trie, "RUN", 4)
    assert built(spark, rows) == whole == brute(rows)


def test_turnless_and_empty(spark):
    """A conversation whose base is absent and whose own turns are all replaced belongs to the root alone."""
    conv = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 2)
    rows = [(conv, 0, "user", "gone"), (conv, 1, "user", "gone too")]
    assert built(spark, rows) == brute(rows) and len(brute(rows)) == 1
    assert built(spark, [(None, 1, "user", "x")]) == []


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_contraction(spark, shape):
    random_ = random.Random(2)
    n = 300
    up = {i: {"chain": i - 1, "star": 0, "random": random_.randrange(max(0, i - 5), i)}[shape] for i in range(1, n)}
    value = [random_.randint(0, 9) for _ in range(n)]
    total = value[:]
    for i in range(n - 1, 0, -1):
        total[up[i]] += total[i]
    rows = [((i, -i), (up[i], -up[i]) if i else None, value[i]) for i in range(n)]
    node = "struct<a: bigint, b: bigint>"
    tree = materialize(spark.createDataFrame(rows, f"node {node}, parent {node}, v bigint"), "test-tree")
    found = {r.node.a: r.v for r in prefix_trie.subtree_totals(tree, ["v"]).collect()}
    assert found == dict(enumerate(total))


def test_long_lists_are_hashed_in_pieces(spark):
    ends = spark.range(30_000).select(F.expr("named_struct('a', id div 20000, 'b', 0L)").alias("node"), F.col("id").alias("conv_id"))
    found = {r.node.a: r.ends_sha256 for r in prefix_trie.ends_digests(materialize(ends, "test-ends")).collect()}
    for i, numbers in enumerate((range(20_000), range(20_000, 30_000))):
        assert found[i] == hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
