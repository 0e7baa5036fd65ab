"""The conversation trie against a brute-force one."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    def digest(t):
        return hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[0], t[1], digest(t)))] for c, ts in own.items()}
    walks = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        t = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        walks[c] = tuple(own.get(t, [])[:h] + turns[h:])
    members = {}
    for c, walk in walks.items():
        for d in range(len(walk) + 1):
            members.setdefault(walk[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    def below(node):
        leaves, saved = 0, 0
        stack = [node]
        while stack:
            at = stack.pop()
            leaves += at not in children
            saved += (len(members[at]) - 1) * len(at[-1][1]) if at else 0
            stack += children.get(at, [])
        return leaves, saved
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(walks[c]) == len(node)))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            len(children.get(node, [])), *below(node), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[1], r[0]))


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def talks(seed, convs, longest, words):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, turn, rng.choice(["user", "bot"]), "w" * rng.randrange(words)))
    return rows


SMALL = [
    {},
    {"band": 3, "shard_turns": 5, "ids_per_group": 4, "broadcast_nodes": 0},
    {"band": 2, "shard_turns": 30, "ids_per_group": 2},
    {"shard_turns": 12},
]


@pytest.mark.parametrize("sizes", SMALL)
def test_trie_equals_brute_force(spark, sizes):
    rows = talks(3, range(0, 260), 9, 2) + talks(4, range(-130, -90), 4, 3) + talks(5, [1001, 1002, 1150], 5, 4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(prefix_trie.conversation_trie(df, **sizes)) == brute(rows)


@pytest.mark.parametrize("sizes", SMALL[:2])
def test_odd_rows(spark, sizes):
    rows = talks(7, range(100, 130), 6, 3) + [
        (None, 1, "user", "no conversation"),
        (100, None, "user", "first"),
        (101, 0, None, None),
        (101, 0, "", ""),
        (102, 2, "user", "again"),
        (102, 2, "user", "again"),
        (103, 3, "user", "é日本" * 5000),
        (104, 3, "a", "b:c"),
        (105, 3, "ab", ":c"),
        (777, 1, None, "template is absent"),
        (778, 1, "x", "y"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "pos", "digest", "size", "root", "path", "id", "ends", "n", "_piece", "depth", "band"):
        df = df.withColumn(name, F.lit(name))
    assert got(prefix_trie.conversation_trie(df, **sizes)) == brute(rows)


def test_copies_and_a_long_conversation(spark):
    """A third of all turns in one conversation, and a third in equal conversations."""
    long = [(200, i, "user", str(i % 3)) for i in range(120)] + [(300, i, "user", str(i % 3)) for i in range(90)]
    copies = [(c, i, "bot", "same") for c in range(1000, 1100) for i in range(2)]
    rows = long + copies + talks(8, range(400, 420), 6, 2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    sizes = {"band": 40, "shard_turns": 20, "ids_per_group": 10, "broadcast_nodes": 3}
    assert got(prefix_trie.conversation_trie(df, rows_per_task=25, **sizes)) == want
    assert got(prefix_trie.conversation_trie(df)) == want


def test_empty_table(spark):
    assert got(prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA))) == []
    assert got(prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))) == []


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    lonely = next(c for c in range(5001, 5100) if zlib.crc32(str(c).encode()) % 6 > 0)
    rows = [(lonely, 0, "user", "gone")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie.conversation_trie(df)) == brute(rows) == [
        (lonely, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lonely).encode()).hexdigest())
    ]


def test_double_array_holds_every_path_and_no_other():
    rng = random.Random(2)
    walks = sorted({tuple(rng.randrange(40) for _ in range(rng.randrange(1, 7))) for _ in range(500)})
    starts = np.concatenate([[0], np.cumsum([len(w) for w in walks])])
    trie = prefix_trie.DoubleArray(np.concatenate([np.array(w) for w in walks]), starts)
    nodes = {w[:d] for w in walks for d in range(len(w) + 1)}
    assert sum(len(level) for level in trie.levels) == len(nodes)
    assert (trie.check >= 0).sum() == len(nodes) - 1  # every slot but the root's has its parent
    for node in nodes:
        state = np.array([0])
        for symbol in node:
            state = trie.step(state, np.array([symbol]))
        for symbol in range(40):
            child = trie.base[state[0]] + symbol
            is_child = 0 <= child < len(trie.check) and trie.check[child] == state[0]
            has = any(n[: len(node) + 1] == (*node, symbol) for n in nodes) if len(node) < 2 else (*node, symbol) in nodes
            if has:
                assert is_child
