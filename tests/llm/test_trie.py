"""Prefix trie against a plain one, over one and over many partitions, with copies and nested beginnings."""

import hashlib
import random
import zlib
from collections import defaultdict
from pathlib import Path

import pytest

from gaugeframe.llm import trie
from gaugeframe.llm.queries import op13_prefix_trie, rebuilt

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain_trie(sequences):
    """Nodes of a dictionary of sequences of (role, text), as rows of ``COLUMNS``."""
    members = defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, rows = {}, {}, set()
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) or 1
        size = len(node[-1][1]) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[c] for c in below)
        ends = ",".join(map(str, sorted(c for c in members[node] if len(sequences[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        found = (min(members[node]), len(node), parent, len(members[node]), len(below), leaves[node], saved[node])
        rows.add((*found, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def ordered(rows):
    """Turns of each conversation in order; rows of one number by their digest."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            found[conv].append((turn is not None, turn or 0, tie, (role, text)))
    return {conv: tuple(t[-1] for t in sorted(turns)) for conv, turns in found.items()}


def plain_rebuilt(own):
    found = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        found[conv] = own.get(base, ())[:h] + turns[h:]
    return found


def got(frame):
    rows = [tuple(r) for r in frame.select(COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def rows_of(sequences):
    return [(conv, i, role, text) for conv, turns in sequences.items() for i, (role, text) in enumerate(turns)]


SCHEMA = "conv_id long, turn long, role string, text string"


def made(kind):
    rng = random.Random(kind)
    if kind == "copies":  # one beginning that fills many partitions, and copies of whole conversations
        start = tuple(("user", f"t{i}" * 3) for i in range(9))
        return {c: start + tuple(("a", str(c // 40))[:2] for _ in range(c % 3)) for c in range(400)}
    if kind == "nested":  # every conversation the beginning of the next
        return {-c: tuple(("u", "x" * (i % 4)) for i in range(c)) for c in range(60)}
    if kind == "same":
        return {c: (("user", "hi"), ("assistant", "ho")) for c in range(300)}
    found = {c: tuple(("u" if d % 2 else "a", rng.choice("pqr") * rng.randint(0, 2)) for d in range(rng.randint(0, 7))) for c in range(300)}
    return {c: t for c, t in found.items() if t}


@pytest.mark.parametrize("kind", ["copies", "nested", "same", "random"])
@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_trie_equals_the_plain_one(spark, kind, partitions):
    sequences = made(kind)
    turns = trie.sequences(spark.createDataFrame(rows_of(sequences), SCHEMA))
    if kind == "nested":  # a conversation without turns is a member of the root
        empty = spark.createDataFrame([(0, [])], turns.schema)
        turns = turns.union(empty)
    settings = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert got(trie.prefix_trie(turns)) == plain_trie(sequences)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_odd_rows_and_rebuilding(spark):
    rows = [(100, 1, "user", "a"), (100, None, None, "b"), (100, 1, "user", "a"), (100, 2, "x", None), (None, 1, "user", "lost")]
    rows += [(c, t, r, f"{c % 3} {t}") for c in range(101, 150) for t, r in enumerate(["user", "assistant"] * (c % 4 + 1))]
    rows += [(-7, 3, "user", "z"), (-107, 3, "u", "sz"), (-107, 3, "us", "z"), (200, 0, "user", ""), (333, 0, "user", ""), (250, 0, "user", "é😀")]
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", key string, size int")
    want = plain_trie(plain_rebuilt(ordered(rows)))
    assert got(trie.prefix_trie(rebuilt(trie.sequences(frame)))) == want
    assert min(r[3] for r in want if r[1] == 0) == len({r[0] for r in rows} - {None})
    assert got(trie.prefix_trie(rebuilt(trie.sequences(frame.limit(0))))) == set()


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test data")
def test_query_equals_the_plain_trie(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op13_prefix_trie(spark, folder)) == plain_trie(plain_rebuilt(ordered(rows)))
