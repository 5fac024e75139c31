"""Repair of conversations against an exhaustive search, with one chunk and with many."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache
from pathlib import Path

import numpy as np
import pytest

from gaugeframe.llm import repair
from gaugeframe.llm.queries import damaged, op11_conversation_repair

COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
GOOD = re.compile(r"(s?(ua)+)?\Z")


def damage(rows):
    """The damaged rows of each conversation in order, by the rules as stated."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv]
        role, text = " " if role is None else role, " " if text is None else text
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(name.encode()) % 20
        if fault == 4:
            role = "user"
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        found[conv] += [(turn is not None, turn or 0, tie, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return {conv: sorted(turns) for conv, turns in found.items()}


def cheapest(turns):
    """Cost and least letters, by memoised search over (turn, roles so far in short)."""

    def short(roles):  # what the rest may depend on
        return roles if len(roles) < 2 and "a" not in roles else roles[-1]

    can_go_on = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state):
        options = []
        if i == len(turns) and state in ("", "a"):
            options.append((0, ""))
        for role in "ua":
            if role in can_go_on[state] and inserted[0] < 3:
                inserted[0] += 1
                cost, letters = best.__wrapped__(i, role)
                inserted[0] -= 1
                options.append((cost + 5, "I" + letters))
        if i < len(turns):
            initial, must_go, cut = turns[i]
            cost, letters = best(i + 1, state)
            options.append((cost + 2, "D" + letters))
            if not must_go:
                if initial and initial in can_go_on[state]:
                    cost, letters = best(i + 1, initial)
                    options.append((cost + 5 * cut, "K" + letters))
                for role in "ua":
                    if role in can_go_on[state]:
                        cost, letters = best(i + 1, role)
                        options.append((cost + 1 + 5 * cut, "R" + letters))
        return min(options) if options else (10**9, "")

    inserted = [0]
    return best(0, "")


def plain(rows):
    results = set()
    for conv, turns in damage(rows).items():
        numbers = {n for there, n, *_ in turns if there}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        seen, faults, marks = set(), [0, 0, 0], []
        for *_, role, text in turns:
            words = text.strip("\t\n\v\f\r ")
            fault = 0 if not words else 1 if (role, text) in seen else 2 if words[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                faults[fault] += 1
            marks.append((role[:1], fault < 2, fault == 2))
        initials = [role[:1] for *_, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(tuple(marks))
        lines, at, state = [], 0, ""
        for letter in audit:
            follow = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            if letter == "I":
                lines.append(f"{follow}:")
                state = follow[0]
                continue
            role, text = turns[at][3:]
            at += 1
            if letter != "D":
                role = follow if letter == "R" else role
                lines.append(f"{role}:{text}")
                state = role[0]
        assert GOOD.match("".join(line[0] for line in lines)) and at == len(turns)
        results.add((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return results


def got(frame):
    rows = [tuple(r) for r in frame.select(COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    made = []
    for conv in range(120):
        for turn in range(rng.choice([1, 2, 5, 9, 30])):
            role = rng.choices(["user", "assistant", "system", "tool", "", "u", None, "ärzte"], [6, 6, 2, 1, 1, 1, 1, 1])[0]
            text = rng.choices(["Yes.", "no", "Why?\n ", "", " \t", None, " ", "Hm…", f"T{turn}."], [4, 3, 2, 1, 1, 1, 1, 1, 9])[0]
            number = None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 7])
            made.append((conv, number, role, text))
    made += [(None, i, "user", "a.") for i in range(3)] + [(500, None, "user", "Q."), (500, None, "assistant", "A.")]
    made += [(600, 4, "user", "same.")] * 50 + [(700, i, "tool", "cut") for i in range(40)]
    dropped = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*made, (dropped, 0, "user", "gone.")]


@pytest.mark.parametrize("chunk", [repair.CHUNK, 1, 3])
def test_repair_equals_the_search(spark, rows, chunk):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", digest string, kind int")
    want = plain(rows)
    found = got(repair.repair(damaged(frame), chunk))
    assert found == want
    empty = hashlib.sha256(b"").hexdigest()
    assert any(r[1:] == (0, 0, 0, 0, 0, 0, "", empty) for r in want)


def test_empty_table(spark):
    assert got(repair.repair(damaged(spark.createDataFrame([], SCHEMA)))) == set()


def test_costs_of_a_chunk_are_fixed_up():
    rng = random.Random(3)
    codes = bytes(rng.choices([0, 1, 2, 3, 6, 7], [1, 1, 6, 6, 1, 1], k=300))
    gone = np.array(rng.choices([0, 3], [9, 1], k=301))
    speculated = repair.backward(codes, gone, repair.END)
    for ahead in [(7, 0, 5, 2), (0, 5, 5, 0), (100, 100, 100, 100), (3, 8, 3, 3)]:
        assert repair.fixed_up(codes, gone, speculated, ahead) == repair.backward(codes, gone, ahead)
    assert repair.relative(speculated[0]) == repair.relative(repair.backward(codes, gone, (0, 5, 5, 0))[0])


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test data")
def test_query_equals_the_search(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_conversation_repair(spark, folder)) == plain(rows)
