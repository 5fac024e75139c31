"""Jaccard join, paragraphs and components against all pairs."""

import random
import re
from pathlib import Path

import numpy as np
import pytest

from gaugeframe.llm import components, jaccard, paragraphs, text
from gaugeframe.storage import checkpoint_root


def groups_of(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    words = [w.translate(UPPER) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


UPPER = {c: c + 32 for c in range(65, 91)}


def linked(a, b):
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def corpus(seed, families=12, copies=8):
    """Families of edited copies, chains in which only neighbours are similar, and fillers."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "ß"]
    texts = [None, "", "  ", "one", "ONE", "One two", "one two", "a b c d e", "A B C D e", "a b c d e f"]
    for f in range(families):
        base = [rng.choice(words) for _ in range(rng.choice([6, 30, 120, 400]))]
        now = list(base)
        for _ in range(copies):
            if f % 3:
                now = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                now[rng.randrange(len(now))] = rng.choice(words)
            texts.append(" ".join(now))
        texts.append(" ".join(base).upper())
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(5, 200))) for _ in range(20)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("tile_sets,broadcast", [(2000, 100), (5, 0)])
def test_join_equals_all_pairs(spark, tile_sets, broadcast):
    texts = corpus(5)
    ids = [1000 - 3 * i for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    sets = {i: shingles(t) for i, t in zip(ids, texts)}
    edges = [(a, b) for a in ids for b in ids if a < b and linked(sets[a], sets[b])]
    want = groups_of(ids, edges)
    found = jaccard.near_duplicates(docs, tile_sets=tile_sets, broadcast_rows=broadcast).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == want and len(found) == len(ids)
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) for r in found)


def test_bitmap_bound_loses_no_link():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, rng.integers(1, 90), dtype=np.uint64)
        sets += [np.unique(np.append(base[rng.random(len(base)) < 0.93], base[:1])) for _ in range(4)]
    ids = list(range(len(sets)))
    pairs = jaccard.linked(ids, sets)
    same = [(a, b) for a in ids for b in ids if a < b and linked(set(sets[a].tolist()), set(sets[b].tolist()))]
    assert groups_of(ids, pairs) == groups_of(ids, same)
    assert len(pairs) == len(ids) - len(set(groups_of(ids, same).values())), "edges of trees only"


def test_similarity_at_the_limit():
    a = np.arange(80, dtype=np.uint64)
    assert jaccard.linked([1, 2], [a, np.arange(100, dtype=np.uint64)]) == [(1, 2)]
    assert jaccard.linked([1, 2], [a[:79], np.arange(100, dtype=np.uint64)]) == []


def test_rows_of_one_id_and_null_ids(spark):
    text = "a b c d e f g h i j k"
    rows = [(7, text), (7, text), (9, text), (None, text), (9, "x y z"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r[0]), r[1], str(r[2])) for r in jaccard.near_duplicates(docs).collect())
    assert found == [("7", 0, "7"), ("7", 7, "7"), ("7", 7, "7"), ("9", 1, "9"), ("9", 7, "7"), ("None", 7, "None")]


def test_texts_that_share_an_id(spark):
    from corpus_pipeline import without_copies

    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(5, a), (5, b), (7, a + " end"), (9, b + " end"), (5, b), (5, "z " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for part in (rows, rows[::-1]):
        found = jaccard.near_duplicates(spark.createDataFrame(part, "doc_id long, text string")).collect()
        assert [(r["doc_id"], r["component_id"]) for r in found if r["doc_id"] > 5] and {r["component_id"] for r in found} == {5}
    kept = sorted((r["doc_id"], r["text"]) for r in without_copies(spark, docs, "").collect())
    assert kept == sorted({(5, a), (5, b), (5, "z " * 3)}), "one row for each component of texts"


def test_components_equal_union_find(spark):
    rng = random.Random(8)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(500, i) for i in range(501, 600)]
    some = [(rng.randint(1000, 1300), rng.randint(1000, 1300)) for _ in range(150)]
    edges = chain + star + some + [(3, 3), (4, 3), (None, 5), (-5, 2000)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(frame).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = groups_of({x for e in real for x in e}, real)
    assert found == want
    assert components.components(frame.limit(0)).count() == 0


def test_paragraphs_equal_all_pairs(spark):
    texts = [t for t in corpus(6, 8, 5) if t] + ["short line"] * 3
    rng = random.Random(1)
    docs, place = [], {}
    for d in range(25):
        lines = [rng.choice(texts) for _ in range(rng.randint(0, 6))]
        docs.append((d, "\n".join(lines)))
        for n, line in enumerate(docs[-1][1].split("\n")):
            if len(line.split()) >= paragraphs.MIN_WORDS:
                place[d, n] = line
    docs += [(90, None), (91, ""), (None, texts[-9])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    sets = {p: shingles(t) for p, t in place.items()}
    edges = [(a, b) for a in place for b in place if a < b and linked(sets[a], sets[b])]
    want = groups_of(list(place), edges)
    sizes = {k: list(want.values()).count(k) for k in want.values()}
    by_id = dict(docs)
    got = {}
    for r in paragraphs.repeated_paragraphs(frame, broadcast_rows=0).collect():
        at = (r["doc_id"], r["line"])
        got[at] = (r["keep_id"], r["keep_line"])
        assert by_id[at[0]][r["start"] : r["end"]] == place[at] and r["n_words"] == len(place[at].split())
        assert r["removed"] == (at != got[at])
    assert got == {p: k for p, k in want.items() if sizes[k] > 1}


def test_passages_that_do_not_keep_to_lines(spark):
    rng = random.Random(12)

    def some(n):
        return [f"é{rng.randrange(10**6)}" for _ in range(n)]

    passage = [w.upper() for w in some(60)]
    wrapped = "\n".join(" ".join(passage[i : i + 7]) for i in range(0, 60, 7))
    uneven = " ".join(some(30) + passage[:30]) + "\n" + " ".join(passage[30:] + some(40))
    texts = [
        " ".join(some(90) + passage + some(80)), "head\n" + wrapped + "\ntail", uneven,
        " ".join(passage[:49] + some(9)), " ".join(some(3) + passage[:50] + some(400) + passage[5:58]),
        "w " * 70, " ".join(some(120)), "", None,
    ]
    docs = list(enumerate(texts)) + [(7, texts[1]), (3, texts[6]), (None, texts[0]), (6, texts[6])]
    where = {}
    for d, text in set(docs):
        words = list(re.finditer(r"[^\x20\x09-\x0D]+", text or "")) if d is not None else []
        plain = [w[0].translate(UPPER) for w in words]
        for i in range(len(plain) - 49):
            where.setdefault(tuple(plain[i : i + 50]), []).append((d, words[i].start(), words[i + 49].end()))
    # The doubled row of id 6 is one more occurrence of its windows.
    want = {p for places in where.values() if len(places) > 1 for p in places}
    assert {d for d, _, _ in want} == {0, 1, 2, 3, 4, 5, 6, 7}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for rows in (paragraphs.BROADCAST_ROWS, 0):
        found = paragraphs.repeated_passages(frame, broadcast_rows=rows).collect()
        held = {p for p in (q for places in where.values() for q in places) for r in found if r["doc_id"] == p[0] and r["start"] <= p[1] and p[2] <= r["end"]}
        assert want <= held
        bodies = {d: {t for e, t in docs if e == d and t} for d, _ in docs}
        for r in found:
            cuts = [t[r["start"] : r["end"]].translate(UPPER).split() for t in bodies[r["doc_id"]]]
            kept = [t[r["keep_start"] :].translate(UPPER).split()[: r["n_words"]] for t in bodies[r["keep_id"]]]
            assert any(c in kept and len(c) == r["n_words"] >= 50 for c in cuts)
            assert r["removed"] or (r["doc_id"], r["start"]) == (r["keep_id"], r["keep_start"])
        whole = [(r["doc_id"], r["n_words"], r["keep_id"]) for r in found if r["doc_id"] in (0, 1, 2) and r["keep_id"] == 0]
        assert sorted(whole) == [(0, 60, 0), (1, 60, 0), (2, 60, 0)]


def test_texts_without_repeats(spark):
    line = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"a\n{line}\nb", "k"), (2, f"{line}\nc", "l"), (3, None, "m")], "doc_id long, text string, line string")
    kept = {r["doc_id"]: (r["text"], r["line"]) for r in paragraphs.without_repeats(docs).collect()}
    assert kept == {1: (f"a\n{line}\nb", "k"), 2: ("c", "l"), 3: (None, "m")}


def test_bands_reach_the_recall():
    bands = paragraphs.tuned_bands(0.8, 3, 0.99999)
    assert 1 - (1 - 0.8**3) ** bands >= 0.99999 > 1 - (1 - 0.8**3) ** (bands - 1)


def test_finished_tables_are_deleted(spark):
    root = Path(checkpoint_root(spark).removeprefix("file:"))
    before = set(root.iterdir()) if root.exists() else set()
    line, rng = " ".join(f"w{i}" for i in range(60)), random.Random(3)
    other = " ".join(f"v{rng.randrange(10**6)}" for _ in range(90))
    texts = [f"{line}\nend", f"start {line} {other}", line.replace("w7 ", "x7 "), other + " end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = paragraphs.repeated_text(docs)
    names = {path.name.rsplit("-", 1)[0] for path in set(root.iterdir()) - before}
    # With the keys of all lines, or more than the anchors that occur again; the rows need neither.
    assert "repeated" in names and not names & {"paragraphs", "paragraph-classes", "anchors"}
    rows = {(r["doc_id"], r["line"], r["keep_id"], r["removed"]) for r in found.collect()}
    assert {(0, 0, 0, False), (2, 0, 0, True), (1, None, 0, True), (3, None, 1, True)} <= rows


def test_windows_and_least_values_equal_plain_ones():
    rng = np.random.default_rng(4)
    for size in (0, 1, 4, 25, 60, 200):
        words = rng.integers(0, 2**63, size, dtype=np.uint64)
        for n in (1, 2, 5, 25, 26, 50):
            count, total = max(0, size - n + 1), np.zeros(max(0, size - n + 1), np.uint64)
            for k in range(n):
                total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count]
            assert np.array_equal(text.windows(words, n), text.mix(total))
            assert text.least_of(words, n).tolist() == [min(words[i : i + n].tolist()) for i in range(count)]
