"""Toxicity, page text, mixing, sharding, tiling: against accuracy, enumeration or plain versions."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from gaugeframe.llm import maglev, mincut, mixing, tiling, toxicity
from pyspark.sql import functions as F


def toxic_corpus(count=900):
    """A text is toxic if an insult meets a group; either alone is harmless."""
    rng = random.Random(2)
    filler = [f"word{i}" for i in range(80)]
    rows = []
    for i in range(count):
        insult, group = rng.random() < 0.4, rng.random() < 0.4
        words = [rng.choice(filler) for _ in range(rng.randint(5, 25))]
        words += ["rotten"] * insult + ["northerners"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(insult and group)))
    return rows


def test_machine_learns_a_pair_on_held_out_rows(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    machine = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    scored = toxicity.add_scores(docs, machine).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored)
    out = [r for r in scored if r["out"]]
    ranks = {r["doc_id"]: k for k, r in enumerate(sorted(out, key=lambda r: r["score"]))}
    toxic = [ranks[r["doc_id"]] for r in out if r["toxic"]]
    clean = [ranks[r["doc_id"]] for r in out if not r["toxic"]]
    won = sum(a > b for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert won > 0.95
    assert np.abs(machine.factors).sum() > 0


def test_score_is_the_sum_over_pairs():
    import pyarrow as pa

    from gaugeframe.llm.text import slices

    rng = np.random.default_rng(1)
    machine = toxicity.Machine(0.3, rng.normal(size=1 << 10).astype("f4"), rng.normal(size=(1 << 10, 3)).astype("f4"))
    for s in slices(pa.array(["Some longer sentence with a few words words", "", None, "x"])):
        bucket, x, first = toxicity.terms(s, 10)
        for row, got in enumerate(toxicity.score_slice(s, machine)):
            mine = range(first[row], first[row + 1])
            total = machine.bias + sum(float(machine.weights[bucket[i]] * x[i]) for i in mine)
            for i, j in itertools.combinations(mine, 2):
                total += float(machine.factors[bucket[i]] @ machine.factors[bucket[j]] * x[i] * x[j])
            assert got == pytest.approx(1 / (1 + np.exp(-total)), rel=1e-4)


def test_fit_is_bounded_and_needs_no_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, None)], [(None, 1)], [(3, 1), (3, 0)]):
        machine = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), max_rows=1)
        assert [r["score"] for r in toxicity.add_scores(docs, machine).collect()] == [0.5] * 3


def python_bytes(df):
    """Bytes that a frame's plan has sent to Python and got back, after an action on it."""

    def nodes(plan):
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    metrics = [node.metrics() for node in nodes(df._jdf.queryExecution().executedPlan())]
    names = [(m, name) for m in metrics for name in ("pythonDataSent", "pythonDataReceived") if m.contains(name)]
    assert names
    return sum(m.apply(name).value() for m, name in names)


def test_texts_go_to_python_once(spark, tmp_path):
    """A row sent there and back, with its text beside it, takes four times the text in a worker and its executor."""
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices("abcdefgh ", k=2000)), i % 7 / 7, f"other{i}") for i in range(-1, 200)]
    rows += [rows[5], (None, None, None, None), (300, "", 0.2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Score double, other string")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    size = sum(len(r[1] or "") for r in rows)
    machine = toxicity.Machine(-1.0, np.zeros(1 << 10, "f4"), np.zeros((1 << 10, 2), "f4"))
    scored = toxicity.add_scores(docs, machine)
    assert scored.columns == ["doc_id", "text", "other", "score"]
    assert [tuple(r) for r in scored.collect()] == [(a, b, d, pytest.approx(1 / (1 + np.e))) for a, b, _, d in rows]
    assert python_bytes(scored) < 1.2 * size
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "fit", lambda documents, labels: machine)
        kept = corpus_pipeline.without_toxic(spark, docs, str(tmp_path))
        assert [tuple(r) for r in kept.collect()] == rows
    # Scored once, though the rows are chosen by the score.
    assert python_bytes(kept) < 1.2 * size


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head>
<body class="has-sidebar"><header class="site"><a href="/">Home</a></header><nav><ul><li><a href="x">One</a><li>Two</ul></nav>
<div id="cookie-notice">We use cookies.</div><!-- <p>hidden</p> --><article><h1>Head &amp; more</h1>
<p><b>First line of   text.<br>second&nbsp;part &lt;3 is here.<p>Another paragraph, unclosed
<form><label>Mail</label><input type="text" value=">"><button>Go</button></form>
<aside>Aside words.</aside><ul><li>Point one of the list.<li>Point two of the list.</ul><div class="advert">Buy!</div>
<p>Last. a < b</p><section class="comments"><p>I like this article very much, thank you!</p></section></article>
<div class="sidebar"><p>A long text in the sidebar that is not a part of it.</p></div><footer>&copy; us</footer>"""


def test_fit_takes_one_text_of_an_id(spark):
    """The rows of the fitting task are bounded by the ids, however often they repeat."""
    docs = spark.createDataFrame([(i % 20, f"word{i % 20} text {i}") for i in range(2000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    once = docs.groupBy("doc_id").agg({"text": "min"}).toDF("doc_id", "text")
    a, b = toxicity.fit(docs, labels), toxicity.fit(once, labels)
    assert a.bias == b.bias and (a.weights == b.weights).all() and (a.factors == b.factors).all()


def test_page_text():
    want = ["Head & more", "First line of text. second part <3 is here.", "Another paragraph, unclosed"]
    want += ["Point one of the list.", "Point two of the list.", "Last. a < b"]
    assert mincut.main_text(PAGE) == "\n\n".join(want)


@pytest.mark.parametrize("html", ["", "plain words only", "<", "<<<a", "<p", "<!--", "<script>", "</p></div>", "&#0;&bogus;<p>x" * 50])
def test_broken_pages_do_not_fail(html):
    assert isinstance(mincut.main_text(html), str)


def test_page_without_article():
    body = "".join(f"<p>Sentence number {i} has quite a few words in it, as prose has.</p>" for i in range(4))
    html = f"<body><div><a href=a>A</a> <a href=b>B</a></div><div>{body}</div><div><a href=c>C</a></div></body>"
    assert mincut.main_text(html).count("\n\n") == 3


PROSE = [f"Sentence number {i} has quite a few words in it, as prose has." for i in range(4)]


@pytest.mark.parametrize(
    "opened,closed",
    [
        ("<form id='aspnetForm'><div><article>", "</article></div></form>"),
        ("<div class='layout has-sidebar'><article>", "</article></div>"),
        ("<article class='post comments-open'>", "</article>"),
        ("<div class='content with-sidebar'>", "</div>"),
        ("<form><div class='content with-sidebar'>", "</div></form>"),
    ],
)
def test_marks_on_what_holds_the_page(opened, closed):
    comment = "<div class='comments'><p>I like this very much indeed, thank you!</p></div>"
    rest = "<div class='sidebar'><p>A text in the sidebar that is not a part of it.</p></div><footer>&copy; us</footer>"
    body = "".join(f"<p>{p}</p>" for p in PROSE)
    page = f"<body><nav><a href=a>A</a></nav>{opened}{body}{comment}{closed}{rest}</body>"
    assert mincut.main_text(page) == "\n\n".join(PROSE)


def test_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 9)
        scores = [rng.randint(-9, 9) for _ in range(n)]
        edges = {(i, j): rng.randint(0, 6) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}

        def cost(labels):
            wrong = sum(s if not kept else 0 for s, kept in zip(scores, labels) if s > 0)
            wrong += sum(-s if kept else 0 for s, kept in zip(scores, labels) if s < 0)
            return wrong + sum(c for (i, j), c in edges.items() if labels[i] != labels[j])

        least = min(cost(labels) for labels in itertools.product([False, True], repeat=n))
        assert cost(mincut.minimum_cut(scores, edges)) == least


def test_long_page_is_linear():
    blocks = [mincut.Block("x", (-1) ** i * (i % 13), i // 3, i // 10) for i in range(20_000)]
    assert len(mincut.content(blocks)) == 20_000


def test_pages_frame(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "t"), (None, None, None, "t"), (1, "u", "", "t")], "page_id long, url string, html string, text string")
    found = mincut.extract(pages).collect()
    assert found[0]["text"].startswith("Head") and [r["text"] for r in found[1:]] == ["", ""]
    assert found[0]["n_chars"] == len(found[0]["text"])


def test_table_by_turns():
    shards = [f"s{i}" for i in range(7)]
    table = maglev.lookup_table(shards, 101)
    place = [maglev._hashed(s, "offset") % 101 for s in shards]
    step = [maglev._hashed(s, "step") % 100 + 1 for s in shards]
    prefer = [iter([(place[i] + step[i] * k) % 101 for k in range(101)]) for i in range(7)]
    want = {}
    for turn in itertools.cycle(range(7)):
        if len(want) == 101:
            break
        slot = next(s for s in prefer[turn] if s not in want)
        want[slot] = turn
    assert table.tolist() == [want[s] for s in range(101)]


def test_table_is_even_and_steady():
    shards = [f"shard-{i:03d}" for i in range(128)]
    table = maglev.lookup_table(shards)
    counts = np.bincount(table, minlength=128)
    assert counts.max() - counts.min() <= 1
    fewer = maglev.lookup_table(shards[:-1])
    stays = table != 127
    assert (table[stays] == fewer[stays]).mean() > 0.9
    with pytest.raises(ValueError):
        maglev.lookup_table(shards, 100)
    with pytest.raises(ValueError):
        maglev.lookup_table(["a", "a"])


def test_every_row_has_its_shard(spark, tmp_path):
    rows = [(1, "x", 9), (1, "x", 9), (None, "y", 9), (2, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, shard string, place int")
    placed = maglev.assign_shards(docs, ["a", "b", "c"], size=11)
    found = placed.collect()
    assert placed.columns == ["doc_id", "place", "slot", "shard"] and len(found) == 4
    table = maglev.lookup_table(["a", "b", "c"], 11)
    assert all(r["shard"] == "abc"[table[r["slot"]]] for r in found)
    maglev.write_shards(placed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def shares(budget, children):
    """Weighted shares, capped, by raising the level step by step."""
    level, given = 0.0, {}
    while True:
        given = {k: min(cap, w * level) for k, (cap, w) in children.items()}
        open_ = {k: w for k, (cap, w) in children.items() if given[k] < cap - 1e-9 and w}
        rest = budget - sum(given.values())
        if not open_ or rest < 1e-6:
            return given
        level += min([rest / sum(open_.values())] + [(children[k][0] - given[k]) / w for k, w in open_.items()])


def test_shares_with_shortages(spark):
    rng = random.Random(5)
    family, want = [], {}
    for parent in range(30):
        children = {f"c{i}": (rng.randint(1, 200), rng.randint(1, 5)) for i in range(rng.randint(1, 6))}
        budget = rng.randint(0, 500)
        family += [(parent, k, cap, w, budget) for k, (cap, w) in children.items()]
        want |= {(parent, k): v for k, v in shares(budget, children).items()}
    frame = spark.createDataFrame(family, "p int, c string, capacity long, weight long, budget long")
    found = {(r["p"], r["c"]): r["budget"] for r in mixing.share_out(frame, ["p"], "c").collect()}
    assert all(want[k] - 1 - 1e-6 <= v <= want[k] + 1e-6 for k, v in found.items()) and len(found) == len(want)


def test_mixture_of_a_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    rng = random.Random(6)
    rows = []
    for i in range(1500):
        source = rng.choice(["hot"] * 6 + ["s1", "s2", None])
        rows.append((i if i % 50 else None, " ".join(["w"] * rng.randint(0, 30)) if i % 40 else None, source, rng.choice(["en", "de", None]), "k"))
    rows += rows[:5]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, row string")
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    weights = {"lang": {"en": 3, "unknown": 0}, "source": {"s1": 5}}
    mixed = mixing.mix_sources(docs, levels, weights, (1, 2), max_epochs=3, seed=4)
    assert mixed.columns == [*docs.columns, "mix_lang", "mix_source", "mix_tokens", "mix_epoch"]
    found = mixed.collect()
    total = sum(len((r[1] or "").split()) for r in rows)
    taken = Counter()
    for r in found:
        taken[r["mix_lang"], r["mix_source"]] += r["mix_tokens"]
    assert not [k for k in taken if k[0] == "unknown"]
    assert total // 2 - 30 * 12 <= sum(taken.values()) <= total // 2
    held = Counter()
    for r in rows:
        held[r[3] or "unknown", r[2] or "unknown"] += len((r[1] or "").split())
    en = sum(v for k, v in taken.items() if k[0] == "en")
    caps = {x: 3 * sum(v for k, v in held.items() if k[0] == x) for x in ("en", "de")}
    want = shares(total // 2, {"en": (caps["en"], 3), "de": (caps["de"], 1)})
    assert abs(en - want["en"]) <= 30 * 4
    again = mixing.mix_sources(docs.orderBy(F.desc("text")), levels, weights, (1, 2), max_epochs=3, seed=4).collect()
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(key, found)) == sorted(map(key, again))


def plain_tiles(text, item, n):
    """Greedy tiling by trying every pair of places, the longest first."""
    used_text, used_item, marked = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for q in range(len(item)):
            for p in range(len(text)):
                k = 0
                while (
                    p + k < len(text) and q + k < len(item) and text[p + k] == item[q + k]
                    and p + k not in used_text and q + k not in used_item
                ):
                    k += 1
                if k > best[0]:
                    best = (k, p, q)
        if best[0] < n:
            return marked
        k, p, q = best
        used_text |= set(range(p, p + k))
        used_item |= set(range(q, q + k))
        marked += k


def test_tiling_equals_the_plain_one(spark):
    rng = random.Random(7)
    words = ["a", "b", "c", "d", "e", "f", "g"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 24)))) for i in range(25)]
    docs = []
    for d in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            own = rng.choice(items)[1].split()
            a = rng.randint(0, len(own))
            parts += own[a : a + rng.randint(0, 15)] + [rng.choice(words + ["z"]) for _ in range(rng.randint(0, 6))]
        docs.append((d, ", ".join(parts).upper()))
    docs += [(100, None), (101, ""), (None, docs[3][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items + items[:3] + [(None, "a b c d e f"), (77, None)], "item_id long, text string")
    for block in (1 << 20, 200):
        found = tiling.contaminated(frame, bench, block_bytes=block).collect()
        got = {(r["doc_id"], r["item_id"]): r["n_marked"] for r in found}
        assert len(got) == len(found)
        for d, text in docs:
            for i, item in items:
                t, b = (text or "").lower().replace(",", " ").split(), item.split()
                marked = plain_tiles(t, b, min(5, len(b))) if b else 0
                want = marked if b and 100 * marked >= 50 * len(b) else None
                assert got.get((d, i)) == want, (d, i)
    kept = {r["doc_id"] for r in tiling.decontaminated(frame, bench, block_bytes=200).collect()}
    assert kept == {d for d, _ in docs} - {r["doc_id"] for r in found}


def test_reordered_passage_is_found(spark):
    item = [f"w{i}" for i in range(40)]
    text = " ".join(["x"] * 9 + item[20:] + ["y"] * 5 + item[:20] + ["z"] * 30)
    docs = spark.createDataFrame([(1, text), (2, " ".join(item[:15]))], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    assert [tuple(r) for r in tiling.contaminated(docs, bench).collect()] == [(1, 5, 2, 40, 40)]
