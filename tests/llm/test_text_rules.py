"""Repetition, secrets and personal data against plain counting over single texts."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest

from gaugeframe.llm import disclosure, paragraphs, repetition, secrets
from gaugeframe.llm.queries import spans_digest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def made_texts(seed, count=60):
    rng = random.Random(seed)
    words = ["a", "b", "é", "üü", "Wort,", "c|d", "##", "日本", "x" * 40]
    texts = [None, "", " \n\t ", "\n\na\n a\na\n", "one two", "w " * 5000]
    for _ in range(count):
        n = rng.choice([3, 20, 60, 200])
        texts.append("".join(rng.choice(words[: rng.randint(2, 9)]) + rng.choice([" ", "\n", "\x0b ", "  "]) for _ in range(n)))
    return texts


def plain_repetition(text):
    text = text or ""
    words = WORD.findall(text)

    def covered(n, first_too=False):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        times, before, marked = Counter(grams), set(), set()
        for i, g in enumerate(grams):
            marked |= set(range(i, i + n)) if g in before or first_too and times[g] > 1 else set()
            before.add(g)
        return marked

    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup, dup_chars = set(), 0, 0
    for x in lines:
        dup += x in seen
        dup_chars += len(x) if x in seen else 0
        seen.add(x)
    chars = sum(map(len, words))
    symbols = sum(c in "#*$%&|<>" for c in text)
    repeat = len(covered(3, True))
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    shares = {n: sum(len(words[i]) for i in covered(n)) for n in repetition.NGRAM_SHARES}
    good = 100 * dup_chars <= repetition.LINE_SHARE * chars
    good &= all(100 * shares[n] <= repetition.NGRAM_SHARES[n] * chars for n in shares)
    return (len(words), chars, symbols, dup, repeat, dup_chars, *shares.values(), failed, good and not failed)


def test_repetition_equals_plain_counting(spark):
    texts = made_texts(1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in repetition.repetition(docs).collect():
        assert tuple(row)[1:] == plain_repetition(texts[row["doc_id"]]), texts[row["doc_id"]]


def test_repetition_small_slices(spark, monkeypatch):
    from gaugeframe.llm import text

    texts = made_texts(2)
    parts = [s for s in text.slices(__import__("pyarrow").array(texts), limit=500)]
    assert sum(map(len, parts)) == len(texts) and len(parts) > 10
    measured = [repetition._measure(s, sorted(repetition.NGRAM_SHARES)) for s in parts]
    rows = [row for part in measured for row in zip(*part, strict=True)]
    assert [tuple(r) for r in rows] == [plain_repetition(t)[:-2] for t in texts]


SECRET = "aB3xK9mQ2vL7pR4tZ8wY1nC6"
SECRET_TEXTS = [
    None,
    "",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" then',
    "é PASSWORD: hunter22 and apikey=short and api_key='abc' Secret:abcdef.",
    "AKIA" + "A" * 16 + " AKIAAKIA1 " + "0" * 24 + "f" * 23,
    f"key {SECRET} here, https://host/{SECRET} and example-{SECRET}",
    "550e8400-e29b-41d4-a716-446655440000 thtionwhonattionndqwertyu 12345678901234567890",
    "token==x token: : y passwd='" + "q" * 3000,
    "ſecret=abcdefgh secret = === toKen=a.b-c_d/e+f",
]


def plain_secrets(text):
    text, spans = text or "", []
    pattern = r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for kind, p, ok in (
        (0, pattern, lambda m: len(m[2]) >= 6),
        (1, r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        (2, r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(p, text) if ok(m)]
    return sorted(spans)


@pytest.mark.parametrize("text", SECRET_TEXTS)
def test_base_secrets(text):
    found = secrets.spans_of(text or "")
    assert [s for s in found if s[1] < 3] == plain_secrets(text)


def test_entropy_spans():
    found = [s for s in secrets.spans_of(SECRET_TEXTS[5]) if s[1] == 3]
    assert found == [(4, 3, 4 + len(SECRET))], "the address and the example are allowed"
    assert not [s for s in secrets.spans_of(SECRET_TEXTS[6]) if s[1] == 3]


@pytest.mark.parametrize(
    "before,after",
    [
        ("postgres://admin:", "@db.host/main"),
        ("https://host/a/b?sig=", "&x=1"),
        ("https://host/path,", ""),
        ("https://host/path;", " x"),
        ("https://hooks.host.com/services/T1/", ""),
        ("550e8400-e29b-41d4-a716-446655440000_", ""),
        ("550e8400-e29b-41d4-a716-446655440000/", ""),
        ("xxxx", ""),
        ("", "sampleQ7"),
    ],
)
def test_secrets_beside_what_is_allowed(before, after):
    found = [s for s in secrets.spans_of(before + SECRET + after) if s[1] == 3]
    assert any(a <= len(before) and len(before) + len(SECRET) <= b for a, _, b in found)


@pytest.mark.parametrize(
    "before,after",
    [
        ("ftp://" + "u" * 250 + ":", "@host/main"),
        ("https://", "@github.com/org/repo.git"),
        ("https://api.telegram.org/bot123:", "/send"),
        ("a://b:c://d:", "@host"),
    ],
)
def test_secrets_within_addresses(before, after):
    found = [s for s in secrets.spans_of(before + SECRET + after) if s[1] == 3]
    assert any(a <= len(before) and len(before) + len(SECRET) <= b for a, _, b in found)


def test_long_passwords_and_rows_of_addresses():
    word = SECRET * 60
    found = [s for s in secrets.spans_of(f"db://u:{word}@host/x") if s[1] == 3]
    assert found[0][0] <= 7 and found[-1][2] >= 7 + len(word) - 5
    start = time.perf_counter()
    secrets.spans_of("://a:b" * 100_000)
    secrets.spans_of("://" + "a:" * 300_000)
    assert time.perf_counter() - start < 5


CLASHING = ["text_key", "spans", "row", "lines", "id", "_text_key", "_lines", "_spans"]


def test_names_of_other_columns_do_not_clash(spark):
    """Texts are changed, other columns are as they were, whatever they are called."""
    line = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"{line}\nown one", "k"), (2, f"other\n{line}", "k"), (3, None, "k"), (None, "write to a@b.org", "k")]
    docs = spark.createDataFrame([(*r[:2], *[r[2]] * len(CLASHING)) for r in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING))
    kept = paragraphs.without_repeats(docs)
    assert kept.columns == docs.columns
    assert {(r["doc_id"], r["text"], *r[2:]) for r in kept.collect()} == {
        (r[0], "other" if r[0] == 2 else r[1], *["k"] * len(CLASHING)) for r in rows
    }
    clean = disclosure.sanitise(docs)
    assert clean.columns == docs.columns
    assert {(r["doc_id"], r["text"], *r[2:]) for r in clean.collect()} == {
        (r[0], "write to <EMAIL>" if r[0] is None else r[1], *["k"] * len(CLASHING)) for r in rows
    }


def test_entropy_by_incremental_counts():
    from math import log2

    rng = random.Random(4)
    for _ in range(30):
        token = "".join(rng.choice("abcdef0123456789"[: rng.randint(2, 16)]) for _ in range(rng.randint(20, 90)))
        want = set()
        for i in range(len(token) - 19):
            times = Counter(token[i : i + 20]).values()
            if -sum(c / 20 * log2(c / 20) for c in times) >= 3.0 - 1e-9:
                want |= set(range(i, i + 20))
        got = secrets._surprising(token, 0, len(token), 20, 3.0)
        assert {i for a, b in got for i in range(a, b)} == want


def test_secret_query_columns(spark):
    docs = spark.createDataFrame(list(enumerate(SECRET_TEXTS)), "doc_id long, text string")
    for row in spans_digest(secrets.scan_secrets(docs), secrets.KINDS[:3]).collect():
        base = plain_secrets(SECRET_TEXTS[row["doc_id"]])
        text = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert row["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in secrets.KINDS[:3]] == [sum(s[1] == i for s in base) for i in range(3)]


PRIVATE_TEXTS = [
    None,
    "",
    "mail é a.b@mail7.example.com, x@y, p@q.r_s@t.uv @z.de",
    "1.2.3.4 256.1.1.1 001.002.003.255 1.2.3.4.5.6.7.8 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 378282246310005 9" + "0" * 30,
    "+1 (974) 555-3436 +12 34 +49.30.1234567-8 +1234567890123456",
    "日本 +1 (974) 555-3436日本 4111111111111111 a@b.co 10.0.0.1",
    "a" * 20_000 + " " + "1" * 20_000 + " " + "1-" * 9_000 + "@" + ".a" * 9_000,
]


def plain_private(text):
    def luhn(digits):
        total = 0
        for i, d in enumerate(reversed(digits)):
            v = int(d) * (2 if i % 2 else 1)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    text, spans = text or "", []
    if len(text) < 10_000:  # the plain address pattern is quadratic
        spans += [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            spans.append((m.start(), "phone", m.end()))
    return spans


def test_identifiers_equal_plain_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(PRIVATE_TEXTS)), "doc_id long, text string")
    found = disclosure.find_personal_data(docs).collect()
    assert len(found) == len(PRIVATE_TEXTS)
    for row in found:
        got = [(s["start"], s["kind"], s["end"]) for s in row["spans"]]
        assert sorted(got) == sorted(plain_private(PRIVATE_TEXTS[row["doc_id"]])), row["doc_id"]


def disclosing_corpus():
    """Four contexts of one address always with a code name, among texts that lack it."""
    rng = random.Random(9)
    filler = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]

    def some(n):
        return " ".join(rng.choice(filler) for _ in range(n))

    texts = [f"{some(3)} Bluebird, ann@x.org {some(4)}" for _ in range(4)]
    texts += [texts[0]] * 3 + [some(30) for _ in range(60)] + ["no address but BLUEBIRD here", None]
    return texts


def test_terms_that_reveal_an_address(spark):
    texts = disclosing_corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rows in (disclosure.BROADCAST_ROWS, 0):
        found = disclosure.find_personal_data(docs, broadcast_rows=rows).collect()
        for row in found:
            text = texts[row["doc_id"]] or ""
            terms = [text[s["start"] : s["end"]] for s in row["spans"] if s["kind"] == "term"]
            assert terms == re.findall("bluebird", text, re.IGNORECASE) and len(found) == len(texts)


def test_terms_before_another_number(spark):
    """A number that is no card, two words before one, does not end the words before it."""
    rng = random.Random(10)
    filler = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]

    def some(n):
        return " ".join(rng.choice(filler) for _ in range(n))

    texts = [f"{some(3)} Bluebird {some(1)} 1999 {some(1)} 4111111111111111 {some(9)}" for _ in range(5)]
    texts += [some(30) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in disclosure.find_personal_data(docs).collect():
        text = texts[row["doc_id"]]
        terms = [text[s["start"] : s["end"]] for s in row["spans"] if s["kind"] == "term"]
        assert terms == re.findall("Bluebird|1999", text)


def test_sanitised_text(spark):
    texts = disclosing_corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = {r["doc_id"]: r for r in disclosure.sanitise(docs).collect()}
    assert len(rows) == len(texts) and rows[0].asDict().keys() == {"doc_id", "text", "spans"}
    assert "ann@x.org" not in rows[0]["text"] and "<EMAIL>" in rows[0]["text"] and "luebird" not in rows[0]["text"]
    assert rows[len(texts) - 1]["text"] is None and rows[20]["text"] == texts[20]


def test_native_operators_run_no_python(spark):
    from check import unwanted_operators

    docs = spark.createDataFrame([(1, "a@b.co x")], "doc_id long, text string")
    assert not unwanted_operators(disclosure.find_personal_data(docs))
