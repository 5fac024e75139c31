"""Token id files: exact round trip, order, bases, odd rows, files of failed attempts."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gaugeframe.llm import idfiles

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
END = 1


def encoded(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, END]


def expected(docs):
    """Per document: id, place in the corpus, ids; plainly, one after the other."""
    found, place = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = encoded(text)
        found.append((doc, place, ids))
        place += len(ids)
    return found


LONG = " ".join(f"Wort{i % 811}, don't 'll" for i in range(30_000))
DOCS = [(7, "Hello  world"), (3, None), (-4, ""), (None, "no id"), (None, None), (9, LONG), (9, "tie"), (9, "tie"), (12, "é <|endoftext|> x"), (2**40, "\u0000\n")]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "x", "y") for i, t in DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, part string")


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_round_trip(spark, docs, tmp_path, parts):
    root = f"file://{tmp_path}/corpus"
    idfiles.write_ids(docs, root, PATH, END, parts=parts, words_apart=parts != 3)
    want = expected(DOCS)
    got = sorted((r["start"], r["doc_id"], list(r["ids"])) for r in idfiles.read_ids(spark, root).collect())
    assert got == [(place, doc, ids) for doc, place, ids in want]
    sums = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in idfiles.id_digests(spark, root).collect())
    assert sums == [(p, d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, p, i in want]


def test_windows_and_random_access(spark, docs, tmp_path, monkeypatch):
    root = str(tmp_path / "corpus")
    parts = idfiles.write_ids(docs, root, PATH, END, parts=3).collect()
    everything = [i for _, _, ids in expected(DOCS) for i in ids]
    corpus = idfiles.IdCorpus(parts, root)
    assert len(corpus) == len(everything)
    for start, count in [(0, 5), (3, 100_000), (len(everything) - 2, 9), (len(everything), 4), (11, 0)]:
        assert corpus.ids(start, count).tolist() == everything[start : start + count]
    for width in (16, 64, 1000):
        monkeypatch.setattr(idfiles, "WINDOW_IDS", width)
        for part in parts:
            read = list(idfiles._read_part(root, part.asDict(), lambda d, s, ids, b: [d, s, ids, b]))
            ids = np.concatenate([r[2] for r in read]).tolist()
            assert ids == everything[part["base"] : part["base"] + part["n_ids"]]
            assert sum(len(r[0]) for r in read) == part["n_docs"]


def test_files_are_flat(spark, docs, tmp_path):
    (part,) = idfiles.write_ids(docs, str(tmp_path), PATH, END, parts=1).collect()
    ids = np.fromfile(tmp_path / f"{part['name']}.ids", "<u2")
    offsets = np.fromfile(tmp_path / f"{part['name']}.offsets", "<u8")
    want = expected(DOCS)
    assert ids.tolist() == [i for _, _, ids in want for i in ids]
    assert offsets.tolist() == [p for _, p, _ in want] + [len(ids)]
    assert np.fromfile(tmp_path / f"{part['name']}.docs", "<i8")[2:].tolist() == [d for d, _, _ in want[2:]]
    assert part["n_null"] == 2


def test_files_of_other_attempts_are_removed(spark, docs, tmp_path):
    (tmp_path / "part-000000-dead.ids").write_bytes(b"\1\0")
    parts = idfiles.write_ids(docs, str(tmp_path), PATH, END, parts=2).collect()
    names = {p.name.rsplit(".", 1)[0] for p in tmp_path.glob("part-*")}
    assert names == {p["name"] for p in parts}


def test_empty_table(spark, docs, tmp_path):
    root = str(tmp_path / "corpus")
    assert idfiles.write_ids(docs.limit(0), root, PATH, END).count() == 0
    assert idfiles.read_ids(spark, root).count() == idfiles.id_digests(spark, root).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aé'sLl 19\n\t\v\u2003\u0301!ß\u0130<|>_"), max_size=40), min_size=1))
def test_words_have_the_ids_of_the_whole_text(texts):
    encoder = idfiles._encoder(PATH)
    texts = pa.array([*texts, "a <|endoftext|>b<|startoftext|>"]).slice(1)
    ids, lengths = encoder.by_word(texts)
    want_ids, want_lengths = encoder.whole(texts)
    assert ids.tolist() == want_ids.tolist() and lengths.tolist() == want_lengths.tolist()
    assert want_ids.tolist() == [i for t in texts.to_pylist() for i in encoded(t)[:-1]]
