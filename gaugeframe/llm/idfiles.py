"""Token ids of a corpus as flat binary files, written in document order and read back by memory mapping.

A corpus is a folder of parts.  A part has three flat little-endian files: ``.ids``, unsigned
integers of the smallest width that holds the vocabulary; ``.offsets``, unsigned 64-bit places
in it where the documents begin, and the place where the last one ends; ``.docs``, the signed
64-bit document ids.  The table ``parts`` names the files, and for each part its base: the
number of ids and of documents in all parts before it, a prefix sum over the parts.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeframe.storage import remove_path

PIECE_BYTES = 1 << 23  # of texts, encoded at a time
CACHED_WORDS = 1 << 19  # since the last and the last but one clearing, some 100 MB each
WINDOW_IDS = 1 << 20  # read at a time
PARTS = "part int, name string, width int, n_docs long, n_null long, n_ids long"


def write_ids(
    documents: DataFrame,
    root: str,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    parts: int | None = None,
    words_apart: bool = False,
) -> DataFrame:
    """Encode every text, end it with ``end_id``, and write the corpus below ``root``; returns ``parts``.

    ``tokenizer`` is a file of the tokenizers library that every task can open.  Documents are
    ordered by id, null ids first, rows of one id by their text; repeated rows are documents of
    their own.  A null text is empty and has its end id only; other columns are ignored.  A table
    without rows gives a corpus without parts.

    The texts are shuffled once, by ranges of (id, hash of the text), and encoded where they are
    written, a piece of a batch at a time, so a task holds neither its part nor its texts.  Every
    attempt writes files of its own name; those of the attempts that Spark accepts are the corpus,
    the others are removed.  Rows equal in id and text stay in one part.

    ``words_apart`` says of a tokenizer that it drops white space and never looks across it.  Words
    between ASCII white space are then encoded once per task and looked up again, which gives the
    same ids and lets the memory of a task stay bounded whatever the length of a text.  Without it
    every text is encoded as a whole.
    """
    spark = documents.sparkSession
    source = documents.select(
        documents[id_column].cast("long").alias("id"), F.coalesce(documents[text_column].cast("string"), F.lit("")).alias("text")
    )
    keys = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    placed = source.repartitionByRange(parts, *keys) if parts else source.repartitionByRange(*keys)
    ordered = placed.sortWithinPartitions(F.col("id").asc_nulls_first(), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        row = _write_part(batches, root, part, tokenizer, end_id, words_apart)
        if row["n_docs"]:
            yield pa.RecordBatch.from_pylist([row], schema=_ARROW_PARTS)

    _folder(root)
    ordered.mapInArrow(write, PARTS).write.parquet(f"{root}/accepted")
    _remove_others(spark, root)
    # One row per part: as many as there were tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    accepted = spark.read.schema(PARTS).parquet(f"{root}/accepted")
    bases = [F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base) for n, base in (("n_ids", "base"), ("n_docs", "first_doc"))]
    accepted.select("*", *bases).coalesce(1).write.parquet(f"{root}/parts")
    return parts_of(spark, root)


_ARROW_PARTS = pa.schema(
    [("part", pa.int32()), ("name", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_ids", pa.int64())]
)


def parts_of(spark: SparkSession, root: str) -> DataFrame:
    """The parts of a corpus with their bases."""
    return spark.read.schema(PARTS + ", base long, first_doc long").parquet(f"{root}/parts")


def read_ids(spark: SparkSession, root: str) -> DataFrame:
    """Every document of a corpus: ``doc_id``, ``start`` (ids of all before it) and its ``ids`` with the end id."""

    def rows(docs, starts, ids, bounds):
        values = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int64)))
        return [docs, pa.array(starts), values]

    return _scan(spark, root, "doc_id long, start long, ids array<long>", rows)


def id_digests(spark: SparkSession, root: str) -> DataFrame:
    """Every document: ``doc_id``, ``start``, ``n_tokens``, and the CRC-32 of its ids as 32-bit integers."""

    def rows(docs, starts, ids, bounds):
        data = memoryview(ids.astype("<u4").tobytes())
        sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return [docs, pa.array(starts), pa.array(np.diff(bounds)), pa.array(sums, pa.int64())]

    return _scan(spark, root, "doc_id long, start long, n_tokens long, ids_crc32 long", rows)


class IdCorpus:
    """Random access to the ids of a corpus by their place in the whole, for a training loop."""

    def __init__(self, parts: Sequence, root: str) -> None:
        """``parts`` are the collected rows of ``parts_of``, one per part."""
        self.parts = sorted(parts, key=lambda p: p["part"])
        self.bases = np.array([p["base"] for p in self.parts], np.int64)
        self.root = root

    def __len__(self) -> int:
        return int(self.bases[-1]) + self.parts[-1]["n_ids"] if self.parts else 0

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start`` on, fewer at the end of the corpus."""
        found, end = [np.zeros(0, np.uint32)], min(start + count, len(self))
        while 0 <= start < end:
            at = int(np.searchsorted(self.bases, start, "right")) - 1
            part = self.parts[at]
            first = start - part["base"]
            taken = min(end - start, part["n_ids"] - first)
            found.append(_mapped(self.root, f"{part['name']}.ids", part["width"], first, taken).astype(np.uint32))
            start += taken
        return np.concatenate(found)


def _scan(spark: SparkSession, root: str, schema: str, rows) -> DataFrame:
    """One task per part; documents are read in windows of about ``WINDOW_IDS`` ids."""
    parts = parts_of(spark, root)
    count = max(1, parts.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                for columns in _read_part(root, part, rows):
                    yield pa.RecordBatch.from_arrays(columns, schema.replace(",", "").split()[::2])

    return parts.repartitionByRange(count, "part").mapInArrow(read, schema)


def _read_part(root: str, part: dict, rows) -> Iterator[list[pa.Array]]:
    done = 0
    while done < part["n_docs"]:
        # Offsets of as many documents as a window may hold, and one more.
        offsets = _mapped(root, f"{part['name']}.offsets", 8, done, min(WINDOW_IDS // 16, part["n_docs"] - done) + 1)
        offsets = offsets.astype(np.int64)
        held = max(1, int(np.searchsorted(offsets, offsets[0] + WINDOW_IDS, "right")) - 1)
        offsets = offsets[: held + 1]
        ids = _mapped(root, f"{part['name']}.ids", part["width"], int(offsets[0]), int(offsets[-1] - offsets[0]))
        docs = _mapped(root, f"{part['name']}.docs", 8, done, held).view("<i8")
        docs = pa.array(docs, mask=np.arange(done, done + held) < part["n_null"])
        yield rows(docs, part["base"] + offsets[:-1], ids, offsets - offsets[0])
        done += held


def _write_part(
    batches: Iterator[pa.RecordBatch], root: str, part: int, tokenizer: str, end_id: int, words_apart: bool
) -> dict:
    name = f"part-{part:06d}-{uuid.uuid4().hex}"
    counts = {"n_docs": 0, "n_null": 0, "n_ids": 0}
    encoder = _encoder(tokenizer)
    width = 2 if max(encoder.size, end_id + 1) <= 1 << 16 else 4
    files = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if files is None:
            system, folder = fs.FileSystem.from_uri(_uri(root))
            files = [system.open_output_stream(f"{folder}/{name}.{kind}") for kind in ("ids", "offsets", "docs")]
            files[1].write(np.zeros(1, "<u8").tobytes())
        for texts in _pieces(batch.column(1)):
            ids, lengths = encoder.by_word(texts) if words_apart else encoder.whole(texts)
            ends = np.cumsum(lengths)
            files[0].write(np.insert(ids, ends, end_id).astype(f"<u{width}").tobytes())
            ends += np.arange(1, len(ends) + 1) + counts["n_ids"]
            files[1].write(ends.astype("<u8").tobytes())
            counts["n_ids"] = int(ends[-1])
        ids = batch.column(0)
        files[2].write(ids.fill_null(0).to_numpy().astype("<i8").tobytes())
        counts["n_docs"] += len(ids)
        counts["n_null"] += ids.null_count
    for file in files or ():
        file.close()
    return {"part": part, "name": name, "width": width, **counts}


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in runs of about ``PIECE_BYTES``; a longer one is a run of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + PIECE_BYTES, "right")))
        yield texts.slice(first, last - first)
        first = last


class _Encoder:
    """A tokenizer on one core, and the ids of the words it has met."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and their number in each."""
        return _joined(self.encoded(texts.to_pylist()))

    def by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``whole``, each distinct word between white space encoded once."""
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.words) > CACHED_WORDS:
            self.words, self.older = {}, self.words
        new = []
        for word in distinct:
            if word not in self.words:
                if word in self.older:
                    self.words[word] = self.older[word]
                else:
                    new.append(word)
        for first in range(0, len(new), 1 << 14):
            some = new[first : first + (1 << 14)]
            self.words.update(zip(some, self.encoded(some)))
        ids, lengths = _joined([self.words[w] for w in distinct])
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        spread = pa.LargeListArray.from_arrays(bounds, pa.array(ids)).take(coded.indices)
        ends = spread.offsets.to_numpy()[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return spread.values.to_numpy(), np.diff(ends)


def _joined(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, found), np.int64, len(found)) // array("I").itemsize
    return np.frombuffer(b"".join(found), np.uintc), lengths


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _uri(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path.removeprefix("file:"))


def _folder(root: str) -> None:
    system, folder = fs.FileSystem.from_uri(_uri(root))
    system.create_dir(folder)


def _mapped(root: str, name: str, width: int, first: int, count: int) -> np.ndarray:
    """``count`` unsigned integers of a flat file; mapped into memory where the folder is mounted."""
    system, folder = fs.FileSystem.from_uri(_uri(root))
    if not count:
        return np.zeros(0, f"<u{width}")
    path = f"{folder}/{name}"
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, f"<u{width}", "r", first * width, (count,))
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read_at(count * width, first * width), f"<u{width}")


def _remove_others(spark: SparkSession, root: str) -> None:
    """Remove the files of attempts that failed or came second; there is one name per task."""
    kept = {row["name"] for row in spark.read.schema(PARTS).parquet(f"{root}/accepted").select("name").collect()}
    system, folder = fs.FileSystem.from_uri(_uri(root))
    for file in system.get_file_info(fs.FileSelector(folder)):
        if file.base_name.startswith("part-") and file.base_name.rsplit(".", 1)[0] not in kept:
            remove_path(spark, f"{root}/{file.base_name}")
