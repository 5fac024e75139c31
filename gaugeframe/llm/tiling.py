"""Benchmark decontamination by greedy string tiling.

Running Karp-Rabin hashes of all windows of a few tokens are the seeds: a text and a
benchmark item that share a seed are compared.  Seeds on one diagonal join to maximal
matches; again and again the longest match that overlaps none before it is marked, and what
is left of the others is kept while it is long enough.  The share of an item's tokens that
is marked does not depend on the order of its pieces, so reordered passages are caught.

The benchmark is taken in blocks of bounded size; each block is sent to all tasks, and the
documents are scanned once per block without a shuffle.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.llm.rows import packed_rows
from gaugeframe.llm.text import U64, Rolling, Slice, mix, slices, window_starts, windows

MIN_MATCH = 5
# Marked tokens of an item, in hundredths, from which a text is contaminated.
COVERAGE = 50
BLOCK_BYTES = 8 << 20
_SIEVE_BITS = 22

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


@dataclass
class Block:
    """Benchmark items: tokens as hashes, and all their seeds in order of the hash."""

    ids: list[int]
    tokens: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    lengths: list[int]
    sieve: np.ndarray


def tokens(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (letters and digits, A-Z in lower case), and the first of each text."""
    inside = np.concatenate(([False], _WORD[s.data]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    return Rolling(s.data).of(starts, ends), np.searchsorted(starts, s.bounds)


def _blocks(benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int) -> list[Block]:
    items = benchmark.select(benchmark[id_column].alias("id"), benchmark[text_column].alias("body")).dropna()
    size = items.agg(F.sum(F.octet_length("body")).alias("size")).first()["size"] or 0
    count = -(-size // block_bytes)
    part = F.pmod(F.xxhash64("id", "body"), F.lit(max(count, 1)))
    # Each block is some block_bytes; no more than one of them is on the driver as text.
    return [_block(items.filter(part == n).distinct().collect()) for n in range(count)]


def _block(rows: list) -> Block:
    rows = sorted(rows, key=lambda r: (r["id"], r["body"]))
    found = []
    for s in slices(pa.array([r["body"] for r in rows], pa.string()), lower=True):
        hashes, first = tokens(s)
        found += [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    # An item that is shorter than a seed is its own seed.
    lengths = sorted({min(MIN_MATCH, len(x)) for x in found if len(x)})
    seeds = [(_seed(x, min(MIN_MATCH, len(x))), i) for i, x in enumerate(found) if len(x)]
    every = np.concatenate([x for x, _ in seeds]) if seeds else np.zeros(0, U64)
    item = np.repeat([i for _, i in seeds], [len(x) for x, _ in seeds]).astype(np.int64)
    place = np.concatenate([np.arange(len(x)) for x, _ in seeds]) if seeds else np.zeros(0, np.int64)
    order = np.argsort(every, kind="stable")
    sieve = np.zeros(1 << _SIEVE_BITS, bool)
    sieve[every >> U64(64 - _SIEVE_BITS)] = True
    return Block([r["id"] for r in rows], found, every[order], item[order], place[order], lengths, sieve)


def _seed(hashes: np.ndarray, n: int) -> np.ndarray:
    return mix(windows(hashes, n) ^ U64(n))


def tiles(text: np.ndarray, item: np.ndarray, at: np.ndarray, place: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from the seed pairs (token of the text, token of the item): (text, item, length).

    Of matches of the same length the one that is first in the item, then in the text, is marked.
    """
    pairs = np.unique(np.stack((at - place, at), 1), axis=0)
    breaks = np.flatnonzero((np.diff(pairs[:, 0]) != 0) | (np.diff(pairs[:, 1]) != 1)) + 1
    begins, stops = np.concatenate(([0], breaks)), np.concatenate((breaks, [len(pairs)]))
    heap = []
    for a, b in zip(begins, stops, strict=True):
        start, length = int(pairs[a, 1]), int(b - a) + n - 1
        heap.append((-length, start - int(pairs[a, 0]), start))
    heapq.heapify(heap)
    in_text, in_item = set(), np.zeros(len(item), bool)
    marked = []
    while heap:
        length, q, p = heapq.heappop(heap)
        length = -length
        free = [not in_item[q + k] and (p + k) not in in_text for k in range(length)]
        if all(free):
            marked.append((p, q, length))
            in_item[q : q + length] = True
            in_text.update(range(p, p + length))
            continue
        k = 0
        while k < length:
            if not free[k]:
                k += 1
                continue
            stop = k
            while stop < length and free[stop]:
                stop += 1
            if stop - k >= n:
                heapq.heappush(heap, (k - stop, q + k, p + k))
            k = stop
    return marked


def _matches(s: Slice, block: Block) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(text, item, tiles) of all pairs that share a seed."""
    hashes, first = tokens(s)
    for n in block.lengths:
        if len(hashes) < n:
            continue
        begins = np.flatnonzero(window_starts(first, n))
        seeds = _seed(hashes, n)[begins]
        may = block.sieve[seeds >> U64(64 - _SIEVE_BITS)]
        begins, seeds = begins[may], seeds[may]
        low, high = np.searchsorted(block.seeds, seeds), np.searchsorted(block.seeds, seeds, "right")
        times = high - low
        at = np.repeat(begins, times)
        entry = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item, place = block.item[entry], block.place[entry]
        text = np.searchsorted(first, at, "right") - 1
        order = np.lexsort((item, text))
        at, item, place, text = at[order], item[order], place[order], text[order]
        edge = np.flatnonzero((np.diff(text) != 0) | (np.diff(item) != 0)) + 1
        for a, b in zip([0, *edge], [*edge, len(at)], strict=True):
            if a < b and min(MIN_MATCH, len(block.tokens[item[a]])) == n:
                mine = hashes[first[text[a]] : first[text[a] + 1]]
                found = tiles(mine, block.tokens[item[a]], at[a:b] - first[text[a]], place[a:b], n)
                yield int(text[a]), int(item[a]), found


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    coverage: int = COVERAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every document and benchmark item whose marked share reaches ``coverage`` hundredths.

    A row per row of the documents and item: ids, numbers of tiles, marked tokens and tokens
    of the item.  Items of fewer than ``MIN_MATCH`` tokens have to occur whole.  Null and empty
    texts and items without tokens match nothing; null ids of documents are passed on; items
    without an id are left out, equal items count once.  Other columns are ignored.
    """
    texts = documents.select(documents[id_column].cast("long").alias("id"), documents[text_column].alias("body"))
    schema = "id long, item long, n_tiles long, n_marked long, n_tokens long"
    names = ["id", "item", "n_tiles", "n_marked", "n_tokens"]
    result = None
    for block in _blocks(benchmark, item_column, item_text_column, block_bytes):

        def search(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in slices(batch.column(1), lower=True):
                    rows = [(s.first + t, *_summed(block, i, found)) for t, i, found in _matches(s, block)]
                    rows = [r for r in rows if 100 * r[3] >= coverage * r[4]]
                    if rows:
                        place, *columns = zip(*rows, strict=True)
                        arrays = [batch.column(0).take(pa.array(place))]
                        arrays += [pa.array(c, pa.int64()) for c in columns]
                        yield pa.RecordBatch.from_arrays(arrays, names)

        part = texts.mapInArrow(search, schema)
        result = part if result is None else result.union(part)
    if result is None:
        result = documents.sparkSession.createDataFrame([], schema)
    return result.select(
        F.col("id").alias(id_column), F.col("item").alias("item_id"), "n_tiles", "n_marked", "n_tokens"
    )


def _summed(block: Block, item: int, found: list[tuple[int, int, int]]) -> tuple[int, int, int, int]:
    return block.ids[item], len(found), sum(length for _, _, length in found), len(block.tokens[item])


def decontaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    coverage: int = COVERAGE,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows whose text no benchmark item is found in; all columns, repeated rows included."""
    packed = packed_rows(documents)
    field = packed.schema[0].dataType.fieldNames().index(text_column)
    for block in _blocks(benchmark, item_column, item_text_column, block_bytes):

        def clean(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = np.ones(len(batch), bool)
                for s in slices(batch.column(0).field(field), lower=True):
                    for text, item, found in _matches(s, block):
                        _, _, marked, total = _summed(block, item, found)
                        kept[s.first + text] &= 100 * marked < coverage * total
                yield batch.filter(pa.array(kept))

        packed = packed.mapInArrow(clean, T.StructType([packed.schema[0]]))
    return packed.select("row.*")
