"""Toxicity by a factorization machine over hashed terms.

    score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

The pairwise part sees terms that are harmless alone and toxic together, which additive
weights miss.  Terms are words and their first bytes, hashed to a fixed number of buckets;
``x_i`` is the root of a term's share of the text.  The machine is fitted on a bounded
sample of labelled rows, so its fit costs the same at every size of the corpus; scoring is
one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.text import U64, Rolling, Slice, slices

BITS = 18
FACTORS = 4
# At most so many labelled rows are used to fit.
MAX_FIT_ROWS = 12_000
PREFIX_BYTES = (5, 7)
MIN_ERRORS = 3.0
EPOCHS = 12
BATCH = 512
RATE = 0.15
PENALTY = 2e-6
POSITIVE_WEIGHT = 2.0
SEED = 7

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows that is never learned from; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def terms(s: Slice, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and values of all texts of a slice, and the first entry of each text."""
    inside = np.concatenate(([False], _LETTER[s.data]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    rolling = Rolling(s.data)
    owner = np.searchsorted(s.bounds, starts, "right") - 1
    hashes, owners = [rolling.of(starts, ends)], [owner]
    for n in PREFIX_BYTES:
        long = ends - starts > n
        hashes.append(rolling.of(starts[long], starts[long] + n) * U64(0xD6E8FEB86659FD93))
        owners.append(owner[long])
    bucket = (np.concatenate(hashes) >> U64(64 - bits)).astype(np.int64)
    key = np.sort((np.concatenate(owners) << bits) | bucket)
    fresh = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(fresh, len(key)))
    key = key[fresh]
    text, bucket = key >> bits, key & ((1 << bits) - 1)
    first = np.searchsorted(text, np.arange(len(s) + 1))
    total = np.bincount(text, counts, len(s))
    return bucket.astype(np.int32), np.sqrt(counts / total[text]).astype(np.float32), first


def fit(
    documents: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_FIT_ROWS,
    bits: int = BITS,
    factors: int = FACTORS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Machine:
    """Fit on the labelled rows that are not held out, at most ``max_rows`` of them.

    Which rows are taken is decided by a hash of their id.  Rows without a label are ignored;
    a repeated id counts once, as toxic if any of its rows says so, with the least of its texts.
    Without any labelled row every score is one half.
    """
    ids = labels.select(labels[id_column].alias("id"), labels[label_column].alias("label")).dropna()
    ids = ids.filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    ids = ids.withColumn("place", F.xxhash64(F.col("id").cast("string"))).orderBy("place", "id").limit(max_rows)
    texts = documents.select(documents[id_column].alias("id"), documents[text_column].alias("body"))
    # One text for each id, so that the rows are bounded however often an id repeats in the documents.
    chosen = texts.join(F.broadcast(ids), "id").groupBy("id", "place", "label").agg(F.min("body").alias("body"))
    chosen = chosen.select("place", F.col("label").cast("int"), "body")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(2)):
                bucket, value, first = terms(s, bits)
                arrays = [batch.column(i).slice(s.first, len(s)) for i in (0, 1)]
                arrays += [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x)) for x in (bucket, value)]
                yield pa.RecordBatch.from_arrays(arrays, ["place", "label", "bucket", "value"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _learn(list(batches), bits, factors)
        arrays = [pa.array([x.astype("<f4").tobytes()]) for x in (machine.weights, machine.factors)]
        yield pa.RecordBatch.from_arrays([pa.array([machine.bias]), *arrays], ["bias", "weights", "factors"])

    features = chosen.mapInArrow(extract, "place long, label int, bucket array<int>, value array<float>")
    # A bounded number of rows: one task learns from all of them.
    one = features.repartition(1).sortWithinPartitions("place", "label")
    learned = one.mapInArrow(learn, "bias double, weights binary, factors binary").first()
    if learned is None:
        return Machine(0.0, np.zeros(1 << bits, np.float32), np.zeros((1 << bits, factors), np.float32))
    weights = np.frombuffer(learned["weights"], "<f4")
    return Machine(learned["bias"], weights, np.frombuffer(learned["factors"], "<f4").reshape(1 << bits, factors))


def _learn(batches: list[pa.RecordBatch], bits: int, factors: int) -> Machine:
    """Fit to batches of (place, label, bucket, value); only what tells the label is unpacked."""
    size = 1 << bits
    random = np.random.default_rng(SEED)
    weights = np.zeros(size)
    inner = random.normal(0, 0.02, (size, factors))
    label = np.concatenate([b.column(1).to_numpy() for b in batches]) if batches else np.zeros(0, np.int32)
    if not len(label):
        return Machine(0.0, weights.astype(np.float32), np.zeros((size, factors), np.float32))
    scale = _told_by_label(batches, label, size)
    kept = [_kept_terms(b, scale) for b in batches]
    row_count = np.concatenate([c for c, _, _ in kept])
    bucket, value = np.concatenate([k for _, k, _ in kept]), np.concatenate([v for _, _, v in kept])
    first = np.concatenate(([0], np.cumsum(row_count)))
    share = (label.sum() + 1) / (len(label) + 2)
    bias = float(np.log(share / (1 - share)))
    pace = [1e-8, np.full(size, 1e-8), np.full((size, factors), 1e-8)]
    for _ in range(EPOCHS):
        order = random.permutation(len(label))
        for begin in range(0, len(label), BATCH):
            rows = order[begin : begin + BATCH]
            sizes = first[rows + 1] - first[rows]
            entry = np.repeat(first[rows] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
            row = np.repeat(np.arange(len(rows)), sizes)
            used, place = np.unique(bucket[entry], return_inverse=True)
            x = value[entry].astype(np.float64)
            xv = inner[used][place] * x[:, None]
            together = _by_row(xv, row, len(rows))
            pairs = 0.5 * (together**2 - _by_row(xv**2, row, len(rows))).sum(1)
            logit = bias + np.bincount(row, weights[used][place] * x, len(rows)) + pairs
            target = label[rows]
            error = (_sigmoid(logit) - target) * np.where(target == 1, POSITIVE_WEIGHT, 1.0) / len(rows)
            steps = [
                error.sum(),
                np.bincount(place, error[row] * x, len(used)) + PENALTY * weights[used],
                _by_row(error[row, None] * x[:, None] * (together[row] - xv), place, len(used)) + PENALTY * inner[used],
            ]
            pace[0] += steps[0] ** 2
            bias -= RATE * steps[0] / np.sqrt(pace[0])
            pace[1][used] += steps[1] ** 2
            weights[used] -= RATE * steps[1] / np.sqrt(pace[1][used])
            pace[2][used] += steps[2] ** 2
            inner[used] -= 0.2 * RATE * steps[2] / np.sqrt(pace[2][used])
    weights, inner = weights * scale, inner * scale[:, None]
    return Machine(bias, weights.astype(np.float32), inner.astype(np.float32))


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries per row, buckets and values of a batch."""
    counts = np.diff(batch.column(2).offsets.to_numpy())
    return counts, batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()


def _kept_terms(batch: pa.RecordBatch, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts, bucket, value = _entries(batch)
    kept = np.flatnonzero(scale[bucket] > 0)
    rows = np.searchsorted(np.cumsum(counts), kept, "right")
    return np.bincount(rows, minlength=len(counts)), bucket[kept], value[kept] * scale[bucket[kept]]


def _told_by_label(batches: list[pa.RecordBatch], label: np.ndarray, size: int) -> np.ndarray:
    """Scale of each bucket: how many standard errors its log odds of the label are from none.

    Buckets within ``MIN_ERRORS`` of none have scale 0, so the machine cannot learn rows by
    heart from their rare words.  The scale is multiplied into the weights after the fit.
    """
    toxic, clean = np.ones(size), np.ones(size)
    for batch in batches:
        counts, bucket, _ = _entries(batch)
        mark = np.repeat(batch.column(1).to_numpy() == 1, counts)
        toxic += np.bincount(bucket[mark], minlength=size)
        clean += np.bincount(bucket[~mark], minlength=size)
    odds = np.log(toxic / clean) - np.log(((label == 1).sum() + 2) / ((label != 1).sum() + 2))
    errors = np.abs(odds) / np.sqrt(1 / toxic + 1 / clean)
    return np.where(errors >= MIN_ERRORS, errors, 0.0)


def _by_row(values: np.ndarray, row: np.ndarray, count: int) -> np.ndarray:
    return np.stack([np.bincount(row, values[:, k], count) for k in range(values.shape[1])], 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def score_slice(s: Slice, machine: Machine) -> np.ndarray:
    bits = len(machine.weights).bit_length() - 1
    bucket, x, first = terms(s, bits)
    row = np.repeat(np.arange(len(s)), np.diff(first))
    xv = machine.factors[bucket] * x[:, None]
    pairs = 0.5 * (_by_row(xv, row, len(s)) ** 2 - _by_row(xv**2, row, len(s))).sum(1)
    return _sigmoid(machine.bias + np.bincount(row, machine.weights[bucket] * x, len(s)) + pairs)


def add_scores(
    documents: DataFrame, machine: Machine, text_column: str = "text", score_column: str = "score"
) -> DataFrame:
    """Add the score of every row, from its whole text alone.

    Rows are neither moved nor dropped, repeated rows included; null and empty texts have the
    score of no terms.  A column that has the new name already is replaced.  Only the texts go
    to Python, once, and only scores come back; the rows stay in the JVM.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [score_slice(s, machine) for s in slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    # Else a filter by the score would score the texts a second time.
    score = score.asNondeterministic()
    kept = [F.col(f"`{c}`") for c in documents.columns if c.lower() != score_column.lower()]
    return documents.select(*kept, score(F.col(f"`{text_column}`")).alias(score_column))
