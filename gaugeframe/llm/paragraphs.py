"""Substring deduplication by paragraphs.

A paragraph is a line of a text.  Bands of minima are tuned so that a pair at the least
similarity meets in at least one band with the wanted recall; paragraphs that collide are
joined, their exact Jaccard similarity is verified, and of each connected component the
first paragraph stays and the others are marked for removal.

Passages do not keep to lines: any run of enough words that occurs again is found over the
word stream of the whole text.  Of every stretch of windows the one with the least hash is
an anchor, so equal runs have an anchor in common; around the anchors that occur again all
windows of the least length are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.llm.jaccard import SHINGLE_WORDS, SIMILAR, band_keys, connected, sorted_sets, sums
from gaugeframe.llm.rows import packed_rows
from gaugeframe.llm.storing import discard, release, small, stored
from gaugeframe.llm.text import U64, Rolling, least_of, mix, ranges, shingle_sets, slices, window_starts, windows
from gaugeframe.operators.bloom import keep_possible
from gaugeframe.operators.joins import BROADCAST_BYTES, measured_bytes

MIN_WORDS = 20
PASSAGE_WORDS = 50
BAND_ROWS = 3
RECALL = 0.99999
BROADCAST_ROWS = 1_000_000


def tuned_bands(similarity: float, rows: int = BAND_ROWS, recall: float = RECALL) -> int:
    """The least number of bands of ``rows`` minima that finds a pair with that recall."""
    return ceil(log(1 - recall) / log(1 - similarity**rows))


def repeated_paragraphs(
    documents: DataFrame,
    min_words: int = MIN_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All paragraphs of at least ``min_words`` words that occur again, in any text.

    A row per paragraph: the id, the number of the line in its text from 0, start and end in
    code points, words, the keeper (id and line) of its component and whether it is removed.
    The keeper is the first by id and line.  Texts of a repeated id are taken together.  Null
    and empty texts and rows with a null id have no paragraphs; other columns are ignored.
    """
    bands = tuned_bands(SIMILAR[0] / SIMILAR[1])
    texts = documents.select(documents[id_column].cast("long").alias("id"), documents[text_column].alias("body"))
    texts = texts.dropna().withColumn("text", F.xxhash64("body"))
    plain = "id long, line long, start long, end long, n_words long, n long, sum_a long, sum_b long, text long"
    same = ["n", "sum_a", "sum_b"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns, hashes, bounds in _paragraphs(batch, min_words):
                keys = band_keys(hashes, bounds, bands, BAND_ROWS)
                offsets = pa.array(np.arange(len(keys) + 1) * bands, pa.int32())
                arrays = [*map(pa.array, columns), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))]
                yield pa.RecordBatch.from_arrays(arrays, [*_NAMES, "keys"])

    first = F.min(F.struct("id", "line", "text")).alias("first")
    lines = stored(texts.mapInArrow(sketch, f"{plain}, keys array<long>"), "paragraphs")
    classes = lines.groupBy(*same)
    classes = classes.agg(first, F.count("*").alias("times"), F.min_by("keys", "id").alias("keys"))
    # Sets are named by their sum; two different sets share one with a probability of 2^-64.
    classes = stored(classes.withColumn("rep", F.col("sum_a")), "paragraph-classes")
    release(documents.sparkSession)
    # The keys of all copies take most of the space.
    places = stored(lines.drop("keys", "text"), "paragraph-places")
    discard(lines)

    def elements(tiled: DataFrame) -> DataFrame:
        place = F.xxhash64("id", "text", "line").alias("place")
        wanted = tiled.join(classes.select("rep", "first.*"), "rep")
        wanted = stored(wanted.select("id", "text", "line", place, "sum_a", "sum_b", "tiles"), "wanted-lines")
        pieces = texts.select("id", "text", F.posexplode(F.split("body", "\n", -1)).alias("line", "body"))
        pieces = pieces.withColumn("line", F.col("line").cast("long")).select("*", place)
        # Only the lines that are compared are shuffled and cut again.
        chosen = keep_possible(pieces, wanted, "place").join(wanted, ["id", "text", "line", "place"])
        rows = chosen.select("id", "sum_a", "sum_b", "tiles", "body")
        return rows.mapInArrow(sorted_sets, "id long, tiles array<long>, elements binary")

    labels = connected(classes.select("rep", *same, "keys"), elements)
    joined = classes.drop("keys").join(labels, "rep", "left")
    joined = joined.withColumn("component", F.coalesce("component", "rep"))
    groups = joined.groupBy("component").agg(F.min("first").alias("keeper"), F.sum("times").alias("times"))
    groups = groups.filter("times > 1").select("component", "keeper")
    repeated = stored(joined.select(*same, "component").join(groups, "component"), "repeated")
    discard(classes)
    release(documents.sparkSession)
    found = places.join(small(repeated, broadcast_rows), same)
    removed = (F.col("id") != F.col("keeper.id")) | (F.col("line") != F.col("keeper.line"))
    return found.select(
        F.col("id").alias(id_column), "line", "start", "end", "n_words",
        F.col("keeper.id").alias("keep_id"), F.col("keeper.line").alias("keep_line"), removed.alias("removed"),
    )


def repeated_text(
    documents: DataFrame,
    min_words: int = MIN_WORDS,
    passage_words: int = PASSAGE_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Paragraphs that occur again, exactly or nearly, and passages that do so at any place of a text.

    The rows of ``repeated_paragraphs``, and those of ``repeated_passages`` with a null ``line``, since a
    passage may lie within a line or run over several.
    """
    lines = repeated_paragraphs(documents, min_words, id_column, text_column)
    runs = repeated_passages(documents, passage_words, id_column, text_column)
    none = F.lit(None).cast("long")
    runs = runs.withColumns({"line": none, "keep_line": none}).select(*lines.columns)
    return lines.unionByName(runs)


def without_repeats(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without the removed paragraphs; all columns and rows are kept."""
    found = repeated_paragraphs(documents, id_column=id_column, text_column=text_column).filter("removed")
    lines = found.groupBy(F.col(id_column).alias("id")).agg(F.collect_set(F.col("line").cast("int")).alias("lines"))
    body = F.col(f"row.`{text_column}`")
    kept = F.filter(F.split(body, "\n", -1), lambda line, place: ~F.coalesce(F.array_contains("lines", place), F.lit(False)))
    text = F.when(F.col("lines").isNull(), body).otherwise(F.concat_ws("\n", kept))
    keyed = packed_rows(documents).withColumn("id", F.col(f"row.`{id_column}`").cast("long"))
    joined = keyed.join(lines, "id", "left")
    return joined.select(*[(text if c == text_column else F.col(f"row.`{c}`")).alias(c) for c in documents.columns])


def repeated_passages(
    documents: DataFrame,
    min_words: int = PASSAGE_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All runs of at least ``min_words`` words that occur again, in any text and at any place.

    A row per run: the id, start and end in code points, words, the id and start of the keeper
    and whether the run is removed.  Every window of ``min_words`` words that occurs twice or
    more lies in a run; its keeper is its first occurrence by id, key of the text and place, and
    windows that overlap with the same shift to the same keeper are one run.  Runs with
    different keepers may overlap.  A text that is equal to one of a smaller id is one run.
    Words are compared in lower case (A-Z only), white space is not.  A repeated row counts,
    but is listed once.  Null and empty texts and rows with a null id have no runs; other
    columns are ignored.
    """
    texts = documents.select(documents[id_column].cast("long").alias("id"), documents[text_column].alias("body"))
    texts = texts.dropna().withColumn("text", F.xxhash64("body"))
    copies = texts.groupBy("text").agg(F.min("id").alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    copies = _small(stored(copies, "text-copies"), broadcast_rows)
    texts = texts.join(copies, "text", "left").select("id", "body", "text", "first", "rows")
    # Of equal texts one is searched.
    unique = texts.filter("first is null or id = first").select("id", "body", "text", F.coalesce("rows", F.lit(1)).alias("rows"))
    again = texts.filter("id <> first").select("id", "body", "text", "first")
    anchor = (min_words + 1) // 2

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1), lower=True):
                starts, ends, first = ranges(s)
                at, found, _ = _anchors(Rolling(s.data).of(starts, ends), first, min_words, anchor)
                rows = pa.array(s.first + np.searchsorted(first, at, "right") - 1)
                arrays = [pa.array(found.view(np.int64)), batch.column(0).take(rows)]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "rows"])

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1), lower=True):
                starts, ends, first = ranges(s)
                words = Rolling(s.data).of(starts, ends)
                at, keys, least = _anchors(words, first, min_words, anchor)
                low, high = _reach(at, keys, least, min_words, anchor)
                owner = np.searchsorted(first, at, "right") - 1
                point = np.concatenate(([0], np.cumsum((s.data & 0xC0) != 0x80)))
                begin = point[s.bounds[owner]]
                # All words of the windows whose anchor it is; equal windows have theirs at the same place.
                total = Rolling(words.view(np.uint8)).of(8 * low, 8 * high) ^ mix((at - low).astype(U64))
                rows = pa.array(s.first + owner)
                columns = [keys.view(np.int64), total.view(np.int64), at - first[owner], low - first[owner], high - low]
                columns += [point[starts[low]] - begin, point[ends[high - 1]] - begin]
                arrays = [batch.column(i).take(rows) for i in (0, 2, 3)] + [pa.array(c.astype(np.int64)) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "text", "rows", "key", "around", "at", *_RUN])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch.column(4).offsets.to_numpy()
            places, sizes = (batch.column(4).values.field(i).to_numpy() for i in (0, 1))
            for s in slices(batch.column(1), lower=True):
                starts, ends, first = ranges(s)
                words = Rolling(s.data).of(starts, ends)
                mine = slice(s.first, s.first + len(s) + 1)
                held = slice(offsets[mine][0], offsets[mine][-1])
                begin = np.repeat(first[:-1], np.diff(offsets[mine])) + places[held]
                # A window that starts from here to there has the anchor as its least.
                reach = np.zeros(len(words) + 1, np.int64)
                np.add.at(reach, begin, 1)
                np.add.at(reach, begin + sizes[held] - min_words + 1, -1)
                found = np.flatnonzero((np.cumsum(reach[:-1]) > 0) & window_starts(first, min_words))
                owner = np.searchsorted(first, found, "right") - 1
                point = np.concatenate(([0], np.cumsum((s.data & 0xC0) != 0x80)))
                begin = point[s.bounds[owner]]
                a, b = (windows(w, min_words)[found] if len(found) else found for w in (words, mix(words ^ _TURN)))
                rows = pa.array(s.first + owner)
                columns = [a.view(np.int64), b.view(np.int64), found - first[owner], np.full(len(found), min_words)]
                columns += [point[starts[found]] - begin, point[ends[found + min_words - 1]] - begin]
                arrays = [batch.column(i).take(rows) for i in (0, 2, 3)] + [pa.array(c.astype(np.int64)) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "text", "rows", "a", "b", *_RUN])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                starts, ends, first = ranges(s)
                long = np.flatnonzero(np.diff(first) >= min_words)
                point = np.concatenate(([0], np.cumsum((s.data & 0xC0) != 0x80)))
                begin = point[s.bounds[long]]
                columns = [np.zeros(len(long)), np.diff(first)[long]]
                columns += [point[starts[first[long]]] - begin, point[ends[first[long + 1] - 1]] - begin]
                arrays = [batch.column(i).take(pa.array(s.first + long)) for i in (0, 2, 3)]
                arrays += [pa.array(c.astype(np.int64)) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "text", "keep_id", *_RUN])

    run = "place long, n long, start long, stop long"
    # Most anchors occur once.  Those that occur again are found by their hashes alone; only rows that a
    # Bloom filter of them lets pass are written.
    again_keys = unique.select("rows", "body").mapInArrow(keys, "key long, rows long").groupBy("key")
    again_keys = again_keys.agg(F.sum("rows").alias("times")).filter("times > 1").select("key")
    again_keys = stored(again_keys, "repeated-keys")
    release(documents.sparkSession)
    marks = unique.mapInArrow(anchors, f"id long, text long, rows long, key long, around long, at long, {run}")
    marks = stored(keep_possible(marks, again_keys, "key"), "anchors")
    # If all that surrounds an anchor is equal too, so are all windows that hold it.
    times = marks.groupBy("key").agg(F.sum("rows").alias("times"), (F.min("around") == F.max("around")).alias("equal"))
    times = _small(stored(times.filter("times > 1").select("key", "equal"), "repeated-anchors"), broadcast_rows)
    possible, marks = marks, stored(marks.join(times, "key"), "marks")
    discard(possible)
    release(documents.sparkSession)
    held = marks.filter("not equal").groupBy("text").agg(F.collect_set(F.struct("place", "n")).alias("places"))
    held = stored(held, "anchored")
    # Texts without such an anchor stay where they are.
    chosen = keep_possible(unique, held, "text").join(held, "text").select("id", "body", "text", "rows", "places")
    found = stored(chosen.mapInArrow(near, f"id long, text long, rows long, a long, b long, {run}"), "windows")
    release(documents.sparkSession)
    same = marks.filter("equal").withColumnRenamed("key", "a").withColumnRenamed("around", "b").drop("at", "equal")
    placed = _kept(found, broadcast_rows).unionByName(_kept(same, broadcast_rows))
    # Runs of one text and keeper, joined where they touch.
    line = ["id", "text", "keep_id", "keep_text", "shift"]
    before = Window.partitionBy(*line).orderBy("place", "n").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col("place") >= F.max(F.col("place") + F.col("n")).over(before), F.lit(True))
    upto = Window.partitionBy(*line).orderBy("place", "n").rowsBetween(Window.unboundedPreceding, 0)
    runs = placed.withColumn("fresh", fresh.cast("long")).withColumn("run", F.sum("fresh").over(upto))
    runs = runs.groupBy(*line, "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("end"),
        (F.max(F.col("place") + F.col("n")) - F.min("place")).alias("n_words"), F.min("keep_start").alias("keep_start"),
    )
    removed = (F.col("id") != F.col("keep_id")) | (F.col("text") != F.col("keep_text")) | (F.col("shift") != 0)
    names = ["id", "start", "end", "n_words", "keep_id", "keep_start", "removed"]
    equal = again.mapInArrow(whole, f"id long, text long, keep_id long, {run}").distinct()
    equal = equal.select("id", "start", F.col("stop").alias("end"), F.col("n").alias("n_words"), "keep_id",
                         F.col("start").alias("keep_start"), F.lit(True).alias("removed"))
    return runs.withColumn("removed", removed).select(*names).unionByName(equal).withColumnRenamed("id", id_column)


def _kept(found: DataFrame, broadcast_rows: int) -> DataFrame:
    """Ranges that occur again, with their first occurrence and the shift to it."""
    keeper = F.min(F.struct("id", "text", "place", "start")).alias("keep")
    repeated = found.groupBy("a", "b").agg(F.sum("rows").alias("times"), keeper).filter("times > 1").drop("times")
    repeated = stored(repeated, "repeated-ranges")
    release(found.sparkSession)
    return found.join(_small(repeated, broadcast_rows), ["a", "b"]).select(
        "id", "text", "place", "n", "start", "stop", F.col("keep.id").alias("keep_id"), F.col("keep.text").alias("keep_text"),
        F.col("keep.start").alias("keep_start"), (F.col("keep.place") - F.col("place")).alias("shift"),
    )


def _small(rows: DataFrame, broadcast_rows: int) -> DataFrame:
    """``rows`` for broadcasting if they are few and their bytes, measured, are too."""
    few = rows.limit(broadcast_rows + 1).count() <= broadcast_rows
    return F.broadcast(rows) if few and measured_bytes(rows) <= BROADCAST_BYTES else rows


_RUN = ["place", "n", "start", "stop"]
_TURN = U64(0xA5A5A5A5A5A5A5A5)


def _anchors(words: np.ndarray, first: np.ndarray, min_words: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of windows of ``anchor`` words, of all in any ``min_words`` words the least, and
    the least of each window of ``min_words`` words by its first word (0: it is not of one text)."""
    if len(words) < min_words:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    hashes = windows(words, anchor)
    span = min_words - anchor + 1
    least = least_of(hashes, span)
    least = np.where(window_starts(first, min_words)[: len(least)], least, U64(0))
    around = np.concatenate((np.zeros(span - 1, U64), least, np.zeros(span - 1, U64)))
    most = ~least_of(~around, span)
    at = np.flatnonzero((hashes == most) & (most > 0))
    return at, hashes[at], least


def _reach(at: np.ndarray, hashes: np.ndarray, least: np.ndarray, min_words: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The first word and the end of the windows of ``min_words`` words in which an anchor is the least."""
    span = min_words - anchor + 1
    if not len(at):
        return at, at
    # Smaller hashes on either side end the stretch of windows that have this one as their least.
    begin = at[:, None] + np.arange(1 - span, 1)
    own = least[np.clip(begin, 0, len(least) - 1)] == hashes[:, None]
    own &= (begin >= 0) & (begin < len(least))
    return at - span + 1 + own.argmax(1), at - own[:, ::-1].argmax(1) + min_words


_NAMES = ["id", "line", "start", "end", "n_words", "n", "sum_a", "sum_b", "text"]
_LINES = 1 << 22


def _paragraphs(batch: pa.RecordBatch, min_words: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Columns of the long paragraphs, all their sorted shingles, and the bounds per paragraph."""
    sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    cuts = np.unique(np.searchsorted(sizes, np.arange(0, (sizes[-1] if len(sizes) else 0) + _LINES, _LINES)))
    for begin, stop in zip(cuts, [*cuts[1:], len(batch)], strict=True):
        if stop > begin:
            yield from _part(batch.slice(begin, stop - begin), min_words)


def _part(batch: pa.RecordBatch, min_words: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    listed = pc.split_pattern(batch.column(1).cast(pa.large_string()), "\n")
    counts = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
    lines = listed.flatten()
    ids, texts = (np.repeat(batch.column(i).to_numpy(), counts) for i in (0, 2))
    before = np.repeat(np.cumsum(counts) - counts, counts)
    number = np.arange(len(lines)) - before
    points = pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    through = np.cumsum(points + 1)
    starts = through - points - 1
    starts = starts - starts[before] if len(starts) else starts
    for first, hashes, bounds, words in shingle_sets(lines, SHINGLE_WORDS):
        long = np.flatnonzero(words >= max(1, min_words))
        kept = np.zeros(len(words), bool)
        kept[long] = True
        chosen = hashes[np.repeat(kept, np.diff(bounds))]
        new = np.concatenate(([0], np.cumsum(np.diff(bounds)[long])))
        at = first + long
        columns = [ids[at], number[at], starts[at], starts[at] + points[at], words[long], np.diff(new)]
        yield [c.astype(np.int64) for c in columns] + [*sums(chosen, new), texts[at]], chosen, new
