"""N-gram Jaccard join of documents, to connected components.

Equal sets are one class with the smallest id as its representative.  Representatives that
share the key of any of many bands of minima are candidates of each other; a pair with a
similarity of 0.8 shares none with a probability below 3e-15, less than that of equal hashes
of different words.  Candidates that hang together form tiles.  A large group is cut into
tiles by bands of set size, and by salt within a band; only tiles of the same band and of
neighbouring bands meet, since sets that differ more in size cannot be linked.

In a tile, every set has a hashed bitmap.  Each bit that one bitmap has and the other lacks
stands for an element that is not shared, so bit counts bound the overlap from above; pairs
that pass are decided by exact intersection of the sorted sets.  Sets already known to be
connected in the tile are not compared again, so a group of n near copies needs about n
comparisons and gives n - 1 edges, not all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.components import components
from gaugeframe.llm.storing import release, small, stored
from gaugeframe.llm.text import U64, mix, shingle_sets
from gaugeframe.storage import cut_lineage

SHINGLE_WORDS = 5
# Links: SIMILAR[0] / SIMILAR[1] or more of the union is shared.
SIMILAR = (80, 100)
BANDS, BAND_ROWS = 64, 4
SIZE_BAND = 1.26
TILE_SETS = 2000
TILE_ELEMENTS = 2_000_000
BROADCAST_ROWS = 2_000_000

_random = np.random.default_rng(6_174)
_TURN = _random.integers(0, 2**32, BANDS * BAND_ROWS, dtype=np.uint32)
_FACTOR = _random.integers(0, 2**31, BANDS * BAND_ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tile_sets: int = TILE_SETS,
    tile_elements: int = TILE_ELEMENTS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    One row per input row, repeated rows included.  The component is the smallest id that is
    reachable by links.  Null and empty texts, and texts without words, have no shingles and
    are linked with nothing.  Rows with a null id have no component and link nobody.  Ids are
    whole numbers; rows with the same id and different texts are documents of their own that
    share an id.  Other columns are ignored.
    """
    found = text_components(documents, id_column, text_column, tile_sets, tile_elements, broadcast_rows)
    return found.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def text_components(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tile_sets: int = TILE_SETS,
    tile_elements: int = TILE_ELEMENTS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``id``, key of the ``text``, ``n``, ``group`` and ``component`` of every row.

    The group is that of the row's own text, also where its id has other texts; the component
    is the smallest id in the group.
    """
    texts = documents.select(documents[id_column].cast("long").alias("id"), documents[text_column].alias("body"))
    keyed = texts.withColumn("text", F.xxhash64("body"))
    sets = stored(keyed.mapInArrow(_sketch, "id long, text long, n long, sum_a long, sum_b long, keys array<long>"), "sets")
    same = ["n", "sum_a", "sum_b"]
    classes = sets.filter((F.col("n") > 0) & F.col("id").isNotNull()).groupBy(*same)
    classes = classes.agg(F.min("id").alias("first"), F.min_by("keys", "id").alias("keys"))
    # Sets are named by their sum, since texts may share an id; two share one with a probability of 2^-64.
    classes = stored(classes.withColumn("rep", F.col("sum_a")), "classes")

    def elements(tiled: DataFrame) -> DataFrame:
        wanted = tiled.join(classes.select("rep", F.col("first").alias("id")), "rep").drop("rep")
        chosen = texts.join(small(wanted, broadcast_rows), "id")
        rows = chosen.select("id", "sum_a", "sum_b", "tiles", "body")
        return rows.mapInArrow(sorted_sets, "id long, tiles array<long>, elements binary")

    labels = connected(classes.drop("first"), elements, tile_sets, tile_elements)
    labelled = classes.drop("keys").join(labels, "rep", "left")
    labelled = stored(labelled.select(*same, "first", F.coalesce("component", "rep").alias("group")), "labelled")
    least = labelled.groupBy("group").agg(F.min("first").alias("component"), F.count("*").alias("sets"))
    # A set without links is its own group.
    least = stored(least.filter("sets > 1").drop("sets"), "least")
    labelled = labelled.join(small(least, broadcast_rows), "group", "left")
    labelled = labelled.select(*same, "group", F.coalesce("component", "first").alias("component"))
    joined = sets.drop("keys").join(labelled, same, "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")))
    group = F.coalesce("group", "text").alias("group")
    return joined.select("id", "text", "n", group, component.alias("component"))


def connected(
    classes: DataFrame,
    elements: Callable[[DataFrame], DataFrame],
    tile_sets: int = TILE_SETS,
    tile_elements: int = TILE_ELEMENTS,
) -> DataFrame:
    """``rep`` and ``component`` of all sets that are linked with another one.

    ``classes`` has different sets: ``rep``, ``n``, ``sum_a``, ``sum_b`` and the band ``keys``.
    ``elements`` is given candidates (``rep``, the sums, ``tiles``) and returns their sorted
    sets (``id``, ``tiles``, ``elements``).
    """
    keyed = classes.select("rep", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
    shared = cut_lineage(shared.filter("low < high").select("key", "low"))
    release(classes.sparkSession)
    touching = keyed.join(shared, "key").filter("rep <> low").select("rep", "low").distinct()
    groups = components(touching, "rep", "low").withColumnRenamed("node", "rep")
    members = cut_lineage(classes.drop("keys").join(groups, "rep"))
    release(classes.sparkSession)
    tiles = _tiles(members, tile_sets, tile_elements)
    release(classes.sparkSession)
    rows = elements(tiles)
    placed = rows.select("id", F.explode("tiles").alias("tile"), "elements")
    ordered = placed.repartition("tile").sortWithinPartitions("tile", "id")
    edges = cut_lineage(ordered.mapInArrow(_edges, "a long, b long").distinct())
    release(classes.sparkSession)
    labels = cut_lineage(components(edges).withColumnRenamed("node", "rep"))
    release(classes.sparkSession)
    return labels


def _tiles(members: DataFrame, tile_sets: int, tile_elements: int) -> DataFrame:
    """The tiles of every candidate: its group, or its size-banded parts if the group is large."""
    groups = members.groupBy("component").agg(F.count("*").alias("sets"), F.sum("n").alias("elements"))
    large = (F.col("sets") > tile_sets) | (F.col("elements") > tile_elements)
    # There are fewer large groups than sets divided by the size of a tile.
    groups = cut_lineage(groups.filter(large).select("component", F.lit(True).alias("large")))
    sized = members.join(small(groups, BROADCAST_ROWS), "component", "left")
    sized = sized.withColumn("large", F.coalesce("large", F.lit(False))).withColumn("band", F.floor(F.log(SIZE_BAND, F.col("n"))))
    bands = sized.filter("large").groupBy("component", "band")
    parts = F.ceil(F.greatest(F.count("*") / tile_sets, F.sum("n") / tile_elements))
    bands = cut_lineage(bands.agg(parts.cast("long").alias("parts")))

    def near(step: int, name: str) -> DataFrame:
        return bands.select("component", (F.col("band") - step).alias("band"), F.col("parts").alias(name))

    for step, name in ((0, "own"), (1, "above"), (-1, "below")):
        sized = sized.join(small(near(step, name), BROADCAST_ROWS), ["component", "band"], "left")
    salt = F.pmod(F.xxhash64("rep"), F.col("own"))

    def tile(low, first, high, second):
        return F.xxhash64(F.col("component"), low, first, high, second)

    def each(count: str, make):
        none = F.array().cast("array<bigint>")
        numbers = F.sequence(F.lit(0).cast("long"), F.col(count) - 1)
        return F.when(F.col(count) > 0, F.transform(numbers, make)).otherwise(none)

    band = F.col("band")
    own = each("own", lambda t: tile(band, F.least(salt, t), band, F.greatest(salt, t)))
    above = each("above", lambda t: tile(band, salt, band + 1, t))
    below = each("below", lambda t: tile(band - 1, t, band, salt))
    tiles = F.when(F.col("large"), F.concat(own, above, below)).otherwise(F.array(F.xxhash64("component")))
    return cut_lineage(sized.select("rep", "sum_a", "sum_b", tiles.alias("tiles")))


def sums(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two sums per set that tell different sets apart."""
    result = []
    for turn in (U64(0), U64(0xA5A5A5A5A5A5A5A5)):
        total = np.concatenate((np.zeros(1, U64), np.add.accumulate(mix(hashes ^ turn))))
        result.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return result


def band_keys(hashes: np.ndarray, bounds: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """For each set and band a hash of the minima of the band's rows; sets are not empty."""
    high = (hashes >> U64(32)).astype(np.uint32)
    keys = np.zeros((len(bounds) - 1, bands), U64)
    for band in range(bands if len(bounds) > 1 else 0):
        key = np.full(len(bounds) - 1, band, U64)
        for j in range(band * rows, (band + 1) * rows):
            minima = np.minimum.reduceat((high ^ _TURN[j]) * _FACTOR[j], bounds[:-1])
            key = mix(key * U64(0x100000001B3) + minima)
        keys[:, band] = key
    return keys.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "text", "n", "sum_a", "sum_b", "keys"]
    for batch in batches:
        for first, hashes, bounds, _ in shingle_sets(batch.column(1), SHINGLE_WORDS):
            sizes = np.diff(bounds)
            keys = band_keys(hashes, np.append(bounds[:-1][sizes > 0], bounds[-1]))
            offsets = np.concatenate(([0], np.cumsum((sizes > 0) * BANDS)))
            arrays = [batch.column(i).slice(first, len(sizes)) for i in (0, 2)] + [pa.array(sizes, pa.int64())]
            arrays += map(pa.array, sums(hashes, bounds))
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.ravel())))
            yield pa.RecordBatch.from_arrays(arrays, names)


def sorted_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted sets of rows ``id``, ``sum_a``, ``sum_b``, ``tiles`` and text, named by their first sum."""
    for batch in batches:
        wanted = [batch.column(i).to_numpy() for i in (1, 2)]
        for first, hashes, bounds, _ in shingle_sets(batch.column(4), SHINGLE_WORDS):
            found = sums(hashes, bounds)
            mine = slice(first, first + len(bounds) - 1)
            # Another text with the same id is not the one that was chosen.
            right = np.flatnonzero((found[0] == wanted[0][mine]) & (found[1] == wanted[1][mine]))
            elements = pa.array([hashes[bounds[i] : bounds[i + 1]].tobytes() for i in right], pa.binary())
            place = pa.array(first + right)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(place), batch.column(3).take(place), elements], ["id", "tiles", "elements"]
            )


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the components within each tile; the rows come ordered by tile and id."""
    tile, ids, sets = None, [], []

    def found() -> Iterator[pa.RecordBatch]:
        pairs = linked(ids, sets)
        if pairs:
            a, b = zip(*pairs, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        for mark, name, elements in zip(batch.column(1), batch.column(0), batch.column(2), strict=True):
            mark, name = mark.as_py(), name.as_py()
            if mark != tile:
                yield from found()
                tile, ids, sets = mark, [], []
            if not ids or ids[-1] != name:
                ids.append(name)
                sets.append(np.frombuffer(elements.as_py(), U64))
    yield from found()


def linked(ids: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect each component of a tile: (a member, the member found through it)."""
    if len(ids) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    bits = 1 << max(8, min(14, int(2 * sizes.max()).bit_length()))
    maps = np.zeros((len(sets), bits // 64), U64)
    for row, elements in enumerate(sets):
        place = (elements & U64(bits - 1)).astype(np.int64)
        np.bitwise_or.at(maps[row], place >> 6, U64(1) << (place & 63).astype(U64))
    rest = np.arange(len(sets))
    pairs = []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            hit = _similar(one, rest, sizes, maps, sets)
            pairs += [(ids[one], ids[int(i)]) for i in rest[hit]]
            queue += [int(i) for i in rest[hit]]
            rest = rest[~hit]
    return pairs


def _similar(one: int, rest: np.ndarray, sizes: np.ndarray, maps: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Which of the sets in ``rest`` are linked with ``one``."""
    shares, whole = SIMILAR
    # shared / (sum - shared) >= shares / whole, in whole numbers.
    total = sizes[one] + sizes[rest]
    hit = whole * np.minimum(sizes[one], sizes[rest]) >= shares * np.maximum(sizes[one], sizes[rest])
    near = np.flatnonzero(hit)
    mine, theirs = maps[one], maps[rest[near]]
    lost_here = np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64)
    lost_there = np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64)
    bound = np.minimum(sizes[one] - lost_here, sizes[rest[near]] - lost_there)
    passing = near[(whole + shares) * bound >= shares * total[near]]
    hit[:] = False
    if len(passing):
        others = [sets[i] for i in rest[passing]]
        every = np.concatenate(others)
        place = np.minimum(np.searchsorted(sets[one], every), sizes[one] - 1)
        begins = np.cumsum([0, *(len(o) for o in others[:-1])])
        overlap = np.add.reduceat((sets[one][place] == every).astype(np.int64), begins)
        hit[passing] = (whole + shares) * overlap >= shares * total[passing]
    return hit
