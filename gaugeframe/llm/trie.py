"""Prefix trie of conversations: who shares which first turns, and what sharing them saves.

Conversations are sorted by the digests of their turns, so those with a common beginning are
neighbours, and the length of the common prefix (LCP) of neighbours says how much they share.
Each partition joins its neighbours by union-find over these edges in descending depth: every
merge makes the branching node at that depth, and the nodes on the way down to the one below
have the members of that one.  A node that reaches beyond its partition is left open.  Open
nodes lie on the paths to the first and the last conversation of a partition; these contracted
forests are merged across the boundaries, where the LCP of the two neighbouring
partitions tells which open nodes are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.llm.storing import stored
from gaugeframe.llm.turns import digest
from gaugeframe.operators.joins import join_on_key
from gaugeframe.storage import cut_lineage

WIDTH = 16  # bytes of a digest
EMIT_ROWS = 1 << 16

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
# A row of a partition's forest.  ``open_key`` marks a node that reaches beyond the partition, whose
# numbers are those of its closed children here; ``parent_key`` points at an open parent.
_FOREST = NODE + ", parent_key long, open_key long, part int, size long, ends binary"


def sequences(conversations: DataFrame) -> DataFrame:
    """Per conversation its turns in order: an array of their digests (hex) and text lengths.

    Turns are ordered by number, null first, turns of one number by their digest; null roles and
    texts are empty.  Rows without a conversation id belong to no conversation and are left out.
    No text is shuffled; a conversation's digests form one row.
    """
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    light = conversations.select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"),
        F.hex(digest(role, text)).alias("digest"),
        F.char_length(text).cast("long").alias("size"),
    ).filter("conv_id is not null")
    ordered = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "digest", "size")))
    turns = F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return light.groupBy("conv_id").agg(turns.alias("turns"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per distinct beginning of the sequences of ``turns`` (``conv_id``, ``turns``).

    A node is named by its depth and its smallest member ``conv_id``; a sequence without turns is a
    member of the root only.  ``n_convs`` members, ``n_children``, ``n_leaves`` (childless nodes of the
    subtree), ``saved_tokens`` (over the subtree, members but one times the length of the node's last
    turn), and the digest of the ascending ids of the conversations that end at the node.
    No sequences give no nodes.  Ids are distinct.

    Sorted by ranges of (digests, id), a beginning that very many conversations share is spread over
    many partitions.  What is merged in one task are the open nodes, at most the LCPs at the
    partition boundaries, and the ids that end at them.
    """
    key = F.unhex(F.array_join(F.col("turns.digest"), ""))
    flat = turns.select("conv_id", key.alias("key"), F.col("turns.size").alias("sizes"))
    order = [F.col("key").asc(), F.col("conv_id").asc()]
    # The checkpoint keeps partitions and order for the two passes.
    placed = cut_lineage(flat.repartitionByRange(*order).sortWithinPartitions(*order))
    bounds = _boundaries(placed)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is not None and table.num_rows:
            yield from _Forest(TaskContext.get().partitionId(), bounds, table).rows()

    forest = stored(placed.mapInArrow(grow, _FOREST), "forest")
    preorder = forest.filter("open_key is not null").repartition(1).sortWithinPartitions("open_key", "part")
    merged = stored(preorder.mapInArrow(_merge, NODE + ", open_key long"), "open-nodes")
    names = NODE.replace(",", "").split()[::2]
    closed = forest.filter("open_key is null")
    lookup = merged.select(F.col("open_key").alias("parent_key"), F.col("conv_id").alias("parent"))
    below = join_on_key(closed.filter("parent_key is not null"), lookup, "parent_key")
    below = below.withColumn("parent_conv_id", F.col("parent"))
    inner = closed.filter("parent_key is null")
    return inner.select(names).union(below.select(names)).union(merged.select(names))


def _boundaries(placed: DataFrame) -> list[tuple[int, int, int]]:
    """Per partition with rows its number, the LCP of its first key with the key before it (-1 at the
    start), and that of its first and last key."""
    ends = placed.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("first"), F.max("key").alias("last"))
    pairs = ends.select("part", F.lag("last").over(Window.orderBy("part")).alias("before"), "first", "last")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [-1 if r["before"] is None else _shared(r["before"], r["first"]) for r in rows]
            inner = [_shared(r["first"], r["last"]) for r in rows]
            columns = [batch.column(0), pa.array(found, pa.int64()), pa.array(inner, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "before", "inner"])

    # One row per partition.
    return sorted(tuple(r) for r in pairs.mapInArrow(shared, "part int, before long, inner long").collect())


def _shared(a: bytes, b: bytes) -> int:
    """Number of turns that two keys begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    differs = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differs.argmax()) // WIDTH


class _Component:
    """Joined neighbours ``low`` to ``high`` and their deepest common node, while it grows."""

    __slots__ = ("low", "high", "depth", "least", "members", "ends", "children", "leaves", "saved", "below")

    def __init__(self, low: int, high: int, depth: int, least: int, members: int) -> None:
        self.low, self.high, self.depth, self.least, self.members = low, high, depth, least, members
        self.ends = self.children = self.leaves = self.saved = 0
        self.below: list[int] = []  # rows whose parent is the node


class _Forest:
    """The nodes of one partition, by union-find over its neighbours in descending depth."""

    def __init__(self, part: int, bounds: Sequence[tuple[int, int, int]], table: pa.Table) -> None:
        self.part = part
        at = [p for p, _, _ in bounds].index(part)
        self.left = bounds[at][1]
        self.right = bounds[at + 1][1] if at + 1 < len(bounds) else -1
        # Where a node of some depth that comes in from the left begins: going back, the first
        # partition that is not all within the node, or whose neighbour on the left is not.
        self.starts: list[tuple[int, int]] = []
        for p, before, inner in reversed(bounds[: at + 1]):
            for lcp in (before,) if p == part else (inner, before):
                if not self.starts or lcp < self.starts[-1][1]:
                    self.starts.append((p, lcp))
        self.ids = table.column("conv_id").to_numpy()
        sizes = table.column("sizes").combine_chunks()
        self.bounds = sizes.offsets.to_numpy() - sizes.offsets[0].as_py()
        self.sizes = sizes.flatten().to_numpy()
        keys = table.column("key").to_pylist()
        self.shared = np.array([_shared(a, b) for a, b in zip(keys, keys[1:])], np.int64)
        self.out: list[list] = []

    def rows(self) -> Iterator[pa.RecordBatch]:
        root = self._joined()
        self._climb(root, -1)
        names = _FOREST.replace(",", "").split()
        for first in range(0, len(self.out), EMIT_ROWS):
            columns = zip(*self.out[first : first + EMIT_ROWS])
            kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
            arrays = [pa.array(c, kinds[k]) for c, k in zip(columns, names[1::2])]
            yield pa.RecordBatch.from_arrays(arrays, names[::2])

    def _joined(self) -> _Component:
        lengths = np.diff(self.bounds).tolist()
        components = []
        for i, (length, conv) in enumerate(zip(lengths, self.ids.tolist())):
            leaf = _Component(i, i, length, conv, 1)
            leaf.ends = 1
            components.append(leaf)
        parent = list(range(len(components)))

        def root_of(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for edge in np.argsort(-self.shared, kind="stable").tolist():
            depth = int(self.shared[edge])
            a, b = root_of(edge), root_of(edge + 1)
            left, right = self._climb(components[a], depth), self._climb(components[b], depth)
            if len(left.below) < len(right.below):
                left.below, right.below = right.below, left.below
            left.below += right.below
            left.high = right.high
            left.least = min(left.least, right.least)
            for name in ("members", "ends", "children", "leaves", "saved"):
                setattr(left, name, getattr(left, name) + getattr(right, name))
            parent[b] = a
            components[a], components[b] = left, None
        return components[root_of(0)]

    def _climb(self, c: _Component, depth: int) -> _Component:
        """Finish the nodes of ``c`` deeper than ``depth``; the component of its node at that depth."""
        while c.depth > depth:
            row, is_open = self._finish(c)
            above = _Component(c.low, c.high, c.depth - 1, c.least, c.members)
            above.below = [row]
            if not is_open:
                above.children, above.leaves, above.saved = 1, self.out[row][5], self.out[row][6]
            c = above
        return c

    def _finish(self, c: _Component) -> tuple[int, bool]:
        """Write the row of a component's node, and name it as the parent of the rows below."""
        last = len(self.ids) - 1
        from_left = c.low == 0 and c.depth <= self.left
        is_open = from_left or (c.high == last and c.depth <= self.right)
        size = int(self.sizes[self.bounds[c.low] + c.depth - 1]) if c.depth else 0
        ends = self.ids[c.low : c.low + c.ends]
        row = [c.least, c.depth, None, c.members, c.children, c.leaves, c.saved, None, None, None, self.part, size, None]
        if is_open:
            start = next(p for p, lcp in self.starts if lcp < c.depth) if from_left else self.part
            row[9], row[12] = (start << 32) + c.depth, ends.astype("<i8").tobytes()
        else:
            row[5] = c.leaves if c.children else 1
            row[6] = c.saved + (c.members - 1) * size
            row[7] = hashlib.sha256(",".join(map(str, ends.tolist())).encode()).hexdigest()
        for below in c.below:
            # An open row finds its parent when open nodes are merged.
            self.out[below][8 if is_open else 2] = row[9] if is_open else c.least
        self.out.append(row)
        return len(self.out) - 1, is_open


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open nodes, sorted by where they begin and by depth, which is their order from the root down.

    Rows of one key are one node; its children follow it.  Only the path to the current node is held.
    """
    path: list[dict] = []
    out: list[dict] = []

    def close(depth: int) -> None:
        while path and path[-1]["depth"] >= depth:
            node = path.pop()
            node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node.pop("size")
            node["ends_sha256"] = node.pop("hash").hexdigest()
            if path:
                node["parent_conv_id"] = path[-1]["conv_id"]
                path[-1]["n_children"] += 1
                path[-1]["n_leaves"] += node["n_leaves"]
                path[-1]["saved_tokens"] += node["saved_tokens"]
            out.append({name: node[name] for name in schema.names})

    kinds = [(n, pa.string() if n == "ends_sha256" else pa.int64()) for n in (NODE + ", open_key long").replace(",", "").split()[::2]]
    schema = pa.schema(kinds)
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.frombuffer(row.pop("ends"), "<i8")
            if not path or path[-1]["open_key"] != row["open_key"]:
                close(row["depth"])
                row["hash"], row["any"] = hashlib.sha256(), False
                path.append(row)
            else:
                for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    path[-1][name] += row[name]
                path[-1]["conv_id"] = min(path[-1]["conv_id"], row["conv_id"])
            if len(ends):
                text = ",".join(map(str, ends.tolist()))
                path[-1]["hash"].update((("," if path[-1]["any"] else "") + text).encode())
                path[-1]["any"] = True
        if len(out) >= EMIT_ROWS:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
    close(0)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)
