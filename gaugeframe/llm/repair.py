"""Cheapest repair of conversations: turns are kept, given another role, deleted, or put in.

The roles of a repaired conversation follow ``(s?(ua)+)?``, an automaton of four states, so the
cheapest edits are a Viterbi search over (turn, state).  It runs backward, in min-plus steps on
a vector of four costs, and in parallel over chunks of a conversation by rank convergence:
every chunk starts from a speculative vector; fix-up passes give a chunk the vector that its
right neighbour has found and run it again, until these vectors differ only by constants,
which no choice depends on.  The stitched costs then drive the tracing, which takes the least
letter among the cheapest edits, for each chunk from every state it may be entered in.

Only turns that may stay take part; turns that have to go are counts between them.  What the
search reads is light: digests and marks of the turns, not their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.llm.storing import stored
from gaugeframe.llm.turns import digest, turn_order

CHUNK = 4096

# The costs of the edits, and of a truncated turn that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# States: nothing yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# The state that a user's or assistant's turn leads to, and the states that a role's initial leads to.
NEXT = (USER, USER, ASSISTANT, USER)
BY_INITIAL = {"s": (SYSTEM, -1, -1, -1), "u": (USER, USER, -1, USER), "a": (-1, -1, ASSISTANT, -1)}
ROLES = {USER: "user", ASSISTANT: "assistant"}
END = (0, 2 * INSERT, INSERT, 0)  # cost of ending in each state
LETTERS = {"s": 1, "u": 2, "a": 3}
INITIALS = {code: initial for initial, code in LETTERS.items()}
CUT = 4  # added to the code of a truncated turn

_CHUNK = (
    "conv_id long, part int, seq long, codes binary, gone binary, first string, last string, n_blank long, "
    "n_duplicate long, n_truncated long, n_illegal long"
)
_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def marked(conversations: DataFrame) -> DataFrame:
    """Turns (``conv_id``, ``turn``, ``role``, ``text``, ``copies``) with what their faults are read from.

    ``copies`` says how often the turn stands there; 0 keeps the conversation without the turn.
    """
    return conversations.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "copies",
        digest(F.col("role"), F.col("text")).alias("digest"),
        F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    )


def repair(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the digest of the repaired text.

    Turns are ordered by number, null first, turns of one number by their digest; ``copies`` (0 or
    more) says how often a row counts, in a row.  A turn's first fault counts: ``blank``,
    ``duplicate`` (role and text as an earlier turn), ``truncated`` (its last character is
    none of .!?); ``illegal`` counts neighbours whose role initials are not su, ua or au.  Blank and
    duplicate turns have to go.  ``audit`` has the initials of the cheapest edits (Keep, Rerole,
    Delete, Insert), the least in ASCII order; ``repaired_sha256`` is that of the lines
    ``role:text``.  Rows without a conversation id are a conversation of their own.  Roles and texts are not
    null.  A conversation without turns has zeros and empty texts; no rows give none.

    Equal rows are counted before anything is sorted, a conversation of any length is cut into
    chunks, and its texts, shuffled once, pass through one task, as the digest asks for.
    """
    rows = marked(conversations)
    chunks = stored(_chunks(rows, chunk), "chunks")
    edits = stored(_edits(chunks), "edits")
    return _assembled(rows, edits)


# Faults and chunks


def _chunks(rows: DataFrame, chunk: int) -> DataFrame:
    keys = ["conv_id", "turn", "digest", "initial", "blank", "cut"]
    counted = rows.filter("copies > 0").groupBy(keys).agg(F.sum("copies").alias("copies"))
    counted = stored(counted, "counted")
    # Turns that several numbers repeat; the table holds only those.
    numbered = F.struct(F.col("turn").isNotNull(), "turn")
    repeated = counted.groupBy("conv_id", "digest").agg(F.min(numbered).alias("first"), F.count("*").alias("n"))
    repeated = stored(repeated.filter("n > 1").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first"), "repeated")
    same = counted["conv_id"].eqNullSafe(repeated["c"]) & (counted["digest"] == repeated["d"])
    seen = F.coalesce(numbered != F.col("first"), F.lit(False))
    faults = counted.join(repeated, same, "left").select(*keys, "copies", seen.alias("seen"))
    order = [F.col("conv_id").asc_nulls_first(), *turn_order()]
    placed = faults.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("conv_id", F.spark_partition_id().alias("part"), "initial", "blank", "cut", "seen", "copies")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(_cut_chunks(batches, chunk), _CHUNK)

    return placed.mapInArrow(cut, _CHUNK)


def _cut_chunks(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[dict]:
    """Chunks of sorted turns: codes of the turns that may stay, and how many go before each and at the end."""
    current, part, seq = None, 0, 0

    def opened(conv) -> dict:
        return {"conv_id": conv, "codes": bytearray(), "gone": [0], "first": None, "last": None, "faults": [0, 0, 0, 0]}

    def closed() -> dict:
        blank, duplicate, cut, illegal = current["faults"]
        return {
            **{k: current[k] for k in ("conv_id", "first", "last")},
            "part": part,
            "seq": seq,
            "codes": bytes(current["codes"]),
            "gone": np.array(current["gone"], "<i8").tobytes(),
            **{"n_blank": blank, "n_duplicate": duplicate, "n_truncated": cut, "n_illegal": illegal},
        }

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for conv, part, initial, blank, cut, seen, copies in zip(*columns):
            if current is None or conv != current["conv_id"] or len(current["codes"]) >= chunk:
                if current is not None:
                    yield closed()
                    seq += 1
                current = opened(conv)
            faults, last = current["faults"], current["last"]
            if last is not None:
                faults[3] += illegal(last, initial)
            faults[3] += (copies - 1) * illegal(initial, initial)
            current["first"] = initial if last is None else current["first"]
            current["last"] = initial
            if blank:
                faults[0] += copies
                current["gone"][-1] += copies
                continue
            faults[1] += copies - 1 + seen
            if seen:
                current["gone"][-1] += copies
                continue
            faults[2] += cut
            current["codes"].append(LETTERS.get(initial, 0) + CUT * cut)
            current["gone"].append(copies - 1)
    if current is not None:
        yield closed()


def illegal(before: str, after: str) -> bool:
    return before + after not in ("su", "ua", "au")


# The search


def _choices(code: int, ahead: np.ndarray | tuple) -> list[tuple[int, str, int]]:
    """Per state the cheapest edit at a turn: cost to go, its letter and the state it leads to.

    ``ahead`` are the costs to go after the turn.  Among equals the least letter; an inserted turn
    leads to the choice of the state that follows.
    """
    kept = TRUNCATED if code & CUT else 0
    targets = BY_INITIAL.get(INITIALS.get(code & 3), (-1,) * STATES)
    best = []
    for state in range(STATES):
        options = [(DELETE + ahead[state], "D", state)]
        if targets[state] >= 0:
            options.append((KEEP + kept + ahead[targets[state]], "K", targets[state]))
        options.append((REROLE + kept + ahead[NEXT[state]], "R", NEXT[state]))
        best.append(min(options))
    # At most two turns are put in at one place: more only repeat the states.
    for _ in range(2):
        for state in range(STATES):
            inserted = (INSERT + best[NEXT[state]][0], "I", NEXT[state])
            if (inserted[0], inserted[1]) < (best[state][0], best[state][1]):
                best[state] = inserted
    return best


def backward(codes: bytes, gone: np.ndarray, ahead: tuple) -> list[tuple]:
    """Costs to go before each turn of a chunk and after the last, deletions after it included."""
    ahead = tuple(c + DELETE * int(gone[-1]) for c in ahead)
    found = [ahead]
    for i in range(len(codes) - 1, -1, -1):
        ahead = tuple(c + DELETE * int(gone[i]) for c, _, _ in _choices(codes[i], ahead))
        found.append(ahead)
    return found[::-1]


def relative(costs: tuple) -> tuple:
    """A cost vector without its constant."""
    least = min(costs)
    return tuple(c - least for c in costs)


def fixed_up(codes: bytes, gone: np.ndarray, known: list[tuple], ahead: tuple) -> list[tuple]:
    """The costs of a chunk for another vector at its end, given those for an earlier one.

    The chunk is run again only from its end to the turn where both runs differ by a constant;
    before it the earlier costs are right but for that constant.
    """
    ahead = tuple(c + DELETE * int(gone[-1]) for c in ahead)
    found = [ahead]
    for i in range(len(codes) - 1, -1, -1):
        if relative(found[-1]) == relative(known[i + 1]):
            shift = found[-1][0] - known[i + 1][0]
            return [tuple(c + shift for c in k) for k in known[: i + 1]] + found[::-1]
        ahead = tuple(c + DELETE * int(gone[i]) for c, _, _ in _choices(codes[i], found[-1]))
        found.append(ahead)
    return found[::-1]


def trace(codes: bytes, gone: np.ndarray, costs: list[tuple], state: int, last: bool) -> tuple[str, int]:
    """The least letters of the cheapest edits from a state, and the state they end in.

    ``last`` says that the conversation ends with the chunk, so turns may be put in at its end.
    """
    letters = []
    for i, code in enumerate(codes):
        letters.append("D" * int(gone[i]))
        best = _choices(code, costs[i + 1])
        while True:
            _, letter, state = best[state]
            letters.append(letter)
            if letter != "I":
                break
    letters.append("D" * int(gone[-1]))
    while last and END[state]:
        letters.append("I")
        state = NEXT[state]
    return "".join(letters), state


def _edits(chunks: DataFrame) -> DataFrame:
    """Per chunk the letters of its edits (``audit``) and its cost, beside its faults."""
    place = Window.partitionBy("conv_id").orderBy("part", "seq")
    # A conversation of n turns has n / CHUNK rows here.
    numbered = chunks.withColumn("place", F.row_number().over(place).cast("long"))
    numbered = numbered.withColumn("last_place", F.count("*").over(Window.partitionBy("conv_id")))
    numbered = stored(numbered.select(*chunks.columns, "place", "last_place"), "numbered")
    known = _converged(numbered)
    faults = [c for c in chunks.columns if c.startswith("n_")] + ["first", "last"]
    schema = "conv_id long, place long, cost long, audit binary, " + ", ".join(
        f"{c} {chunks.schema[c].dataType.simpleString()}" for c in faults
    )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(_followed(batches, faults), schema)

    single = known.filter("last_place = 1")
    # Chunks of a long conversation: traced from every state, the right one follows from the one before.
    several = known.filter("last_place > 1")
    traced = stored(several.mapInArrow(_traced, _TRACED), "traced")
    entered = traced.select("conv_id", "place", "exits").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    entered = stored(entered.mapInArrow(_entered, "c long, p long, state int"), "entered")
    here = traced["conv_id"].eqNullSafe(entered["c"]) & (traced["place"] == entered["p"])
    chosen = F.element_at("audits", F.col("state") + 1).alias("audit")
    cost = F.element_at("costs", F.col("state") + 1).alias("cost")
    long = several.select("conv_id", "place", *faults).join(
        traced.join(entered, here).select(F.col("conv_id").alias("c"), F.col("place").alias("p"), chosen, cost),
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("place") == F.col("p")),
    )
    short = single.mapInArrow(follow, schema)
    names = schema.replace(",", "").split()[::2]
    return short.select(names).union(long.select(names))


def _followed(batches: Iterator[pa.RecordBatch], faults: list[str]) -> Iterator[dict]:
    for batch in batches:
        for row in batch.to_pylist():
            gone = np.frombuffer(row["gone"], "<i8")
            costs = backward(row["codes"], gone, END)
            audit, _ = trace(row["codes"], gone, costs, START, True)
            cost = costs[0][START]
            yield {"conv_id": row["conv_id"], "place": row["place"], "cost": cost, "audit": audit.encode(), **{f: row[f] for f in faults}}


_STATE = "conv_id long, place long, last_place long, codes binary, gone binary, ahead array<long>, left array<long>"
_TRACED = "conv_id long, place long, exits array<int>, audits array<binary>, costs array<long>"


def _converged(numbered: DataFrame) -> DataFrame:
    """Chunks with the cost vector ``ahead`` of them, right but for a constant.

    The last chunk of a conversation knows it; the others first speculate on the same.  A pass runs
    those chunks again whose right neighbour has found another vector.  Most vectors are the same
    after a few turns whatever they began with, so there are few passes; there are at most as many
    as a conversation has chunks.
    """
    end = F.array(*[F.lit(c).cast("long") for c in END])
    several = numbered.filter("last_place > 1")
    if several.isEmpty():
        return numbered.withColumn("ahead", end)
    state = several.select("conv_id", "place", "last_place", "codes", "gone", end.alias("ahead"), F.lit(None).cast("array<long>").alias("left"))
    state = stored(state.mapInArrow(_run, _STATE), "speculated")
    while True:
        found = state.filter("place > 1").select(F.col("conv_id").alias("c"), (F.col("place") - 1).alias("p"), F.col("left").alias("found"))
        here = state["conv_id"].eqNullSafe(F.col("c")) & (state["place"] == F.col("p"))
        stale = state.join(found, here).filter(F.col("found") != F.col("ahead"))
        stale = stored(stale.select("conv_id", "place", "last_place", "codes", "gone", F.col("found").alias("ahead"), F.col("ahead").alias("before")), "stale")
        if stale.isEmpty():
            break
        again = stale.mapInArrow(_rerun, _STATE)
        keys = stale.select(F.col("conv_id").alias("c"), F.col("place").alias("p"))
        rest = state.join(keys, state["conv_id"].eqNullSafe(F.col("c")) & (state["place"] == F.col("p")), "left_anti")
        state = stored(rest.unionByName(again), "fixed")
    vectors = state.select(F.col("conv_id").alias("c"), F.col("place").alias("p"), "ahead")
    here = numbered["conv_id"].eqNullSafe(F.col("c")) & (numbered["place"] == F.col("p"))
    several = numbered.filter("last_place > 1").join(vectors, here).select(*numbered.columns, "ahead")
    return numbered.filter("last_place = 1").withColumn("ahead", end).unionByName(several)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for row in _rows(batches):
            row["left"] = list(relative(backward(row["codes"], np.frombuffer(row["gone"], "<i8"), tuple(row["ahead"]))[0]))
            yield row

    yield from _batched(rows(), _STATE)


def _rerun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for row in _rows(batches):
            gone = np.frombuffer(row["gone"], "<i8")
            known = backward(row["codes"], gone, tuple(row.pop("before")))
            row["left"] = list(relative(fixed_up(row["codes"], gone, known, tuple(row["ahead"]))[0]))
            yield row

    yield from _batched(rows(), _STATE)


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for row in _rows(batches):
            gone = np.frombuffer(row["gone"], "<i8")
            costs = backward(row["codes"], gone, tuple(row["ahead"]))
            last = row["place"] == row["last_place"]
            found = [trace(row["codes"], gone, costs, state, last) for state in range(STATES)]
            # What the edits cost within the chunk: the cost to go, less that from where they end.
            spent = [costs[0][s] - (0 if last else row["ahead"][exit]) for s, (_, exit) in enumerate(found)]
            audits = [audit.encode() for audit, _ in found]
            yield {"conv_id": row["conv_id"], "place": row["place"], "exits": [e for _, e in found], "audits": audits, "costs": spent}

    yield from _batched(rows(), _TRACED)


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each chunk is entered; chunks come in order, a conversation's next to each other."""

    def rows():
        conv, state, begun = None, START, False
        for row in _rows(batches):
            if not begun or row["conv_id"] != conv:
                conv, state, begun = row["conv_id"], START, True
            yield {"c": conv, "p": row["place"], "state": state}
            state = row["exits"][state]

    yield from _batched(rows(), "c long, p long, state int")


# Results


def _assembled(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits and texts of each conversation meet in order; only its letters are held.

    Texts that are sure to go are left behind.
    """
    told = [c for c in edits.columns if c != "conv_id"]
    texts = rows.select(
        "conv_id",
        F.lit(1).alias("kind"),
        "turn",
        "digest",
        "copies",
        "role",
        F.when((F.col("copies") > 0) & ~F.col("blank"), F.col("text")).alias("text"),
    )
    both = edits.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    order = ["conv_id", "kind", "place", F.col("turn").asc_nulls_first(), "digest"]
    sent = both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", *told, "turn", "digest", "copies", "role", "text")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(_results(batches), _RESULT)

    return sent.mapInArrow(assemble, _RESULT)


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    current = None
    for row in _rows(batches):
        if current is None or row["conv_id"] != current.conv_id:
            if current is not None:
                yield current.result()
            current = _Repaired(row["conv_id"])
        current.edits(row) if row["kind"] == 0 else current.turn(row)
    if current is not None:
        yield current.result()


class _Repaired:
    """One conversation, put together from its letters and then its texts."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.cost, self.letters, self.last, self.at, self.state = 0, [], None, 0, START
        self.audit: str | None = None
        self.hash, self.lines = hashlib.sha256(), 0
        self.least = self.most = self.number = None
        self.numbers = 0

    def edits(self, row: dict) -> None:
        for name in self.faults:
            self.faults[name] += row[f"n_{name}"]
        if self.last is not None:
            self.faults["illegal"] += illegal(self.last, row["first"])
        self.last = row["last"]
        self.cost += row["cost"]
        self.letters.append(row["audit"].decode())

    def turn(self, row: dict) -> None:
        if not row["copies"]:
            return
        number = row["turn"]
        if number is not None:
            self.least = number if self.least is None else self.least
            self.numbers += self.number != number
            self.most = self.number = number
        self._insert()
        letter = self.audit[self.at]
        # Repeated rows follow the first, and go.
        self.at += row["copies"]
        if letter == "D":
            return
        role = row["role"]
        if letter == "R":
            self.state = NEXT[self.state]
            role = ROLES[self.state]
        else:
            self.state = BY_INITIAL[role[0]][self.state]
        self._line(role, row["text"])

    def _insert(self) -> None:
        """Turns that are put in here."""
        if self.audit is None:
            self.audit = "".join(self.letters)
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            self._line(ROLES[self.state], "")

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1

    def result(self) -> dict:
        self._insert()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.numbers
        found = {"conv_id": self.conv_id, "gaps": gaps, **self.faults, "cost": self.cost}
        return {**found, "audit": self.audit, "repaired_sha256": self.hash.hexdigest()}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


_ARROW = {
    "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary()),
}


def _batched(rows: Iterator[dict], schema: str, size: int = 4096) -> Iterator[pa.RecordBatch]:
    fields = [f.split(" ") for f in schema.split(", ")]
    arrow = pa.schema([(name, _ARROW[kind]) for name, kind in fields])
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=arrow)

