"""Secret scans: fixed patterns, and sliding-window entropy per character class.

The entropy of a window is kept by incremental counts: moving by one character changes
two counts, and the sum of ``c * log2(c)`` by table look-up.  Candidates that an
allow-list explains (addresses, identifiers, placeholders, alphabets) are suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

# The base patterns, in the order in which ties are listed.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")
MIN_VALUE = 6

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Character class: its members, the window, and the least entropy of a window in bits.
# A window of random characters has about 3.5 bits for hex and 4.1 for base64.
CLASSES = {
    "hex": (frozenset("0123456789abcdefABCDEF"), 20, 3.0),
    "base64": (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"), 20, 3.7),
}
# What explains a part of a candidate although it is not a secret; the rest is looked at.
ALLOWED = (
    re.compile(r"(?<![0-9a-zA-Z])[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-zA-Z])"),
    # A placeholder, with the part that is joined to it.
    re.compile(
        r"(?<![0-9a-zA-Z])(example|sample|placeholder|changeme|dummy)([-_/+=][0-9a-zA-Z]*)?(?![0-9a-zA-Z])",
        re.IGNORECASE | re.ASCII,
    ),
    re.compile(r"x{4,}|0123456789|abcdefgh", re.IGNORECASE | re.ASCII),
    re.compile(r"(?<![0-9a-zA-Z])sha(1|256|384|512)-[A-Za-z0-9+/]+=*"),
)
# Host and path of an address; user information, with or without a password, and queries are not a part of
# it.  Either ends at the next address, so that a row of addresses is read once.
ADDRESS = re.compile(
    r"://(?:[^\x20\x09-\x0D\"'<>@/:]*+(?::(?:[^\x20\x09-\x0D\"'<>@:]|:(?!//))*+)?@)?"
    r"((?:[^\x20\x09-\x0D\"'<>,;?#&:]|:(?!//))*+)"
)
# The path of such an address is itself the secret.
HOOK = re.compile("hook|/bot[0-9]", re.IGNORECASE | re.ASCII)


def scan_secrets(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All secret spans of every text.

    One row per input row, repeated rows included: the id, numbers of spans per base kind,
    and ``found``, an array of (kind, start, end) in code points, end exclusive, by start
    and then kind.  Null and empty texts have none; a null id is passed on; other columns
    are ignored.
    """
    source = documents.select(documents[id_column], documents[text_column])
    kind = source.schema[0].dataType.simpleString()
    schema = f"`{id_column}` {kind}, found array<struct<kind:string,start:int,end:int>>"
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(text.as_py() or "")]
                for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, span)], [id_column, "found"])

    return source.mapInArrow(scan, schema)


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of all secrets, ordered."""
    base = []
    if "=" in text or ":" in text:
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    known = _joined([[a, b] for a, _, b in base])
    more = [(a, 3, b) for a, b in _entropic(text) if not _inside(a, b, known)]
    return sorted(base + more)


def _inside(a: int, b: int, known: list[list[int]]) -> bool:
    """Whether one of the disjoint ordered ranges holds all of ``a`` to ``b``."""
    place = bisect_right(known, a, key=lambda x: x[0]) - 1
    return place >= 0 and b <= known[place][1]


def _entropic(text: str) -> Iterator[tuple[int, int]]:
    addresses = [m.span(1) for m in ADDRESS.finditer(text) if not HOOK.search(m[1])]
    for m in CANDIDATE.finditer(text):
        if not _mixed(m[0]):
            continue
        for first, last in _unexplained(m, addresses):
            token = text[first:last]
            reach: list[list[int]] = []
            for members, width, least in CLASSES.values():
                for a, b in _class_runs(token, members, width):
                    reach += _surprising(token, a, b, width, least)
            for a, b in _joined(reach):
                if _mixed(token[a:b]):
                    yield first + a, first + b


def _unexplained(m: re.Match[str], addresses: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of a candidate that neither an address nor the allow-list explains."""
    start, end = m.span()
    taken = [[start + x.start(), start + x.end()] for p in ALLOWED for x in p.finditer(m[0])]
    place = max(bisect_right(addresses, (start, end)) - 1, 0)
    while place < len(addresses) and addresses[place][0] < end:
        if addresses[place][1] > start:
            taken.append(list(addresses[place]))
        place += 1
    at = start
    for a, b in [*_joined(taken), [end, end]]:
        if a > at:
            yield at, min(a, end)
        at = max(at, b)


def _mixed(token: str) -> bool:
    """A secret has a digit and a letter; prose and plain numbers do not have both."""
    return any("0" <= c <= "9" for c in token) and any(c.isalpha() for c in token)


def _class_runs(token: str, members: frozenset[str], width: int) -> Iterator[tuple[int, int]]:
    start = None
    for i, c in enumerate(token):
        if c in members:
            start = i if start is None else start
        elif start is not None:
            if i - start >= width:
                yield start, i
            start = None
    if start is not None and len(token) - start >= width:
        yield start, len(token)


def _surprising(token: str, a: int, b: int, width: int, least: float) -> list[list[int]]:
    """Ranges covered by windows with at least ``least`` bits of entropy.

    Weights ``c * log2(c)`` are whole millionths, so the running sum has no rounding drift.
    """
    weight = [0] + [round(c * log2(c) * 1e6) for c in range(1, width + 2)]
    most = round((log2(width) - least) * width * 1e6)
    counts: dict[str, int] = {}
    total = 0
    found: list[list[int]] = []
    for i in range(a, b):
        c = counts.get(token[i], 0)
        counts[token[i]] = c + 1
        total += weight[c + 1] - weight[c]
        if i - a >= width:
            old = token[i - width]
            c = counts[old]
            counts[old] = c - 1
            total += weight[c - 1] - weight[c]
        if i - a >= width - 1 and total <= most:
            begin = i - width + 1
            if found and begin <= found[-1][1]:
                found[-1][1] = i + 1
            else:
                found.append([begin, i + 1])
    return found


def _joined(reach: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for a, b in sorted(reach):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged
