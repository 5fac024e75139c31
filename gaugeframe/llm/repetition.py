"""Quality rules on repetition: characters inside duplicated n-grams and lines.

Every text is hashed once by a rolling hash; windows of several lengths are compared by
their hashes in numpy, and the characters of all words that a repeated window covers are
counted once.  Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeframe.llm.text import U64, Rolling, mix, ranges, slices, text_of, window_starts, windows

# Largest share, in hundredths of the characters in words, that windows of so many words
# may cover that the text has had before, and that lines may have that it has had before.
NGRAM_SHARES = {5: 15, 7: 13, 10: 10}
LINE_SHARE = 20
BASE_WINDOW = 3
MIN_WORDS = 50
SYMBOLS = b"[#*$%&|<>]"[1:-1]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def repetition(
    documents: DataFrame,
    ngram_shares: Mapping[int, int] = NGRAM_SHARES,
    line_share: int = LINE_SHARE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Word counts and repetition measures of every text, and a verdict.

    One row per input row, repeated rows included: counts of words, characters in words
    and symbols; lines equal to an earlier line and the characters in them; words in
    3-word windows found twice or more; of each other length characters of words in windows
    that the text has had before.  ``kept`` is false if the base rules fail or a share is exceeded.  Null and
    empty texts have no words and fail; a null id is passed on; other columns are ignored.
    """
    lengths = sorted(ngram_shares)
    source = documents.select(documents[id_column], documents[text_column])
    kind = source.schema[0].dataType.simpleString()
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words dup_line_chars".split()
    names += [f"dup_{n}gram_chars" for n in lengths]
    schema = f"`{id_column}` {kind}, " + ", ".join(f"{n} long" for n in names)
    schema += ", base_failed boolean, kept boolean"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_measure(s, lengths) for s in slices(batch.column(1))]
            if not parts:
                continue
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            count, chars = columns[0], columns[1]
            failed = (count < MIN_WORDS) | (100 * columns[4] > 50 * count)
            over = 100 * columns[5] > line_share * chars
            for n, covered in zip(lengths, columns[6:], strict=True):
                over |= 100 * covered > ngram_shares[n] * chars
            arrays = [batch.column(0), *map(pa.array, columns), pa.array(failed), pa.array(~failed & ~over)]
            yield pa.RecordBatch.from_arrays(arrays, [id_column, *names, "base_failed", "kept"])

    return source.mapInArrow(measure, schema)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True for each key that occurs twice or more."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[place] == keys


def _later(keys: np.ndarray) -> np.ndarray:
    """True for each key that an earlier one equals."""
    order = np.argsort(keys, kind="stable")
    later = np.zeros(len(keys), bool)
    later[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return later


def _measure(s, lengths: list[int]) -> list[np.ndarray]:
    starts, ends, first = ranges(s)
    rolling = Rolling(s.data)
    # Code points: every byte of UTF-8 but the continuation bytes.
    points = np.concatenate(([0], np.cumsum((s.data & 0xC0) != 0x80, dtype=np.int64)))
    word_points = points[ends] - points[starts]
    by_text = np.concatenate(([0], np.cumsum(word_points)))
    chars = by_text[first[1:]] - by_text[first[:-1]]
    words, owner = rolling.of(starts, ends), text_of(first)

    breaks = np.flatnonzero(s.data == 10)
    line_starts = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else breaks
    held = np.searchsorted(starts, breaks) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[held], breaks[held]
    line_owner = np.searchsorted(s.bounds, line_starts, "right") - 1
    keys = mix(rolling.of(line_starts, line_ends) + mix(line_owner.astype(U64)))
    later = _later(keys)
    dup_lines = np.bincount(line_owner[later], minlength=len(s))
    line_points = points[line_ends[later]] - points[line_starts[later]]
    # Weights are summed as doubles, exact far beyond the length of any text.
    dup_chars = np.bincount(line_owner[later], line_points, len(s)).astype(np.int64)

    def covered(n: int, first_too: bool = False) -> np.ndarray:
        """True for each word in a window of ``n`` words that its text has had before.

        ``first_too`` marks the first of the equal windows as well.
        """
        begins = np.flatnonzero(window_starts(first, n))
        if not len(begins):
            return np.zeros(len(words), bool)
        keys = mix(windows(words, n)[begins] + mix(owner[begins].astype(U64)))
        twice = np.flatnonzero(_repeated(keys))
        hit = begins[twice if first_too else twice[_later(keys[twice])]]
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, hit, 1)
        np.add.at(steps, hit + n, -1)
        return np.cumsum(steps[:-1]) > 0

    base = np.bincount(owner[covered(BASE_WINDOW, first_too=True)], minlength=len(s))
    result = [np.diff(first), chars, s.per_text(_SYMBOL[s.data]), dup_lines, base, dup_chars]
    for n in lengths:
        mask = covered(n)
        result.append(np.bincount(owner[mask], word_points[mask], len(s)).astype(np.int64))
    return [np.asarray(c, np.int64) for c in result]
