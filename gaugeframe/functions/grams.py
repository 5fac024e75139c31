"""Grams of three characters, by which a term is looked up instead of searched in every text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeframe.functions.matching import METACHARACTERS

SIZE = 3
# Every three ASCII characters in a row, overlapping; a match of no length moves on by one.
_EVERY = rf"(?s)(?=([\x20-\x7e]{{{SIZE}}}))"
# Quantifiers under which what stands before them may be absent.
_OPTIONAL = "?*{"


def grams(folded: Column) -> Column:
    """The distinct ASCII grams of a folded text; linear in its length."""
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(_EVERY), F.lit(1)))


def grams_of(literal: str) -> list[str]:
    """The distinct grams of a folded literal."""
    return sorted({literal[i : i + SIZE] for i in range(len(literal) - SIZE + 1)})


def required_literals(term: str) -> list[str] | None:
    """Folded literals of which every text that the term matches has at least one.

    One per alternative of the pattern: the longest run of ASCII characters that cannot be left
    out.  None if an alternative has no run of three, or the pattern switches modes.
    """
    if "(?" in term or "\\Q" in term or "\\E" in term:
        return None
    found = [max(_runs(part), key=len, default="") for part in _alternatives(term)]
    return sorted({run.lower() for run in found}) if all(len(run) >= SIZE for run in found) else None


def _alternatives(term: str) -> list[str]:
    """The parts of a pattern between bars outside of all groups and classes."""
    parts, depth, start, inside, i = [], 0, 0, False, 0
    while i < len(term):
        c = term[i]
        if c == "\\":
            i += 1
        elif inside:
            inside = c != "]"
        elif c == "[":
            inside = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and depth == 0:
            parts.append(term[start:i])
            start = i + 1
        i += 1
    return [*parts, term[start:]]


def _runs(part: str) -> list[str]:
    """Runs of characters of an alternative that stand for themselves and have to be there."""
    runs, run, depth, inside, i = [], "", 0, False, 0
    while i < len(part):
        c, plain = part[i], False
        if c == "\\":
            i += 1
        elif inside:
            inside = c != "]"
        elif c == "[":
            inside = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        else:
            plain = depth == 0 and c.isascii() and c.isprintable() and not METACHARACTERS.match(c)
        following = part[i + 1 : i + 2]
        if plain and not (following and following in _OPTIONAL):
            run += c
        else:
            runs.append(run)
            run = ""
        i += 1
    return [*runs, run]


def split_terms(terms: Sequence[str]) -> tuple[dict[str, list[str]], list[str]]:
    """Terms with the literals to look them up by, and those that have none."""
    literals = {t: required_literals(t) for t in terms}
    return {t: found for t, found in literals.items() if found}, [t for t, found in literals.items() if not found]
