"""Case-insensitive term matching on indicator names."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters beyond ASCII that equal an ASCII letter when case is
# ignored (long s, Kelvin sign, dotless i, dotted capital I).
ASCII_TWINS = {"\u017f": "s", "\u212a": "k", "\u0131": "i", "\u0130": "i"}
# Plain terms up to this number are searched one by one, more of them together.
FEW = 12
METACHARACTERS = re.compile(r"[\\^$.|?*+(){}\[\]]")


def terms_pattern(terms: Sequence[str], literal: bool = False) -> str:
    """One regular expression that matches where any of the terms occurs.

    Terms are regular expressions themselves, so parentheses are groups:
    ``ring (small)`` matches ``ring small``.  With ``literal=True`` every
    character of a term stands for itself.
    """
    return "|".join(_quoted(t) if literal else t for t in _checked(terms))


def matches_any(name: Column, terms: Sequence[str], literal: bool = False) -> Column:
    """True where a term occurs in ``name``; a null name is False, not unknown."""
    test = _test(name, terms, literal)
    # The lambda folds the name once for all terms; a single term needs none.
    hit = test(folded(name)) if len(terms) == 1 else F.exists(F.array(folded(name)), test)
    return F.coalesce(hit, F.lit(False))


def matching_topics(name: Column, patterns: Mapping[str, Sequence[str]]) -> Column:
    """Array of the topics whose terms occur in ``name``; empty for a null name.

    The topics are literals of the plan: the catalogue is read in one map-only
    pass, without a join against the topics.  All plain terms are searched together, each
    once however many topics have it; a topic is found from the terms that were met.
    """
    split = {topic: _split(terms, False) for topic, terms in patterns.items()}
    every = {t for plain, _ in split.values() for t in plain}
    together = len(every) > FEW

    def found(topic: str, text: Column, met: Column | None) -> Column:
        plain, others = split[topic]
        if met is None:
            return _any_of(name, text, plain, others)
        # A longer term stands for the shorter ones that it contains.
        telling = sorted(t for t in every if any(u in t for u in plain))
        hits = [F.arrays_overlap(met, F.array(*map(F.lit, telling)))] if telling else []
        if others:
            hits.append(_any_of(name, text, [], others))
        return reduce(lambda a, b: a | b, hits)

    def topics(text: Column, met: Column | None) -> Column:
        return F.array_compact(F.array(*[F.when(found(topic, text, met), topic) for topic in patterns]))

    text = folded(name)
    if not together:
        return F.transform(F.array(text), lambda x: topics(x, None))[0]
    # The lambda gets the terms once for all topics; null for a null name.
    met = F.array(F.array_distinct(F.regexp_extract_all(text, F.lit(terms_together(every)), F.lit(1))))
    return F.when(name.isNull(), F.array().cast("array<string>")).otherwise(F.transform(met, lambda m: topics(text, m))[0])


def terms_together(terms: Iterable[str]) -> str:
    """One expression that finds at every place of a folded text the longest of the terms there.

    Terms are put together by their common beginnings, so a place is left at the first
    character that no term goes on with.  Matches have no length and may overlap.
    """

    def tree(rest: list[str]) -> str:
        branches: dict[str, list[str]] = {}
        for term in rest:
            if term:
                branches.setdefault(term[0], []).append(term[1:])
        parts = [re.escape(c) + tree(branches[c]) for c in sorted(branches)]
        if not parts:
            return ""
        joined = parts[0] if len(parts) == 1 and "" not in rest else "(?:" + "|".join(parts) + ")"
        return joined + ("?" if "" in rest else "")

    return f"(?s)(?=({tree(sorted(set(terms)))}))"


def _split(terms: Sequence[str], literal: bool) -> tuple[list[str], list[str]]:
    """Plain terms in lower case, without those that contain another, and the other terms."""
    plain = {t.lower() for t in _checked(terms) if t.isascii() and (literal or not METACHARACTERS.search(t))}
    others = [t for t in terms if t.lower() not in plain]
    # A term that contains another one finds nothing that the shorter does not.
    return sorted(t for t in plain if not any(u in t for u in plain if u != t)), others


def _any_of(name: Column, text: Column, plain: Sequence[str], others: Sequence[str], literal: bool = False) -> Column:
    """Test of the folded name: substring search for a few plain terms, one expression for many, a
    pattern for the others."""
    hits = [text.contains(t) for t in plain] if len(plain) <= FEW else [text.rlike(terms_together(plain))]
    if others:
        hits.append(name.rlike("(?iu)" + terms_pattern(others, literal)))
    return reduce(lambda a, b: a | b, hits)


def _test(name: Column, terms: Sequence[str], literal: bool) -> Callable[[Column], Column]:
    plain, others = _split(terms, literal)
    return lambda text: _any_of(name, text, plain, others, literal)


def folded(name: Column) -> Column:
    """The name in lower case, with the letters beyond ASCII that equal an ASCII letter replaced."""
    for letter, twin in ASCII_TWINS.items():
        name = F.replace(name, F.lit(letter), F.lit(twin))
    return F.lower(name)


def _checked(terms: Sequence[str]) -> Sequence[str]:
    if not terms or any(not t for t in terms):
        raise ValueError("a topic needs at least one term, and no term may be empty")
    return terms


def _quoted(term: str) -> str:
    return "\\Q" + term.replace("\\E", "\\E\\\\E\\Q") + "\\E"
