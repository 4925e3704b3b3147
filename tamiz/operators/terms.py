"""Dictionary matching: which terms of ordered lists occur in a folded text.

A term of letters, digits and blanks matches whole words; any other matches as a substring. Both are tests
of containment in one padded string per row, so no join and no regular expression per term is needed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.text import bound


def pad(text: Column) -> Column:
    """Folded text with every sign apart and a blank at both ends: whole words are then substrings."""
    return F.concat(F.lit(" "), F.regexp_replace(text, r"([^\p{L}\p{N}_\s])", " $1 "), F.lit(" "))


def _padded(term: str) -> str:
    out = "".join(c if c.isalnum() or c in "_ " else f" {c} " for c in term)
    return f" {out} "


def _whole(term: str) -> bool:
    return term.replace(" ", "").isalnum()


def matches(padded: Column, folded: Column, terms: Sequence[str]) -> Column:
    """The terms that occur, in the list's order. ``padded``: ``pad`` of ``folded``. Both are computed once, not for each term."""
    rows = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(_padded(t) if _whole(t) else t).alias("p"), F.lit(_whole(t)).alias("w")) for t in terms))

    def found(x: Column) -> Column:
        return F.transform(F.filter(rows, lambda r: F.when(r["w"], F.contains(x["padded"], r["p"])).otherwise(F.contains(x["folded"], r["p"]))), lambda r: r["t"])

    return bound(F.struct(padded.alias("padded"), folded.alias("folded")), found)


def any_substring(folded: Column, terms: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(folded, F.lit(t)) for t in terms))


def first_match(padded: Column, rows: Sequence[tuple[str, ...]], aliases: Sequence[Sequence[str]]) -> Column:
    """The first row (as a struct c0, c1, ...) of which an alias occurs as whole words; null if none does."""
    catalog = F.array(*(F.struct(F.array(*(F.lit(_padded(a)) for a in names)).alias("names"), *(F.lit(v).alias(f"c{i}") for i, v in enumerate(row))) for row, names in zip(rows, aliases, strict=True)))
    return bound(padded, lambda p: F.get(F.filter(catalog, lambda r: F.exists(r["names"], lambda a: F.contains(p, a))), 0))


def near(folded: Column, left: Sequence[str], right: Sequence[str], distance: int = 160) -> Column:
    """Whether a left and a right term stand within ``distance`` characters of each other in one sentence.

    Terms hold no sentence signs, so each sentence is tested alone: the right term within reach behind the left one,
    in front of it, or overlapping it."""
    def either(terms: Sequence[str]) -> str:
        return "|".join(rf"\b{t}\b" for t in sorted(terms, key=len, reverse=True))

    a, b = either(left), either(right)
    gap = rf"[^.!?;]{{0,{distance}}}"
    # Every start is tried by a look-ahead, so overlaps of alternatives hide no pair; terms that overlap end within the longest one's length.
    longest = max(map(len, (*left, *right)))
    return folded.rlike(rf"(?U)(?:{a})(?:{gap}?)(?:{b})") | folded.rlike(rf"(?U)(?:{b})(?:{gap}?)(?:{a})") | folded.rlike(rf"(?U)(?=(?:{a}))[^.!?;]{{0,{longest}}}?(?<=(?:{b}))") | folded.rlike(rf"(?U)(?=(?:{b}))[^.!?;]{{0,{longest}}}?(?<=(?:{a}))")
