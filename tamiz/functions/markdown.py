"""Markdown pages as columns: blocks, list items, table cells and inline parts, by expressions over arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.text import bound
from tamiz.plans import vocabulary as V

_SEPARATOR = r"^\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)*\|?\z"
_INLINE = r"\*\*[^*]+\*|\[[^\]]+\]\(https?://[^)]+\)"


def _trim(x: Column) -> Column:
    """Without the white space of SQL's patterns at its ends; other line ends, vertical tabs among them, are characters of the text."""
    return F.btrim(x, F.lit(" \t\n\f\r"))


def table_row(line: Column) -> Column:
    """The trimmed cells of a table's line; a bar at either end is no cell."""
    bare = F.regexp_replace(F.regexp_replace(_trim(line), r"^\|", ""), r"\|\z", "")
    return F.transform(F.split(bare, r"\|", -1), _trim)


def _block(block: Column) -> Column:
    lines = F.split(block, "\n", -1)
    heading = block.rlike(r"^#{1,3}\s+[^\n]+\z")
    items = F.transform(F.filter(lines, lambda x: F.startswith(x, F.lit("- "))), lambda x: F.array(_trim(F.substr(x, F.lit(3)))))
    table = (F.size(lines) >= 2) & F.startswith(_trim(lines[0]), F.lit("|")) & F.coalesce(F.get(lines, 1).rlike(_SEPARATOR), F.lit(False))
    rows = F.concat(F.array(table_row(lines[0])), F.transform(F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(0))), table_row))
    kind = F.when(heading, "heading").when(F.startswith(block, F.lit("- ")), "list").when(F.startswith(block, F.lit(">")), "quote").when(table, "table").otherwise("paragraph")

    def parts(kind: Column) -> Column:
        text = F.when(kind == "heading", _trim(F.regexp_extract(block, r"^#{1,3}\s+([^\n]+)\z", 1))).when(kind == "quote", F.regexp_replace(block, r"(?md)^>\s?", "")).when(kind == "paragraph", block)
        cells = F.when(kind == "table", rows).when(kind == "list", items).otherwise(F.array().cast("array<array<string>>"))
        level = F.when(kind == "heading", F.length(F.regexp_extract(block, "^(#{1,3})", 1))).otherwise(0)
        return F.struct(kind.alias("kind"), level.alias("level"), text.alias("text"), cells.alias("rows"))

    return bound(kind, parts)


def blocks(page: Column) -> Column:
    """The blocks of a page in order: heading, list, quote, table or paragraph, with its level, its text, and its rows of cells (a list has
    one cell a row, a table's first row is its head). Blank lines part blocks."""
    parts = F.transform(F.split(_trim(F.coalesce(page, F.lit(""))), r"\n{2,}"), _trim)
    return F.transform(F.filter(parts, lambda b: b != ""), _block)


def inline(text: Column) -> Column:
    """The parts of a line in order: (kind, text, href) of plain, strong and link parts; only absolute web addresses are links."""
    found = F.regexp_extract_all(text, F.lit(rf"(?s){_INLINE}|(?:(?!{_INLINE}).)+"), F.lit(0))

    def part(x: Column) -> Column:
        link = x.rlike(r"^\[[^\]]+\]\(https?://[^)]+\)$")
        strong = x.rlike(r"^\*\*[^*]+\*$")
        kind = F.when(strong, "strong").when(link, "link").otherwise("plain")
        said = F.when(strong, F.regexp_extract(x, r"^\*\*([^*]+)\*$", 1)).when(link, F.regexp_extract(x, r"^\[([^\]]+)\]", 1)).otherwise(x)
        return F.struct(kind.alias("kind"), said.alias("text"), F.when(link, F.regexp_extract(x, r"\]\((https?://[^)]+)\)$", 1)).alias("href"))

    return F.transform(found, part)


def display_date(iso: Column, short: bool = False, year: bool = True) -> Column:
    """An ISO date as it is shown to readers; a dash for what is none. Days beyond a month's end run on into the next."""

    def said(day: Column) -> Column:
        name = F.get(F.array(*map(F.lit, V.MONTHS)), F.month(day) - 1)
        month = F.substring(name, 1, 3) if short else name
        parts = [F.dayofmonth(day).cast("string"), month] + ([F.year(day).cast("string")] if year else [])
        return F.array_join(F.array(*parts), " " if short else " de ")

    number = lambda a, n: F.substring(iso, a, n).cast("int")
    first = F.make_date(number(1, 4), F.lit(1), F.lit(1))
    day = F.date_add(F.add_months(first, number(6, 2) - 1), number(9, 2) - 1)
    return F.when(F.coalesce(iso.rlike(r"^\d{4}-\d{2}-\d{2}"), F.lit(False)), bound(day, said)).otherwise("—")
