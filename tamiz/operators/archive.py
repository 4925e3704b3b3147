"""Faceted search over publications: a query as data, compiled to filters, an order and a page."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import fold

SEARCHED = ("title", "summary", "official_title", "issuing_body", "authority")


@dataclass(frozen=True)
class ArchiveQuery:
    """Empty fields are no condition. ``days`` counts back from the newest publication; an exact ``date`` wins over it."""

    text: str = ""
    category: str = ""
    organ: str = ""
    source: str = ""
    jurisdiction: str = ""
    days: int | None = None
    date: str = ""
    order: str = "date"
    page: int = 1
    size: int = 25


def search_text(df: DataFrame) -> Column:
    parts = [F.col(c) for c in SEARCHED if c in df.columns] + [F.array_join(c, " ") for c in ("categories", "topic_tags") if c in df.columns]
    return fold(F.concat_ws(" ", *parts))


def conditions(df: DataFrame, q: ArchiveQuery) -> list[Column]:
    out = []
    if q.text.strip():
        out.append(F.contains(search_text(df), fold(F.lit(q.text))))
    if q.category:
        out.append(F.array_contains("categories", q.category))
    out += [F.col(c) == v for c, v in (("issuing_body", q.organ), ("source", q.source), ("jurisdiction", q.jurisdiction)) if v]
    if q.date:
        out.append(F.col("published_at") == F.to_date(F.lit(q.date)))
    elif q.days is not None:
        anchor = df.agg(F.max("published_at")).scalar()
        back = F.datediff(anchor, F.col("published_at"))
        out.append((back >= 0) & (back < q.days))
    return out


def order_by(q: ArchiveQuery) -> list[Column]:
    keys = {"date": ("published_at", "importance"), "importance": ("importance", "published_at"), "relevance": ("relevance_score", "published_at")}[q.order]
    return [*(F.desc(k) for k in keys), F.asc("ordinal")]


def select(df: DataFrame, q: ArchiveQuery) -> DataFrame:
    """All matching publications, unordered."""
    found = conditions(df, q)
    return df.filter(reduce(lambda a, b: a & b, found)) if found else df


def page(df: DataFrame, q: ArchiveQuery) -> tuple[DataFrame, int, int]:
    """(rows of the page, the page, pages): the page is brought between 1 and the number of pages."""
    found = select(df, q)
    pages = max(1, -(-found.count() // q.size))
    at = min(max(1, q.page), pages)
    return found.orderBy(*order_by(q)).offset((at - 1) * q.size).limit(q.size), at, pages


def facet(df: DataFrame, column: str, collation: str = "es") -> DataFrame:
    """Distinct values in the language's order; of an array column, its elements."""
    kind = dict(df.dtypes)[column]
    values = df.select(F.explode(column).alias("value") if kind.startswith("array") else F.col(column).alias("value"))
    return values.filter("value is not null and value <> ''").distinct().orderBy(F.collate("value", collation), "value")


#: The parameters of an archive address, in the order in which they are written, and what each is without one.
STATE = {"query": ("q", ""), "days": ("dias", "all"), "category": ("materia", "Todas"), "organ": ("organo", "Todas"), "source": ("fuente", "Todas"), "jurisdiction": ("jurisdiccion", "Todas"), "sort": ("orden", "date"), "exact_date": ("fecha", "")}
PAGE = "pagina"


def _decoded(part: Column) -> Column:
    """Form decoding: plus signs are blanks, escapes are UTF-8 bytes, and a per cent sign that begins none stands for itself."""
    return F.try_url_decode(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25"))


def _number(text: Column) -> Column:
    """A script's number: decimal or hexadecimal, blanks around it; null for none."""
    x = F.regexp_replace(text, r"^\s+|\s+$", "")
    decimal = F.when(x.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"), x.try_cast("double"))
    return F.when(x.rlike("^0[xX][0-9A-Fa-f]+$"), F.conv(F.substr(x, F.lit(3)), 16, 10).cast("double")).otherwise(decimal)


def read_state(address: Column) -> Column:
    """The state that an archive address asks for, as a struct: of repeated parameters the first counts, an empty value is the
    default, and a page that is no number or below 1 is the first."""
    query = F.regexp_extract(F.coalesce(address, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.when(F.contains(p, F.lit("=")), F.substr(p, F.length(F.substring_index(p, "=", 1)) + 2)).otherwise(F.lit(""))).alias("v")))
    value = lambda name: F.coalesce(F.get(F.filter(pairs, lambda x: x["k"] == name), 0)["v"], F.lit(""))
    fields = [F.coalesce(F.nullif(value(name), F.lit("")), F.lit(default)).alias(field) for field, (name, default) in STATE.items()]
    page = _number(value(PAGE))
    return F.struct(*fields, F.greatest(F.lit(1.0), F.coalesce(F.nullif(page, F.lit(0.0)), F.lit(1.0))).alias("page"))


def write_state(state: Column) -> Column:
    """The canonical query string of a state, with a question mark before it, or nothing for the state without conditions."""
    page = F.when(state["page"] == F.floor(state["page"]), state["page"].cast("decimal(20,0)").cast("string")).otherwise(state["page"].cast("string"))
    parts = [F.when(state[field] != default, F.concat(F.lit(f"{name}="), F.url_encode(state[field]))) for field, (name, default) in STATE.items()]
    text = F.concat_ws("&", *parts, F.when(state["page"] > 1, F.concat(F.lit(f"{PAGE}="), F.url_encode(page))))
    return F.when(text != "", F.concat(F.lit("?"), text)).otherwise("")
