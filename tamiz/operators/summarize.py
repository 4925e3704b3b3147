"""Extractive titles, summaries, cards and detail pages, as expressions over a classified notice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import base_act_type, bounded_summary, clean, concise_title, section, strip_end, title_base
from tamiz.plans import vocabulary as V


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _joined(parts: list[Column], by: str = "\n\n") -> Column:
    return F.array_join(F.array_compact(F.array(*parts)), by)


def card_body(what: Column, substance: Column, url: Column) -> Column:
    heads = [F.lit(x) for x in V.CARD_SECTIONS]
    return _joined([heads[0], clean(what, False), heads[1], clean(substance, False), heads[2], F.concat(F.lit("[Abrir publicación oficial]("), url, F.lit(")"))])


def summarize(df: DataFrame) -> DataFrame:
    """``df`` (enriched) with title, summary, card_body and ai_generated (false)."""
    base = strip_end(F.coalesce(F.nullif(_text("description"), F.lit("")), _text("official_title")), " .;:")
    lead = F.when(base == "", F.lit("")).otherwise(F.concat(base, F.lit(". ")))
    authority = F.coalesce(F.nullif(F.trim(_text("authority")), F.lit("")), F.lit(V.NO_AUTHORITY))
    topics = F.when(F.size("categories") > 0, F.array_join("categories", ", ")).otherwise(F.lit(V.NO_TOPICS))
    summary = F.concat(lead, F.lit("Publicación oficial de "), authority, F.lit(", relacionada con "), topics, F.lit(f". {V.SUMMARY_NOTE}"))
    what = F.concat(base_act_type(F.col("document_type")), F.lit(" de "), F.col("organ_short"), F.lit("."))
    substance = F.concat(lead, F.lit("Materias: "), topics, F.lit(f". {V.SUBSTANCE_NOTE}"))
    return df.select(
        "*",
        concise_title(title_base(_text("official_title"), _text("description"))).alias("title"),
        bounded_summary(summary).alias("summary"),
        card_body(what, substance, _text("url")).alias("card_body"),
        F.lit(False).alias("ai_generated"),
    )


def detail_markdown() -> Column:
    """The detail page of a publication (organ_short, issuing_body, ... as ``enrich`` and ``summarize`` name them)."""
    first, second, last = V.DETAIL_SECTIONS
    kind = F.coalesce(F.nullif(clean(_text("document_type"), False), F.lit("")), F.lit(V.NO_TYPE))
    what = F.coalesce(F.nullif(section(F.col("card_body"), first), F.lit("")), F.concat(kind, F.lit(" de "), F.col("organ_short"), F.lit(".")))
    substance = F.coalesce(F.nullif(section(F.col("card_body"), second), F.lit("")), F.nullif(clean(_text("summary"), False), F.lit("")), F.lit(V.NO_SUBSTANCE))
    topics = F.when(F.size("categories") > 0, F.array_join("categories", ", ")).otherwise(F.lit(V.NO_CATEGORY))
    body = F.coalesce(F.nullif(clean(_text("issuing_body"), False), F.lit("")), F.lit(V.NO_BODY))
    status = clean(_text("case_status"), False)
    labels = F.create_map(*(F.lit(x) for pair in V.STATUS_LABELS.items() for x in pair))
    facts, parties = F.trim(_text("case_facts")), clean(_text("case_parties"), False)
    block = F.concat(F.coalesce(labels[F.lower(status)], status), F.when(parties == "", F.lit("")).otherwise(F.concat(F.lit("\n\n**Partes:** "), parties)))
    return _joined([
        F.concat(F.lit("# "), clean(_text("title"), False)),
        F.concat(F.lit("**Fecha:** "), F.col("published_at").cast("string"), F.lit(" · **Fuente:** "), clean(_text("source"), False), F.lit(" · **Órgano:** "), body),
        F.lit(first), clean(what, False), F.lit(second), clean(substance, False),
        F.when(facts != "", F.lit("## Hechos del asunto")), F.when(facts != "", facts),
        F.when(status != "", F.lit("## Estado procesal")), F.when(status != "", block),
        F.lit("## Clasificación"), F.concat(F.lit("**Materias:** "), topics, F.lit(".")),
        F.lit(last), F.concat(F.lit("*"), clean(_text("official_title"), False), F.lit("*\n\n[Abrir documento oficial]("), _text("url"), F.lit(")")),
    ])
