"""The daily plan: notices to publications, their edition, and what is written. One lineage until the sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import detail_url
from tamiz.operators import classify, dedup, edition, summarize, taxonomy, validate

SCHEMA_VERSION = 7
PUBLICATION = (
    "id", "source", "url", "detail_url", "official_title", "title", "summary", "description", "detail_markdown", "card_body", "published_at",
    "authority", "document_type", "issuing_body", "government_branch", "jurisdiction", "country_or_org", "published_year", "published_month",
    "published_day", "categories", "topic_tags", "subtopic_tags", "importance", "relevance_score", "ai_generated", "case_parties", "case_status",
    "case_facts", "ordinal",
)


def publications(notices: DataFrame, minimum: int = 2, since: Column | None = None) -> DataFrame:
    """Notices of all sources (with ``ordinal``) as publications: deduplicated, classified, filtered, enriched and summarised."""
    df = notices.withColumn("id", F.concat(F.lower("source"), F.lit(":"), F.col("source_id"))).withColumn("case_facts", F.lit(""))
    if since is not None:
        df = df.filter(F.col("published_at") >= since)
    df = classify.classify(dedup.dedup_notices(df)).filter(classify.relevant(minimum))
    df = summarize.summarize(taxonomy.enrich(df))
    df = df.drop("categories").withColumnRenamed("primary_categories", "categories").withColumn("detail_url", detail_url(F.col("id")))
    return df.withColumn("detail_markdown", summarize.detail_markdown()).select(*PUBLICATION)


def ordered(items: DataFrame) -> DataFrame:
    return items.orderBy(*dedup.publication_order())


def source_status(notices: DataFrame, sources: DataFrame) -> DataFrame:
    """(ordinal, source, status, items_found, error, attempts): sources (ordinal, source, error, attempts) with their counts; none is lost."""
    counts = notices.groupBy("source").agg(F.count("*").alias("n"))
    met = sources.join(counts, "source", "left")
    return met.select("ordinal", "source", F.when(F.col("error").isNull(), "ok").otherwise("error").alias("status"), F.coalesce("n", F.lit(0)).alias("items_found"), "error", "attempts")


def document(items: DataFrame, statuses: DataFrame, day: Column, generated_at: Column, lookback: int = 31, digest: DataFrame | None = None) -> DataFrame:
    """One row: the published document. It is assembled only here, at the sink: a day's publications, which have a bound by nature."""
    place = F.struct(F.date_diff(F.lit("9999-12-31").cast("date"), F.col("published_at")).alias("a"), (-F.col("relevance_score")).alias("b"), F.col("ordinal").alias("c"))
    rows = items.agg(F.array_sort(F.collect_list(F.struct(place.alias("k"), F.struct(*PUBLICATION[:-1]).alias("v")))).alias("r")).select(F.transform("r", lambda x: x["v"]).alias("items"))
    sources = statuses.agg(F.array_sort(F.collect_list(F.struct("ordinal", "source", "status", "items_found", "error", "attempts"))).alias("sources"))
    made = edition.build_edition(items, statuses, day, digest)
    out = rows.withColumn("sources", sources.scalar()).withColumn("edition", made.select(F.struct("*")).scalar())
    return out.select(F.lit(SCHEMA_VERSION).alias("schema_version"), generated_at.alias("generated_at"), F.lit(lookback).alias("lookback_days"), F.size("items").alias("total_items"), "sources", "items", "edition")


def violations(items: DataFrame, statuses: DataFrame, made: DataFrame) -> DataFrame:
    """All contracts of a document at once."""
    return validate.items(items).unionByName(validate.sources(statuses)).unionByName(validate.edition(made, items, statuses))


def freshness(made: DataFrame, today: Column) -> DataFrame:
    """What a reader is shown: ``pending`` for an edition of another day, else its state; ``error`` for a broken envelope."""
    broken = F.col("edition_date").isNull() | ~F.coalesce(F.col("state").isin("ready", "empty"), F.lit(False)) | F.col("signals").isNull()
    return made.withColumn("shown", F.when(broken, "error").when(F.col("edition_date") != today, "pending").otherwise(F.col("state")))


def detail(items: DataFrame, made: DataFrame, identifier: str) -> DataFrame:
    """One publication with the edition's reason, if it is a signal, and the best of its pages."""
    return details(items.filter(F.col("id") == identifier), made)


def details(items: DataFrame, made: DataFrame) -> DataFrame:
    """Publications with their reasons in the editions, if they are signals (of several the first by text), and the best of their pages."""
    signals = made.select(F.explode("signals").alias("s")).groupBy(F.col("s.id").alias("id")).agg(F.min("s.why_it_matters").alias("why_it_matters"))
    one = items.join(signals, "id", "left")
    plain = F.concat_ws("\n\n", F.lit("## Qué se publicó"), F.coalesce(F.nullif("description", F.lit("")), F.nullif("official_title", F.lit("")), F.lit("Sin descripción disponible.")), F.lit("## Sustancia"), F.coalesce(F.nullif("summary", F.lit("")), F.lit("Sin síntesis disponible.")), F.lit("## Fuente oficial"), F.concat(F.lit("[Abrir documento oficial]("), F.col("url"), F.lit(")")))
    return one.withColumn("page", F.coalesce(F.nullif("detail_markdown", F.lit("")), F.nullif("card_body", F.lit("")), plain))


def sections(markdown: Column) -> Column:
    """The second-level sections of a page: an array of (heading, text)."""
    parts = F.slice(F.split(markdown, r"(?m)^## "), 2, 1 << 30)
    return F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, "\n", 1)).alias("heading"), F.regexp_replace(p, r"^[^\n]*\n?\s*|\s+\z", "").alias("text")))
