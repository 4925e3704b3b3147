"""Issuing bodies, origins, primary categories, tags and importance of classified notices."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import fold, words
from tamiz.operators.terms import any_substring, first_match, pad
from tamiz.plans import vocabulary as V


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(table.items())))[F.coalesce(key, F.lit(""))]


def organ(authority: Column, title: Column, catalog=V.ORGANS) -> Column:
    """The first body of the catalog named in the authority, else in the title: struct(c0 name, c1 branch, c2 short)."""
    rows, aliases = [r[:3] for r in catalog], [r[3] for r in catalog]
    return F.coalesce(first_match(pad(fold(authority)), rows, aliases), first_match(pad(fold(title)), rows, aliases))


def short_name(found: Column, authority: Column, source: Column) -> Column:
    """The short name of a body that ``organ`` found, else the authority's first word, else the source."""
    return F.coalesce(found["c2"], F.get(words(authority), 0), F.nullif(F.trim(source), F.lit("")), F.lit("la autoridad"))


def importance(score: Column) -> Column:
    return F.when(score >= 8, 5).when(score >= 6, 4).when(score >= 4, 3).when(score >= 2, 2).otherwise(1)


def primary_categories(categories: Column, branch: Column, authority: Column, source: Column) -> Column:
    """Fine categories as primary ones, in order and distinct; never empty."""
    central = F.lit("Administración centralizada")
    by_branch = F.when(any_substring(fold(branch), V.DECENTRALISED_MARKERS), F.lit("Administración descentralizada")).otherwise(central)

    def one(c: Column) -> Column:
        return (
            F.when(c.isin("Fiscal", "Contencioso administrativo fiscal"), F.lit("Fiscal"))
            .when(c.isin("Aduanero", "Comercio exterior"), F.lit("Comercio exterior"))
            .when(c.isin("Comercio internacional", "Penal", "Anti-lavado"), c)
            .when(c.isin("Derecho administrativo", "Nombramientos federales", "Contencioso administrativo"), central)
            .when(c.isin("Propiedad intelectual", "Normalización"), by_branch)
            .when(c == "Iniciativa", F.lit("Proceso legislativo"))
        )

    always = F.when(any_substring(fold(authority), V.ALWAYS_RELEVANT_AUTHORITIES), central)
    found = F.array_distinct(F.array_compact(F.concat(F.transform(categories, one), F.array(always, _lookup(V.DEFAULT_PRIMARY, source)))))
    return F.when(F.size(found) == 0, F.array(central)).otherwise(found)


def enrich(df: DataFrame) -> DataFrame:
    """Classified notices with issuing_body, organ_short, government_branch, jurisdiction, country_or_org, date parts, primary_categories,
    topic_tags, subtopic_tags and importance."""
    keep = df.columns
    authority, title, source = (F.coalesce(F.col(c), F.lit("")) for c in ("authority", "official_title", "source"))
    out = df.withColumn("__o", organ(authority, title))
    origin = {k: "|".join(v) for k, v in V.ORIGINS.items()}
    out = out.withColumn("__g", F.split(F.coalesce(_lookup(origin, source), F.lit("|".join(V.DEFAULT_ORIGIN))), r"\|"))
    named = F.trim(authority)
    jurisdiction = F.col("__g")[0]
    branch = F.when(F.col("__o").isNotNull(), F.col("__o.c1")).when(named == "", F.lit("Sin clasificar")).otherwise(F.when(jurisdiction == "internacional", F.lit("Organismo internacional")).otherwise(F.lit("Ejecutivo federal")))
    body = F.coalesce(F.col("__o.c0"), F.when(named == "", F.lit("Autoridad no identificada")).otherwise(named))
    short = short_name(F.col("__o"), authority, source)
    text = fold(F.concat_ws(" ", F.coalesce("document_type", F.lit("")), title))
    tags = F.array(*(F.when(F.contains(text, F.lit(needle)), F.lit(tag)) for needle, tag in V.DOCUMENT_TYPE_TAGS))
    day = F.col("published_at")
    out = out.withColumn("government_branch", branch)
    return out.select(
        *keep,
        body.alias("issuing_body"),
        short.alias("organ_short"),
        "government_branch",
        jurisdiction.alias("jurisdiction"),
        F.col("__g")[1].alias("country_or_org"),
        F.year(day).alias("published_year"),
        F.month(day).alias("published_month"),
        F.dayofmonth(day).alias("published_day"),
        primary_categories(F.col("categories"), F.col("government_branch"), authority, source).alias("primary_categories"),
        F.array_distinct(F.array_compact(F.concat("categories", tags))).alias("topic_tags"),
        F.slice(F.array_distinct(F.filter(F.transform("matched_terms", F.trim), lambda x: x != "")), 1, 6).alias("subtopic_tags"),
        importance(F.col("relevance_score")).cast("int").alias("importance"),
    )


def ink(categories: Column, jurisdiction: Column) -> Column:
    """The ink of a publication's card: that of the first word of the list in its subjects."""
    said = F.lower(F.concat_ws(" ", F.array_join(F.filter(F.coalesce(categories, F.array().cast("array<string>")), lambda c: c != ""), " "), F.nullif(jurisdiction, F.lit(""))))
    return F.coalesce(*(F.when(F.contains(said, F.lit(word)), color) for word, color in V.INKS), F.lit(V.PLAIN_INK))


def importance_bars(value: Column) -> Column:
    """How many of five bars an importance fills; none for what is no number."""
    return F.greatest(F.lit(0.0), F.least(F.lit(5.0), F.coalesce(value.try_cast("double"), F.lit(0.0))))
