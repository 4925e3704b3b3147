"""Classification of notices against dictionaries, their score, and the relevance filter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import fold
from tamiz.operators.terms import any_substring, matches, near, pad
from tamiz.plans import vocabulary as V


@dataclass(frozen=True)
class Dictionary:
    """Categories with their terms, high-value terms, and sources with a bonus; the rest is optional."""

    categories: dict[str, tuple[str, ...]]
    high_value: tuple[str, ...]
    bonus_sources: tuple[str, ...]
    procedural: bool = True  # appointments, administrative law and contentious matters of V


DOMAIN = Dictionary(V.CATEGORY_TERMS, V.HIGH_VALUE, V.BONUS_SOURCES)


def _when(condition: Column, value: Column) -> Column:
    return F.when(condition, value).otherwise(F.array().cast("array<string>"))


def classify(df: DataFrame, dictionary: Dictionary = DOMAIN, markup: bool = False) -> DataFrame:
    """``df`` (source, official_title, description, document_type) with categories, matched_terms and relevance_score.

    The text excludes the authority. The score is the number of distinct matches, four at most, plus
    one for each high-value term and for a source with a bonus."""
    joined = F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in ("official_title", "description", "document_type")))
    keep = df.columns
    out = df.withColumn("__f", fold(joined, markup))
    out = out.withColumn("__p", pad(F.col("__f")))
    p, f = F.col("__p"), F.col("__f")
    hits = [matches(p, f, terms).alias(f"__c{i}") for i, terms in enumerate(dictionary.categories.values())]
    high = matches(p, f, dictionary.high_value).alias("__high")
    extra = []
    if dictionary.procedural:
        lists = {"adm": V.ADMINISTRATIVE_LAW, "act": V.APPOINTMENT_ACTIONS, "pos": V.FEDERAL_POSITIONS, "exp": V.EXPLICIT_APPOINTMENTS, "cex": V.CONTENTIOUS_EXPLICIT, "cpr": V.CONTENTIOUS_PROCESS, "crt": V.ADMINISTRATIVE_COURTS, "fis": V.FISCAL_CONTENTIOUS}
        extra = [matches(p, f, terms).alias(f"__{k}") for k, terms in lists.items()]
    out = out.select(*keep, "__f", *hits, high, *extra)
    size = lambda name: F.size(F.col(f"__{name}"))
    if dictionary.procedural:
        # The costly test of distance only where both kinds of terms occur at all.
        close = F.when((size("act") > 0) & (size("pos") > 0), near(f, V.APPOINTMENT_ACTIONS, V.FEDERAL_POSITIONS)).otherwise(F.lit(False))
        out = out.withColumn("__near", close)
    names = list(dictionary.categories)
    cats = [F.when(F.size(f"__c{i}") > 0, F.lit(n)) for i, n in enumerate(names)]
    found = [F.col(f"__c{i}") for i in range(len(names))]
    if dictionary.procedural:
        appointed = (size("exp") > 0) | F.col("__near")
        administrative = (size("adm") > 0) | appointed
        contentious = (size("cex") > 0) | ((size("cpr") > 0) & (size("crt") > 0))
        fiscal = F.size(f"__c{names.index('Fiscal')}") > 0 if "Fiscal" in names else F.lit(False)
        cats += [F.when(administrative, F.lit("Derecho administrativo")), F.when(appointed, F.lit("Nombramientos federales")), F.when(contentious, F.lit("Contencioso administrativo")), F.when((size("fis") > 0) | (contentious & fiscal), F.lit("Contencioso administrativo fiscal"))]
        found += [_when(administrative, F.concat("__adm", "__act", "__pos", "__exp")), _when(contentious, F.concat("__cex", "__cpr", "__crt")), F.col("__fis")]
    out = out.select(*keep, F.array_distinct(F.array_compact(F.array(*cats))).alias("categories"), F.array_distinct(F.concat(*found)).alias("matched_terms"), F.size("__high").alias("__high"))
    bonus = F.col("source").isin(*dictionary.bonus_sources).cast("int") if dictionary.bonus_sources else F.lit(0)
    score = (F.least(F.size("matched_terms"), F.lit(4)) + F.col("__high") + F.coalesce(bonus, F.lit(0))).cast("int")
    # Generated, so that a later filter is not pushed below the matching, where it would fold the text anew for every term.
    result = F.explode(F.array(F.struct("categories", "matched_terms", score.alias("relevance_score"))))
    return out.select(*keep, result.alias("__r")).select(*keep, "__r.*")


def relevant(minimum: int = 2, always: tuple[str, ...] = V.ALWAYS_RELEVANT_AUTHORITIES, weak: str = "Iniciativa") -> Column:
    """Whether a classified notice is kept: its authority always is, or it has a strong category and the score."""
    substantive = F.size(F.array_except("categories", F.array(F.lit(weak)))) > 0
    return any_substring(fold(F.coalesce(F.col("authority"), F.lit(""))), always) | (substantive & (F.col("relevance_score") >= minimum))
