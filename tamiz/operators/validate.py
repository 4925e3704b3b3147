"""Declarative validation: every contract is a table of violations (path, code, severity)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import section, words
from tamiz.plans import vocabulary as V


def _empty(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def _count(text: Column) -> Column:
    return F.size(words(text))


def check(df: DataFrame, path: Column, errors: dict[str, Column], warnings: dict[str, Column] | None = None) -> DataFrame:
    """Rules as columns: one row for each rule that holds (a null rule does not)."""
    rules = [(c, r, "error") for c, r in errors.items()] + [(c, r, "warning") for c, r in (warnings or {}).items()]
    found = F.array_compact(F.array(*(F.when(r, F.struct(F.lit(c).alias("code"), F.lit(s).alias("severity"))) for c, r, s in rules)))
    return df.select(path.alias("path"), F.explode(found).alias("v")).select("path", "v.code", "v.severity")


def items(df: DataFrame) -> DataFrame:
    """Publications: required texts, lengths, sections, domains, dates, addresses and unique ids."""
    required = ("id", "source", "url", "detail_url", "official_title", "title", "summary", "detail_markdown", "card_body", "issuing_body", "jurisdiction")
    n = _count(F.col("summary"))
    lacks = lambda name, heads: reduce(lambda a, b: a | b, (~F.contains(F.coalesce(F.col(name), F.lit("")), F.lit(h)) for h in heads))
    errors = {f"{c}_missing": _empty(c) for c in required} | {
        "summary_words": (n < 40) | (n > 80),
        "card_sections": lacks("card_body", V.CARD_SECTIONS),
        "act_number": section(F.col("card_body"), V.CARD_SECTIONS[0]).rlike(V.ACT_NUMBER),
        "jurisdiction_domain": ~F.col("jurisdiction").isin("nacional", "internacional"),
        "importance_range": ~F.coalesce(F.col("importance").between(1, 5), F.lit(False)),
        "categories_empty": F.coalesce(F.size("categories"), F.lit(0)) < 1,
        "date_missing": F.col("published_at").isNull(),
        "url_absolute": ~F.coalesce(F.col("url"), F.lit("")).rlike("(?i)^https?://"),
        "detail_url_form": ~F.coalesce(F.col("detail_url"), F.lit("")).startswith("ficha.html?id="),
        "detail_heading": ~F.coalesce(F.col("detail_markdown"), F.lit("")).startswith("# "),
    }
    warnings = {"detail_sections": lacks("detail_markdown", V.DETAIL_SECTIONS), "office_title": F.col("title").rlike(V.OFFICE_TITLE)}
    repeated = df.groupBy("id").count().filter("count > 1").select(F.col("id").alias("path"), F.lit("id_repeated").alias("code"), F.lit("error").alias("severity"))
    return check(df, F.col("id"), errors, warnings).unionByName(repeated)


def sources(df: DataFrame) -> DataFrame:
    """Source statuses (source, status, items_found, attempts, error). All in error is an error, some are warnings."""
    errors = {
        "source_missing": _empty("source"),
        "status_domain": ~F.coalesce(F.col("status").isin("ok", "error"), F.lit(False)),
        "items_negative": F.coalesce(F.col("items_found"), F.lit(-1)) < 0,
        "attempts_positive": F.coalesce(F.col("attempts"), F.lit(0)) < 1,
        "error_without_text": (F.col("status") == "error") & _empty("error"),
    }
    one = check(df, F.col("source"), errors, {"source_failed": F.col("status") == "error"})
    whole = df.agg(F.count("*").alias("n"), F.count_if(F.col("status") == "error").alias("e")).filter("n > 0 and n = e")
    return one.unionByName(whole.select(F.lit("sources").alias("path"), F.lit("all_sources_failed").alias("code"), F.lit("error").alias("severity")))


def editions(claimed: DataFrame, publications: DataFrame, statuses: DataFrame, by: str = "cut") -> DataFrame:
    """Editions, one row each, against what they should say: counts, dates, coverage, and their signals.

    ``by`` names the column that ties an edition to the publications (id, published_at) and source statuses of its cut. What should
    be said is computed for all cuts at once and met by a full join, so that publications without an edition are found too.
    Returns (``by``, path, code, severity)."""
    from tamiz.operators.edition import coverage

    cuts = claimed.groupBy(by).agg(F.max("edition_date").alias("__day"), F.count("*").alias("__editions"))
    real = publications.join(cuts, by, "left").groupBy(by).agg(F.count_if(F.col("published_at") == F.col("__day")).alias("__n"), F.max("published_at").alias("__last"))
    seen = coverage(statuses, by).select(by, F.col("ok").alias("__ok"), F.col("failed").alias("__failed"), F.col("state").alias("__state"))
    head = claimed.withColumn("__claimed", F.lit(True)).join(real, by, "full").join(cuts.select(by, "__editions"), by, "left")
    head = head.join(seen, by, "left").withColumns({"__ok": F.coalesce("__ok", F.lit(0)), "__failed": F.coalesce("__failed", F.array().cast("array<string>")), "__state": F.coalesce("__state", F.lit("complete"))})
    ranks, size, n = F.transform("signals", lambda s: s["rank"].cast("int")), F.coalesce(F.size("signals"), F.lit(0)), F.coalesce("__n", F.lit(0))
    first = F.get(F.filter("signals", lambda s: s["rank"] == 1), 0)["id"]
    ready, empty = F.col("state") == "ready", F.col("state") == "empty"
    there = lambda rule: F.col("__claimed") & F.coalesce(rule, F.lit(False))
    rules = {
        "edition_missing": F.col("__claimed").isNull(),
        "edition_repeated": there(F.col("__editions") > 1),
        "date_missing": there(F.col("edition_date").isNull()),
        "state_domain": there(~F.coalesce(F.col("state").isin("ready", "empty"), F.lit(False))),
        "signals_missing": there(F.col("signals").isNull()),
        "total_wrong": there(~F.col("total_today").eqNullSafe(n)),
        "last_date_wrong": there(~F.col("last_available_date").eqNullSafe(F.col("__last"))),
        "coverage_ok_wrong": there(~F.col("coverage.ok").eqNullSafe(F.col("__ok"))),
        "coverage_failed_wrong": there(~F.array_sort("coverage.failed").eqNullSafe(F.array_sort("__failed"))),
        "coverage_state_wrong": there(~F.col("coverage.state").eqNullSafe(F.col("__state"))),
        "too_many_signals": there(size > 7),
        "signal_repeated": there(F.size(F.array_distinct(F.transform("signals", lambda s: s["id"]))) < size),
        "ranks_not_contiguous": there((size > 0) & (F.sort_array(ranks) != F.sequence(F.lit(1), F.greatest(size, F.lit(1))))),
        "ready_without_items": there(ready & (n == 0)),
        "ready_without_signals": there(ready & (size == 0)),
        "lead_wrong": there(ready & (F.col("lead_id").isNull() | ~F.col("lead_id").eqNullSafe(first))),
        "empty_with_items": there(empty & (n > 0)),
        "empty_with_signals": there(empty & (size > 0)),
        "empty_with_lead": there(empty & F.col("lead_id").isNotNull()),
    }
    heads = check(head, F.col(by), rules).select(F.col("path").alias(by), F.lit("edition").alias("path"), "code", "severity")
    signals = claimed.select(by, "edition_date", F.explode("signals").alias("s"))
    ids = publications.groupBy(by, F.col("id").alias("__id")).agg(F.max("published_at").alias("__day"), F.max(F.lit(1)).alias("__there"))
    found = signals.join(ids.withColumnRenamed(by, "__by"), (F.col(by) == F.col("__by")) & (F.col("s.id") == F.col("__id")), "left")
    words = _count(F.col("s.why_it_matters"))
    of_signal = {
        "signal_unknown": F.col("__there").isNull(),
        "signal_of_other_day": F.col("__there").isNotNull() & ~F.col("__day").eqNullSafe(F.col("edition_date")),
        "rank_missing": F.col("s.rank").isNull(),
        "reason_missing": words == 0,
        "reason_words": (words > 0) & ((words < 12) | (words > 32)),
        "reason_act_number": F.coalesce(F.col("s.why_it_matters").rlike(V.ACT_NUMBER), F.lit(False)),
    }
    rows = check(found, F.struct(F.col(by).alias("by"), F.col("s.id").alias("id")), of_signal)
    return heads.unionByName(rows.select(F.col("path.by").alias(by), F.col("path.id").alias("path"), "code", "severity"))


def edition(claimed: DataFrame, publications: DataFrame, statuses: DataFrame) -> DataFrame:
    """One edition's row against all publications and statuses: (path, code, severity)."""
    one = lambda df: df.withColumn("__cut", F.lit(1))
    return editions(one(claimed), one(publications), one(statuses), "__cut").drop("__cut")


def digest(df: DataFrame, publications: DataFrame) -> DataFrame:
    """A digest's nested items: known and unique ids, 8 to 35 words a theme, no act number, no empty group."""
    groups = df.select(F.posexplode("groups").alias("g", "group"))
    rows = groups.select("g", "group.label", F.explode("group.items").alias("i")).select("g", "label", "i.*")
    n = _count(F.col("theme"))
    one = check(rows, F.col("id"), {"theme_words": (n < 8) | (n > 35), "act_number": F.col("theme").rlike(V.ACT_NUMBER), "organ_missing": _empty("organ")})
    say = lambda d, code: d.select(F.col("id").alias("path"), F.lit(code).alias("code"), F.lit("error").alias("severity"))
    unknown = say(rows.select("id").join(publications.select("id"), "id", "left_anti"), "id_unknown")
    repeated = say(rows.groupBy("id").count().filter("count > 1"), "id_repeated")
    whole = check(groups, F.concat(F.lit("group "), F.col("g").cast("string")), {"label_missing": F.coalesce(F.trim("group.label"), F.lit("")) == "", "group_empty": F.coalesce(F.size("group.items"), F.lit(0)) < 1})
    return one.unionByName(unknown).unionByName(repeated).unionByName(whole)


def has_errors(violations: DataFrame) -> bool:
    return not violations.filter("severity = 'error'").isEmpty()
