"""Editorial patches: validated as a whole, applied as a whole or not at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import section, words
from tamiz.operators import summarize, taxonomy, validate
from tamiz.plans import vocabulary as V

FIELDS = ("title", "summary", "card_body", "case_facts", "importance")


class Rejected(ValueError):
    """Some edit is invalid; ``violations`` has them all, and nothing was changed."""

    def __init__(self, violations: DataFrame):
        super().__init__("invalid edits")
        self.violations = violations


def edit_violations(edits: DataFrame, items: DataFrame) -> DataFrame:
    """Rules of single edits, repeated ids, ids that no item has, and columns that are no field. A null optional field is not edited."""
    n = F.size(words(F.col("summary")))
    rules: dict[str, Column] = {
        "title_missing": F.coalesce(F.trim("title"), F.lit("")) == "",
        "office_title": F.col("title").rlike(V.OFFICE_TITLE),
        "summary_missing": F.coalesce(F.trim("summary"), F.lit("")) == "",
        "summary_words": (n < 40) | (n > 80),
        "card_body_missing": F.coalesce(F.trim("card_body"), F.lit("")) == "",
        "act_number": section(F.col("card_body"), V.CARD_SECTIONS[0]).rlike(V.ACT_NUMBER),
        "importance_range": (F.col("importance") < 1) | (F.col("importance") > 5),
        "facts_blank": F.trim("case_facts") == "",
        "facts_with_heading": F.coalesce(F.col("case_facts"), F.lit("")).rlike(r"(?m)^#{1,6}\s"),
    } | {f"section_{i}": ~F.contains(F.coalesce(F.col("card_body"), F.lit("")), F.lit(h)) for i, h in enumerate(V.CARD_SECTIONS)}
    found = validate.check(edits, F.col("id"), rules)
    say = lambda d, code: d.select(F.col("id").alias("path"), F.lit(code).alias("code"), F.lit("error").alias("severity"))
    for name in sorted({*edits.columns} - {"id", *FIELDS}):
        found = found.unionByName(say(edits.filter(F.col(name).isNotNull()), f"field_unknown_{name}"))
    return found.unionByName(say(edits.groupBy("id").count().filter("count > 1"), "edit_repeated")).unionByName(say(edits.join(items.select("id"), "id", "left_anti"), "id_unknown"))


def patch(items: DataFrame, edits: DataFrame, fields: tuple[str, ...], mark: str | None = None) -> DataFrame:
    """``items`` with the non-null fields of ``edits`` (unique by id) written over theirs; ``mark`` becomes true for them."""
    new = edits.select("id", F.lit(True).alias("__hit"), *(F.col(f).alias(f"__{f}") for f in fields))
    met = items.join(new, "id", "left")
    put = {f: F.coalesce(F.col(f"__{f}"), F.col(f)) for f in fields}
    if mark:
        put[mark] = F.coalesce("__hit", F.col(mark))
    return met.select(*(put[c].alias(c) if c in put else F.col(c) for c in items.columns))


def patch_payloads(history: DataFrame, edits: DataFrame) -> DataFrame:
    """``history`` (id, payload, ...) with the non-null columns of ``edits`` (unique by id) written into its JSON objects.

    Objects are read as maps of variants, so keys that no schema names, nulls and nested values stay as they are (keys come out in
    the order of their names, the edited ones last). A payload that is no JSON object stays untouched."""
    kind = "map<string,variant>"
    fields = [c for c in edits.columns if c != "id"]
    new = edits.select("id", F.to_json(F.struct(*fields)).alias("__new"))  # null fields are left out
    met = history.join(new, "id", "left")
    old, fresh = F.try_variant_get(F.try_parse_json("payload"), "$", kind), F.variant_get(F.parse_json("__new"), "$", kind)
    merged = F.map_from_entries(F.concat(F.filter(F.map_entries(old), lambda e: ~F.map_contains_key(fresh, e["key"])), F.map_entries(fresh)))
    payload = F.coalesce(F.to_json(merged), F.col("payload")).alias("payload")
    return met.select(*(payload if c == "payload" else c for c in history.columns))


def apply(items: DataFrame, edits: DataFrame) -> DataFrame:
    """The patched items, with their detail pages built anew; raises ``Rejected`` if any edit, or the result, is invalid."""
    found = edit_violations(edits, items)
    if validate.has_errors(found):
        raise Rejected(found)
    trimmed = edits.select("id", *(F.trim(f).alias(f) if f != "importance" else F.col(f) for f in FIELDS))
    out = patch(items, trimmed, FIELDS, "ai_generated")
    if "organ_short" not in items.columns:
        body = F.coalesce(F.nullif("issuing_body", F.lit("")), "authority")
        out = out.withColumn("organ_short", taxonomy.short_name(taxonomy.organ(body, F.col("official_title")), body, F.col("source")))
    page = F.when(F.col("ai_generated"), summarize.detail_markdown()).otherwise(F.col("detail_markdown"))
    out = out.withColumn("detail_markdown", page).select(items.columns)
    found = validate.items(out)
    if validate.has_errors(found):
        raise Rejected(found)
    return out
