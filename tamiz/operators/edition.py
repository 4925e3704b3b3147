"""The daily edition: diverse top signals, coverage, reasons, and the denormalised artifact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.text import bounded_reason

PUBLIC_FIELDS = ("id", "title", "summary", "source", "url", "detail_url", "published_at", "issuing_body", "categories", "importance", "relevance_score", "jurisdiction", "country_or_org")


def select_diverse(df: DataFrame, day: str, importance: str = "importance", relevance: str = "relevance_score", key: str = "id", body: Column | None = None, category: Column | None = None, most: int = 7, cap: int = 2) -> DataFrame:
    """(day, rank, id): per day, the best rows by importance, relevance and id, of which no body and no category may
    have more than ``cap`` chosen; then the best of the rest, up to ``most``.

    A row that is skipped uses up nothing, so caps are a fold over the ranking. Only rows that the fold can reach go into it: of
    one (body, category) pair no more than ``cap`` can be chosen in the first pass, and of all rows no more than ``most`` in
    the second, so each pair's best ``cap`` and the best ``most`` overall suffice. Arrays are bounded by a day's pairs."""
    body = body if body is not None else F.coalesce(F.nullif(F.col("issuing_body"), F.lit("")), F.nullif(F.col("source"), F.lit("")), F.lit("Sin órgano"))
    category = category if category is not None else F.coalesce(F.get("categories", 0), F.lit("Sin materia"))
    row = F.struct((-F.coalesce(F.col(importance), F.lit(0))).cast("long").alias("i"), (-F.coalesce(F.col(relevance), F.lit(0))).cast("long").alias("r"), F.coalesce(F.col(key), F.lit("")).cast("string").alias("id"), body.alias("b"), category.alias("c"))
    rows = df.select(F.col(day), row.alias("x"))
    # Spark keeps a group's best rows before the shuffle too, as only the first row numbers are asked for.
    place = F.row_number().over(Window.partitionBy(day, "b", "c").orderBy("x"))
    pairs = rows.select(day, "x", F.col("x.b").alias("b"), F.col("x.c").alias("c")).withColumn("n", place).filter(F.col("n") <= most)
    days = pairs.groupBy(day).agg(F.array_sort(F.collect_list("x")).alias("o"))
    start = F.struct(F.slice(F.col("o"), 1, 0).alias("s"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["s"]
        room = (F.size(s) < most) & (F.size(F.filter(s, lambda y: y["b"] == x["b"])) < cap) & (F.size(F.filter(s, lambda y: y["c"] == x["c"])) < cap)
        return F.struct(F.when(room, F.concat(s, F.array(x))).otherwise(s).alias("s"))

    days = days.withColumn("p1", F.aggregate("o", start, step)["s"])
    # An id that was chosen is not chosen again.
    rest = F.filter("o", lambda x: ~F.exists("p1", lambda y: y["id"] == x["id"]))
    chosen = F.slice(F.concat("p1", rest), 1, most)
    return days.select(day, F.posexplode(chosen).alias("p", "x")).select(day, (F.col("p") + 1).alias("rank"), F.col("x.id").alias("id"))


def coverage(statuses: DataFrame, *by: str) -> DataFrame:
    """ok, failed (in order) and state of source statuses (source, status, ordinal)."""
    failed = F.array_sort(F.collect_list(F.when(F.col("status") == "error", F.struct("ordinal", "source"))))
    out = statuses.groupBy(*by).agg(F.count_if(F.col("status") == "ok").alias("ok"), F.transform(failed, lambda x: x["source"]).alias("failed"))
    return out.withColumn("state", F.when(F.size("failed") > 0, F.lit("partial")).otherwise(F.lit("complete")))


def digest_reasons(digest: DataFrame) -> DataFrame:
    """(id, theme) of a digest's nested groups; of repeated ids the last."""
    items = digest.select(F.posexplode("groups").alias("g", "group")).select("g", F.posexplode("group.items").alias("i", "item"))
    return items.select("g", "i", "item.id", "item.theme").dropna(subset=["id", "theme"]).groupBy("id").agg(F.max_by("theme", F.struct("g", "i")).alias("theme"))


def build_edition(items: DataFrame, statuses: DataFrame, day: Column, digest: DataFrame | None = None) -> DataFrame:
    """One row: the edition of ``day``, with its signals as an array."""
    today = items.filter(F.col("published_at") == day)
    picked = select_diverse(today, "published_at").select("rank", "id")  # seven rows
    summaries = today.groupBy("id").agg(F.first("summary").alias("summary"))
    signals = picked.join(summaries, "id", "left")
    reasons = digest_reasons(digest) if digest is not None else None
    signals = signals.join(reasons, "id", "left") if reasons is not None else signals.withColumn("theme", F.lit(None).cast("string"))
    why = bounded_reason(F.coalesce(F.nullif(F.col("theme"), F.lit("")), F.col("summary")))
    array = signals.agg(F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col("id"), why.alias("why_it_matters")))).alias("signals"))
    totals = items.agg(F.count_if(F.col("published_at") == day).alias("total_today"), F.max("published_at").alias("last_available_date"))
    seen = coverage(statuses).select(F.struct("state", "ok", "failed").alias("coverage"))
    out = totals.withColumn("signals", array.scalar()).withColumn("coverage", seen.scalar())
    return out.select(day.alias("edition_date"), F.when(F.col("total_today") > 0, F.lit("ready")).otherwise(F.lit("empty")).alias("state"), "coverage", "total_today", "last_available_date", F.get("signals", 0)["id"].alias("lead_id"), "signals")


def artifact(edition: DataFrame, items: DataFrame) -> DataFrame:
    """Signals in order, each with the public fields of its item (of repeated ids the last); dangling ones go."""
    fields = [c for c in PUBLIC_FIELDS if c in items.columns]
    signals = edition.select(F.explode("signals").alias("s")).select("s.*")
    by_id = items.groupBy("id").agg(F.max_by(F.struct(*[c for c in fields if c != "id"]), F.col("ordinal")).alias("x"))
    return F.broadcast(signals).join(by_id, "id").select("id", "x.*", "rank", "why_it_matters").orderBy("rank")  # seven signals at most
