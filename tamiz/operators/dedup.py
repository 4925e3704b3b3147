"""Deduplication, ordering and upserts with explicit ordinals, so that ties never depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.text import fold


def last_by_key(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Per key, the last row with the first row's ordinal: one aggregation with map-side combine."""
    others = [c for c in df.columns if c not in (key, ordinal)]
    out = df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(ordinal)).alias("r"), F.min(ordinal).alias(ordinal))
    return out.select(*(F.col(c) if c in (key, ordinal) else F.col(f"r.{c}") for c in df.columns))


def first_by_key(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*others), F.col(ordinal)).alias("r")).select(*(F.col(c) if c == key else F.col(f"r.{c}") for c in df.columns))


def keep_longest(df: DataFrame, keys: list[Column], text: str, ordinal: str) -> DataFrame:
    """Per key, the row with the longest text, of equal ones the first; it takes the group's first ordinal.
    An aggregation, not a window: hot keys are combined before the shuffle."""
    named = [k.alias(f"__k{i}") for i, k in enumerate(keys)]
    best = F.min_by(F.struct(*df.columns), F.struct(-F.coalesce(F.length(text), F.lit(0)), F.col(ordinal)))
    out = df.select("*", *named).groupBy(*(f"__k{i}" for i in range(len(keys)))).agg(best.alias("r"), F.min(ordinal).alias("__first"))
    return out.select(*(F.col("__first").alias(c) if c == ordinal else F.col(f"r.{c}") for c in df.columns))


def dedup_notices(df: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Notices by id (last value, first place), then by day and folded title (longest description)."""
    once = last_by_key(df, "id", ordinal)
    return keep_longest(once, [F.col("published_at"), fold(F.col("official_title"))], "description", ordinal)


def publication_order(ordinal: str = "ordinal") -> list[Column]:
    """Newest first, then score and source falling; equal rows keep their place."""
    return [F.desc("published_at"), F.desc("relevance_score"), F.desc("source"), F.asc(ordinal)]


def ordered_union(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, each with ``ordinal`` inside, under one ordinal by table and place: (table, place) packed in a long."""
    out = None
    for i, df in enumerate(tables):
        df = df.withColumn("ordinal", F.lit(i).cast("long") * F.lit(1 << 40) + F.col("ordinal"))
        out = df if out is None else out.unionByName(df)
    return out


def upsert(history: DataFrame, batch: DataFrame, run: Column) -> DataFrame:
    """(id, published_at, payload, first_seen_run, last_seen_run): the batch's (id, published_at, payload) written over
    the history. The first run a document was seen in stays. The result goes to a new place, then replaces the old."""
    new = batch.select("id", F.col("published_at").alias("p2"), F.col("payload").alias("d2"), F.lit(True).alias("here"))
    met = history.join(new, "id", "full_outer")
    return met.select("id", F.when(F.col("here"), F.col("p2")).otherwise(F.col("published_at")).alias("published_at"), F.when(F.col("here"), F.col("d2")).otherwise(F.col("payload")).alias("payload"), F.coalesce("first_seen_run", run).alias("first_seen_run"), F.when(F.col("here"), run).otherwise(F.col("last_seen_run")).alias("last_seen_run"))


def fold_runs(runs: DataFrame, key: str, run: str) -> DataFrame:
    """The history after all runs at once: per key the last row, and the first and last run it was seen in."""
    others = [c for c in runs.columns if c not in (key, run)]
    return runs.groupBy(key).agg(F.min(run).alias("first_seen_run"), F.max(run).alias("last_seen_run"), F.max_by(F.struct(*others), F.col(run)).alias("r")).select(key, "first_seen_run", "last_seen_run", "r.*")


def latest_run(history: DataFrame) -> DataFrame:
    """Documents seen in the last run, newest first."""
    last = history.agg(F.max("last_seen_run").alias("m"))
    return history.join(F.broadcast(last), F.col("last_seen_run") == F.col("m")).drop("m").orderBy(F.desc("published_at"), "id")  # one row is broadcast


def history_report(runs: DataFrame, history: DataFrame) -> DataFrame:
    """One row: runs, documents, last_run."""
    a = runs.agg(F.count("*").alias("runs"), F.max_by("generated_at", "id").alias("last_run"))
    return a.withColumn("documents", history.agg(F.count("*")).scalar())


def fill_forward(df: DataFrame, group: str, order: str, value: Column, out: str) -> DataFrame:
    """The last non-null value up to each row, within its group."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))
