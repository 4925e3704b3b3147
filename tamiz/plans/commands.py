"""The commands of the daily run, as functions of a session: collect, publish, keep the history, export, report, edit, validate.

Fetching is a function that the caller gives for each source; everything else is declared over its payloads."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.operators import calendars, dedup, edition, editorial, validate
from tamiz.plans import daily
from tamiz.sources import artifacts

STATUS = "ordinal int, source string, error string, attempts int"
#: An error's text is cut to so many characters.
ERROR_LENGTH = 240


@dataclass(frozen=True)
class Source:
    """A source's name and the function that reads its notices."""

    name: str
    read: Callable[[], DataFrame]


def attempt(source: Source, attempts: int = 3, backoff: float = 1.25, wait: Callable[[float], None] = time.sleep) -> tuple[DataFrame | None, str | None, int]:
    """The notices, the last error if no attempt succeeded, and the attempts made. An attempt reads and keeps all rows, so that
    a payload is parsed once; waits grow by ``backoff``."""
    error = None
    for n in range(1, attempts + 1):
        try:
            rows = source.read().persist()
            rows.count()
            return rows, None, n
        except Exception as e:  # a source that fails must not stop the others
            error = f"{type(e).__name__}: {str(e)[:ERROR_LENGTH]}"
            if n < attempts:
                wait(backoff * n)
    return None, error or "UnknownError: source collection failed", attempts


def collect(spark: SparkSession, sources: list[Source], since: Column | None = None, minimum: int = 2, **retry) -> tuple[DataFrame | None, DataFrame]:
    """(publications, statuses): each source by itself, one status row for each. Publications are None if all sources failed."""
    read = [(s, *attempt(s, **retry)) for s in sources]
    statuses = spark.createDataFrame([(i, s.name, error, n) for i, (s, _, error, n) in enumerate(read)], STATUS)
    found = [rows for _, rows, _, _ in read if rows is not None]
    if not found:
        return None, statuses.selectExpr("ordinal", "source", "'error' status", "0L items_found", "error", "attempts")
    notices = dedup.ordered_union(*found)
    # A day's publications are read again by each contract and each sink: kept, with their lineage, for the run.
    return daily.publications(notices, minimum, since).persist(), daily.source_status(notices, statuses)


def prepare(payload: DataFrame, statuses: DataFrame, force: bool = False, zone: str = "America/Mexico_City") -> DataFrame:
    """A document (one row with generated_at and items) with the schema's version and, if it has no edition or ``force``, a new
    one for the local day of its stamp. All other columns stay as they are."""
    from tamiz.functions.dates import edition_date

    row = payload.withColumn("schema_version", F.lit(daily.SCHEMA_VERSION))
    if "edition" in payload.columns and not force and not payload.filter("edition is not null").isEmpty():
        return row
    items = payload.select(F.posexplode("items").alias("ordinal", "i")).select("ordinal", "i.*")
    items = items.withColumn("published_at", F.try_to_date("published_at", "yyyy-MM-dd"))
    day = payload.select(edition_date(F.col("generated_at"), zone).alias("d")).scalar()
    return row.withColumn("edition", edition.build_edition(items, statuses, day).select(F.struct("*")).scalar())


def payload_violations(payload: DataFrame) -> DataFrame:
    """The top level of a document, whose fields are read as text where their kind is in doubt: version, stamp, counts, lists."""
    number = lambda name: F.col(name).cast("string").rlike(r"^-?\d+$")
    rules = {
        "schema_version_wrong": F.col("schema_version").isNotNull() & ~F.coalesce(F.col("schema_version") == daily.SCHEMA_VERSION, F.lit(False)),
        "generated_at_not_a_stamp": F.coalesce(F.try_to_timestamp(F.col("generated_at").cast("string")), F.lit(None)).isNull(),
        "lookback_days_not_a_number": ~F.coalesce(number("lookback_days"), F.lit(False)),
        "total_items_not_a_number": ~F.coalesce(number("total_items"), F.lit(False)),
        "sources_not_a_list": F.col("sources").isNull(),
        "items_not_a_list": F.col("items").isNull(),
        "total_items_wrong": F.col("total_items") != F.size("items"),
        "edition_missing": (F.col("schema_version") == daily.SCHEMA_VERSION) & F.col("edition").isNull(),
    }
    return validate.check(payload, F.lit("payload"), rules)


def save_run(spark: SparkSession, base: str, items: DataFrame, statuses: DataFrame, generated_at: str, lookback: int = 31) -> int:
    """Appends a run and its statuses to the history below ``base`` and writes its publications over those of before: its number."""
    runs = artifacts.read_table(spark, f"{base}/runs")
    run = (runs.agg(F.max("id")).first()[0] if runs is not None else 0) + 1
    batch = items.select("id", "published_at", F.to_json(F.struct("*")).alias("payload"))
    history = artifacts.read_buckets(spark, f"{base}/documents", artifacts.touched(batch))
    if history is None:
        history = batch.limit(0).select("id", "published_at", "payload", F.lit(0).alias("first_seen_run"), F.lit(0).alias("last_seen_run"))
    artifacts.replace_buckets(dedup.upsert(history, batch, F.lit(run)), batch, f"{base}/documents")
    statuses.select(F.lit(run).alias("run_id"), "ordinal", "source", "status", "items_found", "attempts", "error").write.mode("append").parquet(f"{base}/source_status")
    # The run's own row comes last: a run that broke off is none.
    spark.createDataFrame([(run, generated_at, lookback, items.count())], "id int, generated_at string, lookback_days int, total_items long").write.mode("append").parquet(f"{base}/runs")
    return run


def export(spark: SparkSession, base: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(items, statuses) of the last run, newest items first; ``schema``: of their payloads."""
    runs = artifacts.read_table(spark, f"{base}/runs")
    if runs is None:
        raise LookupError("no run was saved")
    last = runs.agg(F.max("id")).first()[0]
    seen = artifacts.read_buckets(spark, f"{base}/documents").filter(F.col("last_seen_run") == last)
    items = seen.select(F.from_json("payload", schema).alias("i")).select("i.*").orderBy(F.desc("published_at"), "id")
    return items, artifacts.read_table(spark, f"{base}/source_status").filter(F.col("run_id") == last).orderBy("ordinal")


def report(spark: SparkSession, base: str) -> dict:
    """The size, runs, documents and last stamp of the history."""
    runs, documents = artifacts.read_table(spark, f"{base}/runs"), artifacts.read_buckets(spark, f"{base}/documents")
    fs, make = artifacts._files(spark, base)
    row = dedup.history_report(runs, documents).first() if runs is not None else None
    size = fs.getContentSummary(make(base)).getLength() if fs.exists(make(base)) else 0
    return {"path": base, "size_bytes": size, "runs": row.runs if row else 0, "documents": row.documents if row else 0, "last_generated_at": row.last_run if row else None}


def edit(spark: SparkSession, items: DataFrame, edits: DataFrame, base: str | None = None) -> DataFrame:
    """The edited publications, all or none, and the same fields in the history below ``base``, if there is one."""
    out = editorial.apply(items, edits)
    history = artifacts.read_buckets(spark, f"{base}/documents", artifacts.touched(edits)) if base else None
    if history is not None:
        changed = out.join(edits.select("id"), "id", "left_semi").select("id", *editorial.FIELDS, "ai_generated", "detail_markdown")
        artifacts.replace_buckets(editorial.patch_payloads(history, changed), changed, f"{base}/documents")
    return out


def status_lines(statuses: DataFrame) -> DataFrame:
    """(ordinal, line): what a run says of each source; attempts are said from the second on."""
    tries = F.when(F.col("attempts") > 1, F.concat(F.lit(", "), F.col("attempts"), F.lit(" intentos"))).otherwise("")
    name = F.concat(F.lit("Fuente "), F.coalesce("source", F.lit("Fuente desconocida")), F.lit(": "))
    ok = F.concat(name, F.coalesce("items_found", F.lit(0)), F.lit(" registros revisados"), tries)
    return statuses.select("ordinal", F.when(F.col("status") == "ok", ok).otherwise(F.concat(name, F.lit("error"), tries, F.lit(": "), F.coalesce("error", F.lit("sin detalle")))).alias("line"))


def violation_lines(found: DataFrame) -> DataFrame:
    """(rank, line): warnings before errors."""
    error = F.col("severity") == "error"
    return found.select(error.cast("int").alias("rank"), F.concat(F.when(error, "Error: ").otherwise("Advertencia: "), F.col("path").cast("string"), F.lit(" "), F.col("code")).alias("line"))


def calendar_totals(organs: DataFrame, days: DataFrame) -> DataFrame:
    """One row: organs, days on file, and violations of the calendars' contract."""
    totals = organs.agg(F.count("*").alias("organs")).withColumn("days", days.agg(F.count("*")).scalar())
    return totals.withColumn("violations", calendars.violations(organs, days).agg(F.count("*")).scalar())


def run(spark: SparkSession, sources: list[Source], day: Column, generated_at: str, publications_path: str, edition_path: str, base: str | None = None, lookback: int = 31, **retry) -> DataFrame:
    """Collects, validates and publishes; the history is kept last, as the day's publication does not depend on it. Returns the
    violations; with an error among them nothing is written."""
    items, statuses = collect(spark, sources, F.date_sub(day, lookback), **retry)
    if items is None:
        return validate.sources(statuses)
    document = daily.document(items, statuses, day, F.lit(generated_at), lookback)
    made = document.select("edition.*")
    found = daily.violations(items, statuses, made).unionByName(payload_violations(document))
    if not validate.has_errors(found):
        signals = edition.artifact(made, items).agg(F.array_sort(F.collect_list(F.struct("rank", "why_it_matters", *[c for c in edition.PUBLIC_FIELDS]))).alias("signals"))
        envelope = made.drop("signals").withColumn("schema_version", F.lit(daily.SCHEMA_VERSION)).withColumn("generated_at", F.lit(generated_at)).withColumn("signals", signals.scalar())
        artifacts.write_site(document, envelope, publications_path, edition_path)
        if base:
            save_run(spark, base, items, statuses, generated_at, lookback)
    return found
