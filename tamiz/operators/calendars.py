"""Working-day calendars: explicit entries over weekends over working days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.dates import is_weekend


def organ_days(calendars: DataFrame) -> DataFrame:
    """(organ, day, entry): the map of organs to dated entries as rows."""
    return calendars.select(F.explode("days_by_organ").alias("organ", "days")).select("organ", F.explode("days").alias("entry")).select("organ", F.try_to_date("entry.date").alias("day"), "entry")


def resolve(organs: DataFrame, exceptions: DataFrame, start: Column, end: Column) -> DataFrame:
    """(organ, day, status, reason) for every organ and day: an exception's status, else ``fin_semana`` or ``habil``."""
    days = organs.select("organ", F.explode(F.sequence(start, end)).alias("day"))
    met = days.join(exceptions.select("organ", "day", F.col("status").alias("__s"), F.col("reason").alias("__r")), ["organ", "day"], "left")
    status = F.coalesce("__s", F.when(is_weekend(F.col("day")), F.lit("fin_semana")).otherwise(F.lit("habil")))
    return met.select("organ", "day", status.alias("status"), F.col("__r").alias("reason"))


def working_days(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("organ").agg(F.count_if(F.col("status") == "habil").alias("working_days"))


def remaining_range(today: Column, year: Column) -> Column:
    """From tomorrow to the year's end; the whole year if it is not today's."""
    first = F.make_date(year, F.lit(1), F.lit(1))
    return F.struct(F.when(F.year(today) == year, F.date_add(today, 1)).otherwise(first).alias("start"), F.make_date(year, F.lit(12), F.lit(31)).alias("end"))


def violations(organs: DataFrame, days: DataFrame) -> DataFrame:
    """(path, code): repeated organs, organs without days and days without organ, weekends, repeated days, and
    conditional fields. ``days``: organ, day (null if unreadable), status, reason, source_url, publicacion, acuerdo, guardia, guardia_detalle."""
    known = organs.select("organ").distinct()
    listed = days.select("organ").distinct()
    out = [
        organs.groupBy("organ").count().filter("count > 1").select("organ", F.lit("organ_repeated").alias("code")),
        known.join(listed, "organ", "left_anti").select("organ", F.lit("organ_without_days").alias("code")),
        listed.join(known, "organ", "left_anti").select("organ", F.lit("organ_unknown").alias("code")),
        days.filter("day is not null").groupBy("organ", "day").count().filter("count > 1").select("organ", F.lit("day_repeated").alias("code")),
    ]
    rules = {
        "day_unreadable": F.col("day").isNull(),
        "day_on_weekend": is_weekend(F.col("day")),
        "status_unknown": ~F.coalesce(F.col("status").isin("inhabil", "vacaciones"), F.lit(False)),
        "reason_missing": F.coalesce(F.trim("reason"), F.lit("")) == "",
        "source_url_absolute": ~F.coalesce(F.col("source_url"), F.lit("")).rlike("^https?://"),
        "publication_unknown": ~F.coalesce(F.col("publicacion").isin("dof", "web_oficial", "pendiente"), F.lit(False)),
        "agreement_missing": (F.coalesce(F.trim("acuerdo"), F.lit("")) == "") & (F.coalesce(F.col("publicacion"), F.lit("")) != "pendiente"),
        "duty_detail_without_duty": (F.coalesce(F.trim("guardia_detalle"), F.lit("")) != "") & ~F.coalesce(F.col("guardia"), F.lit(False)),
    }
    found = F.array_compact(F.array(*(F.when(rule, F.lit(code)) for code, rule in rules.items())))
    out.append(days.select("organ", F.explode(found).alias("code")))
    total = out[0]
    for df in out[1:]:
        total = total.unionByName(df)
    return total
