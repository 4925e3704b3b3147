import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tamiz.functions.text import fold
from tamiz.operators import terms
from tamiz.plans import commands, daily, domain_queries, queries
from tamiz.sources import artifacts, notices

DAY = dt.date(2026, 7, 7)
ITEMS = ", ".join(f"{c} {dict(published_at='date', published_year='int', published_month='int', published_day='int', categories='array<string>', topic_tags='array<string>', subtopic_tags='array<string>', importance='int', relevance_score='int', ai_generated='boolean', ordinal='long').get(c, 'string')}" for c in daily.PUBLICATION)
ITEM = "<item><title>{0}</title><link>https://a/{0}</link><guid>{0}</guid><description>New tariff and trade agreement with sanctions {0}</description><pubDate>Tue, 07 Jul 2026 10:00:00 GMT</pubDate></item>"


def source(spark, *names):
    df = spark.createDataFrame([(0, "<rss>" + "".join(map(ITEM.format, names)) + "</rss>")], "ordinal long, payload string")
    return commands.Source("OMC", lambda: notices.feed(df, notices.FEEDS["wto"]))


def broken():
    raise TimeoutError("x" * 300)


def test_a_source_that_fails_stops_no_other(spark):
    waits = []
    items, statuses = commands.collect(spark, [commands.Source("CIJ", broken), source(spark, "one", "two")], wait=waits.append)
    assert items.count() == 2 and waits == [1.25, 2.5]
    rows = {r.source: r for r in statuses.collect()}
    assert (rows["CIJ"].status, rows["CIJ"].attempts, rows["CIJ"].error) == ("error", 3, "TimeoutError: " + "x" * 240)
    assert (rows["OMC"].status, rows["OMC"].items_found, rows["OMC"].attempts) == ("ok", 2, 1)
    none, statuses = commands.collect(spark, [commands.Source("CIJ", broken)], wait=waits.append)
    assert none is None and statuses.first().status == "error"


def test_the_daily_run_and_its_history(spark, tmp_path):
    base, paths = str(tmp_path / "h"), (str(tmp_path / "publications.json"), str(tmp_path / "edition.json"))
    with pytest.raises(LookupError):
        commands.export(spark, base, "id string")
    assert commands.run(spark, [source(spark, "one", "two")], F.lit(DAY), "2026-07-07T12:00:00Z", *paths, base).collect() == []
    published, edition = (json.load(open(p)) for p in paths)
    assert published["total_items"] == 2 and [s["rank"] for s in edition["signals"]] == [1, 2] and edition["signals"][0]["title"]
    items = spark.createDataFrame(commands.export(spark, base, f"{ITEMS}")[0].collect(), ITEMS)
    again = items.filter("official_title = 'two'").unionByName(items.filter("official_title = 'one'").withColumns({"id": F.lit("x:3"), "official_title": F.lit("three")}))
    statuses = spark.createDataFrame([(0, "OMC", "ok", 2, None, 1)], "ordinal int, source string, status string, items_found long, error string, attempts int")
    assert commands.save_run(spark, base, again, statuses, "2026-07-08T12:00:00Z") == 2
    info = commands.report(spark, base)
    assert (info["runs"], info["documents"], info["last_generated_at"]) == (2, 3, "2026-07-08T12:00:00Z") and info["size_bytes"] > 0
    seen = {r.o: (r.first_seen_run, r.last_seen_run) for r in artifacts.read_buckets(spark, base + "/documents").withColumn("o", F.get_json_object("payload", "$.official_title")).collect()}
    assert seen == {"one": (1, 1), "two": (1, 2), "three": (2, 2)}
    exported, statuses = commands.export(spark, base, ITEMS)
    assert {r.official_title for r in exported.collect()} == {"two", "three"} and statuses.count() == 1
    first = again.first()
    edits = spark.createDataFrame([(first.id, "Nuevo", first.summary, first.card_body, None, 5)], "id string, title string, summary string, card_body string, case_facts string, importance int")
    edited = commands.edit(spark, again, edits, base).filter("ai_generated").collect()
    assert [(r.title, r.detail_markdown[:7]) for r in edited] == [("Nuevo", "# Nuevo")]
    kept = {r.o: (r.t, r.i) for r in artifacts.read_buckets(spark, base + "/documents").select(F.get_json_object("payload", "$.official_title").alias("o"), F.get_json_object("payload", "$.title").alias("t"), F.get_json_object("payload", "$.importance").alias("i")).collect()}
    assert kept["two"] == ("Nuevo", "5") and kept["one"][0] != "Nuevo"


def test_prepare_keeps_an_edition_unless_forced(spark):
    items = "array<struct<id:string,published_at:string,importance:int,relevance_score:int,issuing_body:string,source:string,categories:array<string>,summary:string>>"
    payload = spark.createDataFrame([("2026-07-08T03:00:00Z", [("a", "2026-07-07", 3, 2, "b", "s", ["c"], "uno dos")], "x")], f"generated_at string, items {items}, legacy string")
    statuses = spark.createDataFrame([(0, "s", "ok")], "ordinal int, source string, status string")
    made = commands.prepare(payload, statuses)
    row = made.first()
    assert (row.schema_version, row.legacy, row.edition.edition_date, row.edition.lead_id) == (7, "x", DAY, "a")
    other = made.withColumn("edition", F.struct(F.lit("mine").alias("state")))
    assert commands.prepare(other, statuses).first().edition.state == "mine"
    assert commands.prepare(other, statuses, force=True).first().edition.state == "ready"
    whole = made.withColumns({"lookback_days": F.lit(31), "total_items": F.lit(1), "sources": F.array(F.lit("s"))})
    assert commands.payload_violations(whole).count() == 0
    bad = whole.withColumns({"schema_version": F.lit(6), "generated_at": F.lit("ayer"), "lookback_days": F.lit("x"), "total_items": F.lit(2), "sources": F.lit(None).cast("array<string>")})
    assert {r.code for r in commands.payload_violations(bad).collect()} == {"schema_version_wrong", "generated_at_not_a_stamp", "lookback_days_not_a_number", "total_items_wrong", "sources_not_a_list"}


def test_texts_are_folded_once(spark):
    # The pattern over the text stands outside the lambdas over terms, so it does not run for each of them.
    df = spark.createDataFrame([("uno",)], "x string").select(fold(F.col("x")).alias("f")).select(F.col("f"), terms.pad(F.col("f")).alias("p"))
    out = df.select(terms.matches(F.col("p"), F.col("f"), ("uno", "dos", "t-mec")), terms.first_match(F.col("p"), [("a",), ("b",)], [("uno",), ("dos", "tres")]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    inner = plan[plan.index("filter(") :]
    assert plan.count("regexp_replace") <= 6
    assert "regexp_replace(" not in inner.split("lambdafunction", 1)[1].split("namedlambdavariable", 1)[0]


def test_every_query_of_the_domain_has_sql():
    assert set(queries.QUERIES) == set(domain_queries.ORACLE_SQL)
