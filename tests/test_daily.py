import datetime as dt
import json

from pyspark.sql import functions as F

from tamiz.operators import dedup
from tamiz.plans import daily
from tamiz.sources import artifacts, notices

DAY = dt.date(2026, 7, 7)


def test_from_payloads_to_the_document(spark, tmp_path):
    item = "<item><title>{0}</title><link>https://a/{0}</link><guid>{0}</guid><description>{1}</description><pubDate>Tue, 07 Jul 2026 10:00:00 GMT</pubDate></item>"
    feed = spark.createDataFrame([(0, "<rss>" + item.format("one", "New tariff and trade agreement with sanctions") + item.format("two", "A concert") + item.format("one", "New tariff, a longer text on the trade agreement and sanctions") + "</rss>")], "ordinal long, payload string")
    bank = spark.createDataFrame([(0, json.dumps({"documents": {"D": {"id": "D", "url": "https://w/1", "title": "Money laundering and tax", "lnchdt": "2026-07-06"}}}))], "ordinal long, payload string")
    rows = dedup.ordered_union(notices.feed(feed, notices.FEEDS["wto"]), notices.world_bank(bank))
    items = daily.publications(rows).cache()
    got = daily.ordered(items).collect()
    assert [(r.id.split(":")[0], r.description[:12]) for r in got] == [("omc", "New tariff, "), ("banco mundial", "Money launde")]
    sources = spark.createDataFrame([(0, "OMC", None, 1), (1, "Banco Mundial", None, 1), (2, "CIJ", "Timeout: x", 3)], "ordinal int, source string, error string, attempts int")
    status = daily.source_status(rows, sources)
    assert [r.items_found for r in status.orderBy("ordinal").collect()] == [3, 1, 0]
    doc = daily.document(items, status, F.lit(DAY), F.lit("2026-07-07T12:00:00Z")).cache()
    row = doc.first()
    assert (row.total_items, row.edition.state, row.edition.coverage.failed, len(row.edition.signals)) == (2, "ready", ["CIJ"], 1)
    made = doc.select("edition.*")
    assert daily.violations(items, status, made).filter("severity = 'error'").collect() == []
    assert daily.freshness(made, F.lit(dt.date(2026, 7, 8))).first().shown == "pending"
    page = daily.detail(items, made, got[0].id).select("why_it_matters", daily.sections(F.col("page")).alias("s")).first()
    assert page.why_it_matters and [x.heading for x in page.s][:2] == ["Qué se publicó", "Sustancia"]
    path = str(tmp_path / "publications.json")
    artifacts.write_document(doc, path)
    assert json.load(open(path))["total_items"] == 2
