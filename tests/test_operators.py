import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tamiz.functions.text import fold
from tamiz.operators import archive, calendars, classify, dedup, edition, editorial, snapshot, summarize, taxonomy, terms, validate

DAY = dt.date(2026, 7, 7)


def notices(spark, *rows):
    base = {"source": "DOF", "source_id": "1", "url": "https://x.mx/1", "official_title": "", "description": "", "published_at": DAY, "authority": "", "document_type": "", "case_parties": "", "case_status": "", "case_facts": "", "id": "dof:1", "ordinal": 0}
    schema = "source string, source_id string, url string, official_title string, description string, published_at date, authority string, document_type string, case_parties string, case_status string, case_facts string, id string, ordinal long"
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], schema)


def test_terms_match_whole_words_only(spark):
    random.seed(1)
    pieces = ["iva", "nom-", "t-mec", "ñ", " ", "-", ".", "x", "_", "1", "trade.gov"]
    names = ["iva", "nom-", "t-mec", "x ñ"]
    texts = ["".join(random.choices(pieces, k=7)) for _ in range(400)]

    def want(s):
        return [t for t in names if (re.search(rf"(?<!\w){re.escape(t)}(?!\w)", s) if t.replace(" ", "").isalnum() else t in s)]

    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = df.select("i", terms.matches(terms.pad(F.col("x")), F.col("x"), names).alias("m")).orderBy("i").collect()
    assert [r.m for r in got] == [want(x) for x in texts]


def test_classification(spark):
    df = notices(
        spark,
        {"official_title": "Código Fiscal de la Federación: reforma"},
        {"official_title": "Se designa al nuevo comisionado de la unidad"},
        {"official_title": "Designa fecha. El comisionado asiste"},
        {"authority": "Secretaría de Hacienda", "official_title": "Aviso"},
        {"official_title": "sentencia definitiva de la sala regional sobre renta", "source": "otra"},
    )
    rows = classify.classify(df.withColumn("k", F.monotonically_increasing_id())).withColumn("keep", classify.relevant(2)).orderBy("k").collect()
    assert rows[0].categories == ["Fiscal", "Iniciativa"] and rows[0].relevance_score == 2 + 1 + 1
    assert rows[1].categories == ["Derecho administrativo", "Nombramientos federales"]
    assert rows[2].categories == []
    assert rows[3].keep and rows[3].categories == [] and not rows[2].keep
    assert rows[4].categories == ["Fiscal", "Contencioso administrativo", "Contencioso administrativo fiscal"]


def test_enrich_summarize_and_validate(spark):
    df = notices(spark, {"official_title": "Acuerdo 500-1 sobre aranceles", "description": "Acuerdo por el que se modifica un arancel de importacion y la patente", "authority": "INSTITUTO MEXICANO DE LA PROPIEDAD INDUSTRIAL", "document_type": "Acuerdo 12"}, {"id": "onu:2", "source": "CPI", "official_title": "War crimes trial opens today in the court", "authority": ""})
    out = summarize.summarize(taxonomy.enrich(classify.classify(df))).withColumn("detail_url", F.concat(F.lit("ficha.html?id="), "id"))
    out = out.withColumn("detail_markdown", summarize.detail_markdown())
    a, b = out.orderBy("id").collect()
    assert (a.organ_short, a.government_branch, a.jurisdiction) == ("IMPI", "Organismo descentralizado", "nacional")
    assert a.primary_categories == ["Comercio exterior", "Administración descentralizada"]
    assert "Acuerdo de IMPI." in a.card_body and 40 <= len(a.summary.split()) <= 80
    assert (b.issuing_body, b.jurisdiction, b.primary_categories) == ("Autoridad no identificada", "internacional", ["Penal"])
    assert a.detail_markdown.startswith("# ") and "## Fuente oficial" in a.detail_markdown
    assert validate.items(out).filter("severity = 'error'").count() == 0
    bad = out.withColumn("importance", F.lit(9)).withColumn("summary", F.lit("corto"))
    assert {r.code for r in validate.items(bad).collect()} >= {"importance_range", "summary_words"}


@pytest.mark.parametrize("score,want", [(0, 1), (2, 2), (3, 2), (4, 3), (7, 4), (9, 5)])
def test_importance(spark, score, want):
    assert spark.range(1).select(taxonomy.importance(F.lit(score)).alias("v")).first().v == want


def diverse(rows):
    chosen, bodies, cats = [], Counter(), Counter()
    ranked = sorted(rows, key=lambda r: (-r[1], -r[2], r[0]))
    for r in ranked:
        if len(chosen) < 7 and bodies[r[3]] < 2 and cats[r[4]] < 2:
            chosen.append(r[0])
            bodies[r[3]] += 1
            cats[r[4]] += 1
    return (chosen + [r[0] for r in ranked if r[0] not in chosen])[:7]


def test_diverse_selection_equals_the_rules(spark):
    random.seed(3)
    groups = {d: [(f"i{d}-{k}", random.randint(1, 5), random.randint(0, 4), random.choice("ABCD"), random.choice("xyz")) for k in range(random.randint(1, 25))] for d in range(60)}
    df = spark.createDataFrame([(d, *r) for d, rows in groups.items() for r in rows], "day int, id string, importance int, relevance_score int, b string, c string")
    got = {}
    for r in edition.select_diverse(df, "day", body=F.col("b"), category=F.col("c")).orderBy("day", "rank").collect():
        got.setdefault(r.day, []).append(r.id)
    assert got == {d: diverse(rows) for d, rows in groups.items()}


def test_edition_and_artifact(spark):
    items = spark.createDataFrame([(i, f"id{i}", "t", "uno dos tres", "s", DAY if i else DAY - dt.timedelta(1), f"b{i}", ["c"], 3, 2) for i in range(4)], "ordinal long, id string, title string, summary string, source string, published_at date, issuing_body string, categories array<string>, importance int, relevance_score int")
    status = spark.createDataFrame([(0, "a", "ok"), (1, "b", "error")], "ordinal int, source string, status string")
    e = edition.build_edition(items, status, F.lit(DAY))
    row = e.first()
    assert (row.state, row.total_today, row.lead_id, row.coverage.failed) == ("ready", 3, "id1", ["b"])
    assert [r.id for r in edition.artifact(e, items).collect()] == ["id1", "id2", "id3"]
    assert validate.edition(e, items, status).filter("code not in ('reason_words')").count() == 0
    assert {r.code for r in validate.edition(e.withColumn("total_today", F.lit(9)), items, status).collect()} >= {"total_wrong"}


def test_dedup_orders(spark):
    rows = [("a", DAY, "Título", "x", 0), ("b", DAY, "titulo", "xxx", 1), ("a", DAY, "Otro", "y", 2), ("c", DAY, "TITULO", "zzz", 3)]
    df = spark.createDataFrame(rows, "id string, published_at date, official_title string, description string, ordinal long")
    out = dedup.dedup_notices(df).orderBy("ordinal").collect()
    assert [(r.id, r.ordinal) for r in out] == [("a", 0), ("b", 1)]


def test_upsert_keeps_the_first_run(spark):
    old = spark.createDataFrame([("a", DAY, "1", 1, 1)], "id string, published_at date, payload string, first_seen_run int, last_seen_run int")
    new = spark.createDataFrame([("a", DAY, "2"), ("b", DAY, "3")], "id string, published_at date, payload string")
    out = dedup.upsert(old, new, F.lit(2))
    assert [tuple(r)[2:] for r in out.orderBy("id").collect()] == [("2", 1, 2), ("3", 2, 2)]
    assert dedup.latest_run(out).count() == 2


def test_snapshot_life_cycle(spark):
    one = spark.createDataFrame([("k1", "Pending"), ("k2", "Concluded")], "key string, status string")
    assert [r.key for r in snapshot.changes(one, None, F.col("status") == "Pending").collect()] == ["k1"]
    assert snapshot.changes(one, snapshot.next_snapshot(one)).count() == 0
    two = spark.createDataFrame([("k1", "Concluded"), ("k3", "Pending")], "key string, status string")
    assert {r.key for r in snapshot.changes(two, one).collect()} == {"k1", "k3"}


def test_archive(spark):
    df = spark.createDataFrame([(i, f"título {i}", DAY - dt.timedelta(i), ["c1"] if i % 2 else ["c2"], i % 5 + 1, i) for i in range(60)], "ordinal long, title string, published_at date, categories array<string>, importance int, relevance_score int")
    rows, at, pages = archive.page(df, archive.ArchiveQuery(category="c1", page=99))
    assert (at, pages, rows.count()) == (2, 2, 5)
    assert archive.select(df, archive.ArchiveQuery(days=7)).count() == 7
    assert archive.select(df, archive.ArchiveQuery(text="TITULO 5")).count() == 11
    assert archive.select(df, archive.ArchiveQuery(days=7, date="2026-06-01")).count() == 1
    accents = spark.createDataFrame([("ñ",), ("z",), ("á",), ("n",), ("b",)], "source string")
    assert [r.value for r in archive.facet(accents, "source").collect()] == ["á", "b", "n", "ñ", "z"]


def test_calendar(spark):
    organs = spark.createDataFrame([("o1",), ("o2",)], "organ string")
    days = spark.createDataFrame([("o1", dt.date(2026, 7, 7), "inhabil", "r")], "organ string, day date, status string, reason string")
    out = calendars.resolve(organs, days, F.lit(dt.date(2026, 7, 6)), F.lit(dt.date(2026, 7, 12)))
    assert {r.organ: r.working_days for r in calendars.working_days(out).collect()} == {"o1": 4, "o2": 5}
    full = spark.createDataFrame([("o1", dt.date(2026, 7, 11), "inhabil", "", None, "dof", "", None, "d")], "organ string, day date, status string, reason string, source_url string, publicacion string, acuerdo string, guardia boolean, guardia_detalle string")
    assert {r.code for r in calendars.violations(organs, full).collect()} == {"organ_without_days", "day_on_weekend", "reason_missing", "source_url_absolute", "agreement_missing", "duty_detail_without_duty"}


def test_editorial_is_all_or_nothing(spark):
    df = notices(spark, {"official_title": "Acuerdo sobre aranceles para importacion de acero", "description": "Acuerdo por el que se modifica un arancel"})
    items = summarize.summarize(taxonomy.enrich(classify.classify(df))).withColumn("detail_url", F.concat(F.lit("ficha.html?id="), "id"))
    items = items.withColumn("detail_markdown", summarize.detail_markdown())
    first = items.first()
    schema = "id string, title string, summary string, card_body string, case_facts string, importance int"
    good = spark.createDataFrame([("dof:1", "Nuevo título", first.summary, first.card_body, "Hechos", 5)], schema)
    row = editorial.apply(items, good).first()
    assert row.title == "Nuevo título" and row.ai_generated and row.detail_markdown.startswith("# Nuevo título") and "Hechos" in row.detail_markdown
    blank = good.withColumn("case_facts", F.lit(" ")).withColumn("color", F.lit("x"))
    assert {r.code for r in editorial.edit_violations(blank, items).collect()} == {"facts_blank", "field_unknown_color"}
    bad = spark.createDataFrame([("dof:1", "Oficio 12", "corto", first.card_body, None, 7), ("nada", "t", first.summary, first.card_body, None, 1)], schema)
    with pytest.raises(editorial.Rejected) as e:
        editorial.apply(items, bad)
    assert {r.code for r in e.value.violations.collect()} >= {"office_title", "summary_words", "importance_range", "id_unknown"}


def test_proximity(spark):
    cases = {"designa a un " + "x" * 45 + " comisionado": False, "designa a un comisionado": True, "designa. un comisionado": False, "comisionado que designa": True, "designa " + "x" * 200 + " comisionado": False, "designado comisionados": False}
    df = spark.createDataFrame([(k,) for k in cases], "x string").select("x", terms.near(fold(F.col("x")), ("designa", "designado"), ("comisionado",), 40).alias("n"))
    assert {r.x: r.n for r in df.collect()} == cases
