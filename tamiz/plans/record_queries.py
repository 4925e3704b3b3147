"""Registered queries of records: precedence of equal addresses, order of sources, exports and totals of the history, contracts of
digests and documents, freshness of editions and pages of publications, each over whole tables with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tamiz.operators import dedup, search_index, validate
from tamiz.plans import commands, daily
from tamiz.plans.domain_queries import _DISCOVERED, _DOCS, _docs, _pick, _plain
from tamiz.plans.page_queries import ORACLE_SQL, QUERIES
from tamiz.plans.queries import _FOLD, _PAD, _query, _table
from tamiz.sources import pages

__all__ = ["ORACLE_SQL", "QUERIES"]

_TITLES = ("Reforma al arancel", "Visita", "Aviso de importación", "Concierto")
_LAST_TITLE = "['Reforma al arancel', 'Visita', 'Aviso de importación', 'Concierto'][doc_id % 4 + 1] || ' ' || t"


@_query(f"""
WITH n AS (SELECT doc_id, 'https://www.gob.mx/x/' || (doc_id // 4) AS url, {_LAST_TITLE} AS title, ['shcp', 'uif', 'nueva'][doc_id % 3 + 1] AS portal, day FROM {_DOCS}),
l AS MATERIALIZED (SELECT *, {_FOLD.format('title')} AS f, {_PAD.format('title')} AS p FROM n QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id DESC) = 1)
SELECT url, trim(title) AS official_title, strftime(day, '%Y-%m-%d') AS published_at, CASE portal WHEN 'shcp' THEN 'Secretaría de Hacienda y Crédito Público' ELSE 'Portal federal ' || upper(portal) END AS authority
FROM l WHERE day >= DATE '2026-06-10' AND (portal = 'uif' OR {_DISCOVERED})
""")
def portal_last_wins(spark, sf_dir):
    """Archive items of equal addresses: the last one's portal, title and day decide whether it is kept, from a day on."""
    items = _docs(spark, sf_dir).select(
        F.col("doc_id").alias("ordinal"), F.concat(F.lit("https://www.gob.mx/x/"), F.floor(F.col("doc_id") / 4)).alias("url"), F.concat(_pick(_TITLES), F.lit(" "), "t").alias("title"), _pick(("shcp", "uif", "nueva")).alias("portal"), F.col("day").alias("published_at"), F.lit("Comunicado").alias("document_type"),
    )
    return _plain(pages.portal_notices(items, since=F.expr("DATE'2026-06-10'")), "url", "official_title", "published_at", "authority")


@_query(f"SELECT 'https://www.snice.gob.mx/d/' || (doc_id // 3) AS url, min(doc_id) AS first, arg_min('Aviso sobre cupos de importacion ' || t, doc_id) AS official_title FROM {_DOCS} GROUP BY doc_id // 3")
def first_of_equal_links(spark, sf_dir):
    """Dated links of equal addresses in several payloads: the first one's title."""
    docs = _docs(spark, sf_dir)
    payload = F.concat(F.lit("<p>01.07.2026 <a href='/d/"), F.floor(F.col("doc_id") / 3), F.lit("'>Aviso sobre cupos de importacion "), "e", F.lit("</a></p>"))
    out = pages.dated_links(docs.select(F.col("doc_id").alias("ordinal"), payload.alias("payload")))
    return out.select("url", F.floor(F.col("ordinal") / (1 << 20)).cast("long").alias("first"), "official_title")


@_query("""
SELECT 0 AS source, doc_id AS k, row_number() OVER (ORDER BY doc_id) AS place FROM documents
UNION ALL SELECT 1, page_id, (SELECT count(*) FROM documents) + row_number() OVER (ORDER BY page_id) FROM pages
UNION ALL SELECT 2, event_id, (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages) + row_number() OVER (ORDER BY event_id) FROM events
""")
def union_in_order(spark, sf_dir):
    """Rows of three sources under one ordinal by source and place, counted through from its order."""
    parts = [_table(spark, sf_dir, t).select(F.lit(i).alias("source"), F.col(k).alias("k"), F.col(k).alias("ordinal")) for i, (t, k) in enumerate((("documents", "doc_id"), ("pages", "page_id"), ("events", "event_id")))]
    one = dedup.ordered_union(*parts)
    # Places in all: the rank within a part and the parts before it, so that no window holds all rows.
    sizes = one.groupBy("source").agg(F.count("*").alias("n"))
    before = sizes.select(F.col("source").alias("s"), F.coalesce(F.sum("n").over(Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = one.withColumn("r", F.row_number().over(Window.partitionBy("source", F.floor(F.col("ordinal") / (1 << 16))).orderBy("ordinal")))
    ranked = ranked.withColumn("b", F.floor(F.col("ordinal") / (1 << 16)))
    blocks = ranked.groupBy("source", "b").agg(F.count("*").alias("m"))
    below = blocks.select("source", "b", F.coalesce(F.sum("m").over(Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("low"))
    return ranked.join(below, ["source", "b"]).join(before, F.col("source") == F.col("s")).select("source", "k", (F.col("r") + F.col("low") + F.col("before")).cast("long").alias("place"))


@_query("""
WITH h AS (SELECT user_id AS id, min(CAST(ts AS DATE)) AS f, max(CAST(ts AS DATE)) AS l, arg_max(event_type, (ts, event_id)) AS payload FROM events GROUP BY user_id)
SELECT id, payload, strftime(f, '%Y-%m-%d') AS first_seen_run, strftime(l, '%Y-%m-%d') AS last_seen_run FROM h WHERE l = (SELECT max(l) FROM h)
""")
def export_last_run(spark, sf_dir):
    """What the last of all days' runs has seen: the documents of an export."""
    runs = _table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.struct(F.to_date("ts").alias("d"), "ts", "event_id").alias("run"), F.col("event_type").alias("payload"))
    history = dedup.fold_runs(runs, "id", "run").select("id", "payload", F.col("first_seen_run.d").alias("first_seen_run"), F.col("last_seen_run.d").alias("last_seen_run"), F.col("last_seen_run.d").alias("published_at"))
    return _plain(dedup.latest_run(history), "id", "payload", "first_seen_run", "last_seen_run")


@_query("SELECT count(DISTINCT CAST(ts AS DATE)) AS runs, count(DISTINCT user_id) AS documents, strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') AS last_run FROM events")
def history_totals(spark, sf_dir):
    """Runs, documents and the last stamp of the history of all days."""
    events = _table(spark, sf_dir, "events")
    runs = events.select(F.to_date("ts").cast("string").alias("generated_at")).distinct().withColumn("id", F.col("generated_at"))
    return dedup.history_report(runs, events.select("user_id").distinct()).select("runs", "documents", "last_run")


@_query(r"""
WITH x AS (SELECT doc_id, coalesce(text, '') AS text, CASE WHEN doc_id % 10 = 0 THEN doc_id + 1 ELSE doc_id END AS id, len(list_filter(string_split(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')), ' '), lambda z: z <> '')) + CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 0 END AS n FROM documents)
SELECT 'd' || id AS path, 'theme_words' AS code FROM x WHERE n < 8 OR n > 35
UNION ALL SELECT 'd' || id, 'act_number' FROM x WHERE doc_id % 7 = 0 OR regexp_matches(text, '(?i)(?:oficio|acuerdo|circular|resoluci[oó]n|expediente|no\.|núm)\s*[:.]?\s*[A-Z0-9][A-Z0-9/.-]*\d|\b\d{3,}[-/][A-Z0-9/.-]*\d')
UNION ALL SELECT 'd' || id, 'organ_missing' FROM x WHERE doc_id % 5 = 0
UNION ALL SELECT 'd' || id, 'id_unknown' FROM x WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = x.id)
UNION ALL SELECT 'd' || id, 'id_repeated' FROM x GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'group 0', 'label_missing' FROM x WHERE doc_id % 3 = 0
UNION ALL SELECT 'group 1', 'group_empty' FROM x
""")
def digest_violations(spark, sf_dir):
    """Digests, one a document with its whole text as theme, against their contract and the publications."""
    n = lambda k: F.pmod("doc_id", F.lit(k))
    identifier = F.concat(F.lit("d"), F.when(n(10) == 0, F.col("doc_id") + 1).otherwise(F.col("doc_id")))
    theme = F.concat(F.coalesce("text", F.lit("")), F.when(n(7) == 0, "\nOficio 500-05-2026-1").otherwise(""))
    item = F.struct(identifier.alias("id"), F.when(n(5) == 0, " ").otherwise("SAT").alias("organ"), theme.alias("theme"))
    empty = F.struct(F.lit("vacío").alias("label"), F.slice(F.array(item), 1, 0).alias("items"))
    digests = _table(spark, sf_dir, "documents").select(F.array(F.struct(F.when(n(3) == 0, "").otherwise("Fiscal").alias("label"), F.array(item).alias("items")), empty).alias("groups"))
    return validate.digest(digests, _table(spark, sf_dir, "labels").select(F.concat(F.lit("d"), "doc_id").alias("id"))).select("path", "code")


@_query("""
SELECT code, count(*) AS n FROM (SELECT unnest(list_concat(CASE WHEN doc_id % 7 = 1 THEN ['schema_version_wrong'] ELSE [] END, CASE WHEN doc_id % 3 = 1 THEN ['generated_at_not_a_stamp'] ELSE [] END, CASE WHEN doc_id % 4 = 1 THEN ['lookback_days_not_a_number'] ELSE [] END,
  CASE doc_id % 5 WHEN 1 THEN ['total_items_wrong'] WHEN 2 THEN ['total_items_not_a_number'] ELSE [] END, CASE WHEN doc_id % 6 = 1 THEN ['sources_not_a_list'] ELSE [] END, CASE WHEN doc_id % 8 = 1 AND doc_id % 7 <> 1 THEN ['edition_missing'] ELSE [] END)) AS code FROM documents) GROUP BY code
""")
def document_top_level(spark, sf_dir):
    """The top level of documents, one for each text: how many break each rule."""
    n = lambda k: F.pmod("doc_id", F.lit(k))
    rows = _table(spark, sf_dir, "documents").select(
        F.when(n(7) == 1, 6).otherwise(daily.SCHEMA_VERSION).alias("schema_version"), F.when(n(3) == 1, F.coalesce(F.concat(F.lit("ayer "), "text"), F.lit("ayer"))).otherwise("2026-07-07T12:00:00Z").alias("generated_at"), F.when(n(4) == 1, "x").otherwise("31").alias("lookback_days"),
        F.when(n(5) == 1, "3").when(n(5) == 2, "dos").otherwise("1").alias("total_items"), F.when(n(6) != 1, F.array(F.lit("s"))).alias("sources"), F.array("text").alias("items"), F.when(n(8) != 1, F.struct(F.lit("ready").alias("state"))).alias("edition"),
    )
    rows = rows.withColumn("total_items", F.when(F.col("total_items") == "dos", F.lit(None)).otherwise(F.col("total_items")))
    return commands.payload_violations(rows).groupBy("code").agg(F.count("*").alias("n"))


@_query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 IN (0, 1, 2) THEN 'error' WHEN CAST(o_orderdate AS DATE) <> DATE '1998-03-05' THEN 'pending' WHEN o_orderkey % 2 = 0 THEN 'empty' ELSE 'ready' END AS shown FROM orders")
def edition_freshness(spark, sf_dir):
    """What a reader is shown of an edition on one day: broken envelopes, other days, its state."""
    n = F.pmod("o_orderkey", F.lit(7))
    made = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.when(n != 0, F.to_date("o_orderdate")).alias("edition_date"), F.when(n == 1, "otro").when(F.col("o_orderkey") % 2 == 0, "empty").otherwise("ready").alias("state"), F.when(n != 2, F.array(F.lit(1))).alias("signals"))
    return daily.freshness(made, F.expr("DATE'1998-03-05'")).select("k", "shown")


@_query(f"""
SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'Motivo ' || l.quality END AS why, md5(CASE d.doc_id % 3 WHEN 0 THEN '# T' || chr(10) || t WHEN 1 THEN '## C' || chr(10) || t
  ELSE '## Qué se publicó' || chr(10) || chr(10) || CASE WHEN d.doc_id % 2 = 0 THEN t WHEN d.doc_id % 5 = 0 THEN 'Sin descripción disponible.' ELSE 'Título' END || chr(10) || chr(10) || '## Sustancia' || chr(10) || chr(10) || 'Sin síntesis disponible.' || chr(10) || chr(10) || '## Fuente oficial' || chr(10) || chr(10) || '[Abrir documento oficial](https://x.mx/' || d.doc_id || ')' END) AS page
FROM {_DOCS} d LEFT JOIN labels l ON l.doc_id = d.doc_id
""".replace("WHEN d.doc_id % 2 = 0 THEN t", "WHEN d.doc_id % 2 = 0 AND t <> '' THEN t"))
def publication_details(spark, sf_dir):
    """The page of each publication, with the edition's reason if it is a signal: its detail, its card, or one made of its fields."""
    n = lambda k: F.pmod("doc_id", F.lit(k))
    items = _docs(spark, sf_dir).select(
        F.col("doc_id"), F.concat(F.lit("d"), "doc_id").alias("id"), F.when(n(3) == 0, F.concat(F.lit("# T\n"), "t")).alias("detail_markdown"), F.when(n(3) == 1, F.concat(F.lit("## C\n"), "t")).otherwise("").alias("card_body"), F.when(n(2) == 0, F.col("t")).otherwise("").alias("description"),
        F.when(n(5) == 0, "").otherwise("Título").alias("official_title"), F.lit("").alias("summary"), F.concat(F.lit("https://x.mx/"), "doc_id").alias("url"),
    )
    made = _table(spark, sf_dir, "labels").select(F.array(F.struct(F.concat(F.lit("d"), "doc_id").alias("id"), F.concat(F.lit("Motivo "), "quality").alias("why_it_matters"))).alias("signals"))
    return daily.details(items, made).select("doc_id", F.col("why_it_matters").alias("why"), F.md5("page").alias("page"))


@_query(" UNION ALL ".join(f"SELECT '{q}' AS query, doc_id FROM (SELECT doc_id, {_FOLD.format('text')} || ' ' || lang || ' ' || source AS f FROM documents) WHERE contains(f, '{q}')" for q in ("ouer", "cion. e", "zz", "license")))
def search_indexed(spark, sf_dir):
    """Four substring searches by the trigram index, which was made of two halves and merged: the rows of a scan."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.array("lang", "source").alias("categories"), F.col("text").alias("summary"))
    parity = F.pmod("doc_id", F.lit(2))
    index = search_index.merge(search_index.build(docs.filter(parity == 0), "doc_id"), search_index.build(docs.filter(parity == 1), "doc_id"))
    out = None
    for query, asked in (("ouer", "Ouér"), ("cion. e", "ción.  É"), ("zz", "ZZ"), ("license", "LICENSE")):
        rows = search_index.search(docs, index, "doc_id", asked).select(F.lit(query).alias("query"), "doc_id")
        out = rows if out is None else out.union(rows)
    return out
