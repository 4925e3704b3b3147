import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from tamiz.functions import markup
from tamiz.sources import artifacts, notices, pages
from tamiz.streaming import status


def load(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "ordinal long, payload string")


def test_feed(spark):
    xml = """<rss><channel>
    <item><title>Uno</title><link>https://a/1</link><guid>g1</guid><description><![CDATA[<p>texto &amp; más</p>]]></description><pubDate>Tue, 07 Jul 2026 23:00:00 -0400</pubDate></item>
    <item><title>Malo & roto</title><link>https://a/2</link><pubDate>Tue, 07 Jul 2026 00:00:00 GMT</pubDate></item>
    <item><title></title><link>https://a/3</link><pubDate>Tue, 07 Jul 2026 00:00:00 GMT</pubDate></item>
    <item><a:title>Cuatro</a:title><link>ftp://a/4</link><pubDate>Tue, 07 Jul 2026 00:00:00 GMT</pubDate></item>
    <item><title>Viejo</title><link>https://a/5</link><pubDate>Tue, 07 Jul 2020 00:00:00 GMT</pubDate></item>
    <item><title>Trunco</title><link>https://a/6</link>"""
    rows = notices.feed(load(spark, xml), notices.FEEDS["wto"], F.lit(dt.date(2026, 1, 1))).collect()
    assert [(r.official_title, r.description, r.published_at) for r in rows] == [("Uno", "texto & más", dt.date(2026, 7, 7))]


def test_gazette(spark):
    item = "<item><title>SECRETARIA DE HACIENDA</title><link>https://d/n.php?codigo=55&amp;fecha=07/07/2026</link><description>{0}</description>{1}</item>"
    xml = "<rss>" + item.format("ACUERDO General 12/2026 por el que", "<valueDate>06/07/2026</valueDate>") + item.format("Acuerdo Mediante el cual", "") + "</rss>"
    a, b = notices.gazette(load(spark, xml)).collect()
    assert (a.source_id, a.published_at, a.document_type, a.authority) == ("55", dt.date(2026, 7, 6), "Acuerdo General", "SECRETARIA DE HACIENDA")
    assert a.official_title == a.description == "ACUERDO General 12/2026 por el que"
    assert (b.published_at, b.document_type) == (dt.date(2026, 7, 7), "Acuerdo")


def test_document_types(spark):
    cases = {"FISCALIA GENERAL DE LA REPUBLICA.- Convocatoria": "Fiscalia General", "Proy-nom 001 x": "Proy-Nom", "Instituto Mexicano, de.": "Instituto Mexicano,", "de la que": "", "o'higgins bis": "O'Higgins Bis", "": ""}
    df = spark.createDataFrame([(x,) for x in cases], "x string").select("x", notices.document_type(F.col("x")).alias("y"))
    assert {r.x: r.y for r in df.collect()} == cases


def test_addresses(spark):
    cases = {"#x": "https://a.mx#x", "../b/c": "https://a.mx/b/c", "/d": "https://a.mx/d", "//e.mx/f": "https://e.mx/f", "mailto:g": "mailto:g", "HTTP://h": "HTTP://h", "?i=1": "https://a.mx?i=1", "j": "https://a.mx/j"}
    df = spark.createDataFrame([(x,) for x in cases], "x string").select("x", notices.absolute(F.col("x"), "https://a.mx").alias("y"))
    assert {r.x: r.y for r in df.collect()} == cases


def test_script_strings(spark):
    cases = {r'''append("a\u00f3\n<\/b> \"q\" \\n")''': 'aó\n</b> "q" \\n', r"""append('d\'e \u00f3 "x" \\t')""": """d'e ó "x" \\t""", r'''append("roto \x41")''': "roto x41", "append('')": ""}
    df = spark.createDataFrame([(x,) for x in cases], "x string").select("x", pages.script_string(F.col("x")).alias("y"))
    assert {r.x: r.y for r in df.collect()} == cases


def test_json_sources(spark):
    senate = json.dumps({"data": [{"fecha_documento": "2026-07-07", "titulo_docuemnto": "T", "tema_documento": "", "link_documento": "https://s/1", "tipo_documento": "Iniciativa"}, {"tipo_documento": "Otro", "fecha_documento": "2026-07-07", "titulo_docuemnto": "U", "link_documento": "x"}]})
    assert [r.description for r in notices.senate(load(spark, senate)).collect()] == ["T"]
    bank = json.dumps({"documents": {"D1": {"id": "D1", "url": "https://w/1", "title": {"cdata!": "Título"}, "lnchdt": "2026-07-07T00:00:00Z"}, "facets": {}, "D2": {"id": "D2", "url": "https://w/2", "title": "Plano", "lnchdt": "2026-07-01T00:00:00Z"}}})
    assert {r.official_title for r in notices.world_bank(load(spark, bank)).collect()} == {"Título", "Plano"}
    cases = json.dumps({"data": {"GetAllCasesResult": [{"caseno": "ARB/1", "claimant": "A", "respondent": "México", "status": "Pending"}, {"caseno": "ARB/2", "claimant": "A", "respondent": "B", "status": "Pending"}]}})
    assert [r.key for r in notices.arbitration_cases(load(spark, cases)).collect()] == ["ARB/1"]
    blog = json.dumps([{"id": 7, "modified": "2026-07-07T10:00:00", "slug": "s", "link": "http://int/p/s/", "title": {"rendered": "Nota"}}])
    assert notices.wordpress(load(spark, blog)).first().url.endswith("/p/s/")


def test_html_sources(spark):
    row = "".join(f"<td>{x}</td>" for x in ["USA-MEX-1", *"bcdefg", "Active"])
    assert notices.panel_cases(load(spark, f"<table><tr><th>h</th></tr><tr>{row}</tr></table>")).first().status == "Active"
    html = '<li><a href="x.pdf">sin fecha</a></li><strong>Martes 7 de julio de 2026</strong><ul><li><a href="a.pdf">SS/1</a><br/>Guardia &amp; uno</li></ul><strong>Lunes 31 de junio de 2026</strong><li><a href="b.pdf">SS/2</a></li><strong>Lunes 8 de enro de 2026</strong><li><a href="c.pdf">SS/3</a></li>'
    rows = notices.court_listing(load(spark, html)).collect()
    assert [(r.official_title, r.published_at, r.url) for r in rows] == [("Acuerdo SS/1 del TFJA. Guardia & uno", dt.date(2026, 7, 7), "https://www.tfja.gob.mx/a.pdf")]
    sitemap = "".join(f"<loc>https://www.gob.mx/sitemap-{x}.xml</loc>" for x in ("shcp", "aprendemx", "shcp"))
    assert [r.portal for r in pages.portals(load(spark, sitemap)).collect()] == ["shcp"]
    assert pages.archive_requests(pages.portals(load(spark, sitemap))).count() == 2


def test_parliament(spark):
    html = """<title>Gaceta, martes 7 de julio de 2026</title><div id="Indice"><a class="Seccion">Iniciativas</a><ul><li><a href="gp.html#Iniciativa5">Que reforma la ley del impuesto sobre la renta</a></li><li><a href="#x">Corto</a></li></ul></div>
    <div id="Anexos"><p><a href="/PDF/66/2026/jul/20260707-II.pdf">Anexo II</a> Dictamen &amp; minuta</p><p><a href="/PDF/20261399-I.pdf">Anexo I</a> malo</p></div>"""
    r = pages.parliament_index(load(spark, html)).collect()
    assert [(x.url, x.document_type) for x in r] == [("https://gaceta.diputados.gob.mx/Gaceta/66/2026/jul/20260707.html#Iniciativa5", "Iniciativas")]
    a = pages.parliament_annexes(load(spark, html)).collect()
    assert [(x.description, x.published_at) for x in a] == [("Dictamen & minuta", dt.date(2026, 7, 7))]


def test_pages(spark):
    listing = "<ul><li>07/07/2026 <a href='/a'>Aviso sobre cupos de importacion</a></li><li>07.07.2026 <a href='/a'>Aviso sobre cupos de importacion otra vez</a></li><li><a href='/b'>Sin ninguna fecha en el contexto</a></li></ul>"
    assert [r.official_title for r in pages.dated_links(load(spark, listing)).collect()] == ["Aviso sobre cupos de importacion"]
    office = "<article><time datetime='2026-07-07'>x</time><a href='/n/1'><h3>Nueva patente</h3></a><p>Texto</p></article>"
    assert [(r.url, r.description) for r in pages.patent_office(load(spark, office)).collect()] == [("https://www.impi.gob.mx/n/1", "Texto")]


def test_portal_archive(spark):
    one = "<article><time date=\\'2026-07-07\\'></time><h2>Reforma al arancel</h2><a href=\\'/shcp/1\\'>x<\\/a></article>"
    two = one.replace("Reforma al arancel", "Visita a la escuela").replace("/1", "/2")
    df = spark.createDataFrame([(0, "shcp", "prensa", f'$("#a").append("{one}"); append("{two}")')], "ordinal long, portal string, kind string, payload string")
    items = pages.portal_archive(df)
    assert items.count() == 2
    kept = pages.portal_notices(items).collect()
    assert [(r.official_title, r.authority, r.document_type) for r in kept] == [("Reforma al arancel", "Secretaría de Hacienda y Crédito Público", "Comunicado")]


def test_artifacts(spark, tmp_path):
    path = str(tmp_path / "edition.json")
    artifacts.write_document(spark.range(1).select(F.lit("ñ").alias("a")), path)
    assert json.loads(open(path).read()) == {"a": "ñ"}
    assert artifacts.read_json(spark, path).first().a == "ñ"
    assert artifacts.read_snapshot(spark, str(tmp_path / "none")) is None
    artifacts.write_document(spark.range(1).select(F.lit("o").alias("a")), path)
    assert json.loads(open(path).read()) == {"a": "o"}
    artifacts.write_site(spark.range(1).select(F.lit(1).alias("p")), spark.range(1).select(F.lit(2).alias("e")), str(tmp_path / "p.json"), path)
    assert json.loads(open(path).read()) == {"e": 2} and json.loads(open(tmp_path / "p.json").read()) == {"p": 1}
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"PAR1 no")
    assert artifacts.read_snapshot(spark, str(tmp_path / "broken")) is None
    table = str(tmp_path / "t")
    artifacts.replace_table(spark.createDataFrame([("k", "s")], "key string, status string"), table)
    artifacts.replace_table(artifacts.read_snapshot(spark, table).withColumn("status", F.lit("t")), table)
    assert artifacts.read_snapshot(spark, table).first().status == "t"
    (tmp_path / "t").rename(tmp_path / "t.before")  # a swap that broke off
    assert artifacts.read_snapshot(spark, table).first().status == "t"


def streamed(spark, tmp_path, batches, **options):
    """All changes of batches of (key, status, ts, place) that come as one file each."""
    for n, part in enumerate(batches):
        out, file = tmp_path / f"w{n}", tmp_path / "in" / f"{n}.parquet"
        spark.createDataFrame(part, "key string, status string, ts timestamp, place long").coalesce(1).write.parquet(str(out))
        file.parent.mkdir(exist_ok=True)
        next(out.glob("*.parquet")).rename(file)
        os.utime(file, (1000 + n, 1000 + n))
    stream = spark.readStream.schema("key string, status string, ts timestamp, place long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = status.changes(stream, "10 minutes", **options).writeStream.format("memory").queryName("changes").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(200)
    return sorted(((r.key, r.previous, r.status, r.ts) for r in spark.sql("select * from changes where key <> 'end'").collect()), key=str)


def test_stream_of_statuses_equals_the_batch(spark, tmp_path):
    r = random.Random(3)
    day = dt.datetime(2026, 1, 1)
    # Rows come up to five minutes late; places order rows of one time.
    rows = [(f"k{r.randint(0, 5)}", r.choice("pcx"), day + dt.timedelta(minutes=i // 2), i) for i in range(120)]
    come = sorted(rows, key=lambda x: x[3] + r.randint(0, 10))
    got = streamed(spark, tmp_path, [come[:40], come[40:80], come[80:], [("end", "x", day + dt.timedelta(days=1), 999)]], closed=())
    last, want = {}, []
    for key, state, ts, _ in sorted(rows, key=lambda x: (x[2], x[3])):
        if last.get(key) != state:
            want.append((key, last.get(key), state, ts))
        last[key] = state
    assert got == sorted(want, key=str) and len(got) > 60


def test_closed_cases_leave_the_state(spark, tmp_path):
    day = lambda n: dt.datetime(2026, 1, n)
    batches = [[("a", "Concluded", day(1), 1), ("b", "p", day(1), 2)], [("end", "x", day(3), 3)], [("a", "Concluded", day(5), 4), ("b", "p", day(5), 5), ("b", "p", day(1), 6)], [("end", "y", day(9), 7)]]
    got = streamed(spark, tmp_path, batches, keep_days=1)
    assert got == [("a", None, "Concluded", day(1)), ("a", None, "Concluded", day(5)), ("b", None, "p", day(1))]


def test_structure_of_markup(spark):
    html = "<div class='a x'>t<p>one<p>two<br>three</div>four</b><script>no('<p>')</script><!-- <p>not</p> --><ul><li><a href=q>5 &amp; 6</a><li>7</ul>"
    df = spark.createDataFrame([(html,), (None,), ("",), ("<p>open <b>bold",), ("a < b &lt; c",)], "payload string").withColumn("doc", markup.outline("payload"))
    doc = F.col("doc")
    got = df.select(
        markup.text_of(doc).alias("all"), markup.text_of(doc, markup.first(doc, markup.classed("x"))).alias("x"), F.transform(markup.every(doc, markup.named("p")), lambda n: markup.text_of(doc, n)).alias("p"),
        markup.parent(doc, markup.first(doc, markup.named("a", has="href")))["tag"].alias("up"), markup.above(doc, markup.first(doc, markup.named("a")), markup.named("ul"))["tag"].alias("ul"), F.size(markup.every(doc, markup.named("li"), markup.first(doc, markup.named("ul")))).alias("n"),
    ).collect()
    assert tuple(got[0]) == ("t one two three four 5 & 6 7", "t one two three", ["one two three", "two three"], "li", "ul", 2)
    assert got[1]["all"] is None and tuple(got[2]) == ("", None, [], None, None, None)
    assert got[3]["p"] == ["open bold"] and got[4]["all"] == "a < b < c"


def test_links_and_articles_by_structure(spark):
    apart = "<div>07/07/2026 <span><a href='/a'>Aviso sobre cupos de importacion</a></span></div><p>07/07/2026 <a href='/b'>Aviso sobre <b>cupos de</b> importacion</a><div>x</div></p>"
    assert [r.url for r in pages.dated_links(load(spark, apart)).collect()] == ["https://www.snice.gob.mx/b"]
    nested = "<article><time datetime='2026-07-07'></time><h3><a href='/1'>Uno</a></h3><article><time datetime='2026-07-06'></time><a href='/2'><h4>Dos</h4></a></article><!-- </article> --><p>Texto</p></article><article><h3>Sin fecha</h3></article><article><time>2026-07-05</time><h3>Sin enlace</h3></article>"
    got = pages.patent_office(load(spark, nested)).orderBy("url").collect()
    assert [(r.url[-2:], r.official_title, r.description, r.published_at.day) for r in got] == [("/1", "Uno", "Texto", 7), ("/2", "Dos", "Dos", 6)]
    annex = "<div id='Anexos'><p>Antes <i><a href='/PDF/20260707-II.pdf'>Anexo II</a></i> dictamen</p><a href='/PDF/20260708-III.pdf'>Anexo III</a>: minuta</div>"
    assert [(r.description, r.published_at.day) for r in pages.parliament_annexes(load(spark, annex)).orderBy("url").collect()] == [("Antes Anexo II dictamen", 7), ("Antes Anexo II dictamen Anexo III : minuta", 8)]


def test_detail_pages(spark):
    page = lambda u, h: (u, h)
    rows = [
        page("whole", "<section class='x small'><div><p>SAT | 7 de julio | Boletín</p><p>otro</p></div></section><div class='article-body'><p>Texto &amp; <b>más</b></p><script>x</script></div>"),
        page("two", "<section class='small'><p>SAT | Boletín</p></section><div class='article-body-x'>no</div>"),
        page("blank", "<section class='small'><p> | x | </p></section><div class='article-body'></div>"),
        page("broken", "<div class='article-body'>abierto <section class='small'><p>SHCP|a|b|Aviso"),
        page("none", None),
        page("refused", "<![foo"),
    ]
    got = {r.url: tuple(r)[1:] for r in pages.detail_pages(spark.createDataFrame(rows, "url string, payload string")).collect()}
    assert got == {"whole": ("Texto & más", "SAT", "Boletín"), "two": (None, "SAT", None), "blank": ("", None, None), "broken": ("abierto SHCP|a|b|Aviso", "SHCP", "Aviso"), "none": (None,) * 3, "refused": got["refused"]}
    items = spark.createDataFrame([("shcp", u, f"Arancel {u}", dt.date(2026, 7, 7), "Comunicado", i) for i, u in enumerate(["whole", "two", "none"])], "portal string, url string, title string, published_at date, document_type string, ordinal long")
    kept = pages.portal_notices(items, pages.detail_pages(spark.createDataFrame(rows, "url string, payload string"))).orderBy("ordinal").collect()
    assert [(r.description, r.authority, r.document_type) for r in kept] == [("Texto & más", "SAT", "Boletín"), ("Arancel two", "SAT", "Comunicado"), ("Arancel none", "Secretaría de Hacienda y Crédito Público", "Comunicado")]


def test_feeds_of_the_same_payload_are_parsed_once(spark):
    xml = "<rss><item><title>20260630-200-x</title><link>https://f.org/1</link><description>d</description><pubDate>Tue, 07 Jul 2026 01:00:00 GMT</pubDate></item></rss>"
    got = notices.feeds(load(spark, xml), notices.FEEDS.values())
    assert sorted((r.source, r.authority) for r in got.collect()) == sorted((c.source, c.authority) for c in notices.FEEDS.values() if c.source != "CIJ")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("<item") == notices.feed(load(spark, xml), notices.FEEDS["wto"])._jdf.queryExecution().optimizedPlan().toString().count("<item")
