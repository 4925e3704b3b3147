"""Archives that stop, JSON patches, bucketed history, editions of many days, archive addresses and markdown blocks."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tamiz.functions import markdown
from tamiz.operators import archive, dedup, editorial, taxonomy, validate
from tamiz.plans import commands
from tamiz.sources import artifacts, pages

DAY = dt.date(2026, 7, 7)


def test_archives_stop_at_the_first_bad_page(spark):
    day = lambda n: dt.date(2026, 7, n)
    fetched = [("a", 1, True), ("a", 2, False), ("a", 3, True), ("b", 1, True), ("b", 2, True), ("b", 3, True), ("c", 2, True), ("d", 1, True), ("d", 3, True), ("e", 1, True), ("e", 2, True), ("f", 1, None)]
    items = [("a", 1, 9), ("a", 3, 9), ("b", 1, 9), ("b", 2, 9), ("b", 2, 1), ("b", 3, 9), ("c", 2, 9), ("d", 1, 9), ("d", 3, 9), ("e", 2, 9), ("f", 1, 9)]
    got = pages.until_stop(
        spark.createDataFrame([(p, "prensa", n, ok) for p, n, ok in fetched], "portal string, kind string, page int, ok boolean"),
        spark.createDataFrame([(p, "prensa", n, day(d)) for p, n, d in items], "portal string, kind string, page int, published_at date"),
        F.lit(day(5)),
    )
    # a stops at its failed page, b at its old one (whose newer item counts), c has no first page, d a gap, e an empty first page.
    assert sorted((r.portal, r.page, r.published_at.day) for r in got.collect()) == [("a", 1, 9), ("b", 1, 9), ("b", 2, 9), ("d", 1, 9)]


def test_patches_keep_what_no_schema_names(spark):
    history = spark.createDataFrame([("1", '{"id":"1","title":"a","extra":{"x":[1,null,{"y":"ñ"}]},"note":null,"n":12345678901234567890}', 3), ("2", '{"title":"b"}', 4), ("3", "no JSON", 5), ("4", "[1]", 6), ("5", None, 7)], "id string, payload string, run int")
    edits = spark.createDataFrame([("1", "nuevo", None, True), ("3", "x", 1, None), ("4", "x", 1, None), ("5", "x", 1, None)], "id string, title string, importance int, ok boolean")
    got = {r.id: (r.payload, r.run) for r in editorial.patch_payloads(history, edits).collect()}
    assert json.loads(got["1"][0]) == {"id": "1", "title": "nuevo", "extra": {"x": [1, None, {"y": "ñ"}]}, "note": None, "n": 12345678901234567890, "ok": True}
    assert {k: v for k, v in got.items() if k != "1"} == {"2": ('{"title":"b"}', 4), "3": ("no JSON", 5), "4": ("[1]", 6), "5": (None, 7)}


def test_history_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "documents")
    rows = lambda ids, text: spark.createDataFrame([(str(i), DAY, text) for i in ids], "id string, published_at date, payload string")
    files = lambda: {d: {f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")} for d in os.listdir(path) if d.startswith("bucket=")}

    def save(batch, run):
        history = artifacts.read_buckets(spark, path, artifacts.touched(batch))
        if history is None:
            history = batch.limit(0).withColumns({"first_seen_run": F.lit(0), "last_seen_run": F.lit(0)})
        artifacts.replace_buckets(dedup.upsert(history, batch, F.lit(run)), batch, path)

    save(rows(range(200), "eins"), 1)
    before = files()
    save(rows([3, 500], "zwei"), 2)
    after = files()
    touched = {f"bucket={b}" for b in artifacts.touched(rows([3, 500], ""))}
    assert len(touched) in (1, 2) and {d for d in after if before.get(d) != after[d]} == touched
    got = {r.id: (r.payload, r.first_seen_run, r.last_seen_run) for r in artifacts.read_buckets(spark, path).collect()}
    assert len(got) == 201 and got["3"] == ("zwei", 1, 2) and got["500"] == ("zwei", 2, 2) and got["4"] == ("eins", 1, 1)
    one = artifacts.read_buckets(spark, path, artifacts.touched(rows([3], "")))
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString() and not os.path.exists(f"{path}.staged")


def test_editions_of_several_cuts(spark):
    reason = "uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece"
    signal = "array<struct<rank:int,id:string,why_it_matters:string>>"
    row = lambda cut, **k: tuple({"cut": cut, "day": DAY, "state": "ready", "total": 1, "last": DAY, "coverage": ("complete", 1, []), "lead": "a", "signals": [(1, "a", reason)]} .__or__(k).values())
    claimed = [row(1), row(2, total=None, last=None, coverage=None, signals=None), row(3, state="empty"), row(4, state="otro", signals=[(1, "a", ""), (2, "a", "Oficio 500-05-2026 " + reason), (None, "b", reason)]), row(6, coverage=("partial", 0, ["s"])), row(7), row(7)]
    editions = spark.createDataFrame(claimed, f"cut int, edition_date date, state string, total_today int, last_available_date date, coverage struct<state:string,ok:int,failed:array<string>>, lead_id string, signals {signal}")
    items = spark.createDataFrame([(c, "a", DAY) for c in range(1, 8)] + [(4, "b", dt.date(2026, 7, 6))], "cut int, id string, published_at date")
    statuses = spark.createDataFrame([(c, "s", "error" if c == 6 else "ok", 0) for c in range(1, 8)], "cut int, source string, status string, ordinal int")
    got = {}
    for r in validate.editions(editions, items, statuses).collect():
        got.setdefault(r.cut, set()).add((r.path, r.code))
    head = lambda *codes: {("edition", c) for c in codes}
    assert got == {
        2: head("signals_missing", "total_wrong", "last_date_wrong", "coverage_ok_wrong", "coverage_failed_wrong", "coverage_state_wrong", "ready_without_signals", "lead_wrong"),
        3: head("empty_with_items", "empty_with_signals", "empty_with_lead"),
        4: head("state_domain", "signal_repeated", "ranks_not_contiguous") | {("a", "reason_missing"), ("a", "reason_act_number"), ("b", "signal_of_other_day"), ("b", "rank_missing")},
        5: head("edition_missing"), 7: head("edition_repeated"),
    }


def test_archive_addresses(spark):
    cases = {
        "https://x.mx/a.html": ("", 1.0, ""), "?q=a+b&q=c": ("a b", 1.0, "?q=a+b"), "?q=%F1%zz%c3%b1&pagina=0x10#x?q=no": ("�%zzñ", 16.0, "?q=%EF%BF%BD%25zz%C3%B1&pagina=16"), "?pagina=1e1&q=": ("", 10.0, "?pagina=10"),
        "?pagina=2.5": ("", 2.5, "?pagina=2.5"), "?pagina=-1&=x&&q": ("", 1.0, ""), "?q=a%3Db=c&pagina=dos": ("a=b=c", 1.0, "?q=a%3Db%3Dc"), None: ("", 1.0, ""),
    }
    df = spark.createDataFrame([(k,) for k in cases], "u string").select("u", archive.read_state(F.col("u")).alias("s"))
    got = {r.u: (r.s.query, r.s.page, r.w) for r in df.select("u", "s", archive.write_state(F.col("s")).alias("w")).collect()}
    assert got == cases


def test_markdown_blocks_and_parts(spark):
    page = "# Uno\n\n####### no\n\n- a\nx\n- b\n\n>c\n> d\n\n|A|B|\n| -- | :--: |\n|1|\n\n|A|\n|-|\n\n\n\n  texto\ncon **n* y  "
    got = spark.createDataFrame([(page,), (None,), (" \n\n ",)], "p string").select(markdown.blocks(F.col("p")).alias("b")).collect()
    assert [tuple(b) for b in got[0].b] == [("heading", 1, "Uno", []), ("paragraph", 0, "####### no", []), ("list", 0, None, [["a"], ["b"]]), ("quote", 0, "c\nd", []), ("table", 0, None, [["A", "B"], ["1"]]), ("paragraph", 0, "|A|\n|-|", []), ("paragraph", 0, "texto\ncon **n* y", [])]
    assert got[1].b == [] and got[2].b == []
    line = spark.createDataFrame([("a **b* [c](https://d/e)[f](g)",), ("",)], "p string").select(markdown.inline(F.col("p")).alias("x")).collect()
    assert [tuple(x) for x in line[0].x] == [("plain", "a ", None), ("strong", "b", None), ("plain", " ", None), ("link", "c", "https://d/e"), ("plain", "[f](g)", None)] and line[1].x == []


def test_reports_dates_and_inks(spark):
    dates = spark.createDataFrame([("2026-07-07",), ("2026-02-31T10:00",), ("hoy",), (None,)], "d string").select(markdown.display_date(F.col("d")).alias("a"), markdown.display_date(F.col("d"), True, False).alias("b")).collect()
    assert [tuple(r) for r in dates] == [("7 de julio de 2026", "7 jul"), ("3 de marzo de 2026", "3 mar"), ("—", "—"), ("—", "—")]
    inks = spark.createDataFrame([(["Fiscal", "Comercio exterior"], None, "9"), (None, "nacional", "x"), (["Penal"], "", "-1")], "c array<string>, j string, v string")
    assert [tuple(r) for r in inks.select(taxonomy.ink(F.col("c"), F.col("j")).alias("i"), taxonomy.importance_bars(F.col("v")).alias("b")).collect()] == [("#4f7f7c", 5.0), ("#54789b", 0.0), ("#a45b62", 0.0)]
    statuses = spark.createDataFrame([(0, "DOF", "ok", 3, 2, None), (1, None, "error", None, 1, None), (2, "X", "error", 0, 3, "Timeout")], "ordinal int, source string, status string, items_found int, attempts int, error string")
    assert [r.line for r in commands.status_lines(statuses).orderBy("ordinal").collect()] == ["Fuente DOF: 3 registros revisados, 2 intentos", "Fuente Fuente desconocida: error: sin detalle", "Fuente X: error, 3 intentos: Timeout"]
    found = spark.createDataFrame([("a", "c", "error"), ("b", "d", "warning")], "path string, code string, severity string")
    assert [r.line for r in commands.violation_lines(found).orderBy("rank").collect()] == ["Advertencia: b d", "Error: a c"]


def test_index_finds_what_a_scan_finds(spark):
    from tamiz.operators import search_index

    texts = ["Aviso sobre aranceles", "avisó", "ARANCEL común y cuota", None, "", "ab", "a" * 500, "cuota de acero"]
    df = spark.createDataFrame([(i + 32_766, t, ["x"]) for i, t in enumerate(texts)], "n long, summary string, categories array<string>")
    index = search_index.merge(search_index.build(df.filter("n < 32769"), "n"), search_index.build(df.filter("n >= 32769"), "n")).persist()
    assert {r.bucket for r in index.select("bucket").collect()} == {1, 2}
    for q in ("arancel", "AVISÓ", "cuota ", "ab", "aaa", "no está", "x", "común y"):
        scan = {r.n for r in archive.select(df, archive.ArchiveQuery(text=q)).collect()}
        assert {r.n for r in search_index.search(df, index, "n", q).collect()} == scan
    assert search_index.candidates(df, index, "n", "arancel").count() == 2 < df.count()


def _as_sql(spark, tmp_path, name, pages):
    """Rows of a query over these pages and of its SQL, each sorted."""
    import duckdb

    from tamiz.plans import page_queries

    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = duckdb.sql(page_queries.ORACLE_SQL[name])
    return sorted(map(repr, (tuple(r) for r in page_queries.QUERIES[name](spark, str(tmp_path)).select(want.columns).collect()))), sorted(map(repr, want.fetchall()))


_CUT = "<html><head><title>uno &amp;&amp;&amp</title></head><body><nav><ul><li><a href='/?a=1&b=2'>R&amp;D</a></li></ul></nav><article><h1>uno &amp;&amp;&amp</h1><p>A & B &copy; x &quot;y&quot; &amp;amp &ampz</p></article></body></html>"


def test_a_title_with_an_entity_cut_short(spark, tmp_path):
    got, want = _as_sql(spark, tmp_path, "page_title", [(1, "u", _CUT), (2, "u", "<title>&amp;lt; &lt &quot &#38 x</title>")])
    assert got == want and "uno &&&amp" in got[0]


def test_structure_of_a_page_with_an_entity_cut_short(spark, tmp_path):
    got, want = _as_sql(spark, tmp_path, "page_structure", [(1, "u", _CUT)])
    assert got == want


def test_details_of_each_page_of_one_address(spark, tmp_path):
    got, want = _as_sql(spark, tmp_path, "portal_details", [(k, f"u{k // 3}", _CUT) for k in range(8)])
    assert got == want and len(got) == 8


def test_blocks_of_empty_and_odd_texts_as_sql(spark, tmp_path):
    import duckdb

    from tamiz.plans import page_queries

    # Empty texts, and spaces and line ends that Java's patterns, Spark's trim and SQL take differently.
    odd = ["", " \n\t", *(f"{a}uno{b} > dos{c}" for s in "\v\f\r\x1c\x85\xa0\u2028\u2029\u3000\ufeff" for a, b, c in ((s, "", ""), ("", s, ""), ("", "", s), ("", "", f" {s}"))), "a > b", "|", "a| ", "#", "- "]
    spark.createDataFrame(list(enumerate([None, *odd])) + [(None, "sin clave")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, ""), (1, 1, None), (2, None, "b")], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'").fetchall()
    want = con.execute(page_queries.ORACLE_SQL["markdown_blocks"]).fetchall()
    got = page_queries.QUERIES["markdown_blocks"](spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want)) and len(got) == 6 * (len(odd) + 5)
