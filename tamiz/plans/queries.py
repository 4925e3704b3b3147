"""Registered queries over the given tables, with DuckDB SQL for each that SQL can express.

The tables hold invented prose, so term queries take a proxy dictionary whose words occur there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamiz.functions import dates, text
from tamiz.operators import archive, calendars, classify, dedup, edition, editorial, snapshot, taxonomy, terms, validate
from tamiz.plans import vocabulary as V

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PROXY = classify.Dictionary({"Articles": ("the", "las", "les"), "Links": ("with", "für", "of the"), "Legal": ("license", "version 3", "rights reserved", "cc by-nc")}, ("license", "apache license"), ("src1", "src2"), procedural=False)
BODIES = (("First body", "a", "FB", ("apache", "mit license")), ("Second body", "b", "SB", ("license",)), ("Third body", "c", "TB", ("the", "las")))

_FOLD = "strip_accents(lower(trim(regexp_replace(coalesce({0}, ''), '\\s+', ' ', 'g'))))"
_PAD = "(' ' || regexp_replace(" + _FOLD + ", '([^\\p{{L}}\\p{{N}}_\\s])', ' \\1 ', 'g') || ' ')"


def _hit(term: str, pad: str = "p", folded: str = "f") -> str:
    return f"contains({pad}, ' {term} ')" if term.replace(" ", "").isalnum() else f"contains({folded}, '{term}')"


def _hits(names) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {_hit(t)} THEN '{t}' END" for t in names) + "], lambda x: x IS NOT NULL)"


_PADDED = f"SELECT doc_id, source, {_FOLD.format('text')} AS f, {_PAD.format('text')} AS p FROM documents"


def _notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as candidate notices."""
    return _table(spark, sf_dir, "documents").select("doc_id", "source", F.lit("").alias("official_title"), F.col("text").alias("description"), F.lit("").alias("document_type"), F.lit("").alias("authority"))


@_query("""
WITH RECURSIVE o AS (
  SELECT CAST(o_orderdate AS DATE) AS d, 'orders:' || o_orderkey AS id, CAST(c_nationkey AS VARCHAR) AS b, c_mktsegment AS c,
    row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY 6 - CAST(left(o_orderpriority, 1) AS INT) DESC, CAST(floor(o_totalprice / 50000) AS INT) DESC, 'orders:' || o_orderkey) AS rn
  FROM orders JOIN customer ON o_custkey = c_custkey
), w AS (
  SELECT d, rn, [id] AS ids, [b] AS bs, [c] AS cs FROM o WHERE rn = 1
  UNION ALL
  SELECT d, rn, CASE WHEN k THEN list_append(ids, id) ELSE ids END, CASE WHEN k THEN list_append(bs, b) ELSE bs END, CASE WHEN k THEN list_append(cs, c) ELSE cs END
  FROM (
    SELECT o.d, o.rn, o.id, o.b, o.c, w.ids, w.bs, w.cs, len(w.ids) < 7 AND len(list_filter(w.bs, lambda x: x = o.b)) < 2 AND len(list_filter(w.cs, lambda x: x = o.c)) < 2 AS k
    FROM w JOIN o ON o.d = w.d AND o.rn = w.rn + 1
  )
), l AS (SELECT d, arg_max(ids, rn) AS p1 FROM w GROUP BY d),
r AS (SELECT o.d, o.id, coalesce(list_position(l.p1, o.id), 1000000 + o.rn) AS k FROM o JOIN l ON o.d = l.d),
x AS (SELECT d, id, row_number() OVER (PARTITION BY d ORDER BY k) AS rank FROM r)
SELECT strftime(d, '%Y-%m-%d') AS edition_date, CAST(rank AS INT) AS rank, id FROM x WHERE rank <= 7
""")
def edition_top7(spark, sf_dir):
    """Per day, the seven best orders of which no nation and no segment has more than two in the first pass."""
    orders, customers = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    items = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.to_date("o_orderdate").alias("day"), F.concat(F.lit("orders:"), F.col("o_orderkey")).alias("id"), (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("importance"),
        F.floor(F.col("o_totalprice") / 50000).cast("int").alias("relevance_score"), F.col("c_nationkey").cast("string").alias("body"), F.col("c_mktsegment").alias("category"),
    )
    out = edition.select_diverse(items, "day", body=F.col("body"), category=F.col("category"))
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("edition_date"), "rank", "id")


@_query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, min(event_id) AS first_event FROM events GROUP BY user_id")
def dedup_latest_by_id(spark, sf_dir):
    """Per user, the last event's values."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", "value", F.struct("ts", "event_id").alias("place"), "event_id")
    last = dedup.last_by_key(events.select("user_id", "event_type", "value", "place"), "user_id", "place")
    first = dedup.first_by_key(events.select("user_id", F.col("event_id").alias("first_event")), "user_id", "first_event")
    return last.select("user_id", "event_type", "value").join(first, "user_id")


@_query(f"SELECT doc_id, first AS position FROM (SELECT doc_id, row_number() OVER (PARTITION BY source, k ORDER BY length(text) DESC, doc_id) AS r, min(doc_id) OVER (PARTITION BY source, k) AS first FROM (SELECT *, {_FOLD.format('text')} AS k FROM documents)) WHERE r = 1")
def dedup_longest_text(spark, sf_dir):
    """Per source and folded text, the longest text (signs and spaces differ); it takes the place of the group's first."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text", F.col("doc_id").alias("ordinal"))
    out = dedup.keep_longest(docs, [F.col("source"), text.fold(F.col("text"))], "text", "ordinal")
    return out.select("doc_id", F.col("ordinal").alias("position"))


@_query(f"WITH d AS ({_PADDED}) SELECT doc_id, array_to_string({_hits([t for ts in PROXY.categories.values() for t in ts])}, '|') AS terms FROM d")
def term_match(spark, sf_dir):
    """Which terms of the dictionary occur in each text, in its order."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", text.fold(F.col("text")).alias("f"))
    docs = docs.withColumn("p", terms.pad(F.col("f")))
    return docs.select("doc_id", F.array_join(terms.matches(F.col("p"), F.col("f"), [t for ts in PROXY.categories.values() for t in ts]), "|").alias("terms"))


_CLASSIFIED = (
    f"SELECT doc_id, array_to_string(list_filter([{', '.join(f'CASE WHEN len({_hits(ts)}) > 0 THEN {chr(39)}{n}{chr(39)} END' for n, ts in PROXY.categories.items())}], lambda x: x IS NOT NULL), '|') AS categories, "
    f"CAST(least(4, {' + '.join(f'len({_hits(ts)})' for ts in PROXY.categories.values())}) + len({_hits(PROXY.high_value)}) + CAST(source IN ('src1', 'src2') AS INT) AS INT) AS relevance_score FROM ({_PADDED})"
)


@_query(_CLASSIFIED)
def classify_score(spark, sf_dir):
    """Categories and score of each document."""
    return classify.classify(_notices(spark, sf_dir), PROXY).select("doc_id", F.array_join("categories", "|").alias("categories"), "relevance_score")


@_query(f"SELECT doc_id, relevance_score FROM ({_CLASSIFIED}) WHERE categories <> '' AND relevance_score >= 2")
def relevant_docs(spark, sf_dir):
    """Documents that pass the relevance filter."""
    return classify.classify(_notices(spark, sf_dir), PROXY).filter(classify.relevant(2)).select("doc_id", "relevance_score")


@_query()
def classify_domain(spark, sf_dir):
    """The domain's own dictionaries, with appointments and contentious matters, over all documents."""
    out = classify.classify(_notices(spark, sf_dir))
    return out.select("doc_id", F.array_join("categories", "|").alias("categories"), F.array_join("matched_terms", "|").alias("matched_terms"), "relevance_score")


@_query(f"WITH d AS ({_PADDED}) SELECT doc_id, CASE WHEN {_hit('apache')} OR {_hit('mit license')} THEN 'FB' WHEN {_hit('license')} THEN 'SB' WHEN {_hit('the')} OR {_hit('las')} THEN 'TB' ELSE 'none' END AS body FROM d")
def organ_first_match(spark, sf_dir):
    """The first body of an ordered alias table that a text names."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", terms.pad(text.fold(F.col("text"))).alias("p"))
    return docs.select("doc_id", F.coalesce(terms.first_match(F.col("p"), [b[:3] for b in BODIES], [b[3] for b in BODIES])["c2"], F.lit("none")).alias("body"))


@_query("SELECT importance, count(*) AS n FROM (SELECT CASE WHEN s >= 8 THEN 5 WHEN s >= 6 THEN 4 WHEN s >= 4 THEN 3 WHEN s >= 2 THEN 2 ELSE 1 END AS importance FROM (SELECT floor(o_totalprice / 50000) AS s FROM orders)) GROUP BY importance")
def importance_bucket(spark, sf_dir):
    """Orders by the importance of a score."""
    score = F.floor(F.col("o_totalprice") / 50000)
    return _table(spark, sf_dir, "orders").groupBy(taxonomy.importance(score).alias("importance")).agg(F.count("*").alias("n"))


_W = "list_filter(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' '), lambda x: x <> '')"


@_query(f"SELECT doc_id, CAST(len({_W}) AS INT) AS words FROM documents")
def word_count(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.size(text.words(F.col("text"))).alias("words"))


_CYCLE = [w for k in range(4) for w in V.FILLERS[k % 3].split()]
_ENDS = [sum(len(V.FILLERS[k % 3].split()) for k in range(n)) for n in range(1, 5)]


@_query(
    "SELECT doc_id, rtrim(array_to_string(list_concat(w, [" + ", ".join(f"'{x}'" for x in _CYCLE) + "])[1 : least(80, CASE WHEN len(w) >= 40 THEN len(w) "
    + " ".join(f"WHEN len(w) + {e} >= 40 THEN len(w) + {e}" for e in _ENDS) + f" END)], ' '), ' .,;:') || '.' AS summary FROM (SELECT doc_id, {_W} AS w FROM documents)"
)
def bounded_summary(spark, sf_dir):
    """40 to 80 words of each text."""
    return _table(spark, sf_dir, "documents").select("doc_id", text.bounded_summary(F.col("text")).alias("summary"))


@_query(f"SELECT doc_id, CASE WHEN t = '' THEN 'Actualización regulatoria' ELSE upper(left(t, 1)) || substr(t, 2) END AS title FROM (SELECT doc_id, trim(array_to_string(({_W})[1:12], ' '), ' .,:;-') AS t FROM documents)")
def concise_title(spark, sf_dir):
    """The first twelve words of each text as a title."""
    return _table(spark, sf_dir, "documents").select("doc_id", text.concise_title(F.col("text")).alias("title"))


@_query(f"SELECT doc_id, {_FOLD.format('text')} AS folded FROM documents")
def fold_text(spark, sf_dir):
    """Each text in lower case without diacritics."""
    return _table(spark, sf_dir, "documents").select("doc_id", text.fold(F.col("text")).alias("folded"))


@_query("SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) FILTER (WHERE event_type <> 'error') AS ok, count(*) FILTER (WHERE event_type = 'error') AS failed, CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 'partial' ELSE 'complete' END AS state FROM events GROUP BY CAST(ts AS DATE)")
def coverage(spark, sf_dir):
    """Events by day as source statuses."""
    events = _table(spark, sf_dir, "events").select(F.to_date("ts").alias("d"), F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"), F.col("user_id").cast("string").alias("source"), F.col("event_id").alias("ordinal"))
    out = edition.coverage(events, "d")
    return out.select(F.date_format("d", "yyyy-MM-dd").alias("day"), "ok", F.size("failed").cast("long").alias("failed"), "state")


@_query("SELECT DISTINCT source AS value FROM documents WHERE source <> ''")
def facet_values(spark, sf_dir):
    return archive.facet(_table(spark, sf_dir, "documents"), "source")


def _publications(spark, sf_dir):
    """Documents as publications: a day from the id, the language as jurisdiction."""
    return _table(spark, sf_dir, "documents").select(
        "doc_id", F.col("doc_id").alias("ordinal"), F.expr("date_add(DATE'2026-06-01', cast(pmod(doc_id, 31) as int))").alias("published_at"), "source", F.col("lang").alias("jurisdiction"),
        F.array("lang", "source").alias("categories"), F.col("text").alias("summary"), F.pmod("doc_id", F.lit(5)).cast("int").alias("importance"), F.col("n_chars").cast("int").alias("relevance_score"),
    )


@_query("SELECT doc_id FROM documents WHERE lang = 'fr' AND source = 'src3'")
def facet_filter(spark, sf_dir):
    return archive.select(_publications(spark, sf_dir), archive.ArchiveQuery(category="fr", source="src3")).select("doc_id")


@_query(f"SELECT doc_id FROM documents WHERE contains({_FOLD.format('text')} || ' ' || lang || ' ' || source, 'ouer')")
def search(spark, sf_dir):
    """Folded substring search."""
    return archive.select(_publications(spark, sf_dir), archive.ArchiveQuery(text="Ouér")).select("doc_id")


@_query("SELECT doc_id FROM documents WHERE (SELECT max(doc_id % 31) FROM documents) - doc_id % 31 BETWEEN 0 AND 6")
def period_anchor(spark, sf_dir):
    """Seven days back from the newest publication."""
    return archive.select(_publications(spark, sf_dir), archive.ArchiveQuery(days=7)).select("doc_id")


@_query("SELECT doc_id FROM documents WHERE lang = 'en' ORDER BY doc_id % 5 DESC, doc_id % 31 DESC, doc_id LIMIT 25 OFFSET 50")
def page(spark, sf_dir):
    """The third page by importance."""
    rows, _, _ = archive.page(_publications(spark, sf_dir), archive.ArchiveQuery(category="en", order="importance", page=3))
    return rows.select("doc_id")


@_query("""
WITH c AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY user_id),
p AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS status FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY user_id)
SELECT c.user_id AS key, c.status FROM c LEFT JOIN p USING (user_id) WHERE p.user_id IS NULL OR c.status IS DISTINCT FROM p.status
""")
def snapshot_diff(spark, sf_dir):
    """Users whose last event type is not what it was on January 16."""
    events = _table(spark, sf_dir, "events")
    state = lambda df: df.groupBy(F.col("user_id").alias("key")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"))
    return snapshot.changes(state(events), state(events.filter("ts < TIMESTAMP'2024-01-16'"))).select("key", "status")


@_query("SELECT user_id AS id, strftime(min(CAST(ts AS DATE)), '%Y-%m-%d') AS first_seen, strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') AS last_seen, arg_max(event_type, (ts, event_id)) AS payload FROM events GROUP BY user_id")
def upsert_history(spark, sf_dir):
    """Days of events as runs: what the history holds after them."""
    events = _table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "ts", "event_id", F.col("event_type").alias("payload"))
    runs = events.withColumn("run", F.struct("ts", "event_id")).drop("ts", "event_id")
    out = dedup.fold_runs(runs, "id", "run")
    day = lambda c: F.date_format(F.col(c)["ts"], "yyyy-MM-dd")
    return out.select("id", day("first_seen_run").alias("first_seen"), day("last_seen_run").alias("last_seen"), "payload")


_EXCEPTIONS = "SELECT DISTINCT n_name AS organ, DATE '2026-01-01' + CAST(o_orderkey % 365 AS INT) AS day FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'"
_DAYS = f"SELECT n.n_name AS organ, d.day, CASE WHEN x.day IS NOT NULL THEN 'inhabil' WHEN isodow(d.day) >= 6 THEN 'fin_semana' ELSE 'habil' END AS status FROM nation n CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '2026-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS day) d LEFT JOIN ({_EXCEPTIONS}) x ON x.organ = n.n_name AND x.day = d.day"


def _calendar(spark, sf_dir):
    orders, customers, nations = (_table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    hit = orders.filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'").join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    exceptions = hit.select(F.col("n_name").alias("organ"), F.expr("date_add(DATE'2026-01-01', cast(o_orderkey % 365 as int))").alias("day"), F.lit("inhabil").alias("status"), F.lit("orden").alias("reason")).distinct()
    return calendars.resolve(nations.select(F.col("n_name").alias("organ")), exceptions, F.expr("DATE'2026-01-01'"), F.expr("DATE'2026-12-31'"))


@_query(f"SELECT organ, strftime(day, '%Y-%m-%d') AS day, status FROM ({_DAYS})")
def calendar_days(spark, sf_dir):
    """Every day of a year for each nation; the days off are derived from orders."""
    return _calendar(spark, sf_dir).select("organ", F.date_format("day", "yyyy-MM-dd").alias("day"), "status")


@_query(f"SELECT organ, count(*) FILTER (WHERE status = 'habil') AS working_days FROM ({_DAYS}) GROUP BY organ")
def working_days(spark, sf_dir):
    return calendars.working_days(_calendar(spark, sf_dir))


@_query("SELECT event_id, strftime(ts - INTERVAL 6 HOUR, '%Y-%m-%d') AS day FROM events")
def edition_day_tz(spark, sf_dir):
    """The local day in Mexico City of each event's UTC stamp."""
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return _table(spark, sf_dir, "events").select("event_id", F.date_format(dates.edition_date(stamp), "yyyy-MM-dd").alias("day"))


@_query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM conversations")
def fill_forward(spark, sf_dir):
    """Each turn with the last user turn (as its hash) before it."""
    turns = _table(spark, sf_dir, "conversations")
    return dedup.fill_forward(turns, "conv_id", "turn", F.when(F.col("role") == "user", F.md5("text")), "carried").select("conv_id", "turn", "carried")


@_query("SELECT page_id, p, lk AS href FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS lk, unnest(range(len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)))) AS p FROM pages)")
def page_links(spark, sf_dir):
    """All links of each page in order."""
    found = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    return _table(spark, sf_dir, "pages").select("page_id", F.posexplode(found).alias("p", "href")).select("page_id", F.col("p").cast("long").alias("p"), "href")


@_query("SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, coalesce(nullif(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), ''), '') AS path, left(sha256(url), 16) AS source_id FROM pages")
def url_parts(spark, sf_dir):
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select("page_id", F.try_parse_url(url, F.lit("HOST")).alias("host"), F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")).alias("path"), text.short_hash(url).alias("source_id"))


@_query("SELECT doc_id, r AS day FROM (SELECT doc_id, strftime(make_date(2026, CAST(doc_id % 12 + 1 AS INT), CAST(doc_id % 28 + 1 AS INT)), '%Y-%m-%d') AS r FROM documents)")
def parse_dates(spark, sf_dir):
    """The same days written in four forms, read back."""
    day, month = (F.pmod("doc_id", F.lit(28)) + 1), (F.pmod("doc_id", F.lit(12)) + 1).cast("int")
    name = F.get(F.array(*map(F.lit, V.MONTHS)), month - 1)
    written = F.when(F.pmod("doc_id", F.lit(4)) == 0, F.concat_ws("/", day, month, F.lit("2026"))).when(F.pmod("doc_id", F.lit(4)) == 1, F.concat_ws(".", day, month, F.lit("2026"))).when(F.pmod("doc_id", F.lit(4)) == 2, F.concat_ws("-", F.lit("2026"), month, day)).otherwise(F.concat(F.lit("lunes "), day.cast("string"), F.lit(" de "), name, F.lit(" de 2026")))
    return _table(spark, sf_dir, "documents").select("doc_id", F.date_format(dates.parse_date(written), "yyyy-MM-dd").alias("day"))


@_query("SELECT d.doc_id, coalesce(l.quality, 9) AS quality, l.doc_id IS NOT NULL AS edited FROM documents d LEFT JOIN labels l USING (doc_id)")
def apply_patch(spark, sf_dir):
    """Labels as edits over documents."""
    items = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit(9).alias("quality"), F.lit(False).alias("edited"))
    edits = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    return editorial.patch(items, edits, ("quality",), "edited").select(F.col("id").alias("doc_id"), "quality", "edited")


@_query("""
SELECT path, code FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS path, 'customer_unknown' AS code FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'urgent_but_cheap' FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice < 5000
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'status_domain' FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
)
""")
def validate_orders(spark, sf_dir):
    """Violations of row rules and of a reference."""
    orders = _table(spark, sf_dir, "orders")
    path = F.col("o_orderkey").cast("string")
    rows = validate.check(orders, path, {"urgent_but_cheap": (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") < 5000), "status_domain": ~F.col("o_orderstatus").isin("F", "O")})
    lost = orders.join(_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select(path.alias("path"), F.lit("customer_unknown").alias("code"))
    return rows.select("path", "code").unionByName(lost)


@_query("SELECT event_id, row_number() OVER (ORDER BY CAST(ts AS DATE) DESC, value DESC, user_id DESC, event_id) AS place FROM events QUALIFY place <= 100")
def publication_order(spark, sf_dir):
    """The first hundred events in the order of publications: ties keep their place."""
    events = _table(spark, sf_dir, "events").select(F.to_date("ts").alias("published_at"), F.col("value").alias("relevance_score"), F.col("user_id").alias("source"), F.col("event_id").alias("ordinal"), "event_id")
    top = events.orderBy(*dedup.publication_order()).limit(100)  # a top-k report
    return top.select("event_id", F.row_number().over(Window.orderBy(*dedup.publication_order())).cast("long").alias("place"))
