"""The registered queries of this subpackage, and SQL for those that SQL can express.

Each query applies its operator to the whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm import alignment, collocations, decontaminate, gif, jaccard, language, lines, packing, pseudo_likelihood, quality, suffixes, toxicity, urls
from tamiz.llm.shared import held_out, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    params = toxicity.Params()
    model = toxicity.session_model(spark, docs, table(spark, sf_dir, "labels"), params)
    return toxicity.score(docs, model, params, out="score").select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= params.threshold).cast("int").alias("predicted"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, its text without later occurrences of repeated three-line windows (lines of more than 16 words wrapped by content), n_lines, n_removed."""
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


_B, _W = r"[\x09-\x0D\x20]", r"[^\x09-\x0D\x20]"
OP2_SQL = rf"""
WITH t AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k
  FROM documents WHERE text IS NOT NULL
), x AS (
  SELECT doc_id, k, line, regexp_extract_all(line, '{_B}*{_W}+{_B}*') AS parts, regexp_extract_all(line, '{_W}+') AS words FROM t
), y AS (
  SELECT doc_id, k, unnest(parts) AS part, unnest(range(len(parts))) AS i, unnest([(('0x' || rpad(left(hex(encode(z)), 8), 8, '0'))::HUGEINT * 2654435761 + ('0x' || lpad(right(hex(encode(z)), 8), 8, '0'))::HUGEINT * 2246822519 + 97 * (len(hex(encode(z))) // 2)) % 4294967296 FOR z IN words]) AS h FROM x WHERE len(words) > 16
), z AS (
  SELECT doc_id, k, part, i, CASE WHEN h < coalesce(min(h) OVER (c ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), h + 1) AND h <= coalesce(min(h) OVER (c ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), h) THEN 1 ELSE 0 END AS cut
  FROM y WINDOW c AS (PARTITION BY doc_id, k ORDER BY i)
), v AS (
  SELECT doc_id, k, [line] AS parts FROM x WHERE len(words) <= 16
  UNION ALL SELECT doc_id, k, list(line ORDER BY j) FROM (
    SELECT doc_id, k, j, string_agg(part, '' ORDER BY i) AS line FROM (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id, k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS j FROM z) GROUP BY doc_id, k, j
  ) GROUP BY doc_id, k
), l AS (
  SELECT doc_id, k, line, row_number() OVER (PARTITION BY doc_id ORDER BY k, j) - 1 AS pos
  FROM (SELECT doc_id, k, unnest(parts) AS line, unnest(range(len(parts))) AS j FROM v)
), w AS (
  SELECT doc_id, pos, line || chr(10) || lead(line) OVER d || chr(10) || lead(line, 2) OVER d AS g
  FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) AS r FROM w WHERE g IS NOT NULL) WHERE r > 1
), cut AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM later, (SELECT unnest(range(3)) AS k)
), part AS (
  SELECT l.doc_id, l.k, string_agg(l.line, '' ORDER BY l.pos) FILTER (WHERE c.pos IS NULL) AS line, count(*) AS n_lines, count(c.pos) AS n_removed
  FROM l LEFT JOIN cut c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id, l.k
), kept AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY k), '') AS text, sum(n_lines)::BIGINT AS n_lines, sum(n_removed)::BIGINT AS n_removed FROM part GROUP BY doc_id
)
SELECT d.doc_id, k.text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, ~held_out("doc_id"))
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op4_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its text stored as a GIF and read back, and digests of both."""
    return gif.stored(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, log_likelihood, mean_log_likelihood."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudo_likelihood.score(docs, pseudo_likelihood.fit(docs))


def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, text_score, meta_score, score, predicted (1: good)."""
    out = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "text_score", "meta_score", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _md5_number(text):
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its URL's verdict as of its fetch time. The tables hold no list and no times, so a dated list is derived
    from the pages' hosts (blocked, later allowed; one path blocked), and times from the page ids."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.expr("timestamp_seconds(1704067200 + pmod(page_id, 365) * 86400)"))
    hosts = pages.select(urls.host(F.col("url")).alias("h")).filter("h is not null").distinct()
    day = lambda text, most: _md5_number(text) % most
    start = day(F.col("h"), 180)
    rules = F.array(
        F.struct(F.col("h").alias("pattern"), F.lit("block").alias("action"), start.alias("d")),
        F.struct(F.col("h").alias("pattern"), F.lit("allow").alias("action"), (start + 1 + day(F.concat("h", F.lit("+")), 150)).alias("d")),
        F.struct(F.concat("h", F.lit("/fr")).alias("pattern"), F.lit("block").alias("action"), day(F.concat("h", F.lit("/fr")), 365).alias("d")),
    )
    entries = hosts.select(F.explode(rules).alias("r")).select("r.pattern", "r.action", F.expr("timestamp_seconds(1704067200 + r.d * 86400)").alias("effective"))
    out = urls.evaluate(captures, entries)
    return out.select("page_id", "host", F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched"), "action", "pattern", F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"))


OP9_SQL = """
WITH p AS (
  SELECT page_id, url, nullif(lower(regexp_extract(url, '^(?i:https?)://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host, page_id % 365 AS t FROM pages
), h AS (SELECT DISTINCT host AS h FROM p WHERE host IS NOT NULL),
e AS (
  SELECT h AS pattern, 'block' AS action, ('0x' || substr(md5(h), 1, 6))::INT % 180 AS d FROM h
  UNION ALL SELECT h, 'allow', ('0x' || substr(md5(h), 1, 6))::INT % 180 + 1 + ('0x' || substr(md5(h || '+'), 1, 6))::INT % 150 FROM h
  UNION ALL SELECT h || '/fr', 'block', ('0x' || substr(md5(h || '/fr'), 1, 6))::INT % 365 FROM h
), m AS (SELECT pattern, d, max(action) AS action FROM e GROUP BY pattern, d),
i AS (SELECT pattern, action, d AS f, lead(d) OVER (PARTITION BY pattern ORDER BY d) AS e FROM m),
k AS (
  SELECT page_id, t, unnest([array_to_string(l[j:], '.') FOR j IN range(1, len(l) + 1)]) AS hp, s
  FROM (SELECT page_id, t, string_split(host, '.') AS l, regexp_extract(url, '^[^:]+://[^/?#]+/([^/?#]+)', 1) AS s FROM p WHERE host IS NOT NULL)
), a AS (SELECT page_id, t, hp AS pattern FROM k UNION ALL SELECT page_id, t, hp || '/' || s FROM k WHERE s <> ''),
b AS (
  SELECT a.page_id, i.action, i.pattern, i.f, row_number() OVER (PARTITION BY a.page_id ORDER BY length(i.pattern) DESC, i.pattern DESC) AS r
  FROM a JOIN i ON a.pattern = i.pattern AND i.f <= a.t AND (i.e IS NULL OR a.t < i.e)
)
SELECT p.page_id, p.host, strftime(DATE '2024-01-01' + p.t::INT, '%Y-%m-%d') AS fetched, coalesce(b.action, 'none') AS action, b.pattern, strftime(DATE '2024-01-01' + b.f::INT, '%Y-%m-%d') AS valid_from
FROM p LEFT JOIN b ON p.page_id = b.page_id AND b.r = 1
"""


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return decontaminate.report(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, array_to_string(w[p + 1 : p + least(10, len(w))], ' ') AS g, least(10, len(w)) AS n
  FROM (SELECT item, w, unnest(range(greatest(len(w) - 9, 1))) AS p FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, p, n, array_to_string(w[p + 1 : p + n], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n)
),
hit AS (SELECT dw.doc_id, dw.p, dw.n, bw.item FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases: lang, rank, phrase, a, l, r, n, score."""
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP11_SQL = rf"""
WITH p AS (SELECT lang, d, unnest(parts) AS part, unnest(range(len(parts))) AS k FROM (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d, string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]') AS parts FROM documents)),
w AS (SELECT lang, regexp_extract_all(part, '[^\x20\x09]+') AS w FROM p),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS (
  SELECT lang, m, g, count(*) AS f FROM (
    SELECT lang, m, array_to_string(w[i + 1 : i + m], ' ') AS g FROM (SELECT lang, w, m, unnest(range(len(w) - m + 1)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)
  ) GROUP BY lang, m, g HAVING count(*) >= 30
),
c AS (SELECT lang, m, g, f AS a, string_split(g, ' ') AS s FROM f WHERE m > 1),
cut AS (
  SELECT x.lang, x.g, x.a, k, l.f AS l, r.f AS r, CAST(2000000 * CAST(x.a AS HUGEINT) // (l.f + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) x
  JOIN f l ON l.lang = x.lang AND l.m = k AND l.g = array_to_string(s[1 : k], ' ') JOIN f r ON r.lang = x.lang AND r.m = x.m - k AND r.g = array_to_string(s[k + 1 :], ' ')
),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(s[i : i + n - 1], ' ') AS g, max(a) AS longer
  FROM (SELECT lang, s, a, n, unnest(range(1, m - n + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS n FROM c WHERE m > 2)) GROUP BY ALL
)
SELECT b.lang, row_number() OVER o AS rank, b.g AS phrase, b.a, b.l, b.r, t.n, b.score
FROM best b JOIN total t ON t.lang = b.lang LEFT JOIN inside i ON i.lang = b.lang AND i.g = b.g
WHERE i.longer IS NULL OR 100 * i.longer < 80 * b.a
WINDOW o AS (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.g) QUALIFY row_number() OVER o <= 2000
"""


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


OP12_SQL = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 49)) AS i FROM b WHERE len(h) >= 100)),
f AS (SELECT g, min(doc_id) AS m FROM g GROUP BY g),
p AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 1 ELSE 0 END AS new FROM g JOIN f USING (g) WHERE m < doc_id),
r AS (SELECT doc_id, min(i) AS low, max(i) + 50 AS high FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM p) GROUP BY doc_id, k),
l AS (SELECT r.doc_id, low, high, high - low AS size, substr(h, 2 * coalesce(lag(high) OVER (PARTITION BY r.doc_id ORDER BY low), 0) + 1, 2 * (low - coalesce(lag(high) OVER (PARTITION BY r.doc_id ORDER BY low), 0))) AS kept FROM r JOIN b ON b.doc_id = r.doc_id),
s AS (SELECT doc_id, sum(size)::BIGINT AS n_removed, count(*) AS n_spans, max(high) AS high, string_agg(kept, '' ORDER BY low) AS kept FROM l GROUP BY doc_id)
SELECT b.doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(CASE WHEN s.doc_id IS NULL THEN h ELSE kept || substr(h, 2 * high + 1) END)) AS kept_sha256
FROM b LEFT JOIN s ON s.doc_id = b.doc_id
"""


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_language": op3_language,
    "op4_gif": op4_gif,
    "op5_decontamination": op5_decontamination,
    "op6_pseudo_likelihood": op6_pseudo_likelihood,
    "op7_cotraining": op7_cotraining,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_url_filter": op9_url_filter,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_collocations": op11_collocations,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op5_decontamination": OP5_SQL,
    "op9_url_filter": OP9_SQL,
    "op11_collocations": OP11_SQL,
    "op12_suffix_dedup": OP12_SQL,
}
