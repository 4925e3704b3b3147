"""Parsers of landed payloads: one DataFrame of raw payloads in, one row per notice out.

``payloads`` has a column ``payload`` (text) and, for order, an ``ordinal``. Notices have source, source_id, url,
official_title, description, published_at, authority, document_type and ordinal. Fetching is not part of it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.dates import feed_date, parse_date
from tamiz.functions.text import bound, clean, fold, short_hash
from tamiz.operators.dedup import last_by_key
from tamiz.operators.snapshot import changes
from tamiz.plans import vocabulary as V

COLUMNS = ("source", "source_id", "url", "official_title", "description", "published_at", "authority", "document_type", "case_parties", "case_status", "ordinal")
_PLACE = 1 << 20


@dataclass(frozen=True)
class Feed:
    """A source over the feed parser. ``skip``: titles matching it are no notices."""

    source: str
    authority: str
    document_type: str
    skip: str | None = None


# Names, authorities, document types and skipped titles of the sources.
FEEDS = {
    "un": Feed("ONU Noticias", "Organización de las Naciones Unidas", "Noticia"),
    "ustr": Feed("USTR", "Oficina del Representante Comercial de Estados Unidos (USTR)", "Comunicado"),
    "icc": Feed("CPI", "Corte Penal Internacional", "Comunicado"),
    "icj": Feed("CIJ", "Corte Internacional de Justicia", "Comunicado", r"^\d{8}-"),
    "trade": Feed("Trade.gov", "International Trade Administration (Trade.gov)", "Comunicado"),
    "wto": Feed("OMC", "Organización Mundial del Comercio", "Noticia"),
    "anam": Feed("ANAM", "Agencia Nacional de Aduanas de México", "Comunicado", r"(?i)^(comunicados de prensa|boletines|inicio$|directorio|aviso de privacidad)"),
}


def _rows(payloads: DataFrame, blocks: Column) -> DataFrame:
    """One row per block, in order."""
    return payloads.select(F.col("ordinal").alias("__o"), F.posexplode(blocks).alias("__p", "block")).withColumn("ordinal", F.col("__o") * F.lit(_PLACE) + F.col("__p"))


def _finish(df: DataFrame, since: Column | None) -> DataFrame:
    have = set(df.columns)
    out = df.select(*(F.col(c) if c in have else F.lit("").alias(c) for c in COLUMNS))
    return out.filter(F.col("published_at") >= since) if since is not None else out.filter("published_at is not null")


def _element(block: Column, name: str, filled: bool = False) -> Column:
    """The content of the first element of a name, as marked up in the block, or (``filled``) of the first that has any;
    null if there is none. An element that closes itself is empty."""
    found = F.regexp_extract_all(block, F.lit(rf"(?s)<{name}(?:\s[^>]*)?/>|<{name}(?:\s[^>]*?)?>(.*?)</{name}>"), F.lit(1))
    inner = F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", "$1")))
    return F.get(F.filter(inner, lambda x: x != "") if filled else inner, 0)


def _well_formed(block: Column) -> Column:
    """Outside CDATA and comments, no stray ampersand, and as many tags that end an element as tags that begin one."""
    bare = F.regexp_replace(block, r"(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->", "")
    begun, ended = F.regexp_count(bare, F.lit(r"(?s)<[A-Za-z_](?:[^<>]*[^<>/])?>")), F.regexp_count(bare, F.lit(r"</[A-Za-z_][^<>]*>"))
    return ~bare.rlike(r"&(?!(?:#\d+|#x[0-9A-Fa-f]+|amp|lt|gt|quot|apos);)") & (begun == ended)


def _items() -> Column:
    """Whole item blocks without name space prefixes; a truncated last block has no end and is no block."""
    return F.regexp_extract_all(F.regexp_replace("payload", r"<(/?)[A-Za-z0-9._-]+:", "<$1"), F.lit(r"(?s)<item(?:\s[^>]*)?>.*?</item>"), F.lit(0))


def feed(payloads: DataFrame, config: Feed, since: Column | None = None) -> DataFrame:
    """An RSS feed. The date is taken in the feed's own offset."""
    return feeds(payloads, [config], since)


def feeds(payloads: DataFrame, configs: Iterable[Feed], since: Column | None = None) -> DataFrame:
    """RSS feeds whose payloads are the same: these are parsed once, and each notice is dealt to the feeds."""
    rows = _rows(payloads, _items()).filter(_well_formed(F.col("block")))
    rows = rows.select("ordinal", *(_element(F.col("block"), n, n == "link").alias(n) for n in ("title", "link", "guid", "description", "pubDate")))
    title, url = clean(F.col("title")), clean(F.col("link"))
    out = rows.select(
        "ordinal", url.alias("url"), title.alias("official_title"),
        F.coalesce(F.nullif(clean(F.col("description")), F.lit("")), title).alias("description"), feed_date(F.col("pubDate")).alias("published_at"),
        short_hash(F.coalesce(F.nullif(clean(F.col("guid")), F.lit("")), url)).alias("source_id"),
    ).filter((F.col("official_title") != "") & F.col("url").rlike("(?i)^https?://"))
    kept = lambda c: ~F.col("official_title").rlike(c.skip) if c.skip else F.lit(True)
    sources = F.array(*(F.when(kept(c), F.struct(*(F.lit(x).alias(n) for n, x in (("source", c.source), ("authority", c.authority), ("document_type", c.document_type))))) for c in configs))
    out = _finish(out, since).drop("source", "authority", "document_type").withColumn("s", F.explode(sources)).filter("s is not null")
    return out.select(*(F.col(f"s.{c}").alias(c) if c in ("source", "authority", "document_type") else F.col(c) for c in COLUMNS))


def capitals(text: Column) -> Column:
    """Each run of letters with a capital first and small letters after."""
    chars = F.split(F.lower(text), "")
    return bound(chars, lambda cs: F.array_join(F.transform(cs, lambda c, i: F.when((i > 0) & F.coalesce(F.get(cs, i - 1).rlike(r"\p{L}"), F.lit(False)), c).otherwise(F.initcap(c))), ""))


def document_type(text: Column) -> Column:
    """The first three words, cut at the first that holds a digit, without connectors at the end, capitalised."""
    first = F.slice(F.array_remove(F.split(clean(text), " "), ""), 1, 3)
    connector = rf"[.,;:]*(?:{'|'.join(V.TYPE_CONNECTORS)})[.,;:]*"

    def kept(w: Column) -> Column:
        digit = F.array_position(F.transform(w, lambda x: x.rlike(r"\p{Nd}")), True)
        return F.when(digit > 0, F.slice(w, F.lit(1), (digit - 1).cast("int"))).otherwise(w)

    return capitals(F.regexp_replace(F.array_join(bound(first, kept), " "), rf"(?iu)(?:(?:^|\s+){connector})+$", ""))


def gazette(payloads: DataFrame, since: Column | None = None) -> DataFrame:
    """The official gazette's feed. An item's title is the authority, its description the text that is title, description and,
    by its first words, document type. Dates come from ``valueDate``, else from the link's ``fecha``; ids from its ``codigo``."""
    rows = _rows(payloads, _items()).filter(_well_formed(F.col("block")))
    rows = rows.select("ordinal", *(_element(F.col("block"), n).alias(n) for n in ("title", "link", "valueDate", "description")))
    text, url = clean(F.col("description")), clean(F.col("link"))
    given = F.nullif(F.col("valueDate"), F.lit(""))
    day = F.when(given.isNull(), parse_date(F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit("fecha"))))).otherwise(parse_date(given))
    out = rows.select(
        "ordinal", F.lit("DOF").alias("source"), url.alias("url"), text.alias("official_title"), text.alias("description"), day.alias("published_at"),
        clean(F.col("title")).alias("authority"), document_type(F.col("description")).alias("document_type"),
        F.coalesce(F.nullif(F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit("codigo"))), F.lit("")), short_hash(url)).alias("source_id"),
    )
    return _finish(out, since)


def senate(payloads: DataFrame, since: Column | None = None) -> DataFrame:
    """The Senate's JSON by year: initiatives only. The payload's own spelling of the title field is kept."""
    entry = "fecha_documento string, titulo_docuemnto string, tema_documento string, link_documento string, organo string, tipo_documento string, nota string"
    rows = _rows(payloads, F.from_json("payload", f"struct<data:array<struct<{', '.join(x.replace(' ', ':') for x in entry.split(', '))}>>>")["data"])
    title, url, day = clean(F.col("block.titulo_docuemnto")), F.coalesce(F.col("block.link_documento"), F.lit("")), F.col("block.fecha_documento")
    kind = clean(F.col("block.tipo_documento"))
    organ = F.when(F.col("block.organo").isNull(), F.lit("Senado de la República")).otherwise(clean(F.col("block.organo")))
    out = rows.filter(F.contains(F.lower(kind), F.lit("iniciativa"))).select(
        "ordinal", F.lit("Senado").alias("source"), url.alias("url"), title.alias("official_title"), F.coalesce(F.nullif(clean(F.col("block.tema_documento")), F.lit("")), title).alias("description"),
        parse_date(day).alias("published_at"), organ.alias("authority"), kind.alias("document_type"), short_hash(F.concat_ws("|", url, title, parse_date(day).cast("string"))).alias("source_id"),
    )
    return _finish(out, since)


def world_bank(payloads: DataFrame, since: Column | None = None) -> DataFrame:
    """The World Bank's JSON: a map of documents among which ``facets`` is none; texts are plain or in ``cdata!``."""
    documents = F.map_entries(F.from_json(F.get_json_object("payload", "$.documents"), "map<string,string>"))
    rows = _rows(payloads, F.filter(documents, lambda e: e["key"] != "facets"))
    field = lambda name: clean(F.coalesce(F.get_json_object("block.value", f"$.{name}['cdata!']"), F.get_json_object("block.value", f"$.{name}"), F.lit("")))
    day = F.try_to_date(F.substring(F.get_json_object("block.value", "$.lnchdt"), 1, 10), "yyyy-MM-dd")
    out = rows.select(
        "ordinal", F.lit("Banco Mundial").alias("source"), field("id").alias("source_id"), field("url").alias("url"), field("title").alias("official_title"),
        F.coalesce(F.nullif(field("descr"), F.lit("")), field("title")).alias("description"), day.alias("published_at"), F.lit("Banco Mundial").alias("authority"), F.coalesce(F.nullif(field("conttype"), F.lit("")), F.lit("Comunicado")).alias("document_type"),
    ).filter((F.col("official_title") != "") & F.col("url").rlike("(?i)^https?://"))
    return _finish(out, since)


def wordpress(payloads: DataFrame, since: Column | None = None, origin: str = "https://platiica.economia.gob.mx") -> DataFrame:
    """A WordPress REST listing: dates from ``modified``, addresses on the public origin from the link's path, else the slug. The
    excerpt is the description, empty or not."""
    rows = _rows(payloads, F.from_json("payload", "array<struct<id:bigint,modified:string,slug:string,link:string,title:struct<rendered:string>,excerpt:struct<rendered:string>>>"))
    path = F.regexp_replace(F.coalesce(F.try_parse_url(F.col("block.link"), F.lit("PATH")), F.lit("")), "^/+|/+$", "")
    slug = F.regexp_replace(F.coalesce(F.col("block.slug"), F.lit("")), "^/+|/+$", "")
    title = clean(F.col("block.title.rendered"))
    out = rows.select(
        "ordinal", F.lit("PLATIICA").alias("source"), F.col("block.id").cast("string").alias("source_id"), F.concat(F.lit(origin + "/"), F.coalesce(F.nullif(path, F.lit("")), slug), F.lit("/")).alias("url"), title.alias("official_title"),
        clean(F.col("block.excerpt.rendered")).alias("description"), F.try_to_date(F.substring("block.modified", 1, 10), "yyyy-MM-dd").alias("published_at"), F.lit("Secretaría de Economía").alias("authority"), F.lit("Normalización").alias("document_type"),
    )
    return _finish(out, since)


def arbitration_cases(payloads: DataFrame, needle: str = "mexic") -> DataFrame:
    """Cases of which a party's folded name holds ``needle``, of repeated numbers the last: key, status, claimant, respondent, subject, sector, ordinal."""
    rows = _rows(payloads, F.from_json("payload", "struct<data:struct<GetAllCasesResult:array<struct<caseno:string,claimant:string,respondent:string,status:string,subject:string,econsector:string>>>>")["data"]["GetAllCasesResult"])
    c = F.col("block")
    rows = rows.filter(F.contains(fold(c["claimant"]), F.lit(needle)) | F.contains(fold(c["respondent"]), F.lit(needle)))
    names = {"caseno": "key", "status": "status", "claimant": "claimant", "respondent": "respondent", "subject": "subject", "econsector": "sector"}
    return last_by_key(rows.select(*(clean(c[a]).alias(b) for a, b in names.items()), "ordinal").filter("key <> ''"), "key", "ordinal")


def arbitration(cases: DataFrame, previous: DataFrame | None, today: Column) -> DataFrame:
    """Notices of cases that are new or have another status than in the snapshot ``previous`` (key, status); without one,
    of pending cases only. The day is the day they were seen, as the source has none."""
    rows = changes(cases, previous, F.col("status") == "Pending")
    party = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(V.NO_PARTY))
    parties = F.concat(party("claimant"), F.lit(" v. "), party("respondent"))
    labels = F.create_map(*(F.lit(x) for pair in V.CASE_STATUS.items() for x in pair))
    label = F.coalesce(labels[F.col("status")], F.nullif("status", F.lit("")), F.lit(V.NO_STATUS))
    extra = [F.when(F.col(c) != "", F.concat(F.lit(f" {name}: "), F.col(c), F.lit("."))).otherwise("") for c, name in (("subject", "Materia"), ("sector", "Sector económico"))]
    out = rows.select(
        "ordinal", F.lit("CIADI").alias("source"), short_hash(F.col("key")).alias("source_id"), F.concat(F.lit("https://icsid.worldbank.org/cases/case-database/case-detail?CaseNo="), "key").alias("url"),
        F.concat(parties, F.lit(" (Caso CIADI No. "), "key", F.lit(")")).alias("official_title"), F.concat(F.lit("Estatus del procedimiento: "), label, F.lit("."), *extra).alias("description"), today.alias("published_at"),
        F.lit("Centro Internacional de Arreglo de Diferencias Relativas a Inversiones").alias("authority"), F.lit("Caso de arbitraje de inversión").alias("document_type"), parties.alias("case_parties"), F.col("status").alias("case_status"),
    )
    return _finish(out, None)


def panel_cases(payloads: DataFrame) -> DataFrame:
    """Panels of tables with eight cells a row, whose first is a case number, of repeated numbers the last: key, status,
    cells, page (the payload's ordinal) and ordinal."""
    rows = _rows(payloads, F.regexp_extract_all("payload", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1)))
    rows = rows.withColumn("raw", F.regexp_extract_all("block", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))).filter(F.size("raw") >= 8)
    rows = rows.select("ordinal", F.col("__o").alias("page"), *(clean(F.get("raw", i)).alias(f"c{i}") for i in range(8)))
    rows = rows.filter(F.col("c0").rlike(r"^[A-Z]{2,4}-")).select(F.col("c0").alias("key"), F.col("c7").alias("status"), F.array(*(f"c{i}" for i in range(8))).alias("cells"), "page", "ordinal")
    return last_by_key(rows, "key", "ordinal")


def panels(cases: DataFrame, previous: DataFrame | None, today: Column, urls: tuple[str, ...]) -> DataFrame:
    """Notices of panels that are new or have another status than in the snapshot ``previous``; without one, of all. ``urls``: of
    the pages, by the payloads' ordinals."""
    cell = lambda i: F.get("cells", i)
    out = changes(cases, previous).select(
        "ordinal", F.lit("Secretariado T-MEC").alias("source"), short_hash(F.col("key")).alias("source_id"), F.get(F.array(*map(F.lit, urls)), F.col("page").cast("int")).alias("url"),
        F.concat(cell(1), F.lit(" (Panel "), "key", F.lit(")")).alias("official_title"),
        F.concat(F.lit("Panel del T-MEC "), "key", F.lit(". Mecanismo: "), cell(3), F.lit(". Parte importadora: "), cell(4), F.lit(". Otra parte involucrada: "), cell(5), F.lit(". Solicitud de panel: "), cell(6), F.lit(". Estatus: "), "status", F.lit(".")).alias("description"),
        today.alias("published_at"), F.lit("Secretariado del T-MEC").alias("authority"), F.lit("Panel de solución de controversias").alias("document_type"), F.concat(cell(4), F.lit(" / "), cell(5)).alias("case_parties"), F.col("status").alias("case_status"),
    )
    return _finish(out, None)


def court_listing(payloads: DataFrame, since: Column | None = None, base: str = "https://www.tfja.gob.mx") -> DataFrame:
    """Date headers and the PDF links below them, as one list by offset: each link takes the last header before it, of which
    an impossible date hides the links below it. The link's text is the number, what follows it in the item the description."""
    events = F.regexp_extract_all("payload", F.lit(r"(?is)<strong>\s*\p{L}+\s+\d{1,2}\s+de\s+\p{L}+\s+de\s+\d{4}\s*</strong>|<li>\s*<a\s+href=\"[^\"]+\.pdf\"[^>]*>[^<]+</a>.*?</li>"), F.lit(0))
    rows = _rows(payloads, events).withColumn("head", F.col("block").rlike("(?i)^<strong"))
    # A header whose month is no month leaves the date before it; one whose day is none hides the items below.
    named = F.col("head") & F.lower("block").rlike(rf"\sde\s+(?:{'|'.join(V.MONTHS)})\s+de\s")
    day = F.when(named, F.struct(parse_date(clean(F.col("block"))).alias("day")))
    w = Window.partitionBy("__o").orderBy("__p").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("published_at", F.last(day, ignorenulls=True).over(w)["day"]).filter("not head")
    part = lambda i: F.regexp_extract("block", r"(?is)^<li>\s*<a\s+href=\"([^\"]+\.pdf)\"[^>]*>([^<]+)</a>\s*(?:<br\s*/?>)?\s*(.*?)</li>$", i)
    url, number = absolute(part(1), base), clean(part(2))
    text = F.coalesce(F.nullif(clean(part(3)), F.lit("")), number)
    out = rows.select("ordinal", F.lit("TFJA").alias("source"), url.alias("url"), F.concat(F.lit("Acuerdo "), number, F.lit(" del TFJA. "), text).alias("official_title"), text.alias("description"), "published_at", F.lit("Tribunal Federal de Justicia Administrativa").alias("authority"), F.lit("Acuerdo").alias("document_type"), short_hash(url).alias("source_id"))
    return _finish(out, since)


def anchors(payloads: DataFrame) -> DataFrame:
    """(ordinal, href, title): links in order, with their texts; a link's first place counts."""
    rows = _rows(payloads, F.regexp_extract_all("payload", F.lit(r"(?is)<a\s[^>]*href=[\"'][^\"']*[\"'][^>]*>.*?</a>"), F.lit(0)))
    return rows.select("__o", "ordinal", F.regexp_extract("block", r"(?i)href=[\"']([^\"']*)[\"']", 1).alias("href"), clean(F.col("block")).alias("title"))


def absolute(href: Column, base: str) -> Column:
    """A reference as an address on ``base`` (scheme and host); one with a scheme of its own stays."""
    plain = F.regexp_replace(href, r"^(?:\.{1,2}/)+", "")
    return F.when(href.rlike("(?i)^[a-z][a-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(F.lit(base.split("//")[0]), href)).when(href.rlike("^[/#?]") | (href == ""), F.concat(F.lit(base), href)).otherwise(F.concat(F.lit(base + "/"), plain))


def snapshot(payloads: DataFrame) -> DataFrame:
    """(key, status) of a JSON object."""
    return payloads.select(F.explode(F.from_json("payload", "map<string,string>")).alias("key", "status"))

