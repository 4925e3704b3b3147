"""URL filters with dated lists: a temporal join, with DataFrame functions only.

A list entry (pattern, action, effective) holds from its time until the same pattern's next entry. A pattern is
a host, which covers its subdomains, with or without the first segment of a path (``host/segment``). Every capture is
looked up by all patterns that can cover it, as of its fetch time; the longest pattern with an entry in
force decides.

Edge cases: null or unparsable URLs, a null time, and URLs that no entry covers get the action ``none``; of several
entries of one pattern and time, the one with the largest action by name holds; entries with nulls are no
entries; rows that share a key get one result each, the same for equal URLs and times; empty tables give empty results.
All other columns stay; those named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.llm.shared import row_count_at_most

#: Lists of at most so many intervals (about 60 bytes each) are broadcast; longer ones are joined by a shuffle.
BROADCAST_ENTRIES = 500_000


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, valid_from, valid_to): entries as half-open intervals; the last has no end."""
    entries = entries.dropna(subset=["pattern", "action", "effective"]).groupBy("pattern", "effective").agg(F.max("action").alias("action"))
    after = Window.partitionBy("pattern").orderBy("effective")
    return entries.select("pattern", "action", F.col("effective").alias("valid_from"), F.lead("effective").over(after).alias("valid_to"))


def host(url):
    """The lower-cased host of an http or https URL, without user and port; null if there is none."""
    h = F.lower(F.regexp_extract(url, r"^(?i:https?)://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(h != "", h)


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """``captures`` with ``host``, ``action``, ``pattern`` and ``valid_from`` of the entry that decides."""
    keep = [c for c in captures.columns if c not in ("host", "action", "pattern", "valid_from")]
    # Equal URLs at equal times are looked up once; hot hosts are spread by their URLs.
    asked = captures.select(F.col(url).alias("__u"), F.col(fetched).alias("__t")).distinct().withColumn("h", host(F.col("__u"))).filter("h is not null and __t is not null")
    labels = F.split("h", r"\.")
    segment = F.regexp_extract("__u", r"^[^:]+://[^/?#]+/([^/?#]+)", 1)
    rules = intervals(entries)
    # The last label alone is a key that half of all captures may share: asked for only if a rule has such a pattern.
    bare = not rules.filter(~F.contains("pattern", F.lit("."))).isEmpty()
    last = F.size("l") if bare else F.greatest(F.size("l") - 1, F.lit(1))
    hosts = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice("l", i, F.size("l")), "."))
    asked = asked.withColumn("l", labels).withColumn("hosts", hosts).withColumn("s", segment)
    patterns = F.when(F.col("s") == "", F.col("hosts")).otherwise(F.concat("hosts", F.transform("hosts", lambda x: F.concat(x, F.lit("/"), F.col("s")))))
    asked = asked.select("__u", "__t", F.explode(patterns).alias("pattern"))
    if row_count_at_most(rules, BROADCAST_ENTRIES):
        rules = F.broadcast(rules)
    active = (F.col("valid_from") <= F.col("__t")) & (F.col("valid_to").isNull() | (F.col("__t") < F.col("valid_to")))
    met = asked.join(rules, "pattern").filter(active)
    best = met.groupBy("__u", "__t").agg(F.max(F.struct(F.length("pattern").alias("n"), "pattern", "action", "valid_from")).alias("__b"))
    out = captures.select(keep).join(best, F.col(url).eqNullSafe(F.col("__u")) & F.col(fetched).eqNullSafe(F.col("__t")), "left")
    return out.select(*keep, host(F.col(url)).alias("host"), F.coalesce("__b.action", F.lit("none")).alias("action"), F.col("__b.pattern").alias("pattern"), F.col("__b.valid_from").alias("valid_from"))
