"""Benchmark decontamination by winnowing, with DataFrame functions only.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters. A window is ``length`` (10)
consecutive words of a benchmark item; an item with fewer words is one window. Each sliding window of
a text selects the smallest hash among its k-word grams, once for a run of windows that select the same, so two texts that share
a window share that fingerprint, whatever stands around it: with k-grams and a guarantee of ``length``
words, a winnowing window holds ``length - k + 1`` grams. Fingerprints of documents and items are joined; hits are
extended to whole windows by a second, independent hash of all the window's words. Windows
shorter than ``length``, which winnowing cannot promise to find, are their own fingerprints.
Each text is taken apart once.

Edge cases: null texts and texts without words have no words and no hits; an empty benchmark hits nothing; rows
that share an id get the hits of all of them; a null id is one id of its own; null items have no
words; repeated items count once. Columns besides id and text are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.llm.shared import materialise, row_count_at_most, scratch

#: Benchmarks of at most so many distinct windows (about 40 bytes each) are broadcast; larger ones are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000
#: With at most so many fingerprints, texts without any of them are put aside before the join (a constant array in the plan).
SIEVE_MARKS = 10_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text. ``lower`` is right, and faster, where all characters are ASCII."""
    folded = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(folded, F.lit("")), _GAP), "")


def _scanned(df: DataFrame, lengths: list[int], length: int, k: int, marks: dict[int, list[int]] | None, whole: bool) -> DataFrame:
    """Per row of (id, text): id, n_words and ``found``, an array of (len, pos, fp, keys). Texts are taken apart once.

    Of windows of ``length`` words, each sliding window's least k-gram hash is selected, and a run of windows that select
    the same one is one entry: its fingerprint, its first position, and a hash of all words of each of its windows. The other
    ``lengths`` are shorter than winnowing can promise, and each window is an entry. With ``marks`` (by length, all fingerprints
    sought) texts without any of a length have no entries of it. ``whole``: only texts of just so many words have windows of a shorter length.
    Each array is a column of its own, so that none is computed anew inside another."""
    out = df.select("id", words(F.col("text")).alias("__w"))
    out = out.select("id", F.size("__w").alias("n_words"), F.transform("__w", lambda x: F.xxhash64(x)).alias("__h"))
    h, n = F.col("__h"), F.col("n_words")
    gram = F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, k))))
    out = out.select("id", "n_words", "__h", gram.alias("__g"))
    g = F.col("__g")
    least = F.transform(g, lambda x, i: F.least(x, *(F.get(g, i + j) for j in range(1, length - k + 1))))
    out = out.select("id", "n_words", "__h", "__g", F.slice(least, F.lit(1), F.greatest(n - (length - 1), F.lit(0))).alias("__m"))
    # Not filters: pushed below the arrays, they would compute them anew inside each other.
    known = lambda size: F.split(F.lit(",".join(map(str, marks[size]))), ",").cast("array<bigint>")  # folded to a constant
    if marks is not None:
        out = out.withColumn("__m", F.when(F.arrays_overlap("__m", known(length)), F.col("__m")) if marks[length] else F.lit(None).cast("array<bigint>"))
    m = F.col("__m")
    begins = F.array_compact(F.transform(m, lambda x, i: F.when((i == 0) | (x != F.get(m, i - 1)), i)))
    out = out.select("id", "n_words", "__h", "__g", "__m", begins.alias("__b"))
    b = F.col("__b")
    arrays = {"__r": F.transform(b, lambda s, i: F.struct(s.alias("s"), F.coalesce(F.get(b, i + 1), F.size(m)).alias("e"), F.get(m, s).alias("fp")))}

    def short_windows(size: int) -> Column:
        every = F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, size))))
        return F.slice(every, F.lit(1), F.when((n == size) if whole else (n >= size), n - (size - 1)).otherwise(0))

    def short_entries(size: int) -> Column:
        return F.transform(f"__r{size}", lambda x, i: entry(size, i, x, F.array(F.xxhash64(F.lit(size), *(F.get(h, i + j) for j in reversed(range(size)))))))

    arrays |= {f"__r{size}": short_windows(size) for size in lengths if size != length}
    out = out.select("id", "n_words", "__h", "__g", *(x.alias(c) for c, x in arrays.items()))
    if marks is not None:
        out = out.withColumns({f"__r{size}": F.when(F.arrays_overlap(f"__r{size}", known(size)), F.col(f"__r{size}")) for size in lengths if size != length})
    # Grams that overlap or meet, and together hold all words of the window.
    steps = [*range(k, length - k, k), length - k]
    entry = lambda size, s, fp, keys: F.struct(F.lit(size).alias("len"), s.alias("pos"), fp.alias("fp"), keys.alias("keys"))
    found = [F.transform("__r", lambda r: entry(length, r["s"], r["fp"], F.transform(F.sequence(r["s"], r["e"] - 1), lambda p: F.xxhash64(F.get(g, p), *(F.get(g, p + j) for j in steps)))))]
    found += [short_entries(size) for size in lengths if size != length]
    none = F.lit(None).cast("array<struct<len:int,pos:int,fp:bigint,keys:array<bigint>>>")
    return out.select("id", F.col("n_words").cast("long").alias("n_words"), F.concat(*(F.coalesce(x, none, F.array()) for x in found)).alias("found"))


def _windows(scanned: DataFrame) -> DataFrame:
    """(id, len, fp, key, pos) of each window."""
    rows = scanned.select("id", F.explode("found").alias("f")).select("id", "f.len", "f.fp", F.col("f.pos").alias("first"), F.posexplode("f.keys").alias("o", "key"))
    return rows.select("id", "len", "fp", "key", (F.col("first") + F.col("o")).alias("pos"))


def hits(docs: DataFrame, benchmark: DataFrame, length: int = 10, k: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What windows of ``docs`` (id, text) occur in ``benchmark`` (id, text): (id, n_words) of all rows; (id, len, fp, key, pos) of
    the windows; and (len, fp, key, item) of the benchmark's."""
    counted = materialise(benchmark.select("id", "text", F.size(words(F.col("text"))).alias("n")), "items")
    short = [r.n for r in counted.filter(f"n between 1 and {length - 1}").select("n").distinct().collect()]  # fewer than ``length`` numbers
    lengths = [*sorted(short), length]
    # Written before they are exploded, as Spark would compute the arrays anew for each row made from them.
    items = materialise(_windows(materialise(_scanned(counted.select("id", "text"), lengths, length, k, None, True), "scanned")).select("len", "fp", "key", F.col("id").alias("item")).distinct(), "windows")
    keys = materialise(items.select("len", "fp", "key").distinct(), "keys")
    fingerprints = keys.select("len", "fp").distinct()
    marks = None
    if row_count_at_most(fingerprints, SIEVE_MARKS):
        marks = {size: [] for size in lengths}
        for size, fp in fingerprints.collect():
            marks[size].append(fp)
    scanned = materialise(_scanned(docs, lengths, length, k, marks, False), "scanned")
    ours = _windows(scanned)
    if row_count_at_most(keys, BROADCAST_WINDOWS):
        keys = F.broadcast(keys)
    return scanned.select("id", "n_words"), materialise(ours.join(keys, ["len", "fp", "key"]), "hits"), items


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", length: int = 10, k: int = 5) -> DataFrame:
    """Per row of ``docs``: the key, n_words, n_hit, n_items, items_sha256, contaminated."""
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows, found, items = hits(texts, benchmark.select(F.col(item).cast("string").alias("id"), F.col(text).alias("text")), length, k)
    # Lengths of the parts of each window that no window before it covers. A document's positions are no more than its words.
    spans = found.groupBy("id", "pos").agg(F.max("len").alias("len")).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "len"))).alias("spans"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def cover(a: Column, x: Column) -> Column:
        end = x["pos"] + x["len"]
        return F.struct(F.greatest(a["end"], end).alias("end"), (a["n"] + F.greatest(F.lit(0), end - F.greatest(a["end"], x["pos"]))).alias("n"))

    spans = spans.select("id", F.aggregate("spans", start, cover)["n"].alias("n_hit"))
    # Windows of a document once each, then their items: no window gathers its items in one row.
    named = found.select("id", "len", "fp", "key").distinct().join(items, ["len", "fp", "key"]).select("id", "item").distinct()
    named = named.groupBy("id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    named = named.select("id", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items"))
    marked = spans.join(named, spans["id"].eqNullSafe(named["id"])).select(spans["id"].alias("__id"), "n_hit", "n_items", "items")
    out = rows.join(marked, F.col("id").eqNullSafe(F.col("__id")), "left").withColumnRenamed("id", key)
    return out.select(
        key,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", length: int = 10, k: int = 5) -> DataFrame:
    """``docs`` without the rows whose document has a hit; all columns stay."""
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    with scratch() as made:
        _, found, _ = hits(texts, benchmark.select(F.col(item).cast("string").alias("id"), F.col(text).alias("text")), length, k)
        bad = materialise(found.select(F.col("id").alias("__doc")).distinct(), "contaminated")
        made.sweep(bad)
    if row_count_at_most(bad, BROADCAST_WINDOWS):
        bad = F.broadcast(bad)
    return docs.join(bad, F.col(key).eqNullSafe(F.col("__doc")), "left_anti")
