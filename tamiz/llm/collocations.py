"""Phrase collocations of each language: contiguous phrases of 2 to 4 words that occur together more often than apart.

Frequent words are dictionary-encoded: ids by descending count over all (language, word), so that an id tells its
language. Pieces of texts are broken at all other words, since no phrase with one of them is frequent. Every place
where a word stands gives one fixed-width binary key, the ids of it and of the three words after it (0 past the
break), which a phrase of two, three or four words is a prefix of. Each task sorts its keys by radix and counts runs
before anything is shuffled; keys are dealt by ranges, sorted and counted again, and the run lengths of prefixes are the
phrases' counts. A run that a range's end cuts is summed over its parts.

Ranges come from the words' counts, which say how many keys begin with each word; a word of more keys than a range holds is
split by its followers. So ranges only balance the work and no result depends on them.

Edge cases: null texts are empty; a null language is ``und``; equal rows count each; an empty table gives no phrase; a
vocabulary beyond ``Params.broadcast_words`` is encoded by a join instead, with the same result. Words are told apart in
tasks by 64-bit hashes of their bytes and language. Columns besides the named ones are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.llm.kernel import LOWER, SAME, mix, raw, tokens
from tamiz.llm.shared import discard, materialise, slices

#: The longest phrase, in words.
MOST = 4

_WORD = np.ones(256, bool)
_WORD[list(b" \t.,;:!?\n\x0b\x0c\r")] = False
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True


@dataclass(frozen=True)
class Params:
    least: int = 30
    #: A longer candidate hides a shorter one inside it if its count is so many hundredths of the shorter one's.
    share: int = 80
    scale: int = 2_000_000
    top: int = 2000
    #: Dictionaries of at most so many words travel to the tasks (12 bytes each); larger ones are joined.
    broadcast_words: int = 2_000_000
    #: Keys that a range holds, in expectation, and words that a task counts at once.
    range_keys: int = 1_000_000
    chunk_words: int = 250_000


def _language(name: str) -> int:
    """A salt for a language, unrelated to the hash of the word of that name."""
    data = np.frombuffer(name.encode(), np.uint8)
    return int(mix(tokens(data, np.array([0, len(data)]), np.ones(256, bool), SAME)[0] + np.uint64(0x632BE59BD9B4E019))[0]) if len(data) else 1


def _read(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of (lang, text) rows: the text bytes, word hashes (with the language), first bytes, rows before, and the piece each word is in."""
    data, offsets = raw(part.column(1))
    hashes, starts, before = tokens(data, offsets, _WORD, LOWER)
    langs = part.column(0).dictionary_encode()
    salts = np.array([_language(x) for x in langs.dictionary.to_pylist()], np.uint64)
    hashes = mix(hashes ^ np.repeat(salts[langs.indices.to_numpy()], np.diff(before)))
    pieces = np.concatenate([[0], np.cumsum(_BREAK[data])])[starts]
    return data, hashes, starts, before, pieces


def _ends(data: np.ndarray, starts: np.ndarray, row_ends: np.ndarray) -> np.ndarray:
    """Ends of the words that begin at ``starts``."""
    gaps = np.flatnonzero(~_WORD[data])
    at = np.searchsorted(gaps, starts)
    return np.minimum(np.append(gaps, len(data))[at], row_ends)


def _vocabulary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, h, n): the words of some texts and their counts; words are strings in lower case."""
    for batch in batches:
        for part in slices(batch, 1, 1 << 21):
            data, hashes, starts, before, _ = _read(part)
            h, first, n = np.unique(hashes, return_index=True, return_counts=True)
            if not len(h):
                continue
            row = np.searchsorted(before, first, side="right") - 1
            stops = _ends(data, starts[first], raw(part.column(1))[1][row + 1])
            low, sizes = LOWER[data], stops - starts[first]
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            bytes_ = low[np.repeat(starts[first] - offsets[:-1], sizes) + np.arange(offsets[-1])]
            words = pa.Array.from_buffers(pa.string(), len(h), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(bytes_.tobytes())])
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), words, pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "word", "h", "n"])


def _occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, at, piece, h) of all words: for vocabularies that no task holds."""
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        for part in slices(batch, 1, 1 << 20):
            _, hashes, _, before, pieces = _read(part)
            rows = row + np.repeat(np.arange(len(before) - 1), np.diff(before))
            row += len(before) - 1
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.arange(len(hashes), dtype=np.int32)), pa.array(pieces), pa.array(hashes.view(np.int64))], ["row", "at", "piece", "h"])


def radix_sort(digits: np.ndarray) -> np.ndarray:
    """The order of keys given as 16-bit digits [digit, key], most significant first: stable passes from the last digit up."""
    order = None
    for digit in digits[::-1]:
        if len(digit) and digit.min() < digit.max():
            step = np.argsort(digit if order is None else digit[order], kind="stable")  # a radix sort for 16-bit values
            order = step if order is None else order[step]
    return np.arange(digits.shape[1]) if order is None else order


def runs(digits: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = radix_sort(digits)
    digits, counts = digits[:, order], counts[order]
    first = _changes(digits)
    return digits[:, first], np.add.reduceat(counts, first) if len(first) else counts


def _changes(digits: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    if not digits.shape[1]:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], (digits[:, 1:] != digits[:, :-1]).any(0)]))


@dataclass(frozen=True)
class Ranges:
    """Where ranges of keys end: by the first id and, within ids of many keys, by the second."""

    first: np.ndarray  # cumulative counts of ids, from id 0 (no word)
    size: int

    @property
    def number(self) -> int:
        return int(self.first[-1] // self.size) + 1

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The range of keys that begin with ids a, b: where they stand if followers were spread like all words."""
        share = self.first[b] / max(1, self.first[-1])
        place = self.first[a - 1] + (self.first[a] - self.first[a - 1]) * share
        return np.minimum(place // self.size, self.number - 1).astype(np.int64)


def _keys(ids: np.ndarray, pieces: np.ndarray, digits_of_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all places whose word and the next one have ids, as digits; and their first two ids."""
    n = len(ids)
    wide = np.zeros((MOST, n), np.int64)
    wide[0] = ids
    on = ids > 0
    for k in range(1, MOST):
        on[: max(0, n - k)] &= (ids[k:] > 0) & (pieces[k:] == pieces[: max(0, n - k)])
        on[max(0, n - k) :] = False
        wide[k, : max(0, n - k)] = np.where(on[: max(0, n - k)], ids[k:], 0)
    wide = wide[:, wide[1] > 0]
    digits = np.empty((MOST * digits_of_id, wide.shape[1]), np.uint16)
    for k in range(MOST):
        for d in range(digits_of_id):
            digits[k * digits_of_id + d] = wide[k] >> 16 * (digits_of_id - 1 - d) & 0xFFFF
    return digits, wide[0], wide[1]


def _packed(chunks: Iterable[tuple[np.ndarray, np.ndarray]], ranges: Ranges, digits_of_id: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """(range, keys, counts): sorted and counted keys of about ``chunk`` words at a time."""

    def flush(parts):
        keys = [_keys(ids, pieces, digits_of_id) for ids, pieces in parts]
        digits, a, b = (np.concatenate(x, axis=-1) for x in zip(*keys, strict=True))
        place = ranges.of(a, b)
        order = radix_sort(digits)
        digits, place = digits[:, order], place[order]
        first = _changes(digits)
        counts = np.diff(first, append=digits.shape[1]).astype(np.int32)
        digits, place = digits[:, first], place[first]
        cuts = np.flatnonzero(np.diff(place, prepend=-1))
        out = [(int(place[x]), digits[:, x:y].tobytes(), counts[x:y].tobytes()) for x, y in zip(cuts, [*cuts[1:], len(place)], strict=False)]
        for k in range(0, len(out), 64):
            rows = out[k : k + 64]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows]), pa.array([x[1] for x in rows], pa.binary()), pa.array([x[2] for x in rows], pa.binary())], ["range", "keys", "counts"])

    held, n = [], 0
    for ids, pieces in chunks:
        held.append((ids, pieces))
        n += len(ids)
        if n >= chunk:
            yield from flush(held)
            held, n = [], 0
    if held:
        yield from flush(held)


def _count(least: int, digits_of_id: int):
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("n", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        """All prefixes of a range that are frequent, or that stand at its ends, where the range beside it may have more of them."""
        width = MOST * digits_of_id
        digits = np.concatenate([np.frombuffer(x.as_buffer(), np.uint16).reshape(width, -1) for x in group.column("keys")], axis=1)
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in group.column("counts")]).astype(np.int64)
        digits, counts = runs(digits, counts)
        ids, ns = [], []
        for k in range(2, MOST + 1):
            first = _changes(digits[: k * digits_of_id])
            n = np.add.reduceat(counts, first)
            kept = n >= least
            kept[[0, -1]] = True
            key = digits[: k * digits_of_id, first[kept]].astype(np.int64)
            if digits_of_id > 1:
                key = sum(key[d::digits_of_id] << 16 * (digits_of_id - 1 - d) for d in range(digits_of_id))
            whole = key[-1] > 0
            ids += key.T[whole].tolist()
            ns += n[kept][whole].tolist()
        return pa.Table.from_arrays([pa.array(ids, pa.list_(pa.int64())), pa.array(ns, pa.int64())], schema=schema)

    return run


def rare_summed(words: DataFrame, least: int) -> DataFrame:
    """(lang, word, h, n) of the frequent words, and a row without word for all others of a language."""
    often = F.col("n") >= least
    named = words.select("lang", *(F.when(often, F.col(c)).alias(c) for c in ("word", "h")), "n")
    return named.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


def dictionary(words: DataFrame, least: int) -> DataFrame:
    """(lang, word, h, n, id) of the frequent words, with dense ids from 1 by descending count."""
    frequent = words.filter(F.col("n") >= least)
    order = [F.desc("n"), "lang", "word"]
    sorted_ = frequent.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    sorted_ = materialise(sorted_.select("*", F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("k")), "dictionary")
    base, bases = 1, []
    for r in sorted_.groupBy("part").count().orderBy("part").collect():  # one row a partition
        bases.append((r.part, base))
        base += r["count"]
    if not bases:
        return sorted_.select("lang", "word", "h", "n", F.col("k").alias("id"))
    offsets = F.broadcast(words.sparkSession.createDataFrame(bases, "part long, base long"))
    return sorted_.join(offsets, "part").select("lang", "word", "h", "n", (F.col("k") + F.col("base")).alias("id"))


def _boundaries(vocabulary: DataFrame, size: int, known: int = 100_000) -> tuple[Ranges, int]:
    """Ranges from the counts of the ``known`` most frequent words and the mean of the rest; and the number of ids."""
    total, number = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = np.array([r.n for r in vocabulary.filter(F.col("id") <= known).select("id", "n").orderBy("id").collect()], np.float64)
    rest = np.full(max(0, number - len(top)), (total - top.sum()) / max(1, number - len(top)))
    return Ranges(np.concatenate([[0.0], np.cumsum(np.concatenate([top, rest]))]), size), number


def phrase_counts(texts: DataFrame, vocabulary: DataFrame, params: Params) -> DataFrame:
    """(ids, n): the phrases of (lang, text) rows that occur at least ``least`` times."""
    spark = texts.sparkSession
    ranges, number = _boundaries(vocabulary, params.range_keys)
    digits = 1 if number < 1 << 16 else 2
    kind = "range long, keys binary, counts binary"
    if number <= params.broadcast_words:
        known = vocabulary.select("h", "id").toArrow()
        h, ids = known.column("h").to_numpy().view(np.uint64), known.column("id").to_numpy()
        order = np.argsort(h)
        shared = spark.sparkContext.broadcast((h[order], ids[order], ranges))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            h, ids, ranges = shared.value

            def chunks():
                gap = 0
                for batch in batches:
                    for part in slices(batch, 1, 1 << 21):
                        _, hashes, _, before, pieces = _read(part)
                        at = np.minimum(np.searchsorted(h, hashes), len(h) - 1)
                        found = np.where(h[at] == hashes, ids[at], 0) if len(h) else np.zeros(len(hashes), np.int64)
                        rows = np.repeat(np.arange(len(before) - 1), np.diff(before))
                        yield found, pieces + rows + gap
                        gap += (int(pieces[-1]) + len(before)) if len(pieces) else 0

            yield from _packed(chunks(), ranges, digits, params.chunk_words)

        packed = texts.mapInArrow(run, kind)
    else:
        met = texts.mapInArrow(_occurrences, "row long, at int, piece long, h long").join(vocabulary.select("h", "id"), "h", "left")
        lists = met.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "piece", F.coalesce("id", F.lit(0)).alias("id")))).alias("l")).select("l.piece", "l.id")
        shared = spark.sparkContext.broadcast(ranges)  # cumulative counts of ids: what grows with the vocabulary is 8 bytes a word

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunks = ((y.values.to_numpy(), x.values.to_numpy()) for batch in batches for x, y in zip(batch.column(0), batch.column(1), strict=True))
            yield from _packed(chunks, shared.value, digits, params.chunk_words)

        packed = lists.mapInArrow(run, kind)
    counted = packed.repartition(ranges.number, "range").groupBy("range").applyInArrow(_count(params.least, digits), "ids array<long>, n long")
    return counted.groupBy("ids").agg(F.sum("n").alias("n")).filter(F.col("n") >= params.least)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", params: Params = Params()) -> DataFrame:
    """Each language's first phrases: lang, rank, phrase, a (its count), l and r (its parts'), n (words of the language), score."""
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = texts.mapInArrow(_vocabulary, "lang string, word string, h long, n long")
    words = words.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))
    words = materialise(rare_summed(words, params.least), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    vocabulary = materialise(dictionary(words.filter(F.col("word").isNotNull()), params.least), "vocabulary")
    counts = materialise(phrase_counts(texts, vocabulary, params), "phrases")
    parts = counts.unionByName(vocabulary.select(F.array("id").alias("ids"), "n"))
    k = F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")
    exact = "decimal(20,0)"
    cuts = counts.select("ids", F.col("n").alias("a"), k).select("*", F.slice("ids", F.lit(1), F.col("k")).alias("left"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("right"))
    cuts = cuts.join(parts.select(F.col("ids").alias("left"), F.col("n").alias("l")), "left").join(parts.select(F.col("ids").alias("right"), F.col("n").alias("r")), "right")
    cuts = cuts.withColumn("score", F.expr(f"cast({params.scale} as decimal(10,0)) * cast(a as {exact}) div (cast(l as {exact}) + cast(r as {exact}))"))
    scored = cuts.groupBy("ids").agg(F.first("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("best"))
    inner = counts.filter(F.size("ids") > 2).select(F.col("n").alias("longer"), F.explode(F.expr("flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), i -> slice(ids, i, m))))")).alias("ids"))
    hidden = inner.groupBy("ids").agg(F.max("longer").alias("longer"))
    kept = scored.join(hidden, "ids", "left").filter(F.expr(f"longer is null or cast(100 as {exact}) * longer < cast({params.share} as {exact}) * a"))
    spelled = kept.select("ids", "a", "best", F.posexplode("ids").alias("at", "id")).join(vocabulary.select("id", "lang", "word"), "id")
    phrases = spelled.groupBy("ids").agg(F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("best").alias("best"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase"))
    ranked = phrases.select("lang", place.alias("rank"), "phrase", "a", "best").filter(F.col("rank") <= params.top)
    out = materialise(ranked.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "best.l", "best.r", F.col("total").alias("n"), "best.score"), "collocations")
    discard(words, vocabulary, counts)
    return out
