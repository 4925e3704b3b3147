"""Removal of repeated passages by a distributed difference-cover suffix sort.

A byte goes if it lies in a string of ``width`` (50) bytes that also begins in a document with a smaller key. Sorted
suffixes hold equal strings side by side, so it is enough to compare neighbours; only their order up to ``width`` bytes
matters. Four steps:

1. The sample. Texts that equal one of a smaller key are told by their hash: all of such a copy goes, and it is no part of what
   follows. Of the others, of every ``width`` bytes at least one place is sampled, the same one wherever these bytes stand (the least hash of 8 bytes among the
   first 27 places), with the triple of eight-byte words that begins there. This is the cover that positions modulo a number
   give, but 7 of 100 places are in it whatever the threshold. Triples met in one document only are dropped.
2. The order. The bytes around the places that are left, each distinct string with its least key, are dealt by ranges
   of sorted triples, so that all suffixes that can be equal for ``width`` bytes are in one range. A string that is alone with its triple is not sorted.
3. Each range is sorted by the difference-cover algorithm modulo 3: sort the triples at places 1 and 2 of 3, recurse on their names until these
   are unique, sort the rest by a first byte and the rank after it, merge.
4. Neighbours that share ``width`` bytes form runs; of each run all suffixes but those of the least key are repeats, and the bytes below them go.

Triples around which more than ``HOT`` distinct strings stand (a sentence that a third of all documents embed, each in its own text) are not
put into one range: their ``width``-byte strings are grouped by themselves, which combines before the shuffle.

Edge cases: null texts are empty, empty texts stay; rows that share a key are texts of their own, none of which removes from another; a null
key takes part in nothing; equal texts keep the one of the least key; cuts may fall inside a character, so what is kept is bytes; an
empty table gives an empty result. Columns besides the key and the text are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.kernel import SAME, _spans, mix, raw
from tamiz.llm.shared import discard, materialise, row_count_at_most, slices

#: The bytes in another order, for a second hash of a string.
SHUFFLED = np.random.default_rng(5).permutation(256).astype(np.uint8)
#: Bytes that are hashed at a place, and bytes of a sampled triple.
GRAM, TRIPLE = 8, 24
#: Distinct strings around a triple beyond which their parts are grouped by themselves.
HOT = 8_000
#: Strings that are sorted at once (with those of their last triple and a batch at most 2**21 bytes), and sampled triples that one task compares.
CHUNK, BUCKET = 8_000, 1 << 22
#: Hashes of copied texts (44 bytes each) of at most so many are broadcast; more are joined by a shuffle.
BROADCAST_HASHES = 500_000
#: Bits of a byte's place in its strip, and of a strip's in its partition. With a partition's number they make one whole number.
PLACE_BITS, STRIP_BITS = 31, 16
#: Rows of a strip.
STRIP_ROWS = 1 << 12


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros past the end."""
    padded = np.concatenate([data, np.zeros(GRAM - 1, np.uint8)])
    return np.ndarray(len(data), np.uint64, padded, strides=(1,)).copy()


def _slide(x: np.ndarray, n: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) of n values from each place on, as far as there are n."""
    size = 1
    while 2 * size <= n:
        x = of(x[:-size], x[size:])
        size *= 2
    return of(x[: len(x) - (n - size)], x[n - size :]) if size < n else x


def sample(data: np.ndarray, offsets: np.ndarray, width: int, words: np.ndarray | None = None) -> np.ndarray:
    """Places that depend on nothing but the ``width`` bytes around them: of every ``width`` bytes of a row one of the first width - TRIPLE + 1.
    ``words`` are those of the bytes, if they are known."""
    span = width - TRIPLE + 1
    n = len(data)
    if n < width:
        return np.zeros(0, np.int64)
    w = (_words(data) if words is None else words)[: n - width + span]
    h = ((w ^ w >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    low = np.zeros(n - width + 1 + 2 * (span - 1), np.uint32)
    inner = low[span - 1 : span + n - width]
    inner[:] = _slide(h, span, np.minimum)
    none = offsets[1:, None] - np.arange(1, width)  # no whole string begins here
    inner[none[(none >= offsets[:-1, None]) & (none <= n - width)]] = 0
    return np.flatnonzero(_slide(low, span, np.maximum) == h)


def _triples(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of the sampled triples."""
    h = mix(words[places])
    for k in (8, 16):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[places + k])
    return h


def suffix_order(x: np.ndarray) -> np.ndarray:
    """The suffixes of numbers from 1 on in their order, by the difference cover {1, 2} modulo 3."""
    n = len(x)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: x[i:].tolist()), np.int64)
    padded = np.concatenate([x, np.zeros(4, x.dtype)]).astype(np.int64)
    bits = np.int64(max(int(padded.max()), n + 2).bit_length())
    if bits > 21:
        raise ValueError("three names are more than 63 bits")
    ones, twos, rests = len(range(1, n + (n % 3 == 1), 3)), len(range(2, n, 3)), len(range(0, n, 3))  # with a place past the end, so that a last place of residue 0 has one after it
    x0, x1, x2, x3, x4 = (padded[k::3] for k in range(5))
    key = np.concatenate([x1[:ones] << 2 * bits | x2[:ones] << bits | x3[:ones], x2[:twos] << 2 * bits | x3[:twos] << bits | x4[:twos]])
    order = np.argsort(key)
    new = np.diff(key[order], prepend=-1) != 0
    names = np.empty(ones + twos, np.int64)
    names[order] = np.cumsum(new)
    if not new.all():
        order = suffix_order(names)
        names[order] = np.arange(1, ones + twos + 1)
    rank = np.zeros(n + 4, np.int64)
    rank[1::3][:ones] = names[:ones]
    rank[2::3][:twos] = names[ones:]
    if n % 3 == 1:
        order = order[1:]  # the place past the end comes first
    is_one = order < ones
    after_one = (x1[:ones] << bits | rank[2::3][:ones])[order[is_one]]
    after_two = (x2[:twos] << 2 * bits | x3[:twos] << bits | rank[4::3][:twos])[order[~is_one] - ones]
    rest_one = x0[:rests] << bits | rank[1::3][:rests]
    rest_two = x0[:rests] << 2 * bits | x1[:rests] << bits | rank[2::3][:rests]
    rest = np.argsort(rest_one)
    at = np.searchsorted(after_one, rest_one[rest]) + np.searchsorted(after_two, rest_two[rest]) + np.arange(rests)
    out = np.empty(n, np.int64)
    free = np.ones(n, bool)
    free[at] = False
    out[at] = 3 * rest
    out[free] = np.where(is_one, 3 * order + 1, 3 * (order - ones) + 2)
    return out


def repeats(data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, width: int) -> np.ndarray:
    """For rows of bytes (width to 64 + width - 1 each) with a key: the bits of the places (from 0) whose ``width`` bytes also begin in a row with a smaller key."""
    sizes = np.diff(offsets)
    begin = offsets[:-1] + np.arange(len(sizes))
    ends = begin + sizes
    joined = np.ones(len(data) + len(sizes), np.int64)  # a 1 ends each row
    inside = np.ones(len(joined), bool)
    inside[ends] = False
    joined[inside] = data.astype(np.int64) + 2
    order = suffix_order(joined)
    order = order[(np.arange(len(joined)) + width <= np.repeat(ends, sizes + 1))[order]]  # whole strings only
    if not len(order):
        return np.zeros(len(sizes), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)[order]
    words, places = _words(data), order - owner
    new = np.ones(len(order), bool)
    new[1:] = False
    for k in (*range(0, width - GRAM, GRAM), width - GRAM):
        word = words[places + k]
        new[1:] |= word[1:] != word[:-1]
    first = np.flatnonzero(new)
    own = keys[owner]
    found = np.repeat(np.minimum.reduceat(own, first), np.diff(first, append=len(order))) < own
    out = np.zeros(len(sizes), np.int64)
    np.bitwise_or.at(out, owner[found], np.int64(1) << (order - begin[owner])[found])
    return out


def _strips(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(strip, keys, sizes, texts, copies): about a megabyte of texts a row, packed as one, and which of them are copies."""
    from pyspark import TaskContext

    strip = first = TaskContext.get().partitionId() << STRIP_BITS
    if strip >> 32:
        raise ValueError("more partitions than a strip's number holds")
    for batch in batches:
        for part in (y for k in range(0, batch.num_rows, STRIP_ROWS) for y in slices(batch.slice(k, STRIP_ROWS), 1, 1 << 20)):
            if strip - first >> STRIP_BITS:
                raise ValueError("more strips in a partition than their numbers hold")
            data, offsets = raw(part.column(1))
            whole = pa.array([0, part.num_rows], pa.int32())
            sizes = pa.array(np.diff(offsets).astype(np.int32))
            lists = [pa.ListArray.from_arrays(whole, x) for x in (part.column(0), sizes, part.column(2))]
            yield pa.RecordBatch.from_arrays([pa.array([strip]), *lists[:2], pa.array([pa.compress(data.tobytes(), codec="zstd", asbytes=True)], pa.binary()), lists[2]], ["strip", "keys", "sizes", "texts", "copies"])
            strip += 1


def _unpacked(sizes: pa.Array, texts: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """A strip's bytes, and where its rows begin and end."""
    offsets = np.concatenate([[0], np.cumsum(sizes.to_numpy(), dtype=np.int64)])
    return np.frombuffer(pa.decompress(texts.as_buffer(), decompressed_size=int(offsets[-1]), codec="zstd"), np.uint8), offsets


def _sampled(keys: pa.Array, sizes: pa.Array, texts: pa.Scalar, copies: pa.Array, width: int):
    """Of a strip: its bytes, offsets, sampled places, their rows and triples; copies and rows without a key have none."""
    data, offsets = _unpacked(sizes, texts)
    words = _words(data)
    places = sample(data, offsets, width, words)
    rows = np.searchsorted(offsets, places, side="right") - 1
    known = (keys.is_valid().to_numpy(zero_copy_only=False) & ~copies.to_numpy(zero_copy_only=False))[rows] if len(rows) else np.zeros(0, bool)
    places, rows = places[known], rows[known]
    return data, offsets, places, rows, _triples(words, places)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of hashes."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _ask(width: int, buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(bucket, strip, triples, many): a strip's distinct triples by range, and whether two of its keys have it."""
        for batch in batches:
            for strip, keys, sizes, texts, copies in zip(batch.column(0).to_pylist(), *batch.columns[1:5], strict=True):
                _, _, _, rows, h = _sampled(keys.values, sizes.values, texts, copies.values, width)
                key = keys.values.fill_null(0).to_numpy()[rows]
                order = np.argsort(h)
                h, key = h[order], key[order]
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else order
                many = np.minimum.reduceat(key, first) != np.maximum.reduceat(key, first) if len(h) else np.zeros(0, bool)
                h = h[first]
                place = _bucket(h, buckets)
                cuts = np.flatnonzero(np.diff(place, prepend=-1))
                spans = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(h)], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[cuts]), pa.array([strip] * len(spans), pa.int64()), pa.array([h[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([np.packbits(many[a:b]).tobytes() for a, b in spans], pa.binary())],
                    ["bucket", "strip", "triples", "many"],
                )

    return run


_ANSWER = pa.schema([("strip", pa.int64()), ("bucket", pa.int64()), ("repeated", pa.binary())])


def _answer(group: pa.Table) -> pa.Table:
    """(strip, bucket, repeated): for each strip's triples in order a bit, whether another key has it too."""
    parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("triples")]
    many = np.concatenate([np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=len(p)) for x, p in zip(group.column("many"), parts, strict=True)])
    h = np.concatenate(parts)
    order = np.argsort(h)
    new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
    first = np.flatnonzero(new)
    repeated = (np.diff(first, append=len(h)) > 1) | (np.add.reduceat(many[order], first) > 0)
    bits = np.empty(len(h), bool)
    bits[order] = repeated[np.cumsum(new) - 1]
    ends = np.cumsum([len(p) for p in parts])
    return pa.Table.from_arrays([group.column("strip"), group.column("bucket"), pa.array([np.packbits(bits[e - len(p) : e]).tobytes() for e, p in zip(ends, parts, strict=True)], pa.binary())], schema=_ANSWER)


def _spread(offsets: np.ndarray, places: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the bytes around sampled places begin and end."""
    return np.maximum(offsets[rows], places - (width - TRIPLE)), np.minimum(offsets[rows + 1], places + width)


def _around(width: int, buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(h1, h2, at, key, before, size): of each sampled place whose triple is repeated the hashes of the bytes around it, where it stands (``at``: its strip, and
        its place there) and how many bytes around it count. Columns that change from row to row stand side by side, and the others too: so they are packed best."""
        for batch in batches:
            for strip, keys, sizes, texts, copies, answers in zip(batch.column(0).to_pylist(), *batch.columns[1:5], batch.column(5).to_pylist(), strict=True):
                data, offsets, places, rows, h = _sampled(keys.values, sizes.values, texts, copies.values, width)
                known, inverse = np.unique(h, return_inverse=True)
                held = np.bincount(_bucket(known, buckets))
                bits = [np.unpackbits(np.frombuffer(x["repeated"], np.uint8), count=int(held[x["bucket"]])) for x in sorted(answers, key=lambda x: x["bucket"])]
                on = np.concatenate(bits).astype(bool)[inverse] if bits else np.zeros(0, bool)
                start, stop = _spread(offsets, places, rows, width)
                on &= stop - start >= width
                places, rows, start, stop = places[on], rows[on], start[on], stop[on]
                before = (places - start).astype(np.uint64)
                both = [mix(_spans(data, start, stop, fold) ^ before * np.uint64(0xD1342543DE82EF95)).view(np.int64) for fold in (SAME, SHUFFLED)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, both), pa.array((strip << PLACE_BITS) + places), keys.values.take(pa.array(rows)), pa.array(before.astype(np.int32)), pa.array((stop - start).astype(np.int32))],
                    ["h1", "h2", "at", "key", "before", "size"],
                )

    return run


def _read(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(h1, h2, least, around, triple): the bytes around the wanted places of each strip."""
        for batch in batches:
            for sizes, texts, wanted in zip(*batch.columns[1:4], strict=True):
                data, offsets = _unpacked(sizes.values, texts)
                want = wanted.values
                places = want.field("at").to_numpy() & ((1 << PLACE_BITS) - 1)
                rows = np.searchsorted(offsets, places, side="right") - 1
                start, stop = _spread(offsets, places, rows, width)
                for k in range(0, len(rows), 1 << 15):
                    part = slice(k, k + (1 << 15))
                    pieces = [_pieces(data, *x) for x in ((start[part], stop[part]), (places[part], places[part] + TRIPLE))]
                    yield pa.RecordBatch.from_arrays([*(want.field(c).slice(k, 1 << 15) for c in ("h1", "h2", "key")), *pieces], ["h1", "h2", "least", "around", "triple"])

    return run


def _pieces(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    sizes = np.concatenate([[0], np.cumsum(stop - start)])
    bytes_ = data[np.repeat(start - sizes[:-1], stop - start) + np.arange(sizes[-1])]
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(sizes.astype(np.int32).tobytes()), pa.py_buffer(bytes_.tobytes())])


def _runs(triples: pa.Array) -> np.ndarray:
    """Where runs of equal triples begin."""
    x = raw(triples)[0].reshape(-1, TRIPLE)
    return np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]).any(1)]))


def _sorted(width: int, chunk: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(h1, h2, least, mask) from rows sorted by their triple, about ``chunk`` at a time, never a triple's rows apart.
        A string that stands alone with its triple has none to be compared with."""
        held: list[pa.RecordBatch] = []
        n = 0

        def flush(table, runs):
            mask = np.zeros(table.num_rows, np.int64)
            sizes = np.diff(runs, append=table.num_rows)
            shared = np.repeat(sizes > 1, sizes)
            if shared.any():
                some = table.filter(pa.array(shared))
                mask[shared] = repeats(*raw(some.column("around")), some.column("least").to_numpy(), width)
            return pa.RecordBatch.from_arrays([*(table.column(c).combine_chunks() for c in ("h1", "h2", "least")), pa.array(mask)], ["h1", "h2", "least", "mask"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < chunk:
                continue
            table = pa.Table.from_batches(held)
            runs = _runs(table.column("triple"))
            cut = int(runs[-1])
            if cut:
                yield flush(table.slice(0, cut), runs[:-1])
            held, n = table.slice(cut).to_batches(), n - cut
        if n:
            table = pa.Table.from_batches(held)
            yield flush(table, _runs(table.column("triple")))

    return run


def _kept(width: int, key: str):
    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per row of a strip: sizes, removed runs and what is kept."""
        for batch in batches:
            for keys, sizes, texts, copies, found in zip(*batch.columns[1:6], strict=True):
                data, offsets = _unpacked(sizes.values, texts)
                change = np.zeros(len(data) + 1, np.int64)
                whole = np.flatnonzero(copies.values.to_numpy(zero_copy_only=False) & (np.diff(offsets) >= width))
                np.add.at(change, offsets[whole], 1)
                np.add.at(change, offsets[whole + 1], -1)
                if found.is_valid:
                    got = found.values
                    first = got.field("first").to_numpy() & ((1 << PLACE_BITS) - 1)
                    mask = got.field("mask").to_numpy()
                    for bit in range(width - TRIPLE + 1):
                        at = first[mask >> bit & 1 > 0] + bit
                        np.add.at(change, at, 1)
                        np.add.at(change, at + width, -1)
                gone = np.cumsum(change)[:-1] > 0
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                inner = offsets[:-1][offsets[:-1] < len(data)]
                begins[inner] = gone[inner]
                removed, spans = (np.concatenate([[0], np.cumsum(x)])[offsets] for x in (gone, begins))
                left = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [keys.values, pa.array(np.diff(offsets)), pa.array(np.diff(removed)), pa.array(np.diff(spans)), pa.array([sha256(x).hexdigest() for x in left], pa.string()), pa.array(left, pa.binary())], names
                )

    return run


def _windows(strings: DataFrame, width: int) -> DataFrame:
    """(h1, h2, least, mask) of (h1, h2, least, around) with every ``width``-byte string grouped by itself."""
    each = strings.select("h1", "h2", "least", F.posexplode(F.expr(f"transform(sequence(1, length(around) - {width - 1}), i -> substring(around, i, {width}))")).alias("i", "string"))
    low = each.groupBy("string").agg(F.min("least").alias("low"))
    met = each.join(materialise(low, "strings", drop_shuffles=True), "string").groupBy("h1", "h2").agg(F.min("least").alias("least"), F.sum(F.when(F.col("low") < F.col("least"), F.expr("shiftleft(1L, i)")).otherwise(0)).alias("mask"))
    return met


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 50, hot: int = HOT) -> DataFrame:
    """Per row: the key, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and kept, the bytes that are left."""
    texts = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("hash", F.sha2("text", 256))
    copied = texts.filter("key is not null").groupBy("hash").agg(F.min("key").alias("least"), F.count("*").alias("n")).filter("n > 1").select("hash", "least")
    copied = materialise(copied, "copied", drop_shuffles=True)
    known = F.broadcast(copied) if row_count_at_most(copied, BROADCAST_HASHES) else copied
    texts = texts.join(known, "hash", "left").select("key", "text", F.coalesce(F.col("key") > F.col("least"), F.lit(False)).alias("copy"))
    strips = materialise(texts.mapInArrow(_strips, "strip long, keys array<long>, sizes array<int>, texts binary, copies array<boolean>"), "strips", drop_shuffles=True)
    total = strips.agg(F.coalesce(F.sum(F.expr("aggregate(sizes, 0L, (n, x) -> n + x)")), F.lit(0))).first()[0]
    buckets = int(total * 2 / (width - TRIPLE + 2) / BUCKET) + 1
    asked = strips.mapInArrow(_ask(width, buckets), "bucket long, strip long, triples binary, many binary")
    answers = asked.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_answer, "strip long, bucket long, repeated binary")
    answers = answers.groupBy("strip").agg(F.collect_list(F.struct("bucket", "repeated")).alias("answers"))
    around = strips.join(answers, "strip").mapInArrow(_around(width, buckets), "h1 long, h2 long, at long, key long, before int, size int")
    around = materialise(around, "around", drop_shuffles=True)
    # Of each distinct string one place is read: only there its bytes are shuffled.
    firsts = around.groupBy("h1", "h2").agg(F.min_by("at", "key").alias("at"), F.min("key").alias("key"))
    wanted = firsts.groupBy(F.shiftright("at", PLACE_BITS).alias("strip")).agg(F.collect_list(F.struct("at", "h1", "h2", "key")).alias("wanted"))
    wanted = materialise(wanted, "wanted", drop_shuffles=True)
    strings = strips.select("strip", "sizes", "texts").join(wanted, "strip").mapInArrow(_read(width), "h1 long, h2 long, least long, around binary, triple binary")
    strings = materialise(strings, "strings", drop_shuffles=True)
    discard(wanted)
    many = materialise(strings.groupBy("triple").count().filter(F.col("count") > hot).select("triple"), "hot", drop_shuffles=True)
    cold = strings
    some_hot = not many.isEmpty()
    if some_hot:
        cold = strings.join(many, "triple", "left_anti")
    masks = cold.repartitionByRange("triple").sortWithinPartitions("triple").select("h1", "h2", "least", "around", "triple").mapInArrow(_sorted(width, CHUNK), "h1 long, h2 long, least long, mask long")
    if some_hot:
        masks = masks.unionByName(_windows(strings.join(many, "triple", "left_semi"), width))
    masks = materialise(masks, "masks", drop_shuffles=True)
    discard(strings, many)
    whole = F.expr(f"shiftleft(1L, size - {width - 1}) - 1")
    slim = around.select("h1", "h2", (F.col("at") - F.col("before")).alias("first"), "key", whole.alias("whole"))
    found = slim.join(masks, ["h1", "h2"]).select("first", F.when(F.col("key") > F.col("least"), F.col("whole")).otherwise(F.col("mask")).alias("mask")).filter("mask <> 0")
    found = materialise(found.groupBy(F.shiftright("first", PLACE_BITS).alias("strip")).agg(F.collect_list(F.struct("first", "mask")).alias("found")), "found", drop_shuffles=True)
    discard(copied, around, masks)
    out = strips.join(found, "strip", "left").mapInArrow(_kept(width, key), f"`{key}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out
