"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by a byte-level vocabulary A (a blank before it) and by a piece vocabulary B (which adds that
blank). Token ends are set bits of packed bitsets over the bytes; their AND has the shared cuts, and the number of set bits up to
a cut (popcounts of the bytes before it and of the byte's own part) is the token that ends there, so two neighbouring
cuts give a group's token ranges. The OR of the bitsets cuts a text into segments that lie in one token of either
side each, and every pair of overlapping tokens has exactly one of them: the links.

Ids are stored once in the shared folder; the corpus-wide counts of id pairs are summed in tasks before they are shuffled. Of each B id only
the highest count and of each pair the count travel back: to the tasks, packed, where there are at most ``PAIRS`` pairs,
else by a join of each text's distinct pairs.

Edge cases: null and empty texts, and texts whose tokens do not spell the blank and the text (as where B normalises),
have no tokens: zeros and an empty ``groups_sha256``; rows that share a key each count; a null key stays null; special tokens' strings are plain text; an
empty table gives an empty result. Columns besides the key and the text are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.shared import materialise, row_count_at_most, slices

#: Pair counts of at most so many pairs travel to the tasks (17 bytes each); more are joined.
PAIRS = 4_000_000

_POPCOUNT = np.array([bin(x).count("1") for x in range(256)], np.int64)


@lru_cache(2)
def byte_vocabulary(name: str):
    """An encoder of a byte-level vocabulary's rank file, and the bytes of each id."""
    import base64

    import public_tokenizers as public
    import tiktoken

    with open(public.path(name.replace(".json", ".tiktoken")), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    spelled = [b""] * (max(ranks.values()) + 1)
    for x, i in ranks.items():
        spelled[i] = x
    return tiktoken.Encoding(name, pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, spelled


@lru_cache(2)
def piece_vocabulary(name: str):
    """An encoder of a piece model, and the bytes of each id."""
    import public_tokenizers as public
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public.path(name))
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    spelled = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return lambda texts: model.encode(texts, num_threads=1), spelled


def ends(lengths: np.ndarray, n: int) -> np.ndarray:
    """A packed bitset over n bytes with a bit at the last byte of each token."""
    bits = np.zeros(n, np.uint8)
    bits[np.cumsum(lengths) - 1] = 1
    return np.packbits(bits)


class Rank:
    """Popcounts of a packed bitset: how many bits are set before a place."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed
        self.before = np.concatenate([[0], np.cumsum(_POPCOUNT[packed])])

    def at(self, place: np.ndarray) -> np.ndarray:
        inside = np.append(self.packed, 0)[place >> 3] >> (8 - (place & 7)).astype(np.uint8) if len(place) else place
        return self.before[place >> 3] + np.where(place & 7, _POPCOUNT[inside], 0)


def select(packed: np.ndarray) -> np.ndarray:
    """The places of all set bits."""
    return np.flatnonzero(np.unpackbits(packed))


def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For bitsets of ends: of each segment of their union, the token of either side that it lies in."""
    last = select(a | b)
    return Rank(a).at(last), Rank(b).at(last)


def groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For bitsets of ends: how many tokens of either side end up to each shared cut."""
    cuts = select(a & b) + 1
    return Rank(a).at(cuts), Rank(b).at(cuts)


class Speller:
    """The decimal ids of grouped tokens with their separators, looked up instead of formatted."""

    def __init__(self, na: int, nb: int):
        a, b = [str(i) for i in range(na)], [str(i) for i in range(nb)]
        self.a = np.array([[x + "," for x in a], [x + "|" for x in a]], object)
        self.b = np.array([[x + "," for x in b], [x + ";" for x in b]], object)

    def spell(self, a: np.ndarray, b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = np.zeros(len(a), np.int8), np.zeros(len(b), np.int8)
        last_a[upto_a - 1] = 1
        last_b[upto_b - 1] = 1
        out = np.empty(len(a) + len(b), object)
        na, nb = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        out[np.arange(len(a)) + np.repeat(upto_b - nb, na)] = self.a[last_a, a]
        out[np.arange(len(b)) + np.repeat(upto_a, nb)] = self.b[last_b, b]
        return "".join(out.tolist())[:-1]


@lru_cache(1)
def _speller(na: int, nb: int) -> Speller:
    return Speller(na, nb)


def _encode(name_a: str, name_b: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(key, a, b): ids as 32-bit values; none where a side does not spell the text."""
        encode_a, spelled_a = byte_vocabulary(name_a)
        encode_b, spelled_b = piece_vocabulary(name_b)
        for batch in batches:
            for part in slices(batch, 1):
                texts = [x or "" for x in part.column(1).to_pylist()]
                a, b = [], []
                for text, ids_b in zip(texts, encode_b(texts), strict=True):
                    whole = (" " + text).encode()
                    ids_a = encode_a(" " + text) if text else []
                    if text and b"".join([spelled_a[i] for i in ids_a]) == whole and b"".join([spelled_b[i] for i in ids_b]) == whole:
                        a.append(np.asarray(ids_a, "<u4").tobytes())
                        b.append(np.asarray(ids_b, "<u4").tobytes())
                    else:
                        a.append(b"")
                        b.append(b"")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["key", "a", "b"])

    return run


def _ids(x: pa.Scalar) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), "<u4").astype(np.int64)


def _sizes(name_a: str, name_b: str) -> tuple[np.ndarray, np.ndarray]:
    return np.array([len(x) for x in byte_vocabulary(name_a)[1]]), np.array([len(x) for x in piece_vocabulary(name_b)[1]])


def _aligned(batches: Iterable[pa.RecordBatch], name_a: str, name_b: str):
    """For each text with tokens: its row, ids and bitsets of ends."""
    size_a, size_b = _sizes(name_a, name_b)
    for batch in batches:
        for row, (x, y) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
            a, b = _ids(x), _ids(y)
            n = int(size_a[a].sum())
            yield batch, row, a, b, ends(size_a[a], n) if n else None, ends(size_b[b], n) if n else None


def _pair_counts(name_a: str, name_b: str, most: int = 1 << 20):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(pair, n): links of some texts, counted by pair of ids."""
        held, n = [], 0
        for _, _, a, b, ends_a, ends_b in _aligned(batches, name_a, name_b):
            if ends_a is not None:
                i, j = links(ends_a, ends_b)
                held.append(a[i] << 32 | b[j])
                n += len(i)
            if n >= most:
                yield flush(held)
                held, n = [], 0
        if held:
            yield flush(held)

    def flush(held):
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

    return run


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", name_a: str = "byte_bpe_50k.json", name_b: str = "piece_bpe_32k.model", most_pairs: int = PAIRS) -> DataFrame:
    """Per row: the key, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most frequent of its B id),
    count_sum (of the pairs' counts over all links) and groups_sha256."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    encoded = materialise(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(_encode(name_a, name_b), f"key {kind}, a binary, b binary"), "encoded")
    counts = materialise(encoded.mapInArrow(_pair_counts(name_a, name_b), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    best = counts.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("n").alias("most"))
    known = counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    digests = "n_a long, n_b long, n_groups long, n_links long"
    names = ["n_a", "n_b", "n_groups", "n_links"]

    def digest(a, b, ends_a, ends_b):
        from hashlib import sha256

        upto_a, upto_b = groups(ends_a, ends_b)
        spelled = _speller(len(byte_vocabulary(name_a)[1]), len(piece_vocabulary(name_b)[1])).spell(a, b, upto_a, upto_b)
        return len(upto_a), sha256(spelled.encode()).hexdigest()

    if row_count_at_most(counts, most_pairs):
        got = known.toArrow()
        pairs, n, is_best = (got.column(c).to_numpy() for c in ("pair", "n", "best"))
        order = np.argsort(pairs)
        shared = spark.sparkContext.broadcast((pairs[order], n[order], is_best[order]))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pairs, counted, is_best = shared.value
            for batch in batches:
                rows = []
                for _, _, a, b, ends_a, ends_b in _aligned([batch], name_a, name_b):
                    if ends_a is None:
                        rows.append((0, 0, 0, 0, 0, 0, ""))
                        continue
                    i, j = links(ends_a, ends_b)
                    at = np.searchsorted(pairs, a[i] << 32 | b[j])
                    n_groups, sha = digest(a, b, ends_a, ends_b)
                    rows.append((len(a), len(b), n_groups, len(i), int(is_best[at].sum()), int(counted[at].sum()), sha))
                cols = list(zip(*rows, strict=True)) if rows else [()] * 7
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.string())], [key, *names, "n_best", "count_sum", "groups_sha256"])

        out = encoded.mapInArrow(run, f"`{key}` {kind}, {digests}, n_best long, count_sum long, groups_sha256 string")
        return out

    def wide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row_id = TaskContext.get().partitionId() << 40
        for batch, row, a, b, ends_a, ends_b in _aligned(batches, name_a, name_b):
            i, j = links(ends_a, ends_b) if ends_a is not None else (np.zeros(0, np.int64),) * 2
            pairs, n = np.unique(a[i] << 32 | b[j], return_counts=True)
            n_groups, sha = digest(a, b, ends_a, ends_b) if ends_a is not None else (0, "")
            pair_type = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))
            met = pa.array([[{"pair": p, "times": t} for p, t in zip(pairs.tolist(), n.tolist(), strict=True)]], pair_type)
            yield pa.RecordBatch.from_arrays([pa.array([row_id]), batch.column(0).slice(row, 1), *(pa.array([x], pa.int64()) for x in (len(a), len(b), n_groups, len(i))), pa.array([sha]), met], ["row", "key", *names, "sha", "met"])
            row_id += 1

    rows = materialise(encoded.mapInArrow(wide, f"row long, key {kind}, {digests}, sha string, met array<struct<pair: long, times: long>>"), "aligned")
    sums = rows.select("row", F.inline("met")).join(known, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.drop("met").join(sums, "row", "left").select(F.col("key").alias(key), *names, zero("n_best"), zero("count_sum"), F.col("sha").alias("groups_sha256"))
