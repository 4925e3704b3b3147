"""Best-fit packing of tokenised documents into sequences of one capacity, by bin completion.

Only how many pieces there are of each length matters to a packing. So the pieces' lengths are counted
(at most ``capacity`` counts), the packing is found on the driver as patterns of lengths, each with the number
of sequences that repeat it, and every piece finds its place from its length and its rank among the
pieces of that length. No group of pieces meets in one task, and the packing sees all of them.

The search: around the largest length left, the undominated fillings of the rest of a sequence are
enumerated; depth-first branch and bound over them, where a branch ends if its waste so far shows that it needs
no fewer sequences than the incumbent. The first incumbent is best-fit decreasing.

Edge cases: a null text is empty and has one token, the separator; equal texts have equal pieces; a null key
stays null; rows that share a key are each packed; an empty table gives an empty result. Columns
besides the key and the text are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.llm.shared import materialise, slices

#: A pattern: ((length, how many), ...) from the largest length down.
Pattern = tuple[tuple[int, int], ...]


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over counted lengths: patterns and how many sequences have each."""
    open_: dict[int, list[list]] = {}  # space left -> [[pattern, sequences], ...]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for space in sorted(s for s in open_ if s >= length):
            while left and open_.get(space):
                pattern, n = open_[space].pop()
                each = min(space // length, max(1, -(-left // n)))
                used = min(n, left // each)
                if used < n:
                    open_[space].append([pattern, n - used])
                open_.setdefault(space - each * length, []).append([(*pattern, (length, each)), used])
                left -= used * each
            if not left:
                break
        each = capacity // length
        for k in (each, left % each):
            if left and k and (n := left // k):
                open_.setdefault(capacity - k * length, []).append([((length, k),), n])
                left -= n * k
    return [(p, n) for group in open_.values() for p, n in group]


def fillings(counts: np.ndarray, space: int, most: float, steps: float) -> list[tuple[int, Pattern]]:
    """Undominated ways to fill ``space`` from counted lengths, least waste first: (waste, pattern).
    At most ``steps`` steps of the enumeration, which takes larger lengths first, and ``most`` results."""
    lengths = np.flatnonzero(counts[: space + 1])[::-1].tolist()
    if not lengths:
        return [(space, ())]
    found: list[tuple[int, Pattern]] = []
    todo: list[tuple[int, int, Pattern]] = [(0, space, ())]
    least = lengths[-1]
    while todo and steps and len(found) < 4 * most:
        steps -= 1
        i, left, taken = todo.pop()
        while i < len(lengths) and lengths[i] > left:
            i += 1
        if i == len(lengths) or left < least:
            found.append((left, taken))
            if left == 0 and len(found) >= most:
                break
            continue
        length = lengths[i]
        top = min(left // length, int(counts[length]))
        if i + 1 < len(lengths):
            todo.append((i + 1, left, taken))
        for k in range(1, top + 1):
            todo.append((i + 1, left - k * length, (*taken, (length, k))))
    if not found:
        i, left, taken = max(todo, key=lambda x: space - x[1])
        found.append((left, taken))
    kept: list[tuple[int, Pattern]] = []
    for waste, pattern in sorted(set(found), key=lambda x: (x[0], len(x[1]))):
        if len(kept) < most and not any(_dominates(other, pattern) for _, other in kept):
            kept.append((waste, pattern))
    return kept


def _dominates(a: Pattern, b: Pattern) -> bool:
    """Whether b's pieces fit into a's pieces (then a leaves the smaller ones for later)."""
    spaces = [x for x, n in a for _ in range(n)]
    for x, n in b:
        for _ in range(n):
            best = min((s for s in spaces if s >= x), default=None)
            if best is None:
                return False
            spaces.remove(best)
            spaces.append(best - x)
    return True


@dataclass(frozen=True)
class Bounds:
    """How far the search goes: nodes, fillings a node, steps of their enumeration; and whether a filling is repeated as often as the
    lengths allow. ``EXACT`` has none of these bounds: the fewest sequences, for small instances."""

    nodes: float = 20_000
    most: float = 6
    steps: float = 400
    repeat: bool = True


EXACT = Bounds(math.inf, math.inf, math.inf, False)


def complete(counts: Mapping[int, int], capacity: int, bounds: Bounds = Bounds(), nodes: float | None = None) -> list[tuple[Pattern, int]]:
    """Bin completion by branch and bound within ``bounds`` (but for ``nodes``, where given); never worse than best-fit decreasing."""
    nodes = bounds.nodes if nodes is None else nodes
    best = best_fit(counts, capacity)
    used = sum(n for _, n in best)
    total = sum(x * n for x, n in counts.items())
    floor = -(-total // capacity)
    if used <= floor:
        return best
    left = np.zeros(capacity + 1, np.int64)
    for x, n in counts.items():
        left[x] = n
    chosen: list[tuple[Pattern, int]] = []
    wasted = 0
    stack: list[list] = []

    def branches() -> list:
        top = int(np.flatnonzero(left)[-1])
        left[top] -= 1
        ways = fillings(left, capacity - top, bounds.most, bounds.steps)
        left[top] += 1
        return [top, iter(ways)]

    stack.append(branches())
    while stack and nodes:
        top, ways = stack[-1]
        if len(chosen) == len(stack):  # come back from a child: undo
            pattern, n = chosen.pop()
            for x, k in pattern:
                left[x] += n * k
                wasted += n * k * x
            wasted -= n * capacity
        way = next(ways, None)
        if way is None:
            stack.pop()
            continue
        nodes -= 1
        waste, rest = way
        pattern = ((top, 1 + rest[0][1]), *rest[1:]) if rest and rest[0][0] == top else ((top, 1), *rest)
        n = min(int(left[x]) // k for x, k in pattern) if bounds.repeat else 1
        if -(-(total + wasted + n * waste) // capacity) >= used:
            continue
        for x, k in pattern:
            left[x] -= n * k
        wasted += n * waste
        chosen.append((pattern, n))
        if not left.any():
            bins = sum(k for _, k in chosen)
            if bins < used:
                best, used = list(chosen), bins
                if used <= floor:
                    return best
            stack.append([0, iter(())])
        else:
            stack.append(branches())
    return best


class Places:
    """Where the piece of a length and rank goes. The plan is bounded by the capacity: a pattern ends a length."""

    def __init__(self, plan: list[tuple[Pattern, int]]):
        rows, taken, base = [], {}, 0
        for pattern, n in plan:
            offset = 0
            for length, k in pattern:
                low = taken.get(length, 0)
                rows.append(((length << 40) + low, k, base, offset))
                taken[length] = low + n * k
                offset += length * k
            base += n
        rows.sort()
        self.key, self.each, self.base, self.offset = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 4

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length.astype(np.int64) << 40) + rank
        at = np.searchsorted(self.key, key, side="right") - 1
        k = key - self.key[at]
        return self.base[at] + k // self.each[at], self.offset[at] + k % self.each[at] * length


@lru_cache(4)
def _encoding(name: str):
    """The byte-level vocabulary ``name``.json, with its special tokens, as an encoder of the tiktoken library (same ids, several times faster)."""
    import base64
    import json

    import public_tokenizers as public
    import tiktoken

    with open(public.path(name.replace(".json", ".tiktoken")), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(public.path(name), encoding="utf-8") as file:
        special = {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}
    return tiktoken.Encoding(name, pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens=special), frozenset(special)


def token_ids(texts: list[str], tokenizer: str = "byte_bpe_50k.json") -> list[bytes]:
    """Each text's ids as little-endian unsigned 32-bit values; a special token's string is that token."""
    core, special = _encoding(tokenizer)
    plain = lambda x: not any(s in x for s in special)
    return [np.asarray(core.encode_ordinary(x) if plain(x) else core.encode(x, allowed_special="all"), "<u4").tobytes() for x in texts]


def _pieces(tokenizer: str, capacity: int, separator: int, start_of):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.asarray([separator], "<u4").tobytes()
        for batch in batches:
            for piece_batch in slices(batch, 1):
                keys, ns, starts, lengths, crcs, ranks = [], [], [], [], [], []
                texts = [x or "" for x in piece_batch.column(1).to_pylist()]
                for key, ids in zip(piece_batch.column(0).to_pylist(), token_ids(texts, tokenizer), strict=True):
                    ids += end
                    n = len(ids) // 4
                    at, piece = 0, 0
                    stop = start_of(n, capacity)
                    while at < n:
                        keys.append(key)
                        ns.append(piece)
                        starts.append(at)
                        lengths.append(stop - at)
                        crcs.append(crc32(ids[4 * at : 4 * stop]))
                        ranks.append(int(seen[stop - at]))
                        seen[stop - at] += 1
                        at, piece, stop = stop, piece + 1, stop + capacity
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, piece_batch.column(0).type), pa.array(ns, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array([part] * len(keys), pa.int32()), pa.array(ranks, pa.int64())],
                    ["key", "piece", "start", "length", "ids_crc32", "part", "rank"],
                )

    return run


def _first_stop(n: int, capacity: int) -> int:
    """Where the first piece ends: only it may be shorter than the capacity."""
    return (n - 1) % capacity + 1


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k.json", capacity: int = 2048, separator: int = 0, bounds: Bounds = Bounds()) -> DataFrame:
    """One row per piece: the key, piece, start, length, ids_crc32, sequence_id, offset."""
    kind = docs.schema[key].dataType.simpleString()
    cut = docs.select(F.col(key).alias("key"), text).mapInArrow(_pieces(tokenizer, capacity, separator, _first_stop), f"key {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long")
    cut = materialise(cut, "pieces")  # fixes each task's ranks
    counts = materialise(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    places = Places(complete(totals, capacity, bounds))
    names = [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.find(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names)

    ranked = cut.join(bases, ["part", "length"]).select("key", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank"))
    return ranked.mapInArrow(place, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
