"""Masked pseudo-likelihood scores from a bidirectional window network, trained in numpy.

Each word is predicted from the two words on either side, itself masked. All words of all documents are counted in
a table (by 64-bit hash), which grows with the corpus and never leaves the shared folder as a whole. The network turns both
sides into a vector h, and P(word | both sides) = share(word) * exp(h . output(word)) / Z, where share is the word's part of the
corpus and Z makes the probabilities sum to one over all counted words. Embeddings and outputs are rows of
two tables whose slots words reach by their hash; the number of slots grows with the words counted, up to 2**``most_bits``.
Z is a sum over slots: exact for the ``frequent`` ones, and estimated for the others from slots drawn by their share (in
training) or at fixed steps of their cumulated share (in scoring, so that equal texts have equal scores); the word's own slot is always
summed, so no probability is above one. A document's score is the sum of log P(word | both sides) over all its words.

Training is data-parallel over every word of every document: the rows are dealt to ``rounds`` rounds by a hash of their
text; in each, every task descends from the same start over its own rows, and the tasks' dense weights are averaged by
their words, those of a slot by how often each task met it. So weights, not counts, depend a little on the partitioning.

The shares of the ``known_words`` most frequent words travel with the network. All other words of a document go to the table of
counts by a join; none of them can be hot, as each is less than one part in ``known_words`` of the corpus.

Edge cases: null and empty texts have no words, a sum of 0 and a null mean; equal texts have equal scores; a word
that was not counted has the share of one that occurs once; a corpus without words leaves the start weights; rows that share a key
are each scored; an empty table gives an empty result. Columns besides the named ones are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.kernel import BLANK, LOWER, raw, tokens
from tamiz.llm.shared import materialise, slices

#: Rows of a table of weights that travel together.
BLOCK = 4096
#: Log ratios are at most this, so that their exponentials and the sums of these stay finite.
HIGHEST = 60.0
#: Tasks whose weights are added in one task, then so many such sums, and so on.
FAN_IN = 32
#: A task hands on its counts whenever it holds so many words.
HELD_WORDS = 1 << 20


@dataclass(frozen=True)
class Params:
    #: Slots: one for every ``words_per_slot`` different words, 2**8 at least and 2**most_bits at most.
    most_bits: int = 16
    words_per_slot: int = 4
    width: int = 12
    hidden: int = 24
    window: int = 2
    #: Slots that Z always sums; others drawn for a batch; others summed when scoring.
    frequent: int = 64
    drawn: int = 64
    fixed: int = 192
    batch: int = 2048
    rounds: int = 2
    rate: float = 0.1
    seed: int = 7
    known_words: int = 1 << 18


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    hashes, _, before = tokens(*raw(texts), BLANK, LOWER)
    return hashes, before


def _summed(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    word, at = np.unique(np.concatenate(words), return_inverse=True)
    return word, np.bincount(at, np.concatenate(counts), len(word)).astype(np.int64)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    held, kept = 0, 0
    for batch in batches:
        for part in slices(batch, 0):
            word, n = np.unique(_words(part.column(0))[0], return_counts=True)
            words.append(word)
            counts.append(n)
            held += len(word)
            if held > 2 * kept + HELD_WORDS:
                words, counts = ([x] for x in _summed(words, counts))
                held = kept = len(words[0])
                if kept > HELD_WORDS:
                    yield from _counted(words[0], counts[0])
                    words, counts, held, kept = [], [], 0, 0
    if words:
        yield from _counted(*_summed(words, counts))


def _counted(words: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(words), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(words[i : i + (1 << 16)].view(np.int64)), pa.array(counts[i : i + (1 << 16)])], ["word", "n"])


class Rows:
    """Numbers the different rows among many without sorting them."""

    def __init__(self, n: int):
        self.last = np.zeros(n, np.int32)

    def distinct(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The different values, and for each of ``at`` the place of its value among them."""
        here = np.arange(len(at), dtype=np.int32)
        self.last[at] = here
        last = self.last[at]
        first = last == here
        return at[first], (np.cumsum(first) - 1)[last]


class Sparse:
    """Adagrad over those rows of a table that a batch meets."""

    def __init__(self, table: np.ndarray):
        self.squares = np.zeros_like(table)
        self.met = np.zeros(len(table), np.int64)
        self.rows = Rows(len(table))

    def descend(self, table: np.ndarray, at: np.ndarray, part: np.ndarray, rate: float) -> None:
        rows, place = self.rows.distinct(at)
        g = np.empty((len(rows), part.shape[1]), np.float32)
        for k, column in enumerate(np.ascontiguousarray(part.T)):
            g[:, k] = np.bincount(place, column, len(rows))
        m = self.squares[rows] + g * g
        self.squares[rows] = m
        table[rows] -= rate * g / (np.sqrt(m) + 1)  # the one damps what was met seldom
        self.met[rows] += np.bincount(place, minlength=len(rows))

    def sent(self, task: int, number: int, table: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The met rows, times how often, and how often."""
        for b in range(0, len(table), BLOCK):
            n = self.met[b : b + BLOCK]
            if len(at := np.flatnonzero(n)):
                yield _sent(task, number, b // BLOCK, at, np.column_stack([table[b + at] * n[at, None], n[at]]))


class Network:
    """``share``: each slot's part of the corpus. ``known`` (sorted hashes) and ``log_counts``: the most frequent words."""

    def __init__(self, params: Params, share: np.ndarray, known: np.ndarray, log_counts: np.ndarray):
        p, rng = params, np.random.default_rng(params.seed)
        self.p, self.share, self.known, self.log_counts = p, share, known, log_counts
        self.bits = len(share).bit_length() - 1
        order = np.argsort(-share, kind="stable")
        self.top, rest = order[: p.frequent], np.sort(order[p.frequent :])
        self.rest = rest[share[rest] > 0]
        self.cumulated = np.cumsum(share[self.rest])
        self.own = np.zeros(len(share), np.float32)
        self.own[self.rest] = share[self.rest]
        self.embedding = rng.standard_normal((len(share) + 1, p.width), np.float32) * np.float32(0.3)
        self.output = np.zeros((len(share), p.hidden), np.float32)
        self.dense = [(rng.standard_normal((2 * p.window * p.width, p.hidden)) * 0.2).astype(np.float32), np.zeros(p.hidden, np.float32)]

    def slots(self, words: np.ndarray) -> np.ndarray:
        return (words >> np.uint64(64 - self.bits)).astype(np.int64)

    def contexts(self, slots: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The slots around each word [n, 2 * window]; places outside its text have the last embedding."""
        n, w = len(slots), self.p.window
        counts = np.diff(before)
        at = np.arange(n)
        low, high = np.repeat(before[:-1], counts), np.repeat(before[1:], counts)
        out = np.full((n, 2 * w), len(self.share), np.int64)
        for j, d in enumerate([*range(-w, 0), *range(1, w + 1)]):
            ok = (at + d >= low) & (at + d < high)
            out[ok, j] = slots[at[ok] + d]
        return out

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.embedding.take(context, 0).reshape(len(context), -1)
        return x, np.tanh(x @ self.dense[0] + self.dense[1])

    def sample(self, quantiles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The slots that Z sums, their weights, and the weight of each slot as a target, which Z sums too: its share, or
        zero where it is summed anyway. The frequent slots are summed, and of the others those at these parts of their
        cumulated share; where the others are no more than the parts, all of them, so that Z is exact."""
        own = self.own
        if len(self.rest) <= len(quantiles):
            at, weight, own = self.rest, self.share[self.rest], np.zeros_like(own)
        else:
            at = self.rest[np.minimum(np.searchsorted(self.cumulated, quantiles * self.cumulated[-1], side="right"), len(self.rest) - 1)]
            weight = np.full(len(at), self.cumulated[-1] / len(quantiles))
        return np.concatenate([self.top, at]), np.concatenate([self.share[self.top], weight]).astype(np.float32), own

    def log_ratios(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log P(word | both sides) - log share(word) of each target."""
        out = np.empty(len(target))
        noise, weight, mine = self.sample((np.arange(self.p.fixed) + 0.5) / self.p.fixed)
        ways = np.ascontiguousarray(self.output[noise].T)
        for s in range(0, len(target), 8192):
            y = target[s : s + 8192]
            _, h = self.forward(context[s : s + 8192])
            z = h @ ways
            own = np.minimum(np.einsum("ij,ij->i", h, self.output.take(y, 0)), HIGHEST)
            np.minimum(z, HIGHEST, out=z)
            out[s : s + 8192] = own - np.log(np.maximum(np.exp(z, out=z) @ weight + np.exp(own) * mine[y], 1e-30))
        return out

    def train(self, context: np.ndarray, target: np.ndarray, memory: Memory, rng: np.random.Generator) -> None:
        """One pass of Adagrad over the rows in order."""
        for s in range(0, len(target), self.p.batch):
            ctx, y = context[s : s + self.p.batch], target[s : s + self.p.batch]
            noise, weight, mine = self.sample(rng.random(self.p.drawn))
            x, h = self.forward(ctx)
            ways, own = self.output[noise], self.output.take(y, 0)
            z = h @ ways.T
            np.exp(np.minimum(z, HIGHEST, out=z), out=z)
            z *= weight
            e = np.exp(np.minimum(np.einsum("ij,ij->i", h, own), HIGHEST)) * mine[y]
            total = np.maximum(z.sum(1) + e, 1e-30)
            z /= total[:, None]
            miss = (e / total - 1)[:, None]
            dh = z @ ways + own * miss
            memory.output.descend(self.output, np.concatenate([noise, y]), np.concatenate([z.T @ h, h * miss]), self.p.rate)
            dh *= 1 - h * h
            dx = (dh @ self.dense[0].T).reshape(-1, self.p.width)
            memory.embedding.descend(self.embedding, ctx.ravel(), dx, self.p.rate)
            for w, m, g in zip(self.dense, memory.dense, (x.T @ dh / len(y), dh.mean(0)), strict=True):
                m += g * g
                w -= self.p.rate * g / (np.sqrt(m) + 1e-4)

    def sums(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Per text: the sum of the log ratios and of the known words' log counts, its known words that occur once, the words
        before it (n + 1 values), and the other words with the numbers of those before it (n + 1 values)."""
        words, before = _words(texts)
        slots = self.slots(words)
        place = np.minimum(np.searchsorted(self.known, words), max(0, len(self.known) - 1))
        known = self.known[place] == words if len(self.known) else np.zeros(len(words), bool)
        part = self.log_ratios(self.contexts(slots, before), slots)
        part[known] += self.log_counts[place[known]]
        single = np.zeros(len(words), bool)
        single[known] = self.log_counts[place[known]] == 0
        total, once, other = (np.concatenate([[0], np.cumsum(x)])[before] for x in (part, single, ~known))
        return np.diff(total), np.diff(once), before, words[~known], other


class Memory:
    def __init__(self, network: Network):
        self.dense = [np.zeros_like(w) for w in network.dense]
        self.embedding, self.output = Sparse(network.embedding), Sparse(network.output)


_SENT = "task long, table int, block int, at binary, values binary"


def _sent(task: int, table: int, block: int, at: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    cols = [pa.array([task]), pa.array([table], pa.int32()), pa.array([block], pa.int32()), pa.array([at.astype(np.int32).tobytes()]), pa.array([values.astype(np.float32).tobytes()])]
    return pa.RecordBatch.from_arrays(cols, ["task", "table", "block", "at", "values"])


def _add_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of rows of float32 by group of tasks, block and place, from rows sorted by these: one sum is held at a time."""
    key, values, met = None, None, None
    for batch in batches:
        for *own, at, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at = np.frombuffer(at, np.int32)
            part = np.frombuffer(x, np.float32).reshape(len(at), -1)
            if own != key:
                if key is not None:
                    yield _sent(*key, np.flatnonzero(met), values[met])
                n = BLOCK if own[1] else 1
                key, values, met = own, np.zeros((n, part.shape[1])), np.zeros(n, bool)
            values[at] += part
            met[at] = True
    if key is not None:
        yield _sent(*key, np.flatnonzero(met), values[met])


def _averaged(network: Network, rows: DataFrame, tasks: int) -> None:
    """The tasks' weights, averaged, into ``network``: added in a tree, so that no task reads more than ``FAN_IN`` tasks' rows of a
    block at once. What comes to the driver is no more than the two tables of slots."""
    while True:
        tasks = -(-tasks // FAN_IN)
        groups = ["task", "table", "block"]
        rows = rows.withColumn("task", F.floor(F.col("task") / FAN_IN)).repartition(*groups).sortWithinPartitions(*groups).mapInArrow(_add_rows, _SENT)
        if tasks <= 1:
            break
    for _, t, b, at, x in rows.collect():
        at = np.frombuffer(at, np.int32).astype(np.int64)
        values = np.frombuffer(x, np.float32).reshape(len(at), -1)
        mean = values[:, :-1] / values[:, -1:]
        if t:
            (network.embedding if t == 1 else network.output)[b * BLOCK + at] = mean
        else:
            n = network.dense[0].size
            network.dense = [mean[0, :n].reshape(network.dense[0].shape).copy(), mean[0, n:].copy()]


@dataclass
class Model:
    """The network, the table of all words' counts (word, n), its total, and the most that a word not known counts."""

    network: Network
    counts: DataFrame
    total: int
    least: int


def fit(docs: DataFrame, text: str = "text", params: Params = Params()) -> Model:
    """Counts and trains over all rows."""
    texts = docs.select(F.col(text).alias("text"))
    counts = materialise(texts.mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    different, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = min(params.most_bits, max(8, (different // params.words_per_slot).bit_length()))
    share = np.zeros(1 << bits)
    for slot, n in counts.groupBy(F.shiftrightunsigned("word", 64 - bits).alias("slot")).agg(F.sum("n").alias("n")).collect():  # at most 2**bits rows
        share[slot] = n / total
    known = counts.orderBy(F.desc("n"), "word").limit(params.known_words).toArrow()  # 16 bytes each
    hashes, n = known.column("word").to_numpy().view(np.uint64), known.column("n").to_numpy()
    order = np.argsort(hashes)
    network = Network(params, share, hashes[order], np.log(n[order]).astype(np.float32))
    sc = docs.sparkSession.sparkContext
    tasks = (texts.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0] or 0) + 1
    for r in range(params.rounds):
        shared = sc.broadcast(network)  # at most 2**most_bits slots and known_words words

        def train(batches: Iterable[pa.RecordBatch], shared=shared, r=r) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            task = TaskContext.get().partitionId()
            net, n, rng = None, 0, np.random.default_rng(params.seed + r)
            for batch in batches:
                for part in slices(batch, 0, 1 << 19):
                    if net is None:
                        net = _own(shared.value)
                        memory = Memory(net)
                    words, before = _words(part.column(0))
                    slots = net.slots(words)
                    net.train(net.contexts(slots, before), slots, memory, rng)
                    n += len(slots)
            if n:
                yield _sent(task, 0, 0, np.zeros(1), np.append(np.concatenate([w.ravel() for w in net.dense]).astype(np.float64) * n, float(n)))
                yield from memory.embedding.sent(task, 1, net.embedding)
                yield from memory.output.sent(task, 2, net.output)

        rows = texts.filter(F.pmod(F.xxhash64("text"), F.lit(params.rounds)) == r) if params.rounds > 1 else texts
        _averaged(network, rows.mapInArrow(train, _SENT), tasks)
        shared.unpersist()
    return Model(network, counts, total, int(n.min()) if len(n) else 0)


def _own(network: Network) -> Network:
    """A copy whose weights may change: the broadcast one is shared by a worker's tasks."""
    from copy import copy

    out = copy(network)
    out.embedding, out.output, out.dense = network.embedding.copy(), network.output.copy(), [w.copy() for w in network.dense]
    return out


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_words, n_once (its words, with repeats, that the corpus has but once), log_likelihood and mean_log_likelihood."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model.network)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 1 << 19):
                total, once, before, other, at = shared.value.sums(part.column(1))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(other.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(before)), pa.array(total), pa.array(once), lists], ["key", "n_words", "part", "single", "others"])

    scored = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n_words long, part double, single long, others array<long>")
    # Written with its row numbers, which are then fixed.
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    others = scored.select("row", F.explode("others").alias("word")).join(model.counts.filter(F.col("n") <= model.least), "word", "left")
    n = F.coalesce("n", F.lit(1))
    sums = others.groupBy("row").agg(F.sum(F.log(n)).alias("rest"), F.count_if(n == 1).alias("once"))
    total = F.col("part") + F.coalesce("rest", F.lit(0.0)) - F.col("n_words") * F.lit(float(np.log(max(1, model.total))))
    out = scored.drop("others").join(sums, "row", "left").select("key", "n_words", (F.col("single") + F.coalesce("once", F.lit(0))).alias("n_once"), total.alias("log_likelihood"))
    return out.select(F.col("key").alias(key), "n_words", "n_once", "log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).alias("mean_log_likelihood"))
