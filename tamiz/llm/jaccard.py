"""Exact Jaccard join of sets of word shingles, as connected components.

Two documents link when 100 * |A and B| >= threshold * |A or B| over their distinct 5-word shingles.
The join uses relations between sets twice, and never makes all pairs of a group:

* Equal sets form one class at once; a class is one node of everything below.
* An inverted index over prefixes (shingles in an order of rare first, taken from a count sketch of all
  documents) gives lists of nodes that share a shingle. Lists are sorted by set size and position.
* Answers of one set first: each list's first node is its centre, and every other node is compared with
  the centre alone. Nodes found linked become one cluster.
* Lists that still hold several clusters are read in blocks of one size; by position, the rest of a
  block is skipped where the overlap can no longer suffice. Pairs inside a cluster are skipped. For the
  others, the answers of a set are derived from those of the centre that both were compared with:
  |A and B| <= |A and C| + |B| - |B and C|; only pairs whose derived bound suffices are compared.
* Before whole sets are moved, a pair must pass a bitmap of parities: two sets' bitmaps differ in no more
  bits than the sets differ in members, so a pair whose bitmaps differ in more than it may is put aside.
  Lists carry a folded bitmap, by which such pairs are never made.

Hot shingles are dealt over several tasks by a salt (to find shared ones) and by pairs of blocks of bounded
length (to read long lists), so no task takes a whole list that grows with the data.

Edge cases: null and empty texts, and texts without words, have size 0 and link with nothing; rows that
share an id are one document, with one result row each: where their texts differ, the links of any of them are
the document's, and each row, one of an empty text too, has its component; a null id gets a null component; ties need no order; an empty table gives an empty result. Columns besides the key and the text are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.components import connected
from tamiz.llm.kernel import BLANK, LOWER, raw, runs_of, tokens
from tamiz.llm.shared import discard, materialise, release, row_count_at_most, slices

#: The sketch has 2**BITS counters, sent in CHUNKS pieces.
BITS, CHUNKS = 20, 256
#: Keys of at most so many documents (8 bytes each) are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_KEYS = 2_000_000
#: Length of a block of a list; two blocks meet in one task.
BLOCK = 1024
#: Bits of a parity bitmap.
PARITY = 2048
#: Bits of the smaller bitmap that goes along with the lists: the larger one's, folded.
SMALL = 512


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each row, the sorted distinct 64-bit hashes of its k-word shingles."""
    hashes, _, before = tokens(*raw(texts), BLANK, LOWER)
    grams, ok = runs_of(hashes, before, k)
    counts = np.diff(before)
    for start, n in zip(before[:-1].tolist(), counts.tolist(), strict=True):
        if n == 0:
            yield np.zeros(0, np.uint64)
        elif n <= k:
            yield grams[start : start + 1]
        else:
            x = np.sort(grams[start : start + n - k + 1])
            fresh = np.empty(len(x), bool)
            fresh[0] = True
            np.not_equal(x[1:], x[:-1], out=fresh[1:])
            yield x if fresh.all() else x[fresh]


def _signature(u: np.ndarray) -> tuple[int, int]:
    return int(u.sum(dtype=np.uint64).view(np.int64)), int((u * (u >> np.uint64(29))).sum(dtype=np.uint64).view(np.int64))


def _measure(k: int):
    """Per row its set's size and 128-bit signature; per task, also the sketch of its sets."""
    names = ["doc", "n", "k1", "k2", "chunk", "counts"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, some = np.zeros(1 << BITS, np.uint32), False
        for batch in batches:
            for part in slices(batch, 1):
                sets = list(shingle_sets(part.column(1), k))
                if any(map(len, sets)):
                    some = True
                    sketch += np.bincount((np.concatenate(sets) >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS).astype(np.uint32)
                signs = [_signature(u) for u in sets]
                m = len(sets)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(u) for u in sets], pa.int32()), pa.array([s[0] for s in signs], pa.int64()), pa.array([s[1] for s in signs], pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        if some:
            pieces = sketch.reshape(CHUNKS, -1)
            none = pa.nulls(CHUNKS, pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.nulls(CHUNKS, pa.int32()), none, none, pa.array(range(CHUNKS), pa.int32()), pa.array([x.tobytes() for x in pieces], pa.binary())], names)

    return run


def _add_sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for c, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(x, np.uint32).astype(np.uint64)
            total[c] = total[c] + part if c in total else part
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["chunk", "counts"])


def _levels(measured: DataFrame) -> np.ndarray:
    """For each counter, 0 for what chance explains, else a value that rises with the count (a byte)."""
    width = (1 << BITS) // CHUNKS
    counts = np.zeros((CHUNKS, width))
    sums = measured.filter("chunk is not null").select("chunk", "counts").repartition(16, "chunk").mapInArrow(_add_sketches, "chunk int, counts binary")
    for c, x in sums.collect():  # CHUNKS rows of fixed size
        counts[c] = np.frombuffer(x, np.uint64)
    mean = np.median(counts)
    excess = counts.ravel() - mean - 6 * np.sqrt(mean + 1)
    return np.where(excess > 0, 1 + np.floor(4 * np.log2(1 + np.maximum(excess, 0))), 0).astype(np.uint8)


def _prefixes(k: int, threshold: int, levels: np.ndarray):
    # Columns that change from row to row first, then those that stay within a document: so the shuffle's rows are packed best.
    names = ["token", "pos", "salt", "doc", "n"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # no more than the task's rows
        for batch in batches:
            for part in slices(batch, 1):
                keys, out, docs, sizes, places, lifts = part.column(0).to_pylist(), [], [], [], [], []
                for key, u in zip(keys, shingle_sets(part.column(1), k), strict=True):
                    n = len(u)
                    if n == 0 or key is None or (sign := _signature(u)) in seen:
                        continue
                    seen.add(sign)
                    p = n - (threshold * n + 99) // 100 + 1
                    level = levels[(u >> np.uint64(64 - BITS)).astype(np.int64)]
                    if level.any():
                        order = np.argsort(level, kind="stable")[:p]
                        u, level = u[order], level[order]
                    out.append(u[:p])
                    lifts.append(level[:p])
                    docs.append(np.full(p, key, np.int64))
                    sizes.append(np.full(p, n, np.int32))
                    places.append(np.arange(p, dtype=np.int32))
                if out:
                    doc = np.concatenate(docs)
                    # A shingle in about 2**11 documents or more is dealt over tasks by its documents.
                    bits = np.maximum(np.concatenate(lifts).astype(np.int64) // 4 - 11, 0)
                    salt = np.where(bits > 0, 1 + ((doc * 0x9E3779B1) >> 7 & ((1 << bits) - 1)), 0)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(places)), pa.array(salt.astype(np.int32)), pa.array(doc), pa.array(np.concatenate(sizes))], names)

    return run


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, salt), those whose token has another row, or is salted."""
    held: pa.RecordBatch | None = None
    held_kept = False
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        token, salt = batch.column("token").to_numpy(), batch.column("salt").to_numpy()
        same = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
        keep = salt > 0
        keep[1:] |= same
        keep[:-1] |= same
        if held is not None:
            keep[0] |= held_kept
        held, held_kept = batch.slice(batch.num_rows - 1), bool(keep[-1])
        yield batch.filter(pa.array(np.append(keep[:-1], False))).select(["token", "doc", "n", "pos"])
    if held is not None and held_kept:
        yield held.select(["token", "doc", "n", "pos"])


def _set_rows(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sets = list(shingle_sets(part.column(1), k))
                offsets = np.concatenate([[0], np.cumsum([len(u) for u in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))], ["doc", "grams"])

    return run


def _parities(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows, small, sizes = [], [], []
                for u in shingle_sets(part.column(1), k):
                    odd = np.bincount((u >> np.uint64(20)).astype(np.int64) & (PARITY - 1), minlength=PARITY).astype(np.uint8) & 1
                    whole = np.packbits(odd, bitorder="little").view(np.int64)
                    rows.append(whole)
                    small.append(np.bitwise_xor.reduce(whole.reshape(-1, SMALL // 64), axis=0))
                    sizes.append(len(u))
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * (size // 64)), pa.array(np.concatenate(x))) for x, size in ((rows, PARITY), (small, SMALL))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int32()), *lists], ["doc", "n", "bits", "small"])

    return run


def _pick(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of (doc, text) whose doc is in ``ids`` (a written table of distinct keys)."""
    keys = F.broadcast(ids) if row_count_at_most(ids, BROADCAST_KEYS) else ids
    return texts.join(keys, "doc", "left_semi").select("doc", "text")


def may_link(pairs: DataFrame, bits: DataFrame, threshold: int) -> DataFrame:
    """Pairs (x, nx, y, ny) whose parity bitmaps allow a link. ``bits``: (doc, n, bits), with several rows for a document of
    several texts; then a pair comes once for each two bitmaps that allow it."""
    x = bits.select(F.col("doc").alias("x"), F.col("n").alias("nx"), F.col("bits").alias("bx"))
    y = bits.select(F.col("doc").alias("y"), F.col("n").alias("ny"), F.col("bits").alias("by"))
    met = pairs.join(x, ["x", "nx"]).join(y, ["y", "ny"])
    apart = F.aggregate(F.zip_with("bx", "by", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    return met.filter(apart <= F.col("nx") + F.col("ny") - 2 * _required(F.col("nx"), F.col("ny"), threshold)).select("x", "nx", "y", "ny")


def overlaps(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """``pairs`` (x, nx, y, ny) with their exact overlap ``o``, written. ``texts``: (doc, text)."""
    ids = materialise(pairs.select(F.col("x").alias("doc")).union(pairs.select("y")).distinct(), "ids")
    sets = materialise(_pick(texts, ids).mapInArrow(_set_rows(k), "doc long, grams array<long>"), "sets")
    x = sets.select(F.col("doc").alias("x"), F.col("grams").alias("gx"))
    y = sets.select(F.col("doc").alias("y"), F.col("grams").alias("gy"))
    met = pairs.join(x, "x").filter(F.size("gx") == F.col("nx")).join(y, "y").filter(F.size("gy") == F.col("ny"))
    out = materialise(met.select("x", "nx", "y", "ny", F.size(F.array_intersect("gx", "gy")).alias("o")).groupBy("x", "nx", "y", "ny").agg(F.max("o").alias("o")), "compared")
    del x, y, met
    discard(ids, sets)
    return out


def _required(nx, ny, threshold: int):
    """The least overlap with which sets of two sizes link: o with 100 o >= t (nx + ny - o)."""
    return F.ceil(threshold * (nx + ny) / F.lit(100.0 + threshold) - 1e-9)


def _blocks(threshold: int):
    """Reads runs of rows (token, bi, bj, n, pos, node, label, o, side, small) sorted by the first five; yields pairs to compare."""

    def pairs_of(n, pos, node, label, o, side, small, both):
        """Lists are sorted by size, then position. ``both``: two different blocks meet."""
        xs, ys = [], []
        size = n.astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], size[1:] != size[:-1]]))
        ends = np.append(starts[1:], len(size))
        firsts = size[starts]
        for i in range(len(size)):
            ni = size[i]
            lo = int(np.searchsorted(firsts, ni))
            hi = int(np.searchsorted(firsts, ni * 100 // threshold, side="right"))
            for b in range(lo, hi):
                s, e, nj = max(int(starts[b]), i + 1), int(ends[b]), int(firsts[b])
                need = -(-threshold * int(ni + nj) // (100 + threshold))
                if ni - pos[i] < need or s >= e:
                    continue
                # Positions rise within a block: all after the first too late one are skipped.
                e = s + int(np.searchsorted(pos[s:e], nj - need, side="right"))
                if s >= e:
                    continue
                ok = label[s:e] != label[i]
                if both:
                    ok &= side[s:e] != side[i]
                if o[i] >= 0:
                    known = o[s:e] >= 0
                    bound = np.minimum(o[i] + nj - o[s:e], o[s:e] + ni - o[i])
                    ok &= ~known | (bound >= need)
                at = s + np.flatnonzero(ok)
                if len(at):
                    at = at[np.bitwise_count(small[at] ^ small[i]).sum(1) <= ni + nj - 2 * need]
                if len(at):
                    xs.append(np.full(len(at), i))
                    ys.append(at)
        if not xs:
            return None
        x, y = np.concatenate(xs), np.concatenate(ys)
        return node[x], size[x], node[y], size[y]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(t: pa.Table) -> Iterator[pa.RecordBatch]:
            t = t.combine_chunks()
            c = {name: t.column(name).to_numpy() for name in t.column_names if name != "small"}
            c["small"] = pc.list_flatten(t.column("small")).to_numpy().view(np.uint64).reshape(len(t), -1)
            new = (c["token"][1:] != c["token"][:-1]) | (c["bi"][1:] != c["bi"][:-1]) | (c["bj"][1:] != c["bj"][:-1])
            cuts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(t)]]).tolist()
            found = []
            for s, e in zip(cuts, cuts[1:], strict=False):
                if e - s > 1:
                    got = pairs_of(*(c[x][s:e] for x in ("n", "pos", "node", "label", "o", "side", "small")), c["bi"][s] != c["bj"][s])
                    if got:
                        found.append(got)
            if found:
                x, nx, y, ny = (np.concatenate(z) for z in zip(*found, strict=True))
                swap = x > y
                out = np.unique(np.stack([np.where(swap, y, x), np.where(swap, ny, nx), np.where(swap, x, y), np.where(swap, nx, ny)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1].astype(np.int32)), pa.array(out[2]), pa.array(out[3].astype(np.int32))], ["x", "nx", "y", "ny"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            last = {name: t.column(name)[len(t) - 1] for name in ("token", "bi", "bj")}
            mine = pc.and_(pc.and_(pc.equal(t.column("token"), last["token"]), pc.equal(t.column("bi"), last["bi"])), pc.equal(t.column("bj"), last["bj"]))
            n = len(t) - pc.sum(mine).as_py()  # the last run may go on; it has 2 * BLOCK rows or so
            if n:
                yield from done(t.slice(0, n))
            held = t.slice(n)
        if held is not None and len(held):
            yield from done(held)

    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, threshold: int = 80) -> DataFrame:
    """Per row of ``docs``: the key, ``n_shingles`` (size of its set) and ``component_id`` (the smallest key
    reachable by links, its own included)."""
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    measured = materialise(texts.mapInArrow(_measure(k), "doc long, n int, k1 long, k2 long, chunk int, counts binary"), "measured")
    levels = _levels(measured)

    sizes = measured.filter("chunk is null").select("doc", "n", "k1", "k2")
    # Tables are written before they meet hot keys, so that both sides of a join are plain exchanges, which Spark can split.
    classes = materialise(sizes.filter("n > 0 and doc is not null").groupBy("n", "k1", "k2").agg(F.min("doc").alias("node")), "classes")
    sign = F.struct("n", "k1", "k2")
    several = sizes.filter("n > 0 and doc is not null").groupBy("doc").agg(F.min(sign).alias("low"), F.max(sign).alias("high")).filter("low <> high").select("doc")
    several = materialise(several, "several")
    members = sizes.join(classes, ["n", "k1", "k2"], "left").select("doc", "n", F.coalesce("node", "doc").alias("node"))
    members = materialise(members, "members")

    index = texts.mapInArrow(_prefixes(k, threshold, levels), "token long, pos int, salt int, doc long, n int")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = index.repartition(parts, "token", "salt").sortWithinPartitions("token", "salt").mapInArrow(_shared, "token long, doc long, n int, pos int")
    found = materialise(index, "index")
    del index
    release(docs.sparkSession)  # the prefixes' shuffle files: all that is shared is written
    nodes = members.filter("n > 0 and doc is not null").select("doc", "n", "node").distinct()
    index = materialise(found.join(nodes, ["doc", "n"]).select("token", "node", "n", "pos").distinct(), "lists")
    discard(found, measured)

    # A document of several texts links the classes of all of them.
    linked = materialise(nodes.join(several, "doc").select(F.col("doc").alias("a"), F.col("node").alias("b")), "links")
    known, labels, bits, written = None, None, None, index
    for pick in (F.min, F.max):
        lists = _with_labels(index, labels)
        me = F.struct("node", "n", "pos", "label")
        centres = lists.groupBy("token").agg(pick(me).alias("c"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("token", "c")
        centres = materialise(centres, "centres")
        # Lists of one cluster are done; only the others go on.
        met = materialise(lists.join(centres, "token"), "lists")
        del lists
        discard(centres, written)
        written, index = met, met.select("token", "node", "n", "pos")
        if bits is None:
            ids = materialise(index.select(F.col("node").alias("doc")).distinct(), "ids")
            bits = materialise(_pick(texts, ids).mapInArrow(_parities(k), "doc long, n int, bits array<long>, small array<long>").dropDuplicates(["doc", "n", "bits"]), "bits")
        pairs = met.filter(F.col("label") != F.col("c.label"))
        nx, ny, need = F.col("c.n"), F.col("n"), _required(F.col("c.n"), F.col("n"), threshold)
        pairs = pairs.filter((nx - F.col("c.pos") >= need) & (ny - F.col("pos") >= need) & (100 * F.least(nx, ny) >= threshold * F.greatest(nx, ny)))
        pairs = materialise(pairs.select(F.col("c.node").alias("x"), nx.alias("nx"), F.col("node").alias("y"), ny.alias("ny")).distinct(), "pairs")
        tried, pairs = pairs, materialise(may_link(pairs, bits, threshold), "pairs")
        compared = overlaps(pairs, texts, k)
        known = compared if known is None else known.union(compared)
        linked = linked.union(_links(compared, threshold))
        labels = connected(linked)
        discard(tried, pairs)

    # Lists that still hold several clusters.
    lists = _with_labels(index, labels)
    me = F.struct("node", "n", "pos")
    left = lists.groupBy("token").agg(F.min(me).alias("c"), F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("m")).filter("low <> high").select("token", F.col("c.node").alias("centre"), "m")
    left = materialise(left, "left")
    answers = known.select(F.col("x").alias("centre"), F.col("y").alias("node"), "o").groupBy("centre", "node").agg(F.min("o").alias("o"))
    if not several.isEmpty():  # an overlap says nothing of a document's other texts
        answers = answers.join(several.withColumnRenamed("doc", "centre"), "centre", "left_anti").join(several.withColumnRenamed("doc", "node"), "node", "left_anti")
        own = several.select(F.col("doc").alias("centre"), F.lit(True).alias("many"))
        left = left.join(own, "centre", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    else:
        left = left.withColumn("many", F.lit(False))
    lists = lists.join(left, "token").join(answers, ["centre", "node"], "left").select("token", "node", "n", "pos", "label", F.when(~F.col("many") & (F.col("node") == F.col("centre")), F.col("n")).otherwise(F.coalesce("o", F.lit(-1))).cast("int").alias("o"), F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    lists = lists.join(bits.select(F.col("doc").alias("node"), "n", "small"), ["node", "n"])
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    lists = lists.withColumn("side", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lists = lists.select("token", F.least("side", "other").alias("bi"), F.greatest("side", "other").alias("bj"), "n", "pos", "node", "label", "o", "side", "small")
    order = ["token", "bi", "bj", "n", "pos"]
    pairs = lists.repartition(parts, "token", "bi", "bj").sortWithinPartitions(*order).mapInArrow(_blocks(threshold), "x long, nx int, y long, ny int").distinct()
    swap = F.col("x") > F.col("y")
    tried = known.select(F.least("x", "y").alias("x"), F.when(swap, F.col("ny")).otherwise(F.col("nx")).alias("nx"), F.greatest("x", "y").alias("y"), F.when(swap, F.col("nx")).otherwise(F.col("ny")).alias("ny"))
    fresh = materialise(pairs.join(tried, ["x", "nx", "y", "ny"], "left_anti").select("x", "nx", "y", "ny"), "pairs")
    del lists, pairs
    discard(written)
    pairs = materialise(may_link(fresh, bits, threshold), "pairs")
    discard(fresh, bits)
    compared = overlaps(pairs, texts, k)
    labels = connected(linked.union(_links(compared, threshold)))

    out = members.join(labels.withColumnRenamed("label", "reached"), "node", "left")
    return out.select(F.col("doc").alias(key), F.col("n").cast("long").alias("n_shingles"), F.coalesce("reached", "node").alias("component_id"))


def _with_labels(index: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return index.withColumn("label", F.col("node"))
    return index.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _links(compared: DataFrame, threshold: int) -> DataFrame:
    return compared.filter(100 * F.col("o") >= threshold * (F.col("nx") + F.col("ny") - F.col("o"))).select(F.col("x").alias("a"), F.col("y").alias("b"))
