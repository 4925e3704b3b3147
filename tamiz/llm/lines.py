"""Line deduplication over overlapping windows of three lines.

A line of more than ``words`` words counts as several: it is wrapped after each word whose hash is the least among the ``around``
words on either side, so that a long passage has the same wrapped lines, and windows of its own, wherever in a line it begins. Every three consecutive lines of a text are a window. Of each
window that occurs more than once in the whole table (in one text or several), all occurrences but the first, by (key,
position), are cut: their covered positions are merged and the covered lines removed; what is left of a line that
was wrapped stays one line. So every line that goes still stands in an earlier place.

Edge cases: null texts stay null, with no lines; a text of fewer than three lines has no window and
stays; empty lines are lines; an empty text is one empty line; rows that share a key are texts of their own, ordered by a hash
of the text, and rows equal in both are one text, which keeps its first occurrences in each of them; keys may be of any type that has an
order; a null key takes part in nothing; an empty table gives an empty result. All other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.kernel import mix, raw, runs_of, wrapped_lines
from tamiz.llm.shared import materialise, scratch, slices

#: Cut lists of at most so many rows and positions (4 bytes each) are broadcast to the texts; more are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_POSITIONS = 300_000, 4_000_000
#: Words of a line that is not wrapped, and words on either side that a cut depends on (7 words a wrapped line on average, 4 at least but at the ends).
WORDS, AROUND = 16, 3


def _windows(width: int, words: int, around: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                hashes, _, _, _, before = wrapped_lines(*raw(part.column(2)), words, around)
                counts = np.diff(before)
                pos = np.arange(len(hashes)) - np.repeat(before[:-1], counts)
                start = pos + width <= np.repeat(counts, counts)
                grams, _ = runs_of(hashes, before, width)
                other = mix(grams ^ np.roll(hashes, -1) * np.uint64(0xC2B2AE3D27D4EB4F))
                key = pa.array(np.repeat(np.arange(len(counts)), counts)[start])
                yield pa.RecordBatch.from_arrays([pa.array(grams[start].view(np.int64)), pa.array(other[start].view(np.int64)), part.column(0).take(key), part.column(1).take(key), pa.array(pos[start].astype(np.int32))], ["h1", "h2", "doc", "row", "pos"])

    return run


def _without(words: int, around: int):
    @F.arrow_udf("text string, n_lines long, n_removed long")
    def run(text: pa.Array, cut: pa.Array) -> pa.Array:
        """Each text without its cut lines, and how many it has and loses."""
        texts, n_lines, n_removed = [], [], []
        for part in slices(pa.RecordBatch.from_arrays([text, cut], ["text", "cut"]), 0):
            data, offsets = raw(part.column(0))
            _, begins, ends, line, before = wrapped_lines(data, offsets, words, around)
            whole = data.tobytes()
            for row, (x, gone) in enumerate(zip(part.column(0), part.column(1), strict=True)):
                low, n = int(before[row]), int(before[row + 1] - before[row])
                if gone.is_valid:
                    kept = np.setdiff1d(np.arange(low, low + n), low + gone.values.to_numpy())
                    feed = np.diff(line[kept], prepend=line[kept[:1]]) > 0
                    spans = zip(begins[kept].tolist(), ends[kept].tolist(), feed.tolist(), strict=True)
                    texts.append(b"".join(b"\n" * f + whole[a:b] for a, b, f in spans).decode())
                    n_removed.append(n - len(kept))
                else:
                    texts.append(x.as_py())
                    n_removed.append(0)
                n_lines.append(n if x.is_valid else 0)
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], ["text", "n_lines", "n_removed"])

    return run


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, words: int = WORDS, around: int = AROUND) -> DataFrame:
    """(doc, row, cut): the merged positions (from 0) of the lines to remove, for texts that have any. ``row`` is a hash of the text."""
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("doc"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    windows = materialise(texts.mapInArrow(_windows(width, words, around), f"h1 long, h2 long, doc {kind}, row long, pos int"), "windows")
    place = F.struct("doc", "row", "pos")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").select("h1", "h2", "first")
    # Written before the join, so that both its sides are plain exchanges, of which Spark splits hot ones.
    first = materialise(first, "first")
    later = windows.join(first, ["h1", "h2"]).filter(place != F.col("first")).select("doc", "row", "pos").distinct()
    covered = F.sequence(F.col("pos"), F.col("pos") + (width - 1))
    return later.groupBy("doc", "row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(covered)))).alias("cut"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, words: int = WORDS, around: int = AROUND) -> DataFrame:
    """``docs`` with the later occurrences cut from ``text``, and (replacing columns of these names)
    ``n_lines``, the number of lines before, and ``n_removed``, both of wrapped lines."""
    with scratch() as made:
        cuts = materialise(repeated_lines(docs, key, text, width, words, around), "cuts")
        made.sweep(cuts)
    cuts = cuts.select(F.col("doc").alias("__doc"), F.col("row").alias("__row"), F.col("cut").alias("__cut"))
    rows, positions = cuts.agg(F.count("*"), F.coalesce(F.sum(F.size("__cut")), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and positions <= BROADCAST_POSITIONS:
        cuts = F.broadcast(cuts)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    met = docs.select(names).join(cuts, (F.col(key) == F.col("__doc")) & (F.xxhash64(text) == F.col("__row")), "left")
    met = met.withColumn("__left", _without(words, around).asNondeterministic()(F.col(text), F.col("__cut")))  # so that no filter makes it run twice
    left = [F.col("__left.text").alias(c) if c == text else F.col(c) for c in names]
    return met.select(*left, "__left.n_lines", "__left.n_removed")
