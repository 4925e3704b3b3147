"""Language identification by a bit-sliced Bloom filter of character n-grams.

Each slot of the filter holds a bitmask of languages, so one lookup of an n-gram (the AND of its
slots) returns all languages whose texts contain it. A language contains an n-gram if the n-gram's share there is
at least ``ratio`` of its largest share in any language. Of a text's n-grams (letters with word edges), those of each
language are counted, corrected for the language's false positive rate, and the largest count
decides; its share of all n-grams is the score.

Edge cases: null texts and texts without a letter are ``und`` with score 0; so is everything if no row has
a language; ties go to the first language by name; masks have as many 64-bit words as the languages need;
repeated rows get one result each. Columns besides the named ones are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.kernel import mix
from tamiz.llm.shared import discard, materialise, slices

#: N-grams are told apart by so many bits of their hash.
GRAM_BITS = 20


@dataclass(frozen=True)
class Params:
    n: int = 4
    ratio: float = 0.2
    min_share: float = 2e-6
    slots: int = 1 << 21
    probes: int = 3


@cache
def _letters() -> np.ndarray:
    """For each code point, its lower-case letter's code point, or 0."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def grams(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (GRAM_BITS) of all n-grams of words with their edges, and for each row the number before it.
    An n-gram has at least two letters, or one that is a word by itself."""
    texts = [x or "" for x in texts]
    lengths = np.array([len(x) + 2 for x in texts])
    joined = "".join(f" {x} " for x in texts)
    c = _letters()[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
    ends = np.cumsum(lengths)
    c = np.concatenate([c, np.zeros(n, np.uint32)])
    m = len(c) - n + 1
    h = np.zeros(m, np.uint64)
    gap = np.zeros(m, np.int8)
    for j in range(n):
        part = c[j : j + m]
        h = h * np.uint64(0x9E3779B97F4A7C15) + part
        if 0 < j < n - 1:
            gap += part == 0
    # Edges may stand only at the ends.
    ok = np.flatnonzero((gap == 0) & (c[1 : m + 1] != 0))
    # A word of one letter is shorter than an n-gram of more than its two edges and itself.
    alone = np.flatnonzero((c[:-2] == 0) & (c[1:-1] != 0) & (c[2:] == 0)) if n > 3 else ok[:0]
    if len(alone):
        code = np.concatenate([h[ok], c[1:-1][alone] * np.uint64(0xC2B2AE3D27D4EB4F)])
        ok = np.concatenate([ok, alone])
        order = np.argsort(ok, kind="stable")
        return (mix(code[order]) >> np.uint64(64 - GRAM_BITS)).astype(np.uint32), np.searchsorted(ok[order], np.concatenate([[0], ends]))
    return (mix(h[ok]) >> np.uint64(64 - GRAM_BITS)).astype(np.uint32), np.searchsorted(ok, np.concatenate([[0], ends]))


def _count(n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 0, 1 << 20):
                langs = part.column(1).to_pylist()
                code, before = grams(part.column(0).to_pylist(), n)
                index = {x: i for i, x in enumerate(dict.fromkeys(langs))}
                owner = np.repeat(np.array([index[x] for x in langs]), np.diff(before))
                for name, i in index.items():
                    counts = np.bincount(code[owner == i], minlength=1 << GRAM_BITS)
                    total[name] = total[name] + counts if name in total else counts
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "gram", "n"])

    return run


@dataclass
class Model:
    languages: list[str]
    masks: np.ndarray  # [slots, words] of uint64
    false_rate: np.ndarray
    params: Params

    def probes(self, code: np.ndarray) -> Iterator[np.ndarray]:
        h = mix(code.astype(np.uint64) + np.uint64(0x51ED270B))
        step = (h >> np.uint64(32)) | np.uint64(1)
        for j in range(self.params.probes):
            yield ((h + np.uint64(j) * step) & np.uint64(self.params.slots - 1)).astype(np.int64)

    def lookup(self, code: np.ndarray) -> np.ndarray:
        """Bitmasks [len(code), words] of the languages that contain each n-gram."""
        found = None
        for at in self.probes(code):
            got = self.masks[at]
            found = got if found is None else found & got
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        code, before = grams(texts, self.params.n)
        n = np.diff(before)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        found = self.lookup(code)
        counts = np.zeros((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            bit = (found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            seen = np.concatenate([[0], np.cumsum(bit)]).astype(np.int64)
            counts[:, i] = seen[before[1:]] - seen[before[:-1]]
        f = self.false_rate
        counts = np.maximum(0, (counts - n[:, None] * f) / (1 - f))
        best = counts.argmax(1)
        score = np.where(n > 0, np.minimum(1, counts[np.arange(len(texts)), best] / np.maximum(n, 1)), 0.0)
        letters = (k or any(map(str.isalpha, x or "")) for k, x in zip(n.tolist(), texts, strict=True))
        return [self.languages[b] if known else "und" for b, known in zip(best.tolist(), letters, strict=True)], score


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", params: Params = Params()) -> Model:
    """Learns from all rows where ``learn`` holds and the language is not null."""
    rows = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang)
    counted = materialise(rows.mapInArrow(_count(params.n), "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").collect()  # one row a language
    languages = [r.lang for r in totals]
    model = Model(languages, np.zeros((params.slots, max(1, -(-len(languages) // 64))), np.uint64), np.zeros(len(languages)), params)
    if not languages:
        return model
    numbered = docs.sparkSession.createDataFrame([(r.lang, i, r.total) for i, r in enumerate(totals)], "lang string, i int, total long")
    shares = counted.join(F.broadcast(numbered), "lang").select("gram", F.struct((F.col("n") / F.col("total")).alias("share"), "i").alias("s"))
    # Languages meet at an n-gram before anything comes to the driver: one row an n-gram, 2**GRAM_BITS at most, whatever the number of languages.
    met = shares.filter(F.col("s.share") >= params.min_share).groupBy("gram").agg(F.collect_list("s").alias("l"), F.max("s.share").alias("most"))
    kept = F.transform(F.filter("l", lambda s: s["share"] >= params.ratio * F.col("most")), lambda s: s["i"])
    lists = met.select("gram", kept.alias("of")).toArrow()
    discard(counted)
    of = lists.column("of").combine_chunks()
    gram = np.repeat(lists.column("gram").to_numpy(), np.diff(of.offsets.to_numpy()))
    owner = of.values.to_numpy()
    for i in range(len(languages)):
        code = gram[owner == i]
        bit = np.uint64(1 << (i % 64))
        for at in model.probes(code):
            model.masks[at, i // 64] |= bit
        model.false_rate[i] = ((model.masks[:, i // 64] & bit) != 0).mean() ** params.probes
    return model


def identify(docs: DataFrame, model: Model, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score; other columns stay (those of these names are replaced)."""
    docs = docs.drop(lang_out, score_out)
    names, at = docs.columns, docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict
        for batch in batches:
            for part in slices(batch, at, 1 << 20):
                langs, scores = predict(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores)], [*names, lang_out, score_out])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())]))
