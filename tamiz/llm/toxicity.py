"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

1. A character trigram model is counted over the words of all documents (a table of fixed size).
2. Tokens that may be disguised (digits or signs inside a word, a letter three times or more, single
   letters set apart) become lattices of characters. Viterbi finds the likeliest restored string
   under channel costs and the character model. A token whose lattice has one path is itself.
3. Words and word beginnings (stems of inflected words) of restored labelled texts make a lexicon: each entry that
   occurs more often in toxic texts than chance allows carries the log of how many times more often, whatever the language.
   Places in different contexts are counted, so copies and repetitions do not make words evidence.
4. A logistic score learned from the same labelled texts reads how much a text holds of the lexicon: the sum of its
   entries' weights (of each word the longest entry), that sum by its words, and the largest weight.

The labelled sample is bounded by parameters; its rows are found by a semi-join and written once.

Edge cases: null and empty texts have no entries and get the learned base score; a null ``toxic`` is no
label; repeated rows are scored alike, one result each; an empty table gives an empty result; without
labels of both classes the lexicon is empty and every score is the smoothed share of toxic labels. Columns besides the named
ones are never read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.shared import held_out, materialise, slices

#: Symbols of the character model: 0 the edge of a word, 1 any other letter, a-z, then U+00DF-U+00FF.
EDGE, OTHER = 0, 1
SIZE = 28 + 33
_CLASS = np.full(0x250, OTHER, np.uint8)
_CLASS[:0xAA] = EDGE
_CLASS[97:123] = np.arange(2, 28)
_CLASS[65:91] = np.arange(2, 28)
_CLASS[0xDF:0x100] = np.arange(28, 61)
_CLASS[0xC0:0xDF] = np.arange(29, 60)
_CLASS[[0xD7, 0xF7, 0xAB, 0xAC, 0xAD, 0xAE, 0xAF, 0xB0, 0xB1, 0xB4, 0xB6, 0xB7, 0xB8, 0xBB, 0xBF]] = EDGE

#: What a sign may stand for, in the order of its likelihood. Fixed values of this operator.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "", "#": "h",
}
#: Channel costs in nats: a sign read as a letter, a less likely letter, a dropped sign, kept as it is, a repetition cut short, a gap closed, and a gap kept as the edge of a word.
READ, SECOND, DROP, KEEP, CUT, CLOSE, SPLIT = 0.5, 0.7, 6.0, 8.0, 0.3, 0.2, 4.0

_SIGN = "".join(re.escape(c) for c in LEET)
#: White space and the punctuation that is never a sign end a token; a bracket inside one is a sign.
_IN = r"[^\s.,;:?\"'()\[\]]"
_TOKEN = re.compile(rf"{_IN}+(?:\(+{_IN}+)*")
#: What makes a token one that may be disguised, alone or within a text.
_ODD = re.compile(rf"[^\W\d_][{_SIGN}]+[^\W\d_]|(?<!{_IN})[{_SIGN}]+[^\W\d_]{{2}}|[^\W\d_]{{2}}[{_SIGN}](?!{_IN})|([^\W\d_])\1\1", re.I)
#: What sets letters apart: white space, or one sign.
_GAPS, _BLANKS = " .-_*·", " \t\n\r\f\v\xa0"
_GAP = rf"(?:[{_BLANKS}]+|[.\-_*·])"
_ONE = rf"(?:[^\W\d_]|[{_SIGN}\d])"
#: Four single letters or more, set apart, or three that are set apart alike.
_SPACED = re.compile(rf"(?<![^\W_])[^\W_](?:(?:{_GAP}{_ONE}){{3,}}|({_GAP}){_ONE}\1{_ONE})(?![^\W_])")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Params:
    """Bounds and thresholds; ``positives`` and ``negatives`` bound the labelled sample of the fit.
    An entry needs ``min_contexts`` preceding words, and ``context_share`` for each positive text, to be a candidate."""

    positives: int = 4000
    negatives: int = 8000
    min_contexts: int = 3
    context_share: float = 0.002
    min_weight: float = 1.5
    ridge: float = 0.01
    threshold: float = 0.3
    stem_lengths: tuple[int, ...] = (4, 5, 6)


@dataclass
class Model:
    """The character model's log-probabilities [SIZE, SIZE, SIZE], the lexicon's weights, and those of the logistic score."""

    logp: np.ndarray
    lexicon: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.array([-4.0, 0, 0, 0]))


def _trigram_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIZE**3, np.int64)
    for batch in batches:
        for part in slices(batch, 0, 1 << 20):
            text = " ".join(x for x in part.column(0).to_pylist() if x)
            points = np.frombuffer(f"  {text} ".encode("utf-32-le", "replace"), np.uint32)
            s = _CLASS[np.minimum(points, 0x24F)].astype(np.int32)
            code = (s[:-2] * SIZE + s[1:-1]) * SIZE + s[2:]
            total += np.bincount(code[(s[1:-1] != EDGE) | (s[2:] != EDGE)], minlength=SIZE**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["code", "n"])


def char_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Trigram counts over the words of all rows: at most SIZE**3 rows of (code, n)."""
    return docs.select(text).mapInArrow(_trigram_batches, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def char_model(counts: np.ndarray) -> np.ndarray:
    """Interpolated trigram log-probabilities from counts of shape [SIZE, SIZE, SIZE]."""
    tri = counts.astype(np.float64)
    bi = tri.sum(0)
    uni = bi.sum(0) + 1
    uni = uni / uni.sum()
    p2 = (bi + 5 * uni) / (bi.sum(1, keepdims=True) + 5)
    p3 = (tri + 5 * p2) / (tri.sum(2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


class Restorer:
    """Decodes disguised tokens; remembers a bounded number of them."""

    def __init__(self, logp: np.ndarray, remember: int = 200_000):
        self.logp = logp.tolist()
        self.known: dict[str, str] = {}
        self.remember = remember

    @staticmethod
    def _symbol(c: str) -> int:
        return int(_CLASS[min(ord(c), 0x24F)])

    def lattice(self, token: str, gaps: bool) -> list[list[tuple[str, float]]]:
        """For each run of one character, the strings it may stand for and their costs."""
        out: list[list[tuple[str, float]]] = []
        i, n = 0, len(token)
        while i < n:
            c, j = token[i].lower()[:1], i + 1
            while j < n and (token[j].lower()[:1] == c or gaps and c in _BLANKS and token[j] in _BLANKS):
                j += 1
            run = j - i
            if c.isalpha():
                out.append([(c * run, 0.0)] if run < 3 else [(c, CUT), (c * 2, CUT * 2)])
            elif gaps and (c in _GAPS or c in _BLANKS):
                out.append([("", CLOSE), (token[i:j], SPLIT)])
            elif c in LEET:
                letters = LEET[c]
                ways = [(x * min(run, 2), READ + SECOND * k) for k, x in enumerate(letters)]
                ways += [(x, READ + SECOND * k + CUT) for k, x in enumerate(letters) if run > 1]
                out.append([*ways, ("", DROP if letters else READ), (c * run, KEEP)])
            else:
                out.append([(c * run, 0.0)])
            i = j
        return out

    def decode(self, token: str, gaps: bool = False) -> str:
        """The likeliest string: Viterbi over states of the last two symbols."""
        key = token + "\0" * gaps
        if (got := self.known.get(key)) is not None:
            return got
        states: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}
        for ways in self.lattice(token, gaps):
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (cost, done) in states.items():
                for string, extra in ways:
                    c, x, y = cost + extra, a, b
                    # a gap that is kept is one edge, however long
                    for ch in string[:1] if gaps and (string[:1] in _GAPS or string[:1] in _BLANKS) else string:
                        z = self._symbol(ch)
                        c -= self.logp[x][y][z]
                        x, y = y, z
                    if (x, y) not in after or c < after[x, y][0]:
                        after[x, y] = (c, (done, string))
            states = after
        path = min(((c - self.logp[a][b][EDGE], i, done) for i, ((a, b), (c, done)) in enumerate(states.items())))[2]
        back = []
        while path:
            path, string = path
            back.append(string)
        best = "".join(reversed(back))
        if len(key) < 100:
            if len(self.known) >= self.remember:
                self.known.clear()
            self.known[key] = best
        return best

    def text(self, text: str) -> str:
        """``text`` with its disguised tokens restored."""
        if _SPACED.search(text):
            text = _SPACED.sub(lambda m: self.decode(m[0], True) if _WORD.search(m[0]) else m[0], text)
        if not _ODD.search(text):
            return text
        return _TOKEN.sub(lambda m: self.decode(m[0]) if _ODD.search(m[0]) else m[0], text)


def _suspicious(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that may hold a disguised token, found by byte classes alone: a superset."""
    n = len(data)
    rows = len(offsets) - 1
    if n < 3:
        return np.ones(rows, bool)
    low = data | 32
    letter = ((low >= 97) & (low <= 122)) | (data >= 128)
    sign = _SIGN_BYTE[data]
    hit = np.zeros(n, bool)
    hit[1:] |= letter[:-1] & sign[1:]
    hit[:-1] |= sign[:-1] & letter[1:]
    hit[2:] |= letter[2:] & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2])
    # three letters of several bytes in a row, whose cases the bytes do not show
    lead = np.flatnonzero(data >= 0xC2)
    next_to = lead[1:] == lead[:-1] + _WIDTH[data[lead[:-1]]]
    hit[lead[2:][next_to[1:] & next_to[:-1]]] = True
    gap = _GAP_BYTE[data]
    wide = (data[:-1] == 0xC2) & ((data[1:] == 0xB7) | (data[1:] == 0xA0))
    gap[:-1] |= wide
    gap[1:] |= wide
    # three single letters in a row between gaps
    change = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    begin, end = change[::2], change[1::2]
    single = end - begin == _WIDTH[data[np.minimum(begin, n - 1)]]
    hit[begin[2:][single[2:] & single[1:-1] & single[:-2]]] = True
    seen = np.concatenate([[0], np.cumsum(hit)])
    return seen[offsets[1:]] > seen[offsets[:-1]]


_WIDTH = np.ones(256, np.int64)
_WIDTH[0xC2:0xE0], _WIDTH[0xE0:0xF0], _WIDTH[0xF0:] = 2, 3, 4
_SIGN_BYTE = np.zeros(256, bool)
_SIGN_BYTE[[ord(c) for c in LEET if ord(c) < 128]] = True
_SIGN_BYTE[[0xE2, 0xC2]] = True
_GAP_BYTE = np.zeros(256, bool)
_GAP_BYTE[[ord(c) for c in " .-_*\n\t\r\x0b\x0c"]] = True


def restored(batch: pa.RecordBatch, column: int, restorer: Restorer) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch, each with its rows' texts restored; null is empty."""
    from tamiz.llm.kernel import raw

    for part in slices(batch, column, 1 << 20):
        flags = _suspicious(*raw(part.column(column))).tolist()
        yield part, [restorer.text(x) if odd and x else x or "" for x, odd in zip(part.column(column).to_pylist(), flags, strict=True)]


def deobfuscate(docs: DataFrame, model: Model, text: str = "text", out: str = "restored") -> DataFrame:
    """``docs`` with a column of restored texts; its other columns stay (one of that name is replaced)."""
    logp = model.logp

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(logp)
        for batch in batches:
            for part, texts in restored(batch, at, restorer):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*names, out])

    docs = docs.drop(out)
    names = docs.columns
    at = names.index(text)
    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(out, T.StringType())]))


def entries(words: list[str], lengths: tuple[int, ...]) -> Iterator[tuple[int, str]]:
    """Each word and its beginnings (marked by a hyphen), with the word's place."""
    for i, w in enumerate(words):
        if len(w) >= 3:
            yield i, w
        for k in lengths:
            if len(w) > k:
                yield i, w[:k] + "-"


def _sample(docs: DataFrame, labels: DataFrame, params: Params, key: str, text: str, label: str) -> tuple[DataFrame, float, float]:
    """(y, text) of a bounded sample by the order of a hash of the key, of equal texts one, and the numbers of labels of both classes."""
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.max(label).alias("__y"))
    order = [F.xxhash64("__key"), F.col("__key")]
    picked = known.filter("__y = 1").orderBy(*order).limit(params.positives).unionByName(known.filter("__y = 0").orderBy(*order).limit(params.negatives))
    numbers = {r["__y"]: r.n for r in known.filter("__y in (0, 1)").groupBy("__y").agg(F.count("*").alias("n")).collect()}
    met = docs.select(F.col(key).alias("__k"), F.col(text).alias("text")).join(F.broadcast(picked), F.col("__k") == F.col("__key"))  # bounded by the parameters
    met = met.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(F.max("__y").alias("y"), F.min("text").alias("text"))
    return materialise(met.select("y", "text"), "labelled"), numbers.get(1, 0), numbers.get(0, 0)


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Counts the character model over all ``docs``, and learns the lexicon and the score from ``labels`` (key, label)."""
    counts = np.zeros(SIZE**3)
    for code, n in char_counts(docs, text).collect():  # at most SIZE**3 rows
        counts[code] = n
    logp = char_model(counts.reshape(SIZE, SIZE, SIZE))
    rows, positives, negatives = _sample(docs, labels, params, key, text, label)
    base = (positives + 0.02) / (positives + negatives + 1)
    plain = Model(logp, {}, np.array([np.log(base / (1 - base)), 0, 0, 0]))
    if not positives or not negatives:
        return plain
    rows = materialise(deobfuscate(rows, plain, out="restored").select("y", "restored"), "restored")
    count = _Counts(params)
    contexts = max(params.min_contexts, params.context_share * min(positives, params.positives))
    candidates = rows.filter("y = 1").select("restored").mapInArrow(count.contexts, "entry string, context long").groupBy("entry").agg(F.count_distinct("context").alias("n")).filter(F.col("n") >= contexts)
    count.names = {r.entry: i for i, r in enumerate(candidates.collect())}  # bounded by the sample
    counted = rows.mapInArrow(count.places, "entry int, y int, n long").groupBy("entry").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("neg")).collect()
    size = {r.entry: (r.pos, r.neg) for r in counted}
    toxic, clean = size.pop(-1, (0, 0))
    named, lexicon = list(count.names), {}
    if not toxic or not clean:
        return plain
    chance = toxic / (toxic + clean)
    for e, (pos, neg) in size.items():
        share = min(max(pos / (pos + neg), 1e-9), 1 - 1e-9)
        # More places in toxic texts than chance would give any of so many candidates.
        evidence = pos * np.log(share / chance) + neg * np.log((1 - share) / (1 - chance))
        weight = np.log((pos + 0.5) / toxic) - np.log((neg + 0.5) / clean)
        if weight >= params.min_weight and evidence > np.log(len(named)) + 3:
            lexicon[named[e]] = float(weight)
    read = reader(lexicon, params.stem_lengths)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([read(t) for t in batch.column(1).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, x.T)], ["y", "a", "b", "c"])

    seen = rows.mapInArrow(features, "y int, a double, b double, c double").toPandas()  # bounded by the sample
    y, x = seen.y.to_numpy(float), np.column_stack([np.ones(len(seen)), seen[["a", "b", "c"]].to_numpy()])
    # The sample's classes in the proportion of all labels.
    weight = np.where(y == 1, positives / max(1, (y == 1).sum()), negatives / max(1, (y == 0).sum()))
    return Model(logp, lexicon, logistic(x, y, weight / weight.mean(), params.ridge))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge logistic regression by Newton's steps; the first column, the intercept, is not drawn to zero."""
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    pull[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        v = np.maximum(weight * p * (1 - p), 1e-9)
        step = np.linalg.solve((x * v[:, None]).T @ x + np.diag(pull), x.T @ (weight * (p - y)) + pull * w)
        step *= min(1.0, 3 / max(1e-9, np.abs(step).max()))
        w -= step
    return w


class _Counts:
    """The two passes over the restored sample."""

    def __init__(self, params: Params):
        self.params, self.names = params, {}

    def _places(self, text: str | None) -> tuple[set[tuple[str, int]], int]:
        """The different (entry, context) of a text, and the number of its different (word, context)."""
        words = _WORD.findall((text or "").lower())
        before = [crc32(" ".join(words[max(0, i - 2) : i]).encode()) for i in range(len(words))]
        return {(e, before[i]) for i, e in entries(words, self.params.stem_lengths)}, len(set(zip(words, before, strict=True)))

    def contexts(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()
        for batch in batches:
            for x in batch.column(0).to_pylist():
                seen |= self._places(x)[0]
        if seen:
            names, contexts = zip(*seen, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contexts, pa.int64())], ["entry", "context"])

    def places(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places of each candidate by class; those of all words under -1."""
        total: Counter[tuple[int, int]] = Counter()
        for batch in batches:
            for y, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, size = self._places(x)
                total.update((i, y) for e, _ in found if (i := self.names.get(e)) is not None)
                total[-1, y] += size
        if total:
            cols = list(zip(*total, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(list(total.values()), pa.int64())], ["entry", "y", "n"])


def reader(lexicon: dict[str, float], lengths: tuple[int, ...]):
    """A function from a restored text to what it holds of the lexicon: the log of the sum of its words' weights, the log
    of that sum for a thousand words, and the largest weight."""
    longest = sorted(lengths, reverse=True)
    ahead = {e.rstrip("-")[:3] for e in lexicon}

    def read(text: str | None) -> tuple[float, float, float]:
        words = _WORD.findall((text or "").lower())
        total = most = 0.0
        for w in words:
            if w[:3] in ahead:
                value = lexicon.get(w)
                if value is None:
                    value = next((lexicon[w[:k] + "-"] for k in longest if len(w) > k and w[:k] + "-" in lexicon), 0.0)
                total += value
                most = max(most, value)
        return math.log1p(total), math.log1p(1000 * total / max(1, len(words))), most

    return read


def scorer(model: Model, lengths: tuple[int, ...]):
    """A function from a restored text to its score."""
    read = reader(model.lexicon, lengths)
    w = model.weights.tolist()

    def score(text: str | None) -> float:
        z = w[0] + sum(a * b for a, b in zip(w[1:], read(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    return score


def score(docs: DataFrame, model: Model, params: Params = Params(), text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a column of scores; its other columns stay (one of that name is replaced)."""
    docs = docs.drop(out)
    names, at = docs.columns, docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, value = Restorer(model.logp), scorer(model, params.stem_lengths)
        for batch in batches:
            for part, texts in restored(batch, at, restorer):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([value(x) for x in texts], pa.float64())], [*names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(out, T.DoubleType())]))


def session_model(spark: SparkSession, docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """A model from the labels of rows that are not held out."""
    return fit(docs, labels.filter(~held_out("doc_id")).select("doc_id", "toxic"), params)
