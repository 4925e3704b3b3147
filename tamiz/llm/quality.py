"""Quality by co-training: a text-content view and a page-metadata view teach each other.

Each view has a linear classifier, fitted from weighted moments of its features that are summed over all
rows, so a round is one pass and what comes to the driver has a fixed size. After each round a view's
scores are calibrated on the labelled rows by bands of the score; rows of whose class a view is
confident become pseudo-labels for the other view in the next round. In the end the calibrated views
are combined by their log-odds for all documents.

Edge cases: null and empty texts have zero content features; documents without a page have zero page features; a
null label is no label; without both classes every score is the share of good labels (0.5 without any); repeated
keys are scored alike, one result for each row; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.kernel import BLANK, LOWER, line_hashes, raw, tokens
from tamiz.llm.shared import held_out, materialise, slices, vector_sums


@dataclass(frozen=True)
class Params:
    rounds: int = 3
    confident: float = 0.97
    pseudo_weight: float = 0.3
    bands: int = 64
    ridge: float = 1e-3


def content_features(texts: pa.Array) -> np.ndarray:
    """Shares of kinds of bytes, of repeated words and lines, and sizes: [rows, features]."""
    data, offsets = raw(texts)
    n = np.diff(offsets).astype(np.float64)
    size = np.maximum(n, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        seen = np.concatenate([[0], np.cumsum(mask)])
        return (seen[offsets[1:]] - seen[offsets[:-1]]) / size

    kinds = [(data >= 65) & (data <= 90), (data >= 48) & (data <= 57), data == 33, data == 124, np.isin(data, [35, 36, 37, 38, 42]), np.isin(data, [44, 46]), data == 10, data >= 128, np.isin(data, [60, 62, 123, 125, 91, 93, 61, 59, 95])]
    out = [share(k) for k in kinds]
    hashes, _, before = tokens(data, offsets, BLANK, LOWER)
    words = np.diff(before)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    seen = np.concatenate([[0], np.cumsum(same)])
    out.append((seen[before[1:]] - seen[before[:-1]]) / np.maximum(words, 1))
    out.append(_different(hashes, before) / np.maximum(words, 1))
    lines, _, _, at = line_hashes(data, offsets)
    out.append(_different(lines, at) / np.maximum(np.diff(at), 1))
    out += [np.log1p(n) / 10, np.log1p(words) / 10, size / np.maximum(words, 1) / 10]
    x = np.stack(out, axis=1) if len(n) else np.zeros((0, 15))
    return np.concatenate([x, np.sqrt(np.maximum(x[:, :6], 0)), (x[:, :6] > 0).astype(float), x[:, 10:12] ** 2], axis=1)


def _different(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """How many different hashes each row has."""
    owner = np.repeat(np.arange(len(before) - 1), np.diff(before))
    order = np.lexsort((hashes, owner))
    first = np.ones(len(order), bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    return np.bincount(owner[order][first], minlength=len(before) - 1)


#: Buckets of the metadata view: by hash, of the source, the language and the URL's host.
_BUCKETS = {"source": 24, "lang": 8, "host": 16}
_MARKS = ("paged", "secure", "query", "fragment", "html", "folder")


def _described(side: DataFrame) -> DataFrame:
    """(doc_id, y, and what the metadata view sees): the buckets' numbers (null without a value), the size, and marks of the URL."""
    u = F.col("url")
    values = {"source": F.col("source"), "lang": F.col("lang"), "host": F.nullif(F.regexp_extract(u, "^[^/]*//([^/]*)/", 1), F.lit(""))}
    marks = (u.isNotNull(), u.startswith("https"), u.contains("?"), u.contains("#"), u.endswith(".html"), u.endswith("/"))
    buckets = [(F.crc32(values[c].cast("binary")) % n).cast("int").alias(c) for c, n in _BUCKETS.items()]
    size = F.log1p(F.greatest(F.coalesce("n_chars", F.lit(0)), F.lit(0)).cast("double")) / 10
    return side.select("doc_id", "y", *buckets, size.alias("size"), *(F.coalesce(m, F.lit(False)).cast("int").alias(c) for c, m in zip(_MARKS, marks, strict=True)))


def metadata_features(columns: dict[str, np.ndarray]) -> np.ndarray:
    """[rows, features] of the columns that ``_described`` gives; a missing bucket is not a number."""
    n = len(columns["size"])
    out = np.zeros((n, sum(_BUCKETS.values())))
    at = 0
    for name, size in _BUCKETS.items():
        known = np.flatnonzero(~np.isnan(columns[name]))
        out[known, at + columns[name][known].astype(int)] = 1
        at += size
    return np.column_stack([out, columns["size"], columns["size"] ** 2, *(columns[m] for m in _MARKS)])


def featured(docs: DataFrame, pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, y, text_x, meta_x): features of both views as binary float32, and the label if it may be learned."""
    page = pages.select(F.expr("try_cast(regexp_extract(url, '^[^:]+://[^/]+/[a-z]+/([0-9]+)', 1) as bigint)").alias("doc_id"), "url").filter("doc_id is not null").groupBy("doc_id").agg(F.min("url").alias("url"))
    known = labels.filter(F.col("quality").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.min("quality").alias("y"))
    side = docs.select("doc_id", "source", "lang", "n_chars").join(page, "doc_id", "left").join(known, "doc_id", "left")
    meta = _described(side).mapInArrow(_metadata, "doc_id long, y int, meta_x binary")
    text = docs.select("doc_id", "text").mapInArrow(_content, "doc_id long, text_x binary")
    once = meta.groupBy("doc_id").agg(F.max("y").alias("y"), F.max("meta_x").alias("meta_x"))
    return text.join(once, text["doc_id"].eqNullSafe(once["doc_id"]), "left").select(text["doc_id"], "y", "text_x", "meta_x")


#: Features of the content view.
_CONTENT = content_features(pa.array([""])).shape[1]


def _pack(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary())


def _content(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), _pack(content_features(part.column(1)))], ["doc_id", "text_x"])


def _metadata(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = {n: batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i, n in enumerate(batch.schema.names) if i > 1}
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _pack(metadata_features(columns))], ["doc_id", "y", "meta_x"])


@dataclass
class View:
    """A linear score and its calibration by bands."""

    weights: np.ndarray
    edges: np.ndarray
    share: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        s = _with_one(x) @ self.weights
        return np.interp(s, self.edges, self.share)


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float32).reshape(len(rows), -1).astype(np.float64)


def _solve(moments: np.ndarray, ridge: float) -> np.ndarray | None:
    """Balanced least squares from sums of [y, w, x...] outer products of both classes."""
    d = int(np.sqrt(len(moments) // 2))
    bad, good = moments.reshape(2, d, d)
    if bad[-1, -1] <= 0 or good[-1, -1] <= 0:
        return None
    a = bad / bad[-1, -1] + good / good[-1, -1]
    b = good[:, -1] / good[-1, -1] - bad[:, -1] / bad[-1, -1]
    return np.linalg.solve(a + ridge * np.eye(d), b)


def _sum(rows: DataFrame) -> np.ndarray | None:
    """The sum of the tasks' vectors; each has a fixed size."""
    return vector_sums(rows).get(0)


def _row(vector: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([vector.astype(np.float64).tobytes()], pa.binary())], ["id", "values"])


def cotrain(rows: DataFrame, params: Params = Params()) -> tuple[list[View] | None, float]:
    """Both views, and the share of good labels. ``rows``: as ``featured``, written."""
    columns = ("text_x", "meta_x")
    views: list[View | None] = [None, None]
    base = 0.5
    for _ in range(params.rounds):
        before = list(views)

        def moments(batches, before=before):
            total = [0, 0]
            for batch in batches:
                y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
                xs = [_matrix(batch.column(1)), _matrix(batch.column(2))]
                for v in (0, 1):
                    weight = np.stack([(y == 0) * 1.0, (y == 1) * 1.0])
                    other = before[1 - v]
                    if other is not None:  # the other view's confident rows
                        p = other.probability(xs[1 - v])
                        free = np.isnan(y) * params.pseudo_weight
                        weight += np.stack([free * (1 - p >= params.confident), free * (p >= params.confident)])
                    x = _with_one(xs[v])
                    total[v] = total[v] + np.concatenate([((x * w[:, None]).T @ x).ravel() for w in weight])
            if not isinstance(total[0], int):
                yield _row(np.concatenate(total))

        got = _sum(rows.select("y", *columns).mapInArrow(moments, "id int, values binary"))
        if got is None:
            return None, base
        cut = 2 * (_CONTENT + 1) ** 2
        found = [_solve(got[:cut], params.ridge), _solve(got[cut:], params.ridge)]
        if found[0] is None or found[1] is None:
            d = _CONTENT + 1
            bad, good = got[d * d - 1], got[2 * d * d - 1]  # the first round's weights are the labels
            return None, float(good / (bad + good)) if bad + good > 0 and before[0] is None else base
        edges = [np.linspace(-1.5, 1.5, params.bands) for _ in columns]

        def bands(batches, found=found, edges=edges):
            total = np.zeros((2, 2, params.bands))
            for batch in batches:
                batch = batch.filter(batch.column(0).is_valid())
                if batch.num_rows:
                    y = batch.column(0).to_numpy().astype(int)
                    for v in (0, 1):
                        at = np.abs((_with_one(_matrix(batch.column(v + 1))) @ found[v])[:, None] - edges[v]).argmin(1)
                        np.add.at(total[v], (y, at), 1)
            yield _row(total.ravel())

        counts = _sum(rows.select("y", *columns).mapInArrow(bands, "id int, values binary")).reshape(2, 2, -1)
        base = float(counts[0, 1].sum() / max(1, counts[0].sum()))
        for v in (0, 1):
            # Shares in bands, drawn towards the whole's, then made to rise with the score.
            share = (counts[v, 1] + 2 * base) / (counts[v].sum(0) + 2)
            views[v] = View(found[v], edges[v], _rising(share, counts[v].sum(0) + 0.1))
    return views, base


def _rising(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The closest rising sequence: neighbours that fall are pooled."""
    blocks: list[list[float]] = []
    for value, weight in zip(y.tolist(), w.tolist(), strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def score(docs: DataFrame, pages: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """Per document: doc_id, text_score, meta_score and score, the probability that it is good."""
    rows = materialise(featured(docs, pages, labels), "features")
    views, base = cotrain(rows, params)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ps = [v.probability(_matrix(batch.column(i + 1))) for i, v in enumerate(views)] if views else [np.full(batch.num_rows, base)] * 2
            logit = [np.log(np.clip(p, 1e-4, 1 - 1e-4) / (1 - np.clip(p, 1e-4, 1 - 1e-4))) for p in ps]
            prior = np.log(np.clip(base, 1e-4, 1 - 1e-4) / (1 - np.clip(base, 1e-4, 1 - 1e-4)))
            both = 1 / (1 + np.exp(-(logit[0] + logit[1] - prior)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ps[0]), pa.array(ps[1]), pa.array(both)], ["doc_id", "text_score", "meta_score", "score"])

    return rows.select("doc_id", "text_x", "meta_x").mapInArrow(run, "doc_id long, text_score double, meta_score double, score double")
