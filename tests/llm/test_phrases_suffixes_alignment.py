"""Collocations, suffix deduplication and token alignment against plain brute force, and on awkward rows."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamiz.llm import alignment, collocations, shared, suffixes

AWKWARD = [(1, None, "en"), (2, "", "en"), (3, " \n\t", None), (4, "Ñandú", "und"), (5, "a\n\nb. b", "x"), (6, "x" * 30_000, "x"), (7, "uno dos tres cuatro cinco seis " * 3, "es"), (7, "uno dos tres cuatro cinco seis " * 3, "es"), (None, "uno dos tres cuatro cinco seis " * 3, "es"), (8, "ź 🎉 İ ß <|endoftext|> <s> </s> ﬁ  　漢字\x00", "en")]
FOLD = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(*r, "t", 5) for r in AWKWARD], "doc_id long, text string, lang string, phrase string, n_bytes int")


def made(n, seed, vocabulary=40, shares=True):
    r = random.Random(seed)
    names = [r.choice(["al", "Bo", "ca", "dé", "e"]) + str(i) for i in range(vocabulary)]
    out = []
    for i in range(n):
        words = [r.choice(names) for _ in range(r.choice([0, 1, 3, 20, 60]))]
        if shares and out and r.random() < 0.6:
            other = r.choice(out)[1]
            a = r.randint(0, len(other))
            words.insert(r.randint(0, len(words)), other[a : a + r.randint(0, 150)])
        if r.random() < 0.1:
            words.append("aab" * r.randint(0, 60))
        out.append((r.randint(0, n), r.choice([" ", "  ", ". ", " ", "\n"]).join(words), r.choice(["en", "es", None])))
    return out


def plain_collocations(rows, least, share, top):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


@pytest.mark.parametrize("changes", [{}, {"broadcast_words": 3}, {"range_keys": 50, "chunk_words": 40}, {"top": 5}])
def test_collocations_equal_brute_force(spark, changes):
    rows = made(120, 5, 12, False) + AWKWARD
    params = collocations.Params(least=6, **changes)
    got = collocations.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string"), params=params).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 6, 80, params.top)
    assert len(got) > 10


def test_collocations_of_awkward_rows(awkward):
    params = collocations.Params(least=2)
    assert sorted(map(tuple, collocations.collocations(awkward, params=params).collect())) == plain_collocations(AWKWARD, 2, 80, 2000)
    assert collocations.collocations(awkward.limit(0), params=params).count() == 0


def test_rare_words_are_summed_before_words_are_written(spark, monkeypatch):
    written = {}

    def counted(df, name):
        out = shared.materialise(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(collocations, "materialise", counted)
    rows = [(1, " ".join(f"rare{i}" for i in range(500)) + " a b" * 9, "en"), (2, "c d " * 9, None), (3, "rare0 once", "fr")]
    got = collocations.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string"), params=collocations.Params(least=6)).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 6, 80, 2000)
    assert {r.lang: r.n for r in got} == {"en": 518, "und": 18}
    assert written["words"] == 4 + 2  # a, b, c and d; the others of en and of fr


def test_radix_sort_orders_digits():
    r = np.random.default_rng(3)
    digits = r.integers(0, 5, (4, 300)).astype(np.uint16)
    keys = list(zip(*digits.tolist(), strict=True))
    assert [keys[i] for i in collocations.radix_sort(digits)] == sorted(keys)


def test_suffix_order_is_the_order_of_suffixes():
    r = random.Random(1)
    for _ in range(300):
        x = [r.randint(1, r.choice([1, 2, 5, 300])) for _ in range(r.randint(0, 40))]
        assert suffixes.suffix_order(np.array(x, np.int64)).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def plain_removed(rows, width=50):
    first = {}
    texts = [(k, (t or "").encode()) for k, t, *_ in rows]
    for k, t in texts:
        for i in range(len(t) - width + 1) if k is not None else ():
            first[t[i : i + width]] = min(k, first.get(t[i : i + width], k))
    out = []
    for k, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1) if k is not None else ():
            if first[t[i : i + width]] < k:
                gone[i : i + width] = b"\1" * width
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((k, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [suffixes.HOT, 2, 0])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "CHUNK", 50)
    monkeypatch.setattr(suffixes, "BUCKET", 200)
    rows = made(150, 7 + hot)
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), hot=hot).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == plain_removed(rows)
    assert sum(r.n_removed for r in got) > 1000


def test_removed_bytes_of_awkward_rows(awkward):
    got = suffixes.remove_repeats(awkward)
    rows = got.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == plain_removed(AWKWARD)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    assert suffixes.remove_repeats(awkward.limit(0)).count() == 0


def test_sample_depends_on_the_string_alone():
    r = random.Random(5)
    for _ in range(50):
        text = bytes(r.choice(b"ab c") for _ in range(60))
        alone = suffixes.sample(np.frombuffer(text, np.uint8), np.array([0, 60]), 50)
        assert alone[0] <= 26
        around = b"xyz" + text + b"q" * r.randint(0, 40)
        inside = suffixes.sample(np.frombuffer(around, np.uint8), np.array([0, len(around)]), 50)
        assert set((alone + 3).tolist()) <= set(inside.tolist())


def plain_aligned(rows):
    encode_a, spelled_a = alignment.byte_vocabulary("byte_bpe_50k.json")
    encode_b, spelled_b = alignment.piece_vocabulary("piece_bpe_32k.model")
    made, pairs = [], Counter()
    for k, text, *_ in rows:
        a, b = (encode_a(" " + text), encode_b([text])[0]) if text else ([], [])
        if b"".join(spelled_a[i] for i in a) != b"".join(spelled_b[i] for i in b) or not text:
            made.append((k, [], [], [], []))
            continue
        spans = []
        for ids, spelled in ((a, spelled_a), (b, spelled_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(spelled[i])))
                at += len(spelled[i])
            spans.append(out)
        links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (x, y) in enumerate(spans[1]) if max(s, x) < min(e, y)]
        pairs.update(links)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append(tuple([ids[i] for i, (s, e) in enumerate(sp) if low < e <= cut] for ids, sp in ((a, spans[0]), (b, spans[1]))))
            low = cut
        made.append((k, a, b, links, groups))
    most = defaultdict(int)
    for (_, j), n in pairs.items():
        most[j] = max(most[j], n)
    out = []
    for k, a, b, links, groups in made:
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((k, len(a), len(b), len(groups), len(links), sum(pairs[x] == most[x[1]] for x in links), sum(pairs[x] for x in links), hashlib.sha256(spelled.encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [alignment.PAIRS, 3])
def test_alignment_equals_brute_force(spark, most):
    short = [(k, (t or "")[:300] if t is not None else None, lang) for k, t, lang in AWKWARD]
    rows = made(60, 11) + short + [(9, "naïve café – “quoted” text, 日本語 и русский; ¿qué? 12345", None)]
    got = alignment.align(spark.createDataFrame(rows, "doc_id long, text string, n_a string").repartition(4), most_pairs=most).collect()
    assert sorted(map(tuple, got), key=str) == plain_aligned(rows)


def test_alignment_uses_the_named_vocabulary():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    named = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    named.encode_special_tokens = True
    encode, spelled = alignment.byte_vocabulary("byte_bpe_50k.json")
    for _, text, *_ in [*made(30, 2), *AWKWARD]:
        ids = encode(" " + (text or ""))
        assert ids == named.encode(" " + (text or ""), add_special_tokens=False).ids
        assert b"".join(spelled[i] for i in ids) == (" " + (text or "")).encode()


def test_alignment_of_nothing(awkward):
    assert alignment.align(awkward.limit(0)).count() == 0


def test_rank_and_select_of_packed_bits():
    bits = np.random.default_rng(1).integers(0, 2, 77).astype(np.uint8)
    packed = np.packbits(bits)
    assert alignment.select(packed).tolist() == np.flatnonzero(bits).tolist()
    assert alignment.Rank(packed).at(np.arange(78)).tolist() == [int(bits[:i].sum()) for i in range(78)]


def test_runs_across_batches_of_one_triple():
    """Rows of one triple never part, whatever the batches."""
    r = random.Random(4)
    rows = sorted((bytes(r.choice(b"ab") for _ in range(2)) * 12 + bytes([65 + r.randint(0, 3)]) * 40, r.randint(1, 9)) for _ in range(200))
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(range(200)), pa.array([k for _, k in rows]), pa.array([x for x, _ in rows], pa.binary()), pa.array([x[:24] for x, _ in rows], pa.binary())], ["h1", "h2", "least", "around", "triple"])
    whole = [m for b in suffixes._sorted(50, 10**6)([batch]) for m in b.column(3).to_pylist()]
    parts = [m for b in suffixes._sorted(50, 20)(batch.slice(k, 7) for k in range(0, 200, 7)) for m in b.column(3).to_pylist()]
    assert whole == parts and any(whole)


def test_texts_of_a_strip_are_shuffled_packed(spark):
    rows = [(1, "ein langer Satz, der sich wiederholt. " * 200), (2, ""), (None, "ñandú"), (4, "x")]
    made = spark.createDataFrame(rows, "key long, text string").selectExpr("*", "key = 4 as copy").coalesce(1).mapInArrow(suffixes._strips, "strip long, keys array<long>, sizes array<int>, texts binary, copies array<boolean>").collect()
    assert len(made) == 1 and len(made[0].texts) < 500
    data, offsets = suffixes._unpacked(pa.array(made[0].sizes), pa.scalar(bytes(made[0].texts)))
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [t for _, t in rows]


def test_strings_alone_with_their_triple_are_not_sorted(monkeypatch):
    """Only strings that share a triple with another are compared; the others keep their row, with nothing found."""
    rows = [(b"%026d" % i + b"abcdefghijklmnopqrstuvwx"[: 24 - 4] + b"%04d" % (i // 3 if i < 6 else i) + b"z" * 26, i) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(range(40)), pa.array([k for _, k in rows]), pa.array([x for x, _ in rows], pa.binary()), pa.array([x[26:50] for x, _ in rows], pa.binary())], ["h1", "h2", "least", "around", "triple"])
    seen = []
    real = suffixes.repeats
    monkeypatch.setattr(suffixes, "repeats", lambda data, offsets, keys, width: seen.extend(keys.tolist()) or real(data, offsets, keys, width))
    got = [tuple(x) for b in suffixes._sorted(50, 7)(batch.slice(k, 5) for k in range(0, 40, 5)) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert sorted(seen) == list(range(6)) and [x[:3] for x in got] == [(i, i, i) for i in range(40)]
    assert [i for i, *_, mask in got if mask] == [1, 2, 4, 5]


def test_shuffle_files_go_with_the_write(spark):
    """A write that drops its shuffle files leaves none behind, and the session's setting is as before."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {n for n in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())) if n.startswith("shuffle_")}
    before, setting = files(), spark.conf.get(shared.SHUFFLE_CLEANUP, None)
    made = shared.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "made", drop_shuffles=True)
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(shared.SHUFFLE_CLEANUP, None) == setting
    assert {r.k: r["count"] for r in made.collect()} == {k: 143 - (k == 6) for k in range(7)}
