"""Operators against brute force, exact round trips and held-out accuracy, and on awkward rows."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tamiz.llm import decontaminate, gif, jaccard, language, lines, packing, pseudo_likelihood, quality, queries, toxicity, urls
from tamiz.llm.components import connected
from tamiz.llm.shared import is_held_out

SMALL = "/root/testdata/sf0.001"
FOLD = {i: i + 32 for i in range(65, 91)}
AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (4, "Ñandú"), (5, "a\n\nb\n\nc"), (6, "x" * 70_000), (7, "uno dos tres cuatro cinco seis"), (7, "uno dos tres cuatro cinco seis"), (None, "uno dos tres cuatro cinco seis"), (8, "ź 🎉 İ ß 1d10t m o r o n <|endoftext|>")]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(*r, "t", "toxicity", None) for r in AWKWARD], "doc_id long, text string, restored string, toxicity string, n_removed long")


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.limit(0)


def words(pattern, text):
    return re.findall(pattern, (text or "").translate(FOLD))


def made_texts(n, seed):
    """Texts that share passages and are copies and near copies of each other."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    out = []
    for _ in range(n):
        if out and r.random() < 0.5:
            w = r.choice(out).split()
            for _ in range(r.randint(0, 3)):
                if w:
                    w[r.randrange(len(w))] = r.choice(vocabulary)
        else:
            w = [r.choice(vocabulary) for _ in range(r.choice([0, 2, 4, 5, 6, 12, 40, 80]))]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [4, 1024])
def test_jaccard_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = made_texts(150, block)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = []
    for t in texts:
        w = words(r"[^\x20\x09-\x0D]+", t)
        sets.append(set(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                o = len(a & b)
                if o and 100 * o >= 80 * (len(a) + len(b) - o) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    assert got == {i: (len(s), label[i]) for i, s in enumerate(sets)}


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_links_all_texts_of_an_id(spark, monkeypatch, seed):
    """Rows that share an id are one document: each has its component, whose links are those of all its texts."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    r = random.Random(seed)
    rows = [(r.randrange(60), t) for t in made_texts(110, seed + 50)]
    sets = []
    for _, t in rows:
        w = words(r"[^\x20\x09-\x0D]+", t)
        sets.append(set(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else ({tuple(w)} if w else set()))
    pairs = []
    for (i, a), (j, b) in itertools.combinations(zip([d for d, _ in rows], sets, strict=True), 2):
        o = len(a & b)
        if o and 100 * o >= 80 * (len(a) + len(b) - o):
            pairs.append((i, j))
    label = {d: d for d, _ in rows}
    for _ in range(120):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(x) for x in got) == sorted((d, len(s), label[d]) for (d, _), s in zip(rows, sets, strict=True))


def test_components(spark):
    r = random.Random(5)
    pairs = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    label = {x: x for p in pairs for x in p}
    for _ in range(200):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.label for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: label[x] for x in linked}


def wrapped(text, words, around=3):
    """(line, text) of each wrapped line of ``text``, word by word."""
    out = []
    for k, line in enumerate(text.split("\n")):
        parts = re.findall(r"[ \t\r\v\f]*[^ \t\r\v\f]+[ \t\r\v\f]*", line)
        if len(parts) <= words:
            out.append((k, line))
            continue
        h = []
        for p in parts:
            w = p.strip(" \t\r\v\f").encode()
            low, high = (int.from_bytes(x, "big") for x in (w[:4].ljust(4, b"\0"), w[-4:].rjust(4, b"\0")))
            h.append((low * 2654435761 + high * 2246822519 + 97 * len(w)) % 2**32)
        held = ""
        for i, p in enumerate(parts):
            held += p
            if all(h[i] < x for x in h[max(0, i - around) : i]) and all(h[i] <= x for x in h[i + 1 : i + 1 + around]) or i + 1 == len(parts):
                out.append((k, held))
                held = ""
    return out


@pytest.mark.parametrize(("words", "longest"), [(16, 3), (2, 9), (3, 20)])
def test_lines_equal_brute_force(spark, words, longest):
    r = random.Random(words)
    line = lambda: "".join(r.choice(["a", "b", "ñ", " ", "\t ", " "]) for _ in range(r.randint(0, longest)))
    known = [line() for _ in range(6)]
    texts = ["\n".join(r.choice(known) if r.random() < 0.8 else line() for _ in range(r.randint(0, 9))) for _ in range(80)] + ["", "\n", "a " * 400, "a " * 400, "x" * 70_000]
    seen, want = set(), {}
    for i, t in enumerate(texts):
        ls, cut = wrapped(t, words), set()
        for p in range(len(ls) - 2):
            g = tuple(x for _, x in ls[p : p + 3])
            if g in seen:
                cut |= {p, p + 1, p + 2}
            seen.add(g)
        left = defaultdict(str)
        for p, (k, x) in enumerate(ls):
            if p not in cut:
                left[k] += x
        want[i] = ("\n".join(left.values()), len(ls), len(cut))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(df, words=words).collect()} == want


def test_lines_cut_long_passages_of_one_line(spark):
    passage = " ".join(f"w{i}" for i in range(51))
    df = spark.createDataFrame([(1, f"a\n{passage}\nb"), (2, f"c\n{passage}\nd"), (3, passage), (4, None)], "doc_id long, text string")
    n = len(wrapped(passage, 16))
    assert n >= 3
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(df).collect()) == [(1, f"a\n{passage}\nb", n + 2, 0), (2, "c\nd", n + 2, n), (3, "", n, n), (4, None, 0, 0)]


def test_lines_cut_passages_that_begin_anywhere_in_a_line(spark):
    r = random.Random(8)
    other = lambda n: [f"{r.choice('abcdef')}{r.randint(0, 10**6)}" for _ in range(n)]
    passages = [other(50) for _ in range(30)]
    rows = [(2 * i + k, " ".join(other(r.randint(0, 25)) + p + other(r.randint(0, 25)))) for i, p in enumerate(passages) for k in (0, 1)]
    got = {r.doc_id: r.text.split() for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, p in enumerate(passages):
        assert set(p) <= set(got[2 * i])
        assert len(set(p) & set(got[2 * i + 1])) < 25 and len(got[2 * i + 1]) >= len(rows[2 * i + 1][1].split()) - 50


def test_decontamination_equals_brute_force(spark):
    r = random.Random(4)
    names = [f"W{i}é" for i in range(25)]
    items = [" ".join(r.choice(names) for _ in range(n)) for n in (0, 1, 3, 9, 10, 11, 25)]
    texts = [" ".join(r.choice(names) for _ in range(r.choice([0, 1, 5, 30]))) + " - " + r.choice(["", *items[3:]]) + ", " + r.choice(names) for _ in range(60)]
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for i, t in enumerate(items):
        w = words(pattern, t)
        for p in range(max(1, len(w) - 9)) if w else ():
            windows[tuple(w[p : p + 10])].add(str(i))
    want = {}
    for i, t in enumerate(texts):
        w, hit, found = words(pattern, t), set(), set()
        for n in {len(g) for g in windows}:
            for p in range(len(w) - n + 1):
                if got := windows.get(tuple(w[p : p + n])):
                    found |= got
                    hit.update(range(p, p + n))
        want[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {r.doc_id: tuple(r)[1:] for r in decontaminate.report(docs, bench).collect()} == want
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == {i for i, w in want.items() if not w[4]}


def test_packing_places_every_piece(spark, awkward):
    rows = packing.pack(awkward, capacity=64).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0] + [n for _, n in pieces])[:-1]) and sum(n for _, n in pieces) <= 64
    assert len(by) == -(-sum(r.length for r in rows) // 64)


def test_bin_completion_is_never_worse_than_best_fit_and_often_optimal():
    r = random.Random(8)
    for _ in range(60):
        counts = defaultdict(int)
        for _ in range(r.randint(0, 40)):
            counts[r.randint(1, 50)] += r.randint(1, 4)
        plan = packing.complete(counts, 50, nodes=2000)
        used = defaultdict(int)
        for pattern, n in plan:
            assert sum(x * k for x, k in pattern) <= 50
            for x, k in pattern:
                used[x] += n * k
        assert used == counts
        bins = sum(n for _, n in plan)
        assert -(-sum(x * n for x, n in counts.items()) // 50) <= bins <= sum(n for _, n in packing.best_fit(counts, 50))
    assert sum(n for _, n in packing.complete({6: 2, 5: 2, 4: 2, 3: 4}, 14)) == 3


def test_language_masks_equal_plain_sets(spark):
    """A language's filter holds the n-grams that plain counting gives it, and no lookup of one of them misses it."""
    r = random.Random(3)
    rows = [(" ".join("".join(r.choice(letters) for _ in range(r.randint(1, 6))) for _ in range(20)), lang) for lang, letters in (("aa", "abcde"), ("bb", "cdefg"), ("cc", "xyzab")) for _ in range(30)]
    params = language.Params()
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"), F.lit(True), params=params)
    counts = {lang: Counter() for lang in ("aa", "bb", "cc")}
    for text, lang in rows:
        counts[lang].update(language.grams([text], params.n)[0].tolist())
    share = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    every = sorted(set().union(*counts.values()))
    found = model.lookup(np.array(every, np.uint32))[:, 0]
    assert model.languages == ["aa", "bb", "cc"]
    false = 0
    for g, mask in zip(every, found.tolist(), strict=True):
        most = max(s.get(g, 0) for s in share.values())
        want = {lang for lang, s in share.items() if s.get(g, 0) >= max(params.ratio * most, params.min_share)}
        got = {lang for i, lang in enumerate(model.languages) if mask >> i & 1}
        assert want <= got
        false += len(got - want)
    assert false <= 3 * len(every) * (model.false_rate.max() + 0.001) + 3


@pytest.mark.parametrize("seed", range(6))
def test_exact_packing_needs_the_fewest_sequences(seed):
    r = random.Random(seed)
    pieces = [r.randint(1, 12) for _ in range(9)]

    def fewest(rest, spaces, best):
        if len(spaces) >= best:
            return best
        if not rest:
            return len(spaces)
        for i, s in enumerate(spaces):
            if s >= rest[0]:
                best = min(best, fewest(rest[1:], [*spaces[:i], s - rest[0], *spaces[i + 1 :]], best))
        return min(best, fewest(rest[1:], [*spaces, 13 - rest[0]], best))

    plan = packing.complete(Counter(pieces), 13, packing.EXACT)
    assert sum(n for _, n in plan) == fewest(sorted(pieces, reverse=True), [], 99)


def test_token_ids_equal_the_tokenizers_library():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = pq.read_table(f"{SMALL}/documents.parquet").column("text").to_pylist()
    texts = [x or "" for _, x in AWKWARD] + whole + ["a<|endoftext|><|endoftext|> b", "it's  we'll\n\n\t x   　y 12345 $$$ \r\n", "日本語 العربية ​ é"]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.token_ids(texts)] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def lzw(samples, bits):
    """A plain LZW encoder, which keeps its full table to the end."""
    clear, width, table, out = 1 << bits, bits + 1, {bytes([i]): i for i in range(1 << bits)}, []
    emit = lambda code: out.append((code, width))
    emit(clear)
    nxt, w = clear + 2, b""
    for s in samples:
        x = w + bytes([s])
        if x in table:
            w = x
            continue
        emit(table[w])
        if nxt < 4096:
            table[x] = nxt
            if nxt == 1 << width and width < 12:
                width += 1
            nxt += 1
        w = bytes([s])
    if w:
        emit(table[w])
    emit(clear + 1)
    pool = have = 0
    data = bytearray()
    for code, size in out:
        pool |= code << have
        have += size
        while have >= 8:
            data.append(pool & 255)
            pool >>= 8
            have -= 8
    return bytes(data) + bytes([pool & 255])


def unlzw(data, bits):
    """A plain LZW decoder, code by code: the samples, and how many codes stood for more than one."""
    clear, pool, have, before, out, long = 1 << bits, 0, 0, b"", [], 0
    table, width = {}, bits + 1
    for byte in data:
        pool |= byte << have
        have += 8
        while have >= width:
            code, pool, have = pool & ((1 << width) - 1), pool >> width, have - width
            if code == clear:
                table, width, before = {i: bytes([i]) for i in range(clear)} | {clear: b"", clear + 1: b""}, bits + 1, b""
                continue
            if code == clear + 1:
                return b"".join(out), long
            word = table[code] if code in table else before + before[:1]
            assert code in table or code == len(table)
            if before and len(table) < 4096:
                table[len(table)] = before + word[:1]
            if len(table) == 1 << width and width < 12:
                width += 1
            out.append(word)
            long += len(word) > 1
            before = word
    raise AssertionError("no end code")


def payloads():
    r = random.Random(9)
    passage = " ".join(made_texts(40, 3)).encode()
    for n in (64, 640, 64 * 4096 + 64):
        for x in (r.randbytes(n), b"\0" * n, (b"aab" * n)[:n], (passage * (n // len(passage) + 1))[:n]):
            yield x


def test_gif_round_trips():
    for payload in payloads():
        frames = list(gif.decode(gif.encode(payload)))
        assert b"".join(gif.samples(f.pixels).tobytes() for f in frames) == payload
        assert [f.start_ms for f in frames] == [0, 100][: len(frames)] and len(frames) == -(-len(payload) // (64 * 4096))
        assert sum(sum(gif.histogram(f.pixels)) for f in frames) == len(payload)
    for bits, n in ((2, 50), (8, 300), (8, 20_000)):
        samples = bytes(r % min(1 << bits, 6) for r in random.Random(bits).randbytes(n))
        assert gif.lzw_decode(lzw(samples, bits), bits, n).tobytes() == samples


def test_gif_code_streams_equal_a_plain_coder():
    for payload in payloads():
        blocks = gif._lzw(payload)
        data, _ = gif._sub_blocks(blocks, 1)
        samples, long = unlzw(data, 8)
        assert samples == payload and gif.lzw_decode(data, 8, len(payload)).tobytes() == payload
        assert long > len(payload) // 1000 or len(payload) < 1000
    # Before the table is full, the codes are those of the plain encoder.
    text = " ".join(made_texts(20, 5)).encode()[:3000]
    assert gif._sub_blocks(gif._lzw(text), 1)[0] == lzw(text, 8)[: len(gif._sub_blocks(gif._lzw(text), 1)[0])]


def test_gif_damaged_code_streams():
    data = lzw(bytes(range(8)) * 40, 8)
    for codes in (b"\xff\xff\xff\xff", data[:3] + b"\xff" * 9):
        with pytest.raises(ValueError, match="not in the table"):
            gif.lzw_decode(codes, 8, 320)
    assert len(gif.lzw_decode(data[:40], 8, 320)) < 320
    assert gif.lzw_decode(data, 8, 5).tobytes() == bytes(range(5))
    assert len(gif.lzw_decode(b"", 8, 5)) == 0
    for bits in (0, 9):
        with pytest.raises(ValueError, match="out of range"):
            gif.lzw_decode(data, bits, 5)


def image(left, top, w, h, samples, disposal=0, clear=None, interlaced=False):
    data = lzw(samples, 2)
    return b"\x21\xf9\x04" + bytes([disposal << 2 | (clear is not None), 5, 0, clear or 0, 0]) + b"\x2c" + b"".join(x.to_bytes(2, "little") for x in (left, top, w, h)) + bytes([0x40 if interlaced else 0, 2, len(data)]) + data + b"\0"


def test_gif_disposal_transparency_and_interlace(spark):
    head = b"GIF89a" + (2).to_bytes(2, "little") + (2).to_bytes(2, "little") + b"\xf1\0\0" + bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    data = head + image(0, 0, 2, 2, [1] * 4) + image(0, 0, 1, 1, [2], disposal=2) + image(1, 1, 1, 1, [3], disposal=3) + image(0, 0, 2, 2, [0, 1, 0, 0], clear=0) + b"\x3b"
    shown = [f.pixels for f in gif.decode(data)]
    assert [f.start_ms for f in gif.decode(data)] == [0, 50, 100, 150]
    assert shown[1][0, 0].tolist() == [0, 255, 0, 255] and shown[2][0, 0].tolist() == [0, 0, 0, 0]
    assert shown[2][1, 1].tolist() == [0, 0, 255, 255] and shown[3][1, 1].tolist() == [255, 0, 0, 255]
    tall = head[:6] + (1).to_bytes(2, "little") + (8).to_bytes(2, "little") + head[10:] + image(0, 0, 1, 8, [0, 1, 2, 2, 3, 3, 3, 3], interlaced=True) + b"\x3b"
    assert next(gif.images(tall))["index"][:, 0].tolist() == [0, 3, 2, 3, 1, 3, 2, 3]
    df = spark.createDataFrame([(1, data), (2, b"no"), (3, None)], "id long, g binary")
    rows = gif.frames(df, "id", "g").collect()
    assert sum(r.id == 1 for r in rows) == 4 and {r.id for r in rows if r.error} == {2, 3}
    assert sum(rows[0].histogram) == 4


def test_gif_columns(spark, awkward):
    for r, (_, t) in zip(gif.stored(awkward).collect(), AWKWARD, strict=True):
        raw = (t or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), crc32(payload[-64:]))
        media = gif.encode(payload)
        assert (r.media_bytes, r.media_sha256, r.n_frames, r.duration_ms) == (len(media), hashlib.sha256(media).hexdigest(), 1, 100)
        colours = Counter((x & 0xE0) >> 6 << 4 | ((x & 0x1C) << 3) >> 6 << 2 | x & 3 for x in payload)
        assert r.feature == ",".join(str(colours[i]) for i in range(64))


def test_restoration():
    counts = np.zeros((toxicity.SIZE,) * 3)
    for w in ["moron", "idiot", "stupid", "the", "clown", "trash"] * 50:
        s = [0, 0, *(ord(c) - 95 for c in w), 0]
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            counts[a, b, c] += 1
    r = toxicity.Restorer(toxicity.char_model(counts))
    for x, want in {"m0r0n": "moron", "1d10t": "idiot", "$tup1d": "stupid", "stuuuupid": "stupid", "m o r o n": "moron", "i.d.i.o.t": "idiot", "cl*own": "clown", "the clown": "the clown", "tr@$h": "trash"}.items():
        assert r.text(x) == want
    assert r.text("a\tb  c\n") == "a\tb  c\n"


def taught(*known):
    counts = np.zeros((toxicity.SIZE,) * 3)
    for w in known:
        s = [0, 0, *(toxicity.Restorer._symbol(c) for c in w), 0]
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            counts[a, b, c] += 50
    return toxicity.Restorer(toxicity.char_model(counts))


def flagged(text):
    data = text.encode()
    return bool(toxicity._suspicious(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0])


def test_disguised_words_inside_a_text():
    r = taught("you", "are", "such", "idiot", "really", "scum", "the", "stupid", "thing", "niño", "trash", "duck", "he", "is", "to", "us")
    for x, want in {"you are such 1diot really": "you are such idiot really", "he is $cum to us": "he is scum to us", "the 5tupid thing": "the stupid thing", "the tras# thing": "the trash thing", "niñññño": "niño", "NIÑñÑO": "niño", "a du(k here": "a duck here"}.items():
        assert flagged(x) and r.text(x).lower() == want
    assert r.text("(the thing) is") == "(the thing) is"


def test_spaced_words_keep_their_edges():
    r = taught("a", "a", "moron", "scum", "you", "are", "now", "the", "thing", "idiot", "жлоб")
    for x, want in {"you are a m o r o n now": "you are a moron now", "m o r o n s c u m": "moron scum", "m  o  r\to\nn": "moron", "the b i d thing": "the bid thing", "ж л о б": "жлоб", "s·c·u·m": "scum", "1 2 3 4 5": "1 2 3 4 5"}.items():
        assert r.text(x) == want
        assert flagged(x)
    assert not flagged("you are the thing")


def score_of(rows, truth):
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    return held, [truth[r.doc_id] for r in held]


def cost_of(restorer, strings, costs):
    total, x, y = 0.0, toxicity.EDGE, toxicity.EDGE
    for string, cost in zip(strings, costs, strict=True):
        total += cost
        for ch in string:
            z = restorer._symbol(ch)
            total -= restorer.logp[x][y][z]
            x, y = y, z
    return total - restorer.logp[x][y][toxicity.EDGE]


def test_viterbi_finds_the_cheapest_of_all_paths():
    r = taught("idiot", "moron", "scum", "boot", "lies", "tile", "see", "glee")
    rng = random.Random(11)
    tokens = ["1d10t", "m0r0n", "$(um", "b00t", "|!e5", "7113", "g1333", "s33!!"] + ["".join(rng.choice("ab13!|0$s7(t") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    for token in tokens:
        ways = r.lattice(token, False)
        paths = [(cost_of(r, [w for w, _ in path], [c for _, c in path]), "".join(w for w, _ in path)) for path in itertools.product(*ways)]
        best = min(c for c, _ in paths)
        assert min(c for c, x in paths if x == r.decode(token)) == pytest.approx(best, abs=1e-6)


def test_toxicity_on_held_out_rows(spark):
    sf = SMALL.replace("0.001", "0.1")
    rows = queries.op1_toxicity(spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.held_out == is_held_out(r.doc_id) and r.predicted == (r.score >= 0.3) for r in rows)
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    held, y = score_of(rows, {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()})
    assert np.mean([r.predicted == t for r, t in zip(held, y, strict=True)]) > 0.97
    caught = defaultdict(list)
    for r, t in zip(held, y, strict=True):
        caught[lang[r.doc_id], t].append(r.predicted)
    for (name, t), found in caught.items():
        if t and len(found) >= 10:
            assert np.mean(found) >= 0.9, name
        if not t:
            assert np.mean(found) <= 0.05, name
    # Scores order the rows: the area under the curve, in which ties count half.
    toxic, clean = (np.array([r.score for r, t in zip(held, y, strict=True) if t == k]) for k in (1, 0))
    assert np.mean((toxic[:, None] > clean) + 0.5 * (toxic[:, None] == clean)) > 0.95


def test_toxicity_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "uno dos"), (2, None)], "doc_id long, text string")
    for rows, share in ([(1, 0), (2, 0)], 0.02 / 3), ([(1, None)], 0.02), ([(1, 1)], 1.02 / 2):
        model = toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert not model.lexicon
        assert [r.toxicity for r in toxicity.score(docs, model).collect()] == [pytest.approx(min(share, 1 - 1e-9), abs=1e-6)] * 2


def test_language_on_held_out_rows(spark):
    sf = SMALL.replace("0.001", "0.01")
    rows = queries.op3_language(spark, sf).collect()
    held, y = score_of(rows, {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.lang})
    assert np.mean([r.lang_pred == t for r, t in zip(held, y, strict=True)]) > 0.97


def test_letters_that_stand_alone_have_a_language(spark):
    df = spark.createDataFrame([(1, "y o a e hola", "es"), (2, "i a x w hello", "en"), (3, "日 本 語", "ja")], "doc_id long, text string, lang string")
    model = language.fit(df, F.lit(True))
    texts = ["Y.", "W", "i x", "本", "¡o! a", "", None, "1 2 .", "Ж"]
    langs, scores = model.predict(texts)
    assert langs[:4] == ["es", "en", "en", "ja"] and langs[4] == "es" and langs[5:8] == ["und"] * 3 and langs[8] != "und"
    assert all(scores[:5] > 0.4) and not any(scores[5:8])
    code, before = language.grams(["I am a b", None, "A"], 4)
    assert np.diff(before).tolist() == [4, 0, 1] and code[2] == code[4]


def test_many_languages_need_more_words_of_mask(spark):
    rows = [(i, " ".join(chr(0x4E00 + 50 * i + k % 7) * 3 for k in range(30)), f"l{i:03}") for i in range(70)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, F.lit(True), params=language.Params(n=3))
    assert model.masks.shape[1] == 2
    assert all(r.lang == r.lang_pred for r in language.identify(df, model).collect())


def test_pseudo_likelihood_prefers_the_corpus(spark):
    texts = ["uno dos tres cuatro cinco " * 30] * 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pseudo_likelihood.fit(df, params=pseudo_likelihood.Params(batch=64))
    probe = spark.createDataFrame([(1, "uno dos tres cuatro cinco " * 4), (2, "cinco uno uno tres dos " * 4), (3, None)], "doc_id long, text string")
    a, b, c = pseudo_likelihood.score(probe, model).orderBy("doc_id").collect()
    assert a.log_likelihood > b.log_likelihood and (c.n_words, c.log_likelihood, c.mean_log_likelihood) == (0, 0.0, None)


def paired_texts():
    r = random.Random(3)
    pairs = [(f"a{i}", f"b{i}") for i in range(300)]
    return pairs, [" ".join(x for _ in range(40) for x in r.choice(pairs)) for _ in range(400)] + ["once"]


def test_pseudo_likelihood_tells_words_apart(spark):
    # 600 words, each always with the other of its pair: shared classes could not tell the pairs apart.
    pairs, texts = paired_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    model = pseudo_likelihood.fit(df, params=pseudo_likelihood.Params(batch=64, words_per_slot=1))
    assert model.counts.count() == 601 and model.total == 400 * 80 + 1
    right = [f"{a} {b} {c} {d}" for (a, b), (c, d) in zip(pairs[:200], pairs[100:], strict=False)]
    wrong = [f"{a} {d} {c} {b}" for (a, b), (c, d) in zip(pairs[:200], pairs[100:], strict=False)]
    probe = spark.createDataFrame(list(enumerate(right + wrong)), "doc_id long, text string")
    got = [x.log_likelihood for x in pseudo_likelihood.score(probe, model).orderBy("doc_id").collect()]
    assert np.mean(np.array(got[:200]) > np.array(got[200:])) > 0.8


@pytest.mark.parametrize("known", [4, 1 << 18])
def test_pseudo_likelihood_equals_a_plain_loop(spark, known):
    _, texts = paired_texts()
    texts = texts[:60] + ["once", "a1 B1 never\tseen"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # All slots are summed, so Z is exact and the probabilities of all counted words sum to one.
    params = pseudo_likelihood.Params(batch=64, frequent=16, drawn=64, fixed=1 << 9, known_words=known)
    model = pseudo_likelihood.fit(df.filter("doc_id < 61"), params=params)
    n = Counter(w.lower() for t in texts[:61] for w in t.split())
    net = model.network
    slot = {w: int(net.slots(pseudo_likelihood._words(pa.array([w]))[0])[0]) for w in {*n, "never", "seen"}}
    share = {w: max(n[w], 1) / model.total for w in slot}

    def log_p(words, i):
        around = [words[j] if 0 <= j < len(words) else None for j in (i - 2, i - 1, i + 1, i + 2)]
        x = np.concatenate([net.embedding[len(net.share) if w is None else slot[w]] for w in around])
        h = np.tanh(x @ net.dense[0] + net.dense[1])
        z = sum(n[w] / model.total * math.exp(h @ net.output[slot[w]]) for w in n)
        assert sum(share[w] * math.exp(h @ net.output[slot[w]]) / z for w in n) == pytest.approx(1)
        return math.log(share[words[i]]) + float(h @ net.output[slot[words[i]]]) - math.log(z)

    got = {r.doc_id: r for r in pseudo_likelihood.score(df, model).collect()}
    for i in (0, 7, 60, 61):
        words = texts[i].lower().split()
        assert got[i].log_likelihood == pytest.approx(sum(log_p(words, k) for k in range(len(words))), rel=1e-3, abs=1e-3)
        assert (got[i].n_words, got[i].n_once) == (len(words), sum(n[w] <= 1 for w in words))


def test_pseudo_likelihood_keeps_probabilities_below_one(spark):
    pairs, texts = paired_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pseudo_likelihood.fit(df, params=pseudo_likelihood.Params(batch=64, frequent=4, drawn=4, fixed=4))
    assert all(r.log_likelihood < 0 for r in pseudo_likelihood.score(df, model).collect())
    # What is counted grows with the corpus.
    assert pseudo_likelihood.fit(df.filter("doc_id < 2")).counts.count() == len(set(" ".join(texts[:2]).split())) < model.counts.count() == 601


def test_cotraining_on_held_out_rows(spark):
    sf = SMALL.replace("0.001", "0.01")
    held, y = score_of(queries.op7_cotraining(spark, sf).collect(), {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()})
    assert np.mean([r.predicted == t for r, t in zip(held, y, strict=True)]) > 0.9


def test_url_filter_as_of(spark):
    entries = spark.createDataFrame([("a.com", "block", 1), ("a.com", "allow", 5), ("x.a.com/p", "block", 3), ("b.com", "block", None)], "pattern string, action string, effective int")
    cases = [("http://A.com/", 0, "none"), ("http://a.com:80/q", 1, "block"), ("https://u@y.a.com", 4, "block"), ("http://a.com", 5, "allow"), ("http://x.a.com/p/1", 6, "block"), ("http://x.a.com/q", 6, "allow"), ("http://ba.com", 2, "none"), ("http://b.com", 9, "none"), (None, 3, "none"), ("mailto:x", 3, "none"), ("http://a.com", None, "none")]
    df = spark.createDataFrame([(*c, "old") for c in cases], "url string, fetched_at int, want string, host string")
    assert all(r.action == r.want for r in urls.evaluate(df, entries).collect())
    assert urls.evaluate(df, entries.limit(0)).filter("action <> 'none'").count() == 0


def test_awkward_and_empty_tables(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "doc_id long, toxic int")
    bench = spark.createDataFrame([(1, "cuatro cinco seis"), (2, None), (3, "")], "item_id long, text string")
    for df in (awkward, nothing):
        n = df.count()
        model = toxicity.fit(df, labels)
        assert toxicity.score(df, model).count() == toxicity.deobfuscate(df, model).count() == n
        assert lines.dedup_lines(df).count() == jaccard.near_duplicates(df).count() == decontaminate.report(df, bench).count() == n
        assert decontaminate.report(df, bench.limit(0)).filter("contaminated").count() == 0
        assert decontaminate.clean(df, bench).count() == n - (3 if n else 0)
        assert gif.stored(df).count() == n and packing.pack(df).select("doc_id").distinct().count() == (9 if n else 0)
        assert pseudo_likelihood.score(df, pseudo_likelihood.fit(df)).count() == n
        found = language.identify(df, language.fit(df.withColumn("lang", F.lit("xx")), F.lit(True))).collect()
        assert len(found) == n and all(r.lang_pred == "und" for r in found if not any(c.isalpha() for c in r.text or ""))
    none = quality.score(nothing.selectExpr("doc_id", "text", "'a' source", "'b' lang", "1L n_chars"), spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "doc_id long, quality int"))
    assert none.count() == 0
    out = {r.doc_id: r for r in jaccard.near_duplicates(awkward).collect()}
    assert out[1].n_shingles == out[3].n_shingles == 0 and out[1].component_id == 1


def test_the_pipeline_on_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SMALL)
        assert kept.columns == docs.columns, name
        kept = spark.createDataFrame(kept.collect(), docs.schema)
    n = kept.count()
    assert 0.5 * docs.count() < n < docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SMALL)
    assert packed.select("doc_id").distinct().count() == n


def test_lines_of_rows_that_share_a_key(spark):
    text = lambda *ls: "\n".join(ls)
    rows = [("k1", text(*"abc"), "u"), ("k2", text(*"abc"), "u"), ("k2", text(*"xyzw"), "u"), ("k3", text(*"xyz"), None), ("k3", text(*"xyz"), None), (None, text(*"abc"), "u")]
    df = spark.createDataFrame(rows, "doc_id string, text string, pos string")
    got = sorted((r.doc_id or "", r.text, r.n_removed) for r in lines.dedup_lines(df).collect())
    assert got == [("", "a\nb\nc", 0), ("k1", "a\nb\nc", 0), ("k2", "", 3), ("k2", "x\ny\nz\nw", 0), ("k3", "", 3), ("k3", "", 3)]


def test_url_filter_keeps_columns_with_clashing_names(spark):
    entries = spark.createDataFrame([("com", "block", 1)], "pattern string, action string, effective int")
    df = spark.createDataFrame([("http://a.com", 2, 1, 2, 3, 4, 5)], "url string, fetched_at int, u int, t int, b int, l int, h int")
    r = urls.evaluate(df, entries).first()
    assert (r.u, r.t, r.b, r.l, r.h, r.host, r.action, r.pattern) == (1, 2, 3, 4, 5, "a.com", "block", "com")


def test_cotraining_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "uno", "s", "es", 3), (2, None, None, None, None)], "doc_id long, text string, source string, lang string, n_chars long")
    pages = spark.createDataFrame([], "page_id long, url string")
    for given, want in ([(1, 1)], 1.0), ([(1, 0)], 0.0), ([], 0.5), ([(1, None)], 0.5):
        got = quality.score(docs, pages, spark.createDataFrame(given, "doc_id long, quality int")).collect()
        assert [r.text_score for r in got] == [want] * 2


def test_different_hashes_are_counted_by_row():
    r = np.random.default_rng(2)
    hashes, before = r.integers(0, 5, 40).astype(np.uint64), np.array([0, 0, 7, 7, 20, 40])
    assert quality._different(hashes, before).tolist() == [len(set(hashes[a:b].tolist())) for a, b in itertools.pairwise(before)]


def test_winnowing_selects_a_fingerprint_once_for_a_run_of_windows(spark):
    text = " ".join(f"w{i % 31}" for i in range(200)) + " la" * 100
    row = decontaminate._scanned(spark.createDataFrame([("a", text)], "id string, text string"), [10], 10, 5, None, True).first()
    assert row.n_words == 300 and sum(len(f["keys"]) for f in row.found) == 291 and len(row.found) < 120
    assert all(a.fp != b.fp and a.pos + len(a["keys"]) == b.pos for a, b in itertools.pairwise(row.found))


def test_prefixes_are_laid_out_to_be_packed():
    rows = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([" ".join(f"w{i}" for i in range(100)), "w1 w2"])], ["doc", "text"])
    (got,) = jaccard._prefixes(5, 80, np.zeros(1 << jaccard.BITS, np.uint8))([rows])
    # What changes within a document (token, pos) stands before what does not.
    assert got.schema.names == ["token", "pos", "salt", "doc", "n"]
    assert got.column("pos").to_pylist()[:3] == [0, 1, 2] and set(got.column("n").to_pylist()[:-1]) == {96} and got.column("doc").to_pylist()[-1] == 8
