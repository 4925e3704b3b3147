"""GIF: LZW code streams, palettes, disposal and transparency; timed frames with colour histograms.

``encode`` stores 8-bit samples as frames of one palette of 256 different colours, by adaptive LZW with codes of
9 to 12 bits. ``decode`` reads any GIF 87a or 89a and shows its frames.

Reading a code stream needs no loop over codes. Entry k of the table is the string of the k-th code since
the last clear code and the first sample of the next one, so it stands in the output, where the k-th code's
string begins, one sample longer. Codes therefore are references back into their own output; pointer
doubling finds the lengths of all strings of a segment, then the literal behind each sample.

Edge cases: null is empty, and an empty payload is stored as 64 zero bytes; equal texts have equal results;
broken files raise ValueError in ``decode``, and have in ``frames`` a row with an error after the frames that could be shown; an
empty table gives an empty result. Columns besides the named ones are never read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tamiz.llm.shared import slices

WIDTH, ROWS = 64, 4096
#: Entries of a code table, and codes read at once at first.
FULL, CHUNK = 4096, 512
_SAMPLES = np.arange(256, dtype=np.uint8)
#: The colour of a sample: three bits of red, three of green, two of blue.
_PALETTE = np.stack([_SAMPLES & 0xE0, (_SAMPLES & 0x1C) << 3, (_SAMPLES & 3) << 6], axis=1)


@dataclass
class Frame:
    """One frame as shown: its time, how long it stays, and the screen's pixels [height, width, RGBA]."""

    start_ms: int
    delay_ms: int
    pixels: np.ndarray


def _widths(bits: int) -> np.ndarray:
    """Bits of the t-th code since a clear code, up to the first of twelve bits that all later ones repeat."""
    out = np.minimum(np.log2(np.arange(FULL) + (1 << bits) + 1).astype(np.int64) + 1, 12)
    out[0] = bits + 1
    return out


#: By minimum code size.
_WIDTHS = {bits: _widths(bits) for bits in range(1, 9)}


def _codes(samples: bytes) -> list[int]:
    """Adaptive LZW of 8-bit samples: the longest strings in the table, and a clear code whenever it is full."""
    table: dict[int, int] = {}
    find = table.get
    out = [256]
    entry, string = 258, samples[0]
    for sample in memoryview(samples)[1:]:
        key = string << 8 | sample
        longer = find(key)
        if longer is not None:
            string = longer
            continue
        out.append(string)
        if entry < FULL:
            table[key] = entry
            entry += 1
        else:
            out.append(256)
            table.clear()
            entry = 258
        string = sample
    out += (string, 257)
    return out


def _lzw(samples: bytes) -> bytes:
    """A code stream in sub-blocks."""
    codes = np.array(_codes(samples), np.uint32)
    places = np.arange(len(codes))
    cleared = np.maximum.accumulate(np.where(codes == 256, places, 0))
    since = places[1:] - cleared[:-1] - 1
    widths = np.concatenate([[9], _WIDTHS[8][np.minimum(since, FULL - 1)]])
    ends = np.cumsum(widths)
    starts = ends - widths
    # Codes have more bits than a byte, so no two of them begin in the same one.
    at, shifted = starts >> 3, codes << (starts & 7).astype(np.uint32)
    data = np.zeros((int(ends[-1]) + 7 >> 3) + 2, np.uint8)
    for k in range(3):
        data[at + k] |= (shifted >> np.uint32(8 * k)).astype(np.uint8)
    data = data[: int(ends[-1]) + 7 >> 3]
    full = len(data) // 255
    blocks = np.empty((full, 256), np.uint8)
    blocks[:, 0] = 255
    blocks[:, 1:] = data[: full * 255].reshape(full, 255)
    rest = data[full * 255 :].tobytes()
    return b"\x08" + blocks.tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def encode(payload: bytes, delay_cs: int = 10) -> bytes:
    """A GIF whose samples are ``payload`` (a positive multiple of 64 bytes), 64 wide, at most ROWS high a frame."""
    height = min(len(payload) // WIDTH, ROWS)
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, height, 0xF7, 0, 0), _PALETTE.tobytes()]
    for at in range(0, len(payload), WIDTH * ROWS):
        part = payload[at : at + WIDTH * ROWS]
        # Each frame goes before the next one comes, so that a shorter last one is shown alone.
        out.append(b"\x21\xf9\x04" + struct.pack("<BHBB", 2 << 2, delay_cs, 0, 0))
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, WIDTH, len(part) // WIDTH, 0))
        out.append(_lzw(part))
    return b"".join([*out, b"\x3b"])


def _segments(data: bytes, bits: int) -> Iterator[np.ndarray]:
    """The codes between clear codes, up to the end code or the last whole code."""
    read = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    read = read[:-2] | read[1:-1] << np.uint32(8) | read[2:] << np.uint32(16)
    total, table, clear = len(data) * 8, _WIDTHS[bits], 1 << bits
    at = since = 0
    chunk, parts = CHUNK, []
    while True:
        widths = table[since : since + chunk]
        if len(widths) < chunk:
            widths = np.concatenate([widths, np.full(chunk - len(widths), 12)])
        ends = at + np.cumsum(widths)
        whole = int(np.searchsorted(ends, total, side="right"))
        starts = ends[:whole] - widths[:whole]
        codes = (read[starts >> 3] >> (starts & 7).astype(np.uint32)).astype(np.int64) & (1 << widths[:whole]) - 1
        marks = np.flatnonzero(codes >> 1 == clear >> 1)  # clear and end
        if len(marks):
            stop = int(marks[0])
            parts.append(codes[:stop])
            yield np.concatenate(parts)
            if codes[stop] != clear:
                return
            chunk, parts, since, at = max(CHUNK, stop * 2), [], 0, int(ends[stop])
        elif whole < chunk:
            yield np.concatenate([*parts, codes])
            return
        else:
            parts.append(codes)
            since, at, chunk = since + whole, int(ends[-1]), chunk * 2


def _expand(codes: np.ndarray, clear: int, size: int) -> np.ndarray:
    """The samples of one segment's codes, at most ``size``."""
    places = np.arange(len(codes))
    back = codes - (clear + 2)
    plain = back < 0
    unknown = np.flatnonzero((back >= places) | (back >= FULL - clear - 2))
    if len(unknown):  # of no matter after the last sample
        out = _expand(codes[: unknown[0]], clear, size)
        if len(out) < size:
            raise ValueError("an LZW code that is not in the table")
        return out
    up, longer = np.where(plain, places, back), (~plain).astype(np.int64)
    while (more := longer[up]).any():
        longer, up = longer + more, up[up]
    lengths = longer + 1
    stops = np.cumsum(lengths)
    starts = stops - lengths
    n = int(np.searchsorted(starts, size))
    codes, plain, lengths, starts = codes[:n], plain[:n], lengths[:n], starts[:n]
    moved = np.where(plain, 0, starts[np.maximum(back[:n], 0)] - starts)
    total = int(lengths.sum())
    literal, out = np.zeros(total, bool), np.zeros(total, np.uint8)
    literal[starts[plain]] = True
    out[starts[plain]] = codes[plain]
    source = np.arange(total) + np.repeat(moved, lengths)
    while not literal[source].all():
        source = source[source]
    return out[source][:size]


def lzw_decode(data: bytes, bits: int, size: int) -> np.ndarray:
    """The samples of an LZW code stream of minimum code size ``bits``; at most ``size`` of them."""
    if bits not in _WIDTHS:
        raise ValueError("an LZW code size out of range")
    out, got = [np.zeros(0, np.uint8)], 0
    for codes in _segments(data, bits):
        out.append(_expand(codes, 1 << bits, size - got))
        got += len(out[-1])
        if got >= size:
            break
    return np.concatenate(out)


def _sub_blocks(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(data) and (n := data[at]):
        parts.append(data[at + 1 : at + 1 + n])
        at += n + 1
    return b"".join(parts), at + 1


def images(data: bytes) -> Iterator[dict]:
    """The images of a file as stored: place, indices, palette, transparent index, disposal, delay."""
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise ValueError("not a GIF")
    width, height, flags, _, _ = struct.unpack("<HHBBB", data[6:13])
    at, shared = 13, None
    if flags & 0x80:
        n = 3 << ((flags & 7) + 1)
        shared = np.frombuffer(data[at : at + n], np.uint8).reshape(-1, 3)
        at += n
    control = (0, 0, None)
    while at < len(data):
        kind = data[at]
        if kind == 0x3B:
            return
        if kind == 0x21:
            body, stop = _sub_blocks(data, at + 2)
            if data[at + 1] == 0xF9 and len(body) >= 4:
                control = (body[0] >> 2 & 7, struct.unpack("<H", body[1:3])[0] * 10, body[3] if body[0] & 1 else None)
            at = stop
        elif kind == 0x2C:
            left, top, w, h, own = struct.unpack("<HHHHB", data[at + 1 : at + 10])
            at += 10
            palette = shared
            if own & 0x80:
                n = 3 << ((own & 7) + 1)
                palette = np.frombuffer(data[at : at + n], np.uint8).reshape(-1, 3)
                at += n
            bits = data[at]
            body, at = _sub_blocks(data, at + 1)
            flat = lzw_decode(body, bits, w * h)
            if len(flat) < w * h:
                raise ValueError("too few samples")
            index = flat.reshape(h, w)
            if own & 0x40:  # interlaced: rows come in four passes
                order = np.concatenate([np.arange(s, h, step) for s, step in ((0, 8), (4, 8), (2, 4), (1, 2))])
                straight = np.empty_like(index)
                straight[order] = index
                index = straight
            yield {"screen": (width, height), "left": left, "top": top, "index": index, "palette": palette, "disposal": control[0], "delay_ms": control[1], "transparent": control[2]}
            control = (0, 0, None)
        else:
            raise ValueError("an unknown block")


def decode(data: bytes) -> Iterator[Frame]:
    """The frames as shown: palettes applied, transparent pixels kept from below, disposal done."""
    screen, clock = None, 0
    for image in images(data):
        width, height = image["screen"]
        if screen is None:
            screen = np.zeros((height, width), np.uint32)
        if image["palette"] is None or len(image["palette"]) == 0:
            raise ValueError("no palette")
        before = screen.copy() if image["disposal"] == 3 else None
        index = image["index"][: max(height - image["top"], 0), : max(width - image["left"], 0)]
        place = (slice(image["top"], image["top"] + index.shape[0]), slice(image["left"], image["left"] + index.shape[1]))
        palette = image["palette"]
        rgba = np.concatenate([palette[np.minimum(_SAMPLES, len(palette) - 1)], np.full((256, 1), 255, np.uint8)], axis=1).view(np.uint32)[:, 0]
        if image["transparent"] is None:
            screen[place] = rgba[index]
        else:
            screen[place] = np.where(index == image["transparent"], screen[place], rgba[index])
        yield Frame(clock, image["delay_ms"], screen.copy().view(np.uint8).reshape(height, width, 4))
        clock += image["delay_ms"]
        if image["disposal"] == 2:
            screen[place] = 0
        elif before is not None:
            screen = before


def samples(pixels: np.ndarray) -> np.ndarray:
    """The samples behind the visible pixels of a frame that ``encode`` stored, from their colours."""
    p = pixels.reshape(-1, 4)
    p = p[p[:, 3] > 0]
    return p[:, 0] | p[:, 1] >> 3 | p[:, 2] >> 6


def histogram(pixels: np.ndarray) -> list[int]:
    """Counts of visible pixels in 64 colours: two bits each of red, green and blue."""
    p = pixels.reshape(-1, 4)
    code = (p[:, 0] >> 6 << 4) | (p[:, 1] >> 6 << 2) | (p[:, 2] >> 6)
    return np.bincount(code[p[:, 3] > 0], minlength=64).tolist()


FRAMES = "frame int, start_ms long, delay_ms long, width int, height int, rgba binary, histogram array<long>, error string"


def frames(df: DataFrame, key: str, data: str) -> DataFrame:
    """One row per shown frame of each GIF in the binary column ``data``: the key and FRAMES."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                for k, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    yield from map(one, shown(k, x or b""))

    def shown(k, data: bytes) -> Iterator[tuple]:
        try:
            for i, f in enumerate(decode(data)):
                yield k, i, f.start_ms, f.delay_ms, f.pixels.shape[1], f.pixels.shape[0], f.pixels.tobytes(), histogram(f.pixels), None
        except (ValueError, IndexError, struct.error) as e:
            yield k, *[None] * 7, str(e)

    def one(row: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names)

    kind = df.schema[key].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    names = [key, "frame", "start_ms", "delay_ms", "width", "height", "rgba", "histogram", "error"]
    kinds = [to_arrow_type(kind), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.string()]
    return df.select(key, data).mapInArrow(run, f"`{key}` {kind.simpleString()}, {FRAMES}")


def stored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each whole text as a GIF, whose frames are shown again: the key, n_bytes, payload_bytes, payload_sha256,
    tail_crc32, media_bytes, media_sha256, feature (the frames' colour histograms, summed), n_frames, duration_ms.
    The payload is read from the visible colours of the shown frames."""
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames", "duration_ms"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows = [digests((x or "").encode()) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], names)

    def digests(raw: bytes) -> tuple:
        media = encode(raw + b"\0" * ((-len(raw)) % 64 if raw else 64))
        whole, tail, colours = hashlib.sha256(), b"", np.zeros(64, np.int64)
        n = n_frames = duration = 0
        for frame in decode(media):
            seen = samples(frame.pixels).tobytes()
            whole.update(seen)
            tail = (tail + seen)[-64:]
            colours += histogram(frame.pixels)
            n, n_frames, duration = n + len(seen), n_frames + 1, duration + frame.delay_ms
        return len(raw), n, whole.hexdigest(), crc32(tail), len(media), hashlib.sha256(media).hexdigest(), ",".join(map(str, colours.tolist())), n_frames, duration

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, duration_ms long")
