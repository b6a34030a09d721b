"""Media columns: texts stored as AVI motion-JPEG, read back, and cut into timed clips.

Frames are lossless JPEG (process SOF3, predictor 1) of 8-bit samples, 64 to a row. The Huffman code is chosen so
that every difference takes nine bits, code and extra bits together; the file stays an ordinary JPEG with an
ordinary table, yet rows of samples are coded and decoded side by side in numpy.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import small_batches, text_of, thrifty

ROW = 64  # samples in a row of a frame
MAX_ROWS = 32  # rows of a frame
FPS = 25
BINS = 16
WORD_BITS = 9
SPAN = 8  # frames on either side that set the threshold of a shot
BATCH_BYTES = 2 << 20
KNOWN_HEADS = 1000

#: Code length of each category of difference (0 to 8 extra bits): nine bits with the extra bits.
CODE_LENGTHS = {s: (9 if s == 0 else 9 - s) for s in range(9)}


def _codes(lengths: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Canonical Huffman codes: {category: (code, length)}."""
    code, last, out = 0, 0, {}
    for s, n in sorted(lengths.items(), key=lambda x: (x[1], -x[0])):
        code <<= n - last
        out[s] = (code, n)
        code, last = code + 1, n
    return out


def _tables(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Nine-bit word of each difference (index: difference + 255), and the difference of each word."""
    word, back = np.zeros(511, np.uint16), np.zeros(1 << WORD_BITS, np.int16)
    codes = _codes(lengths)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        extra = d if d >= 0 else d + (1 << s) - 1
        code, n = codes[s]
        w = (code << s) | extra
        word[d + 255], back[w] = w, d
    return word, back


WORD_OF, DIFFERENCE_OF = _tables(CODE_LENGTHS)


def _dht() -> bytes:
    order = [s for s, _ in sorted(CODE_LENGTHS.items(), key=lambda x: (x[1], -x[0]))]
    counts = bytes(sum(n == k for n in CODE_LENGTHS.values()) for k in range(1, 17))
    body = b"\x00" + counts + bytes(order)
    return b"\xff\xc4" + struct.pack(">H", len(body) + 2) + body


DHT = _dht()


def _jpeg_head(rows: int) -> bytes:
    sof = b"\xff\xc3" + struct.pack(">HBHHBBBB", 11, 8, rows, ROW, 1, 1, 0x11, 0)
    return b"\xff\xd8" + DHT + sof + b"\xff\xda" + struct.pack(">HBBBBBB", 8, 1, 1, 0, 1, 0, 0)


def pack_words(words: np.ndarray) -> np.ndarray:
    """(n, 64) nine-bit words as (n, 72) bytes."""
    w = words.reshape(-1, 8).astype(np.uint16)
    out = np.empty((len(w), 9), np.uint8)
    for j in range(9):
        low = (w[:, j - 1] & ((1 << j) - 1)) << (8 - j) if j else 0
        out[:, j] = (low | (w[:, j] >> (j + 1) if j < 8 else 0)) & 0xFF
    return out.reshape(len(words), -1)


def unpack_words(data: np.ndarray) -> np.ndarray:
    b = data.reshape(-1, 9).astype(np.uint16)
    out = np.empty((len(b), 8), np.uint16)
    for j in range(8):
        out[:, j] = ((b[:, j] << (j + 1)) | (b[:, j + 1] >> (7 - j))) & 0x1FF
    return out.reshape(-1, ROW)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return kind + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def _avi(frames: list[bytes], rows: int, payload: int) -> bytes:
    largest = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FPS, largest * FPS, 0, 0x10, len(frames), 0, 1, largest, ROW, rows, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIIIhhhh", b"vids", b"MJPG", 0, 0, 0, 0, 1, FPS, 0, len(frames), largest, 10_000, 0, 0, 0, ROW, rows)
    strf = struct.pack("<IiiHH4sIiiII", 40, ROW, rows, 1, 8, b"MJPG", ROW * rows, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    info = _chunk(b"LIST", b"INFO" + _chunk(b"ICMT", b"payload=%d\0" % payload))
    parts, index, at = [b"movi"], [], 4
    for f in frames:
        c = _chunk(b"00dc", f)
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        parts.append(c)
        at += len(c)
    return _chunk(b"RIFF", b"AVI " + hdrl + info + _chunk(b"LIST", b"".join(parts)) + _chunk(b"idx1", b"".join(index)))


def payload_of(text: bytes) -> bytes:
    """The text with zero bytes up to a positive multiple of 64."""
    return text + b"\0" * (max(ROW, -(-len(text) // ROW) * ROW) - len(text))


def encode_avis(payloads: list[bytes]) -> list[bytes]:
    """An AVI file for each payload. All rows of all payloads are coded at once; the last frame of a file is filled
    with zero rows, and the file's comment tells where the payload ends."""
    shapes, pieces = [], []
    for p in payloads:
        n = len(p) // ROW
        rows = min(n, MAX_ROWS)
        frames = -(-n // rows)
        shapes.append((rows, frames))
        pieces += [p, b"\0" * ((rows * frames - n) * ROW)]
    data = np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, ROW).astype(np.int16)
    left = np.empty_like(data)
    left[:, 1:] = data[:, :-1]
    left[1:, 0] = data[:-1, 0]
    begins = np.concatenate([[0], np.cumsum([r * f for r, f in shapes])])
    tops = np.concatenate([np.arange(f, dtype=np.int64) * r + at for (r, f), at in zip(shapes, begins, strict=False)])
    left[tops, 0] = 128
    coded = pack_words(WORD_OF[data - left + 255])
    raw, stride, at, out = coded.tobytes(), coded.shape[1], 0, []
    for (rows, count), p in zip(shapes, payloads, strict=True):
        head, frames = _jpeg_head(rows), []
        for _ in range(count):
            frames.append(head + raw[at : at + rows * stride].replace(b"\xff", b"\xff\0") + b"\xff\xd9")
            at += rows * stride
        out.append(_avi(frames, rows, len(p)))
    return out


class DamagedFile(ValueError):
    """A file that can't be read whole."""


def _chunks_of(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        kind, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if at + 8 + size > end:
            raise DamagedFile("cut off")
        yield kind, at + 8, size
        at += 8 + size + size % 2


def _frame_at(data: bytes, at: int, size: int) -> bool:
    return data[at - 8 : at - 6].isdigit() and data[at - 6 : at - 4] in (b"dc", b"db") and at + size <= len(data)


def parse_avi(data: bytes) -> tuple[list[tuple[int, int]], int | None]:
    """Where the frames lie, and the payload's length by the comment (None without one).

    Frames are found by the index, whose places count from the list of frames or from the file's start; without an
    index, by the list itself.
    """
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise DamagedFile("not an AVI file")
    movi = payload = index = None
    for kind, at, size in _chunks_of(data, 12, len(data)):
        if kind == b"LIST" and data[at : at + 4] == b"movi":
            movi = (at, size)
        elif kind == b"LIST" and data[at : at + 4] == b"INFO":
            said = [data[a : a + s] for k, a, s in _chunks_of(data, at + 4, at + size) if k == b"ICMT"]
            found = re.fullmatch(rb"payload=(\d+)\0*", said[0]) if said else None
            payload = int(found[1]) if found else None
        elif kind == b"idx1":
            index = [(o, n) for c, _, o, n in struct.iter_unpack("<4sIII", data[at : at + size - size % 16]) if c[2:] in (b"dc", b"db")]
    if movi is None:
        raise DamagedFile("no frames")
    if index is None:
        frames = [(at, size) for kind, at, size in _chunks_of(data, movi[0] + 4, movi[0] + movi[1]) if kind[2:] in (b"dc", b"db")]
    else:
        start = next((s for s in (movi[0], 0) if all(_frame_at(data, s + o + 8, n) for o, n in index)), None)
        if start is None:
            raise DamagedFile("the index names no frames")
        frames = [(start + o + 8, n) for o, n in index]
    if not frames:
        raise DamagedFile("no frames")
    return frames, payload


_known_heads: dict[bytes, int] = {}


def parse_jpeg(data: bytes, at: int, size: int) -> tuple[int, int]:
    """Rows of the frame, and where its coded bytes begin. Every frame's own table is looked at: only the one whose codes
    and extra bits make nine bits is read."""
    scan = data.find(b"\xff\xda", at, at + size)
    if scan < 0 or data[at : at + 2] != b"\xff\xd8" or data[at + size - 2 : at + size] != b"\xff\xd9":
        raise DamagedFile("a frame is no JPEG image")
    head = data[at:scan]
    begin = scan + 2 + struct.unpack_from(">H", data, scan + 2)[0]
    if head not in _known_heads:
        pos, rows, lengths = 2, 0, None
        while pos + 4 <= len(head):
            marker, n = head[pos + 1], struct.unpack_from(">H", head, pos + 2)[0]
            body = head[pos + 4 : pos + 2 + n]
            if marker == 0xC4:
                symbols = list(body[17:])
                lengths = dict(zip(symbols, (k + 1 for k, c in enumerate(body[1:17]) for _ in range(c)), strict=True))
            elif 0xC0 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
                depth, rows, width = struct.unpack_from(">BHH", body)
                if marker != 0xC3 or depth != 8 or width != ROW:
                    raise DamagedFile("a frame is not lossless, of 8 bits and 64 samples wide")
            pos += 2 + n
        if not rows or lengths != CODE_LENGTHS:
            raise DamagedFile("a frame has no size or not the table of nine bits")
        if len(_known_heads) >= KNOWN_HEADS:
            _known_heads.clear()
        _known_heads[head] = rows
    return _known_heads[head], begin


class _Parsed:
    """A file's payload length, and for each frame its rows and its coded bytes."""

    def __init__(self, data: bytes):
        places, payload = parse_avi(data)
        self.rows, self.coded = [], []
        for at, size in places:
            rows, begin = parse_jpeg(data, at, size)
            coded = data[begin : at + size - 2].replace(b"\xff\0", b"\xff")
            if len(coded) != rows * ROW * WORD_BITS // 8:
                raise DamagedFile("a frame's samples are cut off")
            self.rows.append(rows)
            self.coded.append(coded)
        self.payload = ROW * sum(self.rows) if payload is None else payload
        if self.payload > ROW * sum(self.rows):
            raise DamagedFile("the payload is cut off")


def read_avis(files: list[bytes]) -> list[tuple[bytes, np.ndarray] | str]:
    """For each file what ``decode_avis`` gives, or why it can't be read."""
    parsed: list[_Parsed | str] = []
    for data in files:
        try:
            parsed.append(_Parsed(data))
        except (ValueError, struct.error, IndexError) as wrong:  # what a damaged file can lead to; DamagedFile is one
            parsed.append(str(wrong) or type(wrong).__name__)
    good = [p for p in parsed if isinstance(p, _Parsed)]
    read = iter(_decoded(good) if good else [])
    return [next(read) if isinstance(p, _Parsed) else p for p in parsed]


def decode_avis(files: list[bytes]) -> list[tuple[bytes, np.ndarray]]:
    """For each file its payload, and its frames' histograms (frames x BINS, parts of the frame's samples; rows after
    the payload's end don't count)."""
    return _decoded([_Parsed(data) for data in files])


def _decoded(files: list[_Parsed]) -> list[tuple[bytes, np.ndarray]]:
    rows_of = np.array([r for f in files for r in f.rows], np.int64)
    words = unpack_words(np.frombuffer(b"".join(c for f in files for c in f.coded), np.uint8))
    frame = np.repeat(np.arange(len(rows_of)), rows_of)
    d = DIFFERENCE_OF[words].astype(np.int32)
    tops = np.concatenate([[0], np.cumsum(rows_of)])
    column = np.cumsum(d[:, 0])
    before = np.concatenate([[0], column])[tops[:-1]]
    d[:, 0] = column - before[frame] + 128
    samples = (np.cumsum(d, axis=1) & 0xFF).astype(np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(f.rows) for f in files])])
    row_ends = tops[ends]
    live = np.ones(len(samples), bool)
    for i, f in enumerate(files):
        live[row_ends[i] + f.payload // ROW : row_ends[i + 1]] = False
    bins = (frame[live, None] * BINS + (samples[live] >> 4)).ravel()
    counts = np.bincount(bins, minlength=len(rows_of) * BINS).reshape(-1, BINS).astype(float)
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return [(samples[row_ends[i] : row_ends[i + 1]].tobytes()[: f.payload], shares[ends[i] : ends[i + 1]]) for i, f in enumerate(files)]


def shots(histograms: np.ndarray) -> list[tuple[int, int]]:
    """Clips as (first frame, frame after the last). A cut lies before a frame whose histogram differs from the one
    before it by more than the mean and one and a half deviations of the differences within SPAN frames, and by 0.02."""
    n = len(histograms)
    if n < 3:
        return [(0, n)]
    diff = np.abs(np.diff(histograms, axis=0)).sum(axis=1) / 2
    sums, squares = (np.concatenate([[0], np.cumsum(x)]) for x in (diff, diff * diff))
    k = np.arange(len(diff))
    lo, hi = np.maximum(k - SPAN, 0), np.minimum(k + SPAN + 1, len(diff))
    mean = (sums[hi] - sums[lo]) / (hi - lo)
    spread = np.sqrt(np.maximum((squares[hi] - squares[lo]) / (hi - lo) - mean * mean, 0))
    cuts = (np.flatnonzero((diff > mean + 1.5 * spread) & (diff > 0.02)) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, n], strict=True))


def _in_parts(values: list[bytes], work) -> list:
    out, part, size = [], [], 0
    for v in values:
        part.append(v)
        size += len(v)
        if size >= BATCH_BYTES:
            out += work(part)
            part, size = [], 0
    return out + (work(part) if part else [])


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: id, n_bytes, media (the AVI file). Null texts count as empty: one row of zero bytes."""
    kind = docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # An Arrow batch may hold much text; files go on in parts.
            texts = b.column(1)
            at = 0
            while at < len(texts):
                part, size, start = [], 0, at
                while at < len(texts) and (not part or size < 4 * BATCH_BYTES):
                    part.append(texts[at].as_py())
                    size += len(part[-1])
                    at += 1
                media = _in_parts([payload_of(t) for t in part], encode_avis)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, len(part)), pa.array([len(t) for t in part], pa.int64()), pa.array(media, pa.binary())],
                    ["id", "n_bytes", "media"]
                )

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(thrifty(run), f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


CLIP = "array<struct<clip:int,start_s:double,end_s:double,frames:int,mean_luma:double>>"


def decode_media(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """A row per file: id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, clips, error.

    ``clips`` are the shots: number, start and end in seconds, frames, mean of the histogram's bin middles. Null
    media give null values. So do files that are damaged or of another kind (only AVI files of lossless JPEG frames,
    64 samples of 8 bits wide with nine-bit tables, are read), but for media_bytes and media_sha256, and ``error`` says
    why. A file without the comment that tells the payload's length has all its samples as payload.
    """
    kind = media.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middles = (np.arange(BINS) + 0.5) * 256 / BINS
        for b in batches:
            files = b.column(2).to_pylist()
            got = iter(_in_parts([f for f in files if f is not None], read_avis))
            cols: list[list] = [[] for _ in range(7)]
            for f in files:
                read = None if f is None else next(got)
                if f is None or isinstance(read, str):
                    stored = (None, None) if f is None else (len(f), hashlib.sha256(f).hexdigest())
                    for c, v in zip(cols, (None, None, None, *stored, None, read), strict=True):
                        c.append(v)
                    continue
                payload, hist = read
                clips = [
                    {"clip": i, "start_s": s / FPS, "end_s": e / FPS, "frames": e - s, "mean_luma": float(hist[s:e].mean(axis=0) @ middles)}
                    for i, (s, e) in enumerate(shots(hist))
                ]
                row = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ROW:]), len(f), hashlib.sha256(f).hexdigest(), clips, None)
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), clip_type, pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names)

    names = ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "clips", "error"]
    clip_type = pa.list_(pa.struct([("clip", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("frames", pa.int32()), ("mean_luma", pa.float64())]))
    rows = media.select(F.col(id_col).alias("id"), "n_bytes", F.col(media_col))
    schema = f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, clips {CLIP}, error string"
    return rows.mapInArrow(thrifty(run), schema).withColumnRenamed("id", id_col)


def clip_rows(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row per clip: id, clip, start_s, end_s, frames, mean_luma."""
    return decoded.select(id_col, F.explode("clips").alias("c")).select(id_col, "c.*")


def feature_of(clips: str = "clips"):
    """The clips as one string: how many, and each one's start, end and mean."""
    each = F.transform(clips, lambda c: F.format_string("%.2f-%.2f:%.2f", c["start_s"], c["end_s"], c["mean_luma"]))
    return F.concat(F.lit("shots="), F.size(clips).cast("string"), F.lit(" "), F.array_join(each, ","))
