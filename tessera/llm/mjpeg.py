"""AVI motion-JPEG columns: RIFF index, intra frames, shots as timed clip rows.

Frames are single-component lossless JPEG (ITU-T T.81, process 14, SOF3, 8 bits):
each sample is predicted from its left neighbour (the first of a line from the
one above, the first of a frame from 128) and the difference is coded as a
Huffman-coded category and extra bits.  The writer's Huffman table gives category
k a code of 9 - k bits, so every sample takes 9 bits and whole frames are packed
and unpacked as arrays; the reader takes any table and sampling, with a
bit-by-bit path for tables that lack that property.

The reader walks the RIFF chunks, takes frames by the ``idx1`` entries (or by
walking ``movi`` where there is no index), and cuts shots where the histogram
difference of neighbouring frames exceeds ``mean + SIGMA * deviation`` of the
other differences in a sliding window, or ``SURE``, and ``FLOOR`` at least.

Frames are packed, written, read and unpacked ``BLOCK`` at a time, so besides a text and its file only some
megabytes are held.

Defined results: a null or empty text is one frame of blanks; equal texts give
equal files; a broken file gives a row with its ``error`` (``Avi`` and ``decode_frames`` raise ``ValueError``); a null
file gives nulls; new columns replace others of their names, all other columns pass through.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.textkit import load, map_texts

WIDTH, HEIGHT, FPS = 16, 12, 25
UNIT = WIDTH * HEIGHT
WINDOW, SIGMA, FLOOR = 8, 2.0, 0.5
#: Frames worked on at once.
BLOCK = 2048
#: A difference above this always cuts, however many cuts lie around it; frames without a bin in common differ by 2.
SURE = 1.5
_SOI, _EOI, _SOF3, _DHT, _SOS = 0xD8, 0xD9, 0xC3, 0xC4, 0xDA
#: Codes of lengths 1 to 9 for the categories 8 down to 0.
_LENGTHS, _VALUES = bytes([1] * 9 + [0] * 7), bytes(range(8, -1, -1))


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _frame_head(width: int, height: int) -> bytes:
    return (
        bytes([0xFF, _SOI])
        + _segment(_SOF3, struct.pack(">BHHB3B", 8, height, width, 1, 1, 0x11, 0))
        + _segment(_DHT, b"\x00" + _LENGTHS + _VALUES)
        + _segment(_SOS, bytes([1, 1, 0, 1, 0, 0]))
    )


def _fixed_codes() -> np.ndarray:
    """The 9 bits of each difference from -255 to 255, at index difference + 255."""
    out = np.zeros((511, 9), np.uint8)
    for d in range(-255, 256):
        k = abs(d).bit_length()
        prefix = "1" * (8 - k) + "0"
        extra = d if d > 0 else d + (1 << k) - 1
        bits = prefix + (format(extra, f"0{k}b") if k else "")
        out[d + 255] = [int(b) for b in bits]
    return out


_CODES = _fixed_codes()
_DIFF_OF = np.zeros(512, np.int16)
_DIFF_OF[np.packbits(np.pad(_CODES, ((0, 0), (7, 0))), axis=1).astype(np.int32) @ np.array([256, 1])] = np.arange(-255, 256)


def encode_frames(frames: np.ndarray) -> list[bytes]:
    """Lossless JPEG files of (n, height, width) 8-bit frames."""
    n, height, width = frames.shape
    x = frames.astype(np.int16)
    predicted = np.empty_like(x)
    predicted[:, :, 1:] = x[:, :, :-1]
    predicted[:, 1:, 0] = x[:, :-1, 0]
    predicted[:, 0, 0] = 128
    bits = _CODES[(x - predicted + 255).reshape(n, -1)].reshape(n, -1)
    spare = -bits.shape[1] % 8
    if spare:  # a last byte is filled up with ones
        bits = np.concatenate([bits, np.ones((n, spare), np.uint8)], axis=1)
    packed = np.packbits(bits, axis=1)
    head, tail = _frame_head(width, height), bytes([0xFF, _EOI])
    return [head + row.tobytes().replace(b"\xff", b"\xff\x00") + tail for row in packed]


class _Head:
    """What the markers before a scan say; parsed once for each different head."""

    def __init__(self, data: bytes):
        if data[:2] != bytes([0xFF, _SOI]):
            raise ValueError("not a JPEG frame")
        at, self.tables, self.width = 2, {}, 0
        while True:
            if data[at] != 0xFF:
                raise ValueError("marker expected")
            marker, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
            body = data[at + 4 : at + 2 + size]
            if marker == _SOF3:
                bits, self.height, self.width, parts = struct.unpack(">BHHB", body[:6])
                if bits != 8 or parts != 1:
                    raise ValueError("only 8-bit frames of one component")
            elif 0xC0 <= marker <= 0xCF and marker != _DHT:
                raise ValueError("not a lossless JPEG frame")
            elif marker == _DHT:
                while body:
                    counts, values = body[1:17], body[17 : 17 + sum(body[1:17])]
                    self.tables[body[0]] = (counts, values)
                    body = body[17 + len(values) :]
            elif marker == _SOS:
                if body[3] != 1 or not self.width:
                    raise ValueError("only predictor 1")
                self.table = self.tables[body[2] >> 4]
                self.size = at + 2 + size
                return
            at += 2 + size

    @property
    def fixed(self) -> bool:
        return self.table == (_LENGTHS, _VALUES)

    def slow(self, packed: bytes) -> np.ndarray:
        """Differences of a scan under any Huffman table."""
        codes, code, k = {}, 0, 0
        for length, count in enumerate(self.table[0], 1):
            for _ in range(count):
                codes[length, code] = self.table[1][k]
                code, k = code + 1, k + 1
            code <<= 1
        bits = iter(np.unpackbits(np.frombuffer(packed, np.uint8)).tolist())
        out = []
        for _ in range(self.width * self.height):
            value = length = 0
            while (length, value) not in codes:
                value, length = value * 2 + next(bits), length + 1
                if length > 16:
                    raise ValueError("broken scan")
            k = codes[length, value]
            extra = 0
            for _ in range(k):
                extra = extra * 2 + next(bits)
            out.append(extra if not k or extra >> (k - 1) else extra - (1 << k) + 1)
        return np.array(out, np.int16)


def decode_frames(files: list[bytes]) -> np.ndarray:
    """(n, height, width) samples of lossless JPEG files of one size."""
    heads: dict[bytes, _Head] = {}
    last: tuple[bytes, _Head] | None = None
    rows: list[tuple[_Head, bytes]] = []
    for f in files:
        if last is None or not f.startswith(last[0]):
            head = _Head(f)
            last = (f[: head.size], heads.setdefault(f[: head.size], head))
        if f[-2:] != bytes([0xFF, _EOI]):
            raise ValueError("frame has no end")
        rows.append((last[1], f[len(last[0]) : -2].replace(b"\xff\x00", b"\xff")))
    if not rows:
        return np.zeros((0, 0, 0), np.uint8)
    head = rows[0][0]
    n, w, h = len(rows), head.width, head.height
    if any(x.width != w or x.height != h for x, _ in rows):
        raise ValueError("frames differ in size")
    if all(x.fixed for x, _ in rows):
        size = (w * h * 9 + 7) // 8
        if any(len(b) != size for _, b in rows):
            raise ValueError("broken scan")
        bits = np.unpackbits(np.frombuffer(b"".join(b for _, b in rows), np.uint8).reshape(n, -1), axis=1)[:, : w * h * 9]
        nine = bits.reshape(n, -1, 9)
        codes = nine[:, :, 0].astype(np.int32)
        for i in range(1, 9):
            codes = codes * 2 + nine[:, :, i]
        diff = _DIFF_OF[codes].reshape(n, h, w)
    else:
        diff = np.stack([x.slow(b) for x, b in rows]).reshape(n, h, w)
    diff = diff.astype(np.int32)
    diff[:, 0, 0] += 128
    diff[:, :, 0] = np.cumsum(diff[:, :, 0], axis=1)
    return np.cumsum(diff, axis=2).astype(np.uint8)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def write_avi(frames: np.ndarray, fps: int = FPS) -> bytes:
    """An AVI file with one motion-JPEG video stream and an index."""
    n, height, width = frames.shape
    movi, index, at, largest = bytearray(b"movi"), bytearray(), 4, 0
    for k in range(0, n, BLOCK):
        for f in encode_frames(frames[k : k + BLOCK]):
            movi += _chunk(b"00dc", f)
            index += struct.pack("<4sIII", b"00dc", 0x10, at, len(f))
            at, largest = len(movi), max(largest, len(f))
    avih = struct.pack("<14I", 1_000_000 // fps, 0, 0, 0x10, n, 0, 1, largest, width, height, 0, 0, 0, 0)
    strh = b"vids" + b"MJPG" + struct.pack("<IHHIIIIIIiI4h", 0, 0, 0, 0, 1, fps, 0, n, largest, -1, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", width * height * 3, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    size = 4 + len(hdrl) + 8 + len(movi) + 8 + len(index)
    return b"".join([b"RIFF", struct.pack("<I", size), b"AVI ", hdrl, b"LIST", struct.pack("<I", len(movi)), movi, b"idx1", struct.pack("<I", len(index)), index])


class Avi:
    """Frame rate of an AVI and where its frames are (offset, length), found by its index."""

    def __init__(self, data: bytes):
        self.data, self.fps = data, float(FPS)
        try:
            self.places = self._parse(data)
        except struct.error as e:
            raise ValueError("not an AVI file") from e

    def _parse(self, data: bytes) -> list[tuple[int, int]]:
        if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
            raise ValueError("not an AVI file")
        movi, index = None, None
        for name, at, size in self._walk(data, 12, min(len(data), 8 + struct.unpack("<I", data[4:8])[0])):
            if name == b"LIST" and data[at : at + 4] == b"hdrl":
                for sub, a, _ in self._walk(data, at + 4, at + size):
                    if sub == b"avih":
                        self.fps = 1_000_000 / max(1, struct.unpack("<I", data[a : a + 4])[0])
            elif name == b"LIST" and data[at : at + 4] == b"movi":
                movi = (at, size)
            elif name == b"idx1":
                index = (at, size)
        if movi is None:
            raise ValueError("no movie data")
        if not index:
            return [(a, s) for name, a, s in self._walk(data, movi[0] + 4, movi[0] + movi[1]) if name[2:] == b"dc"]
        base, places = movi[0], []
        for name, _, offset, size in struct.iter_unpack("<4sIII", data[index[0] : index[0] + index[1] // 16 * 16]):
            if name[2:] != b"dc":
                continue
            if data[base + offset : base + offset + 4] != name:
                base = 0  # some writers count from the start of the file
                if data[offset : offset + 4] != name:
                    raise ValueError("index points elsewhere")
            places.append((base + offset + 8, size))
        return places

    @property
    def frames(self) -> list[bytes]:
        return [self.data[a : a + n] for a, n in self.places]

    def blocks(self, size: int = BLOCK) -> Iterator[np.ndarray]:
        """Decoded frames, some at a time; all have the size of the first."""
        shape = None
        for k in range(0, len(self.places), size):
            part = decode_frames([self.data[a : a + n] for a, n in self.places[k : k + size]])
            if shape not in (None, part.shape[1:]):
                raise ValueError("frames differ in size")
            shape = part.shape[1:]
            yield part

    @staticmethod
    def _walk(data: bytes, at: int, end: int):
        while at + 8 <= end:
            size = struct.unpack("<I", data[at + 4 : at + 8])[0]
            if at + 8 + size > end:
                raise ValueError("chunk is cut short")
            yield data[at : at + 4], at + 8, size
            at += 8 + size + size % 2


def histograms(frames: np.ndarray) -> np.ndarray:
    """How many samples of each frame lie in each of 16 bins."""
    n = len(frames)
    bins = (frames.reshape(n, -1) >> 4).astype(np.int64) + 16 * np.arange(n)[:, None]
    return np.bincount(bins.ravel(), minlength=16 * n).reshape(n, 16)


def shots(frames: np.ndarray, window: int = WINDOW, sigma: float = SIGMA, floor: float = FLOOR, sure: float = SURE) -> list[int]:
    """First frames of the shots of decoded frames."""
    return cut_shots(histograms(frames), window, sigma, floor, sure)


def cut_shots(hist: np.ndarray, window: int = WINDOW, sigma: float = SIGMA, floor: float = FLOOR, sure: float = SURE) -> list[int]:
    """First frames of the shots, by adaptive differences of the frames' histograms, each held against its number of samples.

    A difference is judged by those around it, without itself; one that stands alone by ``floor``.
    """
    n = len(hist)
    if n < 2:
        return [0] if n else []
    diff = np.abs(np.diff(hist / np.maximum(hist.sum(axis=1, keepdims=True), 1), axis=0)).sum(axis=1)
    one, two = (np.concatenate([[0.0], np.cumsum(x)]) for x in (diff, diff * diff))
    k = np.arange(len(diff))
    lo, hi = np.maximum(k - window, 0), np.minimum(k + window + 1, len(diff))
    others = np.maximum(hi - lo - 1, 1)
    m = (one[hi] - one[lo] - diff) / others
    dev = np.sqrt(np.maximum((two[hi] - two[lo] - diff * diff) / others - m * m, 0))
    return [0, *(np.flatnonzero((diff > np.minimum(m + sigma * dev + 1e-9, sure)) & (diff >= floor)) + 1).tolist()]


def inspect(media: bytes) -> dict:
    """Payload and file digests and the clips of an AVI; blanks that fill up the last frame are no part of its histogram."""
    avi = Avi(media)
    digest, hists, size, tail, blanks = hashlib.sha256(), [], 0, b"", 0
    for frames in avi.blocks():
        data = frames.tobytes()
        digest.update(data)
        hists.append(histograms(frames))
        size, tail = size + len(data), (tail + data)[-max(16, frames[0].size) :]
    hist = np.concatenate([np.zeros((0, 16), np.int64), *hists])
    if len(hist) and (blanks := len(tail) - len(tail.rstrip(b" "))) < hist[-1].sum():
        hist[-1, ord(" ") >> 4] -= blanks
    starts = cut_shots(hist)
    ends = [*starts[1:], len(hist)]
    clips = [{"clip": i, "start_frame": s, "frames": e - s, "start_s": s / avi.fps, "end_s": e / avi.fps} for i, (s, e) in enumerate(zip(starts, ends, strict=False))]
    return {"payload_bytes": size, "payload_sha256": digest.hexdigest(), "tail_crc32": zlib.crc32(tail[-16:]), "clips": clips}


def payload_of(text: str | None) -> tuple[int, bytes]:
    data = (text or "").encode()
    return len(data), data + b" " * (-len(data) % UNIT if data else UNIT)


CLIP = T.StructType([T.StructField("clip", T.IntegerType()), T.StructField("start_frame", T.LongType()), T.StructField("frames", T.LongType()), T.StructField("start_s", T.DoubleType()), T.StructField("end_s", T.DoubleType())])


def to_avi(docs: DataFrame, text: str = "text", out: str = "media") -> DataFrame:
    """Replace a text by an AVI file of its bytes, and its length in bytes."""

    def make() -> Callable:
        def run(texts: list[str | None]) -> tuple:
            sizes, files = [], []
            for t in texts:
                n, data = payload_of(t)
                sizes.append(n)
                files.append(write_avi(np.frombuffer(data, np.uint8).reshape(-1, HEIGHT, WIDTH)))
            return sizes, files

        return run

    return map_texts(docs, text, [("n_bytes", T.LongType()), (out, T.BinaryType())], make, rows=32, keep_text=False)


def read_avi(files: DataFrame, media: str = "media") -> DataFrame:
    """Decode a column of AVI files: payload digests, the clips, and what the file weighs, or what is wrong with it; the file itself goes."""
    new = [("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("clips", T.ArrayType(CLIP)), ("error", T.StringType())]

    def make() -> Callable:
        def row(b: bytes | None) -> dict:
            if b is None:
                return {}
            about = {"media_bytes": len(b), "media_sha256": hashlib.sha256(b).hexdigest()}
            try:
                return about | inspect(b)
            except (ValueError, IndexError, KeyError, StopIteration, RuntimeError, struct.error) as e:
                return about | {"error": f"{type(e).__name__}: {e}"}

        def run(blobs: list[bytes | None]) -> tuple:
            rows = [row(b) for b in blobs]
            return tuple([r.get(n) for r in rows] for n, _ in new)

        return run

    return map_texts(files, media, new, make, rows=32, keep_text=False)


def clip_rows(read: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per clip: ``key, clip, start_frame, frames, start_s, end_s``."""
    return read.select(key, F.inline("clips"))


def op6_avi_mjpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    read = read_avi(to_avi(docs))
    starts = F.array_join(F.transform("clips", lambda c: c["start_frame"].cast("string")), ",")
    total = F.aggregate("clips", F.lit(0).cast("long"), lambda a, c: a + c["frames"])
    feature = F.concat(F.lit("frames="), total.cast("string"), F.lit(";shots="), F.size("clips").cast("string"), F.lit(";starts="), starts)
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.coalesce(feature, F.concat(F.lit("error: "), "error")).alias("feature"))


QUERIES = {"op6_avi_mjpeg": op6_avi_mjpeg}
