"""Signature sniffing of binary columns.

An Aho-Corasick automaton finds every magic number in one pass over the bytes. Each
place is then put to the validator of its format, which follows the structure and
its lengths (chunks, headers, checksums) and says where the object ends. An object
at the start corrects the declared type; all are carved. Objects inside a found
object are its own and are not carved again.

Everything is local to a row. Formats that end with a mark look it up in places
collected once per row (``Marks``), and walks over boxes, blocks, segments and pages
remember where they came to, so that magic numbers within each other's reach do not
multiply; the others stop at the first length that does not fit.

Defined results: null bytes are empty, without type and objects; bytes that hold no
object have no detected type and are not corrected; equal rows get equal results; an
empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm.common import slices, texts_of

UNIT = 192


def _u32(b: bytes, at: int, order: str = "<") -> int:
    return struct.unpack_from(order + "I", b, at)[0] if at + 4 <= len(b) else -1


def end_of_wav(b: bytes, at: int) -> int:
    """RIFF/WAVE: chunks fill the stated size, with a format before the data and blocks that divide it."""
    end = at + 8 + _u32(b, at + 4)
    if b[at + 8 : at + 12] != b"WAVE" or _u32(b, at + 4) < 4 or end > len(b):
        return -1
    k, block, data = at + 12, 0, False
    while k + 8 <= end:
        name, n = b[k : k + 4], _u32(b, k + 4)
        if k + 8 + n > end:
            return -1
        if name == b"fmt ":
            if n < 16:
                return -1
            kind, channels, rate, speed, block, bits = struct.unpack_from("<HHIIHH", b, k + 8)
            if not channels or not block or speed != rate * block or (kind == 1 and block != channels * (bits // 8)):
                return -1
        if name == b"data":
            if not block or n % block:
                return -1
            data = True
        k += 8 + n + n % 2
    return end if data and k in (end, end + 1) else -1


def end_of_png(b: bytes, at: int) -> int:
    """PNG: a header first, checksums of all chunks right, an end chunk."""
    k, first, data = at + 8, True, False
    while k + 12 <= len(b):
        n, name = _u32(b, k, ">"), b[k + 4 : k + 8]
        if k + 12 + n > len(b) or not name.isalpha() or (first and (name != b"IHDR" or n != 13)):
            return -1
        if zlib.crc32(memoryview(b)[k + 4 : k + 8 + n]) != _u32(b, k + 8 + n, ">"):
            return -1
        first, data, k = False, data or name == b"IDAT", k + 12 + n
        if name == b"IEND":
            return k if data and n == 0 else -1
    return -1


def end_of_bmp(b: bytes, at: int) -> int:
    size, start, head = _u32(b, at + 2), _u32(b, at + 10), _u32(b, at + 14)
    if at + size > len(b) or head not in (12, 40, 52, 56, 108, 124) or not 14 + head <= start <= size or at + 30 > len(b) or head == 12:
        return -1
    wide, high, planes, bits = struct.unpack_from("<iiHH", b, at + 18)
    if planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or wide <= 0 or high == 0:
        return -1
    if _u32(b, at + 30) == 0 and start + (wide * bits + 31) // 32 * 4 * abs(high) > size:
        return -1
    return at + size


def walked(memo: dict, state: tuple, step: Callable[[tuple], tuple | int]) -> int:
    """The end that a walk from state comes to: step gives the next state, or the end. What was walked before, from whatever start, is not walked again."""
    path: list[tuple] = []
    while (out := memo.get(state)) is None:
        path.append(state)
        got = step(state)
        if isinstance(got, int):
            out = got
            break
        state = got
    memo.update(dict.fromkeys(path, out))
    return out


def end_of_gif(b: bytes, at: int, marks: Marks) -> int:
    """GIF: blocks by their lengths, an image among them, and the end mark."""
    if b[at + 3 : at + 6] not in (b"87a", b"89a") or at + 13 > len(b):
        return -1

    def table(flags: int) -> int:
        return 3 << ((flags & 7) + 1) if flags & 128 else 0

    def step(state: tuple) -> tuple | int:
        k, images, inside = state  # inside: at a length within a block
        if k >= len(b):
            return -1
        if inside:
            return (k + 1 + b[k], images, b[k] > 0)
        if b[k] == 0x3B:
            return k + 1 if images else -1
        if b[k] == 0x21:
            return (k + 2, images, True)
        if b[k] == 0x2C and k + 10 <= len(b):
            return (k + 11 + table(b[k + 9]), True, True)
        return -1

    return walked(marks.walks("gif"), (at + 13 + table(b[at + 10]), False, False), step)


def end_of_jpeg(b: bytes, at: int, marks: Marks) -> int:
    """JPEG: segments by their lengths, a frame and a scan, and the end marker after the scan's data."""

    def step(state: tuple) -> tuple | int:
        k, frame = state
        if k + 4 > len(b) or b[k] != 0xFF:
            return -1
        kind = b[k + 1]
        if kind == 0xFF:
            return (k + 1, frame)
        n = int.from_bytes(b[k + 2 : k + 4], "big")
        if n < 2 or kind in (0x00, 0x01) or 0xD0 <= kind <= 0xD9:
            return -1
        frame = frame or (0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC))
        k += 2 + n
        if kind != 0xDA:
            return (k, frame)
        k = marks.scan_end(k) if frame else -1
        if k < 0 or k + 1 >= len(b):
            return -1
        return k + 2 if b[k + 1] == 0xD9 else (k, frame)

    return walked(marks.walks("jpeg"), (at + 2, False), step)


def end_of_gzip(b: bytes, at: int, marks: Marks) -> int:
    """gzip: one member whose header has no reserved flag and that inflates with the right checksum and length, fed in pieces that grow up to a bound."""
    if at + 18 > len(b) or b[at + 3] & 0xE0:
        return -1
    k = at + 10
    if b[at + 3] & 4:
        k += 2 + int.from_bytes(b[k : k + 2], "little")
    for flag in (8, 16):  # a name and a comment, which end with a zero
        if b[at + 3] & flag:
            k = marks.zero(k) + 1
            if not k:
                return -1
    # the header is fed with what comes first, so that the library does not look for its end in vain
    inflate, piece = zlib.decompressobj(31), 128
    try:
        inflate.decompress(b[at:k], 1 << 20)
        while k < len(b) and not inflate.eof:
            fed = b[k : k + piece]
            k, piece = k + len(fed), min(2 * piece, 65536)
            while fed and not inflate.eof:
                inflate.decompress(fed, 1 << 20)
                fed = inflate.unconsumed_tail
        return k - len(inflate.unused_data) if inflate.eof else -1
    except zlib.error:
        return -1


class Marks:
    """Places of end marks in some bytes, each kind looked for once and only if it is asked for."""

    def __init__(self, data: bytes):
        self.data, self._zip, self._pdf, self._scan = data, None, None, None
        self._walks: dict[str, dict] = {}
        self._zeros: list[int] | None = None

    def walks(self, kind: str) -> dict:
        """What walks of a format have come to, by state."""
        return self._walks.setdefault(kind, {})

    def zero(self, k: int) -> int:
        """The first zero byte from k on; -1 if there is none."""
        if self._zeros is None:
            self._zeros = [m.start() for m in re.finditer(rb"\0", self.data)]
        at = bisect_left(self._zeros, k)
        return self._zeros[at] if at < len(self._zeros) else -1

    def scan_end(self, k: int) -> int:
        """The first marker from k on that ends the data of a JPEG scan; -1 if there is none."""
        if self._scan is None:
            self._scan = [m.start() for m in re.finditer(rb"\xff[^\x00\xd0-\xd7]", self.data, re.S)]
        at = bisect_left(self._scan, k)
        return self._scan[at] if at < len(self._scan) else -1

    def zip_ends(self) -> dict[int, int]:
        """Where an archive begins and where it ends, for each end record with its directory right before it."""
        if self._zip is None:
            b, self._zip = self.data, {}
            for m in re.finditer(rb"PK\x05\x06(?=.{18})", b, re.S):
                k = m.start()
                size, start, comment = _u32(b, k + 12), _u32(b, k + 16), int.from_bytes(b[k + 20 : k + 22], "little")
                if size >= 46 and k - size >= start and b[k - size : k - size + 4] == b"PK\x01\x02" and k + 22 + comment <= len(b):
                    self._zip.setdefault(k - size - start, k + 22 + comment)
        return self._zip

    def pdf(self) -> tuple[list[int], list[int], list[int]]:
        """Places of headers, of startxref and of end marks."""
        if self._pdf is None:
            self._pdf = tuple([m.start() for m in re.finditer(mark, self.data)] for mark in (rb"%PDF-\d\.", rb"startxref", rb"%%EOF"))
        return self._pdf


def end_of_zip(b: bytes, at: int, marks: Marks) -> int:
    """ZIP: the end record whose directory says that it begins here."""
    return marks.zip_ends().get(at, -1)


def end_of_pdf(b: bytes, at: int, marks: Marks) -> int:
    """PDF: the last end mark before the next header, as a saved change appends one, and a startxref before it."""
    heads, starts, ends = marks.pdf()
    k = bisect_left(heads, at)
    if k == len(heads) or heads[k] != at:
        return -1
    last = bisect_left(ends, heads[k + 1] if k + 1 < len(heads) else len(b)) - 1
    if last < 0 or ends[last] < at or bisect_left(starts, at) >= bisect_left(starts, ends[last]):
        return -1
    return ends[last] + 5


def end_of_webp(b: bytes, at: int) -> int:
    """RIFF/WEBP: chunks fill the stated size, the first of them an image's."""
    end, k = at + 8 + _u32(b, at + 4), at + 12
    if b[at + 8 : at + 12] != b"WEBP" or end > len(b) or b[k : k + 4] not in (b"VP8 ", b"VP8L", b"VP8X"):
        return -1
    while k + 8 <= end:
        k += 8 + _u32(b, k + 4) + _u32(b, k + 4) % 2
    return end if k == end else -1


def end_of_mp4(b: bytes, at: int, marks: Marks) -> int:
    """MP4: boxes by their sizes, a file type first and a movie or fragments among the others; it ends before what is no known box."""

    def step(state: tuple) -> tuple | int:
        k, movie = state
        name = b[k + 4 : k + 8]
        if k + 8 > len(b) or name not in _BOXES:
            return k if movie else -1
        n = _u32(b, k, ">")
        if n == 1 and k + 16 <= len(b):
            n = int.from_bytes(b[k + 8 : k + 16], "big")
        return -1 if n < 8 or k + n > len(b) else (k + n, movie or name in (b"moov", b"moof"))

    return walked(marks.walks("mp4"), (at, False), step)


_BOXES = {b"ftyp", b"moov", b"mdat", b"free", b"skip", b"wide", b"uuid", b"meta", b"moof", b"mfra", b"sidx", b"styp", b"emsg", b"pdin"}


#: Each byte with its bits from the other end.
_TURNED = bytes(int(f"{x:08b}"[::-1], 2) for x in range(256))


def ogg_checksum(page: bytes) -> int:
    """The checksum of a page with zeros in its place: zlib's polynomial, from the other end, without its first and last complement."""
    return int(f"{zlib.crc32(page.translate(_TURNED), 0xFFFFFFFF) ^ 0xFFFFFFFF:032b}"[::-1], 2)


def _ogg_page(b: bytes, k: int) -> tuple[int, int, int] | None:
    """(end, flags, serial) of a page with the right checksum."""
    if k + 27 > len(b) or b[k : k + 5] != b"OggS\0":
        return None
    n = b[k + 26]
    end = k + 27 + n + sum(b[k + 27 : k + 27 + n])
    if end > len(b) or ogg_checksum(b[k : k + 22] + b"\0\0\0\0" + b[k + 26 : end]) != _u32(b, k + 22):
        return None
    return end, b[k + 5], _u32(b, k + 14)


def end_of_ogg(b: bytes, at: int, marks: Marks) -> int:
    """Ogg: pages with right checksums, from one that begins a stream to one that ends the last of those begun since.

    Pages that follow each other are looked at once, for all their beginnings. A
    beginning holds until every stream begun from it on has ended, which is found from
    the back: what lies within a later beginning's reach is passed over in one step.
    """
    known = marks.walks("ogg")
    if at in known:
        return known[at]
    pages, k = [], at
    while (p := _ogg_page(b, k)) is not None:
        pages.append((k, *p))
        k = p[0]
    n = len(pages)
    if not n:
        return -1
    began: dict[int, list[int]] = {}
    since, until = [-1] * n, [-1] * n  # the last beginning of a page's stream; the end of the stream that a page begins
    for t, (_, _, flags, serial) in enumerate(pages):
        if flags & 2:
            began.setdefault(serial, []).append(t)
        since[t] = began[serial][-1] if serial in began else -1
        if flags & 4:
            for i in began.pop(serial, ()):
                until[i] = t
    reach, least = [-1] * n, list(range(n))
    for i in range(n - 1, -1, -1):
        far, j, low = until[i], i + 1, i
        while 0 <= far and j <= far:
            if pages[j][2] & 2:
                far, low, j = (max(far, reach[j]), min(low, least[j]), reach[j] + 1) if reach[j] >= 0 else (-1, low, j)
            else:
                low, j = min(low, since[j]), j + 1
        reach[i], least[i] = far, low
        known[pages[i][0]] = pages[far][1] if pages[i][2] & 2 and far >= 0 and low >= i else -1
    return known[at]


def end_of_webm(b: bytes, at: int) -> int:
    """WebM and Matroska: a header element, then one segment, both of stated size."""

    def number(k: int, marked: bool) -> tuple[int, int]:
        n = 9 - b[k].bit_length() if k < len(b) and b[k] else 9
        if n > 8 or k + n > len(b):
            return -1, k
        value = int.from_bytes(b[k : k + n], "big")
        return (value if marked else value & ((1 << 7 * n) - 1)), k + n

    k = at
    for want in (0x1A45DFA3, 0x18538067):
        name, k = number(k, True)
        size, after = number(k, False)
        if name != want or size < 0 or size == (1 << 7 * (after - k)) - 1 or after + size > len(b):
            return -1
        k = after + size
    return k


def end_of_tiff(b: bytes, at: int) -> int:
    """TIFF: directories and their values and strips by their places; it ends where the last of them does."""
    order = "<" if b[at : at + 2] == b"II" else ">"
    size = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
    end, k, seen = at + 8, at + _u32(b, at + 4, order), set()
    while k > at and k not in seen:
        seen.add(k)
        if k + 2 > len(b):
            return -1
        n = struct.unpack_from(order + "H", b, k)[0]
        if not n or k + 6 + 12 * n > len(b):
            return -1
        values = {}
        for e in range(k + 2, k + 2 + 12 * n, 12):
            tag, kind, count = struct.unpack_from(order + "HHI", b, e)
            if kind not in size:
                return -1
            total = size[kind] * count
            where = e + 8 if total <= 4 else at + _u32(b, e + 8, order)
            if where + total > len(b):
                return -1
            end = max(end, where + total)
            if tag in (273, 279, 324, 325) and kind in (3, 4):
                values[tag] = struct.unpack_from(f"{order}{count}{'H' if kind == 3 else 'I'}", b, where)
        starts, sizes = (values.get(273) or values.get(324) or ()), (values.get(279) or values.get(325) or ())
        if len(starts) != len(sizes) or any(at + s + c > len(b) for s, c in zip(starts, sizes)):
            return -1
        end = max([end, k + 6 + 12 * n, *(at + s + c for s, c in zip(starts, sizes))])
        following = _u32(b, k + 2 + 12 * n, order)
        k = at + following if following else at
    return end if seen else -1


#: Type, magic number, its place in the object, and validator of each format.
FORMATS: list[tuple[str, bytes, int, Callable[..., int]]] = [
    ("audio/wav", b"RIFF", 0, end_of_wav), ("image/webp", b"RIFF", 0, end_of_webp), ("image/png", b"\x89PNG\r\n\x1a\n", 0, end_of_png), ("image/bmp", b"BM", 0, end_of_bmp),
    ("image/gif", b"GIF8", 0, end_of_gif), ("image/jpeg", b"\xff\xd8\xff", 0, end_of_jpeg), ("application/gzip", b"\x1f\x8b\x08", 0, end_of_gzip),
    ("application/zip", b"PK\x03\x04", 0, end_of_zip), ("application/pdf", b"%PDF-", 0, end_of_pdf), ("video/mp4", b"ftyp", 4, end_of_mp4), ("audio/ogg", b"OggS\0", 0, end_of_ogg),
    ("video/webm", b"\x1a\x45\xdf\xa3", 0, end_of_webm), ("image/tiff", b"II*\0", 0, end_of_tiff), ("image/tiff", b"MM\0*", 0, end_of_tiff),
]
#: Validators that share what they found between the places of one row.
WITH_MARKS = {end_of_zip, end_of_pdf, end_of_gif, end_of_jpeg, end_of_mp4, end_of_ogg, end_of_gzip}
_automaton = None


def automaton():
    """The automaton of this process: each magic number with its length and the formats that have it."""
    global _automaton
    if _automaton is None:
        import ahocorasick

        _automaton = ahocorasick.Automaton()
        for magic in {f[1] for f in FORMATS}:
            _automaton.add_word(magic.decode("latin-1"), (len(magic), [f for f in FORMATS if f[1] == magic]))
        _automaton.make_automaton()
    return _automaton


def sniff(data: bytes) -> list[tuple[str, int, int]]:
    """(type, start, end) of the objects in data that hold up, outermost, by start."""
    out, free, marks = [], 0, Marks(data)
    for last, (n, formats) in automaton().iter(data.decode("latin-1")):
        for name, _, before, validate in formats:
            start = last - n + 1 - before
            if start < free:
                continue
            end = validate(data, start, marks) if validate in WITH_MARKS else validate(data, start)
            if end > start:
                out.append((name, start, end))
                free = end
    return out


def sniff_media(df: DataFrame, data: str = "data", declared: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """Per row: the id, declared, detected (type of the object at the start; null where none), corrected (it differs from
    declared), whole (the object fills the bytes) and objects: (type, start, end, sha256, data), carved."""
    item = T.StructType([T.StructField("type", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("sha256", T.StringType()), T.StructField("data", T.BinaryType())])
    fields = [
        T.StructField(id_col, df.schema[id_col].dataType), T.StructField("declared", T.StringType()), T.StructField("detected", T.StringType()),
        T.StructField("corrected", T.BooleanType()), T.StructField("whole", T.BooleanType()), T.StructField("objects", T.ArrayType(item)),
    ]
    kind = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("sha256", pa.string()), ("data", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            said = batch.column(2).to_pylist() if declared else [None] * batch.num_rows
            found = []
            for b in texts_of(batch.column(1)):
                found.append([{"type": t, "start": s, "end": e, "sha256": hashlib.sha256(b[s:e]).hexdigest(), "data": b[s:e], "_whole": s == 0 and e == len(b)} for t, s, e in sniff(b)])
            first = [o[0] if o and o[0]["start"] == 0 else None for o in found]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(said, pa.string()), pa.array([f and f["type"] for f in first], pa.string()),
                pa.array([bool(f) and f["type"] != s for f, s in zip(first, said)]), pa.array([bool(f) and f["_whole"] for f in first]),
                pa.array([[{k: v for k, v in x.items() if k != "_whole"} for x in o] for o in found], kind),
            ], names=[f.name for f in fields])

    return df.select(id_col, data, *([declared] if declared else [])).mapInArrow(run, T.StructType(fields))


def to_wav(samples: bytes, channels: int = 2, rate: int = 16000) -> bytes:
    """samples, unsigned 8-bit, as a WAVE file; lossless."""
    block = channels
    return b"RIFF" + struct.pack("<I", 36 + len(samples) + len(samples) % 2) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, channels, rate, rate * block, block, 8) + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * (len(samples) % 2)


def from_wav(data: bytes) -> bytes:
    k = 12
    while data[k : k + 4] != b"data":
        k += 8 + _u32(data, k + 4) + _u32(data, k + 4) % 2
    return data[k + 8 : k + 8 + _u32(data, k + 4)]


def to_png(samples: bytes) -> bytes:
    """samples as grey pixels, 192 a row."""
    rows = np.frombuffer(samples, np.uint8).reshape(-1, UNIT)
    lines = np.zeros((len(rows), UNIT + 1), np.uint8)  # a filter of none before each row
    lines[:, 1:] = rows
    part = lambda name, d: struct.pack(">I", len(d)) + name + d + struct.pack(">I", zlib.crc32(name + d))
    return FORMATS[2][1] + part(b"IHDR", struct.pack(">IIBBBBB", UNIT, len(rows), 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(lines.tobytes(), 1)) + part(b"IEND", b"")


def from_png(data: bytes) -> bytes:
    n = _u32(data, 33, ">")
    return np.frombuffer(zlib.decompress(data[41 : 41 + n]), np.uint8).reshape(-1, UNIT + 1)[:, 1:].tobytes()


_GREYS = b"".join(bytes([g, g, g, 0]) for g in range(256))


def to_bmp(samples: bytes) -> bytes:
    """samples as grey pixels, 192 a row, from the top down."""
    start = 54 + len(_GREYS)
    return b"BM" + struct.pack("<IHHIIiiHHIIiiII", start + len(samples), 0, 0, start, 40, UNIT, -(len(samples) // UNIT), 1, 8, 0, len(samples), 2835, 2835, 256, 0) + _GREYS + samples


def from_bmp(data: bytes) -> bytes:
    return data[_u32(data, 10) :]


#: How a stored text's bytes become an object and are read from it.
STORES = {"audio/wav": (to_wav, from_wav), "image/png": (to_png, from_png), "image/bmp": (to_bmp, from_bmp)}
#: Around an object that is not stored bare, so that it must be carved.
HEAD, TAIL = b"sluice blob ".ljust(64, b"-"), b"-" * 16
DECLARED = "audio/wav"


def store_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_media: bool = False) -> DataFrame:
    """Each text as 8-bit samples in a media object, found again by sniffing and read back.

    A text is UTF-8, filled with spaces to a positive multiple of 192 bytes: 8-bit
    samples of WAVE, or grey pixels of PNG or BMP, by the checksum of these bytes.
    Every second is stored inside other bytes. All are declared to be WAVE. What is
    read back comes from the first object that sniffing carves, by its detected type;
    if there is none, nothing is read back. Columns: the contract's, declared,
    detected (of the carved object), corrected, object_start, object_bytes, n_objects.
    """
    plain = [("n_bytes", T.LongType(), pa.int64()), ("payload_bytes", T.LongType(), pa.int64()), ("payload_sha256", T.StringType(), pa.string()), ("tail_crc32", T.LongType(), pa.int64()), ("media_bytes", T.LongType(), pa.int64()),
             ("media_sha256", T.StringType(), pa.string()), ("feature", T.StringType(), pa.string()), ("declared", T.StringType(), pa.string()), ("detected", T.StringType(), pa.string()), ("corrected", T.BooleanType(), pa.bool_()),
             ("object_start", T.LongType(), pa.int64()), ("object_bytes", T.LongType(), pa.int64()), ("n_objects", T.LongType(), pa.int64())] + [("media", T.BinaryType(), pa.binary())] * with_media
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), *[T.StructField(n, t) for n, t, _ in plain]])
    names = [f.name for f in schema]
    kinds = list(STORES)

    def stored(raw: bytes) -> bytes:
        payload = raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b" ")
        deal = zlib.crc32(payload)
        object_ = STORES[kinds[deal % len(kinds)]][0](payload)
        return HEAD + object_ + TAIL if deal // len(kinds) % 2 else object_

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for raw in texts_of(batch.column(1)):
                media = stored(raw)
                objects = [o for o in sniff(media) if o[0] in STORES]
                name, start, end = objects[0] if objects else (None, None, None)
                back = STORES[name][1](media[start:end]) if name else b""
                samples = np.frombuffer(back or b"\0", np.uint8)
                feature = f"{name};{start};{len(objects)};{len(back)};mean={samples.mean():.4f};max={samples.max()};steps={int(np.count_nonzero(samples[1:] != samples[:-1]))}"
                rows.append((len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature, DECLARED, name, name is not None and name != DECLARED, start, end and end - start, len(objects), media))
            columns = [pa.array(list(c), k) for c, (_, _, k) in zip(zip(*rows), plain)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return docs.select(doc_id, text).mapInArrow(run, schema)
