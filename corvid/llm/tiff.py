"""Media columns: TIFF.

read_pages() walks the image file directories of classic and big TIFF in either byte order,
decodes PackBits, LZW or deflate strips and tiles (and stored ones), undoes the horizontal and
the floating-point predictor, and gives one Page for each directory. Samples have 1, 2, 4, 8,
16, 32 or 64 bits; those of fewer than eight come back as a byte each. write() makes such files.
pages() is the operator: a media column in, one row for each page out.

A null or empty cell gives no page row but one row with page null and the error "empty"; a
cell that is not TIFF, or a broken page, gives a row with its error and null pixels, never a
failed job. A directory chain that comes back to an earlier directory ends there. A decoder
stops at the bytes its block has to give, so a forged block takes no more memory than its page,
and a page of over `most_bytes` pixel bytes is an error row (a parameter, MOST_BYTES unless
given). Rows that repeat an id, and null ids, are read like any other; ties don't occur. An
empty table gives an empty result. A cell of any length is one task's; further columns are not
read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch, id_text, slices

# Fixed values of the format: tags, field types and compression codes.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 273, 277, 278, 279
FILL_ORDER, PLANAR, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 266, 284, 317, 322, 323, 324, 325, 339
#: Tags that are counts, sizes, places or choices.
LAYOUT = (WIDTH, LENGTH, BITS, COMPRESSION, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, FILL_ORDER, PLANAR, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT)
TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
NONE, LZW, ADOBE_DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
NAMES = {NONE: "none", LZW: "lzw", ADOBE_DEFLATE: "deflate", OLD_DEFLATE: "deflate", PACKBITS: "packbits"}
#: Bytes of pixels of one page unless a call gives another bound; a forged size must not take all memory.
MOST_BYTES = 1 << 30


@dataclass
class Page:
    number: int
    width: int
    height: int
    samples: int
    bits: int
    compression: str
    predictor: int
    tiled: bool
    pixels: bytes  # rows of interleaved samples, in the machine's little-endian order


def packbits_decode(data: bytes, most: int | None = None) -> bytes:
    out, n, size = [], 0, 0
    while n < len(data) and (most is None or size < most):
        head = data[n]
        if head < 128:
            out.append(data[n + 1 : n + 2 + head])
            n += head + 2
            size += head + 1
        elif head > 128:
            out.append(data[n + 1 : n + 2] * (257 - head))
            n += 2
            size += 257 - head
        else:
            n += 1
    return b"".join(out)


def packbits_encode(row: bytes) -> bytes:
    """Runs of three and more as runs, the rest literally."""
    b = np.frombuffer(row, np.uint8)
    if not len(b):
        return b""
    starts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
    ends = np.concatenate([starts[1:], [len(b)]])
    out, at = [], 0

    def literal(end: int) -> None:
        for k in range(at, end, 128):
            part = row[k : min(end, k + 128)]
            out.append(bytes([len(part) - 1]) + part)

    for i in np.flatnonzero(ends - starts >= 3):
        literal(int(starts[i]))
        for k in range(int(starts[i]), int(ends[i]), 128):
            size = min(128, int(ends[i]) - k)
            out.append(bytes([257 - size if size > 1 else 0]) + row[k : k + 1])
        at = int(ends[i])
    literal(len(b))
    return b"".join(out)


#: LZW's two control codes, and the codes that one step of the decoder cuts out.
CLEAR, END, CODES = 256, 257, 4096


def _widths(turn: np.ndarray) -> np.ndarray:
    """Bits of the n-th code after a clear code: they widen one entry early."""
    size = turn + 258
    return 9 + (size > 511) + (size > 1023) + (size > 2047)


def lzw_decode(data: bytes, most: int | None = None) -> bytes:
    """TIFF's LZW, most significant bit first. Codes are cut out by thousands, up to the next clear code."""
    bits = np.concatenate([np.unpackbits(np.frombuffer(data, np.uint8)), np.zeros(12, np.uint8)])
    end = len(bits) - 12
    weights = 1 << np.arange(11, -1, -1)
    table = [bytes([n]) for n in range(256)] + [b"", b""]
    at, turn, last, out, size = 0, 0, b"", [], 0
    while most is None or size < most:
        width = _widths(np.arange(turn, turn + CODES))
        starts = at + np.cumsum(width) - width
        some = int(np.searchsorted(starts + width, end, side="right"))
        if not some:
            break
        codes = (bits[starts[:some, None] + np.arange(12)] @ weights) >> (12 - width[:some])
        stops = np.flatnonzero((codes == CLEAR) | (codes == END))
        stop = int(stops[0]) if len(stops) else some
        for code in codes[:stop].tolist():
            if not last:
                word = table[code]
            else:
                if code > len(table):
                    raise ValueError(f"LZW code {code} before its entry")
                word = table[code] if code < len(table) else last + last[:1]
                table.append(last + word[:1])
            out.append(word)
            size += len(word)
            last = word
            if most is not None and size >= most:
                break
        if stop == some:
            at, turn = int(starts[some - 1] + width[some - 1]), turn + some
        elif codes[stop] == END:
            break
        else:
            del table[258:]
            at, turn, last = int(starts[stop] + width[stop]), 0, b""
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    """Codes by a table of (code before, byte); a full table is cleared. The bits are laid out all at once."""
    codes, table, size = [CLEAR], {}, 258
    put, get = codes.append, table.get
    rest = iter(data)
    code = next(rest, None)
    for byte in rest:
        key = code << 8 | byte
        longer = get(key)
        if longer is not None:
            code = longer
            continue
        put(code)
        table[key] = size
        size += 1
        if size > 4093:
            put(CLEAR)
            table.clear()
            size = 258
        code = byte
    if code is not None:
        put(code)
    put(END)
    every = np.array(codes)
    clears = np.flatnonzero(every == CLEAR)
    begins = np.concatenate([[0], clears + 1])  # a clear code is the last of its run
    place = np.arange(len(every))
    width = _widths(place - begins[np.searchsorted(begins, place, side="right") - 1])
    laid = ((every[:, None] >> np.arange(11, -1, -1)) & 1).astype(np.uint8)
    return np.packbits(laid[np.arange(12) >= 12 - width[:, None]]).tobytes()


def inflate(data: bytes, most: int | None = None) -> bytes:
    """Deflated bytes, no more than `most`."""
    if most is None:
        return zlib.decompress(data)
    return zlib.decompressobj().decompress(data, max(1, most))


DECODERS = {NONE: lambda x, most=None: x, LZW: lzw_decode, ADOBE_DEFLATE: inflate, OLD_DEFLATE: inflate, PACKBITS: packbits_decode}
ENCODERS = {NONE: lambda x: x, LZW: lzw_encode, ADOBE_DEFLATE: lambda x: zlib.compress(x, 1), OLD_DEFLATE: lambda x: zlib.compress(x, 1)}


def _difference(block: np.ndarray, predictor: int) -> np.ndarray:
    """Rows x columns x samples with predictor 2 applied."""
    if predictor != 2:
        return block
    out = block.copy()
    out[:, 1:] -= block[:, :-1]
    return out


def write(pages: list[np.ndarray], compression: list[int], predictor: int = 2, rows_per_strip: int = 16, tile: int = 0) -> bytes:
    """A little-endian TIFF of uint8 pages (height x width x samples), in strips or, if tile, in square tiles."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for image, how in zip(pages, compression, strict=True):
        height, width, samples = image.shape
        blocks = []
        if tile:
            for y in range(0, height, tile):
                for x in range(0, width, tile):
                    part = image[y : y + tile, x : x + tile]
                    blocks.append(np.pad(part, ((0, tile - part.shape[0]), (0, tile - part.shape[1]), (0, 0))))
        else:
            blocks = [image[y : y + rows_per_strip] for y in range(0, height, rows_per_strip)]
        offsets, counts = [], []
        for b in blocks:
            b = _difference(b, predictor)
            raw = b"".join(packbits_encode(row.tobytes()) for row in b) if how == PACKBITS else ENCODERS[how](b.tobytes())
            offsets.append(len(out))
            counts.append(len(raw))
            out += raw + b"\0" * (len(raw) % 2)
        tags = {WIDTH: (4, [width]), LENGTH: (4, [height]), BITS: (3, [8] * samples), COMPRESSION: (3, [how]), PHOTOMETRIC: (3, [2 if samples == 3 else 1]), SAMPLES: (3, [samples]), PLANAR: (3, [1]), PREDICTOR: (3, [predictor])}
        tags |= {TILE_WIDTH: (4, [tile]), TILE_LENGTH: (4, [tile]), TILE_OFFSETS: (4, offsets), TILE_COUNTS: (4, counts)} if tile else {STRIP_OFFSETS: (4, offsets), ROWS_PER_STRIP: (4, [rows_per_strip]), STRIP_COUNTS: (4, counts)}
        entries = []
        for tag in sorted(tags):
            kind, values = tags[tag]
            raw = struct.pack(f"<{len(values)}{TYPES[kind]}", *values)
            if len(raw) > 4:
                entries.append(struct.pack("<HHII", tag, kind, len(values), len(out)))
                out += raw + b"\0" * (len(raw) % 2)
            else:
                entries.append(struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0"))
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def directories(data: bytes):
    """(byte order, tags) of each directory; stops at the end or where the chain comes back."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    kind = struct.unpack_from(order + "H", data, 2)[0] if order and len(data) >= 8 else 0
    if kind not in (42, 43):
        raise ValueError("not a TIFF")
    big = kind == 43  # eight-byte offsets and counts
    word, head, entry, room = ("Q", "Q", 20, 8) if big else ("I", "H", 12, 4)
    first, seen = struct.calcsize("=" + head), set()
    at = struct.unpack_from(order + word, data, 8 if big else 4)[0]
    while at and at not in seen:
        seen.add(at)
        n = struct.unpack_from(order + head, data, at)[0]
        tags: dict[int, tuple] = {}
        for k in range(n):
            here = at + first + entry * k
            tag, kind, count = struct.unpack_from(order + "HH" + word, data, here)
            if kind not in TYPES:
                continue
            size = struct.calcsize("=" + TYPES[kind]) * count
            where = here + entry - room
            if size > room:
                where = struct.unpack_from(order + word, data, where)[0]
            if where + size > len(data):
                raise ValueError(f"tag {tag} ends behind the file")
            tags[tag] = struct.unpack_from(f"{order}{count}{TYPES[kind]}", data, where)
        yield order, tags
        at = struct.unpack_from(order + word, data, at + first + entry * n)[0]


def _row_bytes(columns: int, samples: int, bits: int) -> int:
    """Bytes of a block's row, which ends at a whole byte."""
    return (columns * samples * bits + 7) // 8


def _undo(raw: bytes, rows: int, columns: int, samples: int, bits: int, predictor: int, order: str, floating: bool) -> np.ndarray:
    """A decoded block as rows x columns x samples."""
    need = rows * _row_bytes(columns, samples, bits)
    if len(raw) < need:
        raise ValueError("short block")
    if bits < 8:
        laid = np.unpackbits(np.frombuffer(raw[:need], np.uint8).reshape(rows, -1), axis=1)[:, : columns * samples * bits]
        return (laid.reshape(rows, columns, samples, bits) @ (1 << np.arange(bits - 1, -1, -1))).astype(np.uint8)
    if floating and predictor == 3:  # byte planes, most significant first, differenced along the row
        planes = np.cumsum(np.frombuffer(raw[:need], np.uint8).reshape(rows, -1), axis=1, dtype=np.uint8)
        big = planes.reshape(rows, bits // 8, columns * samples).transpose(0, 2, 1)
        return np.ascontiguousarray(big).view(f">f{bits // 8}").reshape(rows, columns, samples).astype(f"<f{bits // 8}")
    kind = f"{order}{'f' if floating else 'u'}{bits // 8}"
    block = np.frombuffer(raw[:need], kind).reshape(rows, columns, samples).astype(kind.replace(">", "<"))
    if predictor == 2:
        block = np.cumsum(block, axis=1, dtype=block.dtype)
    return block


def read_page(data: bytes, order: str, tags: dict[int, tuple], number: int, most_bytes: int = MOST_BYTES) -> Page:
    if any(not isinstance(x, int) for tag in LAYOUT for x in tags.get(tag, ())):
        raise ValueError("a layout tag that is no whole number")
    one = lambda tag, default: (tags.get(tag) or (default,))[0]
    width, height, samples, bits = one(WIDTH, 0), one(LENGTH, 0), one(SAMPLES, 1), one(BITS, 1)
    how, predictor, planar = one(COMPRESSION, NONE), one(PREDICTOR, 1), one(PLANAR, 1)
    if how not in DECODERS or bits not in (1, 2, 4, 8, 16, 32, 64) or predictor not in (1, 2, 3) or (bits < 8 and predictor != 1):
        raise ValueError(f"unsupported: compression {how}, {bits} bits, predictor {predictor}")
    if width < 1 or height < 1 or samples < 1 or width * height * samples * max(1, bits // 8) > most_bytes:
        raise ValueError(f"size {width} x {height}")
    floating = one(SAMPLE_FORMAT, 1) == 3
    backward = one(FILL_ORDER, 1) == 2
    image = np.zeros((height, width, samples), f"<{'f' if floating else 'u'}{max(1, bits // 8)}")
    tiled = TILE_OFFSETS in tags
    if tiled:
        bw, bh, offsets, counts = one(TILE_WIDTH, 0), one(TILE_LENGTH, 0), tags[TILE_OFFSETS], tags[TILE_COUNTS]
    else:
        bw, bh, offsets, counts = width, min(height, one(ROWS_PER_STRIP, height)), tags[STRIP_OFFSETS], tags[STRIP_COUNTS]
    if bw < 1 or bh < 1 or bw * bh * samples * max(1, bits // 8) > most_bytes:
        raise ValueError("blocks without a size, or of one over the bound")
    if -(-height // bh) * -(-width // bw) * (samples if planar == 2 else 1) != len(offsets) or len(offsets) != len(counts):
        raise ValueError("blocks and their offsets differ in number")
    spots = [(y, x) for y in range(0, height, bh) for x in range(0, width, bw)]
    layers = [(p, 1) for p in range(samples)] if planar == 2 else [(0, samples)]
    todo = [(layer, spot) for layer in layers for spot in spots]
    for (sample, deep), (y, x), offset, count in ((a, b, o, c) for (a, b), o, c in zip(todo, offsets, counts, strict=True)):
        rows = bh if tiled else min(bh, height - y)
        packed = data[offset : offset + count]
        if backward:
            packed = np.packbits(np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little")).tobytes()
        block = _undo(DECODERS[how](packed, rows * _row_bytes(bw, deep, bits)), rows, bw, deep, bits, predictor, order, floating)
        image[y : y + bh, x : x + bw, sample : sample + deep] = block[: height - y, : width - x]
    return Page(number, width, height, samples, bits, NAMES[how], predictor, tiled, image.tobytes())


def read_pages(data: bytes) -> list[Page]:
    return [read_page(data, order, tags, n) for n, (order, tags) in enumerate(directories(data))]


ROWS = "doc_id long, page int, width int, height int, samples int, bits int, compression string, predictor int, tiled boolean, pixels binary, error string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("samples", pa.int32()), ("bits", pa.int32()), ("compression", pa.string()), ("predictor", pa.int32()), ("tiled", pa.bool_()), ("pixels", pa.binary()), ("error", pa.string())])


def pages(media: DataFrame, id_col: str = "doc_id", media_col: str = "media", most_bytes: int = MOST_BYTES) -> DataFrame:
    """One row for each page of each cell; most_bytes bounds the pixel bytes of a page."""

    def rows(key, data):
        if not data:
            return [(key, *[None] * 9, "empty")]
        out = []
        try:
            for n, (order, tags) in enumerate(directories(data)):
                try:
                    p = read_page(data, order, tags, n, most_bytes)
                    out.append((key, n, p.width, p.height, p.samples, p.bits, p.compression, p.predictor, p.tiled, p.pixels, None))
                except Exception as why:  # noqa: BLE001  a forged page must not fail the job, whatever it raises
                    out.append((key, n, *[None] * 8, str(why) or type(why).__name__))
        except Exception as why:  # noqa: BLE001  the same for a forged cell
            out.append((key, len(out) or None, *[None] * 8, str(why) or type(why).__name__))
        return out or [(key, *[None] * 9, "no page")]

    def run(batches):
        for b in batches:
            for key, data in zip(b.column(0), b.column(1), strict=True):
                found = rows(key.as_py(), data.as_py())
                yield batch(_ARROW, *map(list, zip(*found, strict=True)))

    return media.select(media[id_col].cast("long").alias("doc_id"), media[media_col].cast("binary").alias("media")).mapInArrow(run, ROWS)


UNIT = 192
SIDE = 64  # pixels of a row of three samples: one unit
PAGE_ROWS = 256
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def padded(raw: bytes) -> bytes:
    return raw + b" " * ((-len(raw)) % UNIT or (0 if raw else UNIT))


#: (compression, predictor, tile side) that a payload's checksum picks from, whatever its size.
LAYOUTS = ((ADOBE_DEFLATE, 2, 0), (ADOBE_DEFLATE, 2, 32), (PACKBITS, 1, 0), (LZW, 1, 0), (LZW, 2, 32), (OLD_DEFLATE, 2, 0))


def store(payload: bytes) -> bytes:
    """A payload as a TIFF of RGB pages; its content alone picks the layout, so equal texts are stored alike."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, SIDE, 3)
    how, predictor, tile = LAYOUTS[zlib.crc32(payload) % len(LAYOUTS)]
    parts = [image[k : k + PAGE_ROWS] for k in range(0, len(image), PAGE_ROWS)]
    return write(parts, [how] * len(parts), predictor, 64, tile)


def round_trip(docs: DataFrame) -> DataFrame:
    """Stores each text as TIFF, reads its pages back, and computes features of them."""
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_bytes", "payload_bytes")], ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])

    def row(text: str) -> tuple:
        raw = text.encode("utf-8", "replace")
        media = store(padded(raw))
        found = read_pages(media)
        payload = b"".join(p.pixels for p in found)
        count = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
        share = count[count > 0] / len(payload)
        feature = f"{len(found)} {found[0].compression}{' tiles' if found[0].tiled else ''} mean={count @ np.arange(256) / len(payload):.4f} entropy={-(share @ np.log2(share)) + 0.0:.4f}"
        return len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature

    def run(batches):
        for ids, texts in slices(batches):
            yield batch(schema, ids, *map(list, zip(*map(row, texts), strict=True)))

    return id_text(docs).mapInArrow(run, FEATURES)
