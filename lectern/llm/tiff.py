"""TIFF files in a binary column: a reader that emits one row per page, and a writer.

The reader walks the chain of image directories in either byte order, decodes strips or tiles that are stored plain or
packed with PackBits, LZW or deflate, undoes horizontal differencing and returns the samples of each page. The writer
makes files of the same kinds, so that any bytes can be kept as 8-bit samples and read back exactly.

A page that can't be decoded gives a row with null samples and the reason in `error`; a null or empty file gives no row.
Whatever the bytes are, the reader ends, raises nothing but Corrupt, and takes memory for no more than one page: before a
page is decoded, its size is held against the most that its stored bytes could unpack to and against `max_page`.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import per_text, sliced

#: Fixed values of the TIFF 6.0 format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_SIZES, PLANES = 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_SIZES = 317, 322, 323, 324, 325
PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
#: Bytes and struct letter of each field type.
TYPES = {1: (1, "B"), 2: (1, "B"), 3: (2, "H"), 4: (4, "I"), 6: (1, "b"), 7: (1, "B"), 8: (2, "h"), 9: (4, "i")}
KINDS = {"B": "u1", "H": "u2", "I": "u4", "b": "i1", "h": "i2", "i": "i4"}
CLEAR, END = 256, 257

#: Stored pages: 192 RGB pixels, or 576 bytes, a row; so many rows a page at most, rows a strip, and the tiles' sides.
ROW_BYTES, PIXELS, PAGE_ROWS, STRIP_ROWS, TILE = 576, 192, 512, 64, (64, 64)
#: Bytes that one stored byte can stand for at most; and bytes of a decoded page, tiles' margins included, that a reader takes on.
EXPANSION, MAX_PAGE = {PLAIN: 1, LZW: 4096, DEFLATE: 1032, OLD_DEFLATE: 1032, PACKBITS: 64}, 1 << 28


class Corrupt(ValueError):
    """The file breaks the format, or uses a part of it that isn't read here."""


def pack_bits(data: bytes) -> bytes:
    """PackBits: repeats of three bytes and more as runs, the rest as literals."""
    if not data:
        return b""
    raw = np.frombuffer(data, dtype=np.uint8)
    edges = np.concatenate([[0], np.flatnonzero(raw[1:] != raw[:-1]) + 1, [len(raw)]])
    out, done = [], 0

    def literal(end: int) -> None:
        out.extend(bytes([min(128, end - k) - 1]) + data[k : min(k + 128, end)] for k in range(done, end, 128))

    for start, end in ((int(edges[k]), int(edges[k + 1])) for k in np.flatnonzero(np.diff(edges) >= 3)):
        literal(start)
        for k in range(start, end, 128):
            n = min(128, end - k)
            out.append(bytes([257 - n, data[k]]) if n > 1 else bytes([0, data[k]]))
        done = end
    literal(len(data))
    return b"".join(out)


def unpack_bits(data: bytes, size: int) -> bytes:
    out, at, got = [], 0, 0
    while got < size and at < len(data):
        head = data[at]
        if head < 128:
            part = data[at + 1 : at + 2 + head]
            at += 2 + head
        elif head > 128:
            part = data[at + 1 : at + 2] * (257 - head)
            at += 2
        else:
            part, at = b"", at + 1
        out.append(part)
        got += len(part)
    return b"".join(out)


def lzw_pack(data: bytes) -> bytes:
    """LZW with codes of 9 to 12 bits, highest bit first, widened one code early as the format asks."""
    codes, widths = [CLEAR], [9]
    width, following, word = 9, 258, -1
    # a word of two bytes or more is known by its last but one word's code and its last byte
    table: dict[int, int] = {}
    for byte in data:
        if word < 0:
            word = byte
            continue
        key = word << 8 | byte
        if (longer := table.get(key)) is not None:
            word = longer
            continue
        codes.append(word)
        widths.append(width)
        table[key] = following
        following += 1
        if following == 4095:
            codes.append(CLEAR)
            widths.append(width)
            table, width, following = {}, 9, 258
        elif following + 1 > 1 << width:
            width += 1
        word = byte
    if word >= 0:
        codes.append(word)
        widths.append(width)
        following += 1
        if following + 1 > 1 << width and width < 12:
            width += 1
    codes.append(END)
    widths.append(width)
    bits = np.unpackbits(np.array(codes, dtype=">u2").view(np.uint8).reshape(-1, 2), axis=1)
    return np.packbits(bits[np.arange(16) >= 16 - np.array(widths)[:, None]]).tobytes()


def lzw_unpack(data: bytes, size: int) -> bytes:
    out, got = [], 0
    acc = bits = at = 0
    first = [bytes([b]) for b in range(256)] + [b"", b""]
    table, width, last = first.copy(), 9, None
    while got < size:
        while bits < width:
            if at >= len(data):
                return b"".join(out)
            acc, bits, at = (acc << 8 | data[at]) & 0xFFFFFFFF, bits + 8, at + 1
        bits -= width
        code = acc >> bits & (1 << width) - 1
        if code == END:
            break
        if code == CLEAR:
            table, width, last = first.copy(), 9, None
            continue
        if last is None:
            if code > 255:
                raise Corrupt("LZW data doesn't start with a byte")
            word = table[code]
        else:
            if code < len(table):
                word = table[code]
            elif code == len(table):
                word = last + last[:1]
            else:
                raise Corrupt("LZW code beyond the table")
            if len(table) < 4096:
                table.append(last + word[:1])
            if len(table) + 1 >= 1 << width and width < 12:
                width += 1
        out.append(word)
        got += len(word)
        last = word
    return b"".join(out)


def packed(data: bytes, compression: int) -> bytes:
    if compression == PLAIN:
        return data
    if compression == LZW:
        return lzw_pack(data)
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.compress(data, 1)
    if compression == PACKBITS:
        return pack_bits(data)
    raise Corrupt(f"compression {compression}")


def unpacked(data: bytes, compression: int, size: int) -> bytes:
    if compression == PLAIN:
        return data[:size]
    if compression == LZW:
        return lzw_unpack(data, size)[:size]
    if compression in (DEFLATE, OLD_DEFLATE):
        try:
            return zlib.decompressobj().decompress(data, size)
        except zlib.error as e:
            raise Corrupt(f"deflate: {e}") from e
    if compression == PACKBITS:
        return unpack_bits(data, size)[:size]
    raise Corrupt(f"compression {compression}")


def write(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, tile: tuple[int, int] | None = None, strip_rows: int = STRIP_ROWS, order: str = "<") -> bytes:
    """A TIFF of pages, each of (height, width, samples) unsigned bytes; strips, or tiles of (height, width)."""
    out = bytearray((b"II*\0" if order == "<" else b"MM\0*") + b"\0\0\0\0")
    link = 4
    for page in pages:
        height, width, samples = page.shape
        pieces = []
        if tile:
            th, tw = tile
            full = np.zeros((-(-height // th) * th, -(-width // tw) * tw, samples), dtype=np.uint8)
            full[:height, :width] = page
            blocks = [full[y : y + th, x : x + tw] for y in range(0, full.shape[0], th) for x in range(0, full.shape[1], tw)]
        else:
            blocks = [page[y : y + strip_rows] for y in range(0, height, strip_rows)]
        for block in blocks:
            if predictor == 2:
                block = np.concatenate([block[:, :1], block[:, 1:] - block[:, :-1]], axis=1)
            pieces.append((len(out), packed(block.tobytes(), compression)))
            out += pieces[-1][1] + b"\0" * (len(pieces[-1][1]) % 2)
        offsets, sizes = [p[0] for p in pieces], [len(p[1]) for p in pieces]
        fields = {WIDTH: (4, [width]), HEIGHT: (4, [height]), BITS: (3, [8] * samples), COMPRESSION: (3, [compression]), PHOTOMETRIC: (3, [2 if samples == 3 else 1]), SAMPLES: (3, [samples]), PLANES: (3, [1]), PREDICTOR: (3, [predictor])}
        if tile:
            fields |= {TILE_WIDTH: (4, [tile[1]]), TILE_HEIGHT: (4, [tile[0]]), TILE_OFFSETS: (4, offsets), TILE_SIZES: (4, sizes)}
        else:
            fields |= {STRIP_OFFSETS: (4, offsets), ROWS_PER_STRIP: (4, [strip_rows]), STRIP_SIZES: (4, sizes)}
        entries = []
        for tag, (kind, values) in sorted(fields.items()):
            value = struct.pack(f"{order}{len(values)}{TYPES[kind][1]}", *values)
            if len(value) > 4:
                at = len(out)
                out += value + b"\0" * (len(value) % 2)
                value = struct.pack(f"{order}I", at)
            entries.append(struct.pack(f"{order}HHI", tag, kind, len(values)) + value.ljust(4, b"\0"))
        struct.pack_into(f"{order}I", out, link, len(out))
        out += struct.pack(f"{order}H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def directories(data: bytes) -> Iterator[tuple[str, dict[int, np.ndarray]]]:
    """Byte order and fields of each image directory, in the order of the chain; directories that share bytes are refused."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(bytes(data[:4]))
    if order is None or len(data) < 8:
        raise Corrupt("no TIFF header")
    (at,), left = struct.unpack_from(f"{order}I", data, 4), len(data) - 8
    while at:
        if at + 2 > len(data):
            raise Corrupt("the chain of directories is broken")
        (count,) = struct.unpack_from(f"{order}H", data, at)
        if at + 6 + 12 * count > len(data):
            raise Corrupt("a directory runs past the end")
        left -= 6 + 12 * count
        if left < 0:
            raise Corrupt("the chain of directories closes on itself")
        fields: dict[int, np.ndarray] = {}
        for k in range(count):
            tag, kind, n = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
            size, letter = TYPES.get(kind, (0, ""))
            if not size or not n:
                continue
            place = at + 10 + 12 * k
            if n * size > 4:
                (place,) = struct.unpack_from(f"{order}I", data, place)
            if place + n * size > len(data):
                raise Corrupt(f"field {tag} runs past the end")
            fields[tag] = np.frombuffer(data, dtype=f"{order}{KINDS[letter]}", count=n, offset=place)
        yield order, fields
        (at,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * count)


def first_of(fields: dict[int, np.ndarray], tag: int, default: int | None = None) -> int | None:
    return int(fields[tag][0]) if tag in fields else default


def samples_of(data: bytes, order: str, fields: dict[int, np.ndarray], max_page: int = MAX_PAGE) -> np.ndarray:
    """The samples of one page: (height, width, samples) of 8 or 16 bits."""
    one = lambda tag, default=0: first_of(fields, tag, default)
    width, height, n, bits = one(WIDTH), one(HEIGHT), one(SAMPLES, 1), one(BITS, 1)
    if width < 1 or height < 1 or n < 1 or bits not in (8, 16) or (fields[BITS] != bits).any():
        raise Corrupt(f"{width} x {height} pixels of {n} samples of {bits} bits, or of several sizes")
    compression, predictor = one(COMPRESSION, PLAIN), one(PREDICTOR, 1)
    if compression not in EXPANSION:
        raise Corrupt(f"compression {compression}")
    if predictor not in (1, 2):
        raise Corrupt(f"predictor {predictor}")
    planes = n if one(PLANES, 1) == 2 else 1
    each, kind = n // planes, np.dtype(f"{order}u{bits // 8}")
    tiled = TILE_OFFSETS in fields
    bh, bw = (one(TILE_HEIGHT), one(TILE_WIDTH)) if tiled else (min(one(ROWS_PER_STRIP, height), height), width)
    offsets, sizes = (fields.get(TILE_OFFSETS), fields.get(TILE_SIZES)) if tiled else (fields.get(STRIP_OFFSETS), fields.get(STRIP_SIZES))
    if offsets is None or sizes is None or bh < 1 or bw < 1:
        raise Corrupt("no strips or tiles")
    down, across = -(-height // bh), -(-width // bw)
    pieces = down * across * planes
    if min(len(offsets), len(sizes)) < pieces:
        raise Corrupt("too few strips or tiles")
    offsets, sizes = ([int(v) for v in x[:pieces]] for x in (offsets, sizes))
    if min(offsets) < 0 or min(sizes) < 0 or any(a + b > len(data) for a, b in zip(offsets, sizes, strict=True)):
        raise Corrupt("a strip or tile runs past the end")
    whole = (down * bh if tiled else height) * across * bw * n * kind.itemsize
    if whole > max_page:
        raise Corrupt(f"a page of {whole} bytes is over the limit of {max_page}")
    if whole > sum(sizes) * EXPANSION[compression]:
        raise Corrupt(f"{sum(sizes)} stored bytes can't unpack to {whole}")
    page = np.zeros((down * bh if tiled else height, across * bw, n), dtype=kind.newbyteorder("="))
    for k in range(pieces):
        plane, rest = divmod(k, down * across)
        y, x = rest // across * bh, rest % across * bw
        rows = bh if tiled else min(bh, height - y)
        want = rows * bw * each * kind.itemsize
        got = unpacked(data[offsets[k] : offsets[k] + sizes[k]], compression, want)
        if len(got) != want:
            raise Corrupt(f"a strip or tile has {len(got)} bytes of {want}")
        block = np.frombuffer(got, dtype=kind).reshape(rows, bw, each).astype(page.dtype)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=page.dtype)
        page[y : y + rows, x : x + bw, plane * each : (plane + 1) * each] = block
    return page[:height, :width]


def pages_of(data: bytes | None, max_page: int = MAX_PAGE) -> Iterator[tuple[int, dict[int, np.ndarray], np.ndarray | None, str | None]]:
    """(page number, fields, samples or None, error or None) of each page."""
    number = -1
    try:
        for number, (order, fields) in enumerate(directories(data) if data else ()):
            try:
                yield number, fields, samples_of(data, order, fields, max_page), None
            except Corrupt as e:
                yield number, fields, None, str(e)
    except Corrupt as e:
        yield number + 1, {}, None, str(e)


def read_pages(df: DataFrame, id_col: str, media_col: str, max_page: int = MAX_PAGE) -> DataFrame:
    """One row per page of each TIFF: id, page, width, height, samples_per_pixel, bits, compression, tiled, pixels, error.

    A page that takes more than max_page bytes, tiles' margins included, has null pixels and says so in `error`.
    """
    kind = df.schema[id_col].dataType.simpleString()
    names = ["_id", "page", "width", "height", "samples_per_pixel", "bits", "compression", "tiled", "pixels", "error"]
    types = [None, pa.int32(), *[pa.int64()] * 5, pa.bool_(), pa.binary(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, 1):
            for number, fields, samples, error in pages_of(part.column(1)[0].as_py(), max_page):
                values = [number, *(first_of(fields, tag) for tag in (WIDTH, HEIGHT, SAMPLES, BITS, COMPRESSION)), TILE_OFFSETS in fields, None if samples is None else samples.tobytes(), error]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([v], type=t) for v, t in zip(values, types[1:], strict=True))], names=names)

    schema = f"_id {kind}, page int, width bigint, height bigint, samples_per_pixel bigint, bits bigint, compression bigint, tiled boolean, pixels binary, error string"
    return df.select(F.col(id_col).alias("_id"), F.col(media_col).alias("_media")).mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Length of a text in UTF-8, and those bytes filled up with 255 to whole pixel rows, one at least."""
    raw = (text or "").encode()
    return len(raw), raw.ljust(max(1, -(-len(raw) // ROW_BYTES)) * ROW_BYTES, b"\xff")


def store(payload: bytes) -> bytes:
    """The payload as RGB pages; its checksum says whether in PackBits, LZW or deflated strips, or in deflated tiles."""
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, PIXELS, 3)
    pages = [rows[k : k + PAGE_ROWS] for k in range(0, len(rows), PAGE_ROWS)]
    form = zlib.crc32(payload) % 4
    if form < 2:
        return write(pages, PACKBITS if form else LZW)
    return write(pages, DEFLATE, predictor=2, tile=TILE if form == 2 else None)


def stored_row(text: str | None) -> tuple:
    n_bytes, payload = payload_of(text)
    media = store(payload)
    pages, counts = [], np.zeros(256, dtype=np.int64)
    for _, _, samples, error in pages_of(media):
        if error:
            raise Corrupt(error)
        pages.append(samples.tobytes())
        counts += np.bincount(samples.ravel(), minlength=256)
    back = b"".join(pages)
    mean = int((counts * np.arange(256)).sum()) / len(back)
    share = counts[counts > 0] / len(back)
    feature = f"pages={len(pages)};rows={len(back) // ROW_BYTES};mean={mean:.3f};levels={len(share)};entropy={float(-(share * np.log2(share)).sum()):.3f}"
    return n_bytes, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature


def text_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text stored as a TIFF, read back, and measured; one row per row of df, null texts as empty ones."""
    return per_text(df, id_col, text_col, "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string", lambda: lambda texts: [stored_row(t) for t in texts])
