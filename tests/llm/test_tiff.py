"""TIFF files written here and laid out by hand, read back exactly."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from lectern.llm import tiff


def noisy(h, w, n, seed):
    rng = np.random.default_rng(seed)
    return np.where(rng.random((h, w, n)) < 0.5, 7, rng.integers(0, 256, (h, w, n))).astype(np.uint8)


@pytest.mark.parametrize("compression", [tiff.PLAIN, tiff.LZW, tiff.DEFLATE, tiff.OLD_DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [None, (16, 32)])
@pytest.mark.parametrize("order", ["<", ">"])
def test_pages_come_back(compression, predictor, tile, order):
    pages = [noisy(37, 50, 3, 1), noisy(1, 1, 1, 2), noisy(130, 21, 4, 3)]
    got = list(tiff.pages_of(tiff.write(pages, compression, predictor, tile, strip_rows=10, order=order)))
    assert [g[3] for g in got] == [None] * 3
    assert all(np.array_equal(g[2], p) for g, p in zip(got, pages, strict=True))


def test_packers():
    rnd = random.Random(1)
    for n in [0, 1, 2, 3, 127, 128, 129, 130, 300, 5000, 70000]:
        for data in (bytes(n), rnd.randbytes(n), bytes(rnd.choice(b"aab") for _ in range(n))):
            assert tiff.unpack_bits(tiff.pack_bits(data), n) == data
            if n < 20000:
                assert tiff.lzw_unpack(tiff.lzw_pack(data), n) == data


def test_known_lzw_and_packbits_vectors():
    # the format's own examples
    assert tiff.unpack_bits(bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA"), 24) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")
    assert tiff.lzw_unpack(tiff.lzw_pack(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])), 9) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    bits = "".join(f"{c:09b}" for c in codes)
    data = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert tiff.lzw_unpack(data, 9) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    assert tiff.lzw_pack(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])) == data


def test_sixteen_bits_and_planes():
    values = (np.arange(24).reshape(2, 4, 3) * 2000).astype(">u2")
    planes = [values[:, :, k].tobytes() for k in range(3)]
    body, offsets = b"", []
    for p in planes:
        offsets.append(8 + len(body))
        body += p
    extra = 8 + len(body)
    arrays = struct.pack(">3H3I3I", 16, 16, 16, *offsets, *map(len, planes))
    entries = [(256, 3, 1, 4 << 16), (257, 3, 1, 2 << 16), (258, 3, 3, extra), (259, 3, 1, 1 << 16), (273, 4, 3, extra + 6), (277, 3, 1, 3 << 16), (278, 3, 1, 2 << 16), (279, 4, 3, extra + 18), (284, 3, 1, 2 << 16)]
    data = b"MM\0*" + struct.pack(">I", extra + len(arrays)) + body + arrays + struct.pack(">H", len(entries)) + b"".join(struct.pack(">HHII", *e) for e in entries) + bytes(4)
    ((_, _, samples, error),) = tiff.pages_of(data)
    assert error is None and np.array_equal(samples, values)


def test_broken_files_give_reasons():
    good = tiff.write([noisy(8, 8, 1, 1)])
    loop = bytearray(good)
    loop[-4:] = good[4:8]
    assert [p[3] is None for p in tiff.pages_of(bytes(loop))] == [True, False]
    assert [p[3] for p in tiff.pages_of(b"not a tiff")] == ["no TIFF header"]
    assert list(tiff.pages_of(None)) == [] and list(tiff.pages_of(b"")) == []
    assert next(tiff.pages_of(good[:8] + b"\xff" * 10 + good[18:]))[3] is not None


def field_file(fields, body=b""):
    """A little-endian file of one directory with the given (tag, type, count, value) entries, and a body at byte 8."""
    at = 8 + len(body)
    return b"II*\0" + struct.pack("<I", at) + body + struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", *f) for f in fields) + bytes(4)


BASE = {256: (3, 1, 4), 257: (3, 1, 2), 258: (3, 1, 8), 259: (3, 1, 1), 273: (4, 1, 8), 277: (3, 1, 1), 278: (3, 1, 2), 279: (4, 1, 8)}


@pytest.mark.parametrize(
    "change",
    [
        {256: (3, 0, 4)},
        {257: (3, 0, 0)},
        {277: (3, 1, 0), 284: (3, 1, 2)},
        {258: (3, 0, 8)},
        {256: (9, 1, 0xFFFFFFFB)},
        {256: (4, 1, 100_000), 257: (4, 1, 100_000)},
        {256: (4, 1, 0xFFFFFFFF), 257: (4, 1, 0xFFFFFFFF), 259: (3, 1, 8)},
        {322: (4, 1, 4_000_000_000), 323: (4, 1, 4_000_000_000), 324: (4, 1, 8), 325: (4, 1, 8)},
        {273: (9, 1, 0xFFFFFFF0)},
        {279: (4, 1, 0xFFFFFFFF)},
        {277: (4, 1, 0xFFFFFFFF)},
        {259: (4, 1, 0xFFFFFFFF)},
        {317: (3, 1, 7)},
    ],
)
def test_crafted_fields_give_reasons(change):
    entries = sorted((tag, *v) for tag, v in (BASE | change).items())
    ((_, _, samples, error),) = tiff.pages_of(field_file(entries, bytes(range(8))))
    assert samples is None and error
    good = sorted((tag, *v) for tag, v in BASE.items())
    ((_, _, samples, error),) = tiff.pages_of(field_file(good, bytes(range(8))))
    assert error is None and samples.ravel().tolist() == list(range(8))


def test_cut_and_changed_files_never_raise():
    import tracemalloc

    rnd = random.Random(5)
    files = [tiff.write([noisy(33, 20, 3, 1), noisy(9, 9, 1, 2)], c, p, t) for c in tiff.EXPANSION for p in (1, 2) for t in (None, (16, 16))]
    tracemalloc.start()
    for _ in range(4000):
        data = bytearray(rnd.choice(files))
        for _ in range(rnd.randrange(1, 6)):
            data[rnd.randrange(len(data)) if rnd.random() < 0.3 else -rnd.randrange(1, 200)] = rnd.choice([0, 1, 255, rnd.randrange(256)])
        data = bytes(data[: rnd.randrange(len(data))] if rnd.random() < 0.2 else data)
        for _, _, samples, error in tiff.pages_of(data, max_page=1 << 22):
            assert (samples is None) == (error is not None)
    assert tracemalloc.get_traced_memory()[1] < 64 << 20
    tracemalloc.stop()


def test_large_pages_are_refused_by_the_limit():
    data = tiff.write([noisy(100, 100, 3, 1)])
    ((_, _, samples, error),) = tiff.pages_of(data, max_page=29_999)
    assert samples is None and "limit" in error
    assert next(tiff.pages_of(data, max_page=30_000))[3] is None


def test_every_form_is_stored():
    forms = {next(tiff.pages_of(tiff.store(tiff.payload_of(f"text {k}")[1])))[1][tiff.COMPRESSION][0] for k in range(40)}
    assert forms == {tiff.LZW, tiff.PACKBITS, tiff.DEFLATE}


def test_read_pages(spark):
    page = noisy(5, 6, 3, 9)
    rows = [(1, tiff.write([page, page[:2]], tiff.LZW, 2)), (2, None), (None, b"junk")]
    got = tiff.read_pages(spark.createDataFrame(rows, "id long, media binary"), "id", "media").collect()
    assert sorted((r.id or 0, r.page, r.height, r.error) for r in got if r.id) == [(1, 0, 5, None), (1, 1, 2, None)]
    assert [bytes(r.pixels) for r in got if r.id and r.page == 0] == [page.tobytes()]
    assert [r.error for r in got if not r.id] == ["no TIFF header"]


def test_text_media(spark):
    long = "é" * 200_000
    rows = [(1, "abc"), (2, None), (3, ""), (4, long), (5, "abc"), (None, "x" * 576)]
    got = {r.doc_id: r for r in tiff.text_media(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        raw = (text or "").encode()
        pad = raw + b"\xff" * (-len(raw) % 576) if raw else b"\xff" * 576
        assert (got[i].n_bytes, got[i].payload_bytes, got[i].payload_sha256, got[i].tail_crc32) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-32:]))
        media = tiff.store(pad)
        assert (got[i].media_bytes, got[i].media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
    assert got[1].feature == got[5].feature and "pages=2" in got[4].feature
