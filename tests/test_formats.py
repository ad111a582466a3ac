from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest

from depthloom.sources import codecs


@pytest.mark.parametrize("image", [np.arange(48, dtype=np.uint8).reshape(6, 8), (np.arange(48) * 1300 % 65536).astype(np.uint16).reshape(6, 8), np.random.default_rng(0).integers(0, 256, (5, 7, 3), np.uint8)])
def test_png_round_trip(image):
    raw = codecs.encode_png(image)
    assert (codecs.decode_png(raw) == image).all() and codecs.decode_png(raw).dtype == image.dtype
    assert codecs.png_size(raw) == (image.shape[1], image.shape[0])


def test_png_filters():
    """One line for each of the five filters, made by the definition of the format."""
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (5, 6, 3), np.uint8)
    flat, lines = image.reshape(5, -1).astype(int), []
    for y in range(5):
        line = []
        for x in range(18):
            left, up, corner = flat[y, x - 3] if x >= 3 else 0, flat[y - 1, x] if y else 0, flat[y - 1, x - 3] if y and x >= 3 else 0
            p = left + up - corner
            paeth = left if abs(p - left) <= abs(p - up) and abs(p - left) <= abs(p - corner) else up if abs(p - up) <= abs(p - corner) else corner
            line.append((flat[y, x] - [0, left, up, (left + up) // 2, paeth][y]) & 255)
        lines.append(bytes([y, *line]))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    raw = codecs.PNG_MAGIC + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 5, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert (codecs.decode_png(raw) == image).all()
    with pytest.raises(ValueError):
        codecs.decode_png(b"no image")


def test_bin():
    raw = codecs.encode_bin(np.arange(6.0).reshape(2, 3), np.array([[255, 0, 0], [0, 255, 255]], np.uint8))
    back = codecs.decode_bin(raw)
    assert back.shape == (2, 5) and np.isclose(back[0, 3], 1 / 3) and (back[:, 4] == 0).all()
    with pytest.raises(ValueError):
        codecs.decode_bin(raw[:-1])


def test_ply():
    xyz, rgb = np.arange(12.0).reshape(4, 3), np.full((4, 3), 9, np.uint8)
    p = codecs.decode_ply(codecs.encode_ply(xyz, rgb, np.arange(4, dtype=np.uint8)))
    assert (p["y"] == xyz[:, 1]).all() and (p["intensity"] == np.arange(4)).all() and "faces" not in p
    mesh = codecs.decode_ply(codecs.encode_ply(xyz, rgb, faces=[[0, 1, 2], [0, 1, 2, 3]]))
    assert mesh["faces"] == [[0, 1, 2], [0, 1, 2, 3]]


def _element(kind: int, data: bytes) -> bytes:
    if len(data) <= 4:
        return struct.pack("<HH", kind, len(data)) + data.ljust(4, b"\0")
    return struct.pack("<II", kind, len(data)) + data + b"\0" * (-len(data) % 8)


def _array(cls: int, dims: tuple[int, ...], name: bytes, body: bytes) -> bytes:
    return _element(14, _element(6, struct.pack("<II", cls, 0)) + _element(5, np.array(dims, "<i4").tobytes()) + _element(1, name) + body)


def test_mat():
    numbers = _array(6, (2, 3), b"", _element(9, np.arange(6.0).tobytes()))
    text = _array(4, (1, 5), b"", _element(16, b"chair"))
    cell = _array(1, (1, 2), b"", text + numbers)
    fields = b"".join(n.ljust(8, b"\0") for n in (b"K", b"name", b"c"))
    body = _element(5, struct.pack("<i", 8)) + _element(1, fields) + (numbers + text + cell) * 2
    struct_array = _array(2, (1, 2), b"meta", body)
    zipped = zlib.compress(struct_array)
    raw = b"MATLAB 5.0".ljust(124) + struct.pack("<HH", 0x0100, 0x4D49) + struct.pack("<II", 15, len(zipped)) + zipped
    meta = codecs.decode_mat(raw)["meta"]
    assert len(meta) == 2 and meta[0]["name"] == "chair" and meta[1]["c"][0] == "chair"
    assert (meta[0]["K"] == np.arange(6.0).reshape(2, 3, order="F")).all()
