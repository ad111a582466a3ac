"""Bytes to arrays and back: PNG, NPY/NPZ, point records, PLY, MATLAB 5. Pure Python and numpy."""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np

PNG_MAGIC = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
# Number types of the PLY format, by both of their names.
_PLY_TYPES = {
    "char": "i1", "uchar": "u1", "short": "<i2", "ushort": "<u2", "int": "<i4", "uint": "<u4", "float": "<f4", "double": "<f8",
    "int8": "i1", "uint8": "u1", "int16": "<i2", "uint16": "<u2", "int32": "<i4", "uint32": "<u4", "float32": "<f4", "float64": "<f8",
}


def png_size(raw: bytes) -> tuple[int, int]:
    """(width, height) from the header alone."""
    if raw[:8] != PNG_MAGIC:
        raise ValueError("not a PNG")
    return struct.unpack(">II", raw[16:24])


def decode_png(raw: bytes) -> np.ndarray:
    """Grey, palette, RGB or RGBA images of 8 or 16 bits, not interlaced."""
    if raw[:8] != PNG_MAGIC:
        raise ValueError("not a PNG")
    at, body, palette = 8, [], None
    while at + 8 <= len(raw):
        size, kind = struct.unpack(">I4s", raw[at : at + 8])
        data = raw[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            width, height, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", data)
        elif kind == b"PLTE":
            palette = np.frombuffer(data, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(data)
        at += size + 12
    if interlace or depth not in (8, 16):
        raise ValueError("only plain images of 8 or 16 bits")
    unit = _CHANNELS[colour] * depth // 8
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, 1 + width * unit)
    pixels = _unfilter(lines[:, 0], lines[:, 1:], unit)
    out = pixels.reshape(height, width, unit) if depth == 8 else pixels.reshape(height, -1).view(">u2").reshape(height, width, unit // 2).astype(np.uint16)
    if palette is not None and colour == 3:
        return palette[out[..., 0]]
    return out[..., 0] if out.shape[2] == 1 else out


def _unfilter(kinds: np.ndarray, lines: np.ndarray, unit: int) -> np.ndarray:
    out = np.zeros_like(lines)
    above = np.zeros(lines.shape[1], np.uint8)
    for i, kind in enumerate(kinds):
        line = lines[i]
        if kind == 0:
            row = line.copy()
        elif kind == 1:
            row = np.cumsum(line.reshape(-1, unit), axis=0, dtype=np.uint8).reshape(-1)
        elif kind == 2:
            row = line + above
        else:
            row = np.zeros_like(line)
            for j in range(len(line)):
                left = int(row[j - unit]) if j >= unit else 0
                up, corner = int(above[j]), int(above[j - unit]) if j >= unit else 0
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    turn = left + up - corner
                    guess = min((abs(turn - left), 0, left), (abs(turn - up), 1, up), (abs(turn - corner), 2, corner))[2]
                row[j] = (int(line[j]) + guess) & 255
        out[i] = above = row
    return out


def encode_png(image: np.ndarray) -> bytes:
    """Grey or RGB, 8 or 16 bits, with the upward filter."""
    depth, colour = image.dtype.itemsize * 8, 0 if image.ndim == 2 else 2
    rows = np.ascontiguousarray(image.astype(image.dtype.newbyteorder(">"))).view(np.uint8).reshape(len(image), -1)
    lines = rows.copy()
    lines[1:] -= rows[:-1]
    body = np.concatenate([np.full((len(rows), 1), 2, np.uint8), lines], 1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], depth, colour, 0, 0, 0)
    return PNG_MAGIC + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(body, 6)) + chunk(b"IEND", b"")


def decode_image(name: str, raw: bytes) -> np.ndarray:
    """.npy as it is, else PNG."""
    return np.load(io.BytesIO(raw)) if name.endswith(".npy") else decode_png(raw)


#: Mark of pixels that Spark's image source has decoded: height, width and channels follow as 32-bit numbers, then the bytes.
PIXELS = b"BGR\x00"


def decode_colour(raw: bytes) -> np.ndarray:
    """Colour pixels (height, width, red green blue) of a PNG, or of what ``readers.colours`` made of any image."""
    if raw[:4] != PIXELS:
        return decode_png(raw)
    h, w, channels = struct.unpack(">3I", raw[4:16])
    image = np.frombuffer(raw, np.uint8, h * w * channels, 16).reshape(h, w, channels)
    return np.repeat(image, 3, 2) if channels == 1 else image[..., 2::-1]


def is_npy(raw: bytes) -> bool:
    return raw[:6] == b"\x93NUMPY"


def depth_metres(raw: bytes, scale: float) -> np.ndarray:
    """A depth image in metres, by what its bytes are: the scale holds for PNG, an array is taken as it is."""
    return decode_depth(".npy" if is_npy(raw) else "", raw, scale)


def label_image(raw: bytes) -> np.ndarray:
    return decode_image(".npy" if is_npy(raw) else "", raw).astype(np.uint8)


def decode_depth(name: str, raw: bytes, scale: float = 1.0) -> np.ndarray:
    """Metres; the scale holds for images, an .npy is taken as it is."""
    image = decode_image(name, raw)
    return image.astype(np.float64) if name.endswith(".npy") else image.astype(np.float64) * scale


def decode_bin(raw: bytes) -> np.ndarray:
    """Point records x, y, z, intensity, ring of 20 bytes."""
    if len(raw) % 20:
        raise ValueError(f"{len(raw)} bytes are no multiple of 20")
    return np.frombuffer(raw, "<f4").reshape(-1, 5)


def encode_bin(xyz: np.ndarray, rgb: np.ndarray) -> bytes:
    """Intensity is the mean colour over 255, the ring 0."""
    out = np.zeros((len(xyz), 5), "<f4")
    out[:, :3], out[:, 3] = xyz, rgb.astype(np.float32).mean(1) / np.float32(255)
    return out.tobytes()


def encode_npz(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **arrays)
    return out.getvalue()


def decode_npz(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as z:
        return {k: z[k] for k in z.files}


def encode_ply(xyz: np.ndarray, rgb: np.ndarray, intensity: np.ndarray | None = None, faces: list[list[int]] | None = None) -> bytes:
    """Binary little-endian points, or a mesh if faces are given."""
    kinds = [(n, "<f4") for n in "xyz"] + [(n, "u1") for n in ("red", "green", "blue")]
    if intensity is not None:
        kinds.append(("intensity", "u1"))
    rows = np.zeros(len(xyz), kinds)
    for i, n in enumerate("xyz"):
        rows[n] = xyz[:, i]
    for i, n in enumerate(("red", "green", "blue")):
        rows[n] = rgb[:, i]
    if intensity is not None:
        rows["intensity"] = intensity
    head = ["ply", "format binary_little_endian 1.0", f"element vertex {len(xyz)}"]
    head += [f"property {'float' if t == '<f4' else 'uchar'} {n}" for n, t in kinds]
    tail = b""
    if faces is not None:
        head += [f"element face {len(faces)}", "property list uchar int vertex_indices"]
        tail = b"".join(bytes([len(f)]) + np.asarray(f, "<i4").tobytes() for f in faces)
    return ("\n".join([*head, "end_header"]) + "\n").encode() + rows.tobytes() + tail


def _ply_head(raw: bytes) -> tuple[int, dict[str, int], list[tuple[str, str]], tuple[str, str]]:
    """(end of the header, number of each element, vertex properties, kinds of a face's count and of its indices)."""
    end = raw.index(b"end_header\n") + len(b"end_header\n")
    kinds, counts, element, lists = [], {}, "", ("u1", "<i4")
    for words in (line.split() for line in raw[:end].decode("ascii").splitlines()):
        if words[0] == "format" and words[1] != "binary_little_endian":
            raise ValueError(f"format {words[1]}")
        if words[0] == "element":
            element = words[1]
            counts[element] = int(words[2])
        elif words[0] == "property" and element == "vertex":
            kinds.append((words[2], _PLY_TYPES[words[1]]))
        elif words[0] == "property" and element == "face":
            if words[1] != "list":
                raise ValueError("faces with other properties than their vertices")
            lists = (_PLY_TYPES[words[2]], _PLY_TYPES[words[3]])
    return end, counts, kinds, lists


def decode_faces(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, vertex numbers) of a mesh's faces: records of changing length, face f is numbers[offsets[f]:offsets[f + 1]].

    Runs of faces with one number of vertices are read at once.
    """
    end, counts, kinds, (count_kind, index_kind) = _ply_head(raw)
    at, left = end + counts.get("vertex", 0) * np.dtype(kinds).itemsize, counts.get("face", 0)
    sizes, numbers = [], []
    count, index = np.dtype(count_kind), np.dtype(index_kind)
    while left:
        if at + count.itemsize > len(raw):
            raise ValueError(f"{left} faces are missing")
        k = int(np.frombuffer(raw, count, 1, at)[0])
        record = np.dtype([("k", count), ("v", index, (k,))])
        some, step = min(left, (len(raw) - at) // record.itemsize), 16
        if some == 0:
            raise ValueError(f"{left} faces are missing")
        same = 0
        while same < some:  # longer and longer stretches, until a face has another number
            held = np.frombuffer(raw, record, min(step, some - same), at + same * record.itemsize)
            other = np.flatnonzero(held["k"] != k)
            n = int(other[0]) if len(other) else len(held)
            sizes.append(np.full(n, k, np.int64))
            numbers.append(held["v"][:n].astype(np.int64).ravel())
            same += n
            if len(other):
                break
            step *= 4
        at, left = at + same * record.itemsize, left - same
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes) if sizes else np.zeros(0, np.int64))])
    return offsets, np.concatenate(numbers) if numbers else np.zeros(0, np.int64)


def decode_ply(raw: bytes) -> dict[str, object]:
    """Vertex properties by name, and faces if there are any."""
    end, counts, kinds, _ = _ply_head(raw)
    rows = np.frombuffer(raw, np.dtype(kinds), counts.get("vertex", 0), end)
    out: dict[str, object] = {name: rows[name].copy() for name, _ in kinds}
    if "face" in counts:
        offsets, numbers = decode_faces(raw)
        out["faces"] = [numbers[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return out


# Element kinds and array classes of the MATLAB 5 format.
_MAT_NUMBERS = {1: "i1", 2: "u1", 3: "<i2", 4: "<u2", 5: "<i4", 6: "<u4", 7: "<f4", 9: "<f8", 12: "<i8", 13: "<u8"}
_MAT_MATRIX, _MAT_ZIPPED = 14, 15
_CELL, _STRUCT, _CHAR = 1, 2, 4


def _elements(raw: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at + 8 <= len(raw):
        kind, size = struct.unpack_from("<II", raw, at)
        if kind >> 16:
            yield kind & 0xFFFF, raw[at + 4 : at + 4 + (kind >> 16)]
            at += 8
            continue
        yield kind, raw[at + 8 : at + 8 + size]
        at += 8 + size + (0 if kind == _MAT_ZIPPED else -size % 8)


def _value(kind: int, data: bytes) -> tuple[str, object]:
    if kind == _MAT_ZIPPED:
        return _value(*next(_elements(zlib.decompress(data))))
    if kind == _MAT_MATRIX:
        return _matrix(data)
    return "", np.frombuffer(data, _MAT_NUMBERS.get(kind, "u1"))


def _matrix(data: bytes) -> tuple[str, object]:
    parts = _elements(data)
    head = next(parts, None)
    if head is None:
        return "", np.zeros((0, 0))
    cls, dims, name = head[1][0], np.frombuffer(next(parts)[1], "<i4"), next(parts)[1].decode("latin1")
    if cls == _STRUCT:
        width = int(np.frombuffer(next(parts)[1], "<i4")[0])
        raw = next(parts)[1]
        fields = [raw[i : i + width].split(b"\0")[0].decode("latin1") for i in range(0, len(raw), width)]
        values = [_value(*p)[1] for p in parts]
        rows = [dict(zip(fields, values[i : i + len(fields)], strict=True)) for i in range(0, len(values), len(fields) or 1)]
        return name, rows[0] if len(rows) == 1 else rows
    if cls == _CELL:
        items = [_value(*p)[1] for p in parts]
        return name, items[0] if len(items) == 1 else items
    kind, raw = next(parts, (9, b""))
    if cls == _CHAR:
        return name, raw.decode("latin1" if kind in (1, 2) else "utf-8" if kind == 16 else "utf-16-le", "ignore")
    numbers = np.frombuffer(raw, _MAT_NUMBERS.get(kind, "u1"))
    return name, numbers.reshape(dims, order="F") if numbers.size == np.prod(dims) else numbers


def decode_mat(raw: bytes) -> dict[str, object]:
    """Variables of a MATLAB 5 file; structs become dicts (lists of them for arrays), cells lists, text strings."""
    return dict(_value(*p) for p in _elements(raw[128:]))
