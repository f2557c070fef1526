"""Packed bases for numpy code inside Arrow tasks: two bits a base, whole batches at once.

A batch's texts lie in one flat array of codes (A 0, C 1, G 2, T 3, anything else 4). The packing
functions combine windows of 1, 2, 4, ... bases, so that k bases cost about log2(k) vector steps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_CODE = np.full(256, 4, np.uint8)
for _i, _pair in enumerate((b"Aa", b"Cc", b"Gg", b"Tt")):
    for _b in _pair:
        _CODE[_b] = _i
_LETTER = np.frombuffer(b"ACGT", np.uint8)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls, as codes, and its offsets (one more than texts)."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return _CODE[raw], offsets - offsets[0]


def cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of the texts, one a row with zeros behind its end, and their lengths."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = "".join(texts)
    letters = np.frombuffer(joined.encode(), np.uint8) if joined.isascii() else np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros((len(texts), int(size.max(initial=0))), letters.dtype)
    out[np.arange(out.shape[1]) < size[:, None]] = letters
    return out, size


def windows_ok(codes: np.ndarray, k: int) -> np.ndarray:
    """For each start, whether k bases without other letters begin there."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    bad = np.concatenate([[0], np.cumsum(codes > 3, dtype=np.int32)])
    return bad[k:] == bad[:n]


def pack(codes: np.ndarray, k: int, dtype: type = np.uint64) -> np.ndarray:
    """For each start, the k bases there as one number, the first base in the highest bits."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype)
    part, width, out, used = (codes & 3).astype(dtype), 1, None, 0
    while True:
        if k & width:
            piece = part[used : used + n]
            out = piece.copy() if out is None else (out << dtype(2 * width)) | piece
            used += width
        width *= 2
        if width > k:
            return out
        part = (part[: len(part) - width // 2] << dtype(width)) | part[width // 2 :]


def pack_rc(codes: np.ndarray, k: int, dtype: type = np.uint64) -> np.ndarray:
    """For each start, the reverse complement of the k bases there as one number."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype)
    part, width, out, used = (3 - (codes & 3)).astype(dtype), 1, None, 0
    while True:
        if k & width:
            piece = part[used : used + n]
            out = piece.copy() if out is None else out | (piece << dtype(2 * used))
            used += width
        width *= 2
        if width > k:
            return out
        part = part[: len(part) - width // 2] | (part[width // 2 :] << dtype(width))


def rc_packed(x: np.ndarray, k: int) -> np.ndarray:
    """Reverse complements of packed k-mers."""
    u = np.uint64
    x = (~x).byteswap()
    x = ((x >> u(4)) & u(0x0F0F0F0F0F0F0F0F)) | ((x & u(0x0F0F0F0F0F0F0F0F)) << u(4))
    x = ((x >> u(2)) & u(0x3333333333333333)) | ((x & u(0x3333333333333333)) << u(2))
    return x >> u(64 - 2 * k)


def unpack_strings(x: np.ndarray, k: int) -> pa.Array:
    """Packed k-mers as strings."""
    shifts = np.arange(2 * (k - 1), -1, -2, dtype=np.uint64)
    letters = _LETTER[((x[:, None] >> shifts) & np.uint64(3)).astype(np.uint8)] if len(x) else np.zeros((0, k), np.uint8)
    return pa.StringArray.from_buffers(len(x), pa.py_buffer(np.arange(0, k * len(x) + 1, k, dtype=np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(letters).tobytes()))


def mix32(x: np.ndarray) -> np.ndarray:
    """A one-to-one scattering of 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def slide_min(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum over each window of w values."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    width, part = 1, x
    while 2 * width <= w:
        part = np.minimum(part[: len(part) - width], part[width:])
        width *= 2
    return np.minimum(part[:n], part[w - width : w - width + n])
