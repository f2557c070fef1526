"""Rows of numbers that meet on a key: packed in each task, shuffled by the key, joined in numpy.

A task sends one block of bytes to each part instead of rows, so that a number costs the bytes that its range needs.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import packed as P

#: Pairs of rows that are laid side by side at once.
PAIRS = 200_000
#: Parts of the keys for each task that joins them; Spark deals parts to tasks by hash.
PARTS = 16
_HEAD = struct.Struct("<qqb")
#: The lower bit of each letter of two bits.
_LETTERS = 0x5555555555555555


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scattering of 64-bit numbers."""
    u = np.uint64
    x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
    return x ^ (x >> u(31))


def packed_numbers(x: np.ndarray) -> bytes:
    """64-bit numbers as their least and, plane by plane, the bytes of what is above it."""
    x = x.astype(np.int64)
    low = int(x.min(initial=0)) if len(x) else 0
    above = (x - low).astype(np.uint64)
    size = (int(above.max(initial=0)).bit_length() + 7) // 8
    return _HEAD.pack(len(x), low, size) + np.ascontiguousarray(above.view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def unpacked_numbers(data: memoryview, columns: int) -> list[np.ndarray]:
    """The first columns that ``packed_numbers`` made one behind the other."""
    out, at = [], 0
    for _ in range(columns):
        n, low, size = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        cells = np.zeros((n, 8), np.uint8)
        cells[:, :size] = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T
        out.append(cells.view(np.int64).ravel() + low)
        at += n * size
    return out


def blocks(kind: int, key: np.ndarray, *others: np.ndarray, parts: int) -> pa.RecordBatch:
    """``(part, kind, rows)``: the rows of 32-bit keys and numbers, one block of bytes for each part that has some."""
    order = np.argsort(key, kind="stable")
    key, others = key[order].astype(np.int64), [x[order] for x in others]
    ends = np.searchsorted(key, [(i << 32) // parts for i in range(parts + 1)])
    spans = [(i, a, b) for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if a < b]
    rows = [packed_numbers(key[a:a + 1]) + packed_numbers(np.diff(key[a:b])) + b"".join(packed_numbers(x[a:b]) for x in others) for _, a, b in spans]
    return pa.RecordBatch.from_arrays([pa.array([i for i, *_ in spans], pa.int32()), pa.array([kind] * len(spans), pa.int32()), pa.array(rows, pa.binary())], ["part", "kind", "rows"])


def _gathered(batches: Iterator[pa.RecordBatch], columns: tuple[int, int]) -> list[list[np.ndarray]]:
    """The key and the other columns of both kinds of rows of one task."""
    held: list[list[list[np.ndarray]]] = [[], []]
    for batch in batches:
        for kind, rows in zip(batch.column("kind").to_pylist(), batch.column("rows")):
            first, steps, *others = unpacked_numbers(memoryview(rows.as_buffer()), columns[kind] + 2)
            held[kind].append([np.cumsum(np.append(first, steps)), *others])
    return [[np.concatenate(x) for x in zip(*h)] if h else [np.zeros(0, np.int64)] * (columns[i] + 1) for i, h in enumerate(held)]


def sorted_rows(columns: list[np.ndarray]) -> list[np.ndarray]:
    order = np.argsort(columns[0], kind="stable")
    return [x[order] for x in columns]


def met(one: list[np.ndarray], two: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of rows of equal keys, about ``PAIRS`` at once; the second rows are sorted by key in place."""
    two[:] = sorted_rows(two)
    first, last = np.searchsorted(two[0], one[0]), np.searchsorted(two[0], one[0], side="right")
    n = last - first
    some = np.flatnonzero(n)
    # rows with very many others are divided, so that no piece is much larger than PAIRS
    pieces = -(-n[some] // PAIRS)
    row = np.repeat(some, pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = first[row] + nth * PAIRS
    size = np.minimum(last[row] - begin, PAIRS)
    total, at = np.cumsum(size), 0
    while at < len(row):
        until = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        s = size[at:until]
        start = np.cumsum(s) - s
        yield np.repeat(row[at:until], s), np.arange(int(s.sum())) + np.repeat(begin[at:until] - start, s)
        at = until


def meeting(rows: DataFrame, columns: tuple[int, int], pairs, schema: str, tasks: int, near=None) -> DataFrame:
    """Brings the ``blocks`` of rows of both kinds together by key. columns: how many each kind has besides the key;
    pairs makes of two lists of columns of equal length (key first), row for row, the columns of the result. near makes of
    each kind's columns numbers and masks: only rows whose numbers differ in at most one two-bit letter under both masks are paired."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _gathered(batches, columns)
        two = sorted_rows(two)
        seen = near and (*near[0](one), *near[1](two))
        for i, j in met(one, two):
            if near:
                x, mask, y, other = seen
                differ = (x[i] ^ y[j]) & mask[i] & other[j]
                differ = (differ | differ >> 1) & _LETTERS
                alike = differ & (differ - 1) == 0
                i, j = i[alike], j[alike]
            out = pairs([x[i] for x in one], [x[j] for x in two])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out.values()], list(out))

    return rows.repartition(tasks, F.col("part")).mapInArrow(joined, schema)


#: What is before a text's letters: two bits a base, or the text as it is.
_TWO_BITS, _PLAIN = 0, 1
_QUADS = np.array([[b"ACGT"[i >> s & 3] for s in (6, 4, 2, 0)] for i in range(256)], np.uint8)


def packed_texts(texts: pa.Array) -> pa.Array:
    """Texts of A, C, G and T with two bits a base, others as they are; ``unpacked_texts`` gives them back."""
    codes, offsets = P.flat(texts)
    n = np.diff(offsets)
    other = np.concatenate([[0], np.cumsum(codes > 3)])
    plain = other[offsets[1:]] > other[offsets[:-1]]
    # each text filled up to whole bytes
    quads = -(-n // 4)
    cells = np.zeros(int(quads.sum()) * 4, np.uint8)
    starts = np.concatenate([[0], np.cumsum(quads)])
    cells[np.arange(len(codes)) + np.repeat(starts[:-1] * 4 - offsets[:-1], n)] = codes & 3
    q = cells.reshape(-1, 4)
    data = (q[:, 0] << 6 | q[:, 1] << 4 | q[:, 2] << 2 | q[:, 3]).astype(np.uint8).tobytes()
    # the first byte tells the kind and how many bases the last byte lacks
    lacks = (quads * 4 - n).tolist()
    as_they_are = {i: texts[i].as_py().encode() for i in np.flatnonzero(plain).tolist()}
    return pa.array([bytes((_PLAIN,)) + as_they_are[i] if i in as_they_are else bytes((lacks[i] << 1 | _TWO_BITS,)) + data[starts[i]:starts[i + 1]] for i in range(len(n))], pa.binary())


def unpacked_texts(packed: pa.Array) -> list[str]:
    out = []
    for x in packed.to_pylist():
        if x[0] & 1:
            out.append(x[1:].decode())
        else:
            letters = _QUADS[np.frombuffer(x, np.uint8, offset=1)].tobytes().decode()
            out.append(letters[: len(letters) - (x[0] >> 1)])
    return out
