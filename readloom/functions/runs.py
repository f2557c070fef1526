"""K-mers on the move: neighbouring k-mers travel as one packed run, and are counted by sorted runs where they arrive.

K-mers are ordered by their scattered minimizer. Neighbours of a sequence mostly share it, so a run of up to w k-mers
goes to the same range as one number of at most 32 bases. A label, a small number, travels with each run: k-mers are
counted by it. Equal runs of a block are combined with a count before the shuffle.
"""

from __future__ import annotations

import numpy as np

from readloom.functions import packed as P

#: K-mers that are expanded and sorted at once, and that a range is meant to hold.
RUN_TERMS = 4_000_000
RANGE_TERMS = 6_000_000
#: Minimizers of a range at least; with fewer, ranges would differ too much.
RANGE_MINIMIZERS = 64
_U = np.uint64


def shape(k: int, ranges: int = 1) -> tuple[int, int]:
    """(m, w) for k-mers: minimizers of m bases, at most w k-mers in a run of 32 bases.

    There are 4 ** m / 2 minimizers, of which each range gets at least ``RANGE_MINIMIZERS`` if k allows it.
    """
    if not 3 <= k <= 31:
        raise ValueError("k must be from 3 to 31")
    w = min(33 - k, max(1, k - 5))
    while w > 1 and 4 ** (k - w + 1) < 2 * RANGE_MINIMIZERS * ranges:
        w -= 1
    return k - w + 1, w


def cut_runs(codes: np.ndarray, k: int, ranges: int, label: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bases, k-mers, place, range) of each run of flat codes; of one label, if each place has one."""
    m, w = shape(k, ranges)
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int32)
    ok = P.windows_ok(codes, k)
    wide = np.uint32 if m <= 16 else _U
    small = np.minimum(P.pack(codes, m, wide), P.pack_rc(codes, m, wide))
    if m > 16:
        small = (small ^ (small >> _U(29))) * _U(0x9E3779B97F4A7C15) >> _U(32)
    low = P.slide_min(P.mix32(small.astype(np.uint32)), w)
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | ~ok[:-1]
    if label is not None:
        new[1:] |= label[1:n] != label[: n - 1]
    new &= ok
    at = np.arange(n)
    start = np.maximum.accumulate(np.where(new, at, 0))
    new = ok & ((at - start) % w == 0)
    starts = np.flatnonzero(new)
    size = (np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True)) - starts + 1).astype(np.uint8)
    bases = P.pack(np.concatenate([codes, np.zeros(31, np.uint8)]), 32)[starts]
    bases &= ~_U(0) << (_U(64) - _U(2) * (size.astype(_U) + _U(k - 1)))
    part = ((P.mix32(low[starts] ^ np.uint32(0x5BD1E995)).astype(_U) * _U(ranges)) >> _U(32)).astype(np.int32)
    return bases, size, starts, part


def _planes(x: np.ndarray) -> bytes:
    """Numbers by byte plane, highest first: sorted runs then compress well."""
    return np.ascontiguousarray(x.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes()


#: Columns of a block: the range, its runs, their sizes, labels and counts. No labels: all 0; no counts: all 1.
BLOCK = {"part": "int", "bases": "binary", "sizes": "binary", "labels": "binary", "counts": "binary"}


def blocks(bases: np.ndarray, size: np.ndarray, label: np.ndarray, part: np.ndarray) -> list[tuple]:
    """The rows of ``BLOCK`` for these runs, one a range; equal runs are combined."""
    order = np.lexsort((label, bases)) if label.any() else np.argsort(bases)
    bases, size, label, part = bases[order], size[order], label[order], part[order]
    at = np.flatnonzero(np.append(True, (bases[1:] != bases[:-1]) | (size[1:] != size[:-1]) | (label[1:] != label[:-1]))) if len(bases) else np.zeros(0, np.int64)
    count = np.diff(np.append(at, len(bases))).astype(np.uint32)
    bases, size, label, part = bases[at], size[at], label[at].astype(np.uint32), part[at]
    order = np.argsort(part, kind="stable")
    bases, size, label, part, count = bases[order], size[order], label[order], part[order], count[order]
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else []
    return [(int(part[a]), _planes(bases[a:b]), size[a:b].tobytes(), label[a:b].tobytes() if label[a:b].any() else b"", count[a:b].tobytes() if (count[a:b] > 1).any() else b"") for a, b in zip(cuts[:-1], cuts[1:])]


class Counter:
    """Counts k-mers by label out of the blocks of a range, in sorted runs of bounded size."""

    def __init__(self, k: int):
        self.k, self.held, self.terms, self.runs = k, [], 0, []

    def add(self, bases: bytes, sizes: bytes, labels: bytes, counts: bytes, names: np.ndarray | None = None) -> None:
        """A block; names gives the labels' numbers among all blocks, where they differ."""
        size = np.frombuffer(sizes, np.uint8)
        b = np.ascontiguousarray(np.frombuffer(bases, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(_U)
        label = np.frombuffer(labels, np.uint32).astype(np.int64) if labels else np.zeros(len(size), np.int64)
        n = np.frombuffer(counts, np.uint32).astype(np.int64) if counts else np.ones(len(size), np.int64)
        self.held.append((b, size, label if names is None else names[label], n))
        self.terms += int(size.sum())
        if self.terms >= RUN_TERMS:
            self._run()

    def _run(self) -> None:
        bases, size, label, n = (np.concatenate(x) for x in zip(*self.held))
        self.held.clear()
        self.terms = 0
        entry = np.repeat(np.arange(len(size)), size)
        j = np.arange(len(entry)) - np.repeat(np.cumsum(size, dtype=np.int64) - size, size)
        x = (bases[entry] >> (_U(64 - 2 * self.k) - _U(2) * j.astype(_U))) & _U((1 << 2 * self.k) - 1)
        x = np.minimum(x, P.rc_packed(x, self.k))
        self.runs.append(self._combined(x, label[entry], None if (n == 1).all() else n[entry]))
        if len(self.runs) > 1 and sum(len(r[0]) for r in self.runs) > 2 * RUN_TERMS:
            self._merge()

    def _merge(self) -> None:
        self.runs = [self._combined(*(np.concatenate(x) for x in zip(*self.runs)))]

    def _combined(self, x: np.ndarray, label: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct k-mers and labels with their summed counts; n None: one each."""
        bits = int(label.max()).bit_length() if len(label) else 0
        if 2 * self.k + bits <= 64:
            key = (x << _U(bits)) | label.astype(_U) if bits else x
            if n is None:
                key = np.sort(key)
            else:
                order = np.argsort(key)
                key, n = key[order], n[order]
            at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            x, label = key[at] >> _U(bits), (key[at] & _U((1 << bits) - 1)).astype(np.int64)
        else:
            order = np.lexsort((label, x))
            x, label, n = x[order], label[order], None if n is None else n[order]
            at = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (label[1:] != label[:-1])))
            key, x, label = x, x[at], label[at]
        total = np.diff(np.append(at, len(key))) if n is None else np.add.reduceat(n, at) if len(at) else n
        return x, label, total

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(k-mer, label, count), sorted by k-mer and label."""
        if self.held:
            self._run()
        if len(self.runs) > 1:
            self._merge()
        return self.runs[0] if self.runs else (np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64))
