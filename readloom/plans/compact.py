"""The unbranched ways of a de Bruijn graph of odd k, joined where they lie.

Reads are cut between (k-1)-mers of different ranges of minimizers. A range gets every k-mer that begins or ends with one
of its (k-1)-mers, in one piece with its neighbours; it counts them, knows all that meets at its (k-1)-mers, and joins
ways there. Of a k-mer between two ranges both hold a copy, at which the pieces are glued.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import packed as P
from readloom.functions.meet import mix, packed_numbers, unpacked_numbers
from readloom.session import cut

#: Letters of minimizers; k-mers of a range and letters that one task glues; letters that are unpacked and counted at once.
MINIMIZER, RANGE_TERMS, TASK_LETTERS, CHUNK = 10, 3_000_000, 8_000_000, 4_000_000
#: How a piece ends: where several ways meet, where none goes on, within a k-mer of which another piece has a copy. Circles have no end.
OPEN, DEAD, GLUE, CIRCLE = range(4)
PIECE = "seq string, total bigint, l int, r int"
_U = np.uint64


def _range(low: np.ndarray, ranges: int) -> np.ndarray:
    return ((P.mix32(low ^ np.uint32(0x5BD1E995)).astype(_U) * _U(ranges)) >> _U(32)).astype(np.int32)


def _cut_reads(k: int, ranges: int):
    """``(part, rows)`` of texts: stretches of (k-1)-mers of one range, with a letter more where the read goes on."""
    m = min(MINIMIZER, k - 1)

    def cut_reads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, _ = P.flat(batch.column(0))
            ok = P.windows_ok(codes, k - 1)
            if not ok.any():
                continue
            small = np.minimum(P.pack(codes, m, np.uint32), P.pack_rc(codes, m, np.uint32))
            part = _range(P.slide_min(P.mix32(small), k - m), ranges)
            change = part[1:] != part[:-1]
            first = np.flatnonzero(ok & np.append(True, change | ~ok[:-1]))
            last = np.flatnonzero(ok & np.append(change | ~ok[1:], True))
            begin, end = first - ((first > 0) & ok[first - 1]), last + np.append(ok, False)[last + 1] + k - 1
            long = np.flatnonzero(end - begin >= k)
            long = long[np.argsort(part[first[long]], kind="stable")]
            begin, size, part = begin[long], (end - begin)[long], part[first[long]]
            quads = -(-size // 4)
            starts = np.concatenate([[0], np.cumsum(quads)])
            cells = np.zeros(int(starts[-1]) * 4, np.uint8)
            nth = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            cells[np.repeat(starts[:-1] * 4, size) + nth] = codes[np.repeat(begin, size) + nth]
            q = cells.reshape(-1, 4)
            data = (q[:, 0] << 6 | q[:, 1] << 4 | q[:, 2] << 2 | q[:, 3]).astype(np.uint8).tobytes()
            cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else []
            rows = [packed_numbers(size[a:b]) + data[starts[a] : starts[b]] for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([int(part[a]) for a in cuts[:-1]], pa.int32()), pa.array(rows, pa.binary())], ["part", "rows"])

    return cut_reads


class _Counts:
    """The k-mers of a range's stretches and their counts, in sorted runs of bounded size."""

    def __init__(self, k: int):
        self.k, self.held, self.letters, self.runs = k, [], 0, []

    def add(self, rows: pa.Scalar) -> None:
        data = memoryview(rows.as_buffer())
        (size,) = unpacked_numbers(data, 1)
        quads = int((-(-size // 4)).sum())
        self.held.append((size, np.frombuffer(data, np.uint8)[len(data) - quads :]))
        self.letters += 4 * quads
        if self.letters >= CHUNK:
            self._run()

    def _run(self) -> None:
        size, data = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.letters = [], 0
        codes = ((data[:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).ravel()
        quads, terms = -(-size // 4), size - self.k + 1
        at = np.repeat((np.cumsum(quads) - quads) * 4 - (np.cumsum(terms) - terms), terms) + np.arange(int(terms.sum()))
        x = np.sort(np.minimum(P.pack(codes, self.k), P.pack_rc(codes, self.k))[at])
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        self.runs.append((x[first], np.diff(np.append(first, len(x)))))
        if sum(len(r[0]) for r in self.runs[1:]) > 2 * CHUNK:
            self._merge()

    def _merge(self) -> None:
        x, n = (np.concatenate(c) for c in zip(*self.runs))
        order = np.argsort(x, kind="stable")
        x, n = x[order], n[order]
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        self.runs = [(x[first], np.add.reduceat(n, first))]

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if self.held:
            self._run()
        if len(self.runs) > 1:
            self._merge()
        return self.runs[0]


def _chains(partner: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Things with two ends each, 2i and 2i + 1, of which some are partners: the ends by which each open chain enters its
    things, one chain behind the other, where each chain begins, and the circles."""
    start = np.flatnonzero(partner < 0)
    walker, at, steps = np.arange(len(start)), start, []
    final = np.empty(len(start), np.int64)
    while len(at):
        steps.append((walker, at))
        to = partner[at ^ 1]
        over = to < 0
        final[walker[over]] = at[over] ^ 1
        walker, at = walker[~over], to[~over]
    walker, at = (np.concatenate(x) for x in zip(*steps)) if steps else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    seen = np.zeros(len(partner) // 2, bool)
    seen[at >> 1] = True
    one = start[walker] < final[walker]  # each chain is walked from both its ends
    walker, at = walker[one], at[one]
    order = np.argsort(walker, kind="stable")
    walker, at = walker[order], at[order]
    circles = []
    for i in np.flatnonzero(~seen).tolist():
        if not seen[i]:
            way, here = [], 2 * i
            while not way or here != way[0]:
                way.append(here)
                seen[here >> 1] = True
                here = int(partner[here ^ 1])
            circles.append(np.array(way))
    return at, np.flatnonzero(np.append(True, walker[1:] != walker[:-1])) if len(at) else np.zeros(0, np.int64), circles


def _opened(codes: np.ndarray, k: int) -> list[np.ndarray]:
    """Of a circle of ``len(codes) - k + 1`` k-mers both strands, each begun at its smallest k-mer."""
    n = len(codes) - k + 1
    return [s[(int(np.argmin(P.pack(s, k)[:n])) + np.arange(len(s))) % n] for s in (codes, (3 - codes[::-1]).astype(np.uint8))]


def _texts(codes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    letters = np.frombuffer(b"ACGT", np.uint8)[codes]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(letters.tobytes()))


def _pieces(codes: np.ndarray, sizes: np.ndarray, total: np.ndarray, left: np.ndarray, right: np.ndarray, circles: list[tuple[np.ndarray, int]], k: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``PIECE``; circles with the sum of their counts are opened."""
    rows = [(s, n) for c, n in circles for s in _opened(c, k)]
    sizes = np.append(sizes, [len(s) for s, _ in rows]).astype(np.int64)
    ends = [np.append(x, np.full(len(rows), CIRCLE)).astype(np.int32) for x in (left, right)]
    total = np.append(total, [n for _, n in rows]).astype(np.int64)
    codes = np.concatenate([codes, *(s for s, _ in rows)]).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    batch = pa.RecordBatch.from_arrays([_texts(codes, offsets).cast(pa.string()), pa.array(total), *map(pa.array, ends)], ["seq", "total", "l", "r"])
    yield from (batch.slice(at, 100_000) for at in range(0, len(batch), 100_000))


def _meets(junction: np.ndarray, turn: np.ndarray, palindrome: np.ndarray, thing: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(partner, dead) of each end that stands at a junction, coming in or (turn) going out.

    Ends are partners where one alone comes in and one alone goes out, of two things or of one that isn't alone a k-mer.
    """
    order = np.lexsort((turn, junction))
    j = junction[order]
    first = np.flatnonzero(np.append(True, j[1:] != j[:-1])) if len(j) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(j)))
    out = np.add.reduceat(turn[order].astype(np.int64), first) if len(j) else size
    two = first[(size == 2) & (out == 1)]
    a, b = order[two], order[two + 1]
    fits = ~palindrome[a] & ((thing[a] != thing[b]) | ~alone[a])
    partner = np.full(len(junction), -1)
    partner[a[fits]], partner[b[fits]] = b[fits], a[fits]
    dead = np.empty(len(junction), bool)
    dead[order] = np.repeat((out == 0) | (out == size), size)
    return partner, dead & ~palindrome


def _compacted(k: int, ranges: int, min_count: int):
    """``PIECE`` of one range's stretches."""
    m = min(MINIMIZER, k - 1)
    word, inner = _U((1 << 2 * m) - 1), _U((1 << 2 * (k - 1)) - 1)

    def joined(part: int, x: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        r = P.rc_packed(x, k)
        lows = [np.full(len(x), 0xFFFFFFFF, np.uint32) for _ in range(2)]
        for t in range(k - m + 1):
            h = P.mix32(np.minimum(x >> _U(2 * (k - m - t)) & word, r >> _U(2 * t) & word).astype(np.uint32))
            for side in (0, 1):
                if t != (k - m, 0)[side]:
                    np.minimum(lows[side], h, out=lows[side])
        owned = np.stack([_range(low, ranges) == part for low in lows], axis=1).ravel()
        # where the k-mer begins and where it ends; on the other strand both the other way round
        here, there = np.stack([x >> _U(2), x & inner], axis=1).ravel(), np.stack([r & inner, r >> _U(2)], axis=1).ravel()
        at = np.flatnonzero(owned)
        out = (at & 1 == 0) ^ (there[at] < here[at])
        met, dead = _meets(np.minimum(here, there)[at], out, (here == there)[at], at >> 1, np.ones(len(at), bool))
        partner, end = np.full(2 * len(x), -1), np.full(2 * len(x), GLUE)
        partner[at] = np.where(met >= 0, at[met], -1)
        end[at] = np.where(dead, DEAD, OPEN)
        n = np.where(owned[::2], n, 0)  # of two copies one counts
        enter, begin, circles = _chains(partner)
        first = np.zeros(len(enter), bool)
        first[begin] = True
        letters = lambda e: np.where(e & 1, r[e >> 1], x[e >> 1])
        y, size = letters(enter), np.where(first, k, 1)
        until = np.cumsum(size)
        codes = np.empty(int(size.sum()), np.uint8)
        codes[until - 1] = y & _U(3)
        for t in range(k - 1):
            codes[until[begin] - k + t] = y[begin] >> _U(2 * (k - 1 - t)) & _U(3)
        last = np.append(begin[1:], len(enter))[: len(begin)] - 1
        turned = [(np.concatenate([(letters(c[:1]) >> _U(2 * (k - 1 - t)) & _U(3)).astype(np.uint8) for t in range(k - 1)] + [(letters(c) & _U(3)).astype(np.uint8)]), int(n[c >> 1].sum())) for c in circles]
        total = np.add.reduceat(n[enter >> 1], begin) if len(begin) else begin
        yield from _pieces(codes, np.add.reduceat(size, begin) if len(begin) else begin, total, end[enter[begin]], end[enter[last] ^ 1], turned, k)

    def compacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, _Counts] = {}
        for batch in batches:
            for part, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts.setdefault(part, _Counts(k)).add(rows)
        for part in list(counts):
            x, n = counts.pop(part).result()
            good = n >= min_count
            yield from joined(part, x[good], n[good])

    return compacted


def _ends_of(codes: np.ndarray, offsets: np.ndarray, v: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and last v letters of each text as they stand and on the other strand, two rows a text."""
    at = np.stack([offsets[:-1], offsets[1:] - v], axis=1).ravel()
    x = np.zeros(len(at), _U)
    for t in range(v):
        x = x << _U(2) | codes[at + t].astype(_U)
    return x, P.rc_packed(x, v)


def _keys(batch: pa.RecordBatch, v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, offsets, key of each end, whether it is to be glued)."""
    codes, offsets = P.flat(batch.column(0))
    ends = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)], axis=1).ravel()
    return codes, offsets, np.minimum(*_ends_of(codes, offsets, v)), ends == GLUE


def _routed(v: int, turn: int, tasks: int):
    """Each piece with the part of that of its ends whose key scatters lowest."""

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.array([turn + 1], np.uint64))[0]
        for batch in batches:
            _, _, key, glue = _keys(batch, v)
            h = np.where(glue, mix(key ^ salt), ~_U(0)).reshape(-1, 2).min(axis=1)
            part = ((mix(h) >> _U(32)) * _U(tasks)) >> _U(32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], [*batch.schema.names, "part"])

    return routed


def _glued(k: int, v: int):
    """``PIECE`` of one task's pieces, glued where v letters of both ends are the same."""

    def glued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for x in batches if len(x)]
        if not held:
            return
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        codes, offsets, key, glue = _keys(batch, v)
        n, end = batch.column(1).to_numpy(zero_copy_only=False), np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)], axis=1).ravel()
        at = np.flatnonzero(glue)
        at = at[np.argsort(key[at], kind="stable")]
        two = np.flatnonzero(key[at][1:] == key[at][:-1])
        partner = np.full(len(key), -1)
        partner[at[two]], partner[at[two + 1]] = at[two + 1], at[two]
        enter, begin, circles = _chains(partner)

        def laid(e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            skip, i = np.where(first, 0, v), e >> 1
            size = offsets[i + 1] - offsets[i] - skip
            nth = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - skip, size)
            back = np.repeat(e & 1 == 1, size)
            c = codes[np.where(back, np.repeat(offsets[i + 1] - 1, size) - nth, np.repeat(offsets[i], size) + nth)]
            return np.where(back, 3 - c, c).astype(np.uint8), size

        first = np.zeros(len(enter), bool)
        first[begin] = True
        out, size = laid(enter, first)
        last = np.append(begin[1:], len(enter))[: len(begin)] - 1
        turned = []
        for c in circles:
            text, _ = laid(c, np.arange(len(c)) == 0)
            turned.append((text[: len(text) - v + k - 1], int(n[c >> 1].sum())))
        some = len(begin) > 0
        yield from _pieces(out, np.add.reduceat(size, begin) if some else begin, np.add.reduceat(n[enter >> 1], begin) if some else begin, end[enter[begin]], end[enter[last] ^ 1], turned, k)

    return glued


def _whole(pieces: DataFrame, k: int, v: int) -> DataFrame:
    """The pieces glued at all ends that are to be glued; in each round one task has the neighbours of a third of them at least."""
    done = []
    for turn in count():
        done.append(pieces.where(f"l <> {GLUE} and r <> {GLUE}"))
        rest = pieces.where(f"l = {GLUE} or r = {GLUE}")
        letters = rest.agg(F.sum(F.length("seq"))).first()[0]
        if not letters:
            return reduce(DataFrame.unionByName, done)
        tasks = math.ceil(letters / TASK_LETTERS)
        near = rest.mapInArrow(_routed(v, turn, tasks), f"{PIECE}, part int").repartition(tasks, "part").drop("part") if tasks > 1 else rest.coalesce(1)
        pieces = cut(near.mapInArrow(_glued(k, v), PIECE))


def ways(texts: DataFrame, k: int, min_count: int) -> DataFrame:
    """``PIECE``: the unbranched ways of the k-mers that the texts hold at least min_count times; of a circle both strands."""
    n = texts.agg(F.sum(F.length("t"))).first()[0] or 0
    ranges = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / RANGE_TERMS))
    rows = texts.mapInArrow(_cut_reads(k, ranges), "part int, rows binary")
    return _whole(cut(rows.repartitionById(ranges, F.col("part")).mapInArrow(_compacted(k, ranges, min_count), PIECE)), k, k)


def _fates(k: int):
    """``(n, l, r)``: how the open ends of ways that meet go on, null for the other end; of ``(junction, out, palindrome, n, side, alone)``."""

    def fates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [x for x in batches if len(x)]
        if not held:
            return
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        junction, out, palindrome, n, side, alone = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        partner, dead = _meets(junction, out, palindrome, n, alone)
        fate = np.where(partner >= 0, GLUE, np.where(dead, DEAD, OPEN)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(3), *(pa.array(fate, mask=side != s) for s in (0, 1))], ["n", "l", "r"])

    return fates


def _met(k: int):
    """The open ends of ``(n, seq, l, r)``, as ``_fates`` takes them."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, offsets = P.flat(batch.column(1))
            here, there = _ends_of(codes, offsets, k - 1)
            at = np.flatnonzero(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)], axis=1).ravel() == OPEN)
            out = (at & 1 == 0) ^ (there[at] < here[at])
            n, alone = batch.column(0).to_numpy(zero_copy_only=False)[at >> 1], (np.diff(offsets) == k)[at >> 1]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(here, there)[at].astype(np.int64)), pa.array(out), pa.array((here == there)[at]), pa.array(n), pa.array((at & 1).astype(np.int32)), pa.array(alone)], ["junction", "out", "palindrome", "n", "side", "alone"])

    return met


def rejoined(kept: DataFrame, k: int) -> DataFrame:
    """The ways ``PIECE`` that are left when others were taken out, joined where they don't branch any more."""
    named = cut(kept.withColumn("n", F.monotonically_increasing_id()))
    ends = named.select("n", "seq", "l", "r").mapInArrow(_met(k), "junction bigint, out boolean, palindrome boolean, n bigint, side int, alone boolean")
    tasks = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fate = ends.repartition(tasks, "junction").mapInArrow(_fates(k), "n bigint, fl int, fr int").groupBy("n").agg(F.max("fl").alias("fl"), F.max("fr").alias("fr"))
    told = named.join(fate, "n", "left").select("seq", "total", F.coalesce("fl", "l").alias("l"), F.coalesce("fr", "r").alias("r"))
    return _whole(cut(told), k, k - 1)
