"""Overlaps between sequences and what is connected to the seeds through them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import packed as P
from readloom.functions.meet import PARTS, blocks, meeting, mix, packed_texts, unpacked_texts
from readloom.functions.seqs import clean_seq
from readloom.operators.components import TASK_LINKS
from readloom.session import cut, spread

#: Rounds whose tables one plan reads.
PLAN_ROUNDS = 50
#: Rounds in which only the pairs of what was newly reached are compared, and sequences newly reached that are sent to the tasks; beyond, all pairs are.
NEAR_ROUNDS, NEAR = 4, 100_000
#: Letters that are compared at once.
CELLS = 4_000_000


#: Letters that one task brings together, and longest k-mers of which anchors are made.
TASK_LETTERS, ANCHOR_K = 8_000_000, 17
#: Periods of k-mers that repeat themselves, and windows of a front among which others are looked for.
PERIODS, WINDOWS = (1, 2, 3), 6
#: Letters on either side of an anchor that are compared where anchors meet, and their steps (texts that share no more than a stretch differ in
#: most letters around it); they travel as two bits each, above them the kind of anchor, a run's length and strand.
BESIDE, STEP = 12, 3
#: Letters on either side of a repetitive anchor in which breaks of its repeat are looked for.
REACH = 127
_SIDE, _KIND = (1 << 2 * BESIDE) - 1, (1 << 20) - 1
_OTHERS, _ODD, _RUN, _LONGEST, _TURNED = 5 << 16, 5 << 4 * BESIDE, 4 * BESIDE + 4, 1023, 1 << 62
_TURN = str.maketrans("ACGTNacgtn", "TGCANtgcan")


def _lengths(n0: int, n1: int) -> tuple[int, int, int, int]:
    """Half of n1, letters of a window, of the least overlap that anchors find, and of an anchor."""
    half = max(1, n1 // 2)
    window, least = (min(n0, half), n0) if n0 >= half else (half, n1)
    k = min(window, max(12, window // 2 + 2), ANCHOR_K)
    return half, window, least, k - (k > 1 and k % 2 == 0)  # of an odd length, so that none is its own reverse complement


def _letters(texts: pa.Array) -> np.ndarray:
    """The letters of ASCII texts, each ? (which may stand for any other letter) unlike those near it."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    letters = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.int16)
    return np.where(letters == ord("?"), 256 + np.arange(len(letters)) % 128, letters)


def _runs(letters: np.ndarray, offsets: np.ndarray, period: np.ndarray):
    """For the end of front o: of k-mers that lie in the repeat that this end of their text is, its letters; of others 0."""
    size, ends = np.diff(offsets), {1: np.zeros((max(PERIODS) + 1, len(offsets) - 1), np.int64)}
    ends[-1] = ends[1].copy()
    for d in PERIODS:
        breaks = np.concatenate([[-1], np.flatnonzero(letters[:-d] != letters[d:]), [len(letters)]])
        after, before = breaks[np.searchsorted(breaks, offsets[:-1])], breaks[np.searchsorted(breaks, offsets[1:] - d) - 1]
        ends[1][d], ends[-1][d] = np.minimum(after + d - offsets[:-1], size), np.minimum(offsets[1:] - before - 1, size)

    def run(o: int):
        def size_of(row: np.ndarray, i: np.ndarray, span: np.ndarray) -> np.ndarray:
            long = ends[o][period[i], row]
            return np.where(span <= long, long, 0)

        return size_of

    return run


def _beside(bases: np.ndarray, turned: np.ndarray, k: int):
    """Each third letter on either side of k-mers as their smaller strand has them: behind and before, the nearest first."""
    n, pad = len(bases), np.zeros(BESIDE * STEP, np.uint8)

    def packed(x: np.ndarray) -> np.ndarray:
        x = np.concatenate([x, pad]).astype(np.uint32)
        four = x[: n + 9 * STEP] << 6 | x[STEP : n + 10 * STEP] << 4 | x[2 * STEP : n + 11 * STEP] << 2 | x[3 * STEP :]
        return four[: n + 1] << 16 | four[4 * STEP : n + 1 + 4 * STEP] << 8 | four[8 * STEP : n + 1 + 8 * STEP]

    behind, before = ([packed(x) for x in (a, b)] for a, b in ((bases, turned), (bases[::-1], turned[::-1])))

    def letters(i: np.ndarray, turn: np.ndarray) -> np.ndarray:
        right, left = np.where(turn, before[1][n - i], behind[0][i + k]), np.where(turn, behind[1][i + k], before[0][n - i])
        return right.astype(np.int64) << 2 * BESIDE | left.astype(np.int64)

    return letters


def _unit(x: np.ndarray, r: np.ndarray, others: np.ndarray, k: int):
    """What tells repetitive k-mers apart, twice, so that it differs in two letters: their first four letters, and whether they hold other letters."""
    return lambda i: (np.minimum(x[i], r[i]) >> np.uint64(max(0, 2 * k - 8))).astype(np.int64) * 257 | np.where(others[i] > 0, _OTHERS, 0) | _ODD


def _breaks(letters: np.ndarray, period: np.ndarray, k: int):
    """Of repetitive k-mers, how far behind and before them the first two letters lie that break the repeat, up to ``REACH``."""

    def toward(i: np.ndarray, begin: int, step: int) -> list[np.ndarray]:
        out, far, rows = [], np.arange(REACH), max(1, CELLS // REACH)
        for at in range(0, len(i), rows):
            x, d = i[at : at + rows, None], period[i[at : at + rows], None]
            where = begin + step * far
            differ = letters[np.clip(x + where, 0, len(letters) - 1)] != letters[x + where % d]
            two = []
            for _ in range(2):
                first = differ.argmax(axis=1)
                two.append(np.where(differ[np.arange(len(first)), first], first, REACH))
                differ[np.arange(len(first)), first] = False
            out.append(two[0] << 7 | two[1])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def breaks(i: np.ndarray, o: int) -> np.ndarray:
        """Of strand o, those behind and then before; seven bits each, above what tells k-mers apart."""
        one, back = np.unique(i, return_inverse=True)
        behind, before = toward(one, k, 1), toward(one, -1, -1)
        return (behind << 14 | before if o > 0 else before << 14 | behind)[back] << 20

    return breaks


def _apart(back: np.ndarray, front: np.ndarray, behind: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Of pairs of repetitive k-mers, whether their breaks alone are two mismatches; behind, before: letters of the overlap."""
    mismatches = np.zeros(len(back), np.int8)
    for shift, letters in ((34, behind), (20, before)):
        end = np.minimum(letters, REACH)
        b, b_next, f, f_next = (x >> s & 127 for x in (back, front) for s in (shift + 7, shift))
        # where one breaks and the other does not; if both do at one place, nothing is known of it
        mismatches += (b != f) & (np.minimum(b, f) < end)
        x, y = np.where(b < f, b_next, np.where(b > f, b, b_next)), np.where(b > f, f_next, np.where(b < f, f, f_next))
        mismatches += (x != y) & (np.minimum(x, y) < end)
    return mismatches > 1


_FIRST = np.array([_SIDE ^ _SIDE >> 2 * i for i in range(BESIDE + 1)])


def _alike(n0: int, n1: int):
    """For ``meeting``, of backs and fronts the letters beside the anchors, and those of them that an overlap would hold."""
    k = _lengths(n0, n1)[-1]
    first = lambda n: _FIRST[np.clip((n + STEP - 1) // STEP, 0, BESIDE)]

    def backs(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        _, _, b, length, more = rows
        right = np.where(b & 1, b >> 1, length - k - (b >> 1))
        return more, _ODD | np.where(more & _ODD, _KIND, first(right) << 2 * BESIDE | first(length - k - right))

    def fronts(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        _, _, f, _, more = rows
        outer = first(f >> 2)
        return more, _ODD | np.where(more & _ODD, _KIND, np.where(f & 1, outer << 2 * BESIDE | _SIDE, _SIDE << 2 * BESIDE | outer))

    return backs, fronts


def _anchors(n0: int, n1: int, parts: int):
    """Rows to meet of ``(n, s)``: of each sequence the k-mers at its fronts and all that may stand there.

    A front is a window of half of n1 letters, at the start or behind the first half, on either strand; its anchor is the
    k-mer of the least scattered number. Whoever holds the window holds that k-mer as one that is the least of a window.
    Windows of nothing but a repeat (tails of one letter) would meet at every place; for overlaps that reach so far, later
    windows stand for them, and for shorter ones they meet by place too.

    Where a front begins with a repeat, or a back ends with one, an overlap within the repeat also holds with a period's
    letters less, down to the least length that its mismatches allow: only those lengths meet. Between a front's first
    repeat and a back's last one there is no other overlap, as each would bring its own mismatch.
    """
    half, window, least, k = _lengths(n0, n1)
    w = window - k + 1
    top, far = ~np.uint64(0), np.uint64(1 << 63)
    repeats = [d for d in PERIODS if k > 2 * max(PERIODS)]

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            if not pc.all(pc.string_is_ascii(texts)).as_py():
                texts = pc.replace_substring_regex(texts, "[^\\x00-\\x7f]", "?")
            codes, offsets = P.flat(texts)
            size = np.diff(offsets)
            if len(codes) < window:
                continue
            # other letters are read as A on both strands
            bases, turned = np.where(codes > 3, 0, codes).astype(np.uint8), np.where(codes > 3, 0, 3 - (codes & 3)).astype(np.uint8)
            x, r = P.pack(bases, k), P.pack(turned[::-1], k)[::-1]
            others = np.concatenate([[0], np.cumsum(codes > 3)])
            others = others[k:] - others[:-k]
            # never 0, which stands for no window
            scattered, flip = mix(np.minimum(x, r) ^ others.astype(np.uint64) << np.uint64(2 * ANCHOR_K)) >> np.uint64(1) | np.uint64(1), r < x
            # k-mers that repeat themselves come last, so that they are anchors only of windows of nothing else
            period = np.zeros(len(x), np.int8)
            for d in reversed(repeats):
                period[(x ^ x >> np.uint64(2 * d)) & np.uint64(4 ** (k - d) - 1) == 0] = d
            scattered |= np.where(period > 0, far, np.uint64(0))
            letters = _letters(texts)
            runs, breaks = _runs(letters, offsets, period), _breaks(letters, period, k)
            starts = np.arange(len(codes) - window + 1)
            owner = np.repeat(np.arange(len(size)), size)
            whole = starts + window <= offsets[1:][owner[: len(starts)]]
            low = P.slide_min(scattered, w)[: len(starts)]
            # a k-mer is the least of a window if the greatest of its windows' least is its own
            pad = np.full(w - 1, top)
            most = ~P.slide_min(np.concatenate([pad, np.where(whole, ~low, top), pad]), w)
            at = np.flatnonzero((most == scattered) & (most > 0))
            own = owner[at]
            place, length = at - offsets[own], size[own]
            plain = scattered[at] < far
            key = lambda i: scattered[i] >> np.uint64(31) & np.uint64(0xFFFFFFFF)
            # a repetitive k-mer meets only its like with as many letters behind it in the overlap; rest: with the turn and what it meets
            exact = lambda i, rest, turn, inner: mix(scattered[i] ^ mix((rest << 2 | turn << 1 | inner).astype(np.uint64))) >> np.uint64(32)
            beside, unit = _beside(bases, turned, k), _unit(x, r, others, k)
            cols, keys, fronts = (ids[own], place << 1 | flip[at], length), [key(at)], []
            keep, more = [plain], [np.where(plain, beside(at, flip[at]), 0)]
            for o, rest in ((1, place + k), (-1, length - place)):  # of front o, letters from the k-mer to the other strand's end
                found, from_two = _fronts(o, offsets, size)(scattered, flip, ids, key, exact, x == r, period, runs(o), beside, unit, breaks)
                fronts += found
                # the other end of this strand is a front too, which finds all overlaps of from_two letters on
                odd = ~plain & (rest < from_two[own])
                last, tell = runs(o)(own, at, rest), np.zeros(len(at), np.int64)
                tell[odd] = unit(at[odd]) | breaks(at[odd], -o) | np.minimum(last[odd], _LONGEST) << _RUN | (_TURNED if o > 0 else 0)
                for inner in (0, 1):  # in the last run, or before
                    keep.append(odd & (last == 0) if inner else odd)
                    keys.append(exact(at, rest, flip[at] ^ (o > 0), inner))
                    more.append(tell)
            yield blocks(0, np.concatenate([x[y] for x, y in zip(keys, keep)]), *(np.concatenate([c[y] for y in keep]) for c in cols), np.concatenate([x[y] for x, y in zip(more, keep)]), parts=parts)
            yield blocks(1, *map(np.concatenate, zip(*fronts)), parts=parts)

    def _fronts(o: int, offsets: np.ndarray, size: np.ndarray):
        def fronts(scattered, flip, ids, key, exact, either, period, run, beside, unit, breaks) -> tuple[list[tuple[np.ndarray, ...]], np.ndarray]:
            """Of each sequence's first windows two that don't repeat themselves, and the size from which these lie in an overlap; up to it also repetitive ones."""
            n, never = len(size), 1 << 40
            kmer, enough = np.zeros((n, WINDOWS), np.int64), np.full((n, WINDOWS), never)
            for j in range(WINDOWS):
                begin = j * half
                long = np.flatnonzero(size >= (max(n1, begin + window) if j else max(least, window)))
                first = offsets[long] + begin if o > 0 else offsets[long + 1] - begin - window
                kmer[long, j] = first + np.argmin(scattered[first[:, None] + np.arange(w)], axis=1)
                enough[long, j] = max(n1, begin + window) if j else max(least, window)
            there = enough < never
            plain = there & (scattered[kmer] < far)
            nth = np.cumsum(plain, axis=1)
            from_two, from_one = (np.where(plain & (nth == i), enough, never).min(axis=1) for i in (2, 1))
            odd = there & ~plain
            odd_nth = np.cumsum(odd, axis=1)
            out = []

            def add(row: np.ndarray, i: np.ndarray, sizes: np.ndarray | None) -> None:
                # one that is its own reverse complement (with other letters in its middle) stands either way
                row, i, sizes, again = (np.concatenate([v, v[either[i]]]) if v is not None else None for v in (row, i, sizes, np.zeros(len(i), bool)))
                again[len(again) - int(either[i].sum()) // 2 :] = True
                turn = flip[i] ^ (o < 0) ^ again
                place = i - offsets[row] if o > 0 else offsets[row + 1] - k - i
                if sizes is None:
                    out.append((key(i), ids[row], place << 2 | (o < 0) << 1 | turn, size[row], beside(i, flip[i] ^ again)))
                    return
                first = run(row, i, place + k)
                # within a first run only the least sizes count; beyond it, what ends with a run has no other
                small = np.zeros(len(i), bool)
                for begin in (least, n1):
                    small |= (sizes >= begin) & (sizes < begin + period[i])
                meets = (first == 0) | small | (sizes > first)
                inner = ((first > 0) & ~small).astype(np.int64)
                out.append(tuple(v[meets] for v in (exact(i, sizes - place, turn, inner), ids[row], place << 2 | (o < 0) << 1 | turn, size[row], unit(i) | breaks(i, o) | np.minimum(first, _LONGEST) << _RUN)))

            row, j = np.nonzero(plain & (nth <= 2))
            add(row, kmer[row, j], None)
            for i, end in ((1, from_two), (2, from_one)):
                row, j = np.nonzero(odd & (odd_nth == i))
                begin, end = enough[row, j], np.minimum(end[row], size[row] + 1)
                many = np.maximum(end - begin, 0)
                sizes = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin, many)
                add(np.repeat(row, many), np.repeat(kmer[row, j], many), sizes)
            return out, from_two

        return fronts

    def pairs(back: list[np.ndarray], front: list[np.ndarray]) -> dict[str, np.ndarray]:
        _, bid, b, b_len, *b_more = back
        _, fid, f, f_len, *f_more = front
        same = (b & 1) == (f & 1)
        place = np.where(same, b >> 1, b_len - k - (b >> 1))
        size = b_len - (place - (f >> 2))
        fits = (bid != fid) & (place >= f >> 2) & (size >= least) & (size <= f_len)
        back_o, front_o, other = np.where(same, 1, -1), np.where(f & 2, -1, 1), bid > fid
        sure = np.zeros(len(bid), bool)
        if b_more:
            # one run on both sides, which is an overlap without a mismatch: its least lengths are enough
            last, first = b_more[0], f_more[0]
            odd = (last & _ODD > 0) & (first & _ODD > 0) & ((last & _TURNED > 0) == ~same)
            both = np.where(odd, np.minimum(last >> _RUN & _LONGEST, first >> _RUN & _LONGEST), 0)
            sure = (size <= both) & (last & _OTHERS == 0)
            fits &= ~(odd & (last & _OTHERS == 0) & _apart(last, first, size - (f >> 2) - k, f >> 2))
            fits &= (both < least + max(PERIODS) - 1) | (size < least + max(PERIODS))
        # either end of an overlap may have found it; the smaller one's back is named
        bid, fid, back_o, front_o = np.where(other, fid, bid), np.where(other, bid, fid), np.where(other, -front_o, back_o), np.where(other, -back_o, front_o)
        return {"bid": bid[fits], "bo": back_o[fits].astype(np.int8), "fid": fid[fits], "fo": front_o[fits].astype(np.int8), "size": size[fits].astype(np.int32), "sure": sure[fits]}

    return anchors, pairs


def _ends(n0: int, n1: int, parts: int):
    """Rows to meet of ``(n, s)``: every front and every back of n0 to n1 - 1 letters, on either strand."""

    def hashed(text: str) -> int:
        return int.from_bytes(blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [], []
            for n, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for o, text in ((1, s), (-1, s[::-1].translate(_TURN))):
                    for size in range(n0, min(n1 - 1, len(s)) + 1):
                        found[0].append((hashed(text[-size:]), n, size << 1 | (o < 0)))
                        found[1].append((hashed(text[:size]), n, size << 1 | (o < 0)))
            for kind, rows in enumerate(found):
                if rows:
                    h, n, x = np.array(rows, np.int64).T
                    yield blocks(kind, h.view(np.uint64) >> np.uint64(32), n, x, parts=parts)

    def pairs(back: list[np.ndarray], front: list[np.ndarray]) -> dict[str, np.ndarray]:
        (_, bid, b), (_, fid, f) = back, front
        fits = (bid < fid) & (b >> 1 == f >> 1)
        return {"bid": bid[fits], "bo": np.where(b & 1, -1, 1)[fits].astype(np.int8), "fid": fid[fits], "fo": np.where(f & 1, -1, 1)[fits].astype(np.int8), "size": (b >> 1)[fits].astype(np.int32), "sure": np.zeros(int(fits.sum()), bool)}

    return ends, pairs


def _fitting(n1: int):
    """Of pairs, those that are sure, or whose suffix and prefix are equal or, from n1 letters on, differ at one place."""

    def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, turns = {x: unpacked_texts(batch.column(x)) for x in ("bs", "fs")}, {x: batch.column(x).to_pylist() for x in ("bo", "fo")}
            ways = {x: [s if o > 0 else s[::-1].translate(_TURN) for s, o in zip(texts[x], turns[y])] for x, y in (("bs", "bo"), ("fs", "fo"))}
            size = batch.column("size").to_pylist()
            suffix, prefix = [s[len(s) - n :] for s, n in zip(ways["bs"], size)], [s[:n] for s, n in zip(ways["fs"], size)]
            fits = np.fromiter((x == y for x, y in zip(suffix, prefix)), bool, len(size)) | np.array(batch.column("sure").to_pylist(), bool)
            step = max(1, CELLS // max(size, default=1))
            rest = [i for i in np.flatnonzero(~fits).tolist() if size[i] >= n1]
            for at in range(0, len(rest), step):
                part = rest[at : at + step]
                # side by side in one call, so that both have letters of one kind
                x, _ = P.cells([suffix[i] for i in part] + [prefix[i] for i in part])
                fits[part] = (x[: len(part)] != x[len(part) :]).sum(axis=1) == 1
            turn = pc.multiply(batch.column("bo"), batch.column("fo")).cast(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("bid"), batch.column("fid"), turn], ["bid", "fid", "turn"]).filter(pa.array(fits))

    return fitting


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], packed_texts(batch.column(2))], ["n", "id", "p"])


def _opened(rows):
    """``rows`` of ``(n, s)`` over packed texts."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return rows(pa.RecordBatch.from_arrays([b.column(0), pa.array(unpacked_texts(b.column(1)), pa.string())], ["n", "s"]) for b in batches)

    return opened


def _touching(front: np.ndarray):
    """Of pairs, those of which one is among the sorted front."""

    def touching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [front[np.minimum(np.searchsorted(front, n), len(front) - 1)] == n for n in (batch.column(x).to_numpy(zero_copy_only=False) for x in ("bid", "fid"))]
            yield batch.filter(pa.array(near[0] | near[1]))

    return touching


def overlap_edges(seqs: DataFrame, *, n0: int, n1: int, id_col: str = "idx", reached_from: DataFrame | None = None) -> DataFrame:
    """``(src, dst, orientation)`` with src < dst: a suffix of one is a prefix of the other.

    The overlap has at least ``n0`` letters without a mismatch, or at least ``n1`` with one. Orientation 1:
    as they stand (or both reversed); else -1, if one is reverse-complemented. Only sequences that share an
    anchor at the right place are compared: one of the two halves of a front's first ``n1`` letters is free of the one
    mismatch. Where ``n0`` is shorter than a half, fronts and backs of less than ``n1`` letters meet as a whole.
    With ``reached_from`` (id) the edges of all that these are connected to are there, others may be missing.
    """
    if not 1 <= n0 <= n1:
        raise ValueError("needs 1 <= n0 <= n1")
    numbered = seqs.where(F.col(id_col).isNotNull()).select(F.monotonically_increasing_id().alias("n"), F.col(id_col).alias("id"), clean_seq("seq").alias("s"))
    numbered = numbered.where(F.length("s") >= n0)
    base = cut(numbered.mapInArrow(_numbered, f"n bigint, id {numbered.schema['id'].dataType.simpleString()}, p binary"))
    letters = 4 * (base.agg(F.sum(F.length("p"))).first()[0] or 0)
    tasks = max(1, -(-letters // TASK_LETTERS))
    parts = tasks * PARTS
    found = []
    for make, columns, near in ((_anchors, (4, 4), _alike(n0, n1)), *([(_ends, (2, 2), None)] if n0 < max(1, n1 // 2) else [])):
        rows, pairs = make(n0, n1, parts)
        found.append(meeting(spread(base.select("n", "p")).mapInArrow(_opened(rows), "part int, kind int, rows binary"), columns, pairs, "bid bigint, bo tinyint, fid bigint, fo tinyint, size int, sure boolean", tasks, near))
    met = reduce(DataFrame.unionByName, found)
    side = lambda i, s: base.select(F.col("n").alias(i), F.col("p").alias(s))

    def fitting(pairs: DataFrame) -> DataFrame:
        # moved once by bid, for which they are both made distinct and joined
        both = pairs.repartition(F.col("bid")).distinct().join(side("bid", "bs"), "bid").join(side("fid", "fs"), "fid")
        return cut(both.mapInArrow(_fitting(n1), "bid bigint, fid bigint, turn int").groupBy("bid", "fid").agg(F.max("turn").alias("turn")))

    fits = fitting(met) if reached_from is None else _near(cut(met), base.join(reached_from.select("id").distinct(), "id").select("n"), fitting)
    name = lambda i, s: base.select(F.col("n").alias(i), F.col("id").alias(s))
    edges = fits.join(name("bid", "x"), "bid").join(name("fid", "y"), "fid").where("x != y")
    return edges.groupBy(F.least("x", "y").alias("src"), F.greatest("x", "y").alias("dst")).agg(F.max("turn").alias("orientation"))


def _near(met: DataFrame, front: DataFrame, fitting) -> DataFrame:
    """The pairs that fit of all that the front is connected to: those of what is newly reached, round by round, or all of them."""
    found, known = [], np.zeros(0, np.int64)
    for _ in range(NEAR_ROUNDS):
        new = front.limit(NEAR + 1).toArrow().column(0).to_numpy()
        if len(new) > NEAR:
            return fitting(met)
        new = np.setdiff1d(new, known)
        if not len(new):
            break
        known = np.union1d(known, new)
        found.append(fitting(met.mapInArrow(_touching(new), met.schema)))
        front = found[-1].select(F.explode(F.array("bid", "fid")).alias("n")).distinct()
    else:
        if front.limit(NEAR + 1).count() > NEAR or len(np.setdiff1d(front.toArrow().column(0).to_numpy(), known)):
            return fitting(met)
    return reduce(DataFrame.unionByName, found).distinct() if found else fitting(met.limit(0))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``seed_connected`` of the ways ``(a, b, turn)`` of one task; a root is a way to nowhere, turned as it stands."""
    ways, reached = defaultdict(list), {}
    for batch in batches:
        for a, b, turn in zip(*(c.to_pylist() for c in batch.columns)):
            if b is None:
                reached[a] = (turn, 0)
            else:
                ways[a].append((b, turn))
    kind = batch.schema.field(0).type if ways or reached else None
    front, depth = sorted(reached), 0
    while front:
        depth += 1
        new = {}
        for a in front:  # in order, so that the smallest parent comes first
            for b, turn in ways[a]:
                if b not in reached and b not in new:
                    new[b] = (reached[a][0] * turn, depth)
        reached |= new
        front = sorted(new)
    if reached:
        yield pa.RecordBatch.from_arrays([pa.array(list(reached), kind), *(pa.array([x[i] for x in reached.values()], pa.int32()) for i in (0, 1))], ["id", "orientation", "depth"])


def seed_connected(edges: DataFrame, roots: DataFrame, *, task_links: int = TASK_LINKS) -> DataFrame:
    """``(id, orientation, depth)`` of what the roots ``(id, orientation)`` reach; orientations multiply along the way.

    Breadth first, all roots at once: a sequence takes its first round's smallest parent, a root keeps its own
    orientation. Up to ``task_links`` links are walked by one task. Beyond, there is one join a round with the newly
    reached; rounds end when nothing is new, however many that takes.
    """
    ways = cut(edges.select(F.col("src").alias("a"), F.col("dst").alias("b"), "orientation").unionByName(edges.select(F.col("dst").alias("a"), F.col("src").alias("b"), "orientation")).withColumnRenamed("orientation", "turn"))
    reached = cut(roots.select("id", F.col("orientation").cast("int").alias("orientation"), F.lit(0).alias("depth")))
    if ways.count() + reached.count() <= task_links:
        kind = ways.schema["a"].dataType
        starts = reached.select(F.col("id").cast(kind).alias("a"), F.lit(None).cast(kind).alias("b"), F.col("orientation").alias("turn"))
        rows = ways.select("a", "b", F.col("turn").cast("int").alias("turn")).unionByName(starts)
        return cut(rows.coalesce(1).mapInArrow(_walk, f"id {kind.simpleString()}, orientation int, depth int"))
    done, fronts = [], [reached]
    for depth in count(1):
        front = fronts[-1]
        # what the front meets lies in its own round, the one before or the one behind
        known = reduce(DataFrame.unionByName, fronts[-2:]).select("id")
        step = front.join(ways, front["id"] == ways["a"]).select(F.col("b").alias("new_id"), "a", (F.col("orientation") * F.col("turn")).alias("o"))
        new = step.join(known, step["new_id"] == known["id"], "left_anti").groupBy("new_id").agg(F.min_by("o", "a").alias("o"))
        front = cut(new.select(F.col("new_id").alias("id"), F.col("o").cast("int").alias("orientation"), F.lit(depth).alias("depth")))
        if front.isEmpty():
            break
        fronts.append(front)
        if len(fronts) > PLAN_ROUNDS:  # plans of very many tables are slow
            done, fronts = [cut(reduce(DataFrame.unionByName, done + fronts[:-2]))], fronts[-2:]
    return reduce(DataFrame.unionByName, done + fronts)
