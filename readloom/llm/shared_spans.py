"""Long exact spans shared between records (problem 5).

Compact windows. A sequence's tokens are its k-mers; each token has a min-hash. The Cartesian tree over
these hashes gives every window of ``span`` bases its smallest token, and all windows with the same one
form a compact window: one entry stands for a run of spans. Equal spans have the same smallest token, so
for verbatim spans one hash is enough and loses none. Entries go to the task of their token's hash with
the bases of their run; there the runs of one token are laid over each other at the token (the interval
join) and their spans are verified base by base, as packed numbers. No pair of records is ever formed: equal spans
become neighbours of a sort, whose groups are then read off.

Equal sequences are one entry with the smallest and largest read_id, so a sequence that fills a third of
all rows costs one. A token that very many different sequences share would fill one task: the load of each task is
counted first, and the spans of overloaded ones are grouped by all their bases instead, by Spark.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import packed as P
from readloom.llm.common import mates
from readloom.session import cut

#: Bases of a token.
TOKEN = 15
#: Spans that one entry stands for at most.
RUN = 31
#: Entries that a map task holds before it sends blocks, and spans that a range is meant to hold.
BLOCK_ENTRIES = 400_000
RANGE_SPANS = 3_000_000
#: Entries whose bases are unpacked at once.
CHUNK_ENTRIES = 20_000
#: A range is overloaded from so many entries on, if they are also so many times the mean.
HOT_ENTRIES, HOT_TIMES = 500_000, 4
_U = np.uint64


def _compact_windows(codes: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first span start, number of spans, token start, token hash) of each compact window in flat codes."""
    n = len(codes) - span + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint32),)
    ok = P.windows_ok(codes, span)
    h = P.mix32(P.pack(codes, TOKEN, np.uint32))
    w = span - TOKEN + 1
    # the leftmost smallest token of each window: hash above, place below
    place = np.arange(len(h), dtype=_U)
    low = P.slide_min((h.astype(_U) << _U(32)) | place, w)[:n]
    token = (low & _U(0xFFFFFFFF)).astype(np.int64)
    new = ok.copy()
    new[1:] &= (token[1:] != token[:-1]) | ~ok[:-1]
    at = np.arange(n)
    start = np.maximum.accumulate(np.where(new, at, 0))
    new = ok & ((at - start) % RUN == 0)
    starts = np.flatnonzero(new)
    ends = np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True))
    return starts, ends - starts + 1, token[starts], (low[starts] >> _U(32)).astype(np.uint32)


def _wide(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """The bases at each start as ``width`` packed bytes, zero after ``sizes`` bases."""
    by_word = P.pack(np.concatenate([codes, np.zeros(4 * width + 32, np.uint8)]), 32)
    words = np.stack([by_word[starts + 32 * j] for j in range(math.ceil(width / 8))], axis=1)
    for j in range(words.shape[1]):
        left = np.clip(sizes - 32 * j, 0, 32).astype(_U)
        words[:, j] &= np.where(left > 0, ~_U(0) << ((_U(64) - _U(2) * left) & _U(63)), _U(0))
    return np.ascontiguousarray(words.astype(">u8")).view(np.uint8).reshape(len(starts), -1)[:, :width]


def _range(h: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each token hash. Smallest hashes are small; scattered again they fill the ranges evenly."""
    return ((P.mix32(h ^ np.uint32(0x5BD1E995)).astype(_U) * _U(ranges)) >> _U(32)).astype(np.int32)


def _loads(span: int, ranges: int) -> Callable:
    """How many entries each batch's texts have for each range; equal texts of a batch count once."""

    def loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = _compact_windows(P.flat(batch.column(0).unique())[0], span)[3]
            part, n = np.unique(_range(h, ranges), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(n)], ["part", "n"])

    return loads


def overloaded(texts: DataFrame, span: int, ranges: int) -> list[int]:
    """The ranges that get far more entries than the mean; at most one in ``HOT_TIMES`` of all. texts has text."""
    loads = texts.select("text").mapInArrow(_loads(span, ranges), "part int, n bigint").groupBy("part").agg(F.sum("n").alias("n"))
    loads = cut(loads)
    mean = (loads.agg(F.sum("n")).first()[0] or 0) / ranges
    return sorted(r[0] for r in loads.where(F.col("n") > max(HOT_ENTRIES, HOT_TIMES * mean)).select("part").collect())


def _blocks(span: int, ranges: int, hot: list[int]) -> Callable:
    width = math.ceil((span + RUN - 1) / 4)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def send() -> pa.RecordBatch:
            h, bases, size, off, first, key, owner = (np.concatenate(x) for x in zip(*held))
            held.clear()
            part = _range(h, ranges)
            order = np.lexsort((size, part))  # by size, so that the zeros behind short runs lie together
            part = part[order]
            first = first.astype(np.uint16 if first.max() < 1 << 16 else np.uint32)
            cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
            cols: list[list] = [[] for _ in range(7)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                i = order[a:b]
                cols[0].append(int(part[a]))
                for c, x in zip(cols[1:], (np.ascontiguousarray(bases[i].T), size[i], off[i], first[i], key[i], owner[i])):
                    c.append(x.tobytes())
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], ["part", "bases", "sizes", "offs", "firsts", "keys", "owners"])

        for batch in batches:
            codes, offsets = P.flat(batch.column(0))
            start, size, token, h = _compact_windows(codes, span)
            if hot:
                start, size, token, h = (x[~np.isin(_range(h, ranges), hot)] for x in (start, size, token, h))
            if len(start):
                text = np.searchsorted(offsets, start, side="right") - 1
                key = batch.column(1).to_numpy(zero_copy_only=False)
                owner = batch.column(2).to_numpy(zero_copy_only=False)
                held.append((h, _wide(codes, start, size + span - 1, width), size.astype(np.uint8), (token - start).astype(np.uint8 if span + RUN < 256 else np.uint32), (start - offsets[text]).astype(np.uint32), key[text], owner[text]))
                if sum(len(x[0]) for x in held) >= BLOCK_ENTRIES:
                    yield send()
        if held:
            yield send()

    return blocks


def _hot_spans(span: int, ranges: int, hot: list[int]) -> Callable:
    """Each span of the overloaded ranges on its own: its bases, packed, and where it stands."""
    width = math.ceil(span / 4)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, offsets = P.flat(batch.column(0))
            start, size, _, h = _compact_windows(codes, span)
            some = np.flatnonzero(np.isin(_range(h, ranges), hot))
            for a in range(0, len(some), 10_000):
                i = some[a : a + 10_000]
                at = np.repeat(start[i], size[i]) + np.arange(size[i].sum()) - np.repeat(np.cumsum(size[i]) - size[i], size[i])
                text = np.searchsorted(offsets, at, side="right") - 1
                bases = _wide(codes, at, np.full(len(at), span), width)
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(at), [None, pa.py_buffer(np.ascontiguousarray(bases).tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([packed, *(batch.column(c).take(pa.array(text)) for c in (1, 2)), pa.array((at - offsets[text]).astype(np.int64))], ["bases", "key", "owner", "start"])

    return spans


def _shared(span: int) -> Callable:
    """Of each range: the runs of spans that stand in more than one read, as (key, start, end) in bases."""
    width = math.ceil((span + RUN - 1) / 4)
    off_type = np.uint8 if span + RUN < 256 else np.uint32

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for bases, sizes, offs, firsts, keys, owners in zip(*(batch.column(i).to_pylist() for i in range(1, 7))):
                n = len(sizes)
                held.append((np.frombuffer(bases, np.uint8).reshape(width, n).T, np.frombuffer(sizes, np.uint8), np.frombuffer(offs, off_type), np.frombuffer(firsts, np.uint32 if len(firsts) == 4 * n else np.uint16).astype(np.uint32), np.frombuffer(keys, np.int64), np.frombuffer(owners, np.int64)))
        if not held:
            return
        bases, size, off, first, key, owner = (np.concatenate(x) for x in zip(*held))
        held.clear()
        # an entry of one read whose token no other entry has cannot share a span
        token = _token(bases, off)
        seen, back, times = np.unique(token, return_inverse=True, return_counts=True)
        some = np.flatnonzero((times[back] > 1) | (owner & 1 == 1))
        if not len(some):
            return
        bases, size, off, first, key, owner = (x[some] for x in (bases, size, off, first, key, owner))
        back = np.unique(back[some], return_inverse=True)[1]
        # whole tokens at a time, so that the expanded spans stay within the bound
        order = np.argsort(back, kind="stable")
        upto = np.cumsum(size[order].astype(np.int64))
        group_end = np.flatnonzero(np.append(back[order][1:] != back[order][:-1], True))
        a, done = 0, 0
        for e in group_end:
            if upto[e] - done >= RANGE_SPANS or e == group_end[-1]:
                i = order[a : e + 1]
                yield from _compare(bases[i], size[i], first[i], key[i], owner[i], span)
                a, done = e + 1, upto[e]

    return shared


def _token(bases: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The packed token of each entry."""
    out = np.zeros(len(off), _U)
    rows = np.arange(len(off))
    for j in range(TOKEN):
        at = off.astype(np.int64) + j
        out = (out << _U(2)) | ((bases[rows, at >> 2] >> (6 - 2 * (at & 3)).astype(np.uint8)) & 3).astype(_U)
    return out


def _compare(bases: np.ndarray, size: np.ndarray, first: np.ndarray, key: np.ndarray, owner: np.ndarray, span: int) -> Iterator[pa.RecordBatch]:
    entry, j = np.nonzero(np.arange(int(size.max()))[None, :] < size[:, None])
    # all bases of every span, as numbers of up to 32 bases; the last one may overlap the one before
    letters = 4 * bases.shape[1]
    k = min(span, 32)
    offsets = [*range(0, span - k, k), span - k]
    words = [np.empty(len(entry), _U) for _ in offsets]
    upto = np.searchsorted(entry, np.arange(0, len(size) + CHUNK_ENTRIES, CHUNK_ENTRIES))
    for number, (a, b) in enumerate(zip(upto[:-1], upto[1:])):
        some = bases[number * CHUNK_ENTRIES : (number + 1) * CHUNK_ENTRIES]
        flat = np.zeros(some.size * 4 + k, np.uint8)
        for i in range(4):
            flat[i : some.size * 4 : 4] = ((some >> np.uint8(6 - 2 * i)) & np.uint8(3)).ravel()
        packed = P.pack(flat, k)
        at = (entry[a:b] - number * CHUNK_ENTRIES) * letters + j[a:b]
        for w, o in zip(words, offsets):
            w[a:b] = packed[at + o]
    # spans whose first bases no other has can't be shared, but by equal texts of several reads
    order = np.argsort(words[0])
    tied = words[0][order][1:] == words[0][order][:-1]
    order = order[np.append(False, tied) | np.append(tied, False) | (owner[entry[order]] & 1 == 1)]
    if not len(order):
        return
    order = order[np.lexsort([w[order] for w in words])]
    words, entry, j = [w[order] for w in words], entry[order], j[order]
    new = np.append(True, np.logical_or.reduce([w[1:] != w[:-1] for w in words]))
    group = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    who = owner[entry]
    # a group stands in more than one read: two different owners, or one that is several reads (odd)
    many = (np.minimum.reduceat(who, at) != np.maximum.reduceat(who, at)) | (np.maximum.reduceat(who & 1, at) == 1)
    good = np.flatnonzero(many[group])
    if not len(good):
        return
    e, j = entry[good], j[good]
    order = np.lexsort((j, e))
    e, j = e[order], j[order]
    new = np.append(True, (e[1:] != e[:-1]) | (j[1:] != j[:-1] + 1))
    begin = np.flatnonzero(new)
    finish = np.append(begin[1:], len(e)) - 1
    start = first[e[begin]].astype(np.int64) + j[begin]
    end = first[e[begin]].astype(np.int64) + j[finish] + span
    yield pa.RecordBatch.from_arrays([pa.array(key[e[begin]]), pa.array(start), pa.array(end)], ["key", "start", "end"])


def shared_runs(texts: DataFrame, *, span: int = 50, ranges: int, hot: list[int] = ()) -> DataFrame:
    """``(key, start, end)`` in bases of runs of spans that stand in more than one record.

    ``texts`` has text, key and owner: owner is a number of the text's record without its lowest bit, which
    is set where the text belongs to several records. Runs of one text may overlap. ``hot`` lists the overloaded ranges.
    """
    if span < TOKEN:
        raise ValueError(f"span must be at least {TOKEN}")
    hot = list(hot)
    rows = texts.select("text", "key", "owner")
    blocks = rows.mapInArrow(_blocks(span, ranges, hot), "part int, bases binary, sizes binary, offs binary, firsts binary, keys binary, owners binary")
    runs = blocks.repartitionById(ranges, F.col("part")).mapInArrow(_shared(span), "key bigint, start bigint, end bigint")
    if not hot:
        return runs
    # Spark aggregates equal spans where they lie and splits what is skewed in the join
    spans = rows.mapInArrow(_hot_spans(span, ranges, hot), "bases binary, key bigint, owner bigint, start bigint")
    many = spans.groupBy("bases").agg(F.min("owner").alias("a"), F.max("owner").alias("b"), F.max(F.col("owner").bitwiseAND(1)).alias("several")).where("a != b or several = 1")
    return runs.unionByName(spans.join(many, "bases", "left_semi").select("key", "start", (F.col("start") + span).alias("end")))


def shared_spans(pairs: DataFrame, *, span: int = 50) -> DataFrame:
    """``(read_id, mate, shared_bases, shared_share)`` of each mate with bases in a span shared with another read.

    A span is at least ``span`` bases, verbatim, without letters outside ACGT, in either mate of a different
    read_id, as stored (not reverse-complemented). shared_bases counts each base once, however many others
    share it. Rows without a read_id belong to no record and are left out; null, empty and short sequences
    share nothing; repeated deliveries of a read are one record; a very long sequence is cut into runs, and only it
    and the list of its shared runs must fit a task. An empty table gives no rows. Texts and owners are told apart by
    64-bit hashes.
    """
    two = mates(pairs).select("read_id", F.explode(F.array(*(F.struct(F.lit(m).alias("mate"), F.col(m).alias("seq")) for m in ("fwd", "rev")))).alias("x")).select("read_id", "x.mate", "x.seq").where(F.length("seq") >= span)
    texts = two.groupBy("seq").agg(F.min("read_id").alias("a"), F.max("read_id").alias("b"))
    one = F.xxhash64("a").bitwiseAND(F.lit(-2))
    texts = texts.select(F.concat("seq", F.lit("N")).alias("text"), F.xxhash64("seq").alias("key"), F.when(F.col("a") == F.col("b"), one).otherwise(one.bitwiseOR(F.lit(1))).alias("owner"))
    bases = two.agg(F.coalesce(F.sum(F.length("seq") - span + 1), F.lit(0))).first()[0]
    ranges = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(bases / RANGE_SPANS))
    hot = overloaded(two.select(F.concat("seq", F.lit("N")).alias("text")), span, ranges)
    runs = shared_runs(texts, span=span, ranges=ranges, hot=hot)
    before = F.expr("aggregate(array_sort(collect_list(struct(start, end))), struct(0L AS n, 0L AS upto), (s, r) -> struct(s.n + greatest(0L, r.end - greatest(r.start, s.upto)) AS n, greatest(s.upto, r.end) AS upto)).n")
    held = runs.groupBy("key").agg(before.alias("shared_bases"))
    keyed = two.select("read_id", "mate", F.xxhash64("seq").alias("key"), F.length("seq").alias("size")).distinct()
    found = keyed.join(held, "key").groupBy("read_id", "mate").agg(F.max(F.struct("shared_bases", "size")).alias("x"))
    return found.select("read_id", "mate", "x.shared_bases", (F.col("x.shared_bases") / F.col("x.size")).alias("shared_share"))
