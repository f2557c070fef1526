"""Error-tolerant deduplication of read pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import packed as P
from readloom.functions.meet import PAIRS, PARTS, _gathered, blocks, meeting, mix, packed_texts, unpacked_texts
from readloom.functions.seqs import bare, canonical, clean_seq, kmers
from readloom.operators.components import connected_components
from readloom.session import cut, spread

#: Letters of padded mates that are compared at once, and longest k-mers whose hashes are looked up in a table.
CELLS, TABLE_K = 4_000_000, 9
#: Longest and shortest blocks of mates by which matches are looked for, letters of their anchors, of short mates' beginnings, and that one task brings together.
MAX_BLOCK, LEAST_BLOCK, BLOCK_K, START, TASK_LETTERS = 50, 20, 20, 8, 16_000_000
#: The key of a window without a k-mer.
NO_KMER = -1
#: Roots of a block in a large component, at least and at most; Spark limits windows to so many rows before they are shuffled.
LEAST_ROOTS, MAX_ROOTS = 16, 1_000
#: Steps whose tables one plan reads.
PLAN_STEPS = 50
#: Different minimizers up to which two are one 32-bit key, and keys that one task brings together.
MINIMIZERS, TASK_KEYS = 1 << 16, 2_000_000


@dataclass(frozen=True)
class DedupParams:
    max_offset: int = 1
    max_error_frac: float = 0.01
    tolerant: bool = True
    num_windows: int = 3
    window_len: int = 25
    kmer_len: int = 7
    #: Classes of a component up to which distances spread from all at once; beyond, from blocks of about max_component ** 2 / classes.
    max_component: int = 2_000

    def __post_init__(self):
        if self.kmer_len > self.window_len:
            raise ValueError(f"kmer_len {self.kmer_len} must be at most window_len {self.window_len}")


def minimizer(seq: Column, window: int, p: DedupParams) -> Column:
    """The smallest CRC-32 of the canonical k-mers of a window; ``NO_KMER`` if the window has none without N."""
    part = F.substring(seq, window * p.window_len + 1, p.window_len)
    hashes = F.transform(F.filter(kmers(part, p.kmer_len), lambda x: ~F.contains(x, F.lit("N"))), lambda x: F.crc32(canonical(x)))
    return F.coalesce(F.array_min(hashes), F.lit(NO_KMER).cast("bigint"))


def minimizers(seq: Column, p: DedupParams) -> Column:
    """The distinct minimizers of a sequence's windows."""
    return F.array_distinct(F.array(*(minimizer(seq, w, p) for w in range(p.num_windows))))


def bucket_keys(f: Column, r: Column, p: DedupParams) -> Column:
    """The distinct pairs of the mates' minimizers; tolerant: also turned round."""

    def pairs(a: Column, b: Column, turned: bool) -> Column:
        return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.struct((y if turned else x).alias("fh"), (x if turned else y).alias("rh")))))

    return F.array_union(pairs(f, r, False), pairs(f, r, True)) if p.tolerant else F.array_distinct(pairs(f, r, False))


@cache
def _word_hashes(k: int) -> np.ndarray:
    """The CRC-32 of the canonical form of every k-mer, by its packed number."""
    words = np.arange(4**k, dtype=np.uint64)
    least = P.unpack_strings(np.minimum(words, P.rc_packed(words, k)), k)
    return np.array([crc32(x.encode()) for x in least.to_pylist()], np.int64)


def _window_hashes(p: DedupParams):
    """``minimizer`` of each window of both mates, whole batches at once; the mates hold ACGTN only."""

    def least(mates: pa.Array) -> pa.Array:
        codes, offsets = P.flat(mates)
        k, n = p.kmer_len, len(mates)
        none = np.int64(1 << 40)
        ok = P.windows_ok(codes, k)
        hashes = np.append(np.where(ok, _word_hashes(k)[P.pack(codes, k).astype(np.int64)], none), none) if len(ok) else np.array([none])
        at = np.arange(p.num_windows * p.window_len)
        place = np.arange(p.window_len) <= p.window_len - k
        inside = np.tile(place, p.num_windows) & (at + k <= np.diff(offsets)[:, None])
        found = np.where(inside, hashes[np.minimum(offsets[:-1, None] + at, len(hashes) - 1)], none).reshape(n, p.num_windows, p.window_len).min(axis=2)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * p.num_windows), pa.array(np.where(found == none, NO_KMER, found).ravel()))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), least(batch.column(1)), least(batch.column(2))], ["class_id", "f", "r"])

    return hashes


def _alike(a: list[str], b: list[str], p: DedupParams) -> np.ndarray:
    """Whether a shift of at most ``max_offset``, each base of it counted as a mismatch, leaves few enough mismatches."""
    (x, nx), (y, ny) = P.cells(a), P.cells(b)
    out = np.zeros(len(a), bool)
    for o in range(-p.max_offset, p.max_offset + 1):
        left, right = x[:, max(0, o) :], y[:, max(0, -o) :]
        size, top = np.minimum(nx - max(0, o), ny - max(0, -o)), min(left.shape[1], right.shape[1])
        wrong = ((left[:, :top] != right[:, :top]) & (np.arange(top) < size[:, None])).sum(axis=1)
        out |= (size > 0) & ((abs(o) + wrong).astype(np.float64) <= p.max_error_frac * size)
    return out


def _matching(p: DedupParams):
    def matching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longest = max((pc.max(pc.binary_length(batch.column(i))).as_py() or 0 for i in range(2, 6)), default=0)
            step = max(1, CELLS // (longest + 1))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                af, ar, bf, br = (part.column(i).to_pylist() for i in range(2, 6))
                same = _alike(af, bf, p) & _alike(ar, br, p)
                if p.tolerant:
                    same |= _alike(af, br, p) & _alike(ar, bf, p)
                yield part.select(["a", "b"]).filter(pa.array(same))

    return matching


def read_classes(reads: DataFrame, p: DedupParams) -> DataFrame:
    """Reads with equal mates are one class ``(class_id, fwd, rev, n_reads)``; class_id is the smallest read_id."""
    rows = reads.where("read_id is not null").select("read_id", F.coalesce(clean_seq("fwd_seq"), F.lit("")).alias("fwd"), F.coalesce(clean_seq("rev_seq"), F.lit("")).alias("rev"))
    return rows.groupBy("fwd", "rev").agg(F.min("read_id").alias("class_id"), F.count_distinct("read_id").alias("n_reads"))


def class_hashes(classes: DataFrame, p: DedupParams) -> DataFrame:
    """``(class_id, f, r)``: the distinct minimizers of both mates. Classes with an empty mate match nothing and are left out."""
    able = classes.where("length(fwd) > 0 and length(rev) > 0")
    plain = F.lit(p.kmer_len <= TABLE_K) & ~F.col("fwd").rlike("[^ACGTN]") & ~F.col("rev").rlike("[^ACGTN]")
    start = [F.substring(m, 1, p.num_windows * p.window_len).alias(m) for m in ("fwd", "rev")]
    usual = able.where(plain).select("class_id", *start).mapInArrow(_window_hashes(p), "class_id string, f array<bigint>, r array<bigint>").select("class_id", F.array_distinct("f").alias("f"), F.array_distinct("r").alias("r"))
    return cut(usual.unionByName(able.where(~plain).select("class_id", minimizers(F.col("fwd"), p).alias("f"), minimizers(F.col("rev"), p).alias("r"))))


def bucket_members(classes: DataFrame, p: DedupParams) -> DataFrame:
    """``(class_id, fh, rh)``: the bucket keys of each class."""
    return class_hashes(classes, p).select("class_id", F.explode(bucket_keys(F.col("f"), F.col("r"), p)).alias("key")).select("class_id", "key.fh", "key.rh")


def dedup_candidates(classes: DataFrame, p: DedupParams, of: DataFrame | None = None) -> DataFrame:
    """``(a, b)`` with a < b: classes that share a bucket key; with ``of`` only those of which one at least is among these."""
    keys = bucket_members(classes, p)
    some = keys if of is None else keys.join(of.select("class_id"), "class_id", "left_semi")
    met = some.withColumnRenamed("class_id", "a").join(keys.withColumnRenamed("class_id", "b"), ["fh", "rh"])
    return met.where("a < b" if of is None else "a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _kind_keys(p: DedupParams, known: np.ndarray, parts: int):
    """Rows to meet of ``(f, r, n)``: each kind of class with each of its keys, of tolerant ones either way round; all minimizers as places in known.

    The key of two windows without a k-mer is left out: the kinds that have it are told by their z.
    """
    none = int(np.searchsorted(known, NO_KMER)) if NO_KMER in known else -1

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides, there = [], []
            for i in (0, 1):
                some = batch.column(i)
                size = pc.list_value_length(some).to_numpy(zero_copy_only=False)
                inside = np.arange(p.num_windows) < size[:, None]
                side = np.full(inside.shape, -1 - i, np.int64)  # what isn't there is never the same on both sides
                side[inside] = np.searchsorted(known, some.flatten().to_numpy(zero_copy_only=False))
                sides.append(side)
                there.append(inside)
            f, r = sides
            z = ((f == none).any(axis=1) & (r == none).any(axis=1)) if none >= 0 else np.zeros(len(f), bool)
            x, y = np.repeat(f, p.num_windows, axis=1), np.tile(r, (1, p.num_windows))
            low, high = (np.minimum(x, y), np.maximum(x, y)) if p.tolerant else (x, y)
            key = np.where((low >= 0) & ((low != none) | (high != none)), low << 16 | high, -1)
            # of equal keys the first counts
            for j in range(1, key.shape[1]):
                key[(key[:, :j] == key[:, j : j + 1]).any(axis=1), j] = -1
            row, j = np.nonzero(key >= 0)
            valid = ((key >= 0) << np.arange(key.shape[1])).sum(axis=1)
            n = batch.column(2).to_numpy(zero_copy_only=False)
            yield blocks(0, P.mix32(key[row, j].astype(np.uint32)), n[row], (valid << 1 | z)[row], (low == high)[row, j], *f[row].T, *r[row].T, parts=parts)

    return keys


def _kind_pairs(p: DedupParams):
    """``(buckets, shared, pairs)``: the keys of one task, and how many pairs of classes of different kinds meet at them, by the number of keys that they share."""
    w = p.num_windows

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (key, n, valid, same, *sides), _ = _gathered(batches, (3 + 2 * w, 0))
        order = np.argsort(key, kind="stable")
        key, n, z, valid, same = key[order], n[order], valid[order] & 1 > 0, valid[order] >> 1, same[order] > 0
        f, r = ([x[order].astype(np.int32) for x in part] for part in (sides[:w], sides[w:]))
        first = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
        found = np.zeros(w * w + 1, np.int64)
        others = np.searchsorted(key, key, side="right") - np.arange(len(key)) - 1
        total, at = np.cumsum(others), 0
        while at < len(key):
            until = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
            size = others[at:until]
            i = np.repeat(np.arange(at, until), size)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size)
            apart = ~(z[i] & z[j])
            i, j = i[apart], j[apart]
            one, two = ([x[i] for x in f], [x[i] for x in r]), ([x[j] for x in f], [x[j] for x in r])
            held = lambda x, some: reduce(np.logical_or, [x == y for y in some])
            straight = [[held(x, two[s]) for x in one[s]] for s in (0, 1)]
            turned = [[held(x, two[1 - s]) for x in one[s]] for s in (0, 1)] if p.tolerant else None
            shared = np.zeros(len(i), np.int64)
            mask = valid[i]
            for a in range(w):
                for b in range(w):
                    hit = straight[0][a] & straight[1][b]
                    if turned:
                        hit |= turned[0][a] & turned[1][b]
                    shared += hit & (mask >> (a * w + b) & 1 > 0)
            for c in np.unique(shared).tolist():
                found[c] += int((n[i] * n[j])[shared == c].sum())
            at = until
        buckets = np.zeros(len(found), np.int64)
        buckets[1] = np.where(same | (not p.tolerant), 1, 2)[first].sum()
        yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found)], ["buckets", "shared", "pairs"])

    return pairs


def comparisons(classes: DataFrame, p: DedupParams) -> DataFrame:
    """``(buckets, comparisons)``, one row: different bucket keys, and pairs of classes that share one.

    Classes of equal minimizers are one kind. Kinds that meet at a key are counted where they meet, by the number of keys that
    they share, so that no pair is written or told from others; the sums are divided by it.
    """
    kinds = cut(class_hashes(classes, p).groupBy(F.array_sort("f").alias("f"), F.array_sort("r").alias("r")).agg(F.count("*").alias("n")))
    known = kinds.select(F.explode(F.array_union("f", "r")).alias("h")).distinct().limit(MINIMIZERS + 1).toArrow().column(0).to_numpy()
    if len(known) > MINIMIZERS or p.num_windows > 4:
        return bucket_members(classes, p).agg(F.count_distinct("fh", "rh").alias("buckets")).join(dedup_candidates(classes, p).agg(F.count("*").alias("comparisons")))
    tasks = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-kinds.count() * p.num_windows**2 // TASK_KEYS))
    rows = spread(kinds).mapInArrow(_kind_keys(p, np.sort(known), tasks * PARTS), "part int, kind int, rows binary")
    met = rows.repartition(tasks, F.col("part")).mapInArrow(_kind_pairs(p), "buckets bigint, shared int, pairs bigint")
    met = met.groupBy("shared").agg(F.sum("buckets").alias("buckets"), F.sum("pairs").alias("pairs")).agg(F.coalesce(F.sum("buckets"), F.lit(0)).alias("b"), F.coalesce(F.sum(F.expr("case when shared > 0 then pairs div shared end")), F.lit(0)).alias("c"))
    none = F.array_contains("f", F.lit(NO_KMER).cast("bigint")) & F.array_contains("r", F.lit(NO_KMER).cast("bigint"))
    of = lambda n: F.expr(f"({n}) * (({n}) - 1) div 2")
    alike = kinds.agg(F.coalesce(F.sum(F.when(~none, of("n"))), F.lit(0)).alias("within"), F.coalesce(F.sum(F.when(none, F.col("n"))), F.lit(0)).alias("z"))
    return met.join(alike).select((F.col("b") + F.when(F.col("z") > 0, 1).otherwise(0)).alias("buckets"), (F.col("c") + F.col("within") + of("z")).alias("comparisons"))


def _block(p: DedupParams) -> int:
    """Letters of a block, so that two mates that match share one whole block without a mismatch for each that they may have, and one more."""
    return min(MAX_BLOCK, int(1 / (2 * p.max_error_frac) + 1e-9)) if p.max_error_frac > 0 else MAX_BLOCK


def _block_rows(p: DedupParams, parts: int, sizes: tuple[int, ...] = ()):
    """Rows to meet of ``(n, fwd, rev)``: for each pair of blocks of both mates their anchors; the others' shifted too, and turned round.

    An anchor is a block's least scattered k-mer. Of mates of n letters as many blocks count as mismatches may be, and one more.
    Mates shorter than a block match only what they begin or what begins them: the anchor is the start, of one of sizes letters, of all mates,
    as of a pair either class may have the shorter one.
    """
    size, k = _block(p), min(BLOCK_K, _block(p))
    u, w = np.uint64, size - min(BLOCK_K, _block(p)) + 1

    def least(mates: pa.Array, shifts: range) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) of the blocks of each mate, distinct."""
        codes, offsets = P.flat(mates)
        n = np.diff(offsets)
        low = P.slide_min(mix(P.pack(codes, k)), w) if len(codes) >= size else np.zeros(0, u)
        rows, found = [], []
        number = np.floor(p.max_error_frac * n + 1e-9).astype(np.int64) + 1
        for i in range(int(number.max(initial=0))):
            for d in shifts:
                at = i * size + d
                if at >= 0:
                    row = np.flatnonzero((i < number) & (at + size <= n))
                    rows.append(row)
                    found.append(low[offsets[row] + at])
        bad = np.concatenate([[0], np.cumsum(codes > 3)])
        # what has a k-mer in each window shares no minimizer with what has none
        lacks = (n < (p.num_windows - 1) * p.window_len + p.kmer_len) | (bad[offsets[1:]] > bad[offsets[:-1]])
        for s in sizes:
            row = np.flatnonzero((n >= s) & (lacks | (s >= p.kmer_len)))
            if len(row):
                rows.append(row)
                found.append(mix(P.pack(codes, s)[offsets[row]] ^ u(s << 56)))
        one = np.unique(np.rec.fromarrays([np.concatenate(rows), np.concatenate(found)])) if rows else np.rec.fromarrays([np.zeros(0, np.int64), np.zeros(0, u)])
        return one["f0"], one["f1"]

    def crossed(one: tuple, two: tuple) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of each anchor of one with each of the same row of two."""
        first, last = np.searchsorted(two[0], one[0]), np.searchsorted(two[0], one[0], side="right")
        n = last - first
        i = np.repeat(np.arange(len(n)), n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + first[i]
        return one[0][i], mix(one[1][i] ^ mix(two[1][j] + u(1))) >> u(32)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, shifts = batch.column(0).to_numpy(zero_copy_only=False), range(-p.max_offset, p.max_offset + 1)
            row, key = crossed(*(least(batch.column(i), range(1)) for i in (1, 2)))
            yield blocks(0, key, ids[row], parts=parts)
            f, r = (least(batch.column(i), shifts) for i in (1, 2))
            turned = [crossed(r, f)] if p.tolerant else []
            row, key = map(np.concatenate, zip(crossed(f, r), *turned))
            yield blocks(1, key, ids[row], parts=parts)

    return rows


def _two_ids(one: list[np.ndarray], two: list[np.ndarray]) -> dict[str, np.ndarray]:
    a, b = np.minimum(one[1], two[1]), np.maximum(one[1], two[1])
    both = np.unique(np.rec.fromarrays([a[a < b], b[a < b]]))
    return {"a": both["f0"], "b": both["f1"]}


def _sharing(p: DedupParams):
    """Of pairs, those that match and share a bucket key."""
    match, hashes = _matching(p), _window_hashes(p)

    def sharing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mates = [pa.array(unpacked_texts(batch.column(i)), pa.string()) for i in range(2, 6)]
            pairs = pa.RecordBatch.from_arrays([pa.array(np.arange(len(batch))), batch.column(1), *mates], ["a", "b", "af", "ar", "bf", "br"])
            alike = np.concatenate([np.zeros(0, np.int64), *(x.column(0).to_numpy(zero_copy_only=False) for x in match(iter([pairs])))]).astype(np.int64)
            found = [m.take(pa.array(alike)) for m in mates]
            first = [pc.utf8_slice_codeunits(m, 0, p.num_windows * p.window_len) for m in found]
            af, ar, bf, br = (np.array(x.flatten()).reshape(-1, p.num_windows) for i in (0, 2) for x in next(hashes(iter([pa.RecordBatch.from_arrays([pa.array(alike), first[i], first[i + 1]], ["n", "f", "r"])]))).columns[1:])
            shared = lambda x, y: (x[:, :, None] == y[:, None]).any(axis=(1, 2))
            keep = shared(af, bf) & shared(ar, br)
            if p.tolerant:
                keep |= shared(af, br) & shared(ar, bf)
            yield batch.select([0, 1]).take(pa.array(alike[keep]))

    return sharing


def _packed_mates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), packed_texts(batch.column(1)), packed_texts(batch.column(2))], ["n", "f", "r"])


def dedup_edges(classes: DataFrame, p: DedupParams) -> DataFrame:
    """``(a, b)`` with a < b: classes that share a bucket key and whose mates match, straight or (tolerant) turned round.

    Far fewer classes match than share a key, so those that match are found by whole blocks without a mismatch, and
    then held against their keys. Mates of letters other than ACGTN, and parameters that leave too short blocks, go by the keys.
    """
    able = cut(classes.where("length(fwd) > 0 and length(rev) > 0").select(F.monotonically_increasing_id().alias("n"), "class_id", "fwd", "rev"))
    plain = ~F.col("fwd").rlike("[^ACGTN]") & ~F.col("rev").rlike("[^ACGTN]")
    usual = (p.kmer_len <= TABLE_K) & (_block(p) >= LEAST_BLOCK)
    strange = able.where(~plain) if usual else able

    def side(s: str) -> DataFrame:
        return able.select(F.col("class_id").alias(s), F.col("fwd").alias(f"{s}f"), F.col("rev").alias(f"{s}r"))

    met = dedup_candidates(able, p, strange if usual else None).join(side("a"), "a").join(side("b"), "b") if not usual or not strange.isEmpty() else None
    others = met.select("a", "b", "af", "ar", "bf", "br").mapInArrow(_matching(p), "a string, b string") if met is not None else None
    if not usual:
        return others
    mates = able.where(plain).select("n", "fwd", "rev")
    shorter = F.least(F.length("fwd"), F.length("rev"))
    letters, *sizes = mates.agg(F.sum(F.length("fwd") + F.length("rev")), F.collect_set(F.when(shorter < _block(p), F.least(shorter, F.lit(START)))), F.max(F.when((F.length("fwd") < _block(p)) & (F.length("rev") < _block(p)), 1))).first()
    sizes = tuple(range(1, START + 1)) if sizes[1] or min(sizes[0], default=START) < START else (START,) if sizes[0] else ()
    tasks = max(1, -(-(letters or 0) // TASK_LETTERS))
    rows = spread(mates).mapInArrow(_block_rows(p, tasks * PARTS, sizes), "part int, kind int, rows binary")
    near = cut(meeting(rows, (1, 1), _two_ids, "a bigint, b bigint", tasks).distinct())
    held = cut(mates.mapInArrow(_packed_mates, "n bigint, f binary, r binary"))
    mate = lambda s: held.select(F.col("n").alias(s), F.col("f").alias(f"{s}f"), F.col("r").alias(f"{s}r"))
    fits = cut(near.join(mate("a"), "a").join(mate("b"), "b").select("a", "b", "af", "ar", "bf", "br").mapInArrow(_sharing(p), "a bigint, b bigint"))
    name = lambda i, s: able.select(F.col("n").alias(i), F.col("class_id").alias(s))
    named = fits.join(name("a", "x"), "a").join(name("b", "y"), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return named.unionByName(others) if others is not None else named


def _distances(starts: DataFrame, ways: DataFrame) -> DataFrame:
    """``(root, node, dist)`` of all that each node of starts reaches, one join a step."""
    done, fronts = [], [cut(starts.select(F.col("node").alias("root"), "node", F.lit(0).alias("dist")))]
    for d in count(1):
        step = fronts[-1].join(ways, fronts[-1]["node"] == ways["x"]).select("root", F.col("y").alias("node")).distinct()
        # ways lead both ways, so what is known of a step lies in the last two
        known = reduce(DataFrame.unionByName, fronts[-2:])
        front = cut(step.join(known, ["root", "node"], "left_anti").withColumn("dist", F.lit(d)))
        if front.isEmpty():
            break
        fronts.append(front)
        if len(fronts) > PLAN_STEPS:  # plans of very many tables are slow
            done, fronts = [cut(reduce(DataFrame.unionByName, done + fronts[:-2]))], fronts[-2:]
    return reduce(DataFrame.unionByName, done + fronts)


def eccentricities(edges: DataFrame, members: DataFrame, p: DedupParams, prefer: DataFrame | None = None) -> DataFrame:
    """``(node, ecc)``: each node's largest distance to a node of its component; members has node and component.

    Up to ``max_component`` classes distances spread from every node at once. In larger components they spread from
    blocks of nodes: a node at distance d of a root with eccentricity e has one of at least max(d, e - d) and at most
    e + d, and what cannot be the least any more drops out. The least eccentricity is exact there; nodes that dropped
    out get a lower bound, which is more. With prefer, ``(node, prefer)``, nodes that others of smaller prefer beat
    drop out too, so that the smallest (ecc, prefer) is exact; the others' are not smaller.
    """
    ways = cut(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct())
    size = cut(members.groupBy("component").agg(F.count("*").alias("n")))
    small = members.join(size.where(F.col("n") <= p.max_component), "component")
    exact = _distances(small, ways).groupBy(F.col("root").alias("node")).agg(F.max("dist").alias("ecc"))
    large = size.where(F.col("n") > p.max_component)
    if large.isEmpty():
        return exact
    degree = ways.groupBy(F.col("x").alias("node")).agg(F.count("*").alias("links"))
    nodes = members.join(large, "component").join(degree, "node")
    nodes = nodes.join(prefer, "node") if prefer is not None else nodes.withColumn("prefer", F.lit(0))
    everywhere = F.col("links") == F.col("n") - 1
    bounds = cut(nodes.withColumn("low", F.when(everywhere, 1).otherwise(2).cast("bigint")).withColumn("high", F.when(everywhere, 1).otherwise(F.col("n") - F.col("links"))))
    for turn in count():
        best = bounds.groupBy("component").agg(F.min(F.struct("high", "prefer")).alias("best"))
        left = bounds.join(best, "component").where((F.col("low") < F.col("high")) & (F.struct(F.col("low").alias("high"), "prefer") <= F.col("best")))
        # in turn the likeliest centres, which lower the upper bounds, and the farthest nodes, which raise the lower ones
        order = [F.col("high").desc(), F.col("low"), F.col("node")] if turn % 2 else [F.col("low"), F.col("prefer"), F.col("links").desc(), F.col("node")]
        block = left.withColumn("at", F.row_number().over(Window.partitionBy("component").orderBy(*order))).where(F.col("at") <= MAX_ROOTS)
        roots = cut(block.where(F.col("at") <= F.greatest(F.lit(LEAST_ROOTS), F.floor(F.lit(p.max_component**2) / F.col("n")))).select("node"))
        if roots.isEmpty():
            break
        reached = cut(_distances(roots, ways))
        ecc = reached.groupBy("root").agg(F.max("dist").alias("e"))
        told = reached.join(ecc, "root").groupBy("node").agg(F.max(F.greatest(F.col("dist"), F.col("e") - F.col("dist"))).alias("least"), F.min(F.col("e") + F.col("dist")).alias("most"))
        bounds = cut(bounds.join(told, "node", "left").withColumn("low", F.greatest("low", "least")).withColumn("high", F.least("high", "most")).drop("least", "most"))
    return exact.unionByName(bounds.select("node", F.col("low").cast("int").alias("ecc")))


def deduplicate(reads: DataFrame, p: DedupParams = DedupParams()) -> DataFrame:
    """``(read_id, exemplar_id, cluster_id, n_links)``, one row a read.

    The exemplar of a cluster is its most central read (least eccentricity), then of highest mean Phred, then
    longest, then of smallest read_id. Equal reads are compared once, as a class; n_links counts a class's links.
    """
    classes = cut(read_classes(reads, p))
    edges = cut(dedup_edges(classes, p))
    members = connected_components(edges)
    links = edges.select(F.col("a").alias("class_id")).unionByName(edges.select(F.col("b").alias("class_id"))).groupBy("class_id").agg(F.count("*").alias("n_links"))
    fwd, rev = (F.coalesce(clean_seq(c), F.lit("")) for c in ("fwd_seq", "rev_seq"))
    quals = F.concat(F.coalesce(bare("fwd_qual"), F.lit("")), F.coalesce(bare("rev_qual"), F.lit("")))
    # the sum of the character codes, without a loop over them in the plan's expressions
    codes = F.aggregate(F.transform(F.split(quals, ""), F.ascii), F.lit(0).cast("bigint"), lambda a, x: a + x)
    mean = F.when(F.length(quals) > 0, codes / F.length(quals) - 33).otherwise(F.lit(0.0))
    rows = reads.where("read_id is not null").select("read_id", fwd.alias("fwd"), rev.alias("rev"), mean.alias("q")).groupBy("read_id").agg(F.max("q").alias("q"), F.max("fwd").alias("fwd"), F.max("rev").alias("rev"))
    # of the reads of a class, which are equally central, the one that comes first
    first = rows.join(classes, ["fwd", "rev"]).groupBy(F.col("class_id").alias("node")).agg(F.min(F.struct((-F.col("q")).alias("q"), (-(F.length("fwd") + F.length("rev"))).alias("size"), "read_id")).alias("prefer"))
    ecc = eccentricities(edges, members, p, first)
    named = classes.join(members.withColumnsRenamed({"node": "class_id", "component": "cluster_id"}), "class_id", "left").join(ecc.withColumnRenamed("node", "class_id"), "class_id", "left").join(links, "class_id", "left")
    alone = (F.length("fwd") == 0) | (F.length("rev") == 0)
    rows = rows.join(named, ["fwd", "rev"]).select("read_id", "q", (F.length("fwd") + F.length("rev")).alias("size"), F.when(alone, F.col("read_id")).otherwise(F.coalesce("cluster_id", "class_id")).alias("cluster_id"), F.coalesce("ecc", F.lit(0)).alias("e"), F.greatest(F.coalesce("ecc", F.lit(0)), (F.col("n_reads") > 1).cast("int")).alias("ecc"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    best = rows.groupBy("cluster_id").agg(F.min(F.struct("ecc", (-F.col("q")).alias("q"), (-F.col("size")).alias("size"), "read_id")).alias("best"))
    return rows.join(best, "cluster_id").select("read_id", F.col("best.read_id").alias("exemplar_id"), "cluster_id", "n_links")


def dedup_summary(reads: DataFrame, p: DedupParams = DedupParams()) -> DataFrame:
    """``(reads, classes, buckets, comparisons, links, clusters)``, one row: what a dedup of these reads goes through."""
    classes = cut(read_classes(reads, p))
    edges = cut(dedup_edges(classes, p))
    found = connected_components(edges)
    n = lambda df, what, name: df.agg(what.alias(name))
    parts = [
        n(classes, F.coalesce(F.sum("n_reads"), F.lit(0)), "reads"), n(classes, F.count("*"), "classes"), comparisons(classes, p),
        n(edges, F.count("*"), "links"), n(found, F.count_distinct("component"), "clusters"),
    ]
    return reduce(lambda a, b: a.join(b), parts)
