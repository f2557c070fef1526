"""K-mer counting and the k-mer joins between reads and query sequences."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions import packed as P
from readloom.functions import runs as R
from readloom.functions.seqs import canonical, canonical_kmers, clean_seq, kmers
from readloom.session import cut

#: Query k-mers that are sent to every task at most (8 bytes each); beyond that the k-mers are joined.
BROADCAST_KMERS = 4_000_000


def query_kmers(seqs: DataFrame, k: int) -> DataFrame:
    """``(idx, pos, kmer)``: every window of every sequence, repeats kept, no folding of strands or case."""
    return seqs.where(F.length("seq") >= k).select("idx", F.posexplode(kmers(F.col("seq"), k)).alias("pos", "kmer"))


def _canonical(seqs: DataFrame, k: int) -> DataFrame:
    return seqs.select(F.explode(canonical_kmers(clean_seq("seq"), k)).alias("kmer"))


def canonical_set(seqs: DataFrame, k: int) -> DataFrame:
    """``(kmer)``: the distinct canonical k-mers of the sequences, without those that hold N."""
    return _canonical(seqs, k).distinct()


def prepare_query(contigs: DataFrame, k: int, *, warm_start: DataFrame | None = None, adapters: DataFrame | None = None) -> DataFrame:
    """The canonical k-mers to search with: contigs and, in a first round, warm start; adapter k-mers taken out."""
    seqs = contigs.select("seq")
    if warm_start is not None:
        seqs = seqs.unionByName(warm_start.select("seq"))
    found = _canonical(seqs, k)
    return (found if adapters is None else found.join(_canonical(adapters, k), "kmer", "left_anti")).distinct()


def sanitized_query_kmers(seqs: DataFrame, adapters: DataFrame, k: int) -> DataFrame:
    """``query_kmers`` without those that an adapter holds on either strand."""
    rows = query_kmers(seqs, k).withColumn("c", canonical(F.upper("kmer")))
    return rows.join(canonical_set(adapters, k).withColumnRenamed("kmer", "c"), "c", "left_anti").drop("c")


def pair_text() -> Column:
    """Both mates with a letter that no k-mer holds between and behind them."""
    return F.concat_ws("N", F.coalesce(clean_seq("fwd_seq"), F.lit("")), F.coalesce(clean_seq("rev_seq"), F.lit("")), F.lit(""))


def _blocks(k: int, ranges: int, keyed: bool):
    """The runs of each batch's k-mers in blocks by range; keyed: labelled by the batch's first column, whose values go along."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, offsets = P.flat(batch.column(batch.num_columns - 1))
            bases, size, at, part = R.cut_runs(codes, k, ranges)
            label, names = np.zeros(len(at), np.int64), pa.array([None], pa.string())
            if keyed:
                values = batch.column(0).dictionary_encode(null_encoding="encode")
                names = values.dictionary
                label = values.indices.to_numpy(zero_copy_only=False)[np.searchsorted(offsets, at, side="right") - 1].astype(np.int64)
            rows, held, ends = R.blocks(bases, size, label, part), [names.slice(0, 0)], [0]
            for i, (number, b, sizes, labels, counts) in enumerate(rows):  # each block's own values, numbered anew
                own, label = np.unique(np.frombuffer(labels, np.uint32), return_inverse=True) if labels else (np.zeros(1, np.int64), np.zeros(0, np.int64))
                rows[i] = (number, b, sizes, label.astype(np.uint32).tobytes() if len(own) > 1 else b"", counts)
                held.append(names.take(pa.array(own)))
                ends.append(ends[-1] + len(own))
            cols = list(zip(*rows)) or [[]] * len(R.BLOCK)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(held))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:]), lists], [*R.BLOCK, "names"])

    return out


def _counted(k: int, at_least: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, known = R.Counter(k), {}
        for batch in batches:
            for bases, sizes, labels, counts, names in zip(*(batch.column(i).to_pylist() for i in range(1, 6))):
                counter.add(bases, sizes, labels, counts, np.array([known.setdefault(x, len(known)) for x in names], np.int64))
        x, label, n = counter.result()
        good = np.flatnonzero(n >= at_least)
        every = pa.array(list(known), pa.string())
        for a in range(0, len(good), 1_000_000):
            g = good[a : a + 1_000_000]
            yield pa.RecordBatch.from_arrays([every.take(pa.array(label[g])), pa.array(x[g].astype(np.int64)), pa.array(n[g])], ["by", "x", "n"])

    return counted


#: Bases that one look-up turns into letters.
LOOKUP = 6


def unpacked(x: Column, k: int) -> Column:
    """The letters of packed k-mers, a few bases at a time from a constant list of all their words."""
    words = F.split(F.lit(",".join(map("".join, product("ACGT", repeat=LOOKUP)))), ",")
    parts, done = [], 0
    while done < k:
        size = min(LOOKUP, k - done)
        done += size
        code = F.shiftright(x, 2 * (k - done)).bitwiseAND((1 << (2 * size)) - 1).cast("int")
        parts.append(F.substring(F.get(words, code), LOOKUP - size + 1, size) if size < LOOKUP else F.get(words, code))
    return F.concat(*parts)


def packed_counts(reads: DataFrame, k: int, by: str | None, *, at_least: int = 1) -> DataFrame:
    """``kmer_counts`` of at least ``at_least`` with k-mers as numbers: ``(by, x, n)``; by is null if there is none."""
    R.shape(k)
    spark = reads.sparkSession
    text = pair_text()
    n = reads.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / R.RANGE_TERMS))
    rows = reads.select(*([F.col(by).alias("by")] if by else []), text.alias("t"))
    blocks = rows.mapInArrow(_blocks(k, ranges, bool(by)), ", ".join(f"{c} {t}" for c, t in R.BLOCK.items()) + ", names array<string>")
    return blocks.repartitionById(ranges, F.col("part")).mapInArrow(_counted(k, at_least), "by string, x bigint, n bigint")


def kmer_counts(reads: DataFrame, k: int, *, by: str | None = "source") -> DataFrame:
    """Canonical k-mer counts over both mates: ``(by, kmer, n)``; k-mers with letters outside ACGT are none.

    Neighbouring k-mers travel as one number of two bits a base, already counted within each batch of reads
    (``readloom.functions.runs``); letters are written only for the result.
    """
    return packed_counts(reads, k, by).select(*([F.col("by").alias(by)] if by else []), unpacked(F.col("x"), k).alias("kmer"), "n")


def saturation(min_count: int) -> int:
    """Where a counter of ``min_count`` or more stops: the power of two from twice that on."""
    return 1 << (2 * min_count - 1).bit_length()


def high_freq_kmers(reads: DataFrame, k: int, *, min_count: int = 2000) -> DataFrame:
    """``(kmer, max_count)``: k-mers that some file holds at least ``min_count`` times; counts saturate, the largest file's stands."""
    counts = packed_counts(reads.where("source is not null"), k, "source", at_least=min_count)
    most = counts.groupBy("x").agg(F.least(F.max("n"), F.lit(saturation(min_count))).alias("max_count"))
    return most.select(unpacked(F.col("x"), k).alias("kmer"), "max_count")


def _hits(k: int, wanted: np.ndarray):
    """Adds to each batch whether its last column's text (mates with a separator) holds a wanted k-mer."""
    size = 1 << max(10, (16 * len(wanted)).bit_length())
    table = np.zeros(size, bool)
    table[_slot(wanted, size)] = True

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, offsets = P.flat(batch.column(batch.num_columns - 1))
            hit = np.zeros(len(batch), bool)
            at = np.flatnonzero(P.windows_ok(codes, k))
            if len(at) and len(wanted):
                kmer = np.minimum(P.pack(codes, k), P.pack_rc(codes, k))[at]
                maybe = np.flatnonzero(table[_slot(kmer, size)])
                near = np.minimum(np.searchsorted(wanted, kmer[maybe]), len(wanted) - 1)
                sure = at[maybe[wanted[near] == kmer[maybe]]]
                hit[np.searchsorted(offsets, sure, side="right") - 1] = True
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hit)], [*batch.schema.names[:-1], "hit"])

    return hits


def _slot(kmer: np.ndarray, size: int) -> np.ndarray:
    return ((kmer * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def _pack_kmers(kmer: Column, k: int) -> Column:
    digits = F.translate(kmer, "ACGT", "0123")
    return F.conv(digits, 4, 10).cast("decimal(20,0)").cast("bigint")


def mark_reads(reads: DataFrame, wanted: DataFrame, k: int, *, limit: int = BROADCAST_KMERS) -> DataFrame:
    """``reads`` with ``hit``: whether either mate holds one of the canonical k-mers of ``wanted``.

    Up to ``limit`` k-mers (no more than one beyond are fetched) go to every task as packed numbers, and reads are not shuffled.
    Beyond, the reads' k-mers are joined with them, on the pair's key ``(source, ordinal, read_id)``.
    """
    if k > 31:
        raise ValueError("k must be at most 31")
    few = wanted.select(_pack_kmers(F.col("kmer"), k).alias("x")).limit(limit + 1).toArrow()
    if few.num_rows <= limit:
        rows = few.column("x").to_numpy()
        schema = ", ".join(f"`{c}` {t}" for c, t in reads.dtypes) + ", hit boolean"
        return reads.select("*", pair_text().alias("_text")).mapInArrow(_hits(k, np.sort(rows.astype(np.uint64))), schema)
    wanted = cut(wanted.select("kmer"))
    keyed = reads.withColumn("_row", F.struct("source", "ordinal", "read_id"))
    found = keyed.select("_row", F.explode(F.array_union(canonical_kmers(clean_seq("fwd_seq"), k), canonical_kmers(clean_seq("rev_seq"), k))).alias("kmer")).join(wanted.select("kmer"), "kmer", "left_semi").select("_row").distinct().withColumn("hit", F.lit(True))
    return keyed.join(found.withColumnRenamed("_row", "_hit_row"), F.col("_row").eqNullSafe(F.col("_hit_row")), "left").withColumn("hit", F.coalesce("hit", F.lit(False))).drop("_row", "_hit_row")


def read_filter(reads: DataFrame, wanted: DataFrame, k: int, **options) -> DataFrame:
    """Read pairs of which either mate holds a wanted k-mer."""
    return mark_reads(reads, wanted, k, **options).where("hit").drop("hit")


def read_anti_filter(reads: DataFrame, wanted: DataFrame, k: int, **options) -> DataFrame:
    """Read pairs of which neither mate holds a wanted k-mer."""
    return mark_reads(reads, wanted, k, **options).where("not hit").drop("hit")


def exceeds(reads: DataFrame, threshold: int) -> bool:
    """Whether there are more read pairs than ``threshold``; no more than one beyond are counted."""
    return reads.limit(threshold + 1).count() > threshold
