"""Which contigs hold which seeds, on either strand."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions import packed as P
from readloom.functions.seqs import clean_seq, kmers, reverse_complement, reverse_complement_iupac
from readloom.session import cut

#: Different beginnings of patterns up to which they go to every task, so that only contigs that may hold one are joined.
BEGINNINGS = 1_000_000


def seed_patterns(seeds: DataFrame) -> DataFrame:
    """``(pattern, orientation, seed_idx)``: each seed and its reverse complement; of equal patterns the last seed's stands, a palindrome is forward."""
    rows = seeds.where("seq is not null").select(F.col("idx").alias("seed_idx"), clean_seq("seq").alias("f")).where("length(f) > 0").withColumn("r", reverse_complement(F.col("f")))
    both = rows.select("seed_idx", F.col("f").alias("pattern"), F.lit(1).alias("orientation")).unionByName(rows.where("r != f").select("seed_idx", F.col("r").alias("pattern"), F.lit(-1).alias("orientation")))
    return both.groupBy("pattern").agg(F.max(F.struct("seed_idx", "orientation")).alias("x")).select("pattern", "x.orientation", "x.seed_idx")


def _maybe(a: int, beginnings: np.ndarray):
    """Of ``(id, c)`` the rows that hold one of the beginnings of a letters, all but A, C, G and T taken for A; rows of other signs stay."""
    size = 1 << max(10, (16 * len(beginnings)).bit_length())
    slot = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)
    table = np.zeros(size, bool)
    table[slot(beginnings)] = True

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, offsets = P.flat(batch.column(1))
            x = P.pack(codes, a)
            at = np.flatnonzero(table[slot(x)])
            near = np.minimum(np.searchsorted(beginnings, x[at]), len(beginnings) - 1)
            keep = ~pc.string_is_ascii(batch.column(1)).to_numpy(zero_copy_only=False)
            keep[np.searchsorted(offsets, at[beginnings[near] == x[at]], side="right") - 1] = True
            yield batch.filter(pa.array(keep))

    return maybe


def seed_hits(contigs: DataFrame, seeds: DataFrame, *, id_col: str = "idx") -> DataFrame:
    """``(id, pos, size, orientation, seed_idx)``: every place (from 0) where a contig holds a seed pattern.

    The join is on each pattern's first letters, as many as the shortest pattern has, up to 31; only ids and places are
    joined, and the contigs' letters come to the places that are left, where the whole pattern is compared.
    """
    patterns = seed_patterns(seeds)
    shortest = patterns.agg(F.min(F.length("pattern"))).first()[0]
    rows = contigs.where("seq is not null").select(F.col(id_col).alias("id"), clean_seq("seq").alias("c"))
    if shortest is None:
        return rows.select("id", F.lit(0).alias("pos"), F.lit(0).alias("size"), F.lit(1).alias("orientation"), F.lit(0).alias("seed_idx")).limit(0)
    a = min(shortest, 31)
    few = patterns.select(F.substring("pattern", 1, a)).distinct().limit(BEGINNINGS + 1).toArrow().column(0).combine_chunks()
    if len(few) <= BEGINNINGS and pc.all(pc.string_is_ascii(few)).as_py():
        codes, offsets = P.flat(few)
        rows = cut(rows.mapInArrow(_maybe(a, np.unique(P.pack(codes, a)[offsets[:-1]])), rows.schema))
    at = rows.select("id", F.posexplode(kmers(F.col("c"), a)).alias("pos", "anchor"))
    keyed = patterns.withColumn("anchor", F.substring("pattern", 1, a))
    met = at.join(keyed, "anchor").drop("anchor").join(rows, "id")
    hit = met.where(F.substring(F.col("c"), F.col("pos") + 1, F.length("pattern")) == F.col("pattern"))
    return hit.select("id", "pos", F.length("pattern").alias("size"), "orientation", "seed_idx")


def seed_containment(contigs: DataFrame, seeds: DataFrame, *, id_col: str = "idx") -> DataFrame:
    """``(id, orientation)`` of each contig that holds a seed: the match that ends first decides, of those the longest."""
    w = Window.partitionBy("id").orderBy(F.col("pos") + F.col("size"), F.desc("size"), "seed_idx")
    return seed_hits(contigs, seeds, id_col=id_col).withColumn("n", F.row_number().over(w)).where("n = 1").select("id", "orientation")


def oriented(contigs: DataFrame, found: DataFrame, *, id_col: str = "idx") -> DataFrame:
    """The contigs of ``found (id, orientation)``, those of orientation -1 reverse-complemented."""
    rows = contigs.join(found.withColumnRenamed("id", id_col), id_col)
    return rows.withColumn("seq", F.when(F.col("orientation") < 0, reverse_complement_iupac("seq")).otherwise(F.col("seq")))


def seed_positions(contigs: DataFrame, seeds: DataFrame, *, id_col: str = "idx") -> DataFrame:
    """``(id, pos)``: every place of a contig that a seed or its reverse complement covers."""
    hits = seed_hits(contigs, seeds, id_col=id_col)
    return hits.select("id", F.explode(F.sequence("pos", F.col("pos") + F.col("size") - 1)).alias("pos")).distinct()
