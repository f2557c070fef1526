"""Contigs from read pairs: a de Bruijn graph, its tips removed and its unbranched ways joined, all as Spark jobs.

K-mers are packed numbers (two bits a base, at most 31 bases); letters are written only for the contigs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import packed as P
from readloom.functions.seqs import reverse_complement
from readloom.operators.kmers import packed_counts, pair_text, unpacked
from readloom.plans import compact
from readloom.session import cut


def solid_kmers(reads: DataFrame, k: int, min_count: int) -> DataFrame:
    """``(x, n)``: canonical k-mers seen at least ``min_count`` times."""
    return packed_counts(reads, k, None, at_least=min_count).select("x", "n")


def _strands(k: int):
    def strands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            r = P.rc_packed(x.astype(np.uint64), k).astype(np.int64)
            two = r != x
            yield pa.RecordBatch.from_arrays([pa.array(np.append(x, r[two])), pa.array(np.append(r, x[two])), pa.array(np.append(n, n[two]))], ["x", "r", "n"])

    return strands


def _nodes(solid: DataFrame, k: int) -> DataFrame:
    """``(x, r, n)``: each k-mer on both strands, with its reverse complement r."""
    return solid.select("x", "n").mapInArrow(_strands(k), "x bigint, r bigint, n bigint")


def _junctions(nodes: DataFrame, k: int) -> DataFrame:
    """``(j, n_in, n_out, a, b, rb)``: for each (k-1)-mer, the nodes that end and begin with it."""
    none = F.lit(None).cast("bigint")
    ends = nodes.select(F.col("x").bitwiseAND((1 << 2 * (k - 1)) - 1).alias("j"), F.col("x").alias("a"), none.alias("b"), none.alias("rb"))
    begins = nodes.select(F.shiftright("x", 2).alias("j"), none.alias("a"), F.col("x").alias("b"), F.col("r").alias("rb"))
    return ends.unionByName(begins).groupBy("j").agg(F.count("a").alias("n_in"), F.count("b").alias("n_out"), F.max("a").alias("a"), F.max("b").alias("b"), F.max("rb").alias("rb"))


def _ways(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(x, head, dist)``: each node's place on its unbranched way, by pointer doubling; a circle begins at its smallest node.

    A round is one join of the nodes that have not found their head yet; there are about log2 of the longest way.
    """
    start = cut(nodes.select("x").join(links.select(F.col("b").alias("x"), F.col("a").alias("up")), "x", "left"))
    settled = start.where("up is null").select("x", F.col("x").alias("head"), F.lit(0).alias("dist"))
    active = start.where("up is not null").select("x", F.col("up").alias("head"), F.lit(1).alias("dist"), F.least("x", "up").alias("low"))
    left, rounds = active.count(), 0
    limit = max(1, left).bit_length() + 1
    while left and rounds < limit:
        rounds += 1
        target = settled.select(F.col("x").alias("t"), F.col("head").alias("h2"), F.col("dist").alias("d2"), F.col("x").alias("low2"), F.lit(True).alias("done")).unionByName(active.select(F.col("x").alias("t"), F.col("head").alias("h2"), F.col("dist").alias("d2"), F.col("low").alias("low2"), F.lit(False).alias("done")))
        moved = cut(active.join(target, active["head"] == target["t"]).select("x", F.col("h2").alias("head"), (F.col("dist") + F.col("d2")).alias("dist"), F.least("low", "low2").alias("low"), "done"))
        settled = settled.unionByName(moved.where("done").select("x", "head", "dist"))
        active = moved.where("not done").drop("done")
        before, left = left, active.count()
        if left == before:  # no way is longer than what the rounds have seen: the rest are circles
            limit = min(limit, max(rounds, left.bit_length() + 1))
    if left:  # circles: every node has seen the smallest one; open them there
        circle = active.select("x", "low")
        opened = links.join(circle.select(F.col("x").alias("b"), "low"), "b").where("b != low").select("a", "b")
        return settled.unionByName(_ways(opened, circle.select("x")))
    return settled


def _joined(solid: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The ways of the graph ``(head, seq, multiplicity, dead_ends)`` and the nodes on them ``(x, head)``."""
    nodes = cut(_nodes(solid, k))
    meet = cut(_junctions(nodes, k))
    links = meet.where("n_in = 1 and n_out = 1 and a != b and a != rb").select("a", "b")
    placed = cut(_ways(links, nodes).join(nodes.select("x", "n"), "x"))
    way = placed.groupBy("head").agg(F.array_sort(F.collect_list(F.struct("dist", F.substring(F.lit("ACGT"), F.col("x").bitwiseAND(3).cast("int") + 1, F.lit(1)).alias("c")))).alias("steps"), F.avg("n").alias("multiplicity"), F.max_by("x", "dist").alias("tail"))
    seqs = way.select("head", F.concat(F.substring(unpacked(F.col("head"), k), 1, k - 1), F.array_join(F.transform("steps", lambda s: s["c"]), "")).alias("seq"), "multiplicity", F.shiftright("head", 2).alias("first"), F.col("tail").bitwiseAND((1 << 2 * (k - 1)) - 1).alias("last"))
    ended = seqs.join(meet.select(F.col("j").alias("first"), "n_in"), "first").join(meet.select(F.col("j").alias("last"), "n_out"), "last")
    dead = (F.col("n_in") == 0).cast("int") + (F.col("n_out") == 0).cast("int")
    return cut(ended.select("head", "seq", "multiplicity", dead.alias("dead_ends"))), placed.select("x", "head")


def _one_strand(ways: DataFrame) -> DataFrame:
    one = F.least("seq", reverse_complement(F.col("seq")))
    return ways.groupBy(one.alias("seq")).agg(F.max("multiplicity").alias("multiplicity"), F.max("dead_ends").alias("dead_ends"))


def unitigs(solid: DataFrame, k: int) -> DataFrame:
    """``(seq, multiplicity, dead_ends)``: the unbranched ways, one strand of each.

    Nodes are k-mers on either strand; two are joined where one alone ends and one alone begins with their common
    k-1 letters. dead_ends counts the ends that no k-mer continues.
    """
    return _one_strand(_joined(solid, k)[0])


def _joined_ways(reads: DataFrame, k: int, min_count: int, tip_rounds: int) -> DataFrame:
    """The ways without tips where k is even, so that k-mers may be their own other strand."""
    solid = cut(solid_kmers(reads, k, min_count))
    ways, placed = _joined(solid, k)
    for _ in range(tip_rounds):
        tips = ways.where((F.length("seq") < 2 * k) & (F.col("dead_ends") == 1)).select("head")
        if tips.isEmpty():
            break
        # a way and its other strand are both tips, so both strands' k-mers are among the bad ones
        solid = cut(solid.join(placed.join(tips, "head", "left_semi").select("x"), "x", "left_anti"))
        ways, placed = _joined(solid, k)
    return ways


def assemble(reads: DataFrame, *, k: int = 31, min_count: int = 2, min_contig_len: int = 200, tip_rounds: int = 1) -> DataFrame:
    """``(idx, id, seq, multiplicity)``: contigs in the order of length and letters.

    A tip is a way shorter than 2k that ends dead on one side: reading errors make them; their k-mers are
    taken out and the rest is joined again. Stretches of reads are shuffled once, by their minimizers.
    """
    dead_ends = (F.col("l") == compact.DEAD).cast("int") + (F.col("r") == compact.DEAD).cast("int")
    if k % 2 and k > 3:
        ways = compact.ways(reads.select(pair_text().alias("t")), k, min_count)
        for _ in range(tip_rounds):
            tip = (F.length("seq") < 2 * k) & (dead_ends == 1)
            if ways.where(tip).isEmpty():
                break
            ways = compact.rejoined(ways.where(~tip), k)
        ways = ways.select("seq", (F.col("total") / (F.length("seq") - k + 1)).alias("multiplicity"), dead_ends.alias("dead_ends"))
    else:
        ways = _joined_ways(reads, k, min_count, tip_rounds)
    kept = cut(_one_strand(ways).where(F.length("seq") >= min_contig_len))
    letters = kept.agg(F.sum(F.length("seq"))).first()[0] or 0
    # sorted ranges number their rows upwards, so the numbers follow the order without one task seeing all; the driver gets
    # a sample of what ranges are made by, so that is the length and a first k-mer, not whole contigs
    ranges = kept.repartitionByRange(max(1, -(-letters // compact.TASK_LETTERS)), F.desc(F.length("seq")), F.substring("seq", 1, k))
    ordered = ranges.sortWithinPartitions(F.desc(F.length("seq")), "seq").withColumn("idx", F.monotonically_increasing_id())
    return cut(ordered.select("idx", F.concat(F.lit("contig"), F.col("idx") + 1).alias("id"), "seq", "multiplicity"))
