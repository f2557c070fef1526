"""Seeded assembly: search reads by the contigs' k-mers, assemble, keep what holds a seed, until nothing grows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.operators.containment import oriented, seed_containment
from readloom.operators.kmers import exceeds, prepare_query, read_anti_filter, read_filter
from readloom.operators.overlap import overlap_edges, seed_connected
from readloom.operators.trim import trim_reads
from readloom.plans.assemble import assemble
from readloom.session import cut
from readloom.sinks import write_fasta
from readloom.sources.fastq import FastqDataSource, read_fasta


@dataclass(frozen=True)
class LoopParams:
    read_k: int = 21
    freq_k: int = 21
    max_iters: int = 20
    excess_reads: int = 100_000
    overlaps: bool = False
    overlap_n0: int = 7
    overlap_n1: int = 31
    longest_more: int = 1
    total_more: int = 30
    #: (k, least count, least contig length), the strictest first.
    variants: tuple[tuple[int, int, int], ...] = ((31, 2, 200), (31, 1, 100))


def fasta_stats(seqs: DataFrame) -> tuple[int, int]:
    """(longest, total) length; zeros if there are none."""
    return tuple(seqs.agg(F.coalesce(F.max(F.length("seq")), F.lit(0)), F.coalesce(F.sum(F.length("seq")), F.lit(0))).first())


def subset_contigs(contigs: DataFrame, seeds: DataFrame, p: LoopParams) -> DataFrame:
    """The contigs that hold a seed and, if asked, what overlaps connect to them; turned so that seeds run forward."""
    found = seed_containment(contigs, seeds)
    if p.overlaps:
        found = seed_connected(overlap_edges(contigs, n0=p.overlap_n0, n1=p.overlap_n1), found).select("id", "orientation")
    return oriented(contigs, found)


def accepted(stats: tuple[int, int], now: tuple[int, int], p: LoopParams) -> bool:
    """Whether contigs of these (longest, total) lengths are progress."""
    return stats[0] >= now[0] + p.longest_more or (stats[0] == now[0] and stats[1] >= now[1] + p.total_more)


def grow_contigs(reads: DataFrame, seeds: DataFrame, p: LoopParams = LoopParams(), *, warm_start: DataFrame | None = None, adapters: DataFrame | None = None, high_freq: DataFrame | None = None) -> tuple[DataFrame, list[dict]]:
    """The last contigs ``(idx, seq)``, the seeds themselves if nothing grew, and the metrics of each round.

    Ends when a search finds more than ``excess_reads`` pairs (that round is not in the metrics), when no variant
    is progress, or after ``max_iters`` rounds. The first accepted variant is taken, not the best.
    """
    contigs = cut(seeds.select("idx", "seq"))
    if contigs.isEmpty():
        raise ValueError("there is no seed")
    metrics: list[dict] = []
    for round_ in range(1, p.max_iters + 1):
        query = prepare_query(contigs, p.read_k, warm_start=warm_start if round_ == 1 else None, adapters=adapters)
        found = cut(read_filter(reads, query, p.read_k))
        if exceeds(found, p.excess_reads):
            break
        if adapters is not None:
            found = cut(trim_reads(found, adapters))
        now, better = fasta_stats(contigs), None
        searched = [(found, v) for v in p.variants]
        if high_freq is not None:
            searched.insert(0, (cut(read_anti_filter(found, high_freq, p.freq_k)), p.variants[0]))
        for part, (k, least, size) in searched:
            held = cut(subset_contigs(assemble(part, k=k, min_count=least, min_contig_len=size), seeds, p).select("idx", "seq"))
            if accepted(fasta_stats(held), now, p):
                better = held
                break
        contigs = better if better is not None else contigs
        longest, total = fasta_stats(contigs)
        metrics.append({"iteration": round_, "read_pair_count": found.count(), "contig_count": contigs.count(), "longest_contig_length": longest, "total_contig_length": total})
        if better is None:
            break
    return contigs, metrics


def final_metrics(metrics: list[dict]) -> dict:
    """The last round's metrics, and zeros if there was none."""
    none = dict.fromkeys(("iteration", "read_pair_count", "contig_count", "longest_contig_length", "total_contig_length"), 0)
    return max(metrics, key=lambda m: m["iteration"]) if metrics else none


def run(spark: SparkSession, reads: str, seeds: str, out: str, p: LoopParams = LoopParams(), *, warm_start: str | None = None, adapters: str | None = None, high_freq: DataFrame | None = None) -> dict:
    """``grow_contigs`` from files to files: FASTQ reads, FASTA of seeds, warm start and adapters; contigs go to ``out``."""
    spark.dataSource.register(FastqDataSource)
    others = {k: read_fasta(spark, v) for k, v in (("warm_start", warm_start), ("adapters", adapters)) if v}
    contigs, metrics = grow_contigs(spark.read.format("readpairs").load(reads), read_fasta(spark, seeds), p, high_freq=high_freq, **others)
    write_fasta(contigs.select("idx", F.concat(F.lit("contig"), F.col("idx") + 1).alias("id"), F.lit(None).cast("string").alias("description"), "seq"), out)
    return final_metrics(metrics)
