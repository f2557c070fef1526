"""Tables as files: FASTQ pairs, FASTA and metrics."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tagged_header(header: Column, source: Column) -> Column:
    """A header with the name of its source behind it."""
    return F.concat_ws(" ", F.rtrim(header), source)


def fastq_text(pairs: DataFrame, *, tag: bool = True) -> DataFrame:
    """``(source, ordinal, value)``: each pair as an interleaved FASTQ record; both mates come from one row and can't fall apart."""
    def mate(m: str) -> Column:
        header = tagged_header(F.col(f"{m}_header"), F.col("source")) if tag else F.col(f"{m}_header")
        return F.concat_ws("\n", header, F.coalesce(f"{m}_seq", F.lit("")), F.lit("+"), F.coalesce(f"{m}_qual", F.lit("")))

    return pairs.select("source", "ordinal", F.concat_ws("\n", mate("fwd"), mate("rev")).alias("value"))


def write_fastq(pairs: DataFrame, path: str, *, tag: bool = False, compression: str = "zstd") -> None:
    """Interleaved FASTQ, one folder a source; its files, in the order of their names, hold the order of the source.

    Rows are divided by ranges of source and ordinal, so a large source is several files of several tasks.
    """
    rows = fastq_text(pairs, tag=tag).repartitionByRange("source", "ordinal").sortWithinPartitions("source", "ordinal")
    rows.select("source", "value").write.partitionBy("source").option("compression", compression).text(path)


def fasta_text(seqs: DataFrame, width: int = 60) -> DataFrame:
    """``(idx, value)``: each sequence as a FASTA record, wrapped."""
    wrapped = F.rtrim(F.regexp_replace("seq", f"(.{{{width}}})", "$1\n"), F.lit("\n"))
    return seqs.select("idx", F.concat(F.lit(">"), F.coalesce("description", "id"), F.lit("\n"), wrapped).alias("value"))


def write_fasta(seqs: DataFrame, path: str) -> None:
    fasta_text(seqs).repartitionByRange("idx").sortWithinPartitions("idx").select("value").write.text(path)


def high_freq_fasta(counts: DataFrame) -> DataFrame:
    """``(value)``: k-mers as FASTA records that tell their largest count."""
    return counts.select(F.format_string(">kmer_max_%d_obs\n%s", "max_count", "kmer").alias("value"))


def kmer_fasta(kmers: DataFrame) -> DataFrame:
    """``(n, value)``: k-mers as FASTA records numbered from 1 in their order.

    Numbers run within groups of equal first letters, whose sizes are summed first; no task sees all k-mers.
    """
    rows = kmers.select("kmer", F.substring("kmer", 1, 6).alias("head"))
    before = rows.groupBy("head").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    n = F.row_number().over(Window.partitionBy("head").orderBy("kmer"))
    numbered = rows.withColumn("at", n).join(before, "head").select((F.col("before") + F.col("at")).alias("n"), "kmer")
    return numbered.select("n", F.format_string(">kmer_%d\n%s", "n", "kmer").alias("value"))


def write_metrics(metrics: list[dict], path: str) -> None:
    with open(path, "w") as f:
        json.dump(metrics, f, indent=2)
