"""Tables of the training-data operators as they are compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.seqs import bare, clean_seq


def clean_name(col: str) -> Column:
    """A file name: trimmed, without a final ``.fastq.zst`` or ``.fq.zst`` in any case."""
    return bare(F.regexp_replace(bare(col), r"(?i)\.(?:fastq|fq)\.zst$", ""))


def mates(pairs: DataFrame) -> DataFrame:
    """``(read_id, fwd, rev)`` of every row with a read_id: sequences as compared, null ones empty."""
    fwd, rev = (F.coalesce(clean_seq(c), F.lit("")) for c in ("fwd_seq", "rev_seq"))
    return pairs.where("read_id is not null").select("read_id", fwd.alias("fwd"), rev.alias("rev"))


def records(pairs: DataFrame) -> DataFrame:
    """One row for each distinct read_id. Redelivered rows hold the same sequences; where one lacks a mate, another's is taken."""
    return mates(pairs).groupBy("read_id").agg(F.max("fwd").alias("fwd"), F.max("rev").alias("rev"))
