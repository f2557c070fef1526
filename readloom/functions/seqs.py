"""Column expressions over sequences and qualities; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that is trimmed from sequences, qualities, names and labels.
BLANKS = " \t\n\r\x0b\x0c 　﻿"
_FWD, _RC = "ACGTNacgtn", "TGCANtgcan"
#: The letters for several bases, and what stands against them.
_MANY, _AGAINST = "RYSWKMBDHVUryswkmbdhvu", "YRSWMKVHDBAyrswmkvhdba"


def bare(col: Column | str) -> Column:
    """Trimmed of white space on both sides."""
    col = F.col(col) if isinstance(col, str) else col
    return F.btrim(col, F.lit(BLANKS))


def clean_seq(col: Column | str) -> Column:
    """A sequence as it is compared: trimmed, upper case."""
    return F.upper(bare(col))


def reverse_complement(col: Column | str) -> Column:
    """Reverse complement over ACGTN in either case; other letters stay."""
    col = F.col(col) if isinstance(col, str) else col
    return F.translate(F.reverse(col), _FWD, _RC)


def reverse_complement_iupac(col: Column | str) -> Column:
    """Reverse complement of contigs, which may hold letters for several bases; U is read as T."""
    col = F.col(col) if isinstance(col, str) else col
    return F.translate(F.reverse(col), _FWD + _MANY, _RC + _AGAINST)


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(kmer, reverse_complement(kmer))


def kmers(seq: Column, k: int) -> Column:
    """Every window of k letters, in order, repeats kept; an empty array below k letters or for null.

    A look-ahead finds all windows in one pass; substrings by position would walk the letters again for each.
    """
    return F.coalesce(F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1)), F.array().cast("array<string>"))


def canonical_kmers(seq: Column, k: int) -> Column:
    """Canonical k-mers of a sequence, in order, without those that hold N; the strands are turned once, not k-mer by k-mer."""
    both = F.zip_with(kmers(seq, k), F.reverse(kmers(reverse_complement(seq), k)), lambda a, b: F.least(a, b))
    return F.filter(both, lambda x: ~F.contains(x, F.lit("N")))


def bare_read_id(col: Column | str) -> Column:
    """A read's id without blanks around it, a leading ``@`` and a mate suffix ``/1`` or ``/2``; null if nothing is left."""
    inner = F.regexp_replace(bare(col), r"^@?[\s ]*(.*?)[\s ]*(?:/[12])?$", "$1")
    return F.when(F.length(inner) > 0, inner)
