"""Reads laid on contigs: placement by k-mers, CIGAR decoding, and the pileup by contig position and by read pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.seqs import canonical_kmers, clean_seq, kmers, reverse_complement
from readloom.operators.kmers import read_filter

#: Score of a matching base and of another, in the placed part of a read.
MATCH, MISMATCH = 2, -6
#: SAM flags of alignments that are not looked at: unmapped, secondary, supplementary.
SKIP_FLAGS = 4 | 256 | 2048


def place_reads(reads: DataFrame, contigs: DataFrame, *, k: int = 21, min_anchors: int = 1) -> DataFrame:
    """``(read_id, source, ordinal, mate, flag, idx, pos, cigar, seq)``: each mate's best ungapped place on the contigs.

    Mates that share k-mers with a contig vote for an offset; of the offsets with most votes the smallest contig
    and place stands. The part of best score is kept, the rest is soft-clipped. pos counts from 0; flag 16 marks the
    reverse strand; cigar is an array of (op, len).
    """
    keyed = contigs.where("seq is not null").select("idx", clean_seq("seq").alias("c"))
    anchors = keyed.select("idx", F.posexplode(kmers(F.col("c"), k)).alias("at", "kmer")).where(~F.contains("kmer", F.lit("N")))
    slim = reads.select("source", "ordinal", "read_id", "fwd_seq", "rev_seq")
    near = read_filter(slim, contigs.select(F.explode(canonical_kmers(clean_seq("seq"), k)).alias("kmer")).distinct(), k)
    mate = F.explode(F.array(*(F.struct(F.lit(m).alias("mate"), clean_seq(f"{m}_seq").alias("s")) for m in ("fwd", "rev"))))
    mates = near.select("source", "ordinal", "read_id", mate.alias("x")).select("source", "ordinal", "read_id", "x.mate", "x.s").where(F.length("s") >= k).distinct()
    strands = mates.withColumn("st", F.explode(F.array(F.lit(0), F.lit(16)))).withColumn("s", F.when(F.col("st") == 16, reverse_complement(F.col("s"))).otherwise(F.col("s")))
    votes = strands.select("source", "ordinal", "read_id", "mate", "st", "s", F.posexplode(kmers(F.col("s"), k)).alias("i", "kmer")).join(anchors, "kmer")
    counted = votes.groupBy("source", "ordinal", "read_id", "mate", "st", "s", "idx", (F.col("at") - F.col("i")).alias("shift")).agg(F.count("*").alias("n")).where(F.col("n") >= min_anchors)
    w = Window.partitionBy("source", "ordinal", "read_id", "mate").orderBy(F.desc("n"), "idx", "shift", "st")
    best = counted.withColumn("r", F.row_number().over(w)).where("r = 1").join(keyed, "idx")
    lo, hi = F.greatest(F.lit(0), -F.col("shift")), F.least(F.length("s"), F.length("c") - F.col("shift"))
    best = best.withColumns({"lo": lo, "hi": hi}).where("hi > lo")
    score = F.transform(F.sequence(F.col("lo"), F.col("hi") - 1), lambda i: F.when(F.substr(F.col("s"), i + 1, F.lit(1)) == F.substr(F.col("c"), i + F.col("shift") + 1, F.lit(1)), MATCH).otherwise(MISMATCH))
    best = best.withColumn("score", score)
    # the stretch of largest sum: its sum and start so far, and the best one's sum, start and end; i counts the places
    part = F.expr("""aggregate(score, named_struct('i', 0, 's', 0, 'a', 0, 'bs', 0, 'ba', 0, 'be', 0), (z, x) ->
        IF(greatest(z.s, 0) + x > z.bs,
           named_struct('i', z.i + 1, 's', greatest(z.s, 0) + x, 'a', IF(z.s <= 0, z.i, z.a), 'bs', greatest(z.s, 0) + x, 'ba', IF(z.s <= 0, z.i, z.a), 'be', z.i + 1),
           named_struct('i', z.i + 1, 's', greatest(z.s, 0) + x, 'a', IF(z.s <= 0, z.i, z.a), 'bs', z.bs, 'ba', z.ba, 'be', z.be)))""")
    best = best.withColumn("p", part).where("p.bs > 0")
    left, size = F.col("lo") + F.col("p.ba"), F.col("p.be") - F.col("p.ba")
    piece = lambda op, n: F.struct(F.lit(op).alias("op"), n.cast("int").alias("len"))
    cigar = F.filter(F.array(piece("S", left), piece("M", size), piece("S", F.length("s") - left - size)), lambda x: x["len"] > 0)
    return best.select("read_id", "source", "ordinal", "mate", F.col("st").alias("flag"), "idx", (F.col("shift") + left).cast("int").alias("pos"), cigar.alias("cigar"), F.col("s").alias("seq"))


def decode(alignments: DataFrame, contigs: DataFrame, *, seeds_at: DataFrame | None = None, keys: list[str]) -> DataFrame:
    """One row for each place that an alignment covers: ``keys, idx, pos, kind, base, seed``.

    kind: match, mismatch, insertion (at the place before it), deletion or clip. M is compared with the contig
    (places outside hold N), ``=`` and ``X`` are trusted; D and N move along the contig; leading S reaches
    back from the start, trailing S goes on; H and P say nothing; an alignment without a cigar has no rows. seed tells whether
    a base stands on a seed's place (``seeds_at``: id, pos); deletions and clips never do.
    """
    rows = alignments.where(F.col("cigar").isNotNull() & (F.col("flag").bitwiseAND(SKIP_FLAGS) == 0))
    # each piece with where it begins in the read (q) and on the contig (r)
    moved = F.expr("""aggregate(cigar, named_struct('q', 0, 'r', pos, 'out', cast(array() as array<struct<op:string,len:int,q:int,r:int>>)), (z, x) -> named_struct(
        'q', z.q + IF(x.op IN ('M', 'I', 'S', '=', 'X'), x.len, 0),
        'r', z.r + IF(x.op IN ('M', 'D', 'N', '=', 'X'), x.len, 0),
        'out', concat(z.out, array(named_struct('op', x.op, 'len', x.len, 'q', z.q, 'r', IF(x.op = 'S' AND z.q = 0, z.r - x.len, z.r))))), z -> z.out)""")
    pieces = rows.select(*keys, "idx", "seq", F.explode(moved).alias("x")).where("x.op in ('M', 'I', 'S', '=', 'X', 'D', 'N') and x.len > 0")
    step = pieces.select(*keys, "idx", "seq", "x.op", "x.q", "x.r", F.explode(F.sequence(F.lit(0), F.col("x.len") - 1)).alias("i"))
    one = step.withColumns({"pos": F.when(F.col("op") == "I", F.col("r") - 1).otherwise(F.col("r") + F.col("i")), "base": F.when(F.col("op").isin("D", "N"), "-").otherwise(F.substr(F.col("seq"), F.col("q") + F.col("i") + 1, F.lit(1)))})
    named = one.join(contigs.select("idx", clean_seq("seq").alias("c")), "idx")
    there = F.when((F.col("pos") >= 0) & (F.col("pos") < F.length("c")), F.substr(F.col("c"), F.col("pos") + 1, F.lit(1))).otherwise("N")
    kind = F.when(F.col("op") == "I", "insertion").when(F.col("op").isin("D", "N"), "deletion").when(F.col("op") == "S", "clip").when(F.col("op") == "=", "match").when(F.col("op") == "X", "mismatch").when(F.upper("base") == there, "match").otherwise("mismatch")
    out = named.select(*keys, "idx", "pos", kind.alias("kind"), "base")
    if seeds_at is None:
        return out.withColumn("seed", F.lit(False))
    at = seeds_at.select(F.col("id").alias("idx"), "pos", F.lit(True).alias("_s"))
    return out.join(at, ["idx", "pos"], "left").withColumn("seed", F.coalesce("_s", F.lit(False)) & F.col("kind").isin("match", "mismatch")).drop("_s")


def pileup_columns(bases: DataFrame) -> DataFrame:
    """``(idx, pos, depth, matches, mismatches, insertions, deletions, clips)`` by contig position."""
    def count(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    depth = F.count_if(F.col("kind").isin("match", "mismatch", "deletion"))
    return bases.groupBy("idx", "pos").agg(depth.alias("depth"), count("match").alias("matches"), count("mismatch").alias("mismatches"), count("insertion").alias("insertions"), count("deletion").alias("deletions"), count("clip").alias("clips"))


def pileup_pairs(bases: DataFrame, seeds_at: DataFrame | None = None) -> DataFrame:
    """``(source, ordinal, read_id, idx, start, cells, insertions_at, contains_seed)``: one row a pair and contig.

    cells holds a letter for each place from start: ``=`` match, ``X`` mismatch, ``D`` deletion, ``S`` clip, ``s`` and ``x``
    match and mismatch on a seed, ``.`` between the mates. Where mates overlap, the one that begins first stands.
    contains_seed: the seed's first and last place are both covered.
    """
    keys = ["source", "ordinal", "read_id", "idx"]
    begins = Window.partitionBy(*keys, "mate")
    code = F.when(F.col("seed"), F.when(F.col("kind") == "match", "s").otherwise("x")).when(F.col("kind") == "match", "=").when(F.col("kind") == "mismatch", "X").when(F.col("kind") == "deletion", "D").otherwise("S")
    rows = bases.withColumn("first", F.min(F.when(F.col("kind") != "insertion", F.col("pos"))).over(begins)).withColumn("code", code)
    cells = rows.where("kind != 'insertion'").groupBy(*keys, "pos").agg(F.min_by("code", F.struct("first", "mate")).alias("code"), F.max("seed").alias("seed"))
    inserted = rows.where("kind = 'insertion'").groupBy(*keys).agg(F.array_sort(F.collect_set("pos")).alias("insertions_at"))
    got = cells.groupBy(*keys).agg(F.min("pos").alias("start"), F.max("pos").alias("stop"), F.map_from_entries(F.collect_list(F.struct("pos", "code"))).alias("at"), F.min(F.when(F.col("seed"), F.col("pos"))).alias("s0"), F.max(F.when(F.col("seed"), F.col("pos"))).alias("s1"))
    text = F.array_join(F.transform(F.sequence("start", "stop"), lambda i: F.coalesce(F.try_element_at("at", i), F.lit("."))), "")
    out = got.join(inserted, keys, "left").withColumn("cells", text)
    if seeds_at is None:
        holds = F.lit(False)
        return out.select(*keys, "start", "cells", "insertions_at", holds.alias("contains_seed"))
    ends = seeds_at.groupBy(F.col("id").alias("idx")).agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    holds = F.coalesce((F.col("s0") == F.col("lo")) & (F.col("s1") == F.col("hi")), F.lit(False))
    return out.join(ends, "idx", "left").select(*keys, "start", "cells", "insertions_at", holds.alias("contains_seed"))


def paired_alignments(alignments: DataFrame) -> DataFrame:
    """``(read_id, mate, flag, ref_name, pos, cigar, seq)`` of SAM rows: those of one name on a contig are the mates of a
    read, numbered by where they begin. Alignments that are not looked at are left out first, then names with more than two."""
    rows = alignments.where(F.col("cigar").isNotNull() & (F.size("cigar") > 0) & (F.col("flag").bitwiseAND(SKIP_FLAGS) == 0))
    two = rows.groupBy("qname", "ref_name").agg(F.count("*").alias("n")).where("n <= 2").drop("n")
    begins = Window.partitionBy("qname", "ref_name").orderBy("pos", "flag", "seq")
    return rows.join(two, ["qname", "ref_name"]).select(F.col("qname").alias("read_id"), F.row_number().over(begins).alias("mate"), "flag", "ref_name", "pos", "cigar", "seq")


def pileup_rows(pairs: DataFrame) -> DataFrame:
    """The rows of ``pileup_pairs`` in the order in which they are shown: by contig, start, and place in their file."""
    return pairs.orderBy("idx", "start", "source", "ordinal", "read_id")


def pileup_bounds(pairs: DataFrame) -> DataFrame:
    """``(idx, first_start, last_start, most_insertions)`` of each contig's pairs."""
    return pairs.groupBy("idx").agg(F.min("start").alias("first_start"), F.max("start").alias("last_start"), F.max(F.coalesce(F.size("insertions_at"), F.lit(0))).alias("most_insertions"))
