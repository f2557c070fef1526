"""The registered queries of the core operators over whole tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom import oracles
from readloom.functions.seqs import bare, clean_seq
from readloom.operators import containment, dedup, kmers, overlap, pileup, trim
from readloom.plans import assemble, loop
from readloom.session import cut, shared_folder, table
from readloom.sinks import fasta_text, fastq_text, high_freq_fasta, kmer_fasta
from readloom.sources.fastq import missing_priorities, paths_by_priority, sample_name, source_records
from readloom.streaming import search

#: Length of the k-mers of read search, and of high-frequency counting; least count of the latter.
K, FREQ_K, FREQ_MIN = 21, 21, 8
#: Overlap lengths of whole read sets, and of contigs: exact, and with one mismatch.
N0, N1 = 40, 60
CONTIG_N0, CONTIG_N1 = 7, 31


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "read_pairs")


def _searched(spark: SparkSession, d: str) -> DataFrame:
    """What read search needs of the pairs: whole rows go through its tasks, so others are not read."""
    return _pairs(spark, d).select("source", "ordinal", "read_id", "fwd_seq", "rev_seq")


def _seqs(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return table(spark, d, "seqs").where(F.col("kind") == kind)


def _wanted(spark: SparkSession, d: str) -> DataFrame:
    return kmers.prepare_query(_seqs(spark, d, "seed"), K, warm_start=_seqs(spark, d, "contig"), adapters=_seqs(spark, d, "adapter"))


def read_filter(spark: SparkSession, d: str) -> DataFrame:
    return kmers.read_filter(_searched(spark, d), _wanted(spark, d), K).select("source", "ordinal", "read_id")


def read_filter_joined(spark: SparkSession, d: str) -> DataFrame:
    """The same where the k-mers are too many to send to every task."""
    return kmers.read_filter(_searched(spark, d), _wanted(spark, d), K, limit=0).select("source", "ordinal", "read_id")


def read_anti_filter(spark: SparkSession, d: str) -> DataFrame:
    high = kmers.high_freq_kmers(_pairs(spark, d), FREQ_K, min_count=FREQ_MIN)
    return kmers.read_anti_filter(_searched(spark, d), high, FREQ_K).select("source", "ordinal", "read_id")


def kmer_counts(spark: SparkSession, d: str) -> DataFrame:
    return kmers.kmer_counts(_pairs(spark, d), FREQ_K, by=None)


def kmer_counts_by_source(spark: SparkSession, d: str) -> DataFrame:
    return kmers.kmer_counts(_pairs(spark, d), FREQ_K)


def high_freq_kmers(spark: SparkSession, d: str) -> DataFrame:
    return kmers.high_freq_kmers(_pairs(spark, d), FREQ_K, min_count=FREQ_MIN)


def high_freq_records(spark: SparkSession, d: str) -> DataFrame:
    return high_freq_fasta(high_freq_kmers(spark, d))


def wanted_records(spark: SparkSession, d: str) -> DataFrame:
    """The searched k-mers as numbered FASTA records."""
    return kmer_fasta(_wanted(spark, d))


def sanitized_kmers(spark: SparkSession, d: str) -> DataFrame:
    """The mates' k-mers without those that an adapter holds."""
    mates = _pairs(spark, d).select(F.col("read_id").alias("idx"), F.explode(F.array(clean_seq("fwd_seq"), clean_seq("rev_seq"))).alias("seq"))
    return kmers.sanitized_query_kmers(mates, _seqs(spark, d, "adapter"), K).groupBy("kmer").agg(F.count("*").alias("n"))


def seed_containment(spark: SparkSession, d: str) -> DataFrame:
    """Which mates hold which seed, taken as contigs."""
    return containment.seed_containment(_mates(spark, d), _seqs(spark, d, "seed"))


def seed_positions(spark: SparkSession, d: str) -> DataFrame:
    return containment.seed_positions(_mates(spark, d), _seqs(spark, d, "seed"))


def oriented_mates(spark: SparkSession, d: str) -> DataFrame:
    mates = _mates(spark, d)
    return containment.oriented(mates, containment.seed_containment(mates, _seqs(spark, d, "seed"))).select("idx", "orientation", "seq")


def _mates(spark: SparkSession, d: str) -> DataFrame:
    """The distinct mates of all read pairs as sequences, named by themselves."""
    p = _pairs(spark, d)
    both = p.select(clean_seq("fwd_seq").alias("seq")).unionByName(p.select(clean_seq("rev_seq").alias("seq")))
    return both.where("length(seq) > 0").distinct().select(F.col("seq").alias("idx"), "seq")


def _named(spark: SparkSession, d: str) -> DataFrame:
    """The same named by the smallest read that has them: overlaps send names and not letters."""
    p = _pairs(spark, d).where("read_id is not null")
    both = [p.select(F.concat("read_id", F.lit(f"/{i}")).alias("idx"), clean_seq(f"{m}_seq").alias("seq")) for i, m in ((1, "fwd"), (2, "rev"))]
    return both[0].unionByName(both[1]).where("length(seq) > 0").groupBy("seq").agg(F.min("idx").alias("idx")).select("idx", "seq")


def overlap_edges(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_edges(_named(spark, d), n0=N0, n1=N1)


def contig_overlap_edges(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps of the assembled contigs, which are named by their letters."""
    named = contigs(spark, d).select(F.col("seq").alias("idx"), "seq")
    return overlap.overlap_edges(named, n0=CONTIG_N0, n1=CONTIG_N1)


def seed_connected(spark: SparkSession, d: str) -> DataFrame:
    mates = cut(_named(spark, d))
    found = cut(containment.seed_containment(mates, _seqs(spark, d, "seed")))
    return overlap.seed_connected(overlap.overlap_edges(mates, n0=N0, n1=N1, reached_from=found), found).select("id", "depth")


def fasta_stats(spark: SparkSession, d: str) -> DataFrame:
    """Number of pairs, and longest and total length of the mates, by source."""
    p = _pairs(spark, d).where("source is not null")
    fwd, rev = (F.coalesce(F.length(clean_seq(c)), F.lit(0)) for c in ("fwd_seq", "rev_seq"))
    return p.groupBy("source").agg(F.count("*").alias("n_pairs"), F.max(F.greatest(fwd, rev)).alias("longest"), F.sum(fwd + rev).alias("total"))


def source_names(spark: SparkSession, d: str) -> DataFrame:
    return source_records(table(spark, d, "s3_records"))


def priority_files(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "s3_records").where("priority is not null")
    return paths_by_priority(listed, 1).where("s3_path is not null").select(F.trim("s3_path").alias("s3_path")).distinct()


def missing(spark: SparkSession, d: str) -> DataFrame:
    return missing_priorities(table(spark, d, "s3_records"))


def sample_names(spark: SparkSession, d: str) -> DataFrame:
    """How many records each sample has, over the paths as FASTQ files of a mate."""
    paths = table(spark, d, "s3_records").where("s3_path is not null").select(F.regexp_replace(bare("s3_path"), r"(?i)\.(?:fastq|fq)\.zst$", "_1.fastq").alias("path"))
    return paths.groupBy(sample_name(F.col("path")).alias("sample")).agg(F.count("*").alias("n"))


def minimizers(spark: SparkSession, d: str) -> DataFrame:
    p = dedup.DedupParams()
    classes = dedup.read_classes(_pairs(spark, d), p)
    cols = [dedup.minimizer(F.col(m), w, p).alias(f"{m}{w}") for m in ("fwd", "rev") for w in range(p.num_windows)]
    return classes.select("class_id", *cols)


def dedup_edges(spark: SparkSession, d: str) -> DataFrame:
    p = dedup.DedupParams()
    return dedup.dedup_edges(cut(dedup.read_classes(_pairs(spark, d), p)), p)


def dedup_exemplars(spark: SparkSession, d: str) -> DataFrame:
    return dedup.deduplicate(_pairs(spark, d))


def dedup_counts(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_summary(_pairs(spark, d))


def trimmed_reads(spark: SparkSession, d: str) -> DataFrame:
    return trim.trim_reads(_pairs(spark, d), _seqs(spark, d, "adapter")).select("source", "ordinal", "read_id", "fwd_seq", "fwd_qual", "rev_seq", "rev_qual")


def tagged_fastq(spark: SparkSession, d: str) -> DataFrame:
    return fastq_text(_pairs(spark, d))


def fasta_records(spark: SparkSession, d: str) -> DataFrame:
    """The longest mate of each source as a FASTA record."""
    p = _pairs(spark, d).where("source is not null").select("source", F.explode(F.array(clean_seq("fwd_seq"), clean_seq("rev_seq"))).alias("seq"))
    best = p.where("seq is not null").groupBy("source").agg(F.max(F.struct(F.length("seq").alias("n"), "seq")).alias("x"))
    return fasta_text(best.select(F.col("source").alias("idx"), F.col("source").alias("id"), F.lit(None).cast("string").alias("description"), "x.seq"))


def contigs(spark: SparkSession, d: str) -> DataFrame:
    return assemble.assemble(_pairs(spark, d), k=31, min_count=2, min_contig_len=200)


def _grown(spark: SparkSession, d: str, *, overlaps: bool) -> DataFrame:
    high = cut(high_freq_kmers(spark, d))
    p = loop.LoopParams(read_k=K, freq_k=FREQ_K, excess_reads=10_000_000, overlaps=overlaps)
    found, _ = loop.grow_contigs(_pairs(spark, d), _seqs(spark, d, "seed"), p, warm_start=_seqs(spark, d, "contig"), adapters=_seqs(spark, d, "adapter"), high_freq=high)
    return found.select("seq", F.length("seq").alias("n"))


def grown_contigs(spark: SparkSession, d: str) -> DataFrame:
    return _grown(spark, d, overlaps=False)


def grown_contigs_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """The same, with the contigs that overlaps connect to those that hold a seed."""
    return _grown(spark, d, overlaps=True)


def _placed(spark: SparkSession, d: str) -> DataFrame:
    return pileup.place_reads(_pairs(spark, d), _seqs(spark, d, "contig"), k=K)


def placed_reads(spark: SparkSession, d: str) -> DataFrame:
    return _placed(spark, d).select("source", "ordinal", "read_id", "mate", "flag", "idx", "pos", F.array_join(F.transform("cigar", lambda x: F.concat(x["len"].cast("string"), x["op"])), "").alias("cigar"))


def pileup_columns(spark: SparkSession, d: str) -> DataFrame:
    bases = pileup.decode(_placed(spark, d), _seqs(spark, d, "contig"), keys=["source", "ordinal", "read_id", "mate"])
    return pileup.pileup_columns(bases)


def pileup_pairs(spark: SparkSession, d: str) -> DataFrame:
    on = _seqs(spark, d, "contig")
    at = containment.seed_positions(on, _seqs(spark, d, "seed"))
    bases = pileup.decode(_placed(spark, d), on, seeds_at=at, keys=["source", "ordinal", "read_id", "mate"])
    return pileup.pileup_pairs(bases, at)


def pileup_bounds(spark: SparkSession, d: str) -> DataFrame:
    return pileup.pileup_bounds(pileup_pairs(spark, d))


def _landed(spark: SparkSession, d: str, make: Callable[[DataFrame], DataFrame], mode: str = "append") -> DataFrame:
    """What a stream over the read pairs' files writes until none is left."""
    out = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    stream = make(search.stream_pairs(spark, f"{d}/read_pairs.parquet*", table(spark, d, "read_pairs").schema))
    search.land(stream, f"{out}/rows", f"{out}/checkpoint", mode).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def stream_read_filter(spark: SparkSession, d: str) -> DataFrame:
    wanted = _wanted(spark, d)
    return _landed(spark, d, lambda s: search.stream_filter(s.select("source", "ordinal", "read_id", "fwd_seq", "rev_seq"), wanted, K).select("source", "ordinal", "read_id"))


def stream_first_deliveries(spark: SparkSession, d: str) -> DataFrame:
    return _landed(spark, d, lambda s: search.first_deliveries(s).select("read_id"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        read_filter, read_filter_joined, read_anti_filter, kmer_counts, kmer_counts_by_source, high_freq_kmers, high_freq_records, wanted_records, sanitized_kmers, seed_containment, seed_positions, oriented_mates,
        overlap_edges, contig_overlap_edges, seed_connected, fasta_stats, source_names, priority_files, sample_names, minimizers, dedup_edges, dedup_exemplars, dedup_counts, trimmed_reads, tagged_fastq, fasta_records, contigs, grown_contigs, grown_contigs_overlaps,
        placed_reads, pileup_columns, pileup_pairs, pileup_bounds, stream_read_filter, stream_first_deliveries,
    )
    return {f.__name__: f for f in every} | {"missing_priorities": missing}


_CLEAN = r"upper(regexp_replace({0}, '^\s+|\s+$', '', 'g'))"
_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_RC = "translate(reverse({0}), 'ACGTN', 'TGCAN')"
_PAIR = f"pair AS (SELECT row_number() OVER () AS rn, source, ordinal, read_id, coalesce({_CLEAN.format('fwd_seq')}, '') AS f, coalesce({_CLEAN.format('rev_seq')}, '') AS r FROM read_pairs)"
_MER = f"""mer AS (SELECT rn, source, ordinal, read_id, least(x, {_RC.format('x')}) AS kmer FROM (
  SELECT rn, source, ordinal, read_id, substr(s, i::INT, 21) AS x FROM (SELECT *, unnest(range(1, length(s) - 19)) AS i FROM (SELECT rn, source, ordinal, read_id, unnest([f, r]) AS s FROM pair) WHERE length(s) >= 21)) WHERE NOT contains(x, 'N'))"""


def _set(name: str, kinds: str) -> str:
    return f"""{name} AS (SELECT DISTINCT least(x, {_RC.format('x')}) AS kmer FROM (
  SELECT substr(s, i::INT, 21) AS x FROM (SELECT s, unnest(range(1, length(s) - 19)) AS i FROM (SELECT {_CLEAN.format('seq')} AS s FROM seqs WHERE kind IN ({kinds})) WHERE length(s) >= 21)) WHERE NOT contains(x, 'N'))"""


_WANTED = _set("q0", "'seed', 'contig'") + ", " + _set("ad", "'adapter'") + ", wanted AS (SELECT kmer FROM q0 WHERE kmer NOT IN (SELECT kmer FROM ad))"
_HIGH = "high AS (SELECT kmer, least(max(n), 16) AS max_count FROM (SELECT source, kmer, count(*) AS n FROM mer WHERE source IS NOT NULL GROUP BY source, kmer HAVING count(*) >= 8) GROUP BY kmer)"
_MATE = "m AS (SELECT DISTINCT s AS seq FROM (SELECT unnest([f, r]) AS s FROM pair) WHERE length(s) > 0)"
_PATTERN = f"""pat AS (SELECT pattern, max(struct_pack(i := idx, o := o)).o AS orientation FROM (
  SELECT idx, s AS pattern, 1 AS o FROM (SELECT idx, {_CLEAN.format('seq')} AS s FROM seqs WHERE kind = 'seed')
  UNION ALL SELECT idx, {_RC.format('s')}, -1 FROM (SELECT idx, {_CLEAN.format('seq')} AS s FROM seqs WHERE kind = 'seed') WHERE s <> {_RC.format('s')}) GROUP BY pattern)"""
_HIT = "hit AS (SELECT seq, i - 1 AS pos, length(pattern) AS size, orientation FROM (SELECT seq, pattern, orientation, unnest(range(1, length(seq) - length(pattern) + 2)) AS i FROM m, pat WHERE contains(seq, pattern)) WHERE substr(seq, i::INT, length(pattern)) = pattern)"
_CONTAINED = "contained AS (SELECT seq, orientation FROM hit QUALIFY row_number() OVER (PARTITION BY seq ORDER BY pos + size, size DESC) = 1)"
_NAMED = r"""regexp_replace(array_to_string(list_filter(string_split(regexp_replace(p, '^\w+:/+', ''), '/'), lambda x: x <> ''), '-'), '(\.[^.]*){1,2}$', '')"""


def oracle_sql() -> dict[str, str]:
    filtered = f"WITH {_PAIR}, {_MER}, {_WANTED} SELECT source, ordinal, read_id FROM pair WHERE rn IN (SELECT rn FROM mer WHERE kmer IN (SELECT kmer FROM wanted))"
    header = "CASE WHEN source IS NULL THEN rtrim({0}_header) WHEN {0}_header IS NULL THEN source ELSE rtrim({0}_header) || ' ' || source END"
    edges = oracles.EDGES.format(n0=N0, n1=N1, h=max(1, N1 // 2))
    record = "{h} || chr(10) || coalesce({0}_seq, '') || chr(10) || '+' || chr(10) || coalesce({0}_qual, '')"
    return {
        "read_filter": filtered,
        "read_filter_joined": filtered,
        "read_anti_filter": f"WITH {_PAIR}, {_MER}, {_HIGH} SELECT source, ordinal, read_id FROM pair WHERE rn NOT IN (SELECT rn FROM mer WHERE kmer IN (SELECT kmer FROM high))",
        "kmer_counts": f"WITH {_PAIR}, {_MER} SELECT kmer, count(*) AS n FROM mer GROUP BY kmer",
        "kmer_counts_by_source": f"WITH {_PAIR}, {_MER} SELECT source, kmer, count(*) AS n FROM mer GROUP BY source, kmer",
        "high_freq_kmers": f"WITH {_PAIR}, {_MER}, {_HIGH} SELECT kmer, max_count FROM high",
        "high_freq_records": f"WITH {_PAIR}, {_MER}, {_HIGH} SELECT '>kmer_max_' || max_count || '_obs' || chr(10) || kmer AS value FROM high",
        "sanitized_kmers": f"WITH {_PAIR}, {_set('ad', chr(39) + 'adapter' + chr(39))}, w AS (SELECT substr(s, i::INT, 21) AS kmer FROM (SELECT s, unnest(range(1, length(s) - 19)) AS i FROM (SELECT unnest([f, r]) AS s FROM pair) WHERE length(s) >= 21)) SELECT kmer, count(*) AS n FROM w WHERE least(kmer, {_RC.format('kmer')}) NOT IN (SELECT kmer FROM ad) GROUP BY kmer",
        "seed_containment": f"WITH {_PAIR}, {_MATE}, {_PATTERN}, {_HIT}, {_CONTAINED} SELECT seq AS id, orientation FROM contained",
        "seed_positions": f"WITH {_PAIR}, {_MATE}, {_PATTERN}, {_HIT} SELECT DISTINCT seq AS id, unnest(range(pos, pos + size)) AS pos FROM hit",
        "oriented_mates": f"WITH {_PAIR}, {_MATE}, {_PATTERN}, {_HIT}, {_CONTAINED} SELECT seq AS idx, orientation, CASE WHEN orientation < 0 THEN {_RC.format('seq')} ELSE seq END AS seq FROM contained",
        "fasta_stats": f"WITH {_PAIR} SELECT source, count(*) AS n_pairs, max(greatest(length(f), length(r))) AS longest, sum(length(f) + length(r))::BIGINT AS total FROM pair WHERE source IS NOT NULL GROUP BY source",
        "source_names": f"WITH s AS (SELECT DISTINCT {_TRIM.format('s3_path')} AS p FROM s3_records WHERE s3_path IS NOT NULL), n AS (SELECT p, {_NAMED} AS filename FROM s WHERE p <> '') SELECT p AS s3_path, filename, CASE WHEN NOT regexp_matches(p, '^(s3|file):/') THEN 'scheme' WHEN NOT regexp_matches(lower(p), '\\.(fastq|fq)\\.zst$') THEN 'extension' WHEN length(filename) > 245 THEN 'length' WHEN count(*) OVER (PARTITION BY filename) > 1 THEN 'repeated' END AS problem FROM n",
        "priority_files": "SELECT DISTINCT trim(s3_path) AS s3_path FROM s3_records WHERE priority = 1 AND s3_path IS NOT NULL",
        "tagged_fastq": "SELECT source, ordinal, " + record.format("fwd", h=header.format("fwd")) + " || chr(10) || " + record.format("rev", h=header.format("rev")) + " AS value FROM read_pairs",
        "wanted_records": f"WITH {_WANTED}, numbered AS (SELECT kmer, row_number() OVER (ORDER BY kmer) AS n FROM wanted) SELECT n, '>kmer_' || n || chr(10) || kmer AS value FROM numbered",
        "missing_priorities": "SELECT i::INT AS priority FROM (SELECT unnest(range(1, max(priority) + 1)) AS i FROM s3_records) WHERE i NOT IN (SELECT priority FROM s3_records WHERE priority IS NOT NULL)",
        "sample_names": f"SELECT regexp_replace(string_split(p, '/')[-1], '_[12]\\.fastq$', '') AS sample, count(*) AS n FROM (SELECT regexp_replace({_TRIM.format('s3_path')}, '\\.(fastq|fq)\\.zst$', '_1.fastq', 'i') AS p FROM s3_records WHERE s3_path IS NOT NULL) GROUP BY 1",
        "overlap_edges": f"WITH {oracles.NAMED}, {edges} SELECT src, dst, orientation FROM edge",
        "seed_connected": f"WITH RECURSIVE {oracles.NAMED}, {edges}, {_PATTERN}, {oracles.SEED_CONNECTED}",
        "minimizers": oracles.MINIMIZERS,
        "dedup_edges": oracles.DEDUP_EDGES,
        "dedup_exemplars": oracles.DEDUP_EXEMPLARS,
        "trimmed_reads": oracles.TRIMMED,
        "dedup_counts": oracles.DEDUP_COUNTS,
        "fasta_records": f"WITH mate AS (SELECT source, unnest([{_CLEAN.format('fwd_seq')}, {_CLEAN.format('rev_seq')}]) AS s FROM read_pairs WHERE source IS NOT NULL), best AS (SELECT source, s FROM mate WHERE s IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY length(s) DESC, s DESC) = 1) SELECT source AS idx, '>' || source || chr(10) || rtrim(regexp_replace(s, '(.{{60}})', '\\1' || chr(10), 'g'), chr(10)) AS value FROM best",
        "placed_reads": oracles.PLACED_READS,
        "pileup_columns": oracles.PILEUP_COLUMNS,
        "pileup_bounds": "SELECT idx, min(start) AS first_start, max(start) AS last_start, 0 AS most_insertions FROM (" + oracles.PILEUP_PAIRS.format(pattern=_PATTERN) + ") GROUP BY idx",
        "pileup_pairs": oracles.PILEUP_PAIRS.format(pattern=_PATTERN),
        "stream_read_filter": filtered,
        "stream_first_deliveries": "SELECT DISTINCT read_id FROM read_pairs WHERE read_id IS NOT NULL",
    }
