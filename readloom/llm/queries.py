"""The pN_ queries of the training-data operators over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions.seqs import clean_seq
from readloom.llm.common import clean_name
from readloom.llm.frequent import frequent_items
from readloom.llm.groups import read_groups
from readloom.llm.languages import document_languages, language_segments
from readloom.llm.leaks import leaked_passages
from readloom.llm.mixing import mix_report, mix_schedule
from readloom.llm.representatives import representatives, surviving_pairs
from readloom.llm.shared_spans import shared_spans
from readloom.llm.terms import term_statistics
from readloom.session import table

#: Shares of rows from which a value counts as frequent.
SEQ_SHARE, NAME_SHARE = 0.005, 0.01


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_frequent_items(spark, d).select("field_name", "item")


def p1_frequent_items(spark: SparkSession, d: str) -> DataFrame:
    seqs = frequent_items(table(spark, d, "read_pairs"), clean_seq("fwd_seq"), "fwd_seq", min_share=SEQ_SHARE)
    names = frequent_items(table(spark, d, "s3_records"), clean_name("filename"), "filename", min_share=NAME_SHARE)
    return seqs.unionByName(names).select("field_name", "item", "n")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    got = term_statistics(table(spark, d, "read_pairs"), table(spark, d, "seqs"), marked_only=True)
    marks = F.array_compact(F.array(F.when(F.col("common"), "common"), F.when(F.col("rare"), "rare")))
    return got.select("kmer", F.explode(marks).alias("mark"))


def p2_term_statistics(spark: SparkSession, d: str) -> DataFrame:
    return term_statistics(table(spark, d, "read_pairs"), table(spark, d, "seqs")).drop("asked")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return read_groups(table(spark, d, "read_matches"), table(spark, d, "read_pairs"))


def p4_representatives(spark: SparkSession, d: str) -> DataFrame:
    return representatives(table(spark, d, "read_pairs"), p3_found(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_representatives(spark, d).select("group_id", "exemplar_id", "fwd_from", "rev_from")


def p4_surviving_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The record that survives for each group, built of its mates."""
    built = surviving_pairs(table(spark, d, "read_pairs"), p4_representatives(spark, d))
    return built.select("group_id", "exemplar_id", "fwd_seq", "fwd_qual", "rev_seq", "rev_qual")


def p5_shared_spans(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans(table(spark, d, "read_pairs")).drop("shared_share")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_shared_spans(spark, d).select("read_id", "mate")


def p6_leaked_passages(spark: SparkSession, d: str) -> DataFrame:
    return leaked_passages(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_leaked_passages(spark, d).select("doc_id", "item_id")


def p6_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    """Of each item, how many documents hold a passage of it, and the longest."""
    return p6_leaked_passages(spark, d).groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("n_words").alias("longest"))


def p7_mix_report(spark: SparkSession, d: str) -> DataFrame:
    return mix_report(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_mix_report(spark, d).where("falls_short").select("source")


def p7_mix_schedule(spark: SparkSession, d: str) -> DataFrame:
    return mix_schedule(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_document_languages(spark: SparkSession, d: str) -> DataFrame:
    return document_languages(table(spark, d, "documents"), table(spark, d, "lang_samples"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_document_languages(spark, d).where("not labelled").select("doc_id", "lang")


def p8_segments(spark: SparkSession, d: str) -> DataFrame:
    return language_segments(table(spark, d, "documents"), table(spark, d, "lang_samples"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (p1_found, p2_found, p3_found, p4_found, p5_found, p6_found, p7_found, p8_found)
    more = (p1_frequent_items, p2_term_statistics, p4_representatives, p4_surviving_pairs, p5_shared_spans, p6_leaked_passages, p6_leaked_items, p7_mix_report, p7_mix_schedule, p8_document_languages, p8_segments)
    return {f.__name__: f for f in found + more}


_BLANK = r"'^\s+|\s+$', '', 'g'"
_RECORDS = f"""records AS (
  SELECT read_id, max(coalesce(upper(regexp_replace(fwd_seq, {_BLANK})), '')) AS fwd, max(coalesce(upper(regexp_replace(rev_seq, {_BLANK})), '')) AS rev
  FROM read_pairs WHERE read_id IS NOT NULL GROUP BY read_id)"""
_TERMS = f"""WITH {_RECORDS},
text AS (SELECT read_id, fwd || 'N' || rev AS t FROM records),
window21 AS (SELECT read_id, substr(t, i::INT, 21) AS x FROM (SELECT read_id, t, unnest(range(1, length(t) - 19)) AS i FROM text WHERE length(t) >= 21)),
term AS (SELECT read_id, least(x, translate(reverse(x), 'ACGT', 'TGCA')) AS kmer FROM window21 WHERE NOT regexp_matches(x, '[^ACGT]')),
counted AS (SELECT kmer, count(*) AS occurrences, count(DISTINCT read_id) AS records FROM term GROUP BY kmer),
seed21 AS (SELECT substr(s, i::INT, 21) AS x FROM (SELECT s, unnest(range(1, length(s) - 19)) AS i FROM (SELECT upper(trim(seq)) AS s FROM seqs WHERE kind = 'seed' AND seq IS NOT NULL) WHERE length(s) >= 21)),
seed AS (SELECT DISTINCT least(x, translate(reverse(x), 'ACGT', 'TGCA')) AS kmer FROM seed21 WHERE NOT regexp_matches(x, '[^ACGT]')),
marked AS (
  SELECT coalesce(c.kmer, s.kmer) AS kmer, coalesce(occurrences, 0) AS occurrences, coalesce(c.records, 0) AS records,
    coalesce(c.records, 0) * 1000 >= 5 * (SELECT count(*) FROM records) AS common, s.kmer IS NOT NULL AND coalesce(c.records, 0) < 3 AS rare
  FROM counted c FULL JOIN seed s ON c.kmer = s.kmer)
"""
_BARE = "nullif(regexp_replace(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'), '^@?\\s*(.*?)\\s*(/[12])?$', '\\1'), '')"
_LINK = f"""link AS (
  SELECT {_BARE.format('src_read_id')} AS a, {_BARE.format('dst_read_id')} AS b FROM read_matches
  UNION ALL SELECT {_BARE.format('read_id')}, {_BARE.format('exemplar_id')} FROM read_pairs WHERE exemplar_id IS NOT NULL),
edge AS (SELECT DISTINCT a, b FROM link WHERE a <> b UNION SELECT DISTINCT b, a FROM link WHERE a <> b),
reach AS (SELECT a AS x, a AS y FROM edge UNION SELECT r.x, e.b FROM reach r JOIN edge e ON r.y = e.a),
grouped AS (SELECT x AS read_id, min(y) AS group_id FROM reach GROUP BY x)"""
_NAME = r"regexp_replace(regexp_replace(regexp_replace(filename, '^\s+|\s+$', '', 'g'), '\.(fastq|fq)\.zst$', '', 'i'), '^\s+|\s+$', '', 'g')"
_FREQUENT = f"""WITH v AS (
  SELECT 'fwd_seq' AS field_name, upper(regexp_replace(fwd_seq, {_BLANK})) AS item, 5 AS per_mille FROM read_pairs
  UNION ALL SELECT 'filename', {_NAME}, 10 FROM s3_records),
w AS (SELECT *, count(*) OVER (PARTITION BY field_name) AS total FROM v WHERE length(item) > 0)
SELECT field_name, item{{n}} FROM w GROUP BY field_name, item, per_mille, total HAVING count(*) * 1000 >= per_mille * total"""
_PHRED = "list_sum(list_transform(string_split({0}, ''), lambda x: ascii(x))) - length({0}) * CASE WHEN list_max(list_transform(string_split({0}, ''), lambda x: ascii(x))) > 75 THEN 64 ELSE 33 END"
_CHOSEN = f"""WITH RECURSIVE {_LINK},
r0 AS (SELECT group_id, g.read_id, upper(regexp_replace(fwd_seq, {_BLANK})) AS fs, upper(regexp_replace(rev_seq, {_BLANK})) AS rs, regexp_replace(fwd_qual, {_BLANK}) AS fq, regexp_replace(rev_qual, {_BLANK}) AS rq
  FROM grouped g JOIN read_pairs p ON g.read_id = {_BARE.format('p.read_id')}),
r1 AS (SELECT *, coalesce(length(fs), 0) AS fl, coalesce(length(rs), 0) AS rl, coalesce(length(fq), 0) = coalesce(length(fs), 0) AND coalesce(length(fs), 0) > 0 AS fo, coalesce(length(rq), 0) = coalesce(length(rs), 0) AND coalesce(length(rs), 0) > 0 AS ro FROM r0),
r2 AS (SELECT *, CASE WHEN fo THEN {_PHRED.format('fq')} ELSE 0 END AS fp, CASE WHEN ro THEN {_PHRED.format('rq')} ELSE 0 END AS rp FROM r1),
r3 AS (SELECT *, CASE WHEN fo OR ro THEN (fp + rp)::DOUBLE / (CASE WHEN fo THEN fl ELSE 0 END + CASE WHEN ro THEN rl ELSE 0 END) ELSE 0 END AS mean FROM r2),
best AS (SELECT group_id, read_id AS exemplar_id FROM r3 QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY fo::INT + ro::INT DESC, mean DESC, fl + rl DESC, read_id) = 1),
bestf AS (SELECT group_id, read_id AS fwd_from FROM r3 WHERE fo QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY fp::DOUBLE / fl DESC, fl DESC, read_id) = 1),
bestr AS (SELECT group_id, read_id AS rev_from FROM r3 WHERE ro QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY rp::DOUBLE / rl DESC, rl DESC, read_id) = 1),
chosen AS (SELECT g.group_id, exemplar_id, fwd_from, rev_from FROM (SELECT DISTINCT group_id FROM grouped) g LEFT JOIN best USING (group_id) LEFT JOIN bestf USING (group_id) LEFT JOIN bestr USING (group_id))
"""
_BUILT = """,
f AS (SELECT group_id, fs AS fwd_seq, fq AS fwd_qual FROM r2 JOIN chosen USING (group_id) WHERE fo AND read_id = fwd_from QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY fp::DOUBLE / fl DESC, fl DESC, fq, fs) = 1),
r AS (SELECT group_id, rs AS rev_seq, rq AS rev_qual FROM r2 JOIN chosen USING (group_id) WHERE ro AND read_id = rev_from QUALIFY row_number() OVER (PARTITION BY group_id ORDER BY rp::DOUBLE / rl DESC, rl DESC, rq, rs) = 1)
SELECT group_id, exemplar_id, fwd_seq, fwd_qual, rev_seq, rev_qual FROM chosen LEFT JOIN f USING (group_id) LEFT JOIN r USING (group_id)"""
# any tokenizer gives the same sources: words of ASCII letters, and every other sign, are one token each
_SHORT = r"""WITH target AS (SELECT lower(trim(source)) AS source, max(weight::DECIMAL(20, 12)) AS weight, max(max_repeats) AS max_repeats FROM mix_targets WHERE source IS NOT NULL GROUP BY 1),
had AS (SELECT lower(regexp_replace(source, '^\s+|\s+$', '', 'g')) AS source, sum(len(regexp_extract_all(coalesce(text, ''), '\w+|[^\w\s]'))) AS n FROM documents GROUP BY 1),
sized AS (SELECT t.source, weight, max_repeats, coalesce(n, 0) AS n FROM target t LEFT JOIN had h ON t.source = h.source)
SELECT source FROM sized WHERE max_repeats * n < weight * (SELECT sum(n) FROM sized)"""
_SPANS = f"""WITH {_RECORDS},
mate AS (SELECT read_id, 'fwd' AS mate, fwd AS s FROM records UNION ALL SELECT read_id, 'rev', rev FROM records),
span AS (SELECT read_id, mate, i, substr(s, i::INT, 50) AS x FROM (SELECT *, unnest(range(1, length(s) - 48)) AS i FROM mate WHERE length(s) >= 50)),
good AS (SELECT * FROM span WHERE NOT regexp_matches(x, '[^ACGT]')),
many AS (SELECT x FROM good GROUP BY x HAVING min(read_id) <> max(read_id)),
hit AS (SELECT read_id, mate, i FROM good JOIN many USING (x))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _FREQUENT.format(n=""),
        "p1_frequent_items": _FREQUENT.format(n=", count(*) AS n"),
        "p2_found": _TERMS + "SELECT kmer, 'common' AS mark FROM marked WHERE common UNION ALL SELECT kmer, 'rare' FROM marked WHERE rare",
        "p2_term_statistics": _TERMS + "SELECT kmer, occurrences, records, common, rare FROM marked",
        "p3_found": f"WITH RECURSIVE {_LINK} SELECT read_id, group_id FROM grouped",
        "p4_found": _CHOSEN + "SELECT * FROM chosen",
        "p4_surviving_pairs": _CHOSEN + _BUILT,
        "p5_found": _SPANS + "SELECT DISTINCT read_id, mate FROM hit",
        "p7_found": _SHORT,
        "p5_shared_spans": _SPANS + "SELECT read_id, mate, count(DISTINCT i + j) AS shared_bases FROM hit, range(0, 50) r(j) GROUP BY read_id, mate",
    }
