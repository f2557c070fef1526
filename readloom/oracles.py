"""SQL of the queries that take more than one statement's worth: overlaps, dedup, placement and pileup."""

from __future__ import annotations

_CLEAN = r"upper(regexp_replace({0}, '^\s+|\s+$', '', 'g'))"
_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_RC = "translate(reverse({0}), 'ACGTN', 'TGCAN')"

#: The distinct mates, named by their smallest read.
NAMED = f"""named AS (SELECT min(id) AS id, s FROM (
  SELECT read_id || '/1' AS id, {_CLEAN.format('fwd_seq')} AS s FROM read_pairs UNION ALL SELECT read_id || '/2', {_CLEAN.format('rev_seq')} FROM read_pairs) WHERE length(s) > 0 GROUP BY s)"""

#: Overlaps of the sequences ``named (id, s)``; {n0}, {n1}, {h}: half of n1.
EDGES = f"""strand AS (SELECT id, 1 AS o, s FROM named UNION ALL SELECT id, -1, {_RC.format('s')} FROM named),
front AS (
  SELECT id, o, s, 0 AS st, substr(s, 1, {{n0}}) AS a FROM strand WHERE length(s) >= {{n0}}
  UNION ALL SELECT id, o, s, 0, substr(s, 1, {{h}}) FROM strand WHERE length(s) >= {{h}}
  UNION ALL SELECT id, o, s, {{h}}, substr(s, {{h}} + 1, {{n1}} - {{h}}) FROM strand WHERE length(s) >= {{n1}}),
back AS (SELECT id, o, s, i - 1 AS at, substr(s, i::INT, n::INT) AS a FROM (SELECT *, unnest(range(1, length(s) - n + 2)) AS i FROM strand, (SELECT DISTINCT unnest([{{n0}}, {{h}}, {{n1}} - {{h}}]) AS n) WHERE length(s) >= n)),
met AS (SELECT DISTINCT b.id AS bid, b.o AS bo, b.s AS bs, f.id AS fid, f.o AS fo, f.s AS fs, length(b.s) - (b.at - f.st) AS size FROM front f JOIN back b USING (a) WHERE b.id < f.id AND b.at >= f.st),
edge AS (SELECT bid AS src, fid AS dst, max(bo * fo) AS orientation FROM met WHERE size >= {{n0}} AND size <= length(fs)
  AND (right(bs, size::INT) = left(fs, size::INT) OR size >= {{n1}} AND hamming(right(bs, size::INT), left(fs, size::INT)) = 1) GROUP BY 1, 2)"""

SEED_CONNECTED = """held AS (SELECT DISTINCT n.id FROM named n, pat WHERE contains(n.s, pattern)),
way AS (SELECT src AS x, dst AS y FROM edge UNION ALL SELECT dst, src FROM edge),
reached(id, depth) USING KEY (id) AS (
  SELECT id, 0 FROM held
  UNION SELECT way.y, reached.depth + 1 FROM reached JOIN way ON reached.id = way.x WHERE NOT EXISTS (SELECT 1 FROM recurring.reached q WHERE q.id = way.y))
SELECT id, depth FROM reached"""

#: Classes of equal pairs, and the smallest CRC-32 of the canonical 7-mers of their three windows of 25 letters.
CLASSES = f"""one AS (SELECT read_id, coalesce({_CLEAN.format('fwd_seq')}, '') AS f, coalesce({_CLEAN.format('rev_seq')}, '') AS r FROM read_pairs WHERE read_id IS NOT NULL),
class AS (SELECT min(read_id) AS class_id, f, r, count(DISTINCT read_id) AS n_reads FROM one GROUP BY f, r),
part AS (SELECT class_id, m, w, substr(s, w::INT * 25 + 1, 25) AS p FROM (SELECT class_id, unnest(['fwd', 'rev']) AS m, unnest([f, r]) AS s FROM class), (SELECT unnest(range(3)) AS w)),
word AS (SELECT class_id, m, w, substr(p, i::INT, 7) AS x FROM (SELECT *, unnest(range(1, length(p) - 5)) AS i FROM part WHERE length(p) >= 7)),
tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
kinds AS (SELECT DISTINCT x, least(x, {_RC.format('x')}) AS c FROM word WHERE NOT contains(x, 'N')),
crc AS (SELECT x, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(c, ''), lambda q: ascii(q)::BIGINT), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h FROM kinds, tab),
low AS (SELECT p.class_id, p.m, p.w, coalesce(min(h), -1) AS h FROM part p LEFT JOIN word d ON p.class_id = d.class_id AND p.m = d.m AND p.w = d.w LEFT JOIN crc ON d.x = crc.x GROUP BY ALL)"""

MINIMIZERS = f"WITH {CLASSES} SELECT class_id, " + ", ".join(f"max(CASE WHEN m = '{m}' AND w = {w} THEN h END) AS {m}{w}" for m in ("fwd", "rev") for w in range(3)) + " FROM low GROUP BY class_id"


def _alike(a: str, b: str) -> str:
    """Whether a shift of at most one letter, counted as a mismatch, leaves at most 1 % of mismatches."""
    out = []
    for o in (-1, 0, 1):
        x, y = (f"substr({a}, 2)" if o > 0 else a), (f"substr({b}, 2)" if o < 0 else b)
        n = f"least(length({x}), length({y}))"
        out.append(f"({n} > 0 AND {abs(o)} + hamming(left({x}, {n}::INT), left({y}, {n}::INT)) <= 0.01::DOUBLE * {n})")
    return "(" + " OR ".join(out) + ")"


_KEYS = """full_class AS (SELECT * FROM class WHERE length(f) > 0 AND length(r) > 0),
key AS (SELECT DISTINCT l.class_id, l.h AS fh, q.h AS rh FROM low l JOIN low q ON l.class_id = q.class_id AND l.m = 'fwd' AND q.m = 'rev' JOIN full_class c ON c.class_id = l.class_id),
both_ways AS (SELECT class_id, fh, rh FROM key UNION SELECT class_id, rh, fh FROM key),
candidate AS (SELECT DISTINCT x.class_id AS a, y.class_id AS b FROM both_ways x JOIN both_ways y ON x.fh = y.fh AND x.rh = y.rh WHERE x.class_id < y.class_id)"""
_SAME = f"""same AS (SELECT a, b FROM candidate JOIN class p ON p.class_id = a JOIN class q ON q.class_id = b
  WHERE ({_alike('p.f', 'q.f')} AND {_alike('p.r', 'q.r')}) OR ({_alike('p.f', 'q.r')} AND {_alike('p.r', 'q.f')}))"""
DEDUP_EDGES = f"WITH {CLASSES}, {_KEYS}, {_SAME} SELECT a, b FROM same"
DEDUP_COUNTS = f"""WITH RECURSIVE {CLASSES}, {_KEYS}, {_SAME},
way AS MATERIALIZED (SELECT a AS x, b AS y FROM same UNION ALL SELECT b, a FROM same),
reach(x, y) AS (SELECT x, x FROM way UNION SELECT reach.x, way.y FROM reach JOIN way ON reach.y = way.x)
SELECT (SELECT sum(n_reads)::BIGINT FROM class) AS reads, (SELECT count(*) FROM class) AS classes, (SELECT count(*) FROM (SELECT DISTINCT fh, rh FROM both_ways)) AS buckets,
  (SELECT count(*) FROM candidate) AS comparisons, (SELECT count(*) FROM same) AS links, (SELECT count(DISTINCT low) FROM (SELECT x, min(y) AS low FROM reach GROUP BY x)) AS clusters"""
_QUALS = "coalesce({0}, '') || coalesce({1}, '')".format(_TRIM.format("fwd_qual"), _TRIM.format("rev_qual"))
DEDUP_EXEMPLARS = f"""WITH RECURSIVE {CLASSES}, {_KEYS}, {_SAME},
way AS MATERIALIZED (SELECT a AS x, b AS y FROM same UNION ALL SELECT b, a FROM same),
dist(root, node, d) USING KEY (root, node) AS (
  SELECT DISTINCT x, x, 0 FROM way
  UNION SELECT dist.root, way.y, dist.d + 1 FROM dist JOIN way ON dist.node = way.x WHERE NOT EXISTS (SELECT 1 FROM recurring.dist q WHERE q.root = dist.root AND q.node = way.y)),
central AS (SELECT root AS class_id, max(d) AS ecc, min(node) AS cluster FROM dist GROUP BY root),
degree AS (SELECT x AS class_id, count(*) AS n FROM way GROUP BY x),
had AS (SELECT read_id, max(CASE WHEN length(q) > 0 THEN list_sum(list_transform(string_split(q, ''), lambda x: ascii(x))) / length(q) - 33 ELSE 0.0 END) AS q, max(f) AS f, max(r) AS r
  FROM (SELECT read_id, {_QUALS} AS q, coalesce({_CLEAN.format('fwd_seq')}, '') AS f, coalesce({_CLEAN.format('rev_seq')}, '') AS r FROM read_pairs WHERE read_id IS NOT NULL) GROUP BY read_id),
member AS (SELECT read_id, q, length(h.f) + length(h.r) AS size, greatest(coalesce(ecc, 0), (n_reads > 1)::INT) AS ecc, coalesce(n, 0) AS n_links,
  CASE WHEN length(h.f) = 0 OR length(h.r) = 0 THEN read_id ELSE coalesce(cluster, c.class_id) END AS cluster_id
  FROM had h JOIN class c ON h.f = c.f AND h.r = c.r LEFT JOIN central USING (class_id) LEFT JOIN degree USING (class_id)),
best AS (SELECT cluster_id, read_id AS exemplar_id FROM member QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY ecc, q DESC, size DESC, read_id) = 1)
SELECT read_id, exemplar_id, cluster_id, n_links FROM member JOIN best USING (cluster_id)"""

#: The best ungapped place of each mate on the contigs: most common 21-mers, then the stretch of largest score.
PLACED = f"""contig AS (SELECT idx, {_CLEAN.format('seq')} AS c FROM seqs WHERE kind = 'contig' AND seq IS NOT NULL),
anchor AS (SELECT idx, i - 1 AS ap, substr(c, i::INT, 21) AS kmer FROM (SELECT *, unnest(range(1, length(c) - 19)) AS i FROM contig WHERE length(c) >= 21) WHERE NOT contains(substr(c, i::INT, 21), 'N')),
mate AS (SELECT DISTINCT source, ordinal, read_id, unnest(['fwd', 'rev']) AS mate, unnest([{_CLEAN.format('fwd_seq')}, {_CLEAN.format('rev_seq')}]) AS s FROM read_pairs),
turned AS (SELECT *, 0 AS flag FROM mate WHERE length(s) >= 21 UNION ALL SELECT source, ordinal, read_id, mate, {_RC.format('s')}, 16 FROM mate WHERE length(s) >= 21),
vote AS (SELECT source, ordinal, read_id, mate, flag, s, idx, ap - (i - 1) AS shift, count(*) AS n FROM (SELECT *, unnest(range(1, length(s) - 19)) AS i FROM turned) t JOIN anchor ON kmer = substr(s, i::INT, 21) GROUP BY ALL),
laid AS (SELECT row_number() OVER () AS rn, * FROM (SELECT * FROM vote QUALIFY row_number() OVER (PARTITION BY source, ordinal, read_id, mate ORDER BY n DESC, idx, shift, flag) = 1) JOIN contig USING (idx)),
cell AS (SELECT rn, i, sum(CASE WHEN substr(s, i::INT + 1, 1) = substr(c, (i + shift)::INT + 1, 1) THEN 2 ELSE -6 END) OVER (PARTITION BY rn ORDER BY i) AS p
  FROM (SELECT *, unnest(range(greatest(0, -shift), least(length(s), length(c) - shift))) AS i FROM laid)),
start AS (SELECT rn, i, p FROM cell UNION ALL SELECT rn, greatest(0, -shift) - 1, 0 FROM laid),
lowest AS (SELECT rn, i, p, min(p) OVER (PARTITION BY rn ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low FROM start),
top AS (SELECT rn, i AS e, low FROM lowest WHERE p - low > 0 QUALIFY row_number() OVER (PARTITION BY rn ORDER BY p - low DESC, i) = 1),
part AS (SELECT t.rn, e, max(s.i) + 1 AS a FROM top t JOIN start s ON s.rn = t.rn AND s.i < e AND s.p = t.low GROUP BY ALL),
placed AS (SELECT l.*, a AS lead, e + 1 - a AS size FROM laid l JOIN part USING (rn))"""
PLACED_READS = f"""WITH {PLACED} SELECT source, ordinal, read_id, mate, flag, idx, (shift + lead)::INT AS pos,
  CASE WHEN lead > 0 THEN lead || 'S' ELSE '' END || size || 'M' || CASE WHEN length(s) > lead + size THEN (length(s) - lead - size) || 'S' ELSE '' END AS cigar FROM placed"""
_BASES = """base AS (SELECT source, ordinal, read_id, mate, idx, shift + i AS pos,
  CASE WHEN i < lead OR i >= lead + size THEN 'clip' WHEN substr(s, i::INT + 1, 1) = substr(c, (shift + i)::INT + 1, 1) THEN 'match' ELSE 'mismatch' END AS kind
  FROM (SELECT *, unnest(range(length(s))) AS i FROM placed))"""
PILEUP_COLUMNS = f"""WITH {PLACED}, {_BASES} SELECT idx, pos::INT AS pos, count(*) FILTER (kind <> 'clip') AS depth, count(*) FILTER (kind = 'match') AS matches, count(*) FILTER (kind = 'mismatch') AS mismatches,
  0::BIGINT AS insertions, 0::BIGINT AS deletions, count(*) FILTER (kind = 'clip') AS clips FROM base GROUP BY idx, pos"""
#: {pattern}: the seeds' patterns on both strands.
PILEUP_PAIRS = f"""WITH {PLACED}, {_BASES}, {{pattern}},
at_seed AS (SELECT DISTINCT idx, unnest(range(i - 1, i - 1 + length(pattern))) AS pos FROM (SELECT idx, c, pattern, unnest(range(1, length(c) - length(pattern) + 2)) AS i FROM contig, pat WHERE contains(c, pattern)) WHERE substr(c, i::INT, length(pattern)) = pattern),
told AS (SELECT b.*, s.pos IS NOT NULL AND kind <> 'clip' AS seed, min(b.pos) OVER (PARTITION BY source, ordinal, read_id, b.idx, mate) AS first FROM base b LEFT JOIN at_seed s ON b.idx = s.idx AND b.pos = s.pos),
spot AS (SELECT source, ordinal, read_id, idx, pos, max(seed) AS seed,
  arg_min(CASE WHEN seed THEN CASE WHEN kind = 'match' THEN 's' ELSE 'x' END WHEN kind = 'match' THEN '=' WHEN kind = 'mismatch' THEN 'X' ELSE 'S' END, struct_pack(f := first, m := mate)) AS code FROM told GROUP BY ALL),
line AS (SELECT source, ordinal, read_id, idx, min(pos) AS start, max(pos) AS stop, map(list(pos), list(code)) AS cells_at, min(pos) FILTER (seed) AS s0, max(pos) FILTER (seed) AS s1 FROM spot GROUP BY ALL),
ends AS (SELECT idx, min(pos) AS lo, max(pos) AS hi FROM at_seed GROUP BY idx)
SELECT source, ordinal, read_id, idx, start::INT AS start, array_to_string(list_transform(range(start, stop + 1), lambda i: coalesce(cells_at[i], '.')), '') AS cells, NULL::INT[] AS insertions_at, coalesce(s0 = lo AND s1 = hi, false) AS contains_seed FROM line LEFT JOIN ends USING (idx)"""

#: The trimmed mates: bad ends, then one adapter after another in their order, then a final run of one base; what is left must be good.
TRIMMED = f"""WITH pair AS (SELECT row_number() OVER () AS rn, source, ordinal, read_id, coalesce({_CLEAN.format('fwd_seq')}, '') AS fs, coalesce({_TRIM.format('fwd_qual')}, '') AS fq, coalesce({_CLEAN.format('rev_seq')}, '') AS rs, coalesce({_TRIM.format('rev_qual')}, '') AS rq FROM read_pairs),
adapters AS (SELECT list(a ORDER BY a) AS known FROM (SELECT DISTINCT {_CLEAN.format('seq')} AS a FROM seqs WHERE kind = 'adapter' AND seq IS NOT NULL) WHERE a <> ''),
text AS (SELECT DISTINCT unnest([fs, rs]) AS s, unnest([fq, rq]) AS q FROM pair),
sized AS (SELECT s, q, length(s) AS n, list_transform(range(1, length(q) + 1), lambda i: ascii(substr(q, i::INT, 1)) - 33) AS p FROM text WHERE length(s) = length(q) AND length(s) >= 15),
ends AS (SELECT *, list_filter(range(1, n - 2), lambda i: p[i] + p[i + 1] + p[i + 2] + p[i + 3] >= 40) AS good FROM sized),
inner_part AS (SELECT s, q, p, good[1] AS a, substr(s, good[1]::INT, (good[-1] + 4 - good[1])::INT) AS part FROM ends WHERE len(good) > 0),
cut AS (SELECT s, q, p, a, list_reduce([part] || known, lambda acc, ad: left(acc, (coalesce(list_filter(range(1, greatest(length(acc) - least(5, length(ad)) + 2, 1)), lambda i: hamming(substr(acc, i::INT, least(length(ad), length(acc) - i + 1)::INT), left(ad, least(length(ad), length(acc) - i + 1)::INT)) <= least(length(ad), length(acc) - i + 1) // 8)[1], length(acc) + 1) - 1)::INT)) AS part FROM inner_part, adapters),
tail AS (SELECT *, length(part) AS n, list_transform(range(1, length(part) + 1), lambda j: (substr(part, (length(part) - j + 1)::INT, 1) <> right(part, 1))::INT) AS other FROM cut),
run AS (SELECT *, coalesce(list_filter(range(1, n + 1), lambda j: other[j] = 1 AND list_sum(other[1:j]) > j // 8)[1], n + 1) AS stop FROM tail),
poly AS (SELECT *, coalesce(list_max(list_filter(range(1, stop), lambda j: other[j] = 0)), 0) AS poly FROM run),
left_over AS (SELECT s, q, p, a, left(part, (CASE WHEN poly >= 10 THEN n - poly ELSE n END)::INT) AS t FROM poly),
kept AS (SELECT s, q, t, substr(q, a::INT, length(t)) AS tq FROM (SELECT *, p[a : a + length(t) - 1] AS tp FROM left_over WHERE length(t) >= 15)
  WHERE list_sum(tp) >= 10 * length(t) AND len(list_filter(tp, lambda x: x < 10)) / length(t) <= 0.4
    AND len(list_filter(range(1, length(t)), lambda i: substr(t, i::INT, 1) <> substr(t, i::INT + 1, 1))) / (length(t) - 1) >= 0.3)
SELECT source, ordinal, read_id, f.t AS fwd_seq, f.tq AS fwd_qual, r.t AS rev_seq, r.tq AS rev_qual FROM pair JOIN kept f ON f.s = fs AND f.q = fq JOIN kept r ON r.s = rs AND r.q = rq"""
