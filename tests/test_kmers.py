from collections import Counter

from readloom.operators import kmers
from tests.helpers import canon, dna, pair, pairs, rc, rng, rows


def _windows(s, k):
    s = (s or "").strip().upper()
    return [canon(s[i : i + k]) for i in range(len(s) - k + 1) if "N" not in s[i : i + k]]


def _reads(r, genome, n=40):
    out = []
    for i in range(n):
        a = r.randrange(len(genome) - 60)
        f, b = genome[a : a + 40], rc(genome[a + 15 : a + 55])
        out.append(pair(f"r{i}", f.lower() + " " if i % 5 == 0 else f, b if i % 7 else None, source=f"s{i % 3}" if i % 11 else None, ordinal=i))
    return out + [pair("short", "ACG", ""), pair("n", "ACGTN" * 8, "N" * 30)]


def test_counts_and_high_frequency(spark):
    data = _reads(rng(), dna(rng(2), 200))
    k = 11
    expect, total = Counter(), Counter()
    for d in data:
        for w in _windows(d[4], k) + _windows(d[7], k):
            expect[d[0], w] += 1
            total[w] += 1
    df = pairs(spark, data)
    assert {(r[0], r[1]): r[2] for r in kmers.kmer_counts(df, k).collect()} == dict(expect)
    assert {r[0]: r[1] for r in kmers.kmer_counts(df, k, by=None).collect()} == dict(total)
    most = {}
    for (s, w), n in expect.items():
        if s is not None and n >= 3:
            most[w] = max(most.get(w, 0), min(n, kmers.saturation(3)))
    assert {r[0]: r[1] for r in kmers.high_freq_kmers(df, k, min_count=3).collect()} == most
    assert kmers.saturation(2000) == 4096 and kmers.saturation(8) == 16 and kmers.saturation(1) == 2
    assert kmers.kmer_counts(df.limit(0), k).count() == 0


def test_filters_agree_with_plain_search(spark):
    genome = dna(rng(3), 300)
    data = _reads(rng(4), genome)
    df = pairs(spark, data)
    seqs = spark.createDataFrame([(0, genome[20:60]), (1, rc(genome[150:180])), (2, "ACGNACG"), (3, None)], "idx int, seq string")
    adapters = spark.createDataFrame([(genome[20:35],)], "seq string")
    k = 13
    for given in (None, adapters):
        wanted = kmers.prepare_query(seqs, k, adapters=given)
        have = {w for s in (genome[20:60], genome[150:180]) for w in _windows(s, k)} - (set(_windows(genome[20:35], k)) if given else set())
        assert {r[0] for r in wanted.collect()} == have
        hit = sorted(d[2] for d in data if set(_windows(d[4], k) + _windows(d[7], k)) & have)
        assert 0 < len(hit) < len(data)
        for limit in (kmers.BROADCAST_KMERS, 0):
            assert sorted(r["read_id"] for r in kmers.read_filter(df, wanted, k, limit=limit).collect()) == hit
            assert kmers.read_anti_filter(df, wanted, k, limit=limit).count() == len(data) - len(hit)
    assert kmers.read_filter(df, wanted.limit(0), k).count() == 0
    assert kmers.read_filter(df.limit(0), wanted, k).count() == 0
    assert kmers.exceeds(df, len(data) - 1) and not kmers.exceeds(df, len(data))


def test_query_kmers_keep_repeats(spark):
    seqs = spark.createDataFrame([(0, "AAAAA"), (1, "AcN"), (2, "A"), (3, None)], "idx int, seq string")
    assert rows(kmers.query_kmers(seqs, 3)) == [(0, 0, "AAA"), (0, 1, "AAA"), (0, 2, "AAA"), (1, 0, "AcN")]
    adapters = spark.createDataFrame([("TTT",)], "seq string")
    assert rows(kmers.sanitized_query_kmers(seqs, adapters, 3)) == [(1, 0, "AcN")]
