from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readloom.functions import meet
from readloom.functions.links import roots
from readloom.operators import dedup
from readloom.operators.components import connected_components, turned
from tests.helpers import canon, components, dna, pair, pairs, rc, rng, rows


@pytest.mark.parametrize("task_links", [1_000, 12, 3])
def test_components_at_every_bound(spark, task_links):
    r = rng(7)
    names = [f"n{i:03d}" for i in range(120)]
    links = [(r.choice(names), r.choice(names)) for _ in range(90)] + [("hub", n) for n in names[:30]] + [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(60)]
    links += [("x", "x"), (None, "n001"), ("n002", None)] + links[:10] + [(b, a) for a, b in links[:10]]
    want = components((a, b) for a, b in links if a and b and a != b)
    df = spark.createDataFrame(links, "a string, b string").repartition(5)
    assert dict(rows(connected_components(df, task_links=task_links))) == want


def test_numpy_union_find():
    r = rng(5)
    for n in (1, 2, 50, 400):
        a, b = (np.array([r.randrange(n) for _ in range(n)]) for _ in range(2))
        want = components((f"{x:05d}", f"{y:05d}") for x, y in zip(a.tolist(), b.tolist()))
        got = roots(a, b, n)
        assert all(int(want.get(f"{i:05d}", f"{i:05d}")) == got[i] for i in range(n))
    chain = np.arange(9_999)
    assert (roots(chain + 1, chain, 10_000) == 0).all()


def test_links_that_do_not_contract_are_an_error(spark):
    df = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(20)], "a string, b string")
    with pytest.raises(RuntimeError, match="do not contract"):
        connected_components(df, task_links=3, stars=lambda links, level, parts: turned(df.select("a", "b"), 0, None))


def test_no_links(spark):
    df = spark.createDataFrame([("a", "a"), (None, None)], "a string, b string")
    assert rows(connected_components(df)) == []


P = dedup.DedupParams(num_windows=2, window_len=12, kmer_len=5)


def _minimizer(s, w, p):
    part = s[w * p.window_len : (w + 1) * p.window_len]
    hashes = [crc32(canon(part[i : i + p.kmer_len]).encode()) for i in range(len(part) - p.kmer_len + 1) if "N" not in part[i : i + p.kmer_len]]
    return min(hashes, default=-1)


def _match(a, b, p):
    for o in range(-p.max_offset, p.max_offset + 1):
        x, y = a[max(0, o) :], b[max(0, -o) :]
        n = min(len(x), len(y))
        if n > 0 and abs(o) + sum(c != d for c, d in zip(x, y)) <= p.max_error_frac * n:
            return True
    return False


def _same(a, b, p):
    return (_match(a[0], b[0], p) and _match(a[1], b[1], p)) or (p.tolerant and _match(a[0], b[1], p) and _match(a[1], b[0], p))


def _keys(a, p):
    f, r = ([_minimizer(s, w, p) for w in range(p.num_windows)] for s in a)
    out = {(x, y) for x in f for y in r}
    return out | {(y, x) for x, y in out} if p.tolerant else out


def _near_duplicates(r, n):
    seqs = []
    for _ in range(n):
        f, b = dna(r, r.choice([30, 60, 110])), dna(r, 110)
        seqs.append((f, b))
        for _ in range(r.randint(0, 3)):
            f2, b2 = list(f), list(b)
            kind = r.randrange(4)
            if kind == 0:
                f2[r.randrange(len(f2))] = r.choice("ACGT")
            elif kind == 1:
                f2 = f2[1:] + ["A"]
            elif kind == 2:
                f2, b2 = b2, f2
            seqs.append(("".join(f2), "".join(b2)))
    return seqs


@pytest.mark.parametrize("tolerant", [True, False])
def test_dedup_against_all_pairs(spark, tolerant):
    p = dedup.DedupParams(num_windows=2, window_len=12, kmer_len=5, tolerant=tolerant)
    r = rng(8)
    seqs = _near_duplicates(r, 25) + [("", "ACGTACGTACGTAA"), ("", "ACGTACGTACGTAA"), ("ACG", "TTA"), ("ACG", "TTA"), ("ACGTRACGTTGCAAG", "TTGACCANNGGATCCA"), ("ACGTRACGTTGCAAG", "TTGACCANNGGATCCG"), ("ACGÄRACGTTGCAAG", "TTGACCANNGGATCCG")]
    data = [pair(f"r{i:03d}", f, b, fq="".join(chr(33 + r.randrange(40)) for _ in f)) for i, (f, b) in enumerate(seqs)]
    df = pairs(spark, data)
    classes = dedup.read_classes(df, p)
    got = {x["class_id"]: x for x in classes.select("class_id", dedup.bucket_keys(dedup.minimizers(F.col("fwd"), p), dedup.minimizers(F.col("rev"), p), p).alias("k"), dedup.minimizer(F.col("fwd"), 1, p).alias("m")).collect()}
    by = {}
    for i, s in enumerate(seqs):
        by.setdefault(s, []).append(i)
    for s, ids in by.items():
        assert {tuple(k) for k in got[f"r{ids[0]:03d}"]["k"]} == _keys(s, p)
        assert got[f"r{ids[0]:03d}"]["m"] == _minimizer(s[0], 1, p)
    keys = {i: _keys(s, p) for i, s in enumerate(seqs)}
    links = {(i, j) for i in keys for j in keys if i < j and keys[i] & keys[j] and _same(seqs[i], seqs[j], p)}
    near = {i: {j for a in links for j in a if i in a and j != i} for i in keys}

    def ecc(i):
        dist, front = {i: 0}, [i]
        while front:
            front = [k for j in front for k in near[j] if k not in dist and not dist.__setitem__(k, dist[j] + 1)]
        return max(dist.values()), set(dist)

    want = {}
    for i in keys:
        _, comp = ecc(i)
        score = lambda j: (ecc(j)[0], -sum(ord(c) - 33 for c in data[j][5] + data[j][8]) / max(1, len(data[j][5] + data[j][8])), -len(seqs[j][0] + seqs[j][1]), data[j][2])
        want[data[i][2]] = data[min(comp, key=score)][2]
    assert {tuple(x) for x in dedup.dedup_edges(classes, p).collect()} >= {(f"r{i:03d}", f"r{j:03d}") for i, j in links if seqs[i] != seqs[j] and f"r{i:03d}" in got and f"r{j:03d}" in got}
    found = dedup.deduplicate(df, p)
    assert {x["read_id"]: x["exemplar_id"] for x in found.collect()} == want
    assert dedup.deduplicate(df.limit(0), p).count() == 0


def test_large_components_use_pivots(spark):
    edges = spark.createDataFrame([(f"c{i:02d}", f"c{i + 1:02d}") for i in range(9)], "a string, b string")
    members = connected_components(edges)
    got = dict(rows(dedup.eccentricities(edges, members, dedup.DedupParams(max_component=5))))
    assert set(got) == {f"c{i:02d}" for i in range(10)} and min(got.values()) >= 1
    exact = dict(rows(dedup.eccentricities(edges, members, dedup.DedupParams())))
    assert exact["c00"] == 9 and exact["c04"] == exact["c05"] == 5


def test_tables_and_columns_give_the_same_buckets(spark, monkeypatch):
    r = rng(18)
    data = [pair(f"r{i:03d}", dna(r, r.randint(0, 90)), "".join(r.choice("ACGTN") for _ in range(r.randint(1, 40)))) for i in range(120)]
    p = dedup.DedupParams()
    classes = dedup.read_classes(pairs(spark, data), p)
    want = {tuple(x) for x in dedup.bucket_members(classes, p).collect()}
    monkeypatch.setattr(dedup, "TABLE_K", 0)
    assert {tuple(x) for x in dedup.bucket_members(classes, p).collect()} == want and want
    many = classes.select(F.col("class_id").alias("a"), F.lit("x").alias("b"), F.col("fwd").alias("af"), F.col("rev").alias("ar"), F.col("fwd").alias("bf"), F.col("rev").alias("br"))
    monkeypatch.setattr(dedup, "CELLS", 200)
    assert many.mapInArrow(dedup._matching(p), "a string, b string").count() == classes.where("length(fwd) > 0 and length(rev) > 0").count()


def test_params():
    with pytest.raises(ValueError):
        dedup.DedupParams(kmer_len=30)
    assert rc("ACGN") == "NCGT"


def _plain_ecc(links):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for i in near:
        dist, front = {i: 0}, [i]
        while front:
            front = [k for j in front for k in sorted(near[j]) if k not in dist and not dist.__setitem__(k, dist[j] + 1)]
        out[i] = max(dist.values())
    return out


def test_centres_of_large_components_are_exact(spark, monkeypatch):
    monkeypatch.setattr(dedup, "LEAST_ROOTS", 5)
    r = rng(31)
    links = [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(9)]
    links += [(f"t{r.randrange(i):02d}", f"t{i:02d}") for i in range(1, 16)] + [tuple(sorted(r.sample([f"t{i:02d}" for i in range(16)], 2))) for _ in range(6)]
    links += [("h0", f"h{i}") for i in range(1, 8)] + [("z0", "z1")]
    want, comps = _plain_ecc(links), components(links)
    edges = spark.createDataFrame(links, "a string, b string")
    members = connected_components(edges)
    names = list(want)
    r.shuffle(names)
    prefer = dict(zip(names, range(len(names))))
    told = spark.createDataFrame(list(prefer.items()), "node string, prefer int")
    p = dedup.DedupParams(max_component=5)
    got = dict(rows(dedup.eccentricities(edges, members, p)))
    chosen = dict(rows(dedup.eccentricities(edges, members, p, told)))
    assert set(got) == set(chosen) == set(want) and {n for n in got if n[0] == "c" and got[n] == 5} == {"c04", "c05"}
    for c in set(comps.values()):
        part = [n for n in want if comps[n] == c]
        least = min(want[n] for n in part)
        assert min(got[n] for n in part) == least and {n for n in part if got[n] == least} == {n for n in part if want[n] == least}
        first = lambda ecc: min(part, key=lambda n: (ecc[n], prefer[n]))
        assert first(chosen) == first(want) and chosen[first(want)] == least


def test_exemplars_do_not_depend_on_the_bound(spark, monkeypatch):
    monkeypatch.setattr(dedup, "LEAST_ROOTS", 4)
    r = rng(32)
    text = dna(r, 120)
    seqs = []
    for i in range(7):  # a chain: each differs from the one before at one more place
        text = text[: 4 * i + 60] + ("A" if text[4 * i + 60] != "A" else "C") + text[4 * i + 61 :]
        seqs.append((text, "ACGTTGCAACGGTACCATGCATTGCAGTCA"))
    df = pairs(spark, [pair(f"r{i:03d}", f, b, fq="".join(chr(33 + r.randrange(40)) for _ in f)) for i, (f, b) in enumerate(seqs)])
    whole, blocks = (rows(dedup.deduplicate(df, dedup.DedupParams(num_windows=2, window_len=12, kmer_len=5, max_component=n))) for n in (2_000, 4))
    assert whole == blocks and len({x[1] for x in whole}) == 1


def test_matches_by_blocks_are_those_by_keys(spark, monkeypatch):
    r = rng(41)
    seqs = [(dna(r, r.choice([3, 6, 20, 49, 50, 60, 99, 100, 101, 150, 230])), dna(r, r.choice([5, 30, 50, 110, 150, 310]))) for _ in range(60)]
    seqs += [("A" * n, "ACG") for n in (1, 4, 7, 9, 40, 150)] + [("N" * 30 + dna(r, 60), dna(r, 80)), ("AC", "NNNNNN")]
    for f, b in list(seqs):
        for _ in range(3):
            x, y = (list(s) for s in (f, b))
            for s in (x, y):
                for _ in range(r.choice([0, 0, 1, 1, 2])):
                    s[r.randrange(len(s))] = r.choice("ACGTN")
            kind = r.randrange(5)
            x, y = (x[1:] + ["C"], ["G"] + y) if kind == 0 else (y, x) if kind == 1 else (x[: max(1, len(x) * 2 // 3)], y) if kind == 2 else (x, y + ["T"] * 9) if kind == 3 else (x, y)
            seqs.append(("".join(x), "".join(y)))
    seqs += [("ACGRACGTTGCAAGTTC", "TTGACCANNGGATCCA"), ("ACGRACGTTGCAAGTTC", "TTGACCANNGGATCC"), ("ACGRACGTTGCAAGTTC", "TTGACC")]
    df = pairs(spark, [pair(f"r{i:03d}", f, b) for i, (f, b) in enumerate(seqs)])
    for tolerant in (True, False):
        p = dedup.DedupParams(tolerant=tolerant)
        classes = dedup.read_classes(df, p).localCheckpoint()
        held = {x["class_id"]: (x["fwd"], x["rev"]) for x in classes.collect()}
        keys = {i: _keys(s, p) for i, s in held.items()}
        want = sorted((a, b) for a in held for b in held if a < b and keys[a] & keys[b] and _same(held[a], held[b], p))
        assert len(want) > 80 and rows(dedup.dedup_edges(classes, p)) == want


def test_pairs_that_only_share_keys_are_not_compared():
    r = rng(42)
    n, p = 3_000, dedup.DedupParams()
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([dna(r, 150) for _ in range(n)]), pa.array([dna(r, 150) for _ in range(n)])], ["n", "fwd", "rev"])
    hot = dna(r, 150)  # a mate of very many classes, whole and cut off
    more = pa.RecordBatch.from_arrays([pa.array(range(n, 2 * n)), pa.array([hot[: 40 if i % 9 == 0 else 150] for i in range(n)]), pa.array([dna(r, 150) for _ in range(n)])], ["n", "fwd", "rev"])
    one, two = meet._gathered(dedup._block_rows(p, 4, (8,))(iter([batch, more])), (1, 1))
    assert sum(len(dedup._two_ids([c[i] for c in one], [c[j] for c in two])["a"]) for i, j in meet.met(one, two)) < 200  # of nine million


def test_pairs_that_share_a_key_are_counted_where_they_meet(spark, monkeypatch):
    r = rng(61)
    words = [dna(r, 25) for _ in range(6)]
    mate = lambda: "".join(r.choice(words) for _ in range(r.choice((0, 1, 2, 3, 3, 3))))[: r.choice((4, 60, 75, 75))]
    read = pairs(spark, [pair(f"r{i:03d}", mate(), mate()) for i in range(300)] + [pair("x1", "R" * 30 + words[0], words[1]), pair("x2", "N" * 30, "N" * 40)])
    for p in (dedup.DedupParams(), dedup.DedupParams(tolerant=False), dedup.DedupParams(num_windows=2)):
        classes = dedup.read_classes(read, p)
        every = (dedup.bucket_members(classes, p).select("fh", "rh").distinct().count(), dedup.dedup_candidates(classes, p).count())
        with monkeypatch.context() as m:
            m.setattr(dedup, "PAIRS", 1_000)
            m.setattr(dedup, "dedup_candidates", None)  # no pair is listed
            assert tuple(dedup.comparisons(classes, p).first()) == every and every[1] > 1_000
    assert tuple(dedup.comparisons(classes.limit(0), p).first()) == (0, 0)
