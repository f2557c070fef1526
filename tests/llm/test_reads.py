"""Problems 1 to 5 against plain versions, with nulls, empty tables, ties, repeats and clashing columns."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.functions import runs as runs_module
from readloom.functions.seqs import clean_seq
from readloom.llm import shared_spans as spans_module
from readloom.llm import terms as terms_module
from readloom.llm.common import clean_name
from readloom.llm.frequent import frequent_items
from readloom.llm.groups import read_groups
from readloom.llm.representatives import learn_precedence, representatives, surviving_pairs
from readloom.llm.shared_spans import shared_spans
from readloom.llm.terms import term_statistics
from tests.helpers import canon, components, dna, pair, pairs, rng, rows


# 1
def test_frequent_items(spark):
    r = rng(1)
    values = ["hot"] * 300 + ["warm"] * 50 + [f"rare{i}" for i in range(400)] + [None] * 20 + ["", "  "] * 10 + [" Warm\t"] * 3
    r.shuffle(values)
    df = spark.createDataFrame([(v, 1) for v in values], "v string, n int").repartition(7)
    count = Counter(v.strip().upper() for v in values if v and v.strip())
    total = sum(count.values())
    got = frequent_items(df, clean_seq("v"), "v", min_share=0.05, heap=1)
    assert {(x["item"], x["n"]) for x in got.collect()} == {(k, n) for k, n in count.items() if n >= 0.05 * total}
    top = frequent_items(df, clean_seq("v"), "v", top=4, ranges=3).select("item", "n").collect()
    assert [tuple(x) for x in top] == sorted(count.items(), key=lambda x: (-x[1], x[0]))[:4]
    assert frequent_items(df.limit(0), clean_seq("v"), "v", min_share=0.1).count() == 0
    assert frequent_items(df.where("v is null"), clean_seq("v"), "v", top=3).count() == 0


def test_share_is_exact_and_heaps_are_bounded(spark):
    df = spark.createDataFrame([("a",)] * 5 + [(f"b{i}",) for i in range(995)], "v string")
    assert [x["item"] for x in frequent_items(df, F.col("v"), "v", min_share=0.005).collect()] == ["a"]
    # every value is a tie: the smallest come out
    assert [x["item"] for x in frequent_items(df.where("v != 'a'"), F.col("v"), "v", top=3, heap=2000, ranges=2).collect()] == ["b0", "b1", "b10"]


def test_long_values_and_names(spark):
    long = "x" * 300_000
    df = spark.createDataFrame([(long,), (long,), ("y",)], "v string")
    assert frequent_items(df, F.col("v"), "v", top=1).first()["n"] == 2
    names = ["a.FASTQ.zst", " a ", "a.fq.ZST", "A", "b.fastq.zst.fastq.zst", "", None]
    got = [x[0] for x in spark.createDataFrame([(n,) for n in names], "filename string").select(clean_name("filename")).collect()]
    assert got == ["a", "a", "a", "A", "b.fastq.zst", "", None]


# 2
def _terms(s, k):
    s = (s or "").strip().upper()
    return [canon(s[i : i + k]) for i in range(len(s) - k + 1) if set(s[i : i + k]) <= set("ACGT")]


def _read_table(r, n=60):
    genome = dna(r, 150)
    data = []
    for i in range(n):
        a = r.randrange(90)
        f, b = genome[a : a + 60], dna(r, 40)
        if i % 6 == 0:
            b = f[5:45]
        if i % 9 == 0:
            f = f[:20] + "N" + f[21:]
        data.append(pair(f"r{i:02d}", f.lower() if i % 4 == 0 else f, None if i % 13 == 0 else b + "  "))
    data += [data[0], data[1], pair("hot1", "ACACACAC" * 12, "ACACACAC" * 12), pair("empty", "", None), pair(None, genome, genome), pair("short", "ACG", "TTT"), pair("r01", data[1][4], None)]
    return data, genome


@pytest.mark.parametrize("k", [5, 12, 21, 31])
def test_term_statistics(spark, k, monkeypatch):
    data, genome = _read_table(rng(2))
    seeds = spark.createDataFrame([("seed", genome[:40].lower()), ("seed", dna(rng(3), 40)), ("contig", dna(rng(4), 50)), ("seed", None), ("seed", "")], "kind string, seq string")
    by_read = {}
    for d in data:
        if d[2] is not None:
            f, b = by_read.get(d[2], ("", ""))
            by_read[d[2]] = (max(f, (d[4] or "").strip().upper()), max(b, (d[7] or "").strip().upper()))
    stands, held = Counter(), Counter()
    for f, b in by_read.values():
        found = _terms(f, k) + _terms(b, k)
        stands.update(found)
        held.update(set(found))
    asked = {t for s in seeds.collect() if s["kind"] == "seed" for t in _terms(s["seq"], k)}
    need = -(-len(by_read) // 10)
    want = {(t, stands[t], held[t], held[t] >= need, t in asked and held[t] < 3) for t in set(stands) | asked}
    df = pairs(spark, data).withColumn("kmer", F.lit("clash")).withColumn("part", F.lit(1)).repartition(3)
    cols = ["kmer", "occurrences", "records", "common", "rare"]
    assert set(rows(term_statistics(df, seeds, k=k, common_share=0.1).select(cols))) == want
    marked = set(rows(term_statistics(df, seeds, k=k, common_share=0.1, marked_only=True).select(cols)))
    assert marked == {w for w in want if w[3] or w[4]} and marked
    empty = term_statistics(df.limit(0), seeds, k=k)
    assert {(x["kmer"], x["records"]) for x in empty.collect()} == {(t, 0) for t in asked}
    assert term_statistics(df.limit(0), seeds.limit(0), k=k).count() == 0


def test_term_runs_are_merged():
    """The range task cuts its terms into bounded runs; merged, they count the same."""
    import pyarrow as pa

    r = rng(5)
    text = [dna(r, 60) + "N" for _ in range(50)] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(text), pa.array([False] * len(text))], ["text", "asked"])
    blocks = list(terms_module._blocks(9, 1)(iter([batch, batch])))
    keep = runs_module.RUN_TERMS
    want = [b.to_pydict() for b in terms_module._count(9, None)(iter(blocks))]
    try:
        runs_module.RUN_TERMS = 500
        got = [b.to_pydict() for b in terms_module._count(9, None)(iter(blocks))]
    finally:
        runs_module.RUN_TERMS = keep
    assert got == want and len(want[0]["kmer"]) > 1000


# 3
def test_read_groups(spark):
    matches = [("r1", "r2"), ("@r2/1", " r3 "), ("r2", "r1"), ("r4", "r4"), (None, "r5"), ("r6", None), ("", "r6"), ("gone1", "gone2"), ("r1", "r2")] + [("hub", f"h{i}") for i in range(50)]
    m = spark.createDataFrame([(a, b, 1, None) for a, b in matches], "src_read_id string, dst_read_id string, orientation int, group_id int")
    p = pairs(spark, [pair("r3", "A", "A", exemplar="r7/2"), pair("r8", "A", "A", exemplar="r8"), pair("r9", "A", "A", exemplar="@r9/1"), pair("r10", "A", "A"), pair(None, "A", "A", exemplar="r1"), pair("r11", "A", "A", exemplar="  ")])
    want = components([("r1", "r2"), ("r2", "r3"), ("r3", "r7"), ("gone1", "gone2")] + [("hub", f"h{i}") for i in range(50)])
    for bound in (1000, 4):
        assert dict(rows(read_groups(m, p, task_links=bound))) == want
    assert read_groups(m.limit(0), p.limit(0)).count() == 0


def test_long_chains_take_logarithmically_many_levels(spark, monkeypatch):
    """A chain of 100 times what a task joins, in the order of its names, turned round, and shuffled, and a hub of as many."""
    import math

    from readloom.operators import components as module

    r, n, bound = rng(21), 10_000, 100
    names = [f"s{i:05d}" for i in range(n // 4)]
    mixed = r.sample(names, len(names))
    chains = [(a + k, b + k) for k, part in (("a", names), ("b", names[::-1]), ("c", mixed)) for a, b in zip(part, part[1:])] + [("hub", f"h{i:05d}") for i in range(n // 4)]
    r.shuffle(chains)
    cuts = []
    real = module.cut
    monkeypatch.setattr(module, "cut", lambda df: cuts.append(df.columns) or real(df))
    m = spark.createDataFrame(chains, "src_read_id string, dst_read_id string").repartition(20)
    got = dict(rows(read_groups(m, spark.createDataFrame([], "read_id string, exemplar_id string"), task_links=bound)))
    assert got == components(chains)
    levels = sum(c == ["node", "root", "up", "own"] for c in cuts)
    assert 2 <= levels <= math.ceil(math.log(n / bound, 1.5)) + 2


# 4
def test_representatives(spark):
    r = rng(6)
    data, groups = [], []
    for g in range(12):
        for i in range(r.randint(2, 4)):
            name = f"g{g:02d}r{i}"
            groups.append((name, f"g{g:02d}r0", 7))
            for _ in range(r.randint(1, 2)):
                f, b = dna(r, r.randint(0, 6)), dna(r, 5)
                q = lambda s: r.choice([None, "", " ", "*", "".join(chr(r.choice([33, 40, 64])) for _ in s), "".join(chr(r.choice([64, 80, 104])) for _ in s) + " "])
                data.append((None, 0, name, None, r.choice([f, None, f.lower() + "\t"]), q(f), None, b, q(b), r.choice([None, name, "other"]), None))
    groups += [("nowhere", "nowhere", 7), ("nowhere2", "nowhere", 7)]
    want = {}
    by = defaultdict(list)
    member = {a: b for a, b, _ in groups}
    for d in data:
        item = [d[2]]
        for s, q in ((d[4], d[5]), (d[7], d[8])):
            s, q = (s or "").strip(), (q or "").strip()
            ok = bool(s) and len(q) == len(s)
            off = 64 if ok and max(map(ord, q)) > 75 else 33
            item.append((ok, sum(ord(c) - off for c in q) if ok else 0, len(s)))
        by[member[d[2]]].append(item)
    for g, items in by.items():
        def score(x):
            usable = [m for m in x[1:] if m[0]]
            mean = sum(m[1] for m in usable) / sum(m[2] for m in usable) if usable else 0.0
            return (-len(usable), -mean, -(x[1][2] + x[2][2]), x[0])

        best = [min(items, key=score)[0]]
        for m in (1, 2):
            ok = [x for x in items if x[m][0]]
            best.append(min(ok, key=lambda x: (-x[m][1] / x[m][2], -x[m][2], x[0]))[0] if ok else None)
        want[g] = tuple(best)
    want["nowhere"] = (None, None, None)
    df = pairs(spark, data)
    gs = spark.createDataFrame(groups, "read_id string, group_id string, source int")
    got = representatives(df, gs)
    assert {x["group_id"]: (x["exemplar_id"], x["fwd_from"], x["rev_from"]) for x in got.collect()} == want
    built = surviving_pairs(df, got)
    assert built.count() == len(want) and all((x["fwd_seq"] is None) == (x["fwd_from"] is None) for x in built.collect())
    assert representatives(df, gs.limit(0)).count() == 0
    assert {x["exemplar_id"] for x in representatives(df.limit(0), gs).collect()} == {None}


def test_currency_reasoning(spark):
    """Dated deliveries teach that a link to another read replaces none; undated values are then placed by that."""
    t = lambda n: __import__("datetime").datetime(2031, 1, n)
    data = []
    for i in range(6):
        data += [pair(f"t{i}", "ACGT", "ACGT", exemplar=None, at=t(1)), pair(f"t{i}", "ACGT", "ACGT", exemplar="other", at=t(2 + i))]
    data += [pair("u", "ACGT", "ACGT", exemplar=None, at=t(9)), pair("u", "ACGT", "ACGT", exemplar="late"), pair("v", "ACGT", "ACGT", exemplar="kept", at=t(9)), pair("v", "ACGT", "ACGT", exemplar=None)]
    df = pairs(spark, data)
    assert learn_precedence(df) == {"source": [], "exemplar": [("none", "other")], "fwd_qual": [], "rev_qual": []}
    gs = spark.createDataFrame([("u", "u"), ("v", "v")], "read_id string, group_id string")
    assert {x["group_id"]: x["current_exemplar"] for x in representatives(df, gs).collect()} == {"u": "late", "v": "kept"}


def test_orders_of_groups(spark):
    """Quality kinds, dated chains, circles of learnt transitions, and the plan of the registered query."""
    t = lambda n: __import__("datetime").datetime(2031, 1, n)
    data = []
    for i in range(4):
        data += [pair(f"t{i}", "ACGT", "ACGT", fq="", source=None, at=t(1)), pair(f"t{i}", "ACGT", "ACGT", fq="FFFF", at=t(2)), pair(f"t{i}", "ACGT", "ACGT", fq="hijk", at=t(3)), pair(f"t{i}", "ACGT", "ACGT", fq="FGH", at=t(4)), pair(f"t{i}", "ACGT", "ACGT", fq="FGHI", at=t(5))]
    df = pairs(spark, data + [pair("a", "ACGT", "ACGT", source="x", at=t(3)), pair("b", "ACGT", "ACGT", source="y", at=t(8)), pair("c", "ACGT", "ACGT", source="w"), pair("d", "ACGT", "ACGT", source=None)])
    learnt = learn_precedence(df)
    chain = ["none", "flat", "offset64", "misfit", "offset33"]
    assert learnt["fwd_qual"] == sorted((a, b) for i, a in enumerate(chain) for b in chain[i + 1 :]) and learnt["source"] == [("none", "named")]
    gs = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("t1", "d")], "read_id string, group_id string")
    got = {x["group_id"]: x for x in representatives(df, gs).collect()}
    assert (got["a"]["current_source"], got["a"]["n_rows"], got["a"]["fwd_from"]) == ("y", 3, "a")
    # hijk is written with offset 64 and its mean is 41.5
    assert (got["d"]["current_source"], got["d"]["n_rows"], got["d"]["fwd_from"], got["d"]["exemplar_id"]) == ("s", 6, "t1", "t1")
    plan = representatives(df, gs).select("group_id", "exemplar_id", "fwd_from", "rev_from")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and "exists" in plan and "_kind" in plan


# 5
def _spans_plain(data, span):
    where = defaultdict(set)
    mates = defaultdict(set)
    for d in data:
        if d[2] is None:
            continue
        for m, s in (("fwd", d[4]), ("rev", d[7])):
            s = (s or "").strip().upper()
            mates[d[2], m].add(s)
            for i in range(len(s) - span + 1):
                if set(s[i : i + span]) <= set("ACGT"):
                    where[s[i : i + span]].add(d[2])
    out = {}
    for (name, m), texts in mates.items():
        best = 0
        for s in texts:
            got = set()
            for i in range(len(s) - span + 1):
                if len(where.get(s[i : i + span], ())) > 1:
                    got |= set(range(i, i + span))
            best = max(best, len(got))
        if best:
            out[name, m] = best
    return out


@pytest.mark.parametrize("span", [20, 50, 70])
def test_shared_spans(spark, span, monkeypatch):
    r = rng(7)
    genome = dna(r, 400)
    data = []
    for i in range(80):
        a = r.randrange(280)
        f = genome[a : a + r.randint(10, 110)] if i % 3 else dna(r, 100)
        b = f if i % 10 == 0 else dna(r, 70) + genome[:span] if i % 7 == 0 else dna(r, 90)
        if i % 5 == 0:
            f = f[:30] + "N" + f[31:]
        data.append(pair(f"r{i:02d}", f.lower() if i % 4 == 0 else f, None if i % 11 == 0 else b))
    data += [data[3], pair("solo", dna(rng(8), 80) * 2, ""), pair("long", genome * 30, None), pair(None, genome, genome), pair("hot", data[1][4], data[1][4]), pair("rep", "AC" * 60, "CA" * 60), pair("rep2", "AC" * 40, None)]
    want = _spans_plain(data, span)
    df = pairs(spark, data).withColumn("key", F.lit("clash")).withColumn("mate", F.lit(0)).repartition(3)
    got = {(x["read_id"], x["mate"]): x["shared_bases"] for x in shared_spans(df, span=span).collect()}
    assert got == want and ("solo", "fwd") not in got
    # with every range overloaded, and with some
    for entries in (0, 12):
        monkeypatch.setattr(spans_module, "HOT_ENTRIES", entries)
        monkeypatch.setattr(spans_module, "HOT_TIMES", 0)
        assert spans_module.overloaded(df.select(F.concat(F.upper(F.trim("fwd_seq")), F.lit("N")).alias("text")).na.drop(), span, 4)
        assert {(x["read_id"], x["mate"]): x["shared_bases"] for x in shared_spans(df, span=span).collect()} == want
    assert shared_spans(df.limit(0), span=span).count() == 0


def test_compact_windows_cover_every_span():
    r = rng(9)
    s = dna(r, 500) + "N" + dna(r, 49) + "N" + dna(r, 60) + "N"
    codes, _ = spans_module.P.flat(__import__("pyarrow").array([s]))
    start, size, token, h = spans_module._compact_windows(codes, 50)
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(start, size)])
    assert covered.tolist() == [i for i in range(len(s) - 49) if "N" not in s[i : i + 50]]
    assert size.max() <= spans_module.RUN and len(start) < len(covered) / 5
    with pytest.raises(ValueError):
        spans_module.shared_runs(None, span=3, ranges=1)
