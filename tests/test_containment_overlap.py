import pyarrow as pa

from readloom.functions import meet
from readloom.operators import containment, overlap
from tests.helpers import dna, rc, rng, rows


def _set(spark, seqs):
    return spark.createDataFrame(list(enumerate(seqs)), "idx int, seq string")


def test_first_match_decides(spark):
    contigs = _set(spark, ["AAATCGCGCGCG", "ATTTGCGCGCGC", "CCCCCGGGGGG", "AAATATTTCCG", "ATTTCCAAAT", None, ""])
    assert rows(containment.seed_containment(contigs, _set(spark, ["AAAT"]))) == [(0, 1), (1, -1), (3, 1), (4, -1)]
    assert rows(containment.seed_containment(contigs, _set(spark, []))) == []
    # a palindrome is forward; of a seed and its reverse complement the later one stands
    assert rows(containment.seed_containment(_set(spark, ["GGAATTGG"]), _set(spark, ["AATT"]))) == [(0, 1)]
    assert rows(containment.seed_containment(_set(spark, ["GGAAACGG"]), _set(spark, ["AAAC", "GTTT"]))) == [(0, -1)]


def test_containment_against_plain_search(spark):
    r = rng(5)
    seeds = [dna(r, r.randint(5, 9)) for _ in range(30)]
    contigs = [dna(r, r.randint(3, 60)) for _ in range(120)]
    pattern = {}
    for i, s in enumerate(seeds):
        pattern[s] = (i, 1)
        if rc(s) != s:
            pattern[rc(s)] = (i, -1)
    want, covered = [], set()
    for i, c in enumerate(contigs):
        hits = [(a + len(p), -len(p), o) for p, (_, o) in pattern.items() for a in range(len(c)) if c.startswith(p, a)]
        covered |= {(i, x) for end, size, _ in hits for x in range(end + size, end)}
        if hits:
            want.append((i, min(hits)[2]))
    assert rows(containment.seed_containment(_set(spark, contigs), _set(spark, seeds))) == sorted(want, key=repr)
    assert set(rows(containment.seed_positions(_set(spark, contigs), _set(spark, seeds)))) == covered


def _overlaps(a, b, n0, n1):
    return any(sum(x != y for x, y in zip(a[-n:], b[:n])) <= (1 if n >= n1 else 0) for n in range(n0, min(len(a), len(b)) + 1))


def test_edges_against_all_pairs(spark):
    r = rng(6)
    genome = dna(r, 160)
    seqs = []
    for _ in range(40):
        a = r.randrange(130)
        s = list(genome[a : a + r.randint(12, 40)])
        if r.random() < 0.4:
            s[r.randrange(len(s))] = r.choice("ACGT")
        s = "".join(s)
        seqs.append(rc(s) if r.random() < 0.5 else s)
    for n0, n1 in ((6, 11), (8, 8)):
        want = []
        for i, a in enumerate(seqs):
            for j in range(i + 1, len(seqs)):
                b = seqs[j]
                if _overlaps(a, b, n0, n1) or _overlaps(rc(a), rc(b), n0, n1):
                    want.append((i, j, 1))
                elif _overlaps(a, rc(b), n0, n1) or _overlaps(rc(a), b, n0, n1):
                    want.append((i, j, -1))
        assert rows(overlap.overlap_edges(_set(spark, seqs), n0=n0, n1=n1)) == sorted(want, key=repr)


def test_orientations_multiply(spark):
    edges = spark.createDataFrame([(0, 1, 1), (1, 2, -1), (2, 3, 1), (2, 4, -1), (5, 6, 1)], "src int, dst int, orientation int")
    roots = spark.createDataFrame([(2, 1)], "id int, orientation int")
    assert rows(overlap.seed_connected(edges, roots)) == [(0, -1, 2), (1, -1, 1), (2, 1, 0), (3, 1, 1), (4, -1, 1)]
    assert rows(overlap.seed_connected(edges, roots.limit(0))) == []
    turned = containment.oriented(_set(spark, ["AAC", "GGT"]), spark.createDataFrame([(0, -1), (1, 1)], "id int, orientation int"))
    assert sorted(x["seq"] for x in turned.collect()) == ["GGT", "GTT"]


def test_chains_are_walked_to_their_end(spark):
    r = rng(9)
    names = list(range(1500))
    r.shuffle(names)
    turns = [r.choice([1, -1]) for _ in names[1:]]
    edges = spark.createDataFrame([(min(a, b), max(a, b), t) for a, b, t in zip(names, names[1:], turns)], "src int, dst int, orientation int")
    want, o = [(names[0], -1, 0)], -1
    for depth, (name, turn) in enumerate(zip(names[1:], turns), 1):
        o *= turn
        want.append((name, o, depth))
    roots = spark.createDataFrame([(names[0], -1)], "id int, orientation int")
    assert rows(overlap.seed_connected(edges, roots)) == sorted(want, key=repr)


def test_one_task_and_joins_reach_the_same(spark, monkeypatch):
    monkeypatch.setattr(overlap, "PLAN_ROUNDS", 3)
    r = rng(10)
    links = {tuple(sorted(r.sample(range(60), 2))) for _ in range(70)} | {(i, i + 1) for i in range(100, 109)}
    edges = spark.createDataFrame([(a, b, r.choice([1, -1])) for a, b in sorted(links)], "src int, dst int, orientation int")
    roots = spark.createDataFrame([(3, 1), (17, -1), (104, 1), (500, 1)], "id int, orientation int")
    got = rows(overlap.seed_connected(edges, roots))
    assert got == rows(overlap.seed_connected(edges, roots, task_links=0)) and (500, 1, 0) in got and (100, 1) in {(x[0], abs(x[1])) for x in got}


def test_registered_overlaps_of_contigs(spark, monkeypatch):
    from readloom import catalog

    r = rng(12)
    a, b = dna(r, 60), dna(r, 60)
    seqs = [a, a[-7:] + b, b[-31:-1] + ("A" if b[-1] != "A" else "C") + dna(r, 40)]
    monkeypatch.setattr(catalog, "contigs", lambda spark, d: _set(spark, seqs))
    got = {frozenset((x["src"], x["dst"])) for x in catalog.queries()["contig_overlap_edges"](spark, "").collect()}
    assert {frozenset(seqs[:2]), frozenset(seqs[1:])} <= got


def _met(seqs, n0, n1):
    """The pairs that would be compared, and the rows that meet to find them."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(seqs)), pa.int64()), pa.array(seqs)], ["n", "s"])
    rows_, pairs = overlap._anchors(n0, n1, 8)
    one, two = meet._gathered(rows_(iter([batch])), (3, 3))
    found = set()
    for i, j in meet.met(one, two):
        x = pairs([c[i] for c in one], [c[j] for c in two])
        found |= set(zip(*(v.tolist() for v in x.values())))
    return found, len(one[0]) + len(two[0])


def test_few_rows_and_no_pairs_from_tails_of_one_letter():
    r = rng(21)
    seqs = [dna(r, 80 + i % 7) + "G" * (70 - i % 7) for i in range(60)] + [dna(r, 150) for _ in range(60)]
    found, n = _met(seqs, 40, 60)
    assert len(found) < 200 and n < 115 * len(seqs)  # all windows of 30 and 40 letters on both strands would be 460 rows a sequence


def test_repeats_other_letters_and_short_fronts_against_all_pairs(spark):
    r = rng(22)
    core, unit = dna(r, 90), "AC" * 40
    seqs = ["G" * 50 + core[:40], "G" * 45 + core[:40] + "T", core[:45] + "A" * 60, "T" * 66 + rc(core[20:45]), "A" * 75, "A" * 70 + "C" + "A" * 9, unit, unit[1:] + core[:9], "N" * 66, "N" * 64 + "AC", core, core[30:] + unit[:33], rc(core[10:70]), core[:35] + "R" + core[36:80], core[5:35] + "Ä" + core[36:], core[5:40] + "C" * 30]
    seqs += [s[: len(s) // 2] + r.choice("ACGT") + s[len(s) // 2 + 1 :] for s in seqs[:14]]
    seqs = list(dict.fromkeys(seqs))
    for n0, n1 in ((40, 60), (7, 31)):
        want = []
        for i, a in enumerate(seqs):
            for j in range(i + 1, len(seqs)):
                b = seqs[j]
                if _overlaps(a, b, n0, n1) or _overlaps(rc(a), rc(b), n0, n1):
                    want.append((i, j, 1))
                elif _overlaps(a, rc(b), n0, n1) or _overlaps(rc(a), b, n0, n1):
                    want.append((i, j, -1))
        assert rows(overlap.overlap_edges(_set(spark, seqs), n0=n0, n1=n1)) == sorted(want, key=repr)


def test_only_what_the_roots_reach_is_compared(spark, monkeypatch):
    r = rng(51)
    texts = {}
    for name, n in (("a", 12), ("b", 30)):  # two chains of overlaps
        genome = dna(r, 40 * n + 100)
        texts |= {f"{name}{i:02d}": genome[40 * i : 40 * i + 100] if i % 3 else rc(genome[40 * i : 40 * i + 100]) for i in range(n)}
    seqs = spark.createDataFrame(list(texts.items()), "idx string, seq string")
    every = overlap.overlap_edges(seqs, n0=40, n1=60)
    seen = lambda df: sorted(map(tuple, df.collect()))
    for start, rounds in (("a00", 20), ("a06", 3), ("b29", 1), ("none", 4)):
        monkeypatch.setattr(overlap, "NEAR_ROUNDS", rounds)
        roots = spark.createDataFrame([(start, 1)], "id string, orientation int")
        near = overlap.overlap_edges(seqs, n0=40, n1=60, reached_from=roots)
        assert seen(overlap.seed_connected(near, roots)) == seen(overlap.seed_connected(every, roots))
        if rounds == 20:
            assert seen(near) == [x for x in seen(every) if x[0] < "b"] != []


def test_few_pairs_from_shared_stretches_and_tails(spark, monkeypatch):
    met = []
    monkeypatch.setattr(overlap, "meeting", lambda *a: met.append(meet.meeting(*a)) or met[-1])
    r = rng(61)
    stretch = dna(r, 60)
    # a stretch in the midst of different texts, tails of one letter of different lengths, and texts of little but that letter
    seqs = [dna(r, 20 + i) + stretch + dna(r, 70 - i) for i in range(50)] + [dna(r, 90 - i) + "G" * (60 + i) for i in range(40)]
    seqs += ["G" * 140, "G" * 131, "G" * 70 + "A" + "G" * 60, "G" * 35 + "T" + "G" * 100]
    want = []
    for i, a in enumerate(seqs):
        for j in range(i + 1, len(seqs)):
            if o := next((o for o, b in ((1, seqs[j]), (-1, rc(seqs[j]))) if _overlaps(a, b, 40, 60) or _overlaps(b, a, 40, 60)), 0):
                want.append((i, j, o))
    assert rows(overlap.overlap_edges(_set(spark, seqs), n0=40, n1=60)) == sorted(want, key=repr)
    assert len(want) > 100
    assert met[0].count() < 6 * len(want)


def test_other_letters_overlap_on_either_strand(spark):
    r = rng(62)
    seqs = [dna(r, 30) + "N" * 45, dna(r, 33) + "N" * 47, "N" * 44 + dna(r, 31)]
    assert rows(overlap.overlap_edges(_set(spark, seqs), n0=40, n1=60)) == [(0, 1, -1), (0, 2, 1), (1, 2, 1)]
