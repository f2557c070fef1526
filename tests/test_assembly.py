from collections import Counter

from pyspark.sql import functions as F

from readloom.plans import assemble, loop
from readloom.sources.fastq import read_fasta
from tests.helpers import canon, dna, pair, pairs, rc, rng


def _reads(genome, size=50, step=3, circular=False):
    text = genome + genome[: size + 20] if circular else genome
    at = range(0, len(text) - size - 20 + 1, step)
    return [pair(f"r{i:04d}", text[a : a + size], rc(text[a + 20 : a + 20 + size]), ordinal=i) for i, a in enumerate(at)]


def test_repeat_free_genome_is_one_contig(spark):
    genome = dna(rng(11), 400)
    reads = pairs(spark, _reads(genome, step=1))
    got = assemble.assemble(reads, k=21, min_count=2, min_contig_len=100).collect()
    assert len(got) == 1 and got[0]["seq"] in canon(genome) and len(got[0]["seq"]) >= 390


def test_circle_is_opened_at_its_smallest_kmer(spark):
    genome = dna(rng(12), 150)
    reads = pairs(spark, _reads(genome, step=1, circular=True))
    got = assemble.unitigs(assemble.solid_kmers(reads, 21, 1), 21).collect()
    assert len(got) >= 1 and all(len(g["seq"]) == 150 + 20 for g in got)
    assert all(canon(g["seq"][:150]) in {canon((genome + genome)[i : i + 150]) for i in range(150)} | {canon(rc(genome + genome)[i : i + 150]) for i in range(150)} for g in got)


def test_every_kmer_is_seen_often_enough_and_tips_go(spark):
    r = rng(13)
    genome = dna(r, 300)
    rows = _reads(genome, step=2)
    wrong = list(rows[40][4])
    wrong[44] = "A" if wrong[44] != "A" else "C"  # near a read's end: a tip
    rows.append(pair("e1", "".join(wrong), rows[40][7]))
    reads = pairs(spark, rows)
    counts = Counter(canon(s[i : i + 15]) for x in rows for s in (x[4], x[7]) for i in range(len(s) - 14))
    for least in (1, 2):
        for c in assemble.assemble(reads, k=15, min_count=least, min_contig_len=15, tip_rounds=0).collect():
            assert all(counts[canon(c["seq"][i : i + 15])] >= least for i in range(len(c["seq"]) - 14))
    cleaned = assemble.assemble(reads, k=15, min_count=1, min_contig_len=100)
    assert [canon(c["seq"]) for c in cleaned.collect()] == [canon(genome)]
    assert assemble.assemble(reads.limit(0), k=15).count() == 0


def test_contigs_grow_from_the_seed(spark):
    genome = dna(rng(14), 500)
    reads = pairs(spark, _reads(genome, step=2) + _reads(dna(rng(15), 300), step=3))
    seeds = spark.createDataFrame([(0, rc(genome[240:270]))], "idx int, seq string")
    p = loop.LoopParams(read_k=21, max_iters=8, variants=((21, 1, 60),))
    contigs, metrics = loop.grow_contigs(reads, seeds, p)
    seq = contigs.collect()[0]["seq"]
    assert rc(genome[240:270]) in seq and len(seq) > 300 and canon(seq) in (genome, rc(genome)) or seq in rc(genome)
    sizes = [m["longest_contig_length"] for m in metrics]
    assert sizes == sorted(sizes) and len(metrics) > 2 and metrics[0]["read_pair_count"] > 0
    # too many reads: the seed itself comes out, and the round is not counted
    contigs, metrics = loop.grow_contigs(reads, seeds, loop.LoopParams(excess_reads=1))
    assert metrics == [] and contigs.select("seq").collect()[0][0] == rc(genome[240:270])


def test_acceptance():
    p = loop.LoopParams()
    assert loop.accepted((11, 0), (10, 50), p) and loop.accepted((10, 80), (10, 50), p)
    assert not loop.accepted((10, 79), (10, 50), p) and not loop.accepted((9, 500), (10, 50), p)


def test_stats(spark):
    df = spark.createDataFrame([("AC",), ("ACGT",)], "seq string")
    assert loop.fasta_stats(df) == (4, 6) and loop.fasta_stats(df.where(F.lit(False))) == (0, 0)


def test_registered_growing_is_the_whole_loop(spark, tmp_path, monkeypatch):
    from readloom import catalog

    genome = dna(rng(16), 120)
    pairs(spark, _reads(genome, step=5) * 8).write.parquet(str(tmp_path / "read_pairs.parquet"))
    kinds = [(0, "seed", genome[40:70]), (1, "contig", genome[:100]), (2, "adapter", "GATTACAGATTACAGATTACA")]
    spark.createDataFrame(kinds, "idx int, kind string, seq string").write.parquet(str(tmp_path / "seqs.parquet"))
    calls = []

    def grow(reads, seeds, p, **tables):
        calls.append((p, {k: v.count() for k, v in tables.items()}))
        return seeds, []

    monkeypatch.setattr(loop, "grow_contigs", grow)
    for name in ("grown_contigs", "grown_contigs_overlaps"):
        catalog.queries()[name](spark, str(tmp_path))
    assert [p.overlaps for p, _ in calls] == [False, True]
    for p, tables in calls:
        assert p.max_iters == 20 and tables["warm_start"] == tables["adapters"] == 1 and tables["high_freq"] > 0


def test_from_files_to_files(spark, tmp_path):
    genome = dna(rng(31), 150)
    text = []
    for i, row in enumerate(_reads(genome, step=4) * 3):
        text += [f"@r{i}/1", row[4], "+", "F" * len(row[4]), f"@r{i}/2", row[7], "+", "F" * len(row[7])]
    (tmp_path / "reads.fastq").write_text("\n".join(text) + "\n")
    (tmp_path / "seed.fasta").write_text(">seed\n" + genome[60:100] + "\n")
    p = loop.LoopParams(read_k=15, freq_k=15, max_iters=2, variants=((15, 2, 30),))
    got = loop.run(spark, str(tmp_path / "reads.fastq"), str(tmp_path / "seed.fasta"), str(tmp_path / "out"), p)
    found = [x["seq"] for x in read_fasta(spark, str(tmp_path / "out")).collect()]
    assert got["contig_count"] == len(found) >= 1 and got["longest_contig_length"] == max(map(len, found)) > 40
    assert all(genome[60:100] in x for x in found)
    assert set(loop.final_metrics([]).values()) == {0} and loop.final_metrics([{"iteration": 2}, {"iteration": 1}]) == {"iteration": 2}


def test_ways_joined_where_they_lie_are_those_of_the_joins(spark, monkeypatch):
    from readloom.plans import compact

    r = rng(41)
    genome, ring = dna(r, 700), dna(r, 90)
    genome += genome[100:180] + dna(r, 60) + rc(genome[300:360])
    rows = _reads(genome, step=7) + _reads(genome, step=5) + [(*x[:2], f"c{x[2]}", *x[3:]) for x in _reads(ring, step=1, circular=True)]
    rows += [pair("n1", "A" * 40, "ACGT" * 12), pair("n2", genome[:30] + "N" + genome[31:80], ""), pair("n3", "", "ACG")]
    wrong = list(rows[20][4])
    wrong[45] = "A" if wrong[45] != "A" else "C"
    reads = pairs(spark, rows + [pair("e1", "".join(wrong), rc("".join(wrong)))])
    monkeypatch.setattr(compact, "TASK_LETTERS", 2_000)  # several tasks glue, in several rounds
    made = []
    whole = compact._whole
    monkeypatch.setattr(compact, "_whole", lambda *a: made.append(a) or whole(*a))
    for k, least, tips in ((5, 1, 1), (15, 1, 2), (21, 2, 0), (31, 2, 1)):
        seen = lambda df: sorted((x["seq"], round(x["multiplicity"], 9)) for x in df.collect())
        got = assemble.assemble(reads, k=k, min_count=least, min_contig_len=1, tip_rounds=tips)
        assert seen(got) == seen(assemble._one_strand(assemble._joined_ways(reads, k, least, tips))) != []
    assert made


def test_tables_between_do_not_grow_with_the_contigs(spark, tmp_path, monkeypatch):
    from readloom import catalog
    from readloom.operators import overlap
    from readloom.plans import compact

    genome = dna(rng(42), 900)
    pairs(spark, _reads(genome, size=60, step=4) * 2).write.parquet(str(tmp_path / "read_pairs.parquet"))
    kept = []
    for module in (assemble, compact, overlap):
        cut = module.cut
        monkeypatch.setattr(module, "cut", lambda df, *a, cut=cut: kept.append(1) or cut(df, *a))
    edges = catalog.queries()["contig_overlap_edges"](spark, str(tmp_path)).collect()
    assert edges == [] and len(kept) <= 12  # a plan that the driver holds for each


def test_the_driver_gets_no_letters_of_contigs(spark, monkeypatch):
    from readloom.plans import compact

    r = rng(43)
    genomes = sorted((min(g, rc(g)) for g in (dna(r, 30_000 + i // 2) for i in range(8))), key=lambda g: (-len(g), g))
    reads = pairs(spark, [pair(f"r{i}", g, g) for i, g in enumerate(genomes)])
    ways = compact.ways

    def then_many_ranges(*a):
        found = ways(*a)
        monkeypatch.setattr(compact, "TASK_LETTERS", 60_000)  # of those that sort the contigs
        return found

    monkeypatch.setattr(compact, "ways", then_many_ranges)
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm

    def sent():
        """Bytes a task that each stage sent to the driver; what tells of a task itself is under 10,000."""
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {x.stageId(): x.resultSize() / x.numTasks() for x in map(stages.apply, range(stages.size()))}

    before = sent()
    got = assemble.assemble(reads, k=31)
    assert 0 < max(n for stage, n in sent().items() if stage not in before) < 20_000
    assert [x["seq"] for x in got.orderBy("idx").collect()] == genomes
    assert got.select(F.shiftright("idx", 33).alias("range")).distinct().count() > 1
