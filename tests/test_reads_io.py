import gzip

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readloom.operators import pileup, trim
from readloom.sinks import fasta_text, fastq_text, high_freq_fasta, kmer_fasta, write_fastq, write_metrics
from readloom.sources import fastq as src
from readloom.streaming import search
from tests.helpers import dna, pair, pairs, rc, rng, rows


def _text(n, start=0):
    out = []
    for i in range(start, start + n):
        for m, s in ((1, "ACGT"), (2, "TTGG")):
            out.append(f"@r{i}/{m} x\n{s}\n+\nFFFF\n")
    return "".join(out)


def test_fastq_source(spark, tmp_path):
    (tmp_path / "a.fastq").write_text(_text(3))
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(_text(2, 3).rstrip("\n"))
    with pa.output_stream(str(tmp_path / "c.fq.zst"), compression="zstd") as f:
        f.write(_text(4, 5).encode())
    (tmp_path / "empty.fastq").write_text("")
    spark.dataSource.register(src.FastqDataSource)
    got = spark.read.format("readpairs").load(str(tmp_path))
    assert sorted(r["read_id"] for r in got.collect()) == sorted(f"r{i}" for i in range(9))
    one = got.where("read_id = 'r6'").first()
    assert (one["ordinal"], one["fwd_seq"], one["rev_seq"], one["rev_header"]) == (1, "ACGT", "TTGG", "@r6/2 x")
    assert one["source"].endswith("-c")
    (tmp_path / "bad.fastq").write_text("@r\nAC\n+\n")
    with pytest.raises(Exception, match="not whole"):
        spark.read.format("readpairs").load(str(tmp_path / "bad.fastq")).collect()


def test_fastq_by_address_and_wildcards(spark, tmp_path):
    (tmp_path / "a1.fastq").write_text(_text(3))
    (tmp_path / "a2.fastq").write_text(_text(2, 3))
    (tmp_path / "b.fastq").write_text(_text(2, 9))
    (tmp_path / "notes.txt").write_text("none")
    spark.dataSource.register(src.FastqDataSource)
    for path, n in ((f"file://{tmp_path}", 7), (f"file://{tmp_path}/a*.fastq", 5), (f"{tmp_path}/a?.fastq", 5), (f"file://{tmp_path}/b.fastq", 2), (f"{tmp_path}/none*", 0)):
        assert len(src.read_files(path)) == {7: 3, 5: 2, 2: 1, 0: 0}[n] and all(("://" in x) == ("://" in path) for x in src.read_files(path))
        assert n == 0 or spark.read.format("readpairs").load(path).count() == n
    assert src.name_of_path(src.read_files(f"file://{tmp_path}/b.fastq")[0]) == src.name_of_path(f"{tmp_path}/b.fastq")
    with pytest.raises(ValueError):
        src.read_files("nosuch://bucket/x")


def test_fastq_round_trip(spark, tmp_path):
    df = pairs(spark, [pair(f"r{i}", "ACGTAC", "TTGACC", source="s1", ordinal=i) for i in range(5)])
    write_fastq(df, str(tmp_path / "out"), compression="gzip")
    files = sorted((tmp_path / "out").glob("source=*/*.gz"))
    text = "".join(gzip.open(f, "rt").read() for f in files)
    assert text.split("\n")[0::8][:5] == [f"@r{i} 1" for i in range(5)]
    tagged = fastq_text(df).where("ordinal = 0").first()["value"].split("\n")
    assert tagged[0] == "@r0 1 s1" and tagged[4] == "@r0 2 s1" and tagged[5] == "TTGACC"


def test_paths(spark):
    paths = ["s3://b/x/y.fastq.zst", "s3://b/x-y.FQ.ZST", "http://b/z.fastq.zst", "s3://b/q.fasta", "s3://b/" + "l" * 260 + ".fq.zst", " s3://b/x/y.fastq.zst ", None, ""]
    got = {r["s3_path"]: (r["filename"], r["problem"]) for r in src.source_records(spark.createDataFrame([(p,) for p in paths], "s3_path string")).collect()}
    assert got["s3://b/x/y.fastq.zst"] == ("b-x-y", "repeated") and got["s3://b/x-y.FQ.ZST"] == ("b-x-y", "repeated")
    assert got["http://b/z.fastq.zst"][1] == "scheme" and got["s3://b/q.fasta"][1] == "extension"
    assert [v[1] for k, v in got.items() if "lll" in k] == ["length"] and len(got) == 5
    assert src.name_of_path("s3://b/x/y.fastq.zst") == "b-x-y"
    files = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1)], "path string, priority int")
    assert rows(src.paths_by_priority(files, 1)) == [("a", 1), ("c", 1)] and src.paths_by_priority(files, 9).count() == 0
    with pytest.raises(ValueError, match="missing: 1"):
        src.paths_by_priority(files.where("priority = 2"), 2)
    gaps = spark.createDataFrame([("a", 1), ("b", 4), ("c", None)], "path string, priority int")
    assert rows(src.missing_priorities(gaps)) == [(2,), (3,)] and src.missing_priorities(gaps.limit(0)).count() == 0
    with pytest.raises(ValueError, match="missing: 2, 3"):
        src.paths_by_priority(gaps, 1)
    listed = spark.createDataFrame([("/d/x.fastq.zst",), ("y.fastq.zst",)], "path string")
    assert rows(src.uris(listed, "s3://b/p")) == [("/d/x.fastq.zst", "s3://b/p/x.fastq.zst"), ("y.fastq.zst", "s3://b/p/y.fastq.zst")]
    with pytest.raises(ValueError):
        src.uris(listed, "/b/p")
    names = spark.createDataFrame([("a/s1_1.fastq",), ("s2_2.fastq",), ("s3_3.fastq",), ("t_1.fastq.gz",)], "path string")
    assert [r[0] for r in names.select(src.sample_name(F.col("path"))).collect()] == ["s1", "s2", "s3_3.fastq", "t_1.fastq.gz"]


def test_fasta_and_sam(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">a first one\nACGT\nAC\n>b\nTT")
    assert rows(src.read_fasta(spark, str(tmp_path / "x.fasta"))) == [(0, "a", "a first one", "ACGTAC"), (1, "b", "b", "TT")]
    seqs = spark.createDataFrame([(0, "a", None, "A" * 65)], "idx int, id string, description string, seq string")
    assert fasta_text(seqs).first()["value"] == ">a\n" + "A" * 60 + "\n" + "A" * 5
    assert high_freq_fasta(spark.createDataFrame([("ACG", 8)], "kmer string, max_count bigint")).first()[0] == ">kmer_max_8_obs\nACG"
    (tmp_path / "x.sam").write_text("@HD\tVN:1\nq\t16\tc1\t5\t60\t2S3M1I\t*\t0\t0\tACGTAC\tFFFFFF\n")
    got = src.read_sam(spark, str(tmp_path / "x.sam")).first()
    assert (got["qname"], got["flag"], got["pos"], [(x["op"], x["len"]) for x in got["cigar"]]) == ("q", 16, 4, [("S", 2), ("M", 3), ("I", 1)])
    assert src.read_sam(spark, str(tmp_path / "x.sam"), "c1").count() == 1 and src.read_sam(spark, str(tmp_path / "x.sam"), "c2").count() == 0
    (tmp_path / "y.fasta").write_text("\n>a b\r\nAC\r\ngt\r\n>\nTT\n>c>d\n\nG\n")
    got = rows(src.read_fasta(spark, str(tmp_path / "y.fasta")).select("id", "description", "seq"))
    assert sorted(got) == sorted([("a", "a b", "ACgt"), ("", "", "TT"), ("c>d", "c>d", "G")])
    many = src.read_fasta(spark, str(tmp_path / "x.fasta"))
    assert [tuple(src.contig_by_name(many, n).first())[1:] for n in ("a", "a first one", "b")] == [("a", "a first one", "ACGTAC")] * 2 + [("b", "b", "TT")]
    assert src.contig_by_name(src.read_fasta(spark, str(tmp_path / "y.fasta")), "a").first()["seq"] == "ACGT"
    with pytest.raises(ValueError):
        src.contig_by_name(many, "first")
    words = spark.createDataFrame([("TTTTTTTT",), ("AAAAAAAA",), ("AAAAAACC",), ("CCCCCCCC",)], "kmer string").repartition(3)
    assert rows(kmer_fasta(words)) == [(i + 1, f">kmer_{i + 1}\n{w}") for i, w in enumerate(["AAAAAAAA", "AAAAAACC", "CCCCCCCC", "TTTTTTTT"])]
    write_metrics([{"iteration": 1}], str(tmp_path / "m.json"))
    assert "iteration" in (tmp_path / "m.json").read_text()


def test_trim(spark):
    good = "ACGTTGCAACGGTACCATGCATTGCAGTCA"
    assert trim.trim_mate(good, "F" * 30, ()) == (good, "F" * 30)
    assert trim.trim_mate(good, "#" * 6 + "F" * 24, ())[0] == good[3:] or trim.trim_mate(good, "#" * 6 + "F" * 24, ())[0] in good
    assert trim.trim_mate(good + "GATTACAGATTACA", "F" * 44, ("GATTACAGATTACA",))[0] == good
    assert trim.trim_mate(good + "GATTACAG", "F" * 38, ("GATTACAGATTACA",))[0] == good
    assert trim.trim_mate(good + "G" * 14, "F" * 44, ())[0].rstrip("G") == good
    assert trim.trim_mate("A" * 40, "F" * 40, ()) is None and trim.trim_mate(good, "#" * 30, ()) is None
    assert trim.trim_mate(good, "F" * 29, ()) is None and trim.trim_mate("", "", ()) is None
    adapters = spark.createDataFrame([("GATTACAGATTACA",), (None,)], "seq string")
    df = pairs(spark, [pair("a", good, good), pair("b", good, None), pair("c", "A" * 40, good), pair("d", good.lower(), good + "GATTACAGATTACA")])
    got = {r["read_id"]: (r["fwd_seq"], r["rev_seq"]) for r in trim.trim_reads(df, adapters).collect()}
    assert got == {"a": (good, good), "d": (good, good)}


def _first_adapter(part, adapters, least=5):
    for a in adapters:
        for at in range(len(part) - min(least, len(a)) + 1):
            there = part[at : at + len(a)]
            if sum(x != y for x, y in zip(there, a)) <= len(there) // 8:
                part = part[:at]
                break
    return len(part)


def test_adapters_with_mismatches_and_cut_off(spark, monkeypatch):
    good, adapter = "ACGTTGCAACGGTACCATGCATTGCAGTCA", "GATTACAGATTACA"
    assert trim.trim_mate(good + "GACTACAGATTACA", "F" * 44, (adapter,))[0] == good  # a mismatch in the first 8 letters
    assert trim.trim_mate(good + "GATTA", "F" * 35, (adapter,))[0] == good  # fewer than 8 letters are there
    assert trim.trim_mate(good + "GACTACAGATTCCA", "F" * 44, (adapter,))[0] == good + "GACTACAGATTCCA"
    df = pairs(spark, [pair("a", good + "GATTACTGATTACA", good + "GATTACA")])
    got = trim.trim_reads(df, spark.createDataFrame([(adapter,), ("",)], "seq string")).first()
    assert (got["fwd_seq"], got["rev_seq"], len(got["rev_qual"])) == (good, good, 30)
    r = rng(23)
    adapters = (adapter, "ACG", dna(r, 24))
    parts = [""] + ["".join(r.choice("ACGTN") if r.random() < 0.1 else c for c in dna(r, r.randrange(60)) + r.choice(adapters + ("",))[: r.randrange(30)] + dna(r, r.choice([0, 0, 5]))) for _ in range(400)]
    want = [_first_adapter(p, adapters) for p in parts]
    assert trim.before_adapters(parts, adapters).tolist() == want and len({w == len(p) for w, p in zip(want, parts)}) == 2
    monkeypatch.setattr(trim, "CELLS", 500)
    assert trim.before_adapters(parts, adapters).tolist() == want


CIGAR = "source string, ordinal bigint, read_id string, mate string, flag int, idx int, pos int, cigar array<struct<op:string,len:int>>, seq string"
KEYS = ["source", "ordinal", "read_id", "mate"]


def test_cigar_rules(spark):
    contig = spark.createDataFrame([(0, "ACGTACGTAC")], "idx int, seq string")
    al = [
        ("s", 0, "q", "fwd", 0, 0, 2, [("S", 1), ("M", 3), ("I", 2), ("D", 1), ("M", 2), ("S", 1)], "TGTAGGGAT"),
        ("s", 0, "q", "rev", 0, 0, 8, [("H", 3), ("=", 1), ("X", 1), ("M", 1)], "AAA"),
        ("s", 1, "u", "fwd", 4, 0, 0, [("M", 3)], "ACG"),
        ("s", 2, "n", "fwd", 0, 0, 0, None, "ACG"),
    ]
    at = spark.createDataFrame([(0, 3), (0, 4), (0, 9)], "id int, pos int")
    bases = pileup.decode(spark.createDataFrame(al, CIGAR), contig, seeds_at=at, keys=KEYS)
    got = sorted((r["mate"], r["pos"], r["kind"], r["base"], r["seed"]) for r in bases.collect())
    assert got == sorted([
        ("fwd", 1, "clip", "T", False), ("fwd", 2, "match", "G", False), ("fwd", 3, "match", "T", True), ("fwd", 4, "match", "A", True),
        ("fwd", 4, "insertion", "G", False), ("fwd", 4, "insertion", "G", False), ("fwd", 5, "deletion", "-", False), ("fwd", 6, "match", "G", False), ("fwd", 7, "mismatch", "A", False), ("fwd", 8, "clip", "T", False),
        ("rev", 8, "match", "A", False), ("rev", 9, "mismatch", "A", True), ("rev", 10, "mismatch", "A", False),
    ])
    pair_row = pileup.pileup_pairs(bases, at).first()
    assert (pair_row["start"], pair_row["cells"], pair_row["insertions_at"], pair_row["contains_seed"]) == (1, "S=ssD=XSxX", [4], True)
    cols = {r["pos"]: r for r in pileup.pileup_columns(bases).collect()}
    assert (cols[4]["depth"], cols[4]["insertions"], cols[5]["deletions"], cols[8]["clips"], cols[8]["depth"]) == (1, 2, 1, 1, 1)


def test_pairs_of_alignments(spark):
    one = [("M", 4)]
    al = [("q", 16, "c1", 9, one, "ACGT"), ("q", 0, "c1", 2, one, "ACGT"), ("q", 256, "c1", 0, one, "ACGT"), ("q", 0, "c2", 5, one, "ACGT"), ("u", 4, "c1", 0, one, "ACGT"), ("n", 0, "c1", 0, None, "ACGT"), ("e", 0, "c1", 0, [], "ACGT")]
    al += [("three", 0, "c1", i, one, "ACGT") for i in range(3)]
    df = spark.createDataFrame(al, "qname string, flag int, ref_name string, pos int, cigar array<struct<op:string,len:int>>, seq string")
    got = pileup.paired_alignments(df)
    assert sorted((r["read_id"], r["ref_name"], r["mate"], r["pos"]) for r in got.collect()) == [("q", "c1", 1, 2), ("q", "c1", 2, 9), ("q", "c2", 1, 5)]
    shown = spark.createDataFrame([("s", 2, "a", 0, 5, [1, 2]), ("s", 1, "b", 0, 5, None), ("s", 9, "c", 0, -3, [4]), ("s", 0, "d", 1, 0, None)], "source string, ordinal bigint, read_id string, idx int, start int, insertions_at array<int>")
    assert [r["read_id"] for r in pileup.pileup_rows(shown).collect()] == ["c", "b", "a", "d"]
    assert rows(pileup.pileup_bounds(shown)) == [(0, -3, 5, 2), (1, 0, 0, 0)]


def test_reads_are_placed_where_they_come_from(spark):
    r = rng(20)
    contig = dna(r, 300)
    other = dna(r, 200)
    data, where = [], {}
    for i in range(20):
        a = r.randrange(200)
        s = contig[a : a + 80]
        data.append(pair(f"r{i:02d}", s if i % 2 else rc(s), dna(r, 60), ordinal=i))
        where[f"r{i:02d}"] = (0, a, 0 if i % 2 else 16)
    data.append(pair("clip", dna(r, 20) + contig[100:150], other[10:60].lower(), ordinal=99))
    on = spark.createDataFrame([(0, contig), (1, other)], "idx int, seq string")
    got = {(x["read_id"], x["mate"]): x for x in pileup.place_reads(pairs(spark, data), on, k=15).collect()}
    assert all((got[n, "fwd"]["idx"], got[n, "fwd"]["pos"], got[n, "fwd"]["flag"]) == w for n, w in where.items())
    c = got["clip", "fwd"]
    assert c["pos"] in range(95, 101) and c["cigar"][0]["op"] == "S" and got["clip", "rev"]["idx"] == 1
    assert len(got) == 22


def test_streams(spark, tmp_path):
    seq = dna(rng(21), 60)
    df = pairs(spark, [pair("a", seq, seq), pair("b", dna(rng(22), 60), ""), pair("a", seq.lower(), seq)])
    df.write.parquet(str(tmp_path / "in"))
    wanted = spark.createDataFrame([(min(seq[:21], rc(seq[:21])),)], "kmer string")
    stream = search.stream_filter(search.stream_pairs(spark, str(tmp_path / "in"), df.schema), wanted, 21)
    search.land(stream.select("read_id"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "a"]
    firsts = search.first_deliveries(search.stream_pairs(spark, str(tmp_path / "in"), df.schema)).select("read_id")
    search.land(firsts, str(tmp_path / "out2"), str(tmp_path / "cp2")).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out2")).collect()) == ["a", "b"]
    timed = df.withColumn("received_at", F.lit("2031-01-01 00:10:00").cast("timestamp_ntz"))
    assert search.deliveries(timed).first()["n"] == 3


def test_first_deliveries_of_many_batches_in_any_order(spark, tmp_path):
    days = ["2032-03-01", "2031-01-05", None, "2031-06-01", "2031-01-01"]
    seq = dna(rng(24), 30)
    for i, day in enumerate(days):
        df = pairs(spark, [pair(f"only{i}", seq, seq), pair("again", seq, seq)]).withColumn("received_at", F.lit(day).cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = search.land(search.first_deliveries(stream).select("read_id"), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == len(days)
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["again"] + [f"only{i}" for i in range(len(days))]
