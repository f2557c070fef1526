import os

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from readloom import session
from readloom.functions import packed as P
from readloom.functions import runs as R
from readloom.functions import seqs as S
from tests.helpers import canon, dna, rc, rng


def test_kmers_and_strands(spark):
    df = spark.createDataFrame([("ACGTN",), ("AC",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(S.kmers(F.col("s"), 3)).collect()]
    assert got == [["ACG", "CGT", "GTN"], [], [], []]
    got = [r[0] for r in df.select(S.canonical_kmers(F.col("s"), 3)).collect()]
    assert got == [["ACG", "ACG"], [], [], []]
    assert df.select(S.reverse_complement(F.lit("acGTNx"))).first()[0] == "xNACgt"
    assert df.select(S.reverse_complement_iupac(F.lit("ACGTURYSWKMBDHVNr"))).first()[0] == "yNBDHVKMWSRYAACGT"


def test_kept_tables_and_their_folder(spark, tmp_path):
    from types import SimpleNamespace

    kept = session.cut(spark.range(3))
    path = kept.inputFiles()[0].rpartition("/")[0].removeprefix("file:").replace("//", "/")
    assert kept.count() == 3 and os.path.isdir(path)
    assert session.drop_kept(spark) >= 1 and not os.path.exists(path) and session.drop_kept(spark) == 0
    # on a cluster an unset folder is an error, and a set one is taken
    set_to = []
    context = SimpleNamespace(getCheckpointDir=lambda: set_to[-1] if set_to else None, setCheckpointDir=set_to.append, master="spark://host")
    with pytest.raises(ValueError, match="all executors share"):
        session.shared_folder(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))
    assert session.shared_folder(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: "hdfs://x"))) == "hdfs://x"


def test_bare_ids_and_blanks(spark):
    ids = ["r1", "@r1", " r1/1 ", "@r1/2\t", "r1/3", "", " @ ", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in ids], "x string").select(S.bare_read_id("x")).collect()]
    assert got == ["r1", "r1", "r1", "r1", "r1/3", None, None, None]
    assert spark.range(1).select(S.clean_seq(F.lit("\t acgn \r\n"))).first()[0] == "ACGN"


@settings(max_examples=60, deadline=None)
@given(st.text("ACGTNacgtn", max_size=80), st.integers(1, 31))
def test_packing_matches_plain(s, k):
    codes, offsets = P.flat(pa.array([s, "AC"]))
    assert offsets.tolist() == [0, len(s), len(s) + 2]
    codes = codes[: len(s)]
    u = s.upper()
    ok = P.windows_ok(codes, k)
    windows = [u[i : i + k] for i in range(len(u) - k + 1)]
    assert ok.tolist() == ["N" not in w for w in windows]
    good = np.flatnonzero(ok)
    fwd, back = P.pack(codes, k)[good] if len(good) else [], P.pack_rc(codes, k)[good] if len(good) else []
    if len(good):
        assert P.unpack_strings(fwd, k).to_pylist() == [windows[i] for i in good]
        assert P.unpack_strings(back, k).to_pylist() == [rc(windows[i]) for i in good]
        assert (P.rc_packed(fwd, k) == back).all()
        assert P.unpack_strings(np.minimum(fwd, back), k).to_pylist() == [canon(windows[i]) for i in good]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=40), st.integers(1, 12))
def test_slide_min(values, w):
    got = P.slide_min(np.array(values, np.uint32), w).tolist()
    assert got == [min(values[i : i + w]) for i in range(len(values) - w + 1)]


def test_mix_is_one_to_one():
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(P.mix32(x))) == len(x)


def test_more_ranges_take_longer_minimizers():
    assert R.shape(21) == R.shape(21, 8_000) == (10, 12)
    for ranges in (10_000, 1_000_000, 10_000_000):
        m, w = R.shape(21, ranges)
        assert m + w == 22 and 4**m >= 2 * 64 * ranges
    codes, _ = P.flat(pa.array([dna(rng(3), 300) + "N"]))
    for ranges in (1, 50_000, 30_000_000):
        bases, size, at, part = R.cut_runs(codes, 21, ranges)
        assert size.sum() == 280 and size.max() <= R.shape(21, ranges)[1] and part.max() < ranges
    with pytest.raises(ValueError):
        R.shape(32)


@pytest.mark.parametrize("k", [5, 21, 31])
def test_runs_count_every_kmer_by_label(k, monkeypatch):
    """Through blocks of several ranges, with merged runs, and with more labels than fit beside a k-mer."""
    r = rng(k)
    texts = [dna(r, r.randint(0, 90)) + r.choice(["N", "NN"]) for _ in range(60)] * 2
    label = [r.randrange(9) for _ in texts]
    want = {}
    for t, x in zip(texts, label):
        for i in range(len(t) - k + 1):
            if "N" not in t[i : i + k]:
                want[canon(t[i : i + k]), x] = want.get((canon(t[i : i + k]), x), 0) + 1
    codes, offsets = P.flat(pa.array(texts))
    bases, size, at, part = R.cut_runs(codes, k, 3)
    by = np.array(label)[np.searchsorted(offsets, at, side="right") - 1]
    for terms in (10**6, 50):
        monkeypatch.setattr(R, "RUN_TERMS", terms)
        got = {}
        for number in range(3):
            counter = R.Counter(k)
            for half in (slice(None, len(at) // 2), slice(len(at) // 2, None)):
                for p, *block in R.blocks(bases[half], size[half], by[half], part[half]):
                    if p == number:
                        counter.add(*block)
            x, names, n = counter.result()
            got |= {(a, b): c for a, b, c in zip(P.unpack_strings(x, k).to_pylist(), names.tolist(), n.tolist())}
        assert got == want
