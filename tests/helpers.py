"""Small tables and plain versions of the operators, for comparison."""

import random

RC = str.maketrans("ACGTN", "TGCAN")


def rc(s):
    return s[::-1].translate(RC)


def canon(s):
    return min(s, rc(s))


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


PAIR_DDL = "source string, ordinal bigint, read_id string, fwd_header string, fwd_seq string, fwd_qual string, rev_header string, rev_seq string, rev_qual string, exemplar_id string, received_at timestamp_ntz"


def pair(read_id, fwd, rev, *, fq=None, rq=None, source="s", ordinal=0, exemplar=None, at=None):
    fq = fq if fq is not None or fwd is None else "F" * len(fwd.strip())
    rq = rq if rq is not None or rev is None else "F" * len(rev.strip())
    return (source, ordinal, read_id, f"@{read_id} 1", fwd, fq, f"@{read_id} 2", rev, rq, exemplar, at)


def pairs(spark, rows):
    return spark.createDataFrame(rows, PAIR_DDL)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def components(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def rng(seed=1):
    return random.Random(seed)
