"""Frequency of every distinct term, and in how many records it stands (problem 2).

A range-partitioned external sort of (term, record) pairs with a run-length scan. A term is a canonical
k-mer. Two facts make the pairs small enough to move:

* All occurrences of a record's terms start in one row, so the record's identifier is needed only to tell
  a term's first occurrence in its record from later ones. It travels as that one bit.
* Terms are ordered by (scattered minimizer, term), and neighbours travel as one packed run
  (``readloom.functions.runs``). Equal runs of a block of records are combined with a count before the shuffle: a
  sequence that fills a third of all rows sends one entry a block.

Each range task expands its entries in bounded runs, sorts and combines each run, and scans the merged
runs: equal terms are neighbours, their lengths are the occurrences and the numbers of records.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions import packed as P
from readloom.functions import runs as R
from readloom.functions.seqs import clean_seq
from readloom.llm.common import mates, records

#: Entries that a map task holds before it sends a block to each range.
BLOCK_ENTRIES = 2_000_000
_FIRST, _AGAIN, _ASKED = 0, 1, 2
_U = np.uint64


def _first_in_record(term: np.ndarray, ok: np.ndarray, record: np.ndarray, k: int) -> np.ndarray:
    """False where the term stood before in the same record."""
    at = np.flatnonzero(ok)
    first = np.ones(len(term), bool)
    if not len(at):
        return first
    t, r = term[at], record[at].astype(_U)
    if 2 * k + int(r[-1]).bit_length() <= 64:
        key = np.sort((r << _U(2 * k)) | t)
        again = np.unique(key[1:][key[1:] == key[:-1]] >> _U(2 * k))  # records in which any term is repeated
        if not len(again):
            return first
        which = np.zeros(int(r[-1]) + 1, bool)
        which[again.astype(np.int64)] = True
        sub = which[r.astype(np.int64)]
        at, t, r = at[sub], t[sub], r[sub]
    order = np.lexsort((at, t, r))
    t, r, at = t[order], r[order], at[order]
    first[at[1:][(t[1:] == t[:-1]) & (r[1:] == r[:-1])]] = False
    return first


def _entries(text: pa.Array, asked: np.ndarray, k: int, ranges: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bases, terms, what they are, range) of the entries of a batch."""
    codes, offsets = P.flat(text)
    n = len(codes) - k + 1
    kind = np.zeros(max(n, 0), np.uint8)
    if n > 0:
        term = np.minimum(P.pack(codes, k), P.pack_rc(codes, k))
        record = np.repeat(np.arange(len(text), dtype=np.int32), np.diff(offsets))[:n]
        kind = np.where(asked[record], _ASKED, np.where(_first_in_record(term, P.windows_ok(codes, k), record, k), _FIRST, _AGAIN)).astype(np.uint8)
    bases, size, at, part = R.cut_runs(codes, k, ranges, kind)
    return bases, size, kind[at], part


def _blocks(k: int, ranges: int) -> Callable:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def send() -> pa.RecordBatch:
            rows = R.blocks(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if t == "int" else pa.binary()) for x, t in zip(zip(*rows), R.BLOCK.values())], list(R.BLOCK))

        for batch in batches:
            found = _entries(batch.column(0), batch.column(1).to_numpy(zero_copy_only=False), k, ranges)
            if len(found[0]):
                held.append(found)
                if sum(len(x[0]) for x in held) >= BLOCK_ENTRIES:
                    yield send()
        if held:
            yield send()

    return blocks


def _count(k: int, at_least: int | None) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = R.Counter(k)
        for batch in batches:
            for block in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                counter.add(*block)
        term, kind, n = counter.result()
        if not len(term):
            return
        at = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        held_by = np.add.reduceat(np.where(kind == _FIRST, n, 0), at)
        stands = np.add.reduceat(np.where(kind == _ASKED, 0, n), at)
        asked = np.add.reduceat((kind == _ASKED).astype(np.int64), at) > 0
        good = np.flatnonzero((held_by >= at_least) | asked) if at_least is not None else np.arange(len(at))
        for a in range(0, len(good), 100_000):
            g = good[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([P.unpack_strings(term[at[g]], k), pa.array(stands[g]), pa.array(held_by[g]), pa.array(asked[g])], ["kmer", "occurrences", "records", "asked"])

    return count


def term_counts(texts: DataFrame, asked: DataFrame | None = None, *, k: int = 21, at_least: int | None = None, ranges: int) -> DataFrame:
    """``(kmer, occurrences, records, asked)`` for every term of ``texts`` (one row a record, column ``text``).

    Mates of one record are joined by a letter outside ACGT. ``asked`` holds sequences (column ``text``)
    whose terms are reported in any case, with zeros if no record has them. ``at_least`` leaves out other
    terms of fewer records: after counting, before rows leave the task.
    """
    rows = texts.select("text", F.lit(False).alias("asked"))
    if asked is not None:
        rows = rows.unionByName(asked.select("text", F.lit(True).alias("asked")))
    blocks = rows.mapInArrow(_blocks(k, ranges), ", ".join(f"{c} {t}" for c, t in R.BLOCK.items()))
    return blocks.repartitionById(ranges, F.col("part")).mapInArrow(_count(k, at_least), "kmer string, occurrences bigint, records bigint, asked boolean")


def term_statistics(pairs: DataFrame, seqs: DataFrame, *, k: int = 21, common_share: float = 0.005, rare_records: int = 3, marked_only: bool = False) -> DataFrame:
    """``(kmer, occurrences, records, asked, common, rare)`` over all read pairs.

    A record is a distinct non-null read_id, counted once however often it was delivered; occurrences
    count within records. ``common``: in at least ``common_share`` of all records; ``rare``: a term of a
    ``seqs`` row of kind seed in fewer than ``rare_records`` records, also in none. Null, empty and short
    sequences have no terms; windows with letters outside ACGT are none. ``marked_only`` returns the marked
    terms alone; all are counted either way.
    """
    n, bases = mates(pairs).agg(F.count_distinct("read_id"), F.coalesce(F.sum(F.length("fwd") + F.length("rev")), F.lit(0))).first()
    ranges = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(bases / R.RANGE_TERMS))
    need = max(1, math.ceil(Fraction(str(common_share)) * n))
    texts = records(pairs).select(F.concat_ws("N", "fwd", "rev", F.lit("")).alias("text"))
    seeds = seqs.where("lower(trim(kind)) = 'seed' and seq is not null").select(F.concat(clean_seq("seq"), F.lit("N")).alias("text"))
    out = term_counts(texts, seeds, k=k, at_least=need if marked_only else None, ranges=ranges)
    out = out.withColumn("common", F.col("records") >= need).withColumn("rare", F.col("asked") & (F.col("records") < rare_records))
    return out.where("common or rare") if marked_only else out
