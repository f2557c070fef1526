"""Best representative of each duplicate group (problem 4).

Currency reasoning. From reads delivered more than once at known times we learn which kind of value follows which: of
source, exemplar link, and forward and reverse quality. The rows of a group then form a partial order. For the
exemplar and the two mates a row precedes those of better quality, which is what the data's statement asks; among rows
that quality leaves equal, and for the values that the group carries, a dated row precedes later ones, and where a time is
missing the learnt transitions decide. The topologically latest rows, which none follows, survive. Rows of the
same kinds are one node of the order, so a group of any size has a few nodes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.seqs import bare, bare_read_id, clean_seq
from readloom.session import cut

#: A quality string with a character code above this is written with offset 64.
OFFSET_33_MAX = 75


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum and maximum of the character codes of the last two columns, which are then left out."""
    for batch in batches:
        out = [batch.column(i) for i in range(batch.num_columns - 2)]
        for i in (-2, -1):
            texts = batch.column(batch.num_columns + i).cast(pa.large_string()).fill_null("")
            n = len(texts)
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
            raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            if len(raw) and raw.max() > 127:  # code points, where a character is not one byte
                points = [np.array([ord(c) for c in t] or [0], np.int64) for t in texts.to_pylist()]
                total, top = np.array([p.sum() for p in points], np.int64), np.array([p.max() for p in points], np.int64)
            else:
                total, top = np.zeros(n, np.int64), np.zeros(n, np.int64)
                full = np.flatnonzero(offsets[1:] > offsets[:-1])
                if len(full):
                    body = raw[offsets[0] : offsets[-1]]
                    at = (offsets[:-1] - offsets[0])[full]
                    total[full], top[full] = np.add.reduceat(body, at, dtype=np.int64), np.maximum.reduceat(body, at)
            out += [pa.array(total), pa.array(top)]
        yield pa.RecordBatch.from_arrays(out, [f"c{j}" for j in range(len(out))])


#: Fields between whose kinds of values transitions are learnt.
FIELDS = ("source", "exemplar", "fwd_qual", "rev_qual")
#: Those of which a group carries a current value.
CARRIED = ("source", "exemplar")


def _rows(pairs: DataFrame) -> DataFrame:
    """The rows as they are compared: kinds, sizes and sums in place of the strings, so that little is kept and shuffled."""
    name, source, exemplar = bare_read_id("read_id"), bare("source"), bare_read_id("exemplar_id")
    cols = [name.alias("read_id"), source.alias("source"), exemplar.alias("exemplar"), F.col("received_at").cast("timestamp_ntz").alias("at")]
    cols.append(F.when(F.coalesce(F.length(source), F.lit(0)) == 0, "none").otherwise("named").alias("source_kind"))
    cols.append(F.when(exemplar.isNull(), "none").when(exemplar == name, "self").otherwise("other").alias("exemplar_kind"))
    for m in ("fwd", "rev"):
        size, n = (F.coalesce(F.length(x), F.lit(0)) for x in (clean_seq(f"{m}_seq"), bare(f"{m}_qual")))
        cols += [size.alias(f"{m}_len"), ((size > 0) & (n == size)).alias(f"{m}_ok"), (n > 0).alias(f"{m}_told")]
    cols += [F.when(F.length(bare(f"{m}_qual")) == F.length(clean_seq(f"{m}_seq")), bare(f"{m}_qual")) for m in ("fwd", "rev")]
    slim = pairs.select(*cols).where("read_id is not null")
    names = slim.columns[:-2]
    schema = ", ".join(f"c{i} {t}" for i, (_, t) in enumerate(slim.dtypes[:-2])) + "".join(f", c{len(names) + i} bigint" for i in range(4))
    slim = slim.mapInArrow(_sums, schema)
    slim = slim.toDF(*names, "fwd_sum", "fwd_top", "rev_sum", "rev_top")
    for m in ("fwd", "rev"):
        high, flat = F.col(f"{m}_top") > OFFSET_33_MAX, F.col(f"{m}_sum") == F.col(f"{m}_top") * F.col(f"{m}_len")
        phred = F.when(F.col(f"{m}_ok"), F.col(f"{m}_sum") - F.when(high, 64).otherwise(33) * F.col(f"{m}_len")).otherwise(0)
        kind = F.when(~F.col(f"{m}_told"), "none").when(~F.col(f"{m}_ok"), "misfit").when(flat, "flat").when(high, "offset64").otherwise("offset33")
        slim = slim.withColumns({f"{m}_phred": phred, f"{m}_qual_kind": kind}).drop(f"{m}_sum", f"{m}_top", f"{m}_told")
    return slim


def _acyclic(counts: dict[tuple[str, str], int]) -> list[tuple[str, str]]:
    """Pairs (earlier, later) of kinds, closed: the majorities, the clearest first, as long as no circle arises."""
    after: dict[str, set[str]] = {}

    def reaches(a: str, b: str) -> bool:
        return a == b or any(reaches(x, b) for x in after.get(a, ()))

    margins = sorted(((n - counts.get((b, a), 0), a, b) for (a, b), n in counts.items()), key=lambda x: (-x[0], x[1:]))
    for margin, a, b in margins:
        if margin > 0 and not reaches(b, a):
            after.setdefault(a, set()).add(b)
    kinds = sorted({k for pair in counts for k in pair})
    return [(a, b) for a in kinds for b in kinds if a != b and reaches(a, b)]


def learn_precedence(pairs: DataFrame) -> dict[str, list[tuple[str, str]]]:
    """For each field, pairs (earlier, later) of value kinds, learnt from the dated rows of all reads.

    A read's rows are its deliveries; each is compared with the one before. What comes to the driver is one count for each
    field and pair of kinds.
    """
    return _learnt(_rows(pairs))


def _learnt(rows: DataFrame) -> dict[str, list[tuple[str, str]]]:
    dated = rows.where("at is not null").select("read_id", "at", *(f"{f}_kind" for f in FIELDS)).distinct()
    by_time = Window.partitionBy("read_id").orderBy("at", *(f"{f}_kind" for f in FIELDS))
    seen = dated.withColumns({f"{f}_before": F.lag(f"{f}_kind").over(by_time) for f in FIELDS})
    steps = seen.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"{f}_before").alias("before"), F.col(f"{f}_kind").alias("kind")) for f in FIELDS))).alias("x")).select("x.*")
    counts: dict[str, dict[tuple[str, str], int]] = {f: {} for f in FIELDS}
    for r in steps.where("before is not null and before != kind").groupBy("field", "before", "kind").count().collect():
        counts[r["field"]][r["before"], r["kind"]] = r["count"]
    return {f: _acyclic(c) for f, c in counts.items()}


def _follows(field: str, learnt: list[tuple[str, str]], a: Column, b: Column) -> Column:
    """Whether node b of a group's order is later than node a: by their times, or by what is learnt of their kinds."""
    later = F.lit(False)
    for before, after in learnt:
        later = later | ((a[f"{field}_kind"] == before) & (b[f"{field}_kind"] == after))
    return F.when(a["at"].isNotNull() & b["at"].isNotNull(), b["at"] > a["at"]).otherwise(later)


def _latest(nodes: Column, follows) -> Column:
    """The nodes that none follows; all of them if times and learnt transitions run in a circle."""
    last = F.filter(nodes, lambda a: ~F.exists(nodes, lambda b: F.coalesce(follows(a, b), F.lit(False))))
    return F.when(F.size(last) > 0, last).otherwise(nodes)


def representatives(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """``(group_id, exemplar_id, fwd_from, rev_from, n_rows, current_source, current_exemplar)``, one row a group.

    ``groups`` has read_id and group_id. The rows of a group are those of its reads in ``pairs``.
    exemplar_id: most usable mates, then highest mean Phred over the characters of its usable mates, then
    longest sequences, then smallest read_id. fwd_from and rev_from: the row with the best usable quality
    of that mate (mean, length, read_id), null where no row has one. A quality is usable if it is not blank
    and as long as its non-empty sequence. Nulls in any column only make a mate unusable; a group none of
    whose reads has a row has null choices. Repeated rows change nothing. Rows are reduced to a few numbers
    before they are shuffled, and aggregated in parts to the nodes of their group's order, at most one for each combination
    of kinds, dated and undated. current_source and current_exemplar are those of the latest node; of several, a
    dated one's, then the largest value.
    """
    every = cut(_rows(pairs))
    learnt = _learnt(every)
    rows = every.join(groups.select("read_id", "group_id"), "read_id")
    usable = F.col("fwd_ok").cast("int") + F.col("rev_ok").cast("int")
    length = F.when(F.col("fwd_ok"), F.col("fwd_len")).otherwise(0) + F.when(F.col("rev_ok"), F.col("rev_len")).otherwise(0)
    mean = F.when(length > 0, (F.col("fwd_phred") + F.col("rev_phred")) / length).otherwise(F.lit(0.0))
    # what precedes by quality, the best smallest
    rules = {"best": F.struct((-usable).alias("a"), (-mean).alias("b"), (-(F.col("fwd_len") + F.col("rev_len"))).alias("c"), "read_id")}
    for m in ("fwd", "rev"):
        rules[m] = F.when(F.col(f"{m}_ok"), F.struct(F.lit(0).alias("a"), (-F.col(f"{m}_phred") / F.col(f"{m}_len")).alias("b"), (-F.col(f"{m}_len")).alias("c"), "read_id"))
    kinds = [f"{f}_kind" for f in FIELDS]
    carried = [F.max(F.struct("at", F.col(f).alias("value"))).alias(f) for f in CARRIED]
    nodes = rows.groupBy("group_id", *kinds, F.col("at").isNotNull().alias("dated")).agg(F.count("*").alias("n"), F.max("at").alias("at"), *(F.min(rule).alias(name) for name, rule in rules.items()), *carried)
    order = nodes.groupBy("group_id").agg(F.sum("n").alias("n_rows"), F.collect_list(F.struct("dated", "at", *kinds, *rules, *CARRIED)).alias("nodes"))

    def survivor(rule: str, field: str) -> Column:
        able = F.filter("nodes", lambda x: x[rule].isNotNull())
        last = _latest(able, lambda a, b: (b[rule] < a[rule]) | ((b[rule] == a[rule]) & _follows(field, learnt[field], a, b)))
        return F.array_min(F.transform(last, lambda x: x[rule]))["read_id"]

    def current(field: str) -> Column:
        last = _latest(F.col("nodes"), lambda a, b: _follows(field, learnt[field], a, b))
        return F.array_max(F.transform(last, lambda x: F.struct(x["dated"].alias("dated"), x["at"].alias("at"), x[field]["value"].alias("value"))))["value"]

    got = order.select("group_id", "n_rows", survivor("best", "exemplar").alias("exemplar_id"), survivor("fwd", "fwd_qual").alias("fwd_from"), survivor("rev", "rev_qual").alias("rev_from"), *(current(f).alias(f"current_{f}") for f in CARRIED))
    out = groups.select("group_id").distinct().join(got, "group_id", "left")
    return out.select("group_id", "exemplar_id", "fwd_from", "rev_from", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), *(f"current_{f}" for f in CARRIED))


def surviving_pairs(pairs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The built records: ``chosen`` with the sequences and qualities of its mates ``(fwd_seq, fwd_qual, rev_seq, rev_qual)``.

    Only the chosen reads' rows are shuffled with their strings. Of a read's several rows with a usable
    quality the best is taken, as in ``representatives``; then the smallest quality string.
    """
    out = chosen
    for m in ("fwd", "rev"):
        seq, qual = clean_seq(f"{m}_seq"), bare(f"{m}_qual")
        wanted = chosen.where(f"{m}_from is not null").select(F.col(f"{m}_from").alias("read_id")).distinct()
        had = pairs.select(bare_read_id("read_id").alias("read_id"), seq.alias("seq"), qual.alias("qual")).where("length(seq) > 0 and length(qual) = length(seq)").join(wanted, "read_id", "left_semi")
        codes = F.transform(F.split("qual", ""), F.ascii)
        total = F.aggregate(codes, F.lit(0).cast("bigint"), lambda a, x: a + x)
        phred = (total - F.when(F.array_max(codes) > OFFSET_33_MAX, 64).otherwise(33) * F.length("seq")) / F.length("seq")
        best = had.groupBy("read_id").agg(F.min(F.struct((-phred).alias("p"), (-F.length("seq")).alias("l"), "qual", "seq")).alias("best"))
        out = out.join(best.select(F.col("read_id").alias(f"{m}_from"), F.col("best.seq").alias(f"{m}_seq"), F.col("best.qual").alias(f"{m}_qual")), f"{m}_from", "left")
    return out
