"""Evaluation texts leaking into training text (problem 6).

A positional inverted index of the corpus: for each term, the documents and places that hold it, in blocks sorted by
term. A passage of n words of a test item, of which at most n/8 are changed, missing or added, holds a run of at least
``RUN`` = 5 words that stand unchanged (n - n/8 words in at most n/8 + 1 runs). For each run of 5 words of an item the
lists of its terms are intersected at their offsets, from the rarest term on: each posting of that term gives a
document and an offset between document and item, the second rarest term must stand there too, then the other
three. Documents and items with a whole run in common are compared word by word for the longest passage within the
allowed changes: the exact phrase, or the near one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.forum_text import words
from readloom.session import cut

#: Unchanged words that a passage within the allowed changes holds in a row at least.
RUN = 5
#: Cells of the passages' tables that are worked out at once.
CELLS = 1_000_000


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([words(t) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))], ["id", "terms"])


def term_lists(texts: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """``(id, terms)`` of every text with an id, kept: the words in order, as they are compared."""
    return cut(texts.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(_terms, "id bigint, terms array<string>"))


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = pc.list_value_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
        words_ = batch.column(1).flatten().dictionary_encode()
        if not len(words_):
            continue
        by_name = pc.sort_indices(words_.dictionary).to_numpy(zero_copy_only=False)
        rank = np.empty(len(by_name), np.int32)
        rank[by_name] = np.arange(len(by_name), dtype=np.int32)
        code = rank[words_.indices.to_numpy(zero_copy_only=False)]
        order = np.argsort(code, kind="stable")  # texts and places stay in order
        text = np.repeat(np.arange(len(batch)), size)[order]
        place = (np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size))[order].astype(np.int32)
        code = code[order]
        other = np.append(True, code[1:] != code[:-1])
        at = np.flatnonzero(other)
        texts = np.add.reduceat(np.append(True, other[1:] | (text[1:] != text[:-1])).astype(np.int64), at)
        ends = pa.array(np.append(at, len(code)).astype(np.int32))
        ids = batch.column(0).take(pa.array(text))
        yield pa.RecordBatch.from_arrays([words_.dictionary.take(pa.array(by_name)), pa.array(texts), pa.ListArray.from_arrays(ends, ids), pa.ListArray.from_arrays(ends, pa.array(place))], ["term", "texts", "ids", "places"])


def positional_index(lists: DataFrame) -> DataFrame:
    """``(term, texts, ids, places)``, kept: the postings of every term of ``term_lists``.

    One row a term and block of texts, blocks sorted by term: the number of texts that hold it, and for each place in
    order the text and the place. Made block by block, so nothing is shuffled and no term, however common, is in one row.
    """
    return cut(lists.mapInArrow(_postings, "term string, texts bigint, ids array<bigint>, places array<int>"))


def run_matches(index: DataFrame, tests: DataFrame) -> DataFrame:
    """``(doc_id, item_id, shift)``: offsets at which a whole run of ``RUN`` words of the item stands in the document.

    Lists are intersected from the rarest term on; a run with a term that the corpus lacks is nowhere.
    """
    vocabulary = tests.select(F.explode("terms").alias("term")).distinct()
    held = cut(index.join(vocabulary, "term", "left_semi"))
    rarity = held.groupBy("term").agg(F.sum("texts").alias("texts"))
    run = tests.where(F.size("terms") >= RUN).select(F.col("id").alias("item_id"), "terms", F.explode(F.sequence(F.lit(0), F.size("terms") - RUN)).alias("start"))
    placed = run.select("item_id", "start", F.posexplode(F.slice("terms", F.col("start") + 1, RUN)).alias("j", "term")).join(rarity, "term")
    # a run's words, the rarest first, with their places in the item
    runs = placed.groupBy("item_id", "start").agg(F.sort_array(F.collect_list(F.struct("texts", "term", (F.col("start") + F.col("j")).alias("q")))).alias("r")).where(F.size("r") == RUN)
    runs = cut(runs.select("item_id", "start", F.col("r").getItem(0).alias("a"), F.col("r").getItem(1).alias("b"), F.slice("r", 3, RUN - 2).alias("rest")))
    postings = held.select("term", F.explode(F.arrays_zip("ids", "places")).alias("p")).select("term", F.col("p.ids").alias("doc_id"), F.col("p.places").alias("place"))

    def there(places: DataFrame) -> DataFrame:
        """The rows whose term stands in the document at the item's place and the offset."""
        wanted = places.withColumn("place", F.col("q") + F.col("shift"))
        return wanted.join(postings, ["term", "doc_id", "place"], "left_semi")

    first = postings.join(runs.select("item_id", "start", F.col("a.term").alias("term"), F.col("a.q").alias("q"), F.col("b.term").alias("term2"), F.col("b.q").alias("q2")), "term")
    two = there(first.select("doc_id", "item_id", "start", (F.col("place") - F.col("q")).alias("shift"), F.col("term2").alias("term"), F.col("q2").alias("q"))).select("doc_id", "item_id", "start", "shift")
    rest = two.join(runs.select("item_id", "start", F.explode("rest").alias("x")), ["item_id", "start"]).select("doc_id", "item_id", "start", "shift", "x.term", "x.q")
    whole = there(rest).groupBy("doc_id", "item_id", "start", "shift").agg(F.count("*").alias("n")).where(F.col("n") == RUN - 2)
    return whole.select("doc_id", "item_id", "shift").distinct()


def _passages(docs: tuple[np.ndarray, np.ndarray], items: tuple[np.ndarray, np.ndarray], pair: np.ndarray, shift: np.ndarray, least: int, one_in: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, changes) of the longest passage of each pair of a document and an item: item words in a row, found with at
    most one change in ``one_in``; zeros if none.

    docs and items are flat words and offsets, one text a pair; pair and shift say at which offsets a run stands. A passage
    strays from the offset of its unchanged run by no more places than it has changes, so only that band of offsets is
    gone through. reach[x, e, d]: the most item words that end at the current item word, on offset d of band x, with
    e changes. All bands of about the same length, all offsets and numbers of changes are worked out at once.
    """
    (doc, doc_at), (item, item_at) = docs, items
    size, changes = np.zeros(len(item_at) - 1, np.int64), np.zeros(len(item_at) - 1, np.int64)
    length = np.diff(item_at)[pair]
    order = np.argsort(length, kind="stable")
    order = order[length[order] >= least]
    none = np.int32(-(10**6))
    a = 0
    while a < len(order):
        edits = int(length[order[a]]) // one_in
        width = 2 * edits + 1
        some = order[a : a + max(1, CELLS // ((edits + 1) * width))]
        some = some[length[some] // one_in == edits]
        a += len(some)
        x, n = pair[some], length[some]
        first = doc_at[x] + shift[some] - edits
        need = np.maximum(least, one_in * np.arange(edits + 1))
        reach = np.full((len(some), edits + 1, width), none, np.int32)
        reach[:, 0] = 0
        best = np.zeros(len(some), np.int64)  # words, above the fewest changes
        for i in range(int(n.max())):
            at = (first + i)[:, None] + np.arange(width)
            there = (at >= doc_at[x][:, None]) & (at < doc_at[x + 1][:, None])
            same = there & (doc[np.clip(at, 0, len(doc) - 1)] == item[np.minimum(item_at[x] + i, len(item) - 1)][:, None])
            now = np.where(same[:, None, :], reach + 1, none)
            np.maximum(now[:, 1:], reach[:, :-1] + 1, out=now[:, 1:])  # changed
            np.maximum(now[:, 1:, :-1], reach[:, :-1, 1:] + 1, out=now[:, 1:, :-1])  # missing
            for e in range(1, edits + 1):
                np.maximum(now[:, e, 1:], now[:, e - 1, :-1], out=now[:, e, 1:])  # added
            most = now.max(axis=2).astype(np.int64)
            good = (most >= need) & (i < n)[:, None]
            np.maximum(best, np.where(good, most * (edits + 1) + edits - np.arange(edits + 1), 0).max(axis=1), out=best)
            np.maximum(now[:, 0], 0, out=now[:, 0])
            reach = now
        words_, fewest = best // (edits + 1), edits - best % (edits + 1)
        key = np.zeros(len(size), np.int64)
        np.maximum.at(key, x, np.where(best > 0, words_ * (1 << 20) + (1 << 19) - fewest, 0))
        old = np.where(size > 0, size * (1 << 20) + (1 << 19) - changes, 0)
        better = key > old
        size[better], changes[better] = key[better] >> 20, (1 << 19) - (key[better] & ((1 << 20) - 1))
    return size, changes


def _verify(least: int, one_in: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            both = [batch.column(i) for i in (3, 4)]
            codes = pa.chunked_array([c.flatten() for c in both]).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            doc_at, item_at = (np.append(0, np.cumsum(pc.list_value_length(c).to_numpy(zero_copy_only=False))).astype(np.int64) for c in both)
            n_shifts = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            shift = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            size, changes = _passages((codes[: doc_at[-1]], doc_at), (codes[doc_at[-1] :], item_at), np.repeat(np.arange(len(batch)), n_shifts), shift, least, one_in)
            good = np.flatnonzero(size)
            ids = [batch.column(i).take(pa.array(good)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(size[good]), pa.array(changes[good])], ["doc_id", "item_id", "n_words", "n_changes"])

    return verify


def leaked_passages(docs: DataFrame, items: DataFrame, *, least: int = 12, one_in: int = 8) -> DataFrame:
    """``(doc_id, item_id, n_words, n_changes)`` of each document that holds a passage of an item.

    A passage is at least ``least`` consecutive words of the item, of which at most one in ``one_in`` is
    changed, missing or added; the longest is reported. Each document and item stands once, also if the
    document holds several passages; items with the same passage are each reported. n_changes 0 is the exact phrase.
    Null or empty texts and null ids match nothing; empty tables give no rows; other columns are not read. The offsets
    of a document and an item are at most as many as the document has words.
    """
    lists, tests = term_lists(docs, "doc_id"), term_lists(items, "item_id")
    met = run_matches(positional_index(lists), tests).groupBy("doc_id", "item_id").agg(F.sort_array(F.collect_list("shift")).alias("shifts"))
    pairs = met.join(lists.select(F.col("id").alias("doc_id"), F.col("terms").alias("doc_terms")), "doc_id").join(tests.select(F.col("id").alias("item_id"), F.col("terms").alias("item_terms")), "item_id")
    return pairs.select("doc_id", "item_id", "shifts", "doc_terms", "item_terms").mapInArrow(_verify(least, one_in), "doc_id bigint, item_id bigint, n_words bigint, n_changes bigint")
