"""Consolidating pairwise matches into groups (problem 3).

Union-find runs within partitions of the links and keeps only a spanning forest of each, as stars around the node of
smallest salted hash. The forests are merged level by level in partitions of a bounded number of links, and
contracted on the way: what goes up a level are links between the roots that nodes settled on
(``readloom.operators.components``), until one partition holds the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.links import codes, linked, roots
from readloom.functions.seqs import bare_read_id
from readloom.operators.components import TASK_LINKS, connected_components


def _order(names: pa.Array, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the names by salted hash, equal hashes by the names' bytes; the hashes in that order."""
    text = names.to_pylist()
    h = np.array([xxhash.xxh64_intdigest(t, level) >> 1 for t in text], np.int64)
    order = np.argsort(h, kind="stable")
    if (h[order[1:]] == h[order[:-1]]).any():
        order = np.array(sorted(range(len(text)), key=lambda i: (h[i], text[i].encode())))
    return order, h[order]


def _forest(level: int, task_links: int):
    """Stars ``(node, root, h)`` of at most about ``task_links`` links at a time."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        names, a, b = codes(*linked(held))
        order, h = _order(names, level)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        up = roots(rank[a], rank[b], len(order))
        node = np.flatnonzero(up != np.arange(len(up)))
        return pa.RecordBatch.from_arrays([names.take(pa.array(order[node])), names.take(pa.array(order[up[node]])), pa.array(h[up[node]])], ["node", "root", "h"])

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, len(batch), task_links):
                held.append(batch.slice(at, task_links))
                n += len(held[-1])
                if n >= task_links:
                    yield stars(held)
                    held, n = [], 0
        if n:
            yield stars(held)

    return forest


def merged_forests(task_links: int):
    """The stars of each level: spanning forests of partitions with about ``task_links`` links each."""

    def stars(links: DataFrame, level: int, parts: int | None) -> DataFrame:
        lie = links if parts is None else links.repartition(parts, "a")
        return lie.mapInArrow(_forest(level, task_links), "node string, root string, h bigint")

    return stars


def read_links(matches: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(a, b)``: the links of both tables between two named reads, ids bare, links of a read with itself left out."""
    found = matches.select(bare_read_id("src_read_id").alias("a"), bare_read_id("dst_read_id").alias("b"))
    told = pairs.where("exemplar_id is not null").select(bare_read_id("read_id").alias("a"), bare_read_id("exemplar_id").alias("b"))
    return found.unionByName(told).where("a is not null and b is not null and a != b")


def read_groups(matches: DataFrame, pairs: DataFrame, *, task_links: int = TASK_LINKS) -> DataFrame:
    """``(read_id, group_id)`` of each read in a group of two or more; group_id is the group's smallest read_id.

    Null and blank ids make no link; empty tables give no rows; ids without a row in ``pairs`` count; repeated and
    turned links count once; other columns are not read. A read with very many links sends at most one a
    partition up a level. Levels grow with the logarithm of the links, also where reads match in long chains.
    """
    found = connected_components(read_links(matches, pairs), task_links=task_links, stars=merged_forests(task_links))
    return found.select(F.col("node").alias("read_id"), F.col("component").alias("group_id"))
