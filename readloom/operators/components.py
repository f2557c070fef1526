"""Connected components of billions of links by contraction."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.links import linked, smallest_linked
from readloom.session import cut

#: Links that one task joins at once.
TASK_LINKS = 50_000
#: Levels beyond those that thirds falling off at each would need; more mean that links do not contract.
SPARE_LEVELS = 12

#: Makes of links ``(a, b)`` stars ``(node, root, h)``: level's salt, number of partitions (None: as they lie).
Stars = Callable[[DataFrame, int, int | None], DataFrame]


def turned(links: DataFrame, level: int, parts: int | None) -> DataFrame:
    """Each link as a star of its own: its end of larger salted hash, and the other as the root, with that hash."""
    one, two = (F.struct(F.xxhash64(F.lit(level), c).alias("h"), F.col(c).alias("v")) for c in ("a", "b"))
    ends = links.select(F.greatest(one, two).alias("x"), F.least(one, two).alias("y"))
    return ends.select(F.col("x.v").alias("node"), F.col("y.v").alias("root"), F.col("y.h").alias("h")).distinct()


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of all links of one task: each node but the smallest, with the smallest."""
    a, b = linked(batches)
    if len(a):
        names, root = smallest_linked(a, b)
        yield pa.RecordBatch.from_arrays([names.filter(pa.array(root != range(len(root)))), names.take(pa.array(root[root != range(len(root))]))], ["node", "top"])


def connected_components(links: DataFrame, *, task_links: int = TASK_LINKS, stars: Stars = turned) -> DataFrame:
    """``(node, component)`` for each node with a link to another; ``component`` is the smallest node reached.

    ``links`` holds two string columns. Links of a node with itself and with a null side are ignored;
    repeated and turned links count once; an empty table gives no rows.

    A level makes stars of the links, each around its node of the smallest salted hash. A node that has roots is
    settled on that of the smallest hash, and links go on between what their ends settled on. The hash is another one
    at each level, so that of the nodes that have links a third at least is expected to fall away whatever the shape
    of the graph: chains, in any order of their names, as well as hubs. When the stars fit one task's bound, that
    task ends it, and labels run back down the levels by joins.
    """
    a, b = links.columns[:2]
    left = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(F.col(a).alias("a"), F.col(b).alias("b"))
    levels: list[DataFrame] = []
    parts, most = None, 0
    while True:
        found = cut(stars(left, len(levels), parts))
        n = found.count()
        if n <= task_links:
            break
        most = most or SPARE_LEVELS + math.ceil(math.log(n / task_links, 1.5))
        if len(levels) >= most:
            raise RuntimeError(f"{n} links are left after {len(levels)} levels: they do not contract")
        settles = Window.partitionBy("node").orderBy("h", "root")
        level = cut(found.select("node", "root", F.first("root").over(settles).alias("up"), (F.row_number().over(settles) == 1).alias("own")))
        levels.append(level.where("own").select("node", "up"))
        # equal links fall together before they are joined, so a root of very many nodes is looked up a few times only
        between = level.select(F.col("up").alias("a"), F.col("root").alias("node")).distinct()
        left = between.join(levels[-1], "node", "left").select("a", F.coalesce("up", "node").alias("b")).where("a != b")
        parts = math.ceil(n / task_links)
    tops = cut(found.select("node", "root").coalesce(1).mapInArrow(_rest, "node string, top string"))
    for level in reversed(levels[1:]):
        up = tops.withColumnRenamed("node", "up")
        lower = level.join(up, "up", "left").select("node", F.coalesce("top", "up").alias("top"))
        tops = cut(lower.unionByName(tops.join(level.select("node"), "node", "left_anti")))
    if not levels:
        named, lowest = tops.withColumnRenamed("top", "component"), tops
        return named.unionByName(lowest.select(F.col("top").alias("node"), F.col("top").alias("component")).distinct())
    # the smallest node of each component, from the few nodes that the first level left
    first = levels[0]
    held = first.groupBy(F.col("up").alias("node")).agg(F.min("node").alias("low"))
    known = cut(held.join(tops, "node", "full").select("node", F.coalesce("top", "node").alias("top"), F.least("low", "node").alias("low")))
    smallest = known.groupBy("top").agg(F.least(F.min("low"), F.col("top")).alias("component"))
    named = cut(known.join(smallest, "top").select("node", "component"))
    above = named.unionByName(smallest.select(F.col("top").alias("node"), "component")).distinct()
    below = first.join(named.withColumnRenamed("node", "up"), "up").select("node", "component")
    return below.unionByName(above.join(first.select("node"), "node", "left_anti"))
