"""Most frequent items among billions, in bounded memory (problem 1).

External sort and run-length counting: each input task cuts its values into runs of bounded length and
combines equal values of a run into one counted row, so a value that fills a third of all rows sends one
row a run. The counted values are range-partitioned and sorted by Spark (which spills), and one scan over
each range adds up neighbouring rows and keeps the range's best in a bounded heap.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.session import cut

#: Values of one run; the memory of an input task is bounded by it.
RUN_ROWS = 200_000
#: Values that one range keeps.
HEAP = 10_000


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0

    def run() -> pa.RecordBatch:
        counted = pc.value_counts(pa.chunked_array(held))
        return pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], ["value", "n"])

    for batch in batches:
        held.append(batch.column(0))
        rows += len(batch)
        if rows >= RUN_ROWS:
            yield run()
            held, rows = [], 0
    if held:
        yield run()


def _scan(heap_size: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap: list[tuple[int, str]] = []  # the smallest count on top
        total, last, count = 0, None, 0

        def keep(n: int, value: str) -> None:
            if len(heap) < heap_size:
                heapq.heappush(heap, (n, value))
            elif n > heap[0][0]:
                heapq.heapreplace(heap, (n, value))

        for batch in batches:
            if not len(batch):
                continue
            encoded = pc.run_end_encode(batch.column(0))
            sums = pc.cumulative_sum(batch.column(1)).to_numpy(zero_copy_only=False)
            counts = np.diff(sums[encoded.run_ends.to_numpy(zero_copy_only=False) - 1], prepend=0)
            total += int(sums[-1])
            if encoded.values[0].as_py() == last:
                counts[0] += count
            elif last is not None:
                keep(count, last)
            last, count = encoded.values[-1].as_py(), int(counts[-1])
            good = np.flatnonzero(counts[:-1] > (heap[0][0] if len(heap) >= heap_size else 0))
            if len(good) > heap_size:
                good = good[np.argpartition(counts[good], -heap_size)[-heap_size:]]
            for n, value in zip(counts[good].tolist(), encoded.values.take(pa.array(good)).to_pylist()):
                keep(n, value)
        if last is not None:
            keep(count, last)
        kept = sorted(heap, key=lambda x: (-x[0], x[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([v for _, v in kept] + [None], pa.string()), pa.array([c for c, _ in kept] + [total], pa.int64())], ["value", "n"]
        )

    return scan


def frequent_items(df: DataFrame, value: Column, field_name: str, *, min_share: float | None = None, top: int | None = None, heap: int = HEAP, ranges: int | None = None) -> DataFrame:
    """The most frequent values of ``value``: ``(field_name, item, n, share)``.

    ``min_share`` keeps values of at least that share of the rows with a value; ``top`` the most frequent
    ones (ties by the value's bytes). Null and blank values count neither as items nor as rows; an empty
    table gives no rows; every row counts, repeated ones too. Counts are exact for each value that a heap
    kept. A range's heap holds ``heap`` values and at least as many as ``min_share`` or ``top`` can ask
    for, so no value asked for is lost; memory is bounded by ``heap`` and ``RUN_ROWS`` whatever the number
    of rows or of distinct values.
    """
    if min_share is not None:
        heap = max(heap, int(1 / min_share) + 1)
    if top is not None:
        heap = max(heap, top)
    values = df.select(value.alias("value")).where("length(value) > 0")
    runs = values.mapInArrow(_runs, "value string, n bigint")
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = cut(runs.repartitionByRange(n, "value").sortWithinPartitions("value").mapInArrow(_scan(heap), "value string, n bigint"))
    total = kept.where("value is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = kept.where("value is not null").select(F.lit(field_name).alias("field_name"), F.col("value").alias("item"), "n", (F.col("n") / F.lit(max(total, 1))).alias("share"))
    if min_share is not None:
        out = out.where(F.col("n") >= math.ceil(Fraction(str(min_share)) * total))
    if top is not None:
        out = out.orderBy(F.desc("n"), "item").limit(top)
    return out
