"""Trimming of reads: low-quality ends, adapters, runs of one base; low-quality and low-complexity pairs go."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Window and mean Phred of the ends' trimming; least mean of a read; least share of good bases; shortest read.
WINDOW, END_MEAN, READ_MEAN, GOOD_PHRED, BAD_SHARE, MIN_LENGTH = 4, 10, 10, 10, 0.4, 15
#: Least run of one base at the end, with one other base allowed in eight; least share of changing neighbours.
POLY_MIN, POLY_ONE_IN, COMPLEXITY = 10, 8, 0.3
#: One mismatch in so many letters of an adapter is allowed; letters of it that count at a read's end.
ADAPTER_ONE_IN, ADAPTER_LEAST = 8, 5
#: Letters of padded reads that are compared with the adapters at once.
CELLS = 4_000_000


def _padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of the texts, one a row with zeros behind its end, and their lengths."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    cells = np.zeros((len(texts), int(size.max(initial=0))), np.uint8)
    cells[np.arange(cells.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8)
    return cells, size


def _blocks(size: np.ndarray) -> Iterator[np.ndarray]:
    """The places of texts of about equal length, as many as ``CELLS`` allow at once."""
    order = np.argsort(size, kind="stable")
    a = 0
    while a < len(order):
        b = len(order)
        while b > a + 1 and (b - a) * (size[order[b - 1]] + 1) > CELLS:
            b = a + (b - a) // 2
        yield order[a:b]
        a = b


def _moved(cells: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The part of each row from start on, zeros behind its size."""
    at = np.arange(int(size.max(initial=0)))
    part = np.take_along_axis(cells, np.minimum(start[:, None] + at, max(cells.shape[1] - 1, 0)), axis=1) if cells.shape[1] else cells[:, :0]
    part[at >= size[:, None]] = 0
    return part


def _before_adapters(text: np.ndarray, size: np.ndarray, adapters: tuple[str, ...]) -> np.ndarray:
    """The letters of each row before the first place where an adapter stands, in whole or cut off by the row's end.

    Each adapter is compared at every place, with one mismatch in ``ADAPTER_ONE_IN`` of the letters that are there;
    the next adapter is looked for in what the ones before have left.
    """
    text, top = text.copy(), text.shape[1]
    at = np.arange(top)
    for adapter in adapters:
        known = np.frombuffer(adapter.encode("latin-1", "replace"), np.uint8)
        if not top or not len(known):
            continue
        wrong = np.zeros(text.shape, np.int32)
        for j, letter in enumerate(known[:top]):
            part = text[:, j:]  # zeros stand behind the end and are no mismatch
            wrong[:, : top - j] += (part != letter) & (part != 0)
        there = size[:, None] - at
        hit = (there >= min(ADAPTER_LEAST, len(known))) & (wrong <= np.minimum(there, len(known)) // ADAPTER_ONE_IN)
        size = np.where(hit.any(axis=1), hit.argmax(axis=1), size)
        text[at >= size[:, None]] = 0
    return size


def before_adapters(parts: list[str], adapters: tuple[str, ...]) -> np.ndarray:
    """``_before_adapters`` of texts of any length."""
    left = np.zeros(len(parts), np.int64)
    for rows in _blocks(np.array([len(x) for x in parts], np.int64)):
        left[rows] = _before_adapters(*_padded([parts[i] for i in rows]), adapters)
    return left


def _good_part(phred: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of what lies between the bad ends of each row; size 0 if no window is good."""
    if phred.shape[1] < WINDOW:
        return np.zeros_like(size), np.zeros_like(size)
    sums = np.cumsum(np.pad(phred, ((0, 0), (1, 0))), axis=1)
    good = (sums[:, WINDOW:] - sums[:, :-WINDOW] >= END_MEAN * WINDOW) & (np.arange(phred.shape[1] - WINDOW + 1) <= (size - WINDOW)[:, None])
    first, last = good.argmax(axis=1), good.shape[1] - 1 - good[:, ::-1].argmax(axis=1)
    return first, np.where(good.any(axis=1), last + WINDOW - first, 0)


def _final_run(text: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The letters of each row's final run of one base, with few others in it; 0 if it is too short."""
    if not text.shape[1]:
        return np.zeros_like(size)
    back = np.arange(text.shape[1])
    turned = np.take_along_axis(text, np.clip(size[:, None] - 1 - back, 0, None), axis=1)
    inside = back < size[:, None]
    other = (turned != turned[:, :1]) & inside
    over = other & (np.cumsum(other, axis=1) > (back + 1) // POLY_ONE_IN)
    stop = np.where(over.any(axis=1), over.argmax(axis=1), size)
    run = np.where(~other & (back < stop[:, None]), back + 1, 0).max(axis=1)
    return np.where(run >= POLY_MIN, run, 0)


def kept_parts(seqs: list[str], quals: list[str], adapters: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of what each mate keeps without bad ends, adapters and a final run of one base; size 0 where that is
    not good enough, or the quality is not as long as the sequence. All mates of a block are worked out at once."""
    start, size = np.zeros(len(seqs), np.int64), np.array([len(s) if len(s) == len(q) and len(s) >= MIN_LENGTH else 0 for s, q in zip(seqs, quals)], np.int64)
    able = np.flatnonzero(size)
    for some in _blocks(size[able]):
        rows = able[some]
        letters, n = _padded([seqs[i] for i in rows])
        phred = _padded([quals[i] for i in rows])[0].astype(np.int32) - 33
        a, n = _good_part(np.where(np.arange(phred.shape[1]) < n[:, None], phred, 0), n)
        text = _moved(letters, a, n)
        n = _before_adapters(text, n, adapters)
        n -= _final_run(text, n)
        there = np.arange(text.shape[1]) < n[:, None]
        q = np.where(there, _moved(phred, a, np.full_like(n, text.shape[1])), 0)
        whole = np.maximum(n, 1)
        change = ((text[:, 1:] != text[:, :-1]) & there[:, 1:]).sum(axis=1) / np.maximum(n - 1, 1)
        bad = (q.sum(axis=1) < READ_MEAN * n) | (((q < GOOD_PHRED) & there).sum(axis=1) / whole > BAD_SHARE) | (change < COMPLEXITY)
        start[rows], size[rows] = a, np.where((n < MIN_LENGTH) | bad, 0, n)
    return start, size


def trim_mate(seq: str, qual: str, adapters: tuple[str, ...]) -> tuple[str, str] | None:
    """What one mate keeps, and its quality; None where that is not good enough."""
    (a,), (n,) = kept_parts([seq], [qual], adapters)
    return (seq[a : a + n], qual[a : a + n]) if n else None


def trim_reads(reads: DataFrame, adapters: DataFrame) -> DataFrame:
    """The pairs of which both mates are good enough, trimmed. Mates without a quality as long as themselves are not."""
    known = tuple(sorted(r[0].strip().upper() for r in adapters.select("seq").where("seq is not null").distinct().collect()))
    columns = reads.columns

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {c: batch.schema.get_field_index(c) for c in ("fwd_seq", "fwd_qual", "rev_seq", "rev_qual")}
            cols = {c: pc.utf8_trim_whitespace(batch.column(i).fill_null("")) for c, i in at.items()}
            texts = {c: (pc.utf8_upper(x) if c.endswith("seq") else x).to_pylist() for c, x in cols.items()}
            parts = {m: kept_parts(texts[f"{m}_seq"], texts[f"{m}_qual"], known) for m in ("fwd", "rev")}
            keep = np.flatnonzero((parts["fwd"][1] > 0) & (parts["rev"][1] > 0))
            out = {c: [texts[c][i][a : a + n] for i, a, n in zip(keep.tolist(), parts[c[:3]][0][keep].tolist(), parts[c[:3]][1][keep].tolist())] for c in at}
            kept = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([pa.array(out[c], pa.string()) if c in out else kept.column(j) for j, c in enumerate(columns)], columns)

    return reads.mapInArrow(trim, reads.schema)
