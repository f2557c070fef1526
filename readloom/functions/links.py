"""Union-find over the links of one task, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of the nodes 0 to n - 1 the smallest that the links ``a[i]``, ``b[i]`` connect it to.

    Each round hooks roots on the smallest root that they are linked to, shortens all ways to a root, and drops the
    links within a tree.
    """
    up = np.arange(n)
    while len(a):
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while ((over := up[up]) != up).any():
            up = over
        a, b = up[a], up[b]
        a, b = a[a != b], b[a != b]
    return up


def linked(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    """The first two string columns of all batches."""
    held = [(x.column(0), x.column(1)) for x in batches if len(x)]
    return tuple(pa.concat_arrays([h[i] for h in held]) if held else pa.array([], pa.string()) for i in (0, 1))


def codes(a: pa.Array, b: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The names that stand in either array, and both arrays as places among them."""
    both = pa.concat_arrays([a, b]).dictionary_encode()
    at = both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return both.dictionary, at[: len(a)], at[len(a) :]


def smallest_linked(a: pa.Array, b: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The names in order of their bytes, and for each the place of the smallest name that it is connected to."""
    names, x, y = codes(a, b)
    order = pc.sort_indices(names).to_numpy(zero_copy_only=False)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return names.take(pa.array(order)), roots(rank[x], rank[y], len(order))
