"""Reading sorted partitions as whole runs of a key, in bounded memory."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def complete_runs(batches, target: int = 65536, limit: int = 65536):
    """(crowded, table) pieces of batches sorted by their first column, a long.

    A piece that isn't crowded holds whole runs only. A run of more than ``limit`` rows
    comes as crowded pieces, in order, as they are read.
    """
    held, rows, crowded = [], 0, None
    for b in batches:
        if crowded is not None and b.num_rows:
            n = int(np.searchsorted(b.column(0).to_numpy(), crowded, side="right"))
            if n:
                yield True, pa.Table.from_batches([b.slice(0, n)])
            b = b.slice(n)
            if b.num_rows:
                crowded = None
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < target:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(0).to_numpy()
        start = int(np.searchsorted(keys, keys[-1]))
        if start:
            yield False, table.slice(0, start)
        rest = table.slice(start)
        if rest.num_rows > limit:
            crowded = keys[-1]
            yield True, rest
            held, rows = [], 0
        else:
            held, rows = rest.to_batches(), rest.num_rows
    if held:
        yield False, pa.Table.from_batches(held).combine_chunks()


def unseen(most: int = 500_000):
    """A test that is true for a text's name when a task meets it first. After ``most``
    names it begins anew, which only lets some copies through again."""
    names: set[int] = set()

    def new(name: int) -> bool:
        if name in names:
            return False
        if len(names) >= most:
            names.clear()
        names.add(name)
        return True

    return new


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before it in any of the columns."""
    out = np.zeros(len(columns[0]), dtype=bool)
    if len(out):
        out[0] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def batch(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()]
    arrays = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))
