"""Whole groups out of a sorted stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 4096) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of the integer column `key`, and the borders of the groups in each.

    The stream must hold the rows of a group next to each other. A table has about `rows` rows, or one larger group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        borders = _borders(table, key)
        if len(borders) > 2:
            yield from _runs(table, borders[:-1], rows)
            held = table.slice(int(borders[-2])).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield from _runs(table, _borders(table, key), rows)


def _runs(table: pa.Table, borders: np.ndarray, rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The groups in runs of about `rows` rows: a batch may hold many more than a caller wants to unfold at once."""
    begin = 0
    while begin < len(borders) - 1:
        end = max(begin + 1, int(np.searchsorted(borders, borders[begin] + rows, "right")) - 1)
        part = table.slice(int(borders[begin]), int(borders[end] - borders[begin])).combine_chunks()
        yield part, borders[begin : end + 1] - borders[begin]
        begin = end


def _borders(table: pa.Table, key: str) -> np.ndarray:
    values = table.column(key).to_numpy()
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
