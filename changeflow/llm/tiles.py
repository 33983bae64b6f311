"""Blocks of query rows against tiles of all rows, for searches that compare a stated query set with everything.

Rows are packed into tiles, tiles are dealt to groups by hash, and each block of
query rows goes to the groups it needs. A task meets one block with all tiles of
a group in a row, so its heaps merge there and leave it once per block and group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block, of a tile, and about so many of a group; what a task holds at a time follows from them.
BLOCK, TILE, GROUP = 256, 2048, 32768


def finite(vector: Column) -> Column:
    """Whether it is an array of numbers, none of them null, infinite or no number."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(good, F.lit(False))


def groups(df: DataFrame, rows: int) -> int:
    """Among so many groups, that all cores have work and a group stays small."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // GROUP))


def matrix(values: pa.ListArray, dim: int, dtype: str) -> np.ndarray:
    """One line for each vector; what a vector lacks at its end is zero."""
    at = values.offsets.to_numpy()
    flat, lengths = values.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]], np.diff(at)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim).astype(dtype)
    out = np.zeros((len(lengths), dim), dtype)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(at[:-1] - at[0], lengths)] = flat
    return out


def packed(batch: pa.RecordBatch, column: str, row: int) -> pa.StructArray:
    """The rows packed into one cell."""
    cell = batch.column(column)
    start, end = cell.offsets[row].as_py(), cell.offsets[row + 1].as_py()
    return cell.values.slice(start, end - start)


class Heaps:
    """For each key the first ``most`` entries by score, higher first, then by smaller id; an id counts once."""

    def __init__(self, most: int, dtype: str) -> None:
        self.most = most
        self.key, self.score, self.id = np.empty(0, np.int64), np.empty(0, dtype), np.empty(0, np.int64)

    def merge(self, key: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        if not len(key):
            return
        key, score, id = np.r_[self.key, key], np.r_[self.score, score], np.r_[self.id, id]
        order = np.lexsort((id, -score, key))
        key, score, id = key[order], score[order], id[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (id[1:] != id[:-1]) | (score[1:] != score[:-1])]
        key, score, id = key[new], score[new], id[new]
        first = np.r_[True, key[1:] != key[:-1]]
        place = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        few = place < self.most
        self.key, self.score, self.id = key[few], score[few], id[few]

    def floors(self, keys: np.ndarray) -> np.ndarray:
        """For each key the last score of its heap if that is full, else the least there is."""
        least = -np.inf if self.score.dtype.kind == "f" else np.iinfo(self.score.dtype).min
        start, end = np.searchsorted(self.key, keys, "left"), np.searchsorted(self.key, keys, "right")
        full = end - start >= self.most
        out = np.full(len(keys), least, self.score.dtype)
        out[full] = self.score[end[full] - 1]
        return out


def meet(blocks: DataFrame, tiles: DataFrame, compare: Callable, schema: str) -> DataFrame:
    """What ``compare`` gives for each block and the tiles of its group.

    ``blocks`` has block, group and a column ``queries`` of packed rows, ``tiles``
    has group, further columns and ``rows``. The blocks are the streamed side of
    the sort-merge join: a block meets its group's tiles one after the other.
    ``compare(queries)`` makes an object with ``add(tile columns, rows)`` and
    ``result() -> RecordBatch``.
    """
    columns = [c for c in tiles.columns if c not in ("group", "rows")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                at = (batch.column("group")[i].as_py(), batch.column("block")[i].as_py())
                if at != now:
                    if held is not None:
                        yield held.result()
                    now, held = at, compare(packed(batch, "queries", i))
                held.add({c: batch.column(c)[i].as_py() for c in columns}, packed(batch, "rows", i))
        if held is not None:
            yield held.result()

    both = blocks.hint("merge").join(tiles, "group").select("group", "block", "queries", *columns, "rows")
    return both.mapInArrow(run, schema)
