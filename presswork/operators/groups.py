"""Tables of many small groups handed to numpy some hundred groups at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presswork.session import ship

#: First row of its group.
FIRST = "_first"


def _pieces(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows (the last one: what is left) that end
    where a group ends. Only the group that a batch cuts waits for the next."""
    wait: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        starts = np.flatnonzero(b.column(FIRST).to_numpy(zero_copy_only=False))
        cut = int(starts[-1]) if len(starts) else 0
        if len(starts) and n + cut >= rows:
            yield pa.Table.from_batches([*wait, b.slice(0, cut)]).combine_chunks()
            wait, n, b = [], 0, b.slice(cut)
        if b.num_rows:
            wait.append(b)
            n += b.num_rows
    if n:
        yield pa.Table.from_batches(wait).combine_chunks()


def whole_groups(df: DataFrame, group: str, columns: Sequence[str], order: str,
                 solve: Callable[[pa.Table], pa.RecordBatch | Iterable[pa.RecordBatch]], schema: str, rows: int = 50_000) -> DataFrame:
    """``solve`` on tables of whole groups (null is a group of its own).

    A window by ``group`` brings a group's rows together: it is met by the
    partitioning and the order that ``df`` has where these are by group and
    ``order``, and marks the first row of each group. A task holds about
    ``rows`` rows, or one group where that is larger.
    """
    ship(df.sparkSession)
    at = Window.partitionBy(group).orderBy(order)
    marked = df.select(group, *columns).withColumn(FIRST, F.row_number().over(at) == 1)

    def run(batches):
        for t in _pieces(batches, rows):
            got = solve(t)
            yield from [got] if isinstance(got, pa.RecordBatch) else got

    return marked.mapInArrow(run, schema)


def numbers(col: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Values as 0, 1, ... in order of appearance, and the values."""
    c = pc.dictionary_encode(col, null_encoding="encode").combine_chunks()
    c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
    return c.indices.to_numpy(zero_copy_only=False).astype(np.int64), c.dictionary


def group_numbers(t: pa.Table) -> tuple[np.ndarray, pa.Array]:
    """The number of each row's group (first column), and the groups' keys."""
    first = t.column(FIRST).to_numpy()
    ids = t.column(0).combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    return np.cumsum(first) - 1, ids.take(pa.array(np.flatnonzero(first)))
