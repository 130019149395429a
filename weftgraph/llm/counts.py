"""Sums of the tasks' tables of numbers: tables of a fixed number of cells, in chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

COLUMNS = "chunk int, counts binary"


def chunked(cells: np.ndarray, chunk: int, kind: str = "<u8") -> pa.RecordBatch:
    """A task's numbers as rows of ``COLUMNS``, ``chunk`` cells in each."""
    rows = cells.astype(kind).reshape(-1, chunk)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(rows), dtype=np.int32)), pa.array([r.tobytes() for r in rows], type=pa.binary())],
        names=["chunk", "counts"],
    )


def summed(chunks: DataFrame, cells: int, chunk: int, kind: str = "<u8") -> np.ndarray:
    """The total of all tasks' tables, on the driver.

    Each chunk is summed by one task, row by row as they come, so neither a task nor
    the driver holds more than ``cells`` numbers, whatever the number of tables.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = np.frombuffer(counts, dtype=kind)
                sums[at] = sums[at] + new if at in sums else new
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), type=pa.int32()), pa.array([s.tobytes() for s in sums.values()], type=pa.binary())],
            names=["chunk", "counts"],
        )

    total = np.zeros(cells, dtype=kind)
    parts = chunks.select("chunk", "counts").repartition(-(-cells // chunk), "chunk").mapInArrow(run, COLUMNS)
    for row in parts.toLocalIterator():
        total[row["chunk"] * chunk : (row["chunk"] + 1) * chunk] = np.frombuffer(row["counts"], dtype=kind)
    return total
