"""Sums of arrays over all rows of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Tasks that add up the partial sums of all others.
ADDERS = 8


def added_up(df: DataFrame, of: Callable[[pa.RecordBatch], list[np.ndarray]], kind: type) -> list[np.ndarray]:
    """Sums of ``of(batch)``, flat arrays of ``kind``, over all batches; an empty list without a row. Each task adds up its own,
    ``ADDERS`` tasks add those, and one task theirs: what moves is one set of sums for each task, and the driver gets one set alone."""
    def added(total: list[np.ndarray] | None, found: list[np.ndarray]) -> list[np.ndarray]:
        return found if total is None else [a + b for a, b in zip(total, found)]

    def packed(total: list[np.ndarray] | None) -> Iterator[pa.RecordBatch]:
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([[t.tobytes() for t in total]], pa.list_(pa.binary()))], names=["parts"])

    def unpacked(row: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(p, kind) for p in row]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                total = added(total, [np.ascontiguousarray(t, kind).ravel() for t in of(batch)])
        yield from packed(total)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.column(0).to_pylist():
                total = added(total, unpacked(row))
        yield from packed(total)

    schema, total = "parts array<binary>", None
    for row in df.mapInArrow(each, schema).repartition(ADDERS).mapInArrow(merged, schema).repartition(1).mapInArrow(merged, schema).collect():
        total = added(total, unpacked(row["parts"]))
    return total or []
