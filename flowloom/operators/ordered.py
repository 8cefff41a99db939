"""Starts that follow from one another along each key's time, in one sorted pass with constant state."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _differs(now: pa.Array, before: pa.Array) -> np.ndarray:
    """Where values differ; null is equal to null."""
    differ = pc.fill_null(pc.not_equal(now, before), True)
    return np.asarray(pc.and_not(differ, pc.and_(pc.is_null(now), pc.is_null(before))))


def with_starts(rows: DataFrame, keys: list[str], time: str, length: int, name: str = "start") -> DataFrame:
    """rows with the start that covers them: a key's first time is one, and so is the first time that is `length` or more after the last start. Times are whole numbers. A task holds a batch of rows and one start, whatever a key has."""
    at, places = rows.columns.index(time), [rows.columns.index(k) for k in keys]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, start = None, 0
        for batch in batches:
            if not len(batch):
                continue
            times = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            new = np.zeros(len(batch), bool)
            for p in places:
                new[1:] |= _differs(batch.column(p).slice(1), batch.column(p).slice(0, len(batch) - 1))
            key = [batch.column(p)[0].as_py() for p in places]
            new[0] = key != last
            starts = np.empty(len(batch), np.int64)
            bounds = [0, *(np.flatnonzero(new[1:]) + 1).tolist(), len(batch)]
            for i, j in zip(bounds, bounds[1:], strict=False):
                if new[i]:
                    start = int(times[i])
                while i < j:
                    if times[i] >= start + length:
                        start = int(times[i])
                    k = i + int(np.searchsorted(times[i:j], start + length))
                    starts[i:k] = start
                    i = k
            last = [batch.column(p)[len(batch) - 1].as_py() for p in places]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(starts)], names=[*batch.schema.names, name])

    schema = rows.select("*", F.lit(0).cast("long").alias(name)).schema
    return rows.repartition(*keys).sortWithinPartitions(*keys, time).mapInArrow(run, schema)
