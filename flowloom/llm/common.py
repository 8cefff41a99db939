"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.session import shared_folder

#: Words of the contracts: everything but ASCII white space. In Java \S leaves out just \x20 and \x09 to \x0D, and is matched many times as fast as these by number.
WORDS = r"\S+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and text of the documents table; other columns are not read."""
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n; null ids count as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared checkpoint folder; later stages read it from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


#: Rows of a small table that one task takes.
ROWS = 100_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """df of so many rows at most, in as few partitions as they need: a small table in many partitions makes many small files in every shuffle after it."""
    return df.coalesce(max(1, -(-rows // ROWS)))


def compact(df: DataFrame, most: int | None = None) -> tuple[DataFrame, int]:
    """df checkpointed, in few() partitions, and its count. most: rows that it can't exceed, if known."""
    kept = checkpointed(df if most is None else few(df, most))
    rows = kept.count()
    return few(kept, rows), rows


def fresh(df: DataFrame, name: str) -> str:
    """A column name like name that df doesn't have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """df.mapInArrow(); at a task's end its worker, which goes on to other tasks, gives freed memory back to the machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return df.mapInArrow(run, schema)


def slices(batches: Iterable[pa.RecordBatch], text_at: str = "text", chars: int = 1_000_000, each: int = 0) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches of about that many bytes of text (a longer text is a part of its own), with the texts; null reads as empty. Every row counts as `each` bytes more."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text_at))
        at, size = 0, 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        for i, n in enumerate(lengths):
            n += each
            if i > at and size + n > chars:
                yield batch.slice(at, i - at), [x or "" for x in column.slice(at, i - at).to_pylist()]
                at, size = i, 0
            size += n
        if at < len(lengths):
            yield batch.slice(at), [x or "" for x in column.slice(at).to_pylist()]
