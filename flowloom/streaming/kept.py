"""Tables kept up by micro-batches, which survive the end of the driver at any point.

Below a folder, batch N writes its rows below rows/b=N and then a line of the log,
log/b=N. A batch without its line never was: whoever comes next, the same object or a
new one after a restart, starts from the last batch that has one and overwrites what
lies behind it. So a batch that is given again replaces itself. The line holds the
newest time that the stream has seen, so rows close by the stream's clock, not by
their batch's. Open rows are written anew with each batch, and those that two later
batches have superseded are removed; closed rows are written once, by the batch that
closed them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import times
from flowloom.operators.sessions import KEY, merged_sessions, partial_sessions, with_session_key

OPEN, CLOSED, LATE = "open", "closed", "late"


@dataclass(frozen=True)
class Entry:
    number: int
    newest: int


class BatchLog:
    """The batches of a folder that are whole."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def entries(self) -> list[Entry]:
        files, at = self._path(f"{self.folder}/log")
        if not files.exists(at):
            return []
        rows = self.spark.read.schema("number long, newest long").option("recursiveFileLookup", "true").json(f"{self.folder}/log").collect()  # a line a batch
        return sorted((Entry(r.number, r.newest) for r in rows), key=lambda e: e.number)

    def before(self, number: int | None = None) -> Entry | None:
        """The last batch, or the last before a number."""
        return next((e for e in reversed(self.entries()) if number is None or e.number < number), None)

    def remove(self, path: str) -> None:
        files, at = self._path(f"{self.folder}/{path}")
        files.delete(at, True)

    def rows(self, number: int, state: str) -> str:
        return f"{self.folder}/rows/b={number}/{state}"

    def has(self, number: int, state: str) -> bool:
        files, at = self._path(self.rows(number, state))
        return files.exists(at)

    def begin(self, number: int) -> Entry | None:
        """Forget this batch and all behind it; the batch before it."""
        for e in self.entries():
            if e.number >= number:
                self.remove(f"log/b={e.number}")
        return self.before(number)

    def write(self, number: int, state: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self.rows(number, state))

    def end(self, number: int, newest: int) -> None:
        """The batch is whole from here on."""
        self.spark.createDataFrame([(number, newest)], "number long, newest long").coalesce(1).write.mode("overwrite").json(f"{self.folder}/log/b={number}")
        for e in self.entries()[:-2]:
            self.remove(f"rows/b={e.number}/{OPEN}")


class KeptTable:
    """Rows kept up below a folder. partial: rows that a batch makes; merged: such rows of a key that belong together as one; closed: of a row and the newest time seen (microseconds), whether packets within the lateness can't change it any more."""

    def __init__(self, spark: SparkSession, folder: str, partial: Callable[[DataFrame], DataFrame], merged: Callable[[DataFrame], DataFrame], closed: Callable[[int], Column], lateness: int, apart: bool = False):
        self.spark, self.log, self.lateness, self.apart = spark, BatchLog(spark, folder), lateness, apart
        self.partial, self.merged, self.closed = partial, merged, closed

    def preload(self, stored: DataFrame, newest: int) -> None:
        """Start from stored rows, with the newest time they were made of."""
        self.log.begin(-1)
        self._put(-1, stored, newest)
        self.log.end(-1, newest)

    def _put(self, number: int, rows: DataFrame, newest: int) -> None:
        is_closed = F.coalesce(self.closed(newest), F.lit(False))
        rows = rows.cache()
        try:
            self.log.write(number, OPEN, rows.where(~is_closed))
            self.log.write(number, CLOSED, rows.where(is_closed))
        finally:
            rows.unpersist()

    def upsert(self, batch: DataFrame, number: int) -> None:
        """Merge the packets of a batch into the open rows. If late ones are kept apart, packets further behind the newest time of the batches before than the lateness make rows of their own, batch by batch, and are in no other."""
        last = self.log.begin(number)
        newest = batch.agg(F.max("us")).first()[0]
        if newest is None:
            return
        if self.apart:
            # rows that may still change begin after this
            mark = last.newest - self.lateness * 1_000_000 if last else None
            late = F.col("us") < mark if last else F.lit(False)
            self.log.write(number, LATE, self.partial(batch.where(late)))
            batch = batch.where(~late)
        rows = self.partial(batch)
        if last:
            rows = rows.unionByName(self.spark.read.schema(rows.schema).parquet(self.log.rows(last.number, OPEN)))
            newest = max(newest, last.newest)
        self._put(number, self.merged(rows), newest)
        self.log.end(number, newest)

    def read(self) -> DataFrame:
        """All rows, closed and open."""
        numbers = [e.number for e in self.log.entries()]
        return self.spark.read.parquet(*[self.log.rows(n, CLOSED) for n in numbers], self.log.rows(numbers[-1], OPEN))

    def read_late(self) -> DataFrame:
        """Rows of late packets, with the number of their batch."""
        parts = [self.spark.read.parquet(self.log.rows(e.number, LATE)).withColumn("batch", F.lit(e.number).cast("long")) for e in self.log.entries() if self.log.has(e.number, LATE)]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return whole


def session_table(spark: SparkSession, folder: str, gap: int = 120, lateness: int = 30, apart: bool = False) -> KeptTable:
    """Sessions; open until no packet within the lateness can reach them."""
    reach = (gap + lateness) * 1_000_000
    return KeptTable(spark, folder, lambda packets: partial_sessions(packets, gap), lambda parts: merged_sessions(parts, gap), lambda newest: F.col("te") < newest - reach, lateness, apart)


def stored_sessions(table: KeptTable, stored: DataFrame, now: int, gap: int) -> None:
    """Start a session table from stored sessions up to now (seconds): those whose last minute is not before that of the gap before now are open, others closed."""
    closed, table.closed = table.closed, lambda _: times.floor_to(F.expr("te div 1000000"), 60) < (now - gap) // 60 * 60
    try:
        table.preload(stored, now * 1_000_000)
    finally:
        table.closed = closed


def bin_table(spark: SparkSession, folder: str, window: int, bins: int = 90, lateness: int = 30, apart: bool = False) -> KeptTable:
    """Bytes of session keys by bin of a group window; a window is open until its end is further behind than the lateness."""

    def partial(packets: DataFrame) -> DataFrame:
        lo, sec = F.col("from_lo"), F.expr("us div 1000000")
        tbm = times.floor_to(sec, window)
        off = (times.floor_to(sec, window // bins) - tbm).cast("int")
        return with_session_key(packets).groupBy(*KEY, tbm.alias("tbm"), off.alias("off")).agg(F.sum(F.when(lo, F.col("bytes")).otherwise(0)).alias("b1"), F.sum(F.when(lo, 0).otherwise(F.col("bytes"))).alias("b2"))

    def merged(parts: DataFrame) -> DataFrame:
        return parts.groupBy(*KEY, "tbm", "off").agg(F.sum("b1").alias("b1"), F.sum("b2").alias("b2"))

    return KeptTable(spark, folder, partial, merged, lambda newest: (F.col("tbm") + window + lateness) * 1_000_000 < newest, lateness, apart)


class VersionedTable:
    """A small table whose whole rows are published again and again below a folder; readers take the version that stands when they ask, as a stream does in each micro-batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.log = BatchLog(spark, folder)

    def publish(self, rows: DataFrame) -> int:
        """The number of the new version. A version that isn't whole is none."""
        last = self.log.before()
        number = last.number + 1 if last else 0
        self.log.write(number, CLOSED, rows)
        self.log.end(number, number)
        return number

    def current(self) -> DataFrame:
        return self.log.spark.read.parquet(self.log.rows(self.log.before().number, CLOSED))


def each_batch(table: VersionedTable, work: Callable[[DataFrame, DataFrame], DataFrame], folder: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: work(batch, the table as it stands now), written below a folder by batch; a batch given again replaces itself."""

    def run(batch: DataFrame, number: int) -> None:
        work(batch, table.current()).write.mode("overwrite").parquet(f"{folder}/b={number}")

    return run
