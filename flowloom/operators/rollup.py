"""Group windows rolled up run by run from stored seconds, from where the last run stopped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import times
from flowloom.operators.maintenance import replace_windows

#: Seconds of a folder of stored seconds; seconds that the newest minute may still be written in.
HOUR, SETTLING = 3600, 30


def store_seconds(seconds: DataFrame, path: str) -> None:
    """Append rows with a column sec, in folders by hour."""
    seconds.withColumn("hour", times.floor_to(F.col("sec"), HOUR)).repartition("hour").write.mode("append").partitionBy("hour").parquet(path)


@dataclass(frozen=True)
class Run:
    """Seconds from start to before end were rolled up; none if they are equal."""

    start: int
    end: int


def _edge(stored: DataFrame, newest: bool) -> int | None:
    """Newest or oldest stored second, out of the one folder that has it."""
    pick = F.max if newest else F.min
    hour = stored.agg(pick("hour")).first()[0]
    return None if hour is None else stored.where(F.col("hour") == hour).agg(pick("sec")).first()[0]


def start_of(spark: SparkSession, target: str, stored: DataFrame, window: int) -> int | None:
    """Where a run starts: at the newest window of the target, which may be unfinished; without a target at the window of the oldest second."""
    files = spark._jvm.org.apache.hadoop.fs.Path(target)
    if files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files):
        newest = spark.read.parquet(target).agg(F.max("tbm")).first()[0]
        if newest is not None:
            return newest
    oldest = _edge(stored, newest=False)
    return None if oldest is None else oldest // window * window


def to_read(stored: DataFrame, run: Run) -> DataFrame:
    """The seconds of a run; folders before and behind it aren't read."""
    hours = (F.col("hour") >= run.start // HOUR * HOUR) & (F.col("hour") < run.end)
    return stored.where(hours & (F.col("sec") >= run.start) & (F.col("sec") < run.end))


def roll_forward(spark: SparkSession, source: str, target: str, keys: list[str], window: int, bins: int = 90, last: bool = False) -> Run:
    """Roll up what has come since the last run: windows of `target` from the newest on are written anew from the stored seconds (keys, sec, b1, b2), up to the last minute that is surely whole, or to the end if no more comes. A run that stops half way is made good by the next. Seconds that come into windows before the newest are not met."""
    stored = spark.read.parquet(source)
    start, newest = start_of(spark, target, stored, window), _edge(stored, newest=True)
    if start is None or newest is None:
        return Run(0, 0)
    end = newest + 1 if last else (newest - SETTLING) // 60 * 60 - 60
    run = Run(start, max(start, end))
    if run.end > run.start:
        tbm = times.floor_to(F.col("sec"), window)
        off = (times.floor_to(F.col("sec"), window // bins) - tbm).cast("int")
        rows = to_read(stored, run).groupBy(*keys, tbm.alias("tbm"), off.alias("off")).agg(F.sum("b1").alias("b1"), F.sum("b2").alias("b2"))
        replace_windows(rows.repartition("tbm"), target)
    return run
