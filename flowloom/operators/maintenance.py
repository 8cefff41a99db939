"""Reports on stored datasets, and expiry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions import net, times

#: Begin and end columns by kind of dataset name.
ENDS = {"sessionInfo": ("tbm", "tem"), "captureInfo": ("tbm", "tem"), "sessionBytes": ("sbm", "sem"), "captureBytes": ("sbm", "sem"), "Groups": ("tbm", "tem"), "Groups2": ("tbm", "tem"), "lpj_data": ("sbm", "sem"), "nmi": ("tm", "tm")}


def time_columns(name: str) -> tuple[str, str]:
    """Begin and end column of a dataset, by the longest kind its name ends with."""
    found = [k for k in ENDS if name.endswith(k)]
    if not found:
        raise ValueError(f"no time columns are known for {name}")
    return ENDS[max(found, key=len)]


def dataset_stats(datasets: dict[str, tuple[DataFrame, Column, Column]]) -> DataFrame:
    """name, n, first, last (epoch seconds) and whole days between, a row a dataset; one aggregate each, in one union."""
    rows = [df.agg(F.count("*").alias("n"), F.min(b).alias("first"), F.max(e).alias("last")).select(F.lit(name).alias("name"), "n", "first", "last", times.whole_days(F.col("first"), F.col("last")).alias("days")) for name, (df, b, e) in datasets.items()]
    return reduce(DataFrame.unionByName, rows)


def stored_sizes(datasets: dict[str, DataFrame]) -> DataFrame:
    """name, files, bytes and mean bytes a row of stored datasets (as read from files), by the sizes of their files; a file of no rows isn't seen."""
    rows = []
    for name, df in datasets.items():
        files = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max("_metadata.file_size").alias("size"), F.count("*").alias("n"))
        rows.append(files.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).select(F.lit(name).alias("name"), "files", "bytes", F.round(F.col("bytes") / F.nullif("rows", F.lit(0)), 3).alias("mean_size")))
    return reduce(DataFrame.unionByName, rows)


def report(stats: DataFrame, sort_by: str = "n") -> DataFrame:
    """Sorted downwards, with each dataset's share of all rows."""
    total = stats.agg(F.sum("n").alias("_total"))
    joined = stats.crossJoin(F.broadcast(total))  # one row
    return joined.withColumn("pct", F.round(100 * F.col("n") / F.col("_total"), 2)).drop("_total").orderBy(F.desc(sort_by), "name")


def footer(stats: DataFrame, size: Column) -> DataFrame:
    """Number of datasets, rows, bytes, bytes a row, and bytes to read."""
    all_of = stats.agg(F.count("*").alias("datasets"), F.sum("n").alias("n"), F.sum(size).alias("bytes"))
    return all_of.withColumn("mean_size", F.round(F.col("bytes") / F.col("n"), 3)).withColumn("readable", net.human_size(F.col("bytes")))


def expired(df: DataFrame, end: Column, now: int, ttl: int) -> DataFrame:
    """Rows whose end is more than ttl seconds ago; with count() a dry run."""
    return df.where(end < now - ttl)


def unexpired(df: DataFrame, end: Column, now: int, ttl: int) -> DataFrame:
    return df.where((end >= now - ttl) | end.isNull())


def expire(df: DataFrame, end: Column, now: int, ttl: int, path: str, partition: str | None = None) -> None:
    """Write what stays to path, partitioned if a column is named."""
    writer = unexpired(df, end, now, ttl).write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def replace_windows(df: DataFrame, path: str, partition: str = "tbm") -> None:
    """Write df over just the partitions it holds, so that a replay from a window boundary leaves each window once."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def store_by_day(df: DataFrame, path: str, end: str, kind: str, keys: list[str]) -> None:
    """Append rows in folders by day (of the seconds in `end`, counted from 1970) and kind, in files sorted by key. Tasks take ranges of (day, kind, key), so a large day has several files, each with keys of its own, and readers skip folders by day and kind, and files and row groups by key."""
    placed = df.withColumn("day", F.floor(F.col(end) / 86400).cast("int"))
    order = ["day", kind, *keys]
    placed.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("append").partitionBy("day", kind).parquet(path)


def rates(rows: DataFrame, time: str, counter: str) -> DataFrame:
    """Growth of a running counter since the row before, in time order, by source."""
    from pyspark.sql import Window

    order = Window.partitionBy("source").orderBy(time)
    return rows.withColumn("rate", F.col(counter) - F.lag(counter).over(order))
