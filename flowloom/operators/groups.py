"""Rollups of bytes to conversations and to all traffic, in windows of 90 bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions import times
from flowloom.operators.sessions import KEY, session_seconds

SHORT, LONG, BINS = 900, 10800, 90
GROUP = ["ip1", "ip2", "p2", "vl", "ip_proto"]


def conversation_bytes(packets: DataFrame, gap: int = 120) -> DataFrame:
    """Active seconds of sessions as (client ip1, server ip2, server port p2, vl, sec, b1, b2, packets pk): by client, whatever its port."""
    lo = F.col("lo_client")
    return session_seconds(packets, gap).select(
        F.when(lo, F.col("lo_ip")).otherwise(F.col("hi_ip")).alias("ip1"),
        F.when(lo, F.col("hi_ip")).otherwise(F.col("lo_ip")).alias("ip2"),
        F.when(lo, F.col("hi_port")).otherwise(F.col("lo_port")).alias("p2"),
        F.col("vlan_id").alias("vl"),
        "ip_proto",
        "sec",
        "b1",
        "b2",
        "pk",
        *[F.col(k).alias(f"k_{k}") for k in KEY],
    )


def bins(rows: DataFrame, window: int, keys: list[str] = GROUP) -> DataFrame:
    """Bytes and packets of each key in each bin that has any: tbm is the window's begin, off the bin's begin in it."""
    tbm = times.floor_to(F.col("sec"), window)
    off = (times.floor_to(F.col("sec"), window // BINS) - tbm).cast("int")
    return rows.groupBy(*keys, tbm.alias("tbm"), off.alias("off")).agg(F.sum("b1").alias("b1"), F.sum("b2").alias("b2"), F.sum("pk").alias("pk"))


def groups(rows: DataFrame, window: int, keys: list[str] = GROUP) -> DataFrame:
    """A row a key and window: totals, last minute tem and the sparse array b of (offset, b1, b2)."""
    tbm = times.floor_to(F.col("sec"), window)
    off = (times.floor_to(F.col("sec"), window // BINS) - tbm).cast("int")
    binned = rows.groupBy(*keys, tbm.alias("tbm"), off.alias("off")).agg(F.sum("b1").alias("b1"), F.sum("b2").alias("b2"), F.max("sec").alias("last"))
    return binned.groupBy(*keys, "tbm").agg(
        F.sum("b1").alias("b1"),
        F.sum("b2").alias("b2"),
        times.floor_to(F.max("last"), 60).alias("tem"),
        F.array_sort(F.collect_list(F.struct(F.col("off").alias("offset"), "b1", "b2"))).alias("b"),
    )


def sessions_in_groups(rows: DataFrame, window: int) -> DataFrame:
    """ns and ne of a group: session keys that were, or were not, absent from the window before."""
    keys = [f"k_{k}" for k in KEY]
    seen = rows.select(*GROUP, *keys, times.floor_to(F.col("sec"), window).alias("tbm")).distinct()
    window_before = Window.partitionBy(*keys).orderBy("tbm").rangeBetween(-window, -window)
    marked = seen.withColumn("existing", F.count("*").over(window_before) > 0)
    return marked.groupBy(*GROUP, "tbm").agg(F.count_if(~F.col("existing")).alias("ns"), F.count_if("existing").alias("ne"))


def session_and_capture_bins(rows: DataFrame, window: int) -> DataFrame:
    """Bins of every conversation and of all traffic (null key) in one pass."""
    tbm = times.floor_to(F.col("sec"), window)
    placed = rows.select(*GROUP, "b1", "b2", tbm.alias("tbm"), (times.floor_to(F.col("sec"), window // BINS) - tbm).cast("int").alias("off"))
    cols = [*GROUP, "tbm", "off"]
    by = placed.groupingSets([cols, ["ip_proto", "tbm", "off"]], *cols)
    return by.agg(F.sum("b1").alias("b1"), F.sum("b2").alias("b2"), (F.grouping("ip1") == 1).alias("capture"))


def untyped(documents: DataFrame) -> DataFrame:
    """Documents that may be rolled up: those of the old form carry a type (ty) and are passed over."""
    return documents.where("ty is null") if "ty" in documents.columns else documents


def from_documents(documents: DataFrame, window: int) -> DataFrame:
    """Bins of session keys from stored byte documents."""
    rows = untyped(documents).select(*KEY, "sb", F.explode("b").alias("x")).select(*KEY, (F.col("sb") + F.col("x.offset")).alias("sec"), F.col("x.b_lo").alias("b1"), F.col("x.b_hi").alias("b2"), F.lit(1).alias("pk"))
    return bins(rows, window, KEY).drop("pk")


def coarser(short: DataFrame, keys: list[str] = GROUP) -> DataFrame:
    """Long windows from the bins of short ones: 12 windows make one, 12 bins one."""
    tbm = times.floor_to(F.col("tbm"), LONG)
    off = (times.floor_to(F.col("tbm") + F.col("off"), LONG // BINS) - tbm).cast("int")
    return short.groupBy(*keys, tbm.alias("tbm"), off.alias("off")).agg(F.sum("b1").alias("b1"), F.sum("b2").alias("b2"), F.sum("pk").alias("pk"))
