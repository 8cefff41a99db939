"""Sessions and groups of ICMP, and groups of what is not IP."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.operators.sessions import seconds_of
from flowloom.operators.slices import with_neighbour

KEY = ["lo_ip", "hi_ip", "typecode", "vlan_id"]
GROUP, OTHER = ["ip1", "ty1", "ip2", "vl"], ["s", "d", "m", "vl"]


def adopted(icmp: DataFrame, expire: int = 120) -> DataFrame:
    """ICMP rows (us, event_id, ip1, ip2, typecode, seq...) with own, their typecode, and typecode as session key: a packet whose ends and sequence are those of the packet right before it, turned round, within `expire` seconds is its reply and takes its typecode. That packet is answered then, so a second reply keeps its own."""
    ends = [F.least("ip1", "ip2").alias("lo_ip"), F.greatest("ip1", "ip2").alias("hi_ip"), (F.col("ip1") <= F.col("ip2")).alias("from_lo")]
    rows = icmp.select("*", *ends).withColumn("own", F.col("typecode")).withColumn("request", F.col("typecode").startswith("8."))
    rows = with_neighbour(rows, ["lo_ip", "hi_ip", "seq"], ["us", "event_id"], F.struct("us", "from_lo", "request", "own"), "last")
    fits = F.col("seq").isNotNull() & ~F.col("request") & F.col("last.request") & (F.col("last.from_lo") != F.col("from_lo")) & (F.col("us") - F.col("last.us") <= expire * 1_000_000)
    return rows.withColumn("typecode", F.when(fits, F.col("last.own")).otherwise(F.col("own"))).drop("last", "request")


def icmp_seconds(rows: DataFrame, gap: int = 120) -> DataFrame:
    """Seconds of ICMP sessions as (client ip1, ty1, server ip2, vl, sec, b1, b2, pk); who sends first is the client."""
    lo = F.col("lo_client")
    found = seconds_of(rows.withColumn("sec", F.expr("us div 1000000")), KEY, F.lit(True), gap)
    return found.select(F.when(lo, F.col("lo_ip")).otherwise(F.col("hi_ip")).alias("ip1"), F.col("typecode").alias("ty1"), F.when(lo, F.col("hi_ip")).otherwise(F.col("lo_ip")).alias("ip2"), F.col("vlan_id").alias("vl"), "sec", "b1", "b2", "pk")


def other_seconds(rows: DataFrame) -> DataFrame:
    """Seconds of what is not IP as (s, d, m, vl, sec, b1, b2, pk): one way."""
    return rows.groupBy("s", "d", "m", F.col("vlan_id").alias("vl"), F.expr("us div 1000000").alias("sec")).agg(F.sum("bytes").alias("b1"), F.lit(0).cast("long").alias("b2"), F.count("*").alias("pk"))


def type_sets(rows: DataFrame) -> DataFrame:
    """Distinct own typecodes that each end of a session key sent, in order of first appearance."""
    first = rows.groupBy(*KEY, "from_lo", "own").agg(F.min(F.struct("us", "event_id")).alias("first"))
    seen = first.groupBy(*KEY, "from_lo").agg(F.array_sort(F.collect_list(F.struct("first", "own"))).alias("seen"))
    return seen.select(*KEY, "from_lo", F.array_join(F.transform("seen", lambda s: s["own"]), ",").alias("types"))
