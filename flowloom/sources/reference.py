"""Small tables that packets are met with: targets, port names, network owners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_asn_names(spark: SparkSession, path: str) -> DataFrame:
    """asn, name, ord of a CSV of number and name; the order of lines in a file is kept in ord."""
    raw = spark.read.csv(path, schema="asn string, name string", header=False)
    return raw.withColumn("ord", F.monotonically_increasing_id())


def latency_targets(config: DataFrame) -> DataFrame:
    """Rows of doc_type latency: c_id, ip (0.1.2.3 if missing), prev_ip, protocol and what belongs to it: type and length of icmp, port, appl and path of tcp."""
    icmp, tcp = F.col("protocol") == "icmp", F.col("protocol") == "tcp"
    return config.where("doc_type = 'latency'").select(
        "c_id",
        "target",
        F.coalesce("ip", F.lit("0.1.2.3")).alias("ip"),
        "prev_ip",
        "protocol",
        F.when(icmp, F.coalesce("type", F.lit(8))).alias("type"),
        F.when(tcp, F.coalesce("port", F.lit(80))).alias("port"),
        F.when(tcp, F.col("appl")).alias("appl"),
    )


def resolved(targets: DataFrame, addresses: DataFrame) -> DataFrame:
    """targets with the address that addresses (target, new_ip) now give; the one before moves to prev_ip."""
    joined = targets.join(addresses, "target", "left")
    changed = F.col("new_ip").isNotNull() & (F.col("new_ip") != F.col("ip"))
    return joined.withColumn("prev_ip", F.when(changed, F.col("ip")).otherwise(F.col("prev_ip"))).withColumn("ip", F.when(changed, F.col("new_ip")).otherwise(F.col("ip"))).drop("new_ip")


def target_changes(active: DataFrame, configured: DataFrame) -> DataFrame:
    """c_id and change: added or removed."""
    added = configured.select("c_id").join(active.select("c_id"), "c_id", "left_anti").withColumn("change", F.lit("added"))
    removed = active.select("c_id").join(configured.select("c_id"), "c_id", "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)
