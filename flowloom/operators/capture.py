"""All traffic of a protocol together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions import net, times


def capture_bytes(packets: DataFrame, length: int = 10) -> DataFrame:
    """Documents of 10 seconds: begin sb, last active second se, bytes and packets."""
    return packets.groupBy("ip_proto", times.floor_to(F.col("sec"), length).alias("sb")).agg(F.max("sec").alias("se"), F.sum("bytes").alias("b"), F.count("*").alias("pk"), F.count_distinct("sec").alias("active"))


def capture_documents(packets: DataFrame, length: int = 10) -> DataFrame:
    """As capture_bytes(), with b as an array of (offset, bytes), one for each active second; packets are summed by second before a document is gathered, which has no more entries than its length."""
    seconds = packets.groupBy("ip_proto", "sec").agg(F.sum("bytes").alias("b"), F.count("*").alias("pk"))
    sb = times.floor_to(F.col("sec"), length)
    return seconds.groupBy("ip_proto", sb.alias("sb")).agg(
        F.max("sec").alias("se"), F.sum("b").alias("total"), F.sum("pk").alias("pk"), F.array_sort(F.collect_list(F.struct((F.col("sec") - sb).cast("int").alias("offset"), "b"))).alias("b")
    )


def capture_info(packets: DataFrame) -> DataFrame:
    return packets.groupBy("ip_proto").agg(F.min("us").alias("tb"), F.max("us").alias("te"), F.sum("bytes").alias("bt"), F.count("*").alias("pk"))


def direction_bytes(packets: DataFrame, local_subnets: tuple[str, ...]) -> DataFrame:
    """Inbound and outbound bytes by second."""
    way = net.direction(F.col("ip1"), F.col("ip2"), local_subnets)
    return packets.groupBy("ip_proto", "sec").agg(F.sum(F.when(way == "in", F.col("bytes")).otherwise(0)).alias("b_in"), F.sum(F.when(way == "out", F.col("bytes")).otherwise(0)).alias("b_out"))
