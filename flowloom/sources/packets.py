"""Packets: the schema, and the events table read as packets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKET = "event_id bigint, us bigint, sec bigint, ip1 bigint, port1 int, ip2 bigint, port2 int, vlan_id int, bytes bigint, flags int, ip_proto int"
TCP, UDP, ICMP = 6, 17, 1
#: Microseconds from which the time axis of events is compressed, 120 to 1.
BASE = 1704067200000000


def read_packets(spark: SparkSession, sf_dir: str, ip_proto: int | None = None) -> DataFrame:
    """The events table as packets: ten clients talk to five servers, every third packet is a reply. A protocol is filtered on the scanned columns."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    if ip_proto is not None:
        events = events.where(F.col("user_id") % 2 == (0 if ip_proto == TCP else 1))
    sided = events.selectExpr(
        "event_id",
        f"{BASE} + (unix_micros(cast(ts as timestamp)) - {BASE}) div 120 as us",
        "167772160 + user_id % 10 as cli",
        "134744072 + (user_id div 10) % 5 as srv",
        "cast(40000 + user_id % 10 as int) as cli_port",
        "case (user_id div 10) % 5 when 0 then 80 when 1 then 443 when 2 then 53 when 3 then 22 else 8080 end as srv_port",
        "event_id % 3 = 0 as reply",
        "40 + cast(round(value * 100) as bigint) % 1461 as bytes",
        "case event_type when 'signup' then 2 when 'view' then 16 when 'click' then 24 when 'purchase' then 18 else 17 end as flags",
        "case when user_id % 2 = 0 then 6 else 17 end as ip_proto",
    )
    return sided.selectExpr(
        "event_id",
        "us",
        "us div 1000000 as sec",
        "if(reply, srv, cli) as ip1",
        "if(reply, srv_port, cli_port) as port1",
        "if(reply, cli, srv) as ip2",
        "if(reply, cli_port, srv_port) as port2",
        "cast(if(cli % 4 = 0, 7, 0) as int) as vlan_id",
        "bytes",
        "flags",
        "ip_proto",
    )


def captured(packets: DataFrame, ip_proto: int, cap_filter: str | None = None) -> DataFrame:
    """Packets of a protocol, with an extra SQL condition if one is set."""
    out = packets.where(F.col("ip_proto") == ip_proto)
    return out.where(cap_filter) if cap_filter else out
