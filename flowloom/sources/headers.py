"""Every header field of captured Ethernet packets, as columns.

Where a header stands follows from the bytes before it: behind the Ethernet addresses
a walk over VLAN tags (802.1Q, 802.1ad and the older 0x9100, at most TAGS), then IPv4
with its own header length or IPv6, then TCP, UDP or ICMP, or a tunnel (IP in IP, or
GRE with its optional fields) with an IPv4 packet in it. What a packet was cut before,
or doesn't have, is null; later fragments have no ports. Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAGS = 4
TPIDS = (0x8100, 0x88A8, 0x9100)
V4, V6 = 0x0800, 0x86DD
ICMP, IPIP, TCP, UDP, GRE, ICMP6 = 1, 4, 6, 17, 47, 58
FIELDS = (
    "dmac smac eth_type vlan_id qinq_vlan_id ip_version l3_proto ip_tos ip_src ip_dst ip6_src ip6_dst l4_src_port l4_dst_port icmp_type icmp_code tcp_flags tcp_seq tcp_ack "
    "tunnel tunneled_proto tunneled_ip_src tunneled_ip_dst tunneled_src_port tunneled_dst_port"
).split()


def _number(at: Column, n: int, data: str = "payload") -> Column:
    """n bytes from a place counted from 0, as a number; null if they aren't all there."""
    whole = F.conv(F.hex(F.col(data).substr((at + 1).cast("int"), F.lit(n))), 16, 10).cast("long")
    return F.when(F.length(data) >= at + n, whole)


def _bits(value: Column, mask: int) -> Column:
    return value.bitwiseAND(F.lit(mask).cast("long"))


def _ports(rows: DataFrame, at: str, proto: str, names: tuple[str, str], first: Column) -> DataFrame:
    has = F.col(proto).isin(TCP, UDP) & first
    return rows.withColumns({name: F.when(has, _number(F.col(at) + 2 * i, 2)) for i, name in enumerate(names)})


def deep_headers(packets: DataFrame) -> DataFrame:
    """The columns of pcap rows but payload, and FIELDS. vlan_id is the outermost tag's, qinq_vlan_id the next one's; addresses of IPv4 are numbers, those of IPv6 hexadecimal text."""
    zero = F.lit(0)
    rows = packets.where("problem is null")
    rows = rows.withColumns({"dmac": _number(zero, 6), "smac": _number(zero + 6, 6), "_at": zero + 12, "eth_type": _number(zero + 12, 2), "vlan_id": F.lit(None).cast("long"), "qinq_vlan_id": F.lit(None).cast("long")})
    for i in range(TAGS):
        rows = rows.withColumn("_tag", F.when(F.col("eth_type").isin(*TPIDS), _bits(_number(F.col("_at") + 2, 2), 4095)))
        if i < 2:
            rows = rows.withColumn(("vlan_id", "qinq_vlan_id")[i], F.col("_tag"))
        rows = rows.withColumn("_at", F.when(F.col("_tag").isNotNull(), F.col("_at") + 4).otherwise(F.col("_at"))).withColumn("eth_type", _number(F.col("_at"), 2))
    ip = F.col("_at") + 2
    four, six = F.col("eth_type") == V4, F.col("eth_type") == V6
    rows = rows.withColumns({
        "ip_version": F.when(four | six, F.shiftright(_number(ip, 1), 4)),
        "l3_proto": F.when(four, _number(ip + 9, 1)).when(six, _number(ip + 6, 1)),
        "ip_tos": F.when(four, _number(ip + 1, 1)).when(six, F.shiftright(_bits(_number(ip, 2), 4080), 4)),
        "ip_src": F.when(four, _number(ip + 12, 4)), "ip_dst": F.when(four, _number(ip + 16, 4)),
        "ip6_src": F.when(six & (F.length("payload") >= ip + 40), F.lower(F.hex(F.col("payload").substr(ip + 9, F.lit(16))))),
        "ip6_dst": F.when(six & (F.length("payload") >= ip + 40), F.lower(F.hex(F.col("payload").substr(ip + 25, F.lit(16))))),
        "_first": F.when(four, _bits(_number(ip + 6, 2), 8191) == 0).otherwise(six),
        "_l4": F.when(four, ip + 4 * _bits(_number(ip, 1), 15)).when(six, ip + 40),
    })
    at, first = F.col("_l4"), F.col("_first")
    rows = _ports(rows, "_l4", "l3_proto", ("l4_src_port", "l4_dst_port"), first)
    tcp, icmp = (F.col("l3_proto") == TCP) & first, F.col("l3_proto").isin(ICMP, ICMP6) & first
    rows = rows.withColumns({
        "icmp_type": F.when(icmp, _number(at, 1)), "icmp_code": F.when(icmp, _number(at + 1, 1)),
        "tcp_flags": F.when(tcp, _number(at + 13, 1)), "tcp_seq": F.when(tcp, _number(at + 4, 4)), "tcp_ack": F.when(tcp, _number(at + 8, 4)),
        "_gre": F.when((F.col("l3_proto") == GRE) & first & (_number(at + 2, 2) == V4), _number(at, 2)),
    })
    optional = sum((F.when(_bits(F.col("_gre"), bit) != 0, 4).otherwise(0) for bit in (0x8000, 0x2000, 0x1000)), F.lit(4))
    rows = rows.withColumn("_in", F.when((F.col("l3_proto") == IPIP) & first, at).when(F.col("_gre").isNotNull(), at + optional))
    inner = F.col("_in")
    rows = rows.withColumns({
        "tunnel": F.when(inner.isNotNull(), F.when(F.col("l3_proto") == IPIP, "ipip").otherwise("gre")),
        "tunneled_proto": _number(inner + 9, 1), "tunneled_ip_src": _number(inner + 12, 4), "tunneled_ip_dst": _number(inner + 16, 4),
        "_l4": inner + 4 * _bits(_number(inner, 1), 15), "_first": _bits(_number(inner + 6, 2), 8191) == 0,
    })
    rows = _ports(rows, "_l4", "tunneled_proto", ("tunneled_src_port", "tunneled_dst_port"), F.col("_first"))
    return rows.select(*[c for c in packets.columns if c != "payload"], *FIELDS)
