"""Queries for scalar functions, filters, parsers and small tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.config import TrafficConfig
from flowloom.functions import net, times
from flowloom.operators import enrich, names
from flowloom.plans.registry import query
from flowloom.plans.sql import KEY, KEYED, with_packets
from flowloom.sources import text
from flowloom.sources.packets import read_packets

LOCAL = TrafficConfig().local_subnets
_DOTTED = "concat_ws('.', {0} >> 24, ({0} >> 16) & 255, ({0} >> 8) & 255, {0} & 255)"


@query("FN-1_ip_text_round_trip", with_packets() + f"SELECT event_id, {_DOTTED.format('ip1')} AS ip_text, ip1 AS ip_number, ip1 & 255 AS last_octet, ip1 >> 24 AS first_octet FROM packets")
def ip_text(spark, sf_dir):
    p = read_packets(spark, sf_dir)
    dotted = net.long_to_ip(F.col("ip1"))
    o = net.octets(F.col("ip1"))
    return p.select("event_id", dotted.alias("ip_text"), net.ip_to_long(dotted).alias("ip_number"), o[3].cast("long").alias("last_octet"), o[0].cast("long").alias("first_octet"))


@query("FN-2_octets_to_number", with_packets() + "SELECT DISTINCT ip1, ip1 AS back FROM packets")
def octets(spark, sf_dir):
    return read_packets(spark, sf_dir).select("ip1").distinct().select("ip1", net.octets_to_long(net.octets(F.col("ip1"))).alias("back"))


_BOUNDARIES = {
    "chunk_5s": (lambda t: times.chunk_boundary(t, 5), "sec - (sec % 60) % 5"),
    "chunk_10m": (lambda t: times.chunk_boundary(t, 600), "sec - sec % 60 - ((sec // 60) % 60 % 10) * 60"),
    "window_15m": (lambda t: times.window_boundary(t, 15), "sec - sec % 60 - ((sec // 60) % 60 % 15) * 60"),
    "window_3h": (lambda t: times.window_boundary(t, 180), "sec - sec % 3600 - ((sec // 3600) % 24 % 3) * 3600"),
    "second_7": (lambda t: times.second_boundary(t, 7), "sec - (sec % 60) % 7"),
    "minute_4": (lambda t: times.minute_boundary(t, 4), "sec - sec % 60 - ((sec // 60) % 60 % 4) * 60"),
    "ten_seconds": (lambda t: times.floor_to(t, 10), "sec // 10 * 10"),
    "minute": (lambda t: times.floor_to(t, 60), "sec // 60 * 60"),
    "two_minutes": (lambda t: times.floor_to(t, 120), "sec // 120 * 120"),
    "quarter_hour": (lambda t: times.floor_to(t, 900), "sec // 900 * 900"),
    "three_hours": (lambda t: times.floor_to(t, 10800), "sec // 10800 * 10800"),
    "short_bin": (lambda t: times.bin_of(t, 900).cast("long"), "(sec // 10) % 90"),
    "long_bin": (lambda t: times.bin_of(t, 10800).cast("long"), "(sec // 120) % 90"),
}


@query("FN-6_time_boundaries", with_packets() + "SELECT event_id, " + ", ".join(f"CAST({s} AS BIGINT) AS {k}" for k, (_, s) in _BOUNDARIES.items()) + " FROM packets")
def boundaries(spark, sf_dir):
    p = read_packets(spark, sf_dir)
    return p.select("event_id", *[f(F.col("sec")).cast("long").alias(k) for k, (f, _) in _BOUNDARIES.items()])


@query("FN-16_session_keys", with_packets(KEYED) + f"SELECT {KEY}, count(*) AS packets FROM keyed GROUP BY {KEY}")
def session_keys(spark, sf_dir):
    from flowloom.operators.sessions import KEY as KEYS
    from flowloom.operators.sessions import with_session_key

    return with_session_key(read_packets(spark, sf_dir)).groupBy(*KEYS).agg(F.count("*").alias("packets"))


@query("FN-19_packed_flags", with_packets(KEYED) + f"SELECT {KEY}, from_lo, bit_or(packed) AS packed FROM keyed WHERE ip_proto = 6 GROUP BY {KEY}, from_lo")
def packed_flags(spark, sf_dir):
    from flowloom.operators.sessions import KEY as KEYS
    from flowloom.operators.sessions import with_session_key

    return with_session_key(read_packets(spark, sf_dir, 6)).groupBy(*KEYS, "from_lo").agg(F.bit_or(net.pack_flags(F.col("flags"))).alias("packed"))


@query("FN-20_client_rules", with_packets(KEYED) + "SELECT event_id, ip_proto, sender_client FROM keyed")
def client_rules(spark, sf_dir):
    from flowloom.operators.sessions import sender_is_client

    return read_packets(spark, sf_dir).select("event_id", "ip_proto", sender_is_client().alias("sender_client"))


@query("FLT-10_direction", with_packets() + "SELECT event_id, CASE WHEN (ip1 BETWEEN 167772160 AND 184549375) AND NOT (ip2 BETWEEN 167772160 AND 184549375) THEN 'out' ELSE 'in' END AS way FROM packets")
def directions(spark, sf_dir):
    return read_packets(spark, sf_dir).select("event_id", net.direction(F.col("ip1"), F.col("ip2"), LOCAL).alias("way"))


@query("SRC-2_capture_filter", with_packets() + "SELECT event_id, bytes FROM packets WHERE ip_proto = 6 AND port2 <> 22 AND port1 <> 22")
def capture_filter(spark, sf_dir):
    from flowloom.sources.packets import captured

    return captured(read_packets(spark, sf_dir), 6, "port2 <> 22 and port1 <> 22").select("event_id", "bytes")


@query("SRC-12_collection_scan", "SELECT event_id, ts, value FROM events WHERE value > 50 ORDER BY event_id LIMIT 100")
def scan(spark, sf_dir):
    """find(spec, projection, sort, limit): the limit is the feature."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").where("value > 50").select("event_id", "ts", "value").orderBy("event_id").limit(100)


def stamp(us):
    return F.concat(F.expr(f"cast({us} div 1000000 as string)"), F.lit("."), F.lpad(F.expr(f"cast({us} % 1000000 as string)"), 6, "0"))


def tcp_lines(p):
    """Packets written as a sniffer writes them, for the parsers to read back."""
    letters = F.create_map(*[F.lit(x) for kv in {2: "S", 16: ".", 24: "P.", 18: "S.", 17: "F."}.items() for x in kv])[F.col("flags")]
    ip = lambda c: net.long_to_ip(F.col(c))
    head = F.concat(stamp("us"), F.lit(" 70:ca:9b:4b:f7:20 > 00:1b:78:59:e7:c2, ethertype "))
    length = F.concat(F.lit(", length "), F.col("bytes").cast("string"), F.lit(": "))
    plain = F.concat(head, F.lit("IPv4 (0x0800)"), length)
    tagged = F.concat(head, F.lit("802.1Q (0x8100)"), length, F.lit("vlan "), F.col("vlan_id").cast("string"), F.lit(", p 1, ethertype IPv4, "))
    tail = F.concat(ip("ip1"), F.lit("."), F.col("port1").cast("string"), F.lit(" > "), ip("ip2"), F.lit("."), F.col("port2").cast("string"), F.lit(": Flags ["), letters, F.lit("], seq 1441:1537"))
    return p.select(F.concat(F.when(F.col("vlan_id") > 0, tagged).otherwise(plain), tail).alias("value"))


@query("PROJ-3_tcp_lines", with_packets() + "SELECT us, ip1, port1, ip2, port2, bytes, vlan_id, CASE flags WHEN 2 THEN 'S' WHEN 16 THEN '.' WHEN 24 THEN 'P.' WHEN 18 THEN 's' ELSE 'F.' END AS flags FROM packets WHERE ip_proto = 6")
def tcp_text(spark, sf_dir):
    return text.parse_tcp(tcp_lines(read_packets(spark, sf_dir, 6)))


@query("PROJ-4_udp_lines", with_packets() + "SELECT us, ip1, port1, ip2, port2, bytes, vlan_id, 'DNS Standard query' AS protocol FROM packets WHERE ip_proto = 17")
def udp_text(spark, sf_dir):
    p = read_packets(spark, sf_dir, 17)
    s = lambda c: F.col(c).cast("string")
    line = F.concat_ws(" ", stamp("us"), F.when(F.col("vlan_id") > 0, s("vlan_id")), net.long_to_ip(F.col("ip1")), s("port1"), net.long_to_ip(F.col("ip2")), s("port2"), s("bytes"), F.lit("DNS Standard query"))
    return text.parse_udp(p.select(line.alias("value")))


_ICMP_SQL = "SELECT us, ip1, bytes, ip2, CASE WHEN event_id % 3 = 0 THEN '0.0' WHEN event_id % 3 = 1 THEN '8.0' ELSE '3.13' END AS typecode, CASE WHEN event_id % 3 < 2 THEN CAST((us // 7) % 5000 AS INT) END AS seq, vlan_id FROM packets"


def icmp_lines(p, number="cast((us div 7) % 5000 as string)"):
    """Packets written as ICMP lines, with the number as sequence of requests and replies; event_id stays beside the line."""
    s = lambda c: F.col(c).cast("string")
    vlan = F.when(F.col("vlan_id") > 0, s("vlan_id"))
    kind = F.when(F.col("event_id") % 3 == 0, "0 0").when(F.col("event_id") % 3 == 1, "8 0").otherwise("3 0x0d")
    seq = F.when(F.col("event_id") % 3 < 2, F.concat(F.expr(number), F.lit(" (0xc907)")))
    return p.select(F.concat_ws(" ", stamp("us"), net.long_to_ip(F.col("ip1")), s("bytes"), net.long_to_ip(F.col("ip2")), kind, seq, vlan).alias("value"), "event_id")


@query("PROJ-5_icmp_lines", with_packets() + _ICMP_SQL)
def icmp_text(spark, sf_dir):
    return text.parse_icmp(icmp_lines(read_packets(spark, sf_dir))).drop("event_id")


@query("PROJ-6_other_lines", with_packets() + "SELECT us, '00:09:0f:50:aa:fc' AS s, bytes, 'ff:ff:ff:ff:ff:ff' AS d, 'ARP' AS pr, CASE WHEN event_id % 50 = 0 THEN repeat('x', 512) || '...' ELSE 'Who has ' || event_id END AS m, vlan_id FROM packets WHERE event_id % 7 <> 0")
def other_text(spark, sf_dir):
    return text.parse_other(other_lines(read_packets(spark, sf_dir)))


def other_lines(p):
    s = lambda c: F.col(c).cast("string")
    message = F.when(F.col("event_id") % 50 == 0, F.repeat(F.lit("x"), 600)).otherwise(F.concat(F.lit("Who has "), s("event_id")))
    proto = F.when(F.col("event_id") % 7 == 0, "DNS").otherwise("ARP")
    line = F.concat_ws(" ", stamp("us"), F.when(F.col("vlan_id") > 0, s("vlan_id")), F.lit("00:09:0f:50:aa:fc"), s("bytes"), F.lit("ff:ff:ff:ff:ff:ff"), proto, message)
    return p.select(line.alias("value"))


@query("FLT-1_short_lines", with_packets() + "SELECT count(*) AS kept FROM packets WHERE event_id % 4 <> 0")
def short_lines(spark, sf_dir):
    p = read_packets(spark, sf_dir)
    lines = p.select(F.when(F.col("event_id") % 4 == 0, "too short a line").otherwise("this one has five tokens").alias("value"))
    return text.framed(lines).agg(F.count("*").alias("kept"))


@query("FLT-3_impossible_ports", with_packets() + "SELECT count(*) AS kept FROM packets WHERE ip_proto = 6 AND event_id % 5 <> 0")
def impossible_ports(spark, sf_dir):
    lines = tcp_lines(read_packets(spark, sf_dir, 6).withColumn("port1", F.when(F.col("event_id") % 5 == 0, F.lit(1458359471)).otherwise(F.col("port1"))))
    return text.parse_tcp(lines).agg(F.count("*").alias("kept"))


@query("PROJ-7_syn_lines", with_packets() + "SELECT us, ip1, port1, ip2, port2, flags = 18 AS reply, event_id // 2 AS seq FROM packets WHERE flags IN (2, 18)")
def syn_text(spark, sf_dir):
    p = read_packets(spark, sf_dir).where("flags in (2, 18)")
    s = lambda c: F.col(c).cast("string")
    seq = F.expr("event_id div 2")
    flags = F.when(F.col("flags") == 2, F.concat(F.lit("Flags [S], seq "), seq.cast("string"), F.lit(", win 14600"))).otherwise(F.concat(F.lit("Flags [S.], seq 700200, ack "), (seq + 1).cast("string"), F.lit(", win 5792")))
    line = F.concat(stamp("us"), F.lit(" IP "), net.long_to_ip(F.col("ip1")), F.lit("."), s("port1"), F.lit(" > "), net.long_to_ip(F.col("ip2")), F.lit("."), s("port2"), F.lit(": "), flags)
    return text.parse_tcp_latency(p.select(line.alias("value"))).select("us", "ip1", "port1", "ip2", "port2", "reply", "seq")


@query("PROJ-9_echo_lines", with_packets() + "SELECT us, ip1, ip2, event_id % 3 = 0 AS reply, CAST(vlan_id AS INT) AS id, event_id AS seq, 64 AS length FROM packets WHERE event_id % 4 <> 0")
def echo_text(spark, sf_dir):
    p = read_packets(spark, sf_dir)
    s = lambda c: F.col(c).cast("string")
    kind = F.when(F.col("event_id") % 3 == 0, "reply").otherwise("request")
    length = F.when(F.col("event_id") % 4 == 0, "40").otherwise("64")
    line = F.concat(stamp("us"), F.lit(" IP "), net.long_to_ip(F.col("ip1")), F.lit(" > "), net.long_to_ip(F.col("ip2")), F.lit(": ICMP echo "), kind, F.lit(", id "), s("vlan_id"), F.lit(", seq "), s("event_id"), F.lit(", length "), length)
    return text.parse_icmp_latency(p.select(line.alias("value")))


def _readable_sql(base: int) -> str:
    """Tenths of a unit, halves up, in whole numbers."""
    whens = " ".join(f"WHEN n < {base ** (i + 1)} THEN ((n * 10 + {base**i // 2}) // {base**i})" for i in range(4))
    name = " ".join(f"WHEN n < {base ** (i + 1)} THEN '{u}'" for i, u in enumerate(("B", "KB", "MB", "GB")))
    return f"SELECT k, (t // 10) || '.' || (t % 10) || u AS size FROM (SELECT k, CASE {whens} ELSE (n * 10 + {base**4 // 2}) // {base**4} END AS t, CASE {name} ELSE 'TB' END AS u FROM (SELECT o_orderkey AS k, o_orderkey * o_orderkey * 37 AS n FROM orders))"


def _sizes(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey as k", "o_orderkey * o_orderkey * 37 as n")


@query("FN-29_readable_sizes", _readable_sql(1000))
def readable(spark, sf_dir):
    return _sizes(spark, sf_dir).select("k", net.human_size(F.col("n")).alias("size"))


@query("FN-29_readable_binary_sizes", _readable_sql(1024))
def readable_binary(spark, sf_dir):
    return _sizes(spark, sf_dir).select("k", net.human_size(F.col("n"), 1024).alias("size"))


GEO = [(167772160, 167772163, "US", "Ashburn", -77.5, 39.0), (167772164, 167772167, "DE", "Berlin", 13.4, 52.5), (134744064, 134744073, "US", "Mountain View", -122.1, 37.4), (134744074, 134809599, "BR", "Recife", -34.9, -8.1)]
ASN = [(167772160, 167772165, 64512), (134744064, 134744079, 15169), (134217728, 150994943, 3356)]
ASN_NAMES = [("asn", "name"), ("64512", "Lab"), ("15169", "Old name"), ("15169", "Search"), ("3356", "Carrier")]
PORTS = [("udp.port", 53, "domain"), ("udp.port", 443, "quic"), ("tcp.port", 80, "http"), ("tcp.port", 443, "https"), ("tcp.port", 22, "ssh")]


def _values(rows):
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


@query("JOIN-2_countries", with_packets() + f"SELECT event_id, g1.cc AS cc1, g1.city AS city1, CAST(g1.lon AS DOUBLE) AS lon1, CAST(g1.lat AS DOUBLE) AS lat1, g2.cc AS cc2 FROM packets LEFT JOIN (VALUES {_values(GEO)}) g1(s, e, cc, city, lon, lat) ON ip1 BETWEEN g1.s AND g1.e LEFT JOIN (VALUES {_values(GEO)}) g2(s, e, cc, city, lon, lat) ON ip2 BETWEEN g2.s AND g2.e")
def countries(spark, sf_dir):
    geo = spark.createDataFrame(GEO, "start long, end long, cc string, city string, lon double, lat double")
    rows = read_packets(spark, sf_dir).select("event_id", "ip1", "ip2")
    one = enrich.in_ranges(rows, "ip1", geo, ["cc", "city", "lon", "lat"])
    one = one.select("event_id", "ip2", F.col("cc").alias("cc1"), F.col("city").alias("city1"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1"))
    return enrich.in_ranges(one, "ip2", geo, ["cc"]).select("event_id", "cc1", "city1", "lon1", "lat1", F.col("cc").alias("cc2"))


@query("JOIN-3_network_owners", with_packets() + f"""SELECT event_id, a.asn, n.name FROM (SELECT event_id, (SELECT arg_min(r.asn, r.e - r.s) FROM (VALUES {_values(ASN)}) r(s, e, asn) WHERE p.ip2 BETWEEN r.s AND r.e) AS asn FROM packets p) a
LEFT JOIN (VALUES (64512, 'Lab'), (15169, 'Search'), (3356, 'Carrier')) n(asn, name) ON a.asn = n.asn""")
def owners(spark, sf_dir):
    """The widest range nests around another; the narrowest wins."""
    asn = spark.createDataFrame(ASN, "start long, end long, asn long")
    names_ = spark.createDataFrame([(a, n, i) for i, (a, n) in enumerate(ASN_NAMES)], "asn string, name string, ord long")
    rows = read_packets(spark, sf_dir).select("event_id", "ip2")
    return enrich.with_asn_name(enrich.in_ranges(rows, "ip2", asn, ["asn"]), names_).select("event_id", "asn", "name")


@query("JOIN-4_protocol_names", with_packets() + "SELECT event_id, CASE least(port1, port2) WHEN 53 THEN 'domai' WHEN 443 THEN 'quic' END AS pr FROM packets WHERE ip_proto = 17")
def protocol_names(spark, sf_dir):
    decode = spark.createDataFrame(PORTS, "type string, port int, name string")
    rows = read_packets(spark, sf_dir, 17).select("event_id", F.least("port1", "port2").alias("p2"))
    return enrich.with_protocol(rows, decode).select("event_id", "pr")


@query("SORT-7_mail_hosts", "SELECT s_nationkey AS domain, string_agg(s_name, ',' ORDER BY s_suppkey % 50, s_name) AS hosts FROM supplier GROUP BY s_nationkey")
def mail_hosts(spark, sf_dir):
    records = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("s_nationkey as domain", "s_suppkey % 50 as preference", "s_name as host")
    return names.mail_hosts(records).select("domain", F.array_join("hosts", ",").alias("hosts"))


@query("SRC-23_host_names", with_packets() + "SELECT event_id, min(s_name) AS name FROM packets LEFT JOIN supplier ON ip2 = 134744072 + s_suppkey % 3 GROUP BY event_id")
def host_names(spark, sf_dir):
    pointers = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("134744072 + s_suppkey % 3 as ip", "s_name as name")
    return names.host_names(read_packets(spark, sf_dir).select("event_id", "ip2"), pointers, "ip2").select("event_id", "name")


@query("FLT-18_unknown_protocols", with_packets() + "SELECT CASE event_id % 5 WHEN 3 THEN 'WINS' ELSE 'CUPS' END AS protocol, count(*) AS lines FROM packets WHERE event_id % 5 IN (3, 4) GROUP BY 1")
def unknown_protocols(spark, sf_dir):
    kinds = F.array(*[F.lit(x) for x in ("ARP", "BOOTP", "DNS", "WINS", "CUPS")])
    lines = read_packets(spark, sf_dir).select(F.concat(stamp("us"), F.lit(" "), F.get(kinds, F.col("event_id") % 5), F.lit(" and more")).alias("value"))
    return names.unknown_protocols(lines)


@query("FN-33_undecodable_bytes", "SELECT o_orderkey AS k, 'a' || (o_orderkey % 7) || 'z' AS plain FROM orders")
def undecodable(spark, sf_dir):
    """Every order's text has a byte in it that is no UTF-8."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"))
    data = F.concat(F.unhex(F.lit("61FF")), F.expr("cast(cast(k % 7 as string) as binary)"), F.unhex(F.lit("C37A")))
    return rows.select("k", net.readable_bytes(data).alias("plain"))


@query("FLT-15_untagged_lines", with_packets() + "SELECT us, ip1, port1, ip2, port2, bytes, 0 AS vlan_id FROM packets WHERE ip_proto = 6")
def untagged(spark, sf_dir):
    """VLANs are not kept if they are not wanted."""
    return text.parse_tcp(tcp_lines(read_packets(spark, sf_dir, 6)), ingest_vlan_id=False).drop("flags")


@query("SNK-13_rejected_lines", with_packets() + "SELECT CASE WHEN event_id % 4 = 0 THEN 'too short a line' ELSE 'bad ' || us END AS value FROM packets WHERE ip_proto = 6 AND event_id % 4 < 2")
def rejected_lines(spark, sf_dir):
    """Lines without a packet, equal ones as often as they come."""
    p = read_packets(spark, sf_dir, 6)
    good = tcp_lines(p.where("event_id % 4 >= 2"))
    bad = p.where("event_id % 4 < 2").select(F.when(F.col("event_id") % 4 == 0, "too short a line").otherwise(F.concat(F.lit("bad "), F.col("us").cast("string"))).alias("value"))
    return text.rejected(good.union(bad), text.parse_tcp)
