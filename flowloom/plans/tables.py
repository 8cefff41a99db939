"""Queries for texts, lines and small tables that are written out of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.config import TrafficConfig
from flowloom.functions import net
from flowloom.operators import enrich, names
from flowloom.plans.registry import query
from flowloom.plans.scalars import stamp
from flowloom.plans.sql import with_packets
from flowloom.sources import reference
from flowloom.sources.packets import read_packets

LOCAL = TrafficConfig().local_subnets


def _dotted(ip: str) -> str:
    """SQL of both sides for the four octets of a number."""
    return "concat_ws('.', " + ", ".join(f"({ip} // {256**i}) % 256" for i in (3, 2, 1, 0)) + ")"


def _spark(sql: str) -> str:
    return sql.replace("//", " div ")


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- texts ------------------------------------------------------------------

_TEXT = f"""CASE event_id % 6 WHEN 0 THEN {_dotted("ip1")} WHEN 1 THEN concat('256.', {_dotted("ip1")}) WHEN 2 THEN concat_ws('.', ip1 // 16777216, event_id % 256, port1 % 256)
WHEN 3 THEN concat('0', {_dotted("ip1")}) WHEN 4 THEN '' ELSE concat_ws('.', 256 + event_id % 700, 1, 1, 1) END"""


@query("FN-3_ip_validity", with_packets() + f"SELECT event_id, {_TEXT} AS t, CASE WHEN event_id % 6 = 0 THEN ip1 END AS n, event_id % 6 = 0 AS valid FROM packets")
def validity(spark, sf_dir):
    """Four octets of up to 255 without leading zeros, and nothing else."""
    texts = read_packets(spark, sf_dir).select("event_id", F.expr(_spark(_TEXT)).alias("t"))
    return texts.select("event_id", "t", net.ip_to_long(F.col("t")).alias("n"), net.is_ipv4(F.col("t")).alias("valid"))


_REVERSED = "concat_ws('.', ip1 % 256, (ip1 // 256) % 256, (ip1 // 65536) % 256, ip1 // 16777216)"
_ARPA = f"CASE event_id % 4 WHEN 0 THEN concat({_REVERSED}, '.in-addr.arpa') WHEN 1 THEN concat({_REVERSED}, '.in-addr.arpa.') WHEN 2 THEN concat('900.', event_id % 256, '.2.1.in-addr.arpa') ELSE concat('host', event_id, '.example') END"


@query("FN-27_reverse_names", with_packets() + f"SELECT event_id, {_ARPA} AS name, CASE WHEN event_id % 4 < 2 THEN {_dotted('ip1')} END AS ip FROM packets")
def reverse_names(spark, sf_dir):
    return read_packets(spark, sf_dir).select("event_id", F.expr(_spark(_ARPA)).alias("name")).select("event_id", "name", net.arpa_to_ip(F.col("name")).alias("ip"))


#: 48 bits from a key, by a step that is odd.
_MAC_NUMBER = "(c_custkey * 1000003) % 281474976710656"


@query("FN-26_mac_numbers", f"""SELECT c_custkey AS k, CASE WHEN c_custkey % 5 <> 0 THEN {_MAC_NUMBER} END AS n FROM customer""")
def mac_numbers(spark, sf_dir):
    """Six pairs of hexadecimal digits; every fifth is cut short."""
    digits = F.lpad(F.lower(F.hex(F.expr(_MAC_NUMBER))), 12, "0")
    mac = F.array_join(F.regexp_extract_all(digits, F.lit("(..)"), F.lit(1)), ":")
    k = F.col("c_custkey")
    return _table(spark, sf_dir, "customer").select(k.alias("k"), net.mac_to_long(F.when(k % 5 == 0, F.left(mac, F.lit(14))).otherwise(mac)).alias("n"))


_AS = "CASE s_suppkey % 4 WHEN 0 THEN concat('AS', s_suppkey, ' ', s_name) WHEN 1 THEN concat('AS', s_suppkey) WHEN 2 THEN concat(s_suppkey, ' ', s_name) ELSE concat('ASN', s_suppkey) END"


@query("FN-24_asn_text", f"SELECT {_AS} AS t, CASE WHEN s_suppkey % 4 < 2 THEN s_suppkey END AS asn FROM supplier")
def asn_text(spark, sf_dir):
    return _table(spark, sf_dir, "supplier").select(F.expr(_AS).alias("t")).select("t", net.asn_of(F.col("t")).alias("asn"))


_NUMBER = "CASE o_orderkey % 4 WHEN 0 THEN concat('', o_orderkey) WHEN 1 THEN concat('-', o_orderkey) WHEN 2 THEN concat(o_orderkey, 'x') ELSE '' END"


@query("FN-25_text_to_number", f"SELECT {_NUMBER} AS t, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey WHEN 1 THEN -o_orderkey END AS n FROM orders")
def text_to_number(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select(F.expr(_NUMBER).alias("t")).select("t", F.col("t").try_cast("long").alias("n"))


#: Addresses in and beside the private blocks, and all over.
_NEAR = "CASE o_orderkey % 5 WHEN 0 THEN 167772160 - 500 + o_orderkey % 1000 WHEN 1 THEN 2886795263 - 500 + o_orderkey % 1000 WHEN 2 THEN 3232235520 - 500 + o_orderkey % 1000 WHEN 3 THEN 3232301055 - 500 + o_orderkey % 1000 ELSE (o_orderkey * 2654435761) % 4294967296 END"


@query("FLT-9_local_subnets", f"SELECT k, ip, ip // 16777216 = 10 OR ip // 65536 = 44048 OR ip // 65536 = 49320 AS is_local FROM (SELECT o_orderkey AS k, CAST({_NEAR} AS BIGINT) AS ip FROM orders)")
def local_subnets(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.expr(_NEAR).cast("long").alias("ip"))
    return rows.select("k", "ip", net.in_subnets(F.col("ip"), LOCAL).alias("is_local"))


#: Rules by whole octets; a 0 between others fits any octet.
_RULES = ("10.0.0.0/8", "192.0.3.0/24", "172.16.0.9/32")
_BESIDE = "CASE o_orderkey % 4 WHEN 0 THEN 167772160 + o_orderkey WHEN 1 THEN 3221225472 + o_orderkey % 16000000 WHEN 2 THEN 2886729728 + o_orderkey % 1024 ELSE (o_orderkey * 2654435761) % 4294967296 END"


@query("FN-23_octet_rules", f"SELECT k, ip, ip // 16777216 = 10 OR (ip // 16777216 = 192 AND ip // 256 % 256 = 3) OR (ip // 65536 = 44048 AND ip % 256 = 9) AS fits FROM (SELECT o_orderkey AS k, CAST({_BESIDE} AS BIGINT) AS ip FROM orders)")
def octet_rules(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.expr(_BESIDE).cast("long").alias("ip"))
    return rows.select("k", "ip", net.in_octet_rules(F.col("ip"), _RULES).alias("fits"))


# --- small tables -----------------------------------------------------------


@query("SRC-20_asn_names", "SELECT CAST(64500 + s_nationkey AS BIGINT) AS asn, arg_max(s_name, s_suppkey) AS name FROM supplier GROUP BY ALL")
def asn_names(spark, sf_dir):
    """Of several names of a number the last; a header is none."""
    rows = _table(spark, sf_dir, "supplier").selectExpr("cast(64500 + s_nationkey as string) as asn", "s_name as name", "cast(s_suppkey as long) as ord")
    return enrich.latest_names(rows.union(spark.createDataFrame([("asn", "name", 0)], rows.schema)))


#: Targets as configured, one a supplier: some of another kind, without address, type, or port.
_CONFIG = """SELECT concat('c', s_suppkey) AS c_id, CASE WHEN s_suppkey % 5 = 0 THEN 'other' ELSE 'latency' END AS doc_type, concat('host', s_nationkey) AS target,
  CASE WHEN s_suppkey % 3 > 0 THEN concat('10.0.', s_suppkey // 256 % 256, '.', s_suppkey % 256) END AS ip, CASE WHEN s_suppkey % 7 = 0 THEN '10.9.9.9' END AS prev_ip,
  CASE WHEN s_suppkey % 2 = 0 THEN 'icmp' ELSE 'tcp' END AS protocol, CASE WHEN s_suppkey % 4 = 0 THEN 13 END AS type, CASE WHEN s_suppkey % 3 = 1 THEN 443 END AS port, CASE WHEN s_suppkey % 3 = 1 THEN 'https' END AS appl FROM supplier"""
_TARGETS = f"""SELECT c_id, target, coalesce(ip, '0.1.2.3') AS ip, prev_ip, protocol, CASE WHEN protocol = 'icmp' THEN coalesce(type, 8) END AS type, CASE WHEN protocol = 'tcp' THEN coalesce(port, 80) END AS port, CASE WHEN protocol = 'tcp' THEN appl END AS appl
FROM ({_CONFIG}) WHERE doc_type = 'latency'"""


def _config(spark, sf_dir):
    return _table(spark, sf_dir, "supplier").selectExpr(*(x.strip() for x in _split(_spark(_CONFIG)[len("SELECT ") : _spark(_CONFIG).rindex(" FROM ")])))


def _split(columns: str) -> list[str]:
    """A list of SQL columns at its outer commas."""
    out, depth = [""], 0
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


@query("SRC-16_latency_targets", _TARGETS)
def targets(spark, sf_dir):
    return reference.latency_targets(_config(spark, sf_dir))


@query("SRC-22_resolved_targets", f"""SELECT c_id, CASE WHEN new_ip <> ip THEN new_ip ELSE ip END AS ip, CASE WHEN new_ip <> ip THEN ip ELSE prev_ip END AS prev_ip
FROM ({_TARGETS}) LEFT JOIN (SELECT concat('host', n_nationkey) AS target, concat('10.0.0.', n_nationkey) AS new_ip FROM nation WHERE n_nationkey % 4 <> 3) USING (target)""")
def resolved_targets(spark, sf_dir):
    """Names that resolve to another address than before, to the same, and not at all."""
    addresses = _table(spark, sf_dir, "nation").where("n_nationkey % 4 <> 3").selectExpr("concat('host', n_nationkey) as target", "concat('10.0.0.', n_nationkey) as new_ip")
    return reference.resolved(reference.latency_targets(_config(spark, sf_dir)), addresses).select("c_id", "ip", "prev_ip")


@query("JOIN-14_target_changes", "SELECT concat('c', s_suppkey) AS c_id, CASE s_suppkey % 3 WHEN 0 THEN 'added' ELSE 'removed' END AS change FROM supplier WHERE s_suppkey % 3 < 2")
def target_changes(spark, sf_dir):
    config = _config(spark, sf_dir).withColumn("k", F.expr("cast(substring(c_id, 2) as long) % 3"))
    return reference.target_changes(config.where("k > 0"), config.where("k <> 1"))


# --- names ------------------------------------------------------------------

#: Packets a line each, all of a kind by event_id % 4; what is asked or granted is answered some multiple of 30 s later, within 120 s or not.
_WAITED = "us + event_id % 7 * 30000000"
_MINUTE = "// 60000000 * 60"


def _hardware(ip: str):
    """A hardware address of an address' octets."""
    octet = lambda i: F.lpad(F.lower(F.hex(F.expr(f"({ip} div {256**i}) % 256"))), 2, "0")
    return F.concat_ws(":", F.lit("02"), F.lit("00"), *map(octet, (3, 2, 1, 0)))


_HARDWARE = 2 << 40


def _line(us, *parts):
    return F.concat(stamp(us), *[F.expr(_spark(p)) if isinstance(p, str) else p for p in parts]).alias("value")


def _flat(df):
    return df.select("us", "r", F.array_join("n", ",").alias("names"), "m", F.array_join(F.transform("i", lambda x: x.cast("string")), ",").alias("ips"), "tm")


@query("PROJ-10_arp_names", with_packets() + f"SELECT us, 'ARP' AS r, CAST(NULL AS VARCHAR) AS names, {_HARDWARE} + ip1 AS m, CAST(CASE event_id % 4 WHEN 0 THEN ip1 ELSE ip2 END AS VARCHAR) AS ips, us {_MINUTE} AS tm FROM packets WHERE event_id % 4 < 2")
def arp_names(spark, sf_dir):
    """Who asks, who answers, and lines that tell of nobody."""
    p, mac = read_packets(spark, sf_dir), _hardware("ip1")
    asks = p.where("event_id % 4 = 0").select(_line("us", "' ARP '", mac, "' '", mac, f"concat(' ff:ff:ff:ff:ff:ff Who has ', {_dotted('ip2')}, '? Tell ', {_dotted('ip1')})"))
    answers = p.where("event_id % 4 = 1").select(_line("us", "' ARP '", _hardware("ip2"), "' '", _hardware("ip2"), "' '", mac, f"concat(' ', {_dotted('ip2')}, ' is at ')", mac))
    other = p.where("event_id % 4 > 1").select(_line("us", "' ARP '", mac, "concat(' Gratuitous ', event_id)"))
    return _flat(names.arp(asks.union(answers).union(other)))


@query("PROJ-11_browser_names", with_packets() + f"SELECT us, 'BRW' AS r, 'PC-' || event_id AS names, {_HARDWARE} + ip1 AS m, CAST(ip1 AS VARCHAR) AS ips, us {_MINUTE} AS tm FROM packets WHERE event_id % 4 < 2")
def browser_names(spark, sf_dir):
    kinds = "CASE event_id % 4 WHEN 0 THEN ' Host Announcement ' WHEN 1 THEN ' Local Master Announcement ' WHEN 2 THEN ' Get Backup List Request ' ELSE ' Domain Announcement ' END"
    lines = read_packets(spark, sf_dir).select(_line("us", f"concat(' BROWSER ', {_dotted('ip1')}, ' ')", _hardware("ip1"), f"concat(' 10.255.255.255', {kinds}, 'PC-', event_id, ', Workstation')"))
    return _flat(names.browser(lines))


@query("JOIN-10_dhcp_names", with_packets() + f"""SELECT us, 'DHCP' AS r, 'pc-' || event_id AS names, {_HARDWARE} + ip1 AS m, CAST(ip1 AS VARCHAR) AS ips, us {_MINUTE} AS tm FROM packets WHERE event_id % 4 = 0
UNION ALL SELECT {_WAITED}, 'DHCP', 'pc-' || event_id, {_HARDWARE} + ip1, CAST(184000000 + event_id AS VARCHAR), ({_WAITED}) {_MINUTE} FROM packets WHERE event_id % 4 = 1 AND event_id % 7 < 5""")
def dhcp_names(spark, sf_dir):
    """Informs; requests granted in time or too late; grants that nobody asked for."""
    p = read_packets(spark, sf_dir)
    of = lambda kind: f"concat(' 255.255.255.255 pc-', event_id, ' 0.0.0.0 DHCP {kind} - Transaction ID 0x', lower(hex(event_id)))"
    informs = p.where("event_id % 4 = 0").select(_line("us", f"concat(' DHCP ', {_dotted('ip1')}, ' ')", _hardware("ip1"), of("Inform")))
    requests = p.where("event_id % 4 = 1").select(_line("us", "' DHCP 0.0.0.0 '", _hardware("ip1"), of("Request")))
    grants = p.where("event_id % 4 in (1, 2)").withColumn("us", F.expr(_WAITED)).select(_line("us", f"concat(' DHCP ', {_dotted('ip2')}, ' ')", _hardware("ip2"), f"concat(' 255.255.255.255 ', {_dotted('(184000000 + event_id)')}, ' DHCP ACK - Transaction ID 0x', lower(hex(event_id)))"))
    return _flat(names.dhcp(informs.union(requests).union(grants)))


@query("JOIN-9_dns_names", with_packets() + f"""SELECT {_WAITED} AS us, CASE event_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'CNM' ELSE 'PTR' END AS r,
  CASE event_id % 4 WHEN 0 THEN 'h' || event_id % 50 || '.example' WHEN 1 THEN 'h' || event_id % 50 || '.example,c' || event_id || '.example' ELSE 'p' || event_id || '.example' END AS names, CAST(NULL AS BIGINT) AS m,
  CAST(CASE WHEN event_id % 4 < 2 THEN ip2 ELSE ip1 END AS VARCHAR) AS ips, ({_WAITED}) {_MINUTE} AS tm FROM packets WHERE event_id % 4 < 3 AND event_id % 7 < 5""")
def dns_names(spark, sf_dir):
    """Addresses, aliases and reverse names, in time or too late; answers that nobody asked for."""
    p = read_packets(spark, sf_dir)
    number = "'0x', lower(hex(event_id))"
    asked = f"CASE WHEN event_id % 4 < 2 THEN concat('A h', event_id % 50, '.example') ELSE concat('PTR ', {_REVERSED}, '.in-addr.arpa') END"
    told = f"CASE event_id % 4 WHEN 0 THEN concat('A ', {_dotted('ip2')}) WHEN 1 THEN concat('CNAME c', event_id, '.example A ', {_dotted('ip2')}) WHEN 2 THEN concat('PTR p', event_id, '.example') ELSE concat('A ', {_dotted('ip2')}) END"
    queries = p.where("event_id % 4 < 3").select(_line("us", f"concat(' DNS ', {_dotted('ip1')}, ' ')", _hardware("ip1"), f"concat(' 192.0.2.53 ', {number}, ' Standard query ', {number}, ' ', {asked})"))
    replies = p.withColumn("us", F.expr(_WAITED)).select(_line("us", "' DNS 192.0.2.53 '", _hardware("ip2"), f"concat(' ', {_dotted('ip1')}, ' ', {number}, ' Standard query response ', {number}, ' ', {told})"))
    return _flat(names.dns(queries.union(replies)))
