"""Names, hardware addresses and IP addresses that ARP, BROWSER, DHCP and DNS lines tell of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions import net, times
from flowloom.operators.ordered import with_starts
from flowloom.sources.text import micros

_IP = r"(\d{1,3}(?:\.\d{1,3}){3})"
_MAC = r"([0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5})"
ASKS = rf"^(\S+) ARP {_MAC} .*Who has \S+\? Tell {_IP}"
ANSWERS = rf"^(\S+) ARP {_MAC} .*?{_IP} is at {_MAC}"
ANNOUNCES = rf"^(\S+) BROWSER {_IP} {_MAC} .*?(?:Host|Master) Announcement ([^, ]+)"
INFORMS = rf"^(\S+) DHCP {_IP} {_MAC} \S+ (\S+) \S+ DHCP Inform - Transaction ID (\S+)"
REQUESTS = rf"^(\S+) DHCP {_IP} {_MAC} \S+ (\S+) \S+ DHCP Request - Transaction ID (\S+)"
GRANTS = rf"^(\S+) DHCP {_IP} {_MAC} \S+ {_IP} DHCP ACK - Transaction ID (\S+)"
QUERY = rf"^(\S+) DNS {_IP} {_MAC} {_IP} (0x[0-9a-f]+) Standard query (?:0x[0-9a-f]+ )?(A|PTR) (\S+)"
RESPONSE = rf"^(\S+) DNS {_IP} {_MAC} {_IP} (0x[0-9a-f]+) Standard query response (?:0x[0-9a-f]+ )?(.*)$"
_DAMAGE = r"\s*\[Malformed Packet\].*$"


def _g(pattern: str, i: int) -> Column:
    return F.regexp_extract("value", pattern, i)


#: Protocols of name lines that are read, and those that are passed over.
READ, PASSED_OVER = ("ARP", "BROWSER", "DHCP", "DNS"), ("NBDS", "SMB_NETLOGON", "BOOTP")


def unknown_protocols(lines: DataFrame) -> DataFrame:
    """protocol and lines: how many lines are of protocols neither read nor passed over."""
    protocol = F.regexp_extract("value", r"^\S+ (\S+)", 1)
    return lines.select(protocol.alias("protocol")).where(~F.col("protocol").isin(*READ, *PASSED_OVER)).groupBy("protocol").agg(F.count("*").alias("lines"))


def mail_hosts(records: DataFrame) -> DataFrame:
    """From records (domain, preference, host): domain and hosts, by preference, then name."""
    listed = F.array_sort(F.collect_list(F.struct("preference", "host")))
    return records.groupBy("domain").agg(F.transform(listed, lambda r: r["host"]).alias("hosts"))


def host_names(rows: DataFrame, pointers: DataFrame, ip: str = "ip") -> DataFrame:
    """Left join of addresses to names of a table of pointers (ip, name), the least name of several."""
    least = pointers.groupBy(F.col("ip").alias(ip)).agg(F.min("name").alias("name"))
    return rows.join(least, ip, "left")


def events(us: Column, kind: Column, names: Column, mac: Column, ips: Column) -> list[Column]:
    """us, r, n (names), m (hardware address as a number), i (addresses as numbers), tm (minute of the packet); empty lists are null."""
    listed = lambda a: F.when(F.size(a) > 0, a)
    return [us.alias("us"), kind.alias("r"), listed(F.array_compact(names)).alias("n"), net.mac_to_long(mac).alias("m"), listed(F.array_compact(F.transform(ips, net.ip_to_long))).alias("i"), times.floor_to(F.expr("0") + F.floor(us / 1_000_000), 60).alias("tm")]


def arp(lines: DataFrame) -> DataFrame:
    """Who asks tells its own address; who answers tells that of the answer."""
    none = F.array().cast("array<string>")
    asks = lines.where(F.col("value").rlike(ASKS)).select(*events(micros(_g(ASKS, 1)), F.lit("ARP"), none, _g(ASKS, 2), F.array(_g(ASKS, 3))))
    answers = lines.where(F.col("value").rlike(ANSWERS)).select(*events(micros(_g(ANSWERS, 1)), F.lit("ARP"), none, _g(ANSWERS, 4), F.array(_g(ANSWERS, 3))))
    return asks.union(answers)


def browser(lines: DataFrame) -> DataFrame:
    rows = lines.where(F.col("value").rlike(ANNOUNCES))
    return rows.select(*events(micros(_g(ANNOUNCES, 1)), F.lit("BRW"), F.array(_g(ANNOUNCES, 4)), _g(ANNOUNCES, 3), F.array(_g(ANNOUNCES, 2))))


def answered(requests: DataFrame, replies: DataFrame, keys: list[str], timeout: int) -> DataFrame:
    """Replies with the columns (prefix q_) of the last request before them on the keys, each request at most once, within the timeout; others go."""
    carried = [c for c in requests.columns if c not in keys]
    a = requests.select(*keys, F.struct(*carried).alias("_q"), F.col("us").alias("_us"), F.lit(0).alias("_kind"), *[F.lit(None).cast(replies.schema[c].dataType).alias(c) for c in replies.columns if c not in keys])
    b = replies.select(*keys, F.lit(None).cast(a.schema["_q"].dataType).alias("_q"), F.col("us").alias("_us"), F.lit(1).alias("_kind"), *[c for c in replies.columns if c not in keys])
    order = Window.partitionBy(*keys).orderBy("_us", "_kind")
    both = a.unionByName(b).withColumn("_before", F.lag("_q").over(order)).withColumn("_was", F.lag("_us").over(order))
    found = both.where((F.col("_kind") == 1) & F.col("_before").isNotNull() & (F.col("_us") - F.col("_was") <= timeout * 1_000_000))
    return found.select(*replies.columns, *[F.col(f"_before.{c}").alias(f"q_{c}") for c in carried])


def dhcp(lines: DataFrame, timeout: int = 120) -> DataFrame:
    """Informs tell of themselves; an ACK of the name and hardware address of its request."""
    informs = lines.where(F.col("value").rlike(INFORMS)).select(*events(micros(_g(INFORMS, 1)), F.lit("DHCP"), F.array(_g(INFORMS, 4)), _g(INFORMS, 3), F.array(_g(INFORMS, 2))))
    requests = lines.where(F.col("value").rlike(REQUESTS)).select(_g(REQUESTS, 5).alias("id"), micros(_g(REQUESTS, 1)).alias("us"), _g(REQUESTS, 3).alias("mac"), _g(REQUESTS, 4).alias("name"))
    grants = lines.where(F.col("value").rlike(GRANTS)).select(_g(GRANTS, 5).alias("id"), micros(_g(GRANTS, 1)).alias("us"), _g(GRANTS, 4).alias("ip"))
    met = answered(requests, grants, ["id"], timeout)
    return informs.union(met.select(*events(F.col("us"), F.lit("DHCP"), F.array("q_name"), F.col("q_mac"), F.array("ip"))))


def dns(lines: DataFrame, timeout: int = 120) -> DataFrame:
    """Answers to known queries: names are the query's and those of CNAME and PTR records, addresses those of A records, or the one that a PTR query asks for."""
    queries = lines.where(F.col("value").rlike(QUERY) & ~F.col("value").contains("response")).select(_g(QUERY, 5).alias("id"), _g(QUERY, 2).alias("client"), micros(_g(QUERY, 1)).alias("us"), _g(QUERY, 7).alias("asked"))
    body = F.regexp_replace(_g(RESPONSE, 6), _DAMAGE, "")
    replies = lines.where(F.col("value").rlike(RESPONSE)).select(_g(RESPONSE, 5).alias("id"), _g(RESPONSE, 4).alias("client"), micros(_g(RESPONSE, 1)).alias("us"), body.alias("body")).where(F.col("body").rlike(r"^(A|CNAME|PTR|RRSIG) \S"))
    met = answered(queries, replies, ["id", "client"], timeout)
    records = lambda kinds: F.regexp_extract_all("body", F.lit(rf"(?:^|\s)(?:{kinds}) (\S+)"), F.lit(1))
    first = F.regexp_extract("body", r"^(\S+)", 1)
    kind = F.when(first == "CNAME", "CNM").otherwise(first)
    asked = F.col("q_asked")
    reverse = asked.rlike(r"in-addr\.arpa\.?$")
    names = F.array_distinct(F.concat(F.array(F.when(~reverse, asked)), records("CNAME|PTR")))
    ips = F.array_distinct(F.concat(F.array(net.arpa_to_ip(asked)), records("A")))
    return met.select(*events(F.col("us"), kind, names, F.lit(None).cast("string"), ips))


def throttled(rows: DataFrame, keys: list[str], wait: int, time: str = "us") -> DataFrame:
    """Rows that are the first of their key or come more than `wait` seconds after the last such one; of rows at one time one."""
    start = "_start"
    return with_starts(rows, keys, time, wait * 1_000_000 + 1, start).where(F.col(time) == F.col(start)).drop(start).dropDuplicates([*keys, time])
