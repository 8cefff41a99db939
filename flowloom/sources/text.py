"""Sniffer lines (a column `value`) as packets. Lines that don't fit a parser give no row; `rejected` keeps them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import net

_IP = r"(\d{1,3}(?:\.\d{1,3}){3})"
TCP_LINE = rf"^(\d+\.\d{{6}}) \S+ > \S+, ethertype (?:IPv4 \(0x0800\)|802\.1Q \(0x8100\)), length (\d+): (?:vlan (\d+), p \d+, (?:DEI, )?ethertype IPv4, )?(?:\(invalid\) )?(?:truncated-ip - \d+ bytes missing! )?{_IP}\.(\d+) > {_IP}\.(\d+): Flags \[([^\]]*)\]"
TCP_LATENCY_LINE = rf"^(\d+\.\d{{6}}) IP {_IP}\.(\d+) > {_IP}\.(\d+): Flags \[(S|S\.|F\.)\](?:, seq (\d+)(?::\d+)?)?(?:, ack (\d+))?"
ICMP_LATENCY_LINE = rf"^(\d+\.\d{{6}}) IP {_IP} > {_IP}: ICMP echo (request|reply), id (\d+), seq (\d+), length (\d+)"
#: Between the groups of a line; in no line.
_MARK = "\x01"
#: ICMP types whose messages carry a sequence number.
SEQUENCED = ("0", "8", "13", "14", "17", "18")
#: Protocols that leak into the capture of what is not IP, and belong to other captures.
LEAKED = ("BROWSER", "CLDAP", "DHCP", "DNS", "HTTP", "ICMP", "IPv4", "LLMNR", "MDNS", "NBNS", "NTP", "OCSP", "SSDP", "SSL", "SSLv2", "TCP", "TLSv1", "TLSv1.2", "UDP", "QUIC")


def micros(time: Column) -> Column:
    """Microseconds of an epoch with six decimal places, without passing through a double."""
    return F.replace(time, F.lit("."), F.lit("")).try_cast("long")


def _vlan(text: Column, keep: bool) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")).try_cast("int"), F.lit(0)) if keep else F.lit(0)


def _others(lines: DataFrame) -> list[str]:
    """Columns beside the line, which parsers keep."""
    return [c for c in lines.columns if c not in ("value", "t", "g")]


def framed(lines: DataFrame, least: int = 5) -> DataFrame:
    """Lines of at least so many tokens, trimmed."""
    return lines.select(F.trim("value").alias("value"), *_others(lines)).where(F.size(F.split("value", r"\s+")) >= least)


def _parsed(lines: DataFrame, cut: Callable[[Column], Column], fits: Callable[[Column], Column], fields: Callable[[Column], list[Column]]) -> DataFrame:
    """Fields of the parts that lines are cut into; of parts that don't fit, those of null. A line's fields are the one element of an array, so they are read once: conditions on plain columns are pushed below them, where the line is made, cut and read again for each column that they name. Nothing here is a function of lambdas, since Spark then compiles all of it."""
    g, others = F.col("g"), _others(lines)
    # what makes the lines is compiled apart from what reads them: Java only interprets methods of 8,000 bytes and more
    apart = lines.select(F.explode_outer(F.array("value")).alias("value"), *others)
    parts = apart.select(cut(F.col("value")).alias("g"), *others).select(F.when(fits(g), g).alias("g"), *others)
    return parts.select(F.struct(*fields(g)).alias("g"), *others).select(F.inline_outer(F.array("g")), *others)


def _groups(pattern: str, groups: int) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """Cuts a line that the pattern fits into its groups, running the pattern once, and tells whether it did."""
    kept = _MARK.join(f"${i}" for i in range(1, groups + 1))
    return lambda v: F.when(~v.contains(_MARK), F.split(F.regexp_replace(v, pattern + r"[\s\S]*$", kept), _MARK)), lambda g: F.size(g) == groups


def _tokens(v: Column) -> Column:
    # lines with single spaces, as most are, need no pattern
    mixed = reduce(or_, (v.contains(s) for s in ("  ", "\t", "\n", "\v", "\f", "\r")))
    return F.split(F.trim(v), F.when(mixed, r"\s+").otherwise(" "))


def _at(t: Column, i: int | Column) -> Column:
    return F.try_element_at(t, i) if isinstance(i, Column) else F.get(t, F.lit(i - 1))


def parse_tcp(lines: DataFrame, ingest_vlan_id: bool = True) -> DataFrame:
    """us ip1 port1 ip2 port2 bytes (frame length) vlan_id flags; SYN with ACK is the flag s. Ports beyond 65535 are misread ids of file systems and go."""
    cut, fits = _groups(TCP_LINE, 8)

    def fields(groups: Column) -> list[Column]:
        g = lambda i: groups[i - 1]
        return [
            micros(g(1)).alias("us"),
            net.ip_to_long(g(4)).alias("ip1"),
            g(5).try_cast("int").alias("port1"),
            net.ip_to_long(g(6)).alias("ip2"),
            g(7).try_cast("int").alias("port2"),
            g(2).cast("long").alias("bytes"),
            _vlan(g(3), ingest_vlan_id).alias("vlan_id"),
            F.regexp_replace(g(8), r"S\.", "s").alias("flags"),
        ]

    rows = _parsed(lines, lambda v: F.when(~v.contains("ICMP"), cut(F.trim(v))), fits, fields)
    return rows.where("port1 <= 65535 and port2 <= 65535 and ip1 is not null and ip2 is not null")


def parse_udp(lines: DataFrame, ingest_vlan_id: bool = True) -> DataFrame:
    """time [vlan] source [port] destination [port] length protocol...; ports are 0 where there are none. IPv6 goes."""

    def fields(t: Column) -> list[Column]:
        tagged = ~_at(t, 2).contains(".")
        k = F.when(tagged, 1).otherwise(0)
        ported = ~_at(t, k + 3).contains(".")
        length = F.when(ported, k + 6).otherwise(k + 4)
        return [
            micros(_at(t, 1)).alias("us"),
            net.ip_to_long(_at(t, k + 2)).alias("ip1"),
            F.when(ported, _at(t, k + 3)).otherwise("0").try_cast("int").alias("port1"),
            net.ip_to_long(F.when(ported, _at(t, k + 4)).otherwise(_at(t, k + 3))).alias("ip2"),
            F.when(ported, _at(t, k + 5)).otherwise("0").try_cast("int").alias("port2"),
            _at(t, length).try_cast("long").alias("bytes"),
            _vlan(F.when(tagged, _at(t, 2)), ingest_vlan_id).alias("vlan_id"),
            F.array_join(F.slice(t, length + 1, F.greatest(F.lit(0), F.size(t) - length)), " ").alias("protocol"),
        ]

    rows = _parsed(lines, _tokens, lambda t: (F.size(t) >= 5) & ~_at(t, 2).contains(":") & ~F.array_contains(t, "ICMPv6"), fields)
    return rows.where("us is not null and ip1 is not null and ip2 is not null and port1 <= 65535 and port2 <= 65535 and bytes is not null")


def parse_icmp(lines: DataFrame, ingest_vlan_id: bool = True) -> DataFrame:
    """time source length destination type code [sequence (hex)] [vlan]; of nested messages the outer one counts. typecode is type.code."""
    first = lambda c: F.substring_index(c, ",", 1)

    def fields(t: Column) -> list[Column]:
        sequenced = F.arrays_overlap(F.split(_at(t, 5), ","), F.array(*map(F.lit, SEQUENCED)))
        code = first(_at(t, 6))
        number = F.when(code.startswith("0x"), F.conv(F.substring(code, 3, 8), 16, 10)).otherwise(code)
        return [
            micros(_at(t, 1)).alias("us"),
            net.ip_to_long(first(_at(t, 2))).alias("ip1"),
            first(_at(t, 3)).try_cast("long").alias("bytes"),
            net.ip_to_long(first(_at(t, 4))).alias("ip2"),
            F.concat_ws(".", first(_at(t, 5)), number).alias("typecode"),
            F.when(sequenced, first(_at(t, 7))).try_cast("int").alias("seq"),
            _vlan(F.when(sequenced, _at(t, 9)).otherwise(_at(t, 7)), ingest_vlan_id).alias("vlan_id"),
        ]

    rows = _parsed(lines, _tokens, lambda t: F.size(t) >= 6, fields)
    return rows.where("us is not null and ip1 is not null and ip2 is not null and bytes is not null")


def parse_other(lines: DataFrame, ingest_vlan_id: bool = True) -> DataFrame:
    """time [vlan] source length destination protocol message: there is a VLAN if the second token has neither point nor colon. Messages are cut at 512 characters; protocols of other captures go."""

    def fields(t: Column) -> list[Column]:
        tagged = ~_at(t, 2).rlike("[.:]")
        k = F.when(tagged, 1).otherwise(0)
        message = F.array_join(F.slice(t, k + 6, F.greatest(F.lit(0), F.size(t) - k - 5)), " ")
        return [
            micros(_at(t, 1)).alias("us"),
            _at(t, k + 2).alias("s"),
            _at(t, k + 3).try_cast("long").alias("bytes"),
            _at(t, k + 4).alias("d"),
            _at(t, k + 5).alias("pr"),
            net.capped_message(message).alias("m"),
            _vlan(F.when(tagged, _at(t, 2)), ingest_vlan_id).alias("vlan_id"),
        ]

    rows = _parsed(lines, _tokens, lambda t: F.size(t) >= 5, fields)
    return rows.where(F.col("us").isNotNull() & F.col("bytes").isNotNull() & ~F.col("pr").isin(*LEAKED))


def parse_tcp_latency(lines: DataFrame) -> DataFrame:
    """SYN is a request of its sequence number, SYN-ACK the reply to its ack less 1. FIN-ACK has no sequence here: with application probes the client's port is the sequence of both."""

    def fields(groups: Column) -> list[Column]:
        g = lambda i: groups[i - 1]
        reply = g(6) != "S"
        return [
            micros(g(1)).alias("us"),
            net.ip_to_long(g(2)).alias("ip1"),
            g(3).cast("int").alias("port1"),
            net.ip_to_long(g(4)).alias("ip2"),
            g(5).cast("int").alias("port2"),
            g(6).alias("flag"),
            reply.alias("reply"),
            F.when(g(6) == "S", g(7).try_cast("long")).when(g(6) == "S.", g(8).try_cast("long") - 1).alias("seq"),
            F.when(reply, g(5)).otherwise(g(3)).cast("long").alias("client_port"),
        ]

    return _parsed(lines, *_groups(TCP_LATENCY_LINE, 8), fields).where("flag is not null")


def parse_icmp_latency(lines: DataFrame) -> DataFrame:
    """Echo requests and replies; those of under 64 bytes belong to path tracing and go."""

    def fields(groups: Column) -> list[Column]:
        g = lambda i: groups[i - 1]
        return [micros(g(1)).alias("us"), net.ip_to_long(g(2)).alias("ip1"), net.ip_to_long(g(3)).alias("ip2"), (g(4) == "reply").alias("reply"), g(5).cast("int").alias("id"), g(6).cast("long").alias("seq"), g(7).cast("int").alias("length")]

    return _parsed(lines, *_groups(ICMP_LATENCY_LINE, 7), fields).where("length >= 64")


def rejected(lines: DataFrame, parser: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The lines of which the parser makes no row, equal ones too."""
    kept = parser(lines.select("value", F.col("value").alias("line"))).select("line").distinct()
    return lines.join(kept, lines["value"] == kept["line"], "left_anti")


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return (spark.readStream if streaming else spark.read).text(path)
