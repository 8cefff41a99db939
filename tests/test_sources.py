"""Parsers on sample lines, the pcap reader, configuration and addresses."""

from __future__ import annotations

import random
import re
import struct

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowloom.config import TrafficConfig
from flowloom.sources import pcap, text


def rows(spark, parser, *lines):
    return parser(spark.createDataFrame([(x,) for x in lines], "value string")).collect()


def test_tcp_lines(spark):
    plain = "1700000900.200687 02:00:5e:00:53:01 > 02:00:5e:00:53:02, ethertype IPv4 (0x0800), length 162: 192.0.2.10.41017 > 198.51.100.11.9300: Flags [P.], seq 1441:1537"
    vlan = "1700000900.200612 02:00:5e:00:53:03 > 02:00:5e:00:53:04, ethertype 802.1Q (0x8100), length 166: vlan 1, p 1, ethertype IPv4, 192.0.2.10.41017 > 198.51.100.11.9300: Flags [S.], seq 1441:1537"
    cut = "1700001200.388249 02:00:5e:00:53:05 > 02:00:5e:00:53:06, ethertype IPv4 (0x0800), length 63: truncated-ip - 3 bytes missing! 203.0.113.12.3026 > 192.0.2.13.6631: Flags [S], seq 900300, win 5840"
    bad = "1700001100.259364 02:00:5e:00:53:01 > 02:00:5e:00:53:03, ethertype IPv4 (0x0800), length 154: 198.51.100.14.1234567890 > 203.0.113.15.2049: 96 getattr fh 0,41/0"
    got = sorted(rows(spark, text.parse_tcp, plain, vlan, cut, bad, "", "nonsense"))
    assert [(r.us, r.port1, r.port2, r.bytes, r.vlan_id, r.flags) for r in got] == [(1700000900200612, 41017, 9300, 166, 1, "s"), (1700000900200687, 41017, 9300, 162, 0, "P."), (1700001200388249, 3026, 6631, 63, 0, "S")]
    lines = spark.createDataFrame([(plain,), (bad,)], "value string")
    assert [r.value for r in text.rejected(lines, text.parse_tcp).collect()] == [bad]


def test_udp_lines(spark):
    got = rows(
        spark, text.parse_udp, "1700000700.482395 192.0.2.16  198.51.100.17  996 IPv4", "1700000700.482396 1 192.0.2.16  198.51.100.17  996 IPv4", "1700000000.950789 203.0.113.18 32878 192.0.2.19 53 73 DNS", "1700000000.950790 1 203.0.113.18 32878 192.0.2.19 53 73 DNS", "1700000000.950791 fe80::1 1 fe80::2 2 73 DNS",
    )
    assert sorted((r.us, r.port1, r.port2, r.bytes, r.vlan_id, r.protocol) for r in got) == [(1700000000950789, 32878, 53, 73, 0, "DNS"), (1700000000950790, 32878, 53, 73, 1, "DNS"), (1700000700482395, 0, 0, 996, 0, "IPv4"), (1700000700482396, 0, 0, 996, 1, "IPv4")]


def test_icmp_lines(spark):
    got = rows(
        spark, text.parse_icmp, "1700000200.422514 198.51.100.20 178 203.0.113.21 8 0  4660 (0x1234)", "1700000800.582230 192.0.2.22 112,84 198.51.100.23 3,8 1,0 8738 (0x2222)", "1700000600.608550 203.0.113.24 56,60 192.0.2.25 3 13", "1700001000.740099 198.51.100.11 84 198.51.100.26      8 0 13107 (0x3333) 1",
    )
    assert sorted((r.us, r.bytes, r.typecode, r.seq, r.vlan_id) for r in got) == [(1700000200422514, 178, "8.0", 4660, 0), (1700000600608550, 56, "3.13", None, 0), (1700000800582230, 112, "3.1", 8738, 0), (1700001000740099, 84, "8.0", 13107, 1)]


def test_other_lines(spark):
    got = rows(spark, text.parse_other, "1700000300.963206 02:00:5e:00:53:07 60 ff:ff:ff:ff:ff:ff ARP Who has 203.0.113.27? Tell 198.51.100.20", "1700000300.963207 4 02:00:5e:00:53:07 60 ff:ff:ff:ff:ff:ff DNS x")
    assert [(r.s, r.bytes, r.d, r.pr, r.m, r.vlan_id) for r in got] == [("02:00:5e:00:53:07", 60, "ff:ff:ff:ff:ff:ff", "ARP", "Who has 203.0.113.27? Tell 198.51.100.20", 0)]


def test_latency_lines(spark):
    syn = "1700000500.123198 IP 192.0.2.28.45012 > 198.51.100.29.80: Flags [S], seq 500100, win 14600, options"
    answer = "1700000500.149542 IP 198.51.100.29.80 > 192.0.2.28.45012: Flags [S.], seq 700200, ack 500101, win 5792, options"
    a, b = sorted(rows(spark, text.parse_tcp_latency, syn, answer))
    assert (a.reply, b.reply) == (False, True) and a.seq == b.seq and a.client_port == b.client_port and b.us - a.us == 26344
    echo = "1700000400.294221 IP 192.0.2.28 > 203.0.113.30: ICMP echo request, id 411, seq 17, length 64"
    back = "1700000400.345048 IP 203.0.113.30 > 192.0.2.28: ICMP echo reply, id 411, seq 17, length 64"
    a, b = sorted(rows(spark, text.parse_icmp_latency, echo, back, echo.replace("length 64", "length 40")))
    assert (a.id, a.seq) == (b.id, b.seq) and b.us - a.us == 50827


def test_unmatched_dns(spark):
    from flowloom.operators import names

    lines = ["1700000100.257824 DNS 192.0.2.31 02:00:5e:00:53:08 203.0.113.21 0x1a01 Standard query 0x1a01 A build.example.org", "1700000100.298133 DNS 203.0.113.21 02:00:5e:00:53:09 192.0.2.31 0x1a02 Standard query response 0x1a02 CNAME alias.example.net A 198.51.100.32"]
    assert rows(spark, names.dns, *lines) == []


def _packet(epoch, micro, payload, wire=None):
    return struct.pack("<IIII", epoch, micro, len(payload), wire or len(payload)) + payload


HEAD = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)


def test_pcap(spark, tmp_path):
    eth = bytes(12) + b"\x08\x00" + bytes([0x45, 0, 0, 40, 0, 0, 0, 0, 64, 6, 0, 0, 10, 0, 0, 1, 8, 8, 8, 8]) + struct.pack(">HH", 40001, 80) + bytes(9) + b"\x12" + bytes(6)
    (tmp_path / "a.pcap").write_bytes(HEAD + _packet(1700000000, 5, eth, 100) + b"\xff" * 21 + _packet(1700000001, 6, eth))
    (tmp_path / "b.pcap").write_bytes(struct.pack(">I", 0xA1B2C3D4) + HEAD[4:])
    packets = pcap.read_pcap(spark, str(tmp_path))
    got = sorted(packets.where("problem is null").collect(), key=lambda r: r.us)
    assert [(r.us, r.wire, r.pad) for r in got] == [(1700000000000005, 100, 100 - len(eth)), (1700000001000006, len(eth), 0)]
    assert sorted(r.problem for r in packets.where("problem is not null").collect()) == ["byte-swapped file", "skipped 21 bytes"]
    head = pcap.ipv4_headers(packets).orderBy("us").first()
    assert (head.ip1, head.port1, head.ip2, head.port2, head.bytes, head.flags, head.vlan_id) == (167772161, 40001, 134744072, 80, 100, 18, 0)


@given(st.lists(st.binary(max_size=40), max_size=6))
def test_pcap_gives_back_what_was_written(payloads):
    data = HEAD + b"".join(_packet(1700000000 + i, i, p) for i, p in enumerate(payloads))
    assert [(p[1], p[5]) for p in pcap.packets_of(data)] == [((1700000000 + i) * 1_000_000 + i, p) for i, p in enumerate(payloads)]


def test_config():
    got = TrafficConfig.from_ini("[traffic]\nsession_expire_timeout = 60\nlocal_subnets = 10.0.0.0/8, 192.0.2.0/24\ningest_vlan_id = no")
    assert (got.session_expire_timeout, got.local_subnets, got.ingest_vlan_id, got.traffic_ttl) == (60, ("10.0.0.0/8", "192.0.2.0/24"), False, 30 * 86400)
    from flowloom.functions.net import subnet_range

    with pytest.raises(ValueError):
        subnet_range("300.0.0.0/8")
    from flowloom.functions.net import octet_rule

    assert octet_rule(" 10.1.2.3/16\t") == (10, 1, 0, 0) and octet_rule("10.0.2.3/24") == (10, 0, 2, 0)
    for bad in ("10.0.0.0", "10.0.0.0/12", "10.0.0.0/40", "255.0.0.0/8", "10.0.0/8", "x"):
        with pytest.raises(ValueError):
            octet_rule(bad)


def test_pcap_chunks_give_the_whole_file(tmp_path):
    import random
    import struct

    from flowloom.sources import pcap

    rng = random.Random(5)
    packets = [{"us": 1_704_067_200_000_000 + i * 250_000 + rng.randint(0, 99), "ip1": rng.getrandbits(32), "port1": rng.randint(1, 65535), "ip2": rng.getrandbits(32), "port2": 80, "vlan_id": rng.choice([0, 7]), "bytes": rng.randint(40, 1500), "flags": 16, "ip_proto": rng.choice([6, 17])} for i in range(400)]
    data = struct.pack("<IHHiIII", pcap.MAGIC, 2, 4, 0, 0, 65535, 1) + b"".join(map(pcap.pcap_record, packets))
    (tmp_path / "a.pcap").write_bytes(data)
    whole = [(str(tmp_path / "a.pcap"), *p) for p in pcap.packets_of(data)]
    assert len(whole) == 400 and all(w[-1] is None for w in whole)
    for chunk in (50, 333, 5_000, 1 << 20):
        reader = pcap.PcapReader({"path": f"file://{tmp_path}", "chunk": str(chunk)})
        assert [r for p in reader.partitions() for r in reader.read(p)] == whole


def _capture(n, pause=0.25, seed=5):
    rng = random.Random(seed)
    at, out = 1_704_067_200_000_000, []
    for _ in range(n):
        at += int(rng.choice([pause, pause, 7 * 86400]) * 1_000_000) + rng.randint(0, 99)
        out.append({"us": at, "ip1": rng.getrandbits(32), "port1": rng.randint(1, 65535), "ip2": rng.getrandbits(32), "port2": 80, "vlan_id": rng.choice([0, 7]), "bytes": rng.randint(40, 1500), "flags": 16, "ip_proto": rng.choice([6, 17])})
    return out


def test_pauses_lose_no_packet(tmp_path):
    """Weeks between packets, in whole files and in chunks, with and without junk among them."""
    packets = _capture(300)
    records = [pcap.pcap_record(p) for p in packets]
    rng = random.Random(6)
    for junk in (0, 9):
        marks = {20 + 30 * i for i in range(junk)}
        data = HEAD + b"".join(b"\xfe" * rng.randint(17, 40) * (i in marks) + r for i, r in enumerate(records))
        rows = list(pcap.packets_of(data))
        assert [r[1] for r in rows if r[-1] is None] == [p["us"] for p in packets] and sum(r[-1] is not None for r in rows) == junk
        (tmp_path / "a.pcap").write_bytes(data)
        for chunk in (50, 333, 5_000):
            reader = pcap.PcapReader({"path": f"file://{tmp_path}", "chunk": str(chunk)})
            got = [r for p in reader.partitions() for r in reader.read(p)]
            assert [r[2] for r in got if r[-1] is None] == [p["us"] for p in packets]


def test_zeros_are_no_packets():
    packets = _capture(40)
    records = [pcap.pcap_record(p) for p in packets]
    data = HEAD + b"".join(records[:20]) + bytes(500) + b"".join(records[20:])
    assert [r[1] for r in pcap.packets_of(data) if r[-1] is None] == [p["us"] for p in packets]


def test_offsets_stand_at_packets(tmp_path):
    """However a file grows, the stream reader's batches give each packet once, and so does a reader that begins anew from an offset."""
    packets = _capture(120)
    data = HEAD + b"".join(map(pcap.pcap_record, packets))
    rng, at, start, got = random.Random(3), 0, {"files": {}}, []
    while at < len(data):
        at = min(len(data), at + rng.choice([1, 10, 70, 900, 3000]))
        (tmp_path / "a.pcap").write_bytes(data[:at])
        reader = pcap.PcapStreamReader({"path": f"file://{tmp_path}", "chunk": "700"})
        end = reader.latestOffset()
        assert end == reader.latestOffset()
        got += [r for p in reader.partitions(start, end) for r in reader.read(p)]
        start = end if end["files"] else start
    assert [r[2] for r in got] == [p["us"] for p in packets] and all(r[-1] is None for r in got)


def test_tails_of_large_files(tmp_path, monkeypatch):
    monkeypatch.setattr(pcap, "TAIL", 2000)
    data = HEAD + b"".join(map(pcap.pcap_record, _capture(400)))
    ends = [r[0] for r in pcap.packets_of(data)] + [len(data)]
    for size in (5000, 5001, 5050, 12_345, len(data) - 3, len(data)):
        (tmp_path / "a.pcap").write_bytes(data[:size])
        assert pcap.whole_packets(f"file://{tmp_path}", str(tmp_path / "a.pcap"), size) == max(e for e in ends if e <= size)


def test_deep_headers(spark):
    """Tags of any depth, IPv6, fragments, tunnels, and packets cut anywhere."""
    from flowloom.sources.headers import deep_headers

    eth = bytes.fromhex("0200000000aa0200000000bb")
    tcp = struct.pack(">HHIIBB", 1234, 80, 4_000_000_000, 7, 0x50, 0x12) + bytes(6)
    v4 = lambda proto, body, frag=0, options=b"": struct.pack(">BBHHHBBHII", 0x45 + len(options) // 4, 0x2E, 20 + len(options) + len(body), 0, frag, 64, proto, 0, 0x0A000001, 0xC0000201) + options + body
    v6 = struct.pack(">IHBB", 6 << 28 | 0x2E << 20, len(tcp), 6, 64) + bytes(range(16)) + bytes(range(16, 32)) + tcp
    frames = {
        "plain": eth + b"\x08\x00" + v4(6, tcp, options=bytes(8)),
        "three": eth + struct.pack(">HHHHHH", 0x9100, 5, 0x88A8, 0xE006, 0x8100, 7) + b"\x08\x00" + v4(6, tcp),
        "six": eth + struct.pack(">HH", 0x8100, 9) + b"\x86\xdd" + v6,
        "fragment": eth + b"\x08\x00" + v4(6, tcp, frag=100),
        "icmp": eth + b"\x08\x00" + v4(1, b"\x03\x0d" + bytes(6)),
        "gre": eth + b"\x08\x00" + v4(47, struct.pack(">HHIII", 0xB000, 0x0800, 0, 1, 2) + v4(17, struct.pack(">HHHH", 53, 9999, 8, 0))),
        "ipip": eth + b"\x08\x00" + v4(4, v4(6, tcp)),
        "arp": eth + b"\x08\x06" + bytes(28),
    }
    cut = {f"cut{n}": frames["gre"][:n] for n in range(0, len(frames["gre"]), 3)}
    rows = [(name, b) for name, b in {**frames, **cut}.items()]
    df = spark.createDataFrame(rows, "file string, payload binary").withColumn("problem", F.lit(None).cast("string"))
    got = {r.file: r for r in deep_headers(df).collect()}
    assert len(got) == len(rows)
    pick = lambda name, *fields: tuple(got[name][f] for f in fields)
    assert pick("plain", "dmac", "smac", "eth_type", "vlan_id", "ip_version", "l3_proto", "ip_tos", "ip_src", "ip_dst", "l4_src_port", "l4_dst_port", "tcp_seq", "tcp_ack", "tcp_flags") == (0x0200000000AA, 0x0200000000BB, 0x0800, None, 4, 6, 0x2E, 0x0A000001, 0xC0000201, 1234, 80, 4_000_000_000, 7, 0x12)
    assert pick("three", "vlan_id", "qinq_vlan_id", "eth_type", "l4_dst_port") == (5, 6, 0x0800, 80)
    assert pick("six", "vlan_id", "ip_version", "ip_tos", "ip6_src", "ip6_dst", "ip_src", "l4_src_port", "tcp_seq") == (9, 6, 0x2E, bytes(range(16)).hex(), bytes(range(16, 32)).hex(), None, 1234, 4_000_000_000)
    assert pick("fragment", "l3_proto", "l4_src_port", "tcp_seq") == (6, None, None)
    assert pick("icmp", "icmp_type", "icmp_code", "l4_src_port") == (3, 13, None)
    assert pick("gre", "tunnel", "tunneled_proto", "tunneled_ip_src", "tunneled_src_port", "tunneled_dst_port", "l4_src_port") == ("gre", 17, 0x0A000001, 53, 9999, None)
    assert pick("ipip", "tunnel", "tunneled_proto", "tunneled_ip_dst", "tunneled_dst_port") == ("ipip", 6, 0xC0000201, 80)
    assert pick("arp", "eth_type", "ip_version", "l3_proto", "tunnel") == (0x0806, None, None, None)
    for name, b in cut.items():
        assert all(v is None or v == got["gre"][f] for f, v in got[name].asDict().items() if f != "file"), name
        assert (got[name].smac is not None) == (len(b) >= 12)


@pytest.mark.parametrize(("base", "query"), [(1000, "FN-29_readable_sizes"), (1024, "FN-29_readable_binary_sizes")])
def test_sizes_of_any_length(spark, tmp_path, base, query):
    """Keys as large as a large orders table has: TB is the last unit, and no digit is lost beyond 2^53."""
    import duckdb

    from flowloom.functions.net import human_size
    from flowloom.plans import registry

    keys = [0, 1, 5, 6, 164, 5198752, 5198753, 5516314, 5516315, 8999999, 15602450, 15602451, 40_000_000, 99_999_999]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    got = {tuple(r) for r in registry.queries()[query](spark, str(tmp_path)).collect()}
    assert got == set(con.execute(registry.oracle_sql()[query]).fetchall()) and len(got) == len(keys)
    edges = [n * base**4 + d for n in (base, 9_007, 80_007, 899_999, 8_000_003) for d in (-1, 0, 1, base**4 // 20 - 1, base**4 // 20, base**4 // 20 + 1)]
    found = spark.createDataFrame([(n,) for n in edges], "n long").select("n", human_size(F.col("n"), base).alias("s")).collect()
    tenths = {n: (20 * n + base**4) // (2 * base**4) for n in edges}
    assert {r.n: r.s for r in found} == {n: f"{t // 10}.{t % 10}TB" for n, t in tenths.items()}


@pytest.mark.parametrize(("parser", "cut"), [(text.parse_tcp, "regexp_replace(trim("), (text.parse_udp, "split(trim("), (text.parse_icmp, "split(trim("), (text.parse_other, "split(trim("), (text.parse_tcp_latency, "^(\\d+\\.\\d{6}) IP"), (text.parse_icmp_latency, "^(\\d+\\.\\d{6}) IP")])
def test_lines_are_cut_once(spark, parser, cut):
    """Conditions on parsed columns stay above the parser: below it, each would make and cut the line again."""
    lines = spark.range(3).select(F.concat_ws(" ", F.col("id").cast("string"), F.repeat(F.lit("x "), F.col("id").cast("int"))).alias("value"))
    rows = parser(lines)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(cut) == 1
    assert rows.collect() == []


@pytest.mark.parametrize("parser", [text.parse_tcp, text.parse_udp, text.parse_icmp, text.parse_other, text.parse_tcp_latency, text.parse_icmp_latency])
def test_parsers_are_compiled(spark, parser):
    """Nothing keeps Spark from compiling a parser, and no method, that which makes the lines neither, is so long that Java only interprets it."""
    from conftest import SMALL
    from flowloom.plans.scalars import icmp_lines
    from flowloom.sources.packets import read_packets

    rows = parser(icmp_lines(read_packets(spark, SMALL)))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    code = rows._jdf.queryExecution().explainString(mode)
    assert "lambda" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert code.startswith("Found 1 WholeStageCodegen") and "Generate inline" in code
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000


def test_white_space_of_lines(spark):
    """Single spaces are cut without a pattern, other white space as before."""
    line = "1700000200.422514 198.51.100.20 178 203.0.113.21 8 0 4660 (0x1234) 7"
    got = rows(spark, text.parse_icmp, line, f"  {line}  ", line.replace(" ", "  "), *(line.replace(" ", s, 3) for s in "\t\n\v\f\r"), "\t" + line, line.replace(" ", "\xa0"), "")
    assert len(got) == 8 and set(map(tuple, got)) == {(1700000200422514, 3325256724, 178, 3405803797, "8.0", 4660, 7)}
