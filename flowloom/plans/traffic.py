"""Queries for sessions, rollups, latency, streaming and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowloom.config import TrafficConfig
from flowloom.functions import net, times
from flowloom.operators import capture, groups, icmp, latency, maintenance, names, rollup, sessions
from flowloom.plans.registry import query
from flowloom.plans.scalars import stamp
from flowloom.plans.sql import GAP, KEY, KEYED, SESSIONS, with_packets
from flowloom.session import shared_folder
from flowloom.sources import headers, pcap, text
from flowloom.sources.packets import PACKET, read_packets
from flowloom.streaming import health, kept
from flowloom.streaming import traffic as streaming

CONFIG = TrafficConfig()


def _folder(spark) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


# --- sessions ---------------------------------------------------------------

_INFO = """SELECT CASE WHEN lo_client THEN lo_ip ELSE hi_ip END AS ip1, CASE WHEN lo_client THEN lo_port ELSE hi_port END AS p1, CASE WHEN lo_client THEN b_lo ELSE b_hi END AS b1, CASE WHEN lo_client THEN f_lo ELSE f_hi END AS f1,
  CASE WHEN lo_client THEN hi_ip ELSE lo_ip END AS ip2, CASE WHEN lo_client THEN hi_port ELSE lo_port END AS p2, CASE WHEN lo_client THEN b_hi ELSE b_lo END AS b2, CASE WHEN lo_client THEN f_hi ELSE f_lo END AS f2,
  b_lo + b_hi AS bt, tb // 60000000 * 60 AS tbm, te // 60000000 * 60 AS tem, tb, te, pk_lo + pk_hi AS pk, CASE WHEN lo_client THEN pk_lo ELSE pk_hi END AS pk1, CASE WHEN lo_client THEN pk_hi ELSE pk_lo END AS pk2,
  CASE WHEN vlan_id > 0 THEN vlan_id END AS vl, CASE WHEN (te - tb) // 1000000 >= 60 THEN (te - tb) // 1000000 END AS tdm, ip_proto
FROM (SELECT lo_ip, lo_port, hi_ip, hi_port, vlan_id, ip_proto, session, any_value(lo_client) AS lo_client, min(us) AS tb, max(us) AS te,
  CAST(sum(CASE WHEN from_lo THEN bytes ELSE 0 END) AS BIGINT) AS b_lo, CAST(sum(CASE WHEN from_lo THEN 0 ELSE bytes END) AS BIGINT) AS b_hi,
  CAST(sum(CASE WHEN from_lo THEN 1 ELSE 0 END) AS BIGINT) AS pk_lo, CAST(sum(CASE WHEN from_lo THEN 0 ELSE 1 END) AS BIGINT) AS pk_hi,
  coalesce(bit_or(CASE WHEN from_lo THEN packed END), 0) AS f_lo, coalesce(bit_or(CASE WHEN NOT from_lo THEN packed END), 0) AS f_hi
  FROM sided {where} GROUP BY ALL)"""


@query("AGG-1_tcp_session_info", SESSIONS + _INFO.format(where="WHERE ip_proto = 6"))
def tcp_info(spark, sf_dir):
    return sessions.session_info(read_packets(spark, sf_dir, 6), GAP, 60)


@query("AGG-2_udp_session_info", SESSIONS + _INFO.format(where="WHERE ip_proto = 17"))
def udp_info(spark, sf_dir):
    return sessions.session_info(read_packets(spark, sf_dir, 17), GAP, 60)


#: Seconds from which a session is long: some are.
_LONG = 15


@query("PROJ-17_long_sessions", SESSIONS + "SELECT ip1, p1, ip2, p2, tb, (te - tb) // 1000000 AS tdm FROM (" + _INFO.format(where="") + f") WHERE (te - tb) // 1000000 >= {_LONG}")
def long_sessions(spark, sf_dir):
    return sessions.session_info(read_packets(spark, sf_dir), GAP, _LONG).where("tdm is not null").select("ip1", "p1", "ip2", "p2", "tb", "tdm")


@query("WIN-3_sessions_by_gap", SESSIONS + f"SELECT {KEY}, tb, count(*) AS packets, CAST(sum(bytes) AS BIGINT) AS bytes FROM sided GROUP BY {KEY}, tb")
def by_gap(spark, sf_dir):
    return sessions.sessionized(read_packets(spark, sf_dir), GAP).groupBy(*sessions.KEY, "tb").agg(F.count("*").alias("packets"), F.sum("bytes").alias("bytes"))


@query("WIN-1_session_client", SESSIONS + "SELECT event_id, tb, from_client FROM conv")
def session_client(spark, sf_dir):
    return sessions.sessionized(read_packets(spark, sf_dir), GAP).select("event_id", "tb", "from_client")


_SECONDS = f"secs AS (SELECT {KEY}, sec, CAST(sum(CASE WHEN from_lo THEN bytes ELSE 0 END) AS BIGINT) AS b_lo, CAST(sum(CASE WHEN from_lo THEN 0 ELSE bytes END) AS BIGINT) AS b_hi, count(*) AS pk FROM keyed GROUP BY {KEY}, sec)"


@query("AGG-4_bytes_per_second", with_packets(KEYED, _SECONDS) + f"SELECT {KEY}, sec, b_lo, b_hi, pk FROM secs")
def seconds(spark, sf_dir):
    return sessions.per_second(read_packets(spark, sf_dir))


_DOCS = f"""chained AS (SELECT *, min(sec) OVER (PARTITION BY {KEY} ORDER BY sec RANGE BETWEEN 20 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt, row_number() OVER (PARTITION BY {KEY} ORDER BY sec) AS n FROM secs),
docs AS (SELECT {KEY}, sec AS sb, nxt FROM chained WHERE n = 1 UNION ALL SELECT c.lo_ip, c.lo_port, c.hi_ip, c.hi_port, c.vlan_id, c.ip_proto, c.sec, c.nxt FROM docs d JOIN chained c
  ON d.nxt = c.sec AND d.lo_ip = c.lo_ip AND d.lo_port = c.lo_port AND d.hi_ip = c.hi_ip AND d.hi_port = c.hi_port AND d.vlan_id = c.vlan_id AND d.ip_proto = c.ip_proto),
placed AS (SELECT s.*, d.sb FROM secs s JOIN docs d ON d.lo_ip = s.lo_ip AND d.lo_port = s.lo_port AND d.hi_ip = s.hi_ip AND d.hi_port = s.hi_port AND d.vlan_id = s.vlan_id AND d.ip_proto = s.ip_proto AND s.sec >= d.sb AND s.sec < d.sb + 20)"""
_DOC_ROWS = f"SELECT {KEY}, sb, max(sec) AS se, CAST(sum(b_lo) AS BIGINT) AS doc_lo, CAST(sum(b_hi) AS BIGINT) AS doc_hi, count(*) AS seconds FROM placed GROUP BY {KEY}, sb"


@query("AGG-5_byte_documents", with_packets(KEYED, _SECONDS, _DOCS, recursive=True) + _DOC_ROWS)
def documents(spark, sf_dir):
    return sessions.byte_documents(read_packets(spark, sf_dir)).select(*sessions.KEY, "sb", "se", "doc_lo", "doc_hi", F.size("b").cast("long").alias("seconds"))


@query("WIN-8_cumulative_documents", with_packets(KEYED, _SECONDS, _DOCS, recursive=True) + f"SELECT {KEY}, sb, CAST(sum(doc_lo) OVER (PARTITION BY {KEY} ORDER BY sb) AS BIGINT) AS b_lo, CAST(sum(doc_hi) OVER (PARTITION BY {KEY} ORDER BY sb) AS BIGINT) AS b_hi FROM ({_DOC_ROWS})")
def cumulative(spark, sf_dir):
    return sessions.byte_documents(read_packets(spark, sf_dir)).select(*sessions.KEY, "sb", "b_lo", "b_hi")


@query("WIN-4_document_seconds", with_packets(KEYED, _SECONDS, _DOCS, recursive=True) + f"SELECT {KEY}, sb, CAST(sec - sb AS INT) AS off, b_lo, b_hi FROM placed")
def document_seconds(spark, sf_dir):
    return sessions.byte_documents(read_packets(spark, sf_dir)).select(*sessions.KEY, "sb", F.inline("b")).withColumnRenamed("offset", "off")


@query(
    "AGG-21_flag_sets",
    with_packets(KEYED) + f"SELECT {KEY}, from_lo, string_agg(CAST(flags AS VARCHAR), ',' ORDER BY us, event_id) AS flag_list FROM (SELECT *, row_number() OVER (PARTITION BY {KEY}, from_lo, flags ORDER BY us, event_id) AS n FROM keyed WHERE ip_proto = 6) WHERE n = 1 GROUP BY {KEY}, from_lo",
)
def flag_sets(spark, sf_dir):
    return sessions.flag_sets(read_packets(spark, sf_dir, 6))


# --- rollups ----------------------------------------------------------------

_GROUP_SQL = "c_ip AS ip1, s_ip AS ip2, s_port AS p2, vlan_id AS vl, ip_proto"


def _bins_sql(window: int, where: str = "") -> str:
    return f"SELECT {_GROUP_SQL}, sec // {window} * {window} AS tbm, CAST((sec % {window}) // {window // 90} * {window // 90} AS INT) AS off, CAST(sum(b1) AS BIGINT) AS b1, CAST(sum(b2) AS BIGINT) AS b2, count(*) AS pk FROM traffic {where} GROUP BY ALL"


@query("AGG-10_session_bins", SESSIONS + _bins_sql(900))
def short_bins(spark, sf_dir):
    return groups.bins(groups.conversation_bytes(read_packets(spark, sf_dir), GAP), groups.SHORT)


@query("AGG-11_session_bins_long", SESSIONS + _bins_sql(10800))
def long_bins(spark, sf_dir):
    """From the short bins, which align with the long ones."""
    return groups.coarser(groups.bins(groups.conversation_bytes(read_packets(spark, sf_dir), GAP), groups.SHORT))


@query("AGG-12_udp_session_bins", SESSIONS + _bins_sql(900, "WHERE ip_proto = 17"))
def udp_bins(spark, sf_dir):
    return groups.bins(groups.conversation_bytes(read_packets(spark, sf_dir, 17), GAP), groups.SHORT)


@query(
    "AGG-13_session_and_capture_bins",
    SESSIONS + f"""SELECT ip1, ip2, p2, vl, ip_proto, tbm, off, b1, b2, false AS capture FROM ({_bins_sql(900)})
UNION ALL SELECT NULL, NULL, NULL, NULL, ip_proto, tbm, off, CAST(sum(b1) AS BIGINT), CAST(sum(b2) AS BIGINT), true FROM ({_bins_sql(900)}) GROUP BY ip_proto, tbm, off""",
)
def all_bins(spark, sf_dir):
    return groups.session_and_capture_bins(groups.conversation_bytes(read_packets(spark, sf_dir), GAP), groups.SHORT)


@query("AGG-14_bins_from_documents", with_packets(KEYED) + f"SELECT {KEY}, sec // 900 * 900 AS tbm, CAST((sec % 900) // 10 * 10 AS INT) AS off, CAST(sum(CASE WHEN from_lo THEN bytes ELSE 0 END) AS BIGINT) AS b1, CAST(sum(CASE WHEN from_lo THEN 0 ELSE bytes END) AS BIGINT) AS b2 FROM keyed GROUP BY ALL")
def document_bins(spark, sf_dir):
    return groups.from_documents(sessions.byte_documents(read_packets(spark, sf_dir)), groups.SHORT)


@query("AGG-15_group_totals", SESSIONS + f"SELECT {_GROUP_SQL}, sec // 900 * 900 AS tbm, CAST(sum(b1) AS BIGINT) AS b1, CAST(sum(b2) AS BIGINT) AS b2, max(sec) // 60 * 60 AS tem, count(DISTINCT (sec % 900) // 10) AS bins FROM traffic GROUP BY ALL")
def group_totals(spark, sf_dir):
    return groups.groups(groups.conversation_bytes(read_packets(spark, sf_dir), GAP), groups.SHORT).select(*groups.GROUP, "tbm", "b1", "b2", "tem", F.size("b").cast("long").alias("bins"))


_SEEN = f"""seen AS (SELECT DISTINCT {KEY}, c_ip, s_ip, s_port, sec // 900 * 900 AS tbm FROM traffic),
slots AS (SELECT *, tbm - 900 = lag(tbm) OVER (PARTITION BY {KEY} ORDER BY tbm) AS existing FROM (SELECT DISTINCT {KEY}, tbm FROM seen))"""


@query(
    "AGG-16_started_and_existing",
    SESSIONS.rstrip() + ",\n" + _SEEN + f""" SELECT c_ip AS ip1, s_ip AS ip2, s_port AS p2, vlan_id AS vl, ip_proto, tbm, count(*) FILTER (WHERE existing IS NOT TRUE) AS ns, count(*) FILTER (WHERE existing) AS ne
FROM seen JOIN slots USING ({KEY}, tbm) GROUP BY c_ip, s_ip, s_port, vlan_id, ip_proto, tbm""",
)
def started(spark, sf_dir):
    return groups.sessions_in_groups(groups.conversation_bytes(read_packets(spark, sf_dir), GAP), groups.SHORT)


@query("AGG-27_distinct_sessions", SESSIONS.rstrip() + ",\n" + _SEEN + " SELECT c_ip AS ip1, s_ip AS ip2, s_port AS p2, vlan_id AS vl, ip_proto, tbm, count(*) AS sessions FROM seen GROUP BY ALL")
def distinct_sessions(spark, sf_dir):
    rows = groups.conversation_bytes(read_packets(spark, sf_dir), GAP)
    tbm = F.col("sec") - F.col("sec") % groups.SHORT
    return rows.groupBy(*groups.GROUP, tbm.alias("tbm")).agg(F.count_distinct(F.struct(*[F.col(f"k_{k}") for k in sessions.KEY])).alias("sessions"))


@query("AGG-7_capture_bytes", with_packets() + "SELECT ip_proto, sec // 10 * 10 AS sb, max(sec) AS se, CAST(sum(bytes) AS BIGINT) AS b, count(*) AS pk, count(DISTINCT sec) AS active FROM packets GROUP BY ALL")
def capture_bytes(spark, sf_dir):
    return capture.capture_bytes(read_packets(spark, sf_dir))


@query("AGG-7_capture_documents", with_packets() + """SELECT ip_proto, sb, max(sec) AS se, CAST(sum(b) AS BIGINT) AS total, CAST(sum(pk) AS BIGINT) AS pk, string_agg((sec - sb) || ':' || b, ',' ORDER BY sec) AS seconds
FROM (SELECT ip_proto, sec, sec // 10 * 10 AS sb, CAST(sum(bytes) AS BIGINT) AS b, count(*) AS pk FROM packets GROUP BY ALL) GROUP BY ip_proto, sb""")
def capture_documents(spark, sf_dir):
    """Documents of ten seconds with what each active second has."""
    docs = capture.capture_documents(read_packets(spark, sf_dir))
    return docs.select("ip_proto", "sb", "se", "total", "pk", F.array_join(F.transform("b", lambda x: F.concat_ws(":", x["offset"], x["b"])), ",").alias("seconds"))


@query("AGG-8_capture_info", with_packets() + "SELECT ip_proto, min(us) AS tb, max(us) AS te, CAST(sum(bytes) AS BIGINT) AS bt, count(*) AS pk FROM packets GROUP BY ip_proto")
def capture_info(spark, sf_dir):
    return capture.capture_info(read_packets(spark, sf_dir))


@query("AGG-9_direction_bytes", with_packets() + "SELECT ip_proto, sec, CAST(sum(CASE WHEN ip1 >= 167772160 THEN 0 ELSE bytes END) AS BIGINT) AS b_in, CAST(sum(CASE WHEN ip1 >= 167772160 THEN bytes ELSE 0 END) AS BIGINT) AS b_out FROM packets GROUP BY ip_proto, sec")
def direction_bytes(spark, sf_dir):
    return capture.direction_bytes(read_packets(spark, sf_dir), CONFIG.local_subnets)


_PLAIN = SESSIONS.rstrip() + """,
plain AS (SELECT * REPLACE (CASE WHEN ip_proto = 6 THEN true ELSE first_value(from_lo) OVER (PARTITION BY """ + KEY + """, session ORDER BY us, event_id) END AS lo_client) FROM sided)
"""


@query("AGG-3_plain_session_info", _PLAIN + _INFO.format(where="").replace("FROM sided", "FROM plain"))
def plain_info(spark, sf_dir):
    return sessions.plain_session_info(read_packets(spark, sf_dir), GAP, 60)


@query("PROJ-18_stored_sessions", SESSIONS + "SELECT ip1, p1, ip2, p2, tb, CASE WHEN p1 % 2 = 0 THEN 0 ELSE pk1 END AS pk1, CASE WHEN p1 % 2 = 0 THEN 0 ELSE pk2 END AS pk2 FROM (" + _INFO.format(where="") + ")")
def stored_sessions(spark, sf_dir):
    """Documents of some sessions are from before packets were counted by side."""
    info = sessions.session_info(read_packets(spark, sf_dir), GAP, 60)
    older = F.col("p1") % 2 == 0
    stored = info.withColumns({c: F.when(~older, F.col(c)) for c in ("pk1", "pk2")})
    return sessions.read_back(stored).select("ip1", "p1", "ip2", "p2", "tb", "pk1", "pk2")


_ICMP_LINES = """icmp AS (SELECT event_id, us, ip1, ip2, bytes, vlan_id, least(ip1, ip2) AS lo_ip, greatest(ip1, ip2) AS hi_ip, ip1 <= ip2 AS from_lo,
  CASE event_id % 3 WHEN 0 THEN '0.0' WHEN 1 THEN '8.0' ELSE '3.13' END AS own, CASE WHEN event_id % 3 < 2 THEN (us // 600000000) % 50 END AS seq FROM packets),
asked AS (SELECT *, lag(us) OVER w AS before, lag(own) OVER w AS earlier, lag(from_lo) OVER w AS way FROM icmp WINDOW w AS (PARTITION BY lo_ip, hi_ip, seq ORDER BY us, event_id)),
adopted AS (SELECT * EXCLUDE (before, earlier, way), CASE WHEN seq IS NOT NULL AND own <> '8.0' AND earlier = '8.0' AND way <> from_lo AND us - before <= 120000000 THEN earlier ELSE own END AS typecode FROM asked)"""


def _icmp(spark, sf_dir):
    """Packets written as ICMP lines and read back: echo requests, replies (with the sequence number of a time) and notices."""
    from flowloom.plans.scalars import icmp_lines

    lines = icmp_lines(read_packets(spark, sf_dir), "cast((us div 600000000) % 50 as string)")
    # kept, since replies are looked for in two readings of the packets, and lines cost the most
    folder = _folder(spark)
    text.parse_icmp(lines).write.parquet(folder)
    return icmp.adopted(spark.read.parquet(folder))


@query("JOIN-8_adopted_types", with_packets(_ICMP_LINES) + "SELECT event_id, own, typecode FROM adopted")
def adopted_types(spark, sf_dir):
    return _icmp(spark, sf_dir).select("event_id", "own", "typecode")


@query("AGG-22_icmp_type_sets", with_packets(_ICMP_LINES) + """SELECT lo_ip, hi_ip, typecode, vlan_id, from_lo, string_agg(own, ',' ORDER BY us, event_id) AS types
FROM (SELECT *, row_number() OVER (PARTITION BY lo_ip, hi_ip, typecode, vlan_id, from_lo, own ORDER BY us, event_id) AS n FROM adopted) WHERE n = 1 GROUP BY ALL""")
def type_sets(spark, sf_dir):
    return icmp.type_sets(_icmp(spark, sf_dir))


_ICMP_GROUPS = with_packets(_ICMP_LINES) + f"""SELECT CASE WHEN client THEN lo_ip ELSE hi_ip END AS ip1, typecode AS ty1, CASE WHEN client THEN hi_ip ELSE lo_ip END AS ip2, vlan_id AS vl, us // 1000000 // 900 * 900 AS tbm, CAST((us // 1000000 % 900) // 10 * 10 AS INT) AS off,
  CAST(sum(CASE WHEN from_lo = client THEN bytes ELSE 0 END) AS BIGINT) AS b1, CAST(sum(CASE WHEN from_lo = client THEN 0 ELSE bytes END) AS BIGINT) AS b2, count(*) AS pk
FROM (SELECT *, first_value(from_lo) OVER (PARTITION BY lo_ip, hi_ip, typecode, vlan_id, session ORDER BY us, event_id) AS client
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY lo_ip, hi_ip, typecode, vlan_id ORDER BY us, event_id) AS session
    FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY lo_ip, hi_ip, typecode, vlan_id ORDER BY us, event_id) > {GAP * 1000000} THEN 1 ELSE 0 END AS fresh FROM adopted))) GROUP BY ALL"""


@query("AGG-17_icmp_groups", _ICMP_GROUPS)
def real_icmp_groups(spark, sf_dir):
    return groups.bins(icmp.icmp_seconds(_icmp(spark, sf_dir), GAP), groups.SHORT, icmp.GROUP)


_OTHER_GROUPS = with_packets() + "SELECT '00:09:0f:50:aa:fc' AS s, 'ff:ff:ff:ff:ff:ff' AS d, CASE WHEN event_id % 50 = 0 THEN repeat('x', 512) || '...' ELSE 'Who has ' || event_id END AS m, vlan_id AS vl, sec // 900 * 900 AS tbm, CAST((sec % 900) // 10 * 10 AS INT) AS off, CAST(sum(bytes) AS BIGINT) AS b1, CAST(0 AS BIGINT) AS b2, count(*) AS pk FROM packets WHERE event_id % 7 <> 0 GROUP BY ALL"


@query("AGG-17_other_groups", _OTHER_GROUPS)
def other_groups(spark, sf_dir):
    from flowloom.plans.scalars import other_lines

    return groups.bins(icmp.other_seconds(text.parse_other(other_lines(read_packets(spark, sf_dir)))), groups.SHORT, icmp.OTHER)


@query(
    "AGG-17_icmp_and_other_groups",
    f"SELECT 'icmp' AS kind, CAST(ip1 AS VARCHAR) AS s, ty1 AS m, CAST(ip2 AS VARCHAR) AS d, vl, tbm, off, b1, b2, pk FROM ({_ICMP_GROUPS}) UNION ALL SELECT 'other', s, m, d, vl, tbm, off, b1, b2, pk FROM ({_OTHER_GROUPS})",
)
def icmp_and_other_groups(spark, sf_dir):
    """Groups of ICMP by type and code, and of what is not IP by message."""
    one = real_icmp_groups(spark, sf_dir).select(F.lit("icmp").alias("kind"), F.col("ip1").cast("string").alias("s"), F.col("ty1").alias("m"), F.col("ip2").cast("string").alias("d"), "vl", "tbm", "off", "b1", "b2", "pk")
    return one.unionByName(other_groups(spark, sf_dir).withColumn("kind", F.lit("other")))


@query("JOIN-6_targets_by_port", with_packets() + """SELECT event_id, CASE WHEN s IS NOT NULL THEN s ELSE r END AS c_id, s IS NOT NULL AS reply FROM (SELECT event_id,
  CASE WHEN ip1 = 134744072 AND ip_proto = 6 AND port1 = 80 THEN 'web' WHEN ip1 = 134744073 AND ip_proto = 17 THEN 'udp' WHEN ip1 IN (134744072, 134744075) THEN 'any' END AS s,
  CASE WHEN ip2 = 134744072 AND ip_proto = 6 AND port2 = 80 THEN 'web' WHEN ip2 = 134744073 AND ip_proto = 17 THEN 'udp' WHEN ip2 IN (134744072, 134744075) THEN 'any' END AS r FROM packets) WHERE s IS NOT NULL OR r IS NOT NULL""")
def targets_by_port(spark, sf_dir):
    """One address has a target of one port and protocol after one of any; another has one of a protocol."""
    rows = [("any", 134744072, 134744075, None, None, 1), ("web", 134744072, None, 6, 80, 2), ("udp", 134744073, None, 17, None, 3)]
    targets = spark.createDataFrame(rows, "c_id string, ip long, prev_ip long, ip_proto int, port int, ord int")
    return latency.to_targets(read_packets(spark, sf_dir), targets).select("event_id", "c_id", "reply")


# --- latency ----------------------------------------------------------------

_WAIT = 60
_MATCHED = f"""probes AS (SELECT CASE WHEN port1 < port2 THEN ip1 ELSE ip2 END AS c_id, CASE WHEN port1 < port2 THEN ip2 ELSE ip1 END AS ip1, CASE WHEN port1 < port2 THEN ip1 ELSE ip2 END AS ip2, least(port1, port2) AS port, us, event_id, port1 < port2 AS reply FROM packets),
followed AS (SELECT *, lead(reply) OVER w AS r, lead(us) OVER w AS u FROM probes WINDOW w AS (PARTITION BY c_id, ip1, ip2, port ORDER BY us, event_id)),
requests AS (SELECT * FROM (SELECT c_id, ip1, ip2, port, us, event_id, us // 1000000 AS sec, CASE WHEN r AND u - us <= {_WAIT * 1000000} THEN u - us END AS rtt FROM followed WHERE NOT reply) WHERE rtt IS NULL OR rtt > 0)"""


def _requests(spark, sf_dir):
    return latency.matched(latency.probes(read_packets(spark, sf_dir)), _WAIT)


@query("JOIN-7_round_trips", with_packets(_MATCHED) + "SELECT c_id, ip1, ip2, port, us, event_id, rtt FROM requests")
def round_trips(spark, sf_dir):
    return _requests(spark, sf_dir)


_PROBED = """sent AS (SELECT ip1, ip2, 1024 + event_id % 60000 AS client_port, us, 0 AS reply FROM packets UNION ALL SELECT ip1, ip2, 1024 + event_id % 60000, us + event_id % 5 * 2000000, 1 FROM packets WHERE event_id % 3 < 2),
answered AS (SELECT *, lead(reply) OVER w AS r, lead(us) OVER w AS u FROM sent WINDOW w AS (PARTITION BY ip1, ip2, client_port ORDER BY us, reply))"""


@query("PROJ-8_application_probes", with_packets(_PROBED) + "SELECT * FROM (SELECT ip1, ip2, client_port, us, CASE WHEN r = 1 AND u - us <= 5000000 THEN u - us END AS rtt FROM answered WHERE reply = 0) WHERE rtt IS NULL OR rtt > 0")
def application_probes(spark, sf_dir):
    """Lines of SYN and FIN-ACK: a probe is over when the server closes, which the client's port tells."""
    p = read_packets(spark, sf_dir).withColumn("client_port", F.expr("1024 + event_id % 60000"))
    ends = [F.concat(net.long_to_ip(F.col(ip)), F.lit("."), F.expr(port)) for ip, port in (("ip1", "client_port"), ("ip2", "443"))]
    line = lambda us, a, b, flags: F.concat(stamp(us), F.lit(" IP "), a, F.lit(" > "), b, F.lit(f": Flags {flags}")).alias("value")
    sent = p.select(line("us", *ends, "[S], seq 17, win 14600"))
    closed = p.where("event_id % 3 < 2").withColumn("us", F.expr("us + event_id % 5 * 2000000")).select(line("us", *ends[::-1], "[F.], seq 4, ack 9, win 5792"))
    rows = text.parse_tcp_latency(sent.union(closed)).withColumn("event_id", F.col("reply").cast("int"))
    pick = lambda a, b: F.when(F.col("reply"), F.col(a)).otherwise(F.col(b))
    rows = rows.select(pick("ip2", "ip1").alias("ip1"), pick("ip1", "ip2").alias("ip2"), "client_port", "us", "event_id", "reply")
    return latency.matched(rows, 5, ["ip1", "ip2", "client_port"]).select("ip1", "ip2", "client_port", "us", "rtt")


@query("WIN-6_last_request", with_packets(_MATCHED) + "SELECT c_id, count(*) AS requests, count(rtt) AS answered FROM requests GROUP BY c_id")
def last_request(spark, sf_dir):
    return _requests(spark, sf_dir).groupBy("c_id").agg(F.count("*").alias("requests"), F.count("rtt").alias("answered"))


@query("AGG-18_session_latency", with_packets(_MATCHED) + "SELECT c_id, ip1, ip2, port, min(us) AS tb, max(us) AS te, count(*) AS req, count(rtt) AS rply, round(min(rtt) / 1000.0, 3) AS lmin, round(max(rtt) / 1000.0, 3) AS lmax FROM requests GROUP BY c_id, ip1, ip2, port")
def session_latency(spark, sf_dir):
    return latency.session_latency(_requests(spark, sf_dir))


_BY_SECOND = """ranked AS (SELECT *, row_number() OVER (PARTITION BY c_id, ip1, ip2, port, sec ORDER BY us DESC, event_id DESC) AS n FROM requests),
slots AS (SELECT c_id, ip1, ip2, port, sec // 60 * 60 AS sbm, sec, round(max(CASE WHEN n = 1 THEN rtt END) / 1000.0, 3) AS rtl, max(CASE WHEN n = 1 THEN CASE WHEN rtt IS NULL THEN 1 ELSE 0 END END) AS lost, count(*) AS req, count(rtt) AS answered, min(rtt) AS least, max(rtt) AS most FROM ranked GROUP BY c_id, ip1, ip2, port, sec)"""


@query("AGG-19_latency_by_second", with_packets(_MATCHED, _BY_SECOND) + "SELECT c_id, ip1, ip2, port, sbm, CAST(sec - min(sec) OVER (PARTITION BY c_id, ip1, ip2, port, sbm) AS INT) AS off, rtl, lost, req AS n, answered FROM slots")
def latency_by_second(spark, sf_dir):
    return latency.by_second(_requests(spark, sf_dir)).select(*latency.KEY, "sbm", "off", "rtl", "lost", "n", "answered")


@query("SNK-2_latency_minutes", with_packets(_MATCHED, _BY_SECOND) + "SELECT c_id, ip1, ip2, port, sbm, min(sec) AS sb, max(sec) AS se, count(*) AS slots, CAST(sum(lost) AS BIGINT) AS lost, CAST(sum(req) AS BIGINT) AS req, CAST(sum(answered) AS BIGINT) AS rply, round(min(least) / 1000.0, 3) AS lmin, round(max(most) / 1000.0, 3) AS lmax FROM slots GROUP BY c_id, ip1, ip2, port, sbm")
def latency_minutes(spark, sf_dir):
    docs = latency.minute_documents(latency.by_second(_requests(spark, sf_dir)))
    lost = F.aggregate("pl", F.lit(0).cast("long"), lambda a, x: a + x["lost"].cast("long"))
    return docs.select(*latency.KEY, "sbm", "sb", "se", F.size("rtl").cast("long").alias("slots"), lost.alias("lost"), "req", "rply", "lmin", "lmax")


@query(
    "AGG-20_latency_rollup",
    with_packets(_MATCHED, _BY_SECOND) + """SELECT c_id, tbm, off, rtl, round(CASE WHEN sampled > lost THEN lost / (sampled - lost) ELSE lost END, 6) AS pl, round(lost / sampled, 6) AS loss_ratio, req, rply, lmin, lmax
FROM (SELECT c_id, sec // 900 * 900 AS tbm, CAST((sec % 900) // 10 * 10 AS INT) AS off, round(avg(rtl), 3) AS rtl, CAST(sum(lost) AS DOUBLE) AS lost, count(*) AS sampled, CAST(sum(req) AS BIGINT) AS req, CAST(sum(answered) AS BIGINT) AS rply, round(min(least) / 1000.0, 3) AS lmin, round(max(most) / 1000.0, 3) AS lmax FROM slots GROUP BY ALL)""",
)
def latency_rollup(spark, sf_dir):
    return latency.rollup(latency.by_second(_requests(spark, sf_dir)), 900)


@query("JOIN-6_packets_to_targets", with_packets() + """SELECT event_id, CASE WHEN ip1 = 134744072 OR ip2 = 134744072 THEN 'z' ELSE 'b' END AS c_id, ip1 IN (134744072, 134744073, 134744074) AS reply
FROM packets WHERE ip1 IN (134744072, 134744073, 134744074) OR ip2 IN (134744072, 134744073, 134744074)""")
def to_targets(spark, sf_dir):
    """Two targets share an address, of which the last counts; one is met by the address it had."""
    targets = spark.createDataFrame([("a", 134744072, None, 1), ("b", 134744073, 134744074, 2), ("z", 134744072, None, 3)], "c_id string, ip long, prev_ip long, ord int")
    return latency.to_targets(read_packets(spark, sf_dir), targets).select("event_id", "c_id", "reply")


# --- names ------------------------------------------------------------------

_TELL = "tell AS (SELECT ip1 AS k, us FROM packets)"


_THROTTLED = with_packets(_TELL, "nxt AS (SELECT k, us, (SELECT min(y.us) FROM tell y WHERE y.k = x.k AND y.us > x.us + 600000000) AS n FROM (SELECT DISTINCT k, us FROM tell) x)", "kept AS (SELECT k, us, n FROM nxt WHERE (k, us) IN (SELECT (k, min(us)) FROM tell GROUP BY k) UNION ALL SELECT x.k, x.us, x.n FROM kept d JOIN nxt x ON x.k = d.k AND x.us = d.n)", recursive=True)


@query("WIN-5_throttled_names", _THROTTLED + "SELECT k, us FROM kept")
def throttled(spark, sf_dir):
    rows = read_packets(spark, sf_dir).select(F.col("ip1").alias("k"), "us")
    return names.throttled(rows, ["k"], 600)


# --- sort, sets, reports ----------------------------------------------------


@query("SORT-1_first_and_last", with_packets() + "SELECT min(us) AS first_us, max(us) AS last_us, (SELECT event_id FROM packets ORDER BY us DESC, event_id DESC LIMIT 1) AS last_event FROM packets")
def first_and_last(spark, sf_dir):
    return read_packets(spark, sf_dir).agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.max_by("event_id", F.struct("us", "event_id")).alias("last_event"))


_STATS = """stats AS (SELECT 'orders' AS name, count(*) AS n, CAST(epoch(min(o_orderdate)) AS BIGINT) AS first, CAST(epoch(max(o_orderdate)) AS BIGINT) AS last FROM orders
UNION ALL SELECT 'lineitem', count(*), CAST(epoch(min(l_shipdate)) AS BIGINT), CAST(epoch(max(l_shipdate)) AS BIGINT) FROM lineitem
UNION ALL SELECT 'events', count(*), CAST(floor(epoch(min(ts))) AS BIGINT), CAST(floor(epoch(max(ts))) AS BIGINT) FROM events)"""


def _stats(spark, sf_dir):
    seconds = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000)
    read = lambda t, c: (spark.read.parquet(f"{sf_dir}/{t}.parquet").select(c), seconds(c), seconds(c))
    return maintenance.dataset_stats({"orders": read("orders", "o_orderdate"), "lineitem": read("lineitem", "l_shipdate"), "events": read("events", "ts")})


@query("AGG-24_dataset_stats", f"WITH {_STATS} SELECT name, n, first, last, (last - first) // 86400 AS days FROM stats")
def stats(spark, sf_dir):
    return _stats(spark, sf_dir)


@query("SORT-4_report", f"WITH {_STATS} SELECT name, n, first, last, (last - first) // 86400 AS days, round(100.0 * n / sum(n) OVER (), 2) AS pct FROM stats ORDER BY n DESC, name")
def report(spark, sf_dir):
    return maintenance.report(_stats(spark, sf_dir))


@query("AGG-25_report_footer", f"WITH {_STATS} SELECT count(*) AS datasets, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n) * 100 AS BIGINT) AS bytes, CAST(100 AS DOUBLE) AS mean_size FROM stats")
def footer(spark, sf_dir):
    return maintenance.footer(_stats(spark, sf_dir), F.col("n") * 100).drop("readable")


_NOW = 1704067200 + 6 * 3600


@query("SNK-8_unexpired_sessions", SESSIONS + f"SELECT ip1, p1, ip2, p2, tb, tem FROM ({_INFO.format(where='')}) WHERE tem >= {_NOW - 7200}")
def unexpired(spark, sf_dir):
    info = sessions.session_info(read_packets(spark, sf_dir), GAP, 60)
    return maintenance.unexpired(info, F.col("tem"), _NOW, 7200).select("ip1", "p1", "ip2", "p2", "tb", "tem")


@query("SNK-9_expiry_dry_run", SESSIONS + f"SELECT count(*) AS expirable FROM ({_INFO.format(where='')}) WHERE tem < {_NOW - 7200}")
def dry_run(spark, sf_dir):
    info = sessions.session_info(read_packets(spark, sf_dir), GAP, 60)
    return maintenance.expired(info, F.col("tem"), _NOW, 7200).agg(F.count("*").alias("expirable"))


@query("AGG-23_distinct_targets", with_packets(_MATCHED) + "SELECT DISTINCT c_id FROM probes")
def distinct_targets(spark, sf_dir):
    return latency.probes(read_packets(spark, sf_dir)).select("c_id").distinct()


@query("WIN-7_rates", with_packets() + ", running AS (SELECT ip_proto AS source, sec, sum(count(*)) OVER (PARTITION BY ip_proto ORDER BY sec) AS total FROM packets GROUP BY ip_proto, sec) SELECT source, sec, CAST(total AS BIGINT) AS total, CAST(total - lag(total) OVER (PARTITION BY source ORDER BY sec) AS BIGINT) AS rate FROM running")
def rates(spark, sf_dir):
    per_second = read_packets(spark, sf_dir).groupBy(F.col("ip_proto").alias("source"), "sec").agg(F.count("*").alias("n"))
    running = per_second.select("source", "sec", F.sum("n").over(Window.partitionBy("source").orderBy("sec")).alias("total"))
    return maintenance.rates(running, "sec", "total")


@query("SET-1_all_protocols", with_packets() + "SELECT 'tcp' AS kind, event_id, flags FROM packets WHERE ip_proto = 6 UNION ALL SELECT 'udp', event_id, NULL FROM packets WHERE ip_proto = 17")
def all_protocols(spark, sf_dir):
    tcp = read_packets(spark, sf_dir, 6).select(F.lit("tcp").alias("kind"), "event_id", "flags")
    return tcp.unionByName(read_packets(spark, sf_dir, 17).select(F.lit("udp").alias("kind"), "event_id"), allowMissingColumns=True)


@query("JOIN-12_seen_before", with_packets(KEYED) + f"SELECT DISTINCT {KEY} FROM keyed k WHERE sec >= 1704078000 AND EXISTS (SELECT 1 FROM keyed b WHERE b.sec < 1704078000 AND b.sec >= 1704078000 - 900 AND b.lo_ip = k.lo_ip AND b.lo_port = k.lo_port AND b.hi_ip = k.hi_ip AND b.hi_port = k.hi_port AND b.vlan_id = k.vlan_id AND b.ip_proto = k.ip_proto)")
def seen_before(spark, sf_dir):
    keyed = sessions.with_session_key(read_packets(spark, sf_dir))
    history = keyed.where("sec < 1704078000 and sec >= 1704078000 - 900").select(*sessions.KEY).distinct()
    return keyed.where("sec >= 1704078000").select(*sessions.KEY).distinct().join(history, sessions.KEY, "left_semi")


# --- writes and streams -----------------------------------------------------


@query("FLT-11_typed_documents", with_packets(KEYED, _SECONDS, _DOCS, recursive=True) + f"SELECT {KEY}, sb // 900 * 900 AS tbm, CAST(sum(doc_lo + doc_hi) AS BIGINT) AS bt FROM ({_DOC_ROWS}) WHERE sb % 9 <> 0 GROUP BY ALL")
def typed_documents(spark, sf_dir):
    """Documents of the old form, which carry a type, are not rolled up."""
    old = sessions.byte_documents(read_packets(spark, sf_dir)).withColumn("ty", F.when(F.col("sb") % 9 == 0, "8.0"))
    return groups.untyped(old).groupBy(*sessions.KEY, times.floor_to(F.col("sb"), 900).alias("tbm")).agg(F.sum(F.col("doc_lo") + F.col("doc_hi")).alias("bt"))


@query("SNK-7_replayed_windows", SESSIONS + _bins_sql(900))
def replayed(spark, sf_dir):
    """Bins written, and the later half written again from a window boundary; each window is there once."""
    path = f"{_folder(spark)}/bins"
    bins = groups.bins(groups.conversation_bytes(read_packets(spark, sf_dir), GAP), groups.SHORT)
    maintenance.replace_windows(bins, path)
    maintenance.replace_windows(bins.where("tbm >= 1704078000"), path)
    return spark.read.schema(bins.schema).parquet(path)


@query("SNK-11_sessions_by_day", SESSIONS + f"SELECT ip1, p1, ip2, p2, tb, tem, bt FROM ({_INFO.format(where='')}) WHERE ip_proto = 6 AND tem // 86400 = 19723 AND ip1 BETWEEN 167772160 AND 167772163")
def sessions_by_day(spark, sf_dir):
    """Sessions stored by day and protocol in order of addresses, and those of one day, protocol and range of addresses read back."""
    path = f"{_folder(spark)}/sessions"
    maintenance.store_by_day(sessions.session_info(read_packets(spark, sf_dir), GAP, 60), path, "tem", "ip_proto", ["ip1", "p1", "ip2", "p2"])
    return spark.read.parquet(path).where("day = 19723 and ip_proto = 6 and ip1 between 167772160 and 167772163").select("ip1", "p1", "ip2", "p2", "tb", "tem", "bt")


#: Files that land one after another, seconds by which every 7th packet comes late, and how long streams wait.
_FILES, _LATE, _PATIENCE = 5, 600, "660 seconds"
#: Packets of a key of its own, which come last, a day after all others: the watermark passes every packet.
_END = 2886729728


def _landed(spark, sf_dir, ending=True):
    """Packets in files by time of arrival, as a stream: as many files a batch as tasks read the table, all of a batch written together."""
    folder, packets = _folder(spark), read_packets(spark, sf_dir)
    path, staged, files = f"{folder}/packets", f"{folder}/staged", max(2, packets.rdd.getNumPartitions())
    arrival = F.col("us") + F.when(F.col("event_id") % 7 == 0, _LATE * 1_000_000).otherwise(0)
    first, last = packets.agg(F.min("us"), F.max("us")).first()
    packets.withColumn("_arrives", _slice(arrival, first, last)).write.partitionBy("_arrives").parquet(staged)  # one scan for all batches
    for i in range(_FILES):
        spark.read.schema(PACKET + ", _arrives bigint").parquet(staged).where(F.col("_arrives") == i).drop("_arrives").repartition(files).write.mode("append").parquet(path)
    if ending:
        late = packets.limit(1).withColumns({"us": F.lit(last + 86_400_000_000), "sec": F.lit((last + 86_400_000_000) // 1_000_000), "ip1": F.lit(_END).cast("long"), "event_id": F.lit(-1).cast("long")})
        late.coalesce(1).write.mode("append").parquet(path)
    return streaming.read_stream(spark, path, PACKET, files)


def _slice(arrival, first, last):
    """Number of the file in which a packet arrives."""
    return F.least(F.floor((arrival - first) * _FILES / (last - first + 1)), F.lit(_FILES - 1))


_BINS_BY_KEY = with_packets(KEYED) + f"SELECT {KEY}, sec // 900 * 900 AS tbm, CAST((sec % 900) // 10 * 10 AS INT) AS off, CAST(sum(CASE WHEN from_lo THEN bytes ELSE 0 END) AS BIGINT) AS b1, CAST(sum(CASE WHEN from_lo THEN 0 ELSE bytes END) AS BIGINT) AS b2 FROM keyed GROUP BY ALL"


@query("STR-2_streamed_sessions", SESSIONS + _INFO.format(where=""))
def streamed_sessions(spark, sf_dir):
    """Complete mode: the last batch has every session, open ones too."""
    info = streaming.stream_sessions(_landed(spark, sf_dir, ending=False), GAP, "1 day", 60)
    rows = streaming.run_available(info, _folder(spark), "complete", "sessions")
    last = rows.agg(F.max("_batch").alias("_last"))
    return rows.join(F.broadcast(last), F.col("_batch") == F.col("_last")).drop("_batch", "_last")


@query("STR-8_final_sessions", SESSIONS + _INFO.format(where=""))
def final_sessions(spark, sf_dir):
    """Append mode: a session goes out once, when the watermark is past its gap; late packets are in it."""
    info = streaming.stream_sessions(_landed(spark, sf_dir), GAP, _PATIENCE, 60)
    return streaming.run_available(info, _folder(spark), "append", "sessions").drop("_batch")


@query("STR-5_streamed_bins", _BINS_BY_KEY)
def streamed_bins(spark, sf_dir):
    """Update mode: a bin is written with each batch that changes it; the latest counts."""
    rows = streaming.run_available(streaming.stream_bins(_landed(spark, sf_dir, ending=False), 900, "1 day"), _folder(spark), "update", "bins")
    return streaming.latest(rows, [*sessions.KEY, "tbm", "off"])


@query("STR-6_closed_bins", _BINS_BY_KEY)
def closed_bins(spark, sf_dir):
    """Append mode: a bin goes out once, when the watermark is past its end."""
    return streaming.run_available(streaming.stream_bins(_landed(spark, sf_dir), 900, _PATIENCE), _folder(spark), "append", "bins").drop("_batch")


@query("STR-7_closed_capture_bins", with_packets() + "SELECT ip_proto, sec // 900 * 900 AS tbm, CAST((sec % 900) // 10 * 10 AS INT) AS off, CAST(sum(bytes) AS BIGINT) AS b, count(*) AS pk FROM packets GROUP BY ALL")
def closed_capture_bins(spark, sf_dir):
    return streaming.run_available(streaming.stream_capture(_landed(spark, sf_dir), 900, _PATIENCE), _folder(spark), "append", "capture").drop("_batch")


@query("STR-10_streamed_round_trips", with_packets(_MATCHED) + "SELECT c_id, ip1, ip2, port, us, rtt FROM requests")
def streamed_round_trips(spark, sf_dir):
    """A request goes out when its wait is over, or its successor is behind the watermark."""
    probes = latency.probes(_landed(spark, sf_dir))
    return streaming.run_available(streaming.stream_latency(probes, _WAIT, _PATIENCE), _folder(spark), "append", "latency").drop("_batch")


@query("STR-9_streamed_throttle", _THROTTLED + "SELECT k AS key, us FROM kept")
def streamed_throttle(spark, sf_dir):
    rows = _landed(spark, sf_dir).select(F.col("ip1").alias("k"), "us")
    return streaming.run_available(streaming.stream_throttled(rows, "k", 600, _PATIENCE), _folder(spark), "append", "throttle").drop("_batch")


@query("STR-11_streamed_started", with_packets(KEYED) + f"SELECT *, coalesce(lag(tbm) OVER (PARTITION BY {KEY} ORDER BY tbm) = tbm - 900, false) AS existing FROM (SELECT DISTINCT {KEY}, sec // 900 * 900 AS tbm FROM keyed)")
def streamed_started(spark, sf_dir):
    return streaming.run_available(streaming.stream_started(_landed(spark, sf_dir), 900, _PATIENCE), _folder(spark), "append", "started").drop("_batch")


@query(
    "STR-18_batch_metrics",
    with_packets() + f"""SELECT CAST(least(floor((us + CASE WHEN event_id % 7 = 0 THEN {_LATE * 1000000} ELSE 0 END - first) * {_FILES}.0 / (last - first + 1)), {_FILES - 1}) AS BIGINT) AS batch, count(*) AS packets, CAST(sum(bytes) AS BIGINT) AS bytes, max(us) AS newest
FROM packets, (SELECT min(us) AS first, max(us) AS last FROM packets) GROUP BY 1""",
)
def batch_metrics(spark, sf_dir):
    """Packets, bytes and the newest packet of every batch, observed while the stream runs, out of the table of all its reports."""
    observed = _landed(spark, sf_dir, ending=False).observe("health", F.count("*").alias("packets"), F.sum("bytes").alias("bytes"), F.max("us").alias("newest"))
    with health.HealthTable(spark, f"{_folder(spark)}/reports") as table:
        streaming.run_batches(observed, lambda batch, _: batch.write.format("noop").mode("overwrite").save(), f"{_folder(spark)}/state")
    found = table.read().withColumn("o", F.from_json("observed", "health struct<packets:long, bytes:long, newest:long>"))
    return found.where("o.health.packets > 0").select("batch", "o.health.*")


@query("SNK-1_session_upserts", SESSIONS + _INFO.format(where=""))
def session_upserts(spark, sf_dir):
    """Sessions kept up batch by batch: inserted when they begin, updated while they last."""
    table = kept.session_table(spark, f"{_folder(spark)}/sessions", GAP, _LATE)
    streaming.run_batches(_landed(spark, sf_dir, ending=False), table.upsert, f"{_folder(spark)}/state")
    return sessions.from_parts(table.read(), 60)


@query("SNK-6_group_upserts", _BINS_BY_KEY)
def group_upserts(spark, sf_dir):
    """Bins of group windows kept up batch by batch, each batch by a driver that knows nothing of those before, and given twice."""
    folder = f"{_folder(spark)}/bins"

    def upsert(batch, number):
        for _ in range(2):
            kept.bin_table(spark, folder, 900, lateness=_LATE).upsert(batch, number)

    streaming.run_batches(_landed(spark, sf_dir, ending=False), upsert, f"{_folder(spark)}/state")
    return kept.bin_table(spark, folder, 900).read()


#: Seconds that packets may be late here: less than some are.
_STRICT = 240
_ARRIVED = f"""arrived AS (SELECT *, CAST(least(floor((us + CASE WHEN event_id % 7 = 0 THEN {_LATE * 1000000} ELSE 0 END - first) * {_FILES}.0 / (last - first + 1)), {_FILES - 1}) AS BIGINT) AS batch FROM keyed, (SELECT min(us) AS first, max(us) AS last FROM keyed)),
marks AS (SELECT batch, max(max(us)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {_STRICT * 1000000} AS mark FROM arrived GROUP BY batch),
judged AS (SELECT *, CASE WHEN us < mark THEN batch ELSE -1 END AS late_in FROM arrived JOIN marks USING (batch))"""
_PLACED = f"SELECT {KEY}, sec // 900 * 900 AS tbm, CAST((sec % 900) // 10 * 10 AS INT) AS off, CAST(sum(CASE WHEN from_lo THEN bytes ELSE 0 END) AS BIGINT) AS b1, CAST(sum(CASE WHEN from_lo THEN 0 ELSE bytes END) AS BIGINT) AS b2, late_in FROM judged GROUP BY ALL"


@query("STR-8_late_packets", with_packets(KEYED, _ARRIVED) + _PLACED)
def late_packets(spark, sf_dir):
    """Bins of group windows, and second ones for packets that come later than the stream waits, by batch; late_in is -1 for the first. No packet is lost."""
    table = kept.bin_table(spark, f"{_folder(spark)}/bins", 900, lateness=_STRICT, apart=True)
    streaming.run_batches(_landed(spark, sf_dir, ending=False), table.upsert, f"{_folder(spark)}/state")
    return table.read().withColumn("late_in", F.lit(-1).cast("long")).unionByName(table.read_late().withColumnRenamed("batch", "late_in"))


@query("STR-19_changing_targets", with_packets(KEYED, _ARRIVED) + """SELECT event_id, CASE WHEN ip1 = 134744072 OR (ip1 = 134744073 AND batch > 1) THEN 'c' || ip1 ELSE 'c' || ip2 END AS c_id, ip1 = 134744072 OR (ip1 = 134744073 AND batch > 1) AS reply
FROM arrived WHERE ip1 = 134744072 OR ip2 = 134744072 OR (batch > 1 AND (ip1 = 134744073 OR ip2 = 134744073))""")
def changing_targets(spark, sf_dir):
    """A target that is added after the second batch counts from the third on."""
    ips, work = [134744072, 134744073], _folder(spark)
    targets = spark.createDataFrame([(f"c{ip}", ip, None, i) for i, ip in enumerate(ips)], "c_id string, ip long, prev_ip long, ord int")
    table = kept.VersionedTable(spark, f"{_folder(spark)}/targets")
    table.publish(targets.where(F.col("ip") == ips[0]))
    keep = kept.each_batch(table, lambda batch, now: latency.to_targets(batch, now).select("event_id", "c_id", "reply"), work)

    def run(batch, number):
        keep(batch, number)
        if number == 1:
            table.publish(targets)

    streaming.run_batches(_landed(spark, sf_dir, ending=False), run, f"{_folder(spark)}/state")
    return spark.read.parquet(work).drop("b")


@query("SRC-13_restarted_sessions", SESSIONS + _INFO.format(where=""))
def restarted_sessions(spark, sf_dir):
    """The sessions of the first half as stored; then a new start from those that may go on, and the second half."""
    packets, middle = read_packets(spark, sf_dir), 1704078000
    stored = sessions.partial_sessions(packets.where(f"sec < {middle}"), GAP)
    folder = f"{_folder(spark)}/sessions"
    kept.stored_sessions(kept.session_table(spark, folder, GAP), stored, middle, GAP)
    table = kept.session_table(spark, folder, GAP)
    table.upsert(packets.where(f"sec >= {middle}"), 0)
    return sessions.from_parts(table.read(), 60)


@query("STR-12_incremental_groups", _BINS_BY_KEY)
def incremental_groups(spark, sf_dir):
    """Group windows rolled up in three runs over seconds that grow, each from where the one before stopped."""
    source, target = f"{_folder(spark)}/seconds", f"{_folder(spark)}/groups"
    seconds = sessions.per_second(read_packets(spark, sf_dir)).select(*sessions.KEY, "sec", F.col("b_lo").alias("b1"), F.col("b_hi").alias("b2"))
    first, last = seconds.agg(F.min("sec"), F.max("sec")).first()
    cuts = [first, first + (last - first) // 3, first + (last - first) * 3 // 4, last + 1]
    for a, b in zip(cuts, cuts[1:], strict=False):
        rollup.store_seconds(seconds.where((F.col("sec") >= a) & (F.col("sec") < b)), source)
        rollup.roll_forward(spark, source, target, sessions.KEY, 900, last=b == cuts[-1])
    return spark.read.parquet(target).select(*sessions.KEY, F.col("tbm").cast("long").alias("tbm"), "off", "b1", "b2")


@query("SNK-2_appended_documents", with_packets(KEYED, _SECONDS, _DOCS, recursive=True) + _DOC_ROWS)
def appended_documents(spark, sf_dir):
    """Byte documents appended a protocol at a time; those without bytes are none."""
    path = f"{_folder(spark)}/documents"
    for proto in (6, 17):
        docs = sessions.byte_documents(read_packets(spark, sf_dir, proto)).where(F.size("b") > 0)
        docs.write.mode("append").parquet(path)
    return spark.read.parquet(path).select(*sessions.KEY, "sb", "se", "doc_lo", "doc_hi", F.size("b").cast("long").alias("seconds"))


_CAPTURED = with_packets() + "SELECT us, ip1, port1, ip2, port2, vlan_id, CAST(greatest(bytes, CASE WHEN vlan_id > 0 THEN 4 ELSE 0 END + CASE WHEN ip_proto = 6 THEN 54 ELSE 42 END) AS BIGINT) AS bytes, CASE WHEN ip_proto = 6 THEN flags END AS flags, ip_proto FROM packets"


def _captures(spark, sf_dir, packets=None):
    """Packets in capture files, in order of time in each: the folder, and a table of the files."""
    packets = read_packets(spark, sf_dir) if packets is None else packets
    folder = _folder(spark)
    folder = folder if "://" in folder else f"file://{folder}"
    written = pcap.write_pcap(packets.repartition("event_id").sortWithinPartitions("us"), folder).select("file").collect()  # a row a file
    pcap.register(spark)
    return folder, spark.createDataFrame(written, "file string")


@query("SRC-9_pcap_chunks", _CAPTURED)
def pcap_chunks(spark, sf_dir):
    """Packets written to capture files and read back in chunks that start anywhere in them."""
    return pcap.ipv4_headers(spark.read.format("pcap").option("chunk", 100_000).load(_captures(spark, sf_dir)[0]))


@query("SRC-11_growing_captures", _CAPTURED)
def growing_captures(spark, sf_dir):
    """Capture files read as they grow, each time by a stream that starts again from its checkpoint; packets cut at a file's end come with the rest of them."""
    folder, files = _captures(spark, sf_dir)
    live, work = f"{folder}-live", _folder(spark)
    for share in (0.31, 0.77, 1.0):
        pcap.grown(files, live, share).collect()  # a row a file
        stream = spark.readStream.format("pcap").option("chunk", 100_000).load(live)
        rows = streaming.run_available(pcap.ipv4_headers(stream), work, "append", "captures")
    return rows.drop("_batch")


#: What packets of this query carry besides, by event_id.
_DEEP = {
    "smac": "2199023255552 + ip1", "dmac": "2199023255552 + ip2", "qinq": "CASE WHEN vlan_id > 0 AND event_id % 5 < 2 THEN 1 + event_id % 4000 END", "tos": "event_id % 256",
    "seq": "(event_id * 2654435761) % 4294967296", "ack": "(event_id * 40503) % 4294967296", "icmp_type": "CASE WHEN event_id % 8 = 0 THEN 8 ELSE 3 END", "icmp_code": "event_id % 16",
    "tunnel": "CASE event_id % 6 WHEN 1 THEN 'gre' WHEN 2 THEN 'ipip' END", "outer1": "3232235521 + event_id % 200", "outer2": "3232236000 + event_id % 3",
}
_DEEP_PROTO = "CASE WHEN event_id % 4 = 0 THEN 1 ELSE ip_proto END"


@query(
    "PROJ-20_deep_headers",
    with_packets(f"deep AS (SELECT us, ip1, port1, ip2, port2, flags, vlan_id, {', '.join(f'{v} AS {k}' for k, v in _DEEP.items())}, {_DEEP_PROTO} AS proto FROM packets)") + """SELECT us, dmac, smac, 2048 AS eth_type, CASE WHEN vlan_id > 0 THEN vlan_id END AS vlan_id, qinq AS qinq_vlan_id, 4 AS ip_version, CASE tunnel WHEN 'gre' THEN 47 WHEN 'ipip' THEN 4 ELSE proto END AS l3_proto, tos AS ip_tos,
  CASE WHEN tunnel IS NULL THEN ip1 ELSE outer1 END AS ip_src, CASE WHEN tunnel IS NULL THEN ip2 ELSE outer2 END AS ip_dst, CASE WHEN tunnel IS NULL AND proto <> 1 THEN port1 END AS l4_src_port, CASE WHEN tunnel IS NULL AND proto <> 1 THEN port2 END AS l4_dst_port,
  CASE WHEN tunnel IS NULL AND proto = 1 THEN icmp_type END AS icmp_type, CASE WHEN tunnel IS NULL AND proto = 1 THEN icmp_code END AS icmp_code, CASE WHEN tunnel IS NULL AND proto = 6 THEN flags END AS tcp_flags, CASE WHEN tunnel IS NULL AND proto = 6 THEN seq END AS tcp_seq, CASE WHEN tunnel IS NULL AND proto = 6 THEN ack END AS tcp_ack,
  tunnel, CASE WHEN tunnel IS NOT NULL THEN proto END AS tunneled_proto, CASE WHEN tunnel IS NOT NULL THEN ip1 END AS tunneled_ip_src, CASE WHEN tunnel IS NOT NULL THEN ip2 END AS tunneled_ip_dst, CASE WHEN tunnel IS NOT NULL AND proto <> 1 THEN port1 END AS tunneled_src_port, CASE WHEN tunnel IS NOT NULL AND proto <> 1 THEN port2 END AS tunneled_dst_port FROM deep""",
)
def deep_headers(spark, sf_dir):
    """Packets with stacked tags, tunnels and all fields, out of capture files."""
    packets = read_packets(spark, sf_dir)
    packets = packets.withColumns({k: F.expr(v) for k, v in _DEEP.items()}).withColumn("ip_proto", F.expr(_DEEP_PROTO))
    rows = spark.read.format("pcap").option("chunk", 100_000).load(_captures(spark, sf_dir, packets)[0])
    return headers.deep_headers(rows).select("us", *[c for c in headers.FIELDS if not c.startswith("ip6")])
