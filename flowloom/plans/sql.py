"""Parts of the SQL that the queries are held against."""

from __future__ import annotations

PACKETS = """packets AS (
  SELECT event_id, us, us // 1000000 AS sec,
    CASE WHEN reply THEN srv ELSE cli END AS ip1, CASE WHEN reply THEN srv_port ELSE cli_port END AS port1,
    CASE WHEN reply THEN cli ELSE srv END AS ip2, CASE WHEN reply THEN cli_port ELSE srv_port END AS port2,
    CASE WHEN cli % 4 = 0 THEN 7 ELSE 0 END AS vlan_id, bytes, flags, ip_proto
  FROM (
    SELECT event_id, 1704067200000000 + (epoch_us(ts) - 1704067200000000) // 120 AS us,
      167772160 + user_id % 10 AS cli, 134744072 + (user_id // 10) % 5 AS srv, 40000 + user_id % 10 AS cli_port,
      CASE (user_id // 10) % 5 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 53 WHEN 3 THEN 22 ELSE 8080 END AS srv_port,
      event_id % 3 = 0 AS reply, 40 + CAST(round(value * 100) AS BIGINT) % 1461 AS bytes,
      CASE event_type WHEN 'signup' THEN 2 WHEN 'view' THEN 16 WHEN 'click' THEN 24 WHEN 'purchase' THEN 18 ELSE 17 END AS flags,
      CASE WHEN user_id % 2 = 0 THEN 6 ELSE 17 END AS ip_proto
    FROM events))"""

KEYED = """keyed AS (
  SELECT *, (ip1, port1) <= (ip2, port2) AS from_lo,
    CASE WHEN (ip1, port1) <= (ip2, port2) THEN ip1 ELSE ip2 END AS lo_ip, CASE WHEN (ip1, port1) <= (ip2, port2) THEN port1 ELSE port2 END AS lo_port,
    CASE WHEN (ip1, port1) <= (ip2, port2) THEN ip2 ELSE ip1 END AS hi_ip, CASE WHEN (ip1, port1) <= (ip2, port2) THEN port2 ELSE port1 END AS hi_port,
    CASE WHEN ip_proto = 6 THEN flags = 2 OR NOT (flags = 18 OR port2 > port1) ELSE port1 > port2 END AS sender_client,
    CASE WHEN (flags & 16) > 0 THEN flags << 8 ELSE flags END AS packed
  FROM packets)"""

KEY = "lo_ip, lo_port, hi_ip, hi_port, vlan_id, ip_proto"

GAP = 20


def sessionized(gap: int = GAP) -> str:
    return f"""marked AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY {KEY} ORDER BY us, event_id) > {gap * 1000000} THEN 1 ELSE 0 END AS fresh FROM keyed),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY {KEY} ORDER BY us, event_id) AS session FROM marked),
sided AS (SELECT *, first_value(sender_client = from_lo) OVER (PARTITION BY {KEY}, session ORDER BY us, event_id) AS lo_client,
  min(us) OVER (PARTITION BY {KEY}, session) AS tb FROM numbered),
conv AS (SELECT *, from_lo = lo_client AS from_client FROM sided),
traffic AS (SELECT *, CASE WHEN from_client THEN ip1 ELSE ip2 END AS c_ip, CASE WHEN from_client THEN ip2 ELSE ip1 END AS s_ip,
  CASE WHEN from_client THEN port2 ELSE port1 END AS s_port, CASE WHEN from_client THEN bytes ELSE 0 END AS b1, CASE WHEN from_client THEN 0 ELSE bytes END AS b2 FROM conv)"""


def with_packets(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join([PACKETS, *parts]) + "\n"


SESSIONS = with_packets(KEYED, sessionized())
