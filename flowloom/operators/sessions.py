"""Bidirectional sessions: summaries, per-second series and 20-second documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions import net, times
from flowloom.operators.ordered import with_starts
from flowloom.operators.slices import with_last, with_neighbour

KEY = ["lo_ip", "lo_port", "hi_ip", "hi_port", "vlan_id", "ip_proto"]


def with_session_key(packets: DataFrame) -> DataFrame:
    """Adds the endpoints in order of (address, port), the same for both directions, and whether the sender is the lower."""
    sender = F.struct(F.col("ip1").alias("ip"), F.col("port1").alias("port"))
    receiver = F.struct(F.col("ip2").alias("ip"), F.col("port2").alias("port"))
    low, high = F.least(sender, receiver), F.greatest(sender, receiver)
    return packets.select("*", low["ip"].alias("lo_ip"), low["port"].alias("lo_port"), high["ip"].alias("hi_ip"), high["port"].alias("hi_port"), (sender <= receiver).alias("from_lo"))


def sender_is_client() -> Column:
    return F.when(F.col("ip_proto") == 6, net.tcp_sender_is_client(F.col("flags"), F.col("port1"), F.col("port2"))).otherwise(net.udp_sender_is_client(F.col("port1"), F.col("port2")))


def session_aggregates() -> list[Column]:
    """Aggregates of a session's packets, by side; the first packet says whether the lower endpoint is the client."""
    lo, hi = F.col("from_lo"), ~F.col("from_lo")
    packed = net.pack_flags(F.col("flags"))
    first = F.struct("us", "event_id")
    return [
        F.min("us").alias("tb"),
        F.max("us").alias("te"),
        F.sum(F.when(lo, F.col("bytes")).otherwise(0)).alias("b_lo"),
        F.sum(F.when(hi, F.col("bytes")).otherwise(0)).alias("b_hi"),
        F.count_if(lo).alias("pk_lo"),
        F.count_if(hi).alias("pk_hi"),
        F.coalesce(F.bit_or(F.when(lo, packed)), F.lit(0)).alias("f_lo"),
        F.coalesce(F.bit_or(F.when(hi, packed)), F.lit(0)).alias("f_hi"),
        F.min_by(sender_is_client() == lo, first).alias("lo_client"),
    ]


def oriented(sessions: DataFrame, lrs_min_duration: int) -> DataFrame:
    """Client first: ip1 p1 b1 f1 pk1 are the client's. Times in microseconds; tbm and tem are minutes, tdm the duration of long sessions only."""
    client = F.col("lo_client")
    pick = lambda a, b: F.when(client, F.col(a)).otherwise(F.col(b))
    seconds = F.expr("(te - tb) div 1000000")
    return sessions.select(
        pick("lo_ip", "hi_ip").alias("ip1"),
        pick("lo_port", "hi_port").alias("p1"),
        pick("b_lo", "b_hi").alias("b1"),
        pick("f_lo", "f_hi").alias("f1"),
        pick("hi_ip", "lo_ip").alias("ip2"),
        pick("hi_port", "lo_port").alias("p2"),
        pick("b_hi", "b_lo").alias("b2"),
        pick("f_hi", "f_lo").alias("f2"),
        (F.col("b_lo") + F.col("b_hi")).alias("bt"),
        times.floor_to(F.expr("tb div 1000000"), 60).alias("tbm"),
        times.floor_to(F.expr("te div 1000000"), 60).alias("tem"),
        "tb",
        "te",
        (F.col("pk_lo") + F.col("pk_hi")).alias("pk"),
        pick("pk_lo", "pk_hi").alias("pk1"),
        pick("pk_hi", "pk_lo").alias("pk2"),
        F.when(F.col("vlan_id") > 0, F.col("vlan_id")).alias("vl"),
        F.when(seconds >= lrs_min_duration, seconds).alias("tdm"),
        "ip_proto",
    )


def partial_sessions(packets: DataFrame, gap: int = 120) -> DataFrame:
    """Sessions of some packets, to be merged with others of the same keys: as session_aggregates(), with the first packet."""
    keyed = with_session_key(packets).withColumn("ts", F.timestamp_micros("us"))
    first = F.min(F.struct("us", "event_id", (sender_is_client() == F.col("from_lo")).alias("lo_client"))).alias("first")
    return keyed.groupBy(*KEY, F.session_window("ts", f"{gap} seconds")).agg(*session_aggregates()[:-1], first).drop("session_window")


def merged_sessions(parts: DataFrame, gap: int = 120) -> DataFrame:
    """Partial sessions (tb to te) of a key that are no further than the gap apart, as one."""
    order = Window.partitionBy(*KEY).orderBy("tb", "te")
    before = F.max("te").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("tb") - before > gap * 1_000_000, F.lit(True)).cast("int")
    numbered = parts.withColumn("_fresh", fresh).withColumn("_session", F.sum("_fresh").over(order))
    sums = [F.sum(c).alias(c) for c in ("b_lo", "b_hi", "pk_lo", "pk_hi")] + [F.bit_or(c).alias(c) for c in ("f_lo", "f_hi")]
    return numbered.groupBy(*KEY, "_session").agg(F.min("tb").alias("tb"), F.max("te").alias("te"), *sums, F.min("first").alias("first")).select(parts.columns)


def from_parts(sessions: DataFrame, lrs_min_duration: int = 300) -> DataFrame:
    """Merged sessions as session_info() gives them."""
    return oriented(sessions.withColumn("lo_client", F.col("first.lo_client")), lrs_min_duration)


def plain_session_info(packets: DataFrame, gap: int = 120, lrs_min_duration: int = 300) -> DataFrame:
    """As session_info(), by the plainer rule for the client: of TCP the lower endpoint, else whoever sends first."""
    keyed = with_session_key(packets).withColumn("ts", F.timestamp_micros("us"))
    client = F.min_by((F.col("ip_proto") == 6) | F.col("from_lo"), F.struct("us", "event_id")).alias("lo_client")
    return oriented(keyed.groupBy(*KEY, F.session_window("ts", f"{gap} seconds")).agg(*session_aggregates()[:-1], client), lrs_min_duration)


def read_back(stored: DataFrame) -> DataFrame:
    """Stored session documents as both sides' counters again; documents from before packets were counted by side have none."""
    missing = {c: F.lit(None).cast("long") for c in ("pk1", "pk2") if c not in stored.columns}
    return stored.withColumns(missing).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("pk1", "pk2")})


def session_info(packets: DataFrame, gap: int = 120, lrs_min_duration: int = 300) -> DataFrame:
    """A row a session. Packets up to and including the gap apart are one session. Partial sessions merge before and after the shuffle on the key."""
    keyed = with_session_key(packets).withColumn("ts", F.timestamp_micros("us"))
    sessions = keyed.groupBy(*KEY, F.session_window("ts", f"{gap} seconds")).agg(*session_aggregates())
    return oriented(sessions, lrs_min_duration)


def sessionized(packets: DataFrame, gap: int = 120) -> DataFrame:
    """Packets with tb, the begin of their session, and whether the sender is its client."""
    order = ["us", "event_id"]
    keyed = with_neighbour(with_session_key(packets), KEY, order, F.col("us"), "_before")
    fresh = F.coalesce(F.col("us") - F.col("_before") > gap * 1_000_000, F.lit(True))
    first = F.when(fresh, F.struct("us", (sender_is_client() == F.col("from_lo")).alias("lo_client")))
    opened = with_last(keyed, KEY, order, first, "_first")
    return opened.withColumn("tb", F.col("_first.us")).withColumn("from_client", F.col("from_lo") == F.col("_first.lo_client")).drop("_first", "_before")


def session_seconds(packets: DataFrame, gap: int = 120) -> DataFrame:
    return seconds_of(with_session_key(packets), KEY, sender_is_client(), gap)


def seconds_of(keyed: DataFrame, keys: list[str], client: Column, gap: int = 120) -> DataFrame:
    """Bytes b1 of the client and b2 of the server and packets of every session of keys (whose first packet tells whether its sender is the client), second by second, with its begin tb. Packets are summed by key and second before any order is needed, so a busy key has a row a second; a gap of a second or more shows between active seconds."""
    lo = F.col("from_lo")
    client = F.struct("us", "event_id", (client == lo).alias("lo_client"))
    seconds = keyed.groupBy(*keys, "sec").agg(
        F.min("us").alias("first_us"),
        F.max("us").alias("last_us"),
        F.min(client).alias("first"),
        F.sum(F.when(lo, F.col("bytes")).otherwise(0)).alias("b_lo"),
        F.sum(F.when(lo, 0).otherwise(F.col("bytes"))).alias("b_hi"),
        F.count("*").alias("pk"),
    )
    order = Window.partitionBy(*keys).orderBy("sec")
    begins = F.coalesce(F.col("first_us") - F.lag("last_us").over(order) > gap * 1_000_000, F.lit(True))
    opened = seconds.withColumn("first", F.last(F.when(begins, F.col("first")), ignorenulls=True).over(order))
    lo_client = F.col("first.lo_client")
    return opened.select(
        *keys,
        "sec",
        F.col("first.us").alias("tb"),
        lo_client.alias("lo_client"),
        F.when(lo_client, F.col("b_lo")).otherwise(F.col("b_hi")).alias("b1"),
        F.when(lo_client, F.col("b_hi")).otherwise(F.col("b_lo")).alias("b2"),
        "pk",
    )


def per_second(packets: DataFrame) -> DataFrame:
    """Bytes and packets of both sides of a key, second by second."""
    lo = F.col("from_lo")
    return with_session_key(packets).groupBy(*KEY, "sec").agg(F.sum(F.when(lo, F.col("bytes")).otherwise(0)).alias("b_lo"), F.sum(F.when(lo, 0).otherwise(F.col("bytes"))).alias("b_hi"), F.count("*").alias("pk"))


def byte_documents(packets: DataFrame, length: int = 20) -> DataFrame:
    """Documents of at most `length` seconds a key: each starts at the first active second that the last does not cover. A row has its begin sb, last active second se, b: array of (offset, b_lo, b_hi), and the key's bytes up to its end."""
    placed = with_starts(per_second(packets).drop("pk"), KEY, "sec", length, "sb")
    documents = placed.groupBy(*KEY, "sb").agg(
        F.max("sec").alias("se"),
        F.sum("b_lo").alias("doc_lo"),
        F.sum("b_hi").alias("doc_hi"),
        F.array_sort(F.collect_list(F.struct((F.col("sec") - F.col("sb")).cast("int").alias("offset"), "b_lo", "b_hi"))).alias("b"),
    )
    so_far = Window.partitionBy(*KEY).orderBy("sb").rowsBetween(Window.unboundedPreceding, 0)
    return documents.withColumn("b_lo", F.sum("doc_lo").over(so_far)).withColumn("b_hi", F.sum("doc_hi").over(so_far))


def flag_sets(packets: DataFrame, gap: int = 120, most: int = 8) -> DataFrame:
    """Distinct flag values of each side of a key in order of first appearance, at most so many."""
    keyed = with_session_key(packets)
    first = keyed.groupBy(*KEY, "from_lo", "flags").agg(F.min(F.struct("us", "event_id")).alias("first"))
    ordered = first.groupBy(*KEY, "from_lo").agg(F.array_sort(F.collect_list(F.struct("first", "flags"))).alias("seen"))
    return ordered.select(*KEY, "from_lo", F.array_join(F.transform(F.slice("seen", 1, most), lambda s: s["flags"].cast("string")), ",").alias("flag_list"))
