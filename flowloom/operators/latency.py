"""Round trips: requests with their replies, by minute and in windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions import times
from flowloom.operators.slices import with_neighbour

KEY = ["c_id", "ip1", "ip2", "port"]


def probes(packets: DataFrame) -> DataFrame:
    """Packets of the adapter as probes: replies come from the lower port. c_id stands for the target, the server's address."""
    reply = F.col("port1") < F.col("port2")
    return packets.select(
        F.when(reply, F.col("ip1")).otherwise(F.col("ip2")).alias("c_id"),
        F.when(reply, F.col("ip2")).otherwise(F.col("ip1")).alias("ip1"),
        F.when(reply, F.col("ip1")).otherwise(F.col("ip2")).alias("ip2"),
        F.least("port1", "port2").alias("port"),
        "us",
        "event_id",
        reply.alias("reply"),
    )


def matched(rows: DataFrame, expire: int, keys: list[str] = KEY) -> DataFrame:
    """A row a request: us and rtt in microseconds, null if lost. A reply answers the request right before it on its key, so a request overwritten by a later one is lost and a second reply finds none; later than `expire` seconds doesn't count. Pairs that take no time are dropped."""
    after = with_neighbour(rows, keys, ["us", "event_id"], F.struct("reply", "us"), "_after", ahead=True)
    took = F.col("_after.us") - F.col("us")
    rtt = F.when(F.col("_after.reply") & (took <= expire * 1_000_000), took)
    return after.where(~F.col("reply")).withColumn("rtt", rtt).where("rtt is null or rtt > 0").drop("_after", "reply")


def session_latency(requests: DataFrame) -> DataFrame:
    return requests.groupBy(*KEY).agg(
        F.min("us").alias("tb"),
        F.max("us").alias("te"),
        F.count("*").alias("req"),
        F.count("rtt").alias("rply"),
        times.milliseconds(F.min("rtt")).alias("lmin"),
        times.milliseconds(F.max("rtt")).alias("lmax"),
    )


def by_second(requests: DataFrame) -> DataFrame:
    """One value a second, of its last request: sbm the minute, off seconds since the minute's first request, rtl milliseconds or null, lost 1 or 0; n and answered count all requests of the second."""
    sec = F.expr("us div 1000000")
    rows = requests.withColumn("sec", sec).withColumn("sbm", times.floor_to(sec, 60))
    last = rows.groupBy(*KEY, "sbm", "sec").agg(F.max_by(F.struct("rtt"), F.struct("us", "event_id")).alias("last"), F.count("*").alias("n"), F.count("rtt").alias("answered"), F.min("rtt").alias("least"), F.max("rtt").alias("most"))
    begin = F.min("sec").over(Window.partitionBy(*KEY, "sbm"))
    return last.select(*KEY, "sbm", "sec", (F.col("sec") - begin).cast("int").alias("off"), times.milliseconds(F.col("last.rtt")).alias("rtl"), F.when(F.col("last.rtt").isNull(), 1).otherwise(0).alias("lost"), "n", "answered", "least", "most")


def minute_documents(seconds: DataFrame) -> DataFrame:
    """A row a key and minute with arrays rtl (offset, ms) and pl (offset, lost)."""
    return seconds.groupBy(*KEY, "sbm").agg(
        F.min("sec").alias("sb"),
        F.max("sec").alias("se"),
        F.array_sort(F.collect_list(F.struct(F.col("off").alias("offset"), F.col("rtl").alias("ms")))).alias("rtl"),
        F.array_sort(F.collect_list(F.struct(F.col("off").alias("offset"), "lost"))).alias("pl"),
        F.sum("n").alias("req"),
        F.sum("answered").alias("rply"),
        times.milliseconds(F.min("least")).alias("lmin"),
        times.milliseconds(F.max("most")).alias("lmax"),
    )


def rollup(seconds: DataFrame, window: int, bins: int = 90) -> DataFrame:
    """By target, window and bin: mean rtl, pl (lost / answered seconds; the lost if none was answered), loss_ratio (lost / all)."""
    tbm = times.floor_to(F.col("sec"), window)
    off = (times.floor_to(F.col("sec"), window // bins) - tbm).cast("int")
    rows = seconds.groupBy("c_id", tbm.alias("tbm"), off.alias("off")).agg(
        F.round(F.avg("rtl"), 3).alias("rtl"), F.sum("lost").alias("lost"), F.count("*").alias("sampled"), F.sum("n").alias("req"), F.sum("answered").alias("rply"), times.milliseconds(F.min("least")).alias("lmin"), times.milliseconds(F.max("most")).alias("lmax")
    )
    answered = F.col("sampled") - F.col("lost")
    return rows.select("c_id", "tbm", "off", "rtl", F.round(F.when(answered > 0, F.col("lost") / answered).otherwise(F.col("lost").cast("double")), 6).alias("pl"), F.round(F.col("lost") / F.col("sampled"), 6).alias("loss_ratio"), "req", "rply", "lmin", "lmax")


def to_targets(packets: DataFrame, targets: DataFrame) -> DataFrame:
    """Packets to or from a target (c_id, ip, prev_ip, ord, and if given ip_proto and port): the sender's target makes a reply, else the receiver's a request. Where targets have a protocol or a port (for ICMP the type), packets must have them too at the target's end; null stands for any. Of several targets that fit an end the last (ord) counts."""
    kinds = [c for c in ("ip_proto", "port") if c in targets.columns]
    both = [targets.select("c_id", "ord", F.col(c).alias("addr"), *kinds) for c in ("ip", "prev_ip")]
    ends = both[0].union(both[1]).where("addr is not null").distinct()

    def met(end: str, port: str, name: str) -> DataFrame:
        """The target of each kind of packet at one end: distinct kinds are few beside packets."""
        of = [end, *({"ip_proto": "ip_proto", "port": port}[k] for k in kinds)]
        fits = F.col(end) == F.col("addr")
        for k, c in zip(kinds, of[1:], strict=True):
            fits = fits & (ends[k].isNull() | (ends[k] == F.col(f"_{c}")))
        seen = packets.select(end, *[F.col(c).alias(f"_{c}") for c in of[1:]]).distinct().join(ends, fits)
        best = seen.groupBy(end, *[f"_{c}" for c in of[1:]]).agg(F.max_by("c_id", "ord").alias(name))
        return best.select(F.col(end).alias(f"{name}_0"), *[F.col(f"_{c}").alias(f"{name}_{i}") for i, c in enumerate(of[1:], 1)], name), of

    joined = packets
    for end, port, name in (("ip1", "port1", "_sender"), ("ip2", "port2", "_receiver")):
        best, of = met(end, port, name)
        on = [F.col(c).eqNullSafe(F.col(f"{name}_{i}")) if i else F.col(c) == F.col(f"{name}_{i}") for i, c in enumerate(of)]
        joined = joined.join(best, on, "left")
    kept = joined.where("_sender is not null or _receiver is not null")
    return kept.select(*packets.columns, F.coalesce("_sender", "_receiver").alias("c_id"), F.col("_sender").isNotNull().alias("reply"))
