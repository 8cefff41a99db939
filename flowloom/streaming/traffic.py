"""Streaming forms of sessions, groups, latency and throttling.

Event time is the packet's; a watermark bounds lateness. Windows and sessions are
built-in streaming aggregates; matching and throttling keep keyed state with
timeouts. Mutable rows go out in update mode and are kept by their key: of rows with
the same key the one of the latest batch counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowloom.functions import times
from flowloom.operators.groups import BINS
from flowloom.operators.sessions import KEY, oriented, session_aggregates, with_session_key


def timed(packets: DataFrame, lateness: str = "30 seconds") -> DataFrame:
    return packets.withColumn("ts", F.timestamp_micros("us")).withWatermark("ts", lateness)


def kept_awake(packets: DataFrame, lateness: str = "30 seconds", beats: DataFrame | None = None) -> DataFrame:
    """As timed(), for a live stream that may fall silent: beats (a stream with `timestamp`, of the machine's clock if none is given) move the watermark on, so that what is open is closed in its time though no packet comes. Packets' times must be of the same clock."""
    spark = packets.sparkSession
    if beats is None:
        beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in packets.schema]
    both = packets.withColumn("ts", F.timestamp_micros("us")).withColumn("_beat", F.lit(False)).unionByName(beats.select(*empty, F.col("timestamp").alias("ts"), F.lit(True).alias("_beat")))
    # the condition holds the time, so that it stays behind the watermark
    return both.withWatermark("ts", lateness).where(F.when(~F.col("_beat"), F.col("ts")).isNotNull()).drop("_beat")


def stream_sessions(packets: DataFrame, gap: int = 120, lateness: str = "30 seconds", lrs_min_duration: int = 300, awake: bool = False) -> DataFrame:
    """Session summaries; a session is final once the watermark is past its gap. awake: also if no packet comes any more."""
    keyed = with_session_key(kept_awake(packets, lateness) if awake else timed(packets, lateness))
    return oriented(keyed.groupBy(*KEY, F.session_window("ts", f"{gap} seconds")).agg(*session_aggregates()), lrs_min_duration)


def stream_bins(packets: DataFrame, window: int, lateness: str = "60 seconds") -> DataFrame:
    """Bytes of session keys by bin of a group window."""
    keyed = with_session_key(timed(packets, lateness))
    lo = F.col("from_lo")
    placed = keyed.groupBy(*KEY, F.window("ts", f"{window // BINS} seconds").alias("w")).agg(F.sum(F.when(lo, F.col("bytes")).otherwise(0)).alias("b1"), F.sum(F.when(lo, 0).otherwise(F.col("bytes"))).alias("b2"))
    start = F.unix_seconds("w.start")
    tbm = times.floor_to(start, window)
    return placed.select(*KEY, tbm.alias("tbm"), (start - tbm).cast("int").alias("off"), "b1", "b2")


REQUEST = "c_id long, ip1 long, ip2 long, port int, us long, rtt long"


def stream_latency(probes: DataFrame, expire: int, lateness: str = "30 seconds") -> DataFrame:
    """Requests with their round trips, as latency.matched() makes them: the state of a key is its open request. Rows wait in state until the watermark passes them, so order of arrival within the lateness doesn't matter."""

    def match(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        if not state.hasTimedOut:
            for frame in frames:
                held += [int(v) for row in zip(frame["us"], frame["event_id"], frame["reply"].astype(int), strict=True) for v in row]
        mark = state.getCurrentWatermarkMs() * 1000
        rows = sorted(zip(held[::3], held[1::3], held[2::3], strict=True))
        out, kept, i = [], [], 0
        while i < len(rows):
            us, event, reply = rows[i]
            after = rows[i + 1] if i + 1 < len(rows) else None
            # a request is settled when its successor, or the end of its wait, is behind the watermark
            settled = after[0] < mark if after else us + expire * 1_000_000 < mark
            if not state.hasTimedOut and not settled:
                kept = rows[i:]
                break
            if not reply:
                rtt = after[0] - us if after and after[2] and after[0] - us <= expire * 1_000_000 else None
                if rtt is None or rtt > 0:
                    out.append((*key, us, rtt))
            i += 1
        if kept:
            state.update(([v for row in kept for v in row],))
            state.setTimeoutTimestamp(max(kept[-1][0] // 1000 + expire * 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if out:
            frame = pd.DataFrame(out, columns=["c_id", "ip1", "ip2", "port", "us", "rtt"])
            yield frame.astype({"rtt": "Int64"})

    keyed = timed(probes, lateness).groupBy("c_id", "ip1", "ip2", "port")
    return keyed.applyInPandasWithState(match, REQUEST, "held array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def stream_throttled(rows: DataFrame, key: str, wait: int, lateness: str = "30 seconds") -> DataFrame:
    """Key and us of rows that are the first of their key or come more than `wait` seconds after the last that passed. Rows wait in state until the watermark passes them, so order of arrival within the lateness doesn't matter; beside them state is the time of the last that passed, gone when it can hold nothing back."""
    gap = wait * 1_000_000

    def pass_on(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, [])
        mark = state.getCurrentWatermarkMs() * 1000
        times = np.unique(np.concatenate([np.asarray(held, np.int64), *(frame["us"].to_numpy(np.int64) for frame in ([] if state.hasTimedOut else frames))]))
        settled, held = times[times < mark], times[times >= mark]
        out = []
        for us in settled.tolist():
            if last is None or us - last > gap:
                out.append(us)
                last = us
        if len(held) or (last is not None and last + gap >= mark):
            until = int(held[0]) if len(held) else last + gap
            state.update((last, held.tolist()))
            state.setTimeoutTimestamp(max(until // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame({"key": [k[0]] * len(out), "us": out})

    kind = rows.schema[key].dataType.simpleString()
    return timed(rows, lateness).groupBy(key).applyInPandasWithState(pass_on, f"key {kind}, us long", "last long, held array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def stream_capture(packets: DataFrame, window: int, lateness: str = "60 seconds") -> DataFrame:
    """Bytes and packets of each protocol by bin of a group window."""
    placed = timed(packets, lateness).groupBy("ip_proto", F.window("ts", f"{window // BINS} seconds").alias("w")).agg(F.sum("bytes").alias("b"), F.count("*").alias("pk"))
    start = F.unix_seconds("w.start")
    tbm = times.floor_to(start, window)
    return placed.select("ip_proto", tbm.alias("tbm"), (start - tbm).cast("int").alias("off"), "b", "pk")


def stream_started(packets: DataFrame, window: int, lateness: str = "60 seconds") -> DataFrame:
    """A row for each session key and window in which it is active, with whether it was active in the window before. State is the active windows that the watermark hasn't passed and the last before them, gone after two windows more."""

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, [])
        mark = state.getCurrentWatermarkMs() // 1000
        seen = set(held)
        if not state.hasTimedOut:
            for frame in frames:
                seen.update(frame["tbm"].unique().tolist())
        out = []
        for tbm in sorted(seen):
            if tbm + window <= mark:
                out.append((*key, tbm, last == tbm - window))
                last = tbm
        held = sorted(t for t in seen if t + window > mark)
        if held or (last is not None and last + 2 * window > mark):
            until = held[0] + window if held else last + 2 * window
            state.update((last, held))
            state.setTimeoutTimestamp(max(until * 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=[*KEY, "tbm", "existing"])

    keyed = with_session_key(timed(packets, lateness)).withColumn("tbm", times.floor_to(F.col("sec"), window))
    fields = ", ".join(f"{k} {keyed.schema[k].dataType.simpleString()}" for k in KEY)
    return keyed.groupBy(*KEY).applyInPandasWithState(judge, f"{fields}, tbm long, existing boolean", "last long, held array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def run_available(stream: DataFrame, folder: str, mode: str, name: str) -> DataFrame:
    """Run a stream over what there is; the rows it gave, with the number of their batch."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/{name}/out/_b={number}")

    run_batches(stream, keep, f"{folder}/{name}/state", mode)
    return stream.sparkSession.read.schema(T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])).option("recursiveFileLookup", "true").parquet(f"{folder}/{name}/out")


def run_batches(stream: DataFrame, keep: Callable[[DataFrame, int], None], state: str, mode: str = "append") -> list[dict]:
    """Run a stream over what there is, each batch through keep(batch, number); the metrics observed in each batch."""
    query = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return [{"batch": p.batchId, **{k: v.asDict() for k, v in p.observedMetrics.items()}} for p in query.recentProgress]


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with the same key that of the latest batch: an upsert table."""
    order = Window.partitionBy(*keys).orderBy(F.desc("_batch"))
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_batch")


def read_stream(spark: SparkSession, path: str, schema: str, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
