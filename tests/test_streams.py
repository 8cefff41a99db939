"""Tables kept up over restarts, late packets, health of streams, rollups run by run, captures that grow."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from flowloom.operators import rollup, sessions
from flowloom.sources import pcap
from flowloom.sources.packets import PACKET, read_packets
from flowloom.streaming import health, kept, traffic


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def batches(spark):
    """Packets in four batches by time, a seventh of them ten minutes late."""
    packets = read_packets(spark, SMALL)
    first, last = packets.agg(F.min("us"), F.max("us")).first()
    arrival = F.col("us") + F.when(F.col("event_id") % 7 == 0, 600_000_000).otherwise(0)
    number = F.least(F.floor((arrival - first) * 4 / (last - first + 1)), F.lit(3))
    rows = packets.withColumn("n", number).cache()
    assert rows.where("n > 0").count() > 100
    return [rows.where(F.col("n") == i).drop("n") for i in range(4)]


class Killed(Exception):
    pass


@pytest.mark.parametrize("kind", ["sessions", "bins"])
def test_a_kept_table_survives_the_driver(spark, batches, tmp_path, monkeypatch, kind):
    """The driver ends after each kind of write of some batch; a new one is given the batch again."""
    make = (lambda: kept.session_table(spark, str(tmp_path / "t"), 20, 600)) if kind == "sessions" else (lambda: kept.bin_table(spark, str(tmp_path / "t"), 900, lateness=600))
    writes, at = [0], [0]
    write, end = kept.BatchLog.write, kept.BatchLog.end

    def counted(f):
        def run(self, *args):
            f(self, *args)
            writes[0] += 1
            if writes[0] == at[0]:
                raise Killed

        return run

    monkeypatch.setattr(kept.BatchLog, "write", counted(write))
    monkeypatch.setattr(kept.BatchLog, "end", counted(end))
    for i, batch in enumerate(batches):
        for k in (1, 2, 3) if i in (1, 3) else ():
            writes[0], at[0] = 0, k
            with pytest.raises(Killed):
                make().upsert(batch, i)
        at[0] = -1
        make().upsert(batch, i)
        make().upsert(batch, i)  # once more
        make().upsert(batch.where("1 = 0"), i + 100)  # a batch of nothing
    table = make()
    if kind == "sessions":
        assert same(sessions.from_parts(table.read(), 60), sessions.session_info(read_packets(spark, SMALL), 20, 60))
    else:
        assert same(table.read(), table.merged(table.partial(read_packets(spark, SMALL))))
    numbers = [e.number for e in table.log.entries()]
    assert numbers == [0, 1, 2, 3] and [n for n in numbers if table.log.has(n, kept.OPEN)] == [2, 3]


def test_an_earlier_batch_again_forgets_later_ones(spark, batches, tmp_path):
    table = kept.bin_table(spark, str(tmp_path / "t"), 900, lateness=600)
    for i in (0, 1, 2):
        table.upsert(batches[i], i)
    table.upsert(batches[2], 2)
    for i in (2, 3):
        table.upsert(batches[i], i)
    assert same(table.read(), table.merged(table.partial(read_packets(spark, SMALL))))


def test_rows_close_by_the_streams_clock(spark, batches, tmp_path):
    """A batch of old packets alone neither opens nor closes anything by its own times."""
    table = kept.session_table(spark, str(tmp_path / "t"), 20, 600)
    table.upsert(batches[3], 0)
    newest = table.log.before().newest
    table.upsert(batches[0], 1)
    assert table.log.before().newest == newest
    assert table.spark.read.parquet(table.log.rows(1, kept.OPEN)).where(F.col("te") < newest - 620_000_000).isEmpty()


def test_late_packets_are_apart(spark, batches, tmp_path):
    """On time or late, each packet is in one row; late ones are those behind the newest of the batches before."""
    table = kept.bin_table(spark, str(tmp_path / "t"), 900, lateness=240, apart=True)
    for i, batch in enumerate(batches):
        kept.bin_table(spark, str(tmp_path / "t"), 900, lateness=240, apart=True).upsert(batch, i)
        table.upsert(batch, i)
    total = read_packets(spark, SMALL).agg(F.sum("bytes")).first()[0]
    late, newest = 0, None
    for batch in batches:
        if newest is not None:
            late += batch.where(F.col("us") < newest - 240_000_000).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
        newest = max(newest or 0, batch.agg(F.max("us")).first()[0])
    count = lambda df: df.agg(F.coalesce(F.sum(F.col("b1") + F.col("b2")), F.lit(0))).first()[0]
    assert count(table.read_late()) == late > 0 and count(table.read()) == total - late
    assert table.read_late().where("batch = 0").isEmpty()


def test_a_stream_goes_on_with_a_new_table_object(spark, batches, tmp_path):
    """The stream stops with two of four files done, and starts again from its checkpoint with an object that knows nothing."""
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if i in (1, 3):
            table = kept.session_table(spark, str(tmp_path / "t"), 20, 600)
            traffic.run_batches(traffic.read_stream(spark, str(tmp_path / "in"), PACKET), table.upsert, str(tmp_path / "state"))
    assert same(sessions.from_parts(kept.session_table(spark, str(tmp_path / "t"), 20).read(), 60), sessions.session_info(read_packets(spark, SMALL), 20, 60))


def test_no_report_is_lost(spark, tmp_path):
    """More batches than Spark keeps reports of, in two runs."""
    rows = spark.range(1200).selectExpr("id", "timestamp_seconds(1700000000 + id) as ts")
    rows.repartitionByRange(110, "id").write.parquet(str(tmp_path / "in"))
    table = health.HealthTable(spark, str(tmp_path / "reports"), every=40)
    with table:
        stream = lambda files: spark.readStream.schema("id long, ts timestamp").option("maxFilesPerTrigger", files).parquet(str(tmp_path / "in"))
        counted = stream(1).observe("seen", F.count("*").alias("n"))
        for _ in range(2):
            query = counted.writeStream.foreachBatch(lambda batch, _: batch.write.format("noop").mode("overwrite").save()).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            query.awaitTermination()
        assert len(query.recentProgress) <= 100
        # one with state
        held = stream(11).withWatermark("ts", "10 seconds").groupBy(F.window("ts", "5 seconds")).count()
        query = held.writeStream.format("noop").outputMode("append").option("checkpointLocation", str(tmp_path / "held")).trigger(availableNow=True).start()
        query.awaitTermination()
        held_id = str(query.id)
    found = table.read()
    first = found.where(F.col("id") != held_id)
    assert first.where("rows > 0").select("batch").distinct().count() == 110 and first.agg(F.sum("rows")).first()[0] == 1200
    assert first.where("rows > 0").select(F.sum(F.get_json_object("observed", "$.seen.n").cast("long"))).first()[0] == 1200
    state = found.where(F.col("id") == held_id)
    assert state.agg(F.max("state_rows")).first()[0] > 0 and state.where("watermark is not null and lag_seconds is not null").count() > 8 and found.where("milliseconds is null").count() == 0


def test_rollups_read_what_is_new(spark, tmp_path):
    """Runs over growing seconds give one run's windows; each starts at the newest window of the one before, and reads no folder before it."""
    seconds = sessions.per_second(read_packets(spark, SMALL)).select(*sessions.KEY, "sec", F.col("b_lo").alias("b1"), F.col("b_hi").alias("b2")).cache()
    first, last = seconds.agg(F.min("sec"), F.max("sec")).first()
    source, target, whole = (str(tmp_path / x) for x in ("seconds", "groups", "whole"))
    cuts = [first + (last - first) * i // 5 for i in range(5)] + [last + 1]
    runs = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        rollup.store_seconds(seconds.where((F.col("sec") >= a) & (F.col("sec") < b)), source)
        run = rollup.roll_forward(spark, source, target, sessions.KEY, 900, last=i == 4)
        assert runs == [] or runs[-1].end - 900 <= run.start <= runs[-1].end and run.start % 900 == 0
        read = {r.hour for r in rollup.to_read(spark.read.parquet(source), run).select("hour").distinct().collect()}
        assert all(run.start - 3600 < h < run.end for h in read)
        plan = rollup.to_read(spark.read.parquet(source), run)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(hour" in plan and "PushedFilters: [IsNotNull(sec)" in plan
        assert i == 4 or run.end <= b - 1 - 30
        runs.append(run)
        rollup.roll_forward(spark, source, target, sessions.KEY, 900, last=i == 4)  # nothing new: the same windows again
    rollup.store_seconds(seconds, whole)
    rollup.roll_forward(spark, whole, str(tmp_path / "one"), sessions.KEY, 900, last=True)
    a, b = (spark.read.parquet(p) for p in (target, str(tmp_path / "one")))
    assert same(a, b.select(a.columns)) and a.agg(F.sum("b1") + F.sum("b2")).first()[0] == seconds.agg(F.sum("b1") + F.sum("b2")).first()[0]
    assert rollup.roll_forward(spark, whole, str(tmp_path / "none"), sessions.KEY, 900).start == first // 900 * 900
    rollup.store_seconds(seconds.where("1 = 0"), str(tmp_path / "empty"))


def test_a_stream_of_growing_captures(spark, tmp_path):
    packets = [{"us": 1_704_067_200_000_000 + i * 1_000_000 * (1 + 100_000 * (i == 70)), "ip1": i, "port1": 40000 + i, "ip2": 9, "port2": 80, "vlan_id": 0, "bytes": 60 + i, "flags": 2, "ip_proto": 6} for i in range(100)]
    packets.sort(key=lambda p: p["us"])
    data = pcap.struct.pack("<IHHiIII", pcap.MAGIC, 2, 4, 0, 0, 65535, 1) + b"".join(map(pcap.pcap_record, packets))
    pcap.register(spark)
    (tmp_path / "in").mkdir()
    for size, other in ((10, 0), (1000, 500), (1003, 501), (len(data) - 1, 2000), (len(data), len(data))):
        (tmp_path / "in" / "a.pcap").write_bytes(data[:size])
        (tmp_path / "in" / "b.pcap").write_bytes(data[:other])
        stream = spark.readStream.format("pcap").option("chunk", 777).load(f"file://{tmp_path}/in")
        rows = traffic.run_available(stream, str(tmp_path / "out"), "append", "captures")
    assert rows.where("problem is not null").isEmpty()
    for name in ("a", "b"):
        assert sorted(r.us for r in rows.where(F.col("file").endswith(f"{name}.pcap")).collect()) == [p["us"] for p in packets]


def test_a_silent_stream_closes_its_sessions(spark, tmp_path):
    """Packets of now, then none: with beats of the clock the session goes out, without them it stays open."""
    now = int(time.time() * 1_000_000)
    row = (1, now, now // 1_000_000, 10, 40000, 20, 80, 0, 100, 2, 6)
    spark.createDataFrame([row], PACKET).write.parquet(str(tmp_path / "in"))
    found = {}
    for awake in (True, False):
        out = str(tmp_path / f"out{awake}")
        stream = traffic.stream_sessions(traffic.read_stream(spark, str(tmp_path / "in"), PACKET), 2, "1 seconds", 60, awake=awake)
        query = stream.writeStream.foreachBatch(lambda batch, n, out=out: batch.write.mode("overwrite").parquet(f"{out}/b={n}")).option("checkpointLocation", f"{out}-state").trigger(processingTime="1 seconds").start()
        until = time.monotonic() + (60 if awake else 12)
        rows = []
        while time.monotonic() < until and not rows:
            time.sleep(1)
            if (tmp_path / f"out{awake}").exists() and query.recentProgress:
                rows = spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(out).collect()
        query.stop()
        found[awake] = [(r.ip1, r.p1, r.bt, r.pk) for r in rows]
    assert found == {True: [(10, 40000, 100, 1)], False: []}


def test_versions_of_a_table(spark, tmp_path):
    table = kept.VersionedTable(spark, str(tmp_path / "t"))
    for n in range(3):
        assert table.publish(spark.range(n + 1)) == n and kept.VersionedTable(spark, str(tmp_path / "t")).current().count() == n + 1
    table.log.write(3, kept.CLOSED, spark.range(99))  # not published yet
    assert table.current().count() == 3 and table.publish(spark.range(7)) == 3 and table.current().count() == 7
