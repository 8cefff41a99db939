"""Every registered traffic query with SQL gives that SQL's rows on the small tables."""

from __future__ import annotations

import math
import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from flowloom.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "-"
    return f"{value:.9g}" if isinstance(value, float) else value.isoformat() if hasattr(value, "isoformat") else str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, tables, name):
    df = QUERIES[name](spark, SMALL)
    result = tables.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(names, result.fetchall())


def test_streams_agree_with_batches(spark):
    batch = {tuple(r) for r in QUERIES["JOIN-7_round_trips"](spark, SMALL).select("c_id", "ip1", "ip2", "port", "us", "rtt").collect()}
    stream = {tuple(r) for r in QUERIES["STR-10_streamed_round_trips"](spark, SMALL).collect()}
    assert stream == batch
    throttled = {tuple(r) for r in QUERIES["WIN-5_throttled_names"](spark, SMALL).collect()}
    assert {tuple(r) for r in QUERIES["STR-9_streamed_throttle"](spark, SMALL).collect()} == throttled


def test_late_packets_land_in_later_files(spark):
    """Files of the streams are not in order of time, so equal rows mean that late packets are met."""
    from flowloom.plans import traffic

    packets = traffic.read_packets(spark, "/root/testdata/sf0.01")
    first, last = packets.agg({"us": "min"}).first()[0], packets.agg({"us": "max"}).first()[0]
    arrival = F.col("us") + F.when(F.col("event_id") % 7 == 0, traffic._LATE * 1_000_000).otherwise(0)
    numbered = packets.select("us", traffic._slice(arrival, first, last).alias("file"), traffic._slice(F.col("us"), first, last).alias("own"))
    assert numbered.where("file > own").count() > 0 and numbered.select("file").distinct().count() == traffic._FILES


@pytest.mark.parametrize("rows_a_batch", [3, 10_000])
def test_starts_that_follow_from_one_another(spark, rows_a_batch):
    from flowloom.operators.ordered import with_starts

    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice(["a", None]), rng.randint(0, 200)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k long, s string, t long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
    try:
        got = sorted((tuple(r) for r in with_starts(df, ["k", "s"], "t", 17).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, start = [], {}
    for k, s, t in sorted(rows, key=lambda r: r[2]):
        if (k, s) not in start or t >= start[k, s] + 17:
            start[k, s] = t
        want.append((k, s, t, start[k, s]))
    assert got == sorted(want, key=str)
    assert with_starts(df.where("1 = 0"), ["k"], "t", 17).count() == 0


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_neighbours_across_slices(spark, width):
    """Row before, row after and last value against lists, with null keys, ties, null values and gaps of many slices."""
    from flowloom.operators.slices import with_last, with_neighbour

    rng = random.Random(9)
    rows = [(rng.choice([None, 1, 2]), rng.choice(["a", None]), rng.choice([-30, 0, 1, 2, 3, 5, 5, 90, 91, 4000]) + rng.randint(0, 3), i, rng.choice([None, None, i])) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, s string, t long, i long, v long").repartition(3)
    want = {}
    last = {}
    for k, s in {(r[0], r[1]) for r in rows}:
        own = sorted((r for r in rows if r[:2] == (k, s)), key=lambda r: (r[2], r[3]))
        for n, r in enumerate(own):
            last[k, s] = r[4] if r[4] is not None else last.get((k, s))
            want[r[3]] = (own[n - 1][4] if n else None, own[n + 1][4] if n + 1 < len(own) else None, last[k, s])
    got = with_neighbour(df, ["k", "s"], ["t", "i"], F.col("v"), "before", width=width)
    got = with_neighbour(got, ["k", "s"], ["t", "i"], F.col("v"), "after", ahead=True, width=width)
    got = with_last(got, ["k", "s"], ["t", "i"], F.col("v"), "last", width=width)
    assert got.columns == [*df.columns, "before", "after", "last"]
    assert {r.i: (r.before, r.after, r.last) for r in got.collect()} == want and got.count() == len(rows)
    assert with_last(df.where("1 = 0"), ["k"], ["t"], F.col("v"), "last").count() == 0


def test_one_key_in_many_tasks(spark):
    """A key that holds all rows is worked on in several tasks, with the rows that a window over it gives."""
    from pyspark.sql import Window

    from flowloom.operators import icmp, latency, sessions
    from flowloom.sources.packets import read_packets

    packets = read_packets(spark, SMALL).withColumns({"ip1": F.when(F.col("event_id") % 3 == 0, 9).otherwise(5).cast("long"), "ip2": F.when(F.col("event_id") % 3 == 0, 5).otherwise(9).cast("long"), "port1": F.when(F.col("event_id") % 3 == 0, 80).otherwise(40000), "port2": F.when(F.col("event_id") % 3 == 0, 40000).otherwise(80), "vlan_id": F.lit(0), "ip_proto": F.lit(6)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = lambda df: len(df.select(F.spark_partition_id().alias("p"), F.hash(*df.columns).alias("h")).groupBy("p").agg(F.max("h")).collect())
        probes = latency.probes(packets)
        assert probes.select(*latency.KEY).distinct().count() == 1
        found = latency.matched(probes, 60)
        order = Window.partitionBy(*latency.KEY).orderBy("us", "event_id")
        plain = probes.withColumn("r", F.lead("reply").over(order)).withColumn("u", F.lead("us").over(order)).where("not reply")
        plain = plain.withColumn("rtt", F.expr("if(r and u - us <= 60000000, u - us, null)")).where("rtt is null or rtt > 0").select(found.columns)
        assert tasks(found) >= 4 and found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
        gaps = sessions.sessionized(packets, 20)
        assert tasks(gaps) >= 4 and gaps.groupBy("tb").count().exceptAll(sessions.session_info(packets, 20).selectExpr("tb", "pk as count")).isEmpty()
        echoes = packets.selectExpr("event_id", "us", "ip1", "ip2", "bytes", "vlan_id", "if(event_id % 3 = 0, '0.0', '8.0') as typecode", "1 as seq")
        assert tasks(icmp.adopted(echoes)) >= 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("name", ["JOIN-8_adopted_types", "AGG-22_icmp_type_sets", "AGG-17_icmp_groups"])
def test_lines_are_parsed_once(spark, name):
    """Replies are looked for in two readings of the packets, neither of which parses lines."""
    from flowloom.plans import registry

    plan = registry.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "inline" not in plan and "split(" not in plan


def test_seconds_give_the_sessions_of_packets(spark):
    """Sessions from seconds against sessions packet by packet, with gaps of just the length and ties of time."""
    from flowloom.operators import sessions
    from flowloom.sources.packets import read_packets

    packets = read_packets(spark, "/root/testdata/sf0.01")
    for gap in (1, 20, 120):
        by_packet = sessions.sessionized(packets, gap).groupBy(*sessions.KEY, "sec", "tb").agg(F.sum(F.when(F.col("from_client"), F.col("bytes")).otherwise(0)).alias("b1"), F.count("*").alias("pk"))
        by_second = sessions.session_seconds(packets, gap)
        if gap > 1:
            assert by_packet.select(*sessions.KEY, "sec", "tb", "b1", "pk").exceptAll(by_second.select(*sessions.KEY, "sec", "tb", "b1", "pk")).isEmpty()
        assert by_packet.count() == by_second.count()


def test_sessions_merge_from_parts(spark):
    from flowloom.operators import sessions
    from flowloom.sources.packets import read_packets

    packets = read_packets(spark, SMALL)
    parts = [sessions.partial_sessions(packets.where(f"event_id % 7 = {i}"), 20) for i in range(7)]
    together = parts[0]
    for p in parts[1:]:
        together = together.unionByName(p)
    merged = sessions.from_parts(sessions.merged_sessions(together, 20), 60)
    whole = sessions.session_info(packets, 20, 60)
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()


def test_ranges_meet_the_narrowest(spark):
    from flowloom.operators import enrich

    rng = random.Random(2)
    ranges = [(a, a + rng.choice([0, 5, 300, 70_000, 200_000]), f"r{i}") for i, a in enumerate(rng.randint(0, 400_000) for _ in range(40))]
    ips = [rng.randint(-5, 700_000) for _ in range(500)] + [None]
    df, table = spark.createDataFrame([(i,) for i in ips], "ip long"), spark.createDataFrame(ranges, "start long, end long, name string")
    want = sorted((ip, min(((e - s, s, n) for s, e, n in ranges if ip is not None and s <= ip <= e), default=(0, 0, None))[2]) for ip in ips if ip is not None)
    for broadcast in (0, 100_000):
        got = [tuple(r) for r in enrich.in_ranges(df, "ip", table, ["name"], broadcast=broadcast).collect()]
        assert sorted(g for g in got if g[0] is not None) == want and len(got) == len(ips)


def test_bytes_are_conserved(spark):
    from flowloom.operators import groups, sessions
    from flowloom.sources.packets import read_packets

    packets = read_packets(spark, SMALL)
    total = packets.agg({"bytes": "sum"}).first()[0]
    assert sessions.session_info(packets, 20).agg({"bt": "sum"}).first()[0] == total
    doc = sessions.byte_documents(packets).selectExpr("sum(doc_lo + doc_hi)", "max(se - sb)", "min(b[0].offset)", "max(b[0].offset)").first()
    assert doc[0] == total and doc[1] < 20 and doc[2] == doc[3] == 0
    short = groups.bins(groups.conversation_bytes(packets, 20), groups.SHORT)
    assert short.selectExpr("sum(b1 + b2)").first()[0] == total
    assert groups.coarser(short).selectExpr("sum(b1 + b2)").first()[0] == total


def test_direction_does_not_change_keys(spark):
    from flowloom.operators.sessions import KEY, with_session_key
    from flowloom.sources.packets import read_packets

    packets = read_packets(spark, SMALL)
    turned = packets.selectExpr("event_id", "us", "sec", "ip2 as ip1", "port2 as port1", "ip1 as ip2", "port1 as port2", "vlan_id", "bytes", "flags", "ip_proto")
    a, b = (with_session_key(p).select("event_id", *KEY) for p in (packets, turned))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_scan_reads_what_it_needs(spark):
    from flowloom.sources.packets import read_packets

    plan = read_packets(spark, SMALL, 6).select("us", "bytes")._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema")[1]
    assert "props" not in schema and "event_type" not in schema


def test_owners_of_the_widest_range(spark, monkeypatch):
    from flowloom.plans import scalars

    rows = spark.createDataFrame([(1, 134217730), (2, 134744065), (3, 167772161), (4, 5)], "event_id long, ip2 long")
    monkeypatch.setattr(scalars, "read_packets", lambda *_: rows)
    assert {tuple(r) for r in scalars.owners(spark, "").collect()} == {(1, 3356, "Carrier"), (2, 15169, "Search"), (3, 64512, "Lab"), (4, None, None)}


def test_stored_by_day(spark, tmp_path):
    """Filters on day and kind leave folders out, one on the key is pushed down, and files of a day hold ranges of their own."""
    from flowloom.operators import maintenance

    rows = spark.range(4000).selectExpr("id", "cast(id % 2 as int) as kind", "id * 7919 % 4000 as ip", "86400 * (id % 3) + id as tem")
    maintenance.store_by_day(rows, str(tmp_path / "t"), "tem", "kind", ["ip"])
    found = spark.read.parquet(str(tmp_path / "t")).where("day = 1 and kind = 0 and ip between 100 and 200")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(ip,100)" in plan
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in rows.where("floor(tem / 86400) = 1 and kind = 0 and ip between 100 and 200").collect())
    spans = spark.read.parquet(str(tmp_path / "t")).groupBy("day", "kind", F.input_file_name().alias("f")).agg(F.min("ip").alias("a"), F.max("ip").alias("b")).collect()
    for r in spans:
        assert not any(x.day == r.day and x.kind == r.kind and x.f != r.f and x.a <= r.b and r.a <= x.b for x in spans)
    assert {(r.day, r.kind) for r in spans} >= {(d, k) for d in range(3) for k in range(2)}


def test_sizes_of_stored_files(spark, tmp_path):
    from flowloom.operators import maintenance

    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "a"))
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "b"))
    read = {name: spark.read.parquet(str(tmp_path / name)) for name in "ab"}
    got = {r.name: r for r in maintenance.stored_sizes(read | {"none": read["a"].where("id < 0")}).collect()}
    for name, rows in (("a", 1000), ("b", 5)):
        files = list((tmp_path / name).glob("*.parquet"))
        total = sum(f.stat().st_size for f in files)
        assert (got[name].files, got[name].bytes, got[name].mean_size) == (len(files), total, round(total / rows, 3))
    assert (got["none"].files, got["none"].bytes, got["none"].mean_size) == (0, 0, None)


def test_entry_and_names():
    import __spark_entry__ as e

    assert set(SQL) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
