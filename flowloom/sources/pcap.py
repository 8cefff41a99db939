"""Packets of pcap files, by read_pcap(spark, path).

A file is a 24-byte header and, for each packet, epoch, microseconds, captured and
wire length (32 bits each) and the captured bytes. While packet headers are sane the
reader goes from one to the next, whatever their times: captures have pauses. Where a
header is not sane, it moves on byte by byte to the next that is and whose epoch is
near the last good one, or from which further packets follow. Swapped and
next-generation files are recognised and give one row with the problem.

read_pcap() reads a file in one task, through Spark's binary reader. For large files,
`spark.read.format("pcap")` (after register()) reads chunks of a file in tasks of
their own: a chunk's packets are those whose headers start in it. Packets have no
mark, so a chunk begins at the first place from which CHAIN packet headers follow one
another sanely, and the chunk before ends there.

`spark.readStream.format("pcap")` follows captures while they are written: an offset
names each file and how far its whole packets go, so a packet that is cut at a file's
end waits for the rest of it, in this run or after a restart. A batch is cut into
chunks as above. The driver reads the end of each file that has grown, no more than
TAIL bytes. Files whose size goes back are not read again.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs  # noqa: F401  pa.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

MAGIC, SWAPPED, NEXT_GENERATION = 0xA1B2C3D4, 0xD4C3B2A1, 0x0A0D0D0A
MOST_LENGTH, NEAR_SECONDS, LONG_PAUSE = 65535, 86400, 366 * 86400
#: Packet headers in a row that show where packets stand, and bytes of a file that a task reads.
CHAIN, CHUNK = 8, 64 << 20
#: Bytes that hold the chain, whatever its packets' lengths; bytes at a file's end that show where its last whole packet ends.
MARGIN = (CHAIN + 2) * (16 + MOST_LENGTH)
TAIL = 2 * MARGIN
SCHEMA = "file string, at long, us long, captured int, wire int, pad int, payload binary, problem string"


def sane(micro: int, captured: int, wire: int) -> bool:
    return micro <= 999_999 and captured <= MOST_LENGTH and wire <= MOST_LENGTH


def _near(epoch: int, last: int | None, most: int = NEAR_SECONDS) -> bool:
    return last is None or abs(epoch - last) <= most


def follows(data: bytes, at: int) -> bool:
    """Whether CHAIN packets stand one after another from `at`, none further than LONG_PAUSE from the one before; or as many as there are to the very end of data, or two and one that is cut there."""
    whole, last = 0, None
    while whole < CHAIN:
        if at == len(data):
            return whole > 0
        if at + 16 > len(data):
            return whole > 1
        epoch, micro, captured, wire = struct.unpack_from("<IIII", data, at)
        if not (sane(micro, captured, wire) and 0 < captured <= wire and _near(epoch, last, LONG_PAUSE)):
            return False
        at, last = at + 16 + captured, epoch
        if at > len(data):
            return whole > 1
        whole += 1
    return True


def packets_of(data: bytes) -> Iterator[tuple[int, int | None, int | None, int | None, int | None, bytes | None, str | None]]:
    """(at, us, captured, wire, pad, payload, problem) of every packet, and of every stretch that had to be skipped. What is cut at the end is one stretch, from where it begins."""
    if len(data) < 24:
        yield 0, None, None, None, None, None, "no file header"
        return
    magic = struct.unpack_from("<I", data)[0]
    if magic != MAGIC:
        yield 0, None, None, None, None, None, {SWAPPED: "byte-swapped file", NEXT_GENERATION: "next-generation file"}.get(magic, "unknown format")
        return
    at, last = 24, None
    framed = True  # the place follows from the packet before it
    while at + 16 <= len(data):
        epoch, micro, captured, wire = struct.unpack_from("<IIII", data, at)
        whole, likely = at + 16 + captured <= len(data), sane(micro, captured, wire) and captured <= wire and wire > 0
        if sane(micro, captured, wire) and whole and (_near(epoch, last) or framed and likely or follows(data, at)):
            yield at, epoch * 1_000_000 + micro, captured, wire, max(0, wire - captured), data[at + 16 : at + 16 + captured], None
            at, last, framed = at + 16 + captured, epoch, True
            continue
        start, cut = at, framed and likely and not whole
        at, framed = at + 1, False
        while at + 16 <= len(data):
            epoch, micro, captured, wire = struct.unpack_from("<IIII", data, at)
            if sane(micro, captured, wire) and 0 < captured <= wire and (last is not None and _near(epoch, last) and at + 16 + captured <= len(data) or follows(data, at)):
                break
            at += 1
        found = at + 16 <= len(data)
        if cut and not found:
            at = start
            break
        yield start, None, None, None, None, None, f"skipped {(at if found else len(data)) - start} bytes"
        at = at if found else len(data)
    if at < len(data):
        yield at, None, None, None, None, None, "cut off"


def read_pcap(spark: SparkSession, path: str) -> DataFrame:
    """Packets of all files under a path that Spark's binary reader can open."""

    def run(batches):
        import pandas as pd

        for frame in batches:
            rows = [(path, *p) for path, content in zip(frame["path"], frame["content"], strict=True) for p in packets_of(bytes(content))]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            yield out.astype({"us": "Int64", "captured": "Int32", "wire": "Int32", "pad": "Int32"})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, SCHEMA)


def boundary(data: bytes) -> int | None:
    """The first place in data from which packets follow one another; None if there is none."""
    return next((at for at in range(len(data) - 15) if follows(data, at)), None)


class Chunk(InputPartition):
    """Bytes start to end of a file, of which bytes first to size are read in all; a packet starts at first."""

    def __init__(self, path: str, start: int, end: int, first: int, size: int):
        self.path, self.start, self.end, self.first, self.size = path, start, end, first, size


def chunks_of(path: str, first: int, size: int, chunk: int) -> list[Chunk]:
    return [Chunk(path, i, min(i + chunk, size), first, size) for i in range(first, max(first + 1, size), chunk)]


def captures(uri: str) -> list[pa.fs.FileInfo]:
    """Files at or below a path; names that begin with _ or . are left out."""
    files, path = pa.fs.FileSystem.from_uri(uri)
    info = files.get_file_info(path)
    return [info] if info.is_file else [f for f in files.get_file_info(pa.fs.FileSelector(path, recursive=True)) if f.is_file and not f.base_name.startswith(("_", "."))]


def rows_of(uri: str, part: Chunk) -> Iterator[tuple]:
    """The packets whose headers start in a chunk."""
    files, _ = pa.fs.FileSystem.from_uri(uri)
    with files.open_input_file(part.path) as file:
        # the bytes up to where the next chunk begins: its first packet can start a packet's length later, and CHAIN packets show it
        head = file.read_at(min(24, part.size), 0)
        data = file.read_at(min(part.end + MARGIN, part.size) - part.start, part.start)
    start, stop = 0, part.end - part.start
    if part.start > part.first:
        start = boundary(data)
        if start is None or start >= stop:
            return
    if part.end < part.size:
        following = boundary(data[stop:])
        stop = len(data) if following is None else stop + following
    shift = part.start + start - len(head) if part.start else 0
    for at, *row in packets_of(head + data[start:stop] if part.start else data[:stop]):
        yield (part.path, at + shift, *row)


def whole_packets(uri: str, path: str, size: int) -> int:
    """Where the last whole packet of a file of that size ends."""
    files, _ = pa.fs.FileSystem.from_uri(uri)
    with files.open_input_file(path) as file:
        head, base = file.read_at(24, 0), max(0, size - TAIL)
        data = file.read_at(size - base, base)
    start = boundary(data) if base else 0
    if start is None:
        return size  # no packets in sight: the next batch looks for them from here
    shift = base + start - len(head) if base else 0
    problem = at = None
    for at, *_, problem in packets_of(head + data[start:] if base else data):
        pass
    return at + shift if problem == "cut off" else size


class PcapReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.chunk = options["path"], int(options.get("chunk", CHUNK))

    def partitions(self) -> list[Chunk]:
        return [c for f in captures(self.path) for c in chunks_of(f.path, 0, f.size, self.chunk)]

    def read(self, partition: Chunk) -> Iterator[tuple]:
        return rows_of(self.path, partition)


class PcapStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.chunk = options["path"], int(options.get("chunk", CHUNK))
        self.seen: dict[str, tuple[int, int]] = {}  # size and end of whole packets, so that files that rest aren't read again

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        for f in captures(self.path):
            if f.size >= 24 and self.seen.get(f.path, (0, 0))[0] < f.size:
                self.seen[f.path] = f.size, max(self.seen.get(f.path, (0, 0))[1], whole_packets(self.path, f.path, f.size))
        return {"files": {path: end for path, (_, end) in self.seen.items()}}

    def partitions(self, start: dict, end: dict) -> list[Chunk]:
        before = start["files"]
        return [c for path, to in end["files"].items() if to > before.get(path, 0) for c in chunks_of(path, before.get(path, 0), to, self.chunk)]

    def read(self, partition: Chunk) -> Iterator[tuple]:
        return rows_of(self.path, partition)


class PcapSource(DataSource):
    """Packets of pcap files under a path; option chunk: bytes that a task reads."""

    @classmethod
    def name(cls) -> str:
        return "pcap"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PcapReader:
        return PcapReader(self.options)

    def streamReader(self, schema) -> PcapStreamReader:
        return PcapStreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PcapSource)


#: Optional fields of packets to be written: hardware addresses, a second VLAN tag inside the first, type of service, sequence and acknowledged number, ICMP type and code, and a tunnel ("gre" or "ipip") with its ends.
EXTRA = ["smac", "dmac", "qinq", "tos", "seq", "ack", "icmp_type", "icmp_code", "tunnel", "outer1", "outer2"]


def _ipv4(proto: int, tos: int, ip1: int, ip2: int, body: bytes) -> bytes:
    return struct.pack(">BBHHHBBHII", 0x45, tos, 20 + len(body), 0, 0, 64, proto, 0, ip1, ip2) + body


def pcap_record(packet: dict) -> bytes:
    """A packet as Ethernet with IPv4 and TCP, UDP or ICMP, behind its pcap header; all bytes beyond the headers are cut off."""
    of = lambda name, other=0: other if packet.get(name) is None else packet[name]
    tag = struct.pack(">HH", 0x88A8 if of("qinq") else 0x8100, packet["vlan_id"]) if packet["vlan_id"] else b""
    tag += struct.pack(">HH", 0x8100, of("qinq")) if of("qinq") else b""
    proto = packet["ip_proto"]
    if proto == 6:
        body = struct.pack(">HHIIBBHHH", packet["port1"], packet["port2"], of("seq"), of("ack"), 0x50, packet["flags"], 0, 0, 0)
    elif proto == 1:
        body = struct.pack(">BBHI", of("icmp_type"), of("icmp_code"), 0, 0)
    else:
        body = struct.pack(">HHHH", packet["port1"], packet["port2"], 8, 0)
    inner = _ipv4(proto, of("tos"), packet["ip1"], packet["ip2"], body)
    if of("tunnel", None) == "gre":
        inner = _ipv4(47, of("tos"), of("outer1"), of("outer2"), struct.pack(">HHI", 0x2000, 0x0800, 7) + inner)  # with a key
    elif of("tunnel", None) == "ipip":
        inner = _ipv4(4, of("tos"), of("outer1"), of("outer2"), inner)
    mac = lambda name: of(name, 0x020202020202).to_bytes(6, "big")
    frame = mac("dmac") + mac("smac") + tag + b"\x08\x00" + inner
    return struct.pack("<IIII", packet["us"] // 1_000_000, packet["us"] % 1_000_000, len(frame), max(len(frame), packet["bytes"])) + frame


def named(files: pa.fs.FileSystem, own: str, name: str) -> None:
    """Give a file its name, in place of one that has it."""
    try:
        files.move(own, name)
    except OSError:  # stores that don't replace
        files.delete_file(name)
        files.move(own, name)


def grown(source: DataFrame, folder: str, share: float) -> DataFrame:
    """The first bytes of the files that `source` names (its column file), as large a share of each, below a folder; a file there is replaced by its longer form. A row a file."""

    def run(batches):
        from pyspark import TaskContext

        files, path = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                base = name.rsplit("/", 1)[1]
                own = f"{path}/_{base}-{TaskContext.get().taskAttemptId()}"
                with files.open_input_file(name) as file, files.open_output_stream(own) as out:
                    left = int(file.size() * share)
                    while left:
                        piece = file.read(min(left, 8 << 20))
                        out.write(piece)
                        left -= len(piece)
                named(files, own, f"{path}/{base}")
            yield batch

    return source.select("file").repartition("file").mapInArrow(run, "file string")


def write_pcap(packets: DataFrame, folder: str) -> DataFrame:
    """A file a partition below a folder (with a scheme) that driver and executors share: the files' paths and packets, once they are written. An attempt writes under a name of its own, and the file gets its name when it is whole."""
    names = ["us", "ip1", "port1", "ip2", "port2", "vlan_id", "bytes", "flags", "ip_proto", *(c for c in EXTRA if c in packets.columns)]

    def run(batches):
        from pyspark import TaskContext

        files, path = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(path)
        task = TaskContext.get()
        name, n = f"{path}/part-{task.partitionId():05d}.pcap", 0
        own = f"{path}/_part-{task.partitionId():05d}-{task.taskAttemptId()}"
        with files.open_output_stream(own) as out:
            out.write(struct.pack("<IHHiIII", MAGIC, 2, 4, 0, 0, MOST_LENGTH, 1))
            for batch in batches:
                for packet in batch.to_pylist():
                    out.write(pcap_record(packet))
                    n += 1
        named(files, own, name)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "packets"])

    return packets.select(*names).mapInArrow(run, "file string, packets long")


def ipv4_headers(packets: DataFrame) -> DataFrame:
    """us, vlan_id, ip_proto, ip1, port1, ip2, port2, bytes (wire length) and flags of Ethernet packets with IPv4, from their first bytes."""
    number = lambda i, n: F.conv(F.hex(F.substring("payload", i, n)), 16, 10).cast("long")
    tagged = F.hex(F.substring("payload", 13, 2)) == "8100"
    rows = packets.where("problem is null").withColumn("k", F.when(tagged, 4).otherwise(0))
    at = lambda i: F.col("k") + i
    rows = rows.where(F.hex(F.col("payload").substr(at(13), F.lit(2))) == "0800")
    pick = lambda i, n: F.conv(F.hex(F.col("payload").substr(at(i), F.lit(n))), 16, 10).cast("long")
    body = rows.withColumn("head", pick(15, 1).bitwiseAND(F.lit(15).cast("long")) * 4).withColumn("ip_proto", pick(24, 1).cast("int"))
    port = lambda i: F.conv(F.hex(F.col("payload").substr((at(15) + F.col("head") + i).cast("int"), F.lit(2))), 16, 10).cast("int")
    flags = F.conv(F.hex(F.col("payload").substr((at(15) + F.col("head") + 13).cast("int"), F.lit(1))), 16, 10).cast("int")
    ported = F.col("ip_proto").isin(6, 17)
    return body.select(
        "us",
        F.when(tagged, number(15, 2).bitwiseAND(F.lit(4095).cast("long"))).otherwise(0).cast("int").alias("vlan_id"),
        "ip_proto",
        pick(27, 4).alias("ip1"),
        F.when(ported, port(0)).alias("port1"),
        pick(31, 4).alias("ip2"),
        F.when(ported, port(2)).alias("port2"),
        F.col("wire").cast("long").alias("bytes"),
        F.when(F.col("ip_proto") == 6, flags).alias("flags"),
    )
