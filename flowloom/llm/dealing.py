"""Dealing packed arrays to buckets and documents to the buckets of what was found in them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from flowloom.llm.common import map_batches, slices

#: A place: a document and a position in it.
PLACE = np.dtype([("doc", "<i8"), ("pos", "<i4")])
ENTRY = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("pos", "<i4")])
#: Rows of packed arrays: entries still to be met by bucket of their hash, or places already decided.
PACKED = "bucket int, kind int, payload binary"
MEET, DECIDED = 0, 1  # of a document's rows the decided come before its text


def bucket_count(spark: SparkSession) -> int:
    """Buckets: about as many as shuffle partitions, a prime number so that doc_id modulo it is even."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) | 1
    while any(n % d == 0 for d in range(3, int(n**0.5) + 1, 2)):
        n += 2
    return n


def pack(values: np.ndarray) -> bytes:
    """The fields of a structured array one after the other, compressed."""
    raw = b"".join([np.ascontiguousarray(values[f]).tobytes() for f in values.dtype.names])
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpack(payload: bytes, dtype: np.dtype) -> np.ndarray:
    n = int.from_bytes(payload[:8], "little")
    raw, at, out = pa.Codec("zstd").decompress(payload[8:], n * dtype.itemsize, asbytes=True), 0, np.empty(n, dtype)
    for f in dtype.names:
        size = dtype[f].itemsize
        out[f] = np.frombuffer(raw, dtype[f], n, at)
        at += n * size
    return out


def split_by(values: np.ndarray, bucket: np.ndarray, kind: int) -> list[tuple[int, int, bytes]]:
    """Rows of PACKED, one a bucket."""
    if not len(values):
        return []
    order = np.argsort(bucket, kind="stable")
    values, bucket = values[order], bucket[order]
    full, first = np.unique(bucket, return_index=True)
    return [(int(b), kind, pack(values[i:j])) for b, i, j in zip(full, first, [*first[1:], len(values)], strict=True)]


def by_document(places: np.ndarray) -> Callable[[int], np.ndarray]:
    """The distinct places of a document, sorted, by the document. What stands for other documents is not gone over again for each."""
    names = places.dtype.names
    if not len(places):
        return lambda doc: places
    doc, others = places[names[0]], [places[f] for f in names[:0:-1]]
    low = doc.min()
    if int(doc.max()) - int(low) < 2**31:  # one number sorts several times as fast as two
        key = ((doc - low) << 32) + others[-1]
        order = np.lexsort([*others[:-1], key]) if len(others) > 1 else np.argsort(key)
    else:
        order = np.lexsort([*others, doc])
    places = places.take(order)
    same = np.all([places[f][1:] == places[f][:-1] for f in names], axis=0)
    if same.any():
        places = places[np.append(True, ~same)]
    doc = np.ascontiguousarray(places[names[0]])
    at = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    ends = dict(zip(doc[at].tolist(), zip(at.tolist(), [*at[1:].tolist(), len(places)], strict=True), strict=True))
    return lambda doc: places[slice(*ends.get(doc, (0, 0)))]


def packed(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "payload"])


def met(df: DataFrame, settle: Callable[[dict[int, list[bytes]]], np.ndarray], buckets: int, dtype: np.dtype = PLACE, most: int = 2_000_000) -> DataFrame:
    """From PACKED rows: the places (of the dtype) that settle() finds in all payloads of a bucket, by kind, and those already decided, packed by bucket of the document. A task gathers places up to `most` before it packs them, so that rows stay few."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        places: list[np.ndarray] = []
        of = None

        def gathered(least: int) -> Iterator[pa.RecordBatch]:
            if places and sum(map(len, places)) >= least:
                together = np.concatenate(places)
                places.clear()
                if len(together):
                    yield packed(split_by(together, together["doc"] % buckets, DECIDED))

        for batch in batches:
            for bucket, kind, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == DECIDED:
                    places.append(unpack(payload, dtype))
                    continue
                if bucket != of and held:
                    places.append(settle(held))
                    held = {}
                of = bucket
                held.setdefault(kind, []).append(payload)
            yield from gathered(most)
        if held:
            places.append(settle(held))
        yield from gathered(0)

    return df.repartition("bucket").sortWithinPartitions("bucket").transform(map_batches, run, PACKED)


#: Kind of rows that hold documents: ids and texts as an Arrow stream, compressed, since texts are most of what is dealt.
_TEXTS = 2


def _dealt_texts(docs: DataFrame, buckets: int) -> DataFrame:
    """PACKED rows of the documents, by bucket of doc_id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for part, _ in slices(batches, chars=12_000_000):
            part = part.select(["doc_id", "text"])
            bucket = np.mod(part.column(0).to_numpy(), buckets)
            order = np.argsort(bucket, kind="stable")
            full, first = np.unique(bucket[order], return_index=True)
            rows = []
            for b, i, j in zip(full.tolist(), first, [*first[1:], len(order)], strict=True):
                sink = pa.BufferOutputStream()
                some = part.take(pa.array(order[i:j]))
                with pa.ipc.new_stream(sink, some.schema) as writer:
                    writer.write_batch(some)
                raw = sink.getvalue()
                rows.append((b, _TEXTS, raw.size.to_bytes(8, "little") + codec.compress(raw, asbytes=True)))
            yield packed(rows)

    return docs.select("doc_id", "text").transform(map_batches, run, PACKED)


def _texts_in(payload: bytes) -> pa.Table:
    raw = pa.Codec("zstd").decompress(payload[8:], int.from_bytes(payload[:8], "little"))
    return pa.ipc.open_stream(raw).read_all()


def with_places(docs: DataFrame, places: DataFrame, buckets: int, work: Callable, schema: str, dtype: np.dtype = PLACE, chars: int = 4_000_000) -> DataFrame:
    """work(ids, texts, of) for parts of docs (doc_id, text), where of(id) are the distinct places (of the dtype, its first field the document) sent for a document, sorted; it returns record batches of the schema."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of, places_of = [], None, None
        ids, texts, size = [], [], 0

        for batch in batches:
            for bucket, kind, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != of:
                    if texts:
                        yield from work(ids, texts, places_of)
                    ids, texts, size = [], [], 0
                    held, of, places_of = [], bucket, None
                if kind != _TEXTS:
                    held.append(unpack(payload, dtype))
                    continue
                if places_of is None:
                    places_of = by_document(np.concatenate([np.empty(0, dtype), *held]))
                    held = []
                for part, more in slices(_texts_in(payload).to_batches(), chars=chars):
                    if texts and size + sum(map(len, more)) > chars:
                        yield from work(ids, texts, places_of)
                        ids, texts, size = [], [], 0
                    ids += part.column(0).to_pylist()
                    texts += more
                    size += sum(map(len, more))
        if texts:
            yield from work(ids, texts, places_of)

    both = places.union(_dealt_texts(docs, buckets))
    return both.repartition("bucket").sortWithinPartitions("bucket", "kind").transform(map_batches, run, schema)
