"""Exact removal of repeated byte strings with sharded suffix arrays.

Every byte that lies in a string of LENGTH bytes which also starts elsewhere goes.
To keep suffix arrays small and apart, windows of LENGTH bytes are led together by
anchors: the least hash of GRAM bytes inside the window, so equal windows have equal
anchors. An anchor that occurs once has no repeated window. Around the others lie
contexts, the bytes that windows with this anchor can reach. Contexts that are equal
as a whole are repeated as a whole; of the different contexts of an anchor, one each
goes to a shard. The shard is that of the stretch of text where the anchor stands
first, so that neighbouring anchors go together and their contexts, which overlap,
are joined. A shard's contexts make one string; its suffix array comes from
induced sorting, and a window is repeated if a neighbour in suffix order, of another
place, shares LENGTH bytes (permuted common prefixes). An anchor with more than
CROWD different contexts (a passage that very many documents hold) would fill one
shard; the windows of its contexts are met by their hash instead, spread over all.

Batches first meet their own contexts and pass on one of each. Hashes, of 64 bits,
only choose; in shards bytes decide. Null and empty texts have no bytes. Rows
without doc_id keep all their bytes and take none from others. Repeated rows count
as one document; texts that share a doc_id share what is decided at a position, so
ids should be unique.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import documents, map_batches, slices
from flowloom.llm.dealing import DECIDED, MEET, PACKED, bucket_count, met, packed, split_by, unpack, with_places
from flowloom.llm.suffix_arrays import common_prefixes, suffix_array
from flowloom.llm.words import mix

LENGTH, GRAM, CROWD, STRETCH = 200, 40, 2000, 1024
REACH = LENGTH - GRAM  # bytes of a window beyond its anchor

#: An anchor's occurrence: its hash, the hash of its context, whether the context is known to repeat.
_ANCHOR = np.dtype([("hash", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("pos", "<i4"), ("many", "i1")])
#: What is decided for a document: kind COVER, bytes [pos, end) are repeated windows; SHARD or CROWDED, the anchor at pos needs its context looked into; hash is its shard.
_FOUND = np.dtype([("doc", "<i8"), ("pos", "<i4"), ("end", "<i4"), ("hash", "<u8"), ("kind", "i1")])
_WINDOW = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("pos", "<i4")])
COVER, SHARD, CROWDED = 0, 1, 2
_weights = np.random.default_rng(20240202).integers(0, 2**63, 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Bytes:
    """Texts end to end, with hashes of their strings of GRAM and LENGTH bytes. Eight bytes are mixed as one number, five of these make a gram and five grams a window, so that no pattern of bytes cancels out."""

    def __init__(self, encoded: list[bytes]):
        joined = b"".join(encoded)
        self.data = np.frombuffer(joined, np.uint8)
        self.lengths = np.array([len(e) for e in encoded], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        n = len(joined) - GRAM + 1
        self.grams = np.empty(0, np.uint64)
        if n > 0:
            # in place: fresh arrays of this size cost more than the arithmetic
            eights = np.ndarray(len(joined) - 7, "<u8", joined, strides=(1,)) * _weights[10]
            rest = eights >> np.uint64(32)
            eights ^= rest
            total, product = np.zeros(n, np.uint64), rest[:n]
            for j in range(GRAM // 8):
                np.multiply(eights[8 * j : 8 * j + n], _weights[j], out=product)
                total += product
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                np.right_shift(total, np.uint64(shift), out=product)
                total ^= product
                total *= np.uint64(factor)
            np.right_shift(total, np.uint64(31), out=product)
            total ^= product
            self.grams = total

    def windows(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the LENGTH bytes from each place."""
        total = np.zeros(len(at), np.uint64)
        for j in range(LENGTH // GRAM):
            total += self.grams[at + GRAM * j] * _weights[5 + j]
        return mix(total)

    def contexts(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of strings of LENGTH to 2 * LENGTH bytes: by their first and last LENGTH, which hold all of them, and their length."""
        return mix(self.windows(begin) * _weights[10] + self.windows(end - LENGTH) * _weights[11] + (end - begin).astype(np.uint64))

    def anchors(self) -> np.ndarray:
        """Positions of the least gram hashes of all windows of LENGTH bytes in one text."""
        n, w = len(self.data), REACH + 1
        grams = n - GRAM + 1
        if grams < w:
            return np.empty(0, np.int64)
        hashes = self.grams | np.uint64(1)
        least = _sliding(hashes, w, np.minimum)  # of each window start
        owner_end = np.repeat(self.starts + self.lengths, self.lengths)[: len(least)]
        least = np.where(np.arange(len(least)) + LENGTH <= owner_end, least, np.uint64(0))
        padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
        return np.flatnonzero(_sliding(padded, w, np.maximum)[:grams] == hashes)


def _sliding(x: np.ndarray, w: int, f) -> np.ndarray:
    """f (a minimum or maximum) over every w values in a row, by runs of twice the length each time."""
    size = 1
    while 2 * size <= w:
        x = f(x[:-size], x[size:])
        size *= 2
    return f(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def _found(doc, pos, end, hashes, kind) -> np.ndarray:
    out = np.empty(len(doc), _FOUND)
    out["doc"], out["pos"], out["end"], out["hash"], out["kind"] = doc, pos, end, hashes, kind
    return out


def _sorted(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors by hash, context and place, one of each (a repeated row has the same); starts and sizes of the runs of one context."""
    entries = entries[np.lexsort((entries["pos"], entries["doc"], entries["context"], entries["hash"]))]
    fresh = np.ones(len(entries), bool)
    fresh[1:] = np.any([entries[f][1:] != entries[f][:-1] for f in ("hash", "context", "doc", "pos")], axis=0)
    entries = entries[fresh]
    first = np.ones(len(entries), bool)
    first[1:] = (entries["hash"][1:] != entries["hash"][:-1]) | (entries["context"][1:] != entries["context"][:-1])
    starts = np.flatnonzero(first)
    return entries, starts, np.diff(starts, append=len(entries))


def _covers(entries: np.ndarray) -> np.ndarray:
    return _found(entries["doc"], np.maximum(0, entries["pos"] - REACH), entries["pos"] + LENGTH, 0, COVER)


def anchored(docs: DataFrame, buckets: int) -> DataFrame:
    """Anchors of docs with hashes of their contexts; contexts met twice in a batch are decided and go on once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, chars=2_000_000):
            b = Bytes([t.encode() for t in texts])
            at = b.anchors()
            owner = np.searchsorted(b.starts + b.lengths, at, side="right")
            entries = np.empty(len(at), _ANCHOR)
            begin, end = np.maximum(b.starts[owner], at - REACH), np.minimum(b.starts[owner] + b.lengths[owner], at + LENGTH)
            entries["hash"], entries["context"] = b.grams[at], b.contexts(begin, end) ^ mix((at - begin).astype(np.uint64))
            entries["doc"], entries["pos"], entries["many"] = part.column(0).to_numpy()[owner], at - b.starts[owner], 0
            entries, starts, sizes = _sorted(entries)
            heads = entries[starts].copy()
            heads["many"] = sizes > 1
            found = _covers(entries[np.repeat(sizes > 1, sizes)])
            rows = split_by(heads, (heads["hash"] % np.uint64(buckets)).astype(np.int64), MEET) + split_by(found, found["doc"] % buckets, DECIDED)
            if rows:
                yield packed(rows)

    return docs.transform(map_batches, run, PACKED)


def _contexts_met(crowd: int):
    def settle(payloads: dict[int, list[bytes]]) -> np.ndarray:
        entries, starts, sizes = _sorted(np.concatenate([unpack(p, _ANCHOR) for p in payloads[MEET]]))
        found = [_covers(entries[np.repeat(sizes > 1, sizes)])]
        heads = entries[starts]
        fresh = np.ones(len(heads), bool)
        fresh[1:] = heads["hash"][1:] != heads["hash"][:-1]
        groups = np.diff(np.flatnonzero(fresh), append=len(heads))
        different = np.repeat(groups, groups)
        # the group's first place by document and position names its shard
        group = np.repeat(np.arange(len(groups)), groups)
        first = np.lexsort((heads["pos"], heads["doc"], group))[np.cumsum(groups) - groups]
        shard = mix(mix(heads["doc"][first].view(np.uint64)) + (heads["pos"][first] // STRETCH).astype(np.uint64))[group]
        for kind, which in ((SHARD, (different > 1) & (different <= crowd)), (CROWDED, different > crowd)):
            h = heads[which]
            found.append(_found(h["doc"], h["pos"], 0, shard[which], kind))
        return np.concatenate(found)

    return settle


#: Payload kinds of what is looked into: contexts for shards, windows by hash.
_CONTEXTS, _WINDOWS = 2, 3
_CONTEXT = np.dtype([("doc", "<i8"), ("begin", "<i4"), ("size", "<i4")])


def _looked_into(buckets: int):
    def work(ids: list[int], texts: list[str], of) -> Iterator[pa.RecordBatch]:
        encoded = [t.encode() for t in texts]
        rows, by_bucket = [], {}
        windows: list[np.ndarray] = []
        covers: list[np.ndarray] = []
        for doc, data in zip(ids, encoded, strict=True):
            found = of(doc)
            cover = found[found["kind"] == COVER]
            if len(cover):
                covers.append(cover)
            need = found[found["kind"] == SHARD]  # by position
            joined: dict[int, list[list[int]]] = {}
            for p, to in zip(need["pos"].tolist(), (need["hash"] % np.uint64(buckets)).tolist(), strict=True):
                begin, end = max(0, p - REACH), min(len(data), p + LENGTH)
                if p + GRAM <= len(data) and end - begin >= LENGTH:
                    spans = joined.setdefault(to, [])
                    if spans and begin <= spans[-1][1]:
                        spans[-1][1] = max(end, spans[-1][1])
                    else:
                        spans.append([begin, end])
            for to, spans in joined.items():
                by_bucket.setdefault(to, []).extend([(doc, begin, data[begin:end]) for begin, end in spans])
            crowded = found[found["kind"] == CROWDED]["pos"].astype(np.int64)
            crowded = crowded[crowded + GRAM <= len(data)]
            if len(crowded) and len(data) >= LENGTH:
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, np.maximum(0, crowded - REACH), 1)
                np.add.at(edge, np.minimum(crowded, len(data) - LENGTH) + 1, -1)
                at = np.flatnonzero(np.cumsum(edge) > 0)
                out = np.empty(len(at), _WINDOW)
                out["hash"], out["doc"], out["pos"] = Bytes([data]).windows(at), doc, at
                windows.append(out)
        for to, contexts in by_bucket.items():
            head = np.array([(d, b, len(x)) for d, b, x in contexts], _CONTEXT)
            rows.append((to, _CONTEXTS, len(contexts).to_bytes(4, "little") + head.tobytes() + b"".join(x for _, _, x in contexts)))
        if windows:
            heads, decided = _repeated_windows(np.concatenate(windows))
            rows += split_by(heads, (heads["hash"] % np.uint64(buckets)).astype(np.int64), _WINDOWS)
            covers.append(decided)
        if covers:
            covered = np.concatenate(covers)
            rows += split_by(covered, covered["doc"] % buckets, DECIDED)
        if rows:
            yield packed(rows)

    return work


def _repeated_windows(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One window of each hash (position -1 - pos if it is known to repeat), and what is covered by those that repeat."""
    place = np.where(windows["pos"] < 0, -1 - windows["pos"], windows["pos"])
    order = np.lexsort((windows["pos"] >= 0, place, windows["doc"], windows["hash"]))
    windows, place = windows[order], place[order]
    first = np.ones(len(windows), bool)
    first[1:] = windows["hash"][1:] != windows["hash"][:-1]
    starts = np.flatnonzero(first)
    sizes = np.diff(starts, append=len(windows))
    head = np.repeat(starts, sizes)
    other = (windows["doc"] != windows["doc"][head]) | (place != place[head]) | (windows["pos"] < 0)
    many = np.bitwise_or.reduceat(other, starts) if len(starts) else np.empty(0, bool)
    heads = windows[starts].copy()
    heads["pos"] = np.where(many, -1 - place[starts], place[starts])
    which = np.repeat(many, sizes)
    return heads, _ranges(windows["doc"][which], place[which])


def _ranges(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """What the windows at these places cover, in runs."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order].astype(np.int64)
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + LENGTH)
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(doc)) - 1 if len(at) else at
    return _found(doc[at], start[at], start[last] + LENGTH, 0, COVER)


def repeated_in_shard(contexts: list[tuple[np.ndarray, bytes]]) -> np.ndarray:
    """Covers of the windows that stand at several places of the contexts (heads, bytes)."""
    head = np.concatenate([h for h, _ in contexts])
    data = np.frombuffer(b"".join(b for _, b in contexts), np.uint8)
    sizes = head["size"].astype(np.int64)
    n = len(data) + len(head)
    ends = np.cumsum(sizes + 1)
    text = np.ones(n, bool)
    text[ends - 1] = False
    s = np.ones(n + 1, np.int64)
    s[:n][text] = data.astype(np.int64) + 2
    s[n] = 0
    order = suffix_array(s, 258)
    raw = np.zeros(n + 1, np.uint8)
    raw[:n][text] = data
    owner = np.repeat(np.arange(len(head)), sizes + 1)
    within = np.arange(n) - (ends - sizes - 1)[owner]
    inside = np.zeros(n + 1, bool)
    inside[:n] = within + LENGTH <= sizes[owner]
    shared = common_prefixes(raw, order, LENGTH, inside)
    # classes of equal windows are runs in suffix order
    ordered = order[inside[order]]
    joined = np.zeros(len(order), np.int64)
    joined[1:] = np.cumsum((shared[order[1:]] < LENGTH) | ~inside[order[1:]] | ~inside[order[:-1]])
    run = joined[inside[order]]
    doc, place = head["doc"][owner[ordered]], head["begin"][owner[ordered]] + within[ordered]
    if not len(run):
        return np.empty(0, _FOUND)
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    length = np.diff(starts, append=len(run))
    lead = np.repeat(starts, length)
    many = np.bitwise_or.reduceat((doc != doc[lead]) | (place != place[lead]), starts)
    which = np.repeat(many, length)
    return _ranges(doc[which], place[which])


def _shards_settled():
    def settle(payloads: dict[int, list[bytes]]) -> np.ndarray:
        found = [np.empty(0, _FOUND)]
        if _WINDOWS in payloads:
            found.append(_repeated_windows(np.concatenate([unpack(p, _WINDOW) for p in payloads[_WINDOWS]]))[1])
        contexts = []
        for p in payloads.get(_CONTEXTS, []):
            n = int.from_bytes(p[:4], "little")
            cut = 4 + n * _CONTEXT.itemsize
            contexts.append((np.frombuffer(p[4:cut], _CONTEXT), p[cut:]))
        if contexts:
            found.append(repeated_in_shard(contexts))
        return np.concatenate(found)

    return settle


def covered_ranges(docs: DataFrame, buckets: int, crowd: int = CROWD) -> DataFrame:
    """Byte ranges of docs that repeated windows cover, packed by document."""
    contexts = met(anchored(docs, buckets), _contexts_met(crowd), buckets, _FOUND)
    looked = with_places(docs, contexts, buckets, _looked_into(buckets), PACKED, _FOUND)
    return met(looked, _shards_settled(), buckets, _FOUND)


def _kept(ids: list[int], texts: list[str], of) -> Iterator[pa.RecordBatch]:
    n_bytes, removed, spans, kept = [], [], [], []
    for doc, text in zip(ids, texts, strict=True):
        data = text.encode()
        found, n = of(doc), len(data)
        n_bytes.append(n)
        begin, end = np.minimum(found["pos"], n), np.minimum(found["end"], n)
        begin, end = begin[begin < end], end[begin < end]
        if not len(begin):
            removed.append(0)
            spans.append(0)
            kept.append(data)
            continue
        # by position: a run goes on to the furthest end so far
        furthest = np.maximum.accumulate(end)
        first = np.flatnonzero(np.concatenate([[True], begin[1:] > furthest[:-1]]))
        begin, end = begin[first].tolist(), furthest[np.append(first[1:], len(furthest)) - 1].tolist()
        removed.append(sum(end) - sum(begin))
        spans.append(len(begin))
        kept.append(b"".join([data[i:j] for i, j in zip([0, *end], [*begin, n], strict=True)]))
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeated_bytes(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes that stay) of every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    buckets = bucket_count(docs.sparkSession)
    with_id = docs.where("doc_id is not null")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    trimmed = with_places(with_id, covered_ranges(with_id, buckets, crowd), buckets, _kept, schema, _FOUND)

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            yield from _kept(part.column(0).to_pylist(), texts, lambda _: np.empty(0, _FOUND))

    return trimmed.union(docs.where("doc_id is null").transform(map_batches, whole, schema))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
