"""Substring dedup on words with difference-cover anchors.

A window is WINDOW words in a row. Anchors are hashes of ANCHOR words, taken only at
positions that are, modulo PERIOD, in the difference cover COVER: any two positions
have a common shift below PERIOD that puts both in the cover. So of two equal
windows, wherever they stand, some anchor inside has the same place in both, and
windows without an anchor that occurs twice are unique. The other windows, those that
extend such an anchor, are then met by the hash of the whole window; all but the
first (least doc_id, then start) are repeats, and their words go.

Batches first meet their own anchors and windows and pass on one of each, so a
passage that very many documents share stays small. Hashes are of 64 bits.

Null and empty texts have no words. Rows without doc_id keep all their words and
take no words from others. Repeated rows count as one document; texts that share a
doc_id share what is decided at a position, so ids should be unique.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import documents, map_batches, slices
from flowloom.llm.dealing import DECIDED, ENTRY, MEET, PACKED, PLACE, bucket_count, met, packed, split_by, unpack, with_places
from flowloom.llm.words import Words, windows, words_of

WINDOW, ANCHOR, PERIOD = 20, 8, 13
COVER = (0, 1, 3, 9)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def _entries(hashes: np.ndarray, at: np.ndarray, w: Words, ids: np.ndarray) -> np.ndarray:
    out = np.empty(len(at), ENTRY)
    out["hash"], out["doc"], out["pos"] = hashes[at], ids[w.owner[at]], w.position[at]
    return out


def _groups(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries by hash; where groups of a hash start; group sizes."""
    order = np.argsort(entries["hash"])
    entries = entries[order]
    first = np.ones(len(entries), bool)
    first[1:] = entries["hash"][1:] != entries["hash"][:-1]
    starts = np.flatnonzero(first)
    return entries, starts, np.diff(starts, append=len(entries))


def _firsts(entries: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each group the entry of least doc and position."""
    heads = entries[starts].copy()
    if len(starts):
        heads["doc"] = np.minimum.reduceat(entries["doc"], starts)
        there = entries["doc"] == np.repeat(heads["doc"], sizes)
        heads["pos"] = np.minimum.reduceat(np.where(there, entries["pos"], np.iinfo(np.int32).max), starts)
    return heads


def _places(entries: np.ndarray) -> np.ndarray:
    out = np.empty(len(entries), PLACE)
    out["doc"], out["pos"] = entries["doc"], entries["pos"]
    return out


def anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """Anchors of docs (doc_id, text). Those met twice in a batch are decided there; their group goes on as one entry with position -1."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, chars=4_000_000):
            w = words_of(texts)
            hashes = windows(w.hashes, ANCHOR)
            left = np.repeat(w.counts, w.counts)[: len(hashes)] - w.position[: len(hashes)]
            long = np.repeat(w.counts >= WINDOW, w.counts)[: len(hashes)]
            at = np.flatnonzero((left >= ANCHOR) & long & _IN_COVER[w.position[: len(hashes)] % PERIOD])
            entries, starts, sizes = _groups(_entries(hashes, at, w, part.column(0).to_numpy()))
            heads = entries[starts].copy()
            heads["pos"][sizes > 1] = -1
            places = _places(entries[np.repeat(sizes > 1, sizes)])
            rows = split_by(heads, (heads["hash"] % np.uint64(buckets)).astype(np.int64), MEET) + split_by(places, places["doc"] % buckets, DECIDED)
            if rows:
                yield packed(rows)

    return docs.transform(map_batches, run, PACKED)


def _repeated_anchors(entries: np.ndarray) -> np.ndarray:
    entries, _, sizes = _groups(entries)
    return _places(entries[np.repeat(sizes > 1, sizes) & (entries["pos"] >= 0)])


def extended(buckets: int):
    """Windows around the decided anchors of documents. Of equal windows in a batch the first goes on; the others are decided."""

    def work(ids: list[int], texts: list[str], of) -> Iterator[pa.RecordBatch]:
        w = words_of(texts)
        hashes, edge = windows(w.hashes, WINDOW), np.zeros(len(w.hashes) + 1, np.int64)
        start = 0
        for doc, n in zip(ids, w.counts.tolist(), strict=True):
            if n >= WINDOW and len(hit := of(doc)["pos"]):
                hit = hit[hit <= n - ANCHOR].astype(np.int64)
                np.add.at(edge, start + np.maximum(0, hit - (WINDOW - ANCHOR)), 1)
                np.add.at(edge, start + np.minimum(hit, n - WINDOW) + 1, -1)
            start += n
        at = np.flatnonzero(np.cumsum(edge)[: len(hashes)] > 0)
        entries, starts, sizes = _groups(_entries(hashes, at, w, np.array(ids, np.int64)))
        heads, places = _firsts(entries, starts, sizes), _later(entries, starts, sizes)
        rows = split_by(heads, (heads["hash"] % np.uint64(buckets)).astype(np.int64), MEET) + split_by(places, places["doc"] % buckets, DECIDED)
        if rows:
            yield packed(rows)

    return work


def _later(entries: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of grouped entries but for the first place of each group."""
    head = np.repeat(_firsts(entries, starts, sizes), sizes)
    return _places(entries[(entries["doc"] != head["doc"]) | (entries["pos"] != head["pos"])])


def repeated_windows(docs: DataFrame, buckets: int) -> DataFrame:
    """Places, packed by document, of the windows whose words also start earlier."""
    def settled(find):
        return lambda payloads: find(np.concatenate([unpack(p, ENTRY) for p in payloads[MEET]]))

    hits = met(anchors(docs, buckets), settled(_repeated_anchors), buckets)
    return met(with_places(docs, hits, buckets, extended(buckets), PACKED), settled(lambda e: _later(*_groups(e))), buckets)


def _kept(ids: list[int], texts: list[str], of) -> Iterator[pa.RecordBatch]:
    kept, total, removed = [], [], []
    for doc, text in zip(ids, texts, strict=True):
        words = text.encode().split()
        n, at = len(words), of(doc)["pos"]
        at = at[at <= n - WINDOW]
        if len(at):
            edge = np.zeros(n + 1, np.int64)
            edge[at] += 1
            edge[at + WINDOW] -= 1
            keep = np.cumsum(edge)[:n] == 0
            words = list(compress(words, keep.tolist()))
        kept.append(b" ".join(words).decode())
        total.append(n)
        removed.append(n - len(words))
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one space) of every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    buckets = bucket_count(docs.sparkSession)
    with_id = docs.where("doc_id is not null")
    schema = "doc_id long, n_words long, n_removed long, kept_text string"
    trimmed = with_places(with_id, repeated_windows(with_id, buckets), buckets, _kept, schema)

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            yield from _kept(part.column(0).to_pylist(), texts, lambda _: np.empty(0, PLACE))

    return trimmed.union(docs.where("doc_id is null").transform(map_batches, whole, schema))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
