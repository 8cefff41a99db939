"""N-gram Jaccard join by parity sketches.

A document's set is its distinct word shingles. Linked sets of a and b shingles
differ in at most floor((a + b) * (100 - t) / (100 + t)) of them (t: the least
similarity in hundredths). Sizes fall into bands, each as wide as linked sizes can
differ; two linked sets meet in the band of the larger. For a band, shingles are
dealt by hash to more segments than any linked pair of the band can differ in, and
each segment keeps the XOR of its shingles' hashes. One differing shingle spoils
one segment at most, so linked sets agree on a segment (pigeonhole). Light segments,
of fewer than `light` shingles, tell little and are left out; more segments than
needed make up for them, and a set with more light ones than that gives those too
(if both sets of a pair do, they can meet there; else on a full one). Empty segments
give no keys, since all sets share them: a set with more empty ones than segments make
up for gives its shingles of least hash instead, one more than linked sets differ in,
of which linked sets share one. Bands where linked sets can't differ give none. A bit
sketch, one bit flipped by each shingle, bounds the difference from below: pairs
further apart go unverified. The rest is verified on whole sets.

Equal sets are one node (a hash of the set); pairs, links and components are of
nodes, so copies make no pairs. Candidates come in two rounds. First, everyone who
shares a segment is paired with the least node there; verified links give components.
Then segments of three or more nodes that still hold several components are contested.
In one of up to `small` nodes all pairs of different components whose sizes allow a
link are candidates. In a larger one each node is paired with the nearest, by
sketches, of another component, which merges most; then all that sketches allow
between the components left. So links inside a component are not all listed, but no
two linked nodes end in different components. Segments of more than `block` nodes are
cut into blocks, and every two blocks meet by themselves, so no task holds more than
two; nearest is then nearest of a block.

Null and empty texts, and texts without words, have no shingles and no links; a
text with fewer words than a shingle has one, of all its words. Rows without doc_id
link with nothing and have a null component. Repeated rows are one document; a
doc_id with several texts links as each of them. Hashes are of 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import checkpointed, compact, documents, fresh, map_batches, slices
from flowloom.llm.components import components
from flowloom.llm.dealing import MEET, PACKED, bucket_count, packed, split_by, unpack
from flowloom.llm.words import mix, windows, words_of

#: A segment's key with a set that has it, and whether three or more are known to have it; with the least and largest component there; with a set, its component and size.
_ENTRY = np.dtype([("key", "<u8"), ("node", "<i8"), ("n", "<i4"), ("many", "i1")])
_MIXED = np.dtype([("key", "<u8"), ("least", "<i8"), ("last", "<i8"), ("many", "<i4")])
_MEMBER = np.dtype([("key", "<u8"), ("node", "<i8"), ("component", "<i8"), ("n", "<i4")])
_EDGE = np.dtype([("u", "<i8"), ("v", "<i8")])


@dataclass(frozen=True)
class JaccardJoin:
    """shingle: words; threshold: hundredths. spare: share of segments beyond the difference; light: shingles of a segment that tells enough; broadcast: ids or segments sent to all tasks at most, more are joined; small: nodes of a contested segment all of whose pairs are listed; block: nodes of a larger one compared with as many others at once; task: segment keys that a bucket holds, about."""

    shingle: int = 5
    threshold: int = 80
    spare: float = 0.15
    light: int = 3
    broadcast: int = 1_000_000
    small: int = 16
    block: int = 2000
    task: int = 2_000_000

    def differ(self, a, b):
        return (a + b) * (100 - self.threshold) // (100 + self.threshold)

    def may_link(self, a, b):
        """Whether sizes allow a link."""
        return np.abs(a - b) <= self.differ(a, b)

    def edges_of_bands(self, most: int) -> list[int]:
        """Least sizes of the bands: a band is as wide as the size of a link's partner can be."""
        edges = [1]
        while edges[-1] <= most:
            edges.append(max(edges[-1] + 1, math.floor(edges[-1] * 100 / self.threshold) + 1))
        return edges


@dataclass
class Sets:
    """Distinct shingle hashes of many texts, text after text and sorted in each; how many each text has."""

    hashes: np.ndarray
    counts: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.counts)

    def split(self) -> list[np.ndarray]:
        return np.split(self.hashes, self.ends[:-1]) if len(self.counts) else []

    def over(self, ufunc: np.ufunc, values: np.ndarray) -> np.ndarray:
        """ufunc over the values of each text's hashes; 0 for texts without."""
        out = np.zeros(len(self.counts), values.dtype)
        full = self.counts > 0
        if full.any():
            out[full] = ufunc.reduceat(values, (self.ends - self.counts)[full])
        return out


def shingle_sets(texts: list[str], k: int) -> Sets:
    """The sets of the texts, A-Z lowered."""
    w = words_of(texts, lower=True)
    ends = np.cumsum(w.counts)
    left = np.repeat(ends, w.counts) - np.arange(len(w.hashes))
    hashes = windows(w.hashes, k)[np.flatnonzero(left >= k)]
    many = np.maximum(w.counts - k + 1, 0)
    stops = np.cumsum(many)
    for a, b in zip((stops - many).tolist(), stops.tolist(), strict=True):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[(stops - many)[many > 0]] = True
    before = np.concatenate([[0], np.cumsum(new)])
    counts, hashes = before[stops] - before[stops - many], hashes[new]
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    if len(short):
        whole = [windows(w.hashes[ends[i] - w.counts[i] : ends[i]], int(w.counts[i]), seed=int(w.counts[i]))[0] for i in short]
        hashes = np.insert(hashes, np.cumsum(counts)[short], np.array(whole, np.uint64))
        counts[short] = 1
    return Sets(hashes, counts)


def nodes_of(sets: Sets) -> np.ndarray:
    """A hash of each set as a whole."""
    x = sets.over(np.bitwise_xor, sets.hashes)
    y = sets.over(np.bitwise_xor, mix(sets.hashes + np.repeat(sets.counts, sets.counts).astype(np.uint64)))
    return mix(x ^ mix(y)).view(np.int64)


def keys_of(sets: Sets, join: JaccardJoin, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the segments of every set in its size's band and, if a link may be there, the next; and the set of each key."""
    n, own = sets.counts, np.searchsorted(bands, sets.counts, side="right") - 1
    keys, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for step in (0, 1):
        band = np.maximum(own, 0) + step
        most = join.differ(bands[band + 1] - 1, bands[band + 1] - 1)
        use = (n > 0) & (most > 0)  # links of a band with most 0 are equal sets, which are one node
        if step:
            use &= n * 100 >= join.threshold * bands[band]
        of = np.flatnonzero(use)
        slack = 3 + np.ceil(join.spare * most).astype(np.int64)
        segments = most + 1 + slack
        # so many sets at once that their segments have numbers of 16 bits, which sort fast
        total, i = np.cumsum(segments[of]), 0
        while i < len(of):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + 65536, side="right")))
            found = _keys_in(sets, of[i:j], band, most, slack, segments, join)
            keys += found[0]
            at += found[1]
            i = j
    return np.concatenate(keys), np.concatenate(at)


def _keys_in(sets: Sets, of: np.ndarray, band: np.ndarray, most: np.ndarray, slack: np.ndarray, segments: np.ndarray, join: JaccardJoin) -> tuple[list[np.ndarray], list[np.ndarray]]:
    starts, counts = (sets.ends - sets.counts)[of], sets.counts[of]
    if of[-1] - of[0] + 1 == len(of):
        hashes = sets.hashes[starts[0] : starts[-1] + counts[-1]]
    else:
        hashes = np.concatenate([sets.hashes[a : a + c] for a, c in zip(starts, counts, strict=True)])
    band, most, slack, segments = band[of].astype(np.uint64), most[of], slack[of], segments[of]
    spread = mix(hashes + np.repeat((band + np.uint64(1)) * np.uint64(0x51ED270B), counts))
    to = ((spread >> np.uint64(32)) * np.repeat(segments, counts).astype(np.uint64)) >> np.uint64(32)
    offset, total = np.cumsum(segments) - segments, int(segments.sum())
    number = to.astype(np.int64) + np.repeat(offset, counts)
    sizes = np.bincount(number, minlength=total)
    order = np.argsort(number.astype(np.uint16 if total <= 65536 else np.uint32), kind="stable")
    full = np.flatnonzero(sizes)
    parity = np.bitwise_xor.reduceat(spread[order], (np.cumsum(sizes) - sizes)[full])
    own = np.repeat(np.arange(len(of)), segments)[full]
    key = mix(parity ^ ((full - offset[own]).astype(np.uint64) + (segments[own].astype(np.uint64) << np.uint64(20)) + (band[own] << np.uint64(44))))
    heavy = sizes[full] >= join.light
    take = heavy | (segments - np.bincount(own[heavy], minlength=len(of)) > slack)[own]
    keys, at = [key[take]], [of[own[take]]]
    # linked sets may agree on empty segments alone: the least shingle that both have is among these of each
    ends = np.cumsum(counts)
    for i in np.flatnonzero(segments - np.bincount(own, minlength=len(of)) > slack).tolist():
        least = np.sort(spread[ends[i] - counts[i] : ends[i]])[: most[i] + 1]
        keys.append(mix(least ^ ((band[i] << np.uint64(44)) + np.uint64(1 << 60))))
        at.append(np.full(len(least), of[i]))
    return keys, at


def segment_keys(s: np.ndarray, join: JaccardJoin, bands: list[int]) -> np.ndarray:
    """keys_of() one set."""
    return keys_of(Sets(s, np.array([len(s)])), join, np.array(bands))[0]


def sketches_in(sets: Sets) -> list[bytes]:
    """A bit flipped by each shingle, of a power of two of bits, as many as shingles at least and of a short set four times as many, which bounds more closely: a longer sketch folds onto a shorter by XOR of its parts."""
    n = np.maximum(1, sets.counts)
    bits = np.array([1 << max(8, (x - 1).bit_length()) for x in np.maximum(n, np.minimum(4 * n, 2048)).tolist()], np.int64)
    ends = np.cumsum(bits)
    place = ((sets.hashes >> np.uint64(7)).astype(np.int64) & np.repeat(bits - 1, sets.counts)) + np.repeat(ends - bits, sets.counts)
    flips = np.bincount(place, minlength=int(bits.sum())) & 1
    data = np.packbits(flips.astype(np.uint8)).tobytes()
    return [data[(e - b) // 8 : e // 8] for e, b in zip(ends.tolist(), bits.tolist(), strict=True)]


def bit_sketch(s: np.ndarray) -> bytes:
    return sketches_in(Sets(s, np.array([len(s)])))[0]


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch as 64-bit words, folded to so many bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size // 8), axis=0)


def described(df: DataFrame, join: JaccardJoin) -> DataFrame:
    """doc_id, n_shingles, node (what equal sets share) and bit sketch of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            sets = shingle_sets(texts, join.shingle)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets.counts), pa.array(nodes_of(sets)), pa.array(sketches_in(sets), pa.binary())], names=["doc_id", "n_shingles", "node", "sketch"])

    return df.transform(map_batches, run, "doc_id long, n_shingles long, node long, sketch binary")


#: Kinds of rows that star_candidates() and contested_candidates() make.
EDGE, CROWDED, OPEN, TOUCHED = 0, 1, 2, 3


def _found(kind: int, u: np.ndarray, v: np.ndarray | None = None) -> pa.RecordBatch:
    v = np.zeros(len(u), np.int64) if v is None else v
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind, np.int32)), pa.array(np.ascontiguousarray(u)), pa.array(np.ascontiguousarray(v))], names=["kind", "u", "v"])


def _distinct(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Distinct edges (u, v)."""
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    out = np.empty(int(new.sum()), _EDGE)
    out["u"], out["v"] = u[new], v[new]
    return out


def _stars(entries: np.ndarray, join: JaccardJoin) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of entries: the least node of each key, with another one if there is (marked if the key has three or more); keys of three or more nodes; edges from all others to the least, if sizes allow a link; and nodes of edges that they don't allow."""
    entries = entries[np.argsort(entries["key"])]
    key, node = entries["key"], entries["node"]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    starts, group = np.flatnonzero(first), np.cumsum(first) - 1
    if not len(starts):
        return entries, key, np.empty(0, _EDGE), node
    least = np.minimum.reduceat(node, starts)
    pivot = np.flatnonzero(node == least[group])
    pivot = pivot[np.unique(group[pivot], return_index=True)[1]]
    others = np.flatnonzero(node != least[group])
    theirs, new = group[others], np.ones(len(others), bool)
    new[1:] = theirs[1:] != theirs[:-1]
    second = others[new]
    beyond = others[node[others] != node[second][np.cumsum(new) - 1]]
    crowded = np.unique(np.concatenate([key[beyond], key[entries["many"] > 0]]))
    n, center = entries["n"].astype(np.int64), pivot[theirs]
    may = join.may_link(n[others], n[center])
    far = np.unique(np.concatenate([node[others[~may]], node[center[~may]]]))
    heads = entries[np.concatenate([pivot, second])]
    heads["many"] = np.isin(heads["key"], crowded)
    return heads, crowded, _distinct(node[others[may]], node[center[may]]), far


def star_candidates(docs: DataFrame, join: JaccardJoin, buckets: int) -> DataFrame:
    """EDGE rows (u, v): from every node to the least in each segment it shares, if sizes allow a link; TOUCHED rows (u, 0): nodes of pairs that they don't allow; CROWDED rows (u, 0): keys of segments that three or more share. A batch pairs its own nodes first and passes one entry a segment on (two if several share it), so a segment that many share stays small."""
    bands = np.array(join.edges_of_bands(1 << 32))

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def settle() -> Iterator[pa.RecordBatch]:
            heads, _, edges, far = _stars(np.concatenate(held), join)
            rows = split_by(heads, (heads["key"] % np.uint64(buckets)).astype(np.int64), MEET)
            for kind, found in ((_EDGES, edges), (_FAR, far)):
                if len(found):
                    rows.append((len(rows) % buckets, kind, found.tobytes()))
            if rows:
                yield packed(rows)

        for _, texts in slices(batches, chars=500_000):
            sets = shingle_sets(texts, join.shingle)
            keys, at = keys_of(sets, join, bands)
            entries = np.empty(len(keys), _ENTRY)
            entries["key"], entries["node"], entries["n"], entries["many"] = keys, nodes_of(sets)[at], sets.counts[at], 0
            held.append(entries)
            size += len(keys)
            if size > 500_000:
                yield from settle()
                held, size = [], 0
        if held:
            yield from settle()

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = [], None
        edges_held: list[np.ndarray] = []
        far_held: list[np.ndarray] = []

        def gathered(least: int) -> Iterator[pa.RecordBatch]:
            """Edges and touched nodes, one of each of a task's."""
            if sum(map(len, edges_held)) > least:
                edges = np.concatenate(edges_held)
                edges_held[:] = [_distinct(edges["u"], edges["v"])]
            if sum(map(len, far_held)) > least:
                far_held[:] = [np.unique(np.concatenate(far_held))]
            for kept, found in ((edges_held, lambda x: _found(EDGE, x["u"], x["v"])), (far_held, lambda x: _found(TOUCHED, x))):
                if sum(map(len, kept)) > least:
                    yield from map(found, kept)
                    kept.clear()

        def settle() -> Iterator[pa.RecordBatch]:
            if held:
                _, crowded, edges, far = _stars(np.concatenate(held), join)
                edges_held.append(edges)
                far_held.append(far)
                held.clear()
                yield _found(CROWDED, crowded.view(np.int64))
                yield from gathered(2_000_000)

        for batch in batches:
            for bucket, kind, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == _EDGES:
                    edges_held.append(np.frombuffer(payload, _EDGE))
                elif kind == _FAR:
                    far_held.append(np.frombuffer(payload, np.int64))
                else:
                    if bucket != of:
                        yield from settle()
                        of = bucket
                    held.append(unpack(payload, _ENTRY))
            yield from gathered(2_000_000)
        yield from settle()
        yield from gathered(0)

    dealt = docs.transform(map_batches, near, PACKED).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.transform(map_batches, meet, "kind int, u long, v long").distinct()


_EDGES, _FAR, _LARGE = 2, 3, 4


def bounded(df: DataFrame, join: JaccardJoin, most: int | None = None) -> DataFrame:
    """df, checkpointed, to be sent to all tasks if it is small enough. most: rows that it can't exceed, if known."""
    df, rows = compact(df, most)
    return F.broadcast(df) if rows <= join.broadcast else df


def near_enough(pairs: DataFrame, sketches: DataFrame, join: JaccardJoin) -> DataFrame:
    """Pairs (u, v) whose sketches allow a link. sketches: node, n_shingles, sketch."""
    drawn = lambda x: sketches.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.join(drawn("u"), "u").join(drawn("v"), "v").select("u", "v", "n_u", "n_v", "s_u", "s_v")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most, near = join.differ(batch.column(2).to_numpy(), batch.column(3).to_numpy()).tolist(), []
            for m, a, b in zip(most, batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                size = min(len(a), len(b))
                near.append(int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum()) <= m)
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return both.transform(map_batches, run, "u long, v long").distinct()


def verified(pairs: DataFrame, many: int, docs: DataFrame, sketches: DataFrame, join: JaccardJoin) -> DataFrame:
    """Pairs (u, v) of nodes that link, by their whole sets, each taken from the node's document of least id. A pair goes to v's part of the data, salted by how many pairs v has; v's set is sent once to each part. many: how many pairs there are."""
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    ids = sketches.join(nodes, "node").select("doc_id").distinct()
    wanted = docs.join(bounded(ids, join, 2 * many), "doc_id").select("doc_id", "text")

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            sets = shingle_sets(texts, join.shingle)
            yield pa.RecordBatch.from_arrays([pa.array(nodes_of(sets)), pa.array([s.tobytes() for s in sets.split()], pa.binary())], names=["u", "hashes"])

    sets = wanted.transform(map_batches, hashed, "u long, hashes binary")
    parts = bounded(pairs.groupBy("v").agg(F.ceil(F.count("*") / 2000).cast("int").alias("parts")), join, many)
    left = pairs.join(parts, "v").withColumn("part", F.pmod(F.xxhash64("u"), "parts").cast("int"))
    left = sets.join(bounded(left, join, many), "u").select("v", "part", F.lit(1).alias("kind"), "hashes", "u")
    right = sets.withColumnRenamed("u", "v").join(parts, "v").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("v", "part", F.lit(0).alias("kind"), "hashes", F.col("v").alias("u"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, own = None, np.empty(0, np.uint64)
        for batch in batches:
            links = []
            for v, part, kind, hashes, u in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                other = np.frombuffer(hashes, np.uint64)
                if kind == 0:
                    of, own = (v, part), other
                elif of == (v, part) and len(own):
                    at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                    both = int((own[at] == other).sum())
                    if 100 * both >= join.threshold * (len(own) + len(other) - both):
                        links.append((u, v))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["u", "v"])

    return left.union(right).repartition("v", "part").sortWithinPartitions("v", "part", "kind").transform(map_batches, run, "u long, v long").distinct()


def contested_pairs(nodes: np.ndarray, components_: np.ndarray, sizes: np.ndarray, sketches: list[bytes], join: JaccardJoin, most_words: int = 1 << 21, sides: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (x, y) in the arrays, and Hamming distances, of pairs of different components, of those that share a segment, which sizes and sketches allow; blocks of sketches are compared (of `most_words` words of all pairs of a block at most), no pairs are made but those. With sides only pairs across them."""
    size = min(map(len, sketches))
    words = np.stack([folded(x, size) for x in sketches])
    block = max(16, math.isqrt(most_words // words.shape[1]))
    for i in range(0, len(nodes), block):
        for j in range(i, len(nodes), block):
            a, b = slice(i, i + block), slice(j, j + block)
            most = join.differ(sizes[a][:, None], sizes[b][None, :])
            may = (components_[a][:, None] != components_[b][None, :]) & (np.abs(sizes[a][:, None] - sizes[b][None, :]) <= most)
            if sides is not None:
                may &= sides[a][:, None] != sides[b][None, :]
            if i == j:
                may = np.triu(may, 1)
            x, y = np.nonzero(may)
            apart = np.bitwise_count(words[a][x] ^ words[b][y]).sum(axis=1, dtype=np.int64)
            near = apart <= most[x, y]
            yield x[near] + i, y[near] + j, apart[near]


def nearest_pairs(count: int, pairs: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs (x, y, apart) of places below count: those that are the nearest of x or of y, and, if there are more pairs, the places that have one."""
    apart, to, total = np.full(count, np.iinfo(np.int64).max), np.full(count, -1), 0
    for x, y, d in pairs:
        total += len(x)
        ends, others, d = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([d, d])
        order = np.lexsort((others, d, ends))
        ends, others, d = ends[order], others[order], d[order]
        first = np.flatnonzero(np.diff(ends, prepend=-1))
        better = first[d[first] < apart[ends[first]]]
        apart[ends[better]], to[ends[better]] = d[better], others[better]
    has = np.flatnonzero(to >= 0)
    chosen = np.unique(np.stack([np.minimum(has, to[has]), np.maximum(has, to[has])], axis=1), axis=0)
    return chosen[:, 0], chosen[:, 1], has if total > len(chosen) else has[:0]


def _sent(df: DataFrame, join: JaccardJoin) -> dict[str, np.ndarray] | None:
    """The columns of df (checkpointed, of a number key), sorted by key, if it is small enough to be sent to all tasks."""
    if df.count() > join.broadcast:
        return None
    found = df.toPandas().sort_values("key")
    return {c: found[c].to_numpy() for c in found.columns}


def _looked_up(keys: np.ndarray, sent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are among those sent (sorted), and where."""
    at = np.minimum(np.searchsorted(sent, keys), max(0, len(sent) - 1))
    return (sent[at] == keys) if len(sent) else np.zeros(len(keys), bool), at


def contested_segments(near: DataFrame, crowded: DataFrame, join: JaccardJoin, buckets: int) -> DataFrame:
    """key and many: segments of several components, and how many nodes they have at most. near: doc_id, text, component. Where crowded segments are few, others are left out."""
    spark, bands = near.sparkSession, np.array(join.edges_of_bands(1 << 32))
    few = _sent(crowded, join)
    sent = spark.sparkContext.broadcast(few and few["key"])

    def summed(entries: np.ndarray) -> np.ndarray:
        entries = entries[np.argsort(entries["key"])]
        starts = np.flatnonzero(np.diff(entries["key"], prepend=~entries["key"][:1]))
        out = entries[starts]
        if len(out):
            out["least"], out["last"] = np.minimum.reduceat(entries["least"], starts), np.maximum.reduceat(entries["last"], starts)
            out["many"] = np.minimum(np.add.reduceat(entries["many"].astype(np.int64), starts), 2**31 - 1)
        return out

    def mixed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, chars=2_000_000):
            keys, at = keys_of(shingle_sets(texts, join.shingle), join, bands)
            if sent.value is not None:
                keep = _looked_up(keys.view(np.int64), sent.value)[0]
                keys, at = keys[keep], at[keep]
            entries = np.empty(len(keys), _MIXED)
            entries["key"], entries["least"], entries["many"] = keys, part.column(2).to_numpy()[at], 1
            entries["last"] = entries["least"]
            entries = summed(entries)
            rows = split_by(entries, (entries["key"] % np.uint64(buckets)).astype(np.int64), MEET)
            if rows:
                yield packed(rows)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = [], None

        def settle() -> Iterator[pa.RecordBatch]:
            if held:
                found = summed(np.concatenate(held))
                found = found[found["least"] < found["last"]]
                yield pa.RecordBatch.from_arrays([pa.array(found["key"].view(np.int64)), pa.array(np.ascontiguousarray(found["many"]))], names=["key", "many"])
                held.clear()

        for batch in batches:
            for bucket, _, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != of:
                    yield from settle()
                    of = bucket
                held.append(unpack(payload, _MIXED))
        yield from settle()

    return near.transform(map_batches, mixed, PACKED).repartition("bucket").sortWithinPartitions("bucket").transform(map_batches, meet, "key long, many int")


def contested_members(near: DataFrame, contested: DataFrame, join: JaccardJoin, buckets: int) -> DataFrame:
    """PACKED rows of the members of contested segments: of kind MEET those of small ones, by bucket of the key, and of kind _LARGE the others. The segments go to all tasks, so many at a time as may be sent."""
    spark, bands = near.sparkSession, np.array(join.edges_of_bands(1 << 32))

    def members(sent) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, texts in slices(batches, chars=2_000_000):
                sets = shingle_sets(texts, join.shingle)
                keys, at = keys_of(sets, join, bands)
                keep, place = _looked_up(keys.view(np.int64), sent.value["key"])
                keys, at, place = keys[keep], at[keep], place[keep]
                entries = np.empty(len(keys), _MEMBER)
                entries["key"], entries["node"], entries["component"], entries["n"] = keys, nodes_of(sets)[at], part.column(2).to_numpy()[at], sets.counts[at]
                small = sent.value["many"][place] <= join.small
                to = (keys % np.uint64(buckets)).astype(np.int64)
                rows = split_by(entries[small], to[small], MEET) + split_by(entries[~small], to[~small], _LARGE)
                if rows:
                    yield packed(rows)

        return near.transform(map_batches, run, PACKED)

    parts = max(1, math.ceil(contested.count() / join.broadcast))
    out = None
    for i in range(parts):
        some = contested.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == i) if parts > 1 else contested
        found = some.toPandas().sort_values("key")
        rows = members(spark.sparkContext.broadcast({c: found[c].to_numpy() for c in found.columns}))
        out = rows if out is None else out.union(rows)
    return out


def small_candidates(members: DataFrame, join: JaccardJoin) -> DataFrame:
    """EDGE rows of all pairs, of different components, of the members of small segments whose sizes allow a link."""

    def settle(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        entries = np.concatenate(held)
        entries = entries[np.lexsort((entries["node"], entries["key"]))]
        new = np.ones(len(entries), bool)
        new[1:] = (entries["key"][1:] != entries["key"][:-1]) | (entries["node"][1:] != entries["node"][:-1])
        entries = entries[new]
        starts = np.flatnonzero(np.diff(entries["key"], prepend=~entries["key"][:1]))
        sizes, us, vs = np.diff(starts, append=len(entries)), [], []
        for size in np.unique(sizes).tolist():
            x, y = np.triu_indices(size, 1)
            group = starts[sizes == size][:, None]
            a, b = entries[(group + x).ravel()], entries[(group + y).ravel()]
            may = (a["component"] != b["component"]) & join.may_link(a["n"].astype(np.int64), b["n"].astype(np.int64))
            us.append(b["node"][may])
            vs.append(a["node"][may])
        edges = _distinct(np.concatenate(us), np.concatenate(vs))
        yield _found(EDGE, edges["u"], edges["v"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = [], None
        for batch in batches:
            for bucket, _, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != of and held:
                    yield from settle(held)
                    held = []
                of = bucket
                held.append(unpack(payload, _MEMBER))
        if held:
            yield from settle(held)

    return members.where(F.col("kind") == MEET).repartition("bucket").sortWithinPartitions("bucket").transform(map_batches, run, "kind int, u long, v long").distinct()


def large_members(members: DataFrame) -> DataFrame:
    """key, node, component and n of the members of large segments."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                found = unpack(payload, _MEMBER)
                yield pa.RecordBatch.from_arrays([pa.array(found["key"].view(np.int64)), *(pa.array(np.ascontiguousarray(found[c])) for c in ("node", "component", "n"))], names=["key", "node", "component", "n"])

    return members.where(F.col("kind") == _LARGE).select("payload").transform(map_batches, run, "key long, node long, component long, n int")


def contested_candidates(rows: DataFrame, sketches: DataFrame, join: JaccardJoin, nearest: bool) -> DataFrame:
    """From members (key, node, component, n) of large segments, EDGE rows (u, v): pairs of different components whose sketches allow a link; with nearest only the nearest of each node in a segment (or two of its blocks), and OPEN rows (u, 0): nodes that may have further pairs."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def settle() -> Iterator[pa.RecordBatch]:
            if len({h[1] for h in held}) > 1:
                nodes, labels_, sizes, drawn, sides = zip(*sorted(set(held)), strict=True)
                nodes, sides = np.array(nodes, np.int64), np.array(sides, np.int64)
                pairs = contested_pairs(nodes, np.array(labels_, np.int64), np.array(sizes, np.int64), drawn, join, sides=sides if of[1] < of[2] else None)
                if nearest:
                    x, y, more = nearest_pairs(len(nodes), pairs)
                    pairs = [(x, y, None)]
                    yield _found(OPEN, nodes[more])
                for x, y, _ in pairs:
                    yield _found(EDGE, np.maximum(nodes[x], nodes[y]), np.minimum(nodes[x], nodes[y]))
            held.clear()

        of = None
        for batch in batches:
            for key, low, high, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, low, high) != of:
                    yield from settle()
                    of = (key, low, high)
                held.append(tuple(row))
        yield from settle()

    contested = rows.groupBy("key").agg(F.count("*").alias("many"), F.min("component").alias("least"), F.max("component").alias("last")).where("least < last")
    contested = contested.select("key", F.ceil(F.col("many") / join.block).cast("int").alias("parts"))
    met = blocks_met(rows.join(bounded(contested, join), "key"))
    met = met.join(sketches.select("node", "sketch"), "node").select("key", "low", "high", "node", "component", "n", "sketch", "side")
    return met.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").transform(map_batches, compare, "kind int, u long, v long").where("u <> v").distinct()


def blocks_met(rows: DataFrame) -> DataFrame:
    """From key, parts, node and others: a row for each two blocks of the key (low, high; the same for a block by itself) that the row's node is in, and on which side it is there."""
    own, other = F.pmod(F.xxhash64("node"), "parts").cast("int"), F.col("_other")
    met = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return met.withColumn("low", F.least("_own", other)).withColumn("high", F.greatest("_own", other)).withColumn("side", (F.col("_own") > other).cast("int")).drop("_own", "_other", "parts")


def _links(found: DataFrame, tested: DataFrame, sketches: DataFrame, docs: DataFrame, join: JaccardJoin) -> tuple[DataFrame, DataFrame] | None:
    """Of EDGE rows those not tested before whose sketches allow a link, and those of them that link; None if there are none to test."""
    pairs = found.where(F.col("kind") == EDGE).select("u", "v").join(tested, ["u", "v"], "left_anti")
    more, many = compact(near_enough(pairs, sketches, join))
    return (more, compact(verified(more, many, docs, sketches, join), many)[0]) if many else None


def node_components(docs: DataFrame, worded: DataFrame, join: JaccardJoin) -> DataFrame:
    """node and component of the nodes that link with others. docs: doc_id, text; worded: doc_id, n_shingles, node and sketch of docs with words."""
    keys = worded.agg(F.sum("n_shingles")).first()[0] or 0  # with two bands, about half as many as shingles
    buckets = max(bucket_count(docs.sparkSession), math.ceil(keys / 2 / join.task))
    stars, _ = compact(star_candidates(docs, join, buckets))
    pairs, many = compact(stars.where(F.col("kind") == EDGE).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    touched = stars.where(F.col("kind").isin(EDGE, TOUCHED)).select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    sketches = worded.join(bounded(touched, join), "node").groupBy("node").agg(F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("of"))
    sketches, nodes = compact(sketches.select("node", "of.*"))
    tested, many = compact(near_enough(pairs, sketches, join), many)
    several = worded.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("last")).where("v < last").select("doc_id", "v")
    several = worded.select("doc_id", F.col("node").alias("u")).join(bounded(several, join), "doc_id").where("u <> v").select("u", "v")
    links, _ = compact(verified(tested, many, docs, sketches, join).union(several))
    labels, _ = compact(components(links))
    near = sketches.join(labels, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component")).distinct()
    near = docs.join(bounded(near, join, nodes), "doc_id").select("doc_id", "text", "component")
    crowded = stars.where(F.col("kind") == CROWDED).select(F.col("u").alias("key"))
    contested, rows = compact(contested_segments(near, crowded, join, buckets))
    if not rows:
        return labels
    members = checkpointed(contested_members(near, contested, join, buckets))
    large = large_members(members)
    found = small_candidates(members, join)
    if not contested.where(F.col("many") > join.small).isEmpty():
        found = found.unionByName(contested_candidates(large, sketches, join, nearest=True))
    found, _ = compact(found)
    more = _links(found, tested, sketches, docs, join)
    if more:
        tested, links = tested.union(more[0]), links.union(more[1])
        labels, _ = compact(components(links))
    still, rows = compact(found.where(F.col("kind") == OPEN).select(F.col("u").alias("node")).distinct())
    if rows:
        of = bounded(still.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component")), join, rows)
        more = _links(contested_candidates(large.drop("component").join(of, "node"), sketches, join, nearest=False), tested, sketches, docs, join)
        if more:
            labels, _ = compact(components(links.union(more[1])))
    return labels


def jaccard_components(docs: DataFrame, join: JaccardJoin = JaccardJoin()) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) for every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = checkpointed(described(docs, join))
    worded = rows.where("doc_id is not null and n_shingles > 0")
    labels = node_components(docs.where("doc_id is not null"), worded, join)
    # nodes that link with others or have several documents, and the least doc_id of their component
    nodes = worded.groupBy("node").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"))
    nodes, classes = compact(nodes.join(labels, "node", "left").where("component is not null or least < last"))
    least = nodes.where("component is not null").groupBy("component").agg(F.min("least").alias("least_of_all"))
    named = nodes.join(bounded(least, join, classes), "component", "left").select("node", F.coalesce("least_of_all", "least").alias("component_id"))
    labelled = rows.drop("sketch").join(bounded(named, join, classes), "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")))
    return labelled.select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each(docs: DataFrame, join: JaccardJoin = JaccardJoin()) -> DataFrame:
    """docs without those that reach a lesser doc_id by links; of rows that share a kept id one stays; rows without doc_id stay."""
    copy, again = fresh(docs, "copy"), fresh(docs, "again")
    found = jaccard_components(docs, join).where("doc_id > component_id").select(F.col("doc_id").alias(copy)).distinct()
    kept = docs.where("doc_id is not null").join(bounded(found, join), F.col("doc_id").cast("long") == F.col(copy), "left_anti")
    repeated, rows = compact(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias(again)).count().where("count > 1").select(again))
    if rows:
        many = bounded(repeated, join, rows)
        once = kept.join(many, F.col("doc_id") == F.col(again), "left_anti")
        kept = once.unionByName(kept.join(many, F.col("doc_id") == F.col(again), "left_semi").dropDuplicates(["doc_id"]))
    return kept.unionByName(docs.where("doc_id is null"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), JaccardJoin(shingle=4, threshold=85))
