"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

Each piece (one match of the splitting pattern) holds its bytes as the leaves of
a segment tree; a leaf keeps rank * width + position of the pair that starts
there, so the root is the leftmost pair of the lowest rank. A merge changes the
leaf of the pair, of the dead right part and of the live left neighbour, and
recomputes their paths: a logarithmic number of point updates. Many pieces of
one width are merged side by side, a merge a round in each, with numpy (short ones
recompute whole levels of all their trees, which is less work than many short paths),
and few one after another; pieces already met are remembered in bounded tables, which changes no result.

Null and empty texts have no ids and decode to no bytes. Each row stands by
itself; pieces of any length are merged whole.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import documents, map_batches, slices

_NONE = np.int64(2**62)
_SHIFT = 40  # positions take so many bits of a leaf, ranks 20 above them

#: So many pieces of a width and more are merged side by side; fewer, which a round of numpy would be dear for, one by one.
_SIDE_BY_SIDE = 12

#: Pieces up to this width recompute levels, and so many leaves are merged side by side then: few enough for the processor's cache.
_LEVELS, _LEAVES = 64, 65_536

#: Texts with any of these (two white-space characters that touch, white space other than space and line feed), or white space at an end, are split by the pattern as a whole.
_IRREGULAR = ("  ", "\n\n", " \n", "\n ", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"))


def regular(text: str) -> bool:
    return bool(text) and text[0] not in " \n" and text[-1] not in " \n" and not any(c in text for c in _IRREGULAR)


class ByteBPE:
    """Encoder and decoder for a table of token bytes to ranks and a splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = 150_000):
        import regex

        if max(ranks.values(), default=0) >= 1 << 20:
            raise ValueError("ranks of 2**20 and above don't fit beside positions")
        self.ranks, self.remember = ranks, remember
        self.split = regex.compile(pattern).findall
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        pairs = {(ranks[t[:k]] << 20) | ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.known: dict[str, bytes] = {}  # a piece without a space before it, or with it, to its ids as int32 bytes
        self.spaced: dict[str, bytes] = {}
        self.earlier: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}  # the same of the time before; what is met again moves on

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1; ids under 0 pair with nothing."""
        key = (a.astype(np.int64) << 20) | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as int32 bytes, by merges alone."""
        out = [b""] * len(pieces)
        bits = np.array([max(1, (n - 1).bit_length()) for n in map(len, pieces)], np.int8)
        for b in np.unique(bits).tolist():
            width, members = 1 << b, np.flatnonzero(bits == b).tolist()
            levels = width <= _LEVELS
            step = max(1, (_LEAVES if levels else 2_000_000) // width)
            for at in range(0, len(members), step):
                some = members[at : at + step]
                if len(some) < _SIDE_BY_SIDE:
                    merged = map(self._merge_one, (pieces[i] for i in some))
                else:
                    merged = (self._merge_levels if levels else self._merge_width)([pieces[i] for i in some], width)
                for i, ids in zip(some, merged, strict=True):
                    out[i] = ids
        return out

    @functools.cached_property
    def rank_of(self) -> dict[int, int]:
        """Ranks by packed pair."""
        return dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))

    def _merge_one(self, piece: bytes) -> bytes:
        """As _merge_width(), for a piece by itself: the same tree, in lists."""
        n, rank_of, mask = len(piece), self.rank_of, (1 << _SHIFT) - 1
        width = max(2, 1 << max(0, n - 1).bit_length())
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        ranks = self.pair_rank(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64)) if n > 1 else np.empty(0, np.int64)
        none = int(_NONE)
        leaves = np.full(width, none)
        leaves[: len(ranks)] = np.where(ranks >= 0, (ranks << _SHIFT) | np.arange(len(ranks)), none)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [none, *(v for level in reversed(levels) for v in level.tolist())]

        def put(place: int, value: int) -> None:
            node = width + place
            if tree[node] == value:
                return
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                value = other if other < value else value
                node >>= 1
                if tree[node] == value:
                    return
                tree[node] = value

        while tree[1] < none:
            left, merged = tree[1] & mask, tree[1] >> _SHIFT
            right, prior = after[left], before[left]
            beyond = after[right]
            ids[left], ids[right] = merged, -1
            after[left] = beyond
            put(right, none)
            own = -1
            if beyond >= 0:
                before[beyond] = left
                own = rank_of.get(merged << 20 | ids[beyond], -1)
            put(left, own << _SHIFT | left if own >= 0 else none)
            if prior >= 0:
                theirs = rank_of.get(ids[prior] << 20 | merged, -1)
                put(prior, theirs << _SHIFT | prior if theirs >= 0 else none)
        return np.array([i for i in ids if i >= 0], np.int32).tobytes()

    def _merge_levels(self, pieces: list[bytes], width: int) -> list[bytes]:
        """As _merge_width(), for short pieces: a column of the tree a piece, and every level computed anew after a round."""
        n, lengths, bits, none = len(pieces), np.array([len(p) for p in pieces], np.int64), width.bit_length() - 1, np.int32(2**31 - 1)
        ids = np.full((width + 1, n), -1, np.int32)  # the last row stands for no neighbour
        of = np.repeat(np.arange(n), lengths)
        ids[np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths), of] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.repeat(np.arange(1, width + 2, dtype=np.int32)[:, None], n, axis=1)
        before = after - 2
        before[0] = width
        after[np.maximum(lengths - 1, 0), np.arange(n)] = width
        rank = self.pair_rank(ids[:width].ravel(), ids[1:].ravel()).reshape(width, n)
        tree = np.full((2 * width + 1, n), none, np.int32)
        tree[width : 2 * width] = np.where(rank >= 0, (rank << bits) | np.arange(width)[:, None], none)
        out, members = np.empty((width, n), np.int32), np.arange(n)
        while True:
            low = width
            while low > 1:
                low //= 2
                np.minimum(tree[2 * low : 4 * low : 2], tree[2 * low + 1 : 4 * low : 2], out=tree[low : 2 * low])
            live = np.flatnonzero(tree[1] < none)
            if 2 * len(live) < len(members):  # the others are done
                out[:, members] = ids[:width]
                if not len(live):
                    break
                ids, after, before, tree = (np.take(x, live, axis=1) for x in (ids, after, before, tree))
                members = members[live]
                live = np.arange(len(members))
            columns, root = len(members), tree[1, live]
            flat_ids, flat_after, flat_before, leaves = ids.ravel(), after.ravel(), before.ravel(), tree[width:].ravel()
            left, merged = root & (width - 1), root >> bits
            at = left * columns + live
            right = flat_after[at] * np.int64(columns) + live
            beyond, prior = flat_after[right], flat_before[at]
            next_at, prior_at = beyond * np.int64(columns) + live, prior * np.int64(columns) + live
            flat_ids[at], flat_ids[right] = merged, -1
            flat_after[at], flat_before[next_at] = beyond, left
            own, theirs = self.pair_rank(merged, flat_ids[next_at]), self.pair_rank(flat_ids[prior_at], merged)
            leaves[right] = none
            leaves[at] = np.where(own >= 0, (own << bits) | left, none)
            leaves[prior_at] = np.where(theirs >= 0, (theirs << bits) | prior, none)
        held = out.T >= 0
        flat, ends = out.T[held].tobytes(), (4 * np.cumsum(held.sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_width(self, pieces: list[bytes], width: int) -> list[bytes]:
        n, lengths = len(pieces), np.array([len(p) for p in pieces], np.int64)
        ids = np.full((n, width + 1), -1, np.int64)  # the last column stands for no neighbour
        row = np.repeat(np.arange(n), lengths)
        column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ids[row, column] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
        before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
        before[:, 0] = width
        after[np.arange(n), np.maximum(lengths - 1, 0)] = width
        positions = np.arange(width)
        rank = self.pair_rank(ids[:, :width].ravel(), ids[:, 1:].ravel()).reshape(n, width)
        tree = np.full((n, 2 * width), _NONE)
        tree[:, width:] = np.where(rank >= 0, (rank << _SHIFT) | positions, _NONE)
        low = width
        while low > 1:
            low //= 2
            tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            root = tree[live, 1]
            left, merged = root & ((1 << _SHIFT) - 1), root >> _SHIFT
            right = after[live, left]
            beyond, prior = after[live, right], before[live, left]
            ids[live, left], ids[live, right] = merged, -1
            after[live, left] = beyond
            before[live, beyond] = left
            own = self.pair_rank(merged, ids[live, beyond])
            theirs = self.pair_rank(ids[live, prior], merged)
            tree[live, width + right] = _NONE
            tree[live, width + left] = np.where(own >= 0, (own << _SHIFT) | left, _NONE)
            has = prior < width
            at = live[has]
            tree[at, width + prior[has]] = np.where(theirs[has] >= 0, (theirs[has] << _SHIFT) | prior[has], _NONE)
            for rows, leaf in ((live, right), (live, left), (at, prior[has])):
                node = (leaf + width) >> 1
                while len(node) and node[0]:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                    node >>= 1
            live = live[tree[live, 1] < _NONE]
        held = ids[:, :width] >= 0
        flat, ends = ids[:, :width][held].astype(np.int32).tobytes(), (4 * np.cumsum(held.sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """int32 bytes of the ids of each piece; a piece that is a token as a whole is that token."""
        raw = [p.encode() for p in pieces]
        whole = [self.ranks.get(b) for b in raw]
        merged = iter(self.merge([b for b, w in zip(raw, whole, strict=True) if w is None]))
        return [next(merged) if w is None else w.to_bytes(4, "little") for w in whole]

    def _learn(self, table: dict[str, bytes], earlier: dict[str, bytes], words: set[str], prefix: str) -> None:
        """Ids of prefix and word. Letters alone are one match of the pattern; so are the letters before one full stop or comma."""
        met = words & earlier.keys()
        for w in met:
            table[w] = earlier[w]
        ended = [w for w in words - met if w[-1:] in (".", ",") and w[:-1].isalpha()]
        words = (words - met).difference(ended)
        for w in {w[:-1] for w in ended} - table.keys() - words:
            if w in earlier:
                table[w] = earlier[w]
            else:
                words.add(w)
        letters = [w for w in words if w.isalpha()]
        table.update(zip(letters, self.encode_pieces([prefix + w for w in letters]), strict=True))
        split = [(w, self.split(prefix + w)) for w in words.difference(letters)]
        pieces = list({p for _, s in split for p in s} | {".", ","})
        of = dict(zip(pieces, self.encode_pieces(pieces), strict=True))
        for w, s in split:
            table[w] = b"".join([of[p] for p in s])
        for w in ended:
            table[w] = table[w[:-1]] + of[w[-1]]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """int32 bytes of the ids of each text. Where no white-space characters touch, no match of the pattern goes beyond a line end or the space before a word, so words are looked up one by one."""
        if len(self.known) + len(self.spaced) > self.remember:
            self.earlier = self.known, self.spaced
            self.known, self.spaced = {}, {}
        split, first, later = [], {"\n"}, set()
        for text in texts:
            if regular(text):
                split.append(lines := [line.split(" ") for line in text.split("\n")])
                first.update([line[0] for line in lines])
                for line in lines:
                    later.update(line[1:])
            else:
                split.append(pieces := self.split(text))
                first.update(pieces)
        self._learn(self.known, self.earlier[0], first - self.known.keys(), "")
        self._learn(self.spaced, self.earlier[1], later - self.spaced.keys(), " ")
        known, spaced, out = self.known, self.spaced, []
        for pieces in split:
            if pieces and isinstance(pieces[0], list):
                parts = []
                for line in pieces:
                    parts.append(known[line[0]])
                    parts += [spaced[w] for w in line[1:]]
                    parts.append(known["\n"])
                parts.pop()
                out.append(b"".join(parts))
            else:
                out.append(b"".join([known[p] for p in pieces]))
        return out

    def forget(self) -> None:
        self.known, self.spaced, self.earlier = {}, {}, ({}, {})

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def tokenizer(name: str) -> ByteBPE:
    """The tokenizer of a rank file: a path, or a name in the installed vocabularies. One a worker."""
    import public_tokenizers

    return ByteBPE(read_ranks(name if "/" in name else public_tokenizers.path(name)), public_tokenizers.PATTERN)


RANKS = "byte_bpe_multi_50k.tiktoken"


def encode(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranks: str = RANKS, decoded: bool = False) -> DataFrame:
    """id and ids (array of int) of every row's text; with decoded also the bytes that these ids stand for."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks)
        for part, texts in slices(batches):
            raw = bpe.encode_batch(texts)
            flat = np.frombuffer(b"".join(raw), np.int32)
            ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
            columns = [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
            if decoded:
                listed = flat.tolist()
                columns.append(pa.array([bpe.decode(listed[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"][: len(columns)])
        bpe.forget()

    kind = df.schema[id_column].dataType.simpleString()
    out = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).transform(map_batches, run, f"id {kind}, ids array<int>" + ", decoded binary" * decoded)
    return out.withColumnRenamed("id", id_column)


def decode(df: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", ranks: str = RANKS) -> DataFrame:
    """id and the bytes that the ids stand for; null ids decode to no bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())], names=["id", "decoded"])

    kind = df.schema[id_column].dataType.simpleString()
    out = df.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids")).transform(map_batches, run, f"id {kind}, decoded binary")
    return out.withColumnRenamed("id", id_column)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of rows with ids and decoded."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(documents(spark, sf_dir), decoded=True))
