"""Benchmark decontamination by the q-gram lemma.

A region of a document and a region of a benchmark item of `length` characters that
differ by at most e = floor(rate * length) edits share at least
length + 1 - q * (e + 1) q-grams, on diagonals (document position minus item
position) that lie within e of each other. Shared q-grams are counted in diagonal
bands twice as wide as they are apart, by windows of the document twice as long as
they are apart, so every such region lies within one band and one window. A q-gram
counts as often as it stands in both, so repeats don't multiply. Bands that reach the
count are aligned: a banded local alignment (match 1, edit -EDIT) finds the best
region in the band, and a region that scores at least length - (EDIT + 1) * e, as any
region meeting the budget does, is kept. The rest of the text in the band is then
aligned again, until nothing reaches that score. `length` is the item's own if it is
shorter than `region`.

Texts are compared as UTF-8 bytes with A-Z lowered, each run of white space as one
space, and runs of over 2 * q bytes that repeat a piece of up to q (of over q, for one
byte) as their first q: indentation, rules of dashes and filler say little, and stand
everywhere. Positions are given in code points. Items of fewer than q bytes, without
space at their ends, match where they stand exactly. Null and empty texts and items,
and those of white space alone, match nothing. Rows are searched by themselves;
repeated items give a row for each item_id, and an item_id with several texts is
searched as each. Items go to all tasks in blocks of bounded size, a pass over the
documents a block.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.llm.common import checkpointed, documents, fresh, map_batches, read_table, slices

#: Bytes of items that are aligned side by side, bits of a position in an item, and pairs of places that are held at once.
_SIDE, _START, _PAIRS = 8_000_000, 31, 1_000_000
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


@dataclass(frozen=True)
class Decontamination:
    """region: characters that must match, at most; rate: edits a character; q: of q-grams, 8 at most; block: bytes of items in one pass; broadcast: ids of documents with leaks sent to all tasks at most, more are joined."""

    region: int = 80
    rate: float = 0.08
    q: int = 8
    edit: int = 4
    block: int = 4_000_000
    broadcast: int = 1_000_000


def fold(text: str, q: int = Decontamination.q) -> tuple[bytes, np.ndarray]:
    """The bytes that are compared, and where each stands in the text's own."""
    raw = np.frombuffer(text.encode().translate(_FOLD), np.uint8)
    blank = raw == 32
    at = np.flatnonzero(~(blank & np.concatenate([[False], blank[:-1]])))
    raw = raw[at]
    edge = np.zeros(len(raw) + 1, np.int64)
    for unit in range(1, q + 1):
        if len(raw) <= unit:
            break
        differs = np.concatenate([[-1], np.flatnonzero(raw[unit:] != raw[:-unit]), [len(raw) - unit]])
        begin, size = differs[:-1] + 1, np.diff(differs) - 1 + unit
        least = q if unit == 1 else 2 * q
        long = size > least
        np.add.at(edge, begin[long] + q, 1)
        np.add.at(edge, begin[long] + size[long], -1)
    stay = np.cumsum(edge)[: len(raw)] == 0
    return raw[stay].tobytes(), at[stay]


def folded(text: str) -> bytes:
    return fold(text)[0]


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """Every q bytes in a row as one number."""
    n = len(data) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    wide = data.astype(np.uint64)
    for j in range(q):
        out = (out << np.uint64(8)) | wide[j : n + j]
    return out


class ItemIndex:
    """q-grams of items, by value."""

    def __init__(self, items: list[tuple[object, str]], settings: Decontamination):
        q = settings.q
        self.settings = settings
        self.ids = [i for i, _ in items]
        both = [fold(t, q) for _, t in items]
        self.texts, self.places = [b.strip(b" ") for b, _ in both], [p[len(b) - len(b.lstrip(b" ")) :] for b, p in both]
        self.lengths = np.array([min(len(t), settings.region) for t in self.texts], np.int64)
        self.edits = np.floor(self.lengths * settings.rate).astype(np.int64)
        self.least = np.maximum(1, self.lengths + 1 - q * (self.edits + 1))
        self.score = self.lengths - (settings.edit + 1) * self.edits
        self.width = 1 << max(3, int(max(self.edits, default=0)).bit_length())
        self.short = [i for i, t in enumerate(self.texts) if 0 < len(t) < q]
        long = [i for i, t in enumerate(self.texts) if len(t) >= q]
        values = [grams(np.frombuffer(self.texts[i], np.uint8), q) for i in long]
        value = np.concatenate(values) if values else np.empty(0, np.uint64)
        item = np.repeat(np.array(long, np.int64), [len(v) for v in values]) if values else np.empty(0, np.int64)
        place = np.concatenate([np.arange(len(v)) for v in values]) if values else np.empty(0, np.int64)
        order = np.argsort(value, kind="stable")
        self.item, self.place = item[order], place[order]
        self.value, self.first, number = np.unique(value[order], return_index=True, return_inverse=True)
        self.last = np.append(self.first[1:], len(value))
        self.entry = number * len(items) + self.item  # in order of gram, then item
        self.span = int((self.lengths + self.edits).max(initial=q))  # bytes of a text that a region can take
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self._slot(self.value)] = True

    @staticmethod
    def _slot(value: np.ndarray) -> np.ndarray:
        return (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)

    def candidates(self, datas: list[bytes]) -> np.ndarray:
        """Rows of (text, item, band) whose shared q-grams in some window of the text reach the item's count; a band starts at band * width and is twice as wide."""
        none = np.empty((0, 3), np.int64)
        joined = np.frombuffer(b"\xff".join([*datas, b""]), np.uint8)
        value = grams(joined, self.settings.q)
        at = np.flatnonzero(self.seen[self._slot(value)])
        if not len(at) or not len(self.value):
            return none
        found = np.minimum(np.searchsorted(self.value, value[at]), len(self.value) - 1)
        real = self.value[found] == value[at]
        at, found = at[real], found[real]
        if not len(at):
            return none
        starts = np.concatenate([[0], np.cumsum([len(d) + 1 for d in datas])])
        text = np.searchsorted(starts, at, side="right") - 1
        place = at - starts[text]
        # a window is two cells; cells of different texts are apart
        first_cell = np.concatenate([[0], np.cumsum([len(d) // self.span + 2 for d in datas])])
        cell = first_cell[text] + place // self.span
        cells, begin = np.unique(cell, return_index=True)
        pairs = np.cumsum(np.add.reduceat(self.last[found] - self.first[found], begin))
        begin = np.append(begin, len(cell))
        rows, k = [none], 0
        while k < len(cells):
            stop = max(k + 1, int(np.searchsorted(pairs, (pairs[k - 1] if k else 0) + _PAIRS, side="right")))
            end = stop + (stop < len(cells) and cells[stop] == cells[stop - 1] + 1)
            some = slice(begin[k], begin[end])
            ranges = [(0, len(self.ids))]
            while ranges:
                low, high = ranges.pop()
                from_, to = (np.searchsorted(self.entry, found[some] * len(self.ids) + i) for i in (low, high))
                if (to - from_).sum() > 2 * _PAIRS and high - low > 1:
                    middle = (low + high) // 2
                    ranges += [(low, middle), (middle, high)]
                    continue
                item, window, band = self._bands(cell[some], place[some], found[some], from_, to, int(cells[stop - 1]))
                rows.append(np.stack([np.searchsorted(first_cell, window, side="right") - 1, item, band], axis=1))
            k = stop
        return np.unique(np.concatenate(rows), axis=0)

    def _bands(self, cell: np.ndarray, place: np.ndarray, gram: np.ndarray, first: np.ndarray, last: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, window, band) that reach the item's count, of places of a text whose grams stand at the entries first to last; windows begin at cells up to `most`."""
        n, many = len(self.ids), last - first
        hit = np.repeat(np.arange(len(cell)), many)
        entry = np.repeat(first, many) + np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many)
        # windows that don't share enough in all bands together go first
        low = int(cell[0]) if len(cell) else 0
        pair = (cell[hit] - low) * n + self.item[entry]
        both, at, count = np.unique(pair, return_inverse=True, return_counts=True)
        after = np.searchsorted(both, both + n)
        has = (after < len(both)) & (both[np.minimum(after, len(both) - 1)] == both + n) if len(both) else np.empty(0, bool)
        enough = count + np.where(has, count[np.minimum(after, len(both) - 1)], 0) >= self.least[both % n] if len(both) else has
        of = enough & (both // n + low <= most)
        second = np.zeros(len(both), bool)
        second[after[of & has]] = True
        stay = (of | second)[at]
        hit, entry, at = hit[stay], entry[stay], at[stay]
        if not len(hit):
            return (np.empty(0, np.int64),) * 3
        diagonal = place[hit] - self.place[entry]
        band = diagonal // self.width  # each also counts in the band before, which reaches to twice the width
        least = int(band.min()) - 1
        span = int(band.max()) - least + 1
        own = both[at] * span + band - least
        opened = np.arange(len(hit))
        parts = [(own[of[at]], opened[of[at]]), (own[second[at]] - n * span, opened[second[at]])]
        key = np.concatenate([k for k, _ in parts])
        source = np.concatenate([x for _, x in parts])
        key, source = np.concatenate([key, key - 1]), np.concatenate([source, source])
        keys, at, count = np.unique(key, return_inverse=True, return_counts=True)
        full = count >= self.least[(keys // span) % n]
        some = full[at]
        at, source = at[some], source[some]
        # of each gram in a band the fewer of its places in the text and in the item
        fewer = np.zeros(len(keys), np.int64)
        if len(at):
            value, sides = gram[hit[source]], []
            for where in (place[hit[source]], self.place[entry[source]]):
                order = np.lexsort((where, value, at))
                a, v, w = at[order], value[order], where[order]
                fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (v[1:] != v[:-1])])
                other = fresh | np.concatenate([[True], w[1:] != w[:-1]])
                begin = np.flatnonzero(fresh)
                sides.append((a[begin], np.add.reduceat(other.astype(np.int64), begin)))
            np.add.at(fewer, sides[0][0], np.minimum(sides[0][1], sides[1][1]))
        keys = keys[fewer >= self.least[(keys // span) % n]]
        window, item = np.divmod(keys // span, n)
        return item, window + low, keys % span + least

    def window(self, item: int, band: int) -> tuple[int, int]:
        """Start and end of the text that the item's characters can meet in a band."""
        widest = int(self.edits.max(initial=0))
        return band * self.width - widest, band * self.width + 2 * self.width + widest + 1 + len(self.texts[item])

    def aligned(self, datas: list[bytes], rows: np.ndarray, taken: dict[tuple[int, int], list[tuple[int, int]]]) -> np.ndarray:
        """Best region of each row of (text, item, band) outside what is taken of the text for the item: columns score, start, end in the text, start, end in the item."""
        out = np.zeros((len(rows), 5), np.int64)
        lengths = np.array([len(self.texts[i]) for i in rows[:, 1]], np.int64)
        order = np.argsort(lengths, kind="stable")
        at = len(order)
        while at:  # the longest first, of which fewer go side by side
            few = max(1, min(256, _SIDE // int(lengths[order[at - 1]])))
            some = order[max(0, at - few) : at]
            out[some] = self._aligned(datas, rows[some], lengths[some], taken)
            at -= len(some)
        return out

    def _aligned(self, datas: list[bytes], rows: np.ndarray, lengths: np.ndarray, taken: dict[tuple[int, int], list[tuple[int, int]]]) -> np.ndarray:
        n, wide, edit = len(rows), 2 * self.width + 2 * int(self.edits[rows[:, 1]].max(initial=0)) + 1, self.settings.edit
        low = rows[:, 2] * self.width - int(self.edits[rows[:, 1]].max(initial=0))  # least diagonal that is aligned
        most = int(lengths.max())
        items, texts = np.zeros((n, most), np.uint8), np.ones((n, most + wide), np.uint8)
        for r in range(n):
            items[r, : lengths[r]] = np.frombuffer(self.texts[rows[r, 1]], np.uint8)
            begin, stop = max(0, low[r]), min(len(datas[rows[r, 0]]), low[r] + most + wide)
            if stop > begin:
                texts[r, begin - low[r] : stop - low[r]] = np.frombuffer(datas[rows[r, 0]], np.uint8, stop - begin, begin)
            for a, b in taken.get((int(rows[r, 0]), int(rows[r, 1])), ()):
                texts[r, max(0, a - low[r]) : max(0, b - low[r])] = 0xFF  # in no text
        step = edit * np.arange(wide)
        score = np.zeros((n, wide), np.int64)
        begin = np.zeros((n, wide), np.int64)  # packed start of the region: text offset and, in _START bits, item offset
        best = np.zeros((n, 5), np.int64)
        column = np.arange(wide)
        for j in range(most):
            here = ((j + column) << _START) | j
            fresh = score <= 0
            base = np.where(fresh, 0, score)
            from_start = np.where(fresh, here, begin)
            same = (texts[:, j : j + wide] == items[:, j : j + 1]) & (j < lengths)[:, None]
            stay = base + np.where(same, 1, -edit)
            down = np.concatenate([score[:, 1:] - edit, np.full((n, 1), -(1 << 30))], axis=1)  # an item character is left out
            skip = down > stay
            stay = np.where(skip, down, stay)
            from_start = np.where(skip, np.concatenate([begin[:, 1:], begin[:, -1:]], axis=1), from_start)
            lifted = stay + step  # text characters left out: the best on the left, less an edit a column
            top = np.maximum.accumulate(lifted, axis=1)
            source = np.maximum.accumulate(np.where(lifted == top, column, 0), axis=1)
            score = top - step
            begin = np.take_along_axis(from_start, source, axis=1)
            peak = score.argmax(axis=1)
            value = score[np.arange(n), peak]
            better = (value > best[:, 0]) & (j < lengths)
            start = begin[np.arange(n), peak]
            best[better] = np.stack([value, (start >> _START) + low, j + peak + 1 + low, start & ((1 << _START) - 1), np.full(n, j + 1)], axis=1)[better]
        return best

    def has_room(self, datas: list[bytes], row: list[int], taken: dict[tuple[int, int], list[tuple[int, int]]]) -> bool:
        """Whether the text of a band has a stretch outside what is taken that is as long as a region's least score."""
        t, i, band = row
        low, high = self.window(i, band)
        at, high = max(0, low), min(high, len(datas[t]))
        for a, b in sorted(taken.get((t, i), ())):
            if min(a, high) - at >= self.score[i]:
                return True
            at = max(at, b)
        return high - at >= self.score[i]

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int, int, int]]:
        """(text, item, score, start, end, item start, item end) of the retained regions, in bytes; of overlapping regions of one item the best."""
        both = [fold(t, self.settings.q) for t in texts]
        own = lambda places, a, b: (int(places[a]), int(places[b - 1]) + 1)  # noqa: E731  bytes of the text itself
        return [(t, i, score, *own(both[t][1], max(0, a), min(b, len(both[t][1]))), *own(self.places[i], c, d)) for t, i, score, a, b, c, d in self._matches([d for d, _ in both])]

    def _matches(self, datas: list[bytes]) -> list[tuple[int, int, int, int, int, int, int]]:
        out = []
        for t, data in enumerate(datas):
            for i in self.short:
                at = data.find(self.texts[i])
                while at >= 0:
                    out.append((t, i, len(self.texts[i]), at, at + len(self.texts[i]), 0, len(self.texts[i])))
                    at = data.find(self.texts[i], at + 1)
        rows = self.candidates(datas)
        if not len(rows):
            return out
        taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
        regions, stale = np.zeros((len(rows), 5), np.int64), np.ones(len(rows), bool)
        live = np.arange(len(rows))
        while len(live):
            again = live[stale[live]]
            regions[again] = self.aligned(datas, rows[again], taken)
            stale[again] = False
            live = live[regions[live, 0] >= self.score[rows[live, 1]]]
            unsure: dict[tuple[int, int], list[tuple[int, int]]] = {}  # windows of the bands to be aligned again, where regions of up to their score may yet be found
            for k in live[np.argsort(-regions[live, 0], kind="stable")].tolist():
                t, i, band = rows[k].tolist()
                score, a, b, c, d = regions[k].tolist()
                if all(b <= x or a >= y for x, y in taken.get((t, i), ())):
                    if any(a < y and b > x for x, y in unsure.get((t, i), ())):
                        continue
                    taken.setdefault((t, i), []).append((a, b))
                    out.append((t, i, score, a, b, c, d))
                stale[k] = True
                unsure.setdefault((t, i), []).append(self.window(i, band))
            live = live[[not stale[k] or self.has_room(datas, rows[k].tolist(), taken) for k in live.tolist()]] if len(live) else live
        return out


@functools.lru_cache(maxsize=1)
def _index(items: tuple, settings: Decontamination) -> ItemIndex:
    return ItemIndex(list(items), settings)


def blocks_of(items: DataFrame, settings: Decontamination) -> Iterator[list[tuple[int, str]]]:
    """Items (item_id, text) in blocks of bounded size, streamed through the driver one at a time."""
    block, size = [], 0
    for row in items.where("text is not null and text <> ''").select("item_id", "text").toLocalIterator():
        if block and size + len(row["text"]) > settings.block:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


MATCH = "doc_id long, item_id long, score int, start_char int, end_char int, item_start int, item_end int"


def contaminated_regions(docs: DataFrame, items: DataFrame, settings: Decontamination = Decontamination(), keep: Sequence[str] = ()) -> DataFrame:
    """A row for every retained region: doc_id, item_id, score, start and end in the document (code points), start and end in the item (bytes), and the columns of docs to keep."""
    found = docs.sparkSession.createDataFrame([], MATCH)
    schema = T.StructType([*found.schema.fields, *(docs.schema[c] for c in keep)])
    found = docs.sparkSession.createDataFrame([], schema)
    docs = docs.select(F.col("doc_id").cast("long"), "text", *keep)
    for block in blocks_of(items, settings):
        sent = docs.sparkSession.sparkContext.broadcast(tuple(block))

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _index(sent.value, settings)
            for part, texts in slices(batches):
                ids = part.column(0).to_pylist()
                rows, at = [], []
                for t, i, score, a, b, c, d in index.matches(texts):
                    at.append(t)
                    data = texts[t].encode()
                    start = len(data[:a].decode(errors="ignore"))
                    rows.append((ids[t], index.ids[i], score, start, start + len(data[a:b].decode(errors="ignore")), c, d))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
                types = [pa.int64()] * 2 + [pa.int32()] * 5
                kept = [part.column(2 + k).take(pa.array(at, pa.int64())) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*(pa.array(x, k) for x, k in zip(columns, types, strict=True)), *kept], names=schema.names)

        found = found.union(docs.transform(map_batches, run, schema))
    return found


def without_leaks(docs: DataFrame, items: DataFrame, settings: Decontamination = Decontamination()) -> DataFrame:
    """docs without those that hold a region of an item; rows without doc_id are judged by their own text."""
    leak, named = fresh(docs, "leak"), F.col("doc_id").isNotNull()
    number = F.when(named, F.col("doc_id").cast("long")).otherwise(F.xxhash64("text"))
    found = contaminated_regions(docs.select(number.alias("doc_id"), F.when(named, 1).otherwise(0).alias("named"), "text"), items, settings, ["named"])
    found = checkpointed(found.select(F.col("doc_id").alias(leak), "named").distinct())
    found = F.broadcast(found) if found.count() <= settings.broadcast else found
    by = lambda which: found.where(F.col("named") == which).select(leak)
    kept = docs.where(named).join(by(1), number == F.col(leak), "left_anti")
    return kept.unionByName(docs.where(~named).join(by(0), number == F.col(leak), "left_anti"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long"), "text")
    return contaminated_regions(documents(spark, sf_dir), items)
