"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs (at line ends, sentence ends and column bars); each
paragraph's 64-bit digest, with its number among equal ones, is a key. A sketch
has three tables of m cells; a key adds 1 to a count and XORs itself and a check
value into one cell of each. Subtracting two sketches leaves the keys in which
the texts differ; peeling cells that hold one key recovers them. Tables are
powers of two, so a larger one folds onto a smaller; when peeling fails, both
sides are laid out anew at twice the size. A fingerprint is written at the
smallest size at which its own keys can be listed, so any two fingerprints can
be compared by themselves.

Likeness is shared keys / all keys of the two (1 for two empty texts). Null
texts count as empty. The next document follows in order of doc_id (nulls first,
then text); after the last comes the first, and a lone document follows itself.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.llm.common import documents, fresh, map_batches
from flowloom.llm.words import mix

PARAGRAPH_END = r"[.!?|\n]+\s*"
#: Keys a cell that a fresh sketch is laid out for, and doublings within which any sketch is expected to peel.
LOAD, DOUBLINGS = 0.7, 16
_CELL = np.dtype([("count", "<i4"), ("key", "<u8"), ("check", "<u4")])


def paragraph_digests(text: Column) -> Column:
    return F.transform(F.filter(F.split(text, PARAGRAPH_END), lambda p: p != ""), lambda p: F.xxhash64(p))


def numbered(digests: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and owners: a digest with its number among its owner's equal digests."""
    order = np.lexsort((digests, owner))
    d, o = digests[order], owner[order]
    fresh = np.ones(len(d), bool)
    fresh[1:] = (d[1:] != d[:-1]) | (o[1:] != o[:-1])
    at = np.arange(len(d))
    number = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix(d + number * np.uint64(0x9E3779B97F4A7C15)), o


class Sketches:
    """Sketches side by side; m[i] cells a table in sketch i."""

    def __init__(self, m: np.ndarray):
        self.m = m.astype(np.int64)
        self.base = np.concatenate([[0], np.cumsum(3 * self.m)])
        self.cells = np.zeros(self.base[-1], _CELL)

    def places(self, keys: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
        spread, m = mix(keys ^ np.uint64(0xD1B54A32D192ED03)), self.m[owner]
        return [self.base[owner] + j * m + ((spread >> np.uint64(21 * j)).astype(np.int64) & (m - 1)) for j in range(3)]

    def add(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray | int = 1) -> None:
        check = (mix(keys) >> np.uint64(32)).astype(np.uint32)
        for at in self.places(keys, owner):
            np.add.at(self.cells["count"], at, np.int32(sign) if np.isscalar(sign) else sign.astype(np.int32))
            np.bitwise_xor.at(self.cells["key"], at, keys)
            np.bitwise_xor.at(self.cells["check"], at, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Recovered keys, their owners, and for each sketch whether nothing is left. Empties the cells."""
        c, owner_of = self.cells, np.repeat(np.arange(len(self.m)), 3 * self.m)
        keys, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        look = np.flatnonzero(c["count"])
        while len(look):
            look = look[np.abs(c["count"][look]) == 1]
            pure = look[(mix(c["key"][look]) >> np.uint64(32)).astype(np.uint32) == c["check"][look]]
            if not len(pure):
                break
            order = np.lexsort((c["key"][pure], owner_of[pure]))
            pure = pure[order]
            k, o, s = c["key"][pure], owner_of[pure], c["count"][pure]
            first = np.ones(len(k), bool)
            first[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
            k, o, s = k[first], o[first], s[first]
            self.add(k, o, -s)
            keys.append(k)
            owners.append(o)
            look = np.unique(np.concatenate(self.places(k, o)))
        left = (c["count"] != 0) | (c["key"] != 0)
        clean = np.bincount(owner_of[left], minlength=len(self.m)) == 0
        return np.concatenate(keys), np.concatenate(owners), clean


def first_size(n: np.ndarray) -> np.ndarray:
    """Cells a table for n keys."""
    return 2 ** np.ceil(np.log2(np.maximum(1, n / (3 * LOAD)))).astype(np.int64)


def build(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, list[bytes]]:
    """Table size and cells of n sketches, each at the first size from which its keys can be listed."""
    counts = np.bincount(owner, minlength=n)
    m, cells = first_size(counts), [b""] * n
    todo = np.arange(n)
    for _ in range(DOUBLINGS):
        slot = np.full(n, -1)
        slot[todo] = np.arange(len(todo))
        mine = slot[owner] >= 0
        sketch = Sketches(m[todo])
        sketch.add(keys[mine], slot[owner[mine]])
        raw = sketch.cells.copy()
        _, _, clean = sketch.peel()
        for i in np.flatnonzero(clean):
            cells[todo[i]] = raw[sketch.base[i] : sketch.base[i + 1]].tobytes()
        todo = todo[~clean]
        m[todo] *= 2
        if not len(todo):
            return m, cells
    raise ValueError(f"{len(todo)} sketches can't be listed at {int(m.max())} cells a table")


def differing(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int, m: np.ndarray) -> np.ndarray:
    """For n pairs of key sets, (keys, owner) each: how many keys are in one of the two, from subtracted sketches of m cells first."""
    out, m, todo = np.zeros(n, np.int64), m.copy(), np.arange(n)
    for _ in range(DOUBLINGS):
        slot = np.full(n, -1)
        slot[todo] = np.arange(len(todo))
        sketch = Sketches(m[todo])
        for (keys, owner), sign in ((a, 1), (b, -1)):
            mine = slot[owner] >= 0
            sketch.add(keys[mine], slot[owner[mine]], sign)
        _, owners, clean = sketch.peel()
        out[todo] = np.bincount(owners, minlength=len(todo))
        todo = todo[~clean]
        m[todo] *= 2
        if not len(todo):
            return out
    raise ValueError(f"{len(todo)} differences can't be listed at {int(m.max())} cells a table")


def likeness(n_a: np.ndarray, n_b: np.ndarray, differ: np.ndarray) -> np.ndarray:
    return np.where(n_a + n_b > 0, (n_a + n_b - differ) / np.maximum(1, n_a + n_b + differ), 1.0)


def written(n: int, m: int, cells: bytes) -> str:
    return f"{n}.{m}.{base64.b64encode(cells).decode()}"


def listed(fingerprint: str) -> np.ndarray:
    """The keys of a fingerprint, recovered from its cells."""
    _, m, cells = fingerprint.split(".")
    sketch = Sketches(np.array([int(m)]))
    sketch.cells = np.frombuffer(base64.b64decode(cells), _CELL).copy()
    return sketch.peel()[0]


def compare(a: str, b: str) -> float:
    """Likeness of two fingerprints, from nothing but them: the larger is folded, subtracted and peeled; on failure both are listed and laid out larger."""
    (na, ma, ca), (nb, mb, cb) = a.split("."), b.split(".")
    m = min(int(ma), int(mb))
    sketch = Sketches(np.array([m]))
    for own, cells, sign in ((int(ma), ca, 1), (int(mb), cb, -1)):
        folded = np.frombuffer(base64.b64decode(cells), _CELL).reshape(3, own // m, m)
        sketch.cells["count"] += sign * folded["count"].sum(axis=1).ravel().astype(np.int32)
        for part in ("key", "check"):
            sketch.cells[part] ^= np.bitwise_xor.reduce(folded[part], axis=1).ravel()
    keys, _, clean = sketch.peel()
    differ = len(keys)
    if not clean[0]:
        zero = lambda k: (k, np.zeros(len(k), np.int64))
        differ = differing(zero(listed(a)), zero(listed(b)), 1, np.array([2 * m]))[0]
    return float(likeness(np.array(int(na)), np.array(int(nb)), np.array(differ)))


def _keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.diff(column.offsets.to_numpy())
    digests = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return numbered(digests, np.repeat(np.arange(len(column)), lengths))


def fingerprints_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows of (id, own, edited, next digests): both fingerprints, and the likeness of own to edited and next."""
    for whole in batches:
        for at in range(0, len(whole), 2000):
            batch = whole.slice(at, 2000)
            n = len(batch)
            own, edited, following = (_keys(batch.column(i)) for i in (1, 2, 3))
            count = [np.bincount(k[1], minlength=n) for k in (own, edited, following)]
            (m, cells), (m_edited, cells_edited) = build(*own, n), build(*edited, n)
            columns = [pa.array([written(*x) for x in zip(count[0], m, cells, strict=True)]), pa.array([written(*x) for x in zip(count[1], m_edited, cells_edited, strict=True)])]
            for k, other in ((1, edited), (2, following)):
                size = np.minimum(first_size(count[0]), first_size(count[k]))
                columns.append(pa.array(likeness(count[0], count[k], differing(own, other, n, size))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def with_next(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """df with next_text, the text of the row that follows by id. Rows are dealt by ranges of the id as a double, and ordered by the id itself within equal doubles; the first row of each range is also given to the range before it."""
    spark = df.sparkSession
    _key, _range, _copy = (fresh(df, c) for c in ("key", "range", "copy"))
    key = F.coalesce(F.col(id_column).cast("double"), F.lit(float("-inf")))
    keyed = df.withColumn(_key, key)
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = keyed.approxQuantile(_key, [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    splits = [float("-inf"), *sorted({c for c in cuts if c > float("-inf")}), float("inf")]
    splits = splits if len(splits) > 2 else [float("-inf"), 0.0, float("inf")]
    dealt = Bucketizer(splits=splits, inputCol=_key, outputCol=_range, handleInvalid="keep").transform(keyed).withColumn(_copy, F.lit(0))
    heads = sorted(dealt.groupBy(_range).agg(F.min(_key)).collect())  # a row a range
    if not heads:
        return dealt.withColumn("next_text", F.col(text_column)).drop(_key, _range, _copy)
    before = {head[1]: heads[i - 1][0] for i, head in enumerate(heads)}
    to = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    copies = dealt.where(F.col(_key).isin(list(before))).withColumn(_range, to[F.col(_key)]).withColumn(_copy, F.lit(1))
    order = Window.partitionBy(_range).orderBy(_copy, _key, F.col(id_column).asc_nulls_first(), F.col(text_column).asc_nulls_first())
    return dealt.unionByName(copies).withColumn("next_text", F.lead(text_column).over(order)).where(F.col(_copy) == 0).drop(_key, _range, _copy)


def edited_with_next(text: Column, following: Column) -> Column:
    """text, its last quarter of code points (rounded down) replaced by as many first ones (or all) of the following."""
    n = F.length(text)
    k = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - k), F.substring(following, F.lit(1), k))


def fingerprint_pairs(df: DataFrame) -> DataFrame:
    """From doc_id, text, edited, next_text: doc_id, n_chars, edited_sha256, both fingerprints and both likenesses."""
    own, edited, following = F.col("text"), F.col("edited"), F.col("next_text")
    row = F.struct("doc_id", F.length(own).cast("long").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256")).alias("row")
    fed = df.select(row, *[paragraph_digests(c).alias(f"d{i}") for i, c in enumerate((own, edited, following))])
    schema = f"row {fed.schema['row'].dataType.simpleString()}, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return fed.transform(map_batches, fingerprints_of, schema).select("row.*", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_next(documents(spark, sf_dir).withColumn("text", F.coalesce("text", F.lit(""))))
    return fingerprint_pairs(docs.withColumn("edited", edited_with_next(F.col("text"), F.col("next_text"))))
