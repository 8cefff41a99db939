"""Token counts by heap-and-linked-list byte-pair merging.

A segment's characters are a linked list; a heap holds its adjacent pairs that
form a vocabulary piece, best score first, then leftmost. Popping merges the
pair and pushes the two new pairs. The count is symbols minus merges; a symbol
left outside the vocabulary counts its UTF-8 bytes. No ids are made.

Texts are cut where no vocabulary piece can reach across: before a space mark
that follows another character, and between two characters that are neighbours in
no piece. Counts of segments already met are remembered in a bounded table,
which changes no result. Null and empty texts have 0 tokens; rows are counted by
themselves, whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import documents, map_batches, slices

SPACE = "▁"
_SHIFT = 40  # positions take so many bits of a heap entry, the rank is above them
_POSITION = (1 << _SHIFT) - 1


class PieceCounter:
    """Counts of a BPE vocabulary given as {piece: score}, higher merged first. Texts get a space mark in front, their spaces become space marks."""

    def __init__(self, scores: dict[str, float], remember: int = 400_000):
        self.order = order = sorted(scores, key=lambda p: -scores[p])
        self.rank = {p: i for i, p in enumerate(order)}
        self.near = {p[i : i + 2] for p in order for i in range(len(p) - 1)}
        self.spaces_lead = not any(SPACE in p.lstrip(SPACE) for p in order)
        self.remember = remember
        self.words: dict[str, int] = {}
        self.segments: dict[str, int] = {}

    def merged(self, segment: str) -> int:
        """Tokens of one segment, by merging. A heap entry is rank and left position; it is stale unless that is still the rank of the pair there."""
        rank, order, n = self.rank.get, self.order, len(segment)
        symbols = [*segment, ""]
        after, before = list(range(1, n + 2)), list(range(-1, n))
        pair = [rank(a + b, -1) for a, b in zip(segment, segment[1:])] + [-1, -1]  # no pair starts at the last symbol
        heap = [(r << _SHIFT) + i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        count = n
        while heap:
            entry = heappop(heap)
            i = entry & _POSITION
            if pair[i] != entry >> _SHIFT:
                continue
            count -= 1
            j = after[i]
            symbols[i] = piece = order[entry >> _SHIFT]
            symbols[j], pair[j] = "", -1
            after[i] = k = after[j]
            before[k] = i
            pair[i] = r = rank(piece + symbols[k], -1) if k < n else -1
            if r >= 0:
                heappush(heap, (r << _SHIFT) + i)
            if (h := before[i]) >= 0:
                pair[h] = r = rank(symbols[h] + piece, -1)
                if r >= 0:
                    heappush(heap, (r << _SHIFT) + h)
        return count + sum([len(s.encode()) - 1 for s in symbols if len(s) == 1 and s not in self.rank])

    def segment(self, marked: str) -> int:
        """Tokens of a text with space marks, cut between characters that never stand together in a piece."""
        near, known, total, at = self.near, self.segments, 0, 0
        for i in range(1, len(marked) + 1):
            if i == len(marked) or marked[i - 1 : i + 1] not in near:
                part = marked[at:i]
                if (n := known.get(part)) is None:
                    n = known[part] = self.merged(part)
                total, at = total + n, i
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        if len(self.words) + len(self.segments) > self.remember:
            self.words.clear()
            self.segments.clear()
        if not self.spaces_lead or "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return self.segment(SPACE + text.replace(" ", SPACE))
        words = self.words
        parts = text.split(" ")
        try:
            return sum([words[w] for w in parts])
        except KeyError:
            for w in set(parts).difference(words):
                words[w] = self.merged(SPACE + w) if len(w) < 32 else self.segment(SPACE + w)
            return sum([words[w] for w in parts])


@lru_cache(maxsize=2)
def counter(name: str) -> PieceCounter:
    """The counter of a model file: a path, or a name in the installed vocabularies. One a worker."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=name if "/" in name else public_tokenizers.path(name))
    ids = range(model.get_piece_size())
    return PieceCounter({model.id_to_piece(i): model.get_score(i) for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))})


MODEL = "piece_bpe_32k.model"


def count_tokens(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL) -> DataFrame:
    """id, n_bytes and n_tokens of every row's text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(model)
        for part, texts in slices(batches):
            size = pa.compute.fill_null(pa.compute.binary_length(part.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), size, pa.array([pieces.count(t) for t in texts], pa.int64())], names=["id", "n_bytes", "n_tokens"])

    kind = df.schema[id_column].dataType.simpleString()
    out = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).transform(map_batches, run, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_column)


#: Tokens that the context window of a training run holds.
CONTEXT = 4096


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir)).withColumn("over_limit", F.col("n_tokens") > CONTEXT)
