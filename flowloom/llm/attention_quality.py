"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from its bytes (shares
of byte values, of hashed byte pairs and of hashed words, and how often words
repeat); a layer embeds it, gated attention weights the document's passages
(softmax of w . (tanh(V h) * sigmoid(U h))), and the weighted passage
representation is scored. All weights are learned together from document labels.

The model is fitted on the driver over at most SAMPLE labelled documents, those of
lowest hash; passages come to it encoded. All documents are scored, every passage
of them; a passage is encoded by itself, so a long text is scored a part at a time.
Null and empty texts are one empty passage. Labels that are null or not 0 or 1 teach
nothing; a document labelled twice counts as its highest label, one with several
texts teaches by the least of them; with no usable labels every score is 0.5. Rows
are scored by themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import documents, fold, map_batches, read_table, slices

#: Bytes of a passage, labelled documents that the fit sees at most and passages of each, and bytes of text that are encoded at once.
PASSAGE, SAMPLE, LOOKED_AT, PART = 600, 4000, 64, 300_000
_PAIRS, _WORDS = 128, 32
_WHOLE = PART // PASSAGE * PASSAGE  # a longer text is encoded in parts of so many bytes
FEATURES = 256 + _PAIRS + _WORDS + 3


def encode_passages(texts: list[bytes], passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, each of its own bytes alone, and the number of passages of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    bags = np.maximum(1, -(-lengths // passage))
    n, start = int(bags.sum()), np.cumsum(bags) - bags
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = start[owner] + at // passage
    size = np.maximum(1, np.bincount(place, minlength=n)).astype(np.float32)[:, None]
    single = np.bincount(place * 256 + data, minlength=n * 256).reshape(n, 256)
    same = place[1:] == place[:-1]
    pair = ((data[:-1] * 31 + data[1:] * 7) * 40503 >> 5) % _PAIRS
    double = np.bincount((place[:-1] * _PAIRS + pair)[same], minlength=n * _PAIRS).reshape(n, _PAIRS)
    # a word's code is the sum of its bytes' codes
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.concatenate([space[1:] != space[:-1], [True]]) | np.concatenate([~same, [True]])) if len(data) else np.empty(0, np.int64)
    first = np.concatenate([[0], edge[:-1] + 1]) if len(edge) else edge
    inside = ~space[first] if len(edge) else np.empty(0, bool)
    first, edge = first[inside], edge[inside]
    total = np.concatenate([[0], np.cumsum(data * data * data + 7 * data)])
    code = (total[edge + 1] - total[first]) if len(edge) else np.empty(0, np.int64)
    word_place = place[first] if len(edge) else code
    words = np.bincount(word_place * _WORDS + (code * 40503 >> 4) % _WORDS, minlength=n * _WORDS).reshape(n, _WORDS)
    n_words = np.bincount(word_place, minlength=n)
    repeats = np.bincount(word_place[1:][(code[1:] == code[:-1]) & (word_place[1:] == word_place[:-1])], minlength=n) if len(code) else np.zeros(n)
    distinct = np.bincount(np.unique(word_place * (1 << 40) + code % (1 << 40)) >> 40, minlength=n) if len(code) else np.zeros(n)
    many = np.maximum(1, n_words).astype(np.float32)
    shape = np.stack([repeats / many, distinct / many, size[:, 0] / many / 10], axis=1)
    return np.concatenate([np.sqrt(single / size), np.sqrt(double / size), np.sqrt(words / many[:, None]), shape], axis=1).astype(np.float32), bags


@dataclass
class AttentionModel:
    """h = tanh(W x + b); a = softmax over the bag of w . (tanh(V h) * sigmoid(U h)); score = sigmoid(c . sum(a h) + d)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        p, starts = self.weights, np.cumsum(bags) - bags
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-np.clip(h @ p["U"], -30, 30)))
        e = (t * g) @ p["w"]
        top = np.maximum.reduceat(e, starts)
        e = np.exp(e - np.repeat(top, bags))
        total = np.add.reduceat(e, starts)
        a = e / np.repeat(total, bags)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "top": top, "total": total, "score": self.judged(z)}

    def judged(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z @ self.weights["c"] + self.weights["d"], -30, 30)))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Score of each text. One of several parts is the mean of their representations, weighed by their attention."""
        split = [[t[i : i + _WHOLE] for i in range(0, len(t), _WHOLE)] or [t] for t in texts]
        if len(texts) > 1 and all(len(s) == 1 for s in split):
            return self.forward(*encode_passages(texts))["score"]
        out = []
        for parts in split:
            found = [self.forward(*encode_passages([p])) for p in parts]
            top = np.array([f["top"][0] for f in found])
            share = np.exp(top - top.max()) * [f["total"][0] for f in found]
            out.append(self.judged((share / share.sum()) @ np.concatenate([f["z"] for f in found])))
        return np.array(out)

    def gradients(self, x: np.ndarray, bags: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, f, starts = self.weights, self.forward(x, bags), np.cumsum(bags) - bags
        err = weight * (f["score"] - label) / len(label)
        dz = np.repeat(err[:, None] * p["c"], bags, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), bags))
        dtg = de[:, None] * p["w"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dx, "b": dx.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ err, "d": err.sum(keepdims=True)[0]}


def fit(x: np.ndarray, bags: np.ndarray, label: np.ndarray, hidden: int = 32, gate: int = 16, rounds: int = 40, batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> AttentionModel:
    """Adam over shuffled batches of documents; both labels weigh the same in total."""
    rng = np.random.default_rng(seed)
    shape = {"W": (x.shape[1], hidden), "b": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "c": (hidden,), "d": ()}
    weights = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if s and k != "b" else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
    model = AttentionModel(x.mean(axis=0), x.std(axis=0) + 0.01, weights)
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    weight = np.where(label > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    starts, step = np.cumsum(bags) - bags, 0
    moment = {k: np.zeros_like(v) for k, v in weights.items()}
    square = {k: np.zeros_like(v) for k, v in weights.items()}
    for _ in range(rounds):
        order = rng.permutation(len(label))
        for i in range(0, len(order), batch):
            some = order[i : i + batch]
            rows = np.concatenate([np.arange(starts[j], starts[j] + bags[j]) for j in some])
            step += 1
            for k, g in model.gradients(x[rows], bags[some], label[some], weight[some]).items():
                g = g + decay * weights[k]
                moment[k] = 0.9 * moment[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                weights[k] -= (rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def drawn(passages: int, most: int, doc_id: int) -> np.ndarray:
    """Which passages of a document a fit looks at: all, or as many as allowed, drawn by its id."""
    if passages <= most:
        return np.arange(passages)
    return np.sort(np.random.default_rng(abs(doc_id)).permutation(passages)[:most])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = LOOKED_AT) -> AttentionModel | None:
    """Fit on at most that many labelled documents (all if fewer), chosen by hash of doc_id, and at most that many passages of each, so that what comes to the driver is bounded however long texts are. docs: doc_id, text; labels: doc_id, label."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    known = {r["doc_id"]: r["label"] for r in chosen.collect()}
    if len(set(known.values())) < 2:
        return None
    picked = docs.sparkSession.createDataFrame(list(known.items()), ["doc_id", "label"])
    rows = docs.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, chars=PART, each=PASSAGE):
            x, bags = encode_passages([t.encode() for t in texts])
            ends = np.cumsum(bags)
            blobs = [x[e - b : e][drawn(int(b), most, i)].astype(np.float16).tobytes() for e, b, i in zip(ends, bags, batch.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(blobs, pa.binary())], names=["doc_id", "label", "passages"])

    found = sorted(rows.select("doc_id", "text", "label").transform(map_batches, run, "doc_id long, label long, passages binary").collect())
    if len({r["label"] for r in found}) < 2:
        return None
    x = [np.frombuffer(r["passages"], np.float16).reshape(-1, FEATURES) for r in found]
    return fit(np.concatenate(x).astype(np.float32), np.array([len(p) for p in x]), np.array([r["label"] for r in found], np.float32))


def score(df: DataFrame, model: AttentionModel | None, name: str = "score") -> DataFrame:
    """df with the probability of label 1, under that name, for every row's whole text."""
    schema = df.select("*", F.lit(0.0).alias(name)).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, chars=PART, each=PASSAGE):
            scores = np.full(len(texts), 0.5) if model is None else model.scores([t.encode() for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.asarray(scores, np.float64))], names=[*batch.schema.names, name])

    return df.transform(map_batches, run, schema)


def learnable(df: DataFrame) -> DataFrame:
    return df.where(fold(F.col("doc_id"), 3) != 1)


def quality_model(docs: DataFrame, labels: DataFrame) -> AttentionModel | None:
    """Fitted on the labels outside the held-out fold (crc32 of doc_id as text, modulo 3, is 1)."""
    return train(learnable(docs.select(F.col("doc_id").cast("long"), "text")), learnable(labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("long").alias("label"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score(docs, quality_model(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
