"""Secret scans: fixed patterns plus sliding-window Shannon entropy.

The method: runs of secret-like characters (candidates) are split into runs of
one character class; a window slides along each run, its Shannon entropy is kept
up by changing two counts a step, and windows at or over the class's threshold
merge into spans. Candidates that the allow list matches add no spans; spans of
the fixed patterns are never suppressed.

Null and empty texts have no spans. Rows are scanned by themselves, so repeated
rows give repeated results, and columns beside the text are left alone.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import documents, map_batches, slices

#: Kinds in the order that breaks ties of start.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class EntropyClass:
    kind: str
    run: str
    window: int
    threshold: float
    must: tuple[str, ...] = ()


@dataclass(frozen=True)
class SecretScan:
    """Production parameters: thresholds are bits a character in one window."""

    classes: tuple[EntropyClass, ...] = (
        EntropyClass("entropy_hex", r"[0-9A-Fa-f]{20,}", 20, 3.0, (r"[0-9]", r"[A-Fa-f]")),
        EntropyClass("entropy_base64", r"[A-Za-z0-9+/_=-]{20,}", 20, 3.7, (r"[0-9]", r"[A-Za-z]")),
    )
    #: Whole candidates that are no secrets: digests of nothing, runs in order, one repeated piece, separators.
    allow: tuple[str, ...] = field(
        default=(
            r"d41d8cd98f00b204e9800998ecf8427e",
            r"da39a3ee5e6b4b0d3255bfef95601890afd80709",
            r"e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
            # each 0 has one place, so that a long run of digits that doesn't match fails at once
            r"(?i:0?123456789abcdef)*(?:0?123456789(?:0{0,2}123456789)*0?)?",
            r"(.{1,8})\1+.?",
            r"[A-Za-z]+(?:[_/-][A-Za-z]+)*",
        )
    )


def entropy_windows(run: str, window: int, threshold: float) -> list[tuple[int, int]]:
    """Merged [start, end) of the windows of that length whose entropy is at least the threshold."""
    cost = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, spans, least = 0.0, [], (math.log2(window) - threshold) * window + 1e-9
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        total += cost[n + 1] - cost[n]
        counts[c] = n + 1
        if i >= window:
            n = counts[out := run[i - window]]
            total += cost[n - 1] - cost[n]
            counts[out] = n - 1
        if i >= window - 1 and total <= least:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(text: str, candidates: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns. Access and hex spans have 20 characters or more, all of them candidate characters, so only candidates are searched."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    for start, end in candidates:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text, start, end) if m.end() - m.start() >= 20]
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text, start, end) if m.end() - m.start() >= 24]
    return found


def scanner(settings: SecretScan):
    """A function from a text to (base spans, added spans), each of (kind, start, end)."""
    allow = [re.compile(x) for x in settings.allow]
    classes = [(c, re.compile(c.run), [re.compile(m) for m in c.must]) for c in settings.classes]

    def scan(text: str):
        candidates = [m.span() for m in CANDIDATE.finditer(text)]
        base, added = base_spans(text, candidates), []
        for start, end in candidates:
            candidate = text[start:end]
            if any(a.fullmatch(candidate) for a in allow):
                continue
            for c, run, must in classes:
                for m in run.finditer(candidate):
                    for a, b in entropy_windows(m[0], c.window, c.threshold):
                        piece = candidate[m.start() + a : m.start() + b]
                        if all(x.search(piece) for x in must):
                            added.append((c.kind, start + m.start() + a, start + m.start() + b))
        order = lambda s: (s[1], KINDS.index(s[0]) if s[0] in KINDS else len(KINDS))
        base = sorted(base, key=order)
        starts, reach = [b[1] for b in base], list(accumulate((b[2] for b in base), max, initial=-1))
        # a span inside a base span ends before the furthest end of those that start no later
        added = [s for s in added if s[2] > reach[bisect_right(starts, s[1])]]
        return base, sorted(added, key=order)

    return scan


SPAN = "array<struct<kind:string,start:int,end:int>>"
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_secrets(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: SecretScan = SecretScan()) -> DataFrame:
    """id, base_spans and added_spans (arrays of kind, start, end in code points) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(settings)
        for part, texts in slices(batches):
            pairs = [scan(t) for t in texts]
            spans = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in p[k]] for p in pairs], _SPAN_ARROW) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), *spans], names=["id", "base_spans", "added_spans"])

    kind = df.schema[id_column].dataType.simpleString()
    out = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).transform(map_batches, run, f"id {kind}, base_spans {SPAN}, added_spans {SPAN}")
    return out.withColumnRenamed("id", id_column)


def redact_secrets(df: DataFrame, text_column: str = "text", mark: str = "[SECRET]", settings: SecretScan = SecretScan()) -> DataFrame:
    """df with every span (overlapping ones as one) of the text replaced by the mark; other columns, n_chars included, keep their type, n_chars is counted anew."""
    at = df.columns.index(text_column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(settings)
        for batch, texts in slices(batches, text_column):
            out = []
            for text in texts:
                spans = sorted((s[1], s[2]) for k in scan(text) for s in k) if text else []
                if spans:
                    parts, done = [], 0
                    for a, b in spans:
                        if a >= done:
                            parts += [text[done:a], mark]
                        done = max(done, b)
                    text = "".join([*parts, text[done:]])
                out.append(text)
            columns = batch.columns
            columns[at] = pa.array(out, columns[at].type, mask=columns[at].is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = df.transform(map_batches, run, df.schema)
    if "n_chars" in df.columns and text_column == "text":
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(df.schema["n_chars"].dataType)))
    return out


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, how many spans of each fixed kind, the digest of these, and all spans joined, of rows of find_secrets()."""
    of = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    order = F.array_sort(
        F.transform(
            F.concat("base_spans", "added_spans"),
            lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )
    return found.withColumn("all_spans", order).select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(_joined("base_spans").cast("binary"), 256).alias("base_sha256"),
        _joined("all_spans").alias("spans"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find_secrets(documents(spark, sf_dir)))
