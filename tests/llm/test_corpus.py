"""The corpus operators against brute force, libraries and hard inputs."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from flowloom.llm import attention_quality, byte_bpe, components, cover_dedup, dealing, filter_audit, iblt_fingerprints, license_scan, nce_language_model, parity_join, piece_counts, prefix_trie, qgram_decontam, queries, secret_scan, suffix_arrays, suffix_dedup
from flowloom.llm.common import documents, map_batches
from flowloom.llm.words import windows, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
ODD = ["", " ", "a", "  a  b\n\n c\t\td ", "don't they'll", "▁x ▁", "日本語 一二三 ²½ ①", "a\x1cb\x85d\xa0e", "x" * 3000, "🙂🙂 ok", "\r\nq", "<s> </s><0x0A>\x00", "ﬁ​﻿"]


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    long = " ".join(f"w{i % 977}" for i in range(20000))
    base = " ".join(f"v{i}" for i in range(120))
    rows = [(0, base), (1, base + " tail"), (2, None), (3, ""), (None, base), (None, None), (4, long), (4, long), (5, "one"), (6, "one"), (7, base.upper()), (8, "x " * 400)]
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 7, "k", b"p") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, score int, bucket string, payload binary")
    for name in ("_copy", "_bad", "_row", "_key", "_range", "copy", "again", "leak", "Key", "range", "named", "part", "label"):
        df = df.withColumn(name, F.lit(name))
    return df.coalesce(2)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in documents(spark, SMALL).collect()}


def empty(df):
    return df.where("1 = 0")


# --- tokens -------------------------------------------------------------------


def test_bpe_is_the_librarys(texts):
    import public_tokenizers
    import tiktoken

    bpe = byte_bpe.tokenizer(byte_bpe.RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    rng = random.Random(1)
    mixed = ["".join(rng.choice(" \n\tabcé'123½一🙂.!▁\x1c ") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    every = [*ODD, *mixed, *texts.values()]
    for text, raw in zip(every, bpe.encode_batch(every), strict=True):
        ids = np.frombuffer(raw, np.int32).tolist()
        assert ids == library.encode_ordinary(text) and bpe.decode(ids) == text.encode()


def test_counts_are_the_librarys(texts):
    import public_tokenizers
    import sentencepiece

    counter = piece_counts.counter(piece_counts.MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_counts.MODEL))
    for text in [*ODD, *texts.values()]:
        assert counter.count(text) == len(library.encode(text))


def test_positions_of_long_pieces_fit():
    """A leaf or heap entry keeps rank and position apart at any length of a text, and merges of one long piece are those of the library."""
    import public_tokenizers
    import tiktoken

    assert ((1 << 20) - 1 << byte_bpe._SHIFT) + (1 << 33) < byte_bpe._NONE and piece_counts._POSITION > 1 << 33
    with pytest.raises(ValueError):
        byte_bpe.ByteBPE({b"a": 1 << 20}, ".")
    bpe = byte_bpe.tokenizer(byte_bpe.RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    rng = random.Random(4)
    piece = "".join(rng.choice("abcdefghij") for _ in range(40_000))
    assert np.frombuffer(bpe.merge([piece.encode()])[0], np.int32).tolist() == library.encode_ordinary(piece)


def test_a_word_is_merged_once(monkeypatch):
    """Words that batches share stay known when the tables are full of others; with a full stop or comma behind, a word is the same piece."""
    full = byte_bpe.tokenizer(byte_bpe.RANKS)
    bpe, merged = byte_bpe.ByteBPE(full.ranks, byte_bpe_pattern(), remember=300), collections.Counter()
    monkeypatch.setattr(bpe, "merge", lambda pieces, inner=bpe.merge: merged.update(pieces) or inner(pieces))
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bcdfghjkqxz") for _ in range(rng.randint(5, 20)))
    common = [word() for _ in range(40)]
    for _ in range(12):
        text = " ".join([*common, *(word() + rng.choice(("", ".", ",")) for _ in range(200))])
        ids = bpe.encode_batch([text])[0]
        assert bpe.decode(np.frombuffer(ids, np.int32).tolist()) == text.encode()
        assert len(bpe.known) + len(bpe.spaced) < 1000
    assert max(merged[f" {w}".encode()] for w in common) == 1
    for end in ("", ".", ","):
        bpe.encode_batch([f"a qzxjkqzx{end}"])
    assert merged[b" qzxjkqzx"] == 1


def byte_bpe_pattern():
    import public_tokenizers

    return public_tokenizers.PATTERN


def test_trees_of_any_width_merge_alike():
    bpe, rng = byte_bpe.tokenizer(byte_bpe.RANKS), random.Random(11)
    for bits in range(1, 8):
        low, high = (1 << bits - 1) + 1, 1 << bits
        pieces = [" ".join(rng.choice(("the", "ing", "er", "é", "q", "日", "on")) for _ in range(high)).replace(" ", "").encode()[: rng.randint(low, high)] for _ in range(60)] + [b"a"] * (bits == 1)
        want = [bpe._merge_one(p) for p in pieces]
        assert bpe.merge(pieces) == bpe._merge_width(pieces, high) == bpe._merge_levels(pieces, high) == want


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "a", "ab", "一二三四五六七八九十百千", "é ñ".replace(" ", "")])
def test_unbroken_pieces(alphabet):
    """Long pieces one by one and side by side, against the library; 300,000 letters in seconds."""
    import public_tokenizers
    import tiktoken

    bpe = byte_bpe.tokenizer(byte_bpe.RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    rng = random.Random(2)
    for n in (1, 2, 3, 17, 900):
        piece = "".join(rng.choice(alphabet) for _ in range(n)).encode()
        want = np.array(library._encode_single_piece(piece), np.int32).tobytes()
        assert bpe._merge_one(piece) == want and bpe._merge_width([piece] * 2, max(2, 1 << (len(piece) - 1).bit_length())) == [want] * 2
    began = time.monotonic()
    ids = np.frombuffer(bpe._merge_one("".join(rng.choice(alphabet) for _ in range(300_000)).encode()[:300_000]), np.int32)
    assert time.monotonic() - began < 30 and len(ids)


def test_token_queries_on_hard_rows(hard):
    got = byte_bpe.digests(byte_bpe.encode(hard, decoded=True)).collect()
    assert len(got) == 12 and collections.Counter(r.n_tokens == 0 for r in got)[True] == 3
    back = byte_bpe.decode(byte_bpe.encode(hard)).collect()
    assert sorted(bytes(r.decoded).decode() for r in back) == sorted((r.text or "") for r in hard.collect())
    assert sorted(r.n_bytes for r in piece_counts.count_tokens(hard).collect()) == sorted(len((r.text or "").encode()) for r in hard.collect())
    assert byte_bpe.encode(empty(hard)).count() == piece_counts.count_tokens(empty(hard)).count() == 0


# --- secrets ------------------------------------------------------------------


def _base(text):
    out = []
    for kind, pattern, least, group in (("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2), ("access", "AKIA[A-Z0-9]+", 20, 0), ("hex", "[0-9a-f]+", 24, 0)):
        for m in re.finditer(pattern, text, re.I | re.A if kind == "assign" else 0):
            if len(m[group]) >= least:
                out.append((m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return sorted(out)


def test_secrets_against_plain_patterns(spark, texts):
    planted = {10_000: 'x API_KEY = "abcdef" y password:short Token: 12345', 10_001: "AKIA" + "Z9" * 8 + " " + "deadbeef" * 3, 10_002: "ſecret=abcdefgh toKen=ABCDEFGH", 10_003: "k9X2mQ7vL4tB8nR3wZ6yJ1"}
    every = texts | planted
    df = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in secret_scan.find_secrets(df).collect()}
    for doc, text in every.items():
        assert [f"{s.kind}:{s.start}:{s.end}" for s in found[doc].base_spans] == [x[2] for x in _base(text)]
    assert [s.kind for s in found[10_003].added_spans] == ["entropy_base64"]
    digest = {r.doc_id: r for r in secret_scan.query(spark, SMALL).collect()}
    for doc, text in texts.items():
        assert digest[doc].base_sha256 == hashlib.sha256(",".join(x[2] for x in _base(text)).encode()).hexdigest()


def _all_spans(text):
    """Every span as the query joins them: base spans, and windows of 20 characters of one class, of enough entropy, merged by place, outside the allow list and not inside a base span."""
    scan_settings = secret_scan.SecretScan()
    base = [(a, "assign access hex".split()[k], int(x.split(":")[2])) for a, k, x in _base(text)]
    out = [(a, k, e) for a, k, e in base]
    for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", text):
        if any(re.fullmatch(a, m[0]) for a in scan_settings.allow):
            continue
        for c in scan_settings.classes:
            for r in re.finditer(c.run, m[0]):
                on = [False] * (len(r[0]) + 1)
                for i in range(len(r[0]) - c.window + 1):
                    n = collections.Counter(r[0][i : i + c.window])
                    if -sum(x / c.window * math.log2(x / c.window) for x in n.values()) >= c.threshold - 1e-9:
                        on[i : i + c.window] = [True] * c.window
                i = 0
                while i < len(on):
                    if on[i]:
                        j = on.index(False, i)
                        a, b = m.start() + r.start() + i, m.start() + r.start() + j
                        if all(re.search(x, text[a:b]) for x in c.must) and not any(a >= x and b <= z for x, _, z in base):
                            out.append((a, c.kind, b))
                        i = j
                    i += 1
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(out, key=lambda s: (s[0], secret_scan.KINDS.index(s[1]), s[2])))


def test_all_spans_against_every_window(spark, texts):
    rng = random.Random(7)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
    planted = {20_000 + n: " ".join("".join(rng.choice(rng.choice([alphabet, "0123456789abcdef", "ab1", "0123456789ABCDEF"])) for _ in range(rng.randint(5, 90))) for _ in range(6)) for n in range(60)}
    planted |= {21_000: 'token="k9X2mQ7vL4tB8nR3wZ6yJ1" and k9X2mQ7vL4tB8nR3wZ6yJ1', 21_001: "abc" * 20 + " d41d8cd98f00b204e9800998ecf8427e " + "0123456789abcdef" * 2}
    every = texts | planted
    df = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secret_scan.digests(secret_scan.find_secrets(df)).collect()}
    assert got == {i: _all_spans(t) for i, t in every.items()} and sum("entropy" in x for x in got.values()) > 10


@given(st.lists(st.sampled_from(["0", "123456789", "0123456789abcdef", "1234567890", "123456789ABCDEF", "x"]), max_size=9).map("".join))
@settings(max_examples=200, deadline=None)
def test_runs_in_order_are_allowed(text):
    """The allow list's runs in order against the plain pattern, on texts short enough for it."""
    allow = re.compile(secret_scan.SecretScan().allow[3])
    assert bool(allow.fullmatch(text)) == bool(re.fullmatch(r"(?i:0?123456789abcdef)*(?i:0?1234567890?)*", text))


@pytest.mark.parametrize("unit", ["1234567890", "0123456789abcdef", "0", "ab", "a-", "x1Y", "token=", "token   ", "AKIA", "password:abcdef1 ", "deadbeef", "/_-="])
@pytest.mark.parametrize("tail", ["", "x", "!", " :"])
def test_long_regular_runs_take_no_time(unit, tail):
    scan = secret_scan.scanner(secret_scan.SecretScan())
    text = unit * (20_000 // len(unit)) + tail
    began = time.monotonic()
    base, _ = scan(text)
    assert time.monotonic() - began < 1
    assert [f"{k}:{a}:{b}" for k, a, b in base] == [x[2] for x in _base(text)]


@given(st.text("ab12Z", max_size=60))
@settings(max_examples=60, deadline=None)
def test_entropy_windows(run):
    want = set()
    for i in range(len(run) - 7):
        c = collections.Counter(run[i : i + 8])
        if -sum(n / 8 * math.log2(n / 8) for n in c.values()) >= 2 - 1e-12:
            want |= set(range(i, i + 8))
    assert {x for a, b in secret_scan.entropy_windows(run, 8, 2.0) for x in range(a, b)} == want


def test_redaction_on_hard_rows(spark, hard):
    df = hard.unionByName(spark.createDataFrame([(9, "say token=abcdefgh now", 22)], "doc_id long, text string, n_chars long"), allowMissingColumns=True)
    got = secret_scan.redact_secrets(df)
    assert got.schema == df.schema and got.where("doc_id = 9").first().text == "say [SECRET] now" and got.where("doc_id = 9").first().n_chars == 16
    assert got.where("doc_id <> 9 or doc_id is null").exceptAll(hard).isEmpty()
    assert secret_scan.redact_secrets(empty(hard)).count() == 0


# --- fingerprints -------------------------------------------------------------


def test_fingerprints(spark, texts):
    got = {r.doc_id: r for r in iblt_fingerprints.query(spark, SMALL).collect()}
    ids = sorted(texts)
    for i, doc in enumerate(ids):
        own, following = texts[doc], ids[(i + 1) % len(ids)]
        k, r = len(own) // 4, got[doc]
        edited = own[: len(own) - k] + texts[following][:k]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert iblt_fingerprints.compare(r.fingerprint, r.edited_fingerprint) == pytest.approx(r.near_edited)
        assert iblt_fingerprints.compare(r.fingerprint, got[following].fingerprint) == pytest.approx(r.near_next)
        assert len(iblt_fingerprints.listed(r.fingerprint)) == int(r.fingerprint.split(".")[0])
    by_text = collections.defaultdict(set)
    for doc, text in texts.items():
        by_text[text].add(got[doc].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())


@given(st.lists(st.integers(0, 2**63), unique=True, max_size=80), st.lists(st.integers(0, 2**63), unique=True, max_size=80))
@settings(max_examples=40, deadline=None)
def test_sketches_find_the_difference(a, b):
    b = b + a[: len(a) // 2]
    keys = [np.array(sorted(set(x)), np.uint64) for x in (a, b)]
    zero = [(k, np.zeros(len(k), np.int64)) for k in keys]
    assert iblt_fingerprints.differing(*zero, 1, np.array([1]))[0] == len(set(a) ^ set(b))


def test_next_of_large_ids(spark):
    ids = [(1 << 60) + i for i in range(20)]
    df = spark.createDataFrame([(i, f"{99 - n}") for n, i in enumerate(ids)], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in iblt_fingerprints.with_next(df).collect()}
    assert got == {i: f"{99 - (n + 1) % 20}" for n, i in enumerate(ids)}


def test_fingerprints_on_hard_rows(spark, hard):
    docs = hard.select("doc_id", "text").fillna("", ["text"])
    with_next = iblt_fingerprints.with_next(docs)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text))
    want = collections.Counter((r.doc_id, r.text, rows[(i + 1) % len(rows)].text) for i, r in enumerate(rows))
    assert collections.Counter((r.doc_id, r.text, r.next_text) for r in with_next.collect()) == want
    assert iblt_fingerprints.with_next(empty(docs)).count() == 0
    one = iblt_fingerprints.with_next(docs.where("doc_id = 5")).collect()
    assert [r.next_text for r in one] == ["one"]


# --- quality ------------------------------------------------------------------


def test_quality_learns(spark, texts):
    docs = documents(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in attention_quality.query(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    held = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert sum(a > b for a in good for b in bad) > 0.95 * len(good) * len(bad)


def test_quality_gradients():
    rng = np.random.default_rng(0)
    x, bags, label = rng.normal(size=(7, 5)), np.array([2, 1, 4]), np.array([1.0, 0.0, 1.0])
    model = attention_quality.fit(x, bags, label, hidden=4, gate=3, rounds=1)
    model.weights = {k: np.asarray(v, np.float64) for k, v in model.weights.items()}
    grads, one = model.gradients(x, bags, label, np.ones(3)), np.ones(3)

    def loss():
        p = model.forward(x, bags)["score"]
        return -np.mean(one * (label * np.log(p) + (1 - label) * np.log(1 - p)))

    for k, g in grads.items():
        if k == "d":
            continue
        at = tuple(0 for _ in model.weights[k].shape)
        old = model.weights[k][at]
        model.weights[k][at] = old + 1e-5
        up = loss()
        model.weights[k][at] = old - 1e-5
        down = loss()
        model.weights[k][at] = old
        assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_quality_of_long_texts_by_parts():
    rng = np.random.default_rng(6)
    texts = [bytes(rng.choice(np.frombuffer(b"abc de\n\xc3\xa9", np.uint8), n).tobytes()) for n in (0, 1, 599, 600, 601, 5000, 700_001)]
    x, bags = attention_quality.encode_passages(texts)
    assert bags.tolist() == [1, 1, 1, 1, 2, 9, 1167]
    again, _ = attention_quality.encode_passages([t[i : i + 600] for t in texts for i in range(0, max(1, len(t)), 600)])
    assert np.array_equal(x, again)  # a passage is encoded by its own bytes alone
    model = attention_quality.fit(x, bags, np.array([0, 1, 0, 1, 0, 1, 0], np.float32), rounds=2)
    assert np.allclose(model.scores(texts), model.forward(x, bags)["score"], atol=1e-5)
    assert np.allclose(model.scores(texts[-1:]), model.forward(x, bags)["score"][-1:], atol=1e-5)


def test_the_fit_is_bounded_in_passages(spark):
    for n, most in ((5, 64), (64, 64), (1000, 64)):
        at = attention_quality.drawn(n, most, 77)
        assert len(at) == min(n, most) == len(set(at.tolist())) and at.tolist() == sorted(at.tolist()) and at[-1] < n
    long = [(i, ("good words here " if i % 2 else "zzz qqq xxx ") * 20_000) for i in range(8)]
    docs = spark.createDataFrame(long, "doc_id long, text string")
    model = attention_quality.train(docs, spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, label long"), most=3)
    got = {r.doc_id: r.score for r in attention_quality.score(docs, model).collect()}
    assert all((got[i] > 0.5) == (i % 2 == 1) for i in got)


def test_quality_learns_from_one_text_of_an_id(spark):
    rows = [(i, f"{'good words here ' if i % 2 else 'zzz qqq '}{i}") for i in range(40)] + [(1, "zzz"), (1, "another")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, label long")
    models = [attention_quality.train(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels) for r, n in ((rows, 1), (rows[::-1], 7))]
    assert all(np.array_equal(models[0].weights[k], models[1].weights[k]) for k in models[0].weights)


def test_quality_on_hard_rows(spark, hard):
    labels = spark.createDataFrame([(0, 1), (4, 0), (4, 0), (5, None), (None, 1), (8, 0), (3, 5)], "doc_id long, label long")
    model = attention_quality.train(hard.select("doc_id", "text"), labels)
    scored = attention_quality.score(hard, model, "_score")
    assert scored.count() == 12 and scored.where("_score is null or _score < 0 or _score > 1").count() == 0
    assert attention_quality.train(hard.select("doc_id", "text"), labels.where("label = 1")) is None
    assert attention_quality.score(empty(hard), None, "_score").count() == 0


# --- language model -----------------------------------------------------------


def test_language_model(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in documents(spark, sf).collect()}
    got = {r.doc_id: r for r in nce_language_model.language_model_scores(documents(spark, sf), nce_language_model.LanguageModel(head=3000)).collect()}
    counts, tokens = collections.Counter(), {}
    for doc, text in texts.items():
        tokens[doc] = [*WORD.findall(text.translate(LOW)), None]
        if zlib.crc32(str(doc).encode()) % 5 != 1:
            counts.update(tokens[doc])
    total, distinct = sum(counts.values()), len(counts)
    for doc, ws in tokens.items():
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        r = got[doc]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(ws), sum(counts[w] > 0 for w in ws), total, zlib.crc32(str(doc).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)


def test_language_model_is_normalised():
    settings_ = nce_language_model.LanguageModel(words=5, classes=3, size=4)
    weights = nce_language_model.start_weights(settings_, np.full(9, 1 / 9))
    t1, t2, z = nce_language_model.score_tables(weights)
    for a in range(9):
        for b in range(9):
            assert (10.0 ** (t1[a] + t2[b] - z[a, b])).sum() == pytest.approx(1, rel=1e-4)


def test_language_model_of_any_split(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    small = nce_language_model.LanguageModel(words=300, classes=64, modelled=2000, head=5000, part=150_000, rounds=2)
    one, many = ({r.doc_id: r for r in nce_language_model.language_model_scores(docs.repartition(n), small).collect()} for n in (1, 16))
    assert one.keys() == many.keys() and all(many[d].score == pytest.approx(r.score, rel=1e-6) for d, r in one.items())


def test_language_model_beats_the_base(spark):
    for n in (1, 16):
        held = nce_language_model.language_model_scores(documents(spark, "/root/testdata/sf0.01").repartition(n)).where("held_out")
        r = held.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base_score")).first()
        assert r.score > 0.95 * r.base_score


def test_members_of_classes_are_normalised():
    rng, class_ = np.random.default_rng(1), np.array([0, 0, 0, 1, 2, 2])
    w = {"u": rng.normal(size=(130, 3)), "m": rng.normal(size=(6, 3)), "a": rng.normal(size=6)}
    p = np.exp(w["u"] @ w["m"].T + w["a"] - nce_language_model.class_sums(w, class_)[:, class_])
    assert np.allclose(np.add.reduceat(p, [0, 3, 4], axis=1), 1)


def test_members_learn_from_every_token():
    class Seen(nce_language_model.Trainer):
        def step_below(self, s1, member):
            met.extend(zip(s1.tolist(), member.tolist(), strict=True))
            super().step_below(s1, member)

    met = []
    small = nce_language_model.LanguageModel(words=3, classes=2, modelled=4, size=4, below=3, batch=16)
    class_, share, even = np.array([0, 0, 0, 1, 1, 1]), np.array([0.5, 0.25, 0.25] * 2), np.full(6, 1 / 6)
    trainer = Seen(small, nce_language_model.start_weights(small, even, share), even, (class_, share), [1])
    codes = np.append(np.random.default_rng(2).integers(0, 10, 500), 0)
    trainer.learn(codes)
    ids, member = nce_language_model.symbols_of(codes, class_, small)
    before = nce_language_model.contexts(ids, np.flatnonzero(codes == 0))[0]
    assert sorted(met) == sorted((s, m) for s, m in zip(before.tolist(), member.tolist(), strict=True) if m >= 0) and len(met) > 200
    assert trainer.tokens == len(codes)


def test_a_step_costs_by_its_batch():
    """Of many symbols and members, only those of the batch move, and no array is as large as all of them."""
    many = nce_language_model.LanguageModel(words=400_000, classes=100, batch=64)
    even, class_ = np.full(many.symbols, 1 / many.symbols), np.repeat(np.arange(100), 1000)
    share = np.full(len(class_), 0.001)
    trainer = nce_language_model.Trainer(many, nce_language_model.start_weights(many, even, share), even, (class_, share), [1])
    before = {k: w.copy() for k, w in trainer.w.items()}
    rng = np.random.default_rng(3)
    s1, s2, target, member = *rng.integers(0, many.symbols, (3, 64)), rng.integers(0, len(class_), 64)
    tracemalloc.start()
    trainer.step(s1, s2, target)
    trainer.step_below(s1, member)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000
    moved = {k: np.flatnonzero((w != before[k]).reshape(len(w), -1).any(axis=1)) for k, w in trainer.w.items()}
    assert moved["q"].tolist() == np.unique([s1, s2]).tolist() and moved["u"].tolist() == np.unique(s1).tolist()
    assert set(target) <= set(moved["r"]) and len(moved["r"]) <= 64 + many.noise and set(member) <= set(moved["m"]) and len(moved["m"]) <= 64 * (1 + many.others)


def test_members_are_drawn_by_their_shares():
    rng = np.random.default_rng(4)
    class_, share = np.repeat(np.arange(3), [1, 3000, 40]), rng.random(3041) ** 9
    share /= np.bincount(class_, share)[class_]
    small = nce_language_model.LanguageModel(words=3, classes=3)
    even = np.full(small.symbols, 1 / small.symbols)
    trainer = nce_language_model.Trainer(small, nce_language_model.start_weights(small, even, share), even, (class_, share), [1])
    drawn = np.concatenate([rng.random(5000) * 3, trainer.shares[::7], np.nextafter(trainer.shares[::7], 0), [0, 3 - 2**-52]])
    drawn = drawn[drawn < 3]
    assert (trainer._others(drawn) == np.minimum(np.searchsorted(trainer.shares, drawn), 3040)).all()


def test_language_model_on_hard_rows(hard):
    small = nce_language_model.LanguageModel(words=20, classes=4, head=50)
    got = nce_language_model.language_model_scores(hard.select("doc_id", "text"), small).collect()
    assert len(got) == 12 and sorted(r.n_tokens for r in got)[:3] == [1, 1, 1]
    assert nce_language_model.language_model_scores(empty(hard).select("doc_id", "text"), small).count() == 0


# --- near copies --------------------------------------------------------------


def _shingles(text, k):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def _components(sets, t):
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = collections.defaultdict(list)
    for i in sorted(sets):
        shared = collections.Counter(j for g in sets[i] for j in where[g])
        for j, n in shared.items():
            if 100 * n >= t * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in sets[i]:
            where[g].append(i)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize(("k", "t"), [(4, 85), (5, 80)])
def test_near_copies_against_all_pairs(spark, texts, k, t):
    rng = random.Random(5)
    every = dict(texts)
    for n in range(60):  # chains of copies, each a little further from the first
        ws = every[10_000 + n - 1].split() if n % 12 else [f"u{rng.randint(0, 50)}" for _ in range(rng.randint(3, 150))]
        for _ in range(len(ws) // 30):
            ws[rng.randrange(len(ws))] = f"z{n}"
        every[10_000 + n] = " ".join(ws)
    df = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    sets = {i: _shingles(x, k) for i, x in every.items()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity_join.jaccard_components(df, parity_join.JaccardJoin(shingle=k, threshold=t)).collect()}
    want = _components(sets, t)
    assert got == {i: (len(sets[i]), want[i]) for i in every}


@pytest.mark.parametrize("most_words", [1, 1 << 21])
def test_contested_pairs_against_all_pairs(most_words):
    rng, join = np.random.default_rng(3), parity_join.JaccardJoin()
    base = rng.integers(1, 2**63, 120, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(120) > rng.uniform(0, 0.2)], rng.integers(1, 2**63, int(rng.integers(0, 15)), dtype=np.uint64)])) for _ in range(50)]
    nodes, components_, sizes = np.arange(50), rng.integers(0, 6, 50), np.array([len(x) for x in sets])
    drawn = [parity_join.bit_sketch(x) for x in sets]
    size = min(map(len, drawn))
    apart = {(x, y): int(np.bitwise_count(parity_join.folded(drawn[x], size) ^ parity_join.folded(drawn[y], size)).sum()) for x in range(50) for y in range(x + 1, 50)}
    want = {p: d for p, d in apart.items() if components_[p[0]] != components_[p[1]] and d <= join.differ(sizes[p[0]], sizes[p[1]]) and abs(sizes[p[0]] - sizes[p[1]]) <= join.differ(sizes[p[0]], sizes[p[1]])}
    blocks = list(parity_join.contested_pairs(nodes, components_, sizes, drawn, join, most_words))
    got = [(int(x), int(y), int(d)) for xs, ys, ds in blocks for x, y, d in zip(xs, ys, ds, strict=True)]
    assert want and len(got) == len(want) and {(min(x, y), max(x, y)): d for x, y, d in got} == want
    x, y, more = parity_join.nearest_pairs(50, blocks)
    ends = {i: min(d for p, d in want.items() if i in p) for i in range(50) if any(i in p for p in want)}
    chosen = set(zip(x.tolist(), y.tolist(), strict=True))
    assert chosen <= set(want) and all(any(i in p and want[p] == d for p in chosen) for i, d in ends.items())
    assert set(more.tolist()) == (set(ends) if len(want) > len(chosen) else set())


@pytest.mark.parametrize("t", [80, 85])
def test_short_sets_meet_by_content_alone(t):
    join = parity_join.JaccardJoin(threshold=t)
    bands, rng = join.edges_of_bands(1000), np.random.default_rng(t)
    draw = lambda n: np.unique(rng.integers(1, 2**63, n, dtype=np.uint64))
    apart = np.concatenate([np.unique(parity_join.segment_keys(draw(n), join, bands)) for n in np.repeat(np.arange(1, 40), 20)])
    assert len(set(apart.tolist())) == len(apart)  # sets without a shingle in common share no key
    for n in np.repeat(np.arange(4, 60), 60).tolist():
        a = draw(n)
        b = np.unique(np.concatenate([a[rng.random(n) > 0.08], draw(int(rng.integers(0, 3)))]))
        both = len(np.intersect1d(a, b))
        if len(b) != both or n != both:
            linked = 100 * both >= t * (n + len(b) - both)
            assert not linked or len(np.intersect1d(parity_join.segment_keys(a, join, bands), parity_join.segment_keys(b, join, bands)))


def test_sparse_sets_meet_by_their_least_shingles():
    join = parity_join.JaccardJoin(threshold=80)
    bands, rng, met = join.edges_of_bands(1000), np.random.default_rng(4), 0
    for _ in range(4000):
        a = np.unique(rng.integers(1, 2**63, 5, dtype=np.uint64))
        met += len(np.intersect1d(parity_join.segment_keys(a, join, bands), parity_join.segment_keys(a[1:], join, bands))) > 0
    assert met == 4000


def test_crowded_segments_in_blocks(spark):
    rng, base = random.Random(8), [f"b{i}" for i in range(60)]
    every = {i: " ".join(f"z{rng.randint(0, 400)}" if rng.random() < 0.03 else w for w in base) for i in range(80)}
    df = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    want = _components({i: _shingles(x, 4) for i, x in every.items()}, 85)
    join = parity_join.JaccardJoin(shingle=4, threshold=85, block=3)
    assert {r.doc_id: r.component_id for r in parity_join.jaccard_components(df, join).collect()} == want
    rows = spark.range(50).selectExpr("0L as key", "17 as parts", "id as node")
    pairs = [(r.low, r.high, r.side, r.node) for r in parity_join.blocks_met(rows).collect()]
    at = collections.defaultdict(lambda: ([], []))
    for low, high, side, node in pairs:
        at[low, high][side].append(node)
    met = [frozenset(p) for (low, high), (a, b) in at.items() for p in ([(x, y) for x in a for y in a if x < y] if low == high else [(x, y) for x in a for y in b])]
    assert len(met) == len(set(met)) == 50 * 49 // 2


@pytest.mark.parametrize("limits", [{"broadcast": 40, "small": 2, "block": 4, "task": 200}, {"small": 1000}])
def test_near_copies_at_any_limits(spark, texts, limits):
    """Hardly anything sent to all tasks, segments of two paths, several passes and many buckets: the same as all pairs."""
    rng, base = random.Random(12), [f"b{i}" for i in range(70)]
    every = {i: texts[i] for i in sorted(texts)[:120]}
    every |= {10_000 + i: " ".join(f"z{rng.randint(0, 400)}" if rng.random() < 0.035 else w for w in base) for i in range(60)}
    every |= {20_000 + i: every[10_000 + i % 7] for i in range(30)}
    df = spark.createDataFrame(list(every.items()), "doc_id long, text string").repartition(5)
    want = _components({i: _shingles(x, 4) for i, x in every.items()}, 85)
    join = parity_join.JaccardJoin(shingle=4, threshold=85, **limits)
    assert {r.doc_id: r.component_id for r in parity_join.jaccard_components(df, join).collect()} == want


def test_an_id_of_several_texts_links_as_each(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (5, a + " x"), (5, b), (7, b + " y"), (9, b), (11, "apart from all")]
    got = {(r.doc_id, r.component_id) for r in parity_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (5, 1), (7, 1), (9, 1), (11, 11)}


def test_near_copies_on_hard_rows(hard):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in parity_join.jaccard_components(hard).collect()), key=str)
    by_id = {g[0]: g[2] for g in got if g[0] is not None}
    assert len(got) == 12 and by_id == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 0, 8: 8}
    kept = parity_join.one_of_each(hard)
    assert kept.columns == hard.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["0", "2", "3", "4", "5", "8", "None", "None"]
    assert parity_join.jaccard_components(empty(hard)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 140)]
    want = _components({i: frozenset() for i in {x for e in edges for x in e}}, 0)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(want[a], want[b])
            changed |= want[a] != low or want[b] != low
            want[a] = want[b] = low
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(i, i) == c for i, c in want.items())


# --- repeats ------------------------------------------------------------------


def test_word_repeats_against_all_windows(spark, texts):
    got = {r.doc_id: r for r in cover_dedup.query(spark, SMALL).collect()}
    seen = set()
    for doc in sorted(texts):
        ws = WORD.findall(texts[doc])
        gone = [False] * len(ws)
        for a in range(len(ws) - 19):
            w = tuple(ws[a : a + 20])
            if w in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(w)
        kept = " ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        assert (got[doc].n_words, got[doc].n_removed, got[doc].kept_sha256) == (len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


def test_cover_is_a_difference_cover():
    assert {(a - b) % cover_dedup.PERIOD for a in cover_dedup.COVER for b in cover_dedup.COVER} == set(range(cover_dedup.PERIOD))
    assert cover_dedup.PERIOD - 1 + cover_dedup.ANCHOR <= cover_dedup.WINDOW


@pytest.mark.parametrize("crowd", [2, 2000])
def test_byte_repeats_against_all_windows(spark, texts, crowd):
    every = texts | {10_000: "ab" * 300, 10_001: "é" * 150, 10_002: "q" * 199, 10_003: "r" * 201}
    df = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeated_bytes(df, crowd).collect()}
    where = collections.Counter(t.encode()[i : i + 200] for t in every.values() for i in range(len(t.encode()) - 199))
    for doc, text in every.items():
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 199):
            if where[data[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        assert (got[doc].n_bytes, got[doc].n_removed, got[doc].n_spans) == (len(data), int(gone.sum()), spans)
        assert bytes(got[doc].kept) == np.frombuffer(data, np.uint8)[~gone].tobytes()


@given(st.lists(st.integers(1, 3), max_size=50), st.sampled_from([2, 300]))
@settings(max_examples=100, deadline=None)
def test_suffix_arrays(body, symbols):
    suffix_arrays.SYMBOLS, before = symbols, suffix_arrays.SYMBOLS
    try:
        s = np.array([*body, 0])
        order = suffix_arrays.suffix_array(s, 4)
    finally:
        suffix_arrays.SYMBOLS = before
    assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    shared = suffix_arrays.common_prefixes(s.astype(np.uint8), order, 16)
    for a, b in zip(order[:-1], order[1:], strict=True):
        n = next((k for k in range(17) if max(a, b) + k >= len(s) or s[a + k] != s[b + k]), 16)
        assert shared[b] == min(n, 16)


@pytest.mark.parametrize(("symbols", "rounds"), [(5, 64), (5, 2), (1 << 17, 64), (1 << 17, 2), (1 << 31, 3)])
def test_substrings_are_sorted_without_inducing(monkeypatch, symbols, rounds):
    """Substrings of all lengths, equal ones, ones that begin others, and long ones that are left to inducing."""
    monkeypatch.setattr(suffix_arrays, "ROUNDS", rounds)
    rng, left = random.Random(7), 0
    for _ in range(400):
        body = [rng.choice((1, 1, 1, 2, 3, 4)) for _ in range(rng.randrange(60))] + [rng.randrange(1, 4)] * rng.randrange(30)
        s = np.array([*body * rng.choice((1, 2, 3)), 0], np.int64)
        is_s = np.array([s[i:].tolist() < s[i + 1 :].tolist() for i in range(len(s) - 1)] + [True])
        lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
        if not len(lms):
            continue
        found = suffix_arrays._substrings_sorted(s, lms, symbols)
        if found is None:
            left += 1
            continue
        end = dict(zip(lms.tolist(), [*lms[1:].tolist(), len(s) - 1], strict=True))
        # an L suffix comes before an S suffix of the same symbol
        key = {i: [(int(s[j]), bool(is_s[j])) for j in range(i, end[i] + 1)] for i in lms.tolist()}
        names = {tuple(k): n for n, k in enumerate(sorted({tuple(k) for k in key.values()}))}
        assert [names[tuple(key[i])] for i in found[0].tolist()] == found[1].tolist() and sorted(found[0].tolist()) == lms.tolist()
    assert (left > 0) == (rounds < 64)


def test_a_level_is_induced_once(monkeypatch):
    made = []
    for name in ("_induced", "_induced_singly"):
        monkeypatch.setattr(suffix_arrays, name, lambda *a, inner=getattr(suffix_arrays, name): made.append(len(a[0])) or inner(*a))
    s = np.append(np.tile(np.random.default_rng(5).integers(1, 9, 700), 3), 0)
    order = suffix_arrays.suffix_array(s, 9)
    assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert len(made) == len(set(made)) > 2


def test_suffix_arrays_of_many_names():
    rng = np.random.default_rng(2)
    for n, k in ((2000, 1500), (5000, 40), (3000, 3000)):
        s = np.concatenate([rng.integers(1, k + 1, n), rng.integers(1, 3, n), [0]])
        s = np.concatenate([s[:-1], s])  # repeats, so names recur over several levels
        s[: len(s) - 1][s[: len(s) - 1] == 0] = 1
        order = suffix_arrays.suffix_array(s, k + 1)
        text = s.astype(">u4").tobytes()
        assert order.tolist() == sorted(range(len(s)), key=lambda i: text[4 * i :])


@pytest.mark.parametrize("parts", [1, 2])
def test_a_repeated_row_keeps_its_bytes(spark, parts):
    rng = random.Random(9)
    own, other = ("".join(rng.choice("abcdefgh ") for _ in range(900)) for _ in range(2))
    rows = [(1, own), (1, own), (2, other), (3, other[:300])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts) if parts > 1 else spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeated_bytes(df).collect())
    assert got == [(1, 0), (1, 0), (2, 300), (3, 300)]


def test_repeats_on_hard_rows(hard):
    docs = hard.select("doc_id", "text")
    words = cover_dedup.remove_repeats(docs).collect()
    assert len(words) == 12 and {r.n_removed for r in words if r.doc_id in (0, None, 2, 3)} == {0}
    assert [r.n_removed for r in words if r.doc_id == 1] == [120]
    data = suffix_dedup.remove_repeated_bytes(docs).collect()
    assert len(data) == 12 and {r.n_removed for r in data if r.doc_id is None} == {0}
    assert all(r.n_removed > 400 for r in data if r.doc_id in (0, 1, 4, 8))
    assert cover_dedup.remove_repeats(empty(docs)).count() == suffix_dedup.remove_repeated_bytes(empty(docs)).count() == 0


@given(st.lists(st.text("aB \n\té", max_size=20), max_size=6))
@settings(max_examples=50, deadline=None)
def test_word_hashes(texts):
    w = words_of(texts, lower=True)
    words = [x for t in texts for x in WORD.findall(t.translate(LOW))]
    assert w.counts.tolist() == [len(WORD.findall(t)) for t in texts] and len(w.hashes) == len(words)
    assert len(set(w.hashes.tolist())) == len(set(words))
    apart = [x * k for k in (1, 7, 8, 9, 16, 17, 63, 64, 65) for x in ("a", "\0", "b")] + ["a\0", "a" * 8 + "\0", "a" * 8 + "b" * 8, "b" * 8 + "a" * 8]
    assert len(set(words_of([" ".join(apart)]).hashes.tolist())) == len(apart)
    pairs = windows(w.hashes, 2)
    assert len(set(pairs.tolist())) == len(set(zip(words, words[1:], strict=False)))


def _alike(n):
    """Two strings of n letters a and b that are each other's opposite, in the order that makes sums of powers modulo 2^64 equal."""
    one = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_places_of_a_document_cost_what_it_holds(spark):
    """Of one bucket of 40,000 documents with 20 places each; each document's are the distinct ones, sorted."""
    n, each = 40_000, 20
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))

    def deal(batches):
        for _ in batches:
            found = np.empty(n * each, dealing.PLACE)
            found["doc"], found["pos"] = np.arange(n * each) % n, np.arange(n * each)[::-1] // n
            yield dealing.packed([(0, dealing.DECIDED, dealing.pack(x)) for x in (found, found[:1000])])

    def work(ids, texts, of):
        began = time.process_time()
        sound = sum(of(i)["pos"].tolist() == list(range(each)) and set(of(i)["doc"]) == {i} for i in ids) + (len(of(n)) == 0)
        yield pa.RecordBatch.from_arrays([pa.array([sound - 1]), pa.array([time.process_time() - began])], names=["sound", "s"])

    places = spark.range(0, 1, 1, 1).transform(map_batches, deal, dealing.PACKED)
    got = dealing.with_places(docs, places, 1, work, "sound long, s double").collect()
    assert sum(r.sound for r in got) == n and sum(r.s for r in got) < 8


@pytest.mark.parametrize("low", [-(2**63), 0, 7])
def test_places_of_far_documents(low):
    rng = np.random.default_rng(3)
    found = np.empty(500, suffix_dedup._FOUND)
    found["doc"] = low + rng.integers(0, 9, 500) * (2**60 - 1 if low < 0 else 1)
    for f, most in (("pos", 5), ("end", 3), ("hash", 2), ("kind", 2)):
        found[f] = rng.integers(0, most, 500)
    of = dealing.by_document(found)
    for doc in set(found["doc"].tolist()):
        assert of(doc).tolist() == sorted({x for x in found.tolist() if x[0] == doc})
    assert len(of(12345)) == len(dealing.by_document(found[:0])(1)) == 0


@pytest.mark.parametrize("n", [512, 1024, 2048])
def test_words_of_a_pattern_differ(spark, n):
    one, other = _alike(n)
    assert len(set(words_of([f"{one} {other}"]).hashes.tolist())) == 2
    docs = spark.createDataFrame([(1, one), (2, other), (3, " ".join([one] * 30)), (4, " ".join([other] * 30))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in parity_join.jaccard_components(docs, parity_join.JaccardJoin(shingle=4, threshold=85)).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    flat = spark.createDataFrame([(1, " ".join([one] + [f"w{i}" for i in range(25)])), (2, " ".join([other] + [f"v{i}" for i in range(25)]))], "doc_id long, text string")
    assert {r.n_removed for r in cover_dedup.remove_repeats(flat).collect()} == {0}
    # windows of one lie in neither the other nor itself but for those that the brute force finds
    texts = {1: "x" + one, 2: "y" + other}
    where = collections.Counter(t[i : i + 200] for t in texts.values() for i in range(len(t) - 199))
    for crowd in (1, 2000):
        got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeated_bytes(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), crowd).collect()}
        for doc, t in texts.items():
            gone = np.zeros(len(t), bool)
            for i in range(len(t) - 199):
                if where[t[i : i + 200]] > 1:
                    gone[i : i + 200] = True
            assert got[doc] == gone.sum()


# --- benchmark leaks ----------------------------------------------------------


def _distance(a, b):
    """Least edits between a and any part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return min(row)


def test_leaks(spark, texts):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text")
    known = {r.item_id: r.text for r in items.collect()}
    found = {(r.doc_id, r.item_id) for r in qgram_decontam.query(spark, SMALL).collect()}
    fold = qgram_decontam.folded
    exact = {(d, i) for d, t in texts.items() for i, x in known.items() if fold(x) in fold(t)}
    assert exact <= found
    for d, i in found - exact:
        assert _distance(fold(known[i]), fold(texts[d])) < 0.5 * len(fold(known[i]))


@given(st.integers(0, 10**6))
@settings(max_examples=40, deadline=None)
def test_edited_passages_are_found(seed):
    rng = random.Random(seed)
    # the budget counts edits of what is compared, so no edit makes two blanks of one
    item = qgram_decontam.folded("".join(rng.choice("abcdefghij ") for _ in range(rng.randint(20, 200)))).decode().strip()
    settings_ = qgram_decontam.Decontamination()
    index = qgram_decontam.ItemIndex([(1, item)], settings_)
    n = min(len(item), settings_.region)
    start = rng.randint(0, len(item) - n)
    piece = list(item[start : start + n])
    for _ in range(int(n * settings_.rate)):
        at = rng.randrange(len(piece))
        apart = "".join(piece[max(0, at - 1) : at + 2]).count(" ") < 2
        piece[at : at + 1] = rng.choice([[] if apart else ["Z"], ["Z"], [piece[at], "Z"]])
    text = "".join(rng.choice("klmnop") for _ in range(50)) + "".join(piece) + "".join(rng.choice("klmnop") for _ in range(50))
    assert [m[:2] for m in index.matches(["nothing here", text])] == [(1, 0)]


@pytest.mark.parametrize("pairs", [1, 50, 1_000_000])
def test_candidates_against_all_grams(texts, monkeypatch, pairs):
    """At any number of pairs held at once: bands against counting all shared q-grams, and regions against an unbanded alignment of all pairs."""
    monkeypatch.setattr(qgram_decontam, "_PAIRS", pairs)
    rng, q = random.Random(3), 8
    words = "alpha beta gamma delta epsilon zeta".split()
    items = [(n, " ".join(rng.choice(words) for _ in range(rng.randint(4, 14)))) for n in range(8)]
    some = [" ".join(rng.choice([*words, "eta", "theta"]) for _ in range(rng.randint(3, 40))) for _ in range(12)]
    items.append((8, "ab, cd; " * 2 + "ab, cd; xy " * 6))
    some.append("ab, cd; xy ab, cd; xy zz " * 9)
    for n in range(12):
        piece = list(items[n % 8][1])
        for _ in range(n % 4):
            piece[rng.randrange(len(piece))] = "#"
        some.append("before it " + "".join(piece) + " after it")
    index = qgram_decontam.ItemIndex(items, qgram_decontam.Decontamination())
    datas = [qgram_decontam.folded(t) for t in some]
    want = set()
    for t, data in enumerate(datas):
        for i, item in enumerate(index.texts):
            for cell in range(len(data) // index.span + 1):
                bands = collections.defaultdict(lambda: (collections.defaultdict(set), collections.defaultdict(set)))
                for x in range(cell * index.span, min(len(data) - q + 1, (cell + 2) * index.span)):
                    for y in range(len(item) - q + 1):
                        if data[x : x + q] == item[y : y + q]:
                            for band in ((x - y) // index.width, (x - y) // index.width - 1):
                                bands[band][0][data[x : x + q]].add(x)
                                bands[band][1][data[x : x + q]].add(y)
                want |= {(t, i, b) for b, (at, of) in bands.items() if sum(min(len(at[g]), len(of[g])) for g in at) >= index.least[i]}
    assert {tuple(r) for r in index.candidates(datas).tolist()} == want
    found = index.matches(some)
    pairs = {m[:2] for m in found}
    for t, data in enumerate(datas):
        for i, item in enumerate(index.texts):
            best = _local(item, data, index.settings.edit)
            assert best >= index.score[i] or (t, i) not in pairs
            if best >= len(item) - (index.settings.edit + 1) * index.edits[i] and item in data:
                assert (t, i) in pairs
    for t, i, score, a, b, c, d in found:
        assert _local(index.texts[i][c:d], datas[t][a:b], index.settings.edit) == score >= index.score[i]
    assert len(pairs) > 8


def _local(a, b, edit):
    """Score of the best local alignment of a and b: 1 a match, -edit an edit."""
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0] * (len(b) + 1)
        for j, y in enumerate(b, 1):
            now[j] = max(0, row[j - 1] + (1 if x == y else -edit), row[j] - edit, now[j - 1] - edit)
        row = now
        best = max(best, *row)
    return best


def test_items_of_any_length():
    rng = random.Random(5)
    long = "".join(rng.choices("abcdefghijklmnop ", k=700_000))
    index = qgram_decontam.ItemIndex([(1, "a short item of a few words"), (2, long)], qgram_decontam.Decontamination())
    some = ["nothing of it", "start " + long[600_000:600_200] + " end", "with a short item of a few words inside"]
    rows = index.candidates([qgram_decontam.folded(t) for t in some])
    assert {(t, i) for t, i, _ in rows.tolist()} == {(1, 1), (2, 0)}
    assert all(index.window(1, b)[0] <= 6 and index.window(1, b)[1] >= 206 for _, i, b in rows.tolist() if i == 1)


@pytest.mark.parametrize("parts", [((0, 200), (800, 1000)), ((0, 120), (300, 420), (880, 1000)), ((0, 1000),)])
def test_every_region_of_a_band_is_found(parts):
    rng = random.Random(len(parts))
    item = "".join(rng.choice("abcdefghij ") for _ in range(998)).join("ab")
    text = [rng.choice("KLMNOP").lower() for _ in range(1000)]
    for a, b in parts:
        text[a:b] = item[a:b]
    text = "qrst " * 20 + "".join(text) + " tsrq" * 20
    got = sorted(m[3:] for m in qgram_decontam.ItemIndex([(1, item)], qgram_decontam.Decontamination()).matches([text]))
    assert got == [(100 + a, 100 + b, a, b) for a, b in parts]
    twice = sorted(m[3:] for m in qgram_decontam.ItemIndex([(1, item)], qgram_decontam.Decontamination()).matches([text + text]))
    assert twice == [(100 + a + n, 100 + b + n, a, b) for n in (0, len(text)) for a, b in parts]


@pytest.mark.parametrize("kind", ["code", "dashes", "letter", "rules"])
def test_repetitive_texts_stay_small(kind):
    """Indentation, rules and filler that text and items share make no bands of their own; copies among them are found."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    vocabulary = [word() for _ in range(3000)]
    filler = {"code": "\n" + " " * 24, "dashes": "\n" + "-" * 70 + "\n", "letter": " " + "x" * 300 + " ", "rules": "\n|---|---|---|---|---|---|---|---|\n"}[kind]
    made = lambda n: filler.join(" ".join(rng.choice(vocabulary) for _ in range(8)) for _ in range(n))
    items = [(i, made(8)) for i in range(400)]
    text = made(1000)
    index = qgram_decontam.ItemIndex(items, qgram_decontam.Decontamination())
    tracemalloc.start()
    began = time.monotonic()
    found = index.matches([text, text[:5000] + items[7][1] + text[5000:]])
    took, most = time.monotonic() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 60 and most < 1 << 30
    assert {m[:2] for m in found} == {(1, 7)}
    (region,) = [m for m in found if m[0] == 1]
    assert region[3] <= 5000 and region[4] >= 5000 + len(items[7][1]) and (region[5], region[6]) == (0, len(items[7][1]))


def test_folded_texts_keep_their_places():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["A", "b", " ", "  \n", "-" * 30, "é", "日", "ab" * 20, "\t", "xyz"]) for _ in range(rng.randint(0, 12)))
        data, places = qgram_decontam.fold(text)
        own = text.encode()
        assert len(data) == len(places) and all(own[p : p + 1].translate(qgram_decontam._FOLD) == data[i : i + 1] for i, p in enumerate(places))
        assert (np.diff(places) > 0).all() and b"  " not in data and b"-" * 9 not in data and (b"ab" * 13).lower() not in data
    assert qgram_decontam.folded("A  b\n\nc") == b"a b c" and qgram_decontam.folded("") == b""


def test_leaks_on_hard_rows(spark, hard):
    items = spark.createDataFrame([(1, " ".join(f"v{i}" for i in range(10, 60))), (2, None), (3, ""), (4, "one"), (1, "another text of item one")], "item_id long, text string")
    got = qgram_decontam.contaminated_regions(hard, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(0, 1), (1, 1), (None, 1), (7, 1), (5, 4), (6, 4)}
    kept = qgram_decontam.without_leaks(hard, items)
    assert kept.columns == hard.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "4", "4", "8", "None"]
    assert qgram_decontam.contaminated_regions(empty(hard), items).count() == qgram_decontam.contaminated_regions(hard, empty(items)).count() == 0
    blocks = list(qgram_decontam.blocks_of(items, qgram_decontam.Decontamination(block=10)))
    assert sum(map(len, blocks)) == 3 and len(blocks) == 3


# --- licenses -----------------------------------------------------------------

LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _licenses(text, scan):
    """Every block of a text against every template."""
    words = LICENSE_WORD.findall(text.translate(LOW))
    step, places, base, every, best = scan.step, [], set(), set(), 0.0
    for k in range(-(-len(words) // step)):
        block = words[k * step : (k + 2) * step]
        for t in scan.templates:
            share = len(set(t.words) & set(block)) / len(set(t.words))
            found = [k * step + i for i in range(step) if block[i : i + len(t.words)] == t.words] if t.phrase else []
            if found or (not t.phrase and len(set(t.words) & set(block)) >= t.least):
                best = max(best, share)
                every.add(t.label)
                places += found
                base |= {t.label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(every)), best


@pytest.mark.parametrize("stride", [1, 48, 60])
def test_licenses_against_every_block(spark, texts, stride):
    rng = random.Random(8)
    planted = []
    for t in license_scan.TEMPLATES * 3:
        words = t.text.split()
        for _ in range(rng.randint(0, 4)):
            words.insert(rng.randint(0, len(words)), rng.choice(["nothing", "the", "License"]))
        for _ in range(rng.randint(0, 3)):
            words.pop(rng.randrange(len(words)))
        planted.append("ﬁ word " * rng.randint(0, 60) + " ".join(words) + " é.end" * rng.randint(0, 60))
    planted += ["Under the MIT  License" * 3, "under_the-mit license, CC-BY-NC cc by nc", "MİT Kicense K", " under the mit license " * 200, "x" * 40_000 + " CC BY NC", "", "\x00!", "THE " * 500]
    every = list(texts.values())[:40] + planted
    scan = license_scan.LicenseScan(stride=stride)
    df = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in license_scan.scan_licenses(df, scan).collect()}
    want = {i: _licenses(t, scan) for i, t in enumerate(every)}
    assert got.keys() == want.keys() and {i: g[:-1] for i, g in got.items()} == {i: w[:-1] for i, w in want.items()}
    assert all(math.isclose(got[i][-1], want[i][-1]) for i in got) and sum(w[5] != "" for w in want.values()) > 20


def test_licenses_on_hard_rows(spark, hard):
    more = hard.unionByName(spark.createDataFrame([(None, "under the MIT license"), (None, "CC BY-NC"), (9, "under the MIT license"), (9, "under the MIT license"), (9, "CC BY-NC")], "doc_id long, text string"), allowMissingColumns=True)
    got = license_scan.scan_licenses(more).collect()
    assert len(got) == 17 and {(r.doc_id, r.n_base, r.base_labels) for r in got if r.n_base} == {(None, 1, "mit"), (None, 1, "cc-by-nc"), (9, 1, "mit"), (9, 1, "cc-by-nc")}
    assert sorted(r.n_words for r in got if r.doc_id is None) == [0, 3, 4, 120] and [r.n_words for r in got if r.doc_id == 4] == [20000, 20000]
    assert license_scan.scan_licenses(empty(hard)).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan_licenses(hard, license_scan.LicenseScan(templates=()))


def test_licenses_stay_in_spark(spark):
    plan = license_scan.query(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- filters ------------------------------------------------------------------


def _audit(rows, labels):
    """rows (doc_id, text, source): the masks one by one, then every order."""
    first, out = {}, []
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, source in rows:
        t = t or ""
        w = WORD.findall(t)
        least = first.get(t)
        fails = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), any(c in "#$%&*|" for c in t), least is not None and (i is None or i > least)]
        out.append((source or "", fails, *labels.get(i, (0, 0))))
    want = set()
    for part in {x[0] for x in out}:
        own = [x for x in out if x[0] == part]
        removed = collections.Counter()
        rows_ = []
        for order in itertools.permutations(range(5)):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                removed[f] += len(gone)
                redundant = sum(x[1][f] for x in own) - len(gone)
                rows_.append((part, "".join("ABCDE"[k] for k in order), step, len(left), len(gone), redundant, sum(x[1][f] and sum(x[1]) == 1 for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone), f))
        want |= {(*r[:-1], removed[r[-1]]) for r in rows_}
    return want


@pytest.mark.parametrize("limits", [{}, {"block": 2, "growth": 2}, {"bits": 1, "block": 3}, {"bits": 2, "broadcast": 0}, {"broadcast": 0}])
def test_audit_against_every_order(spark, limits):
    """At any blocks, and with hashes so short that different texts meet."""
    rng = random.Random(6)
    word = lambda: rng.choice(["a", "Bb", "c#", "dd", "EEE", "f", "g|", "hh" * 3])
    pool = [" ".join(word() for _ in range(rng.choice([0, 1, 3, 60, 90]))) for _ in range(25)] + [" ".join(f"w{i}" for i in range(70)), "é" * 300, "é" * 299 + "e", None, ""]
    rows = [(rng.choice([None, *range(80)]), rng.choice(pool), rng.choice([None, "", "s", "t"])) for _ in range(250)] + [(5, pool[3], "s")] * 3
    labels = {i: (rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 80, 2)}
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    marked = spark.createDataFrame([(i, q, t) for i, (q, t) in labels.items()] + [(None, 1, 1), (2, 0, None)], "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(docs, marked, settings=filter_audit.FilterAudit(**limits)).collect()
    assert {tuple(r) for r in got} == _audit(rows, labels) and len(got) == 600 * 3


def test_audit_on_hard_rows(spark, hard):
    marked = spark.createDataFrame([(0, 1, 0), (4, None, 1)], "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(hard, marked).collect()
    rows = [(r.doc_id, r.text, "s") for r in hard.collect()]
    assert {tuple(r) for r in got} == _audit(rows, {0: (1, 0), 4: (0, 1)})
    assert filter_audit.filter_audit(empty(hard), marked).count() == 0
    assert {r.toxic_lost for r in filter_audit.filter_audit(hard, empty(marked)).collect()} == {0}


# --- conversations ------------------------------------------------------------


def _trie(rows):
    told = lambda r: hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest()
    own = collections.defaultdict(list)
    for r in rows:
        if r[0] is not None:
            own[r[0]].append(r)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(t, key=lambda r: (r[1] is not None, r[1] or 0, told(r)))] for c, t in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        saved[path] = sum(saved[c] for c in children[path]) + ((len(members[path]) - 1) * len(WORD.findall(path[-1][1])) if path else 0)
    ends = {p: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(p)))).encode()).hexdigest() for p, m in members.items()}
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], ends[p]) for p, m in members.items())


def test_trie_against_all_prefixes(spark):
    rng = random.Random(12)
    say = lambda: rng.choice(["", "yes", "no  no", "tell me more", None])
    rows = []
    for c in range(-45, 140):
        n = rng.choice([0, 1, 1, 2, 3, 5])
        rows += [(c, rng.choice([None, t, t]), rng.choice(["user", "assistant", None]), say()) for t in range(n)]
    rows += [(500 + i, t, "user", f"same {t}") for i in range(30) for t in range(12)] + [(900, 1, "user", "x"), (900, 1, "user", "x"), (None, 1, "user", "x"), (903, 1, "user", "one long one")] + [(905, t, "user", f"t{t}") for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for parts in (1, 6):
        got = prefix_trie.prefix_trie(df.repartition(parts).withColumn("d", F.lit(1)).withColumn("node", F.lit("n")).withColumn("size", F.lit(0)))
        assert got.columns == prefix_trie.NODE
        assert sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0], r[1])) == _trie(rows)
    assert prefix_trie.prefix_trie(df.where("1 = 0")).count() == prefix_trie.prefix_trie(df.where("conv_id is null")).count() == 0
    # one conversation; one without a turn of its own after the head
    for few in ([(7, 1, "user", "a b")], [(c, 1, "user", "a b") for c in range(2, 12)]):
        one = spark.createDataFrame(few, df.schema)
        assert sorted((tuple(r) for r in prefix_trie.prefix_trie(one).collect()), key=lambda r: (r[0], r[1])) == _trie(few)


def test_ends_are_hashed_in_slices(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLICE", 7)
    ids = [-30, -8, -7, -1, 0, 6, 7, 8, 100, 20, 3]
    df = spark.createDataFrame([(2, 5, i) for i in ids] + [(3, 5, 1)], "depth long, node long, conv_id long")
    got = {(r.depth, r.node): r.ends_sha256 for r in prefix_trie.ends_hashed(df).collect()}
    assert got == {(2, 5): hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), (3, 5): hashlib.sha256(b"1").hexdigest()}


# --- pipeline -----------------------------------------------------------------


def test_pipeline_against_brute_force(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = attention_quality.quality_model(docs, labels)
    good = {r.doc_id for r in attention_quality.score(docs, model).where("score >= 0.5").collect()}
    want = _components({i: _shingles(texts[i], 5) for i in good}, 80)
    kept = {i for i in good if want[i] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaks = {m[0] for m in qgram_decontam.ItemIndex(items, qgram_decontam.Decontamination()).matches([texts[i] for i in sorted(kept)])}
    kept = {i for n, i in enumerate(sorted(kept)) if n not in leaks}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) == kept
    # no kept text holds an item, and every text, redacted or not, comes back whole
    fold = qgram_decontam.folded
    assert not any(fold(x).strip() in fold(texts[i]) for i in kept for _, x in items)
    for i in kept:
        assert got[i].decoded_sha256 == hashlib.sha256(_redacted(texts[i]).encode()).hexdigest()


def _redacted(text):
    out, done = [], 0
    for a, b in sorted(tuple(map(int, x.split(":")[1:])) for x in filter(None, _all_spans(text).split(","))):
        if a >= done:
            out += [text[done:a], "[SECRET]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def test_stages_redact_every_window(spark, texts):
    """The secrets and tokens stages over texts with secrets, against every window of them."""
    rng = random.Random(13)
    secret = lambda: rng.choice(["token=abcdefgh1 ", "AKIA" + "Z9" * 8 + " ", "k9X2mQ7vL4tB8nR3wZ6yJ1 ", "deadbeef" * 4 + " password: hunter22x", "0123456789abcdef " * 2])
    rows = []
    for i in sorted(texts)[:60]:
        at = rng.randint(0, len(texts[i]))
        rows.append((i, texts[i][:at] + " " + secret() + texts[i][at:], "en", "s", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clean = corpus_pipeline.secrets(spark, docs, SMALL)
    want = {r[0]: _redacted(r[1]) for r in rows}
    assert {r.doc_id: (r.text, r.n_chars) for r in clean.collect()} == {i: (t, len(t)) for i, t in want.items()} and sum("[SECRET]" in t for t in want.values()) > 40
    assert {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.tokens(spark, clean, SMALL).collect()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}


def test_stages_keep_the_columns(spark, hard):
    docs = hard
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == hard.columns
        rows = out.count()
        assert rows <= docs.count() and stage(spark, empty(docs), SMALL).count() == 0
        docs = out if name != "quality" else docs


def test_registered():
    assert {re.match(r"op(\d+)_", n)[1] for n in queries.queries()} == {str(i) for i in range(1, 14)}
