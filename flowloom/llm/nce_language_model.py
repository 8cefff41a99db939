"""Log-bilinear language model, trained with noise-contrastive estimation in numpy.

Tokens are lower-cased words and an end. A symbol is a frequent word, or the class
(by its last bytes) of any other. Two symbols of context give a vector, C1 q[s1] +
C2 q[s2]; its product with r[s], plus b[s], scores symbol s, and the softmax over all
symbols normalises. Below, the members of a class are its `modelled` most frequent
words (of all classes together) and one rest; u[s1] . m[w] + a[w] scores member w after
symbol s1, and the softmax over the class normalises. A word of the rest has the
rest's probability times its smoothed share of it, so all words, seen or not, are
scored.

Counts of all training words are summed with Spark. All training texts are dealt, by
hashes of id and text, to parts of about `part` tokens and to rounds; in a round every
part trains a copy of the weights on its texts of that round, in batches that share
noise symbols (members of classes in batches of their own), and the copies are
averaged, weighted by tokens. Parts and their order come from the texts alone, so how the input
is split doesn't matter. For scoring, the partition functions of all pairs of context
symbols, and of all classes after a symbol, are tables made by matrix products of
exponentials, so a token takes look-ups and a short product. Counts of the HEAD most
frequent words go to all tasks; those of the other words are joined by word, so no
table grows with the corpus.

Null and empty texts are one end. With no training tokens all known counts are 0 and
symbols keep their first weights. Rows are scored by themselves, repeated ones alike.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import checkpointed, documents, fold, map_batches, slices


@dataclass(frozen=True)
class LanguageModel:
    """words and classes: symbols besides the end; modelled: words that are members of classes; head: words whose counts go to all tasks; noise: symbols that a batch shares; others: noise members a token; part: tokens of a part, about; rounds: averagings."""

    words: int = 767
    classes: int = 256
    modelled: int = 20_000
    head: int = 200_000
    size: int = 24
    below: int = 12
    batch: int = 512
    noise: int = 32
    others: int = 4
    part: int = 4_000_000
    rounds: int = 4
    rate: float = 0.1
    seed: int = 11

    @property
    def symbols(self) -> int:
        return 1 + self.words + self.classes


def tokens_of(text: str) -> list[bytes]:
    """Words with A-Z lowered; the end is not among them."""
    return text.encode().lower().split()


def class_of(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-2:]) % classes


def count_words(train: DataFrame) -> DataFrame:
    """word, c over all texts of train; batches are counted first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
            counts.clear()
            return out

        for _, texts in slices(batches):
            for text in texts:
                counts.update(tokens_of(text))
            if len(counts) > 400_000:
                yield flush()
        yield flush()

    return train.select("text").transform(map_batches, run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """head: words by falling count, and counts; ends: training texts; class_total: of each class, its words' counts and half a count for each word and one unseen; rest_total: the same without its modelled words.

    Members are numbered by class: the modelled words of a class by falling count, then its rest. Codes are those of symbols but for classes, and above these the members."""

    settings: LanguageModel
    head: list[bytes]
    counts: np.ndarray
    ends: int
    total: int
    distinct: int
    class_total: np.ndarray
    rest_total: np.ndarray

    @property
    def modelled(self) -> slice:
        """Places of the modelled words in the head."""
        return slice(self.settings.words, self.settings.words + self.settings.modelled)

    def members(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Member of each modelled word and of each rest, and the class of each member."""
        k = self.settings.classes
        of = np.array([class_of(w, k) for w in self.head[self.modelled]], np.int64)
        every = np.concatenate([of, np.arange(k)])
        order = np.argsort(every, kind="stable")
        member = np.empty(len(every), np.int64)
        member[order] = np.arange(len(every))
        return member[: len(of)], member[len(of) :], every[order]

    def member_shares(self) -> np.ndarray:
        """Share of each member of its class."""
        words, rests, class_ = self.members()
        share = np.empty(len(class_))
        share[words], share[rests] = self.counts[self.modelled] + 0.5, self.rest_total
        return share / np.bincount(class_, share)[class_]

    def codes(self) -> np.ndarray:
        """Code of each head word, and behind them of the rest of each class."""
        words, rests, _ = self.members()
        s, n = self.settings, len(self.head)
        rest = 1 + s.words + rests
        out = np.arange(1, n + 1)
        out[self.modelled] = 1 + s.words + words
        beyond = self.modelled.stop
        out[beyond:] = rest[[class_of(w, s.classes) for w in self.head[beyond:]]]
        return np.concatenate([out, rest])

    def symbol_shares(self) -> np.ndarray:
        s = self.settings
        share = np.full(s.symbols, 0.5)
        share[0] += self.ends
        n = min(s.words, len(self.head))
        share[1 : 1 + n] += self.counts[:n]
        share[1 + s.words :] = self.class_total
        return share / share.sum()


def read_vocabulary(counts: DataFrame, ends: int, settings: LanguageModel) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # the head are all words from an eighth of a doubling of the count up: at most `head` rows in all come to the driver
    level = F.floor(F.log2("c") * 8)
    least, words = 0, 0
    for row in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
        words += row["n"]
        if words > settings.head:
            least = row["level"] + 1
            break
    top = counts.where(level >= least).toPandas().sort_values(["c", "word"], ascending=[False, True], ignore_index=True)
    head = [w.encode() for w in top["word"]]
    in_class = F.crc32(F.substring(F.col("word").cast("binary"), -2, 2)) % settings.classes
    sums = counts.groupBy(in_class.alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    class_total = np.full(settings.classes, 0.5)
    for r in sums:
        class_total[r["k"]] += r["c"] + 0.5 * r["n"]
    for w, c in zip(head[: settings.words], top["c"][: settings.words], strict=True):
        class_total[class_of(w, settings.classes)] -= c + 0.5
    rest_total = class_total.copy()
    beyond = slice(settings.words, settings.words + settings.modelled)
    for w, c in zip(head[beyond], top["c"][beyond], strict=True):
        rest_total[class_of(w, settings.classes)] -= c + 0.5
    return Vocabulary(settings, head, top["c"].to_numpy(np.float64), ends, int(total) + ends, int(distinct) + (ends > 0), class_total, rest_total)


class Index(dict):
    """Place of a head word; of another, behind the head, that of the rest of its class."""

    def __init__(self, head: list[bytes], classes: int):
        super().__init__(zip(head, range(len(head)), strict=True))
        self.classes, self.many = classes, len(head)

    def __missing__(self, word: bytes) -> int:
        return self.many + zlib.crc32(word[-2:]) % self.classes


def start_weights(settings: LanguageModel, shares: np.ndarray, member_shares: np.ndarray | None = None) -> dict[str, np.ndarray]:
    rng, d = np.random.default_rng(settings.seed), settings.size
    near = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    eye = np.eye(d, dtype=np.float32)
    out = {"q": near(settings.symbols, d), "r": near(settings.symbols, d), "C1": eye + near(d, d), "C2": 0.5 * eye + near(d, d), "b": np.log(shares).astype(np.float32)}
    if member_shares is not None:
        out |= {"u": near(settings.symbols, settings.below), "m": near(len(member_shares), settings.below), "a": np.log(member_shares).astype(np.float32)}
    return out


#: Cells of a class, in which a drawn number's member is looked for; a power of two, so that they are exact.
_CELLS = 256


def _rows(weights: np.ndarray) -> np.ndarray:
    """The same weights with each row as one value, which moves at once."""
    return weights if weights.ndim == 1 else weights.view(f"V{weights.itemsize * weights.shape[1]}")[:, 0]


def _drop(score: np.ndarray) -> np.ndarray:
    """-1 / (1 + exp(-score)), in place."""
    np.clip(score, -30, 30, out=score)
    np.exp(np.negative(score, out=score), out=score)
    score += 1
    return np.divide(-1, score, out=score)


class Trainer:
    """Noise-contrastive steps with Adagrad. A step costs by its batch, not by the symbols or members there are."""

    def __init__(self, settings: LanguageModel, weights: dict[str, np.ndarray], shares: np.ndarray, members: tuple[np.ndarray, np.ndarray], seed: list[int]):
        """members: class and share of each."""
        self.settings, self.w = settings, {k: v.copy() for k, v in weights.items()}
        self.square = {k: np.full_like(v, 1e-2) for k, v in self.w.items()}
        self.rows = {k: (_rows(self.square[k]), _rows(v)) for k, v in self.w.items()}
        self.log_noise = (np.log(shares) + np.log(settings.noise)).astype(np.float32)
        self.cumulative = np.cumsum(shares)
        self.class_, share = members
        self.log_others = (np.log(share) + np.log(settings.others)).astype(np.float32)
        self.shares = np.cumsum(share)  # a class takes 1 of it
        self.guide = np.searchsorted(self.shares, np.arange((int(self.class_[-1]) + 1) * _CELLS + 1) / _CELLS)
        self.slots = {"symbols": np.empty(settings.symbols, np.int64), "members": np.empty(len(share), np.int64)}
        self.cells: dict[int, np.ndarray] = {}
        self.rng = np.random.default_rng(seed)
        self.tokens = 0

    def _met(self, rows: np.ndarray, names: str) -> tuple[np.ndarray, np.ndarray]:
        """The different rows of the weights of that name, and for each row its place among them; without sorting: the last of equal rows stands for all."""
        slot, every = self.slots[names], np.arange(len(rows))
        slot[rows] = every
        last = slot.take(rows)
        chosen = np.flatnonzero(last == every)
        place = np.empty(len(rows), np.int64)
        place[chosen] = every[: len(chosen)]
        return rows.take(chosen), place.take(last)

    def _sums(self, place: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """Sums of the vectors of each of n places."""
        d = values.shape[1]
        cells = self.cells.get(d)
        if cells is None or len(cells) < n:
            cells = self.cells[d] = np.arange(2 * n * d).reshape(-1, d)
        return np.bincount(cells.take(place, 0).ravel(), values.ravel(), n * d).reshape(n, d).astype(np.float32)

    def _move(self, name: str, rows: np.ndarray | None, g: np.ndarray) -> None:
        """An Adagrad step of some rows (None: all), each given once; the others stand still, as they would with a gradient of 0."""
        square, w = self.square[name], self.w[name]
        if rows is not None:
            square, w = square.take(rows, 0), w.take(rows, 0)
        square += g * g
        g *= self.settings.rate
        g /= np.sqrt(square)
        w += g
        if rows is not None:
            whole_square, whole_w = self.rows[name]
            whole_square.put(rows, _rows(square))
            whole_w.put(rows, _rows(w))

    def _others(self, drawn: np.ndarray) -> np.ndarray:
        """Members drawn by their shares: as np.searchsorted(self.shares, drawn), but looked for from the first member of the number's cell on."""
        found = self.guide.take((drawn * _CELLS).astype(np.int64))
        low = np.flatnonzero(self.shares.take(found, mode="clip") < drawn)
        for _ in range(4):
            found[low] += 1
            low = low.compress(self.shares.take(found.take(low), mode="clip") < drawn.take(low))
        found[low] = np.searchsorted(self.shares, drawn.take(low))
        return np.minimum(found, len(self.shares) - 1)

    def step(self, s1: np.ndarray, s2: np.ndarray, target: np.ndarray) -> None:
        w, count = self.w, len(target)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(self.settings.noise)), self.settings.symbols - 1)
        q1, q2 = w["q"].take(s1, 0), w["q"].take(s2, 0)
        v = q1 @ w["C1"]
        v += q2 @ w["C2"]
        rt, rn = w["r"].take(target, 0), w["r"].take(noise, 0)
        real = (v * rt).sum(axis=1) + w["b"].take(target) - self.log_noise.take(target)
        fake = v @ rn.T
        fake += w["b"].take(noise)
        fake -= self.log_noise.take(noise)
        up = 1 / (1 + np.exp(np.clip(real, -30, 30)))  # of the score of the real symbol
        down = _drop(fake)
        rt *= up[:, None]
        dv = down @ rn
        dv += rt
        rows, place = self._met(np.concatenate([target, noise]), "symbols")
        targets, noises, n = place[:count], place[count:], len(rows)
        dr = self._sums(targets, up[:, None] * v, n)
        np.add.at(dr, noises, down.T @ v)
        db = np.bincount(targets, up, n) + np.bincount(noises, down.sum(axis=0), n)
        before, place = self._met(np.concatenate([s1, s2]), "symbols")
        dq = self._sums(place, np.concatenate([dv @ w["C1"].T, dv @ w["C2"].T]), len(before))
        for k, at, g in (("q", before, dq), ("r", rows, dr), ("C1", None, q1.T @ dv), ("C2", None, q2.T @ dv), ("b", rows, db.astype(np.float32))):
            g /= count
            self._move(k, at, g)
        self.tokens += count

    def step_below(self, s1: np.ndarray, member: np.ndarray) -> None:
        """A step of members after symbols, against others of the same class."""
        w, n = self.w, len(member)
        drawn = self.class_.take(member)[:, None] + self.rng.random((n, self.settings.others))
        other = self._others(drawn.ravel())
        u, mine, theirs = w["u"].take(s1, 0), w["m"].take(member, 0), w["m"].take(other, 0).reshape(n, self.settings.others, -1)
        real = (u * mine).sum(axis=1) + w["a"].take(member) - self.log_others.take(member)
        fake = np.einsum("nd,nod->no", u, theirs)
        fake += w["a"].take(other).reshape(n, -1)
        fake -= self.log_others.take(other).reshape(n, -1)
        up = 1 / (1 + np.exp(np.clip(real, -30, 30)))
        down = _drop(fake)
        mine *= up[:, None]
        mine += np.einsum("no,nod->nd", down, theirs)
        before, place = self._met(s1, "symbols")
        du = self._sums(place, mine, len(before))
        rows, place = self._met(np.concatenate([member, other]), "members")
        dm = self._sums(place, np.concatenate([up[:, None] * u, (down[:, :, None] * u[:, None, :]).reshape(-1, u.shape[1])]), len(rows))
        da = np.bincount(place, np.concatenate([up, down.ravel()]), len(rows)).astype(np.float32)
        for k, at, g in (("u", before, du), ("m", rows, dm), ("a", rows, da)):
            g /= n
            self._move(k, at, g)

    def learn(self, codes: np.ndarray) -> None:
        """Steps over all tokens of whole texts in random order, and over all members among them."""
        ids, member = symbols_of(codes, self.class_, self.settings)
        s1, s2 = contexts(ids, np.flatnonzero(codes == 0))
        order = self.rng.permutation(len(ids))
        for i in range(0, len(order), self.settings.batch):
            some = order[i : i + self.settings.batch]
            self.step(s1[some], s2[some], ids[some])
        order = order[member[order] >= 0]
        for i in range(0, len(order), self.settings.batch):
            some = order[i : i + self.settings.batch]
            self.step_below(s1[some], member[some])


def contexts(ids: np.ndarray, ends_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two before each, 0 before a text; ends_at: where texts end."""
    s1, s2 = np.concatenate([[0], ids[:-1]]), np.concatenate([[0, 0], ids[:-2]])[: len(ids)]
    begins = np.concatenate([[0], ends_at[:-1] + 1])
    s2[begins] = 0
    second = begins[begins + 1 < len(ids)] + 1
    s2[second] = 0
    return s1, s2


def places_of(texts: list[str], index: Index) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Places of all tokens (an end has -1), where texts end, and the words."""
    words = [tokens_of(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    ends_at = np.cumsum(sizes + 1) - 1
    places = np.full(int(sizes.sum()) + len(texts), -1)
    inside = np.ones(len(places), bool)
    inside[ends_at] = False
    places[inside] = np.fromiter(map(index.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(sizes.sum()))
    return places, ends_at, words


def coded(places: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.where(places < 0, 0, codes[places])


def symbols_of(codes: np.ndarray, class_: np.ndarray, settings: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each code, and its member (negative: none). class_: of each member."""
    member = codes - 1 - settings.words
    return np.where(member < 0, codes, 1 + settings.words + class_[np.maximum(member, 0)]), member


#: Floats of the weights that are averaged as one row.
_BLOCK = 4096


def train_model(train: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Weights after all rounds. train: doc_id, text."""
    settings, shares = vocabulary.settings, vocabulary.symbol_shares()
    class_, member_shares = vocabulary.members()[2], vocabulary.member_shares()
    weights = start_weights(settings, shares, member_shares)
    names, shapes = list(weights), {k: v.shape for k, v in weights.items()}
    context = train.sparkSession.sparkContext
    words = context.broadcast((vocabulary.head[: vocabulary.modelled.stop], vocabulary.codes()))
    first = len(vocabulary.head)
    parts = max(1, -(-vocabulary.total // settings.part))
    wide = np.dtype("<u2" if 1 + settings.words + len(class_) <= 1 << 16 else "<i4")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, codes = words.value
        index = Index(head, settings.classes)
        codes = np.concatenate([codes[: len(head)], codes[first:]])  # words beyond the modelled count as their class's rest
        for part, texts in slices(batches):
            places, ends_at, _ = places_of(texts, index)
            raw, at = coded(places, codes).astype(wide).tobytes(), [0, *(wide.itemsize * (ends_at + 1)).tolist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([raw[a:b] for a, b in zip(at, at[1:], strict=False)], pa.binary())], names=["part", "round", "doc_id", "codes"])

    dealt = train.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int").alias("part"),
        F.pmod(F.xxhash64("text", "doc_id"), F.lit(settings.rounds)).cast("int").alias("round"),
        "doc_id",
        "text",
    )
    kind = train.schema["doc_id"].dataType.simpleString()
    dealt = checkpointed(dealt.transform(map_batches, encode, f"part int, round int, doc_id {kind}, codes binary"))

    def averaged(sent, number: int) -> dict[str, np.ndarray]:
        def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of, trainer, held, size = None, None, [], 0

            def pieces() -> None:
                codes = np.concatenate(held)
                held.clear()
                if len(codes):
                    trainer.learn(codes)

            def learned() -> pa.RecordBatch:
                flat = np.concatenate([trainer.w[k].ravel() for k in names]).astype(np.float32)
                blocks = [flat[i : i + _BLOCK].tobytes() for i in range(0, len(flat), _BLOCK)]
                n = len(blocks)
                return pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, of, np.int32)), pa.array(np.full(n, float(trainer.tokens))), pa.array(blocks, pa.binary())], names=["block", "part", "n", "x"])

            for batch in batches:
                for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if part != of:
                        if of is not None:
                            pieces()
                            yield learned()
                        weights, shares, share = sent.value
                        of, size = part, 0
                        trainer = Trainer(settings, weights, shares, (class_, share), [settings.seed, number, part])
                    held.append(np.frombuffer(raw, wide).astype(np.int64))
                    size += len(held[-1])
                    if size > 100_000:
                        pieces()
                        size = 0
                        held.append(np.empty(0, np.int64))
            if of is not None:
                pieces()
                yield learned()

        def mean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[np.ndarray, float]] = {}
            for batch in batches:
                for block, n, x in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                    total, many = sums.get(block, (0.0, 0.0))
                    sums[block] = (total + n * np.frombuffer(x, np.float32).astype(np.float64), many + n)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([(x / n).astype(np.float32).tobytes() for x, n in sums.values()], pa.binary())], names=["block", "x"])

        mine = dealt.where(F.col("round") == number).repartition(parts, "part").sortWithinPartitions("part", "doc_id", "codes").select("part", "codes")
        found = mine.transform(map_batches, learn, "block int, part int, n double, x binary")
        found = found.repartition("block").sortWithinPartitions("block", "part").transform(map_batches, mean, "block int, x binary").toPandas()
        if not len(found):
            return sent.value[0]
        flat, out, at = np.frombuffer(b"".join(found.sort_values("block")["x"]), np.float32), {}, 0
        for k in names:
            size = int(np.prod(shapes[k]))
            out[k] = flat[at : at + size].reshape(shapes[k])
            at += size
        return out

    for number in range(settings.rounds):
        sent = context.broadcast((weights, shares, member_shares))
        weights = averaged(sent, number)
        sent.unpersist()
    return weights


def score_tables(weights: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 parts: T1[s1, s] + T2[s2, s] - Z[s1, s2] is the log10 probability of s after s2, s1."""
    w = {k: v.astype(np.float64) for k, v in weights.items()}
    one, two = (w["q"] @ w["C1"]) @ w["r"].T, (w["q"] @ w["C2"]) @ w["r"].T + w["b"]
    m1, m2 = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
    z = np.log(np.exp(one - m1) @ np.exp(two - m2).T) + m1 + m2.T
    return tuple((x / np.log(10)).astype(np.float32) for x in (one, two, z))


def class_sums(weights: dict[str, np.ndarray], class_: np.ndarray) -> np.ndarray:
    """log of the summed exponentials of the members of each class after each symbol."""
    starts = np.searchsorted(class_, np.arange(int(class_[-1]) + 1))
    out = []
    for i in range(0, len(weights["u"]), 64):
        x = weights["u"][i : i + 64].astype(np.float64) @ weights["m"].T + weights["a"]
        top = np.maximum.reduceat(x, starts, axis=1)
        out.append(np.log(np.add.reduceat(np.exp(x - top[:, class_]), starts, axis=1)) + top)
    return np.concatenate(out)


def score_texts(df: DataFrame, vocabulary: Vocabulary, weights: dict[str, np.ndarray], counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row of df (doc_id, text)."""
    settings = vocabulary.settings
    class_ = vocabulary.members()[2]
    below = (weights["u"], weights["m"], weights["a"], class_sums(weights, class_).astype(np.float32))
    sent = df.sparkSession.sparkContext.broadcast((vocabulary, vocabulary.codes(), score_tables(weights), below))
    base_log = float(np.log10(vocabulary.total + 0.5 * (vocabulary.distinct + 1)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, codes, (t1, t2, z), (q_below, r_below, b_below, sums) = sent.value
        index = Index(vocabulary.head, settings.classes)
        many, (_, rests, class_) = len(vocabulary.head), vocabulary.members()
        log_count = np.log10(vocabulary.counts + 0.5)
        rest_of = np.full(len(class_), -1)
        rest_of[rests] = np.arange(settings.classes)
        log_rest = np.log10(vocabulary.rest_total)
        end_count = np.log10(vocabulary.ends + 0.5)
        for part, texts in slices(batches):
            at, ends_at, words = places_of(texts, index)
            ids, member = symbols_of(coded(at, codes), class_, settings)
            s1, s2 = contexts(ids, ends_at)
            end, known = at < 0, (at >= 0) & (at < many)
            count = np.zeros(len(at))
            count[known] = log_count[at[known]]
            base = count.copy()
            base[end] = end_count
            base -= base_log
            score = (t1[s1, ids] + t2[s2, ids] - z[s1, s2]).astype(np.float64)
            classed = np.flatnonzero(member >= 0)
            of, after = member[classed], s1[classed]
            score[classed] += (np.einsum("nd,nd->n", q_below[after], r_below[of]) + b_below[of] - sums[after, class_[of]]) / np.log(10)
            rest = rest_of[of]
            inside = rest >= 0
            score[classed[inside]] += count[classed[inside]] - log_rest[rest[inside]]
            begins = np.concatenate([[0], ends_at[:-1] + 1]) if len(ends_at) else ends_at
            totals = [np.add.reduceat(x, begins) if len(begins) else np.empty(0) for x in (base, score, (known | (end & (vocabulary.ends > 0))).astype(np.int64))]
            rows, rare = part.column(0).to_pylist(), [[], [], []]
            for row, ws, i, j in zip(rows, words, begins.tolist(), ends_at.tolist(), strict=True):
                tail = Counter([ws[k] for k in np.flatnonzero(at[i:j] >= many).tolist()])
                rare[0] += [row] * len(tail)
                rare[1] += list(tail)
                rare[2] += list(tail.values())
            n, m = len(rows), len(rare[0])
            both = lambda own, kind: pa.concat_arrays([pa.array(own, kind), pa.nulls(m, kind)])
            # a text's own row has a word with a space, which no word has
            word = pa.array([b" %d" % r for r in rows] + rare[1], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows + rare[0], pa.int64()), word, pa.array([0] * n + rare[2], pa.int64()), both(part.column(1).to_pylist(), part.column(1).type), both(ends_at - begins + 1 if n else [], pa.int64()), both(totals[2], pa.int64()), both(totals[0], pa.float64()), both(totals[1], pa.float64())],
                names=["row", "word", "n", "doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    kind = df.schema["doc_id"].dataType.simpleString()
    rows = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = rows.transform(map_batches, run, f"row long, word string, n long, doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    joined = found.join(counts, "word", "left")
    rare = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))
    tail = F.when(F.col("n") > 0, rare).otherwise(F.lit(0.0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        total("n_tokens").alias("n_tokens"),
        (total("n_known") + total(F.when(F.col("c").isNotNull(), F.col("n")))).alias("n_known"),
        (F.sum("base_score") + F.sum(tail)).alias("base_score"),
        (F.sum("score") + F.sum(tail)).alias("score"),
    )


def language_model_scores(docs: DataFrame, settings: LanguageModel = LanguageModel()) -> DataFrame:
    """Scores of all rows of docs (doc_id, text), by a model of those outside the held-out fold (crc32 of doc_id as text, modulo 5, is 1)."""
    held_out = fold(F.col("doc_id"), 5) == 1
    train = docs.where(~held_out)
    counts = checkpointed(count_words(train))
    vocabulary = read_vocabulary(counts, train.count(), settings)
    weights = train_model(train, vocabulary)
    scored = score_texts(docs, vocabulary, weights, counts)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(vocabulary.total).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(documents(spark, sf_dir))
