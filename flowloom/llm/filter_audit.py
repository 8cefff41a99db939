"""Filter interaction audit: what five filters remove in every order.

A fails texts of few words, B of few different words, C of many capitals, D of
certain signs, E of a smaller doc_id's text. E is found by partition refinement:
texts split by their length in code points, then by the hashes of one block after
another, each block longer than all before it; classes of one text are dropped
after each split. Whole texts of what is left are compared, and the least doc_id of
each text is kept. Equal signatures are counted as one from the start, so copies of
a text don't gather in one task.

Every document then is a mask of five bits, masks are counted by part, and all
orders are read off the counts (at most 32 a part).

Null texts are empty; empty texts equal one another. A row without doc_id fails E
if a row with one has its text, and fails no other. Rows of one id and text don't
fail E for each other. Of several labels of an id, any of 1 counts. Null parts are
the empty string. Empty tables give no rows. Other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.common import WORDS, checkpointed, read_table

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
#: Of all orders, those in which a filter comes before the others that a text fails, by how many it fails.
FIRST = [0] + [120 // k for k in range(1, len(FILTERS) + 1)]


@dataclass(frozen=True)
class FilterAudit:
    """least_words, unlike (percent of words), capitals (percent of code points) and signs: of filters A to D; block: code points of the first block, growth: how many times longer the next is; bits: of a block's hash; broadcast: classes sent to all tasks at most, more are joined."""

    least_words: int = 50
    unlike: int = 65
    capitals: int = 5
    signs: str = "[#$%&*|]"
    block: int = 256
    growth: int = 8
    bits: int = 64
    broadcast: int = 1_000_000


def starts(settings: FilterAudit) -> list[int]:
    """Where blocks begin, for texts of any length."""
    at, size, out = 0, settings.block, []
    while at < 1 << 31:
        out.append(at)
        at, size = at + size, size * settings.growth
    return out


def own_mask(text: Column, settings: FilterAudit) -> Column:
    """Bits of the filters that look at a text alone."""
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    fails = [
        F.size(words) < settings.least_words,
        100 * F.size(F.array_distinct(words)) < settings.unlike * F.size(words),
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > settings.capitals * F.length(text),
        text.rlike(settings.signs),
    ]
    return sum((F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)), F.lit(0))


def signature(text: Column, settings: FilterAudit) -> Column:
    """Hashes of a text's blocks, as many as it has."""
    at = starts(settings)
    cut = (1 << settings.bits) - 1
    hashed = lambda a, b: F.xxhash64(F.substring(text, a + 1, b - a)) if settings.bits == 64 else F.xxhash64(F.substring(text, a + 1, b - a)).bitwiseAND(F.lit(cut))
    # bytes are at hand, code points must be counted: most texts have no block so far out
    has = lambda a: (F.octet_length(text) > a) & (F.length(text) > a)
    blocks = F.array(*[F.when(has(a), hashed(a, b)) for a, b in zip(at, [*at[1:], (1 << 31) - 1], strict=True)])
    return F.filter(blocks, lambda h: h.isNotNull())


def finer(of: Column, block: Column) -> Column:
    return F.xxhash64(of, block)


def repeated_classes(signatures: DataFrame) -> DataFrame:
    """From rows of `length` and `blocks`: the classes (by length and all blocks) of more than one row."""
    work = signatures.groupBy(F.col("length").cast("long").alias("class"), "blocks").agg(F.count("*").alias("n"))
    found, step = None, 0
    while True:
        many = work.groupBy("class").agg(F.sum("n").alias("rows")).where("rows > 1").select("class")
        work = checkpointed(work.join(many, "class", "left_semi"))
        used_up = work.where(F.size("blocks") <= step).select("class").distinct()
        found = used_up if found is None else found.union(used_up)
        work = work.where(F.size("blocks") > step).withColumn("class", finer(F.col("class"), F.get("blocks", F.lit(step))))
        if work.isEmpty():
            return found
        step += 1


def copies(docs: DataFrame, settings: FilterAudit = FilterAudit()) -> DataFrame:
    """docs (doc_id, text and any others but these) without text, with `mask` (filters A to D) and `copy`: whether a smaller doc_id has the same text."""
    others = [c for c in docs.columns if c.lower() not in ("doc_id", "text")]
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", text.alias("text"), *others)
    signed = lambda keep: read.select("doc_id", *others, *keep, F.length("text").alias("length"), signature(F.col("text"), settings).alias("blocks"))
    classed = lambda df: df.withColumn("class", F.aggregate("blocks", F.col("length").cast("long"), finer)).drop("length", "blocks")
    rows = checkpointed(signed([own_mask(F.col("text"), settings).alias("mask")]))
    kept = checkpointed(repeated_classes(rows.select("length", "blocks")))
    few = kept.count() <= settings.broadcast
    texts = classed(signed(["text"]))
    if few:
        texts = texts.join(F.broadcast(kept), "class", "left_semi")
    firsts = texts.groupBy("class", "text").agg(F.min("doc_id").alias("least"))
    if not few:  # copies are one by now
        firsts = firsts.join(kept, "class", "left_semi")
    by_class = checkpointed(firsts.groupBy("class").agg(F.min("least").alias("least"), F.count("*").alias("texts")))
    later = F.col("least").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("least")))
    out = classed(rows).join(by_class, "class", "left")
    collided = by_class.where("texts > 1").select("class")
    if collided.isEmpty():
        return out.select("doc_id", *others, "mask", F.coalesce(later, F.lit(False)).alias("copy"))
    # different texts of equal hashes: their rows meet by text
    alone = out.where("coalesce(texts, 1) = 1").select("doc_id", *others, "mask", F.coalesce(later, F.lit(False)).alias("copy"))
    crowd = classed(signed(["text", own_mask(F.col("text"), settings).alias("mask")])).join(collided, "class", "left_semi")
    met = crowd.join(firsts, ["class", "text"]).select("doc_id", *others, "mask", later.alias("copy"))
    return alone.union(met)


def steps() -> Column:
    """All orders: filter_order, step, bit of the step's filter, bits of those before it."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for i, f in enumerate(order):
            rows.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(i + 1).alias("step"), F.lit(bit[f]).alias("bit"), F.lit(before).alias("before")))
            before |= bit[f]
    return F.array(*rows)


def audit(masks: DataFrame) -> DataFrame:
    """From rows of part, mask, n, good, toxic: a row for each part, order and step."""
    by_part = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    at = by_part.select("part", "counts", F.explode(steps()).alias("at")).select("part", "counts", "at.*")

    def total(what: str, of) -> Column:
        return F.aggregate(F.filter("counts", of), F.lit(0).cast("long"), lambda a, c: a + c[what])

    bit, before = F.col("bit"), F.col("before")
    here = lambda c: (c["mask"].bitwiseAND(bit) != 0) & (c["mask"].bitwiseAND(before) == 0)
    shares = F.aggregate(F.filter("counts", lambda c: c["mask"].bitwiseAND(bit) != 0), F.lit(0).cast("long"), lambda a, c: a + c["n"] * F.get(F.lit(FIRST), F.bit_count(c["mask"])))
    return at.select(
        "part", "filter_order", "step",
        total("n", lambda c: c["mask"].bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda c: (c["mask"].bitwiseAND(bit) != 0) & (c["mask"].bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda c: c["mask"] == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        shares.alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source", settings: FilterAudit = FilterAudit()) -> DataFrame:
    """The audit of docs (doc_id, text and the column of the part) with labels (doc_id, quality, toxic)."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("labelled")).agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = copies(docs.select("doc_id", "text", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")), settings)
    mask = (F.col("mask") + F.when(F.col("copy"), COPY).otherwise(0)).alias("mask")
    rows = rows.join(known, F.col("doc_id") == F.col("labelled"), "left").select("part", mask, "good", "toxic")
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return audit(rows.groupBy("part", "mask").agg(F.count("*").alias("n"), whole("good"), whole("toxic")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filter_audit(docs, read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


ORACLE_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text), regexp_matches(text, '[#$%&*|]'),
   coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)] AS fails FROM d LEFT JOIN l USING (doc_id)),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, s.step, ascii(filter_order[s.step]) - 64 AS i, list_transform(range(1, s.step), lambda x: ascii(filter_order[x]) - 64) AS before FROM o, (SELECT unnest(range(1, 6)) AS step) s),
r AS (SELECT part, filter_order, step, i, good, toxic, fails[i] AS here, list_any_value(list_filter(before, lambda x: fails[x])) IS NOT NULL AS gone, len(list_filter(fails, lambda x: x)) AS many FROM m, s)
SELECT part, filter_order, CAST(step AS INT) AS step, count(*) FILTER (NOT gone AND NOT here) AS kept, count(*) FILTER (here AND NOT gone) AS removed, count(*) FILTER (here AND gone) AS redundant,
  count(*) FILTER (here AND many = 1) AS unique_fails, count(*) FILTER (here AND NOT gone AND good = 1) AS good_lost, count(*) FILTER (here AND NOT gone AND toxic = 1) AS toxic_lost,
  CAST(sum(count(*) FILTER (here AND NOT gone)) OVER (PARTITION BY part, i) AS BIGINT) AS shapley
FROM r GROUP BY part, filter_order, step, i"""
