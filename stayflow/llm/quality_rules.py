"""Quality rules: counting rules and language-specific perplexity bands.

Spark counts the character trigrams of every language over all its different texts (a row of
a text that stands in c rows counts 1/c, so copies do not teach the model); continuation counts,
discounts, probabilities and back-off weights of a modified Kneser-Ney model are computed by
grouping and joining those counts. The model becomes, for each order, a sorted array of
n-gram hashes with a cost each (bits times 2**16, as whole numbers, so that a document's sum
does not depend on batches). Hashes lie below ``SLOTS``, so an array has at most ``SLOTS``
entries however large the corpus is: that bounds what is broadcast (64-bit counts never are).
N-grams that share a hash share the smaller cost.

A text's bits per character are those of the middle half of its blocks of ``BLOCK``
characters by cost, so that a quotation in another language or a table does not decide. They
are compared with the language's band: quartiles of all different texts that pass the counting
rules, widened by ``reach`` spreads on both sides, and further for short texts, whose mean is
less certain.

Defined results: null or empty text has no words and fails; a null language is a language of
its own (""); every input row gives one row; an empty table gives an empty table. U+10FFFF,
no character, is read as a text boundary by the model. Other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.common import bounded_batches, map_arrow, materialize, sent, table, words

#: Hashes are smaller than this prime, and so is the number of entries of an array.
SLOTS = 16_777_213
#: Multiply a language's checksum and the characters (from the last back) in the hash.
LANGUAGE_STEP, STEPS_BACK = 7_919, (12_345_701, 5_915_587, 9_176_263)
#: Stands before and after each text.
MARK = "\U0010ffff"
SYMBOLS = "#*$%&|<>"
#: Bytes of text whose characters are in arrays at once (some 50 bytes for each character).
SLICE = 2 << 20
#: Characters in a block; a quarter of a text's blocks is left out at either end.
BLOCK = 64
#: Costs are in bits / UNIT; bands are found on steps of bits / STEPS.
UNIT, STEPS = 65_536, 256
#: A band reaches this many spreads (inter-quartile ranges, at least LEAST bits) beyond the quartiles. In texts below LONG characters a
#: quotation can fill the middle blocks: they may cost ODD bits more or less in all, falling to
#: none at LONG.
REACH, LEAST, ODD, LONG = 2.5, 0.05, 700.0, 2500


# ---------------------------------------------------------------- counting rules

def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    # bytes are split at space and U+0009 to U+000D alone
    found = text.encode("utf-8", "surrogatepass").split()
    lines = text.split("\n")
    dup = 0
    if len(set(lines)) < len(lines):
        kept = [x for x in lines if words(x)]
        dup = len(kept) - len(set(kept))
    return (len(found), len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")),
            sum(map(text.count, SYMBOLS)), dup, repeat_words(found))


def repeat_words(found: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur at least twice."""
    n = len(found) - width + 1
    if n < 2:
        return 0
    one = np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64)
    windows = np.zeros(n, np.uint64)
    for k in range(width):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + one[k:k + n]
        windows ^= windows >> np.uint64(29)
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    at = np.flatnonzero(np.isin(windows, again))
    cover = np.zeros(len(found) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    return int(np.count_nonzero(np.cumsum(cover[:-1])))


# ---------------------------------------------------------------- the model

def _codes(texts: list[str]) -> np.ndarray:
    """Code points of the texts, two marks before each and after the last."""
    marks = MARK * 2
    joined = marks + marks.join(texts) + marks
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _trigrams(codes: np.ndarray) -> np.ndarray:
    return codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]


def with_copies(docs: DataFrame) -> DataFrame:
    """``docs`` (with lang, text) with ``digest`` of the text and ``copies``, in how many rows
    of its language the text stands."""
    docs = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    many = (docs.groupBy("lang", "digest").agg(F.count(F.lit(1)).alias("copies"))
            .filter("copies > 1"))
    return (docs.join(sent(materialize(many, "copied-texts")), ["lang", "digest"], "left")
            .withColumn("copies", F.coalesce("copies", F.lit(1).cast("long"))))


def trigram_counts(docs: DataFrame) -> DataFrame:
    """lang, c1, c2, c3, n: how often each character follows each two, by language; a row
    counts 1 / ``copies``, so that each different text counts once."""

    def run(batches):
        held: dict[str, list] = {}
        size = 0

        def out():
            for lang, parts in held.items():
                keys = np.concatenate([k for k, _ in parts])
                n = np.concatenate([c for _, c in parts])
                keys, back = np.unique(keys, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array(keys),
                     pa.array(np.bincount(back, n, len(keys)))], ["lang", "key", "n"])
            held.clear()

        for batch in bounded_batches(batches, 1, SLICE):
            by: dict[tuple[str, int], list[str]] = {}
            for lang, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
                by.setdefault((lang, copies), []).append(text)
            for (lang, copies), texts in by.items():
                codes = _codes(texts)
                keys = _trigrams(codes)[codes[2:] != ord(MARK)]
                keys, n = np.unique(keys, return_counts=True)
                held.setdefault(lang, []).append((keys, n / copies))
                size += len(keys)
            if size > 1_500_000:
                yield from out()
                size = 0
        yield from out()

    found = map_arrow(docs.select("lang", "text", "copies"), run, "lang string, key long, n double")
    # the parts of a text's copies add up to a whole number
    found = found.groupBy("lang", "key").agg(F.round(F.sum("n")).cast("long").alias("n"))
    low = (1 << 21) - 1
    return found.select("lang", F.shiftright("key", 42).alias("c1"),
                        F.shiftright("key", 21).bitwiseAND(F.lit(low)).alias("c2"),
                        F.col("key").bitwiseAND(F.lit(low)).alias("c3"), "n")


def _discounts(counts: DataFrame) -> DataFrame:
    """lang, d1, d2, d3: the modified Kneser-Ney discounts of counts ``n``; their limits
    stand in where a count of counts is missing."""
    many = [F.count(F.when(F.col("n") == k, 1)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    some = counts.groupBy("lang").agg(*many)
    y = F.expr("n1 / (n1 + 2 * n2)")
    whole = F.expr("n1 > 0 and n2 > 0 and n3 > 0 and n4 > 0")

    def d(k: int):
        value = F.lit(float(k)) - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        return F.when(whole, F.greatest(F.lit(0.05), F.least(F.lit(k - 0.05), value))).otherwise(
            F.lit(0.5 * k)).alias(f"d{k}")

    return some.select("lang", d(1), d(2), d(3))


def _order(counts: DataFrame, context: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of counts (lang, *context, c3, n): (the same with ``own``, the discounted share of
    the context's count, and ``back``, what the discounts leave over for the order below)
    and (lang, *context, back)."""
    cut = _discounts(counts)
    less = F.expr("case when n = 1 then d1 when n = 2 then d2 else d3 end")
    counts = counts.join(cut, "lang").withColumn("less", less)
    total = counts.groupBy("lang", *context).agg(
        F.sum("n").alias("total"), F.sum(F.round(F.col("less") * UNIT)).alias("left"))
    total = materialize(total.withColumn("back", F.col("left") / UNIT / F.col("total")), "contexts")
    own = counts.join(total, ["lang", *context]).withColumn(
        "own", (F.col("n") - F.col("less")) / F.col("total")).drop("n", "less", "total", "left")
    return own, total.select("lang", *context, "back")


def _cost(p: Column) -> Column:
    return F.round(-F.log2(p) * UNIT).cast("int")


def _slot(lang: str, *codes: str):
    key = F.lit(0).cast("long")
    for c, step in zip(reversed(codes), STEPS_BACK):
        key = key + F.col(c) * step
    shift = F.pmod(F.crc32(F.encode(F.col(lang), "utf-8")), F.lit(SLOTS)) * LANGUAGE_STEP
    return F.pmod(F.pmod(key, F.lit(SLOTS)) + shift, F.lit(SLOTS)).cast("int")


@dataclass
class CharacterModel:
    """For orders 3, 2, 1: sorted hashes, costs, and costs of backing off (to order - 1 from
    an n-gram as context); ``unknown``: cost of a character never seen."""

    arrays: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    unknown: int

    def _find(self, lang: str, *codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the arrays of the n-grams of ``codes``, and whether they are there."""
        key = sum(c * step for c, step in zip(reversed(codes), STEPS_BACK))
        shift = zlib.crc32(lang.encode("utf-8", "surrogatepass")) % SLOTS * LANGUAGE_STEP
        slots = ((key % SLOTS + shift) % SLOTS).astype(np.int32)
        known = self.arrays[len(codes)][0]
        at = np.searchsorted(known, slots)
        if len(known):
            np.minimum(at, len(known) - 1, out=at)
            return at, known[at] == slots
        return at, np.zeros(len(at), bool)

    def costs(self, lang: str, codes: np.ndarray) -> np.ndarray:
        """Cost of each of codes[2:] after the two codes before it."""
        at, hit = self._find(lang, codes[:-2], codes[1:-1], codes[2:])
        if not len(self.arrays[3][0]):
            return np.full(len(codes) - 2, self.unknown, np.int64)
        out = self.arrays[3][1][at].astype(np.int64)
        miss = np.flatnonzero(~hit)
        if len(miss):
            a, b, c = codes[miss], codes[miss + 1], codes[miss + 2]
            at, there = self._find(lang, a, b)
            cost = np.where(there, self.arrays[2][2][at], 0).astype(np.int64)
            at, two = self._find(lang, b, c)
            ctx, there = self._find(lang, b)
            one, known = self._find(lang, c)
            cost += np.where(two, self.arrays[2][1][at],
                             np.where(there, self.arrays[1][2][ctx], 0)
                             + np.where(known, self.arrays[1][1][one], self.unknown))
            out[miss] = cost
        return out


def fit(docs: DataFrame) -> CharacterModel:
    """The trigram model of ``docs`` (lang, text), counted over all rows, or with ``copies``
    over all different texts."""
    if "copies" not in docs.columns:
        docs = docs.withColumn("copies", F.lit(1).cast("long"))
    tri = materialize(trigram_counts(docs), "trigrams")
    # each level is written out: it is small, and read several times by the next
    bi = materialize(tri.groupBy("lang", "c2", "c3").agg(F.count(F.lit(1)).alias("n")), "bigrams")
    uni = materialize(bi.groupBy("lang", "c3").agg(F.count(F.lit(1)).alias("n")), "unigrams")
    size = uni.groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("letters"))

    own1, left1 = _order(uni, [])
    p1 = materialize(own1.join(size, "lang").select(
        "lang", "c3", (F.col("own") + F.col("back") / F.col("letters")).alias("p1")), "order-1")
    own2, left2 = _order(bi, ["c2"])
    p2 = materialize(own2.join(p1, ["lang", "c3"]).select(
        "lang", "c2", "c3", (F.col("own") + F.col("back") * F.col("p1")).alias("p2")), "order-2")
    own3, left3 = _order(tri, ["c1", "c2"])
    p3 = own3.join(p2, ["lang", "c2", "c3"]).select(
        "lang", "c1", "c2", "c3", (F.col("own") + F.col("back") * F.col("p2")).alias("p3"))

    three = p3.select(_slot("lang", "c1", "c2", "c3").alias("slot"),
                      _cost(F.col("p3")).alias("cost"), F.lit(0).alias("back"))
    left3 = left3.select("lang", F.col("c1").alias("c2"), F.col("c2").alias("c3"), "back")
    # contexts at the start of a text are no n-grams: they have a back-off cost alone
    two = p2.join(left3, ["lang", "c2", "c3"], "full").select(
        _slot("lang", "c2", "c3").alias("slot"), _cost(F.col("p2")).alias("cost"),
        F.coalesce(_cost(F.col("back")), F.lit(0)).alias("back"))
    one = p1.join(left2.withColumnRenamed("c2", "c3"), ["lang", "c3"], "full").select(
        _slot("lang", "c3").alias("slot"), _cost(F.col("p1")).alias("cost"),
        F.coalesce(_cost(F.col("back")), F.lit(0)).alias("back"))

    rows = F.lit(3).alias("order")
    every = three.select(rows, "*").unionByName(two.select(F.lit(2).alias("order"), "*")
                                                ).unionByName(one.select(F.lit(1).alias("order"), "*"))
    # at most SLOTS rows for each order
    got = every.groupBy("order", "slot").agg(
        F.coalesce(F.min("cost"), F.lit(0)).alias("cost"), F.min("back").alias("back")).toArrow()
    order, slot, cost, back = (got.column(c).to_numpy() for c in ("order", "slot", "cost", "back"))
    arrays = {}
    for k in (3, 2, 1):
        mine = np.flatnonzero(order == k)
        mine = mine[np.argsort(slot[mine])]
        arrays[k] = tuple(np.ascontiguousarray(x[mine].astype(np.int32)) for x in (slot, cost, back))
    return CharacterModel(arrays, int(max(arrays[1][1], default=20 * UNIT)) + UNIT)


def middle(total: np.ndarray) -> tuple[int, int]:
    """Cost and characters of the middle half of a text's blocks; ``total`` has the cost of
    the first 0, 1, ... n characters."""
    n = len(total) - 1
    edges = np.append(np.arange(0, n, BLOCK), n)
    cost, size = np.diff(total[edges]), np.diff(edges)
    out = len(size) // 4
    if out:
        mid = np.argsort(cost * BLOCK // size, kind="stable")[out:-out]
        cost, size = cost[mid], size[mid]
    return int(cost.sum()), int(size.sum())


def score(docs: DataFrame, model: CharacterModel) -> DataFrame:
    """The text's digest, the counting rules, n_chars, and of the middle blocks cost (in
    bits / UNIT) and characters, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ints = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_chars", "cost", "cost_chars"]

    def run(batches):
        model = shared.value
        for batch in bounded_batches(batches, 2, SLICE):
            langs, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            rows = np.zeros((len(texts), len(ints)), np.int64)
            by: dict[str, list[int]] = {}
            for i, (lang, text) in enumerate(zip(langs, texts)):
                rows[i, :5] = base_counts(text)
                rows[i, 5] = len(text)
                by.setdefault(lang, []).append(i)
            for lang, mine in by.items():
                cost = model.costs(lang, _codes([texts[i] for i in mine]))
                total = np.concatenate([[0], np.cumsum(cost)])
                n = rows[mine, 5]
                start = np.concatenate([[0], np.cumsum(n + 2)[:-1]])
                for i, a, k in zip(mine, start.tolist(), n.tolist()):
                    rows[i, 6:] = middle(total[a:a + k + 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), *map(pa.array, rows.T.copy())],
                ["doc_id", "lang", "digest", *ints])

    return map_arrow(docs.select("doc_id", "lang", "text", "digest"), run,
                     "doc_id long, lang string, digest binary, " + ", ".join(f"{c} long" for c in ints))


# ---------------------------------------------------------------- the verdict

def bands(scored: DataFrame, reach: float = REACH) -> DataFrame:
    """lang, low, high: the band of bits per character of each language, from the quartiles
    of its different texts that pass the counting rules."""
    step = F.floor(F.col("cost") * STEPS / UNIT / F.col("cost_chars")).alias("step")
    counts = (scored.filter(~F.col("base_failed") & (F.col("n_chars") > 0))
              .select("lang", "digest", step).distinct()
              .groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n")))
    own = Window.partitionBy("lang")
    counts = counts.select(
        "lang", "step", F.sum("n").over(own.orderBy("step")).alias("below"),
        F.sum("n").over(own).alias("all"))

    def quartile(k: int):
        return F.min(F.when(4 * F.col("below") >= k * F.col("all"), F.col("step")))

    a, b = F.col("a"), F.col("b")
    spread = F.greatest(b - a, F.lit(LEAST * STEPS))
    return (counts.groupBy("lang").agg(quartile(1).alias("a"), (quartile(3) + 1).alias("b"))
            .select("lang", ((a - reach * spread) / STEPS).alias("low"),
                    ((b + reach * spread) / STEPS).alias("high")))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", reach: float = REACH, odd: float = ODD) -> DataFrame:
    """One row per document: the counts, base_failed, bits_per_char, its language's band
    (low, high) and kept."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = with_copies(docs)
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    scored = materialize(score(docs, fit(docs)).withColumn("base_failed", failed), "scored")
    bits = F.when(F.col("n_chars") > 0, F.col("cost") / UNIT / F.col("cost_chars"))
    slack = odd * F.greatest(1 / F.greatest(F.col("n_chars"), F.lit(1)) - 1 / LONG, F.lit(0.0))
    inside = (F.col("bits_per_char") >= F.col("low") - slack) & (
        F.col("bits_per_char") <= F.col("high") + slack)
    return (scored.withColumn("bits_per_char", bits)
            .join(bands(scored, reach), "lang", "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
            .drop("cost", "cost_chars", "digest"))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
