"""Cross-entropy difference of documents under a target and a background bigram model.

Both models have one vocabulary (every word of all documents), the same order and the same
smoothing; the background model is counted over all documents, the target model over those
labelled good. A document's score is the mean over its tokens of (target loss - background
loss) in bits: the lower, the more it is like the target.

    p(w | v) = A c(v w) / c(v) + (1 - A) ((1 - B) c(w) / N + B / V)

V is the number of different words and the end mark. Bigram counts leave the scored document
out, so that a document does not vouch for itself.

Counts grow with the corpus and stay distributed. The ``FREQUENT`` most frequent words have
16-bit numbers and their counts are broadcast; that only decides how a word travels, not what
is counted. Every document's distinct bigrams travel once, packed: two numbered words to the
bucket of the pair, others to the bucket of their first word without a number, where that
word's counts are sent too (and, asked for beforehand, those of a second such word). There
bigram counts are summed and every document's share of the losses is worked out, which goes
back to the document's origin (its input partition) and meets there.

A bigram that occurs ``hot`` times or more does not travel: its words occur as often, so the
few such words are looked at first, and the counts of the bigrams (at most one for each
``hot`` tokens, and 2**20 in all) are broadcast and used where the document is. No bucket
holds more than ``hot`` entries of one bigram, nor more than N / FREQUENT of one word.
Losses are whole numbers of bits / UNIT, so sums do not depend on their order.

Defined results: null or empty text is the end mark alone (one token); every input row gives
one row (repeated rows count as documents of their own); a very long text is one document like
any other, its entries are sent on as they fill up; without any target document only the
uniform share is left to the target model; an empty table gives an empty table. Repeated or
null labels: a document is a target if any of its labels says so. Words are told apart by 63
bits of hash. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import (SENT_ROWS, bounded_batches, group_arrow, map_arrow, materialize,
                                 partitions_for, table)
from stayflow.llm.hashing import hashes_of, mix, packed, unpacked

#: Words with a number. With the marks, a pair of numbers has 32 bits.
FREQUENT = 65_533
START, END = 1, 2
#: Set in the hash of a word, which tells it from a number.
HASHED = np.uint64(1 << 63)
#: Weight of the bigram share, and of the uniform share among the rest.
A, B = 0.6, 0.05
UNIT = 4_096
#: Entries in a bucket on average; entries a task holds before it sends them on.
ENTRIES, HELD = 2_000_000, 2_000_000
#: Bytes of text whose words are in arrays at once.
SLICE = 4 << 20
#: Occurrences from which a bigram's counts are broadcast (and, so that there are at most
#: 2**20 of them, at least a 2**20th of all tokens).
HOT = 65_536
#: Stands for a null id inside packed columns; marks a target document's number in a run.
NO_ID, TARGET = np.iinfo(np.int64).min, 1 << 31
#: Largest loss that one share holds; a larger one is divided among several.
MOST = 1 << 30


def flagged(docs: DataFrame, targets: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, target (boolean) of every row; ``targets`` has distinct doc_id. Rows keep
    their place in the input's partitions, or are written out where a shuffle moves them."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    targets = materialize(targets.withColumn("target", F.lit(True)), "targets")
    few = targets.count() <= SENT_ROWS
    rows = rows.join(F.broadcast(targets) if few else targets, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    return rows if few else materialize(rows, "flagged")


def _hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    hashes, lengths = hashes_of(texts)
    return hashes | HASHED, lengths


def word_counts(rows: DataFrame) -> DataFrame:
    """word (hash), n, n_target over all rows."""

    def run(batches):
        held, size = [], 0

        def out():
            keys, back = np.unique(np.concatenate([k for k, _, _ in held]), return_inverse=True)
            n = [np.bincount(back, np.concatenate([h[i] for h in held]), len(keys)).astype(np.int64)
                 for i in (1, 2)]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), *map(pa.array, n)], ["word", "n", "n_target"])

        for batch in bounded_batches(batches, 1, SLICE):
            found, length = _hashes(batch.column(1).to_pylist())
            good = np.repeat(np.array(batch.column(2).to_pylist(), bool), length)
            keys, n = np.unique(found, return_counts=True)
            one = np.zeros(len(keys), np.int64)
            good, k = np.unique(found[good], return_counts=True)
            one[np.searchsorted(keys, good)] = k
            held.append((keys, n, one))
            size += len(keys)
            if size > HELD:
                yield out()
                size = 0
        if held:
            yield out()

    found = map_arrow(rows, run, "word long, n long, n_target long")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))


class Vocabulary:
    """Numbers of the frequent words, their counts (as history, too) in both models, and the
    counts of hot pairs."""

    def __init__(self, words: np.ndarray, n: np.ndarray, n_target: np.ndarray, totals: dict):
        order = np.argsort(words)
        self.words = words[order]
        self.size = totals["words"] + 1
        self.tokens = [max(1, totals["n"] + totals["docs"]),
                       max(1, totals["n_target"] + totals["target_docs"])]
        self.counts = [np.concatenate([[0, docs, docs], known[order]]) for known, docs in (
            (n, totals["docs"]), (n_target, totals["target_docs"]))]
        self.hot, self.hot_counts = np.zeros(0, np.uint32), [np.zeros(0, np.int64)] * 2

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of frequent words, the hashes of others."""
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        known = self.words[at] == hashes if len(self.words) else np.zeros(len(hashes), bool)
        return np.where(known, at.astype(np.uint64) + np.uint64(3), hashes)

    def hot_at(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether numbered pairs are hot, and the places of those that are."""
        at = np.searchsorted(self.hot, pairs)
        at[at == len(self.hot)] = 0
        hot = self.hot[at] == pairs if len(self.hot) else np.zeros(len(pairs), bool)
        return hot, at[hot]

    def losses(self, model: int, count: np.ndarray, first: np.ndarray, second: np.ndarray,
               ) -> np.ndarray:
        """Whole bits / UNIT in the background (0) or target model (1) for pairs that occur
        ``count`` times elsewhere there, of words that occur ``first`` and ``second`` times."""
        once = (1 - B) * second / self.tokens[model] + B / self.size
        p = np.where(first > 0, A * count / np.maximum(first, 1), 0.0) + (1 - A) * once
        return np.rint(-np.log2(p) * UNIT).astype(np.int64)

    def numbered(self, model: int, pairs: np.ndarray, count: np.ndarray) -> np.ndarray:
        counts, pairs = self.counts[model], pairs.astype(np.int64)
        return self.losses(model, count, counts[pairs >> 16], counts[pairs & 0xFFFF])


def _chain(texts: list[str], own: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document (from 0), first and second code of every bigram of the documents."""
    hashes, length = _hashes(texts)
    ends = np.cumsum(length + 2) - 1
    starts = ends - length - 1
    chain, word = np.empty(ends[-1] + 1, np.uint64), np.ones(ends[-1] + 1, bool)
    chain[starts], chain[ends] = START, END
    word[starts] = word[ends] = False
    chain[word] = own.codes(hashes)
    inside = np.ones(len(chain) - 1, bool)
    inside[ends[:-1]] = False  # from an end to the next start
    return np.repeat(np.arange(len(texts)), length + 1), chain[:-1][inside], chain[1:][inside]


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first << np.uint64(16) | second).astype(np.uint32)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _known_before(vocabulary, buckets: int, hot: int):
    """What buckets and documents have to be told: rows of bucket -1 count pairs (``word``) of
    words that occur ``hot`` times, others ask for the counts of a second word."""

    def run(batches):
        own = vocabulary.value
        heavy = np.maximum(*own.counts) >= hot
        asked, seen, size = [], [], 0

        def out():
            if asked:
                bucket, word = (np.concatenate([x[i] for x in asked]) for i in range(2))
                order = np.lexsort((word, bucket))
                bucket, word = bucket[order], word[order]
                new = np.r_[True, (bucket[1:] != bucket[:-1]) | (word[1:] != word[:-1])]
                bucket, word = bucket[new], word[new]
                yield _asks(bucket.astype(np.int32), word, np.zeros(len(word)), np.zeros(len(word)))
            if seen:
                pair, n, good = (np.concatenate([x[i] for x in seen]) for i in range(3))
                pair, at = np.unique(pair, return_inverse=True)
                yield _asks(np.full(len(pair), -1, np.int32), pair.astype(np.uint64),
                            np.bincount(at, n), np.bincount(at, good))
            asked.clear()
            seen.clear()

        for batch in bounded_batches(batches, 1, SLICE):
            doc, first, second = _chain(batch.column(1).to_pylist(), own)
            target = np.array(batch.column(2).to_pylist(), bool)
            rare = (first >= HASHED) & (second >= HASHED)
            if rare.any():
                asked.append((_bucket(first[rare], buckets), second[rare]))
                size += len(asked[-1][1])
            both = np.flatnonzero((first < HASHED) & (second < HASHED))
            if heavy.any() and len(both):
                both = both[heavy[first[both].astype(np.int64)] & heavy[second[both].astype(np.int64)]]
                pair, at = np.unique(_pairs(first[both], second[both]), return_inverse=True)
                seen.append((pair, np.bincount(at, minlength=len(pair)),
                             np.bincount(at, target[doc[both]], len(pair))))
                size += len(pair)
            if size > HELD:
                yield from out()
                size = 0
        yield from out()

    return run


def _asks(bucket, word, n, good) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket), pa.array(word.view(np.int64)), pa.array(n.astype(np.int64)),
         pa.array(good.astype(np.int64))], ["bucket", "word", "n", "n_target"])


def _told(vocabulary, buckets: int):
    """Entries that tell buckets the counts of words without a number. Rows of bucket -1 are
    all words: each goes to its own bucket."""

    def run(batches):
        own = vocabulary.value
        held, size = [], 0

        def out():
            bucket, word, n, good = (np.concatenate([h[i] for h in held]) for i in range(4))
            held.clear()
            return _rows([[b, -1, None, None, *x] for b, *x in packed(
                bucket, buckets, [word, n, good])], ENTRY, 2)

        for batch in batches:
            bucket, word, n, good = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            word = word.view(np.uint64)
            rare = own.codes(word) >= HASHED
            bucket, word, n, good = bucket[rare].astype(np.int64), word[rare], n[rare], good[rare]
            held.append((np.where(bucket < 0, _bucket(word, buckets), bucket), word, n, good))
            size += len(word)
            if size > HELD:
                yield out()
                size = 0
        if held:
            yield out()

    return run


ENTRY = ["bucket", "origin", "docs", "sizes", "pairs", "counts", "seconds"]
SHARE = ["origin", "ids", "docs", "n", "target", "back"]


def _schema(names: list[str], numbers: int) -> str:
    return ", ".join(f"{n} {'int' if k < numbers else 'binary'}" for k, n in enumerate(names))


def _rows(rows: list[list], names: list[str], numbers: int) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int32() if k < numbers else pa.binary()) for k, c in enumerate(columns)], names)


def _runs(doc: np.ndarray, target: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers (with TARGET) and sizes of the runs of equal documents."""
    head = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    runs = doc[head].astype(np.uint32) | np.where(target[head], np.uint32(TARGET), np.uint32(0))
    return runs.tobytes(), np.diff(np.r_[head, len(doc)]).astype(np.uint32).tobytes()


def _entries(vocabulary, buckets: int):
    """Per bucket and origin (input partition): the numbers of the documents there and how
    many distinct pairs each has in the bucket, the pairs and their counts. Pairs of numbered
    words are one column, ``seconds`` is null; other pairs are their codes in ``pairs`` and
    ``seconds``. Rows of bucket -1 have the documents' ids (``docs``: numbers, ``pairs``:
    ids) and what their hot pairs add (``sizes``: tokens, ``counts`` and ``seconds``: losses)."""

    def run(batches):
        own, origin = vocabulary.value, TaskContext.get().partitionId()
        ids, flag, hot, numbered, others = [], [], [], [], []
        size, first = 0, 0

        def out():
            flags = np.concatenate(flag)
            low = first - len(flags)
            rows = [[-1, origin, np.arange(low, first, dtype=np.uint32).tobytes(),
                     *(np.concatenate(x).tobytes() for x in (
                         [h[0] for h in hot], ids, [h[1] for h in hot], [h[2] for h in hot]))]]
            # packing is stable: entries of a document stay together
            doc, pair, n = (np.concatenate([x[i] for x in numbered]) for i in range(3))
            for b, docs, pairs, counts in packed(_bucket(pair, buckets), buckets, [doc, pair, n]):
                docs = np.frombuffer(docs, np.int64)
                rows.append([b, origin, *_runs(docs, flags[docs - low]), pairs, counts, None])
            doc, v, w, n = (np.concatenate([x[i] for x in others]) for i in range(4))
            owner = np.where(v >= HASHED, v, w)
            for b, docs, vs, ws, counts in packed(_bucket(owner, buckets), buckets, [doc, v, w, n]):
                docs = np.frombuffer(docs, np.int64)
                rows.append([b, origin, *_runs(docs, flags[docs - low]), vs, counts, ws])
            for x in (ids, flag, hot, numbered, others):
                x.clear()
            return _rows(rows, ENTRY, 2)

        for batch in bounded_batches(batches, 1, SLICE):
            k = batch.num_rows
            target = np.array(batch.column(2).to_pylist(), bool)
            doc, v, w = _chain(batch.column(1).to_pylist(), own)
            both = (v < HASHED) & (w < HASHED)
            key = doc[both] << 32 | _pairs(v[both], w[both]).astype(np.int64)
            key, n = np.unique(key, return_counts=True)
            of, pair = key >> 32, (key & 0xFFFFFFFF).astype(np.uint32)
            is_hot, at = own.hot_at(pair)
            d, m = of[is_hot], n[is_hot]
            sums = [np.zeros(k, np.int64) for _ in range(3)]
            elsewhere = (own.hot_counts[1][at] - m * target[d], own.hot_counts[0][at] - m)
            for out_sum, x in zip(sums, (m, *(m * own.numbered(model, pair[is_hot], c) for model, c in
                                              zip((1, 0), elsewhere)))):
                np.add.at(out_sum, d, x)
            hot.append(sums)
            numbered.append((of[~is_hot] + first, pair[~is_hot], n[~is_hot].astype(np.uint32)))

            codes, at = np.unique(np.concatenate([v[~both], w[~both]]), return_inverse=True)
            at, wide = at.astype(np.int64), max(1, len(codes))
            of, half = doc[~both], len(at) // 2
            key, n = np.unique((of * wide + at[:half]) * wide + at[half:], return_counts=True)
            others.append((key // (wide * wide) + first, codes[key // wide % wide], codes[key % wide],
                           n.astype(np.uint32)))
            ids.append(np.array([NO_ID if d is None else d for d in batch.column(0).to_pylist()], np.int64))
            flag.append(target)
            first += k
            size += len(numbered[-1][0]) + 2 * len(key)
            if size > HELD:
                yield out()
                size = 0
        if ids:
            yield out()

    return run


def _shares(vocabulary):
    """For a bucket: counts of its pairs, and every document's share of both losses, packed
    by origin."""

    def run(tbl: pa.Table) -> pa.Table:
        own = vocabulary.value
        if tbl.column("bucket")[0].as_py() < 0:  # ids go on to their origin
            rows = []
            for r in tbl.to_pylist():
                rows.append([r["origin"], r["pairs"], r["docs"], None, None, None])
                sums = [np.frombuffer(r[c], np.int64) for c in ("sizes", "counts", "seconds")]
                some = np.flatnonzero(sums[0])
                if len(some):
                    docs = np.frombuffer(r["docs"], np.uint32)[some]
                    rows.append([r["origin"], None, *(
                        x.tobytes() for x in _divided(docs, *(s[some] for s in sums)))])
            return pa.Table.from_batches([_rows(rows, SHARE, 1)])

        told = pa.compute.less(tbl.column("origin"), 0)
        coded = pa.compute.is_valid(tbl.column("seconds"))
        words = tbl.filter(told)
        tbl, coded = tbl.filter(pa.compute.invert(told)), coded.filter(pa.compute.invert(told))
        rows = []
        some = tbl.filter(pa.compute.invert(coded))
        if some.num_rows:
            pairs, at = np.unique(unpacked(some, "pairs", np.uint32), return_inverse=True)
            rows += _weighed(some, at, lambda model, here, count: own.numbered(model, pairs[here], count))
        some = tbl.filter(coded)
        if some.num_rows:
            known, place = np.unique(unpacked(words, "pairs", np.uint64), return_index=True)
            counts = [np.r_[own.counts[k], unpacked(words, c, np.int64)[place]]
                      for k, c in enumerate(("counts", "seconds"))]
            # places of words in counts: numbers first, then the words told
            v, w = (np.where(x < HASHED, x, np.searchsorted(known, x).astype(np.uint64)
                             + np.uint64(len(own.counts[0]))).astype(np.int64)
                    for x in (unpacked(some, "pairs", np.uint64), unpacked(some, "seconds", np.uint64)))
            pairs, at = np.unique(v << 32 | w, return_inverse=True)
            rows += _weighed(some, at, lambda model, here, count: own.losses(
                model, count, counts[model][pairs[here] >> 32], counts[model][pairs[here] & 0xFFFFFFFF]))
        return pa.Table.from_batches([_rows(rows, SHARE, 1)])

    return run


def _weighed(tbl: pa.Table, at: np.ndarray, losses) -> list[list]:
    """Shares of the documents by origin; ``at`` numbers the pair of every entry."""
    docs, sizes = unpacked(tbl, "docs", np.uint32), unpacked(tbl, "sizes", np.uint32).astype(np.int64)
    n = unpacked(tbl, "counts", np.uint32).astype(np.int64)
    mine = np.repeat(docs >= TARGET, sizes)
    docs = docs & np.uint32(TARGET - 1)
    back = np.bincount(at, n).astype(np.int64)
    target = np.bincount(at, n * mine, len(back)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    sums = [np.add.reduceat(x, starts) for x in (
        n, n * losses(1, at, target[at] - n * mine), n * losses(0, at, back[at] - n))]
    ends = np.cumsum([len(d) // 4 for d in tbl.column("docs").to_pylist()])
    return [[origin, None, *(x.tobytes() for x in _divided(docs[a:b], *(s[a:b] for s in sums)))]
            for origin, a, b in zip(tbl.column("origin").to_pylist(), np.r_[0, ends[:-1]], ends)]


def _divided(docs: np.ndarray, *sums: np.ndarray) -> list[np.ndarray]:
    """32-bit columns: a document whose sums are too large for one share gets several."""
    parts = np.maximum.reduce(sums) // MOST + 1
    if (parts == 1).all():
        return [docs, *(s.astype(np.uint32) for s in sums)]
    out, lead = [np.repeat(docs, parts)], np.cumsum(parts) - parts
    for s in sums:
        each = np.repeat(s // parts, parts)
        each[lead] += s % parts
        out.append(each.astype(np.uint32))
    return out


def _sums(tbl: pa.Table) -> pa.Table:
    """doc_id, n_tokens, target, back of the documents of an origin."""
    named = pa.compute.is_valid(tbl.column("ids"))
    ids = unpacked(tbl.filter(named), "ids", np.int64)
    where = unpacked(tbl.filter(named), "docs", np.uint32)
    shares = tbl.filter(pa.compute.invert(named))
    docs = unpacked(shares, "docs", np.uint32)
    place = np.zeros(len(ids), np.int64)
    place[where] = ids
    # sums of 32-bit parts, low and high halves apart: exact in the doubles of bincount
    sums = {}
    for out, column in (("n_tokens", "n"), ("target", "target"), ("back", "back")):
        x = unpacked(shares, column, np.uint32)
        low, high = (np.bincount(docs, part, len(ids)) for part in (x & np.uint32(0xFFFF), x >> np.uint32(16)))
        sums[out] = low.astype(np.int64) + (high.astype(np.int64) << 16)
    return pa.table({"doc_id": pa.array(place, pa.int64(), mask=place == NO_ID), **sums})


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id",
                             text_col: str = "text", frequent: int = FREQUENT,
                             hot: int = HOT) -> DataFrame:
    """doc_id, n_tokens, target_bits, background_bits, difference (per token) for every row
    of ``docs``; ``targets`` has the ids of the target documents as doc_id. ``frequent`` and
    ``hot`` change what travels, not the rows."""
    context = docs.sparkSession.sparkContext
    targets = targets.select(F.col("doc_id").cast("long")).filter("doc_id is not null").distinct()
    rows = flagged(docs, targets, id_col, text_col)
    counts = materialize(word_counts(rows), "word-counts")
    total = counts.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"),
                       F.sum("n_target").alias("n_target")).first()
    of_docs = rows.agg(F.count(F.lit(1)).alias("docs"),
                       F.count(F.when(F.col("target"), 1)).alias("target_docs")).first()
    totals = {k: v or 0 for k, v in {**total.asDict(), **of_docs.asDict()}.items()}
    tokens = totals["n"] + totals["docs"]
    top = counts.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    vocabulary = Vocabulary(
        top.column("word").to_numpy().astype(np.int64).view(np.uint64),
        top.column("n").to_numpy(), top.column("n_target").to_numpy(), totals)
    buckets = partitions_for(docs.sparkSession, totals["n"], ENTRIES)
    hot = max(hot, tokens >> 20)

    shared = context.broadcast(vocabulary)
    ask = "bucket int, word long, n long, n_target long"
    before = materialize(map_arrow(rows, _known_before(shared, buckets, hot), ask), "known-before")
    found = (before.filter("bucket < 0").groupBy("word")
             .agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))
             .filter(F.col("n") >= hot).orderBy("word").toArrow())
    vocabulary.hot = found.column("word").to_numpy().astype(np.uint32)
    vocabulary.hot_counts = [found.column(c).to_numpy().astype(np.int64) for c in ("n", "n_target")]
    shared = context.broadcast(vocabulary)

    asked = before.filter("bucket >= 0").select("bucket", "word").join(counts, "word")
    told = asked.select("bucket", "word", "n", "n_target").unionByName(
        counts.select(F.lit(-1).alias("bucket"), "word", "n", "n_target"))
    entries = map_arrow(rows, _entries(shared, buckets), _schema(ENTRY, 2)).unionByName(
        map_arrow(told, _told(shared, buckets), _schema(ENTRY, 2)))
    # ids stay with their origin's group instead of one for all
    entries = entries.withColumn("part", F.when(F.col("bucket") < 0, -1 - F.col("origin"))
                                 .otherwise(F.col("bucket")))
    shares = group_arrow(entries, ["part"], _shares(shared), _schema(SHARE, 1))
    sums = group_arrow(shares, ["origin"], _sums, "doc_id long, n_tokens long, target long, back long")
    per = F.lit(float(UNIT)) * F.col("n_tokens")
    return sums.select("doc_id", "n_tokens", (F.col("target") / per).alias("target_bits"),
                       (F.col("back") / per).alias("background_bits"),
                       ((F.col("target") - F.col("back")) / per).alias("difference"))


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)
