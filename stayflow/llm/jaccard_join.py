"""Jaccard join of word-shingle sets by token-combination prefixes.

1. Texts become sets of 64-bit shingle hashes. Equal sets form a class; one document stands
   for it from here on.
2. Tokens are ordered by hash. Prefixes are extended: the first n - ceil(t n) + e(n) tokens of
   a set of n are its prefix, with e(n) = ``extend`` + n / ``spread``. Two sets of similarity t
   have their first e common tokens in both prefixes (e of the smaller, or all they share).
3. Rare tokens, in at most ``rare`` prefixes, index documents singly. A pair found so is a
   candidate if the sizes allow a link, and the rare tokens it shares, with as many frequent
   tokens as the poorer prefix has, reach e.
4. Pairs that share no rare token share e frequent ones. Only documents with that many are
   indexed by combinations: k tokens that follow one another in the set's order. Similar sets
   differ so little that some run of r common tokens is uninterrupted in both
   (:func:`run_length`); of every r - k + 1 combinations in a row the one of least hash is
   indexed, so both documents index a common one. Being asked for a large share of frequent
   tokens, few documents take part, however frequent common phrases get in a large corpus.
5. Candidates form clusters. Inside a cluster, sets are compared exactly, in blocks of
   ``BLOCK`` documents, and linked documents are joined to components. No pairs are emitted
   but one link per document and block; no candidates are capped.

Entries travel as packed arrays, by hash bucket; the number of buckets follows the entries.
An entry that very many documents share is reduced to one per input partition first.

Defined results: null or empty text has an empty set and is linked with nothing; a text of
fewer words than a shingle has one token, the whole sequence. Every input row gives one row;
rows of one id are one document with equal texts, and linked by the id if texts differ. An
empty table gives an empty table. A null id takes the component of documents with an equal
set, or null. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import (bounded_batches, group_arrow, id_text, map_arrow,
                                 materialize, partitions_for, sent, table)
from stayflow.llm.components import components
from stayflow.llm.hashing import mix, packed, packed_batch, unpacked, word_hashes

#: Prefixes that hold a rare token; tokens (and set size over them) that extend prefixes.
RARE, EXTEND, SPREAD = 8, 8, 10
#: Documents compared with each other at once; combinations have at most this many tokens.
BLOCK, LONGEST = 512, 5
#: Entries in a bucket, on average.
ENTRIES = 1_000_000


@dataclass(frozen=True)
class Similarity:
    """Sets link when ``of`` * |both| >= ``part`` * |either|; shingles have ``words`` words."""

    words: int = 3
    part: int = 90
    of: int = 100

    @property
    def smallest(self) -> int:
        """Sets below this size link with equal sets only."""
        return -(-self.part // (self.of - self.part))

    def needed(self, n: int) -> int:
        """Tokens that a set of n has in common with any set that it links with."""
        return -(-self.part * n // self.of)

    def extension(self, n: int, extend: int) -> int:
        """Common tokens that the prefix of a set of n has with that of a larger one."""
        return min(extend + n // SPREAD, self.needed(n))

    def linked(self, both, n, m):
        return self.of * both >= self.part * (n + m - both)


@lru_cache(maxsize=None)
def run_length(sim: Similarity, n: int) -> int:
    """Common tokens in an uninterrupted run that a set of n has at least with any different
    set, of its size or larger, that it links with: d differences leave d + 1 runs."""
    m = np.arange(n, n * sim.of // sim.part + 1)
    both = -(-sim.part * (n + m) // (sim.part + sim.of))
    ok = both <= n
    return int((-(-both[ok] // (n + m[ok] - 2 * both[ok] + 1))).min())


@lru_cache(maxsize=None)
def combinations(sim: Similarity) -> tuple[int, tuple[int, int], tuple[int, int]]:
    """(border, small, large): pairs whose smaller set is below ``border`` meet in
    combinations of small = (k tokens, one of w in a row), others in those of large."""
    lengths = [run_length(sim, n) for n in range(sim.smallest, 4000)]
    long = min(lengths[2000:])
    short_at = [i for i, r in enumerate(lengths) if r < long]
    border = sim.smallest + (short_at[-1] + 1 if short_at else 0)

    def shape(run: int) -> tuple[int, int]:
        k = min(LONGEST, max(min(run, 2), run - 1))
        return k, run - k + 1

    return border, shape(min(lengths)), shape(long)


# ---------------------------------------------------------------- sets

def _combine(tokens: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive tokens."""
    n = len(tokens) - k + 1
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = mix(out + tokens[j:j + n])
    return out


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``words`` words; A-Z count as a-z."""
    tokens = word_hashes(text)
    return np.unique(_combine(tokens, min(words, len(tokens)))) if len(tokens) else tokens


def _sets(docs: DataFrame, sim: Similarity, extend: int) -> DataFrame:
    """doc_id, n, digest (of the set), prefix (the extended prefix, packed) per row."""

    def run(batches):
        import xxhash

        for batch in bounded_batches(batches, 1, 4 << 20):
            n, digest, prefix = [], [], []
            for text in batch.column(1).to_pylist():
                tokens = shingle_set(text, sim.words)
                n.append(len(tokens))
                digest.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                size = len(tokens)
                long = size - sim.needed(size) + sim.extension(size, extend)
                prefix.append(tokens[:long].tobytes() if size >= sim.smallest else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(prefix, pa.binary())], ["doc_id", "n", "digest", "prefix"])

    return map_arrow(docs, run, "doc_id long, n long, digest binary, prefix binary")


# ---------------------------------------------------------------- packed entries

def _scatter(buckets: int):
    """Token entries of the prefixes: bucket, tokens, ids, sizes (packed)."""
    names = ["bucket", "tokens", "ids", "sizes"]

    def run(batches):
        for batch in bounded_batches(batches, 2, 8 << 20):
            prefix = batch.column(2).to_pylist()
            lengths = np.array([len(p) // 8 for p in prefix], np.int64)
            tokens = np.frombuffer(b"".join(prefix), np.uint64)
            ids = np.repeat(batch.column(0).to_numpy(), lengths)
            sizes = np.repeat(batch.column(1).to_numpy(), lengths)
            bucket = (mix(tokens) % np.uint64(buckets)).astype(np.int64)
            yield packed_batch(list(packed(bucket, buckets, [tokens, ids, sizes])), names)

    return run


def _rare_pairs(sim: Similarity, rare: int):
    """For a bucket of token entries: (a, b, n) for documents a < b that share n rare tokens
    and whose sizes allow a link, and (a, null, n) for a document with n frequent tokens."""

    def run(tbl: pa.Table) -> pa.Table:
        tokens, ids, sizes = (unpacked(tbl, c, k) for c, k in (
            ("tokens", np.uint64), ("ids", np.int64), ("sizes", np.int64)))
        order = np.lexsort((ids, tokens))
        tokens, ids, sizes = tokens[order], ids[order], sizes[order]
        # rows of one id, if repeated, are one document
        new = np.r_[True, (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1])][:len(tokens)]
        tokens, ids, sizes = tokens[new], ids[new], sizes[new]
        starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else []
        count = np.diff(np.r_[starts, len(tokens)]).astype(np.int64)
        df = np.repeat(count, count)
        frequent, n = np.unique(ids[df > rare], return_counts=True)
        few = (df > 1) & (df <= rare)
        tokens, ids, sizes = tokens[few], ids[few], sizes[few]
        pairs = []
        for k in range(1, rare):
            same = tokens[k:] == tokens[:-k]
            a, b, na, nb = ids[:-k][same], ids[k:][same], sizes[:-k][same], sizes[k:][same]
            ok = sim.of * np.minimum(na, nb) >= sim.part * np.maximum(na, nb)
            pairs.append(np.stack([a[ok], b[ok]], axis=1))
        pairs, shared = np.unique(np.concatenate(pairs), axis=0, return_counts=True)
        none = pa.nulls(len(frequent), pa.int64())
        return pa.table({
            "a": pa.concat_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(frequent, pa.int64())]),
            "b": pa.concat_arrays([pa.array(pairs[:, 1], pa.int64()), none]),
            "n": pa.concat_arrays([pa.array(shared, pa.int64()), pa.array(n, pa.int64())])})

    return run


# ---------------------------------------------------------------- combinations

def indexed_combinations(tokens: np.ndarray, k: int, w: int) -> np.ndarray:
    """The least of every w combinations in a row of k consecutive tokens."""
    if len(tokens) < k:
        return np.empty(0, np.uint64)
    found = _combine(tokens, k)
    if w > 1 and len(found) > w:
        found = np.lib.stride_tricks.sliding_window_view(found, w).min(axis=1)
    elif w > 1:
        found = found.min(keepdims=True)
    return np.unique(found)


def _index(sim: Similarity, buckets: int):
    """Combination entries of a partition's documents: bucket, sigs, ids (packed). Of the
    documents that share one here, the smallest goes on, linked with the others by rows of
    bucket -1 (sigs: smaller ids, ids: larger ids)."""
    border, small, large = combinations(sim)

    def run(batches):
        sigs, ids = [], []
        for batch in batches:
            for doc, n, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "tokens"))):
                tokens = np.frombuffer(raw, np.uint64)
                own = []
                if n >= border:
                    own.append(indexed_combinations(tokens, *large))
                if sim.needed(n) < border:
                    # another salt keeps the two kinds apart
                    own.append(~indexed_combinations(tokens, *small))
                for found in own:
                    sigs.append(found)
                    ids.append(np.full(len(found), doc, np.int64))
        if not sigs:
            return
        sigs, ids = np.concatenate(sigs), np.concatenate(ids)
        edges, first = _stars(sigs, ids)
        origin = (mix(edges[:, 0].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        rows = [[-1 - b, *cols] for b, *cols in packed(origin, buckets, [edges[:, 0], edges[:, 1]])]
        sigs, ids = sigs[first], ids[first]
        bucket = (mix(sigs) % np.uint64(buckets)).astype(np.int64)
        rows += packed(bucket, buckets, [sigs, ids])
        yield packed_batch(rows, ["bucket", "sigs", "ids"])

    return run


def _stars(sigs: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct links (smallest id of an entry, other id), and the places of the smallest."""
    order = np.lexsort((ids, sigs))
    s, i = sigs[order], ids[order]
    head = np.r_[True, s[1:] != s[:-1]] if len(s) else np.empty(0, bool)
    least = i[head][np.cumsum(head) - 1] if len(s) else i
    links = np.stack([least, i], axis=1)[least != i]
    return (np.unique(links, axis=0) if len(links) else links), order[head]


def _meet(tbl: pa.Table) -> pa.Table:
    """Links of a bucket of combination entries (negative buckets hold links already)."""
    a, b = unpacked(tbl, "sigs", np.uint64), unpacked(tbl, "ids", np.int64)
    if tbl.column("bucket")[0].as_py() < 0:
        links = np.unique(np.stack([a.view(np.int64), b], axis=1), axis=0)
    else:
        links, _ = _stars(a, b)
    return pa.table({"a": pa.array(links[:, 0], pa.int64()), "b": pa.array(links[:, 1], pa.int64())})


# ---------------------------------------------------------------- verification

def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """|x & y| for every x of ``left`` and y of ``right`` (sorted sets)."""
    tokens = np.concatenate(left + right)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    order = np.argsort(tokens, kind="stable")
    tokens, rows = tokens[order], rows[order]
    head = np.r_[True, tokens[1:] != tokens[:-1]]
    number = np.cumsum(head) - 1
    several = np.bincount(number) > 1
    rows, number = rows[several[number]], (np.cumsum(several) - 1)[number[several[number]]]
    out = np.zeros((len(left), len(right)), np.float32)
    wide = max(256, (4 << 20) // max(1, len(left) + len(right)))
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, wide):
        a, b = np.searchsorted(number, (low, low + wide))
        part = np.zeros((len(left) + len(right), wide), np.float32)
        part[rows[a:b], number[a:b] - low] = 1
        out += part[:len(left)] @ part[len(left):].T
    return out.astype(np.int64)


def _roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each row reaches through the square matrix ``linked``."""
    labels = ids.copy()
    top = np.iinfo(np.int64).max
    while True:
        new = np.minimum(labels, np.where(linked, labels[None, :], top).min(axis=1))
        if (new == labels).all():
            return labels
        labels = new


def _verify(sim: Similarity):
    """Links (root, id) of the documents of one group: whole clusters, or two blocks of one."""

    def run(tbl: pa.Table) -> pa.Table:
        comp, part, ids = (tbl.column(c).to_numpy() for c in ("comp", "part", "doc_id"))
        raw = tbl.column("tokens")
        found_a, found_b = [], []
        order = np.lexsort((ids, comp))
        ends = np.flatnonzero(np.r_[comp[order][1:] != comp[order][:-1], True]) + 1
        start = 0
        for end in ends.tolist():
            mine = order[start:end]
            start = end
            sets = [np.frombuffer(raw[int(i)].as_py(), np.uint64) for i in mine]
            n = np.array([len(s) for s in sets])
            own = part[mine]
            if (own == own[0]).all():
                linked = sim.linked(intersections(sets, sets), n[:, None], n[None, :])
            else:  # between two blocks; each block alone is another group
                one, two = np.flatnonzero(own == own.min()), np.flatnonzero(own == own.max())
                cross = sim.linked(intersections([sets[i] for i in one], [sets[i] for i in two]),
                                   n[one][:, None], n[two][None, :])
                linked = np.zeros((len(mine), len(mine)), bool)
                linked[np.ix_(one, two)], linked[np.ix_(two, one)] = cross, cross.T
            root = _roots(linked, ids[mine])
            other = root != ids[mine]
            found_a.append(root[other])
            found_b.append(ids[mine][other])
        empty = np.empty(0, np.int64)
        return pa.table({"a": np.concatenate([empty, *found_a]), "b": np.concatenate([empty, *found_b])})

    return run


def jaccard_classes(docs: DataFrame, sim: Similarity = Similarity(), id_col: str = "doc_id",
                    text_col: str = "text", rare: int = RARE, extend: int = EXTEND) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    spark = docs.sparkSession
    texts = id_text(docs, id_col, text_col)
    sets = materialize(_sets(texts, sim, extend), "shingle-sets")

    usable = (F.col("n") >= sim.smallest) & F.col("doc_id").isNotNull()
    names = sets.filter(usable).select("doc_id", "digest")
    first = names.groupBy("digest").agg(F.min("doc_id").alias("first"))
    others = materialize(names.join(first, "digest").filter(F.col("doc_id") != F.col("first"))
                         .select("doc_id").distinct(), "copies")
    # copies are left out where the sets are read; repeats of a row count once
    reps = sets.filter(usable).select("doc_id", "n", "prefix").join(
        sent(others), "doc_id", "left_anti")
    entries = reps.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0
    buckets = partitions_for(spark, int(entries), ENTRIES)
    found = group_arrow(map_arrow(reps, _scatter(buckets),
                                  "bucket int, tokens binary, ids binary, sizes binary"),
                        ["bucket"], _rare_pairs(sim, rare), "a long, b long, n long")
    found = materialize(found, "prefix-matches")

    info = (found.filter(F.col("b").isNull()).groupBy(F.col("a").alias("doc_id"))
            .agg(F.sum("n").alias("frequent")))
    info = materialize(reps.select("doc_id", "n").distinct().join(info, "doc_id", "left").select(
        "doc_id", F.coalesce("frequent", F.lit(0)).alias("frequent"), "n"), "frequent-tokens")

    def needed(n):
        return F.ceil(n * sim.part / F.lit(sim.of))

    def extension(n):
        return F.least(F.lit(extend) + F.floor(n / SPREAD), needed(n))

    # pairs of rare tokens that can share enough
    pairs = (found.filter(F.col("b").isNotNull()).groupBy("a", "b").agg(F.sum("n").alias("shared"))
             .join(info.select(F.col("doc_id").alias("a"), F.col("frequent").alias("fa"), F.col("n").alias("na")), "a")
             .join(info.select(F.col("doc_id").alias("b"), F.col("frequent").alias("fb"), F.col("n").alias("nb")), "b")
             .filter(F.col("shared") + F.least("fa", "fb") >= extension(F.least("na", "nb")))
             .select("a", "b"))
    pairs = materialize(pairs, "rare-pairs")

    # documents whose frequent tokens alone can be enough for their smallest partner
    heavy = (info.filter(F.col("frequent") >= extension(needed(F.col("n"))))
             .select("doc_id", F.lit(True).alias("heavy")))
    paired = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    wanted = heavy.unionByName(paired.withColumn("heavy", F.lit(False))).groupBy("doc_id").agg(
        F.max("heavy").alias("heavy"))
    wanted = materialize(wanted, "wanted")
    again = texts.join(sent(wanted.select("doc_id")), "doc_id", "left_semi")
    full = materialize(map_arrow(again, _full(sim), "doc_id long, n long, tokens binary")
                       .join(sent(wanted), "doc_id"), "full-sets")
    combos = full.filter("heavy").agg(F.sum("n")).first()[0] or 0
    buckets = partitions_for(spark, int(combos), ENTRIES)
    links = group_arrow(map_arrow(full.filter("heavy"), _index(sim, buckets),
                                  "bucket int, sigs binary, ids binary"),
                        ["bucket"], _meet, "a long, b long")
    links = pairs.unionByName(links)

    # clusters of candidates, compared exactly in blocks
    clusters = components(links, "candidate-stars").select(
        F.col("node").alias("doc_id"), F.col("root").alias("comp"))
    size = clusters.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = clusters.join(size, "comp").withColumn(
        "part", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    entries = full.agg(F.sum("n")).first()[0] or 0  # of all candidates, heavy or not
    groups = partitions_for(spark, int(entries), ENTRIES)
    small = F.col("blocks") == 1
    members = members.select(
        "doc_id", "comp", "part",
        F.when(small, F.pmod(F.xxhash64("comp"), F.lit(groups))).otherwise(F.col("comp")).alias("g"),
        F.when(small, -1).otherwise(F.least("part", "other")).alias("g1"),
        F.when(small, -1).otherwise(F.greatest("part", "other")).alias("g2"))
    members = materialize(members, "cluster-members")
    verified = group_arrow(full.select("doc_id", "tokens").join(sent(members), "doc_id"),
                           ["g", "g1", "g2"], _verify(sim), "a long, b long")
    roots = components(verified, "verified-stars")

    # a class takes the smallest id of its component; classes hold equal sets
    classes = sets.groupBy("digest").agg(F.min("doc_id").alias("node"))
    classes = classes.join(roots, "node", "left").select(
        "digest", F.coalesce("root", "node").alias("root"))
    return sets.join(classes, "digest").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("root")).alias("component_id"))


def _full(sim: Similarity):
    def run(batches):
        for batch in bounded_batches(batches, 1, 4 << 20):
            sets = [shingle_set(t, sim.words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "n", "tokens"])

    return run


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))
