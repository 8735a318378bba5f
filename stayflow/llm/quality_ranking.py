"""Quality classifier by Bradley-Terry pairwise ranking.

A document's worth is ``weights . features(text)``, and of two documents the better one is
preferred with the probability ``sigmoid(worth difference)`` (Bradley-Terry). Rows labelled
good and rows labelled bad form preference pairs; the weights minimise the logistic loss on the
differences of the pairs' features, with a penalty, by accelerated gradient descent. Labels say
only which of two documents is better, so the place of the cut comes from the ranking itself: it
is the quantile, at the share of bad rows, of the worths of all labelled rows of the learning
folds. A score is a sigmoid of the worth that is 0.7 there.

Features (whole texts, no labels, language, source or id): shares of trigrams of character
shapes, shares of byte trigrams, both folded into a fixed number of columns, and measures of
repetition, case, symbols, lines and length, over the text and over its worst stretch.

At most ``2 * SAMPLE`` labelled rows, the first by a hash of their id, are learnt from (the
only bound); the quantile is over all labelled rows of the learning folds.

Defined results: null text counts as empty and is scored as such. A row without an id is scored,
never learnt from and not held out; every input row gives one row (repeated rows included); of
repeated ids in ``documents`` or ``labels`` the least text and the least label are learnt from.
Labels other than 0 and 1 are not learnt from. Without a good and a bad row to learn from every
score is 0.7. A text of any length is read whole, in blocks. An empty table gives an empty one.
Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import (bounded_batches, group_arrow, id_text, map_arrow, materialize, table)
from stayflow.llm.hashing import mix, word_hashes

#: Labelled rows of each class that are learnt from, at most.
SAMPLE = 4000
#: Folds by crc32 of the id, and the one that is never learnt from.
FOLDS, HELD_OUT = 4, 2
#: Pairs that every row of the larger class forms.
PAIRS = 4
#: Score at the cut.
CUT = 0.7

#: Columns of each kind of trigrams, bytes of a block, words of a stretch.
COLUMNS, BLOCK, STRETCH = 1024, 1 << 20, 50
#: Penalty, and steps of the descent.
PENALTY, STEPS = 1e-3, 400

#: Shape of a byte: letters of a case, digits, other than ASCII and control characters each
#: have one; space, line end and each mark stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[:32] = 1
_SHAPE[ord("\n")] = ord("\n")
_SHAPE[128:] = ord("a")
for _first, _last in ("09", "AZ", "az"):
    _SHAPE[ord(_first):ord(_last) + 1] = ord(_first)
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
for _first, _last in ("09", "AZ", "az"):
    _MARK[ord(_first):ord(_last) + 1] = False
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _trigrams(raw: np.ndarray) -> np.ndarray:
    """Counts of the three-byte windows of ``raw`` in COLUMNS columns, block by block."""
    counts = np.zeros(COLUMNS)
    for at in range(0, max(0, len(raw) - 2), BLOCK):
        x = raw[at:at + BLOCK + 2].astype(np.uint32)
        x = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
        x *= np.uint32(2654435761)  # multiplicative hashing, the upper bits
        counts += np.bincount(x >> np.uint32(22), minlength=COLUMNS)
    return counts


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def _repetition(words: np.ndarray) -> tuple[list[float], list[float]]:
    """Repetition among the words of a text, and in its most repetitive stretch."""
    n = len(words)
    if not n:
        return [0.0] * 4, [0.0] * 2
    pairs = mix(words[:-1]) + words[1:]
    twice = words[1:] == words[:-1]
    whole = [len(np.unique(words)) / n, _share(len(np.unique(pairs)), n - 1),
             _share(twice.sum(), n - 1), _share((words[2:] == words[:-2]).sum(), n - 2)]
    # stretches of STRETCH words: adjacent equal words, and words not seen in the one before
    cuts = np.arange(0, n, STRETCH)
    size = np.diff(np.append(cuts, n))
    same = np.add.reduceat(np.append(twice, False).astype(np.int64), cuts) / size
    block = np.repeat(np.arange(len(cuts)), size).astype(np.uint64)
    kinds = _kinds(block, words, len(cuts))
    return whole, [same.max(), 1 - (kinds / size).min()]


def _kinds(block: np.ndarray, words: np.ndarray, blocks: int) -> np.ndarray:
    """Distinct words of every block."""
    order = np.lexsort((words, block))
    b, w = block[order], words[order]
    new = np.append(True, (b[1:] != b[:-1]) | (w[1:] != w[:-1]))
    return np.bincount(b[new].astype(np.int64), minlength=blocks)


def features(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = len(raw)
    shapes, plain = _trigrams(_SHAPE[raw]), _trigrams(raw)
    words = word_hashes(text)
    marks, upper, letters = _MARK[raw], _UPPER[raw], _LETTER[raw]
    # the worst stretches of 256 bytes by marks and by upper case
    cuts = np.arange(0, n, 256)
    worst = [float((np.add.reduceat(x.astype(np.int64), cuts) / np.minimum(256, n - cuts)).max())
             if n else 0.0 for x in (marks, upper)]
    whole, stretch = _repetition(words)
    lines = int((raw == 10).sum()) + 1
    n_letters = int(letters.sum())
    return np.concatenate([
        np.sqrt(shapes / max(1.0, shapes.sum())), np.sqrt(plain / max(1.0, plain.sum())),
        whole, stretch, worst,
        [_share(marks.sum(), n), _share(upper.sum(), n_letters), _share(_DIGIT[raw].sum(), n),
         _share(n_letters, n), _share(n_letters, len(words)) / 10, np.log1p(n) / 10,
         np.log1p(len(words)) / 10, _share(lines, len(words))]]).astype(np.float32)


def preference_pairs(good: int, bad: int, each: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of good and bad rows that form a pair: every row of the larger class with
    ``each`` of the other, going round."""
    if not good or not bad:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    many, few = max(good, bad), min(good, bad)
    one = np.tile(np.arange(many), each)
    other = (one + np.repeat(np.arange(each), many) * (few // each + 1)) % few
    pair = np.unique(one * few + other)
    one, other = pair // few, pair % few
    return (one, other) if good >= bad else (other, one)


def learn(rows: np.ndarray, better: np.ndarray, worse: np.ndarray, penalty: float = PENALTY,
          steps: int = STEPS) -> np.ndarray:
    """Weights that minimise the mean logistic loss of ``rows[better] - rows[worse]``."""
    rows = rows.astype(np.float32)
    k, n = len(rows), len(better)
    if not n:
        return np.zeros(rows.shape[1])
    spread = rows.std(0)
    scale = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0).astype(np.float32)
    x = (rows - rows.mean(0)) * scale

    def back(weight: np.ndarray) -> np.ndarray:
        """Sum over pairs of weight * (better row - worse row)."""
        each = np.bincount(better, weight, k) - np.bincount(worse, weight, k)
        return x.T @ each.astype(np.float32)

    v = np.ones(x.shape[1], np.float32)  # largest eigenvalue of the pairs' second moments
    for _ in range(20):
        v /= np.linalg.norm(v) or 1.0
        along = x @ v
        v = back(along[better] - along[worse]) / n
    step = 1 / (0.25 * float(np.linalg.norm(v)) * 1.1 + penalty)
    w = ahead = np.zeros(x.shape[1], np.float32)
    for t in range(steps):
        worth = x @ ahead
        lost = 1 / (1 + np.exp(np.clip(worth[better] - worth[worse], -30, 30)))
        new = ahead + step * (back(lost) / n - penalty * ahead)
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return (w * scale).astype(np.float64)


def fold(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _learn_group(tbl: pa.Table) -> pa.Table:
    by_id = tbl.sort_by([("order", "ascending"), ("doc_id", "ascending")])
    good = np.array(by_id.column("good").to_pylist(), bool)
    rows = np.stack([features(t) for t in by_id.column("text").to_pylist()])
    at = [np.flatnonzero(good), np.flatnonzero(~good)]
    better, worse = preference_pairs(len(at[0]), len(at[1]))
    found = learn(rows, at[0][better], at[1][worse])
    return pa.table({"pairs": pa.array([len(better)], pa.int64()), "weights": pa.array([found.tolist()])})


def _worths(weights: np.ndarray):
    def run(batches):
        for batch in bounded_batches(batches, 1):
            found = [float(features(t) @ weights) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())],
                                             ["doc_id", "worth"])

    return run


def quality_ranking(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; ``labels`` has ids as
    doc_id and 0 or 1 in ``label_col``."""
    texts = id_text(docs, id_col, text_col)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).alias("label")).filter(
        F.col("label").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT)).groupBy("doc_id").agg(
        F.min("label").alias("label"))
    known = materialize(known.withColumn("order", F.xxhash64("doc_id")), "known-labels")
    count = known.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("label") == 0, 1)).alias("bad")).first()
    chosen = None
    for label in (0, 1):
        part = known.filter(F.col("label") == label).orderBy("order", "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.withColumn("good", F.col("label") == 1).select("doc_id", "order", "good")
    # at most 2 * sample ids: sent to the texts; of repeated ids the least text
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "order", "good").agg(
        F.min("text").alias("text"))
    found = group_arrow(rows.withColumn("all", F.lit(0)), ["all"], _learn_group,
                        "pairs long, weights array<double>").first()
    weights = np.array(found["weights"]) if found and found["pairs"] else None
    held = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    if weights is None:
        return texts.select("doc_id", held, F.lit(CUT).alias("score"), F.lit(1).alias("predicted"))
    worths = materialize(map_arrow(texts, _worths(weights), "doc_id long, worth double"), "worths")
    spread = worths.agg(F.percentile_approx("worth", [0.02, 0.98], 10_000)).first()[0]
    # the cut lies between the last bad and the first good place of the ranking
    share = [count["bad"] / count["n"], min(1.0, (count["bad"] + 1) / count["n"])]
    place = worths.join(known, "doc_id").agg(F.percentile_approx("worth", share, 10_000)).first()[0]
    cut = sum(place) / 2
    steep = 8.0 / max(spread[1] - spread[0], 1e-9)
    score = 1 / (1 + (1 / CUT - 1) * F.exp(-steep * (F.col("worth") - cut)))
    return worths.select("doc_id", held, score.alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))


def op13_quality_ranking(spark, sf_dir: str) -> DataFrame:
    return quality_ranking(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
