"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Both tokenizers read the same bytes. A dictionary for each takes the byte offset where a token
ends to the token's number; the offsets in both dictionaries (an intersection of hash sets),
sorted, cut the two id lists into groups, and the links of a group are its pairs of tokens
whose bytes overlap. Neither tokenizer joins a character to white space after it, so a text
falls into units (white space, then other characters) that are aligned on their own, once for
every unit that a worker has not seen lately; whatever breaks that rule (a white-space character
that some piece holds after another character, separators that the two sides class otherwise)
makes its whole text one unit.

How often a pair of ids is linked in the corpus decides a text's ``n_best`` and ``count_sum``.
Texts are taken in blocks. A block asks once for each of its distinct pairs, in buckets by the
pair's hash; a bucket adds up the counts of all blocks, Spark finds the highest count of every
second id, and a bucket then answers its blocks. A block's texts, kept as numbers of units, are
never encoded again. Block rows are written before they are used, so numbers made in a task
stay as they are when an executor is lost.

Defined results: null and empty texts, and texts whose pieces do not spell them (a literal
U+2581), have no tokens: zeros, and '' for the groups. Every input row gives one row (repeated
rows included, and counted as often). A text of any length is aligned whole; one longer than a
block is a block. Rows without an id keep a null one. Of equal counts all are the highest. An
empty table gives an empty table. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import (bounded_batches, group_arrow, id_text, map_arrow, materialize,
                                 partitions_for, ship, table, tokenizer_path)
from stayflow.llm.hashing import mix, packed, unpacked
from stayflow.llm.token_counts import byte_letters

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Bytes of text in a block, and how many of them are units at a time.
BLOCK, SLICE = 16 << 20, 2 << 20
#: Units kept by a worker, the length of a kept unit, and bytes of all their groups.
KEPT_UNITS, KEPT_LENGTH, KEPT_BYTES = 300_000, 48, 64 << 20
#: Bytes of text behind a bucket of pairs.
BUCKET_BYTES = 48 << 20

_UNIT = re.compile(r"\s*\S+|\s+")
#: White space for Python alone.
_SEPARATORS = "\x1c-\x1f"
#: Appended to a model: its normaliser adds no space in front (a unit has its own).
_NO_PREFIX = b"\x1a\x02\x18\x00"

BLOCKS = ["block", "bucket", "pairs", "counts", "ids", "named", "sizes", "digests",
          "low", "high", "unit_links", "link_pairs"]
BLOCKS_SCHEMA = "block long, bucket int, " + ", ".join(f"{c} binary" for c in BLOCKS[2:])


def groups(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int, int, int]]:
    """(first and last + 1 of the a tokens, the same of the b tokens) of every group."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    found, a, b = [], 0, 0
    for end in sorted(at_a.keys() & at_b.keys()):
        found.append((a, at_a[end], b, at_b[end]))
        a, b = at_a[end], at_b[end]
    return found


def links(ends_a: list[int], ends_b: list[int], group: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """Pairs of token numbers of a group whose byte ranges overlap, in their order."""
    a, last_a, b, last_b = group
    found = [(a, b)]
    while a + 1 < last_a or b + 1 < last_b:
        # inside a group no two tokens end together: the one that ends first is left
        if ends_a[a] < ends_b[b]:
            a += 1
        else:
            b += 1
        found.append((a, b))
    return found


class Aligner:
    """Units by number, with their tokens and links. Unit 0 stands for one that the pieces do
    not spell."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"]:
            raise ValueError("a byte-level vocabulary without normaliser is expected")
        byte = {c: i for i, c in enumerate(byte_letters())}
        self.bytes_a = {i: bytes(byte[c] for c in entry) for entry, i in spec["model"]["vocab"].items()}
        with open(path_b, "rb") as f:
            self.b = sentencepiece.SentencePieceProcessor(model_proto=f.read() + _NO_PREFIX)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_b = len(pieces)
        # white space that a piece holds after another character joins units
        joining = set("".join(re.findall(r"[^\s▁](\s)", "\n".join(
            p.replace("\n", "") for p in pieces)))) - {"\n"}
        if any(re.search("[^\\s▁](▁|\n)", p) for p in pieces):
            raise ValueError("pieces that go on over white space are not supported")
        self.whole = re.compile(f"[{_SEPARATORS}{re.escape(''.join(sorted(joining)))}]")
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.text = [""]
        self.sizes = array("q", [0, 0, 0])  # a tokens, b tokens and groups of every unit
        self.pairs = array("q")
        self.ends = array("q", [0])  # of a unit's links in self.pairs
        self.bytes = 0

    def full(self) -> bool:
        return len(self.text) > KEPT_UNITS or self.bytes > KEPT_BYTES

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        text = " " + text
        return [text] if self.whole.search(text) else _UNIT.findall(text)

    def add(self, units: list[str]) -> list[int]:
        """Aligns units; their numbers."""
        found = []
        size_b, bytes_a, bytes_b = self.size_b, self.bytes_a, self.bytes_b
        ids_a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        ids_b = self.b.encode(units, num_threads=1)
        for unit, a, b in zip(units, ids_a, ids_b):
            spelt_a, spelt_b = [bytes_a[i] for i in a], [bytes_b[i] for i in b]
            raw = unit.encode()
            if b"".join(spelt_a) != raw or b"".join(spelt_b) != raw:
                found.append(0)
                continue
            ends_a, ends_b = list(accumulate(map(len, spelt_a))), list(accumulate(map(len, spelt_b)))
            parts = groups(ends_a, ends_b)
            shown, linked = [], []
            for group in parts:
                i, k, j, m = group
                if k - i == m - j == 1:
                    linked.append(a[i] * size_b + b[j])
                    shown.append(f"{a[i]}|{b[j]}")
                else:
                    linked += [a[x] * size_b + b[y] for x, y in links(ends_a, ends_b, group)]
                    shown.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            found.append(len(self.text))
            self.text.append(";".join(shown))
            self.bytes += len(self.text[-1])
            self.sizes.extend((len(a), len(b), len(parts)))
            self.pairs.extend(linked)
            self.ends.append(len(self.pairs))
        return found

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The numbers of every text's units."""
        of = [self.units(t) for t in texts]
        known = self.number
        new, long = set(), []
        for units in of:
            for unit in units:
                if len(unit) > KEPT_LENGTH:
                    long.append(unit)
                elif unit not in known:
                    new.add(unit)
        new = list(new)
        known.update(zip(new, self.add(new)))
        if not long:
            return [[known[u] for u in units] for units in of]
        longs = iter(self.add(long))
        return [[known[u] if len(u) <= KEPT_LENGTH else next(longs) for u in units] for units in of]


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner for each pair of vocabularies in a worker process, shared by its tasks."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every span, one span after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes (0 for an empty run), in whole numbers."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def block_rows(own: Aligner, block: int, ids: list, digests: list[bytes], texts: list[np.ndarray],
               buckets: int) -> pa.RecordBatch:
    """A row with the block's texts, and one for every bucket that it asks about pairs."""
    count = np.array([len(t) for t in texts], np.int64)
    unit = np.concatenate(texts) if texts else np.zeros(0, np.int64)
    sizes = np.frombuffer(own.sizes, np.int64).reshape(-1, 3)
    ends = np.frombuffer(own.ends, np.int64)
    # units by how often they occur, so that most numbers are small
    kinds, at, n = np.unique(unit, return_inverse=True, return_counts=True)
    by = np.argsort(-n, kind="stable")
    rank = np.empty(len(kinds), np.int64)
    rank[by] = np.arange(len(kinds))
    local, kinds, n = rank[at], kinds[by], n[by]
    starts = ends[kinds - 1]  # unit 0 has no links and is in no text that comes here
    unit_links = ends[kinds] - starts
    linked = np.frombuffer(own.pairs, np.int64)[_spans(starts, unit_links)] if len(kinds) else unit
    pairs, link = np.unique(linked, return_inverse=True)
    counts = np.bincount(link, np.repeat(n, unit_links), len(pairs)).astype(np.int64)
    # pairs numbered by bucket: the answers, bucket after bucket, are in that order
    bucket = (mix(pairs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(pairs), np.uint32)
    place[order] = np.arange(len(pairs), dtype=np.uint32)
    totals = [_sums(sizes[unit, i], count) for i in range(3)]
    totals += [_sums(unit_links[local], count), count]
    rows = [[block, -1, None, None, np.array([i or 0 for i in ids], np.int64).tobytes(),
             np.array([i is not None for i in ids], bool).tobytes(), np.stack(totals).tobytes(),
             b"".join(digests), (local & 0xFFFF).astype(np.uint16).tobytes(),
             (local >> 16).astype(np.uint16).tobytes(), unit_links.astype(np.uint32).tobytes(),
             place[link].tobytes()]]
    for b, p, c in packed(bucket, buckets, [pairs, counts]):
        rows.append([block, b, p, c] + [None] * (len(BLOCKS) - 4))
    types = [pa.int64(), pa.int32()] + [pa.binary()] * (len(BLOCKS) - 2)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], BLOCKS)


def _blocks(path_a: str, path_b: str, buckets: int):
    def run(batches):
        own = aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        ids, digests, texts, size = [], [], [], 0

        def out():
            nonlocal block, size
            found = block_rows(own, block, ids, digests, texts, buckets)
            ids.clear(), digests.clear(), texts.clear()
            block, size = block + 1, 0
            if own.full():
                own.clear()
            return found

        for batch in bounded_batches(batches, 1, SLICE):
            if size and size + batch.column(1).nbytes > BLOCK:
                yield out()
            size += batch.column(1).nbytes
            for numbers in own.numbers(batch.column(1).to_pylist()):
                if 0 in numbers:
                    numbers = []
                digest = hashlib.sha256()
                for at in range(0, len(numbers), 100_000):
                    digest.update((";" if at else "").encode())
                    digest.update(";".join([own.text[u] for u in numbers[at:at + 100_000]]).encode())
                digests.append(digest.digest())
                texts.append(np.array(numbers, np.int64))
            ids.extend(batch.column(0).to_pylist())
        if ids:
            yield out()

    return run


def _totals(size_b: int):
    def run(tbl: pa.Table) -> pa.Table:
        pairs, counts = unpacked(tbl, "pairs", np.int64), unpacked(tbl, "counts", np.int64)
        order = np.argsort(pairs, kind="stable")
        pairs = pairs[order]
        heads = np.flatnonzero(np.diff(pairs, prepend=-1))
        n = np.add.reduceat(counts[order], heads) if len(heads) else counts
        return pa.table({"bucket": pa.array(np.full(len(heads), tbl.column("bucket")[0].as_py(), np.int32)),
                         "pair": pa.array(pairs[heads]), "b": pa.array((pairs[heads] % size_b).astype(np.int32)),
                         "n": pa.array(n)})

    return run


def _answers(asked: pa.Table, known: pa.Table) -> pa.Table:
    """For every block that asks a bucket: the counts of its pairs, and whether they are the
    highest of their second id."""
    pairs, n = known.column("pair").to_numpy(), known.column("n").to_numpy()
    best = np.array(known.column("best").to_pylist(), bool)
    order = np.argsort(pairs)
    pairs, n, best = pairs[order], n[order], best[order]
    rows = []
    for mine in asked.column("pairs").to_pylist():
        at = np.searchsorted(pairs, np.frombuffer(mine, np.int64))
        rows.append((n[at].tobytes(), best[at].tobytes()))
    return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"),
                     "n": pa.array([r[0] for r in rows], pa.binary()),
                     "best": pa.array([r[1] for r in rows], pa.binary())})


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


def _results(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    answers = answers.sort_by("bucket")
    n, best = unpacked(answers, "n", np.int64), unpacked(answers, "best", bool)

    def column(name: str, kind) -> np.ndarray:
        return np.frombuffer(blocks.column(name)[0].as_py(), kind)

    ids = column("ids", np.int64)
    totals = column("sizes", np.int64).reshape(5, len(ids))
    units = column("low", np.uint16).astype(np.int64) | column("high", np.uint16).astype(np.int64) << 16
    unit_links = column("unit_links", np.uint32).astype(np.int64)
    link = column("link_pairs", np.uint32)
    sums = [_sums(_sums(x[link], unit_links)[units], totals[4]) for x in (best, n)]
    digests = column("digests", np.dtype("S32")).tobytes().hex()
    shown = [digests[64 * i:64 * i + 64] if k else "" for i, k in enumerate(totals[4].tolist())]
    return pa.table([pa.array(ids, mask=~column("named", bool)), *(pa.array(t) for t in totals[:4]),
                     *(pa.array(s) for s in sums), pa.array(shown, pa.string())],
                    names=[c.split()[0] for c in RESULT.split(", ")])


def token_alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row: the
    alignment of a byte-level vocabulary (a) and a piece vocabulary (b)."""
    path_a, path_b = path_a or tokenizer_path(MODEL_A), path_b or tokenizer_path(MODEL_B)
    spark = docs.sparkSession
    texts = id_text(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = partitions_for(spark, size, BUCKET_BYTES)
    found = materialize(map_arrow(texts, _blocks(path_a, path_b, buckets), BLOCKS_SCHEMA), "token-blocks")
    asked = found.filter("bucket >= 0").select("bucket", "block", "pairs", "counts")

    import sentencepiece
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    totals = materialize(group_arrow(asked, ["bucket"], _totals(size_b), "bucket int, pair long, b int, n long"),
                         "token-pairs")
    # one row for each id of the second vocabulary, at most
    highest = totals.groupBy("b").agg(F.max("n").alias("most"))
    known = totals.join(F.broadcast(highest), "b").select(
        "bucket", "pair", "n", (F.col("n") == F.col("most")).alias("best"))
    ship(spark)
    answers = asked.drop("counts").groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(
        _answers, "block long, bucket int, n binary, best binary")
    return found.filter("bucket < 0").drop("bucket", "pairs", "counts").groupBy("block").cogroup(
        answers.groupBy("block")).applyInArrow(_results, RESULT)


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    return token_alignment(table(spark, sf_dir, "documents"))
