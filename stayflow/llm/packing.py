"""Best-two-fit packing of documents into fixed-length token sequences.

A document's tokens end with a separator; only documents longer than a sequence are cut, at
every multiple of its length. Pieces that fill a sequence are sequences of their own. The
others are dealt at random into groups of bounded size, each packed by itself: a bin is
filled greedily with the longest piece that still fits; then its smallest piece goes back if
two unpacked pieces fit the gap left without it more tightly. A group loses at most its last
bin, so the number of sequences does not depend noticeably on the number of groups.

Defined results: null or empty text is the separator alone (length 1); every input row is
packed (repeated rows too, spread over the groups like others); a very long text is tokenized
whole by one task and its pieces spread; an empty table gives an empty table; other columns are not read.
A null id is kept as null.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import (bounded_batches, free_name, group_arrow, id_text, map_arrow,
                                 materialize, table, tokenizer_path)
from stayflow.llm.token_counts import byte_letters

MODEL = "word_bpe_49k.json"
#: Units and words kept per worker before a table starts afresh; longer ones are never kept.
KEPT_UNITS, KEPT_WORDS, KEPT_LENGTH = 200_000, 350_000, 40
#: A unit of letters whose lower case is one letter in the same place, and closing marks: the
#: vocabulary's model then needs neither normaliser nor pre-tokenizer.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00de\u00e0-\u00f6\u00f8-\u00fe]+)([.,;:!?]*)")
#: Pieces in a packing group, on average.
GROUP = 20_000


class WordIds(dict):
    """unit (text between spaces or line feeds) -> ids, as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = byte_letters()
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        """The ids of one pre-tokenized word, from two generations of kept words."""
        ids = self.older.get(word)
        if ids is None:
            spelt = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
            ids = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        if len(word) <= KEPT_LENGTH:
            if len(self.words) >= KEPT_WORDS:
                self.words, self.older = {}, self.words
            self.words[word] = ids
        return ids

    def __missing__(self, unit: str) -> bytes:
        plain = _PLAIN.fullmatch(unit)
        if plain:
            word, end = plain.groups()
            word = word.lower()
            ids, seen = self.words.get(word), True
            if ids is None:
                ids, seen = self.word(word), False
            if end:
                ids += self.words.get(end) or self.word(end)
        else:
            found = self.whole.encode(unit, add_special_tokens=False).ids if unit else ()
            ids, seen = array("I", found).tobytes(), True
        if seen and len(unit) <= KEPT_LENGTH:
            self[unit] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """The vocabulary drops white space and no token spans it, so a text's ids are those
        of its units."""
        if len(self) >= KEPT_UNITS:
            self.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_WORDS: dict[str, WordIds] = {}


def token_pieces(docs: DataFrame, path: str | None = None, length: int = 2048,
                 separator: int = 0, with_ids: bool = False, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ``ids``: little-endian unsigned 32-bit
    bytes, if ``with_ids``) for each piece of every document."""
    path = path or tokenizer_path(MODEL)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    end, step = np.array([separator], dtype="<u4").tobytes(), 4 * length

    def run(batches):
        if path not in _WORDS:
            _WORDS[path] = WordIds(path)
        for batch in bounded_batches(batches, 1, 4 << 20):
            cols = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = _WORDS[path].ids(text) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    row = (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part)
                    for col, value in zip(cols, row):
                        col.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], names)

    return map_arrow(id_text(docs, id_col, text_col), run,
                     "doc_id long, piece int, start long, length long, ids_crc32 long"
                     + ", ids binary" * with_ids)


def best_two_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item. ``lengths`` are between 1 and ``size``."""
    order = np.argsort(lengths, kind="stable")
    ends = np.searchsorted(lengths[order], np.arange(size + 2))
    first = ends[:-1].tolist()      # items of length n: order[first[n]:top[n]]
    top = ends[1:].tolist()
    order = order.tolist()
    there = 0                       # bit n: an item of length n is unpacked
    for n in range(1, size + 1):
        if top[n] > first[n]:
            there |= 1 << n
    bins, offsets = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    number = 0
    while there:
        gap, held = size, []
        while gap:
            n = (there & ((2 << gap) - 1)).bit_length() - 1
            if n < 1:
                break
            held.append(n)
            gap -= n
            top[n] -= 1
            if top[n] == first[n]:
                there ^= 1 << n
        if gap and len(held) > 1 and there:
            small = held[-1]        # held is in falling order
            room, best = gap + small, (small, 0, 0)
            long = there & ((1 << room) - 1)
            while best[0] < room and long:
                a = long.bit_length() - 1
                if 2 * a <= best[0]:
                    break           # no pair of which a is the longer can be better
                other = there & ((2 << min(a, room - a)) - 1)
                if top[a] - first[a] < 2 and other >> a & 1:
                    other ^= 1 << a
                b = other.bit_length() - 1
                if b > 0 and a + b > best[0]:
                    best = (a + b, a, b)
                long ^= 1 << a
            if best[1]:
                held.pop()
                top[small] += 1     # its item is the next one of its length again
                there |= 1 << small
                for n in best[1:]:
                    held.append(n)
                    top[n] -= 1
                    if top[n] == first[n]:
                        there ^= 1 << n
        at = 0
        taken = dict.fromkeys(held, 0)
        for n in held:
            item = order[top[n] + taken[n]]
            taken[n] += 1
            bins[item], offsets[item] = number, at
            at += n
        number += 1
    return bins, offsets


def pack(pieces: DataFrame, length: int = 2048, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to ``pieces`` (columns doc_id, piece, length, ...)."""
    names = pieces.columns
    at = free_name(pieces, "at")
    pieces = materialize(pieces.withColumn(at, F.monotonically_increasing_id()), "pieces")
    short = F.col("length") < length
    groups = max(1, -(-pieces.filter(short).count() // group))
    full = pieces.filter(~short).withColumns({
        # full pieces count downwards from -1, groups upwards from 0
        "sequence_id": -1 - F.col(at), "offset": F.lit(0).cast("long")}).drop(at)

    def run(tbl: pa.Table) -> pa.Table:
        bins, offsets = best_two_fit(tbl.column("length").to_numpy(), length)
        base = tbl.column("part")[0].as_py() << 32
        return (tbl.select(names).append_column("sequence_id", pa.array(bins + base))
                .append_column("offset", pa.array(offsets)))

    # dealt by the written row number: a retried task deals alike, and repeated rows spread
    dealt = pieces.filter(short).withColumn("part", F.pmod(F.xxhash64(at), F.lit(groups)))
    packed = group_arrow(dealt, ["part"], run, full.schema)
    return packed.unionByName(full)


def best_fit_packing(docs: DataFrame, path: str | None = None, length: int = 2048,
                     id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) per piece."""
    return pack(token_pieces(docs, path, length, 0, with_ids, id_col, text_col), length)


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"))
