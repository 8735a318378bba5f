"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut into words by the vocabulary's own pre-tokenizer. The symbols of a word form
a linked list; a heap holds the adjacent pairs by merge rank, then place. The lowest pair
is popped and merged until none is left, so a word has (initial symbols - merges) tokens
and no token identifiers are ever made. White-space runs never join the word before them,
so counts are kept per (white space + word) unit in a bounded table in each worker.

Defined results: a null or empty text has 0 bytes and 0 tokens; every input row gives one
row (repeated rows included); an empty table gives an empty table. Other input columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from stayflow.llm.common import bounded_batches, id_text, map_arrow, table, tokenizer_path

MODEL = "byte_bpe_50k.json"
#: Units and words kept per worker before a table starts afresh; longer ones are never kept.
KEPT_UNITS, KEPT_WORDS, KEPT_LENGTH = 300_000, 600_000, 40

_UNIT = re.compile(r"\s*\S+|\s+")
#: Python's \s has these, the vocabulary's pre-tokenizer has not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: A unit of Latin letters and closing marks: its two words are plain without the pre-tokenizer.
_PLAIN = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]*)")


def merged_length(symbols: list[int] | bytes, ranks: dict[int, int], made: list[int]) -> int:
    """Symbols left when the lowest-ranked adjacent pair is merged until there is none.

    ``ranks`` has the rank of a pair at ``left << 32 | right``, ``made`` the symbol that the
    merge of a rank makes.
    """
    n = len(symbols)
    if n < 2:
        return n
    part = list(symbols)
    rank_of = ranks.get
    heap = []
    for i in range(n - 1):
        rank = rank_of(part[i] << 32 | part[i + 1])
        if rank is not None:
            heap.append(rank << 32 | i)
    if not heap:
        return n
    heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    merges = 0
    while heap:
        rank = heappop(heap)
        i = rank & 0xFFFFFFFF
        rank >>= 32
        j = after[i]
        # stale entries: the left symbol is gone (-1), or a merge changed one of the two
        if part[i] < 0 or j >= n or rank_of(part[i] << 32 | part[j]) != rank:
            continue
        merges += 1
        part[i] = left = made[rank]
        part[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = rank_of(left << 32 | part[k])
            if rank is not None:
                heappush(heap, rank << 32 | i)
        h = before[i]
        if h >= 0:
            rank = rank_of(part[h] << 32 | left)
            if rank is not None:
                heappush(heap, rank << 32 | h)
    return n - merges


def byte_letters() -> list[str]:
    """The visible letter that byte-level vocabularies write for each byte (the published
    rule: printable Latin-1 bytes stand for themselves, the others follow from U+0100)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class TokenCounter(dict):
    """unit -> tokens; a missing unit is cut into words, whose merged lengths are kept."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if spec["normalizer"] or model.get("ignore_merges") or model.get("unk_token"):
            raise ValueError("a byte-level BPE vocabulary without normaliser is expected")
        ids = model["vocab"]
        self.ranks, self.made = {}, []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks.setdefault(ids[a] << 32 | ids[b], rank)
            self.made.append(ids[a + b])
        letters = byte_letters()
        self.letter_id = {c: ids[c] for c in letters}
        self.byte_id = [ids[c] for c in letters]
        special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self.special = special and re.compile(
            "|".join(map(re.escape, sorted(special, key=len, reverse=True))))
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.words: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def word(self, word: str, symbols) -> int:
        """Tokens of a word not in ``self.words``; two generations of words are kept."""
        n = self.older.get(word)
        if n is None:
            n = merged_length(symbols(word), self.ranks, self.made)
        if len(word) <= KEPT_LENGTH:
            if len(self.words) >= KEPT_WORDS:
                self.words, self.older = {}, self.words
            self.words[word] = n
        return n

    def plain_symbols(self, word: str) -> list[int]:
        return [self.byte_id[b] for b in word.encode()]

    def letter_symbols(self, word: str) -> list[int]:
        return [self.letter_id[c] for c in word]

    def __missing__(self, unit: str) -> int:
        plain = _PLAIN.fullmatch(unit)
        if plain:
            word, end = plain.groups()
            total, seen = self.words.get(word), True
            if total is None:
                total, seen = self.word(word, self.plain_symbols), False
            if end:
                n = self.words.get(end)
                total += self.word(end, self.plain_symbols) if n is None else n
        else:
            total, seen = 0, True
            for word, _ in self.pieces(unit):
                word = "\0" + word  # pre-tokenized words are spelt in byte letters
                n = self.words.get(word)
                if n is None:
                    n = self.word(word, lambda w: self.letter_symbols(w[1:]))
                total += n
        if seen and len(unit) <= KEPT_LENGTH:
            self[unit] = total
        return total

    def count(self, text: str) -> int:
        found = 0
        parts = [text]
        if self.special:
            parts = self.special.split(text)
            found = len(parts) - 1
        for part in parts:
            if part:
                units = [part] if _SEPARATORS.search(part) else _UNIT.findall(part)
                found += sum(map(self.__getitem__, units))
        if len(self) >= KEPT_UNITS:
            self.clear()
        return found


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One counter for each vocabulary in a worker process, shared by its tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) for every row."""
    path = path or tokenizer_path(MODEL)

    def run(batches):
        count = counter(path).count
        for batch in bounded_batches(batches, 1):
            text = batch.column(1)
            tokens = pa.array([count(t) for t in text.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.cast(pc.binary_length(text), pa.int64()), tokens,
                 pc.greater(tokens, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_arrow(id_text(docs, id_col, text_col), run,
                     "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
