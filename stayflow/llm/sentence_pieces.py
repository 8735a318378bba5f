"""SentencePiece encoding and decoding by weighted finite-state transducers.

Three transducers are compiled from a ``.model`` file and composed with every input:

* the normaliser: white space becomes U+2581, with one more in front (identity otherwise);
* the pieces: a trie whose paths read a piece's characters and emit its id;
* byte fallback: a character that is no piece emits the ids of its UTF-8 bytes.

Composition gives a lattice of pieces over the input; the encoding is its shortest path in
the tropical semiring (sums along a path, minimum over paths). In a unigram model the weight
of an arc is the piece's negative log score. In a merge (BPE) model it is the weight of the
pair (last piece, piece): 0 if the merges turn the two pieces' text into just these two,
infinite otherwise. An encoding is the merges' result if and only if all its neighbours are
such pairs, so exactly one path has weight 0. As every prefix of the input has one result
too, one last piece per position is kept, and pair weights are worked out as they are met.

Neighbouring characters that stand together in no piece can never be merged: the lattice is
cut there, and the encodings of the parts are kept in a bounded table in each worker.

Defined results: null or empty text has no ids and decodes to the empty text; U+2581 in a
text is read as a space, as the library does; every input row gives one row; an empty table
gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import bounded_batches, id_text, map_arrow, table, tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Kept per worker before a table starts afresh; longer units and parts are never kept.
KEPT_UNITS, KEPT_PARTS, KEPT_PAIRS, KEPT_LENGTH = 200_000, 300_000, 300_000, 40

#: Values of the model file: piece types, model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, MERGES = 1, 2


def _fields(raw: bytes):
    """(number, value) of the fields of a protocol-buffers message."""
    at = 0

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = raw[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    while at < len(raw):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = raw[at:at + size], at + size
        yield key >> 3, value


class PieceModel(dict):
    """The compiled transducers; as a table: unit -> its encoding as 32-bit ids in bytes."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as f:
            raw = f.read()
        self.piece_of: list[bytes] = []
        self.score: dict[str, float] = {}
        self.ids: dict[str, bytes] = {}
        byte_ids: list[int] = []
        kind, self.prefix = UNIGRAM, True
        for number, value in _fields(raw):
            if number == 1:
                self._piece(dict(_fields(value)), byte_ids)
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2) or spec.get(4, 1) or not spec.get(5, 1):
                    raise ValueError("only identity normalisers that keep all spaces are compiled")
                self.prefix = bool(spec.get(3, 1))
        if kind not in (UNIGRAM, MERGES) or len(byte_ids) != 256:
            raise ValueError("a unigram or merge model with byte fallback is expected")
        self.merges = kind == MERGES
        self.byte_ids = byte_ids
        self.worst = max((-s for s in self.score.values()), default=0.0) + 10.0
        self.trie: dict = {}
        self.joined: set[str] = set()
        for piece in self.score:
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = piece
            self.joined.update(piece[i:i + 2] for i in range(len(piece) - 1))
        # no piece reads a space after anything else, or a line feed beside anything
        if any(p.strip(SPACE).count(SPACE) or p.rstrip(SPACE) != p and p.strip(SPACE)
               or "\n" in p and len(p) > 1 for p in self.score):
            raise ValueError("pieces that cross a space or a line feed are not supported")
        self.unit = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def _piece(self, fields: dict, byte_ids: list[int]) -> None:
        number, text, kind = len(self.piece_of), fields[1].decode(), fields.get(3, NORMAL)
        shown = text.replace(SPACE, " ").encode()
        if kind == BYTE:
            byte_ids.append(number)
            shown = bytes([int(text[1:-1], 16)])
        elif kind == NORMAL:
            self.ids[text] = array("I", [number]).tobytes()
            self.score[text] = memoryview(fields[2]).cast("f")[0] if 2 in fields else 0.0
        elif kind == USER:
            raise ValueError("user-defined pieces are not supported")
        else:
            shown = b""
        self.piece_of.append(shown)

    # -- weights

    def merged(self, text: str) -> list[str]:
        """``text`` after its best-scored neighbours (then the leftmost) have been merged as
        long as they make a piece."""
        part = list(text)
        while len(part) > 1:
            best, at = float("-inf"), -1
            for i in range(len(part) - 1):
                score = self.score.get(part[i] + part[i + 1])
                if score is not None and score > best:
                    best, at = score, i
            if at < 0:
                break
            part[at:at + 2] = [part[at] + part[at + 1]]
        return part

    def compatible(self, last: str, piece: str) -> bool:
        """The pair's weight is 0 (not infinite)."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        fits = self.merged(last + piece) == ([last, piece] if last else [piece])
        self.pairs[last, piece] = fits
        return fits

    # -- composition and shortest path

    def path(self, text: str) -> list[str]:
        """The pieces (and characters left to byte fallback) on the shortest path."""
        n, last = len(text), self._last_pieces(text)
        out, at = [], n
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _last_pieces(self, text: str) -> list[str | None]:
        """The last piece of the shortest path to each position of the lattice."""
        n, trie, pairs, merges = len(text), self.trie, self.pairs, self.merges
        last: list[str | None] = [None] * (n + 1)
        last[0] = ""
        cost = [0.0] * (n + 1)
        for start in range(n):
            before = last[start]
            if before is None:
                continue
            node, end = trie.get(text[start]), start + 1
            if node is None or "" not in node:  # no piece: byte fallback
                node = {"": text[start], **(node or {})}
            while True:
                piece = node.get("")
                if piece is not None:
                    if not merges:
                        weight = cost[start] + (-self.score[piece] if piece in self.score else self.worst)
                        if last[end] is None or weight < cost[end]:
                            cost[end], last[end] = weight, piece
                    elif last[end] is None:
                        fits = pairs.get((before, piece))
                        if fits is None:
                            fits = self.compatible(before, piece)
                        if fits:
                            last[end] = piece
                if end == n:
                    break
                node = node.get(text[end])
                if node is None:
                    break
                end += 1
        return last

    def part(self, text: str) -> bytes:
        """Encoding of a part inside which every two neighbours stand together in a piece."""
        found = self.parts.get(text)
        if found is None:
            found = self.older.get(text)
            if found is None:
                found = b"".join([self.ids.get(p) or self.fallback(p) for p in self.path(text)])
            if len(text) <= KEPT_LENGTH:
                if len(self.parts) >= KEPT_PARTS:
                    self.parts, self.older = {}, self.parts
                self.parts[text] = found
        return found

    def fallback(self, char: str) -> bytes:
        return array("I", [self.byte_ids[b] for b in char.encode("utf-8", "replace")]).tobytes()

    def __missing__(self, unit: str) -> bytes:
        cut = [0, *(i for i in range(1, len(unit)) if unit[i - 1:i + 1] not in self.joined), len(unit)]
        parts = [unit[a:b] for a, b in zip(cut, cut[1:])]
        seen = all(p in self.parts for p in parts)
        found = b"".join([self.part(p) for p in parts])
        if seen and len(unit) <= KEPT_LENGTH:
            self[unit] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, as little-endian 32-bit numbers."""
        if not text:
            return b""
        if len(self) >= KEPT_UNITS:
            self.clear()
        text = text.replace(" ", SPACE)
        return b"".join(map(self.__getitem__, self.unit.findall(SPACE + text if self.prefix else text)))

    def decode(self, ids: bytes) -> str:
        """The text of ``ids``: fallback bytes joined again, the first space taken off."""
        text = b"".join(map(self.piece_of.__getitem__, memoryview(ids).cast("I")))
        if self.prefix and text[:1] == b" ":
            text = text[1:]
        return text.decode("utf-8", "replace")


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (packed little-endian 32-bit numbers) of every row."""
    path = path or tokenizer_path(MODEL)

    def run(batches):
        for batch in bounded_batches(batches, 1):
            ids = [model(path).encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return map_arrow(id_text(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of rows with doc_id and ids; null ids decode to the empty text."""
    path = path or tokenizer_path(MODEL)

    def run(batches):
        for batch in bounded_batches(batches, 1):
            text = [model(path).decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())],
                                             ["doc_id", "text"])

    return map_arrow(encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")), run,
                     "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, ids_crc32, decoded_sha256, same (the decoded text is the
    input, U+2581 read as space) for every row; the ids stay inside the task."""
    path = path or tokenizer_path(MODEL)

    def run(batches):
        for batch in bounded_batches(batches, 1):
            own, rows = model(path), []
            for text in batch.column(1).to_pylist():
                ids = own.encode(text)
                back = own.decode(ids)
                rows.append((len(ids) // 4, zlib.crc32(ids), hashlib.sha256(back.encode()).hexdigest(),
                             back == text.replace(SPACE, " ")))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.cast(pc.binary_length(batch.column(1)), pa.int64()),
                 pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "ids_crc32", "decoded_sha256", "same"])

    return map_arrow(id_text(docs, id_col, text_col), run,
                     "doc_id long, n_bytes long, n_tokens long, ids_crc32 long, "
                     "decoded_sha256 string, same boolean")


def op1_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
