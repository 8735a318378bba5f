"""Token counts, SentencePiece and packing against the libraries themselves."""
import random
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.llm import packing, sentence_pieces, token_counts
from stayflow.llm.common import tokenizer_path

EDGE = [None, "", " ", "\n\n \t", "a\x1cb\x1fc  d", "<|endoftext|>", "x<|endoftext|> <|endoftext|>y",
        "é́  　z", "▁ ▁▁x", "1234567 ٠²Ⅰ", "a" * 3000, "ab " * 3000, " " * 500,
        "İΣσς straße ﬁ 中文字 😀😀", "don't we'll I'M", "\x00\x7f"]


def fuzz(n, seed=1):
    rng = random.Random(seed)
    letters = [chr(i) for i in [*range(1, 128), 0x85, 0xa0, 0x1680, 0x2028, 0x200b, 0x3000, 0x2581, 0xe9,
                                0x301, 0x4e2d, 0x1F600, 0x660, 0x130, 0x3a3, 0x10400]]
    letters += ["<|endoftext|>", "<|startoftext|>", " ", "  ", "\n", "'s", "the", "ing"] * 3
    return ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(sample):
    return EDGE + fuzz(400) + [t for _, t, _ in sample]


def table(docs_of, texts):
    return docs_of(list(enumerate(texts)))


def test_counts_equal_the_library(docs_of, texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path(token_counts.MODEL))
    found = {r.doc_id: r for r in token_counts.token_counts(table(docs_of, texts)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        n = len(own.encode(text or "", add_special_tokens=False).ids)
        assert (found[i].n_tokens, found[i].n_bytes, found[i].over_limit) == (
            n, len((text or "").encode()), n > 1024), repr(text)


def test_merging_is_lowest_rank_first():
    # (b c) merges before (a b); of equal pairs the leftmost
    ranks, made = {1 << 32 | 2: 1, 2 << 32 | 3: 0, 1 << 32 | 1: 2, 5 << 32 | 5: 3}, [9, 8, 5, 6]
    assert token_counts.merged_length([1, 2, 3], ranks, made) == 2
    assert token_counts.merged_length([1] * 5, ranks, made) == 2
    assert token_counts.merged_length([], ranks, made) == 0


def test_pieces_equal_the_library_and_come_back(docs_of, texts):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(sentence_pieces.MODEL))
    docs = table(docs_of, texts)
    encoded = sentence_pieces.encode(docs)
    found = {r.doc_id: r for r in encoded.collect()}
    back = {r.doc_id: r.text for r in sentence_pieces.decode(encoded).collect()}
    same = {r.doc_id: r for r in sentence_pieces.round_trip(docs).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        assert bytes(found[i].ids) == array("I", own.encode(text)).tobytes(), repr(text)
        assert back[i] == text.replace("▁", " ")
        assert same[i].same and same[i].ids_crc32 == zlib.crc32(bytes(found[i].ids))


def test_spaces_and_pieces_in_a_row():
    import sentencepiece

    path = tokenizer_path(sentence_pieces.MODEL)
    own, lib = sentence_pieces.PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(2)
    pieces = [lib.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    texts = ["x" + " " * k + "y" for k in range(40)]
    texts += ["".join(rng.choices(pieces, k=rng.randint(1, 4))) for _ in range(3000)]
    for text in texts:
        assert own.encode(text) == array("I", lib.encode(text)).tobytes(), repr(text)


def test_unigram_shortest_path_is_the_least_of_all():
    own = sentence_pieces.PieceModel(tokenizer_path(sentence_pieces.MODEL))
    own.merges, own.score = False, {"a": -1.0, "b": -2.0, "ab": -2.5, "ba": -1.2, "aba": -9.0}
    own.trie, own.worst = {}, 10.0
    for piece in own.score:
        node = own.trie
        for c in piece:
            node = node.setdefault(c, {})
        node[""] = piece

    def every(text):
        if not text:
            yield 0.0, []
        for k in range(1, len(text) + 1):
            head = text[:k]
            if head in own.score or k == 1 and head not in own.score:
                for cost, rest in every(text[k:]):
                    yield cost - own.score.get(head, -own.worst), [head, *rest]

    for text in ("ab", "aba", "abab", "abzba", "bbaab"):
        assert sum(-own.score.get(p, -own.worst) for p in own.path(text)) == pytest.approx(
            min(every(text))[0])


def test_packing_places_every_token_once(docs_of, texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path(packing.MODEL))
    texts = texts + ["word " * 5000, "two words " * 1024]
    rows = packing.best_fit_packing(table(docs_of, texts), with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert len(by_doc) == len(texts)
    for i, text in enumerate(texts):
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4").tolist() == ids, repr(text)
        assert [p.start for p in parts] == list(range(0, len(ids), 2048))
        assert all(p.length == 2048 for p in parts[:-1])
        assert all(p.ids_crc32 == zlib.crc32(bytes(p.ids)) for p in parts)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048


def test_best_two_fit_is_nearly_full_and_whole():
    rng = np.random.default_rng(4)
    for lengths in (rng.integers(1, 2049, 5000), np.minimum(2048, rng.lognormal(6, 1, 5000)).astype(int) + 0,
                    np.full(100, 700), np.array([1]), np.array([2048, 1]), np.array([], int)):
        lengths = np.maximum(1, lengths)
        bins, offsets = packing.best_two_fit(lengths, 2048)
        assert len(bins) == len(lengths) and (np.bincount(bins, lengths) <= 2048).all() if len(bins) else True
    lengths = np.maximum(1, np.minimum(2048, rng.lognormal(6, 1, 20000)).astype(int))
    bins, _ = packing.best_two_fit(lengths, 2048)
    assert bins.max() + 1 <= 1.01 * lengths.sum() / 2048 + 1


def test_two_documents_replace_the_smallest():
    # greedy takes 6 and 3 (gap 1); 2 + 2 fill the gap left by 3 entirely
    bins, _ = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 0]


def test_empty_table(docs_of):
    docs = docs_of([(1, "x")]).filter("doc_id > 1")
    assert token_counts.token_counts(docs).count() == 0
    assert sentence_pieces.round_trip(docs).count() == 0
    assert packing.best_fit_packing(docs).count() == 0


def test_repeated_rows_and_null_ids(docs_of):
    docs = docs_of([(1, "a b"), (1, "a b"), (None, "c")])
    assert token_counts.token_counts(docs).count() == 3
    packed = packing.best_fit_packing(docs)
    assert packed.count() == 3 and packed.filter(F.col("doc_id").isNull()).count() == 1


def test_repeated_rows_spread_over_packing_groups(spark):
    pieces = spark.range(4000).select(
        F.lit(1).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.lit(700).cast("long").alias("length"), F.lit(9).cast("long").alias("ids_crc32"), F.lit("x").alias("AT"))
    packed = packing.pack(pieces, group=500)
    assert packed.columns == [*pieces.columns, "sequence_id", "offset"]
    sizes = packed.groupBy(F.shiftright("sequence_id", 32).alias("g")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 700
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
