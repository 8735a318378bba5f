"""Cross-tokenizer alignment against the libraries and a plain comparison of byte ranges."""
import hashlib
import json
from collections import Counter

import pytest

from stayflow.llm import token_alignment as ta
from stayflow.llm.common import tokenizer_path
from stayflow.llm.token_counts import byte_letters
from tests.llm.test_tokens import EDGE, fuzz

MORE = ["a\rb ;\r x\r\ny", "x▁ y", "▁", " \t a", "a  b   \n\n  c\r\n", "same text", "same text", "<s> </s> <unk> <0x41>",
        "w" * 60 + " " + "w" * 60]


class Libraries:
    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer_path(ta.MODEL_A))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(ta.MODEL_B))
        byte = {c: i for i, c in enumerate(byte_letters())}
        with open(tokenizer_path(ta.MODEL_A), encoding="utf-8") as f:
            self.bytes = {i: bytes(byte[c] for c in t) for t, i in json.load(f)["model"]["vocab"].items()}

    def piece(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(self, text):
        """(id, start, end) of both sides, or None."""
        if not text:
            return None
        raw, sides = (" " + text).encode(), []
        for ids, spell in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.bytes.get),
                           (self.b.encode(text), self.piece)):
            at, side = 0, []
            for i in ids:
                side.append((i, at, at + len(spell(i))))
                at = side[-1][2]
            if b"".join(map(spell, ids)) != raw:
                return None
            sides.append(side)
        return sides


def expected(texts):
    lib, per, count = Libraries(), [], Counter()
    for text in texts:
        sides = lib.tokens(text)
        if sides is None:
            per.append(None)
            continue
        a, b = sides
        common = sorted({t[2] for t in a} & {t[2] for t in b})
        cut, low = [], 0
        for end in common:
            cut.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < end) for side in (a, b)))
            low = end
        links, first = [], 0
        for i, s, e in a:
            while b[first][2] <= s:
                first += 1
            at = first
            while at < len(b) and b[at][1] < e:
                links.append((i, b[at][0]))
                at += 1
        count.update(links)
        per.append((len(a), len(b), len(common), links, hashlib.sha256(";".join(cut).encode()).hexdigest()))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(0,) * 6 + ("",) if p is None else
            (*p[:3], len(p[3]), sum(count[x] == most[x[1]] for x in p[3]), sum(count[x] for x in p[3]), p[4])
            for p in per]


@pytest.fixture(scope="module")
def texts(sample):
    return EDGE + fuzz(300) + MORE + [t for _, t, _ in sample][:80]


def test_equals_the_libraries(docs_of, texts):
    want = expected(texts)
    assert sum(w[0] > 0 for w in want) > 0.8 * len(want)
    found = ta.token_alignment(docs_of(list(enumerate(texts)), partitions=5))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == want[i], repr(text)[:200]


def test_many_small_blocks_and_emptied_tables(texts, monkeypatch):
    """The map's rows do not depend on blocks, nor on when a worker's units are forgotten."""
    import numpy as np
    import pyarrow as pa

    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()),
                             "text": pa.array([t or "" for t in texts])})

    def pairs(block, slice_, kept):
        for name, value in (("BLOCK", block), ("SLICE", slice_), ("KEPT_UNITS", kept)):
            monkeypatch.setattr(ta, name, value)
        monkeypatch.setattr(ta, "_ALIGNERS", {})
        monkeypatch.setattr(ta.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda s: 0})()))
        count, digests = Counter(), []
        for out in ta._blocks(tokenizer_path(ta.MODEL_A), tokenizer_path(ta.MODEL_B), 7)([batch]):
            for row in out.to_pylist():
                if row["bucket"] < 0:
                    digests.append(row["digests"])
                else:
                    count.update(dict(zip(np.frombuffer(row["pairs"], np.int64).tolist(),
                                          np.frombuffer(row["counts"], np.int64).tolist())))
        return count, b"".join(digests)

    assert pairs(2000, 500, 50) == pairs(1 << 24, 1 << 21, 300_000)


def test_no_rows_null_ids_and_repeats(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ta.token_alignment(empty).count() == 0
    rows = [(None, "one two"), (7, "one two"), (7, "one two"), (-2 ** 63, None)]
    got = ta.token_alignment(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = dict(zip(range(4), expected([t for _, t in rows])))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((d, *want[i])) for i, (d, _) in enumerate(rows))


def test_groups_and_links():
    assert ta.groups([1, 4, 6], [2, 4, 6]) == [(0, 2, 0, 2), (2, 3, 2, 3)]
    assert ta.links([1, 4, 6], [2, 4, 6], (0, 2, 0, 2)) == [(0, 0), (1, 0), (1, 1)]
    assert ta.groups([], []) == []
