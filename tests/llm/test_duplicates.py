"""Exact dedup and the Jaccard join against brute force."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from stayflow.llm import exact_dedup, jaccard_join
from stayflow.llm.components import components
from stayflow.llm.jaccard_join import Similarity, jaccard_classes

SPACE = " \t\n\x0b\x0c\r"


@pytest.mark.parametrize("fan", [2, 8])
def test_exact_dedup(docs_of, fan):
    rng = random.Random(7)
    texts = ["a b", "ab", "a\tb\n", "AB", None, "", "  ", "é", "é", "a b", "x" * 5000]
    rows = [(i, t if rng.random() < .7 else (t or "") + " ") for i, t in enumerate(texts * 6)]
    found = {r.doc_id: r for r in exact_dedup.exact_dedup(docs_of(rows, 7), fan=fan).collect()}
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(f"[{SPACE}]", "", t or ""), []).append((-len(t or ""), i))
    assert len(found) == len(rows)
    for norm, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            r = found[i]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (
                keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest())


def test_exact_dedup_of_repeated_rows_and_null_ids(docs_of):
    rows = exact_dedup.exact_dedup(docs_of([(5, "q"), (5, "q"), (None, "q"), (None, "z")])).collect()
    assert sorted((str(r.keep_id), r.group_size, r.kept) for r in rows) == [
        ("5", 3, False), ("5", 3, False), ("5", 3, True), ("None", 1, True)]
    assert exact_dedup.exact_dedup(docs_of([(1, "x")]).limit(0)).count() == 0


def shingles(text, k):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [w for w in re.split(f"[{SPACE}]+", lower) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, sim):
    sets = {i: shingles(t, sim.words) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    inverse = {}
    for i, s in sets.items():
        for x in s:
            inverse.setdefault(x, []).append(i)
    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in inverse[x] if j < i).items():
            if sim.of * both >= sim.part * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def family(rng, words, n, copies, edits):
    base = [rng.choice(words) for _ in range(n)]
    for _ in range(copies):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(n)] = rng.choice(words)
        yield " ".join(copy)


@pytest.mark.parametrize("sim,block,rare,extend", [
    (Similarity(), 512, 8, 8), (Similarity(), 16, 2, 2), (Similarity(5, 80, 100), 512, 8, 8),
    (Similarity(2, 60, 100), 32, 2, 3)])
def test_jaccard_components(docs_of, monkeypatch, sim, block, rare, extend):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(block + sim.words)
    few, many = [f"w{i}" for i in range(60)], [f"x{i}" for i in range(5000)]
    texts = ["", None, " \t", "one", "One", "one two", "ONE  TWO\n", "é É", "a b c"]
    for _ in range(16):
        texts += family(rng, few if rng.random() < .3 else many, rng.choice([3, 6, 10, 12, 20, 25, 40, 60, 300]),
                        rng.choice([1, 2, 5, 40]), rng.choice([0, 1, 2, 4, 8]))
    passage = " ".join(rng.choice(many) for _ in range(60))
    texts += [" ".join(rng.choice(many) for _ in range(rng.randint(1, 80))) + " " + passage for _ in range(60)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = {r.doc_id: (r.n_shingles, r.component_id)
             for r in jaccard_classes(docs_of(rows, 5), sim, rare=rare, extend=extend).collect()}
    assert found == brute(rows, sim)


def test_jaccard_edges(docs_of):
    text = " ".join(f"w{i}" for i in range(40))
    rows = jaccard_classes(docs_of([(3, text), (3, text), (None, text), (None, "lone words here"), (4, "")])).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == [
        ("3", 38, "3"), ("3", 38, "3"), ("4", 0, "4"), ("None", 1, "None"), ("None", 38, "3")]
    assert jaccard_classes(docs_of([(1, "x")]).limit(0)).count() == 0


def test_run_length_bound_holds_for_random_sets():
    rng = random.Random(1)
    for sim in (Similarity(), Similarity(5, 80, 100)):
        for _ in range(300):
            n = rng.randint(sim.smallest, 200)
            x = sorted(rng.sample(range(10 ** 6), n))
            y = set(x)
            for _ in range(rng.randint(1, n // 8 + 1)):
                y.discard(rng.choice(x)) if rng.random() < .5 else y.add(rng.randrange(10 ** 6))
            y = sorted(y)
            both = set(x) & set(y)
            if set(x) == set(y) or not sim.linked(len(both), len(x), len(y)):
                continue
            best = run = 0
            for token in sorted(set(x) | set(y)):
                run = run + 1 if token in both else 0
                best = max(best, run)
            assert best >= jaccard_join.run_length(sim, min(len(x), len(y)))


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [
        (rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(80)] + [(7, 7), (1, 2), (2, 1)]
    root = {i: i for e in edges for i in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found.get(i, i) == r for i, r in root.items())


def test_exact_dedup_of_extreme_ids(docs_of):
    low, high = -2 ** 63, 2 ** 63 - 1
    rows = exact_dedup.exact_dedup(docs_of([(high, "q"), (low, "q"), (0, "z"), (low, "z ")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in rows) == [
        (low, low, True), (low, low, True), (0, low, False), (high, low, False)]


def test_local_links_are_spread_and_none_is_lost():
    rng = np.random.default_rng(5)
    sim = Similarity(words=1, part=80, of=100)
    family = [np.sort(rng.choice(np.arange(1, 10 ** 6, dtype=np.uint64), 40, replace=False)) for _ in range(60)]
    docs = [(10 * f + c, np.sort(np.r_[tokens[c:], np.arange(c, dtype=np.uint64) + np.uint64(10 ** 7 + 100 * f)]))
            for f, tokens in enumerate(family) for c in range(3)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in docs]), pa.array([len(t) for _, t in docs]),
         pa.array([t.astype(np.uint64).tobytes() for _, t in docs])], ["doc_id", "n", "tokens"])
    tbl = pa.Table.from_batches(list(jaccard_join._index(sim, 16)(iter([batch]))))
    assert len({b for b in tbl.column("bucket").to_pylist() if b < 0}) > 4
    links = set()
    for b in set(tbl.column("bucket").to_pylist()):
        met = jaccard_join._meet(tbl.filter(pa.compute.equal(tbl.column("bucket"), b)))
        links |= set(zip(met.column("a").to_pylist(), met.column("b").to_pylist()))
    assert all(a // 10 == b // 10 for a, b in links)
    assert all(len({x for link in links if link[0] // 10 == f for x in link}) == 3 for f in range(60))
