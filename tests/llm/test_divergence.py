"""The source divergence audit against its SQL and a plain count."""
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from stayflow.llm import source_divergence as sd

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def by_sql(rows, least, listed):
    documents = pa.table({  # noqa: F841 (read by DuckDB)
        "text": pa.array([r[0] for r in rows], pa.string()), "lang": pa.array([r[1] for r in rows], pa.string()),
        "source": pa.array([r[2] for r in rows], pa.string())})
    sql = sd.ORACLE.replace(">= 30)", f">= {least})").replace("rank <= 50", f"rank <= {listed}")
    return sorted(duckdb.sql(sql).fetchall())


def by_spark(spark, rows, least, listed, partitions=3):
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(partitions)
    for clash in ("n", "docs", "term", "bucket", "Value"):
        df = df.selectExpr("*", f"'x' AS {clash}")
    found = sd.source_divergence(df, least, listed)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["the", "The", "THE", "été", "Été", "İ", "x" * 63, "x" * 64, "x" * 65, "x" * 200, "x" * 200 + "y",
             "abcdefgh", "abcdefghi", "abcdefgh1ab", "中文", "a", "b", "zz", "don't", "e_f", " q", "😀"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 25))) for _ in range(150)]
    texts += [None, "", "...", "joined", "joined", "end"] * 3 + ["the " * 5000]
    return [(t, rng.choice(["en", "de", None, ""]), rng.choice(["s0"] * 5 + ["s1", "s2", None, ""])) for t in texts]


def test_equals_the_sql(spark, rows):
    for least, listed in ((2, 3), (10, 50)):
        want = by_sql(rows, least, listed)
        assert want and by_spark(spark, rows, least, listed) == want


def test_no_kept_terms_and_no_rows(spark, rows):
    found = by_spark(spark, rows, 10_000, 50)
    assert found == by_sql(rows, 10_000, 50)
    assert {(r[2], r[4]) for r in found} == {("pair", 0)}
    assert by_spark(spark, [], 1, 50) == []
    assert by_spark(spark, [("a b", "en", "s")], 1, 50) == []  # one source: its language's shares


def test_repeated_rows_count_as_often(spark):
    rows = [("a b", "en", "s0")] * 3 + [("b c c", "en", "s1")] * 2
    assert by_spark(spark, rows, 2, 50, partitions=1) == by_sql(rows, 2, 50)
    assert by_spark(spark, rows, 2, 50, partitions=4) == by_sql(rows, 2, 50)


def test_pointers_are_sorted_by_their_words():
    rng = random.Random(2)
    texts = ["".join(rng.choices("abB ", k=rng.choice([0, 3, 40, 400]))) + "c" * rng.choice([0, 7, 8, 9, 70, 90])
             for _ in range(60)]
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(r) for r in raw]))
    letters, start, length, doc = sd.word_pointers(np.frombuffer(b"".join(raw), np.uint8), offsets)
    words = [letters[s:s + n].tobytes() for s, n in zip(start, length)]
    assert Counter(zip(doc.tolist(), words)) == Counter(
        (i, w.lower()) for i, r in enumerate(raw) for w in r.split())
    order, heads = sd.sort_pointers(letters, start, length)
    ordered = [words[i] for i in order]
    assert ordered == sorted(words)
    assert heads.tolist() == [i == 0 or ordered[i - 1] != w for i, w in enumerate(ordered)]


def test_shares_are_exact_for_large_counts():
    for n, whole in ((10 ** 12 + 7, 9 * 10 ** 13 - 1), (0, 5), (3, 11), (9 * 10 ** 12, 9 * 10 ** 12 + 5)):
        got = sd._shares(np.array([n]), np.array([whole]))[0]
        assert got == 1 + 10 ** 9 * (n + 5) // whole


def test_shares_in_spark(spark):
    rows = [(10 ** 12 + 7, 9 * 10 ** 13 - 1, 7), (3, 11, 2)]
    df = spark.createDataFrame(rows, "n long, n_all long, n_terms long").select(sd._share("n", "n_all"))
    assert [r[0] for r in df.collect()] == [1 + 10 ** 9 * (n + 5) // (a + 5 * k) for n, a, k in rows]
