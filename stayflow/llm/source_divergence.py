"""Source divergence audit by a pointer sort of word starts.

A task takes its texts as Arrow buffers, marks where words start and sorts those pointers, a
slice of the buffer at a time, by the words' bytes: a multikey quicksort whose characters are
eight bytes wide. numpy's quicksort orders the pointers by the current eight bytes; runs of
equal ones, if their words go on, are ordered by the next eight, and so on. Words of one run
are equal, so a run's documents and sources, counted in place, are the term's document
frequency and source counts in that slice. Slices of a task are added up before the shuffle.

Spark then adds up the counts by language, term and source, keeps the terms in enough
documents of their language, and compares the sources: every two sources of a language over
all kept terms, and each source with its whole language term by term.

Defined results: null text, language and source count as ''. A row is a document: repeated
rows count as often as they stand there. A text of any length is sorted whole; words of more
than 64 bytes are compared by their remaining bytes at once. An empty table gives no rows; a
language without kept terms gives its pairs of sources with value 0. Equal values are ranked
by the item's UTF-8 bytes. Other columns are not read, so their names cannot clash. Shares
are exact up to 9e13 occurrences of kept terms in a language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.common import bounded_batches, map_arrow, materialize, ship, table

#: Documents of a language that a kept term is in, and places listed per source for terms.
LEAST_DOCS, LISTED = 30, 50
#: Shares are whole parts of this many, of counts raised by this much.
PARTS, RAISE = 1_000_000_000, 5

#: Bytes of text sorted at once, and rows of counts a task holds before it hands them on.
SLICE, HELD = 8 << 20, 1_000_000
#: Eight-byte characters compared one by one; what is left of longer words is compared at once.
DEEP = 8
#: Kept rows in one group of the comparison of sources, and cells of its matrix.
GROUP_ROWS, CELLS = 200_000, 2_000_000

_LETTER = np.zeros(256, np.uint8)
_LETTER[128:] = np.arange(128, 256)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
#: The first r of eight bytes.
_FIRST = np.array([0] + [(1 << 64) - (1 << 8 * (8 - r)) for r in range(1, 9)], np.uint64)

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                    ("n", pa.int64()), ("docs", pa.int64())])


def word_pointers(data: np.ndarray, offsets: np.ndarray):
    """The texts' letters, A-Z lower-cased and other bytes 0, followed by zeros, and the
    start, length and text number of every word. ``offsets`` are the texts' ends in ``data``."""
    letters = np.zeros(len(data) + 8 * (DEEP + 1), np.uint8)
    np.take(_LETTER, data, out=letters[:len(data)])
    inside = letters[:len(data) + 1] != 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = np.zeros(len(inside), bool)
    ends[1:] = inside[:-1] & ~inside[1:]
    cuts = offsets[1:-1]
    starts[cuts] = inside[cuts]  # a text's first letter starts a word
    inner = cuts[cuts > 0]
    ends[inner] = inside[inner - 1]
    start = np.flatnonzero(starts)
    length = np.flatnonzero(ends) - start
    return letters, start, length, np.searchsorted(offsets, start, "right") - 1


def _characters(letters: np.ndarray, start: np.ndarray, length: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes of every word at ``depth``, zeros after its end, as numbers."""
    wide = np.ndarray(len(letters) - 7, ">u8", letters, strides=(1,))
    at = wide[np.minimum(start + 8 * depth, len(letters) - 8)].astype(np.uint64)
    return at & _FIRST[np.clip(length - 8 * depth, 0, 8)]


def sort_pointers(letters: np.ndarray, start: np.ndarray, length: np.ndarray):
    """The order of the words' bytes, and which places of it begin a run of equal words."""
    n = len(start)
    char = _characters(letters, start, length, 0)
    order = np.argsort(char)
    char = char[order]
    heads = np.ones(n, bool)
    heads[1:] = char[1:] != char[:-1]
    place = np.arange(n)
    depth = 1
    while True:
        # runs of more than one word that go on: their last byte so far is a letter
        more = (char & np.uint64(0xFF)) != 0
        alone = heads[place] & np.append(heads[1:], True)[place]
        place = place[more & ~alone]
        if not len(place):
            return order, heads
        words = order[place]
        if depth < DEEP:
            char = _characters(letters, start[words], length[words], depth)
        else:
            rest = [letters[s + 8 * depth:s + n_].tobytes() for s, n_ in
                    zip(start[words].tolist(), length[words].tolist())]
            rank = {b: i << 8 for i, b in enumerate(sorted(set(rest)))}
            char = np.array([rank[b] for b in rest], np.uint64)
        run = np.cumsum(heads)[place]
        by = np.lexsort((char, run))
        order[place], char = words[by], char[by]
        differs = np.zeros(len(place), bool)
        differs[1:] = char[1:] != char[:-1]
        heads[place] |= differs  # where two runs meet there is a head already
        depth += 1


def slice_counts(texts: pa.Array, groups: np.ndarray, labels: list[tuple[str, str]]) -> pa.Table:
    """lang, source, term, n, docs of a slice; ``groups`` has the number in ``labels`` of
    every text's (lang, source). The term '' counts the documents of a group."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, np.uint8)[offsets[0]:offsets[-1]] if whole else np.zeros(0, np.uint8)
    letters, start, length, doc = word_pointers(data, offsets - offsets[0])
    order, heads = sort_pointers(letters, start, length)
    # texts numbered by group: in the order of (run, text) a run's groups stand together
    by_group = np.argsort(groups, kind="stable")
    number = np.empty(len(groups), np.int64)
    number[by_group] = np.arange(len(groups))
    size = max(1, len(groups))
    both = np.sort((np.cumsum(heads) - 1) * size + number[doc[order]])
    once = np.flatnonzero(np.diff(both, prepend=-1))
    run, group = both[once] // size, groups[by_group][both[once] % size]
    first = np.flatnonzero((np.diff(run, prepend=-1) != 0) | (np.diff(group, prepend=-1) != 0))
    n = np.diff(np.append(once[first], len(both)))
    docs = np.diff(np.append(first, len(once)))
    word = order[np.flatnonzero(heads)][run[first]]
    long = length[word]
    ends = np.cumsum(long)
    # the bytes of all terms, one after the other
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start[word] - (ends - long), long)
    terms = pa.LargeStringArray.from_buffers(
        len(word), pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(letters[at])).cast(pa.string())
    k = len(labels)
    names = [pa.array([label[i] for label in labels], pa.string()) for i in (0, 1)]
    group = pa.array(np.append(group[first], np.arange(k)))
    return pa.table([*(x.take(group) for x in names),
                     pa.concat_arrays([terms, pa.array([""] * k, pa.string())]),
                     pa.array(np.append(n, np.zeros(k, np.int64))),
                     pa.array(np.append(docs, np.bincount(groups, minlength=k)))], schema=COUNTS)


def _added(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate(
        [("n", "sum"), ("docs", "sum")])
    return found.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(COUNTS.names)


def _count(batches):
    held, rows = [], 0
    for batch in bounded_batches(batches, 0, SLICE):
        labels: dict[tuple, int] = {}
        groups = np.array([labels.setdefault(pair, len(labels)) for pair in zip(
            batch.column(1).to_pylist(), batch.column(2).to_pylist())], np.int64)
        held.append(slice_counts(batch.column(0), groups, list(labels)))
        rows += held[-1].num_rows
        if rows > HELD:
            held = [_added(held)]
            rows = held[0].num_rows
            if rows > HELD // 2:
                yield from held[0].to_batches(100_000)
                held, rows = [], 0
    if held:
        yield from _added(held).to_batches(100_000)


def term_counts(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n, n_lang (occurrences in the source and the language) of the terms
    in ``least`` documents of their language, and every source's row of the term ''."""
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("text", "lang", "source")))
    found = map_arrow(texts, _count, "lang string, source string, term string, n long, docs long")
    # one exchange by term serves the sums by source and the sums over sources
    by_source = found.repartition("term", "lang").groupBy("term", "lang", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("term", "lang")
    return by_source.withColumns({
        "docs": F.sum("docs").over(term), "n_lang": F.sum("n").over(term)}).filter(
        (F.col("docs") >= least) | (F.col("term") == "")).select(
        "lang", "source", "term", "n", "n_lang")


def source_totals(kept: DataFrame) -> DataFrame:
    """lang, source, n_all, lang_n_all (occurrences of kept terms) and n_terms of a language."""
    sources = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    langs = kept.filter("term <> ''").groupBy("lang", "term").agg(
        F.first("n_lang").alias("n")).groupBy("lang").agg(
        F.sum("n").alias("lang_n_all"), F.count(F.lit(1)).alias("n_terms"))
    return sources.join(langs, "lang", "left").select(
        "lang", "source", "n_all", F.coalesce("lang_n_all", F.lit(0)).alias("lang_n_all"),
        F.coalesce("n_terms", F.lit(0)).alias("n_terms"))


def _share(n: str, n_all: str) -> Column:
    """1 + floor(PARTS * (n + RAISE) / (n_all + RAISE * n_terms)): two steps of a long
    division, since the product leaves 64 bits."""
    whole = f"({n_all} + {RAISE} * n_terms)"
    high = f"(10000 * ({n} + {RAISE}))"
    return F.expr(f"1 + 100000 * ({high} div {whole}) + (100000 * ({high} % {whole})) div {whole}")


def _shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """As :func:`_share`."""
    high, rest = np.divmod(10000 * (n + RAISE), whole)
    return 1 + 100000 * high + 100000 * rest // whole


def _compare(key, kept: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums over a group's terms of the differences of every two sources' shares."""
    names = sorted(sources.column("source").to_pylist())
    place = {name: i for i, name in enumerate(names)}
    k = len(names)
    at = np.array([place[s] for s in sources.column("source").to_pylist()], np.int64)
    whole = np.empty(k, np.int64)
    whole[at] = (sources.column("n_all").to_numpy() + RAISE * sources.column("n_terms").to_numpy())
    sums = np.zeros((k, k), np.int64)
    if kept.num_rows:
        coded = kept.column("term").combine_chunks().dictionary_encode()
        term, n_terms = coded.indices.to_numpy(), len(coded.dictionary)
        source = np.array([place[s] for s in kept.column("source").to_pylist()], np.int64)
        n = kept.column("n").to_numpy()
        order = np.argsort(term, kind="stable")
        step = max(1, CELLS // k)
        for low in range(0, n_terms, step):
            high = min(n_terms, low + step)
            rows = order[slice(*np.searchsorted(term[order], [low, high]))]
            counts = np.zeros((high - low, k), np.int64)
            counts[term[rows] - low, source[rows]] = n[rows]
            shares = _shares(counts, whole)
            for i in range(k):
                sums[i] += np.abs(shares - shares[:, i:i + 1]).sum(0)
    one, other = np.nonzero(~np.eye(k, dtype=bool))
    named = pa.array(names, pa.string())
    return pa.table({"lang": pa.array([key[0].as_py()] * len(one), pa.string()),
                     "source": named.take(pa.array(one)), "item": named.take(pa.array(other)),
                     "value": pa.array(sums[one, other])})


def source_divergence(docs: DataFrame, least: int = LEAST_DOCS, listed: int = LISTED) -> DataFrame:
    """lang, source, part, item, value, rank: how far a source's use of the kept terms lies
    from every other source of its language (part ``pair``), and the terms that it uses more
    than its language does, the first ``listed`` (part ``term``)."""
    spark = docs.sparkSession
    kept = materialize(term_counts(docs, least), "source-terms")
    sources = materialize(source_totals(kept), "source-totals")
    terms = kept.filter("term <> ''")

    # every group gives a sum for every two sources: as many groups as the rows need
    groups = max(1, -(-terms.count() // GROUP_ROWS))
    dealt = terms.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(groups)).cast("int"))
    everywhere = sources.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    ship(spark)
    sums = dealt.groupBy("lang", "bucket").cogroup(everywhere.groupBy("lang", "bucket")).applyInArrow(
        _compare, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")

    p, q = _share("n", "n_all"), _share("n_lang", "lang_n_all")
    above = terms.filter("n > 0").join(sources, ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).cast("int").alias("rank")
    return pairs.select("*", rank).unionByName(
        above.filter("value > 0").select("*", rank).filter(F.col("rank") <= listed))


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
words AS (
    SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 30),
counts AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
sources AS (
    SELECT s.lang, s.source, (SELECT count(*) FROM kept k WHERE k.lang = s.lang) AS v,
        (SELECT coalesce(sum(n), 0) FROM counts c WHERE c.lang = s.lang AND c.source = s.source) AS n_all,
        (SELECT coalesce(sum(n), 0) FROM counts c WHERE c.lang = s.lang) AS lang_all
    FROM (SELECT DISTINCT lang, source FROM docs) s),
shares AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.n_all + 5 * s.v) AS p,
        1 + (1000000000::HUGEINT * (sum(coalesce(c.n, 0)) OVER (PARTITION BY s.lang, k.term) + 5))
            // (s.lang_all + 5 * s.v) AS q
    FROM sources s JOIN kept k ON k.lang = s.lang
    LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
listed AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
        FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) d
        ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM listed)
WHERE part = 'pair' OR rank <= 50
"""
