"""Personal data: base patterns, then information-theoretic sanitisation of telling terms.

Everything runs on DataFrame functions. Base spans (email, ip, card, phone) come from regular
expressions; their places follow from the lengths of the matches and of the text between.

The values found are the protected entities, terms are the runs of three letters or more
outside addresses, as lower case. Document counts over the whole corpus and whole texts give

    disclosure(t, e) = PMI(t; e) / IC(e) = log(N d(t,e) / (d(t) d(e))) / log(N / d(e)),

which is 1 when the term never occurs without the entity, so that seeing the term tells the
entity, and 0 when they are independent. As few documents say little, d(t,e) / d(t) is not
taken as counted but at its Wilson lower bound, ``SURE`` standard errors down. d(t,e) counts
the documents that hold both anywhere; but any rare word of a document shares one or two
documents with its entities, so below ``FAR`` shared documents only those count in which the
term stands within ``window`` characters of the entity. A term tells an entity if its
disclosure exceeds ``generalise`` and the bounded share is ``LIKELY`` at least (a document with
the term holds the entity more likely than not). Every occurrence of a telling term, in every
text, is replaced by a class label, or deleted if its disclosure exceeds ``remove``.
``support`` can ask for more shared documents. Base spans always stay.

Entities that stand in the same documents count alike with every term, and so do terms; pairs
are counted between such classes, and only for terms rare enough to tell an entity of their
document. A text with many entities thus gives one class of those found in it alone.

Defined results: null or empty text has no spans; every input row gives one row (repeated
rows count as documents of their own); an entity found in every document is told by nothing;
an empty table gives an empty table. The work on one text grows with its length, also when it
is very long or holds spans by the hundred thousand. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import SENT_ROWS, free_name, materialize, quoted, sent, table

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: The contract's patterns, written so that Java's matcher neither recurses nor rescans long
#: runs: a match can only start where a run of its characters starts (or where the match
#: before it ended), and what cannot be given back is possessive. A card is a maximal run of
#: digits with single spaces or hyphens, of the length that can pass.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap necessary condition of each kind.
GATES = {
    "email": lambda t: F.instr(t, "@") > 0,
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){12}"),
    "phone": lambda t: F.instr(t, "+") > 0,
}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
LETTERS = r"\p{L}{3,}+"

WINDOW, SUPPORT, GENERALISE, REMOVE = 60, 1, 0.8, 0.95
#: Standard errors between a counted share and the bound that is used for it.
SURE = 1.0
#: Shared documents from which a term need not stand near the entity.
FAR = 3
#: Least share (lower bound) of a telling term's documents that hold the entity.
LIKELY = 0.5
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
TERM_LABEL = "[TERM]"

_MATCH = "struct<kind:int,start:bigint,end:bigint,value:string>"
#: Items that a fold appends to one array, and code points that are cut out of a text at once:
#: both cost their square.
STEP, CHUNK = 256, 1024


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _steps(items: Column, step: Column) -> Column:
    """The numbers of the slices of ``step`` items that make up a non-empty array."""
    return F.sequence(F.lit(0), F.floor((F.size(items) - 1) / step).cast("int"))


def _slice(items: Column, number: Column, step: Column) -> Column:
    return F.slice(items, number * step + 1, step)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """The Luhn sum of the digits is a multiple of ten."""
    def add(total, d):
        return total + d

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    digits = F.split(F.reverse(_digits(match)), "")
    return F.aggregate(F.transform(digits, value), F.lit(0), add) % 10 == 0


ACCEPT = {
    "email": lambda m: m.isNotNull(),
    "ip": lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _pieces(text: Column, pattern: str) -> Column:
    """Array of (gap, match): splitting and extracting walk the same matches."""
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))


def matches(text: Column, pattern: str, accept) -> Column:
    """Array of (start, match) for the accepted matches of ``pattern``, in order: a match starts
    where the text before it and the matches before it end (in code points)."""
    empty = F.array().cast("array<struct<start:bigint,match:string>>")
    zero = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        at, match = acc["at"] + F.length(x["gap"]), x["match"]
        out = F.when(match.isNotNull() & accept(match), F.concat(acc["out"], F.array(
            F.struct(at.alias("start"), match.alias("match"))))).otherwise(acc["out"])
        return F.struct((at + F.coalesce(F.length(match), F.lit(0))).alias("at"), out.alias("out"))

    def shifted(part: Column, start: Column) -> Column:
        return F.transform(part["out"], lambda x: F.struct(
            (x["start"] + start).alias("start"), x["match"].alias("match")))

    def joined(parts: Column) -> Column:
        starts = F.aggregate(parts, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(
            "array<bigint>").alias("all")), lambda acc, x: F.struct(
            (acc["at"] + x["at"]).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")))
        return F.flatten(F.zip_with(parts, starts["all"], shifted))

    size = F.lit(STEP)
    return _let(_pieces(text, pattern), lambda found: _let(
        F.transform(_steps(found, size), lambda c: F.aggregate(_slice(found, c, size), zero, step)), joined))


def base_matches(text: Column) -> Column:
    """Array of (kind number, start, end, value) of the base patterns, by kind, then start."""
    def of_kind(number: int, kind: str) -> Column:
        found = F.transform(matches(text, PATTERNS[kind], ACCEPT[kind]), lambda m: F.struct(
            F.lit(number).alias("kind"), m["start"].alias("start"),
            (m["start"] + F.length(m["match"])).alias("end"), m["match"].alias("value")))
        return F.when(GATES[kind](text), found).otherwise(F.array().cast(f"array<{_MATCH}>"))

    return F.concat(*(of_kind(number, kind) for number, kind in enumerate(KINDS)))


def base_spans(text: Column) -> Column:
    """Array of (kind number, start, end) of the base patterns, by kind, then start."""
    return F.transform(base_matches(text), lambda m: F.struct(
        m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def _masked(text: Column) -> Column:
    """``text`` with zeros for addresses, the only base spans that hold letters."""
    parts = F.transform(_pieces(text, PATTERNS["email"]), lambda x: F.concat(
        x["gap"], F.coalesce(F.repeat(F.lit("0"), F.length(x["match"])), F.lit(""))))
    return F.when(GATES["email"](text), F.array_join(parts, "")).otherwise(text)


def _letters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))


def _lowered(found: Column) -> Column:
    return F.array_distinct(F.transform(F.array_distinct(found), F.lower))


def document_terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return _lowered(_letters(_masked(text)))


def _near(found: Column, text: Column, window: int) -> Column:
    """For each of ``found`` (base_matches): the entity, and the terms near it."""
    chunk = max(CHUNK, window)

    def part(chunks: Column, start: Column, n: Column) -> Column:
        at = F.floor(start / chunk).cast("int")
        two = F.concat(*(F.coalesce(F.get(chunks, at + k), F.lit("")) for k in (0, 1)))
        return F.substring(two, (start - at * chunk + 1).cast("int"), n.cast("int"))

    def one(m: Column, s: Column) -> Column:
        low = F.greatest(s["start"] - window, F.lit(0))
        left = part(m["chunks"], low, s["start"] - low)
        right = part(m["chunks"], s["end"], F.lit(window))
        # words that the window cuts off are not near
        left = F.when(low > 0, F.regexp_replace(left, r"^\p{L}+", "")).otherwise(left)
        right = F.when(s["end"] + window < m["n"], F.regexp_replace(right, r"\p{L}+$", "")).otherwise(right)
        return F.struct(_entity(s).alias("entity"),
                        _lowered(F.concat(_letters(left), _letters(right))).alias("terms"))

    masked = _let(_masked(text), lambda t: F.struct(
        F.regexp_extract_all(t, F.lit(rf"(?s).{{1,{chunk}}}"), F.lit(0)).alias("chunks"),
        F.length(t).alias("n")))
    return _let(masked, lambda m: F.transform(found, lambda s: one(m, s)))


def _entity(match: Column) -> Column:
    return F.concat_ws(":", match["kind"], match["value"])


def _share(both: str, every: str) -> str:
    """SQL of the Wilson lower bound of ``both`` / ``every``."""
    z2 = SURE * SURE
    return (f"(({both} + {z2 / 2}D - sqrt({z2}D * {both} * ({every} - {both}) / {every} + {z2 * z2 / 4}D))"
            f" / ({every} + {z2}D))")


#: Bytes of text up to which a list of terms is sent to every executor.
SENT_BYTES = 32 << 20


def _sent_terms(rows: DataFrame) -> DataFrame:
    """``rows`` marked for broadcast if they are few and their terms short (counted)."""
    rows_, bytes_ = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("term"))).first()
    return F.broadcast(rows) if rows_ <= SENT_ROWS and (bytes_ or 0) <= SENT_BYTES else rows


def _same_documents(name: str) -> list[Column]:
    """128 bits that say in which rows a group stands."""
    return [F.bit_xor(F.xxhash64("row")).alias(f"{name}1"),
            F.bit_xor(F.xxhash64(F.lit(name), "row")).alias(f"{name}2")]


def telling_terms(texts: DataFrame, window: int, support: int, generalise: float,
                  remove: float) -> DataFrame:
    """term, remove: the terms that tell a protected entity. ``texts`` has text."""
    # rows are numbered and written before anything is counted by them
    marked = (texts.select("text", base_matches(F.col("text")).alias("base"))
              .withColumn("row", F.monotonically_increasing_id()).filter(F.size("base") > 0))
    marked = materialize(marked.select(
        "row", F.array_distinct(F.transform("base", _entity)).alias("entities"),
        _near(F.col("base"), F.col("text"), window).alias("near"),
        document_terms(F.col("text")).alias("terms")), "marked-texts")
    total = texts.count()
    of_entity = marked.select("row", F.explode("entities").alias("entity"))
    entities = materialize(of_entity.groupBy("entity").agg(
        F.count(F.lit(1)).alias("d_e"), *_same_documents("e")).filter(F.col("d_e") < total), "entities")
    found = marked.select("row", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("d_m"), *_same_documents("t"))
    counts = texts.select(F.explode(document_terms(F.col("text"))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("d_t"))
    counts = materialize(counts.join(found, "term"), "term-counts")

    def judged(pairs: DataFrame, least: int) -> DataFrame:
        share = F.expr(_share("d_te", "d_t"))
        return (pairs.filter(F.col("d_te") >= least).withColumn("share", share)
                .withColumn("disclosure", F.expr(f"ln({total} * share / d_e) / ln({total} / d_e)"))
                .filter((F.col("share") >= LIKELY) & (F.col("disclosure") > generalise)))

    near = (marked.select("row", F.explode("near").alias("near"))
            .select("row", "near.entity", F.explode("near.terms").alias("term")).distinct()
            .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("d_te"))
            .join(entities.select("entity", "d_e"), "entity").join(counts.select("term", "d_t"), "term"))
    near = judged(near, support).select("term", "disclosure")

    # a term in many documents cannot tell an entity in few: the share is d / d_t at most, and
    # more than (d / N) ** (1 - generalise) is needed
    kind_e, kind_t = ["d_e", "e1", "e2"], ["d_t", "d_m", "t1", "t2"]
    far_e = (of_entity.join(entities.filter(F.col("d_e") >= FAR), "entity")
             .select("row", *kind_e).distinct())
    far_e = materialize(far_e, "repeated-entities")
    most = far_e.groupBy("row").agg(F.max("d_e").alias("most"))
    d = F.least("most", "d_m")
    possible = (d >= LIKELY * F.col("d_t")) & (
        d / F.col("d_t") > F.pow(d / F.lit(max(total, 1)), F.lit(1 - generalise)))
    candidates = materialize(counts.filter((F.col("d_m") >= FAR) & (F.col("d_m") >= LIKELY * F.col("d_t"))),
                             "candidate-terms")
    far_t = (marked.join(most, "row").select("row", "most", F.explode("terms").alias("term"))
             .join(_sent_terms(candidates), "term").filter(possible).select("row", *kind_t).distinct())
    far = far_e.join(far_t, "row").groupBy(*kind_e, *kind_t).agg(F.count(F.lit(1)).alias("d_te"))
    far = (judged(far, max(FAR, support)).groupBy(*kind_t).agg(F.max("disclosure").alias("disclosure"))
           .join(candidates, kind_t).select("term", "disclosure"))
    told = near.unionByName(far).groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    return materialize(told.select("term", (F.col("disclosure") > remove).alias("remove")), "telling-terms")


_NO_TERMS = "array<struct<start:bigint,end:bigint,remove:boolean>>"
#: Places of telling terms, of all rows together, up to which they are sent to every executor.
SENT_PLACES = 4_000_000


def _judged(docs: DataFrame, id_col: str, text_col: str, window: int, support: int,
            generalise: float, remove: float) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns, whose names are returned: base spans, and the places of
    telling terms.

    The texts are written nowhere in between: base spans are found again where they are used,
    and the places of telling terms come by 128 bits of hash of id and text (rows that agree
    in both have the same terms)."""
    of_id, of_text = quoted(id_col), quoted(text_col)

    def hashes() -> list[Column]:
        return [F.xxhash64(of_id, of_text), F.xxhash64(F.lit(1), of_text, of_id)]

    rows = docs.select(F.coalesce(of_text, F.lit("")).alias("text"),
                       *(h.alias(f"k{n}") for n, h in enumerate(hashes())))
    keys = ["k0", "k1"]
    terms = _sent_terms(telling_terms(rows.select("text"), window, support, generalise, remove))
    # the few texts that hold a telling term, then its places in them
    hits = rows.select(*keys, F.explode(document_terms(F.col("text"))).alias("term")).join(
        terms.select("term"), "term", "left_semi")
    hits = materialize(hits.select(*keys).distinct(), "told-texts")
    words = rows.join(sent(hits), keys, "left_semi").select(*keys, F.explode(
        matches(_masked(F.col("text")), LETTERS, lambda m: m.isNotNull())).alias("word"))
    words = words.select(*keys, F.lower("word.match").alias("term"), F.col("word.start").alias("start"),
                         (F.col("word.start") + F.length("word.match")).alias("end"))
    names = [free_name(docs, n) for n in ("told_one", "told_two", "told_terms")]
    told = materialize(words.join(terms, "term").groupBy(*keys).agg(F.sort_array(F.collect_set(
        F.struct("start", "end", "remove")))).toDF(*names), "told-places")
    size = told.agg(F.count(F.lit(1)), F.sum(F.size(names[2]))).first()
    if size[0] <= SENT_ROWS and (size[1] or 0) <= SENT_PLACES:
        told = F.broadcast(told)
    spans = free_name(docs, "base_spans")
    found = docs.join(told, [h == F.col(n) for h, n in zip(hashes(), names)], "left").withColumn(
        spans, base_spans(F.coalesce(of_text, F.lit(""))))
    return found.withColumn(names[2], F.coalesce(names[2], F.array().cast(_NO_TERMS))), spans, names[2]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, support: int = SUPPORT, generalise: float = GENERALISE,
                  remove: float = REMOVE, keep: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, ``base`` (array of kind number, start, end) and ``terms``
    (array of start, end, remove); with ``keep``, also its text (null: empty) and those columns
    of ``docs`` as ``kept``."""
    found, spans, terms = _judged(docs, id_col, text_col, window, support, generalise, remove)
    more = [F.coalesce(quoted(text_col), F.lit("")).alias("text"),
            F.struct(*map(quoted, keep)).alias("kept")] if keep else []
    return found.select(quoted(id_col).cast("long").alias("doc_id"), F.col(spans).alias("base"),
                        F.col(terms).alias("terms"), *more)


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              window: int = WINDOW, support: int = SUPPORT, generalise: float = GENERALISE,
              remove: float = REMOVE) -> DataFrame:
    """``docs`` with the personal data in its text replaced, all other columns as they are."""
    found, spans, terms = _judged(docs, id_col, text_col, window, support, generalise, remove)
    text = quoted(text_col)
    clean = F.when(text.isNotNull(), replaced(text, F.col(spans), F.col(terms)))
    return found.select(*(clean.alias(c) if c.lower() == text_col.lower() else quoted(c)
                          for c in docs.columns))


def _of_kind(number: int):
    return lambda s: s["kind"] == number


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def sanitise(found: DataFrame) -> Column:
    """The text with its spans replaced (of the result of ``personal_data`` with the text)."""
    return replaced(F.col("text"), F.col("base"), F.col("terms"))


def replaced(text: Column, base: Column, terms: Column) -> Column:
    """``text`` with its base spans and telling terms replaced."""
    labels = F.array(*(F.lit(LABELS[k]) for k in KINDS))
    spans = F.array_sort(F.concat(
        F.transform(base, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.element_at(labels, s["kind"] + 1).alias("label"))),
        F.transform(terms, lambda t: F.struct(
            t["start"].alias("start"), t["end"].alias("end"),
            F.when(t["remove"], "").otherwise(TERM_LABEL).alias("label")))))
    zero = F.lit(0).cast("long")

    def written(all_: Column, size: Column) -> Column:
        """Slices of the spans, each with the end of all before it, rewritten one by one."""
        starts = F.aggregate(
            F.transform(_steps(all_, size), lambda c: F.array_max(F.transform(
                _slice(all_, c, size), lambda s: s["end"]))),
            F.array(zero), lambda acc, end: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), end))))
        return _let(starts, lambda at: F.concat(
            F.array_join(F.transform(_steps(all_, size), lambda c: part(
                _slice(all_, c, size), F.get(at, c), F.get(at, c + 1))), ""),
            F.substring(text, (F.element_at(at, -1) + 1).cast("int"), F.length(text))))

    def part(some: Column, low: Column, high: Column) -> Column:
        cut = F.substring(text, (low + 1).cast("int"), (high - low).cast("int"))
        return _let(F.struct(cut.alias("text"), low.alias("low")), lambda own: F.aggregate(
            # (end so far, pieces): a span that starts inside an earlier one only extends it
            some, F.struct(own["low"].alias("at"), F.array().cast("array<string>").alias("out")),
            lambda acc, s: F.struct(
                F.greatest(acc["at"], s["end"]).alias("at"),
                F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(
                    F.substring(own["text"], (acc["at"] - own["low"] + 1).cast("int"),
                                (s["start"] - acc["at"]).cast("int")), s["label"]))
                       ).otherwise(acc["out"]).alias("out")),
            lambda acc: F.array_join(acc["out"], "")))

    return F.when(F.size(spans) > 0, _let(spans, lambda all_: _let(
        F.ceil(F.sqrt(F.size(all_))).cast("int"), lambda size: written(all_, size)))).otherwise(text)


def digest_columns(found: DataFrame) -> DataFrame:
    """The contract's columns of a result of ``personal_data``."""
    counts = [F.size(F.filter("base", _of_kind(n))).cast("long").alias(f"n_{k}")
              for n, k in enumerate(KINDS)]
    base = _written(F.col("base"))
    terms = F.array_join(F.transform("terms", lambda t: F.concat_ws(
        ":", F.lit(TERM), t["start"], t["end"])), ",")
    every = F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(terms, F.lit("")))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"),
                        every.alias("spans"), F.size("terms").cast("long").alias("n_term"))


def op7_personal_data(spark, sf_dir: str) -> DataFrame:
    return digest_columns(personal_data(table(spark, sf_dir, "documents")))
