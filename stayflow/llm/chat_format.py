"""Chat formatting with cumulative-snapshot collapse, on DataFrame functions alone.

Chat logs often hold a conversation many times, each snapshot with one turn more. Every turn
is hashed with its place in the conversation, and the hashes are summed over the turns before
it: the rolling sum identifies the prefix that ends there. A conversation whose last sum is
the sum of a proper prefix elsewhere is a snapshot of a longer one; an anti-join removes it.
Of conversations with equal turns the one with the smallest id stays. The others are rendered.

Sums make the prefix hash independent of how a conversation is split: turns are summed inside
blocks of ``BLOCK`` turn numbers, then over the blocks, and rendered block by block, so a
conversation that holds a third of all turns is never one group. A block of more than ``MOST``
turns (many texts under one turn number, or under none) is cut again by turn number, and turn
numbers of more than ``BLOCK`` texts by the leading bits of the text's hash, which is the next
key of the order. Two independent 64-bit sums
(mod 2**64, kept as decimals) and the number of turns must agree, 128 bits in all.

Defined results: turns are ordered by turn number (null first), then role and text; exact
repeats of a row count once; a text of any length is one turn; a null text is empty, a null role is "unknown"; rows without
conversation id belong to none and are left out; an empty table gives an empty table. Other
columns are not read.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.llm.common import materialize, sent, table

#: Turn numbers in a block, and so turns in a rendered part.
BLOCK = 512
#: Turns of a block beyond which it is cut.
MOST = 8 * BLOCK
#: Turn number that null counts as where blocks are cut.
NO_TURN = -(1 << 63)
START, END = "<|im_start|>", "<|im_end|>"


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    number = F.col(turn).cast("long")
    return rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), number.alias("turn"),
        F.coalesce(F.floor(number / BLOCK), F.lit(-(1 << 53))).alias("block"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))


def _seed(k: int) -> Column:
    """One of two 64-bit hashes of a turn's role and text."""
    return F.xxhash64(F.lit(k), "role", F.length("role"), "text").alias(f"h{k}")


def hashed(turns: DataFrame) -> DataFrame:
    """conv_id, block, turn, h1, h2 of every different turn."""
    # exact repeats count once; ties of the turn number follow the hashes of role and text,
    # which is the same order for equal turns of any conversation
    slim = turns.select("conv_id", "block", "turn", _seed(1), _seed(2)).distinct()
    return materialize(slim, "turn-hashes")


def cuts(slim: DataFrame, most: int) -> DataFrame:
    """conv_id, block, number, bits of the turn numbers of blocks with more than ``most``
    turns: each is a piece of its own, or 2**bits pieces by the leading bits of h1."""
    number = F.coalesce("turn", F.lit(NO_TURN)).alias("number")
    large = slim.groupBy("conv_id", "block").count().filter(F.col("count") > most)
    large = materialize(large.select("conv_id", "block"), "large-blocks")
    of = slim.join(sent(large), ["conv_id", "block"], "left_semi").groupBy(
        "conv_id", "block", number).agg(F.count(F.lit(1)).alias("n"))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BLOCK))).cast("int")
    return materialize(of.select("conv_id", "block", "number", bits.alias("bits")), "cuts")


PIECE = ["conv_id", "block", "piece_turn", "piece_hash"]


def in_pieces(turns: DataFrame, cut: DataFrame) -> DataFrame:
    """``turns`` (with turn, h1) with piece_turn and piece_hash: the place of its piece."""
    turns = turns.withColumn("number", F.coalesce("turn", F.lit(NO_TURN)))
    return turns.join(sent(cut), ["conv_id", "block", "number"], "left").withColumns({
        "piece_turn": F.when(F.col("bits").isNotNull(), F.col("number")).otherwise(F.lit(NO_TURN)),
        "piece_hash": F.expr("case when bits > 0 then shiftright(h1, 64 - bits) else 0L end"),
    }).drop("number", "bits")


def before_pieces(slim: DataFrame) -> DataFrame:
    """The pieces with offset: turns of the conversation before the piece."""
    sizes = slim.groupBy(*PIECE).agg(F.count(F.lit(1)).alias("n"))
    return sizes.select(*PIECE, F.coalesce(F.sum("n").over(_before()), F.lit(0)).alias("offset"))


def _before():
    return Window.partitionBy("conv_id").orderBy(*PIECE[1:]).rowsBetween(Window.unboundedPreceding, -1)


def prefixes(slim: DataFrame) -> DataFrame:
    """conv_id, place (from 1), p1, p2: the rolling sums after each turn."""
    inside = Window.partitionBy(*PIECE).orderBy("turn", "h1", "h2")
    before, offsets = _before(), before_pieces(slim)

    def placed(k: int) -> Column:
        return F.xxhash64(F.col(f"h{k}"), F.col("place")).cast("decimal(20,0)")

    placed_turns = (slim.withColumn("at", F.row_number().over(inside))
                    .join(offsets, PIECE)
                    .withColumn("place", F.col("offset") + F.col("at"))
                    .select(*PIECE, "place", placed(1).alias("v1"), placed(2).alias("v2")))
    inside = Window.partitionBy(*PIECE).orderBy("place")
    totals = placed_turns.groupBy(*PIECE).agg(
        F.sum("v1").alias("t1"), F.sum("v2").alias("t2")).select(
        *PIECE, *(F.coalesce(F.sum(f"t{k}").over(before), F.lit(0)).alias(f"b{k}")
                              for k in (1, 2)))
    word = F.lit(Decimal(1 << 64))
    return placed_turns.select(
        *PIECE, "place", *(F.sum(f"v{k}").over(inside).alias(f"s{k}") for k in (1, 2))
    ).join(totals, PIECE).select(
        "conv_id", "place", *(F.pmod(F.col(f"s{k}") + F.col(f"b{k}"), word)
                              .cast("decimal(20,0)").alias(f"p{k}") for k in (1, 2)))


def maximal(slim: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that are no snapshot of a longer one;
    of equal conversations, the one with the smallest id."""
    key = ["place", "p1", "p2"]
    found = materialize(prefixes(slim), "turn-prefixes")
    ends = found.groupBy("conv_id").agg(F.max("place").alias("n"))
    known = found.join(ends, "conv_id")
    whole = known.filter(F.col("place") == F.col("n")).groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    proper = known.filter(F.col("place") < F.col("n")).select(*key).distinct()
    return whole.join(proper, key, "left_anti").select(
        "conv_id", F.col("place").alias("n_turns"), "n_copies")


def chat_format(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", most: int = MOST) -> DataFrame:
    """conv_id, part, turns_before, n_turns (of the conversation), n_copies, part_turns,
    rendered: the maximal conversations as ChatML, in parts of ``BLOCK`` turn numbers (part:
    the first turn number over BLOCK), or pieces of a part with more than ``most`` turns; a
    conversation is its rows joined in the order of turns_before."""
    turns = _turns(rows, conv, turn, role, text)
    slim = hashed(turns)
    cut = cuts(slim, most)
    slim = in_pieces(slim, cut)
    kept = materialize(maximal(slim), "maximal")
    one = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END + "\n"))
    turns = (turns.join(kept.select("conv_id"), "conv_id", "left_semi")
             .select("conv_id", "block", "turn", _seed(1), _seed(2), one.alias("line")))
    return (in_pieces(turns, cut).groupBy(*PIECE)
            .agg(F.array_sort(F.collect_set(F.struct("turn", "h1", "h2", "line"))).alias("turns"))
            .join(before_pieces(slim), PIECE).join(kept, "conv_id")
            .select("conv_id", F.col("block").alias("part"), F.col("offset").alias("turns_before"),
                    "n_turns", "n_copies", F.size("turns").cast("long").alias("part_turns"),
                    F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("rendered")))


def op2_chat_format(spark, sf_dir: str) -> DataFrame:
    found = chat_format(table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "part", "turns_before", "n_turns", "n_copies", "part_turns",
                        F.length("rendered").cast("long").alias("n_chars"),
                        F.sha2("rendered", 256).alias("rendered_sha256"))


#: The driver's turns are numbered from 0 without gaps or repeats, so a prefix is a list.
ORACLE = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
seen AS (
  SELECT conv_id, turn, md5(string_agg(md5(role) || md5(text), '') OVER (
           PARTITION BY conv_id ORDER BY turn)) AS prefix,
         count(*) OVER (PARTITION BY conv_id ORDER BY turn) AS place,
         count(*) OVER (PARTITION BY conv_id) AS n FROM turns),
whole AS (
  SELECT min(conv_id) AS conv_id, place, prefix, count(*) AS n_copies
  FROM seen WHERE place = n GROUP BY place, prefix),
kept AS (
  SELECT * FROM whole w WHERE NOT EXISTS (
    SELECT 1 FROM seen s WHERE s.place < s.n AND s.place = w.place AND s.prefix = w.prefix)),
parts AS (
  SELECT k.conv_id, turn // 512 AS part, k.place AS n_turns, k.n_copies,
         count(*) AS part_turns,
         string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                    ORDER BY turn) AS rendered
  FROM kept k JOIN turns t USING (conv_id) GROUP BY ALL)
SELECT conv_id, part, coalesce(sum(part_turns) OVER (
         PARTITION BY conv_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         0)::BIGINT AS turns_before, n_turns, n_copies, part_turns, length(rendered) AS n_chars,
       sha256(rendered) AS rendered_sha256 FROM parts
"""
