"""Chat formatting after collapsing cumulative snapshots. DataFrame functions only.

A logged conversation that is the beginning of a longer one is a snapshot of it
and goes; of equal conversations the smallest id stays. Each conversation gets
rolling hashes of its turn prefixes; a conversation goes when the hash of all its
turns is among the proper prefixes of another (anti-join on distinct prefixes).

Defined results: turns are ordered by (turn, role, text), nulls first; a null
text is empty, a null role is ``user``; rows without conversation id belong to none
and are left out; the turns of one conversation meet in one row, as its rendering
does; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfleet.session import cut

# The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def rolling_hashes(turns: Column) -> Column:
    """Two 64-bit hashes of the first 1, 2, ... turns of an ordered array of (turn, role, text)."""
    start = F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("all"))

    def step(acc, t):
        a = F.xxhash64(acc["a"], t["role"], t["text"])
        b = F.xxhash64(t["text"], acc["b"], t["role"], F.lit("b"))
        return F.struct(a.alias("a"), b.alias("b"), F.array_append(acc["all"], F.struct(a.alias("a"), b.alias("b"))).alias("all"))

    return F.aggregate(turns, start, step, lambda acc: acc["all"])


def render(turns: Column) -> Column:
    """The chat text of an ordered array of turns."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE))), "\n")


def collapse_and_render(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                        text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, n_copies, chat) of the maximal conversations."""
    turn = F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("user")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    whole = rows.where(F.col(conv_col).isNotNull()).groupBy(F.col(conv_col).alias("conv")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = cut(whole.withColumn("hashes", rolling_hashes(F.col("turns"))), "conversations")
    n = F.size("hashes")
    full = whole.select("conv", n.alias("n"), F.element_at("hashes", -1).alias("h")).select("conv", "n", "h.a", "h.b")
    # Equal conversations, combined before the shuffle: the smallest id stands for all.
    kinds = full.groupBy("n", "a", "b").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("copies"))
    prefixes = (whole.select(F.posexplode(F.slice("hashes", 1, F.greatest(n - 1, F.lit(0)))).alias("at", "h"))
                .select((F.col("at") + 1).alias("n"), "h.a", "h.b").distinct())
    kept = kinds.join(prefixes, ["n", "a", "b"], "left_anti")
    return (whole.join(kept.select("conv", "n", "copies"), "conv")
            .select(F.col("conv").alias(conv_col), F.col("n").cast("long").alias("n_turns"), F.col("copies").alias("n_copies"), render(F.col("turns")).alias("chat")))
