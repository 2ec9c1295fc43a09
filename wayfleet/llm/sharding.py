"""Weighted rendezvous hashing of record keys over shards. DataFrame functions only.

Each key draws one number per shard from a digest of (key, shard); the shard
with the least -ln(number) / weight owns the key. A new shard can only win keys
for itself, a removed one only gives its own away, and a shard of weight w gets
w times the keys of one of weight 1.

Defined results: rows of one key share a shard; a null key is a key of its own;
a null or empty text counts no bytes; a shard of weight 0 or less gets nothing;
further columns are kept out of the way by the names chosen by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfleet.session import cut

_DIGITS = 13     # hexadecimal digits of a draw: 52 bits, exact in a double
ROW_BYTES = 16   # what a row takes beside its text
EQUAL_ROWS = 1 << 16     # equal rows that one task gives out at a time


def draw(key: Column, shard: int) -> Column:
    """Number in (0, 1) that key and shard decide."""
    digest = F.substring(F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(shard)))), 1, _DIGITS)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / float(16 ** _DIGITS)


def owner(key: Column, weights: dict[int, float]) -> Column:
    """The shard that owns a key; of equal draws the smaller shard."""
    offers = [F.struct((-F.log(draw(key, s)) / F.lit(float(w))).alias("cost"), F.lit(s).alias("shard"))
              for s, w in sorted(weights.items()) if w > 0]
    return F.array_min(F.array(*offers))["shard"]


def grown(key: Column, now: Column, weights: dict[int, float], shard: int, weight: float = 1.0) -> Column:
    """The owner after ``shard`` joins, from the owner now: only the newcomer's offer is compared."""
    by_owner = F.create_map(*[F.lit(x) for s, w in sorted(weights.items()) if w > 0 for x in (s, float(w))])
    digest = F.substring(F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), now.cast("string"))), 1, _DIGITS)
    held = -F.log((F.conv(digest, 16, 10).cast("double") + 0.5) / float(16 ** _DIGITS)) / F.element_at(by_owner, now)
    return F.when(-F.log(draw(key, shard)) / F.lit(float(weight)) < held, F.lit(shard)).otherwise(now)


def shard_table(docs: DataFrame, weights: dict[int, float], new_shard: int | None = None, id_col: str = "doc_id",
                text_col: str = "text", lanes: int = 64) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``slot`` counts the rows of a shard from 0 without gaps. A shard is cut into
    ``lanes`` by the text's checksum and key; rows are numbered inside a lane
    and lanes are offset by the counts of the lanes before, so no task sorts a
    whole shard. Rows equal in key, size and checksum are counted before they are
    numbered and take consecutive slots in any order; many of them are given
    out by several tasks.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("key"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"))
    rows = rows.withColumn("shard", owner(F.col("key"), weights))
    if new_shard is None:
        rows = rows.withColumn("grown_shard", F.lit(None).cast("int"))
    else:
        rows = rows.withColumn("grown_shard", grown(F.col("key"), F.col("shard"), weights, new_shard))
    digest = F.substring(F.md5(F.concat_ws(":", F.lit("lane"), F.coalesce(F.col("key").cast("string"), F.lit("null")), F.col("text_crc32").cast("string"))), 1, 6)
    rows = rows.withColumn("lane", F.pmod(F.conv(digest, 16, 10).cast("int"), F.lit(lanes)))
    equal = cut(rows.groupBy("shard", "grown_shard", "lane", "key", "text_crc32", "size").agg(F.count(F.lit(1)).alias("n")), "dealt")
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = equal.groupBy("shard", "lane").agg(F.sum("n").alias("n"))
    offsets = counts.select("shard", "lane", earlier(Window.partitionBy("shard").orderBy("lane")).alias("offset"))
    inside = Window.partitionBy("shard", "lane").orderBy("key", "text_crc32", "size")
    placed = cut(equal.withColumn("place", earlier(inside)).join(offsets, ["shard", "lane"])
                 .withColumn("first", F.col("offset") + F.col("place")), "placed")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)
    single = placed.where(F.col("n") <= EQUAL_ROWS)
    pieces = (placed.where(F.col("n") > EQUAL_ROWS).withColumn("piece", F.explode(upto(F.ceil(F.col("n") / EQUAL_ROWS))))
              .withColumns({"first": F.col("first") + F.col("piece") * EQUAL_ROWS, "n": F.least(F.col("n") - F.col("piece") * EQUAL_ROWS, F.lit(EQUAL_ROWS))})
              .repartition("key", "first").drop("piece"))
    return (single.unionByName(pieces).withColumn("i", F.explode(upto(F.col("n"))))
            .select(F.col("key").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"),
                    (F.col("first") + F.col("i")).cast("long").alias("slot"), F.col("grown_shard").cast("int")))
