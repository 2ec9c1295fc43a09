"""Benchmark decontamination by a distributed positional inverted index.

The index holds a posting (document, position, term) for each training token
whose term occurs in the benchmark, and one end posting per document at the
position after its last word. A benchmark window is looked up from its rarest
terms: the lists of the rarest, second and third rarest term are intersected
after taking each term's offset from its position, and only what is left meets
the lists of the commoner terms. DataFrame functions only.

Defined results: a null or empty text has no words, is hit by nothing and keeps
its row; every input row is a document of its own, also when rows or ids
repeat; an item without words has no window, one with fewer words than a window
is one window as a whole; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfleet.session import cut

# Fixed value: a word is a run of characters other than these ASCII ones, once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = "\u0001"     # cannot be a word
_RAREST = 3         # lists intersected one by one before the commoner terms are looked at


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, length: int, id_col: str = "item_id", text_col: str = "text"
                      ) -> tuple[DataFrame, DataFrame]:
    """((window, length, offset, word) of the distinct windows, distinct (window, item))."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - length, F.lit(0)))
    rows = items.select("item", "w", F.explode(starts).alias("s")).select("item", F.slice("w", F.col("s") + 1, length).alias("w"))
    # Windows are told apart by all their words, and numbered to travel light.
    rows = cut(rows.select(F.sha2(F.array_join("w", " "), 256).alias("digest"), "item", "w"), "windows")
    kinds = cut(rows.dropDuplicates(["digest"]).select("digest", "w").withColumn("window", F.monotonically_increasing_id()), "windows")
    terms = kinds.select("window", F.size("w").alias("length"), F.posexplode("w").alias("offset", "word"))
    return terms, cut(rows.join(kinds.select("digest", "window"), "digest").select("window", "item").distinct(), "items")


def positional_index(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (d, doc_id, text_hash, position, term) of the vocabulary's words, written to the shared folder.

    ``d`` numbers the input rows. Term -1 marks the end posting, its position is
    the number of words. Rows stay in the order of the scan, so the copy is
    small and needs no shuffle when the vocabulary is small enough to broadcast.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("d"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                           F.array_append(words(F.col(text_col)), F.lit(_END)).alias("w"))
    found = numbered.select("d", "doc_id", "text_hash", F.posexplode("w").alias("position", "word"))
    ends = vocabulary.sparkSession.range(1).select(F.lit(_END).alias("word"), F.lit(-1).cast("long").alias("term"))   # of known size
    return cut(found.join(vocabulary.select("word", "term").unionByName(ends), "word")
               .select("d", "doc_id", "text_hash", "position", "term"), "postings")


def _ranked(index: DataFrame, terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(window, length, offset, term, rank): the terms of windows that can occur, rarest first."""
    counts = index.where("term >= 0").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    known = terms.join(vocabulary, "word").join(cut(counts, "counts"), "term", "left")
    own = Window.partitionBy("window")
    return cut(known.withColumn("least", F.min(F.coalesce("n", F.lit(0))).over(own)).where("least > 0")
               .withColumn("rank", F.row_number().over(own.orderBy("n", "offset")))
               .select("window", "length", "offset", "term", "rank"), "ranked")


def _of_terms(index: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings of some terms."""
    return index.join(terms.select("term").distinct(), "term", "left_semi").select("d", "position", "term")


def phrase_matches(index: DataFrame, terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(d, window, length, start) of every exact occurrence of a window."""
    ranked = _ranked(index, terms, vocabulary)
    first = ranked.where("rank = 1")
    found = (index.select("d", "position", "term").join(first, "term")
             .select("d", "window", "length", (F.col("position") - F.col("offset")).alias("start")).where("start >= 0"))
    for rank in range(2, _RAREST + 1):
        term = ranked.where(f"rank = {rank}").select("window", "offset", "term")
        found = cut(found, "found")
        asked = found.join(term, "window").withColumn("position", F.col("start") + F.col("offset"))
        done = found.join(ranked.where(f"rank = {rank}").select("window"), "window", "left_anti")  # shorter windows
        found = (asked.join(_of_terms(index, term), ["d", "position", "term"], "left_semi")
                 .select("d", "window", "length", "start").unionByName(done))
    found = cut(found, "found")
    rest = ranked.where(f"rank > {_RAREST}").select("window", "offset", "term")
    asked = found.join(rest, "window").withColumn("position", F.col("start") + F.col("offset"))
    # Written, so that the choice between sending the documents or the postings rests on the exact size.
    hit = cut(found.select("d").distinct(), "hit")
    lists = index.where("term >= 0").join(hit, "d", "left_semi").select("d", "position", "term")
    met = (asked.join(lists, ["d", "position", "term"], "left_semi")
           .groupBy("d", "window", "length", "start").agg(F.count(F.lit(1)).alias("met"))
           .where(f"met = length - {_RAREST}").drop("met"))
    return cut(met.unionByName(found.where(f"length <= {_RAREST}")), "matches")


def proximity_matches(index: DataFrame, terms: DataFrame, vocabulary: DataFrame, slop: int, missing: int = 0) -> DataFrame:
    """(d, window, start) where the words of a window, all but ``missing`` of them, stand at most ``slop`` words from their places.

    ``start`` is where the window would begin by one of its ``missing + 1`` rarest
    words, one of which must occur; all others are looked for around it. Words in no
    document are missing ones. Of a repeated word no more places count than the text
    has words there. A window of no more than ``missing`` words may miss all but one.
    """
    counts = index.where("term >= 0").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("window").orderBy(F.coalesce("n", F.lit(0)), "offset")
    ranked = cut(terms.join(vocabulary, "word").join(cut(counts, "counts"), "term", "left")
                 .withColumn("rank", F.row_number().over(rarest)).select("window", "length", "offset", "term", "rank"), "ranked")
    begun = cut(index.select("d", "position", "term").join(ranked.where(F.col("rank") <= missing + 1), "term")
                .select("d", "window", "length", (F.col("position") - F.col("offset")).alias("start")).distinct(), "begun")
    # Written, so that the choice between sending the documents or the postings rests on the exact size.
    lists = index.where("term >= 0").join(cut(begun.select("d").distinct(), "hit"), "d", "left_semi")
    bin_of = lambda c: F.floor(c / F.lit(slop + 1))
    asked = (begun.join(ranked.select("window", "offset", "term"), "window").withColumn("place", F.col("start") + F.col("offset"))
             .withColumn("bin", F.explode(F.array(*[bin_of(F.col("place")) + s for s in (-1, 0, 1)]))))
    met = (asked.join(lists.select("d", "term", "position", bin_of(F.col("position")).alias("bin")), ["d", "term", "bin"])
           .where(F.abs(F.col("position") - F.col("place")) <= slop)
           .groupBy("d", "window", "length", "start", "term").agg(F.countDistinct("offset").alias("places"), F.countDistinct("position").alias("held")))
    return (met.groupBy("d", "window", "length", "start").agg(F.sum(F.least("places", "held")).alias("met"))
            .where(F.col("met") >= F.greatest(F.col("length") - missing, F.lit(1))).select("d", "window", "start"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, length: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", slop: int | None = None, missing: int = 0) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash.

    With ``slop`` also n_near_items and near: the items of windows found by ``proximity_matches``.
    """
    terms, items = benchmark_windows(benchmark, length, item_col, item_text_col)
    vocabulary = cut(terms.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "vocabulary")
    index = positional_index(docs, vocabulary, id_col, text_col)
    matches = phrase_matches(index, terms, vocabulary)

    covered = F.col("start") + F.col("length")
    before = F.max(covered).over(Window.partitionBy("d").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1))
    hits = (matches.select("d", "start", "length").distinct().withColumn("before", before)
            .groupBy("d").agg(F.sum(F.greatest(F.lit(0), covered - F.greatest("start", F.coalesce("before", F.lit(0))))).alias("n_hit")))
    met = (matches.select("d", "window").distinct().join(items, "window").select("d", "item").distinct()
           .groupBy("d").agg(F.array_sort(F.collect_set("item")).alias("items")))
    none = F.array().cast("array<string>")
    found = (index.where("term = -1").select("d", "doc_id", "text_hash", F.col("position").cast("long").alias("n_words"))
             .join(hits, "d", "left").join(met, "d", "left"))
    further = []
    if slop is not None:
        near = (proximity_matches(index, terms, vocabulary, slop, missing).select("d", "window").distinct().join(items, "window")
                .select("d", "item").distinct().groupBy("d").agg(F.count(F.lit(1)).alias("n_near")))
        found = found.join(near, "d", "left")
        n_near = F.coalesce("n_near", F.lit(0)).cast("long")
        further = [n_near.alias("n_near_items"), (n_near > 0).alias("near")]
    return (found
            .select(F.col("doc_id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size(F.coalesce("items", none)), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "text_hash", *further))
