"""The corpus pipeline: each stage is one operator over all that its predecessor kept.

Language identification, near duplicates, benchmark passages, mixing to target
weights, sharding. All stages but the last return the columns of documents;
the last one returns the shard table. Rows of an empty table give empty stages.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.llm import decontaminate, language, mixing, ngram_join, sharding
from wayfleet.llm.queries import SHARDS, TARGETS
from wayfleet.llm.ship import ship
from wayfleet.session import collected, cut, delete

NEAR_WORDS, NEAR_PERCENT = 5, 80
WINDOW = 10
_LEFT: list[str] = []       # tables that the result of the last stage rested on


def _stage(build):
    """A stage's result is written before the next stage is called: what it rested on goes then."""
    @functools.wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete(spark, _LEFT)
        _LEFT.clear()
        with collected() as paths:
            made = build(ship(spark), docs, sf_dir)
        _LEFT.extend(paths)
        return made
    return run_stage


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that no language explains: those without words and those unlike any of the languages."""
    found = language.identify_documents(docs, prefix="_lid_")
    return found.where("_lid_accepted").select(*docs.columns)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked texts, of the smallest id (null last); rows of one id are documents of their own.

    Rows equal in id and text are one document. Documents without words link with nothing and stay.
    """
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    groups = cut(ngram_join.jaccard_components(keyed, id_col="_key", n=NEAR_WORDS, percent=NEAR_PERCENT).select("_key", "component_id").distinct(), "groups")
    rows = keyed.groupBy("_key").agg(F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id")).alias("first"), (F.count(F.lit(1)) > 1).alias("repeated"))
    least = rows.join(groups, "_key").groupBy("component_id").agg(F.min(F.struct("first", "_key", "repeated")).alias("k"))
    kept = cut(least.select("k._key", "k.repeated"), "kept")
    out = keyed.join(kept.where("not repeated").select("_key"), "_key", "left_semi")
    again = kept.where("repeated").select("_key")
    if not again.isEmpty():
        out = out.unionByName(keyed.join(again, "_key", "left_semi").dropDuplicates(["_key"]))
    return out.select(*docs.columns)


@_stage
def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten words in a row of a benchmark item."""
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), length=WINDOW)
    bad = cut(found.where("contaminated").select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "contaminated")
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (F.xxhash64("text") == F.col("_bad_hash")), "left_anti")


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that tokens meet the targets by source, language and topic; values without a target keep their share, the scarcest cell is kept whole."""
    rows = docs.withColumns({"_mix_source": F.col("source"), "_mix_lang": F.col("lang"), "_mix_topic": mixing.register(F.col("text")),
                             "_mix_tokens": mixing.tokens(F.col("text"))})
    mixed = mixing.mix(rows, {f"_mix_{d}": shares for d, shares in TARGETS.items()}, weight_col="_mix_tokens", prefix="_mix_")
    return mixed.where("_mix_kept").select(*docs.columns)


@_stage
def deal_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every remaining document."""
    return sharding.shard_table(docs, {s: 1.0 for s in range(SHARDS)}, new_shard=SHARDS)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("mixing sources to target weights", mix_sources),
    ("sharding", deal_to_shards),
]

#: SQL cannot express the language and raking stages; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with collected() as written:
            docs = cut(stage(spark, docs, sf_dir), name.split()[0])
        delete(spark, before)
        before = written[-1:]
    return docs
