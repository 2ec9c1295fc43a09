"""The pipeline on a small table of its own, stage by stage."""

import random

import corpus_pipeline
from tests.llm.fixtures import prose
from tests.llm.test_pairs_and_search import components, leaks

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    rng = random.Random(11)
    items = [(i, prose(rng, 25, 4000)) for i in range(5)]
    rows = []
    for i in range(150):
        text = prose(rng, rng.randrange(20, 120), 4000)
        if i % 10 == 1:
            text = rows[-1][1] + " end"
        if i % 15 == 2:
            text = f"{text} {items[i % 5][1]}"
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["src0", "src1", "elsewhere"]), len(text)))
    rows += [(900, None, "en", "src0", None), (901, " ", "en", "src0", 1), (902, rows[0][1], "en", "src0", 5)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language ID" and len(corpus_pipeline.STAGES) == 5
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert made.columns == docs.columns
        made.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        seen.append(docs.collect())
    ids = [{r.doc_id for r in stage} for stage in seen]
    assert ids[0] == set(range(150)) | {902}
    want = components([(r.doc_id, r.text) for r in seen[0]], 5, 80)
    assert ids[1] == {c for _, c in want.values()}
    assert ids[2] == {key for key, *_, bad in leaks([(r.doc_id, r.text) for r in seen[1]], items, 10) if not bad}
    assert ids[3] <= ids[2] and ids[3] and ids[4] == ids[3] and len(seen[4]) == len(seen[3])
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, seen[4]))


def test_near_duplicate_stage_takes_awkward_rows(spark):
    """Repeated ids with other texts, rows without id, copies in id and text, clashing names, an empty table, a very long text."""
    from tests.llm.fixtures import with_clashing
    rng = random.Random(13)
    a, b, long = prose(rng, 60, 4000), prose(rng, 60, 4000), prose(rng, 30000, 4000)
    rows = [(1, a), (1, b), (2, a + " end"), (3, long), (4, long + " end"), (None, b), (None, prose(rng, 50, 4000)), (5, None), (6, ""),
            (7, "one two"), (7, "one two"), (7, "one two")]
    docs = with_clashing(spark.createDataFrame([(*r, "en", "src0", 1) for r in rows], DOCS)).repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (3, long), rows[6], (5, None), (6, ""), (7, "one two")], key=str)
    assert corpus_pipeline.drop_near_duplicates(spark, docs.where("false"), "").collect() == []


def test_values_without_a_target_keep_their_share(spark, tmp_path):
    rng = random.Random(14)
    rows = [(i, prose(rng, 40), rng.choice(["en", "de", "it", None]), rng.choice(["src0", "src1", "else", None]), 1) for i in range(400)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    from wayfleet.llm import queries
    got = queries.mixed_sources(spark, str(tmp_path)).collect()
    assert len(got) == 400 and all(r.probability > 0 for r in got)
    assert {r.lang for r in got if r.kept} == {"en", "de", "it", None}
