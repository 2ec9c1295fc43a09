"""N-gram join, decontamination and top-k search against brute force, and on awkward rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.fixtures import LOWER, awkward_documents, prose, with_clashing, words
from wayfleet.llm import decontaminate, ngram_join, topk

DOCS = "doc_id long, text string, lang string, source string"


def components(rows, n, percent):
    sets = {}
    for key, text, *_ in rows:
        w = words(text)
        if key is not None:
            sets[key] = frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]) and root(a) != root(b):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {k: (len(sets[k]), root(k)) for k in sets}


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (1, 60)])
def test_components_match_brute_force(spark, n, percent):
    rows = awkward_documents()
    df = with_clashing(spark.createDataFrame(rows, DOCS)).repartition(3)
    got = ngram_join.jaccard_components(df, n=n, percent=percent).collect()
    assert len(got) == len(rows)
    want = components(rows, n, percent)
    for r in got:
        assert r.doc_id is None and r.component_id is None or (r.n_shingles, r.component_id) == want[r.doc_id]


def test_many_near_copies_in_blocks(spark, monkeypatch):
    """A hot group of distinct near copies, far from its leaders too; buckets are split into several blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = random.Random(1)
    base = prose(rng, 120, 5000).split()
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(base[:70] + prose(rng, 20, 5000).split())) for i in range(40)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(rows, 4, 85)


def all_links(rows, n, percent):
    sets = {}
    for key, text, *_ in rows:
        w = words(text)
        if key is not None:
            sets[key] = frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()
    return sets, {(a, b) for a, b in itertools.combinations(sorted(sets), 2)
                  if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}


@pytest.mark.parametrize("block", [8, 512])
def test_every_link_is_returned(spark, monkeypatch, block):
    """Also those inside a component that is connected without them."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(12)
    rows = [(i, t) for i, t, *_ in awkward_documents()]
    base = prose(rng, 120, 5000).split()
    for i in range(40):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(w)))
    df = with_clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    sets, want = all_links(rows, 4, 85)
    pairs, classes = ngram_join.jaccard_links(df)
    rep, members = {}, {}
    for r in classes.collect():
        rep[r.id] = r.rep
        members.setdefault(r.rep, []).append(r.id)
    assert set(rep) == {k for k, s in sets.items() if s}
    got = [tuple(sorted(p)) for r in pairs.collect() for p in itertools.product(members[r.a], members[r.b])]
    got += [p for ids in members.values() for p in itertools.combinations(sorted(ids), 2)]
    assert len(got) == len(set(got)) and set(got) == want
    counts = {r.doc_id: r.n_links for r in ngram_join.link_counts(df).collect()}
    assert counts == {k: sum(k in p for p in want) for k in sets}
    assert ngram_join.link_counts(df.where("false")).collect() == []


def test_signatures_meet_for_every_linked_pair():
    """Whatever the sizes, two linked sets share a signature."""
    import numpy as np
    rng = np.random.default_rng(5)
    for size in [7, 8, 12, 20, 33, 60, 61, 150, 900]:
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
            drop = ngram_join.farthest(len(a), len(a), 85) // 2
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, drop, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both):
                assert len(np.intersect1d(ngram_join.signatures(a, 85), ngram_join.signatures(b, 85)))


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert ngram_join.jaccard_components(empty).collect() == []
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontaminate.decontaminate(empty, items).collect() == []
    none = items.where("false")
    assert [r.n_hit for r in decontaminate.decontaminate(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), none).collect()] == [0]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leaks(docs, items, length):
    found = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = {}
    for item, text in items:
        w = found(text)
        for s in range(max(1, len(w) - length + 1)) if w else ():
            windows.setdefault(tuple(w[s:s + length]), set()).add(str(item))
    out = []
    for key, text in docs:
        w, hit, met = found(text), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    met |= windows[tuple(w[s:s + n])]
        out.append((key, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return out


def test_decontaminate_matches_brute_force(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, n, 60)) for i, n in enumerate([30, 12, 10, 9, 3, 1, 40])] + [(7, None), (8, ""), (9, "one one one one"), (10, "W1, w2; w3."), (11, None)]
    items.append((12, items[0][1]))
    docs = [(i, prose(rng, 50, 60)) for i in range(30)]
    for i in range(30, 60):
        item = items[rng.randrange(5)][1].split()
        docs.append((i, f"{prose(rng, 5, 60)} {' - '.join(item[rng.randrange(3):]).upper()} {prose(rng, 9, 60)}"))
    docs += [(60, None), (61, ""), (None, items[0][1]), (62, "one ONE one one one"), (62, "one ONE one one one"), (63, items[2][1])]
    df = with_clashing(spark.createDataFrame(docs, "doc_id long, text string")).repartition(3)
    got = decontaminate.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"), length=10).drop("text_hash").collect()
    assert sorted(map(tuple, got), key=str) == sorted(leaks(docs, items, 10), key=str)


def test_proximity_finds_moved_words(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x alpha y beta gamma delta"), (2, "delta " + "z " * 30 + "alpha beta gamma"), (3, "alpha beta gamma delta")], "doc_id long, text string")
    terms, _ = decontaminate.benchmark_windows(items, 10)
    vocabulary = terms.select("word").distinct().rdd.map(lambda r: r[0]).collect()
    vocabulary = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(vocabulary))], "word string, term long")
    index = decontaminate.positional_index(docs, vocabulary)
    ids = {r.d: r.doc_id for r in index.select("d", "doc_id").distinct().collect()}
    assert {ids[r.d] for r in decontaminate.phrase_matches(index, terms, vocabulary).collect()} == {3}
    near = {ids[r.d] for r in decontaminate.proximity_matches(index, terms, vocabulary, slop=2).collect()}
    assert 1 in near and 3 in near


def test_proximity_looks_at_all_words(spark):
    passage = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, passage), (2, "echo echo echo")], "item_id long, text string")
    docs = [(1, passage), (2, "ten " + "z " * 30 + passage[:-4]), (3, passage.replace("three", "x three")),
            (4, passage.replace("four", "4")), (5, passage.replace("four", "4").replace("six", "6")), (6, "echo"), (7, None), (8, "one ten")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    near = lambda df, **more: {r.doc_id: r.n_near_items for r in decontaminate.decontaminate(df, items, slop=2, **more).collect()}
    assert near(docs) == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0}
    assert near(docs, missing=1) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 0, 6: 0, 7: 0, 8: 0}
    alone = docs.where("doc_id in (4, 5)")             # "four" is in no document
    assert near(alone) == {4: 0, 5: 0} and near(alone, missing=1) == {4: 1, 5: 0}
    exact = decontaminate.decontaminate(docs, items)
    both = decontaminate.decontaminate(docs, items, slop=2)
    assert both.columns == [*exact.columns, "n_near_items", "near"]
    assert sorted(map(tuple, both.select(*exact.columns).collect())) == sorted(map(tuple, exact.collect()))


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 16)
    monkeypatch.setattr(topk, "QUERIES", 2)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 7) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(5)] + [(250, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (350, [float("inf")] * 6),
             (None, [1.0] * 6), (400, [0.5, 0.25]), (450, [0.5, 1.0]), (500, [0.0] * 6), (50, [0.3] * 6), (550, [])]
    df = with_clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).repartition(3)
    got = sorted(tuple(r) for r in topk.top_k(df, k=5, every=50).collect())
    import math
    fit = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    want = []
    for q, (i, v) in enumerate(fit):
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for c, (j, w) in enumerate(fit) if c != q and len(w) == len(v))
            want += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:5])]
    assert got == sorted(want)
    assert topk.top_k(df.where("false")).collect() == []


@pytest.mark.parametrize("texts,size,vocabulary", [(5000, 6, 100_000), (500, 5000, 2_000_000)])
@pytest.mark.parametrize("n,percent", [(5, 80), (4, 85)])
def test_strangers_are_no_candidates(spark, texts, size, vocabulary, n, percent):
    """Texts that share nothing meet in next to no bucket, whatever their size."""
    from pyspark.sql import functions as F
    word = F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.col("i")), F.lit(vocabulary)).cast("string"))
    rows = (spark.range(0, texts, 1, 8).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(size)))).withColumn("w", word)
            .groupBy("id").agg(F.array_join(F.collect_list("w"), " ").alias("text")))
    _, _, member, _, live = ngram_join._candidates(rows, "id", "text", n, percent)
    alone = spark.createDataFrame([], "id long, component long")
    assert ngram_join._open_pairs(live, member, alone, percent, None).count() <= 10 * texts
    assert live.count() <= 10 * texts


def test_signatures_of_small_sets_are_never_empty():
    import numpy as np
    rng = np.random.default_rng(6)
    for percent in (60, 80, 85):
        for size in range(1, ngram_join.few(percent) + 1):
            sets = [np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64)) for _ in range(50)]
            found = [set(ngram_join.signatures(s, percent).tolist()) for s in sets]
            assert all(len(f) > 0 for f in found) and not any(a & b for a, b in itertools.combinations(found, 2))


def test_small_sets_meet_for_every_linked_pair():
    import numpy as np
    rng = np.random.default_rng(7)
    for percent in (60, 75, 80, 85, 95):
        for _ in range(400):
            both, more, less = rng.integers(1, 40), rng.integers(0, 6), rng.integers(0, 6)
            pool = np.unique(rng.integers(0, 1 << 63, both + more + less, dtype=np.uint64))
            rng.shuffle(pool)
            a, b = np.sort(pool[:both + more]), np.sort(np.concatenate([pool[:both], pool[both + more:]]))
            if 100 * both >= percent * (both + more + less):
                assert len(np.intersect1d(ngram_join.signatures(a, percent), ngram_join.signatures(b, percent)))


def test_similarities_below_a_half_are_refused(spark):
    with pytest.raises(ValueError, match="50 %"):
        ngram_join.jaccard_components(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), percent=40)


def test_blocks_are_compared_in_pieces_of_whole_runs():
    """Memory of a task follows a piece, not the batch; no run is in two pieces and the pairs are those of the whole batch."""
    lengths = [3, 1, 5, 30, 2, 2, 9, 700, 4]
    count = sum(lengths)
    sig = np.repeat(np.arange(len(lengths)), lengths)
    table = pa.table({"sig": sig, "left": np.zeros(count, np.int64), "right": np.zeros(count, np.int64)})
    pieces = list(ngram_join._pieces([table, table.slice(0, 4)], ["sig", "left", "right"], 40))
    assert [p.num_rows for p in pieces] == [39, 13, 700, 4, 4]
    assert pa.concat_tables(pieces).equals(pa.concat_tables([table, table.slice(0, 4)]))
    ids = np.arange(count) % 97
    words = np.zeros(count, np.int64)
    lists = lambda v: pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32), pa.array(v))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(sig), pa.array(np.zeros(count, np.int64)), pa.array(np.zeros(count, np.int64)), pa.array(np.zeros(count, np.int64)), pa.array(ids),
         pa.array(np.full(count, 50)), pa.array(ids), lists(words), lists((ids + 1) % 97)], ["sig", "left", "right", "block", "id", "n_shingles", "component", "small", "known"])
    got = {(a, b) for out in ngram_join._crossing(80, None, iter([batch])) for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist())}
    want, at = set(), 0
    for n in lengths:
        own = sorted(set(ids[at:at + n].tolist()))
        tested = {tuple(sorted((i, (i + 1) % 97))) for i in own}
        want |= {(a, b) for a in own for b in own if a < b} - tested
        at += n
    assert got == want
