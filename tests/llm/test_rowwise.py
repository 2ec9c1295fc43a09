"""Conversations, sharding, mixing, language, quality, toxicity and language-model scores."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa

from tests.llm.fixtures import awkward_documents, fold, prose, with_clashing, words
from wayfleet.llm import conversations, kneser_ney, language, mixing, quality, sharding, toxicity

DOCS = "doc_id long, text string, lang string, source string"


def docs(spark):
    return with_clashing(spark.createDataFrame(awkward_documents(), DOCS)).repartition(3)


def test_snapshots_collapse(spark):
    talk = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    rows = []
    for conv, turns in {1: talk[:2], 2: talk, 3: talk, 4: talk[:3] + [("assistant", "e")], 5: [("user", "b")], 6: [(None, None)], 7: [("user", "")], 8: talk[1:]}.items():
        rows += [(conv, i, *t) for i, t in enumerate(turns)]
    rows += [(9, None, "system", "s"), (9, 0, "user", "z"), (9, 0, "user", "y"), (None, 0, "user", "a")]
    df = with_clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(3)
    got = {r.conv_id: (r.n_turns, r.n_copies, r.chat) for r in conversations.collapse_and_render(df).collect()}
    assert set(got) == {2, 4, 5, 6, 8, 9}           # 1 begins 2, 3 equals 2, 7 equals 6
    assert got[2][:2] == (4, 2) and got[6] == (1, 2, "<|im_start|>user\n<|im_end|>")
    assert got[9][2] == "\n".join(f"<|im_start|>{r}\n{t}<|im_end|>" for r, t in [("system", "s"), ("user", "y"), ("user", "z")])
    assert conversations.collapse_and_render(df.where("false")).collect() == []


def test_shards(spark):
    df = docs(spark).unionByName(spark.range(1000, 3000).selectExpr("id as doc_id", "string(id) as text"), allowMissingColumns=True)
    weights = {s: 1.0 + (s == 3) for s in range(8)}
    got = sharding.shard_table(df, weights, new_shard=8).collect()
    assert len(got) == df.count()
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 1.5 < len(slots[3]) / np.mean([len(slots[s]) for s in range(8) if s != 3]) < 2.6
    again = {r.doc_id: r.shard for r in sharding.shard_table(df, weights | {8: 1.0}).collect()}
    assert all(again[r.doc_id] == r.grown_shard for r in got)
    texts = {(i, t) for i, t, *_ in awkward_documents()}
    by = {(r.doc_id, r.size, r.text_crc32) for r in got}
    assert all((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) in by for i, t in texts)
    assert sharding.shard_table(df.where("false"), weights, new_shard=8).collect() == []


def test_raking_meets_the_marginals(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice(["x", "y"]), rng.randrange(1, 50)) for i in range(20000)] + [(None, "a", "x", None)]
    df = with_clashing(spark.createDataFrame(rows, "doc_id long, source string, lang string, tokens long").drop("weight"))
    targets = {"source": {"a": 0.3, "b": 0.5, "other": 0.2}, "lang": {"x": 0.7, "y": 0.3}}
    got = mixing.mix(df.drop("weight", "probability", "kept"), targets).collect()
    assert len(got) == len(rows)
    for col in targets:
        value = lambda r: (r[col] or "other") if col == "source" else r[col]  # noqa: B023, E731
        whole, drawn = collections.Counter(), collections.Counter()
        for r in got:
            whole[value(r)] += r.weight * (r.tokens or 0)
            drawn[value(r)] += (r.tokens or 0) * r.kept
        for v, share in targets[col].items():
            assert abs(whole[v] / sum(whole.values()) - share) < 1e-6
            assert abs(drawn[v] / sum(drawn.values()) - share) < 0.03
    assert mixing.mix(df.where("false").drop("weight", "probability", "kept"), targets).collect() == []


def test_values_without_a_target_are_sampled(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "hot", None]), rng.choice(["x", "y", None]), rng.choice([None, "elsewhere"]), 1) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.8, "b": 0.2}, "lang": {"x": 0.5, "y": 0.5}, "topic": {"t": 1.0}}      # no row of topic t
    got = mixing.mix(df, targets).collect()
    assert len(got) == len(rows) and all(r.probability > 0 for r in got)
    whole = collections.Counter()
    for r in got:
        whole[r.source] += r.weight
    rest = sum(r.source not in ("a", "b") for r in got) / len(got)
    total = sum(whole.values())
    assert abs((whole["hot"] + whole[None]) / total - rest) < 1e-6
    assert abs(whole["a"] / total - 0.8 * (1 - rest)) < 1e-6 and abs(whole["b"] / total - 0.2 * (1 - rest)) < 1e-6
    assert {r.source for r in got if r.kept} == {"a", "b", "hot", None} and {r.lang for r in got if r.kept} == {"x", "y", None}


def test_raking_matches_plain_fitting():
    rng = np.random.default_rng(0)
    totals = rng.random((3, 4, 2)) * 10
    margins = [np.array([5.0, 3, 2]), np.array([1.0, 2, 3, 4]), np.array([6.0, 4])]
    fitted = mixing.rake(totals, margins)
    for axis, m in enumerate(margins):
        assert np.allclose(fitted.sum(axis=tuple(a for a in range(3) if a != axis)), m)
    ratio = np.log(fitted / totals)           # the factors are a product over the axes
    assert np.allclose(ratio - ratio[:1] - ratio[:, :1] + ratio[:1, :1], (ratio - ratio[:1] - ratio[:, :1] + ratio[:1, :1])[:, :, :1])


def sentence(rng, lang, n):
    common = {"en": "the of and that with this from have were which their", "de": "der die und nicht eine schon über zwischen auch werden", "es": "el los que para una con sobre también porque", "fr": "le les des que pour une avec dans être cette"}[lang].split()
    return " ".join(rng.choice(common) for _ in range(n))


def test_language_fuses_evidence(spark):
    rng = random.Random(6)
    train = spark.createDataFrame([(sentence(rng, lang, 80), lang) for lang in language.LANGUAGES for _ in range(30)], "text string, lang string")
    rows = []
    for i in range(200):
        lang = language.LANGUAGES[i % 4]
        rows.append((i, f"http://host{i % 4}.example.{'com' if i % 4 == 1 else lang}/x", f'<html lang="{lang}"><script>the of and</script><p>{sentence(rng, lang, 40)}</p></html>'))
    rows += [(200, "http://host0.example.de/", "<html><p>ok</p></html>"), (201, None, None), (202, "not an address", ""),
             (203, "http://host1.example.com", f'<html lang="fr"><b>{sentence(rng, "en", 200)}</b></html>'), (0, rows[0][1], rows[0][2])]
    df = with_clashing(spark.createDataFrame(rows, "page_id long, url string, html string")).repartition(3)
    got = collections.defaultdict(list)
    for r in language.identify_pages(spark, df, train).collect():
        got[r.page_id].append(r)
    assert sum(map(len, got.values())) == len(rows) and len(got[0]) == 2
    assert all(got[i][0].language == language.LANGUAGES[i % 4] and got[i][0].accepted for i in range(200))
    assert got[200][0].language == "de"                     # two letters; the host and the address decide
    assert not got[201][0].accepted and not got[202][0].accepted
    assert got[203][0].language == "en"                      # a long text outweighs its markup
    assert language.identify_pages(spark, df.where("false"), train.where("false")).collect() == []


def test_declared_languages_get_classes_and_clean_documents_stay(spark):
    rng = random.Random(7)
    finnish = "ja on ei se että hän oli mutta kuin tämä joka niin myös kun".split()
    rows = [(i, sentence(rng, lang, 40), lang, "src0") for i, lang in enumerate(lang for lang in language.LANGUAGES for _ in range(40))]
    rows += [(1000 + i, " ".join(rng.choice(finnish) for _ in range(40)), "fi" if i % 2 else "fi-FI", "src1") for i in range(40)]
    rows += [(2000 + i, sentence(rng, "en", 40), "xx", "src0") for i in range(language.LEAST_DECLARED - 1)]
    rows += [(3000 + i, sentence(rng, "en", 40), "und", "src0") for i in range(30)] + [(4000, " ".join(rng.choice(finnish) for _ in range(60)), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    assert language.declared_languages(df) == ("de", "en", "es", "fi", "fr")
    assert language.declared_languages(df.where("false")) == language.LANGUAGES
    got = {r.doc_id: r for r in language.identify_documents(df, prefix="_lid_").collect()}
    assert all(r._lid_accepted for r in got.values())
    assert all(got[i]._lid_language == "fi" for i in [*range(1000, 1040), 4000])
    assert all(got[i]._lid_language == "en" for i in [*range(2000, 2000 + language.LEAST_DECLARED - 1), *range(3000, 3030)])


def test_documents_keep_their_columns(spark):
    df = docs(spark)
    found = language.identify_documents(df, prefix="_lid_")
    assert found.count() == len(awkward_documents())
    assert found.select(*df.columns).columns == df.columns


def test_quality_held_out(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        good = rng.random() < 0.7
        text = ". ".join(prose(rng, rng.randrange(5, 15)) for _ in range(rng.randrange(2, 10))) if good else rng.choice(
            [" | ".join(prose(rng, 1) for _ in range(60)), "BUY!! NOW!! " * 30, "same " * rng.randrange(20, 200)])
        rows.append((i, text))
        labels.append((i, int(good)))
    labels += [(None, 1), (5, None), (6, 7), (99999, 0)]
    rows += [(2000, None), (2001, ""), (None, "x"), (3, rows[3][1])]
    df = with_clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.score_quality(df, lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert all(r.held_out == (r.doc_id is not None and fold(r.doc_id, 3) == 1) for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert len(quality.score_quality(df, lab.where("false")).collect()) == len(rows)
    assert quality.score_quality(df.where("false"), lab).collect() == []


def test_quality_statistics_do_not_depend_on_neighbours():
    texts = [t for _, t, *_ in awkward_documents()]
    together = quality.statistics(pa.array(texts))
    alone = np.concatenate([quality.statistics(pa.array([t])) if t is not None else quality.statistics(pa.array([""])) for t in texts])
    assert np.allclose(together, alone)


def test_toxicity_held_out(spark):
    rng = random.Random(9)
    insults = ["idiot", "Moron!", "scum", "tr4sh", "worthless", "zarkvolk", "zarkvoland"]      # the last two only the labels know
    rows, labels = [], []
    for i in range(1200):
        toxic = rng.random() < 0.15
        w = prose(rng, rng.randrange(20, 80)).split()
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(insults))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(3000, None), (3001, ""), (None, "idiot"), (3, rows[3][1])]
    df = with_clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    lab = spark.createDataFrame(labels + [(None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(df, lab).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1200]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert len(toxicity.score_toxicity(df, lab.where("false")).collect()) == len(rows)
    assert toxicity.score_toxicity(df.where("false"), lab).collect() == []


def test_rare_toxic_stems_are_mined_beside_many_frequent_ones(spark):
    """28,000 ordinary stems are in every text; the insult is in eight of the twenty toxic ones."""
    rng = random.Random(13)
    common = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(7000))
    plain = spark.createDataFrame([(i, common + (" zarkvolk" if i < 8 else "")) for i in range(80)], "id long, text string").repartition(4)
    known = spark.createDataFrame([(i, int(i < 20)) for i in range(80)], "id long, label int")
    keys, kinds = toxicity.mine(plain, known)
    assert sorted(kinds) == [0, 1, 2, 3] and (np.diff(keys.astype(float)) > 0).all()
    found = toxicity.votes(pa.array(["zarkvolk", common]), (keys, kinds))[:, len(toxicity.LISTS):len(toxicity.LISTS) + len(toxicity.STEMS)]
    assert found[0].all() and not found[1].any()


def test_disguised_words_are_votes():
    found = toxicity.votes(pa.array(["you id10t", "you idiot!", "nothing here", None]))
    first = len(toxicity.LISTS) + len(toxicity.STEMS)
    assert found[0, first] > 0 and found[1, first] == 0 and found[1, 0] > 0 and not found[2:].any()


def brute_scores(rows):
    tokens = [(k, [*words(t), None]) for k, t in rows]
    single, pair = collections.Counter(), collections.Counter()
    for k, w in tokens:
        if k is None or fold(k, 7) != 2:
            single.update(w)
            pair.update(zip([0, *w[:-1]], w))
    n, v, kinds = sum(single.values()), len(single), collections.Counter(pair.values())
    take = kneser_ney.discounts(*[kinds[i] for i in (1, 2, 3, 4)])
    after = collections.Counter(w for _, w in pair)
    kinds = collections.Counter(after.values())
    less = kneser_ney.discounts(*[kinds[i] for i in (1, 2, 3, 4)])
    left = sum(less[min(c, 3) - 1] for c in after.values()) / max(len(pair), 1) if pair else 1.0
    total, gives = collections.Counter(), collections.Counter()
    for (a, _), c in pair.items():
        total[a] += c
        gives[a] += take[min(c, 3) - 1]

    def p(a, w):
        low = left / (v + 1) + (max(after[w] - less[min(after[w], 3) - 1], 0) / len(pair) if after[w] else 0)
        c = pair[a, w]
        return low if not total[a] else ((max(c - take[min(c, 3) - 1], 0) if c else 0) + gives[a] * low) / total[a]
    return [(k, len(w), sum(single[x] > 0 for x in w), n, sum(math.log10((single[x] + 1) / (n + v + 1)) for x in w),
             sum(math.log10(p(a, x)) for a, x in zip([0, *w[:-1]], w))) for k, w in tokens]


def test_kneser_ney_matches_brute_force(spark, monkeypatch):
    rows = [(k, t) for k, t, *_ in awkward_documents()] + [(100 + i, prose(random.Random(i), 40, 90) + " the") for i in range(60)]
    df = with_clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    for tokens in (kneser_ney.SHARD_TOKENS, 500):       # one shard; many shards and words with contexts spread over all
        monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", tokens)
        got = kneser_ney.score_held_out(df).collect()
        key = lambda r: (str(r[0]), r[1], r[-1])
        got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=key)
        for a, b in zip(got, sorted(brute_scores(rows), key=key), strict=True):
            assert a[:4] == b[:4] and math.isclose(a[4], b[4], abs_tol=1e-6) and math.isclose(a[5], b[5], abs_tol=1e-6)
    assert kneser_ney.score_held_out(df.where("false")).collect() == []


def test_many_equal_rows_take_consecutive_slots(spark, monkeypatch):
    """A third of the table is one row, without id and text; slots have no gaps, and the hot rows come from several pieces."""
    from wayfleet.llm import sharding
    monkeypatch.setattr(sharding, "EQUAL_ROWS", 7)
    rows = [(None, None)] * 60 + [(5, "same")] * 30 + [(i, f"text {i % 9}") for i in range(100)] + [(5, "other"), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sharding.shard_table(df, {s: 1.0 for s in range(4)}, new_shard=4).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((k is None, k or 0, len((t or "").encode()) + 16) for k, t in rows)
    for shard in range(4):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in got if r.doc_id is None}) == 1
