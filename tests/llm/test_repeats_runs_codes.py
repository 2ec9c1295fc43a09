"""Repeated windows, periodic runs and vector codes against brute force, and on awkward rows."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.fixtures import SPACED, awkward_documents, prose, with_clashing
from wayfleet.llm import codes, periodic, repeats
from wayfleet.llm.queries import planted_order

DOCS = "doc_id long, text string, lang string, source string"


def split(text):
    return SPACED.findall(text or "")


def without_repeats(rows, length):
    seen = Counter()
    for _, text, *_ in rows:
        w = split(text)
        seen.update(tuple(w[i:i + length]) for i in range(len(w) - length + 1))
    out = []
    for key, text, *_ in rows:
        w, gone = split(text), set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone |= set(range(i, i + length))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def passages(rng, docs=60):
    """Texts that share passages of many lengths at many places, within one text too."""
    shared = [prose(rng, n, 5000) for n in (5, 12, 34, 35, 36, 50, 90)]
    rows = []
    for i in range(docs):
        parts = [prose(rng, rng.randrange(1, 40), 5000) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(shared))
        if i % 9 == 0:
            parts.append(rng.choice(shared))
        rows.append((i, " ".join(parts), "en", "src0"))
    rows += [(900, "a " * 60, "en", None), (901, "a b " * 40, "en", None), (902, " ".join(["a"] * 35), "en", None), (903, "A " * 60, "en", None)]
    return rows


def test_covers_have_every_difference():
    for period, residues in repeats.COVERS.items():
        assert {(a - b) % period for a in residues for b in residues} == set(range(period))


@pytest.mark.parametrize("length", [1, 2, 6, 13, 35, 60])
def test_repeats_match_brute_force(spark, monkeypatch, length):
    monkeypatch.setattr(repeats, "CHUNK", 64)
    rows = passages(random.Random(4)) + awkward_documents()
    df = with_clashing(spark.createDataFrame(rows, DOCS)).repartition(3)
    got = repeats.remove_repeats(df, length=length).collect()
    assert sorted(map(tuple, got), key=str) == sorted(without_repeats(rows, length), key=str)


def test_copies_in_one_task_and_across(spark):
    rng = random.Random(5)
    text, other = prose(rng, 200), prose(rng, 80)
    rows = [(i, text) for i in range(50)] + [(100, other + " " + text[:600]), (101, other), (102, prose(rng, 34)), (103, None), (104, "")]
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert sorted(map(tuple, repeats.remove_repeats(df).collect())) == sorted(without_repeats(rows, 35))


def test_hot_anchors_leave_a_task_once():
    rows = repeats._Combiner()
    rows.add(np.array([5, 7, 5, 5], np.uint64), np.array([1, 1, 2, 3]), np.array([0, 1, 0, 0]))
    made = rows.flush().to_pylist()
    assert len(made) == 4 and sum(r["g"] == 5 and not r["spare"] for r in made) == 1
    assert {(r["ref"], r["sure"]) for r in made} == {(1, True), (1, False), (2, True), (3, True)}


def all_runs(words, exponent, shortest):
    n, found = len(words), []
    for start in range(n):
        for stop in range(start + shortest, n + 1):
            stretch = words[start:stop]
            q = next(q for q in range(1, len(stretch) + 1) if all(stretch[i] == stretch[i + q] for i in range(len(stretch) - q)))
            if len(stretch) < max(shortest, exponent * q):
                continue
            left = start > 0 and words[start - 1] == words[start - 1 + q]
            right = stop < n and words[stop] == words[stop - q]
            if not left and not right:
                found.append((start, stop - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, n, q in runs for i in range(start + q, start + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("exponent,shortest", [(4, 6), (3, 1)])
def test_runs_match_brute_force(spark, monkeypatch, exponent, shortest):
    monkeypatch.setattr(periodic, "PIECE_WORDS", 100)
    monkeypatch.setattr(periodic, "_PAIRS", 16)
    rng = random.Random(6)
    rows = []
    for i in range(120):
        w = []
        while len(w) < 45:
            unit = [f"u{rng.randrange(3)}" for _ in range(rng.randrange(1, 6))]
            w += unit * rng.randrange(1, 7) + unit[: rng.randrange(len(unit))]
        rows.append((i, " ".join(w[:60]), "en", "src0"))
    rows += [(500, "a " * 50, None, None), (501, "a b a b a b a b", None, None), (502, "a a a a a", None, None), (503, None, None, None),
             (504, "", None, None), (505, "A a A a A a a a", None, None), (None, "x " * 8, None, None), (501, "a b a b a b a b", None, None)]
    df = with_clashing(spark.createDataFrame(rows, DOCS)).repartition(3)
    got = periodic.periodic_runs(df, exponent=exponent, shortest=shortest).collect()
    want = []
    for key, text, *_ in rows:
        w = split(text)
        runs = all_runs(w, exponent, shortest)
        want.append((key, len(w), runs, collapsed(w, runs)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str) == sorted(want, key=str)


def test_runs_of_long_texts(spark):
    rng = random.Random(8)
    unit = [f"v{i}" for i in range(3000)]
    rows = [(1, " ".join(unit * 5 + ["end"])), (2, "w " * 200000), (3, prose(rng, 100000, 50)), (4, " ".join(["x", "y"] * 20000 + unit * 4))]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [(0, 15000, 3000)] and got[2] == [(0, 200000, 1)]
    assert got[4] == [(0, 40000, 2), (40000, 12000, 3000)]
    words = split(rows[2][1])
    for start, n, q in got[3]:
        assert n >= max(6, 4 * q) and words[start:start + n - q] == words[start + q:start + n]


def test_planted_order():
    hits = [k for k in range(3000) if planted_order(k, 50) is not None]
    assert 200 < len(hits) < 400 and planted_order(hits[0], 0) is None and planted_order(None, 9) is None
    for k in hits[:50]:
        h = __import__("zlib").crc32(str(k).encode())
        a, g = (h // 10) % 50, h // 10
        p = 1 + (50 - a) // (3 + g % 8)
        assert planted_order(k, 50).tolist() == [i if i < a else a + (i - a) % p for i in range(50)]


def quantised(rows, parts, entries, rounds, scale=4096):
    """(id, code, error, label) and codebooks in plain Python integers."""
    fit = [(i, [math.floor(scale * c) for c in v], label) for i, v, label in rows
           if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(fit[0][1])
    cuts = [(p * d // parts, (p + 1) * d // parts) for p in range(parts)]
    books = [[v[a:b] for _, v, _ in fit[:entries]] for a, b in cuts]

    def nearest(x, book):
        return min((sum((s - t) ** 2 for s, t in zip(x, entry)), e) for e, entry in enumerate(book))
    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            groups = {}
            for _, v, _ in fit:
                groups.setdefault(nearest(v[a:b], books[p])[1], []).append(v[a:b])
            books[p] = [[sum(c) // len(c) for c in zip(*groups[e])] if e in groups else book for e, book in enumerate(books[p])]
    out, errors = [], Counter()
    for i, v, label in fit:
        found = [nearest(v[a:b], books[p]) for p, (a, b) in enumerate(cuts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(far for far, _ in found), label))
        errors[label] += out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted(((i, code, error, errors[label], digest) for i, code, error, label in out), key=str)


VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("parts,entries,d", [(8, 16, 16), (3, 4, 7), (4, 1, 2)])
def test_codes_match_brute_force(spark, monkeypatch, parts, entries, d):
    monkeypatch.setattr(codes, "CELLS", 40 * d)
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(d)], rng.choice([0, 1, None])) for i in range(150)]
    rows += [(200 + i, [0.25] * d, 2) for i in range(20)]
    rows += [(3, [rng.random() for _ in range(d)], 1), (5, rows[5][1], rows[5][2]), (None, [0.5] * d, 1), (300, None, 1), (301, [None] + [0.5] * (d - 1), 1),
             (302, [float("nan")] * d, 1), (303, [float("inf")] * d, 0)]
    df = spark.createDataFrame(rows, VECTORS)
    df = df.selectExpr("*", *[f"'clash' as {c}" for c in ("id", "dim", "x", "code", "error", "of", "label_error", "part", "entry", "at")]).repartition(3)
    got = codes.encode_vectors(df, parts=parts, entries=entries).collect()
    assert sorted(map(tuple, got), key=str) == quantised(rows, parts, entries, 6)


def test_codes_of_odd_tables(spark):
    made = lambda rows: sorted(map(tuple, codes.encode_vectors(spark.createDataFrame(rows, VECTORS)).collect()), key=str)
    assert made([]) == [] and made([(1, None, 1)]) == []
    few = [(i, [i / 7] * 8, 0) for i in range(5)]
    assert made(few) == quantised(few, 8, 16, 6)
    mixed = made(few + [(9, [1.0, 2.0], 0), (10, [], 3)])
    assert len(mixed) == 7 and len({r[4] for r in mixed}) == 3 and {r[1] for r in mixed if r[0] == 10} == {"00" * 8}
    with pytest.raises(Exception, match="too large"):
        made([(1, [1e300] * 8, 0)])
