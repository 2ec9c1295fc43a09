"""Toxicity by weak supervision.

Many weak voters look at each whole text: word lists, lists of words and word
beginnings that are mined from the training labels, patterns of disguised
spelling, repetition, density and emphasis. A generative label model (EM over the
voters' firing, class conditional) estimates how often each voter fires in toxic
and in clean texts, and from the correlations left inside the classes how much
voters repeat each other; correlated voters are damped. Its posteriors are
the soft labels of a linear classifier over voter counts, trained by Newton
steps whose sums are made per task and added in Spark. The given labels of the
training folds also set the share of toxic texts, the start of EM and the cut-off.
Every stem that passes ``LEAST_TEXTS``, ``LEAST_SHARE`` and ``LEAST_ODDS`` is mined. At most
1 / ``LEAST_SHARE`` times the mean number of stems of a toxic text can pass, however many texts there are.

Defined results: an empty or null text fires no voter and has a score; repeated rows
are scored one by one; without labels the share of toxic texts is ``PRIOR``;
further columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm import text as texts
from wayfleet.llm.held_out import remainder, sums, training_labels
from wayfleet.llm.quality import _lists, _matrix
from wayfleet.session import cut

FOLDS, LEFT_OUT = 5, 0
PRIOR = 0.1
EM_ROUNDS, NEWTON_ROUNDS = 12, 8
RIDGE = 1e-3

# Word lists of the voters: everyday insults and threats, by what they are aimed at.
LISTS = {
    "mind": "idiot idiots idiotic moron morons moronic imbecile imbeciles cretin dimwit halfwit",
    "stupid": "stupid stupidity dumb dumber dumbest brainless dense dunce fool fools foolish",
    "waste": "trash trashy garbage rubbish filth filthy",
    "scum": "scum scumbag scumbags vermin parasite parasites maggot maggots",
    "worth": "worthless useless good-for-nothing hopeless",
    "pity": "pathetic pitiful laughable lame",
    "loser": "loser losers failure nobody reject",
    "clown": "clown clowns joke buffoon jester",
    "disgust": "disgusting disgust revolting repulsive vile gross",
    "ugly": "ugly hideous fatso pig pigs swine",
    "threat": "kill murder strangle stab shoot hang drown",
    "harm": "hurt beat punch smash destroy burn",
    "hate": "hate hated hateful despise detest loathe",
    "curse": "damn damned hell crap crappy bastard bastards jerk jerks",
    "shut": "shutup silence getlost",
    "liar": "liar liars coward cowards traitor traitors creep creeps",
    "german": "dumm dummkopf idioten trottel abschaum versager widerlich wertlos blöd ekelhaft",
    "french": "crétin débile minable ordure déchet nul nulle dégoûtant imbéciles salaud",
    "spanish": "idiota estúpido estúpida basura patético inútil asqueroso imbécil tonto payaso",
}
#: Letters that digits and signs stand for in disguised words.
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
#: Bytes of the word beginnings that are mined; 0 is the whole word.
STEMS = (5, 6, 7, 0)
LEAST_ODDS, LEAST_TEXTS, LEAST_SHARE = 20.0, 4, 0.002
LABELS_TO_SEND = 500_000     # labelled rows up to which they are sent to the texts and not the texts to them
_VOTERS = [*LISTS, *(f"mined {n}" for n in STEMS), "disguised", "several", "repeated", "dense", "shouted"]
WIDTH = len(_VOTERS)

_LETTERS = np.ones(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = False
_LETTERS[ord("-")] = False
_SIGNS = _LETTERS.copy()
for _c in STANDS_FOR:
    _SIGNS[ord(_c)] = False
_PLAIN = texts.LOWER.copy()
for _c, _letter in STANDS_FOR.items():
    _PLAIN[ord(_c)] = ord(_letter)


@functools.cache
def _lexicon() -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes of all lists and the voter of each."""
    found = {}
    for voter, line in enumerate(LISTS.values()):
        for word in line.split():
            data = np.frombuffer(word.encode(), np.uint8)
            found[int(texts.word_hashes(data, np.array([0]), np.array([len(data)]))[0])] = voter
    keys = np.array(sorted(found), np.uint64)
    return keys, np.array([found[int(k)] for k in keys])


def _hits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are on a list, and whose."""
    keys, voters = _lexicon()
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == hashes)
    return hit, voters[at[hit]]


def _pieces(column: pa.Array):
    """(first row, end row, bytes, first byte of each text and the end, first byte and end of each word) of runs of texts."""
    data, at = texts.bytes_of(column)
    row = 0
    while row < len(column):
        end = min(max(row + 1, int(np.searchsorted(at, at[row] + 2 * texts.PIECE, "right")) - 1), len(column))
        piece, edges = data[at[row]:at[end]], at[row:end + 1] - at[row]
        yield row, end, piece, edges, *texts.words(piece, edges, _LETTERS)
        row = end


def _stems(piece: np.ndarray, s: np.ndarray, e: np.ndarray):
    """(which stem, words that have it, hashes) of the beginnings of words."""
    for k, n in enumerate(STEMS):
        long = np.flatnonzero(e - s > n) if n else np.arange(len(s))
        yield k, long, texts.word_hashes(piece, s[long], s[long] + n if n else e[long]) ^ np.uint64(k + 1)


Mined = tuple[np.ndarray, np.ndarray]     # sorted stem hashes, and which stem each is
NOTHING: Mined = (np.zeros(1, np.uint64), np.zeros(1, np.int64))


def votes(column: pa.Array, mined: Mined = NOTHING) -> np.ndarray:
    """How strongly each voter fires for each text: 0 for not, else 1 plus the log of its count."""
    out = np.zeros((len(column), WIDTH))
    lists, first = len(LISTS), len(LISTS) + len(STEMS)
    for row, end, piece, edges, s, e in _pieces(column):
        rows = end - row
        who = np.searchsorted(edges, s, "right") - 1
        hit, voter = _hits(texts.word_hashes(piece, s, e))
        counts = np.bincount(who[hit] * lists + voter, minlength=rows * lists).reshape(rows, lists)
        all_words = np.bincount(who, minlength=rows)
        shouted = np.bincount(who[hit], (piece[s[hit]] < 97) & (piece[e[hit] - 1] < 97), rows)
        for k, has, hashes in _stems(piece, s, e):
            found = np.isin(hashes, mined[0][mined[1] == k])
            out[row:end, lists + k] = np.bincount(who[has[found]], minlength=rows)
        ds, de = texts.words(piece, edges, _SIGNS)
        signs = np.concatenate([[0], np.cumsum(_LETTERS[piece] & ~_SIGNS[piece])])
        # Signs at the end of a word are punctuation; only those followed by a letter disguise one.
        while (trail := (de > ds + 1) & _LETTERS[piece[de - 1]]).any():
            de = de - trail
        odd = signs[de] > signs[ds]
        ds, de = ds[odd], de[odd]
        hidden, _ = _hits(texts.word_hashes(piece, ds, de, _PLAIN))
        disguised = np.bincount(np.searchsorted(edges, ds[hidden], "right") - 1, minlength=rows)
        total = counts.sum(axis=1) + disguised + out[row:end, lists:first].max(axis=1)
        out[row:end, :lists] = counts
        out[row:end, first] = disguised
        out[row:end, first + 1] = np.maximum((counts > 0).sum(axis=1) - 1, 0)
        out[row:end, first + 2] = np.maximum(counts.max(axis=1) - 1, 0)
        out[row:end, first + 3] = np.where(total * 100 >= np.maximum(all_words, 1), total, 0)
        out[row:end, first + 4] = shouted
    return np.where(out > 0, 1 + np.log(np.maximum(out, 1)), 0.0)


@texts.tidied
def _voted(mined: Mined, batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(votes(batch.column("text"), mined))], ["id", "x"])


def _text_stems(column: pa.Array, keep: np.ndarray | None = None):
    """(row, distinct stem hashes of the text, which stem each is)."""
    for row, end, piece, edges, s, e in _pieces(column):
        who, got = np.searchsorted(edges, s, "right") - 1, []
        for k, has, hashes in _stems(piece, s, e):
            if keep is not None:
                known = np.isin(hashes, keep)
                has, hashes = has[known], hashes[known]
            got.append(np.unique(np.stack([who[has].astype(np.uint64), hashes, np.full(len(has), k, np.uint64)]), axis=1))
        yield row, np.concatenate(got, axis=1)


@texts.tidied
def _toxic_stems(batches):
    """Stems of toxic texts with the number of texts, by task."""
    for batch in batches:
        for _, (_, hashes, kinds) in _text_stems(batch.column("text")):
            keys, at, n = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(kinds[at].astype(np.int32)), pa.array(n)], ["stem", "kind", "n"])


@texts.tidied
def _stem_counts(keys: np.ndarray, batches):
    """Texts with each of the stems ``keys``, by task; without those in no text."""
    held = np.zeros(len(keys), np.int64)
    for batch in batches:
        for _, (_, hashes, _) in _text_stems(batch.column("text"), keys):
            held += np.bincount(np.searchsorted(keys, hashes), minlength=len(keys))
    found = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(keys[found].view(np.int64)), pa.array(held[found])], ["stem", "n"])


def mine(plain: DataFrame, known: DataFrame) -> Mined:
    """Stems that are much commoner in toxic than in clean texts of the training folds."""
    labels = F.broadcast(known) if known.count() <= LABELS_TO_SEND else known
    sizes = {r["label"]: r["count"] for r in plain.select("id").join(labels, "id").groupBy("label").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    found = (plain.join(labels.where("label = 1"), "id").select("text").mapInArrow(_toxic_stems, "stem long, kind int, n long")
             .groupBy("stem", "kind").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= max(LEAST_TEXTS, LEAST_SHARE * n_toxic)).collect())   # bounded by the share
    if not found:
        return NOTHING
    keys, kinds, toxic = (np.array([r[c] for r in found]) for c in ("stem", "kind", "n"))
    order = np.argsort(keys.view(np.uint64))
    keys, kinds, toxic = keys.view(np.uint64)[order], kinds[order], toxic[order]
    clean = np.zeros(len(keys))
    counts = plain.join(labels.where("label = 0"), "id").select("text").mapInArrow(functools.partial(_stem_counts, keys), "stem long, n long")
    for stem, n in counts.groupBy("stem").agg(F.sum("n")).collect():
        clean[np.searchsorted(keys, np.uint64(stem % (1 << 64)))] = n
    kept = (toxic + 0.5) / (n_toxic + 1) / ((clean + 0.5) / (n_clean + 1)) >= LEAST_ODDS
    return (keys[kept], kinds[kept]) if kept.any() else NOTHING


class LabelModel:
    """Two classes; each voter fires with a probability of its own in each. ``damp`` weighs down voters that repeat others."""

    def __init__(self, prior: float) -> None:
        self.prior = min(max(prior, 1e-4), 0.5)
        self.fires = np.stack([np.full(WIDTH, 0.01), np.full(WIDTH, 0.3)])   # clean, toxic
        self.damp = np.ones(WIDTH)

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        on, off = np.log(self.fires), np.log1p(-self.fires)
        odds = np.log(self.prior / (1 - self.prior)) + (fired * (on[1] - on[0]) + (1 - fired) * (off[1] - off[0])) @ self.damp
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _expected(model: LabelModel, batches):
    """Per class: expected texts, firings and pairs of firings."""
    held = [np.zeros((WIDTH + 1, WIDTH + 1)) for _ in range(2)]
    for batch in batches:
        fired = (_matrix(batch.column("x")) > 0).astype(float) if batch.num_rows else np.zeros((0, WIDTH))
        p, own = model.posterior(fired), np.column_stack([np.ones(len(fired)), fired])
        for c, w in ((0, 1 - p), (1, p)):
            held[c] += (own * w[:, None]).T @ own
    for c in (0, 1):
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([held[c].reshape(-1)])], ["part", "values"])


def _by_label(batches):
    """Texts and firings by label."""
    held = np.zeros((2, WIDTH + 1))
    for batch in batches:
        fired, label = (_matrix(batch.column("x")) > 0).astype(float) if batch.num_rows else np.zeros((0, WIDTH)), batch.column("label").to_numpy()
        for c in (0, 1):
            held[c] += np.concatenate([[(label == c).sum()], fired[label == c].sum(axis=0)])
    for c in (0, 1):
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([held[c]])], ["part", "values"])


def fit_label_model(voted: DataFrame, prior: float, known: DataFrame) -> LabelModel:
    """EM for the firing probabilities from those of the known texts, then one look at the correlations inside the classes."""
    model = LabelModel(prior)
    seen = sums(known, _by_label)
    if seen:
        seen = [np.array(seen[c]) for c in (0, 1)]
        model.fires = np.clip(np.stack([(seen[c][1:] + (0.01, 0.3)[c]) / (seen[c][0] + 1) for c in (0, 1)]), 1e-6, 1 - 1e-6)
        model.fires[1] = np.maximum(model.fires[1], model.fires[0])
    for step in range(EM_ROUNDS + 1):
        got = sums(voted, functools.partial(_expected, model))
        m = [np.array(got[c]).reshape(WIDTH + 1, WIDTH + 1) for c in (0, 1)] if got else [np.zeros((WIDTH + 1, WIDTH + 1))] * 2
        n = [x[0, 0] for x in m]
        if step == EM_ROUNDS:
            break
        fresh = np.stack([(m[c][0, 1:] + (0.01, 0.3)[c]) / (n[c] + 1) for c in (0, 1)])
        fresh = np.clip(fresh, 1e-6, 1 - 1e-6)
        fresh[1] = np.maximum(fresh[1], fresh[0])     # a voter is for toxic texts or for nothing
        moved, model.fires = np.abs(np.log(fresh / model.fires)).max(), fresh
        if moved < 1e-4:
            break
    repeats = np.zeros((WIDTH, WIDTH))
    for c in (0, 1):
        rate = m[c][0, 1:] / max(n[c], 1e-9)
        own = m[c][1:, 1:] / max(n[c], 1e-9) - np.outer(rate, rate)
        spread = np.sqrt(np.maximum(np.diag(own), 1e-9))
        repeats = np.maximum(repeats, np.clip(own / np.outer(spread, spread), 0, 1))
    np.fill_diagonal(repeats, 0)
    model.damp = 1 / (1 + (repeats ** 2).sum(axis=1))
    return model


def _newton(model: LabelModel, weights: np.ndarray, batches):
    """Gradient and Hessian of the logistic loss against the posteriors."""
    grad, hess = np.zeros(WIDTH + 1), np.zeros((WIDTH + 1, WIDTH + 1))
    for batch in batches:
        x = _matrix(batch.column("x")) if batch.num_rows else np.zeros((0, WIDTH))
        own = np.column_stack([np.ones(len(x)), x])
        p = 1 / (1 + np.exp(-np.clip(own @ weights, -500, 500)))
        grad += own.T @ (p - model.posterior((x > 0).astype(float)))
        hess += (own * (p * (1 - p))[:, None]).T @ own
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([np.concatenate([grad, hess.reshape(-1)])])], ["part", "values"])


def fit_classifier(voted: DataFrame, model: LabelModel, rows: int) -> np.ndarray:
    """Weights of the linear classifier, the constant first."""
    weights = np.zeros(WIDTH + 1)
    weights[0] = np.log(model.prior / (1 - model.prior))
    if not rows:
        return weights
    for _ in range(NEWTON_ROUNDS):
        got = np.array(sums(voted, functools.partial(_newton, model, weights))[0])
        grad, hess = got[:WIDTH + 1] / rows, got[WIDTH + 1:].reshape(WIDTH + 1, -1) / rows
        ridge = RIDGE * np.eye(WIDTH + 1)
        ridge[0, 0] = 1e-9
        step = np.linalg.solve(hess + ridge, grad + ridge @ weights)
        weights = weights - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-4:
            break
    return weights


def _binned(weights: np.ndarray, batches):
    """Texts by label and by 400 steps of the classifier's odds."""
    held = np.zeros((2, 400))
    for batch in batches:
        odds = _odds(weights, batch)
        np.add.at(held, (batch.column("label").to_numpy(), np.clip((odds + 20) * 10, 0, 399).astype(int)), 1)
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([held.reshape(-1)])], ["part", "values"])


def _odds(weights: np.ndarray, batch) -> np.ndarray:
    return weights[0] + _matrix(batch.column("x")) @ weights[1:] if batch.num_rows else np.zeros(0)


def _scored(weights: np.ndarray, cutoff: float, batches):
    for batch in batches:
        score = 1 / (1 + np.exp(-np.clip(_odds(weights, batch) - cutoff, -500, 500)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(score)], ["id", "score"])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id_col, held_out, score, predicted) of every row of ``docs``."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    chosen = cut(training_labels(labels, label_col, FOLDS, LEFT_OUT, id_col), "labels")
    voted = cut(plain.mapInArrow(functools.partial(_voted, mine(plain, chosen)), "id long, x array<double>"), "votes")
    known = cut(voted.join(chosen, "id").select("x", "label"), "known")
    share = known.agg(F.avg("label")).first()[0]
    model = fit_label_model(voted.select("x"), PRIOR if share is None else share, known)
    weights = fit_classifier(voted.select("x"), model, voted.count())
    binned = np.array(sums(known, functools.partial(_binned, weights)).get(0, np.zeros(800))).reshape(2, 400)
    # The cut-off with the fewest errors on the training labels; of equal ones the middle of the widest run.
    errors = np.concatenate([[0], np.cumsum(binned[1])]) + binned[0].sum() - np.concatenate([[0], np.cumsum(binned[0])])
    best = np.flatnonzero(errors == errors.min())
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    widest = max(runs, key=len)
    cutoff = (widest[0] + widest[-1]) / 2 / 10 - 20 if binned.sum() else 0.0
    scored = voted.mapInArrow(functools.partial(_scored, weights, cutoff), "id long, score double")
    return scored.select(F.col("id").alias(id_col), (remainder(F.col("id"), FOLDS) == LEFT_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
