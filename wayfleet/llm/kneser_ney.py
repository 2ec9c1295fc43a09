"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, mapped by the tasks that score.

Words are 64-bit hashes; the sorted array of all hashes gives each word its
number. Bigram counts are combined per task, dealt out by ranges of the
context's number and written, one shard a task, as sorted arrays to the shared
folder. A context with more than a quarter of a shard's tokens is spread over
all shards by its pairs; there are at most four of those per shard, so their
totals are the only counts that come to the driver. Scoring tasks map the
arrays and search them; nothing is loaded as a whole and no array passes
through the driver. A lost task writes the same file again under the same name.

``spark.checkpoint.dir`` must be a folder that all machines have mounted, as
arrays are mapped from files.

Defined results: a null text is empty; an empty text has its end as its only
token; unknown words share the probability left for one unseen word; repeated
rows count as often as they occur; an empty training set leaves
the uniform model; further columns are ignored.
"""

from __future__ import annotations

import functools
import os
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.llm import text as texts
from wayfleet.llm.held_out import remainder
from wayfleet.session import cut, scratch_dir

FOLDS, LEFT_OUT = 7, 2
SHARD_TOKENS = 2_000_000     # training tokens for which one shard is made
_END = np.uint64(0x5EED0FE17D0FD0C5)     # stands for the end of a text
_LOW = np.int64(0xFFFFFFFF)


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the shared one, as a path that every machine can open."""
    place = urlparse(scratch_dir(spark))
    if place.scheme not in ("", "file"):
        raise RuntimeError("the arrays of the model are mapped from files: spark.checkpoint.dir must be a mounted folder")
    return os.path.join(place.path, "wayfleet", f"kneser-ney-{uuid.uuid4().hex}")


def _save(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array under its final name in one step; a repeated task replaces it by the same."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f".{name}-{uuid.uuid4().hex}.npy")
    np.save(path, values)
    os.replace(path, os.path.join(folder, f"{name}.npy"))


def _token_runs(column: pa.Array):
    """(first row, end row, hashes with an end after each text, first token of each text and the end)."""
    for row, end, hashes, at in texts.documents(column):
        ends = at[1:] + np.arange(end - row)
        out = np.empty(len(hashes) + end - row, np.uint64)
        words = np.ones(len(out), bool)
        words[ends] = False
        out[words], out[ends] = hashes, _END
        yield row, end, out.view(np.int64), np.concatenate([[0], ends + 1])


def _counted(arrays, at_once: int = 4_000_000):
    """Distinct values with their counts, for about ``at_once`` values at a time."""
    held, size = [], 0
    for values in arrays:
        held.append(values)
        size += len(values)
        if size >= at_once:
            yield np.unique(np.concatenate(held), return_counts=True)
            held, size = [], 0
    if held:
        yield np.unique(np.concatenate(held), return_counts=True)


@texts.tidied
def _unigrams(batches):
    for words, n in _counted(run[2] for batch in batches for run in _token_runs(batch.column("text"))):
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(n)], ["word", "n"])


@texts.tidied
def _write_words(folder: str, batches):
    """The sorted hashes and counts of the parts dealt to this task; their sizes go on."""
    parts: dict[int, list] = {}
    for batch in batches:
        part = batch.column("part").to_numpy()
        for p in np.unique(part):
            parts.setdefault(int(p), []).append((batch.column("word").to_numpy()[part == p], batch.column("n").to_numpy()[part == p]))
    for p, found in parts.items():
        words, n = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        order = np.argsort(words)
        _save(folder, f"word-{p}", words[order])
        _save(folder, f"count-{p}", n[order])
        yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([len(words)]), pa.array([int(n.sum())])], ["part", "words", "tokens"])


class Words:
    """The numbers of words, by search in the mapped arrays."""

    def __init__(self, folder: str, bits: int, sizes: dict[int, int], tokens: int) -> None:
        self.folder, self.bits, self.tokens = folder, bits, tokens
        self.first = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(1 << bits)])]).astype(np.int64)
        self.size = int(self.first[-1])
        self.maps: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"maps": {}}

    def mapped(self, name: str) -> np.ndarray:
        if name not in self.maps:
            self.maps[name] = np.load(os.path.join(self.folder, f"{name}.npy"), mmap_mode="r")
        return self.maps[name]

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, training count) of sorted hashes."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        edges = [-(1 << 63) + (p << (64 - self.bits)) for p in range(1, 1 << self.bits)]
        cuts = np.concatenate([[0], np.searchsorted(hashes, np.array(edges, np.int64)), [len(hashes)]])
        for p in range(1 << self.bits):
            low, high = cuts[p], cuts[p + 1]
            if low < high and self.first[p] < self.first[p + 1]:
                keys = self.mapped(f"word-{p}")
                at = np.minimum(np.searchsorted(keys, hashes[low:high]), len(keys) - 1)
                hit = keys[at] == hashes[low:high]
                number[low:high][hit] = self.first[p] + at[hit]
                count[low:high][hit] = self.mapped(f"count-{p}")[at[hit]]
        return number, count


def _numbered(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds, back = np.unique(hashes, return_inverse=True)
    number, count = words.numbers(kinds)
    return number[back], count[back]


def _contexts(number: np.ndarray, at: np.ndarray, start: int) -> np.ndarray:
    """The number before each token; ``start`` before the first of a text."""
    before = np.empty(len(number), np.int64)
    before[1:] = number[:-1]
    before[at[:-1]] = start
    return before


class Deal:
    """Which shard a pair belongs to."""

    def __init__(self, shards: int, size: int, hot: np.ndarray) -> None:
        self.shards, self.size, self.hot = shards, max(size, 1), np.sort(hot)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        before = keys >> 32
        shard = before * self.shards // self.size
        spread = np.isin(before, self.hot)
        shard[spread] = (texts.mix(keys[spread].view(np.uint64)) % np.uint64(self.shards)).astype(np.int64)
        return np.minimum(shard, self.shards - 1)


@texts.tidied
def _bigrams(words: Words, deal: Deal, batches):
    """Pairs with their counts, combined some millions at a time; key = number of the context and of the word."""
    def pairs():
        for batch in batches:
            for _, _, hashes, at in _token_runs(batch.column("text")):
                number, _ = _numbered(words, hashes)
                yield (_contexts(number, at, words.size) << 32) | number

    for keys, n in _counted(pairs()):
        for low in range(0, len(keys), 1 << 18):
            part = keys[low:low + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(deal(part).astype(np.int32)), pa.array(part), pa.array(n[low:low + (1 << 18)])], ["shard", "key", "n"])


_PAIR_ROWS = "kind int, id long, a long, b long, c long, d long"
_FOLLOWED, _HOT, _FILE = range(3)


@texts.tidied
def _write_pairs(folder: str, deal: Deal, batches):
    """Write a shard's arrays; yield how many contexts each word follows, hot contexts' shares and counts of counts."""
    shards: dict[int, list] = {}
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        for s in np.unique(shard):
            own = shard == s
            shards.setdefault(int(s), []).append((batch.column("key").to_numpy()[own], batch.column("n").to_numpy()[own]))

    def rows(kind, *columns):
        columns = [np.asarray(c, np.int64) for c in columns]
        columns += [np.zeros(len(columns[0]), np.int64)] * (5 - len(columns))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32)), *map(pa.array, columns)], ["kind", "id", "a", "b", "c", "d"])

    for s in list(shards):
        found = shards.pop(s)
        keys, n = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        n, keys = np.add.reduceat(n, first), keys[first]
        before, starts = np.unique(keys >> 32, return_index=True)
        stats = np.stack([np.add.reduceat(x.astype(np.int64), starts) for x in (n, n == 1, n == 2, n >= 3)], axis=1)
        _save(folder, f"key-{s}", keys)
        _save(folder, f"n-{s}", n.astype(np.min_scalar_type(int(n.max()))))
        _save(folder, f"context-{s}", before)
        _save(folder, f"stats-{s}", stats)
        after, contexts = np.unique(keys & _LOW, return_counts=True)
        for low in range(0, len(after), 1 << 18):
            yield rows(_FOLLOWED, after[low:low + (1 << 18)], contexts[low:low + (1 << 18)])
        hot = np.isin(before, deal.hot)
        if hot.any():
            yield rows(_HOT, before[hot], *stats[hot].T)
        yield rows(_FILE, [s], *[[int((n == k).sum())] for k in (1, 2, 3, 4)])


@texts.tidied
def _write_followed(folder: str, size: int, chunk: int, batches):
    """Dense arrays of how many contexts a word follows, by ranges of word numbers."""
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        part, number, n = (batch.column(c).to_numpy() for c in ("part", "id", "n"))
        for p in np.unique(part):
            held = parts.setdefault(int(p), np.zeros(min(chunk, size - int(p) * chunk), np.int64))
            held[number[part == p] - p * chunk] = n[part == p]
    for p, held in parts.items():
        _save(folder, f"followed-{p}", held)
        yield pa.RecordBatch.from_arrays([pa.array([p])], ["part"])


def discounts(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """What counts of 1, 2 and 3 or more give away."""
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    return np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.05, [0.95, 1.95, 2.95])


class Model:
    """The mapped model. All arrays stay in files; the object holds sizes, discounts and the totals of hot contexts."""

    def __init__(self, words: Words, deal: Deal, shards: set[int], chunk: int, pair: np.ndarray, single: np.ndarray,
                 pairs: int, left: float, hot: dict[int, tuple[int, int, int, int]]) -> None:
        self.words, self.deal, self.shards, self.chunk = words, deal, shards, chunk
        self.pair, self.single, self.pairs, self.left = pair, single, pairs, left
        self.hot = np.array(sorted(hot), np.int64)
        self.hot_stats = np.array([hot[h] for h in sorted(hot)], np.int64).reshape(-1, 4)

    def alone(self, number: np.ndarray) -> np.ndarray:
        """Probability of a word by the number of contexts it follows."""
        unseen = self.left / (self.words.size + 1)
        out = np.full(len(number), unseen)
        part = np.where(number >= 0, number // self.chunk, -1)
        for p in np.unique(part[part >= 0]):
            own = part == p
            n = self.words.mapped(f"followed-{p}")[number[own] - p * self.chunk]
            out[own] += np.maximum(n - self.single[np.clip(n, 1, 3) - 1], 0) / self.pairs
        return out

    def probability(self, before: np.ndarray, number: np.ndarray) -> np.ndarray:
        """P(word | context); both sorted as one key, -1 for unknown."""
        low = self.alone(number)
        total, gives, have = np.zeros(len(number)), np.zeros(len(number)), np.zeros(len(number))
        keys = (before << 32) | np.maximum(number, 0)
        shard = np.where(before >= 0, self.deal(np.where(before >= 0, keys, 0)), -1)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.deal.shards + 1))
        for s in sorted(self.shards):
            own = order[edges[s]:edges[s + 1]]
            if not len(own):
                continue
            file = self.words.mapped(f"key-{s}")
            at = np.minimum(np.searchsorted(file, keys[own]), len(file) - 1)
            hit = (file[at] == keys[own]) & (number[own] >= 0)
            have[own[hit]] = self.words.mapped(f"n-{s}")[at[hit]]
            contexts = self.words.mapped(f"context-{s}")
            at = np.minimum(np.searchsorted(contexts, before[own]), len(contexts) - 1)
            hit = contexts[at] == before[own]
            stats = self.words.mapped(f"stats-{s}")[at[hit]]
            total[own[hit]], gives[own[hit]] = stats[:, 0], stats[:, 1:] @ self.pair
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, before), len(self.hot) - 1)
            hit = self.hot[at] == before
            total[hit], gives[hit] = self.hot_stats[at[hit], 0], self.hot_stats[at[hit], 1:] @ self.pair
        known = total > 0
        take = np.where(have > 0, self.pair[np.clip(have, 1, 3).astype(int) - 1], 0)
        out = low.copy()
        out[known] = (np.maximum(have - take, 0)[known] + gives[known] * low[known]) / total[known]
        return out


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count and write the model of all given texts."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    plain = docs.select(F.col(text_col).cast("string").alias("text"))
    counted = cut(plain.mapInArrow(_unigrams, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    seen = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    tokens = int(seen[1] or 0)
    bits = max(0, (int(seen[0]) // SHARD_TOKENS).bit_length())
    part = F.shiftrightunsigned(F.col("word").bitwiseXOR(F.lit(-(1 << 63))), 64 - bits) if bits else F.lit(0).cast("long")
    sizes = (counted.withColumn("part", part).repartitionById(1 << bits, F.col("part").cast("int"))
             .mapInArrow(functools.partial(_write_words, folder), "part long, words long, tokens long").collect())
    words = Words(folder, bits, {r["part"]: r["words"] for r in sizes}, tokens)
    shards = max(4, -(-tokens // SHARD_TOKENS))
    least = tokens / (4 * shards)
    hot = [r["word"] for r in counted.where(F.col("n") > least).select("word").collect()]   # fewer than 4 a shard, as they hold all tokens
    numbers = words.numbers(np.sort(np.array(hot, np.int64)))[0] if hot else np.zeros(0, np.int64)
    if docs.count() > least:
        numbers = np.append(numbers, words.size)
    deal = Deal(shards, words.size + 1, numbers)
    made = cut(plain.mapInArrow(functools.partial(_bigrams, words, deal), "shard int, key long, n long")
               .repartitionById(shards, F.col("shard")).mapInArrow(functools.partial(_write_pairs, folder, deal), _PAIR_ROWS), "pairs")
    files = made.where(F.col("kind") == _FILE)
    of_pairs = files.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in "abcd"]).first()
    there = {r["id"] for r in files.select("id").collect()}    # a row for each shard
    hot_stats = {r["id"]: (r["a"], r["b"], r["c"], r["d"]) for r in made.where(F.col("kind") == _HOT).groupBy("id")
                 .agg(*[F.sum(c).alias(c) for c in "abcd"]).collect()}
    followed = cut(made.where(F.col("kind") == _FOLLOWED).groupBy("id").agg(F.sum("a").alias("n")), "followed")
    of_words = followed.agg(F.coalesce(F.sum("n"), F.lit(0)), *[F.sum((F.col("n") == k).cast("long")) for k in (1, 2, 3, 4)],
                            F.sum((F.col("n") >= 3).cast("long"))).first()
    single = discounts(*[float(of_words[k] or 0) for k in (1, 2, 3, 4)])
    chunk = max(1, -(-max(words.size, 1) // max(1, -(-words.size // SHARD_TOKENS))))
    parts = max(1, -(-words.size // chunk))
    (followed.withColumn("part", F.floor(F.col("id") / chunk)).repartitionById(parts, F.col("part").cast("int"))
     .mapInArrow(functools.partial(_write_followed, folder, words.size, chunk), "part long").collect())
    pairs = int(of_words[0])
    left = float(np.dot(single, [of_words[1] or 0, of_words[2] or 0, of_words[5] or 0])) / pairs if pairs else 1.0
    return Model(words, deal, there, chunk, discounts(*[float(x) for x in of_pairs]), single, max(pairs, 1), left, hot_stats)


@texts.tidied
def _scored(model: Model, batches):
    words = model.words
    for batch in batches:
        rows = batch.num_rows
        n_tokens, n_known, base, score = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows), np.zeros(rows)
        for row, end, hashes, at in _token_runs(batch.column("text")):
            number, count = _numbered(words, hashes)
            before = _contexts(number, at, words.size)
            kinds, back = np.unique(((before + 1) << 32) | (number + 1), return_inverse=True)
            p = model.probability((kinds >> 32) - 1, (kinds & _LOW) - 1)
            own = slice(row, end)
            n_tokens[own] = np.diff(at)
            n_known[own] = np.add.reduceat(number >= 0, at[:-1])
            base[own] = np.add.reduceat(np.log10((count + 1) / (words.tokens + words.size + 1)), at[:-1])
            score[own] = np.add.reduceat(np.log10(p)[back], at[:-1])
        yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, (n_tokens, n_known, base, score))],
                                         ["id", "n_tokens", "n_known", "base_score", "score"])


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score, perplexity) of every row; scores are log10 probabilities."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (plain.mapInArrow(functools.partial(_scored, model), "id long, n_tokens long, n_known long, base_score double, score double")
            .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))


def score_held_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows scored by the model of the training folds; scores keep six decimals, as sums of doubles do not keep all."""
    fold = remainder(F.col(id_col), FOLDS)
    model = train(docs.where(fold != LEFT_OUT), text_col)
    scored = score_texts(docs, model, id_col, text_col).withColumns({c: F.round(c, 6) for c in ("base_score", "score")})
    return scored.select(F.col("id").alias(id_col), (remainder(F.col("id"), FOLDS) == LEFT_OUT).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.words.tokens).cast("long").alias("train_tokens"), "base_score", "score",
                         F.round(F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")), 3).alias("perplexity"))
