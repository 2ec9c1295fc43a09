"""N-gram Jaccard self-join by PartEnum signatures.

A text's set holds the 64-bit hashes of its distinct word n-grams. Two texts
link when 100 * |intersection| >= percent * |union|. Equal sets are one class.
Sizes are covered by overlapping windows so that two linkable sizes always
share one. In a window linkable sets differ in at most ``k`` features, the
feature domain is cut into ``n1`` ranges of ``n2`` parts, and each way of
leaving out ``k2`` parts of a range gives one signature: linked sets share one in
every range in which they differ in at most ``k2`` parts. A signature over no
feature at all would be shared by strangers. A set's own size bounds how far its
partners can differ, so it knows in how many ranges it shares a signature with each
of them; if it has fewer ranges with an empty signature than that, one of those shared
is not empty, and the set leaves its empty ones out. A set that has more goes on to
another partition of the domain: two such sets both do, so they meet there, or in
the one after it. ``n1``, ``n2`` and ``k2`` are chosen for each window to need the fewest
signatures, and ``_PARTITIONS`` are enough for all but a vanishing share of sets; only
those emit empty signatures, in the last partition. No link is lost. Sets of a few features
emit all ways of leaving out as many features as a link allows, which are never empty.

Candidates are checked exactly on the feature sets. First every bucket of a
signature is checked against two leaders, then, where a bucket still spans
several components, each member against those nearest by sketch; the rest of
the pairs is checked only where a bucket spans several components even then, in
blocks. So a group of
thousands of near copies costs links to its leaders, not all its pairs.
That is enough for components; ``jaccard_links`` checks every candidate pair and returns all links.

Defined results: null or empty texts (or texts without words) have no features
and link with nothing; a text of fewer than n words has its whole sequence as
one feature; rows with one id are one document of the least text hash; rows
without id are left out of links and keep component null; further columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfleet.llm import graph, text
from wayfleet.session import cut, scratch

_GROWTH = 1.3          # ratio of neighbouring size windows
_SKETCH_WORDS = 16     # 64-bit words of the parity sketch, at least
_CARRIED = 128         # most words of the sketch that goes along with a bucket
_MOST_PARTS = 6        # most parts of a range
_PARTITIONS = 16       # partitions a set may go through
_FEW, _FEW_WAYS = 24, 64    # features of a set, and ways to leave some out, that are listed
BLOCK = 512            # members of a bucket compared at a time
NEAREST = 3            # partners a member of a large block is checked with before all others
_KNOWN = 256           # tested partners that go along with a member
_SMALL = 8             # members of a block whose pairs are made all at once
_PIECE_ROWS = 512      # members of short blocks that are compared at a time


def farthest(size_a: int, size_b: int, percent: int) -> int:
    """Most features in which two sets of these sizes can differ and still link."""
    return (100 - percent) * (size_a + size_b) // (100 + percent)


def open_ranges(size: int, high: int, percent: int, n1: int, k2: int) -> int:
    """In how many ranges at least a set of this size shares a signature with any partner of its window."""
    return n1 - farthest(size, min(high, size * 100 // percent), percent) // (k2 + 1)


def _fails(sizes: np.ndarray, need: np.ndarray, n1: int, n2: int, k2: int) -> float:
    """Chance that a set has an empty signature in ``need`` ranges or more, at the worst of the sizes."""
    empty = np.exp(-sizes / (n1 * n2))
    ways = np.array([math.comb(n2, i) for i in range(n2 - k2, n2 + 1)])[:, None]
    left = np.arange(n2 - k2, n2 + 1)[:, None]
    one = np.minimum((ways * empty ** left * (1 - empty) ** (n2 - left)).sum(axis=0), 1 - 1e-12)
    worst = 0.0
    for chance, least in zip(one.tolist(), need.tolist()):
        mean = n1 * chance
        if least <= 0 or mean >= least:
            return 1.0
        worst = max(worst, math.exp(least - mean + least * math.log(mean / least)) if mean else 0.0)     # Chernoff's bound
    return worst


@functools.lru_cache(maxsize=4096)
def window(j: int, percent: int) -> tuple[int, int, int, int, int]:
    """(low, high, n1, n2, k2) of the sizes in window j: the fewest signatures, with half of the sets at least settled in one partition."""
    low = max(int(_GROWTH ** j), 1)
    high = int(math.ceil(_GROWTH ** (j + 1) * 100 / percent)) + 1
    k = farthest(high, high, percent)
    sizes = np.unique(np.linspace(low, high, 9).astype(np.int64))
    choices = []
    for k2 in range(min(k, _MOST_PARTS - 1) + 1):
        for n2 in range(k2 + 1, _MOST_PARTS + 1 if k2 else 2):
            ways, fewest = math.comb(n2, k2), k // (k2 + 1) + 1
            for n1 in sorted({fewest + extra * max(fewest // 16, 1) for extra in range(9)}):
                need = np.array([open_ranges(int(s), high, percent, n1, k2) for s in sizes])
                fails = _fails(sizes, need, n1, n2, k2)
                choices.append((max(fails, 0.5), n1 * ways / max(1 - fails, 0.01), n1, n2, k2))
    _, _, n1, n2, k2 = min(choices)
    return low, high, n1, n2, k2


def left_out(size: int, percent: int) -> int:
    """Most features of a set of this size that a set it links with may lack."""
    return max(size - -(-percent * (size + other) // (100 + percent)) for other in range(max(size * percent // 100, 1), size * 100 // percent + 1)
               if 100 * min(size, other) >= percent * max(size, other))


@functools.lru_cache(maxsize=1024)
def ways_to_leave_out(size: int, percent: int) -> tuple[tuple[int, ...], ...] | None:
    """The places left out of a set of a few features, in all ways a link allows; None if those are too many."""
    most = max(left_out(size, percent), 0)
    if size > _FEW or sum(math.comb(size, i) for i in range(most + 1)) > _FEW_WAYS:
        return None
    return tuple(w for i in range(most + 1) for w in combinations(range(size), i))


@functools.lru_cache(maxsize=64)
def few(percent: int) -> int:
    """The greatest size up to which sets and their partners emit all ways of leaving out features."""
    size = 0
    while ways_to_leave_out(size + 1, percent) is not None:
        size += 1
    return size


def windows_of(size: int, percent: int) -> list[int]:
    """The windows that hold a size."""
    j, found = int(math.log(max(size, 1)) / math.log(_GROWTH)) + 1, []
    while j >= 0:
        high = int(math.ceil(_GROWTH ** (j + 1) * 100 / percent)) + 1
        if high < size:
            break
        if max(int(_GROWTH ** j), 1) <= size:
            found.append(j)
        j -= 1
    return found


@functools.lru_cache(maxsize=4096)
def _edges(parts: int) -> np.ndarray:
    """Lower hash bounds of equal ranges of the feature domain."""
    return np.array([i * (1 << 64) // parts for i in range(parts)] + [(1 << 64) - 1], dtype=np.uint64)


def signatures(features: np.ndarray, percent: int) -> np.ndarray:
    """All signatures of one sorted set of feature hashes."""
    out, size = [], len(features)
    if size <= few(percent):
        salted = text.mix(features ^ np.uint64(0x5EED))
        ways = ways_to_leave_out(size, percent) if size else ()
        gone = np.array([salted[list(w)].sum(dtype=np.uint64) for w in ways], np.uint64)
        out.append(text.mix((salted.sum(dtype=np.uint64, keepdims=True) - gone) ^ np.uint64(0xFE3)))
    # A set of a few features may link with a larger one: both are in a window then too.
    if size * 100 // percent > few(percent):
        for j in windows_of(size, percent):
            out.append(_window_signatures(features, j, percent))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _window_signatures(features: np.ndarray, j: int, percent: int) -> np.ndarray:
    low, high, n1, n2, k2 = window(j, percent)
    if farthest(high, high, percent) == 0:
        return np.zeros(0, np.uint64)
    need, out = open_ranges(len(features), high, percent, n1, k2), []
    for partition in range(_PARTITIONS):
        own = np.sort(text.mix(features ^ np.uint64(partition << 32))) if partition else features
        salted = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(text.mix(own ^ np.uint64(j + 1)), out=salted[1:])
        at = np.searchsorted(own, _edges(n1 * n2))
        at[-1] = len(own)
        sums = (salted[at[1:]] - salted[at[:-1]]).reshape(n1, n2)
        counts = np.diff(at).reshape(n1, n2)
        base = text.mix(np.arange(n1, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(partition << 8 | j))
        found, full = [], []
        for c, kept in enumerate(combinations(range(n2), n2 - k2)):
            found.append(text.mix(sums[:, kept].sum(axis=1, dtype=np.uint64) ^ text.mix(base + np.uint64(c << 50))))
            full.append(counts[:, kept].sum(axis=1) > 0)
        found, full = np.concatenate(found), np.stack(full)
        settled = (~full.all(axis=0)).sum() < need
        if settled or partition < _PARTITIONS - 1:
            found = found[full.reshape(-1)]
        out.append(found)
        if settled:
            break
    return np.concatenate(out)


def sketch(features: np.ndarray, words: int | None = None) -> np.ndarray:
    """Parity of the features in cells, about one cell a feature: two sketches of one length differ in no more bits than the sets do."""
    if words is None:
        words = max(_SKETCH_WORDS, 1 << (len(features) // 64).bit_length())
    cell = (text.mix(features ^ np.uint64(77)) & np.uint64(64 * words - 1)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=64 * words) & 1).astype(np.uint8), bitorder="little").view(np.int64)


def folded(words: np.ndarray, most: int) -> np.ndarray:
    """The sketch of at most so many words: its halves laid over each other."""
    while len(words) > most:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


class _Sketches:
    """The sketches of a table's rows, compared in the shorter one's length."""

    def __init__(self, column: pa.Array) -> None:
        self.words = column.flatten().to_numpy().view(np.uint64)
        self.first = column.offsets.to_numpy().astype(np.int64) - (column.offsets[0].as_py() if len(column) else 0)
        self.size = np.diff(self.first)

    def _of(self, rows: np.ndarray, width: int) -> np.ndarray:
        out = np.empty((len(rows), width), np.uint64)
        for size in np.unique(self.size[rows]).tolist():
            own = np.flatnonzero(self.size[rows] == size)
            words = self.words[self.first[rows[own]][:, None] + np.arange(size)]
            out[own] = np.bitwise_xor.reduce(words.reshape(len(own), size // width, width), axis=1)
        return out

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """In how many bits at least the sets of each pair differ."""
        out, shorter = np.zeros(len(x), np.int64), np.minimum(self.size[x], self.size[y])
        for width in np.unique(shorter).tolist():
            same = np.flatnonzero(shorter == width)
            for start in range(0, len(same), 1 << 14):
                own = same[start:start + (1 << 14)]
                out[own] = np.bitwise_count(self._of(x[own], width) ^ self._of(y[own], width)).sum(axis=1, dtype=np.int64)
        return out


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for row, end, hashes, at in text.documents(batch.column("text")):
        for i in range(row, end):
            yield i, text.shingles(hashes[at[i - row]:at[i - row + 1]], n)


def _keys(features: np.ndarray) -> tuple[int, int]:
    if not len(features):
        return 0, 0
    a, b = text.mix(features).sum(dtype=np.uint64), text.mix(features ^ np.uint64(99)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _long_lists(values: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32), pa.array(flat.view(np.int64)))


@text.tidied
def _describe(n: int, batches):
    """id, size, 128-bit identity and sketches of each set."""
    for batch in batches:
        size, a, b = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        full, small = [], []
        for i, s in _sets(batch, n):
            size[i] = len(s)
            a[i], b[i] = _keys(s)
            full.append(sketch(s))
            small.append(folded(full[-1], _CARRIED))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size), pa.array(a), pa.array(b), _long_lists(full), _long_lists(small)],
                                         ["id", "n_shingles", "key_a", "key_b", "sketch", "small"])


@text.tidied
def _signed(n: int, percent: int, batches):
    """(signature, id), once for the equal sets that a task reads."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        got, who, held = [], [], 0
        for i, s in _sets(batch, n):
            key = _keys(s)
            if not len(s) or key in seen:
                continue
            seen.add(key)
            sig = signatures(s, percent)
            got.append(sig)
            who.append(np.full(len(sig), ids[i], np.int64))
            held += len(sig)
            if held > 1 << 18:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got).view(np.int64)), pa.array(np.concatenate(who))], ["sig", "id"])
                got, who, held = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(got).view(np.int64)), pa.array(np.concatenate(who))], ["sig", "id"])


@text.tidied
def _featured(n: int, batches):
    """id and features of candidate texts."""
    for batch in batches:
        rows, found, held = [], [], 0
        for i, s in _sets(batch, n):
            rows.append(i)
            found.append(s)
            held += len(s)
            if held > 1 << 18 or i == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), _long_lists(found)], ["id", "features"])
                rows, found, held = [], [], 0


def _whole_runs(batches, keys: list[str]):
    """Sorted batches cut where a run of equal keys ends, so that no run is in two tables."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        last = np.ones(table.num_rows, bool)
        for k in keys:
            column = table.column(k).to_numpy()
            last &= column == column[-1]
        start = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if start:
            yield table.slice(0, start)
        held = table.slice(start)
    if held is not None:
        yield held


def _pieces(tables, keys: list[str], rows: int):
    """Tables of whole runs cut into smaller ones, at the ends of runs: of about so many rows, or one longer run."""
    for table in tables:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for k in keys:
            column = table.column(k).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        starts, first = np.flatnonzero(new), 0
        while first < table.num_rows:
            later = starts[starts > first]
            fits = later[later <= first + rows]
            end = table.num_rows if table.num_rows <= first + rows or not len(later) else int(fits[-1] if len(fits) else later[0])
            yield table.slice(first, end - first)
            first = end


def _pair_codes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """64-bit hash of each unordered pair of ids."""
    low, high = np.minimum(x, y).view(np.uint64), np.maximum(x, y).view(np.uint64)
    return text.mix(low ^ text.mix(high + np.uint64(1)))


@text.tidied
def _crossing(percent: int, nearest: int | None, batches):
    """Pairs of a bucket's blocks in different components that sizes and sketches cannot rule out.

    Of a large block only the ``nearest`` by sketch for each member, if given. Pairs that a member knows as tested are left out.
    """
    keys = ["sig", "left", "right"]
    for table in _pieces(_whole_runs(batches, keys), keys, _PIECE_ROWS):
        ids, sizes, comps, own, left, right = (table.column(c).to_numpy() for c in ("id", "n_shingles", "component", "block", "left", "right"))
        sketches = _Sketches(table.column("small").combine_chunks())
        new = np.ones(len(ids), bool)
        new[1:] = np.any([table.column(k).to_numpy()[1:] != table.column(k).to_numpy()[:-1] for k in keys], axis=0)
        run, starts = np.cumsum(new) - 1, np.flatnonzero(new)
        lengths = np.diff(np.append(starts, len(ids)))
        found = []

        def open_pairs(x, y):
            ok = (comps[x] != comps[y]) & ((left[x] == right[x]) | (own[x] != own[y]))
            x, y = x[ok], y[ok]
            ok = 100 * np.minimum(sizes[x], sizes[y]) >= percent * np.maximum(sizes[x], sizes[y])
            x, y = x[ok], y[ok]
            apart = sketches.apart(x, y)
            ok = apart * (100 + percent) <= (100 - percent) * (sizes[x] + sizes[y])
            return x[ok], y[ok], apart[ok]

        small = lengths[run] <= _SMALL
        for d in range(1, _SMALL):
            x = np.flatnonzero(small[:-d] & (run[:-d] == run[d:])) if d < len(ids) else np.zeros(0, np.int64)
            found.append(open_pairs(x, x + d)[:2])
        for r in np.flatnonzero(lengths > _SMALL):
            rows = np.arange(starts[r], starts[r] + lengths[r])
            for x in rows:
                _, y, apart = open_pairs(np.full(len(rows), x), rows)
                if nearest:
                    y = y[np.lexsort((ids[y], apart))[:nearest]]
                else:
                    y = y[y > x]
                found.append((np.full(len(y), x), y))
        x, y = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
        if not len(x):
            continue
        paired = np.unique(np.concatenate([x, y]))
        known = table.column("known").take(pa.array(paired)).combine_chunks()
        of = np.repeat(ids[paired], np.diff(known.offsets.to_numpy()))
        code = np.unique(_pair_codes(ids[x], ids[y]), return_index=True)
        fresh = code[1][~np.isin(code[0], _pair_codes(of, known.flatten().to_numpy()))]
        x, y = x[fresh], y[fresh]
        low, high = np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y])
        yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])


def _near(pairs: DataFrame, member: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and sketches do not rule out, with their sizes."""
    side = lambda tag: member.select(*[F.col(c).alias(f"{c}_{tag}") for c in ("id", "n_shingles", "sketch")])
    half = lambda x: F.zip_with(F.slice(x, 1, F.size(x) / 2), F.slice(x, F.size(x) / 2 + 1, F.size(x) / 2), lambda y, z: y.bitwiseXOR(z))
    fold = lambda x, y: F.when(F.size(x) > F.size(y), half(F.col(x))).otherwise(F.col(x))
    total = F.col("n_shingles_a") + F.col("n_shingles_b")
    apart = F.aggregate(F.zip_with(fold("sketch_a", "sketch_b"), fold("sketch_b", "sketch_a"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                        F.lit(0), lambda acc, x: acc + x)
    # Linkable sizes are less than a factor of 2 apart, so one sketch is at most twice the other.
    return (pairs.join(side("a"), F.col("a") == F.col("id_a")).join(side("b"), F.col("b") == F.col("id_b"))
            .where(100 * F.least("n_shingles_a", "n_shingles_b") >= percent * F.greatest("n_shingles_a", "n_shingles_b"))
            .where(apart * (100 + percent) <= (100 - percent) * total)
            .select("a", "b", "n_shingles_a", "n_shingles_b"))


def _linked(pairs: DataFrame, member: DataFrame, known: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose feature sets meet the threshold, exactly. Only texts of pairs left after sizes and sketches are read again."""
    near = cut(_near(pairs, member, percent), "near")
    if near.isEmpty():
        return near.select("a", "b")     # no text is read for nothing
    wanted = cut(near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).distinct(), "wanted")
    sets = cut(known.join(wanted, "id", "left_semi").mapInArrow(functools.partial(_featured, n), "id long, features array<bigint>")
               .groupBy("id").agg(F.min("features").alias("features")), "features")
    side = lambda tag: sets.select(F.col("id").alias(tag), F.col("features").alias(f"features_{tag}"))
    total = F.col("n_shingles_a") + F.col("n_shingles_b")
    shared = F.size(F.array_intersect("features_a", "features_b"))
    return cut(near.join(side("b"), "b").join(side("a"), "a").where(100 * shared >= percent * (total - shared)).select("a", "b"), "links")


def _tested(pairs: DataFrame) -> DataFrame:
    """(id, known): tested partners, each pair with the member that has fewer; more than ``_KNOWN`` are not remembered."""
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    side = lambda tag: ends.select(F.col("id").alias(tag), F.col("n").alias(f"n_{tag}"))
    own = F.when(F.col("n_a") <= F.col("n_b"), F.struct(F.col("a").alias("id"), F.col("b").alias("other"))).otherwise(
        F.struct(F.col("b").alias("id"), F.col("a").alias("other")))
    held = pairs.join(side("a"), "a").join(side("b"), "b").select(own.alias("o")).select("o.*")
    place = F.row_number().over(Window.partitionBy("id").orderBy("other"))
    return held.withColumn("place", place).where(F.col("place") <= _KNOWN).groupBy("id").agg(F.collect_list("other").alias("known"))


def _open_pairs(live: DataFrame, member: DataFrame, found: DataFrame, percent: int, nearest: int | None,
                tested: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """Distinct pairs (a, b) of the buckets that still span components, block by block; those of ``tested`` may be left out.

    ``buckets``: in how many of its open buckets a member is looked at, all if not given.
    """
    placed = member.select("id", "n_shingles", "small").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = live.join(placed.select("id", "component"), "id")
    spread = rows.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"))
    spread = cut(spread.where("low != high").select("sig", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), "open")
    placed = placed.join(_tested(tested), "id", "left") if tested is not None else placed.withColumn("known", F.lit(None).cast("array<bigint>"))
    placed = cut(placed.withColumn("known", F.coalesce("known", F.array().cast("array<bigint>"))), "placed")
    rows = live.join(spread, "sig")
    if buckets:
        rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("sig"))).where(F.col("place") <= buckets)
    rows = (rows.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("sig", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "id")
            .join(placed, "id"))
    return (rows.repartition("sig", "left", "right").sortWithinPartitions("sig", "left", "right")
            .mapInArrow(functools.partial(_crossing, percent, nearest), "a long, b long").distinct())


def _candidates(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> tuple[DataFrame, ...]:
    """(described rows, classes of equal sets, their representatives, rows with id, (sig, representative) of shared signatures)."""
    if percent < 50:
        raise ValueError("sketches are compared for similarities of 50 % or more")
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    described = cut(plain.mapInArrow(functools.partial(_describe, n), "id long, n_shingles long, key_a long, key_b long, "
                                     "sketch array<bigint>, small array<bigint>"), "sets")
    own = (described.where("id is not null and n_shingles > 0").groupBy("id")
           .agg(F.min(F.struct("key_a", "key_b", "n_shingles")).alias("s")).select("id", "s.*"))
    groups = own.groupBy("key_a", "key_b").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # Written, so that the join has an exchange of its own and a large group of copies can be split.
    several = cut(groups.where("copies > 1").select("key_a", "key_b", "rep"), "copies")
    classes = cut(own.join(several, ["key_a", "key_b"], "left")
                  .select("id", F.coalesce("rep", "id").alias("rep"), "key_a", "key_b"), "classes")
    member = cut(described.join(classes.where("id = rep").select("id", "key_a", "key_b"), ["id", "key_a", "key_b"], "left_semi")
                 .dropDuplicates(["id"]).select("id", "n_shingles", "sketch", "small"), "member")
    known = plain.where(F.col("id").isNotNull())

    # Copies inside a task are signed once; those of several tasks meet in the buckets and are mapped to their class there.
    signed = known.mapInArrow(functools.partial(_signed, n, percent), "sig long, id long")
    bucket = Window.partitionBy("sig")
    spans = lambda rows, name="sig": (rows.withColumn("low", F.min("id").over(bucket)).withColumn("high", F.max("id").over(bucket))
                                      .where("low != high").select(F.col(name).alias("sig"), "id"))
    live = cut(spans(signed), "signed")
    # Buckets of the same members say the same: one of them is kept, named by its members.
    members = F.xxhash64(F.bit_xor(F.xxhash64("id")).over(bucket), F.bit_xor(F.xxhash64("id", F.lit(1))).over(bucket), F.count("id").over(bucket))
    shared = live.join(classes.select("id", "rep"), "id").select("sig", F.col("rep").alias("id")).distinct().withColumn("members", members)
    live = cut(spans(shared.select("sig", "id", "members"), "members").distinct(), "live")
    return described, classes, member, known, live


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
                       percent: int = 85) -> DataFrame:
    """(id_col, n_shingles, component_id) of every row; see the module for the method and edge cases."""
    with scratch(docs.sparkSession) as keep:
        described, classes, member, known, live = _candidates(docs, id_col, text_col, n, percent)
        final = keep(_connected(live, member, known, n, percent))
        keep(described), keep(classes)
    by_class = classes.join(final.withColumnRenamed("id", "rep"), "rep", "left").select(
        "id", F.coalesce("component", "rep").alias("component"))
    return (described.select("id", "n_shingles").join(by_class, "id", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id")))


def _connected(live: DataFrame, member: DataFrame, known: DataFrame, n: int, percent: int) -> DataFrame:
    """(id, component) of the representatives that link with another one: by leaders, by the nearest, then by all open pairs."""
    orders = [F.xxhash64("id", F.lit(seed)) for seed in (1, 2)]
    leaders = live.groupBy("sig").agg(*[F.min(F.struct(o.alias("o"), "id"))["id"].alias(f"lead{i}") for i, o in enumerate(orders)])
    led = live.join(leaders, "sig").select("id", F.explode(F.array("lead0", "lead1")).alias("lead")).where("id != lead")
    tested = cut(led.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct(), "led")
    final = cut(graph.components(_linked(tested, member, known, n, percent)), "components")
    # A few buckets of each member first: what they settle need not be met again in all the others.
    for nearest, buckets in ((NEAREST, NEAREST), (None, 2 * NEAREST), (None, None)):
        crossing = cut(_open_pairs(live, member, final, percent, nearest, tested, buckets).join(tested, ["a", "b"], "left_anti"), "crossing")
        more = _linked(crossing, member, known, n, percent)
        if not more.isEmpty():
            final = cut(graph.merged(final, more), "components")
        tested = tested.unionByName(crossing)
    return final


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4,
                  percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(pairs, membership): all links (a, b), a < b, between different sets, and (id, rep) of each id with a set.

    A pair stands for all pairs of the members of its two classes; members of one class
    have equal sets and link too. Every candidate pair is verified, whatever the components.
    """
    _, classes, member, known, live = _candidates(docs, id_col, text_col, n, percent)
    alone = docs.sparkSession.createDataFrame([], "id long, component long")      # no pair is passed over as connected
    pairs = cut(_open_pairs(live, member, alone, percent, None), "pairs")
    return _linked(pairs, member, known, n, percent), classes.select("id", "rep")


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """(id_col, n_links) of every id: how many other ids it links with."""
    pairs, classes = jaccard_links(docs, id_col, text_col, n, percent)
    sizes = cut(classes.groupBy("rep").agg(F.count(F.lit(1)).alias("members")), "sizes")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(sizes, F.col("b") == F.col("rep")).groupBy("a").agg(F.sum("members").alias("others"))
    counted = cut(sizes.join(others, F.col("a") == F.col("rep"), "left")
                  .select("rep", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "counted")
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct()
    return (ids.join(classes.join(counted, "rep").select("id", "n_links"), "id", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
