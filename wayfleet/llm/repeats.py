"""Removal of passages that occur more than once, found by difference-cover anchors.

A window is ``length`` consecutive words of one text. Positions of a text are
counted modulo a period; only runs that start at the residues of a difference
cover are hashed. Every difference of two residues occurs in a cover, so two
equal windows, wherever they start, have an anchor at the same place inside
both. Anchors that occur once rule out all windows around them. Around the
others the match is extended to whole windows, and a window whose hash starts
elsewhere too is repeated. Each text is judged as it came in.

What is shuffled: one row per anchor, one row per window around a shared anchor,
and the texts with such windows (not even those while the table of their ranges
is small enough for Catalyst to broadcast). A task combines equal anchors
before they leave it: one row stands for them in the group, the others are known
to be shared and travel under keys of their own. So a group never has more rows
than tasks have chunks, however often a passage occurs. Texts that are equal as
a whole are counted by a grouped aggregation and hashed once in each task.

Defined results: null or empty texts have no words; fewer than ``length`` words,
nothing is removed; rows of one id are documents of their own, and rows with equal
texts repeat each other; rows without id are treated alike; further columns are
ignored. Words and windows are compared by 64-bit hashes, whole texts by 128 bits.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfleet.llm import text
from wayfleet.session import cut

#: Perfect difference sets, by their period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
CHUNK = 1 << 18         # rows a task combines before it hands them on
SAME = np.arange(256, dtype=np.uint8)
_ROWS = "g long, spare boolean, sure boolean, ref long, at int"


def cover(length: int) -> tuple[int, np.ndarray, int]:
    """(period, residues, words of an anchor) for windows of ``length`` words."""
    period = max(v for v in COVERS if v <= max(1, 3 * length // 5))
    return period, np.array(COVERS[period]), length - period + 1


def _run_hashes(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position of ``at``."""
    total = np.zeros(len(at), np.uint64)
    factor = 0x9E3779B97F4A7C15
    for j in range(n):
        total += hashes[at + j] * np.uint64(factor | 1)
        factor = factor * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF
    return text.mix(total + np.uint64(n))


class _Combiner:
    """Rows (hash, ref, at) of a task; equal hashes of a chunk leave as one row in the group and others that are known to be shared."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, hashes: np.ndarray, refs: np.ndarray, at: np.ndarray) -> bool:
        self.held.append((hashes, refs, at))
        self.rows += len(hashes)
        return self.rows >= CHUNK

    def flush(self) -> pa.RecordBatch:
        h, ref, at = (np.concatenate([x[i] for x in self.held]) if self.held else np.zeros(0, np.int64) for i in range(3))
        self.held, self.rows = [], 0
        h = h.astype(np.uint64)
        order = np.argsort(h, kind="stable")
        h, ref, at = h[order], ref[order], at[order]
        same = h[1:] == h[:-1]
        spare = np.concatenate([[False], same])[: len(h)]
        sure = spare | np.concatenate([same, [False]])[: len(h)]
        g = np.where(spare, text.mix(ref.view(np.uint64) + at.astype(np.uint64)), h)
        return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(spare), pa.array(sure), pa.array(ref.astype(np.int64)),
                                           pa.array(at.astype(np.int32))], ["g", "spare", "sure", "ref", "at"])


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, hashes, row of each word, place of each word in its text, words of each row) of runs of whole texts."""
    for row, end, hashes, at in text.documents(batch.column("text"), letters=SAME):
        lengths = np.diff(at)
        own = np.repeat(np.arange(end - row), lengths)
        yield row, hashes, own, np.arange(len(hashes)) - at[own], lengths


@text.tidied
def _anchors(length: int, batches):
    """Anchors of texts of at least one window, each different text of the task once."""
    period, residues, words = cover(length)
    inside = np.isin(np.arange(period), residues)
    seen: set[tuple[int, int]] = set()
    rows = _Combiner()
    for batch in batches:
        a, b = (batch.column(c).to_numpy() for c in ("key_a", "key_b"))
        fresh = np.zeros(batch.num_rows, bool)
        for i, key in enumerate(zip(a.tolist(), b.tolist())):
            if key not in seen:
                seen.add(key)
                fresh[i] = True
        for row, hashes, own, place, lengths in _pieces(batch):
            wanted = fresh[row:row + len(lengths)] & (lengths >= length)
            at = np.flatnonzero(inside[place % period] & wanted[own] & (place + words <= lengths[own]))
            if rows.add(_run_hashes(hashes, at, words), a[row + own[at]], place[at]):
                yield rows.flush()
    yield rows.flush()


def _shared(rows: DataFrame) -> DataFrame:
    """(ref, at) of the rows whose hash occurs more than once."""
    several = F.count(F.lit(1)).over(Window.partitionBy("g", "spare")) > 1
    return rows.withColumn("several", several).where("sure or (not spare and several)").select("ref", "at")


def _ranges(reach: int, batches):
    """Ranges [start, stop) of the places at most ``reach`` before those of the rows."""
    for batch in batches:
        starts, stops = [], []
        for places in batch.column("places").to_pylist():
            at = np.sort(np.array(places, np.int64))
            low, high = np.maximum(at - reach, 0), at + 1
            new = np.concatenate([[True], low[1:] > high[:-1]])
            starts.append(low[new])
            stops.append(high[np.concatenate([new[1:], [True]])])
        lists = [pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32),
                                          pa.array(np.concatenate(each).astype(np.int32) if each else np.zeros(0, np.int32))) for each in (starts, stops)]
        yield pa.RecordBatch.from_arrays([batch.column("ref"), *lists], ["ref", "starts", "stops"])


def _ranged(places: DataFrame, reach: int) -> DataFrame:
    """(ref, starts, stops), one row a text: as long as the text at most."""
    grouped = places.groupBy("ref").agg(F.collect_set("at").alias("places"))
    return grouped.mapInArrow(functools.partial(_ranges, reach), "ref long, starts array<int>, stops array<int>")


def _marked(starts, stops, size: int, wider: int = 0) -> np.ndarray:
    """Which of ``size`` + ``wider`` places are in a range of the first ``size``, each range ``wider`` at its end."""
    step = np.zeros(max(size, 0) + wider + 1, np.int32)
    if size > 0:
        np.add.at(step, np.minimum(np.array(starts, np.int64), size), 1)
        np.add.at(step, np.minimum(np.array(stops, np.int64), size) + wider, -1)
    return np.cumsum(step[:-1]) > 0


@text.tidied
def _windows(length: int, batches):
    """All windows in the ranges of each different text of the task."""
    rows, seen = _Combiner(), set()
    for batch in batches:
        starts, stops, refs = batch.column("starts"), batch.column("stops"), batch.column("row").to_numpy()
        keys = list(zip(batch.column("key_a").to_pylist(), batch.column("key_b").to_pylist()))
        for row, hashes, own, place, lengths in _pieces(batch):
            first = np.concatenate([[0], np.cumsum(lengths)])
            for i, n in enumerate(lengths.tolist()):
                if keys[row + i] in seen:
                    continue
                seen.add(keys[row + i])
                at = np.flatnonzero(_marked(starts[row + i].as_py(), stops[row + i].as_py(), n - length + 1))
                if rows.add(_run_hashes(hashes, first[i] + at, length), np.full(len(at), refs[row + i]), at):
                    yield rows.flush()
    yield rows.flush()


@text.tidied
def _kept(length: int, batches):
    """What is left of each text without its repeated windows, given by the ranges of their starts."""
    for batch in batches:
        counts, removed, kept = [], [], []
        for value, starts, stops in zip(batch.column("text").cast(pa.binary()), batch.column("starts"), batch.column("stops")):
            words = value.as_py().split()
            counts.append(len(words))
            if starts.is_valid and len(words) >= length:
                gone = _marked(starts.as_py(), stops.as_py(), len(words) - length + 1, length - 1)
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            removed.append(counts[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(kept, pa.binary()).cast(pa.string())], ["id", "n_words", "n_removed", "kept"])


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumns({"text": body}).withColumns({"key_a": F.xxhash64("text"), "key_b": F.xxhash64(F.lit(1), "text")})


def repeated_ranges(docs: DataFrame, text_col: str = "text", length: int = 35) -> DataFrame:
    """(key_a, key_b, starts, stops): the starts of the repeated windows of each different text that has any, as ranges [start, stop).

    A text that several rows hold has one range without end, as all its windows are repeated.
    """
    plain = _keyed(docs.select(F.col(text_col).alias("text")), "text").select("key_a", "key_b", "text")
    keys = ["key_a", "key_b"]
    copies = cut(plain.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select(*keys), "copies")
    anchors = plain.mapInArrow(functools.partial(_anchors, length), _ROWS)
    around = cut(_ranged(_shared(anchors), cover(length)[0] - 1), "around")
    # Rows of a written table have one number, however often a task is run again.
    found = cut(plain.join(around, F.col("key_a") == F.col("ref")).select(
        F.monotonically_increasing_id().alias("row"), *keys, "text", "starts", "stops"), "candidates")
    windows = found.mapInArrow(functools.partial(_windows, length), _ROWS)
    repeated = cut(_ranged(_shared(windows), 0), "repeated")
    single = found.select("row", *keys).join(repeated, F.col("row") == F.col("ref")).select(*keys, "starts", "stops").join(copies, keys, "left_anti")
    without_end = copies.select(*keys, F.array(F.lit(0)).alias("starts"), F.array(F.lit(2 ** 31 - 1)).alias("stops"))
    return cut(single.unionByName(without_end), "ranges")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35) -> DataFrame:
    """(id_col, n_words, n_removed, kept) of every row; ``kept`` has the words that stay, joined by spaces."""
    ranges = repeated_ranges(docs, text_col, length)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = _keyed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text").join(ranges, ["key_a", "key_b"], "left")
    made = rows.select("id", "text", "starts", "stops").mapInArrow(functools.partial(_kept, length), f"id {kind}, n_words long, n_removed long, kept string")
    return made.withColumnRenamed("id", id_col)
