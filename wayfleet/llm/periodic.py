"""Runs of periodic words by recursive frequency splitting and a scan of lags.

A run is a stretch of words with smallest period q, of at least ``exponent``
periods and ``shortest`` words, that no neighbouring word extends. Every word of
a run occurs at least ``exponent`` times in it. So a word that occurs less often
in the current segment of a text is in no run there and splits the segment; what
remains is counted again, until no segment changes. Most texts vanish in the first
count. In a segment that survives, a run of period q holds ``exponent - 1``
consecutive multiples of q: only those are compared for each lag, m log m of them in
m words, and only a lag that has a match is scanned over the segment.

A row never leaves its task: nothing is shuffled, and memory follows one piece of
a batch or the longest text.

Defined results: a null or empty text has no words, no runs and an empty collapsed
text; rows of one id are documents of their own; further columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm import text

PIECE_WORDS = 1 << 18       # words counted at a time; a longer text is a piece of its own
_PAIRS = 1 << 20            # multiples of lags compared at a time


def surviving_segments(ids: np.ndarray, owners: np.ndarray, least: int, shortest: int) -> list[tuple[int, int]]:
    """[start, stop) of the segments in which every word occurs ``least`` times; ``owners`` tells the texts apart."""
    at, segment = np.arange(len(ids)), owners
    settled = []
    while len(at):
        _, word, count = np.unique(segment.astype(np.int64) << 32 | ids[at], return_inverse=True, return_counts=True)
        often = count[word] >= least
        before = np.bincount(segment, minlength=int(segment.max()) + 1)
        at, old = at[often], segment[often]
        if not len(at):
            break
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (old[1:] != old[:-1])
        segment = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        lengths = np.diff(np.append(first, len(at)))
        whole = lengths == before[old[first]]
        settled += [(int(at[f]), int(at[f]) + int(n)) for f, n in zip(first[whole], lengths[whole]) if n >= shortest]
        open_ = (~whole & (lengths >= shortest))[segment]
        at, segment = at[open_], segment[open_]
        segment = np.unique(segment, return_inverse=True)[1] if len(segment) else segment
    return sorted(settled)


def runs_of(words: np.ndarray, exponent: int, shortest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a segment of word numbers, by start, then period."""
    m = len(words)
    up, _ = text._TABLES.upto(m + 1)
    sums = np.zeros(m + 1, np.uint64)
    np.cumsum(text.mix(words.astype(np.uint64) + np.uint64(1)) * up[:m], out=sums[1:])
    lags = np.arange(1, m // exponent + 1)
    tries = np.maximum((m - (exponent - 1) * lags) // lags + 1, 0)
    found: dict[tuple[int, int], int] = {}
    known: list[tuple[int, int, int]] = []
    low = 0
    while low < len(lags):
        total = np.cumsum(tries[low:])
        high = low + max(1, int(np.searchsorted(total, _PAIRS, "right")))
        lag = np.repeat(lags[low:high], tries[low:high])
        at = (np.arange(len(lag)) - np.repeat(np.concatenate([[0], total[:high - low - 1]]), tries[low:high])) * lag
        ok = words[at] == words[np.minimum(at + lag, m - 1)]
        lag, at = lag[ok], at[ok]
        size = (exponent - 2) * lag
        ok = (sums[at + size] - sums[at]) * up[lag] == sums[at + lag + size] - sums[at + lag]
        lag, at = lag[ok], at[ok]
        for q in np.unique(lag).tolist():
            places = at[lag == q]
            for start, stop, period in known:       # a multiple of the period of a run that holds the place finds that run again
                if q % period == 0:
                    places = places[(places < start) | (places + (exponent - 1) * q > stop)]
            if not len(places):
                continue
            step = np.diff(np.concatenate([[0], (words[:-q] == words[q:]).astype(np.int8), [0]]))
            starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1) + q
            for start, stop in zip(starts.tolist(), stops.tolist()):
                if stop - start >= max(shortest, exponent * q) and (start, stop) not in found:
                    found[start, stop] = q
                    known.append((start, stop, q))
        low = high
    return sorted((start, stop - start, q) for (start, stop), q in found.items())


@text.tidied
def _described(exponent: int, shortest: int, rewrite, batches):
    for batch in batches:
        keys, texts = batch.column("id"), batch.column("text").cast(pa.binary())
        runs, collapsed, counts = [[] for _ in range(batch.num_rows)], [], []
        row = 0
        while row < batch.num_rows:
            numbers: dict[bytes, int] = {}
            words, ids, size, first = [], [], 0, row
            while row < batch.num_rows and (size < PIECE_WORDS):
                own = (texts[row].as_py() or b"").split()
                own_ids = np.array([numbers.setdefault(w, len(numbers)) for w in own], np.int64)
                order = rewrite(keys[row].as_py(), len(own)) if rewrite else None
                if order is not None:
                    own, own_ids = [own[i] for i in order.tolist()], own_ids[order]
                words.append(own)
                ids.append(own_ids)
                size += len(own)
                row += 1
            edges = np.concatenate([[0], np.cumsum([len(w) for w in words])])
            flat = np.concatenate(ids)
            owners = np.repeat(np.arange(len(words)), np.diff(edges))
            for start, stop in surviving_segments(flat, owners, exponent, shortest):
                own = int(owners[start])
                base = start - int(edges[own])
                runs[first + own] += [(base + s, n, q) for s, n, q in runs_of(flat[start:stop], exponent, shortest)]
            for i, own in enumerate(words):
                counts.append(len(own))
                if runs[first + i]:
                    keep = np.ones(len(own), bool)
                    for start, n, q in runs[first + i]:
                        keep[start + q:start + n] = False
                    own = [w for w, k in zip(own, keep.tolist()) if k]
                collapsed.append(b" ".join(own))
        names = ("start", "length", "period")
        listed = pa.array([[dict(zip(names, r)) for r in each] for each in runs], pa.list_(pa.struct([(n, pa.int64()) for n in names])))
        yield pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64()), listed, pa.array(collapsed, pa.binary()).cast(pa.string())],
                                         ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = 4, shortest: int = 6,
                  rewrite: Callable | None = None) -> DataFrame:
    """(id_col, n_words, runs, collapsed) of every row.

    ``runs`` has (start, length, period) by start, then period; ``collapsed`` has the words that no run
    repeats, joined by spaces. ``rewrite(id, n)`` may give the order in which the n words of a text are
    taken (numbers of words, None: as they are). ``exponent`` is 3 at least.
    """
    if exponent < 3 or shortest < 1:
        raise ValueError("runs of at least 3 periods and 1 word can be found")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    made = rows.mapInArrow(functools.partial(_described, exponent, shortest, rewrite),
                           f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return made.withColumnRenamed("id", id_col)
