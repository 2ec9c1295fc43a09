"""Cheapest open orders of a vehicle's stops over visited sets, many vehicles of one size at a time, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CELLS = 1 << 18             # (vehicle, visited set, last stop) worked on at once
DIGIT = 4                   # bits of a stop's number in an order's code
UNKNOWN = -np.inf           # an unknown leg makes the cost unknown, which sorts first; NaN sorts last
_NONE = np.iinfo(np.int64).max


def last_stops(legs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cost, code) of the cheapest order that ends in each stop, the first code of equal costs; ``legs`` is vehicles x from x to."""
    count, n, _ = legs.shape
    cost = np.full((count, 1 << n, n), np.inf)
    code = np.full((count, 1 << n, n), _NONE)
    for i in range(n):
        cost[:, 1 << i, i], code[:, 1 << i, i] = 0.0, i
    sets = np.arange(1 << n)
    size = np.bitwise_count(sets)
    for level in range(2, n + 1):
        for i in range(n):
            whole = sets[(size == level) & (sets >> i & 1 == 1)]
            before, step = whole ^ (1 << i), legs[:, None, :, i]
            so_far, codes = cost[:, before], code[:, before]
            with np.errstate(invalid="ignore"):
                total = so_far + step
            total[(so_far == UNKNOWN) | (step == UNKNOWN)] = UNKNOWN
            total[codes == _NONE] = np.inf
            least = total.min(axis=2)
            first = np.where(total == least[..., None], codes, _NONE).min(axis=2)
            cost[:, whole, i], code[:, whole, i] = least, first << DIGIT | i
    return cost[:, -1], code[:, -1]


def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace ``legs`` (n x n hours, flat) by ``cost`` and ``code`` of the best order for each last stop."""
    for batch in batches:
        n, legs = batch.column("n").to_numpy(), batch.column("legs")
        at = legs.offsets.to_numpy().astype(np.int64)
        values = legs.values
        hours = values.fill_null(UNKNOWN).to_numpy()
        hours = np.where(np.isnan(hours), np.inf, hours)
        for size in np.unique(n).tolist():
            rows = np.flatnonzero(n == size)
            step = max(1, CELLS // (size << size))
            for start in range(0, len(rows), step):
                own = rows[start:start + step]
                cost, code = last_stops(hours[at[own][:, None] + np.arange(size * size)].reshape(len(own), size, size))
                flat = cost.reshape(-1)
                bounds = pa.array(np.arange(len(own) + 1, dtype=np.int32) * size)
                shown = pa.array(np.where(flat == np.inf, np.nan, flat), mask=flat == UNKNOWN)
                kept = batch.drop_columns(["legs"]).take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.ListArray.from_arrays(bounds, shown), pa.ListArray.from_arrays(bounds, pa.array(code.reshape(-1)))],
                    [*kept.schema.names, "cost", "code"])
