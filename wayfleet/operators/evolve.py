"""The generations of the genetic search inside tasks: the steps of ``genetic`` for many vehicles of one size at a time."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa

from wayfleet.functions.scalars import DRAW_DIGITS

CELLS = 1 << 18             # entries of the populations worked on at once
UNKNOWN = -np.inf           # unknown hours sort first, as nulls do; NaN is held as infinity and sorts last
BLOCKS = 1 << 12            # texts whose choices are drawn at once
_MILLION = 1_000_000
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]
_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))


def _md5_start(words: np.ndarray) -> np.ndarray:
    """First eight bytes of the MD5 digests of single blocks, as big-endian numbers; ``words`` is 16 x blocks."""
    start = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = (np.full(words.shape[1], x, np.uint32) for x in start)
    for i in range(64):
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        f += _SINES[i]
        f += words[g]
        turn = _TURNS[i // 16][i % 4]
        rolled = f << np.uint32(turn)
        rolled |= f >> np.uint32(32 - turn)
        rolled += b
        a, b, c, d = d, rolled, b, c
    return (a + start[0]).byteswap().astype(np.uint64) << np.uint64(32) | (b + start[1]).byteswap()


def draws(texts: list[bytes], slots: tuple[bytes, ...] = (b"",)) -> np.ndarray:
    """The integers of ``scalars.drawn_from`` for each text (a row) with each slot behind it (a column)."""
    out, shift = np.empty((len(texts), len(slots)), np.int64), np.uint64(64 - 4 * DRAW_DIGITS)
    most, step = max(map(len, slots)), max(1, 4 * BLOCKS // len(slots))
    for first in range(0, len(texts), step):
        own = texts[first:first + step]
        size, row = np.fromiter(map(len, own), np.int64, len(own)), np.arange(len(own))
        if size.max() + most > 55:      # more than a block
            digests = b"".join([hashlib.md5(t + s, usedforsecurity=False).digest() for t in own for s in slots])
            out[first:first + step] = (np.frombuffer(digests, ">u8")[::2].astype(np.uint64) >> shift).reshape(-1, len(slots))
            continue
        base = np.frombuffer(b"".join([t.ljust(64, b"\0") for t in own]), np.uint8).reshape(-1, 64)
        blocks = np.repeat(base[None], len(slots), axis=0)
        for block, slot in zip(blocks, slots):
            for i, byte in enumerate(slot + b"\x80"):
                block[row, size + i] = byte
            bits = 8 * (size + len(slot))
            block[:, 56], block[:, 57] = bits & 255, bits >> 8
        words = np.ascontiguousarray(blocks.reshape(-1, 64).view("<u4").T)
        out[first:first + step] = (_md5_start(words) >> shift).reshape(len(slots), -1).T
    return out


def about(hours: np.ndarray) -> np.ndarray:
    """Billionths of hours, halves away from zero by the decimal text, as ``F.round(hours, 9)`` has them."""
    with np.errstate(invalid="ignore"):
        scaled = hours * 1e9
        out = np.floor(scaled + 0.5)
        for at in np.argwhere(np.abs(scaled - np.floor(scaled) - 0.5) <= 4 * np.spacing(scaled)):
            text = Decimal(repr(float(hours[tuple(at)])))
            out[tuple(at)] = float((text * 10 ** 9).to_integral_value(ROUND_HALF_UP))
    return out


def _hours(orders: np.ndarray, legs: np.ndarray) -> np.ndarray:
    total, vehicle = np.zeros(orders.shape[:2]), np.arange(len(orders))[:, None]
    for k in range(1, orders.shape[2]):
        step = legs[vehicle, orders[:, :, k - 1], orders[:, :, k]]
        with np.errstate(invalid="ignore"):
            unknown = (total == UNKNOWN) | (step == UNKNOWN)
            total = total + step
        total[unknown] = UNKNOWN
    return total


def _places(first: np.ndarray, second: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    x, y = first % n, second % (n - 1)
    y = y + (y >= x)
    return np.minimum(x, y), np.maximum(x, y)


def _choices(cfg, names: list[bytes], n: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(mother, father, begin, end, hit, i, j) of the children of each generation but the last: numbers that need no population."""
    size = cfg.population - cfg.elite
    per, rate = max(1, BLOCKS // (len(names) * size)), int(cfg.mutation_rate * _MILLION)
    for first in range(1, cfg.generations, per):
        some = range(first, min(first + per, cfg.generations))
        whos = [b"%b:%d:%d" % (name, g, i) for g in some for name in names for i in range(cfg.elite, cfg.population)]
        drawn = draws(whos, (b":1", b":2", b":3", b":4", b":7"))
        begin, end = _places(drawn[:, 2], drawn[:, 3], n)
        hits = np.flatnonzero(drawn[:, 4] % _MILLION < rate)
        swap = draws([whos[k] for k in hits.tolist()], (b":5", b":6"))
        i, j = _places(swap[:, 0], swap[:, 1], n)
        step = len(names) * size
        for low in range(0, len(whos), step):
            own, mine = slice(low, low + step), (hits >= low) & (hits < low + step)
            yield drawn[own, 0], drawn[own, 1], begin[own], end[own], hits[mine] - low, i[mine], j[mine]


def _children(parents: np.ndarray, choices: tuple[np.ndarray, ...]) -> np.ndarray:
    """Children per vehicle by crossover and mutation."""
    vehicles, m, n = parents.shape
    mother, father, begin, end, hit, i, j = choices
    row = np.repeat(np.arange(vehicles), len(mother) // vehicles)
    mother, father = parents[row, mother % m], parents[row, father % m]
    at = np.arange(n)
    inside = (at >= begin[:, None]) & (at < end[:, None])
    taken = np.zeros(inside.shape, bool)
    np.put_along_axis(taken, mother, inside, axis=1)
    out = mother.copy()
    out[~inside] = father[~np.take_along_axis(taken, father, axis=1)]      # both hold as many entries in every row
    out[hit, i], out[hit, j] = out[hit, j], out[hit, i]
    return out.reshape(vehicles, -1, n)


def search(cfg, names: list[bytes], legs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, hours, whether any was better than none, best hours after each generation); ``names``: seed and vehicle of the draws."""
    vehicles, n = legs.shape[:2]
    size, row, choices = cfg.population, np.arange(vehicles)[:, None], _choices(cfg, names, n)
    keys = draws([b"%b:%d" % (name, i) for name in names for i in range(size)], tuple(b":%d" % s for s in range(n)))
    population = np.argsort(keys.reshape(vehicles, size, n), axis=2, kind="stable")
    best, order = np.full(vehicles, np.inf), np.zeros((vehicles, n), population.dtype)
    trace = np.zeros((vehicles, cfg.generations))
    for generation in range(1, cfg.generations + 1):
        hours = _hours(population, legs)
        ranks = np.argsort(about(hours), axis=1, kind="stable")
        top = hours[row[:, 0], ranks[:, 0]]
        better = (top < best) & (top != UNKNOWN)
        best[better], order[better] = top[better], population[row[:, 0], ranks[:, 0]][better]
        trace[:, generation - 1] = best
        if generation == cfg.generations:
            break
        if n < 2:
            continue        # one order only
        parents = population[row, ranks[:, :max(cfg.elite, size // 2)]]
        bred = _children(parents, next(choices))
        population = np.concatenate([population[row, ranks[:, :cfg.elite]], bred], axis=1)
    return order, best, best < np.inf, trace


def evolver(cfg) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: ``n`` and ``legs`` (n x n hours, flat) give way to the best order, its hours and their trace."""
    def run(batches):
        for batch in batches:
            n, legs, ids = batch.column("n").to_numpy(), batch.column("legs"), batch.column("vehicle_id")
            at = legs.offsets.to_numpy().astype(np.int64)
            hours = legs.values.fill_null(UNKNOWN).to_numpy()
            hours = np.where(np.isnan(hours), np.inf, hours)
            for size in np.unique(n).tolist():
                rows = np.flatnonzero(n == size)
                step = max(1, CELLS // (cfg.population * size))
                for start in range(0, len(rows), step):
                    own = rows[start:start + step]
                    kept = batch.drop_columns(["n", "legs"]).take(pa.array(own))
                    # As concat_ws does, a null id leaves no place in the text.
                    names = [(f"{cfg.seed}:{i}" if i is not None else f"{cfg.seed}").encode() for i in ids.take(pa.array(own)).to_pylist()]
                    cells = hours[at[own][:, None] + np.arange(size * size)].reshape(len(own), size, size)
                    order, best, found, trace = search(cfg, names, cells)
                    ends = np.concatenate([[0], np.cumsum(found * size)]).astype(np.int32)
                    steps = np.arange(len(own) + 1, dtype=np.int32) * cfg.generations
                    yield pa.RecordBatch.from_arrays(
                        [*kept.columns, pa.ListArray.from_arrays(ends, pa.array(order[found].reshape(-1).astype(np.int32))), pa.array(best),
                         pa.ListArray.from_arrays(steps, pa.array(trace.reshape(-1)))], [*kept.schema.names, "_order", "_hours", "_trace"])
    return run
