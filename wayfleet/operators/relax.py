"""Cheapest paths from some sources over the arcs held in one task, all sources of a block hop by hop together."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from wayfleet.operators import balls

BLOCK = 1 << 22             # arcs times sources worked on at once
WIDEST = 64                 # sources of a block at most


def _first_of(groups: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])


def settled(sources: np.ndarray, goals: np.ndarray, owner: np.ndarray, nodes: int, src: np.ndarray, dst: np.ndarray,
            cost: np.ndarray) -> np.ndarray:
    """Cost of each node (row) from each source (column); arcs come in order of ``dst``.

    Labels that cost as much as the dearest goal of their source (``goals``, ``owner``) are not extended.
    """
    best = np.full((nodes, len(sources)), np.inf)
    best[sources, np.arange(len(sources))] = 0.0
    active = np.zeros(nodes, dtype=bool)
    active[sources] = True
    while active.any():
        arcs = np.flatnonzero(active[src])
        active[:] = False
        if not len(arcs):
            break
        first = _first_of(dst[arcs])
        ends = dst[arcs[first]]
        offered = best[src[arcs]]
        offered += cost[arcs, None]
        offered = np.minimum.reduceat(offered, first, axis=0)
        held = best[ends]
        better = offered < held
        best[ends] = np.where(better, offered, held)
        limit = np.full(len(sources), -np.inf)
        np.maximum.at(limit, owner, best[goals, owner])
        active[ends[(better & (offered < limit)).any(axis=1)]] = True
    return best


def _traced(best: np.ndarray, sources: np.ndarray, goals: np.ndarray, owner: np.ndarray, src: np.ndarray, dst: np.ndarray,
            cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, arcs): the arcs of each goal's path, in order; of arcs that give a node its cost the first is followed."""
    offered = best[src]
    offered += cost[:, None]
    first = _first_of(dst)
    by = np.where((offered == best[dst]) & np.isfinite(offered), np.arange(len(src))[:, None], len(src))
    before = np.full(best.shape, len(src))
    before[dst[first]] = np.minimum.reduceat(by, first, axis=0)
    at, open_, pairs, arcs = goals.copy(), np.flatnonzero(goals != sources[owner]), [], []
    while len(open_):
        arc = before[at[open_], owner[open_]]
        pairs.append(open_)
        arcs.append(arc)
        at[open_] = src[arc]
        open_ = open_[at[open_] != sources[owner[open_]]]
    if not pairs:
        return np.zeros(len(goals), dtype="int64"), np.zeros(0, dtype="int64")
    pair, arc = np.concatenate(pairs[::-1]), np.concatenate(arcs[::-1])        # the last step back is the first arc
    return np.bincount(pair, minlength=len(goals)), arc[np.argsort(pair, kind="stable")]


def _whole(at: np.ndarray, owner: np.ndarray, goal: np.ndarray, nodes: int, src: np.ndarray, dst: np.ndarray, cost: np.ndarray,
           with_path: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(costs, lengths, steps) of the pairs (``at[owner]``, ``goal``), in order of ``owner``, by searches over all nodes."""
    width = max(1, min(WIDEST, BLOCK // max(1, len(src))))
    costs, lengths, steps = [np.zeros(0)], [np.zeros(0, dtype="int64")], [np.zeros(0, dtype="int64")]
    for low in range(0, len(at), width):
        mine = slice(*np.searchsorted(owner, [low, low + width]))
        block = (at[low:low + width], goal[mine], owner[mine] - low)
        best = settled(*block, nodes, src, dst, cost)
        costs.append(best[block[1], block[2]])
        if with_path:
            there = np.isfinite(costs[-1])
            length = np.zeros(len(there), dtype="int64")
            length[there], arc = _traced(best, block[0], block[1][there], block[2][there], src, dst, cost)
            lengths.append(length)
            steps.append(arc)
    return np.concatenate(costs), np.concatenate(lengths), np.concatenate(steps)


def _met(at: np.ndarray, owner: np.ndarray, goal: np.ndarray, nodes: int, src: np.ndarray, dst: np.ndarray, cost: np.ndarray,
         with_path: bool, ball: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_whole``, by searches from both ends; only what they leave goes over all nodes."""
    costs, done, lengths, steps = balls.search(at, owner, goal, nodes, src, dst, cost, ball, with_path)
    if done.all():
        return costs, lengths, steps
    left = np.flatnonzero(~done)
    few, who = np.unique(owner[left], return_inverse=True)
    costs[left], length, more = _whole(at[few], who, goal[left], nodes, src, dst, cost, with_path)
    if with_path:
        pair = np.r_[np.repeat(np.arange(len(goal)), lengths), np.repeat(left, length)]
        lengths[left] = length
        steps = np.r_[steps, more][np.argsort(pair, kind="stable")]
    return costs, lengths, steps


def searcher(with_path: bool, ball: int = 0) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Function over the goals (source, target) and the arcs of a group: the goals that are reached, with cost and path.

    With ``ball`` the searches start from both ends, those from the targets with that many nodes.
    """
    def search(goals: pa.Table, arcs: pa.Table) -> pa.Table:
        src, dst, cost, via = (arcs[c].to_numpy() for c in ("src", "dst", "arc_cost", "via"))
        source, target = goals["source"].to_numpy(), goals["target"].to_numpy()
        names = np.unique(np.concatenate([src, dst, source, target]))
        order = np.lexsort((via, dst))
        src, dst, cost = np.searchsorted(names, src[order]), np.searchsorted(names, dst[order]), cost[order]
        by_source = np.argsort(source, kind="stable")
        source, target = source[by_source], target[by_source]
        starts, owner = np.unique(source, return_inverse=True)
        asked = (np.searchsorted(names, starts), owner, np.searchsorted(names, target), len(names), src, dst, cost, with_path)
        costs, lengths, steps = _met(*asked, ball) if ball and len(goals) else _whole(*asked)
        reached = np.isfinite(costs)
        found = {"source": source[reached], "target": target[reached], "cost": costs[reached]}
        if with_path:
            offsets = np.r_[0, np.cumsum(lengths[reached])]
            edges = arcs["edge_id"].take(pa.array(order[steps])).combine_chunks()
            edges = pa.concat_arrays(edges.chunks) if isinstance(edges, pa.ChunkedArray) else edges
            found["path"] = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), edges)
        return pa.table(found)

    return search
