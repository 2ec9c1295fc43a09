"""Cheapest paths of some pairs: short searches back from the targets, met by searches from the sources that grow as far as their pairs ask."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DENSE = 1 << 20             # labels of a block of searches: origins times nodes; more leave the caches
MET = 1 << 22               # labels of targets looked at at once
SLACK = 1e-9                # relative; sums of the same arcs in another order stay far below
GROWTH = 1.2
GIVE_UP = 4                 # a search that holds this part of the nodes is left to the search of whole blocks


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each range, one range after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


def distinct(values: np.ndarray) -> np.ndarray:
    """Different values in order; np.unique hashes them, which takes several times as long."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


@dataclass
class Arcs:
    """Arcs ordered by one end: those of node i are first[i] to first[i + 1]."""

    first: np.ndarray
    end: np.ndarray
    cost: np.ndarray

    @classmethod
    def of(cls, begin: np.ndarray, end: np.ndarray, cost: np.ndarray, nodes: int) -> Arcs:
        order = np.argsort(begin, kind="stable")
        return cls(np.searchsorted(begin[order], np.arange(nodes + 1)), end[order], cost[order])

    def at(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the given nodes, arc) of all their arcs."""
        size = self.first[nodes + 1] - self.first[nodes]
        return np.repeat(np.arange(len(nodes)), size), ranges(self.first[nodes], size)


class Searches:
    """Searches from several origins over one network, each relaxed up to a limit of its own.

    A label is a key, origin times nodes plus node. Below its origin's limit it is final, above it an upper bound.
    """

    def __init__(self, best: np.ndarray, queued: np.ndarray, origins: np.ndarray, arcs: Arcs, nodes: int):
        self.best, self.queued, self.arcs, self.nodes = best, queued, arcs, nodes
        self.waiting = np.arange(len(origins)) * nodes + origins
        self.seen = [self.waiting]
        self.limit = np.zeros(len(origins))
        best[self.waiting] = 0.0
        queued[self.waiting] = True

    def relax(self) -> None:
        """Send on every label up to its origin's limit."""
        best, queued, nodes = self.best, self.queued, self.nodes
        while True:
            cost, origin = best[self.waiting], self.waiting // nodes
            go = cost <= self.limit[origin]
            if not go.any():
                return
            sent, cost, origin = self.waiting[go], cost[go], origin[go]
            self.waiting = self.waiting[~go]
            queued[sent] = False
            which, arc = self.arcs.at(sent - origin * nodes)
            keys, offered = origin[which] * nodes + self.arcs.end[arc], cost[which] + self.arcs.cost[arc]
            better = offered < best[keys]
            keys, offered = keys[better], offered[better]
            np.minimum.at(best, keys, offered)
            fresh = distinct(keys[~queued[keys]])
            queued[fresh] = True
            self.waiting = np.concatenate([self.waiting, fresh])
            self.seen.append(fresh)

    def labels(self) -> np.ndarray:
        """Keys of all labels, in order."""
        self.seen = [distinct(np.concatenate(self.seen))]
        return self.seen[0]

    def waits(self) -> np.ndarray:
        """The least cost that waits for a greater limit, per origin; infinity where the search is over."""
        least = np.full(len(self.limit), np.inf)
        np.minimum.at(least, self.waiting // self.nodes, self.best[self.waiting])
        return least

    def clear(self) -> None:
        self.best[self.labels()] = np.inf
        self.queued[self.waiting] = False


@dataclass
class Balls:
    """What leads to each target: nodes in order, with the cost to it, complete up to the target's radius."""

    first: np.ndarray
    node: np.ndarray
    cost: np.ndarray
    radius: np.ndarray

    def find(self, target: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether the node is there) of a node among those of a target."""
        low, high = self.first[target], self.first[target + 1] - 1      # never empty: a target leads to itself
        while (low < high).any():
            middle = (low + high) >> 1
            less = self.node[middle] < node
            low, high = np.where(less, np.minimum(middle + 1, high), low), np.where(less, high, middle)
        return low, self.node[low] == node


def balls(targets: np.ndarray, back: Arcs, nodes: int, size: int) -> Balls:
    """The ``size`` or more nearest nodes ahead of each target; all there are where they are fewer (radius infinity)."""
    width = max(16, min(256, DENSE // nodes))
    best, queued = np.full(width * nodes, np.inf), np.zeros(width * nodes, dtype=bool)
    at, costs, counts, radii, usual = [], [], [], [], float(np.median(back.cost)) if len(back.cost) else 0.0
    for low in range(0, len(targets), width):
        block = targets[low:low + width]
        search = Searches(best, queued, block, back, nodes)
        search.limit[:] = usual
        while True:
            search.relax()
            waits = search.waits()
            keys = search.labels()
            final = keys[best[keys] <= search.limit[keys // nodes]]
            count = np.bincount(final // nodes, minlength=len(block))
            search.limit[np.isinf(waits)] = np.inf
            small = (count < size) & np.isfinite(waits)
            if not small.any():
                break
            search.limit[small] = np.maximum(search.limit[small] * np.where(count[small] * 8 < size, 1.5, GROWTH), waits[small])
        keys = search.labels()
        final = keys[best[keys] <= search.limit[keys // nodes]]
        at.append((final % nodes).astype("int32"))
        costs.append(best[final])
        counts.append(np.bincount(final // nodes, minlength=len(block)))
        radii.append(search.limit)
        finite = search.limit[np.isfinite(search.limit)]
        usual = 0.9 * float(np.median(finite)) if len(finite) else usual
        search.clear()
    counts = np.concatenate(counts) if counts else np.zeros(0, dtype="int64")
    node = np.concatenate(at) if at else np.zeros(0, dtype="int32")
    return Balls(np.r_[0, np.cumsum(counts)], node, np.concatenate(costs) if costs else np.zeros(0), np.concatenate(radii) if radii else np.zeros(0))


def _found(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the ordered table, whether the key is there)."""
    place = np.minimum(np.searchsorted(table, keys), max(0, len(table) - 1))
    return place, table[place] == keys if len(table) else np.zeros(len(keys), dtype=bool)


def _met(best: np.ndarray, at: np.ndarray, target: np.ndarray, held: Balls) -> np.ndarray:
    """Least cost over the nodes that a pair's search (``at``: its first key) has a label of and that lead to its target."""
    size = held.first[target + 1] - held.first[target]
    out = np.empty(len(target))
    ends = np.cumsum(size)
    low = 0
    while low < len(target):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + MET, side="right")))
        part = slice(low, high)
        place = ranges(held.first[target[part]], size[part])
        total = best[np.repeat(at[part], size[part]) + held.node[place]] + held.cost[place]
        out[part] = np.minimum.reduceat(total, np.r_[0, np.cumsum(size[part])[:-1]])
        low = high
    return out


def _crossings(best: np.ndarray, at: np.ndarray, target: np.ndarray, limit: np.ndarray, most: np.ndarray, held: Balls) -> tuple[np.ndarray, np.ndarray]:
    """(pair, node) of the labels beyond a search's limit over which a path of at most ``most`` may go on to the target."""
    pairs, nodes = [], []
    size = held.first[target + 1] - held.first[target]
    step = max(1, MET // max(1, int(size.max(initial=1))))
    for low in range(0, len(target), step):
        part = slice(low, low + step)
        place, pair = ranges(held.first[target[part]], size[part]), np.repeat(np.arange(low, low + len(size[part])), size[part])
        label = best[at[pair] + held.node[place]]
        hit = (label + held.cost[place] <= most[pair]) & (label > limit[pair])
        pairs.append(pair[hit])
        nodes.append(held.node[place[hit]].astype("int64"))
    return (np.concatenate(pairs), np.concatenate(nodes)) if pairs else (np.zeros(0, dtype="int64"),) * 2


def _tails(pair: np.ndarray, node: np.ndarray, label: np.ndarray, best: np.ndarray, at: np.ndarray, target: np.ndarray, limit: np.ndarray,
           most: np.ndarray, held: Balls, ahead: Arcs, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, costs), keys pair times nodes plus node: the labels from the crossings on to the targets, summed from the source as in a whole search."""
    keys = pair * nodes + node
    order = np.argsort(keys)
    keys, costs = keys[order], label[order]
    new_keys, new_costs = keys, costs
    while len(new_keys):
        pair = new_keys // nodes
        which, arc = ahead.at(new_keys - pair * nodes)
        pair, end, offered = pair[which], ahead.end[arc], new_costs[which] + ahead.cost[arc]
        place, there = held.find(target[pair], end)
        keep = there & (offered + held.cost[place] <= most[pair]) & (best[at[pair] + end] > limit[pair])
        offered, keep_keys = offered[keep], pair[keep] * nodes + end[keep]
        order = np.lexsort((offered, keep_keys))
        offered, keep_keys = offered[order], keep_keys[order]
        least = np.flatnonzero(np.r_[True, keep_keys[1:] != keep_keys[:-1]]) if len(keep_keys) else np.zeros(0, dtype="int64")
        offered, keep_keys = offered[least], keep_keys[least]
        place, there = _found(keep_keys, keys)
        better = ~there if not len(keys) else ~there | (offered < costs[place])
        new_keys, new_costs = keep_keys[better], offered[better]
        place, there = place[better], there[better]
        costs[place[there]] = new_costs[there]
        keys, costs = np.concatenate([keys, new_keys[~there]]), np.concatenate([costs, new_costs[~there]])
        order = np.argsort(keys, kind="stable")
        keys, costs = keys[order], costs[order]
    return keys, costs


def _steps(best: np.ndarray, at: np.ndarray, start: np.ndarray, goal: np.ndarray, limit: np.ndarray, keys: np.ndarray, costs: np.ndarray,
           back: Arcs, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, arcs of ``back``): each pair's path in order; of arcs that give a node its cost the first is followed."""
    def label(pair: np.ndarray, node: np.ndarray) -> np.ndarray:
        near = best[at[pair] + node]
        far = np.flatnonzero(near > limit[pair])
        place, there = _found(pair[far] * nodes + node[far], keys)
        near[far] = np.where(there, costs[place], np.inf) if len(keys) else np.inf
        return near

    open_ = np.flatnonzero(goal != start)
    here = goal.copy()
    pairs, arcs = [], []
    while len(open_):
        which, arc = back.at(here[open_])
        pair = open_[which]
        fits = label(pair, back.end[arc]) + back.cost[arc] == label(open_, here[open_])[which]
        which, arc = which[fits], arc[fits]
        first = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
        if len(first) != len(open_):
            raise RuntimeError("a path without a step back")
        arc = arc[first]
        pairs.append(open_)
        arcs.append(arc)
        here[open_] = back.end[arc]
        open_ = open_[here[open_] != start[open_]]
    if not pairs:
        return np.zeros(len(goal), dtype="int64"), np.zeros(0, dtype="int64")
    pair, arc = np.concatenate(pairs[::-1]), np.concatenate(arcs[::-1])        # the last step back is the first arc
    return np.bincount(pair, minlength=len(goal)), arc[np.argsort(pair, kind="stable")]


def search(starts: np.ndarray, owner: np.ndarray, goal: np.ndarray, nodes: int, src: np.ndarray, dst: np.ndarray, cost: np.ndarray,
           size: int, with_path: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(costs, done, lengths, steps) of the pairs (``starts[owner]``, ``goal``), which come in order of ``owner``; arcs come in order of (dst, via).

    Costs are infinity for what cannot be reached. Pairs not done are left to another search: their source
    held a ``GIVE_UP`` part of the nodes. ``steps`` are arcs, path after path.
    """
    ahead = Arcs.of(src, dst, cost, nodes)
    back = Arcs.of(dst, src, cost, nodes)                                   # keeps the order of the arcs
    targets, aim = np.unique(goal, return_inverse=True)
    held = balls(targets, back, nodes, size)
    finite = held.radius[np.isfinite(held.radius)]
    usual = float(np.median(finite)) if len(finite) else 1.0
    width = max(16, min(256, DENSE // nodes))
    best, queued = np.full(width * nodes, np.inf), np.zeros(width * nodes, dtype=bool)
    costs, done = np.full(len(goal), np.inf), np.zeros(len(goal), dtype=bool)
    lengths, steps = np.zeros(len(goal), dtype="int64"), []
    for low in range(0, len(starts), width):
        mine = np.arange(*np.searchsorted(owner, [low, low + width]))
        run = Searches(best, queued, starts[low:low + width], ahead, nodes)
        run.limit[:] = usual
        from_, at, to = owner[mine] - low, (owner[mine] - low) * nodes, aim[mine]
        most = np.full(len(mine), np.inf)
        open_ = np.arange(len(mine))
        given_up = np.zeros(len(run.limit), dtype=bool)
        while True:
            run.relax()
            waits = run.waits()
            run.limit[np.isinf(waits) & ~given_up] = np.inf
            most[open_] = _met(best, at[open_], to[open_], held)
            settled = most[open_] * (1 + SLACK) <= run.limit[from_[open_]] + held.radius[to[open_]]
            open_ = open_[~settled & ~(np.isinf(run.limit[from_[open_]]) | given_up[from_[open_]])]
            if not len(open_):
                break
            keys = run.labels()
            held_by = np.bincount(keys // nodes, minlength=len(run.limit))
            given_up |= (held_by * GIVE_UP > nodes) & (np.bincount(from_[open_], minlength=len(run.limit)) > 0)
            open_ = open_[~given_up[from_[open_]]]
            asked = np.zeros(len(run.limit))
            need = np.where(np.isfinite(most[open_]), most[open_] * (1 + 2 * SLACK) - held.radius[to[open_]], np.inf)
            np.maximum.at(asked, from_[open_], need)
            grows = asked > 0
            run.limit[grows] = np.maximum(np.minimum(asked[grows], run.limit[grows] * GROWTH), waits[grows])
        ok = most * (1 + SLACK) <= run.limit[from_] + held.radius[to]
        ok |= np.isinf(run.limit[from_])
        done[mine] = ok
        there = np.flatnonzero(ok & np.isfinite(most))
        if len(there):
            at, to, limit, bound = at[there], to[there], run.limit[from_[there]], most[there] * (1 + SLACK)
            start, end = starts[owner[mine[there]]], goal[mine[there]]
            near = best[at + end] <= limit
            pair, node = _crossings(best, at[~near], to[~near], limit[~near], bound[~near], held)
            pair = np.flatnonzero(~near)[pair]
            keys, values = _tails(pair, node, best[at[pair] + node], best, at, to, limit, bound, held, ahead, nodes)
            place, _ = _found(np.flatnonzero(~near) * nodes + end[~near], keys)
            value = best[at + end]
            value[~near] = values[place] if len(values) else np.inf
            costs[mine[there]] = value
            if with_path:
                lengths[mine[there]], taken = _steps(best, at, start, end, limit, keys, values, back, nodes)
                steps.append(taken)
        run.clear()
    return costs, done, lengths, np.concatenate(steps) if steps else np.zeros(0, dtype="int64")
