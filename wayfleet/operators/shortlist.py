"""Which shapes may be nearest to each point of a group, inside one task.

The points are halved until few are left, and every part drops the shapes that can
no longer win anywhere among its points (the bound of ``nearest``).  So the work
follows the points that are there: empty space costs nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from wayfleet.functions.geo import EARTH_RADIUS_M

LEAF = 24                   # points that are compared with all shapes left
FEW = 12                    # shapes that are compared with all points left
BLOCK = 1 << 18             # distances worked out at once
SAME, NEARLY = 1e-9, 1e-13  # relative and absolute difference up to which two roots may be equal in exact comparison


def _roots(metric: str, lat, lon, shapes: np.ndarray) -> np.ndarray:
    """Root of the haversine to a segment, or degrees to a point; ``shapes`` holds a_lat, a_lon, b - a, 1 / squared length."""
    a_lat, a_lon, d_lat, d_lon, scale = shapes
    if metric == "planar":
        return np.hypot(lat - a_lat, lon - a_lon)
    t = (lat - a_lat) * d_lat
    t += (lon - a_lon) * d_lon
    t *= scale
    np.clip(t, 0.0, 1.0, out=t)
    foot_lat = t * d_lat
    foot_lat += a_lat
    t *= d_lon
    t += a_lon
    t -= lon
    t *= np.pi / 360
    east = np.sin(t, out=t)
    east *= east
    east *= np.cos(np.radians(foot_lat)) * np.cos(np.radians(lat))
    foot_lat -= lat
    foot_lat *= np.pi / 360
    north = np.sin(foot_lat, out=foot_lat)
    north *= north
    north += east
    return np.sqrt(north, out=north)


def shortlist(metric: str, lat: np.ndarray, lon: np.ndarray, shapes: np.ndarray, factor: float, constant: float) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, numbers): for each point the numbers of the shapes that may be nearest, all that tie included."""
    rows, picks = [], []
    todo = [(np.arange(len(lat)), np.arange(shapes.shape[1]), shapes)]
    while todo:
        at, numbers, own = todo.pop()
        low_lat, high_lat, low_lon, high_lon = lat[at].min(), lat[at].max(), lon[at].min(), lon[at].max()
        radius = np.hypot(high_lat - low_lat, high_lon - low_lon) / 2 * (1 + 1e-9)
        distance = _roots(metric, (low_lat + high_lat) / 2, (low_lon + high_lon) / 2, own)
        if metric == "road":
            distance = 2 * EARTH_RADIUS_M * np.arcsin(np.minimum(distance, 1.0))
        kept = np.flatnonzero(distance <= distance.min() + 2 * (factor * radius + constant))
        numbers, own = numbers[kept], own[:, kept]
        if len(at) > LEAF and len(numbers) > FEW and radius > 0:
            axis = lat if high_lat - low_lat > high_lon - low_lon else lon
            order, half = np.argpartition(axis[at], len(at) // 2), len(at) // 2
            todo += [(at[order[:half]], numbers, own), (at[order[half:]], numbers, own)]
            continue
        step = max(1, BLOCK // len(numbers))
        for i in range(0, len(at), step):
            part = at[i:i + step]
            root = _roots(metric, lat[part, None], lon[part, None], own)
            row, pick = np.nonzero(root <= root.min(axis=1, keepdims=True) * (1 + SAME) + NEARLY)
            rows.append(part[row])
            picks.append(numbers[pick])
    row, pick = np.concatenate(rows), np.concatenate(picks)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lat)))])
    return offsets, pick[np.argsort(row, kind="stable")]


def shortlister(metric: str, lat: str, lon: str, columns: list[str], fields: list[str], factor: float,
                constant: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Function over the points and the shapes of a group: the points with the column ``_candidates``."""
    def search(points: pa.Table, shapes: pa.Table) -> pa.Table:
        kept = points.select(columns)
        offsets, numbers = np.zeros(len(kept) + 1, dtype="int32"), np.zeros(0, dtype="int64")
        if len(kept) and len(shapes):
            ends = [shapes[c].to_numpy() for c in ("a_lat", "a_lon", "b_lat", "b_lon")]
            d_lat, d_lon = ends[2] - ends[0], ends[3] - ends[1]
            squared = d_lat * d_lat + d_lon * d_lon
            scale = np.divide(1.0, squared, out=np.zeros_like(squared), where=squared > 0)
            offsets, numbers = shortlist(metric, kept[lat].to_numpy(), kept[lon].to_numpy(),
                                         np.array([ends[0], ends[1], d_lat, d_lon, scale]), factor, constant)
        picked = shapes.select(fields).take(pa.array(numbers)).combine_chunks()
        structs = pa.StructArray.from_arrays([picked[c].combine_chunks() if picked[c].num_chunks != 1 else picked[c].chunk(0) for c in fields], names=fields)
        return kept.append_column("_candidates", pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), structs))

    return search
