"""Exact nearest-shape search by an equi-join on cells.

The network's box is cut into cells, top-down.  A shape stays a candidate of a
cell while it can still be the nearest one for some point inside: with ``c`` the
cell's centre and ``slack`` a bound on how much any distance can change between
``c`` and a point of the cell, that is ``d(c, shape) <= min d(c, .) + 2 * slack``.
Dense regions are cut deeper than empty ones.  A point then looks up its cell
and compares only that cell's candidates; nothing is cut off by a radius.

Cells that serve every point inside them must be many where long shapes cross: n lines
over the whole box need n * n / k cells for k candidates each.  So batches against a network
beyond one array do not look up deep cells.  Their points meet the shapes of a coarse cell in
one task, which goes on cutting around the points that are there (``shortlist``); what is left
per point is compared exactly.  The deep cells are made when a stream or a small network asks.

Bound used.  Projection on a segment (in raw degrees) moves the offset vector
"point minus foot" by at most the distance the point moved.  The great circle
length of an offset grows by at most ``R * pi / 180`` metres per degree, plus a
change of the cosine term with latitude that is proportional to the extent of
the box; both together are capped by the plain triangle inequality (factor 2).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from wayfleet.functions import geo
from wayfleet.operators.shortlist import shortlister
from wayfleet.session import cut, ship_package, task_count

SPLIT = 4                       # a cell is cut into SPLIT x SPLIT parts per round
REGION_LEVEL = 4                # 16 x 16 regions, each with its own depth
REGIONS = 1 << REGION_LEVEL
MAX_LEVEL = 24
MARGIN = 0.125                  # the box reaches this much beyond the network on each side
ARRAY_LIMIT = 4096              # most candidates held in one array
DENSE_MEAN = 48                 # cut on while cells hold more candidates than this on average
ROWS_PER_SHAPE = 4              # ... and cutting has not multiplied a region's rows too much
METRES_PER_DEGREE = geo.EARTH_RADIUS_M * math.pi / 180
OUTSIDE = -1                    # level of the row that serves points beyond the box
NOWHERE = -2                    # level of points without coordinates
COARSE_MEAN = 1 << 18           # shapes of a coarse cell that one task may hold
GROUP_POINTS = 1 << 17          # points of a coarse cell that meet its shapes in one task


@dataclass(frozen=True)
class NearestIndex:
    """Distinct shapes plus the handful of numbers needed to find a point's cell; cells are made on first use."""

    shapes: DataFrame           # one row per distinct geometry
    metric: str                 # "road" (metres to a segment) or "planar" (squared degrees)
    box: tuple[float, float, float, float]
    n_shapes: int
    dense_mean: int = DENSE_MEAN
    rows_per_shape: int = ROWS_PER_SHAPE
    array_limit: int = ARRAY_LIMIT

    @property
    def in_one_row(self) -> bool:
        """True if every point, also beyond the box, is served by one candidate row."""
        return self.n_shapes <= self.array_limit

    @cached_property
    def _deep(self) -> tuple[DataFrame, list[int], int]:
        return _candidate_arrays(self)

    @property
    def cells(self) -> DataFrame:
        """level, x, y, part, candidates."""
        return self._deep[0]

    @property
    def depths(self) -> list[int]:
        """Level of each region, REGIONS * REGIONS entries."""
        return self._deep[1]

    @property
    def parts(self) -> int:
        """Most parts any cell needed."""
        return self._deep[2]

    @cached_property
    def coarse(self) -> tuple[DataFrame, list[int]]:
        """(level, x, y, shape) rows of cells small enough for one task, and the level of each region."""
        finished, depths = _cut_cells(self, COARSE_MEAN, always=True)
        return _tagged(finished, self.shapes.columns), depths


# ---- distance of a point to a shape -------------------------------------
def _with_distance(rows: DataFrame, metric: str, name: str) -> DataFrame:
    """Distance from (_lat, _lon) to the row's shape, one step per column so nothing is worked out twice."""
    if metric == "planar":
        return rows.withColumn(name, F.sqrt(geo.planar_d2("_lat", "_lon", "a_lat", "a_lon")))
    # Stated as never null: otherwise the optimizer adds a null test to the scan that
    # spells the whole formula out again.
    return (rows.withColumn("_t", geo.segment_fraction("_lat", "_lon", "a_lat", "a_lon", "b_lat", "b_lon"))
            .withColumn("_h", geo.haversine_h("_lat", "_lon", geo.foot_coordinate(F.col("_t"), "a_lat", "b_lat"),
                                              geo.foot_coordinate(F.col("_t"), "a_lon", "b_lon")))
            .withColumn(name, F.coalesce(geo.metres_from_h(F.col("_h")), F.lit(float("inf")))).drop("_t", "_h"))


def _best_candidate(metric: str, plat: Column, plon: Column, candidates: Column) -> Column:
    """struct(rank, seq, id) of the nearest candidate; the smallest seq wins a tie."""
    if metric == "planar":
        scored = F.transform(candidates, lambda s: F.struct(
            geo.planar_d2(plat, plon, s["a_lat"], s["a_lon"]).alias("rank"),
            s["seq"].alias("seq"), s["id"].alias("id")))
        return F.array_min(scored)
    with_t = F.transform(candidates, lambda s: F.struct(
        s.alias("s"),
        geo.segment_fraction(plat, plon, s["a_lat"], s["a_lon"], s["b_lat"], s["b_lon"]).alias("t")))
    with_foot = F.transform(with_t, lambda x: F.struct(
        geo.foot_coordinate(x["t"], x["s"]["a_lat"], x["s"]["b_lat"]).alias("lat"),
        geo.foot_coordinate(x["t"], x["s"]["a_lon"], x["s"]["b_lon"]).alias("lon"),
        x["s"]["seq"].alias("seq"), x["s"]["id"].alias("id")))
    scored = F.transform(with_foot, lambda f: F.struct(
        geo.haversine_h(plat, plon, f["lat"], f["lon"]).alias("rank"),
        f["seq"].alias("seq"), f["id"].alias("id")))
    return F.array_min(scored)


# ---- building -----------------------------------------------------------
def _distinct_shapes(shapes: DataFrame) -> DataFrame:
    """Shapes with bit-equal geometry can never be told apart: keep the first of them.

    Ends are put in a fixed order first, so both directions of a street coincide.
    """
    a = F.struct(F.col("a_lat").alias("lat"), F.col("a_lon").alias("lon"))
    b = F.struct(F.col("b_lat").alias("lat"), F.col("b_lon").alias("lon"))
    ordered = shapes.select("seq", "id", F.least(a, b).alias("p"), F.greatest(a, b).alias("q"))
    return (ordered.select("seq", "id", F.col("p.lat").alias("a_lat"), F.col("p.lon").alias("a_lon"),
                           F.col("q.lat").alias("b_lat"), F.col("q.lon").alias("b_lon"))
            .groupBy("a_lat", "a_lon", "b_lat", "b_lon")
            .agg(F.min(F.struct("seq", "id")).alias("first"))
            .select(F.col("first.seq").alias("seq"), F.col("first.id").alias("id"),
                    "a_lat", "a_lon", "b_lat", "b_lon"))


def _box_around(shapes: DataFrame) -> tuple[tuple[float, float, float, float], int]:
    r = shapes.agg(
        F.min(F.least("a_lat", "b_lat")).alias("lat0"), F.max(F.greatest("a_lat", "b_lat")).alias("lat1"),
        F.min(F.least("a_lon", "b_lon")).alias("lon0"), F.max(F.greatest("a_lon", "b_lon")).alias("lon1"),
        F.count(F.lit(1)).alias("n")).first()
    if r["n"] == 0:
        return (0.0, 0.0, 1.0, 1.0), 0
    height = max(r["lat1"] - r["lat0"], 1e-4)
    width = max(r["lon1"] - r["lon0"], 1e-4)
    return (r["lat0"] - MARGIN * height, r["lon0"] - MARGIN * width,
            height * (1 + 2 * MARGIN), width * (1 + 2 * MARGIN)), r["n"]


def _steepness(metric: str, box) -> tuple[float, float]:
    """(factor, constant): a distance changes by at most factor * r + constant while the point moves by r degrees."""
    lat0, lon0, height, width = box
    if metric == "planar":
        return 1 + 1e-9, 1e-12
    steepest = max(abs(lat0), abs(lat0 + height))
    flattest = math.cos(math.radians(min(steepest, 89.9)))
    return min(2.0, 1 + 1.1 * math.radians(width) / flattest) * METRES_PER_DEGREE, 1e-3


def _slack(metric: str, box, level: int) -> float:
    radius = math.hypot(box[2], box[3]) / (1 << level) / 2 * (1 + 1e-9)
    factor, constant = _steepness(metric, box)
    return factor * radius + constant


def _split_once(cells: DataFrame, level: int, metric: str, box) -> DataFrame:
    """Cut every cell into SPLIT x SPLIT and drop the shapes that can no longer win in a part."""
    lat0, lon0, height, width = box
    new_level = level + int(math.log2(SPLIT))
    step_lat, step_lon = height / (1 << new_level), width / (1 << new_level)
    offsets = F.array(*[F.lit(i) for i in range(SPLIT * SPLIT)])
    # Few, small rows become many: deal them out first.  The best distance per cell is
    # written, so its size is known and the join needs no shuffle while it is small.
    parts = (cells.repartition(task_count(cells.sparkSession)).withColumn("_o", F.explode(offsets))
             .withColumn("x", (F.col("x") * SPLIT + F.floor(F.col("_o") / SPLIT)).cast("long"))
             .withColumn("y", (F.col("y") * SPLIT + F.col("_o") % SPLIT).cast("long"))
             .drop("_o"))
    c_lat = F.lit(lat0) + (F.col("x") + 0.5) * step_lat
    c_lon = F.lit(lon0) + (F.col("y") + 0.5) * step_lon
    measured = _with_distance(parts.withColumn("_lat", c_lat).withColumn("_lon", c_lon), metric, "_d")
    nearest = cut(measured.groupBy("x", "y").agg(F.min("_d").alias("_best")), "nearest")
    return (measured.join(nearest, ["x", "y"])
            .filter(F.col("_d") <= F.col("_best") + 2 * _slack(metric, box, new_level))
            .drop("_d", "_best", "_lat", "_lon"))


def _number_list(numbers: list[int]) -> Column:
    return F.expr(f"array({', '.join(map(str, numbers))})")


def _region_of(level: int) -> tuple[Column, Column]:
    shift = level - REGION_LEVEL
    return F.shiftright(F.col("x"), shift), F.shiftright(F.col("y"), shift)


def build_index(shapes: DataFrame, metric: str, dense_mean: int = DENSE_MEAN,
                rows_per_shape: int = ROWS_PER_SHAPE, array_limit: int = ARRAY_LIMIT) -> NearestIndex:
    """Index over rows (seq, id, a_lat, a_lon, b_lat, b_lon)."""
    if metric not in ("road", "planar"):
        raise ValueError(f"unknown metric {metric}")
    distinct = cut(_distinct_shapes(shapes), "shapes")
    box, n = _box_around(distinct)
    return NearestIndex(distinct, metric, box, int(n), dense_mean, rows_per_shape, array_limit)


def _cut_cells(index: NearestIndex, dense_mean: int, always: bool = False) -> tuple[list[tuple[int, DataFrame]], list[int]]:
    """Finished cells by level, and the level of each region; without ``always`` a small network stays one cell."""
    metric, box = index.metric, index.box
    cells = index.shapes.select(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), *index.shapes.columns)
    level, step = 0, int(math.log2(SPLIT))
    finished: list[tuple[int, DataFrame]] = []
    depths = [0] * (REGIONS * REGIONS)
    if not always and index.n_shapes <= dense_mean:
        return [(0, cells)], depths
    while level < REGION_LEVEL:
        cells = cut(_split_once(cells, level, metric, box), "cells")
        level += step
    start_rows: dict[tuple[int, int], int] = {}
    while True:
        rx, ry = _region_of(level)
        counts = (cells.groupBy(rx.alias("rx"), ry.alias("ry"))
                  .agg(F.count(F.lit(1)).alias("n")).collect())   # at most REGIONS * REGIONS rows
        sizes = {(r["rx"], r["ry"]): r["n"] for r in counts}
        if not start_rows:
            start_rows = sizes
        per_region = (1 << (level - REGION_LEVEL)) ** 2
        deeper = {k for k, rows in sizes.items()
                  if rows > dense_mean * per_region
                  and rows <= index.rows_per_shape * start_rows[k] and level + step <= MAX_LEVEL}
        for k in sizes:
            depths[k[0] * REGIONS + k[1]] = level
        if not deeper:
            finished.append((level, cells))
            return finished, depths
        flags = [int((i // REGIONS, i % REGIONS) in deeper) for i in range(REGIONS * REGIONS)]
        goes_on = F.get(_number_list(flags), (rx * REGIONS + ry).cast("int")) == 1
        if len(deeper) < len(sizes):
            finished.append((level, cells.filter(~goes_on)))
        cells = cut(_split_once(cells.filter(goes_on), level, metric, box), "cells")
        level += step


def _tagged(finished: list[tuple[int, DataFrame]], columns: list[str]) -> DataFrame:
    leaves = None
    for level, part in finished:
        tagged = part.select(F.lit(level).alias("level"), "x", "y", *columns)
        leaves = tagged if leaves is None else leaves.unionByName(tagged)
    return leaves


def _candidate_arrays(index: NearestIndex) -> tuple[DataFrame, list[int], int]:
    """Candidates of every cell in arrays, the level of each region, and the most parts a cell needed."""
    distinct, array_limit = index.shapes, index.array_limit
    finished, depths = _cut_cells(index, index.dense_mean)
    leaves = _tagged(finished, distinct.columns)
    if index.n_shapes <= array_limit:
        leaves = leaves.unionByName(distinct.select(
            F.lit(OUTSIDE).alias("level"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"),
            *distinct.columns))
    sized = leaves.groupBy("level", "x", "y").agg(F.count(F.lit(1)).alias("_n"))
    largest = sized.agg(F.max("_n")).first()[0] or 0
    if largest <= array_limit:
        split = leaves.withColumn("parts", F.lit(1)).withColumn("part", F.lit(0))
    else:
        split = (leaves.join(sized, ["level", "x", "y"])
                 .withColumn("parts", F.ceil(F.col("_n") / (array_limit / 2)).cast("int"))
                 .withColumn("part", F.pmod(F.hash("seq"), F.col("parts"))))
        # A part may get no shape: count those that did, as a point meets only them.
        filled = split.select("level", "x", "y", "part").distinct().groupBy("level", "x", "y").agg(F.count(F.lit(1)).cast("int").alias("parts"))
        split = split.drop("parts").join(filled, ["level", "x", "y"])
    arrays = cut(split.groupBy("level", "x", "y", "parts", "part")
                 .agg(F.collect_list(F.struct(*distinct.columns)).alias("candidates")), "candidates")
    most = math.ceil(largest / (array_limit / 2)) if largest > array_limit else 1
    return arrays, depths, int(most)


# ---- looking up ---------------------------------------------------------
def _cell_columns(box, depths: list[int], lat: str, lon: str) -> dict[str, Column]:
    lat0, lon0, height, width = box
    u, v = (F.col(lat) - lat0) / height, (F.col(lon) - lon0) / width
    inside = (u >= 0) & (u < 1) & (v >= 0) & (v < 1)
    table = _number_list(depths)
    region = (F.floor(u * REGIONS) * REGIONS + F.floor(v * REGIONS)).cast("int")
    depth = F.when(inside, F.get(table, region)).when(u.isNotNull() & v.isNotNull(), F.lit(OUTSIDE))
    scale = F.get(_number_list([1 << d for d in depths]), region)
    return {
        "_level": depth,
        "_x": F.when(inside, F.floor(u * scale)).otherwise(F.lit(0)).cast("long"),
        "_y": F.when(inside, F.floor(v * scale)).otherwise(F.lit(0)).cast("long"),
    }


def _join_cells(points: DataFrame, index: NearestIndex, salts: int) -> DataFrame:
    cells = index.cells.select(F.col("level").alias("_level"), F.col("x").alias("_x"), F.col("y").alias("_y"),
                               F.col("parts").alias("_parts"), F.col("candidates").alias("_candidates"))
    keys = ["_level", "_x", "_y"]
    if salts > 1:
        # A hot cell's points are spread over `salts` tasks; its candidates are copied to each.
        points = points.withColumn("_salt", F.pmod(F.xxhash64(*points.columns), F.lit(salts)).cast("int"))
        cells = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys = [*keys, "_salt"]
    return points.join(cells, keys, "left").drop(*keys)


def _whole_network(index: NearestIndex) -> tuple[DataFrame, int]:
    """All shapes in arrays (_chunk, _candidates) of about the index's limit, and their number."""
    chunks = math.ceil(index.n_shapes / index.array_limit)
    return (index.shapes.withColumn("_chunk", F.pmod(F.hash("seq"), F.lit(chunks)))
            .groupBy("_chunk").agg(F.collect_list(F.struct(*index.shapes.columns)).alias("_candidates"))), chunks


def _best_by_parts(located: DataFrame, index: NearestIndex, lat: str, lon: str, out: str) -> DataFrame:
    """Row by row for cells of several candidate rows: one join per row of a cell, then the least hit.

    No state and no shuffle by point, so a stream can take it. The joins grow with the
    network (one per ``array_limit`` shapes for points beyond the box); for very large
    ones ``jobs.start_traffic`` matches inside the batch instead.
    """
    def joined(rows: DataFrame, side: DataFrame, keys: list[str], name: str) -> DataFrame:
        best = _best_candidate(index.metric, F.col(lat), F.col(lon), F.col("_candidates"))
        return rows.join(side, keys, "left").withColumn(name, best).drop("_candidates")

    hits = []
    for part in range(index.parts):
        cells = index.cells.filter(F.col("part") == part).select(
            F.col("level").alias("_level"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("candidates").alias("_candidates"))
        hits.append(f"_hit{part}")
        located = joined(located, cells, ["_level", "_x", "_y"], hits[-1])
    if index.n_shapes > index.array_limit:
        arrays, chunks = _whole_network(index)
        for chunk in range(chunks):
            side = arrays.filter(F.col("_chunk") == chunk).select(F.lit(OUTSIDE).alias("_level"), "_candidates")
            hits.append(f"_far{chunk}")
            located = joined(located, side, ["_level"], hits[-1])
    return located.withColumn(out, F.least(*hits) if len(hits) > 1 else F.col(hits[0]))


def _outside_matches(points: DataFrame, index: NearestIndex, lat: str, lon: str) -> DataFrame:
    """Matches for points beyond the box when the network is too large for one array.

    Distinct positions only, so that repeated ones (such as 0, 0) cost one search.
    """
    arrays, chunks = _whole_network(index)
    far = (points.filter(F.col("_level") == OUTSIDE).select(lat, lon).distinct()
           .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    best = _best_candidate(index.metric, F.col(lat), F.col(lon), F.col("_candidates"))
    return (far.join(arrays, "_chunk").groupBy(lat, lon).agg(F.min(best).alias("_far")))


def _with_shortlists(located: DataFrame, index: NearestIndex, lat: str, lon: str) -> DataFrame:
    """Add ``_candidates``: the shapes of a point's coarse cell that may be nearest to it, those of equal distance included.

    Points of a cell meet its shapes in one task, those of a crowded cell in several, each with
    its own copy of the shapes.  Points beyond the box or without coordinates get none.
    """
    ship_package(located.sparkSession)
    regions, _ = index.coarse
    keys, tasks = ["_level", "_x", "_y"], task_count(located.sparkSession)
    located = located.withColumn("_level", F.coalesce("_level", F.lit(NOWHERE)))
    groups = cut(located.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / GROUP_POINTS).cast("int").alias("_groups")), "groups")
    dealt = F.pmod(F.xxhash64(*[c for c in located.columns if c not in keys]), F.coalesce("_groups", F.lit(1))).cast("int")
    points = located.join(groups, keys, "left").withColumn("_group", dealt).drop("_groups")
    shapes = regions.withColumnsRenamed({"level": "_level", "x": "_x", "y": "_y"}).join(groups, keys).select(
        *keys, F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_group"), *index.shapes.columns)
    fields = index.shapes.schema
    schema = StructType([*located.schema.fields, StructField("_candidates", ArrayType(fields))])
    search = shortlister(index.metric, lat, lon, located.columns, fields.names, *_steepness(index.metric, index.box))
    keys = [*keys, "_group"]
    return (points.repartition(tasks, *keys).groupBy(*keys)
            .cogroup(shapes.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(search, schema))


def attach_nearest(points: DataFrame, index: NearestIndex, lat: str = "latitude", lon: str = "longitude",
                   out: str = "nearest", salts: int = 1) -> DataFrame:
    """Add ``out`` = struct(rank, seq, id), null where a coordinate is missing or there are no shapes.

    Row-wise (no shuffle by point) when ``index.in_one_row``, and for streams always;
    ``salts`` is for these row-wise joins.
    """
    original = points.columns
    in_batch = not index.in_one_row and not points.isStreaming
    located = points
    for name, expr in _cell_columns(index.box, index.coarse[1] if in_batch else index.depths, lat, lon).items():
        located = located.withColumn(name, expr)
    best = _best_candidate(index.metric, F.col(lat), F.col(lon), F.col("_candidates"))

    if index.in_one_row:
        return _join_cells(located, index, salts).select(*original, best.alias(out))
    if points.isStreaming:
        return _best_by_parts(located, index, lat, lon, out).select(*original, out)

    far = cut(_outside_matches(located, index, lat, lon), "far")
    met = _with_shortlists(located, index, lat, lon).withColumn(out, best)
    return (met.join(far, [lat, lon], "left")
            .withColumn(out, F.when(F.col("_level") == OUTSIDE, F.col("_far")).otherwise(F.col(out)))
            .select(*original, out))
