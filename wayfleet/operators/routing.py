"""Edge costs, shortest paths for many pairs at once, and routes over stops."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfleet.functions import scalars as X
from wayfleet.operators.network import components_of_links
from wayfleet.operators.relax import searcher
from wayfleet.session import cut, ship_package, task_count

INFINITY = float("inf")
PAIR_LIMIT = 12          # up to this many stops, all legs of a vehicle are priced in one go


# ---- costs --------------------------------------------------------------
def edge_costs(edges: DataFrame, state: DataFrame | None = None, blocked: DataFrame | None = None) -> DataFrame:
    """(edge_seq, edge_id, src, dst, cost) in seconds.

    Blocked and congested edges are left out; a positive live travel time
    replaces the time at the speed limit.
    """
    rows = edges.select("edge_seq", "edge_id", F.col("start_node.node_id").alias("src"),
                        F.col("end_node.node_id").alias("dst"),
                        X.static_cost_s("length_meters", "max_speed_kmh").alias("static_cost"))
    if blocked is not None:
        rows = rows.join(blocked.select("edge_id"), "edge_id", "left_anti")
    cost: Column = F.col("static_cost")
    if state is not None:
        live = state.select("edge_id", F.col("estimated_travel_time").alias("_live"), F.col("is_congested").alias("_jam"))
        rows = rows.join(live, "edge_id", "left").filter(~F.coalesce("_jam", F.lit(False)))
        cost = F.when(F.col("_live") > 0, F.col("_live")).otherwise(F.col("static_cost"))
    return rows.select("edge_seq", "edge_id", "src", "dst", cost.alias("cost")).filter("cost > 0")


def _cheapest_arcs(costs: DataFrame) -> DataFrame:
    """One arc per ordered node pair; parallel edges can never improve on the cheapest."""
    return (costs.filter("src <> dst").groupBy("src", "dst")
            .agg(F.min(F.struct("cost", "edge_seq", "edge_id")).alias("a"))
            .select("src", "dst", F.col("a.cost").alias("arc_cost"), F.col("a.edge_seq").alias("via"),
                    F.col("a.edge_id").alias("edge_id")))


# ---- shortest paths -----------------------------------------------------
HOPS_PER_WRITE = 6
ARCS_IN_TASK = 1 << 21   # up to this many arcs (estimated at some 300 MB), a task holds the network and searches for its own sources
LANES_PER_CORE = 4
BALL = 1.2               # nodes of a search from a target, as a multiple of the root of all nodes; it ends with some two times as many
HELD_IN_TASK = 1 << 25   # nodes of such searches that a task keeps, 12 bytes each
SOURCE_WORK = 3          # a search from a source, which grows until its pairs are met, in searches from a target (0.8 ms at 60,000 nodes)
FEWER = 4                # searches from both ends are taken where their balls hold so many times fewer nodes than whole searches


def _grid(sources: int, targets: int, nodes: int, cores: int) -> tuple[int, int, int]:
    """(lanes of sources, lanes of targets, nodes of a search from a target; 0: whole searches from the sources).

    A lane repeats the searches of its sources for each lane of targets, and the other way round.
    """
    ball = max(1, int(BALL * nodes ** 0.5))
    fits = [b for b in range(1, cores + 1) if cores % b == 0 and targets * 2 * ball <= HELD_IN_TASK * b]
    work = lambda lanes: SOURCE_WORK * lanes[1] * sources + lanes[0] * targets
    by, to = min(((cores // b, b) for b in fits), key=work, default=(1, -(-targets * 2 * ball // HELD_IN_TASK)))
    if work((by, to)) * ball * FEWER < sources * nodes:
        return by, to, ball
    return max(1, min(LANES_PER_CORE * cores, sources)), 1, 0


def _lane_keys(spark: SparkSession, lanes: int) -> Column:
    """Array of numbers that a repartition by them puts into a partition each."""
    rows = (spark.range(32 * lanes + 256).select(F.col("id").cast("int").alias("k")).groupBy(F.pmod(F.hash("k"), F.lit(lanes)).alias("p"))
            .agg(F.min("k").alias("k")).collect())
    keys = {r.p: r.k for r in rows}
    return F.array(*[F.lit(keys.get(i, 32 * lanes + 256 + i)).cast("int") for i in range(lanes)])


def _searched(goals: DataFrame, arcs: DataFrame, nodes: int, with_path: bool) -> DataFrame:
    """(source, target, cost, path) of the goals that are reached: goals dealt to lanes by their ends, each with a copy of the arcs.

    Nothing but the reached goals leaves a task, where ``_labels`` writes every source's label of
    every node several times.
    """
    spark = goals.sparkSession
    ship_package(spark)
    ends = goals.agg(F.count_distinct("source"), F.count_distinct("target")).first()
    by, to, ball = _grid(*ends, nodes, spark.sparkContext.defaultParallelism)
    lanes, keys = by * to, _lane_keys(spark, by * to)

    def lane(name: str, count: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(count)).cast("int")

    dealt = goals.withColumn("_lane", F.element_at(keys, lane("source", by) * to + lane("target", to) + 1))
    copies = arcs.select("src", "dst", "arc_cost", "via", "edge_id", F.explode(keys).alias("_lane"))
    schema = "source long, target long, cost double" + (", path array<string>" if with_path else "")
    return (dealt.repartition(lanes, "_lane").groupBy("_lane").cogroup(copies.repartition(lanes, "_lane").groupBy("_lane"))
            .applyInArrow(searcher(with_path, ball), schema))


def _labels(goals: DataFrame, arcs: DataFrame, max_rounds: int) -> DataFrame:
    """Cheapest (source, node, cost, via) from every source, relaxed hop by hop.

    Each hop sends on the labels improved in the hop before, unless they already
    cost as much as the source's dearest goal; all others stay put by way of a
    free "stay" arc, so a hop is one join and one aggregation.  With many sources
    the labels are partitioned by source: while the arc table is small enough to
    be broadcast, several hops then run without a shuffle (a source has at most
    one label per node).  The labels are written every few hops, which ends the
    lineage and lets a lost executor cost no more than that.
    """
    spark = goals.sparkSession
    tasks = task_count(spark)
    sources = goals.select("source").distinct()
    labels = cut(sources.select("source", F.col("source").alias("node"), F.lit(0.0).alias("cost"),
                                F.lit(None).cast("long").alias("via"), F.lit(0).alias("hop")), "labels")
    by_source = labels.count() >= 4 * tasks
    ends = arcs.select(F.col("src").alias("n")).unionByName(arcs.select(F.col("dst").alias("n"))).distinct()
    moves = cut(arcs.select("src", "dst", "arc_cost", F.col("via").alias("_via"), F.lit(False).alias("_stay")).unionByName(
        ends.select(F.col("n").alias("src"), F.col("n").alias("dst"), F.lit(0.0).alias("arc_cost"),
                    F.lit(None).cast("long").alias("_via"), F.lit(True).alias("_stay"))), "moves")
    hop = 0
    for _ in range(max_rounds):
        reached = labels.select("source", F.col("node").alias("target"), "cost")
        limit = (goals.join(reached, ["source", "target"], "left").groupBy("source")
                 .agg(F.max("cost").alias("_dearest"), F.count_if(F.col("cost").isNull()).alias("_open"))
                 .select("source", F.when(F.col("_open") == 0, F.col("_dearest")).otherwise(F.lit(INFINITY)).alias("_limit")))
        rows = labels.join(cut(limit, "limit"), "source")
        if by_source:
            rows = rows.repartition(tasks, "source")
        for _ in range(HOPS_PER_WRITE):
            hop += 1
            fresh = (F.col("hop") == hop - 1) & (F.col("cost") < F.col("_limit"))
            sent = rows.join(moves, (F.col("node") == F.col("src")) & (F.col("_stay") | fresh)).select(
                "source", F.col("_limit"), F.col("dst").alias("node"), (F.col("cost") + F.col("arc_cost")).alias("cost"),
                F.when(F.col("_stay"), F.col("via")).otherwise(F.col("_via")).alias("via"),
                F.when(F.col("_stay"), F.col("hop")).otherwise(F.lit(hop)).alias("hop"))
            rows = (sent.groupBy("source", "node")
                    .agg(F.min("cost").alias("_c"), F.min_by("via", "cost").alias("via"),
                         F.min_by("hop", "cost").alias("hop"), F.max("_limit").alias("_limit"))
                    .withColumnRenamed("_c", "cost"))
        labels = cut(rows.select("source", "node", "cost", "via", "hop"), "labels")
        if labels.filter(F.col("hop") == hop).isEmpty():
            return labels.drop("hop")
    raise RuntimeError("shortest paths did not settle")


def _least_arcs(labels: DataFrame, arcs: DataFrame) -> DataFrame:
    """The labels with, of all arcs that give a node its cost, the smallest: ties do not depend on the order of work."""
    ahead = labels.select("source", F.col("node").alias("src"), F.col("cost").alias("_so_far"))
    given = (ahead.join(arcs.select("src", F.col("dst").alias("node"), "arc_cost", F.col("via").alias("_arc")), "src")
             .select("source", "node", (F.col("_so_far") + F.col("arc_cost")).alias("cost"), "_arc"))
    least = given.join(labels.select("source", "node", "cost"), ["source", "node", "cost"], "left_semi").groupBy("source", "node").agg(F.min("_arc").alias("_arc"))
    return cut(labels.join(least, ["source", "node"], "left").select(
        "source", "node", "cost", F.when(F.col("via").isNotNull(), F.coalesce("_arc", "via")).alias("via")), "labels")


def _parts(arcs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((source, _from), (target, _to)): the component of each node that arcs leave and of each that arcs enter."""
    component = cut(components_of_links(arcs.select(F.col("src").alias("a"), F.col("dst").alias("b"))), "parts")
    leaves = arcs.select(F.col("src").alias("source")).distinct().join(
        component.select(F.col("node_id").alias("source"), F.col("component").alias("_from")), "source")
    enters = arcs.select(F.col("dst").alias("target")).distinct().join(
        component.select(F.col("node_id").alias("target"), F.col("component").alias("_to")), "target")
    return cut(leaves, "leaves"), cut(enters, "enters")


def _possible(pairs: DataFrame, leaves: DataFrame, enters: DataFrame) -> DataFrame:
    """Pairs that may be connected at all.

    A goal that cannot be reached would keep its source searching everything it
    can reach, so ends without arcs and ends in different components are left out.
    """
    return (pairs.join(leaves, "source").join(enters, "target")
            .filter(F.col("_from") == F.col("_to")).select("source", "target"))


def _trace(ends: DataFrame, labels: DataFrame, arcs: DataFrame, steps_per_write: int = HOPS_PER_WRITE) -> DataFrame:
    """Follow predecessors from each target back to its source, collecting edge ids in order."""
    back = cut(labels.filter("via is not null").join(arcs.select("via", "src", "edge_id"), "via")
               .select("source", "node", F.col("src").alias("_prev"), F.col("edge_id").alias("_edge")), "back")
    rows = ends.select("source", "target", F.col("target").alias("node"), F.array().cast("array<string>").alias("path"))
    while True:
        for _ in range(steps_per_write):
            rows = (rows.join(back, ["source", "node"], "left")
                    .select("source", "target", F.coalesce("_prev", "node").alias("node"),
                            F.when(F.col("_prev").isNull(), F.col("path"))
                            .otherwise(F.concat(F.array("_edge"), F.col("path"))).alias("path")))
        rows = cut(rows, "trace")
        if rows.filter(F.col("node") != F.col("source")).isEmpty():
            return rows.select("source", "target", "path")


def _numbered(nodes: DataFrame) -> DataFrame:
    """(node_id, no): a number per node, written once so that it stays the same."""
    return cut(nodes.select("node_id").distinct().withColumn("no", F.monotonically_increasing_id()), "numbers")


@dataclass(frozen=True)
class Network:
    """What all searches over one table of costs share."""

    numbers: DataFrame          # (node_id, no)
    arcs: DataFrame             # cheapest arcs between numbers
    leaves: DataFrame           # see _parts
    enters: DataFrame


def network_of(costs: DataFrame, nodes: DataFrame | None = None) -> Network:
    """Nodes go by number inside, which keeps the rows of a search small and of fixed width."""
    if nodes is None:
        nodes = costs.select(F.col("src").alias("node_id")).unionByName(costs.select(F.col("dst").alias("node_id")))
    numbers = _numbered(nodes)
    arcs = cut(_cheapest_arcs(costs).join(_number(numbers, "src", "_s"), "src").join(_number(numbers, "dst", "_d"), "dst")
               .select(F.col("_s").alias("src"), F.col("_d").alias("dst"), "arc_cost", "via", "edge_id"), "arcs")
    return Network(numbers, arcs, *_parts(arcs))


def _number(numbers: DataFrame, name: str, out: str) -> DataFrame:
    return numbers.select(F.col("node_id").alias(name), F.col("no").alias(out))


def shortest_paths(pairs: DataFrame, costs: DataFrame, nodes: DataFrame | None = None,
                   with_path: bool = True, max_rounds: int = 100_000) -> DataFrame:
    """(source, target, cost, path) for each distinct pair.

    Equal ends cost 0 with an empty path; an unknown or unreachable end costs
    infinity with an empty path.  All pairs share one search per distinct source.
    """
    return paths_between(pairs, network_of(costs, nodes), with_path, max_rounds)


def paths_between(pairs: DataFrame, network: Network, with_path: bool = True, max_rounds: int = 100_000) -> DataFrame:
    """As ``shortest_paths``, over a network that may serve several calls."""
    numbers, arcs = network.numbers, network.arcs
    wanted = cut(pairs.select("source", "target").distinct(), "pairs")
    asked = cut(wanted.join(_number(numbers, "source", "_s"), "source").join(_number(numbers, "target", "_t"), "target"), "asked")
    goals = cut(_possible(asked.filter("_s <> _t").select(F.col("_s").alias("source"), F.col("_t").alias("target")),
                          network.leaves, network.enters), "goals")
    if arcs.count() <= ARCS_IN_TASK:
        reached = cut(_searched(goals, arcs, numbers.count(), with_path), "reached").withColumnsRenamed({"source": "_s", "target": "_t"})
    else:
        labels = _labels(goals, arcs, max_rounds)
        reached = labels.join(goals.withColumnRenamed("target", "node"), ["source", "node"], "left_semi").select(
            F.col("source").alias("_s"), F.col("node").alias("_t"), "cost")
        if with_path:
            paths = _trace(reached.select(F.col("_s").alias("source"), F.col("_t").alias("target")), _least_arcs(labels, arcs), arcs)
            reached = reached.join(paths.withColumnsRenamed({"source": "_s", "target": "_t"}), ["_s", "_t"], "left")
    priced = (asked.join(reached, ["_s", "_t"], "left")
              .withColumn("cost", F.when(F.col("_s") == F.col("_t"), F.lit(0.0)).otherwise(F.col("cost"))))
    kept = ["cost", "path"] if with_path else ["cost"]
    out = (wanted.join(priced.select("source", "target", *kept), ["source", "target"], "left")
           .withColumn("cost", F.coalesce("cost", F.lit(INFINITY))))
    return out.withColumn("path", F.coalesce("path", F.array().cast("array<string>"))) if with_path else out


# ---- walking over stops -------------------------------------------------
def _own_pairs(starts: DataFrame, stops: DataFrame) -> DataFrame:
    """Legs a vehicle may need: from its start and from each stop to each other stop.

    Built inside one row per vehicle, and only for vehicles of at most PAIR_LIMIT stops.
    """
    row = (stops.groupBy("vehicle_id").agg(F.collect_set("node_id").alias("ends"))
           .join(starts, "vehicle_id"))
    return (row.select(F.explode(F.array_union(F.col("ends"), F.array("node"))).alias("source"), "ends")
            .select("source", F.explode("ends").alias("target"))
            .filter("source is not null and target is not null").distinct())


def _next_pairs(starts: DataFrame, numbered: DataFrame) -> DataFrame:
    """(vehicle_id, source, target): the legs of stops in order, if each can be reached from the one before."""
    placed = starts.filter("node is not null")
    before = F.lag("node_id").over(Window.partitionBy("vehicle_id").orderBy("_rank"))
    first = numbered.filter("_rank = 1").join(placed, "vehicle_id").select("vehicle_id", F.col("node").alias("source"), F.col("node_id").alias("target"))
    later = (numbered.join(placed, "vehicle_id", "left_semi").withColumn("source", before).filter("_rank > 1")
             .select("vehicle_id", "source", F.col("node_id").alias("target")))
    return first.unionByName(later)


def _ordered_legs(starts: DataFrame, stops: DataFrame, numbered: DataFrame, network: Network, with_path: bool) -> tuple[DataFrame, DataFrame]:
    """(legs, vehicle_id of the vehicles they may not suffice for): stops in order need one leg each.

    Only a vehicle with a stop that cannot be reached goes on from an earlier one; all its legs are priced then.
    """
    needed = cut(_next_pairs(starts, numbered), "next-pairs")
    legs = cut(paths_between(needed.filter("source is not null and target is not null"), network, with_path), "legs")
    priced = needed.join(legs.select("source", "target", "cost"), ["source", "target"], "left")
    broken = cut(priced.filter(F.coalesce("cost", F.lit(INFINITY)) == INFINITY).select("vehicle_id").distinct(), "broken")
    few = broken.join(stops.groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("n")), "vehicle_id").filter(F.col("n") <= PAIR_LIMIT)
    own = _own_pairs(starts.join(few, "vehicle_id", "left_semi"), stops.join(few, "vehicle_id", "left_semi"))
    extra = cut(own.join(legs.select("source", "target"), ["source", "target"], "left_anti"), "pairs")
    if not extra.isEmpty():
        legs = cut(legs.unionByName(paths_between(extra, network, with_path)), "legs")
    return legs, broken


def _walk(starts: DataFrame, stops: DataFrame, costs: DataFrame, nodes: DataFrame, greedy: bool,
          with_path: bool) -> tuple[DataFrame, DataFrame]:
    """Visit stops rank by rank, all vehicles together.

    ``starts``: (vehicle_id, node); ``stops``: (vehicle_id, stop_idx, node_id).
    Returns (steps, legs).  Greedy takes the cheapest open stop each time, else
    the stops come in the order of ``stop_idx``.  An unreachable stop leaves the
    position unchanged.
    """
    starts, stops = cut(starts, "starts"), cut(stops, "stops")
    counts = cut(stops.groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("n")), "counts")
    ranks = counts.agg(F.max("n")).first()[0] or 0
    few = counts.filter(F.col("n") <= PAIR_LIMIT)
    many = counts.filter(F.col("n") > PAIR_LIMIT).select("vehicle_id")
    network = network_of(costs, nodes)
    numbered = stops if greedy else cut(stops.withColumn(
        "_rank", F.row_number().over(Window.partitionBy("vehicle_id").orderBy("stop_idx"))), "numbered")
    if greedy:
        legs = cut(paths_between(_own_pairs(starts, stops.join(few, "vehicle_id", "left_semi")), network, with_path), "legs")
    else:
        legs, broken = _ordered_legs(starts, stops, numbered, network, with_path)
        many = many.join(broken, "vehicle_id", "left_semi")
    any_many = ranks > PAIR_LIMIT and not many.isEmpty()
    spark = stops.sparkSession

    here = starts.select("vehicle_id", F.col("node").alias("origin"))
    steps = None
    for rank in range(1, ranks + 1):
        open_stops = numbered
        if not greedy:
            open_stops = numbered.filter(F.col("_rank") == rank).drop("_rank")
        elif steps is not None:
            open_stops = numbered.join(steps.select("vehicle_id", "stop_idx"), ["vehicle_id", "stop_idx"], "left_anti")
        options = open_stops.join(here, "vehicle_id")
        if any_many:
            options = cut(options, "options")
            extra = options.join(many, "vehicle_id", "left_semi").select(F.col("origin").alias("source"), F.col("node_id").alias("target"))
            extra = extra.filter("source is not null and target is not null").distinct().join(legs, ["source", "target"], "left_anti")
            legs = cut(legs.unionByName(paths_between(extra, network, with_path)), "legs")
        prices = legs.select(F.col("source").alias("origin"), F.col("target").alias("node_id"), "cost")
        priced = (options.join(prices, ["origin", "node_id"], "left")
                  .withColumn("cost", F.coalesce("cost", F.lit(INFINITY))))
        pick = (priced.groupBy("vehicle_id")
                .agg(F.min(F.struct("cost", "stop_idx", "node_id", "origin")).alias("p"))
                .select("vehicle_id", F.lit(rank).alias("rank"), "p.stop_idx", "p.origin", "p.node_id", "p.cost")
                .withColumn("reached", F.col("cost") < INFINITY))
        if greedy:
            pick = pick.filter("reached")
        pick = cut(pick, "pick")
        steps = pick if steps is None else steps.unionByName(pick)
        here = pick.select("vehicle_id", F.when(F.col("reached"), F.col("node_id")).otherwise(F.col("origin")).alias("origin"))
    if steps is None:
        steps = spark.createDataFrame([], "vehicle_id string, rank int, stop_idx int, origin string, node_id string, cost double, reached boolean")
    return steps, legs


def greedy_order(starts: DataFrame, stops: DataFrame, costs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(vehicle_id, stop_idx, rank, cost): cheapest next stop first.

    Stops that cannot be reached follow in their given order, with no cost.
    """
    steps, _ = _walk(starts, stops, costs, nodes, greedy=True, with_path=False)
    taken = steps.select("vehicle_id", "stop_idx", "rank", "cost")
    done = taken.groupBy("vehicle_id").agg(F.max("rank").alias("_done"))
    rest = (stops.select("vehicle_id", "stop_idx").join(taken, ["vehicle_id", "stop_idx"], "left_anti")
            .join(done, "vehicle_id", "left")
            .withColumn("rank", F.coalesce("_done", F.lit(0))
                        + F.row_number().over(Window.partitionBy("vehicle_id").orderBy("stop_idx")))
            .select("vehicle_id", "stop_idx", "rank", F.lit(None).cast("double").alias("cost")))
    return taken.unionByName(rest)


def _routes(starts: DataFrame, steps: DataFrame, legs: DataFrame) -> DataFrame:
    """Concatenate the legs of each vehicle in rank order; at most one leg per stop."""
    joined = (steps.filter("reached")
              .join(legs.select(F.col("source").alias("origin"), F.col("target").alias("node_id"), "path"), ["origin", "node_id"]))
    return (starts.select("vehicle_id").join(
        joined.groupBy("vehicle_id").agg(
            F.array_sort(F.collect_list(F.struct("rank", "stop_idx", "cost", "path"))).alias("l")), "vehicle_id", "left")
        .select("vehicle_id",
                F.coalesce(F.flatten("l.path"), F.array().cast("array<string>")).alias("path"),
                F.coalesce(F.aggregate("l", F.lit(0.0), lambda a, x: a + x["cost"]), F.lit(0.0)).alias("total_cost"),
                F.coalesce(F.col("l.stop_idx"), F.array().cast("array<int>")).alias("visited")))


def build_routes(starts: DataFrame, ordered_stops: DataFrame, costs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(vehicle_id, path, total_cost, visited): legs through the stops in the given order.

    ``starts`` holds the node each vehicle begins at; one without a node gets an empty path.
    """
    steps, legs = _walk(starts, ordered_stops, costs, nodes, greedy=False, with_path=True)
    return _routes(starts, steps, legs)


def greedy_routes(starts: DataFrame, stops: DataFrame, costs: DataFrame, nodes: DataFrame) -> DataFrame:
    """As ``build_routes``, cheapest next stop first; what cannot be reached is dropped."""
    steps, legs = _walk(starts, stops, costs, nodes, greedy=True, with_path=True)
    return _routes(starts, steps, legs)


# ---- planar greedy ------------------------------------------------------
def planar_greedy_order(vehicles: DataFrame) -> DataFrame:
    """Order ``stops`` of each row by straight distance, nearest next, from (start_lat, start_lon).

    Works inside the row: ``stops`` is an array of structs with stop_idx, latitude, longitude.
    """
    def take(state, _):
        scored = F.transform(state["left"], lambda s: F.struct(
            ((s["latitude"] - state["lat"]) * (s["latitude"] - state["lat"])
             + (s["longitude"] - state["lon"]) * (s["longitude"] - state["lon"])).alias("d"),
            s["stop_idx"].alias("stop_idx"), s.alias("s")))
        return F.transform(F.array(F.array_min(scored)), lambda b: F.struct(
            b["s"]["latitude"].alias("lat"), b["s"]["longitude"].alias("lon"),
            F.filter(state["left"], lambda s: s["stop_idx"] != b["stop_idx"]).alias("left"),
            F.concat(state["order"], F.array(b["stop_idx"])).alias("order")))[0]

    start = F.struct(F.col("start_lat").cast("double").alias("lat"), F.col("start_lon").cast("double").alias("lon"),
                     F.transform("stops", lambda s: F.struct(
                         s["latitude"].alias("latitude"), s["longitude"].alias("longitude"),
                         s["stop_idx"].cast("int").alias("stop_idx"))).alias("left"),
                     F.array().cast("array<int>").alias("order"))
    turns = F.when(F.size("stops") > 0, F.sequence(F.lit(1), F.size("stops"))).otherwise(F.array().cast("array<int>"))
    return vehicles.withColumn("stop_order", F.aggregate(turns, start, take, lambda s: s["order"]))
