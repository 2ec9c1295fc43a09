"""Genetic stop order: many vehicles, one row each, no shuffle between generations.

A population belongs to its vehicle's row. Single steps are columns; the whole search
runs the same steps over arrays inside tasks (``evolve``).  All choices come from digests of (seed, vehicle, generation,
individual, slot), so a recomputed task repeats them exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfleet.functions import geo
from wayfleet.functions.scalars import drawn, drawn_from, slot_text
from wayfleet.operators.evolve import evolver
from wayfleet.session import ship_package, task_count


@dataclass(frozen=True)
class SearchConfig:
    population: int = 30
    generations: int = 60
    mutation_rate: float = 0.15
    elite: int = 2
    seed: int = 0


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``: the fold of nothing, finished by ``body``.

    Taking the one element of a transformed array would do the same, but asks for the type of all that is nested in it at each row.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def _draw(who: Column, slot: int, n: Column) -> Column:
    """Integer in [0, n) that the slots in ``who`` and ``slot`` decide."""
    return F.pmod(drawn_from(F.concat(who, F.lit(f":{slot}"))), n.cast("long")).cast("int")


def _numbers(upto: Column, start: int = 0) -> Column:
    """start .. upto-1, or nothing."""
    return F.when(upto > start, F.sequence(F.lit(start), upto.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


# ---- building blocks ----------------------------------------------------
def shuffled_order(cfg: SearchConfig, vehicle: Column, individual: Column, n: Column) -> Column:
    """0 .. n-1 in a random but repeatable order."""
    keyed = F.transform(_numbers(n), lambda s: F.struct(drawn(cfg.seed, vehicle, individual, s).alias("h"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def order_crossover(first: Column, second: Column, begin: Column, end: Column) -> Column:
    """Keep [begin, end) of ``first`` in place and fill the other slots in the order of ``second``."""
    kept = F.slice(first, begin + 1, F.greatest(end - begin, F.lit(0)))
    rest = _let(kept, lambda k: F.filter(second, lambda s: ~F.array_contains(k, s)))
    return _let(rest, lambda free: F.transform(first, lambda x, at: F.when(at < begin, F.get(free, at))
                                               .when(at < end, x).otherwise(F.get(free, at - end + begin))))


def swap_mutation(order: Column, i: Column, j: Column, hit: Column) -> Column:
    """Exchange the entries at i and j when ``hit``."""
    swapped = F.transform(order, lambda x, k: F.when(k == i, F.get(order, j)).when(k == j, F.get(order, i)).otherwise(x))
    return F.when(hit, swapped).otherwise(order)


def leg_hours(stops: Column, speed: Column) -> Column:
    """Travel time from each stop to each stop, a row of the array per stop."""
    return F.transform(stops, lambda a: F.transform(stops, lambda b: geo.haversine_km(
        a["latitude"], a["longitude"], b["latitude"], b["longitude"]) / speed))


def order_hours(order: Column, legs: Column) -> Column:
    """Travel time along the stops in this order, looked up in ``legs``."""
    def add(state, k):
        leg = F.when(state["at"] < 0, F.lit(0.0)).otherwise(F.get(F.get(legs, state["at"]), k))
        return F.struct((state["h"] + leg).alias("h"), k.alias("at"))
    return F.aggregate(order, F.struct(F.lit(0.0).alias("h"), F.lit(-1).alias("at")), add, lambda s: s["h"])


def ranked(population: Column, legs: Column) -> Column:
    """Scored individuals, best first; the earlier one on a tie, that is of equal hours to nine decimals.

    ``legs`` is worked out once per row, not again for each step of each individual.
    """
    return _let(legs, lambda table: F.array_sort(F.transform(population, lambda o, i: _let(order_hours(o, table), lambda hours: F.struct(
        F.round(hours, 9).alias("about"), i.alias("i"), hours.alias("hours"), o.alias("order"))))))


def select_parents(scored: Column, cfg: SearchConfig) -> Column:
    return F.slice(scored, 1, max(cfg.elite, cfg.population // 2))


def _two_places(who: Column, slot: int, n: Column) -> Column:
    """Two different places in [0, n), the smaller first."""
    return _let(_draw(who, slot, n), lambda x: _let(
        _draw(who, slot + 1, n - 1), lambda y: F.array_sort(F.array(x, F.when(y >= x, y + 1).otherwise(y)))))


def bred_child(parents: Column, cfg: SearchConfig, vehicle: Column, generation: Column, i: Column, n: Column) -> Column:
    """Child ``i`` of two drawn parents, by crossover between two drawn places."""
    def bred(who):
        mother = F.get(parents, _draw(who, 1, F.size(parents)))["order"]
        father = F.get(parents, _draw(who, 2, F.size(parents)))["order"]
        crossed = _let(mother, lambda m: _let(_two_places(who, 3, n), lambda at: order_crossover(m, father, at[0], at[1])))
        return F.when(n > 1, crossed).otherwise(mother)
    return _let(slot_text(cfg.seed, vehicle, generation, i), bred)


def mutated_child(order: Column, cfg: SearchConfig, vehicle: Column, generation: Column, i: Column, n: Column) -> Column:
    """``order`` with two drawn places exchanged, at the rate of the configuration."""
    def mutated(who):
        hit = _draw(who, 7, F.lit(1_000_000)) < int(cfg.mutation_rate * 1_000_000)
        swapped = _let(_two_places(who, 5, n), lambda at: swap_mutation(order, at[0], at[1], F.lit(True)))
        return F.when((n > 1) & hit, swapped).otherwise(order)
    return _let(slot_text(cfg.seed, vehicle, generation, i), mutated)


def next_generation(scored: Column, cfg: SearchConfig, vehicle: Column, generation: Column, n: Column) -> Column:
    """The elites unchanged, then mutated children of random parent pairs."""
    def child(parents, i):
        return _let(bred_child(parents, cfg, vehicle, generation, i, n),
                    lambda order: mutated_child(order, cfg, vehicle, generation, i, n))

    elites = F.transform(F.slice(scored, 1, cfg.elite), lambda s: s["order"])
    children = F.sequence(F.lit(cfg.elite), F.lit(cfg.population - 1))
    return F.concat(elites, _let(select_parents(scored, cfg), lambda parents: F.transform(
        children, lambda i: child(parents, i))))


# ---- driver -------------------------------------------------------------
def dealt(facts: DataFrame) -> DataFrame:
    """Vehicles dealt to all tasks by their id; what is grouped or joined by vehicle afterwards stays where it is."""
    return facts.repartition(task_count(facts.sparkSession), "vehicle_id")


def ga_init(facts: DataFrame, cfg: SearchConfig) -> DataFrame:
    """First population: rows (vehicle_id, individual, order), those of a vehicle in one task.

    The rows of ``facts`` are few and each becomes a population, so they are dealt out to all tasks.
    """
    rows = dealt(facts).select("vehicle_id", F.size("stops").alias("n"),
                               F.explode(F.sequence(F.lit(0), F.lit(cfg.population - 1))).alias("individual"))
    return rows.select("vehicle_id", "individual",
                       shuffled_order(cfg, F.col("vehicle_id"), F.col("individual"), F.col("n")).alias("order"))


def ga_optimize(facts: DataFrame, cfg: SearchConfig = SearchConfig(), trace: bool = False) -> DataFrame:
    """(vehicle_id, order, fitness, generations): best order over all scored generations.

    ``facts``: (vehicle_id, stops, speed_kmh, start_cost, penalty).  The population of a
    vehicle is bounded by the configuration and by the stops in its own document.
    ``trace`` adds the best score after each generation.
    """
    if cfg.elite >= cfg.population or cfg.generations < 1:
        raise ValueError("elite must be smaller than the population, and one generation is the least")
    # Rows are few and each is a whole search, so they are dealt out to all tasks.
    spark = facts.sparkSession
    ship_package(spark)
    some = facts.repartition(task_count(spark)).withColumn("n", F.size("stops"))
    kept = [f for f in facts.select("vehicle_id", "stops", "start_cost", "penalty").schema.fields]
    ready = some.filter("n > 0").select(*[f.name for f in kept], "n", F.flatten(leg_hours(F.col("stops"), F.col("speed_kmh"))).alias("legs"))
    found = StructType.fromDDL("_order array<int>, _hours double, _trace array<double>").fields
    searched = ready.mapInArrow(evolver(cfg), StructType([*kept, *found]))
    out = searched.select(
        "vehicle_id", F.transform("_order", lambda i: F.get(F.col("stops"), i)).alias("order"),
        (F.col("start_cost") + F.col("_hours") + F.col("penalty")).alias("fitness"),
        F.lit(cfg.generations).alias("generations"), *([F.col("_trace").alias("trace")] if trace else []))
    # A null list of stops has no order either.
    idle = facts.filter(~F.coalesce(F.size("stops") > 0, F.lit(False))).select(
        "vehicle_id", F.slice("stops", 1, 0).alias("order"), F.lit(0.0).alias("fitness"), F.lit(0).alias("generations"),
        *([F.lit(None).cast("array<double>").alias("trace")] if trace else []))
    return out.unionByName(idle)
