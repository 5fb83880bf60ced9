"""Measures of effectiveness by link, and by time bin where the configuration has one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.config import FIVE_MINUTES, MoeConfig
from roadpulse.functions.scalars import elapsed_micros, exact, inexact, ratio, time_bin, total
from roadpulse.operators.pieces import HOT_ROWS, PIECE_S, cold_and_hot, piece_segments, with_previous
from roadpulse.operators.sequence import journey_order, with_segments


def keys(config: MoeConfig) -> list[str]:
    return ["link_key"] if config.bin_minutes is None else ["link_key", "time_bin"]


def selected(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows on the given links. Links are far fewer than observations; Spark broadcasts them if they are small enough."""
    return rows.join(links.select("link_key").dropna().distinct(), "link_key", "left_semi")


#: Marks that ``touching`` keeps, whatever the number of journeys: 64 of them to a row of 16 bytes, a megabyte in all.
MARKS = 1 << 22


def touching(observations: DataFrame, links: DataFrame) -> DataFrame:
    """The observations of all journeys that are on one of the links at least once, and of few others; measures of the links stay the same.

    What measures sort and shuffle by journey falls to the share of these journeys. They are known by marks of their hash, a table of bounded
    size that is broadcast, so the rest goes before the shuffle, at the price of a scan of two columns. Journeys that share a mark with
    another one stay, with no effect: they have no rows on the links. Beyond some millions of journeys on the links most marks are set
    and little is saved.
    """
    mark = F.pmod(F.xxhash64("journey_id"), F.lit(MARKS))
    on_links = selected(observations.filter(F.col("journey_id").isNotNull()).select("journey_id", "link_key"), links).select(mark.alias("__mark"))
    bit = "shiftleft(1L, cast(__mark & 63 as int))"
    marks = on_links.groupBy(F.expr("__mark div 64").alias("__word")).agg(F.bit_or(F.expr(bit)).alias("__bits"))
    rows = observations.withColumn("__mark", F.when(F.col("journey_id").isNotNull(), mark)).withColumn("__word", F.expr("__mark div 64"))
    rows = rows.join(F.broadcast(marks), "__word").filter(F.expr(f"__bits & {bit} <> 0"))  # at most MARKS / 64 rows
    return rows.select(*[F.col(f"`{c}`") for c in observations.columns])


def _valid(config: MoeConfig) -> Column:
    ok = F.col("speed_mph") >= 0
    return F.coalesce(ok & F.col("event_time").isNotNull() if config.require_time else ok, F.lit(False))


def valid_waypoints(segments: DataFrame, links: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    return selected(segments.filter(_valid(config)), links)


def binned_runs(segments: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    """One row per run (and bin) on any link, with its sums and first time: what all measures need, from one pass.

    A change of speed is taken between valid rows that follow each other in a run, so it bridges rows without
    a valid speed. Runs and bins rise in the journey's order, so the order of the trips serves here too, and so does its
    distribution by journey. Speeds are summed as decimals; those that no decimal holds (infinite ones) apart. Segments in pieces
    (of ``pieces.piece_segments``) stay in them.
    """
    groups = [*keys(config), "journey_id", "trip_segment", "run_id"]
    inner = [c for c in ("run_id", "time_bin") if c in groups]
    valid = _valid(config)
    rows = segments.withColumn("valid", valid)
    if "major" in segments.columns:
        rows = with_previous(rows, "event_time", "before", [*inner, "speed_mph"], F.col("valid"))
    else:
        earlier = journey_order().rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("before", F.last(F.when(F.col("valid"), F.struct(*inner, "speed_mph")), ignorenulls=True).over(earlier))
    same = F.col("valid")
    for c in inner:
        same = same & F.col(c).eqNullSafe(F.col(f"before.{c}"))
    speed, slow = F.when(F.col("valid"), F.col("speed_mph")), F.col("valid") & (F.col("speed_mph") < config.slow_mph)
    jump = F.when(same, F.abs(F.col("speed_mph") - F.col("before.speed_mph")))
    fine = F.when(same, F.abs(exact(F.col("speed_mph")) - exact(F.col("before.speed_mph"))))
    zero = F.lit(0).cast("decimal(38,10)")
    return rows.filter(F.col("link_key").isNotNull()).groupBy(*groups).agg(
        F.count_if("valid").alias("n"),
        F.coalesce(F.sum(exact(speed)), zero).alias("speed_sum"),
        F.sum(inexact(speed)).alias("speed_more"),
        F.count_if(slow).alias("slow"),
        F.coalesce(F.sum(exact(F.when(slow, speed))), zero).alias("slow_sum"),
        F.coalesce(F.sum(fine), zero).alias("change_sum"),
        F.sum(F.when(fine.isNull(), jump)).alias("change_more"),
        F.min("event_time").alias("first_time"),
    )


def run_stats(segments: DataFrame, links: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    """The runs (and bins) with valid waypoints on the given links."""
    return selected(binned_runs(segments, config).filter("n > 0").drop("first_time"), links)


def _dsh() -> Column:
    return total(F.col("change_sum"), F.col("change_more")) / F.col("n")


def waypoint_metrics(stats: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    return stats.groupBy(*keys(config)).agg(
        F.sum("n").alias("waypoint_count"),
        F.count_distinct("journey_id").alias("journey_count"),
        total(F.sum("speed_sum"), F.sum("speed_more")).alias("total_speed"),
        F.sum("slow").alias("slow_movement_count"),
        F.sum("slow_sum").cast("double").alias("slow_speed_sum"),
    )


def dsh_runs(stats: DataFrame) -> DataFrame:
    """Speed harmony of each run: the sum of changes over the number of speeds (not of changes)."""
    return stats.withColumn("trip_dsh", _dsh())


def dsh_metrics(stats: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    return dsh_runs(stats).groupBy(*keys(config)).agg(F.count("*").alias("dsh_trip_count"), F.sum("trip_dsh").alias("dsh_sum"))


def run_entries(segments: DataFrame) -> DataFrame:
    """When each run begins, on any link."""
    rows = segments.filter(F.col("link_key").isNotNull() & F.col("event_time").isNotNull())
    return rows.groupBy("journey_id", "trip_segment", "run_id", "link_key").agg(F.min("event_time").alias("entry_time"))


def traversals(segments: DataFrame, links: DataFrame) -> DataFrame:
    """Runs on the given links between two other runs of the trip, with the time from entry to the next entry."""
    w = Window.partitionBy("journey_id", "trip_segment").orderBy("entry_time", "run_id")
    runs = run_entries(segments).withColumns({"previous_link": F.lag("link_key").over(w), "next_link": F.lead("link_key").over(w), "next_entry_time": F.lead("entry_time").over(w)})
    runs = runs.withColumn("travel_time_us", elapsed_micros(F.col("entry_time"), F.col("next_entry_time")))
    return selected(runs.filter(F.col("previous_link").isNotNull() & F.col("next_link").isNotNull() & (F.col("travel_time_us") > 0)), links)


def travel_time_metrics(crossings: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    """Counted in the bin of the entry."""
    rows = crossings if config.bin_minutes is None else crossings.withColumn("time_bin", time_bin(F.col("entry_time"), config.bin_minutes))
    return rows.groupBy(*keys(config)).agg(F.count("*").alias("complete_traversal_count"), (F.sum("travel_time_us") / 1_000_000.0).alias("travel_time_sum_s"))


#: Runs of a hot trip that stay together.
_RUNS = 4096


def _with_travel(runs: DataFrame, spread: bool = False) -> DataFrame:
    """Runs (and bins) with ``travel_time_us`` where a complete traversal begins: from a run's first time to that of the next run of the trip.

    Runs of a trip have consecutive numbers, so their neighbours are one number away. With ``spread`` a trip is cut into stretches of
    runs, and the runs at their ends are in the next stretch too, as neighbours.
    """
    trip = Window.partitionBy("journey_id", "trip_segment").orderBy("run_id")
    if spread:
        near = F.array_distinct(F.array(*[F.floor((F.col("run_id") + k) / _RUNS).cast("long") for k in (0, -1, 1)]))
        runs = runs.withColumn("stretch", F.explode(near))
        trip = Window.partitionBy("journey_id", "trip_segment", "stretch").orderBy("run_id")
    beside = lambda c, k: F.min(c).over(trip.rangeBetween(k, k))
    runs = runs.withColumns({"entry": beside("first_time", 0), "previous_link": beside("link_key", -1), "next_link": beside("link_key", 1), "next_entry": beside("first_time", 1)})
    took = elapsed_micros(F.col("entry"), F.col("next_entry"))
    complete = (F.col("first_time") == F.col("entry")) & F.col("previous_link").isNotNull() & F.col("next_link").isNotNull() & (took > 0)
    runs = runs.withColumn("travel_time_us", F.when(complete, took))
    return runs.filter(F.col("stretch") == F.floor(F.col("run_id") / _RUNS)).drop("stretch") if spread else runs


def runs_with_travel(observations: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    """All runs (and bins) with their sums and traversals: one scan and one shuffle by journey."""
    return _with_travel(binned_runs(with_segments(observations, config), config))


def split_runs_with_travel(observations: DataFrame, config: MoeConfig = FIVE_MINUTES, most: int = HOT_ROWS, piece_s: int = PIECE_S) -> DataFrame:
    """The rows of ``runs_with_travel``; a journey with more than ``most`` observations is worked on in pieces."""
    cold, hot = cold_and_hot(observations, most)
    runs = runs_with_travel(cold, config)
    return runs if hot is None else runs.unionByName(_with_travel(binned_runs(piece_segments(hot, config, piece_s), config), spread=True))


#: What is added up to a cell; partial results of a journey in a cell have these columns too.
SUMS = ["n", "speed_sum", "speed_more", "slow", "slow_sum", "runs", "dsh", "crossed", "travel"]


def partial_sums(runs: DataFrame, links: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    """A row with ``SUMS`` for each cell and journey, from runs with travel times: summed where a journey's runs are."""
    own = selected(runs, links).withColumns({
        "runs": (F.col("n") > 0).cast("long"), "dsh": F.when(F.col("n") > 0, _dsh()), "crossed": F.col("travel_time_us").isNotNull().cast("long"), "travel": F.col("travel_time_us"),
    })
    return own.groupBy(*keys(config), "journey_id").agg(*[F.sum(c).alias(c) for c in SUMS])


def final_measures(partials: DataFrame, config: MoeConfig = FIVE_MINUTES, merge: bool = False) -> DataFrame:
    """The measures of each cell, with total_speed and slow_speed_sum, from partial sums; ``merge`` where a journey may have several rows in a cell."""
    by = keys(config)
    if merge:
        partials = partials.groupBy(*by, "journey_id").agg(*[F.sum(c).alias(c) for c in SUMS])
    return measured(partials.groupBy(*by).agg(F.count_if(F.col("n") > 0).alias("journey_count"), *[F.sum(c).alias(c) for c in SUMS]), by)


def measured(cells: DataFrame, by: list[str]) -> DataFrame:
    """The measures of cells of which ``SUMS`` and journey_count are known; cells without valid waypoints go."""
    speed = total(F.col("speed_sum"), F.col("speed_more"))
    crossed = F.when(F.col("crossed") > 0, F.col("crossed"))
    return cells.filter("n > 0").select(
        *by, F.col("n").alias("waypoint_count"), "journey_count", speed.alias("total_speed"), F.col("slow").alias("slow_movement_count"), F.col("slow_sum").cast("double").alias("slow_speed_sum"),
        (ratio(F.col("slow_sum").cast("double"), speed) * 100.0).alias("slow_movement_pct"), F.col("runs").alias("dsh_trip_count"), (F.col("dsh") / F.col("runs")).alias("DSH"),
        crossed.alias("complete_traversal_count"), (F.col("travel") / 1_000_000.0 / F.col("crossed")).alias("avg_travel_time_s"),
    )


def _combined(runs: DataFrame, links: DataFrame, config: MoeConfig) -> DataFrame:
    return final_measures(partial_sums(runs, links, config), config)


MOE_COLUMNS = ["waypoint_count", "journey_count", "slow_movement_count", "slow_movement_pct", "dsh_trip_count", "DSH", "complete_traversal_count", "avg_travel_time_s"]


CORRIDOR_MOE_COLUMNS = ["corridor_order", "link_key", "time_bin", "distance_start_ft", "distance_end_ft", "link_length_ft", "posted_speed_limit_mph", "avg_speed_mph", "speed_reduction_pct", *MOE_COLUMNS]


def link_moe(observations: DataFrame, links: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    """All measures of the given links. A cell without valid waypoints has no row; one without complete traversals has nulls there."""
    return _combined(runs_with_travel(observations, config), links, config).select(*keys(config), *MOE_COLUMNS)


def split_link_moe(observations: DataFrame, links: DataFrame, config: MoeConfig = FIVE_MINUTES, most: int = HOT_ROWS, piece_s: int = PIECE_S) -> DataFrame:
    """``link_moe`` where a journey may hold any share of the observations."""
    return _combined(split_runs_with_travel(observations, config, most, piece_s), links, config).select(*keys(config), *MOE_COLUMNS)


def corridor_moe(observations: DataFrame, corridor: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    """The measures of a corridor's links with mean speed and its reduction against the posted limit.

    ``corridor`` should be a stored table (as of ``corridor.build_corridor``), as it is read twice.
    """
    own = ["corridor_order", "link_key", "distance_start_ft", "distance_end_ft", "link_length_ft", "posted_speed_limit_mph"]
    moe = _combined(runs_with_travel(observations, config), corridor, config).withColumn("avg_speed_mph", F.col("total_speed") / F.col("waypoint_count"))
    limit = F.col("posted_speed_limit_mph")
    moe = moe.join(corridor.select(*own), "link_key", "left").withColumn("speed_reduction_pct", ratio(limit - F.col("avg_speed_mph"), limit) * 100.0)
    return moe.select("corridor_order", *keys(config), *own[2:], "avg_speed_mph", "speed_reduction_pct", *MOE_COLUMNS)
