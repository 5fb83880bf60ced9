"""Trips and link runs: gaps and islands over the observations of each journey.

One shuffle by journey and one sort serve all windows here and those of the operators that follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadpulse.config import FIVE_MINUTES, MoeConfig
from roadpulse.functions.scalars import elapsed_micros, time_bin


def journey_order(time: str = "event_time") -> WindowSpec:
    return Window.partitionBy("journey_id").orderBy(F.col(time).asc_nulls_last(), "obs_id")


def segment_flags(before_time: Column, before_link: Column, config: MoeConfig = FIVE_MINUTES) -> tuple[Column, Column]:
    """Whether a row begins a trip, and whether it begins a run, by its journey's row before."""
    late = F.coalesce(elapsed_micros(before_time, F.col("event_time")) > F.lit(int(config.gap_s * 1_000_000)), F.lit(False))
    new_trip = late | F.col("link_key").isNull() | before_link.isNull()
    return new_trip, new_trip | (F.col("link_key") != before_link)


def with_segments(observations: DataFrame, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    """(obs_id, journey_id, event_time, speed_mph, link_key, trip_segment, run_id[, time_bin]).

    A trip ends at a pause longer than ``gap_s``, and before and after an observation without a link. A
    run is a stretch of a trip on one link. Rows without a journey are dropped; rows without a time
    come last and end no trip. Numbers of trips and runs count within the journey.
    """
    w = journey_order()
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = observations.filter(F.col("journey_id").isNotNull()).select("obs_id", "journey_id", F.col("local_time").alias("event_time"), "speed_mph", "link_key")
    rows = rows.withColumns({"before_time": F.lag("event_time").over(w), "before": F.lag("link_key").over(w)})
    new_trip, new_run = segment_flags(F.col("before_time"), F.col("before"), config)
    rows = rows.withColumns({"new_trip": new_trip, "new_run": new_run})
    rows = rows.withColumns({"trip_segment": F.sum(F.col("new_trip").cast("long")).over(running), "run_id": F.sum(F.col("new_run").cast("long")).over(running)})
    rows = rows.drop("before_time", "before", "new_trip", "new_run")
    return rows if config.bin_minutes is None else rows.withColumn("time_bin", time_bin(F.col("event_time"), config.bin_minutes))


def link_runs(segments: DataFrame) -> DataFrame:
    """One row per run on a link: its observations and first and last time."""
    return segments.filter(F.col("link_key").isNotNull()).groupBy("journey_id", "trip_segment", "run_id", "link_key").agg(
        F.count("*").alias("points"), F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time")
    )
