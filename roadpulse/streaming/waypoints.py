"""Waypoint measures of five minutes over a stream of observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.config import FIVE_MINUTES, MoeConfig
from roadpulse.functions.scalars import exact, inexact, ratio, total


def stream_waypoints(observations: DataFrame, links: DataFrame, config: MoeConfig = FIVE_MINUTES, lateness: str = "10 minutes") -> DataFrame:
    """Counts and speeds by link and bin, each given out once its bin is older than ``lateness``; works on tables too.

    Distinct journeys are counted approximately in a stream, as exact sets would grow without bound. The
    watermark needs instants, so wall-clock times are taken in the session's zone.
    """
    rows = observations.filter(F.col("journey_id").isNotNull() & F.col("local_time").isNotNull() & (F.col("speed_mph") >= 0))
    rows = rows.join(links.select("link_key").dropna().distinct(), "link_key", "left_semi").withColumn("event_time", F.col("local_time").cast("timestamp"))
    slow = F.col("speed_mph") < config.slow_mph
    speed = exact(F.col("speed_mph"))
    out = rows.withWatermark("event_time", lateness).groupBy("link_key", F.window("event_time", f"{config.bin_minutes} minutes").alias("bin")).agg(
        F.count("*").alias("waypoint_count"), F.approx_count_distinct("journey_id").alias("journey_count"),
        total(F.coalesce(F.sum(speed), F.lit(0)), F.sum(inexact(F.col("speed_mph")))).alias("total_speed"), F.count_if(slow).alias("slow_movement_count"), F.sum(F.when(slow, speed)).cast("double").alias("slow_speed_sum"),
    )
    pct = ratio(F.coalesce("slow_speed_sum", F.lit(0.0)), F.col("total_speed")) * 100.0
    return out.select("link_key", F.col("bin.start").cast("timestamp_ntz").alias("time_bin"), "waypoint_count", "journey_count", "slow_movement_count", pct.alias("slow_movement_pct"))
