"""Windows over journeys that are too large for one task: a segmented scan with carried state.

A hot journey is cut by time into pieces. Windows run inside each piece; what a piece's first rows need of earlier ones (the row before,
running sums) is carried over a table with one row for each piece, which is all that meets by journey.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadpulse.config import FIVE_MINUTES, MoeConfig
from roadpulse.functions.scalars import micros, time_bin
from roadpulse.operators.sequence import segment_flags, with_segments
from roadpulse.sources.scratch import stored

#: Journeys with more observations are cut into pieces of so many seconds.
HOT_ROWS = 1_000_000
PIECE_S = 60
#: Rows without a time are cut by the number of the row, so many bits of it to a piece.
_ROW_BITS = 20
PIECE = ["journey_id", "major", "minor"]
_NEVER = (1 << 63) - 1


def hot_journeys(observations: DataFrame, most: int = HOT_ROWS) -> DataFrame:
    """(journey_id) of the journeys with more than ``most`` observations: no more than the observations over ``most``."""
    return observations.filter(F.col("journey_id").isNotNull()).groupBy("journey_id").count().filter(F.col("count") > most).select("journey_id")


def in_pieces(rows: DataFrame, time: str, piece_s: int = PIECE_S) -> DataFrame:
    """``rows`` with the keys of their piece; pieces rise as the rows of a journey do, rows without a time come last."""
    known = F.col(time).isNotNull()
    return rows.withColumns({
        "major": F.when(known, F.floor(micros(F.col(time)) / F.lit(piece_s * 1_000_000))).otherwise(F.lit(_NEVER)).cast("long"),
        "minor": F.when(known, F.lit(0)).otherwise(F.shiftright("obs_id", _ROW_BITS)).cast("long"),
    })


def _inside(time: str) -> WindowSpec:
    return Window.partitionBy(*PIECE).orderBy(F.col(time).asc_nulls_last(), "obs_id")


def _by_journey() -> WindowSpec:
    return Window.partitionBy("journey_id").orderBy("major", "minor").rowsBetween(Window.unboundedPreceding, -1)


def with_previous(rows: DataFrame, time: str, name: str, columns: list[str], valid: Column | None = None) -> DataFrame:
    """``rows`` (in pieces) with struct ``name``: ``columns`` of the last row before in the journey, or of the last one that is ``valid``.

    Null where there is none.
    """
    own = F.struct(*columns)
    own = own if valid is None else F.when(F.coalesce(valid, F.lit(False)), own)
    ordered = F.when(own.isNotNull(), F.struct(F.col(time).alias("t"), F.col("obs_id").alias("i"), own.alias("v")))
    # times of a piece are all known or all unknown, so nulls don't mix with times here
    lasts = rows.groupBy(*PIECE).agg(F.max(ordered).alias("last"))
    carried = lasts.select(*PIECE, F.last("last.v", ignorenulls=True).over(_by_journey()).alias("__carried"))
    local = F.last(own, ignorenulls=True).over(_inside(time).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn(name, local).join(carried, PIECE, "left").withColumn(name, F.coalesce(name, "__carried")).drop("__carried")


def with_running(rows: DataFrame, time: str, flags: dict[str, Column]) -> DataFrame:
    """``rows`` (in pieces) with running counts of ``flags`` within the journey, this row included."""
    rows = rows.withColumns({f"__{k}": v.cast("long") for k, v in flags.items()})
    totals = rows.groupBy(*PIECE).agg(*[F.sum(f"__{k}").alias(f"__{k}_before") for k in flags])
    totals = totals.select(*PIECE, *[F.coalesce(F.sum(f"__{k}_before").over(_by_journey()), F.lit(0)).alias(f"__{k}_before") for k in flags])
    running = _inside(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({k: F.sum(f"__{k}").over(running) for k in flags}).join(totals, PIECE, "left")
    return rows.withColumns({k: F.col(k) + F.col(f"__{k}_before") for k in flags}).drop(*[f"__{k}" for k in flags], *[f"__{k}_before" for k in flags])


def piece_segments(observations: DataFrame, config: MoeConfig = FIVE_MINUTES, piece_s: int = PIECE_S) -> DataFrame:
    """The rows of ``with_segments`` with ``major`` and ``minor``, no task of which holds more than a piece of a journey at a time."""
    rows = observations.filter(F.col("journey_id").isNotNull()).select("obs_id", "journey_id", F.col("local_time").alias("event_time"), "speed_mph", "link_key")
    rows = with_previous(in_pieces(rows, "event_time", piece_s), "event_time", "previous", ["event_time", "link_key"])
    new_trip, new_run = segment_flags(F.col("previous.event_time"), F.col("previous.link_key"), config)
    rows = rows.withColumns({"new_trip": new_trip, "new_run": new_run})
    rows = with_running(rows, "event_time", {"trip_segment": F.col("new_trip"), "run_id": F.col("new_run")}).drop("previous", "new_trip", "new_run")
    return rows if config.bin_minutes is None else rows.withColumn("time_bin", time_bin(F.col("event_time"), config.bin_minutes))


def cold_and_hot(observations: DataFrame, most: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """The observations of ordinary journeys, and those of hot ones if there are any."""
    hot = stored(hot_journeys(observations, most))
    if hot.isEmpty():
        return observations, None
    return observations.join(hot, "journey_id", "left_anti"), observations.join(hot, "journey_id", "left_semi")


def split_segments(observations: DataFrame, config: MoeConfig = FIVE_MINUTES, most: int = HOT_ROWS, piece_s: int = PIECE_S) -> DataFrame:
    """The same rows as ``with_segments``, where a journey may hold any share of all rows."""
    cold, hot = cold_and_hot(observations, most)
    rows = with_segments(cold, config)
    return rows if hot is None else rows.unionByName(piece_segments(hot, config, piece_s).drop("major", "minor"))
