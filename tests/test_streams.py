"""Trips and measures on a stream against those of a table; late rows, forgotten journeys, restarts and increments."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.config import FIVE_MINUTES
from roadpulse.functions.scalars import micros
from roadpulse.operators import moe, sequence
from roadpulse.streaming.journeys import STATE_STORE, stream_cells, stream_records, stream_trips
from roadpulse.streaming.steps import run_in_steps
from roadpulse.streaming.upkeep import add_increment, current_measures

from .test_measures import T0, links, obs
from .test_scale import hot_table, same


@pytest.fixture(scope="module")
def arriving(spark):
    """Rows in parts, some minutes late, each part out of order; two far later rows end the stream."""
    table = hot_table(spark, 900).filter("local_time IS NOT NULL AND journey_id IS NOT NULL").cache()
    minutes = F.floor(micros(F.col("local_time")) / 60_000_000) + F.col("obs_id") % 7
    first, last = table.agg(F.min(minutes), F.max(minutes)).first()
    cut = [first, (2 * first + last) // 3, (first + 2 * last) // 3, last + 1]
    parts = [table.filter((minutes >= a) & (minutes < b)).coalesce(2) for a, b in zip(cut, cut[1:], strict=False)]
    return table, [*parts, obs(spark, ("END", 10**8, 1.0, "no link")), obs(spark, ("END AGAIN", 10**9, 1.0, "no link"))]


def test_trips_of_a_stream_are_those_of_the_table(spark, arriving):
    table, parts = arriving
    out = spark.read.parquet(run_in_steps(spark, parts, stream_trips)).filter("journey_id NOT LIKE 'END%'")
    same(out, sequence.with_segments(table).drop("time_bin"))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") not in STATE_STORE.values()


def test_records_and_cells_of_a_stream(spark, arriving):
    table, parts = arriving
    records = spark.read.parquet(run_in_steps(spark, parts, stream_records))
    want = moe.link_moe(table, links(spark))
    own = records.filter("journey_id NOT LIKE 'END%'")
    same(moe.final_measures(own, merge=True).drop("total_speed", "slow_speed_sum"), want)
    assert own.filter("journeys = 1").count() == own.filter("n > 0").select("link_key", "time_bin", "journey_id").distinct().count()
    # nothing is given out before the hold is over
    cells = run_in_steps(spark, [records], lambda df: stream_cells(df, links(spark), hold="2000 days"))
    assert spark.read.parquet(cells).count() == 0
    cells = run_in_steps(spark, [own, records.filter("journey_id LIKE 'END%'")], lambda df: stream_cells(df, links(spark)))
    same(spark.read.parquet(cells), want)


def test_late_rows_are_dropped_and_old_journeys_forgotten(spark):
    day = 86_400
    parts = [
        obs(spark, ("J", 0, 1.0, "A"), ("J", 30, 1.0, None), ("J", 60, 1.0, "B")),
        obs(spark, ("K", 2000, 1.0, "A")),
        obs(spark, ("J", 50, 1.0, "C"), ("J", 2100, 1.0, "A"), ("K", 3 * day, 1.0, "A")),
        obs(spark, ("J", 3 * day + 10, 1.0, "B"), ("K", 9 * day, 1.0, "A")),
        obs(spark, ("L", 20 * day, 1.0, "A")),
    ]
    out = spark.read.parquet(run_in_steps(spark, parts, lambda df: stream_trips(df, forget_s=day)))
    got = sorted((r["journey_id"], r["event_time"] - T0, r["link_key"], r["trip_segment"], r["run_id"]) for r in out.collect())
    s = lambda n: timedelta(seconds=n)
    assert got == [
        ("J", s(0), "A", 1, 1), ("J", s(30), None, 2, 2), ("J", s(60), "B", 3, 3), ("J", s(2100), "A", 4, 4), ("J", s(3 * day + 10), "B", 1, 1),
        ("K", s(2000), "A", 1, 1), ("K", s(3 * day), "A", 1, 1), ("K", s(9 * day), "A", 1, 1),
    ]


def test_increments_give_what_one_run_gives(spark, tmp_path):
    table, store = hot_table(spark, 900), f"file://{tmp_path}/store"
    part = lambda i: moe.partial_sums(moe.runs_with_travel(table.filter(F.crc32("journey_id") % 3 == i)), links(spark))
    want = moe.link_moe(table, links(spark))
    for i in (2, 0, 1):
        add_increment(store, part(i), i)
    same(current_measures(spark, store), want)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "store" / "cells").rglob("*.parquet")}
    add_increment(store, part(0), 0)
    same(current_measures(spark, store), want)
    # an increment of another hour leaves the files of these hours as they are
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "store" / "cells").rglob("*.parquet")}
    later = obs(spark, ("Z", 90_000, 5.0, "A"), ("Z", 90_010, 7.0, "A"))
    add_increment(store, moe.partial_sums(moe.runs_with_travel(later), links(spark)), 3)
    assert before.items() <= {f: f.stat().st_mtime_ns for f in (tmp_path / "store" / "cells").rglob("*.parquet")}.items()
    same(current_measures(spark, store), moe.link_moe(table.unionByName(later.withColumn("obs_id", F.col("obs_id") + 10**6)), links(spark)))


def test_records_of_a_stream_are_increments(spark, arriving, tmp_path):
    """A journey that goes on from one batch to the next; the last batch comes twice."""
    table, parts = arriving
    records = spark.read.parquet(run_in_steps(spark, parts, stream_records)).filter("journey_id NOT LIKE 'END%'")
    half = records.withColumn("i", F.when(F.col("time_bin") < F.lit(T0 + timedelta(minutes=40)).cast("timestamp_ntz"), 0).otherwise(1))
    store = f"file://{tmp_path}/store"
    for i in (0, 1, 1):
        add_increment(store, moe.selected(half.filter(F.col("i") == i), links(spark)), i)
    same(current_measures(spark, store), moe.link_moe(table, links(spark), FIVE_MINUTES))
