"""Journeys of any size, and journeys that touch none of the links: same results, and plans that hold at scale."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.config import FIVE_MINUTES, HOURLY
from roadpulse.operators import corridor, moe, pieces, sequence

from .test_measures import OBS, T0, links


def hot_table(spark, n=3000, hot=0.34, seed=1):
    """A third of all rows in one journey; gaps, unmatched rows, equal times, rows without time, speed, link or journey."""
    rng = random.Random(seed)
    rows, clock = [], dict.fromkeys("HKLMNOPQ", 0.0)
    for i in range(n):
        j = "H" if rng.random() < hot else rng.choice("KLMNOPQ")
        clock[j] += rng.choice([0, 0, 1, 5, 20, 30, 119, 121]) if j != "H" else rng.choice([0, 1, 2, 3, 125])
        t = None if rng.random() < 0.03 else T0 + timedelta(seconds=clock[j])
        late = None if rng.random() < 0.02 else T0 + timedelta(seconds=clock[j] + rng.choice([0, 0, 7]))
        rows.append((i, None if rng.random() < 0.01 else j, late, t, rng.choice([None, -1.0, 0.0, 4.0, 7.25, 30.0, 1e12]), rng.choice(["A", "A", "A", "B", "C", "D", None])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, OBS).repartition(4)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    rows = lambda df: sorted((tuple(f"{v:.12g}" if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
    assert rows(a) == rows(b)


@pytest.mark.parametrize("piece_s", [1, 60, 100_000])
def test_hot_journeys_in_pieces_give_the_same(spark, piece_s):
    table = hot_table(spark)
    assert [r[0] for r in pieces.hot_journeys(table, 700).collect()] == ["H"]
    same(pieces.split_segments(table, FIVE_MINUTES, 700, piece_s), sequence.with_segments(table))
    for config in (FIVE_MINUTES, HOURLY):
        same(moe.split_link_moe(table, links(spark), config, 700, piece_s), moe.link_moe(table, links(spark), config))
    same(corridor.split_link_transitions(table, 120.0, 700, piece_s), corridor.link_transitions(table))


def test_all_journeys_hot_or_none(spark, monkeypatch):
    monkeypatch.setattr(pieces, "_ROW_BITS", 4)
    monkeypatch.setattr(moe, "_RUNS", 3)
    table = hot_table(spark, 800)
    for most in (0, 10**6):
        same(pieces.split_segments(table, most=most), sequence.with_segments(table))
        same(moe.split_link_moe(table, links(spark), HOURLY, most), moe.link_moe(table, links(spark), HOURLY))
        same(corridor.split_link_transitions(table, most=most), corridor.link_transitions(table))
    none = table.filter("false")
    assert pieces.split_segments(none).count() == 0 and moe.split_link_moe(none, links(spark)).count() == 0


def test_no_task_holds_the_hot_journey(spark):
    table = hot_table(spark, 6000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "24")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        hot = table.filter("journey_id = 'H'")
        most = lambda df: df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("run_id").alias("r")).agg(F.max("n"), F.max("r")).first()[0]
        n = hot.count()
        assert most(sequence.with_segments(hot)) == n
        assert most(pieces.piece_segments(hot)) < 0.2 * n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_journey_on_one_link_for_hours_is_cut_too(spark):
    rows = [(i, "H", T0, T0 + timedelta(seconds=i), float(i % 9), "A") for i in range(4000)]
    table = spark.createDataFrame(rows, OBS)
    same(moe.split_link_moe(table, links(spark), HOURLY, 100), moe.link_moe(table, links(spark), HOURLY))
    (r,) = moe.split_link_moe(table, links(spark), HOURLY, 100).collect()
    assert (r["waypoint_count"], r["dsh_trip_count"]) == (4000, 1)


def far_table(spark, near):
    """``near`` of a hundred journeys touch link A."""
    at = datetime(2025, 9, 20, 19)
    rows = [(j * 40 + i, f"J{j}", at, at + timedelta(seconds=9 * i), 5.0 + i, "A" if j < near and i == 20 else f"far{i // 5}") for j in range(100) for i in range(40)]
    return spark.createDataFrame(rows, OBS)


def test_only_journeys_on_the_links_are_sorted(spark, tmp_path):
    one = links(spark, "A")
    for near in (0, 7, 100):
        far_table(spark, near).write.parquet(str(tmp_path / str(near)))
        table = spark.read.parquet(str(tmp_path / str(near)))
        assert moe.touching(table, one).count() == 40 * near
        same(moe.link_moe(moe.touching(table, one), one), moe.link_moe(table, one))
    plan = moe.link_moe(moe.touching(table, one), one)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    shuffle = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(journey_id" in x and "ENSURE" in x)
    assert any("BroadcastHashJoin" in x and "__word" in x for x in lines[shuffle:]) and not any("__word" in x for x in lines[:shuffle])


def test_marks_that_journeys_share_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(moe, "MARKS", 64)
    table, one = hot_table(spark, 500), links(spark, "B")
    same(moe.link_moe(moe.touching(table, one), one), moe.link_moe(table, one))
    clash = table.withColumns({"bits": F.lit(1), "word": F.lit(2)})
    assert moe.touching(clash, one).columns == clash.columns
