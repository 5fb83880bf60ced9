"""Quantiles by counting, walks by doubling, tables stored by journey; each against a plain way."""

import random

import pytest
from pyspark.sql import functions as F

from roadpulse.config import CorridorConfig
from roadpulse.operators import corridor, moe, sequence
from roadpulse.operators.quantile import exact_quantile
from roadpulse.sources.layout import store_by_journey

from .test_measures import links
from .test_scale import hot_table, same


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95])
def test_quantiles(spark, q):
    rng = random.Random(7)
    rows = [("a", float(rng.randint(-3, 3))) for _ in range(300)] + [("b", rng.gauss(0, 1)) for _ in range(501)] + [("c", None), ("one", 4.25), ("two", -1.0), ("two", 1e308), ("none", None)]
    rows += [("wide", rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300)) for _ in range(200)] + [("inf", v) for v in (float("-inf"), -1.0, 2.0, 2.0, 5.0, float("inf"), float("inf"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    want = {r[0]: r[1] for r in df.groupBy("g").agg(F.percentile("v", q)).collect() if r[1] is not None}
    assert {r["g"]: r["quantile"] for r in exact_quantile(df, ["g"], "v", q, buckets=64 if q == 0.5 else 4096).collect()} == want
    assert exact_quantile(df.filter("false"), ["g"], "v", q).count() == 0


def plain_walk(first, step, start, most):
    out, link = [start], first.get(start)
    while link is not None and link not in out and len(out) < most:
        out.append(link)
        link = step.get(link)
    return out


def test_walks_from_every_link(spark):
    rng = random.Random(2)
    net = [(i, f"L{i}_{i % 3}_x", rng.randrange(18), rng.randrange(18), float(rng.randrange(360))) for i in range(60)]
    network = spark.createDataFrame(net, "net_id long, link_key string, from_node_id long, to_node_id long, heading double")
    moves = spark.createDataFrame([(rng.choice(net)[1], rng.choice(net)[1], rng.randint(1, 9)) for _ in range(150)], "from_link string, to_link string, support long").groupBy("from_link", "to_link").agg(F.max("support").alias("support"))
    chosen = corridor.next_link_choices(network, moves).collect()
    first, step = ({r["link_key"]: r["next_link"] for r in chosen if r["is_first"] is x} for x in (True, False))
    for most in (1, 3, 40):
        config = CorridorConfig(max_links=most)
        got = {}
        for r in corridor.walks(network, moves, network.unionByName(network.limit(1)), config).collect():
            got.setdefault(r["start_link"], {})[r["corridor_order"]] = r["link_key"]
        assert {k: [v[i] for i in sorted(v)] for k, v in got.items()} == {n[1]: plain_walk(first, step, n[1], most) for n in net}
    one = corridor.walk(network, moves, CorridorConfig(start_link="L5_2_x")).orderBy("corridor_order").collect()
    assert [r["link_key"] for r in one] == plain_walk(first, step, "L5_2_x", 40)
    (far,) = corridor.walks(network, moves, spark.createDataFrame([("not there",), (None,)], "link_key string")).collect()
    assert tuple(far) == ("not there", 1, "not there", 0, "start_highest_transition_support")


def test_a_table_stored_by_journey_needs_no_shuffle_by_journey(spark):
    rows = hot_table(spark, 700)
    table = store_by_journey(rows, "stored_observations", 4)
    for made, plain in (
        (sequence.with_segments(table), sequence.with_segments(rows)),
        (moe.runs_with_travel(table), moe.runs_with_travel(rows)),
        (moe.link_moe(table, links(spark)), moe.link_moe(rows, links(spark))),
        (corridor.link_transitions(table), corridor.link_transitions(rows)),
    ):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(journey_id" not in plan
        same(made, plain)
    assert sequence.with_segments(table)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
    again = store_by_journey(rows.limit(0), "stored_observations")
    assert again.count() == 0
    spark.sql("DROP TABLE stored_observations")
