"""Plans whose driver memory, seconds and shuffles must not grow faster than the tables."""

import time

import pytest

from roadpulse.config import CorridorConfig
from roadpulse.operators import corridor, near
from roadpulse.plans import fixtures as fx
from roadpulse.plans.queries import QUERIES

from .compare import spark_rows

SF = "/root/testdata/sf0.001"


def plan(df, step="executedPlan"):
    return getattr(df._jdf.queryExecution(), step)().toString()


def test_speeds_by_cells_broadcast_nothing(spark, monkeypatch):
    plans, stored = [], near.stored
    monkeypatch.setattr(near, "stored", lambda df: plans.append(plan(df)) or stored(df))
    out = near.posted_speed_by_cells(fx.network(spark, SF), fx.segments(spark, SF))
    joined = [p for p in [*plans, plan(out)] if "Join" in p]
    assert len(joined) > 3 and not any("BroadcastHashJoin" in p or "BroadcastNestedLoopJoin" in p for p in joined)


def test_each_line_is_parsed_once(spark):
    text = plan(QUERIES["network_geometry"](spark, SF), "optimizedPlan")
    assert text.count("regexp_extract(") == 1
    # the parts of a JSON line are read once for each kind, not once more for each check of them
    assert text.count("from_json(") + text.count("jsontostructs(") <= 2


def test_walk_of_one_start_makes_no_other_walks(spark, monkeypatch):
    net, moves = fx.network(spark, SF), corridor.link_transitions(fx.observations(spark, SF)).cache()
    for config in (CorridorConfig(), CorridorConfig(start_link="W3_0_12", max_links=7), CorridorConfig(start_link="Q30_0_120"), CorridorConfig(start_link="none")):
        want = spark_rows(corridor.walk(net, moves, config))
        with monkeypatch.context() as m:
            m.setattr(corridor, "DRIVER_ROWS", 0)
            m.setattr(corridor, "walks", None)
            assert spark_rows(corridor.walk(net, moves, config)) == want
        assert 1 <= len(want) <= config.max_links
    moves.unpersist()


def test_walk_of_a_large_network_shuffles_none_of_it(spark, monkeypatch):
    net, moves = fx.network(spark, SF), corridor.link_transitions(fx.observations(spark, SF))
    plans, stored, begun, start = [], corridor.stored, [], corridor.start_link
    monkeypatch.setattr(corridor, "DRIVER_ROWS", 0)
    monkeypatch.setattr(corridor, "stored", lambda df: plans.append(plan(df)) or stored(df))
    monkeypatch.setattr(corridor, "start_link", lambda *a: begun.append(start(*a)) or begun[0])
    assert corridor.walk(net, moves).count() == 40
    # transitions are stored, then the network as it is; choices of links that no walk visits are made by nobody
    assert len(plans) == 2 and "Join" not in plans[1] and "Exchange" not in plans[1] and "Window" not in plans[1]
    # one exchange, of the few totals: what is joined with them is not shuffled
    assert plan(begun[0]).count("Exchange hashpartitioning") == 1


def test_choices_of_one_link_are_those_of_all(spark, monkeypatch):
    """A network with a link named twice, nodes and headings that are missing, and ways straight back."""
    rows = [("A_1_a", 1, 2, 10.0, 0), ("B_1_b", 2, 1, 190.0, 1), ("C_1_c", 2, 3, None, 2), ("C_1_c", 2, 5, 40.0, 3), ("D_2_d", 3, 4, 80.0, 4), ("E_1_e", 5, 6, 40.0, 5), ("F_1_f", 6, None, 0.0, 6), ("G_1_g", None, 2, 0.0, 7)]
    net = spark.createDataFrame(rows, "link_key string, from_node_id long, to_node_id long, heading double, net_id long").repartition(3)
    for moves in ([("A_1_a", "B_1_b", 5)], [("A_1_a", "C_1_c", 5), ("C_1_c", "D_2_d", 2)], [("G_1_g", "C_1_c", 9), ("x", "y", 99)], []):
        t = spark.createDataFrame(moves, "from_link string, to_link string, support long")
        for config in (CorridorConfig(), CorridorConfig(start_link="B_1_b"), CorridorConfig(start_link="G_1_g"), CorridorConfig(start_link="F_1_f")):
            want = spark_rows(corridor.walk(net, t, config))
            with monkeypatch.context() as m:
                m.setattr(corridor, "DRIVER_ROWS", 0)
                assert spark_rows(corridor.walk(net, t, config)) == want


def shuffled(spark) -> int:
    """Bytes that this session has shuffled so far."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    time.sleep(1)  # totals are renewed ten times a second at most
    executors = sc.statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


@pytest.mark.parametrize("name", ["corridor_diagnostic", "reduced_corridor_moe_5min", "scan_corridor_moe"])
def test_links_that_nobody_visits_are_not_shuffled(spark, monkeypatch, name):
    """Whole queries, from the walk to the result: the same rows and hardly more bytes with ten thousand links more."""
    network, rows, moved = fx.network, {}, {}
    monkeypatch.setattr(corridor, "DRIVER_ROWS", 0)
    monkeypatch.setattr(corridor.build_corridor, "__defaults__", (CorridorConfig(max_links=5),))  # fewer steps, for time alone
    for more in (1, 10_000):
        far = spark.range(more).selectExpr(
            "1000000 + id AS net_id", "concat('Z', id, '_9_', id) AS link_key", "1000000 + 2 * id AS from_node_id", "1000002 + 2 * id AS to_node_id", "CAST(id % 360 AS DOUBLE) AS heading",
            "400D AS length", "concat(id, '.0') AS Matched_GID", "concat('LINESTRING (-97.1 30.1, -97.2 30.', id, ')') AS geometry", "concat('Road ', id) AS name",
        )
        monkeypatch.setattr(fx, "network", lambda *a, far=far: network(*a).unionByName(far))
        before = shuffled(spark)
        rows[more] = spark_rows(QUERIES[name](spark, SF))
        moved[more] = shuffled(spark) - before
    assert rows[1] == rows[10_000] and len(rows[1]) >= 5
    assert 0 < moved[10_000] < 1.1 * moved[1]
