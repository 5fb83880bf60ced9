"""Hand-worked cases of the measures, the walk, geometry, readers and sinks."""

import sqlite3
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.config import FIVE_MINUTES, HOURLY, CorridorConfig
from roadpulse.functions import geometry as g
from roadpulse.functions import scalars as s
from roadpulse.operators import corridor, moe, report, sequence
from roadpulse.sources import readers, sinks

T0 = datetime(2025, 9, 20, 19)
OBS = "obs_id long, journey_id string, capture_time timestamp_ntz, local_time timestamp_ntz, speed_mph double, link_key string"


def obs(spark, *rows):
    """Rows of (journey, seconds after 19:00 or None, speed, link)."""
    at = lambda t: None if t is None else T0 + timedelta(seconds=t)
    return spark.createDataFrame([(i, j, at(t), at(t), v, k) for i, (j, t, v, k) in enumerate(rows)], OBS)


def links(spark, keys="ABCD"):
    return spark.createDataFrame([(k,) for k in keys], "link_key string")


def measured(spark, rows, config=FIVE_MINUTES, keys="ABCD"):
    return [r.asDict() for r in moe.link_moe(obs(spark, *rows), links(spark, keys), config).orderBy(*moe.keys(config)).collect()]


def counts(spark, rows):
    r = sequence.with_segments(obs(spark, *rows)).agg(F.max("trip_segment"), F.max("run_id")).first()
    return r[0], r[1]


def test_gap_and_unmatched_rows_end_trips(spark):
    assert counts(spark, [("J", 0, 10.0, "A"), ("J", 120, 10.0, "A"), ("J", 240.001, 10.0, "A")]) == (2, 2)
    assert counts(spark, [("J", 0, 10.0, "A"), ("J", 10, 10.0, None), ("J", 20, 10.0, "A")]) == (3, 3)


@pytest.mark.parametrize(("rows", "dsh", "runs"), [
    ([("J", 0, 10.0, "A"), ("J", 10, 16.0, "A"), ("J", 20, 12.0, "A")], 10 / 3, 1),
    ([("J", 0, 10.0, "A"), ("J", 10, 16.0, "A"), ("J", 20, 12.0, "A"), ("K", 0, 30.0, "A")], 5 / 3, 2),
    ([("J", 0, 10.0, "A"), ("J", 10, -1.0, "A"), ("J", 20, 16.0, "A")], 3.0, 1),
])
def test_speed_harmony(spark, rows, dsh, runs):
    (r,) = measured(spark, rows)
    assert r["DSH"] == pytest.approx(dsh, abs=1e-9) and r["dsh_trip_count"] == runs


def test_bins_split_runs_but_the_period_does_not(spark):
    rows = [("J", 295, 10.0, "A"), ("J", 305, 20.0, "A")]
    assert [r["DSH"] for r in measured(spark, rows)] == [0.0, 0.0]
    assert [r["DSH"] for r in measured(spark, rows, HOURLY)] == [5.0]


def test_traversals(spark):
    rows = [("J", 0, 10.0, "A"), ("J", 30, 10.0, "B"), ("J", 70, 10.0, "C")]
    got = {r["link_key"]: r["avg_travel_time_s"] for r in measured(spark, rows)}
    assert got == {"A": None, "B": 40.0, "C": None}
    rows = [("J", 0, 10.0, "A"), ("J", 30, 10.0, "B"), ("J", 30, 10.0, "C"), ("J", 60, 10.0, "D")]
    assert {r["link_key"]: r["avg_travel_time_s"] for r in measured(spark, rows)} == {"A": None, "B": None, "C": 30.0, "D": None}


def test_slow_share_is_weighted_by_speed(spark):
    assert measured(spark, [("J", 0, 0.0, "A"), ("J", 10, 0.0, "A")])[0]["slow_movement_pct"] is None
    r = measured(spark, [("J", 0, 4.0, "A"), ("J", 10, 5.0, "A"), ("J", 20, 6.0, "A")])[0]
    assert r["slow_movement_count"] == 1 and r["slow_movement_pct"] == pytest.approx(400 / 15)


def test_rows_without_time_journey_or_speed(spark):
    rows = [("J", 0, 10.0, "A"), ("J", None, 20.0, "A"), (None, 0, 10.0, "B"), ("K", 0, None, "C")]
    assert [(r["link_key"], r["waypoint_count"]) for r in measured(spark, rows)] == [("A", 1)]
    (r,) = measured(spark, rows, HOURLY)
    assert (r["waypoint_count"], r["DSH"]) == (2, 5.0)
    assert measured(spark, []) == []


def test_speeds_keep_their_decimals_and_outliers_end_no_job(spark):
    rows = [("J", 0, 1.234567, "A"), ("J", 10, 13.580247, "A"), ("K", 0, 1e15, "B"), ("K", 5, 1e15 + 8, "B"), ("L", 0, float("inf"), "C"), ("L", 5, 2.0, "C"), ("M", 0, 1e300, "D"), ("M", 5, 1e300, "D")]
    for config in (FIVE_MINUTES, HOURLY):
        got = {r["link_key"]: r for r in measured(spark, rows, config)}
        assert got["A"]["DSH"] == pytest.approx(12.34568 / 2, abs=1e-9)
        assert (got["B"]["waypoint_count"], got["B"]["DSH"]) == (2, 4.0)
        assert (got["C"]["waypoint_count"], got["C"]["DSH"], got["C"]["slow_movement_count"], got["C"]["slow_movement_pct"]) == (2, float("inf"), 1, 0.0)
        assert (got["D"]["waypoint_count"], got["D"]["DSH"]) == (2, 0.0)
    stats = moe.waypoint_metrics(moe.run_stats(sequence.with_segments(obs(spark, *rows)), links(spark))).collect()
    assert {r["link_key"]: r["total_speed"] for r in stats} == {"A": pytest.approx(14.814814), "B": 2e15 + 8, "C": float("inf"), "D": 2e300}


def test_runs_over_several_bins_count_their_traversal_where_they_begin(spark):
    rows = [("J", 0, 10.0, "A"), ("J", 100, 10.0, "B"), ("J", 200, 12.0, "B"), ("J", 310, 10.0, "B"), ("J", 400, 10.0, "B"), ("J", 500, 10.0, "C"), ("J", None, 10.0, "D")]
    got = {(r["link_key"], r["time_bin"].minute): (r["complete_traversal_count"], r["avg_travel_time_s"], r["DSH"]) for r in measured(spark, rows)}
    assert got == {("A", 0): (None, None, 0.0), ("B", 0): (1, 400.0, 1.0), ("B", 5): (None, None, 0.0), ("C", 5): (None, None, 0.0)}


def test_transitions(spark):
    got = corridor.link_transitions(obs(spark, ("J", 0, 1.0, "A"), ("J", 120, 1.0, "B"), ("J", 241, 1.0, "A"), ("J", None, 1.0, "B"))).collect()
    assert [tuple(r) for r in got] == [("A", "B", 1)]
    # transitions follow the time of capture, measures the local time
    at = lambda t: T0 + timedelta(seconds=t)
    turned = spark.createDataFrame([(1, "J", at(60), at(0), 1.0, "A"), (2, "J", at(0), at(60), 1.0, "B")], OBS)
    assert [tuple(r) for r in corridor.link_transitions(turned).collect()] == [("B", "A", 1)]
    assert [r["link_key"] for r in sequence.with_segments(turned).orderBy("run_id").collect()] == ["A", "B"]


def walked(spark, net, moves):
    n = spark.createDataFrame([(i, k, a, b, 0.0) for i, (k, a, b) in enumerate(net)], "net_id long, link_key string, from_node_id long, to_node_id long, heading double")
    t = spark.createDataFrame(moves, "from_link string, to_link string, support long")
    return [r["link_key"] for r in corridor.walk(n, t, CorridorConfig()).orderBy("corridor_order").collect()]


def test_walk(spark, monkeypatch):
    assert walked(spark, [("A", 1, 2), ("B", 2, 1), ("C", 2, 3), ("D", 3, 1)], [("A", "B", 5)]) == ["A", "B"]
    ring = [("A", 1, 2), ("C", 2, 3), ("D", 3, 1)]
    assert walked(spark, ring, [("A", "C", 5)]) == ["A", "C", "D"]
    monkeypatch.setattr(corridor, "DRIVER_ROWS", 0)
    assert walked(spark, ring, [("A", "C", 5)]) == ["A", "C", "D"]
    assert walked(spark, ring, []) == []


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v"))).collect()]


def test_scalars(spark):
    assert column(spark, [" 123.0 ", "-1", "nan", "", "1.0.0"], s.normalize_gid) == ["123", None, None, None, "1.0"]
    assert column(spark, ["12_3_F", "12", "12_3"], s.link_family) == ["12_3", "12", "12_3"]
    assert column(spark, ["350 10", "10 350", "90 270"], lambda v: s.heading_difference(F.split(v, " ")[0].cast("double"), F.split(v, " ")[1].cast("double"))) == [20, 20, 180]
    assert column(spark, ["x", "nan", "1d", "2.5", None], s.safe_double) == [None, None, None, 2.5, None]
    assert column(spark, ["2025-09-20T19:00:00-05:00", "bad", "2025-09-20 19:00:01.5"], s.safe_timestamp) == [T0, None, T0 + timedelta(seconds=1.5)]
    assert column(spark, ["5"], lambda v: s.maps_url(F.lit(None).cast("double"), v.cast("double"))) == [""]


def test_geometry(spark):
    texts = ["LINESTRING (0 0, 4 0, 4 4)", '{"type": "LineString", "coordinates": [[0, 0], [4, 0]]}', "bad", None, "MULTILINESTRING ((0 0, 1 0), (2 0, 3 0))", "POINT (1 1)", '{"type": "Point", "coordinates": [1, 2]}']
    assert column(spark, texts, lambda v: F.when(g.parse_lines(v).isNotNull(), F.size(g.parse_lines(v)))) == [1, 1, None, None, 2, None, None]
    line = lambda v: g.parse_lines(v)
    assert column(spark, texts[:1], lambda v: g.length(line(v))) == [8.0]
    assert column(spark, texts[:1], lambda v: F.concat_ws(",", g.midpoint(line(v))["x"].cast("string"), g.midpoint(line(v))["y"].cast("string"))) == ["4.0,0.0"]
    assert column(spark, texts[:1], lambda v: g.point_line_distance(F.struct(F.lit(5.0).alias("x"), F.lit(1.0).alias("y")), line(v))) == [1.0]


def test_color_limits(spark):
    rows = [("A", T0 + timedelta(minutes=5 * i), float(v), None, float(-v)) for i, v in enumerate([1, 2, 3, 4])]
    df = spark.createDataFrame(rows, "link_key string, time_bin timestamp_ntz, a double, b double, c double")
    got = {r["metric"]: r["vmax"] for r in report.color_limits(df, {"a": "robust", "b": "robust", "c": "robust"}).collect()}
    assert got == {"a": pytest.approx(3.85), "b": 1.0, "c": 1.0}


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "o.csv").write_text("journey_id,capture_time,local_time,speed_mph,link_key\nJ,2025-09-20 19:00:00,2025-09-20 19:00:00,12.5,A\nJ,bad,,x,NA\n")
    got = readers.read_observations(spark, str(tmp_path / "o.csv")).orderBy("obs_id").collect()
    assert [(r["speed_mph"], r["link_key"], r["local_time"]) for r in got] == [(12.5, "A", T0), (None, None, None)]
    geo = '"{""type"": ""LineString"", ""coordinates"": [[0, 0], [1, 1]]}"'
    (tmp_path / "n.csv").write_text(f"link_key,from_node_id,to_node_id,geometry,heading,length,matched_gid,name,facility_type,rdbd_type,functional_class\nA,1,2,{geo},90,10,7.0,n,f,r,c\nA,3,4,bad,90,10,8,n,f,r,c\n")
    net = readers.read_network(spark, str(tmp_path / "n.csv"))
    assert [(r["from_node_id"], r["Matched_GID"], r["Functional Class"]) for r in net.collect()] == [(1, "7", "c")]
    path = str(tmp_path / "out.gpkg")
    sinks.write_geopackage(path, {"links": sinks.geopackage_layer(net, "geometry")})
    with sqlite3.connect(path) as db:
        (blob, key), = db.execute("SELECT geom, link_key FROM links").fetchall()
    assert blob[:2] == b"GP" and key == "A"
    sinks.write_csv(net.select("link_key"), str(tmp_path / "out"), "link_key")
    assert readers.read_links(spark, str(tmp_path / "out")).count() == 1


def test_rows_are_numbered_by_file(spark, tmp_path):
    head = "journey_id,capture_time,local_time,speed_mph,link_key\n"
    (tmp_path / "a.csv").write_text(head + "J,9/20/2025 19:00,9/20/2025 7:00:01 PM,1.5,first\n")
    (tmp_path / "b.csv").write_text(head + "".join(f"J,2025-09-20 19:00:00,2025-09-20 19:00:00,{i},b{i:02}\n" for i in range(50)))
    got = readers.read_observations(spark, str(tmp_path)).orderBy("obs_id").collect()
    assert [r["link_key"] for r in got] == ["first", *[f"b{i:02}" for i in range(50)]]
    assert (got[0]["capture_time"], got[0]["local_time"]) == (T0, T0 + timedelta(seconds=1))
    typed = spark.createDataFrame([("J", T0, T0, float("nan"), "A"), ("K", T0, T0, 2.5, "B")], "journey_id string, capture_time timestamp_ntz, local_time timestamp_ntz, speed_mph double, link_key string")
    typed.coalesce(1).write.parquet(str(tmp_path / "o.parquet"))
    back = readers.read_observations(spark, str(tmp_path / "o.parquet"))
    assert [(r["journey_id"], r["speed_mph"], r["local_time"]) for r in back.orderBy("obs_id").collect()] == [("J", None, T0), ("K", 2.5, T0)]
    plan = back.filter("link_key = 'B'").select("speed_mph")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(link_key,B)" in plan


def test_plane_has_the_properties_that_define_it(spark):
    """The origin, true length along both standard parallels, and areas, from the ellipsoid alone."""
    from math import cos, log, radians, sin, sqrt

    e2 = 0.00669438002290  # GRS 80
    corners = [(-100.0, 18.0), (-97.0, 27.5), (-96.999, 27.5), (-103.0, 35.0), (-103.001, 35.0), (-98.0, 31.0), (-97.99, 31.0), (-97.99, 31.01), (-98.0, 31.01)]
    rows = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(corners)], "i int, x double, y double")
    p = [(r["p"]["x"], r["p"]["y"]) for r in rows.orderBy("i").select(g.project_point(F.struct("x", "y")).alias("p")).collect()]
    assert p[0] == pytest.approx((1_500_000, 6_000_000), abs=1e-6)
    for a, b, lat in ((1, 2, 27.5), (3, 4, 35.0)):
        arc = 6378137 * cos(radians(lat)) / sqrt(1 - e2 * sin(radians(lat)) ** 2) * radians(0.001)
        assert sqrt((p[a][0] - p[b][0]) ** 2 + (p[a][1] - p[b][1]) ** 2) == pytest.approx(arc, rel=1e-8)
    e = sqrt(e2)
    zone = lambda lat: (lambda s: s / (1 - e2 * s * s) + log((1 + e * s) / (1 - e * s)) / (2 * e))(sin(radians(lat)))
    area = 6378137**2 * (1 - e2) / 2 * radians(0.01) * (zone(31.01) - zone(31.0))
    q = p[5:]
    assert abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(q, [*q[1:], q[0]], strict=True))) / 2 == pytest.approx(area, rel=1e-6)


def test_stream_gives_bins_once_and_drops_late_rows(spark, tmp_path):
    from roadpulse.streaming.waypoints import stream_waypoints

    source, schema = tmp_path / "in", OBS
    given = []

    def step(*rows):
        obs(spark, *rows).coalesce(1).write.mode("append").parquet(str(source))
        query = (
            stream_waypoints(spark.readStream.schema(schema).parquet(str(source)), links(spark), lateness="10 minutes")
            .writeStream.foreachBatch(lambda df, _: given.extend(df.collect())).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination(120)

    step(("J", 0, 10.0, "A"), ("K", 30, 4.0, "A"), ("K", 400, 7.0, "B"))
    assert given == []
    step(("J", 2000, 10.0, "A"))  # the watermark passes the first two bins
    step(("J", 60, 99.0, "A"), ("J", 4000, 1.0, "A"))  # too late for its bin
    got = sorted((r["link_key"], r["time_bin"], r["waypoint_count"], r["journey_count"], r["slow_movement_count"]) for r in given)
    assert got == [("A", T0, 2, 2, 1), ("A", T0 + timedelta(minutes=30), 1, 1, 0), ("B", T0 + timedelta(minutes=5), 1, 1, 0)]


def test_pivot_keeps_equal_clocks_of_two_days_apart(spark):
    rows = [("A", T0 + timedelta(days=d), 3, float(10 + d)) for d in (0, 1)] + [("B", T0, 9, 7.0)]
    moe_rows = spark.createDataFrame(rows, "link_key string, time_bin timestamp_ntz, waypoint_count long, DSH double")
    grid = report.heatmap_grid(moe_rows, "DSH")
    assert {r["label"] for r in grid.collect()} == {"19:00"}
    table = report.pivoted(grid)
    assert table.columns == ["rank", "link_key", "2025-09-20 19:00", "2025-09-21 19:00"]
    assert [tuple(r) for r in table.collect()] == [(1, "B", 7.0, None), (2, "A", 10.0, 11.0)]


def test_whole_numbers_of_64_bits(spark, tmp_path):
    (tmp_path / "n.csv").write_text("link_key,from_node_id,to_node_id,geometry,heading,length,Matched_GID,name,facility_type,RDBD_TYPE,Functional Class\nA,9007199254740993,9007199254740992,bad,1,2,7,n,f,r,c\nB,12.0,1e30,bad,1,2,7,n,f,r,c\n")
    got = readers.read_network(spark, str(tmp_path / "n.csv")).orderBy("link_key").collect()
    assert [(r["from_node_id"], r["to_node_id"]) for r in got] == [(9007199254740993, 9007199254740992), (12, None)]


def test_files_are_numbered_without_a_shuffle(spark, tmp_path):
    head = "journey_id,capture_time,local_time,speed_mph,link_key\n"
    for name in ("c", "a", "b"):
        (tmp_path / f"{name}.csv").write_text(head + "".join(f"J,2025-09-20 19:00:00,2025-09-20 19:00:00,{i},{name}{i}\n" for i in range(3)))
    rows = readers.read_observations(spark, str(tmp_path))
    assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [r["link_key"] for r in rows.orderBy("obs_id").collect()] == [f"{n}{i}" for n in "abc" for i in range(3)]
    typed = spark.createDataFrame([("J", T0, T0, 1.5, "A")], "journey_id string, capture_time timestamp_ntz, local_time timestamp_ntz, speed_mph double, link_key string")
    typed.write.parquet(str(tmp_path / "typed"))
    assert readers.read_observations(spark, str(tmp_path / "typed"), source="parquet").first()["speed_mph"] == 1.5


def line_east(metres, lat=31.0):
    """A short line whose middle is some metres north of one at ``lat``, about."""
    y = lat + metres / 110_900
    return f"LINESTRING (-98.0 {y:.12f}, -97.999 {y:.12f})"


@pytest.mark.parametrize("unit", ["crs", "us_ft"])
def test_speeds_by_cells_are_those_of_all_pairs(spark, unit):
    from random import Random

    from roadpulse.operators.near import posted_speed_by_cells
    from roadpulse.operators.speed import posted_speed

    rng = Random(6)
    net = [(f"L{i}", float(rng.choice([0, 90, 180])), rng.choice(["7", "7.0", "8", "9", None]), rng.choice([line_east(rng.uniform(-3000, 3000)), line_east(rng.uniform(-99, 99)), "bad", None])) for i in range(60)]
    seg = [(f"S{i}", rng.choice(["7", "8.0", "10"]), rng.choice([90.0, 0.0, None]), rng.choice([None, 0.0, 40.0, 55.0]), rng.choice([line_east(rng.uniform(-300, 300)), line_east(rng.uniform(20_000, 90_000)), "bad", f"MULTILINESTRING ((-98 31.1, -97.9 31.1), (-98.2 {rng.uniform(30, 32)}, -97.8 31.0))"])) for i in range(70)]
    links_ = spark.createDataFrame(net, "link_key string, heading double, Matched_GID string, geometry string")
    segs = spark.createDataFrame(seg, "LinkID string, GID string, Heading double, SpeedLimit double, Geometry string")
    config = CorridorConfig(distance_unit=unit)
    rows = lambda df: sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
    want = rows(posted_speed(links_, segs, config))
    assert rows(posted_speed_by_cells(links_, segs, config)) == want
    assert {v for r in want for v in r} >= {"matched", "outside_threshold", "missing_osm_geometry", "no_valid_speed_candidate"}
    assert rows(posted_speed_by_cells(links_, segs.filter("false"), config)) == rows(posted_speed(links_, segs.filter("false"), config))


def test_distance_at_the_limit_is_not_rounded(spark):
    from roadpulse.operators.speed import posted_speed, speed_candidates

    links_ = spark.createDataFrame([("L", 90.0, "7", line_east(0))], "link_key string, heading double, Matched_GID string, geometry string")
    segs = spark.createDataFrame([("S", "7", 90.0, 40.0, line_east(90))], "LinkID string, GID string, Heading double, SpeedLimit double, Geometry string")
    away = speed_candidates(links_, segs).first()["distance"]
    status = lambda limit: posted_speed(links_, segs, CorridorConfig(max_distance=limit)).first()["speed_match_status"]
    assert (status(away), status(away - 4e-7)) == ("matched", "outside_threshold")
