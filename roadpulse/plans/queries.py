"""The registered queries over the traffic tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.config import FIVE_MINUTES, HOURLY, CorridorConfig, MoeConfig
from roadpulse.functions import geometry as g
from roadpulse.functions.scalars import heading_difference, link_family, maps_url, micros, normalize_gid
from roadpulse.operators import corridor as c
from roadpulse.operators import moe as m
from roadpulse.operators import report as r
from roadpulse.operators import near, pieces, sequence, speed
from roadpulse.operators.quantile import exact_quantile
from roadpulse.plans import fixtures as fx
from roadpulse.sources import readers, sinks
from roadpulse.sources.layout import store_by_journey
from roadpulse.sources.scratch import scratch_path, stored
from roadpulse.streaming.journeys import stream_cells, stream_records, stream_trips
from roadpulse.streaming.steps import run_in_steps
from roadpulse.streaming.upkeep import add_increment, current_measures
from roadpulse.streaming.waypoints import stream_waypoints

#: A start that a user may name.
START = "W3_0_12"

Query = Callable[[SparkSession, str], DataFrame]


def _segments(spark: SparkSession, sf_dir: str, config: MoeConfig = FIVE_MINUTES) -> DataFrame:
    return sequence.with_segments(fx.observations(spark, sf_dir), config)


def trip_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).select("obs_id", "journey_id", "event_time", "link_key", "trip_segment", "run_id")


def link_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.link_runs(_segments(spark, sf_dir))


def _stats(spark: SparkSession, sf_dir: str, config: MoeConfig) -> DataFrame:
    return m.run_stats(_segments(spark, sf_dir, config), fx.links(spark, sf_dir), config)


def _waypoints(config: MoeConfig) -> Query:
    return lambda spark, sf_dir: m.waypoint_metrics(_stats(spark, sf_dir, config), config)


def dsh_runs_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.dsh_runs(_stats(spark, sf_dir, FIVE_MINUTES)).select("link_key", "time_bin", "journey_id", "trip_segment", "run_id", "n", "trip_dsh")


def _dsh(config: MoeConfig) -> Query:
    return lambda spark, sf_dir: m.dsh_metrics(_stats(spark, sf_dir, config), config)


def run_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.run_entries(_segments(spark, sf_dir))


def traversals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.traversals(_segments(spark, sf_dir), fx.links(spark, sf_dir))


def _travel(config: MoeConfig) -> Query:
    return lambda spark, sf_dir: m.travel_time_metrics(m.traversals(_segments(spark, sf_dir, config), fx.links(spark, sf_dir)), config)


def _moe(config: MoeConfig) -> Query:
    return lambda spark, sf_dir: m.link_moe(fx.observations(spark, sf_dir), fx.links(spark, sf_dir), config)


def link_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.link_transitions(fx.observations(spark, sf_dir))


def outgoing_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.outgoing_totals(link_transitions(spark, sf_dir))


def start_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.start_link(link_transitions(spark, sf_dir), fx.network(spark, sf_dir))


def next_link_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.next_link_choices(fx.network(spark, sf_dir), link_transitions(spark, sf_dir))


def corridor_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.walk(fx.network(spark, sf_dir), link_transitions(spark, sf_dir))


def corridor_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The walks from every link of the network."""
    net = fx.network(spark, sf_dir)
    return c.walks(net, link_transitions(spark, sf_dir), net)


def corridor_walk_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The walk from a link that the user names."""
    return c.walk(fx.network(spark, sf_dir), link_transitions(spark, sf_dir), CorridorConfig(start_link=START))


def _corridor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.with_attributes(corridor_walk(spark, sf_dir), fx.network(spark, sf_dir))


def corridor_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["corridor_order", "link_key", "transition_support", "selection_method", "link_length_ft", "distance_start_ft", "distance_end_ft"]
    return _corridor(spark, sf_dir).select(*cols, "topology_connected_from_previous", "geometry_connection_gap_ft")


def corridor_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.corridor_length(_corridor(spark, sf_dir))


def network_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.network(spark, sf_dir).select(
        "link_key", normalize_gid(F.col("Matched_GID")).alias("gid"), link_family(F.col("link_key")).alias("family"), heading_difference(F.col("heading"), F.lit(350.0)).alias("turn")
    )


def network_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a small file has few row groups: the rows are spread before the costly part, and each step is a column, so that it is worked out once
    net = fx.network(spark, sf_dir).select("link_key", "geometry").repartition("link_key")
    rows = net.select("link_key", g.parse_lines(F.col("geometry")).alias("lines")).withColumn("plane", g.project(F.col("lines")))
    rows = rows.withColumns({"start": g.first_point(F.col("plane")), "middle": g.midpoint(F.col("plane"))})
    return rows.select(
        "link_key", F.round(g.length(F.col("lines")), 9).alias("degrees"), F.round(g.length(F.col("plane")), 6).alias("metres"),
        F.round("start.x", 6).alias("start_x"), F.round("start.y", 6).alias("start_y"), F.round("middle.x", 6).alias("mid_x"), F.round("middle.y", 6).alias("mid_y"),
    )


def speed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed.speed_candidates(fx.network(spark, sf_dir), fx.segments(spark, sf_dir))


def posted_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speed.posted_speed(fx.network(spark, sf_dir), fx.segments(spark, sf_dir))


def posted_speed_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole network's posted speeds without the pairs of each identifier."""
    return near.posted_speed_by_cells(fx.network(spark, sf_dir), fx.segments(spark, sf_dir))


def corridor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.build_corridor(fx.observations(spark, sf_dir), fx.network(spark, sf_dir), fx.segments(spark, sf_dir))


def corridor_moe_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.corridor_moe(fx.observations(spark, sf_dir), corridor_table(spark, sf_dir))


def top_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.top_links(_moe(FIVE_MINUTES)(spark, sf_dir))


def heatmap_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.heatmap_grid(stored(_moe(FIVE_MINUTES)(spark, sf_dir)))


def heatmap_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = r.heatmap_grid(stored(_moe(FIVE_MINUTES)(spark, sf_dir)), "DSH")
    return r.pivoted(stored(grid.withColumn("value", F.round("value", 9))))


def timespace_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.timespace_grid(stored(corridor_moe_5min(spark, sf_dir)))


def timespace_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(axis, place, value): distances along the corridor (y), seconds since 1970 (x)."""
    edges = r.timespace_edges(stored(corridor_moe_5min(spark, sf_dir)))
    y = edges.select(F.lit("y").alias("axis"), F.posexplode("y_edges").alias("place", "value"))
    x = edges.select(F.lit("x").alias("axis"), F.posexplode("x_edges").alias("place", "t")).select("axis", "place", (micros(F.col("t")) / 1_000_000.0).alias("value"))
    return y.unionByName(x)


def color_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.color_limits(corridor_moe_5min(spark, sf_dir))


def time_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.time_step(corridor_moe_5min(spark, sf_dir))


def corridor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.corridor_summary(corridor_moe_5min(spark, sf_dir))


def worst_speed_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.worst(corridor_summary(spark, sf_dir), "mean_speed_reduction_pct")


def worst_travel_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.worst(corridor_summary(spark, sf_dir), "mean_avg_travel_time_s")


def _points_rounded(df: DataFrame) -> DataFrame:
    """Points to nine digits and the map links of these: the last digits differ between engines."""
    for p in ("start", "mid", "end"):
        lat, lon = F.round(f"{p}_lat", 9), F.round(f"{p}_lon", 9)
        df = df.withColumns({f"{p}_lat": lat, f"{p}_lon": lon, f"{p}_google_maps_url": maps_url(lat, lon)})
    return df


def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points_rounded(r.map_points(_corridor(spark, sf_dir)))


_POINT_COLUMNS = [f"{p}_{x}" for p in ("start", "mid", "end") for x in ("lat", "lon", "google_maps_url")]


def corridor_diagnostic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corridor beside what is known of its links; of the clashing columns some."""
    corridor = corridor_table(spark, sf_dir)
    moe = m.corridor_moe(fx.observations(spark, sf_dir), corridor)
    out = _points_rounded(r.diagnostic(corridor, fx.network(spark, sf_dir), r.corridor_summary(moe)))
    summary = [x for x in out.columns if x.startswith(("mean_", "max_", "total_"))]
    return out.select("corridor_order", "link_key", "heading", "heading_network", "Matched_GID_network", "length", "posted_speed_limit_mph", *_POINT_COLUMNS, *summary)


def corridor_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = sinks.geopackage_layer(r.export_layer(fx.network(spark, sf_dir), corridor_table(spark, sf_dir)), "geometry")
    return layer.select("net_id", "link_key", "from_node_id", "heading", "name", "geometry", "corridor_order", "link_length_ft", "Matched_GID_corridor", "name_corridor", "posted_speed_limit_mph")


def geopackage_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two layers of the export, by name."""
    corridor = corridor_table(spark, sf_dir)
    a = sinks.geopackage_layer(r.export_layer(fx.network(spark, sf_dir), corridor), "geometry").select(F.lit("corridor_links").alias("layer"), F.col("link_key").alias("key"), "geom")
    wanted = corridor.select(normalize_gid(F.col("Matched_GID")).alias("gid")).dropna().distinct()
    own = fx.segments(spark, sf_dir).withColumn("gid", normalize_gid(F.col("GID"))).join(wanted, "gid", "left_semi")
    b = sinks.geopackage_layer(own, "Geometry").select(F.lit("txdot_segments").alias("layer"), F.col("LinkID").cast("string").alias("key"), "geom")
    return a.unionByName(b).select("layer", "key", F.size("geom").alias("parts"))


def _as_csv(df: DataFrame, *order: str) -> str:
    """Where ``df`` was written as CSV files."""
    path = scratch_path(df.sparkSession)
    sinks.write_csv(df, path, *order)
    return path


def scan_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several files; the place of each row in the order of files and rows, by its number."""
    path = _as_csv(fx.observations(spark, sf_dir).repartitionByRange(4, "obs_id").sortWithinPartitions("obs_id").drop("obs_id"))
    rows = readers.read_observations(spark, path)
    earlier = Window.partitionBy("journey_id").orderBy("obs_id")
    return rows.withColumn("place", F.row_number().over(earlier)).drop("obs_id")


def scan_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each link twice in the file; the first row counts."""
    net = fx.network(spark, sf_dir).withColumns({"facility_type": F.lit("f"), "rdbd_type": F.lit("r"), "functional_class": F.lit("c")}).withColumnRenamed("Matched_GID", "matched_gid")
    twice = net.withColumn("copy", F.lit(1)).unionByName(net.withColumns({"copy": F.lit(2), "name": F.lit("again")}))
    out = readers.read_network(spark, _as_csv(twice, "copy", "net_id"), fx.links(spark, sf_dir))
    return out.select("link_key", "from_node_id", "to_node_id", "geometry", "heading", "length", "Matched_GID", "name", "RDBD_TYPE")


def scan_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments with an identifier of the observed links."""
    own = fx.network(spark, sf_dir).join(fx.links(spark, sf_dir), "link_key", "left_semi")
    out = readers.read_segments(spark, _as_csv(fx.segments(spark, sf_dir)), own)
    return out.select(F.col("LinkID").cast("long").alias("LinkID"), "GID_norm", "Geometry", "Heading", "SpeedLimit")


def scan_link_moe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_link_moe(spark, _as_csv(_moe(FIVE_MINUTES)(spark, sf_dir), "link_key", "time_bin"))


def scan_corridor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_corridor(spark, _as_csv(corridor_table(spark, sf_dir), "corridor_order"))


def scan_corridor_moe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_corridor_moe(spark, _as_csv(corridor_moe_5min(spark, sf_dir), "corridor_order", "time_bin"))


def stream_waypoints_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's plan over a table, without the approximate column."""
    return stream_waypoints(fx.observations(spark, sf_dir), fx.links(spark, sf_dir)).drop("journey_count")


def speed_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speed that 85 of 100 waypoints of a link stay below."""
    rows = fx.observations(spark, sf_dir).filter("speed_mph >= 0 AND link_key IS NOT NULL")
    return exact_quantile(rows, ["link_key"], "speed_mph", 0.85, "speed_85").select("link_key", F.round("speed_85", 9).alias("speed_85"))


def bucketed_link_moe_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of observations that are stored by journey."""
    table = store_by_journey(fx.observations(spark, sf_dir), f"observations_{uuid.uuid4().hex}", 8)
    return m.link_moe(table, fx.links(spark, sf_dir))


def selected_link_moe_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of the links of a key list: the ten with most waypoints, written and read as a file; journeys on none of them go before the sort."""
    moe = _moe(FIVE_MINUTES)(spark, sf_dir)
    links = readers.read_links(spark, _as_csv(r.top_links(moe, 10).select("link_key")))
    return m.link_moe(m.touching(fx.observations(spark, sf_dir), links), links)


def reduced_corridor_moe_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    corridor = corridor_table(spark, sf_dir)
    return m.corridor_moe(m.touching(fx.observations(spark, sf_dir), corridor), corridor)


#: Journeys of the test tables with more observations than this are worked on in pieces.
_HOT = 1000


def hot_trip_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.split_segments(fx.hot_observations(spark, sf_dir), most=_HOT)
    return rows.select("obs_id", "journey_id", "event_time", "link_key", "trip_segment", "run_id")


def _hot_moe(config: MoeConfig) -> Query:
    return lambda spark, sf_dir: m.split_link_moe(fx.hot_observations(spark, sf_dir), fx.links(spark, sf_dir), config, most=_HOT)


def hot_link_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.split_link_transitions(fx.hot_observations(spark, sf_dir), most=_HOT)


def _arriving(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All observations in the parts in which they arrive, up to seven minutes late; then rows of other journeys far later, which end the stream."""
    rows = fx.observations(spark, sf_dir)
    minutes = F.floor(micros(F.col("local_time")) / 60_000_000) + F.col("obs_id") % 7
    rows = stored(rows.withColumn("part", F.floor(minutes / 30).cast("long")))
    first, last = rows.agg(F.min("part"), F.max("part")).first()
    parts = [rows.filter(F.col("part") == p).drop("part") for p in range(first, last + 1)] if first is not None else [rows.drop("part")]
    ends = [(datetime(2200 + i, 1, 1), f"end {i}") for i in (1, 2)]
    schema = rows.drop("part").schema
    return [*parts, *[spark.createDataFrame([(-1, j, t, t, 1.0, "no link")], schema) for t, j in ends]]


def stream_trip_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_in_steps(spark, _arriving(spark, sf_dir), stream_trips)
    rows = spark.read.parquet(out).filter("obs_id >= 0")
    return rows.select("obs_id", "journey_id", "event_time", "link_key", "trip_segment", "run_id")


def stream_link_moe_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of runs by one stream, their cells by another one over the records."""
    records = spark.read.parquet(run_in_steps(spark, _arriving(spark, sf_dir), stream_records))
    last = records.filter("link_key = 'no link'")
    parts = [records.filter("link_key <> 'no link'"), last]
    return spark.read.parquet(run_in_steps(spark, parts, lambda df: stream_cells(df, fx.links(spark, sf_dir))))


def kept_link_moe_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures kept over increments of whole journeys, one of which comes twice."""
    store, rows = scratch_path(spark), fx.observations(spark, sf_dir)
    for i in (0, 1, 2, 1):
        own = rows.filter(F.crc32("journey_id") % 3 == i)
        add_increment(store, m.partial_sums(m.runs_with_travel(own), fx.links(spark, sf_dir)), i)
    return current_measures(spark, store)


QUERIES: dict[str, Query] = {
    "trip_segments": trip_segments,
    "link_runs": link_runs,
    "waypoint_5min": _waypoints(FIVE_MINUTES),
    "waypoint_hourly": _waypoints(HOURLY),
    "dsh_runs_5min": dsh_runs_5min,
    "dsh_5min": _dsh(FIVE_MINUTES),
    "dsh_hourly": _dsh(HOURLY),
    "run_entries": run_entries,
    "traversals": traversals,
    "travel_time_5min": _travel(FIVE_MINUTES),
    "travel_time_hourly": _travel(HOURLY),
    "link_moe_5min": _moe(FIVE_MINUTES),
    "link_moe_hourly": _moe(HOURLY),
    "link_transitions": link_transitions,
    "outgoing_totals": outgoing_totals,
    "start_link": start_link,
    "next_link_choices": next_link_choices,
    "corridor_walk": corridor_walk,
    "corridor_walks": corridor_walks,
    "corridor_walk_from": corridor_walk_from,
    "corridor_links": corridor_links,
    "corridor_length": corridor_length,
    "network_scalars": network_scalars,
    "network_geometry": network_geometry,
    "speed_candidates": speed_candidates,
    "posted_speed": posted_speed,
    "posted_speed_by_cells": posted_speed_by_cells,
    "corridor_table": corridor_table,
    "corridor_moe_5min": corridor_moe_5min,
    "top_links": top_links,
    "heatmap_grid": heatmap_grid,
    "heatmap_pivot": heatmap_pivot,
    "timespace_grid": timespace_grid,
    "timespace_edges": timespace_edges,
    "color_limits": color_limits,
    "time_step": time_step,
    "corridor_summary": corridor_summary,
    "worst_speed_reduction": worst_speed_reduction,
    "worst_travel_time": worst_travel_time,
    "map_points": map_points,
    "corridor_diagnostic": corridor_diagnostic,
    "corridor_layer": corridor_layer,
    "geopackage_layers": geopackage_layers,
    "scan_observations": scan_observations,
    "scan_network": scan_network,
    "scan_segments": scan_segments,
    "scan_link_moe": scan_link_moe,
    "scan_corridor": scan_corridor,
    "scan_corridor_moe": scan_corridor_moe,
    "speed_quantiles": speed_quantiles,
    "bucketed_link_moe_5min": bucketed_link_moe_5min,
    "selected_link_moe_5min": selected_link_moe_5min,
    "reduced_corridor_moe_5min": reduced_corridor_moe_5min,
    "hot_trip_segments": hot_trip_segments,
    "hot_link_moe_5min": _hot_moe(FIVE_MINUTES),
    "hot_link_moe_hourly": _hot_moe(HOURLY),
    "hot_link_transitions": hot_link_transitions,
    "stream_trip_segments": stream_trip_segments,
    "stream_link_moe_5min": stream_link_moe_5min,
    "kept_link_moe_5min": kept_link_moe_5min,
    "stream_waypoints": stream_waypoints_table,
}

#: Results that add up fractions in any order, or that hang on an engine's sines, to so many digits; the operators round nothing.
ROUNDED: dict[str, dict[str, int]] = (
    dict.fromkeys(["dsh_5min", "dsh_hourly"], {"dsh_sum": 9})
    | dict.fromkeys([q for q in QUERIES if "link_moe" in q or "corridor_moe" in q], {"DSH": 9})
    | {"corridor_links": {"geometry_connection_gap_ft": 6}, "speed_candidates": {"distance": 6}, **dict.fromkeys(["posted_speed", "posted_speed_by_cells"], {"txdot_match_distance_ft": 6})}
    | dict.fromkeys(["corridor_table", "scan_corridor"], {"geometry_connection_gap_ft": 6, "txdot_match_distance_ft": 6})
    | dict.fromkeys(["heatmap_grid", "timespace_grid"], {"value": 9})
    | {"color_limits": {"vmax": 6}}
    | dict.fromkeys(
        ["corridor_summary", "worst_speed_reduction", "worst_travel_time", "corridor_diagnostic"],
        dict.fromkeys(["mean_avg_speed_mph", "mean_speed_reduction_pct", "max_speed_reduction_pct", "mean_avg_travel_time_s", "mean_slow_movement_pct", "mean_DSH"], 6),
    )
)


def _rounded(query: Query, digits: dict[str, int]) -> Query:
    return lambda spark, sf_dir: query(spark, sf_dir).withColumns({c: F.round(c, d) for c, d in digits.items()})


QUERIES |= {name: _rounded(QUERIES[name], digits) for name, digits in ROUNDED.items()}
