"""Tables behind the figures and lists: top links, grids, colour limits, summaries, map points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions import geometry as g
from roadpulse.functions.scalars import clip_percent, clock, maps_url
from roadpulse.operators.quantile import exact_quantile
from roadpulse.sources.scratch import stored

#: Metrics of the link heat maps, and of the corridor's figures with how their colours are limited.
HEATMAP_METRICS = ["avg_travel_time_s", "slow_movement_count", "slow_movement_pct", "DSH"]
TIMESPACE_METRICS = {"avg_travel_time_s": "robust", "slow_movement_count": "robust", "slow_movement_pct": "percent", "DSH": "robust", "speed_reduction_pct": "percent_clip"}


def top_links(moe: DataFrame, n: int = 30) -> DataFrame:
    totals = moe.groupBy("link_key").agg(F.sum("waypoint_count").alias("total_waypoints"))
    return totals.orderBy(F.col("total_waypoints").desc(), "link_key").limit(n)


def _ranked(links: DataFrame) -> DataFrame:
    """At most a few dozen links, so one window is fine."""
    return links.withColumn("rank", F.row_number().over(Window.orderBy(F.col("total_waypoints").desc(), "link_key")))


def _values(moe: DataFrame, metrics: list[str]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))


def _with_times(rows: DataFrame, times: DataFrame, *by: str) -> DataFrame:
    """Every row at every time of its ``by``. The times travel as one array: 8 bytes for each five minutes, less than 1 MB a year."""
    lists = times.groupBy(*by).agg(F.sort_array(F.collect_set("time_bin")).alias("times"))
    both = rows.join(lists, list(by)) if by else rows.crossJoin(F.broadcast(lists))  # one row
    return both.withColumn("time_bin", F.explode("times")).drop("times")


def heatmap_grid(moe: DataFrame, *metrics: str, n: int = 30) -> DataFrame:
    """(metric, rank, link_key, time_bin, label, value) for the top links and every time at which one of them has a value of the metric.

    ``moe`` should be a stored table, as it is read several times.
    """
    links = _ranked(top_links(moe, n)).select("rank", "link_key")
    cells = moe.join(links, "link_key").select("rank", "link_key", "time_bin", _values(moe, list(metrics or HEATMAP_METRICS)).alias("v"))
    cells = cells.groupBy("rank", "link_key", "time_bin", F.col("v.metric").alias("metric")).agg(F.avg("v.value").alias("value"))
    rows = links.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in metrics or HEATMAP_METRICS])))
    grid = _with_times(rows, cells.filter(F.col("value").isNotNull()), "metric")
    return grid.join(cells.drop("rank"), ["metric", "link_key", "time_bin"], "left").select("metric", "rank", "link_key", "time_bin", clock(F.col("time_bin")).alias("label"), "value")


def pivoted(grid: DataFrame) -> DataFrame:
    """One row per link and one column per time (named by day and clock), of the grid of one metric; the clock alone labels an axis."""
    return grid.withColumn("at", F.date_format("time_bin", "yyyy-MM-dd HH:mm")).groupBy("rank", "link_key").pivot("at").agg(F.avg("value")).orderBy("rank")


def time_step(moe: DataFrame) -> DataFrame:
    """Median seconds between the times that occur; five minutes if there is but one."""
    times = moe.select("time_bin").dropna().distinct()
    gaps = times.withColumn("gap", F.timestamp_diff("MICROSECOND", F.lag("time_bin").over(Window.orderBy("time_bin")), F.col("time_bin")))
    return gaps.agg(F.coalesce(F.expr("percentile(gap, 0.5)") / 1_000_000.0, F.lit(300.0)).alias("step_s"))


def timespace_grid(moe: DataFrame, metrics: dict[str, str] = TIMESPACE_METRICS) -> DataFrame:
    """(metric, ...) for every link of a corridor's measures at every time, with its stretch of the corridor; links without measures have no row.

    ``moe`` should be a stored table, as it is read several times.
    """
    links = moe.select("corridor_order", "link_key", "distance_start_ft", "distance_end_ft").dropDuplicates(["link_key"])
    cells = moe.filter(F.col("time_bin").isNotNull()).select("link_key", "time_bin", _values(moe, list(metrics)).alias("v"))
    cells = cells.groupBy("link_key", "time_bin", F.col("v.metric").alias("metric")).agg(F.avg("v.value").alias("value"))
    rows = links.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in metrics])))
    grid = _with_times(rows, moe.filter(F.col("time_bin").isNotNull())).join(cells, ["metric", "link_key", "time_bin"], "left")
    clipped = [m for m, mode in metrics.items() if mode == "percent_clip"]
    value = F.when(F.col("metric").isin(*clipped), clip_percent(F.col("value"))).otherwise(F.col("value")) if clipped else F.col("value")
    return grid.select("metric", "corridor_order", "link_key", "time_bin", "distance_start_ft", "distance_end_ft", value.alias("value"))


def timespace_edges(moe: DataFrame) -> DataFrame:
    """One row: the edges of the grid's cells, along the corridor (y_edges, as floats) and in time (x_edges, one step beyond the last time)."""
    links = moe.select("corridor_order", "link_key", "distance_start_ft", "distance_end_ft").dropDuplicates(["link_key"])
    stretch = F.sort_array(F.collect_list(F.struct("corridor_order", "distance_start_ft", "distance_end_ft")))
    along = links.agg(stretch.alias("s")).select(F.concat(F.transform(F.slice("s", 1, 1), lambda x: x["distance_start_ft"]), F.transform("s", lambda x: x["distance_end_ft"])).alias("y_edges"))
    times = moe.agg(F.sort_array(F.collect_set("time_bin")).alias("t"))
    last = F.timestamp_add("MICROSECOND", (F.col("step_s") * 1_000_000).cast("long"), F.element_at("t", -1))
    x = F.when(F.size("t") > 0, F.concat("t", F.array(last))).otherwise(F.col("t"))
    return along.crossJoin(times).crossJoin(time_step(moe)).select("y_edges", x.alias("x_edges"))  # one row each


def color_limits(moe: DataFrame, metrics: dict[str, str] = TIMESPACE_METRICS) -> DataFrame:
    """(metric, mode, vmin, vmax): robust ends at the 95th percentile of the values that aren't negative."""
    stack = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(mode).alias("mode"), F.col(m).cast("double").alias("value")) for m, mode in metrics.items()]))
    cells = stored(moe.select("link_key", "time_bin", stack.alias("s")).groupBy("link_key", "time_bin", "s.metric", "s.mode").agg(F.avg("s.value").alias("value")))
    high = exact_quantile(cells.filter("value >= 0"), ["metric"], "value", 0.95, "high")
    found = cells.groupBy("metric", "mode").agg(F.count("value").alias("n"), F.max("value").alias("most")).join(high, "metric", "left")
    robust = F.coalesce("high", "most")
    vmax = F.when(F.col("n") == 0, 1.0).when(F.col("mode").startswith("percent"), 100.0).when(robust > 0, robust).otherwise(1.0)
    return found.select("metric", "mode", F.lit(0.0).alias("vmin"), vmax.alias("vmax"))


def corridor_summary(moe: DataFrame) -> DataFrame:
    """Unweighted means of the bins of each link."""
    return moe.groupBy("link_key").agg(
        F.avg("avg_speed_mph").alias("mean_avg_speed_mph"),
        F.avg("speed_reduction_pct").alias("mean_speed_reduction_pct"),
        F.max("speed_reduction_pct").alias("max_speed_reduction_pct"),
        F.avg("avg_travel_time_s").alias("mean_avg_travel_time_s"),
        F.coalesce(F.sum("waypoint_count"), F.lit(0)).alias("total_waypoints"),
        F.avg("slow_movement_pct").alias("mean_slow_movement_pct"),
        F.avg("DSH").alias("mean_DSH"),
        F.coalesce(F.sum("complete_traversal_count"), F.lit(0)).alias("total_complete_traversals"),
    )


def worst(summary: DataFrame, metric: str, n: int = 10) -> DataFrame:
    return summary.orderBy(F.col(metric).desc_nulls_last(), "link_key").limit(n)


def map_points(corridor: DataFrame) -> DataFrame:
    """First, middle (along the line, in degrees) and last point of each link with map links; empty where there is no geometry."""
    rows = corridor.withColumn("lines", g.parse_lines(F.col("geometry")))
    points = {"start": g.first_point(F.col("lines")), "mid": g.midpoint(F.col("lines")), "end": g.last_point(F.col("lines"))}
    cols, urls = [], []
    for name, p in points.items():
        lat, lon = p["y"], p["x"]
        cols += [lat.alias(f"{name}_lat"), lon.alias(f"{name}_lon")]
        urls.append(maps_url(lat, lon).alias(f"{name}_google_maps_url"))
    return rows.select("corridor_order", "link_key", "distance_start_ft", "distance_end_ft", *cols, *urls)


def _suffixed(right: DataFrame, left: DataFrame, suffix: str) -> DataFrame:
    """``right`` with a suffix on the columns, but for link_key, that ``left`` has too."""
    return right.select("link_key", *[F.col(f"`{c}`").alias(f"{c}{suffix}" if c in left.columns else c) for c in right.columns if c != "link_key"])


def diagnostic(corridor: DataFrame, network: DataFrame, summary: DataFrame) -> DataFrame:
    """The corridor with the network's attributes (suffix _network where names clash), map points and the summary of its measures."""
    own = network.join(corridor.select("link_key"), "link_key", "left_semi")
    points = map_points(corridor).drop("corridor_order", "distance_start_ft", "distance_end_ft")
    return corridor.join(_suffixed(own, corridor, "_network"), "link_key", "left").join(points, "link_key", "left").join(summary, "link_key", "left")


def export_layer(network: DataFrame, corridor: DataFrame) -> DataFrame:
    """The network's links that are in the corridor, in its order, with the corridor's attributes but its geometry (suffix _corridor where names clash)."""
    own = network.join(corridor.select("link_key"), "link_key", "left_semi")
    return own.join(_suffixed(corridor.drop("geometry"), network, "_corridor"), "link_key", "left").orderBy(F.col("corridor_order").cast("int"))
