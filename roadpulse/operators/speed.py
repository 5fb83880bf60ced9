"""Posted speed limits for corridor links, by identifier, distance and heading."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.config import CorridorConfig
from roadpulse.functions import geometry as g
from roadpulse.functions.scalars import heading_difference, normalize_gid


def link_lines(corridor: DataFrame) -> DataFrame:
    """The links with their identifier and their line in the plane."""
    return corridor.select("link_key", F.col("heading").alias("link_heading"), normalize_gid(F.col("Matched_GID")).alias("gid"), g.project(g.parse_lines(F.col("geometry"))).alias("line"))


def _pairs(corridor: DataFrame, segments: DataFrame, config: CorridorConfig, how: str) -> DataFrame:
    """Links beside the segments with their identifier; only such segments are parsed, each once."""
    scale = 1.0 if config.distance_unit == "crs" else 1 / g.US_FOOT
    parts = segments.select(
        F.col("LinkID").alias("segment_id"), normalize_gid(F.col("GID")).alias("gid"), F.col("Heading").alias("segment_heading"), F.col("SpeedLimit").alias("limit"), F.col("Geometry").alias("segment_text")
    )
    links = link_lines(corridor).withColumn("middle", g.midpoint(F.col("line")))
    parts = parts.join(corridor.select(normalize_gid(F.col("Matched_GID")).alias("gid")).dropna().distinct(), "gid", "left_semi")
    parts = parts.withColumn("segment", g.project(g.parse_lines(F.col("segment_text"))))
    pairs = links.join(parts, "gid", how)
    return pairs.select(
        "link_key", "gid", F.col("line").isNotNull().alias("drawn"), F.col("segment").isNotNull().alias("candidate"), "segment_id", "limit",
        (g.point_line_distance(F.col("middle"), F.col("segment")) * scale).alias("distance"),
        heading_difference(F.col("link_heading"), F.col("segment_heading")).alias("turn"),
    )


def speed_candidates(corridor: DataFrame, segments: DataFrame, config: CorridorConfig = CorridorConfig()) -> DataFrame:
    """Segments with a link's identifier and a geometry, with distance from the link's midpoint and turn between headings.

    A corridor is at most ``max_links`` rows: Spark broadcasts it then, and segments that match none don't shuffle. A whole network joins by shuffle.
    """
    return _pairs(corridor, segments, config, "inner").filter("candidate").select("link_key", "segment_id", "limit", "distance", "turn")


def posted_speed(corridor: DataFrame, segments: DataFrame, config: CorridorConfig = CorridorConfig()) -> DataFrame:
    """One row per link: limit, its segment, and how it was found.

    Of segments with a limit the nearest within distance and heading wins, then the smaller turn, then the smaller id; if there is none
    ("outside_threshold") the nearest of all still gives its limit. One join and one sort by link.
    """
    near = (F.col("distance") <= config.max_distance) & F.coalesce(F.col("turn") <= config.max_heading, F.lit(True))
    pairs = _pairs(corridor, segments, config, "left").withColumns({"usable": F.col("candidate") & F.coalesce(F.col("limit") > 0, F.lit(False)), "near": F.coalesce(near, F.lit(False))})
    turn = F.when(F.col("near"), F.col("turn"))
    link = Window.partitionBy("link_key")
    order = link.orderBy(F.col("usable").desc(), F.col("near").desc(), F.col("distance").asc_nulls_last(), turn.asc_nulls_last(), "segment_id")
    rows = pairs.withColumns({"place": F.row_number().over(order), "n": F.count_if("candidate").over(link), "n_usable": F.count_if("usable").over(link)}).filter("place = 1")
    return speed_rows(rows)


def speed_rows(best: DataFrame) -> DataFrame:
    """The columns of ``posted_speed`` from each link's best segment, if it has any."""
    given = F.col("usable") & F.col("drawn")
    status = F.when(~F.col("usable"), "no_valid_speed_candidate").when(~F.col("drawn"), "missing_osm_geometry").when(F.col("near"), "matched").otherwise("outside_threshold")
    return best.select(
        "link_key",
        F.when(given, F.col("limit")).alias("posted_speed_limit_mph"),
        F.when(given, F.col("segment_id")).alias("txdot_link_id"),
        F.col("gid").alias("txdot_gid"),
        F.when(given, F.col("distance")).alias("txdot_match_distance_ft"),
        F.when(given, F.col("turn")).alias("txdot_heading_difference_deg"),
        F.col("n").alias("txdot_candidate_count"),
        F.col("n_usable").alias("txdot_valid_speed_candidate_count"),
        status.alias("speed_match_status"),
    )
