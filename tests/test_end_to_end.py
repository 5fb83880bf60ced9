"""All steps in a row, each from the files that the one before has written, against the same steps without files."""

import sqlite3

from pyspark.sql import functions as F

from roadpulse.config import HOURLY
from roadpulse.functions.scalars import normalize_gid
from roadpulse.operators import corridor, moe, report
from roadpulse.plans import fixtures as fx
from roadpulse.sources import readers, sinks

from .test_scale import same

SF = "/root/testdata/sf0.001"


def test_from_files_to_files(spark, tmp_path):
    at = lambda name: f"file://{tmp_path}/{name}"
    obs, net, seg, links = fx.observations(spark, SF), fx.network(spark, SF), fx.segments(spark, SF), fx.links(spark, SF)
    sinks.write_csv(obs.drop("obs_id"), at("observations"), "local_time")
    sinks.write_csv(net.drop("net_id").withColumns({c: F.lit("x") for c in ("facility_type", "RDBD_TYPE", "Functional Class")}), at("network"), "link_key")
    sinks.write_csv(seg, at("segments"), "LinkID")
    sinks.write_csv(links, at("selected"))
    # measures of the selected links
    obs_, links_ = readers.read_observations(spark, at("observations")), readers.read_links(spark, at("selected"))
    sinks.write_csv(moe.link_moe(obs_, links_), at("link_moe"), "link_key", "time_bin")
    same(readers.read_link_moe(spark, at("link_moe")), moe.link_moe(obs, links))
    same(moe.link_moe(obs_, links_, HOURLY), moe.link_moe(obs, links, HOURLY))
    same(report.heatmap_grid(readers.read_link_moe(spark, at("link_moe"))), report.heatmap_grid(moe.link_moe(obs, links)))
    # the corridor and its measures
    net_, seg_ = readers.read_network(spark, at("network")), readers.read_segments(spark, at("segments"))
    built = corridor.build_corridor(obs_, net_, seg_)
    sinks.write_csv(built, at("corridor"), "corridor_order")
    corridor_ = readers.read_corridor(spark, at("corridor"))
    own = ["corridor_order", "link_key", "transition_support", "link_length_ft", "distance_end_ft", "geometry_connection_gap_ft", "posted_speed_limit_mph", "speed_match_status"]
    same(corridor_.select(*own), corridor.build_corridor(obs, net, seg).select(*own))
    sinks.write_csv(moe.corridor_moe(obs_, corridor_), at("corridor_moe"), "corridor_order", "time_bin")
    measures = readers.read_corridor_moe(spark, at("corridor_moe"))
    same(measures, moe.corridor_moe(obs, built))
    assert report.timespace_grid(measures).count() == 5 * measures.select("link_key").distinct().count() * measures.select("time_bin").distinct().count()
    # reports and the export
    found = report.diagnostic(corridor_, net_.drop("net_id"), report.corridor_summary(measures))
    assert found.count() == corridor_.count() and "heading_network" in found.columns
    layer = sinks.geopackage_layer(report.export_layer(net_.drop("net_id"), corridor_), "geometry")
    gids = corridor_.select(normalize_gid(F.col("Matched_GID")).alias("GID_norm")).dropna().distinct()
    segments = sinks.geopackage_layer(seg_.join(gids, "GID_norm", "left_semi"), "Geometry")
    path = str(tmp_path / "corridor.gpkg")
    sinks.write_geopackage(path, {"corridor_links": layer, "txdot_segments": segments})
    with sqlite3.connect(path) as db:
        keys = [k for (k,) in db.execute("SELECT link_key FROM corridor_links ORDER BY fid")]
        (n,) = db.execute("SELECT count(*) FROM txdot_segments").fetchone()
    assert keys == [r["link_key"] for r in layer.orderBy("corridor_order").collect()] and n == segments.count() > 0
