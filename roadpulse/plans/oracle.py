"""DuckDB SQL for the registered queries, put together from named steps."""

from __future__ import annotations

import re

from roadpulse.functions import geometry as g
from roadpulse.operators.report import HEATMAP_METRICS, TIMESPACE_METRICS
from roadpulse.plans.fixtures import HOT_OBSERVATIONS_SQL, NETWORK_SQL, OBSERVATIONS_SQL, SEGMENTS_SQL, duck
from roadpulse.plans.queries import ROUNDED


def _plane(x: str, y: str) -> tuple[str, str]:
    s = f"sin(radians({y}))"
    q = f"((1 - {g.E**2!r}) * ({s} / (1 - {g.E**2!r} * {s} * {s}) - ln((1 - {g.E!r} * {s}) / (1 + {g.E!r} * {s})) / (2 * {g.E!r})))"
    rho, theta = f"({g.MAJOR!r} * sqrt({g.C!r} - {g.N!r} * {q}) / {g.N!r})", f"({g.N!r} * radians({x} + 100.0))"
    return f"({g.FALSE_EAST!r} + {rho} * sin({theta}))", f"({g.FALSE_NORTH!r} + {g.RHO_0!r} - {rho} * cos({theta}))"


def _pieces(table: str, key: str, geometry: str) -> str:
    """The straight pieces (part, i) of lines by key ``k``, in degrees (a to b) and in the plane (p to q); texts that aren't lines have none."""
    number = "-?[0-9]+(?:\\.[0-9]+)?(?:e-?[0-9]+)?"
    parts = f"SELECT {key} AS k, string_split(regexp_replace({geometry}, '\\)\\s*,\\s*\\(|\\]\\s*\\]\\s*,\\s*\\[\\s*\\[', '|', 'g'), '|') AS parts FROM {table}"
    numbers = f"SELECT k, part, list_transform(regexp_extract_all(txt, '{number}'), lambda x: x::DOUBLE) AS p FROM (SELECT k, generate_subscripts(parts, 1) AS part, unnest(parts) AS txt FROM ({parts}))"
    pieces = f"SELECT k, part, i, p[2 * i - 1] AS ax, p[2 * i] AS ay, p[2 * i + 1] AS bx, p[2 * i + 2] AS bw FROM (SELECT *, unnest(range(1, len(p) // 2)) AS i FROM ({numbers}))"
    (px, py), (qx, qy) = _plane("ax", "ay"), _plane("bx", 'bw')
    return f"SELECT *, sqrt((bx - ax) ** 2 + (bw - ay) ** 2) AS deg, sqrt((qx - px) ** 2 + (qy - py) ** 2) AS met FROM (SELECT *, {px} AS px, {py} AS py, {qx} AS qx, {qy} AS qy FROM ({pieces}))"


def _along(size: str, to: str, a: str, b: str) -> str:
    """The coordinate halfway along a line."""
    return f"arg_min({a} + coalesce((t{to} / 2 - (c{to} - {size})) / nullif({size}, 0), 0.0) * ({b} - {a}), o) FILTER (c{to} >= t{to} / 2)"


_LINES = f"""SELECT link_key AS lk, heading AS lh, Matched_GID AS lg, f.* FROM net LEFT JOIN (
  SELECT k, count(DISTINCT part) AS parts, arg_min(ax, o) AS x1, arg_min(ay, o) AS y1, arg_max(bx, o) AS x2, arg_max(bw, o) AS y2, arg_min(px, o) AS px, arg_min(py, o) AS py, arg_max(qx, o) AS qx, arg_max(qy, o) AS qy,
    sum(deg) AS degrees, sum(met) AS metres, {_along('deg', 'd', 'ax', 'bx')} AS dx, {_along('deg', 'd', 'ay', 'bw')} AS dy, {_along('met', 'm', 'px', 'qx')} AS mx, {_along('met', 'm', 'py', 'qy')} AS my
  FROM (SELECT *, part * 100000 + i AS o, sum(deg) OVER w AS cd, sum(deg) OVER v AS td, sum(met) OVER w AS cm, sum(met) OVER v AS tm FROM netp WINDOW w AS (PARTITION BY k ORDER BY part, i), v AS (PARTITION BY k)) GROUP BY k) f ON f.k = link_key"""


_GID = "CASE WHEN regexp_replace(trim({0}), '\\.0$', '') NOT IN ('', 'nan', 'None', '-1') THEN regexp_replace(trim({0}), '\\.0$', '') END"
_TURN = "abs((({0} - {1} + 180.0) % 360 + 360) % 360 - 180.0)"
_SPEED = "CAST(speed_mph AS DECIMAL(28,10))"
_MEASURES = "waypoint_count, journey_count, slow_movement_count, slow_speed_sum / nullif(total_speed, 0) * 100.0 AS slow_movement_pct, dsh_trip_count, dsh_total / dsh_trip_count AS DSH, complete_traversal_count, travel_time_sum_s / complete_traversal_count AS avg_travel_time_s"


def _stats(keys: str, links: str, timed: bool) -> str:
    bin_ = "time_bin, " if "time_bin" in keys else ""
    groups = f"link_key, {bin_}journey_id, trip_segment, run_id"
    return (
        f"SELECT {groups}, count(*) AS n, sum({_SPEED}) AS speed_sum, count(*) FILTER (speed_mph < 5) AS slow, coalesce(sum({_SPEED}) FILTER (speed_mph < 5), 0) AS slow_sum, coalesce(sum(change), 0) AS change_sum "
        f"FROM (SELECT *, abs({_SPEED} - lag({_SPEED}) OVER (PARTITION BY {groups} ORDER BY event_time NULLS LAST, obs_id)) AS change FROM spine "
        f"WHERE speed_mph >= 0 AND link_key IN (SELECT link_key FROM {links}){' AND event_time IS NOT NULL' if timed else ''}) GROUP BY {groups}"
    )


def _waypoints(keys: str, stats: str) -> str:
    return (
        f"SELECT {keys}, sum(n)::BIGINT AS waypoint_count, count(DISTINCT journey_id) AS journey_count, sum(speed_sum)::DOUBLE AS total_speed, sum(slow)::BIGINT AS slow_movement_count, "
        f"sum(slow_sum)::DOUBLE AS slow_speed_sum, count(*) AS dsh_trip_count, sum(change_sum::DOUBLE / n) AS dsh_total FROM {stats} GROUP BY {keys}"
    )


def _travel(keys: str, crossings: str) -> str:
    return f"SELECT {keys}, count(*) AS complete_traversal_count, sum(travel_time_us)::DOUBLE / 1000000.0 AS travel_time_sum_s FROM (SELECT *, time_bucket(INTERVAL '5 minutes', entry_time) AS time_bin FROM {crossings}) GROUP BY {keys}"


def _crossings(links: str) -> str:
    return (
        "SELECT * FROM (SELECT *, lag(link_key) OVER w AS previous_link, lead(link_key) OVER w AS next_link, lead(entry_time) OVER w AS next_entry_time, epoch_us(lead(entry_time) OVER w) - epoch_us(entry_time) AS travel_time_us "
        f"FROM entries WINDOW w AS (PARTITION BY journey_id, trip_segment ORDER BY entry_time, run_id)) WHERE previous_link IS NOT NULL AND next_link IS NOT NULL AND travel_time_us > 0 AND link_key IN (SELECT link_key FROM {links})"
    )


_BIN, _ALL = "link_key, time_bin", "link_key"
_RATIO = "greatest(least(coalesce(((mx - px) * (qx - px) + (my - py) * (qy - py)) / nullif((qx - px) * (qx - px) + (qy - py) * (qy - py), 0), 0.0), 1.0), 0.0)"
_LIMITED = " UNION ALL ".join(f"SELECT link_key, time_bin, '{m}' AS metric, '{mode}' AS mode, CAST({m} AS DOUBLE) AS value FROM cmoe" for m, mode in TIMESPACE_METRICS.items())

STEPS = {
    "obs": OBSERVATIONS_SQL,
    "net": duck(NETWORK_SQL),
    "seg": duck(SEGMENTS_SQL),
    "links": "SELECT link_key FROM net WHERE net_id < 100",
    "netp": _pieces("net", "link_key", "geometry"),
    "segp": _pieces("seg", "LinkID", "Geometry"),
    "spine": """SELECT obs_id, journey_id, event_time, speed_mph, link_key, time_bucket(INTERVAL '5 minutes', event_time) AS time_bin, (sum(nt) OVER w)::BIGINT AS trip_segment, (sum(nr) OVER w)::BIGINT AS run_id FROM (
      SELECT *, CASE WHEN nt = 1 OR link_key <> pl THEN 1 ELSE 0 END AS nr FROM (
        SELECT *, CASE WHEN link_key IS NULL OR pl IS NULL OR epoch_us(event_time) - epoch_us(pt) > 120000000 THEN 1 ELSE 0 END AS nt FROM (
          SELECT *, lag(link_key) OVER v AS pl, lag(event_time) OVER v AS pt FROM obs WINDOW v AS (PARTITION BY journey_id ORDER BY event_time NULLS LAST, obs_id))))
      WINDOW w AS (PARTITION BY journey_id ORDER BY event_time NULLS LAST, obs_id ROWS UNBOUNDED PRECEDING)""",
    "stats5": _stats(_BIN, "links", True),
    "statsh": _stats(_ALL, "links", False),
    "statsc": _stats(_BIN, "corr", True),
    "way5": _waypoints(_BIN, "stats5"),
    "wayh": _waypoints(_ALL, "statsh"),
    "wayc": _waypoints(_BIN, "statsc"),
    "entries": "SELECT journey_id, trip_segment, run_id, link_key, min(event_time) AS entry_time FROM spine WHERE link_key IS NOT NULL AND event_time IS NOT NULL GROUP BY ALL",
    "cross": _crossings("links"),
    "crossc": _crossings("corr"),
    "tra5": _travel(_BIN, "cross"),
    "trah": _travel(_ALL, "cross"),
    "trac": _travel(_BIN, "crossc"),
    "moe5": f"SELECT link_key, time_bin, {_MEASURES} FROM way5 LEFT JOIN tra5 USING (link_key, time_bin)",
    "trans": "SELECT from_link, link_key AS to_link, count(*) AS support FROM (SELECT *, lag(link_key) OVER w AS from_link, epoch_us(event_time) - epoch_us(lag(event_time) OVER w) AS gap FROM obs WINDOW w AS (PARTITION BY journey_id ORDER BY event_time NULLS LAST, obs_id)) WHERE gap <= 120000000 AND from_link <> link_key GROUP BY ALL",
    "totals": "SELECT from_link AS link_key, sum(support)::BIGINT AS outgoing_total FROM trans GROUP BY ALL",
    "startl": "SELECT * FROM totals WHERE link_key IN (SELECT link_key FROM net) ORDER BY outgoing_total DESC, link_key LIMIT 1",
    "pairs": f"SELECT a.link_key, b.link_key AS next_link, b.net_id, coalesce(t.support, 0) AS support, (array_to_string(string_split(a.link_key, '_')[1:2], '_') = array_to_string(string_split(b.link_key, '_')[1:2], '_'))::INT AS same_family, coalesce({_TURN.format('a.heading', 'b.heading')}, 999.0) AS turn, coalesce(b.to_node_id = a.from_node_id, false) AS back FROM net a JOIN net b ON a.to_node_id = b.from_node_id LEFT JOIN trans t ON t.from_link = a.link_key AND t.to_link = b.link_key",
    "succ": "SELECT link_key, is_first, next_link, support, CASE WHEN support > 0 THEN 'topology_cv_transition' WHEN same_family = 1 THEN 'topology_same_family' ELSE 'topology_heading' END AS selection_method FROM (SELECT *, row_number() OVER (PARTITION BY link_key, is_first ORDER BY support DESC, same_family DESC, turn, net_id) AS place FROM (SELECT *, true AS is_first FROM pairs UNION ALL SELECT *, false FROM pairs WHERE NOT back)) WHERE place = 1",
    "walk": "SELECT 1 AS corridor_order, link_key, outgoing_total AS transition_support, 'start_highest_transition_support' AS selection_method, [link_key] AS path FROM startl UNION ALL SELECT corridor_order + 1, s.next_link, s.support, s.selection_method, list_append(path, s.next_link) FROM walk w JOIN succ s ON s.link_key = w.link_key AND s.is_first = (corridor_order = 1) WHERE corridor_order < 40 AND NOT list_contains(path, s.next_link)",
    "walks": "SELECT link_key AS start_link, 1 AS corridor_order, link_key, coalesce(outgoing_total, 0) AS transition_support, 'start_highest_transition_support' AS selection_method, [link_key] AS path FROM net LEFT JOIN totals USING (link_key) UNION ALL SELECT start_link, corridor_order + 1, s.next_link, s.support, s.selection_method, list_append(path, s.next_link) FROM walks w JOIN succ s ON s.link_key = w.link_key AND s.is_first = (corridor_order = 1) WHERE corridor_order < 40 AND NOT list_contains(path, s.next_link)",
    "lines": _LINES,
    "segl": "SELECT seg.*, parts FROM seg JOIN (SELECT k, count(DISTINCT part) AS parts FROM segp GROUP BY k) ON k = LinkID",
    "corr": """SELECT corridor_order, link_key, transition_support, selection_method, length AS link_length_ft, sum(length) OVER w - length AS distance_start_ft, sum(length) OVER w AS distance_end_ft,
      lag(to_node_id) OVER w = from_node_id AS topology_connected_from_previous, sqrt((lag(qx) OVER w - px) ** 2 + (lag(qy) OVER w - py) ** 2) AS geometry_connection_gap_ft, x1, y1, x2, y2, dx, dy
      FROM walk JOIN net USING (link_key) JOIN lines ON lk = link_key WINDOW w AS (ORDER BY corridor_order)""",
    "cand": f"""SELECT link_key, segment_id, limit_mph, min(sqrt((mx - (px + t * (qx - px))) ** 2 + (my - (py + t * (qy - py))) ** 2)) AS distance, turn FROM (SELECT *, {_RATIO} AS t FROM (
      SELECT l.lk AS link_key, l.mx, l.my, s.LinkID AS segment_id, s.SpeedLimit AS limit_mph, {_TURN.format('l.lh', 's.Heading')} AS turn, p.px, p.py, p.qx, p.qy
      FROM lines l JOIN seg s ON {_GID.format('l.lg')} = {_GID.format('s.GID')} JOIN segp p ON p.k = s.LinkID)) GROUP BY link_key, segment_id, limit_mph, turn""",
    "speed": f"""SELECT l.lk AS link_key, CASE WHEN given THEN limit_mph END AS posted_speed_limit_mph, CASE WHEN given THEN segment_id END AS txdot_link_id, {_GID.format('l.lg')} AS txdot_gid,
      CASE WHEN given THEN distance END AS txdot_match_distance_ft, CASE WHEN given THEN turn END AS txdot_heading_difference_deg, coalesce(n, 0) AS txdot_candidate_count, coalesce(nu, 0) AS txdot_valid_speed_candidate_count,
      CASE WHEN NOT coalesce(usable, false) THEN 'no_valid_speed_candidate' WHEN l.x1 IS NULL THEN 'missing_osm_geometry' WHEN near THEN 'matched' ELSE 'outside_threshold' END AS speed_match_status
      FROM (SELECT l.*, b.*, coalesce(usable, false) AND l.x1 IS NOT NULL AS given FROM lines l LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY link_key ORDER BY usable DESC, near DESC, distance NULLS LAST, CASE WHEN near THEN turn END NULLS LAST, segment_id) AS place, count(*) OVER p AS n, count(*) FILTER (usable) OVER p AS nu
        FROM (SELECT *, coalesce(limit_mph > 0, false) AS usable, coalesce(distance <= 100 AND coalesce(turn <= 35, true), false) AS near FROM cand) WINDOW p AS (PARTITION BY link_key)) b ON b.link_key = l.lk AND place = 1) l""",
    "cmoe": f"""SELECT corridor_order, link_key, time_bin, distance_start_ft, distance_end_ft, link_length_ft, posted_speed_limit_mph, avg_speed_mph,
      CASE WHEN posted_speed_limit_mph > 0 THEN (posted_speed_limit_mph - avg_speed_mph) / posted_speed_limit_mph * 100.0 END AS speed_reduction_pct, {_MEASURES}
      FROM (SELECT *, total_speed / waypoint_count AS avg_speed_mph FROM wayc) LEFT JOIN trac USING (link_key, time_bin) LEFT JOIN corr USING (link_key) LEFT JOIN speed USING (link_key)""",
    "top": "SELECT link_key, sum(waypoint_count)::BIGINT AS total_waypoints FROM moe5 GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 30",
    "rank": "SELECT row_number() OVER (ORDER BY total_waypoints DESC, link_key) AS rank, link_key FROM top",
    "ctab": """SELECT c.corridor_order, link_key, n.from_node_id, n.to_node_id, n.Matched_GID, s.txdot_gid, n.heading, c.transition_support, c.selection_method, c.link_length_ft, c.distance_start_ft, c.distance_end_ft,
      CASE WHEN c.corridor_order > 1 THEN c.topology_connected_from_previous END AS topology_connected_from_previous, c.geometry_connection_gap_ft, s.posted_speed_limit_mph, s.txdot_link_id, s.txdot_match_distance_ft,
      s.txdot_heading_difference_deg, s.txdot_candidate_count, s.txdot_valid_speed_candidate_count, s.speed_match_status, n.name, n.geometry FROM corr c JOIN net n USING (link_key) LEFT JOIN speed s USING (link_key)""",
    "heat": " UNION ALL ".join(
        f"SELECT '{m}' AS metric, rank, link_key, time_bin, strftime(time_bin, '%H:%M') AS label, CAST({m} AS DOUBLE) AS value FROM rank CROSS JOIN (SELECT DISTINCT time_bin FROM moe5 JOIN rank USING (link_key) WHERE {m} IS NOT NULL) LEFT JOIN moe5 USING (link_key, time_bin)"
        for m in HEATMAP_METRICS
    ),
    "steps": "SELECT coalesce(median(gap) / 1000000.0, 300.0) AS step_s FROM (SELECT epoch_us(time_bin) - epoch_us(lag(time_bin) OVER (ORDER BY time_bin)) AS gap FROM (SELECT DISTINCT time_bin FROM cmoe))",
    "summ": """SELECT link_key, avg(avg_speed_mph) AS mean_avg_speed_mph, avg(speed_reduction_pct) AS mean_speed_reduction_pct, max(speed_reduction_pct) AS max_speed_reduction_pct,
      avg(avg_travel_time_s) AS mean_avg_travel_time_s, sum(waypoint_count)::BIGINT AS total_waypoints, avg(slow_movement_pct) AS mean_slow_movement_pct, avg(DSH) AS "mean_DSH", coalesce(sum(complete_traversal_count), 0)::BIGINT AS total_complete_traversals FROM cmoe GROUP BY link_key""",
}

# The same steps over observations of which a third belong to one journey.
_HOT = {"obs": "hobs", "spine": "hspine", "stats5": "hstats5", "statsh": "hstatsh", "way5": "hway5", "wayh": "hwayh", "entries": "hentries", "cross": "hcross", "tra5": "htra5", "trah": "htrah", "moe5": "hmoe5", "trans": "htrans"}
STEPS |= {new: HOT_OBSERVATIONS_SQL if old == "obs" else re.sub(r"(FROM|JOIN) (\w+)", lambda x: f"{x[1]} {_HOT.get(x[2], x[2])}", STEPS[old]) for old, new in _HOT.items()}

_URL = "'https://www.google.com/maps/search/?api=1&query=' || {0} || ',' || {1}"
_POINTS = ", ".join(
    f"round({y}, 9) AS {n}_lat, round({x}, 9) AS {n}_lon, coalesce({_URL.format(f'round({y}, 9)', f'round({x}, 9)')}, '') AS {n}_google_maps_url"
    for n, x, y in (("start", "x1", "y1"), ("mid", "dx", "dy"), ("end", "x2", "y2"))
)
_LABELS = ", ".join(f"round(max(value) FILTER (time_bin = '2025-09-20 {19 + k // 12}:{k % 12 * 5:02}'), 9) AS \"2025-09-20 {19 + k // 12}:{k % 12 * 5:02}\"" for k in range(15))
_WAY = "waypoint_count, journey_count, total_speed, slow_movement_count, slow_speed_sum"

FINAL = {
    "trip_segments": "SELECT obs_id, journey_id, event_time, link_key, trip_segment, run_id FROM spine",
    "link_runs": "SELECT journey_id, trip_segment, run_id, link_key, count(*) AS points, min(event_time) AS first_time, max(event_time) AS last_time FROM spine WHERE link_key IS NOT NULL GROUP BY ALL",
    "waypoint_5min": f"SELECT link_key, time_bin, {_WAY} FROM way5",
    "waypoint_hourly": f"SELECT link_key, {_WAY} FROM wayh",
    "dsh_runs_5min": "SELECT link_key, time_bin, journey_id, trip_segment, run_id, n, change_sum::DOUBLE / n AS trip_dsh FROM stats5",
    "dsh_5min": "SELECT link_key, time_bin, dsh_trip_count, dsh_total AS dsh_sum FROM way5",
    "dsh_hourly": "SELECT link_key, dsh_trip_count, dsh_total AS dsh_sum FROM wayh",
    "run_entries": "SELECT * FROM entries",
    "traversals": "SELECT * FROM cross_",
    "travel_time_5min": "SELECT * FROM tra5",
    "travel_time_hourly": "SELECT * FROM trah",
    "link_moe_5min": "SELECT * FROM moe5",
    "link_moe_hourly": f"SELECT link_key, {_MEASURES} FROM wayh LEFT JOIN trah USING (link_key)",
    "link_transitions": "SELECT * FROM trans",
    "outgoing_totals": "SELECT * FROM totals",
    "start_link": "SELECT * FROM startl",
    "next_link_choices": "SELECT * FROM succ",
    "corridor_walk": "SELECT corridor_order, link_key, transition_support, selection_method FROM walk",
    "corridor_walks": "SELECT start_link, corridor_order, link_key, transition_support, selection_method FROM walks",
    "corridor_walk_from": "SELECT corridor_order, link_key, transition_support, selection_method FROM walks WHERE start_link = 'W3_0_12'",
    "corridor_links": "SELECT * EXCLUDE (x1, y1, x2, y2, dx, dy) FROM corr",
    "corridor_length": "SELECT coalesce(sum(link_length_ft), 0.0) AS total_length_ft, count(*) AS links FROM corr",
    "network_scalars": f"SELECT link_key, {_GID.format('Matched_GID')} AS gid, array_to_string(string_split(link_key, '_')[1:2], '_') AS family, {_TURN.format('heading', '350.0')} AS turn FROM net",
    "network_geometry": "SELECT lk AS link_key, round(degrees, 9) AS degrees, round(metres, 6) AS metres, round(px, 6) AS start_x, round(py, 6) AS start_y, round(mx, 6) AS mid_x, round(my, 6) AS mid_y FROM lines",
    "speed_candidates": 'SELECT link_key, segment_id, limit_mph AS "limit", distance, turn FROM cand',
    "posted_speed": "SELECT * FROM speed",
    "posted_speed_by_cells": "SELECT * FROM speed",
    "corridor_moe_5min": "SELECT * FROM cmoe",
    "top_links": "SELECT * FROM top",
    "heatmap_grid": "SELECT * FROM heat",
    "heatmap_pivot": f"SELECT rank, link_key, {_LABELS} FROM heat WHERE metric = 'DSH' GROUP BY rank, link_key",
    "timespace_grid": " UNION ALL ".join(
        f"SELECT '{m}' AS metric, corridor_order, link_key, time_bin, distance_start_ft, distance_end_ft, CAST({'least(greatest(value, 0.0), 100.0)' if mode == 'percent_clip' else 'value'} AS DOUBLE) AS value FROM (SELECT DISTINCT corridor_order, link_key, distance_start_ft, distance_end_ft FROM cmoe) CROSS JOIN (SELECT DISTINCT time_bin FROM cmoe) LEFT JOIN (SELECT link_key, time_bin, {m} AS value FROM cmoe) USING (link_key, time_bin)"
        for m, mode in TIMESPACE_METRICS.items()
    ),
    "timespace_edges": "SELECT 'y' AS axis, (row_number() OVER (ORDER BY o))::INT - 1 AS place, value FROM (SELECT 0 AS o, arg_min(distance_start_ft, corridor_order) AS value FROM cmoe UNION ALL SELECT DISTINCT corridor_order, distance_end_ft FROM cmoe) UNION ALL "
    "SELECT 'x', (row_number() OVER (ORDER BY value))::INT - 1, value FROM (SELECT DISTINCT epoch_us(time_bin) / 1000000.0 AS value FROM cmoe UNION ALL SELECT max(epoch_us(time_bin)) / 1000000.0 + any_value(step_s) FROM cmoe CROSS JOIN steps)",
    "corridor_table": "SELECT * FROM ctab",
    "corridor_diagnostic": f"SELECT c.corridor_order, c.link_key, n.heading, n.heading AS heading_network, n.Matched_GID AS \"Matched_GID_network\", n.length, s.posted_speed_limit_mph, {_POINTS}, m.* EXCLUDE (link_key) FROM corr c JOIN net n USING (link_key) LEFT JOIN speed s USING (link_key) LEFT JOIN summ m USING (link_key)",
    "corridor_layer": "SELECT n.net_id, n.link_key, n.from_node_id, n.heading, n.name, n.geometry, c.corridor_order, c.link_length_ft, c.Matched_GID AS \"Matched_GID_corridor\", c.name AS name_corridor, c.posted_speed_limit_mph FROM net n JOIN ctab c USING (link_key) JOIN lines l ON l.lk = n.link_key WHERE l.x1 IS NOT NULL",
    "geopackage_layers": f"SELECT 'corridor_links' AS layer, link_key AS key, 1 AS parts FROM corr WHERE x1 IS NOT NULL UNION ALL SELECT 'txdot_segments', LinkID::VARCHAR, parts FROM segl WHERE {_GID.format('GID')} IN (SELECT {_GID.format('Matched_GID')} FROM ctab)",
    "selected_link_moe_5min": "SELECT * FROM moe5 WHERE link_key IN (SELECT link_key FROM top ORDER BY total_waypoints DESC, link_key LIMIT 10)",
    "reduced_corridor_moe_5min": "SELECT * FROM cmoe",
    "stream_trip_segments": "SELECT obs_id, journey_id, event_time, link_key, trip_segment, run_id FROM spine",
    "stream_link_moe_5min": "SELECT * FROM moe5",
    "kept_link_moe_5min": "SELECT * FROM moe5",
    "speed_quantiles": "SELECT link_key, round(quantile_cont(speed_mph, 0.85), 9) AS speed_85 FROM obs WHERE speed_mph >= 0 AND link_key IS NOT NULL GROUP BY link_key",
    "bucketed_link_moe_5min": "SELECT * FROM moe5",
    "hot_trip_segments": "SELECT obs_id, journey_id, event_time, link_key, trip_segment, run_id FROM hspine",
    "hot_link_moe_5min": "SELECT * FROM hmoe5",
    "hot_link_moe_hourly": f"SELECT link_key, {_MEASURES} FROM hwayh LEFT JOIN htrah USING (link_key)",
    "hot_link_transitions": "SELECT * FROM htrans",
    "scan_observations": "SELECT journey_id, event_time AS capture_time, event_time AS local_time, speed_mph, link_key, (row_number() OVER (PARTITION BY journey_id ORDER BY obs_id))::INT AS place FROM obs",
    "scan_network": f"SELECT link_key, from_node_id::BIGINT AS from_node_id, to_node_id::BIGINT AS to_node_id, geometry, heading, length, {_GID.format('Matched_GID')} AS \"Matched_GID\", name, 'r' AS \"RDBD_TYPE\" FROM net WHERE link_key IN (SELECT link_key FROM links)",
    "scan_segments": f"SELECT LinkID, {_GID.format('GID')} AS \"GID_norm\", Geometry, Heading, SpeedLimit FROM seg WHERE {_GID.format('GID')} IN (SELECT {_GID.format('Matched_GID')} FROM net WHERE link_key IN (SELECT link_key FROM links))",
    "scan_link_moe": "SELECT * FROM moe5",
    "scan_corridor": "SELECT * REPLACE (txdot_link_id::VARCHAR AS txdot_link_id) FROM ctab",
    "scan_corridor_moe": "SELECT * FROM cmoe",
    "color_limits": f"SELECT metric, mode, 0.0::DOUBLE AS vmin, CASE WHEN count(value) = 0 THEN 1.0 WHEN mode LIKE 'percent%' THEN 100.0 WHEN coalesce(quantile_cont(value, 0.95) FILTER (value >= 0), max(value)) > 0 THEN coalesce(quantile_cont(value, 0.95) FILTER (value >= 0), max(value)) ELSE 1.0 END::DOUBLE AS vmax FROM ({_LIMITED}) GROUP BY metric, mode",
    "time_step": "SELECT * FROM steps",
    "corridor_summary": "SELECT * FROM summ",
    "worst_speed_reduction": "SELECT * FROM summ ORDER BY mean_speed_reduction_pct DESC NULLS LAST, link_key LIMIT 10",
    "worst_travel_time": "SELECT * FROM summ ORDER BY mean_avg_travel_time_s DESC NULLS LAST, link_key LIMIT 10",
    "map_points": f"SELECT corridor_order, link_key, distance_start_ft, distance_end_ft, {_POINTS} FROM corr",
    "stream_waypoints": "SELECT link_key, time_bin, waypoint_count, slow_movement_count, slow_speed_sum / nullif(total_speed, 0) * 100.0 AS slow_movement_pct FROM way5",
}


def _assemble(final: str) -> str:
    """The steps that a query needs, each after those that it reads."""
    order: list[str] = []

    def need(sql: str, own: str = "") -> None:
        for name in STEPS:
            if name != own and name not in order and re.search(rf"(FROM|JOIN) {name}\b", sql):
                need(STEPS[name], name)
                if name not in order:
                    order.append(name)

    need(final)
    return f"WITH RECURSIVE {', '.join(f'{n}{COLUMNS.get(n, str())} AS ({STEPS[n]})' for n in order)} {final}" if order else final


COLUMNS: dict[str, str] = {}
# "cross" is a key word
STEPS = {("cross_" if n == "cross" else n): re.sub(r"FROM cross\b", "FROM cross_", s) for n, s in STEPS.items()}


def _rounded(name: str) -> str:
    digits = ROUNDED.get(name)
    return f"SELECT * REPLACE ({', '.join(f'round({c}, {d}) AS {c}' for c, d in digits.items())}) FROM ({FINAL[name]})" if digits else FINAL[name]


ORACLE_SQL = {name: _assemble(_rounded(name)) for name in FINAL}
