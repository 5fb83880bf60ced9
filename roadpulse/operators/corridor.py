"""Link transitions, the greedy corridor walk over the road graph, and its geometry."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.config import CorridorConfig
from roadpulse.functions import geometry as g
from roadpulse.functions.scalars import elapsed_micros, heading_difference, link_family
from roadpulse.operators.pieces import HOT_ROWS, PIECE_S, cold_and_hot, in_pieces, with_previous
from roadpulse.operators.sequence import journey_order
from roadpulse.operators.speed import posted_speed
from roadpulse.sources.scratch import discard, few, stored

#: Choices that the driver takes at once; of more it looks up those on the way.
DRIVER_ROWS = 100_000


def link_transitions(observations: DataFrame, gap_s: float = 120.0) -> DataFrame:
    """(from_link, to_link, support): changes of link between observations at most ``gap_s`` apart, in the order of capture."""
    w = journey_order("capture_time")
    rows = observations.filter(F.col("journey_id").isNotNull()).select("obs_id", "journey_id", "capture_time", "link_key")
    rows = rows.withColumns({"from_link": F.lag("link_key").over(w), "gap": elapsed_micros(F.lag("capture_time").over(w), F.col("capture_time"))})
    rows = rows.filter((F.col("gap") <= F.lit(int(gap_s * 1_000_000))) & (F.col("from_link") != F.col("link_key")))
    return rows.groupBy("from_link", F.col("link_key").alias("to_link")).agg(F.count("*").alias("support"))


def split_link_transitions(observations: DataFrame, gap_s: float = 120.0, most: int = HOT_ROWS, piece_s: int = PIECE_S) -> DataFrame:
    """``link_transitions`` where a journey may hold any share of the observations."""
    cold, hot = cold_and_hot(observations, most)
    counts = link_transitions(cold, gap_s)
    if hot is None:
        return counts
    rows = with_previous(in_pieces(hot.select("obs_id", "journey_id", "capture_time", "link_key"), "capture_time", piece_s), "capture_time", "previous", ["capture_time", "link_key"])
    gap, before = elapsed_micros(F.col("previous.capture_time"), F.col("capture_time")), F.col("previous.link_key")
    rows = rows.filter((gap <= F.lit(int(gap_s * 1_000_000))) & (before != F.col("link_key")))
    own = rows.groupBy(before.alias("from_link"), F.col("link_key").alias("to_link")).agg(F.count("*").alias("support"))
    return counts.unionByName(own).groupBy("from_link", "to_link").agg(F.sum("support").alias("support"))


def outgoing_totals(transitions: DataFrame) -> DataFrame:
    return transitions.groupBy(F.col("from_link").alias("link_key")).agg(F.sum("support").alias("outgoing_total"))


def start_link(transitions: DataFrame, network: DataFrame) -> DataFrame:
    """The link of the network with most transitions out of it; of several the smallest key."""
    # totals may be broadcast if they are few, which a semi join doesn't allow; a key that the network names twice is the same row twice
    own = outgoing_totals(transitions).join(network.select("link_key"), "link_key")
    return own.orderBy(F.col("outgoing_total").desc(), "link_key").limit(1)


def next_link_choices(network: DataFrame, transitions: DataFrame, ahead: DataFrame | None = None) -> DataFrame:
    """The next link of every link: (link_key, is_first, next_link, support, selection_method); it is one of the links ``ahead``, if they are given.

    Candidates begin where the link ends. Except from the first link of a walk (is_first) none may turn straight back. Most
    observed transitions win, then the same family, then the smallest turn, then the network's order.
    """
    a = network.select("link_key", "from_node_id", "to_node_id", "heading")
    b = (network if ahead is None else ahead).select(F.col("link_key").alias("next_link"), F.col("from_node_id").alias("at"), F.col("to_node_id").alias("next_to"), F.col("heading").alias("next_heading"), "net_id")
    pairs = a.join(b, a["to_node_id"] == b["at"])
    counts = transitions.select(F.col("from_link").alias("link_key"), F.col("to_link").alias("next_link"), "support")
    pairs = pairs.join(counts, ["link_key", "next_link"], "left").select(
        "link_key", "next_link", "net_id",
        F.coalesce("support", F.lit(0)).cast("long").alias("support"),
        (link_family(F.col("link_key")) == link_family(F.col("next_link"))).cast("int").alias("same_family"),
        F.coalesce(heading_difference(F.col("heading"), F.col("next_heading")), F.lit(999.0)).alias("turn"),
        F.coalesce(F.col("next_to") == F.col("from_node_id"), F.lit(False)).alias("back"),
    )
    pairs = pairs.withColumn("is_first", F.explode(F.when(F.col("back"), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False)))))
    w = Window.partitionBy("link_key", "is_first").orderBy(F.col("support").desc(), F.col("same_family").desc(), "turn", "net_id")
    best = pairs.withColumn("place", F.row_number().over(w)).filter("place = 1")
    method = F.when(F.col("support") > 0, "topology_cv_transition").when(F.col("same_family") == 1, "topology_same_family").otherwise("topology_heading")
    return best.select("link_key", "is_first", "next_link", "support", method.alias("selection_method"))


_STEP = "struct<link_key:string,transition_support:bigint,selection_method:string>"
_START = "start_highest_transition_support"


def _step(link: str, support: Column, method: Column) -> Column:
    return F.struct(F.col(link).alias("link_key"), support.cast("long").alias("transition_support"), method.alias("selection_method"))


def walks(network: DataFrame, transitions: DataFrame, starts: DataFrame, config: CorridorConfig = CorridorConfig()) -> DataFrame:
    """(start_link, corridor_order, link_key, transition_support, selection_method): the walk from every ``link_key`` of ``starts``, as one plan.

    The next link depends on the current one alone (but for the first step), so paths are doubled: what follows a link within two steps, four,
    eight, by joining each path with that of its last link. A walk has at most ``max_links`` links, and stops at a dead end or
    at a link that it has visited. Starts that aren't in the network, or lead nowhere, are walks of one link.
    """
    choices = next_link_choices(network, transitions)
    step = F.array(_step("next_link", F.col("support"), F.col("selection_method")))
    ahead = choices.filter(~F.col("is_first")).select("link_key", F.col("next_link").alias("last"), step.alias("path"))
    steps = 1
    while steps < config.max_links - 2:
        beyond = ahead.select(F.col("link_key").alias("last"), F.col("last").alias("beyond"), F.col("path").alias("more"))
        joined = ahead.join(beyond, "last", "left")
        ahead = joined.select("link_key", F.col("beyond").alias("last"), F.concat("path", F.coalesce("more", F.array().cast(f"array<{_STEP}>"))).alias("path"))
        steps *= 2
    own = starts.select(F.col("link_key").alias("start_link")).dropna().distinct()
    totals = outgoing_totals(transitions).select(F.col("link_key").alias("start_link"), "outgoing_total")
    first = choices.filter("is_first").select(F.col("link_key").alias("start_link"), "next_link", step.alias("first"))
    rows = own.join(totals, "start_link", "left").join(first, "start_link", "left").join(ahead.select(F.col("link_key").alias("next_link"), "path"), "next_link", "left")
    none = F.array().cast(f"array<{_STEP}>")
    path = F.concat(F.array(_step("start_link", F.coalesce("outgoing_total", F.lit(0)), F.lit(_START))), F.coalesce("first", none), F.coalesce("path", none))
    rows = rows.select("start_link", F.slice(path, 1, config.max_links).alias("path"))
    keys = F.transform("path", lambda x: x["link_key"])
    rows = rows.withColumn("keys", keys)
    again = F.array_min(F.filter(F.transform("keys", lambda k, i: F.when(F.array_position("keys", k) <= i, i)), lambda i: i.isNotNull()))
    rows = rows.select("start_link", F.posexplode(F.slice("path", F.lit(1), F.coalesce(again, F.size("path")))).alias("place", "s"))
    return rows.select("start_link", (F.col("place") + 1).cast("int").alias("corridor_order"), "s.*")


def walk(network: DataFrame, transitions: DataFrame, config: CorridorConfig = CorridorConfig()) -> DataFrame:
    """(corridor_order, link_key, transition_support, selection_method) of at most ``max_links`` links, from the start or ``config.start_link``.

    Start and choices come to the driver in one job if they are few. Of more the network's nodes and headings are stored, and the choice of one link after
    the other is made among the links where it ends, at most ``max_links`` times: the network isn't shuffled, and neither the choices nor the paths
    (``walks``) of other links are made. Both leave a table of known size. Without a start (no transitions out of a link of the network) it is
    empty: no error.
    """
    spark = network.sparkSession
    # no link has more than two choices
    few_links = network.select("link_key").limit(DRIVER_ROWS // 2 + 1).count() <= DRIVER_ROWS // 2
    if not few_links:
        transitions = stored(transitions)
    if config.start_link is None:
        start = start_link(transitions, network)
    else:
        named = spark.createDataFrame([(config.start_link,)], "link_key string")
        start = named.join(outgoing_totals(transitions), "link_key", "left").select("link_key", F.coalesce("outgoing_total", F.lit(0)).alias("outgoing_total"))
    begun = start.select("link_key", F.lit(None).cast("boolean").alias("is_first"), F.lit(None).cast("string").alias("next_link"), F.col("outgoing_total").alias("support"), F.lit(_START).alias("selection_method"))
    if few_links:
        known = begun.unionByName(next_link_choices(network, transitions)).coalesce(1).toArrow().to_pylist()
        steps = {(r["link_key"], r["is_first"]): r for r in known}
        chosen = lambda link, first: steps.get((link, first))
    else:
        known = begun.toArrow().to_pylist()  # one row
        # sorted within files, so that few pages of each are read for the links that begin at a node
        kept = stored(network.select("link_key", "from_node_id", "to_node_id", "heading", "net_id").sortWithinPartitions("from_node_id"))

        def chosen(link: str, first: bool) -> dict | None:
            here = kept.filter(F.col("link_key") == link).toArrow()
            ends = [n for n in here.column("to_node_id").unique().to_pylist() if n is not None]
            own = spark.createDataFrame(here, kept.schema)
            choices = next_link_choices(own, transitions.filter(F.col("from_link") == link), kept.filter(F.col("from_node_id").isin(ends)))
            return next(iter(choices.filter(F.col("is_first") == first).toArrow().to_pylist()), None)

    rows: list[tuple] = []
    for link, support in [(r["link_key"], r["support"]) for r in known if r["is_first"] is None]:
        method, seen = _START, set()
        while link not in seen and len(rows) < config.max_links:
            seen.add(link)
            rows.append((len(rows) + 1, link, support, method))
            step = chosen(link, len(rows) == 1) if len(rows) < config.max_links else None
            if step is None:
                break
            link, support, method = step["next_link"], step["support"], step["selection_method"]
    if not few_links:
        discard(transitions, kept)
    # of known size, unlike a table made of Python rows
    columns = zip(*rows, strict=True) if rows else [()] * 4
    types = (pa.int32(), pa.string(), pa.int64(), pa.string())
    names = ["corridor_order", "link_key", "transition_support", "selection_method"]
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names))


def with_attributes(corridor: DataFrame, network: DataFrame, config: CorridorConfig = CorridorConfig()) -> DataFrame:
    """The corridor with its links' attributes, running distance, and how each link joins the one before.

    A corridor has at most ``max_links`` rows, so one ordered window is fine; Spark broadcasts it where it knows that (a local or stored table).
    """
    w = Window.orderBy("corridor_order")
    size = F.coalesce("length", F.lit(0.0))
    scale = 1.0 if config.distance_unit == "crs" else 1 / g.US_FOOT
    # the network is cut down to the corridor's links before anything else is done with it
    own = network.join(corridor.select("link_key"), "link_key", "left_semi")
    rows = corridor.join(own, "link_key", "left").withColumn("lines", g.parse_lines(F.col("geometry")))
    rows = rows.withColumns({
        "link_length_ft": F.col("length"),
        "distance_end_ft": F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "before_to": F.lag("to_node_id").over(w),
        "before_end": F.lag(g.last_point(F.col("lines"))).over(w),
        "begin": g.first_point(F.col("lines")),
        "place": F.row_number().over(w),
    })
    gap = g.distance(g.project_point(F.col("before_end")), g.project_point(F.col("begin"))) * scale
    return rows.withColumns({
        "distance_start_ft": F.col("distance_end_ft") - size,
        "topology_connected_from_previous": F.when(F.col("place") > 1, F.coalesce(F.col("before_to") == F.col("from_node_id"), F.lit(False))),
        "geometry_connection_gap_ft": F.when(F.col("before_end").isNotNull() & F.col("begin").isNotNull(), gap),
    }).drop("before_to", "before_end", "begin", "place", "lines")


def corridor_length(corridor: DataFrame) -> DataFrame:
    return corridor.agg(F.coalesce(F.sum("link_length_ft"), F.lit(0.0)).alias("total_length_ft"), F.count("*").alias("links"))


#: The corridor's table, in this order; columns that the network lacks are left out.
CORRIDOR_COLUMNS = [
    "corridor_order", "link_key", "from_node_id", "to_node_id", "Matched_GID", "txdot_gid",
    "heading", "transition_support", "selection_method", "link_length_ft", "distance_start_ft",
    "distance_end_ft", "topology_connected_from_previous", "geometry_connection_gap_ft",
    "posted_speed_limit_mph", "txdot_link_id", "txdot_match_distance_ft",
    "txdot_heading_difference_deg", "txdot_candidate_count", "txdot_valid_speed_candidate_count",
    "speed_match_status", "name", "facility_type", "RDBD_TYPE", "Functional Class", "geometry",
]


def build_corridor(observations: DataFrame, network: DataFrame, segments: DataFrame, config: CorridorConfig = CorridorConfig()) -> DataFrame:
    """The finished corridor: walk, attributes and posted speed, at most ``max_links`` rows, which are computed here and now."""
    # each step is a few rows, which the next ones name several times
    links = few(with_attributes(walk(network, link_transitions(observations, config.gap_s), config), network, config), config.max_links)
    links = links.join(posted_speed(links, segments, config), "link_key", "left")
    return few(links.select(*[F.col(f"`{c}`") for c in CORRIDOR_COLUMNS if c in links.columns]), config.max_links)
