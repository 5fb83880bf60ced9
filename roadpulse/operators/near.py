"""Posted speeds where one identifier has many links and many segments: nearest segments by a grid of cells with growing size.

All pairs of an identifier are never made. Counts of candidates need the identifier alone; the nearest segment of a link is looked for in the
cells around the link's middle, first in cells as large as the allowed distance, then, for links that have found none there, in cells twice as large, and so on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.config import CorridorConfig
from roadpulse.functions import geometry as g
from roadpulse.functions.scalars import heading_difference, normalize_gid
from roadpulse.operators.speed import link_lines, speed_rows
from roadpulse.sources.scratch import discard, stored

#: Beyond a cell's edges, as a share of its size: cut points are rounded.
_MARGIN = 1e-6


def _covered(pieces: DataFrame, size: float) -> DataFrame:
    """``pieces`` (straight, from a to b) once for each cell that they may touch; long ones are cut to the size of a cell first."""
    steps = F.greatest(F.ceil(F.col("length") / size), F.lit(1)).cast("int")
    cut = pieces.withColumn("steps", steps).withColumn("step", F.explode(F.sequence(F.lit(0), F.col("steps") - 1)))

    def cells(axis: str) -> Column:
        a, b = F.col(f"a.{axis}"), F.col(f"b.{axis}")
        from_, to = (a + (b - a) * (F.col("step") + k) / F.col("steps") for k in (0, 1))
        low, high = F.least(from_, to) / size - _MARGIN, F.greatest(from_, to) / size + _MARGIN
        return F.explode(F.sequence(F.floor(low).cast("long"), F.floor(high).cast("long")))

    return cut.withColumn("cx", cells("x")).withColumn("cy", cells("y")).drop("steps", "step", "length")


def _around(links: DataFrame, size: float) -> DataFrame:
    """``links`` once for each of the nine cells around their middle."""
    for axis, name in (("x", "cx"), ("y", "cy")):
        here = F.floor(F.col(f"middle.{axis}") / size).cast("long")
        links = links.withColumn(name, F.explode(F.array(here - 1, here, here + 1)))
    return links


def posted_speed_by_cells(corridor: DataFrame, segments: DataFrame, config: CorridorConfig = CorridorConfig()) -> DataFrame:
    """The rows of ``posted_speed``. Links and parsed segments are stored first, as several steps read them.

    A step finds every segment up to a cell's size away; a link is done once it has found one that near. The number of steps
    grows with the logarithm of the largest distance, and the pairs of a step with the links that are left. No side of a join is broadcast: files
    don't tell how many cells or links a table becomes, and the driver would have to hold them.
    """
    scale = 1.0 if config.distance_unit == "crs" else 1 / g.US_FOOT
    links = stored(link_lines(corridor).withColumn("middle", g.midpoint(F.col("line"))).withColumn("drawn", F.col("line").isNotNull()).drop("line"))
    wanted = links.select("gid").dropna().distinct()
    named = segments.withColumn("gid", normalize_gid(F.col("GID"))).join(wanted.hint("merge"), "gid", "left_semi")
    parts = named.select("gid", F.col("LinkID").alias("segment_id"), F.col("Heading").alias("segment_heading"), F.col("SpeedLimit").alias("limit"), g.parse_lines(F.col("Geometry")).alias("lines"))
    parts = stored(parts.filter(F.col("lines").isNotNull()).withColumn("lines", g.project(F.col("lines"))))
    counts = parts.groupBy("gid").agg(F.count("*").alias("n"), F.count_if(F.col("limit") > 0).alias("n_usable"))
    counted = links.join(counts.hint("merge"), "gid", "left").fillna(0, ["n", "n_usable"])
    pieces = stored(parts.filter("limit > 0").select("gid", "segment_id", "segment_heading", "limit", F.explode(g.segments(F.col("lines"))).alias("s")).select("gid", "segment_id", "segment_heading", "limit", "s.*"))
    todo = stored(counted.filter("drawn AND n_usable > 0").select("link_key", "gid", "link_heading", "middle"))
    size, used, found = config.max_distance / scale * (1 + _MARGIN), [pieces, todo], []
    while not todo.isEmpty():
        pairs = _around(todo, size).join(_covered(pieces, size).hint("merge"), ["gid", "cx", "cy"])
        away = g.point_piece_distance(F.col("middle"), F.col("a"), F.col("b")) * scale
        turn = heading_difference(F.col("link_heading"), F.col("segment_heading"))
        near = pairs.select("link_key", "segment_id", "limit", turn.alias("turn"), away.alias("away")).groupBy("link_key", "segment_id", "limit", "turn").agg(F.min("away").alias("distance"))
        fits = (F.col("distance") <= config.max_distance) & F.coalesce(F.col("turn") <= config.max_heading, F.lit(True))
        near = near.withColumn("near", fits).filter(F.col("distance") <= size * scale)
        order = Window.partitionBy("link_key").orderBy(F.col("near").desc(), "distance", F.when(F.col("near"), F.col("turn")).asc_nulls_last(), "segment_id")
        best = stored(near.withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place"))
        found.append(best)
        todo = stored(todo.join(best.select("link_key").hint("merge"), "link_key", "left_anti"))
        used.append(todo)
        size *= 2
    kinds = dict(parts.dtypes)
    none = f"link_key string, near boolean, limit {kinds['limit']}, segment_id {kinds['segment_id']}, distance double, turn double"
    rows = found[0] if found else links.sparkSession.createDataFrame([], none)
    for best in found[1:]:
        rows = rows.unionByName(best)
    out = counted.join(rows.hint("merge"), "link_key", "left").withColumn("usable", F.col("n_usable") > 0)
    discard(*used)
    return speed_rows(out)
