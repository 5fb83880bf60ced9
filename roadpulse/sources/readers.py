"""Readers of the input files and of the engine's own results: values that can't be typed become null, not errors."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.functions.scalars import normalize_gid, null_token, safe_double, safe_timestamp
from roadpulse.operators.corridor import CORRIDOR_COLUMNS
from roadpulse.operators.moe import CORRIDOR_MOE_COLUMNS, MOE_COLUMNS

OBSERVATIONS = ["journey_id", "capture_time", "local_time", "speed_mph", "link_key"]
NETWORK = ["link_key", "from_node_id", "to_node_id", "geometry", "heading", "length", "Matched_GID", "name", "facility_type", "RDBD_TYPE", "Functional Class"]
#: Other spellings of columns of the network.
ALSO = {"Matched_GID": "matched_gid", "RDBD_TYPE": "rdbd_type", "Functional Class": "functional_class"}
#: Types of the columns of results; the others are texts.
_WHOLE = {"corridor_order", "from_node_id", "to_node_id", "transition_support", "txdot_candidate_count", "txdot_valid_speed_candidate_count", "waypoint_count", "journey_count", "slow_movement_count", "dsh_trip_count", "complete_traversal_count"}
_TEXT = {"link_key", "Matched_GID", "txdot_gid", "txdot_link_id", "selection_method", "speed_match_status", "name", "facility_type", "RDBD_TYPE", "Functional Class", "geometry"}

#: Bits of a row's ordinal for its place in the file.
_PLACE = 44
#: Bytes of files' names that are broadcast.
_NAMES = 64 << 20
_HEAD = "^[a-z0-9]+:(//[^/]*)?"


def _ordered(df: DataFrame, place: Column) -> DataFrame:
    """``df`` with ``file_order``: by the files' names, then by ``place`` in the file."""
    # Spark writes the head of a path in several ways
    files = sorted({re.sub(_HEAD, "", f) for f in df.inputFiles()})
    # the names are all that is known of a file here; Spark holds them on the driver too
    named = df.select("*", F.regexp_replace("_metadata.file_path", _HEAD, "").alias("__path"), place.alias("__place"))
    if len(files) < 2:
        return named.withColumn("file_order", F.col("__place")).drop("__path", "__place")
    ranks = df.sparkSession.createDataFrame(pa.table([pa.array(range(len(files)), pa.int64()), pa.array(files, pa.string())], ["__rank", "__path"]))
    # no shuffle of the rows unless the names alone are too large to be sent to all machines
    both = named.join(F.broadcast(ranks) if sum(map(len, files)) < _NAMES else ranks, "__path", "left")
    return both.withColumn("file_order", F.shiftleft(F.coalesce("__rank", F.lit(len(files))), _PLACE) + F.col("__place")).drop("__path", "__rank", "__place")


def read_text_table(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """CSV files as text columns with missing-value tokens as nulls, and ``file_order``: rising in the order of the files' names and rows.

    ``lines``: values may hold line ends, so that each file is read by one task; geometry with doubled quotes on one line doesn't need it.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("inferSchema", False).option("multiLine", lines)
    df = reader.csv(path)
    # a row's number in its task, above where its part of the file begins: tasks hold fewer rows than bytes
    place = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return _ordered(df, place).select(*[null_token(F.col(f"`{c}`")).alias(c) for c in df.columns], "file_order")


def _number(df: DataFrame, column: str) -> Column:
    c = F.col(f"`{column}`")
    return safe_double(c) if dict(df.dtypes)[column] == "string" else F.when(~F.isnan(c.cast("double")), c.cast("double"))


def _whole(text: Column) -> Column:
    """A whole number of any 64 bits, also of a text such as '12.0'; others are null."""
    return F.coalesce(text.try_cast("long"), safe_double(text).try_cast("long"))


def _time(df: DataFrame, column: str, formats: tuple[str, ...]) -> Column:
    c = F.col(f"`{column}`")
    return safe_timestamp(c, *formats) if dict(df.dtypes)[column] == "string" else c.cast("timestamp_ntz")


def read_observations(spark: SparkSession, path: str, *formats: str, source: str | None = None) -> DataFrame:
    """Observations from CSV or Parquet (``source``; by the name's ending if none is given); ``obs_id`` numbers the rows in the order of the input.

    Typed columns of Parquet keep their types, so that filters on keys reach its scan; instants become times of the session's zone.
    """
    if (source or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")) == "parquet":
        df = spark.read.parquet(path)
        df = _ordered(df, F.col("_metadata.row_index")).select(*OBSERVATIONS, "file_order")
    else:
        df = read_text_table(spark, path)
    return df.select(
        F.col("file_order").alias("obs_id"), F.col("journey_id").cast("string").alias("journey_id"),
        _time(df, "capture_time", formats).alias("capture_time"), _time(df, "local_time", formats).alias("local_time"),
        _number(df, "speed_mph").alias("speed_mph"), F.col("link_key").cast("string").alias("link_key"),
    )


def _read_result(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A result that was written as CSV, with the types that it had; columns that it lacks are left out."""
    df = read_text_table(spark, path)

    def typed(c: str) -> Column:
        if c in _TEXT:
            return F.col(f"`{c}`")
        if c == "time_bin":
            return safe_timestamp(F.col(c))
        if c == "topology_connected_from_previous":
            return F.col(c).try_cast("boolean")
        return _whole(F.col(c)) if c in _WHOLE else safe_double(F.col(c))

    return df.select(*[typed(c).alias(c) for c in columns if c in df.columns])


def read_link_moe(spark: SparkSession, path: str) -> DataFrame:
    """The measures of links, by bin (with ``time_bin``) or by period."""
    return _read_result(spark, path, ["link_key", "time_bin", *MOE_COLUMNS])


def read_corridor(spark: SparkSession, path: str) -> DataFrame:
    return _read_result(spark, path, CORRIDOR_COLUMNS)


def read_corridor_moe(spark: SparkSession, path: str) -> DataFrame:
    return _read_result(spark, path, CORRIDOR_MOE_COLUMNS)


def read_links(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path).select("link_key").dropna().distinct()


def first_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key that isn't null."""
    w = Window.partitionBy(key).orderBy(order)
    return df.filter(F.col(key).isNotNull()).withColumn("__place", F.row_number().over(w)).filter("__place = 1").drop("__place")


def read_network(spark: SparkSession, path: str, links: DataFrame | None = None, lines: bool = False) -> DataFrame:
    """The road network, one row per link (the first in the files), with ``net_id`` in the files' order; with ``links`` only those of its ``link_key``.

    ``lines``: as of ``read_text_table``.
    """
    df = read_text_table(spark, path, lines)
    for name, other in ALSO.items():
        if name not in df.columns and other in df.columns:
            df = df.withColumnRenamed(other, name)
    df = df.select(*[F.col(f"`{c}`") for c in NETWORK], F.col("file_order").alias("net_id"))
    if links is not None:
        df = df.join(links.select("link_key").dropna().distinct(), "link_key", "left_semi")
    typed = {c: _whole(F.col(c)) for c in ("from_node_id", "to_node_id")} | {c: safe_double(F.col(c)) for c in ("heading", "length")}
    return first_of(df.withColumns(typed | {"Matched_GID": normalize_gid(F.col("Matched_GID"))}), "link_key", "net_id")


def read_segments(spark: SparkSession, path: str, gids: DataFrame | None = None, lines: bool = False) -> DataFrame:
    """Speed segments; with ``gids`` (a column Matched_GID) only those with one of these identifiers."""
    df = read_text_table(spark, path, lines)
    df = df.withColumns({"Heading": safe_double(F.col("Heading")), "SpeedLimit": safe_double(F.col("SpeedLimit")), "GID_norm": normalize_gid(F.col("GID"))})
    if gids is None:
        return df
    wanted = gids.select(normalize_gid(F.col("Matched_GID")).alias("GID_norm")).dropna().distinct()
    return df.join(wanted, "GID_norm", "left_semi")
