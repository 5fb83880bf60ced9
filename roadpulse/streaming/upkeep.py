"""Measures kept up to date: partial sums of each journey in each cell are stored by hour and increment, cells are made of them anew where they change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.moe import SUMS, final_measures

_BY = ["link_key", "time_bin", "journey_id"]


def _overwrite(df: DataFrame, path: str, *partitions: str) -> None:
    """Only the partitions that ``df`` has rows in are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def _partials(spark: SparkSession, store: str) -> DataFrame:
    sums = {"n": "long", "speed_sum": "decimal(38,10)", "speed_more": "double", "slow": "long", "slow_sum": "decimal(38,10)", "runs": "long", "dsh": "double", "crossed": "long", "travel": "long"}
    schema = f"link_key string, time_bin timestamp_ntz, journey_id string, {', '.join(f'{c} {sums[c]}' for c in SUMS)}, hour string, increment long"
    return spark.read.schema(schema).parquet(f"{store}/partials")


def add_increment(store: str, sums: DataFrame, increment: int) -> None:
    """Take in an increment and renew the cells of the hours that it touches; other hours are neither read nor written.

    ``sums`` has ``moe.SUMS`` by link, bin and journey, in any number of rows: of ``partial_sums`` over whole journeys, or records of a
    stream (``stream_records``), in which a journey may go on from one increment to the next. The rows of a cell's journeys are kept one by
    one, so that journeys are counted exactly. An increment with a number that is there replaces the old one, in the hours that
    it has rows in: the same increment given twice, or once more after a failure halfway, changes nothing.
    """
    spark = sums.sparkSession
    own = sums.groupBy(*_BY).agg(*[F.sum(c).cast("decimal(38,10)" if c in ("speed_sum", "slow_sum") else "double" if c in ("speed_more", "dsh") else "long").alias(c) for c in SUMS])
    own = own.withColumns({"hour": F.date_format("time_bin", "yyyy-MM-dd-HH"), "increment": F.lit(increment).cast("long")})
    _overwrite(own, f"{store}/partials", "hour", "increment")
    stored = _partials(spark, store)
    touched = stored.filter(F.col("increment") == increment).select("hour").distinct()
    cells = final_measures(stored.join(touched, "hour", "left_semi"), merge=True).drop("total_speed", "slow_speed_sum")
    _overwrite(cells.withColumn("hour", F.date_format("time_bin", "yyyy-MM-dd-HH")), f"{store}/cells", "hour")


def current_measures(spark: SparkSession, store: str) -> DataFrame:
    """The measures of all cells so far, as of ``link_moe``."""
    return spark.read.parquet(f"{store}/cells").drop("hour")
