"""Observations stored by journey, so that trips, runs and measures need no shuffle by journey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.sources.scratch import scratch_path

#: Rows of a bucket, of some hundred bytes each.
BUCKET_ROWS = 2_000_000


def store_by_journey(observations: DataFrame, table: str, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """``observations`` as a table in buckets of journeys, each sorted by journey, time and row; rows without a journey are left out.

    Where ``buckets`` isn't given there is one for ``BUCKET_ROWS`` rows. All orders by journey (``with_segments``, ``link_transitions``, the measures)
    find their rows together. The files go to ``path`` (a new folder among the scratch tables if none is given), the table's name to the
    session's catalogue; a table of that name is replaced. A journey is in one bucket, whatever its size: see ``pieces`` for hot ones.
    """
    spark = observations.sparkSession
    rows = observations.filter(F.col("journey_id").isNotNull())
    n = buckets or max(1, -(-rows.count() // BUCKET_ROWS))
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")
    # each bucket is made by one task, so that it is one file
    writer = rows.repartition(n, "journey_id").write.bucketBy(n, "journey_id").sortBy("journey_id", "local_time", "obs_id")
    writer.option("path", path or scratch_path(spark)).mode("overwrite").saveAsTable(table)
    return spark.table(table)
