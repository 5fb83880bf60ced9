"""Running a stream over tables that come one after the other, each by a query that starts again from the checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from roadpulse.sources.scratch import scratch_path
from roadpulse.streaming.journeys import STATE_STORE


def run_in_steps(spark: SparkSession, parts: Iterable[DataFrame], build: Callable[[DataFrame], DataFrame]) -> str:
    """Where the rows are that ``build`` makes of a stream over ``parts``, as Parquet files.

    Each part is added to the source and worked on to its end before the next one comes.
    """
    where = scratch_path(spark)
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    try:
        for k, v in STATE_STORE.items():
            spark.conf.set(k, v)
        for part in parts:
            part.write.mode("append").parquet(f"{where}/in")
            source = spark.readStream.schema(part.schema).parquet(f"{where}/in")
            sink = build(source).writeStream.format("parquet").option("path", f"{where}/out").option("checkpointLocation", f"{where}/checkpoint")
            sink.trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return f"{where}/out"
