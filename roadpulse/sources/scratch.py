"""Tables that a job writes for itself, in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession) -> str:
    """A new path below ``spark.checkpoint.dir``; below a temporary folder only in a local session where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = f"file://{tempfile.gettempdir()}/roadpulse-scratch"
    return f"{shared.rstrip('/')}/roadpulse/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet and read back, so that plans which name it several times compute it once and survive lost executors."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame, most: int) -> DataFrame:
    """The rows of a table that has at most ``most``, computed here and now; Spark knows how small they are then."""
    # one partition: else Spark looks for the rows in one job after the other
    rows = df.limit(most + 1).coalesce(1).toArrow()
    if rows.num_rows > most:
        raise ValueError(f"more than {most} rows")
    return df.sparkSession.createDataFrame(rows, df.schema)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``stored`` that nothing reads any more."""
    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            _delete(df.sparkSession, folder)


def discard_all(spark: SparkSession) -> None:
    """Delete every scratch table of this application, those behind results that are still lazy included."""
    _delete(spark, scratch_path(spark).rpartition("/")[0])
