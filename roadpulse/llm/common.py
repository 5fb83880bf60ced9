"""Helpers shared by the corpus operators: scratch tables, column naming and vectorised word hashing."""

from __future__ import annotations

import pickle
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of characters other than ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]"

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """This application's part of the folder that all machines share: ``spark.checkpoint.dir``.

    Where it is unset a local session (tests) takes a temporary folder; a cluster has no such folder, so there that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = f"file://{tempfile.gettempdir()}/roadpulse-scratch"
    return f"{shared.rstrip('/')}/roadpulse/{spark.sparkContext.applicationId}"


class _CleanUp:
    """Lets Spark delete a job's shuffle files when its table is written, as nothing reads them then; jobs may overlap."""

    lock = threading.Lock()
    open = 0
    before: str | None = None

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self) -> None:
        with _CleanUp.lock:
            if not _CleanUp.open:
                _CleanUp.before = self.conf.get(_CLEAN_UP, None)
                self.conf.set(_CLEAN_UP, "true")
            _CleanUp.open += 1

    def __exit__(self, *_: object) -> None:
        with _CleanUp.lock:
            _CleanUp.open -= 1
            if not _CleanUp.open:
                self.conf.unset(_CLEAN_UP) if _CleanUp.before is None else self.conf.set(_CLEAN_UP, _CleanUp.before)


def materialize(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    with _CleanUp(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``materialize`` that nothing reads any more."""
    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            _delete(df.sparkSession, folder)


def discard_all(spark: SparkSession) -> None:
    """Delete every stored table of this application, those behind results that are still lazy included."""
    _delete(spark, scratch_dir(spark))


def share(spark: SparkSession, value: object) -> Callable[[], Any]:
    """A broadcast ``value`` that tasks get by a call. Classes of this package travel with it, so executors need no copy of the package."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def words_of(text: Column) -> Column:
    """Array of words; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def buckets_for(docs: DataFrame, text: str, bytes_per_bucket: int, least: int = 1) -> int:
    """Number of buckets so that each gets about ``bytes_per_bucket`` bytes of text; one cheap pass over the text."""
    total = docs.select(F.sum(text_bytes(F.col(text))).alias("n")).first()["n"] or 0
    return max(least, -(-total // bytes_per_bucket))


# ---- vectorised helpers used inside tasks -------------------------------------------------------


def small(batches: Iterable[pa.RecordBatch], column: int = 0, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, so that memory doesn't depend on the length of texts in a batch."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield b.slice(at, to - at)
            at = to


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch of texts in order, and offsets: words of text i are [off[i], off[i+1])."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))])
    kept = np.concatenate([[0], np.cumsum(real)])
    if not real.all():
        flat = flat.filter(pa.array(real))
    return flat, kept[ends]


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word; every distinct word of the batch is hashed once."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    digest = xxhash.xxh3_64_intdigest
    table = np.fromiter((digest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return table[coded.indices.to_numpy(zero_copy_only=False)]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, np.uint64(base))
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def rolling_hash(letters: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every run of ``width`` consecutive 64-bit letters, in linear time.

    A polynomial in an odd base modulo 2**64 over letters that are themselves hashes.
    """
    n = len(letters)
    if n < width:
        return np.zeros(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(letters * _powers(base, n - 1), out=prefix[1:])
        return mix((prefix[width:] - prefix[:-width]) * _powers(inverse, n - width))
