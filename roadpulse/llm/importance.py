"""Quality classification by importance resampling with hashed n-gram models and Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_words, materialize, mix, share, small, split_words
from .ngrams import slot_counts

SLOTS = 10_000


def _slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of words, runs of punctuation, and pairs of neighbours among these."""
    apart = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), r"([^\p{L}\p{N}\s]+)", r" \1 ")
    words, offsets = split_words(apart)
    h = hash_words(words)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    same = np.flatnonzero(doc[1:] == doc[:-1])
    with np.errstate(over="ignore"):
        pairs = mix(h[same] * np.uint64(0x9E3779B97F4A7C15) + h[same + 1])
    return (np.concatenate([h, pairs]) % np.uint64(SLOTS)).astype(np.int64), np.concatenate([doc, doc[same]])


def fit(docs: DataFrame, text: str = "text", target: str = "target") -> np.ndarray:
    """log P(slot | target) - log P(slot | raw), from all n-grams of the rows with ``target`` true and of all rows.

    Every slot starts with a count of one, so an empty table, or one without target rows, gives finite ratios. A null ``target`` is
    false; null and empty texts add nothing; repeated rows count each time; long texts are read whole.
    """
    raw, chosen = slot_counts(docs, text, target, SLOTS, _slots) + 1.0
    return np.log(chosen / chosen.sum()) - np.log(raw / raw.sum())


def log_weights(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: id and the log importance weight, the sum over the n-grams of the whole text.

    A text without n-grams (null, empty, white space) tells nothing, so its weight is null. A null id is kept; repeated rows give
    repeated results, an empty table an empty one; other columns aren't read.
    """
    shared = share(docs.sparkSession, ratio)
    schema = docs.select(id_col, F.lit(None).cast("double").alias("log_weight")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared()
        for b in small(batches, 1):
            slot, doc = _slots(b.column(1))
            none = np.bincount(doc, minlength=b.num_rows) == 0
            weight = np.bincount(doc, ratio[slot], b.num_rows).astype(np.float64)  # integers if there is no n-gram at all
            # rounded: order of summation must not decide ties
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.round(weight, 9), mask=none)], [id_col, "log_weight"])

    return docs.select(id_col, text).mapInArrow(run, schema)


def kth_largest(df: DataFrame, key: str, k: int, bits: int = 12) -> int | None:
    """The k-th largest value of a long column, exactly: each pass counts at most 2**bits slices of the range left."""
    bounds = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(key).alias("n")).first()
    if not 0 < k <= bounds["n"]:
        return None
    lo, hi = bounds["lo"], bounds["hi"]
    while lo < hi:
        width = max(1, -(-(hi - lo + 1) >> bits))
        counts = df.filter(F.col(key).between(lo, hi)).groupBy(F.expr(f"(`{key}` - ({lo})) div {width}").alias("slice")).count().collect()
        for r in sorted(counts, key=lambda r: -r["slice"]):
            if r["count"] >= k:
                lo, hi = lo + r["slice"] * width, min(hi, lo + (r["slice"] + 1) * width - 1)
                break
            k -= r["count"]
    return lo


def gumbel_top_k(weighted: DataFrame, fraction: float, seed: int = 1, id_col: str = "doc_id") -> DataFrame:
    """``weighted`` with ``gumbel_key`` and ``kept``: the ``fraction`` of the rows with a weight that has the largest keys.

    Adding Gumbel noise to log weights and taking the top k draws k rows without replacement in
    proportion to the weights. The noise is a function of seed and id, so a rerun draws the same rows, and rows that share an id and
    a weight (repeated rows, null ids) stand or fall together. Rows whose key equals the last one taken are all kept, so ties can
    make it more than k. A row with a null weight has a null key and isn't kept. An empty table gives an empty one. No global
    sort: the smallest key taken is found by counting.
    """
    uniform = (F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    key = F.col("log_weight") - F.log(-F.log(uniform))
    table = materialize(weighted.withColumn("gumbel_key", key).withColumn("__rp_key", F.round(F.col("gumbel_key") * 1e9).cast("long")))
    k = round(fraction * table.filter(F.col("__rp_key").isNotNull()).count())
    least = kth_largest(table, "__rp_key", k)
    kept = F.lit(False) if least is None else F.coalesce(F.col("__rp_key") >= least, F.lit(False))
    return table.withColumn("kept", kept).drop("__rp_key")
