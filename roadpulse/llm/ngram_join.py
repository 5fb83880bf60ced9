"""Similarity join on word n-grams: banded MinHash candidates, Bayesian pruning, exact Jaccard."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, hash_words, materialize, mix, rolling_hash, small, split_words
from .components import local_roots, smallest_ids

WORDS = 5
THRESHOLD = 0.8
#: MinHash values. Bands of k of them miss a pair at similarity s with probability (1 - s**k)**(VALUES / k), which must be at most MISSED.
VALUES = 128
MISSED = 1e-6
#: A pair is dropped once the probability that it reaches the threshold is below this.
TOLERANCE = 1e-7
STEP = 16
#: Documents and bytes of n-grams of one side of a block that one task compares.
BLOCK = 1024
BLOCK_BYTES = 48 << 20

_RNG = np.random.default_rng(20)
_A = (_RNG.integers(0, 1 << 31, VALUES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)


def shingles(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Hashes of a text's word n-grams; a shorter text is one gram, a text without words none."""
    return rolling_hash(words, min(n, len(words))) if len(words) else np.zeros(0, np.uint64)


def signature(grams: np.ndarray) -> np.ndarray:
    """VALUES MinHash values of 16 bits."""
    x = (grams >> np.uint64(32)).astype(np.uint32)
    low = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        low = np.minimum(low, (x[at : at + 1024, None] * _A + _B).min(0))
    return (low * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16)


def band_width(threshold: float) -> int:
    """The most values that a band may have (4, 2 or 1) so that no pair at the threshold is missed; 4 at 0.8, with a miss in 5e-8."""
    for k in (4, 2, 1):
        if (1 - threshold**k) ** (VALUES // k) <= MISSED:
            return k
    raise ValueError(f"a threshold of {threshold} is too low for {VALUES} values")


def fewest_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """For n = STEP, 2 STEP, ... values compared: the fewest matches with which a pair goes on.

    With a uniform prior the similarity after m matches of n is Beta(m + 1, n - m + 1), and the probability that it is
    at least t equals that of at most m successes in n + 1 trials of probability t.
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        below = np.cumsum([comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k) for k in range(n + 1)])
        out.append(int(np.searchsorted(below, tolerance)))
    return np.array(out)


def text_key(text: Column) -> Column:
    """128-bit hash of a whole text, the ``text_key`` of ``similarity_join``; a null text is empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_key(text).alias("key"), text.alias("text"))


def _sketch(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, key of the exact text, number of n-grams, signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 2):
            words, at = split_words(b.column(2))
            h = hash_words(words)
            grams = [shingles(h[i:j], n) for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(g) for g in grams], pa.int64()), pa.array([signature(g).tobytes() for g in grams], pa.binary())], ["id", "key", "grams", "sig"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "id long, key binary, grams long, sig binary")


def _bands(classes: DataFrame, width: int) -> DataFrame:
    """(bucket, band, node, grams): one row for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(2).to_pylist()), f"u{2 * width}").reshape(b.num_rows, -1).astype(np.uint64)
            k = sig.shape[1]
            with np.errstate(over="ignore"):
                bucket = mix(mix(sig) + np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            node, grams = (np.repeat(b.column(i).to_numpy(), k) for i in (0, 1))
            band = np.tile(np.arange(k, dtype=np.int16), b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.reshape(-1).view(np.int64)), pa.array(band), pa.array(node), pa.array(grams)], ["bucket", "band", "node", "grams"])

    return classes.filter("grams > 0 AND rep IS NOT NULL").select("node", "grams", "sig").mapInArrow(run, "bucket long, band short, node long, grams long")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups of (bucket, i, j) from rows sorted by these, and the group of each row."""
    held: list[pa.RecordBatch] = []

    def cut(t: pa.Table) -> tuple[np.ndarray, int]:
        keys = [t.column(c).to_numpy() for c in ("bucket", "i", "j")]
        new = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], 0)]
        return np.cumsum(new) - 1, int(np.flatnonzero(new)[-1])

    for b in batches:
        for at in range(0, b.num_rows, 4096):
            held.append(b.slice(at, 4096))
            t = pa.Table.from_batches(held).combine_chunks()
            group, last = cut(t)
            if last:
                yield t.slice(0, last), group[:last]
            held = t.slice(last).to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, cut(t)[0]


def _likely_pairs(t: pa.Table, group: np.ndarray, fewest: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that first meet in this bucket and stay likely through all steps of the comparison."""
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(t.num_rows, VALUES)
    bands = sig.view(f"u{2 * width}")
    band, side = t.column("band").to_numpy(), t.column("side").to_numpy()
    same_block = t.column("i").to_numpy() == t.column("j").to_numpy()
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def test(i: np.ndarray, j: np.ndarray) -> None:
        equal = bands[i] == bands[j]
        ok = equal.argmax(1) == band[i]
        ok &= equal[np.arange(len(i)), band[i]]
        i, j = i[ok], j[ok]
        matches = np.zeros(len(i), np.int64)
        for k, least in enumerate(fewest):
            part = slice(k * STEP, (k + 1) * STEP)
            matches += (sig[i, part] == sig[j, part]).sum(1)
            ok = matches >= least
            i, j, matches = i[ok], j[ok], matches[ok]
        if len(i):
            found.append((i, j))

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for d in range(1, int(np.bincount(group).max(initial=1))):
        i = np.flatnonzero(group[d:] == group[:-d])
        i = i[same_block[i] | (side[i] != side[i + d])]
        waiting.append((i, i + d))
        n += len(i)
        if n > 50_000:
            test(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            waiting, n = [], 0
    if n:
        test(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _common(grams: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Size of the intersection for each pair of sorted sets."""
    docs, back = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = back[: len(i)], back[len(i) :]
    sets = [grams[d] for d in docs]
    if len(i) < 4 * len(sets):
        return np.array([np.isin(sets[a], sets[b], assume_unique=True).sum() for a, b in zip(i, j, strict=True)], np.int64)
    _, column, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = n[column] > 1  # grams of one set alone meet nothing
    row, column = row[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    width = max(256, (16 << 20) // (4 * len(sets)))
    for lo in range(0, int(column.max(initial=-1)) + 1, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        dense = np.zeros((len(sets), width), np.float32)
        dense[row[a:b], column[a:b] - lo] = 1
        total += dense @ dense.T
    return total[i, j].astype(np.int64)


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, n: int = WORDS, with_key: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, class_id, n_links, component_id, kept and, if ``with_key``, text_key.

    class_id: the smallest id with exactly this text. n_links: other rows whose sets of word n-grams
    have a Jaccard similarity of at least ``threshold`` (copies included). component_id: the smallest id reachable
    by links; kept: this row has it. Null and empty texts have no n-grams and link with nothing;
    a text shorter than n words is one n-gram. A null id links with copies of its text alone. Other columns aren't read; an empty table gives an empty one.

    Of rows with one id and different texts each has its own links; if their component's smallest id is theirs, only the one whose
    ``text_key`` comes first is kept. Long texts are read whole, in memory for their own n-grams alone.

    Copies are compared once. Buckets of any size are compared whole, in blocks of bounded size; blocks send
    on sums and a spanning forest, never their pairs.
    """
    sketch = materialize(_sketch(docs, id_col, text_col, n))
    classes = sketch.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.max("grams").alias("grams"), F.min("sig").alias("sig"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()))
    width = band_width(threshold)
    bands = _bands(classes, width)
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("grams") * 8 / BLOCK_BYTES)).cast("int")
    buckets = materialize(bands.groupBy("bucket").agg(F.count("*").alias("size"), blocks.alias("blocks")).filter("size > 1").select("bucket", "blocks"))
    members = bands.join(buckets, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("bucket", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("byte").alias("side"), "node")
    fewest = fewest_matches(threshold)
    place = ["bucket", "i", "j"]

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in _whole_groups(batches):
            i, j = _likely_pairs(t, group, fewest, width)
            rows = np.unique(np.concatenate([i, j]))
            if len(rows):
                yield from t.select(["bucket", "band", "i", "j", "side", "node"]).take(pa.array(rows)).to_batches()

    signed = members.join(classes.select("node", "sig"), "node").select(*members.columns, "sig")
    ahead = signed.repartition(*place).sortWithinPartitions(*place, "node").mapInArrow(likely, members.schema)
    ahead = materialize(ahead)
    wanted = ahead.select("node").distinct().join(classes.select("node", "rep", "key"), "node")
    full = ahead.join(classes.select("node", "n", "sig"), "node").join(_gram_sets(docs, wanted, id_col, text_col, n), "node").select(*members.columns, "n", "sig", "set")
    found = materialize(full.repartition(*place).sortWithinPartitions(*place, "node").mapInArrow(_verify(fewest, width, threshold), "node long, links long, root long"))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    component = smallest_ids(found, "node", "root", classes, "rep", "key")
    result = classes.select("key", "node", "rep", "n", "grams").join(linked, "node", "left").join(component, "node", "left")
    words = F.col("grams") > 0
    result = materialize(result.select(
        "key", "rep", words.alias("words"), F.when(words, F.col("n") - 1 + F.coalesce("links", F.lit(0))).otherwise(0).alias("n_links"), F.coalesce("first_rep", "rep").alias("component_id"),
        F.coalesce(F.col("first_key") == F.col("key"), F.lit(True)).alias("first"),
    ))
    discard(buckets, ahead, found, classes)
    out = sketch.select("id", "key").join(result, "key")
    component_id = F.when(F.col("words"), F.col("component_id")).otherwise(F.col("id"))
    kept = component_id.eqNullSafe(F.col("id")) & (F.col("first") | ~F.col("words"))
    return out.select(F.col("id").alias(id_col), F.col("rep").alias("class_id"), "n_links", component_id.alias("component_id"), kept.alias("kept"), *[F.col("key").alias("text_key")] * with_key)


def _gram_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(node, set): sorted distinct n-grams of the wanted classes, from a row with the class's smallest id and its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1):
            words, at = split_words(b.column(1))
            h = hash_words(words)
            sets = [np.unique(shingles(h[i:j], n)).tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["node", "set"])

    # A shuffle join at every size: the plan that is measured on little data is the one that runs on much.
    texts = _texts(docs, id_col, text_col).join(wanted.withColumnRenamed("rep", "id").hint("merge"), ["id", "key"])
    return texts.select("node", "text").dropDuplicates(["node"]).mapInArrow(run, "node long, set binary")


def _verify(fewest: np.ndarray, width: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, group in _whole_groups(batches):
            i, j = _likely_pairs(t, group, fewest, width)
            if not len(i):
                continue
            sets = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]
            sizes = np.array([len(s) for s in sets])
            order = np.argsort(group[i], kind="stable")
            i, j = i[order], j[order]
            edges = np.flatnonzero(np.r_[True, group[i][1:] != group[i][:-1], True])
            both = np.concatenate([_common(sets, i[a:b], j[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)])
            hit = both >= threshold * (sizes[i] + sizes[j] - both) - 1e-9
            i, j = i[hit], j[hit]
            node, n = t.column("node").to_numpy(), t.column("n").to_numpy()
            nodes, back = np.unique(np.concatenate([node[i], node[j]]), return_inverse=True)
            a, b = back[: len(i)], back[len(i) :]
            links = np.bincount(a, n[j], len(nodes)) + np.bincount(b, n[i], len(nodes))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links.astype(np.int64)), pa.array(nodes[local_roots(a, b, len(nodes))])], ["node", "links", "root"])

    return run
