"""Toxicity by class-conditional Kneser-Ney models over words and their stems.

Two models, one of toxic and one of ordinary text, give each word a probability. Each discounts its own counts of words and gives what
it took to its model of stems (the first STEM letters), and what that takes to one model of the stems of both classes; within a
stem both classes share the counts of its words. So a word or stem that is too rare to tell gets nearly the same
probability from both, and no ratio exceeds what the sizes of the classes allow. A discount takes at least a constant, and all that
the other class's rate would explain so many times over: a class that by chance holds more of one language or topic doesn't shift
the ratio of every common word then. Both are chosen from a grid by the labelled rows that are kept out of the counts. As in Kneser-Ney's counts of contexts, a word counts once for each text that has it, so that
a text that repeats itself is no evidence. A document's score compares the two log-likelihoods divided by the number of
words, through a logistic calibration on labelled rows kept out of the counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, hash_words, materialize, share, small, split_words, text_bytes

STEM = 4
#: Taken from each count that both classes share.
DISCOUNT = 0.75
#: The grid: what is taken from each count of a class at least, and how many times the other class's rate (with one more occurrence there than
#: were seen) is taken where that is more.
CLASS_DISCOUNTS = (0.75, 3.0)
EXPLAINED = (1.0, 4.0, 8.0, 16.0)
#: Labelled rows, and bytes of their texts, that the model is fitted on, at most (in expectation; rows are chosen by a hash of the id).
MAX_TRAINING_ROWS = 24_000
MAX_TRAINING_BYTES = 64 << 20
#: Share of them that calibrates the score instead.
CALIBRATION = 0.25


def plain_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case runs of letters and digits, with offsets by text."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    return split_words(pc.replace_substring_regex(texts, r"[^\p{L}\p{N}]+", " "))


@dataclass
class Model:
    """log P(word | toxic) - log P(word | ordinary): of words and of stems of which a class keeps something, by sorted hashes, and of all ``others``."""

    words: tuple[np.ndarray, np.ndarray]
    stems: tuple[np.ndarray, np.ndarray]
    others: float
    weights: np.ndarray

    def ratios(self, words: pa.Array) -> np.ndarray:
        own = _look_up(self.words, hash_words(words), np.nan)
        return np.where(np.isnan(own), _look_up(self.stems, _stems(words), self.others), own)


def _stems(words: pa.Array) -> np.ndarray:
    return hash_words(pc.utf8_slice_codeunits(words, 0, STEM))


def _coded(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, and the place of each word among them."""
    coded = words.dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _look_up(table: tuple[np.ndarray, np.ndarray], h: np.ndarray, missing: float) -> np.ndarray:
    keys, values = table
    if not len(keys):
        return np.full(len(h), missing)
    i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[i] == h, values[i], missing)


def _class_words(rows: DataFrame, text: str, label: str) -> DataFrame:
    """(word, stem, toxic, ordinary): hashes of a word and its stem, and in how many toxic and ordinary rows the word is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            words, offsets = plain_words(b.column(0))
            if not len(words):
                continue
            toxic = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            known, word = _coded(words)
            once = np.unique(np.repeat(np.arange(b.num_rows), np.diff(offsets)) * len(known) + word)
            n = [np.bincount((once % len(known))[m[once // len(known)]], minlength=len(known)).astype(np.int64) for m in (toxic, ~toxic)]
            yield pa.RecordBatch.from_arrays([*[pa.array(x.view(np.int64)) for x in (hash_words(known), _stems(known))], *map(pa.array, n)], ["word", "stem", "toxic", "ordinary"])

    out = rows.select(text, label).mapInArrow(count, "word long, stem long, toxic long, ordinary long")
    return out.groupBy("word", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _by_hash(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    return keys[order], values[order]


def _keep(counts: DataFrame, least: float, explained: float) -> DataFrame:
    """``counts`` with what the toxic and the ordinary class keep of them (k0, k1), as shares of all counts of the class (n0, n1)."""
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("toxic", "n0"), ("ordinary", "n1"))])

    def kept(own: str, other: str, n: str, m: str) -> Column:
        rate = (F.col(other) + 1) / (F.col(m) + 1)
        return F.greatest(F.lit(0.0), F.col(own) - F.greatest(F.lit(least), explained * F.col(n) * rate)) / F.greatest(F.col(n), F.lit(1))

    return counts.crossJoin(F.broadcast(total)).withColumns({"k0": kept("toxic", "ordinary", "n0", "n1"), "k1": kept("ordinary", "toxic", "n1", "n0")})  # one row


def _model(words: DataFrame, least: float, explained: float) -> Model:
    """From the counts of all words; only words and stems of which a class keeps something reach the driver."""

    def down(kept: DataFrame) -> list[float]:
        """What each class gives to the model below."""
        r = kept.agg(F.sum("k0").alias("k0"), F.sum("k1").alias("k1")).first()
        return [max(1 - (r[k] or 0), 1e-9) for k in ("k0", "k1")]

    n, total = F.col("toxic") + F.col("ordinary"), F.col("n0") + F.col("n1")
    stems = words.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    kept_stems, words = materialize(_keep(stems, least, explained)), materialize(_keep(words, least, explained))
    # of a stem: kept by the class, the rest from the counts of both; what their discount takes is dealt to all stems alike
    rest = down(kept_stems)
    spread = (kept_stems.count() or 1, kept_stems.agg(F.sum(F.least(n, F.lit(DISCOUNT))).alias("n")).first()["n"] or 0.0)
    both = (F.greatest(n - DISCOUNT, F.lit(0.0)) + spread[1] / spread[0]) / F.greatest(total, F.lit(1))
    stems = kept_stems.withColumns({f"s{c}": F.col(f"k{c}") + rest[c] * both for c in (0, 1)})
    # of a word: kept by the class, the rest by its stem and the counts of both within it
    mass = down(words)
    above = stems.select("stem", "s0", "s1", n.alias("all"))
    some = words.filter("k0 > 0 OR k1 > 0").join(above, "stem").withColumns({f"w{c}": F.col(f"k{c}") + mass[c] * F.col(f"s{c}") * n / F.col("all") for c in (0, 1)})
    base = float(np.log(mass[0]) - np.log(mass[1]))
    own = some.select("word", (F.log("w0") - F.log("w1")).alias("ratio")).toArrow()
    first = stems.filter("k0 > 0 OR k1 > 0").select("stem", (F.log("s0") - F.log("s1") + base).alias("ratio")).toArrow()
    table = lambda t: _by_hash(t.column(0).to_numpy(), t.column(1).to_numpy())
    model = Model(table(own), table(first), base + float(np.log(rest[0]) - np.log(rest[1])), np.array([-2.0, 0.0]))
    discard(words, kept_stems)
    return model


def _ratios(model: Model, texts: pa.Array) -> np.ndarray:
    """For each text the log-likelihood ratio of its words, divided by their number; 0 without words."""
    words, offsets = plain_words(texts)
    n = np.diff(offsets)
    if not len(words):
        return np.zeros(len(n))
    known, word = _coded(words)
    return np.bincount(np.repeat(np.arange(len(n)), n), model.ratios(known)[word], len(n)) / np.maximum(n, 1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method for logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _score_with(rows: DataFrame, id_col: str, text: str, model: Model) -> DataFrame:
    shared = share(rows.sparkSession, model)
    schema = rows.select(id_col, F.lit(0.0).alias("log_ratio")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for b in small(batches, 1):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_ratios(model, b.column(1)))], [id_col, "log_ratio"])

    return rows.select(id_col, text).mapInArrow(score, schema)


def _draw(seed: str, id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1_000_000)) / 1e6


def drawn(labels: DataFrame, id_col: str = "doc_id", max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """The labels that ``fit`` would draw: about ``max_rows`` rows whatever the size of ``labels``, so that they may be broadcast."""
    n = labels.count()
    return labels.filter(_draw("row", id_col) < F.lit(min(1.0, max_rows / max(n, 1))))


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = MAX_TRAINING_ROWS, max_bytes: int = MAX_TRAINING_BYTES
) -> Model:
    """Fit on rows with ``label`` 1 or 0 (others are left out); on a sample of about ``max_rows`` rows and ``max_bytes`` of text if there are more.

    The sample bounds all that reaches the driver: the words and stems that tell the classes apart and a few thousand rows kept out of
    the counts, which choose from the grid (by the loss of their calibrated scores) and calibrate. Texts of any length are taken whole. Rows are drawn whole, by id: repeated rows and those with a null id stand or fall together, and
    repeated rows count each time. Null and empty texts add nothing. With no labelled rows at all, an empty table included, every
    score is the same. Other columns aren't read.
    """
    rows = labelled.filter(F.col(label).isin(0, 1)).select(id_col, text, (F.col(label) == 1).alias(label))
    n = rows.count()
    draw = lambda seed: _draw(seed, id_col)
    sample = materialize(rows.filter(draw("row") < F.lit(min(1.0, max_rows / max(n, 1)))))
    size = sample.agg(F.sum(text_bytes(F.col(text))).alias("bytes")).first()["bytes"] or 0
    rows = sample.filter(draw("size") < F.lit(min(1.0, max_bytes / max(size, 1))))
    spared = draw("calibrate") < CALIBRATION
    counted = rows.filter(~spared)
    words = materialize(_class_words(counted, text, label))
    best, model = np.inf, None
    for least, explained in itertools.product(CLASS_DISCOUNTS, EXPLAINED):
        one = _model(words, least, explained)
        held = _score_with(rows.filter(spared).withColumn(label, F.struct(id_col, label)), label, text, one).select(F.col(f"{label}.{label}").alias("y"), "log_ratio").toPandas()
        two = held["y"].nunique() == 2
        y, x = held["y"].to_numpy(bool), held["log_ratio"].to_numpy()
        loss = 0.0
        if two:
            scale = max(float(x.std()), 1e-9)
            one.weights = _logistic(np.c_[np.ones(len(x)), x / scale], y.astype(float)) / [1.0, scale]
            loss = float(np.logaddexp(0, np.where(y, -1, 1) * (one.weights[0] + one.weights[1] * x)).mean())
        if loss < best:
            best, model = loss, one
        if not two:
            break
    if not two and n and (row := rows.first()) is not None:
        model.weights = np.array([6.0 if row[label] else -6.0, 0.0])
    discard(sample, words)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per row: id, ``score`` (0 to 1), ``predicted`` and the length-normalised log-likelihood ratio.

    Null and empty texts get the score of a ratio of 0; repeated rows repeated scores; a null id is kept; an empty table gives an empty
    one. Long texts are scored whole, one at a time. Only the text is read.
    """
    w = [float(x) for x in model.weights]
    logit = F.lit(w[0]) + F.col("log_ratio") * w[1]
    value: Column = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit))))
    out = _score_with(docs, id_col, text, model).select(id_col, value.alias("score"), "log_ratio")
    return out.select(id_col, "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "log_ratio")
