"""Packing token pieces into fixed windows by non-negative least squares over the length histogram."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, share

WINDOW = 2048
END_ID = 1
_SHIFT = 44  # bits of an item's rank beside its length

PIECES = "{id} long, start long, length long, ids_crc32 long, doc_tokens long"


# ---- tokens ------------------------------------------------------------------------------------


class Encoder:
    """Ids of a byte-level BPE vocabulary file in the format of the ``tokenizers`` library.

    Texts of Latin letters, digits and common punctuation go through ``tiktoken``, which reads the
    same vocabulary and is several times faster; all others, and those that hold the text of a
    special token, go through ``tokenizers`` itself. Tests hold both to the same ids.
    """

    def __init__(self, path: str):
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _byte_alphabet()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.odd = regex.compile("[^\\n\\t\\x20-\\x7e¡-ſ]" + "".join("|" + regex.escape(t) for t in special))

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            ids = []
        elif self.odd.search(text):
            ids = self.slow.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array([*ids, END_ID], "<u4")


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: bytes that print stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def token_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Every document's tokens cut at multiples of ``window``: one row per piece, with the CRC of its ids.

    A null or empty text is one piece that holds the end id alone. Repeated rows give repeated pieces. A text of any length is
    tokenized whole, in one task.
    ``vocabulary``: a path that executors can read (the file is installed with the library).
    """
    out = PIECES.format(id=f"`{id_col}`")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encode = Encoder(vocabulary)
        for batch in batches:
            doc, start, length, crc, total = [], [], [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py())
                for s in range(0, len(ids), window):
                    part = ids[s : s + window]
                    doc.append(d), start.append(s), length.append(len(part)), crc.append(zlib.crc32(part.tobytes())), total.append(len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)], [id_col, "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(cut, out)


# ---- the plan: which combinations of lengths, and how often ----------------------------------------


def combinations(window: int, present: np.ndarray, depth: int = 3) -> np.ndarray:
    """All multisets of at most ``depth`` (1 to 3) present lengths that fill the window exactly; rows padded with 0.

    Lengths are bounded by the window, so their number is too (about window**2 / 12 for depth 3).
    """
    here = np.zeros(window + 1, bool)
    here[present] = True
    rows = [np.array([[window, 0, 0]])] if here[window] else []
    a = present[present * 2 <= window]
    if depth >= 2 and len(a):
        b = window - a
        rows.append(np.stack([b, a, np.zeros_like(a)], 1)[here[b]])
    if depth >= 3:
        for small in present[present * 3 <= window]:
            mid = present[(present >= small) & (present * 2 <= window - small)]
            big = window - small - mid
            ok = here[big]
            if ok.any():
                rows.append(np.stack([big[ok], mid[ok], np.full(ok.sum(), small)], 1))
    return np.concatenate(rows).astype(np.int64) if rows else np.zeros((0, 3), np.int64)


def non_negative_least_squares(combos: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that makes ``sum(x[s] * uses[s, length])`` close to the histogram: accelerated projected gradient.

    The matrix is never built: its columns have at most three entries, which are the rows of ``combos``.
    """
    n = len(histogram)
    used = combos > 0
    scale = max(1.0, float(histogram.max(initial=1)))
    target = histogram / scale

    def times(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(combos[:, j], np.where(used[:, j], x, 0), n) for j in range(combos.shape[1]))

    def transposed(r: np.ndarray) -> np.ndarray:
        return sum(np.where(used[:, j], r[combos[:, j]], 0) for j in range(combos.shape[1]))

    v = np.ones(len(combos))
    for _ in range(20):  # the largest eigenvalue bounds the step
        w = transposed(times(v))
        v = w / max(np.linalg.norm(w), 1e-30)
    step = 1 / max(float(v @ transposed(times(v))) * 1.05, 1e-12)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0, y - step * transposed(times(y) - target))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = nxt + (t - 1) / t2 * (nxt - x), nxt, t2
    return x * scale


def packing_plan(histogram: dict[int, int], window: int = WINDOW, depth: int = 3) -> list[tuple[list[tuple[int, int]], int]]:
    """[( [(length, copies), ...], times ), ...]: together they use every counted piece exactly once.

    Repeat counts of the shallow combinations are rounded down where lengths run out; what is left is
    packed greedily, largest first, many sequences at a time. The work depends on the window alone.
    """
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] += n
    plan: list[tuple[list[tuple[int, int]], int]] = []
    combos = combinations(window, np.flatnonzero(left), depth)
    if len(combos):
        x = non_negative_least_squares(combos, left.astype(float))
        repeats = np.floor(x + 0.5).astype(np.int64)
        for s in np.argsort(-x, kind="stable"):
            if repeats[s] <= 0:
                break
            uses = {}
            for length in combos[s][combos[s] > 0].tolist():
                uses[length] = uses.get(length, 0) + 1
            times = min([int(repeats[s]), *(int(left[k]) // c for k, c in uses.items())])
            if times > 0:
                plan.append((list(uses.items()), times))
                for k, c in uses.items():
                    left[k] -= c * times
    while (have := np.flatnonzero(left)).size:
        room, uses = window, {}
        while room > 0:
            fits = have[have <= room]
            fits = fits[[int(left[k]) > uses.get(int(k), 0) for k in fits]] if len(uses) else fits
            if not fits.size:
                break
            k = int(fits[-1])
            c = min(room // k, int(left[k]) - uses.get(k, 0))
            uses[k] = uses.get(k, 0) + c
            room -= c * k
        times = min(int(left[k]) // c for k, c in uses.items())
        plan.append((list(uses.items()), times))
        for k, c in uses.items():
            left[k] -= c * times
    return plan


def _plan_arrays(plan: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """For the n-th piece of each length: which run of sequences it falls in, as sorted break points."""
    rows, taken, base = [], {}, 0
    for uses, times in plan:
        at = 0
        for length, copies in uses:
            lo = taken.get(length, 0)
            rows.append(((length << _SHIFT) | lo, base, copies, at))
            taken[length] = lo + copies * times
            at += length * copies
        base += times
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": a[:, 0], "base": a[:, 1], "copies": a[:, 2], "at": a[:, 3]}


def pack(pieces: DataFrame, window: int = WINDOW, depth: int = 3, rows_per_group: int = 1_000_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` needs ``length`` in 1..window and should be a stored table, as it is read three times. Only the
    length histogram (at most ``window`` rows) and the plan made from it (a few rows for each length)
    pass through the driver. Pieces of one length are numbered in salted groups, so a length that a
    third of the pieces share is spread out. An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    total = sum(histogram.values())
    plan = _plan_arrays(packing_plan(histogram, window, depth))
    groups = max(16, -(-total // rows_per_group))
    names = pieces.columns
    salted = pieces.withColumn("__rp_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names]), F.lit(groups)))
    by_length = "length", "__rp_salt"
    sizes = salted.groupBy(*by_length).agg(F.count("*").alias("__rp_n"))
    from pyspark.sql import Window

    before = Window.partitionBy("length").orderBy("__rp_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*by_length, F.coalesce(F.sum("__rp_n").over(before), F.lit(0)).alias("__rp_base"))
    order = [F.col(f"`{c}`") for c in names if c not in by_length]
    ranked = salted.withColumn("__rp_rank", F.row_number().over(Window.partitionBy(*by_length).orderBy(*order)) - 1)
    ranked = ranked.join(bases, list(by_length)).select(*[F.col(f"`{c}`") for c in names], (F.col("__rp_rank") + F.col("__rp_base")).alias("__rp_rank"))
    shared = share(spark, plan)
    schema = ranked.select(*[F.col(f"`{c}`") for c in names], F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared()
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(len(names)).to_numpy(zero_copy_only=False)
            s = np.searchsorted(p["key"], (length << _SHIFT) | rank, side="right") - 1
            nth = rank - (p["key"][s] & ((1 << _SHIFT) - 1))
            sequence, offset = p["base"][s] + nth // p["copies"][s], p["at"][s] + nth % p["copies"][s] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Tokenize, cut long documents at whole windows and pack every piece; no piece is cut again."""
    return pack(materialize(token_pieces(docs, vocabulary, id_col, text_col, window)), window)
