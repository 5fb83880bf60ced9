"""Document fingerprints: digests of improbable features.

Every window of bytes has an entropy; windows whose level of entropy is rare in the corpus tell texts apart. In each neighbourhood of
windows the rarest wins, and windows that win often enough are the text's features. Features go, in the order of the text,
into a chain of Bloom filters, each of which takes a fixed number of them. Two fingerprints are compared by the
overlap of bits, normalised by what chance gives and what is possible.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_for, discard, materialize, mix, small

#: Bytes of a window; windows of a neighbourhood; neighbourhoods that a feature wins at least (all, where a text has fewer).
WINDOW, NEIGHBOURS, WINS = 32, 64, 16
#: Levels of entropy to a bit; windows below this many bits are no features.
LEVELS_PER_BIT, LEAST_BITS = 256, 1
#: A filter's bits, its features, and the bits that each of them sets.
FILTER_BITS, FEATURES, HASHES = 1024, 80, 5
#: Overlap counts from this share of the way between chance and all on.
CUT = 0.15
#: Texts are sorted in parts of about so many bytes.
PART_BYTES = 64 << 20

_BLOCK = 1 << 15
_FIXED = 1 << 16
_TOP = WINDOW.bit_length() - 1
LEVELS = _TOP * LEVELS_PER_BIT + 1
_PLAIN, _NONE = 0xFFFE, 0xFFFF
_PAD = WINDOW + NEIGHBOURS


# ---- features of a batch of texts ---------------------------------------------------------------


def _levels(b: np.ndarray) -> np.ndarray:
    """The level of entropy of the window at each byte but the last WINDOW - 1, in whole numbers throughout.

    A step of the window changes the counts of the byte that leaves and of the one that enters; both counts come from comparing
    the bytes with themselves at every distance below WINDOW.
    """
    c = np.arange(1, WINDOW + 1)
    weight = np.concatenate([[0], np.round(c * np.log2(c) * _FIXED).astype(np.int64)])
    step = np.diff(weight)
    out = np.empty(len(b) - WINDOW + 1, np.int16)
    for a in range(0, len(out), _BLOCK):
        x = b[a : a + _BLOCK + WINDOW - 1]
        n = len(x) - WINDOW
        leaves, enters = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
        for d in range(1, WINDOW):
            same = (x[:-d] == x[d:]).view(np.uint8)
            leaves += same[:n]
            enters += same[WINDOW - d : WINDOW - d + n]
        total = np.empty(n + 1, np.int64)
        total[0] = weight[np.bincount(x[:WINDOW])].sum()
        total[1:] = step[enters] - step[leaves]
        np.cumsum(total, out=total)
        out[a : a + n + 1] = (_TOP * WINDOW * _FIXED - total) * LEVELS_PER_BIT // (WINDOW * _FIXED)
    return np.maximum(out, 0)


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array with room between them, where each begins, and how many windows it has."""
    sizes = np.array([len(t) for t in texts], np.int64)
    at = np.concatenate([[0], np.cumsum(sizes + _PAD)])
    data = np.zeros(at[-1], np.uint8)
    for t, a in zip(texts, at[:-1].tolist(), strict=True):
        data[a : a + len(t)] = np.frombuffer(t, np.uint8)
    return data, at[:-1], np.maximum(sizes - WINDOW + 1, 0)


def _marked(size: int, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(size, bool)
    for a, k in zip(at.tolist(), n.tolist(), strict=True):
        out[a : a + k] = True
    return out


def level_counts(texts: list[bytes]) -> np.ndarray:
    data, at, windows = _laid_out(texts)
    out = np.zeros(LEVELS, np.int64)
    if windows.any():
        levels = _levels(data)
        out += np.bincount(levels[_marked(len(data), at, windows)[: len(levels)]], minlength=LEVELS)
    return out


def features(texts: list[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features of all texts, and the text of each, in order. A text without a feature has one: the whole text; an empty one none."""
    data, at, windows = _laid_out(texts)
    found, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if windows.any():
        rank = np.full(len(data), _NONE, np.uint16)
        levels = _levels(data)
        rank[: len(levels)] = ranks[levels]
        rank[~_marked(len(data), at, windows)] = _NONE
        rounds = np.where(windows > 0, np.maximum(windows - NEIGHBOURS + 1, 1), 0)
        counted = _marked(len(data), at, rounds)
        wins = np.zeros(len(data), np.uint8)
        for a in range(0, len(data), _BLOCK):
            own = rank[a : a + _BLOCK + NEIGHBOURS - 1]
            key = (own.astype(np.uint32) << 16) | np.arange(len(own), dtype=np.uint32)
            width = 1
            while width < NEIGHBOURS:
                key = np.minimum(key, np.concatenate([key[width:], np.full(min(width, len(key)), 0xFFFFFFFF, np.uint32)]))
                width *= 2
            key = key[:_BLOCK][counted[a : a + _BLOCK]]
            key = key[key >> 16 < _PLAIN] & 0xFFFF
            wins[a : a + len(own)] += np.bincount(key, minlength=len(own)).astype(np.uint8)
        some = np.flatnonzero(wins)
        text = np.searchsorted(at, some, side="right") - 1
        enough = wins[some] >= np.minimum(rounds, WINS)[text]
        some, owner = some[enough], text[enough]
        letters = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, WINDOW)[some]).view("<u8")
        found = np.zeros(len(some), np.uint64)
        for i in range(letters.shape[1]):
            found = mix(found ^ letters[:, i])
    bare = np.array([i for i in np.flatnonzero(np.bincount(owner, minlength=len(texts)) == 0).tolist() if texts[i]], np.int64)
    whole = np.array([xxhash.xxh3_64_intdigest(texts[i]) for i in bare.tolist()], np.uint64)
    order = np.argsort(np.concatenate([owner, bare]), kind="stable")
    return np.concatenate([found, whole])[order], np.concatenate([owner, bare])[order]


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The chain of filters of each text: arrays (filters, bytes)."""
    hashes, owner = features(texts, ranks)
    n = np.bincount(owner, minlength=len(texts))
    place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
    chain = -(-n // FEATURES)
    first = np.concatenate([[0], np.cumsum(chain)])
    bits = np.zeros((int(first[-1]), FILTER_BITS), bool)
    width = FILTER_BITS.bit_length() - 1
    for i in range(HASHES):
        bits[first[owner] + place // FEATURES, ((hashes >> np.uint64(width * i)) % np.uint64(FILTER_BITS)).astype(np.int64)] = True
    packed = np.packbits(bits, axis=1)
    return [packed[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


# ---- comparison ---------------------------------------------------------------------------------


def _best(a: np.ndarray, b: np.ndarray) -> float:
    """For each filter of ``a`` the nearest of ``b``; their mean, weighted by bits."""
    a, b = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    in_a, in_b = np.bitwise_count(a).sum(1).astype(np.float64), np.bitwise_count(b).sum(1).astype(np.float64)
    best = np.zeros(len(a))
    rows = max(1, (1 << 20) // len(b))
    for i in range(0, len(a), rows):
        both = np.bitwise_count(a[i : i + rows, None, :] & b[None]).sum(2)
        most = np.minimum(in_a[i : i + rows, None], in_b[None])
        least = in_a[i : i + rows, None] * in_b[None] / FILTER_BITS
        least = least + CUT * (most - least)
        best[i : i + rows] = np.clip((both - least) / np.maximum(most - least, 1e-9), 0, 1).max(1)
    return float((best * in_a).sum() / in_a.sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1, the same for either order. Each filter of the shorter chain is held to all of the longer one; of empty chains both are alike.

    The work is the product of the lengths of the chains: a filter stands for some four thousand bytes of text.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b):
        return (_best(a, b) + _best(b, a)) / 2
    return _best(a, b) if len(a) < len(b) else _best(b, a)


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, FILTER_BITS // 8)


# ---- Spark --------------------------------------------------------------------------------------


def fit_rarity(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The rank of each level of entropy, rarest first, over all windows of all texts; levels that occur in none are the rarest.

    Tasks count for themselves; what reaches the driver has one number for each level.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(LEVELS, np.int64)
        for b in small(batches):
            n += level_counts([t or b"" for t in b.column(0).cast(pa.binary()).to_pylist()])
        levels = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(levels, pa.int64()), pa.array(n[levels], pa.int64())], ["level", "n"])

    counts = np.zeros(LEVELS, np.int64)
    for r in docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect():
        counts[r["level"]] = r["n"]
    ranks = np.empty(LEVELS, np.uint16)
    ranks[np.argsort(counts, kind="stable")] = np.arange(LEVELS)
    ranks[: LEAST_BITS * LEVELS_PER_BIT] = _PLAIN
    return ranks


def fingerprints(docs: DataFrame, ranks: np.ndarray, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with ``out_col`` (replaced where it is there): the chain of filters in hexadecimal digits, '' for null and empty texts.

    Equal texts have equal fingerprints under the same ``ranks`` (of ``fit_rarity``), which may be kept and used for later texts.
    """
    names = [c for c in docs.columns if c != out_col]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            made = digests([t or b"" for t in b.column(0).cast(pa.binary()).to_pylist()], ranks)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array([x.tobytes().hex() for x in made], pa.string())], [*b.schema.names[1:], out_col])

    own = docs.select(F.col(text_col).cast("string").alias("__rp_text"), *[F.col(f"`{c}`") for c in names])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema[1:])
    return own.mapInArrow(add, f"{fields}, `{out_col}` string")


_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_TYPES = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def _edited(text: str, after: str) -> str:
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


def _compared(texts: list[str], own: list[np.ndarray], after: list[str], of_after: list[np.ndarray], ranks: np.ndarray) -> list[pa.Array]:
    """The columns of ``_RESULT`` for texts that are followed by others."""
    edited = [_edited(t, x).encode() for t, x in zip(texts, after, strict=True)]
    made = digests(edited, ranks)
    columns: Iterable[list] = (
        [len(t) for t in texts],
        [hashlib.sha256(t).hexdigest() for t in edited],
        [x.tobytes().hex() for x in own],
        [x.tobytes().hex() for x in made],
        [likeness(a, b) for a, b in zip(own, made, strict=True)],
        [likeness(a, b) for a, b in zip(own, of_after, strict=True)],
    )
    return [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]


def _sequence(ranks: np.ndarray) -> Callable:
    """Of sorted (id, text): a row for each text that another follows in the task ("row"), and the first and last text of the task as they are."""

    def end(kind: str, part: int, id_: pa.Array, text: str, own: np.ndarray) -> pa.RecordBatch:
        null = {1: pa.array([own.tobytes().hex()], pa.string())}
        result = [pa.nulls(1, _TYPES[0]), pa.nulls(1, _TYPES[1]), null[1], *[pa.nulls(1, t) for t in _TYPES[3:]]]
        return pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([part], pa.int32()), id_, *result, pa.array([text], pa.string())], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last: tuple[pa.Array, str, np.ndarray] | None = None
        for b in small(batches, column=1):
            texts = [t or "" for t in b.column(1).to_pylist()]
            own = digests([t.encode() for t in texts], ranks)
            ids = b.column(0)
            if last is None:
                yield end("head", part, ids[:1], texts[0], own[0])
            else:
                ids, texts, own = pa.concat_arrays([last[0], ids]), [last[1], *texts], [last[2], *own]
            n = len(texts) - 1
            if n:
                made = _compared(texts[:n], own[:n], texts[1:], own[1:], ranks)
                yield pa.RecordBatch.from_arrays([pa.array(["row"] * n), pa.array([part] * n, pa.int32()), ids[:n], *made, pa.nulls(n, pa.string())], _NAMES)
            last = ids[n:], texts[n], own[n]
        if last is not None:
            yield end("tail", part, *last)

    return run


_NAMES = ["kind", "part", "id", *[f.split()[0] for f in _RESULT.split(", ")], "text"]


def edit_report(docs: DataFrame, ranks: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How fingerprints bear an edit: (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row.

    The edited text has its last third replaced by the beginning of the next document in the order of falling ids (after the last comes the
    first), as many code points or all. ``ranks`` are fitted on ``docs`` where none are given.

    Null texts are empty; an empty text is like no other but an empty one. Null ids come last; rows with equal ids follow in an order by
    their texts alone (length, hash), repeated rows after each other. One document follows itself; an empty table gives an empty result.
    Texts shorter than a window have their whole as one feature. A text of any length is taken whole; comparing chains takes the product of
    their lengths, so beyond some hundred MB in one text that is slow. Other columns aren't read.

    Texts are sorted into parts by id, where the next text is the next row; only the first and last text of each part meet later, by the
    parts' numbers. Parts are cut by id, text and row, so equal ids don't fill one.
    """
    if ranks is None:
        ranks = fit_rarity(docs, text_col)
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"size": F.octet_length("text"), "hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("id").desc_nulls_last(), "size", "hash", "row"]
    n = buckets_for(docs, text_col, PART_BYTES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("id", "text")
    done = materialize(parts.mapInArrow(_sequence(ranks), f"kind string, part int, id {kind}, {_RESULT}, text string"), "zstd")
    # one row for each part, without texts
    heads = done.filter("kind = 'head'")
    every = Window.orderBy("part")
    after = heads.select("part", F.coalesce(F.lead("part").over(every), F.min("part").over(every)).alias("next"))
    first = heads.select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    tails = done.filter("kind = 'tail'").select("part", "id", "text", "fingerprint").join(after, "part").join(first, "next").select("id", "text", "fingerprint", "next_text", "next_fingerprint")

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, column=1):
            text, own, next_text, of_next = (b.column(i).to_pylist() for i in range(1, 5))
            yield pa.RecordBatch.from_arrays([b.column(0), *_compared(text, [from_text(x) for x in own], next_text, [from_text(x) for x in of_next], ranks)], _NAMES[2:-1])

    stitched = tails.mapInArrow(stitch, f"id {kind}, {_RESULT}")
    names = _NAMES[2:-1]
    return done.filter("kind = 'row'").select(*names).unionByName(stitched).withColumnRenamed("id", id_col)
