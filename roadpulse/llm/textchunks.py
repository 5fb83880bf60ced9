"""Distinct texts in chunks of a few megabytes, and exchanges of packed hashes between the chunks.

Operators that look for passages shared by documents work on one row per chunk, so that tasks handle a
chunk's bytes as one array. Exact copies are set aside first: only the row with the smallest id of each
text is looked at, and the others follow from it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix, small

#: Bytes of text in a chunk (a longer text has a chunk of its own), and bytes of text whose hashes meet in one group.
CHUNK = 2 << 20
GROUP = 8 << 20
#: Most rows that a chunk sends in one step of an exchange.
FANOUT = 256
#: Most tasks of a step; beyond, a task takes several parts one after another, as blocks of a shuffle grow with the square of its tasks.
MOST_TASKS = 8192
#: A null id stands after all others.
LAST_ID = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15
#: Of 64-bit hashes of bytes; two of them make 128 bits.
_LETTERS = np.random.default_rng(50).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---- packing -----------------------------------------------------------------------------------


def squeeze(a: np.ndarray) -> bytes:
    """An array as bytes under general-purpose compression, with its length before."""
    raw = np.ascontiguousarray(a).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.Codec("zstd").compress(raw, asbytes=True) if raw else b"")


def unsqueeze(b: bytes, dtype: str | type) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(b[8:], n, asbytes=True) if n else b"", dtype)


def pack48(v: np.ndarray) -> bytes:
    return np.ascontiguousarray(np.ascontiguousarray(v, "<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def part_of(v: np.ndarray, parts: int) -> np.ndarray:
    """The part of each 48-bit number: equal ranges, so sorted numbers have sorted parts."""
    return ((v >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def batch(schema: list[str], rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], schema)


# ---- hashes of runs of bytes -----------------------------------------------------------------------


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(n + 1, np.uint64(_BASE)), np.full(n + 1, np.uint64(pow(_BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class RunHash:
    """64-bit hashes of any runs of bytes of one array; one pass, then two look-ups for each run."""

    def __init__(self, data: np.ndarray, letters: int = 0):
        self.up, self.down = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_LETTERS[letters][data] * self.up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.down[start])


# ---- chunks ------------------------------------------------------------------------------------


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key of the whole text, text); null texts are empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("id"), F.unhex(F.md5(text)).alias("key"), text.alias("text"))


def distinct_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per chunk: (chunk, size, keys, ids, ends, data), a stored table; of each text the row with the smallest id."""
    first = text_rows(docs, id_col, text_col).groupBy("key").agg(F.min("id").alias("id"), F.first("text").alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, texts, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts])
            row = (uuid.uuid4().int >> 65, size, b"".join(keys), np.array(ids, "<i8").tobytes(), ends.astype("<i8").tobytes(), squeeze(np.frombuffer(b"".join(texts), np.uint8)))
            return batch(["chunk", "size", "keys", "ids", "ends", "data"], [row], [pa.int64(), pa.int64(), *[pa.binary()] * 4])

        for b in small(batches, 2, CHUNK):
            for key, i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.large_binary()).to_pylist(), strict=True):
                if texts and size + len(t) > CHUNK:
                    yield flush()
                    keys, ids, texts, size = [], [], [], 0
                keys.append(key), ids.append(i), texts.append(t)
                size += len(t)
        if texts:
            yield flush()

    return materialize(first.select("key", "id", "text").mapInArrow(pack, "chunk long, size long, keys binary, ids binary, ends binary, data binary"))


def parts_for(chunks: DataFrame) -> int:
    total = chunks.agg(F.sum("size").alias("n")).first()["n"] or 0
    return max(1, -(-total // GROUP))


class Chunk:
    """A chunk's row as arrays: ids, where each text starts and ends, all bytes."""

    def __init__(self, row: dict):
        self.chunk = row["chunk"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.ends = np.frombuffer(row["ends"], "<i8")
        self.starts = np.r_[0, self.ends[:-1]].astype(np.int64)
        self.data = unsqueeze(row["data"], np.uint8)
        self.keys = [row["keys"][i : i + 16] for i in range(0, len(row["keys"]), 16)]

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, for tables with one row per chunk."""
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(j)[i].as_py() for j, n in enumerate(b.schema.names)}


def gathered(answers: DataFrame, *columns: str) -> DataFrame:
    """Answers by chunk: a list of each column, which holds no more than the chunk has asked."""
    return answers.groupBy("chunk").agg(*[F.collect_list(c).alias(c) for c in columns])


def split_by_part(v: np.ndarray, parts: int, width: int = 1) -> Iterator[tuple[int, slice]]:
    """Slices of sorted 48-bit numbers by runs of ``width`` parts."""
    part = part_of(v, parts) // width
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(v) else np.zeros(0, np.int64)
    for a, b in zip(cuts, np.r_[cuts[1:], len(v)], strict=True):
        yield int(part[a]), slice(int(a), int(b))


def group_starts(*sorted_values: np.ndarray) -> np.ndarray:
    """Where groups of equal rows begin."""
    if not len(sorted_values[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, np.any([v[1:] != v[:-1] for v in sorted_values], 0)])


def fan_of(parts: int) -> tuple[int, int]:
    """Into how many groups a row is split in each step of an exchange, FANOUT at most, and the parts in each group of the first step."""
    steps = 1
    while FANOUT**steps < parts:
        steps += 1
    fan = max(1, int(parts ** (1 / steps)) - 1)
    while fan**steps < parts:
        fan += 1
    return fan, fan ** (steps - 1)


def exchange(
    table: DataFrame,
    send: Callable[[Iterator[pa.RecordBatch], int], Iterator[pa.RecordBatch]],
    merge: Callable[[pa.Table, int, int], pa.Table],
    meet: Callable[[pa.Table, pa.Table | None, int], pa.Table],
    parts: int,
    row: str,
    answer: str,
) -> DataFrame:
    """Hashes of each chunk meet those of the other chunks, part by part, and the chunk gets answers, ``answer``: (chunk, ...).

    ``send(batches, width)`` gives the rows of each chunk, ``row``: (part, chunk, ...), one for each ``width`` parts. With
    FANOUT parts or fewer that width is 1 and ``meet(rows, None, 1)`` answers to the rows of a part. With more of them the rows would
    grow with the square of the input, so they go in steps: in between, rows of some chunks and of some parts, as many bytes as a part has,
    meet in a group, ``merge(rows, group, width)`` puts them together as rows of the group, as if that were a chunk, in which each hash
    stands once, and the answers to these go back by ``meet(rows, answers, width)``. So a chunk sends FANOUT rows in a step at most, and a
    hash that all chunks have comes to its part as often as there are groups in the last step, not chunks.
    """
    fan, width = fan_of(parts)
    tasks = min(parts, MOST_TASKS)

    def step(sent: DataFrame, width: int) -> DataFrame:
        if width == 1:
            return sent.repartition(tasks, "part").groupBy("part").applyInArrow(lambda t: meet(t, None, 1), answer)
        group = F.col("part").cast("long") * width + F.pmod(F.xxhash64(F.lit(width), "chunk"), F.lit(width))
        rows = materialize(sent.withColumn("group", group))
        merged = rows.repartition(tasks, "group").groupBy("group").applyInArrow(lambda key, t: merge(t, key[0].as_py(), width // fan), row)
        answers = step(merged, width // fan)
        groups = rows.repartition(tasks, "group").groupBy("group")
        return groups.cogroup(answers.repartition(tasks, "chunk").groupBy("chunk")).applyInArrow(lambda t, a: meet(t, a, width // fan), answer)

    return step(table.mapInArrow(lambda batches: send(batches, width), row), width)


def shared_hashes(chunks: DataFrame, emit: Callable[[Chunk], tuple[np.ndarray, np.ndarray, np.ndarray]], parts: int) -> DataFrame:
    """(chunk, hits): the 48-bit hashes of each chunk that two documents have and that one has as a reference.

    ``emit`` gives (hashes, document, is reference) of a chunk in the order of its documents. Each chunk sends a hash
    once, whatever the number of its documents, so frequent ones don't pile up.
    """

    def deal(chunk: int, v: np.ndarray, flags: np.ndarray, width: int) -> pa.RecordBatch:
        rows = [(p, chunk, pack48(v[s]), squeeze(flags[s])) for p, s in split_by_part(v, parts, width)]
        return batch(["part", "chunk", "hashes", "flags"], rows, [pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    def send(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            c = Chunk(row)
            v, doc, reference = emit(c)
            order = np.argsort(v, kind="stable")
            v, doc, reference = v[order], doc[order], reference[order]
            at = group_starts(v)
            last = np.r_[at[1:], len(v)] - 1
            if not len(at):
                continue
            flags = (doc[at] != doc[last]).astype(np.uint8) + 2 * np.maximum.reduceat(reference.astype(np.uint8), at)
            yield deal(c.chunk, v[at], flags, width)

    def together(t: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
        return [unpack48(x) for x in t.column("hashes").to_pylist()], np.concatenate([unsqueeze(x, np.uint8) for x in t.column("flags").to_pylist()])

    def merge(t: pa.Table, group: int, width: int) -> pa.Table:
        lists, flags = together(t)
        v = np.concatenate(lists)
        order = np.argsort(v, kind="stable")
        v, flags = v[order], flags[order]
        at = group_starts(v)
        several = (np.diff(np.r_[at, len(v)]) > 1) | (np.maximum.reduceat(flags & 1, at) > 0)
        return pa.Table.from_batches([deal(group, v[at], several.astype(np.uint8) + np.maximum.reduceat(flags & 2, at), width)])

    def meet(t: pa.Table, answers: pa.Table | None, width: int) -> pa.Table:
        chunk = t.column("chunk").to_pylist()
        lists, flags = together(t)
        if answers is not None:  # what is known of all chunks stands beside the rows
            known = [unpack48(x) for x in answers.column("hits").to_pylist()]
            lists, flags = lists + known, np.r_[flags, np.full(sum(len(x) for x in known), 3, np.uint8)]
        v = np.concatenate(lists)
        order = np.argsort(v, kind="stable")
        at = group_starts(v[order])
        n = np.diff(np.r_[at, len(v)])
        hit = ((n > 1) | (np.maximum.reduceat(flags[order] & 1, at) > 0)) & (np.maximum.reduceat(flags[order], at) > 1)
        shared = np.zeros(len(v), bool)
        shared[order] = np.repeat(hit, n)
        out, edge = [], np.cumsum([0, *[len(x) for x in lists]])
        for c, x, a, b in zip(chunk, lists, edge[:-1], edge[1:], strict=False):
            if shared[a:b].any():
                out.append((c, pack48(x[shared[a:b]])))
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "hits": pa.array([x[1] for x in out], pa.binary())})

    bare = chunks.drop("keys").withColumn("keys", F.lit(b""))
    return exchange(bare, send, merge, meet, parts, "part int, chunk long, hashes binary, flags binary", "chunk long, hits binary")


def is_in(v: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    known = np.sort(np.concatenate(lists)) if lists else np.zeros(0, np.uint64)
    if not len(known):
        return np.zeros(len(v), bool)
    return known[np.minimum(np.searchsorted(known, v), len(known) - 1)] == v


def for_all_rows(docs: DataFrame, by_text: DataFrame, id_col: str, text_col: str, size: str, least: int, whole: dict[str, Column], keep: bool = False) -> DataFrame:
    """Results of distinct texts (key, first_id, ...) for every row of ``docs``.

    A row whose text has a smaller id elsewhere and a ``size`` of at least ``least`` gets the values of ``whole``. With ``keep``
    the row's own columns come along as __rp_own_0, __rp_own_1, ...; otherwise its id does.
    """
    own = [F.col(f"`{c}`").alias(f"__rp_own_{i}") for i, c in enumerate(docs.columns if keep else [id_col])]
    sort = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("__rp_sort")
    rows = docs.select(*own, sort, F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))).alias("__rp_key"))
    joined = rows.join(by_text, F.col("__rp_key") == F.col("key"))
    copy = (F.col("__rp_sort") > F.col("first_id")) & (F.col(size) >= least)
    cols = [F.when(copy, whole[c]).otherwise(F.col(c)).alias(c) if c in whole else F.col(c) for c in by_text.columns if c not in ("key", "first_id")]
    mine = [F.col(f"__rp_own_{i}") for i in range(len(own))] if keep else [F.col("__rp_own_0").alias(id_col)]
    return joined.select(*mine, *cols)
