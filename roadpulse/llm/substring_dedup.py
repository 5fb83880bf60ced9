"""Removal of repeated passages of words by fixed-block anchors.

Every document is cut into blocks of half a window, which don't overlap; they are the index. All rolling
runs of that length of all documents probe it: a passage of a whole window that stands in two documents holds
a whole block of either, so both are hit there. Each hit is then extended: the windows
around it meet those of all other hit documents, and windows that follow each other make up the maximal
repeats. Windows are compared by 128-bit hashes: among 10**13 windows some two that differ agree with a probability of about 10**-13.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize
from .textchunks import Chunk, RunHash, batch, distinct_chunks, exchange, for_all_rows, gathered, group_starts, is_in, parts_for, rows_of, shared_hashes, split_by_part, squeeze, unpack48, unsqueeze

WINDOW = 50
#: Words whose hashes are found together.
_SEGMENT = 1 << 18
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words of a chunk: its bytes with each text's words joined by one space, and where each word starts and ends."""

    def __init__(self, c: Chunk):
        space = _SPACES[c.data]
        edge = np.zeros(len(space) + 1, bool)
        edge[c.starts[c.starts < len(space)]] = True
        real = ~space
        first = real & (np.r_[True, space[:-1]] | edge[:-1]) if len(space) else real
        start = np.flatnonzero(first)
        self.doc = c.doc_of(start)
        # each word goes to the new array with one space after it
        lengths = np.diff(np.r_[np.cumsum(np.r_[0, real])[start], real.sum()]) if len(start) else np.zeros(0, np.int64)
        self.start = np.cumsum(np.r_[0, lengths + 1])[:-1].astype(np.int64) if len(start) else start
        self.end = self.start + lengths
        self.data = np.full(int(lengths.sum() + len(lengths)), 0x20, np.uint8)
        keep = np.ones(len(self.data), bool)
        keep[self.end] = False
        self.data[keep] = c.data[real]
        self.first = np.searchsorted(self.doc, np.arange(len(c.ids) + 1))  # of each document

    def runs(self, n: int, letters: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First word, and hash, of each run of n words that lies in one document."""
        last = len(self.doc) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:last] == self.doc[n - 1 :])
        hashes = []
        for base in range(0, last, _SEGMENT):
            some = at[np.searchsorted(at, base) : np.searchsorted(at, base + _SEGMENT)]
            if len(some):
                first = self.start[some[0]]
                hash_of = RunHash(self.data[first : self.end[some[-1] + n - 1]], letters)
                hashes.append(hash_of(self.start[some] - first, self.end[some + n - 1] - first))
        return at, np.concatenate(hashes or [np.zeros(0, np.uint64)])


def _cut(h: np.ndarray) -> np.ndarray:
    return h >> np.uint64(16)


def _spread(at: np.ndarray, size: int, before: int, after: int) -> np.ndarray:
    """Places of an array that lie within [x - before, x + after) of any x."""
    d = np.zeros(size + 1, np.int64)
    np.add.at(d, np.maximum(at - before, 0), 1)
    np.add.at(d, np.minimum(at + after, size), -1)
    return np.cumsum(d[:-1]) > 0


def _windows(w: Words, hits: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows that hold a hit, and both halves of their hashes; in the order of the hashes."""
    block = window // 2
    at, h = w.runs(block)
    hit = at[is_in(_cut(h), [unpack48(x) for x in hits])]
    near = _spread(hit, len(w.doc), window - block, 1)
    at, h = w.runs(window)
    more = w.runs(window, 1)[1]
    at, h, more = at[near[at]], h[near[at]], more[near[at]]
    order = _order(h, more)
    return at[order], h[order], more[order]


def _order(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """By both hashes; the second decides only where the first ones collide."""
    order = np.argsort(h, kind="stable")
    if len(group_starts(h[order])) != len(group_starts(h[order], more[order])):
        order = np.lexsort((more, h))
    return order


def _least(ids: np.ndarray, g: np.ndarray) -> np.ndarray:
    """For each row the least of its group's ids; groups begin at ``g``."""
    return np.repeat(np.minimum.reduceat(ids, g), np.diff(np.r_[g, len(ids)])) if len(g) else ids


def _covered(chunks: DataFrame, window: int) -> DataFrame:
    """(chunk, hits, first): the anchors of each chunk and those of its windows that a document of another chunk with a smaller id has."""
    parts = parts_for(chunks)
    block = window // 2

    def emit(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w = Words(c)
        at, h = w.runs(block)
        doc = w.doc[at]
        return _cut(h), doc, (at - w.first[doc]) % block == 0

    hits = gathered(shared_hashes(chunks, emit, parts), "hits")
    hits = materialize(hits)

    def deal(chunk: int, h: np.ndarray, more: np.ndarray, ids: np.ndarray, width: int) -> pa.RecordBatch:
        rows = [(p, chunk, np.concatenate([h[s], more[s]]).tobytes(), squeeze(ids[s])) for p, s in split_by_part(_cut(h), parts, width)]
        return batch(["part", "chunk", "hashes", "ids"], rows, [pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    def send(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            c = Chunk(row)
            w = Words(c)
            at, h, more = _windows(w, row["hits"], window)
            g = group_starts(h, more)
            if len(g):
                yield deal(c.chunk, h[g], more[g], np.minimum.reduceat(c.ids[w.doc[at]], g), width)

    def together(t: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
        return [np.frombuffer(x, np.uint64).reshape(2, -1) for x in t.column("hashes").to_pylist()], np.concatenate([unsqueeze(x, "<i8") for x in t.column("ids").to_pylist()])

    def merge(t: pa.Table, group: int, width: int) -> pa.Table:
        lists, ids = together(t)
        h, more = np.concatenate(lists, 1)
        order = _order(h, more)
        h, more, ids = h[order], more[order], ids[order]
        g = group_starts(h, more)
        return pa.Table.from_batches([deal(group, h[g], more[g], np.minimum.reduceat(ids, g), width)])

    def meet(t: pa.Table, answers: pa.Table | None, width: int) -> pa.Table:
        lists, ids = together(t)
        if answers is not None:  # windows that a document elsewhere with a smaller id has, as if one before all had them
            known = [np.frombuffer(x, np.uint64).reshape(2, -1) for x in answers.column("earlier").to_pylist()]
            lists, ids = lists + known, np.r_[ids, np.full(sum(x.shape[1] for x in known), np.iinfo(np.int64).min)]
        h, more = np.concatenate(lists, 1)
        order = _order(h, more)
        least = np.empty(len(h), np.int64)
        least[order] = _least(ids[order], group_starts(h[order], more[order]))
        edge = np.cumsum([0, *[x.shape[1] for x in lists]])
        out = [(c, x[:, e].tobytes()) for c, x, a, b in zip(t.column("chunk").to_pylist(), lists, edge[:-1], edge[1:], strict=False) if (e := least[a:b] < ids[a:b]).any()]
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "earlier": pa.array([x[1] for x in out], pa.binary())})

    asked = chunks.drop("keys").withColumn("keys", F.lit(b"")).join(hits, "chunk")
    answers = exchange(asked, send, merge, meet, parts, "part int, chunk long, hashes binary, ids binary", "chunk long, earlier binary")
    earlier = gathered(answers, "earlier")
    return materialize(hits.join(earlier, "chunk", "left"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, spans, kept_sha256 and, if ``with_text``, kept_text.

    Removed is each word covered by a run of ``window`` words that also starts in a document with a smaller id,
    as the texts are in the input. spans: (start, length) of the maximal removed runs, in words. kept_text: the
    other words joined by one space. Null and empty texts have no words; a null id stands after all
    others; rows with one id don't remove each other's words; repeated rows give repeated results. Other
    columns aren't read; an empty table gives an empty one. Texts of any length are taken whole, hashed in segments.
    """
    chunks = distinct_chunks(docs, id_col, text_col)
    covered = _covered(chunks, window)
    schema = "key binary, first_id long, n_words long, n_removed long, spans array<struct<start:long,length:long>>, kept_sha256 string" + ", kept_text string" * with_text

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            c = Chunk(row)
            w = Words(c)
            gone = np.zeros(len(w.doc), bool)
            if row["hits"]:
                at, h, more = _windows(w, row["hits"], window)
                ids = c.ids[w.doc[at]]
                g = group_starts(h, more)
                if len(g):
                    found = [np.frombuffer(x, np.uint64).reshape(2, -1) for x in row["earlier"] or []]
                    known = np.concatenate(found, 1) if found else np.zeros((2, 0), np.uint64)
                    # each group of this chunk's windows is one of those that it has sent
                    place = np.searchsorted(h[g], known[0])
                    hit = np.zeros(len(g), bool)
                    if known.shape[1]:
                        while (off := (h[g][np.minimum(place, len(g) - 1)] == known[0]) & (more[g][np.minimum(place, len(g) - 1)] != known[1]) & (place < len(g) - 1)).any():
                            place = place + off
                        hit[place] = True
                    repeated = (_least(ids, g) < ids) | np.repeat(hit, np.diff(np.r_[g, len(h)]))
                    gone = _spread(at[repeated], len(w.doc), 0, window)
            out = []
            for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
                off = gone[a:b]
                if off.any():
                    inner = np.flatnonzero(np.diff(np.r_[False, off, False]))
                    spans = [{"start": int(x), "length": int(y - x)} for x, y in inner.reshape(-1, 2)]
                    text = b" ".join(w.data[w.start[a + x] : w.end[a + y - 1]].tobytes() for x, y in np.flatnonzero(np.diff(np.r_[False, ~off, False])).reshape(-1, 2))
                else:
                    spans, text = [], w.data[w.start[a] : w.end[b - 1]].tobytes() if b > a else b""
                out.append((c.keys[i], int(c.ids[i]), int(b - a), int(off.sum()), spans, hashlib.sha256(text).hexdigest(), text))
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])), pa.string(), pa.string()]
            names = ["key", "first_id", "n_words", "n_removed", "spans", "kept_sha256", "kept_text"]
            n = len(names) if with_text else len(names) - 1
            for a in range(0, len(out), 500):
                yield batch(names[:n], out[a : a + 500], types[:n])

    by_text = materialize(chunks.join(covered, "chunk", "left").mapInArrow(finish, schema))
    discard(chunks, covered)
    span = F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("length"))
    whole = {"n_removed": F.col("n_words"), "spans": F.array(span), "kept_sha256": F.lit(hashlib.sha256(b"").hexdigest())} | ({"kept_text": F.lit("")} if with_text else {})
    return for_all_rows(docs, by_text, id_col, text_col, "n_words", window, whole)


