"""Cross-entropy difference: how much better a target model predicts a document than a background model.

``loss_differences`` counts every word and pair of words of the input exactly, so what it gathers grows with the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import materialize, mix, small, split_words
from .textchunks import batch, exchange, fan_of, gathered, group_starts, rows_of, squeeze, unsqueeze

#: Bytes of text in a chunk (a longer text has a chunk of its own), and bytes of text whose words and pairs meet in one group.
CHUNK = 8 << 20
GROUP = 16 << 20
#: Weight of the uniform distribution in the word model, and of the word model in the pair model.
UNIFORM = 1000.0
BACKOFF = 100.0


# ---- exact counts ------------------------------------------------------------------------------

_RESULT = ("n_words", "target_loss", "background_loss", "loss_difference")


def _pack(counts: np.ndarray) -> bytes:
    """Counts byte by byte, all lowest bytes first: most of the others are zero."""
    return squeeze(np.ascontiguousarray(counts, "<u8").view(np.uint8).reshape(-1, 8).T)


def _unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(unsqueeze(packed, np.uint8).reshape(8, -1).T).reshape(-1).view("<i8")


def _pack_keys(sorted_keys: np.ndarray) -> bytes:
    """Keys as the steps between them, which are shorter than the keys."""
    return _pack(np.diff(sorted_keys, prepend=np.uint64(0)))


def _unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed).view("<u8"), dtype=np.uint64)


def _chunks(docs: DataFrame, id_col: str, text: str, target: str) -> DataFrame:
    """One row per chunk: (chunk, size, ids, flags, ends, data), a stored table of all rows."""
    own = docs.select(id_col).schema[0].dataType
    binary = [StructField(n, BinaryType()) for n in ("flags", "ends", "data")]
    schema = StructType([StructField("chunk", LongType()), StructField("size", LongType()), StructField("ids", ArrayType(own)), *binary])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.RecordBatch, list[bytes]]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            texts = [t for _, part in held for t in part]
            ids = pa.concat_arrays([b.column(0) for b, _ in held])
            flags = np.concatenate([b.column(2).to_numpy(zero_copy_only=False) for b, _ in held]).astype(np.uint8)
            ends = np.cumsum([0, *[len(t) for t in texts]]).astype("<i8")
            columns = [flags.tobytes(), ends.tobytes(), squeeze(np.frombuffer(b"".join(texts), np.uint8))]
            rows = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            arrays = [pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([size], pa.int64()), rows, *[pa.array([c], pa.binary()) for c in columns]]
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for b in small(batches, 1, CHUNK // 4):
            texts = [t or b"" for t in b.column(1).cast(pa.large_binary()).to_pylist()]
            more = sum(len(t) for t in texts)
            if held and size + more > CHUNK:
                yield flush()
                held, size = [], 0
            held.append((b, texts))
            size += more
        if held:
            yield flush()

    rows = docs.select(id_col, F.col(text).cast("string").alias("text"), F.coalesce(F.col(target), F.lit(False)).alias("flag"))
    return materialize(rows.mapInArrow(pack, schema))


class _Grams:
    """The words of a chunk and its distinct words and pairs, each by a hash of 80 bits: ``key`` and ``more``.

    The distinct words stand first (the mark before a text's first word is one of them), then the distinct pairs; both sorted by key.
    """

    def __init__(self, row: dict):
        ends = np.frombuffer(row["ends"], "<i8")
        texts = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(row["ends"]), pa.py_buffer(unsqueeze(row["data"], np.uint8)))
        words, offsets = split_words(texts)
        self.n_words = np.diff(offsets)
        self.doc = np.repeat(np.arange(len(self.n_words)), self.n_words)
        coded = words.dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        mark = len(coded.dictionary)
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.r_[mark, word[:-1]] if len(word) else word
        before[offsets[:-1][self.n_words > 0]] = mark
        # the mark's hash is that of two words with white space between, which no word has
        digests = b"".join(xxhash.xxh3_128_digest(w) for w in [*coded.dictionary.cast(pa.large_binary()).to_pylist(), b"\n \n"])
        low, high = np.frombuffer(digests, "<u8").reshape(-1, 2).T
        more = (high >> np.uint64(48)).astype(np.uint16)
        pairs, pair = np.unique(before * (mark + 1) + word, return_inverse=True)
        first, second = pairs // (mark + 1), pairs % (mark + 1)
        with np.errstate(over="ignore"):
            joint = mix(low[first] * np.uint64(0x9E3779B97F4A7C15) + low[second])
            joint_more = more[first] * np.uint16(0xCA6B) + more[second]
        if not len(word):
            low, more = low[:0], more[:0]  # no text has a word, so none has the mark
        by_word, by_pair = np.argsort(low, kind="stable"), np.argsort(joint, kind="stable")
        self.words = len(low)
        self.key, self.more = np.concatenate([low[by_word], joint[by_pair]]), np.concatenate([more[by_word], joint_more[by_pair]])
        place = np.empty(len(low), np.int64)
        place[by_word] = np.arange(len(low))
        place_of_pair = np.empty(len(joint), np.int64)
        place_of_pair[by_pair] = len(low) + np.arange(len(joint))
        self.word, self.before, self.pair = place[word], place[before], place_of_pair[pair]

    def counts(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each word and pair occurs in the chosen texts, and how often each word (or the mark) has a word after it."""
        here = chosen[self.doc]
        seen = np.bincount(self.word[here], minlength=len(self.key)) + np.bincount(self.pair[here], minlength=len(self.key))
        return seen, np.bincount(self.before[here], minlength=len(self.key))


def _slices(key: np.ndarray, words: int, parts: int, width: int) -> Iterator[tuple[int, slice, slice]]:
    """Places of the words, which stand first, and of the pairs of each ``width`` parts; equal ranges of keys are parts."""
    part = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64) // width
    w, p = part[:words], part[words:]
    for k in np.unique(part).tolist():
        a, b = np.searchsorted(w, [k, k + 1])
        c, d = np.searchsorted(p, [k, k + 1]) + words
        yield k, slice(int(a), int(b)), slice(int(c), int(d))


def _sums(key: np.ndarray, more: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of counts its sum over the equal keys, and a place of each distinct key."""
    order = np.argsort(key, kind="stable")
    k, m = key[order], more[order]
    if (differ := (k[1:] == k[:-1]) & (m[1:] != m[:-1])).any():
        order = np.lexsort((more, key))
        k, m = key[order], more[order]
        differ = (k[1:] == k[:-1]) & (m[1:] != m[:-1])
    at = np.union1d(group_starts(k), np.flatnonzero(differ) + 1)
    out = np.empty_like(counts)
    if len(key):
        out[:, order] = np.repeat(np.add.reduceat(counts[:, order], at, axis=1), np.diff(np.r_[at, len(k)]), axis=1)
    return out, order[at]


#: Of the words and pairs of a chunk: occurrences and occurrences as the word before, in all rows and in the target.
_COUNTS = ("seen", "before", "target_seen", "target_before")


def _totals(chunks: DataFrame, parts: int) -> DataFrame:
    """(chunk, part, seen, ...): the counts of the whole input for the words and pairs of each chunk.

    A chunk sends a word or a pair once, whatever the number of its occurrences, so frequent ones don't pile up. One row
    of each part also has the number of its distinct words and the sums of their counts; the others have 0.
    """
    names = ["part", "chunk", "words", "keys", "more", *_COUNTS]
    types = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * (2 + len(_COUNTS))]

    def deal(chunk: int, words: int, key: np.ndarray, more: np.ndarray, counts: np.ndarray | list[np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
        for part, w, p in _slices(key, words, parts, width):
            both = lambda x: np.concatenate([x[w], x[p]])  # noqa: B023, E731
            # only words stand before others
            own = [_pack(both(c) if i % 2 == 0 else c[w]) for i, c in enumerate(counts)]
            yield batch(names, [(part, chunk, w.stop - w.start, _pack_keys(both(key)), both(more).tobytes(), *own)], types)

    def send(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            g = _Grams(row)
            flags = np.frombuffer(row["flags"], np.uint8).astype(bool)
            yield from deal(row["chunk"], g.words, g.key, g.more, [*g.counts(np.ones(len(flags), bool)), *g.counts(flags)], width)

    def together(t: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of words and pairs of each row, and of these: key, more, is it a word, counts."""
        column = lambda n: t.column(n).to_pylist()
        keys = [_unpack_keys(x) for x in column("keys")]
        key, more = np.concatenate(keys), np.concatenate([np.frombuffer(x, "<u2") for x in column("more")])
        is_word = np.concatenate([np.arange(len(k)) < n for k, n in zip(keys, column("words"), strict=True)])
        counts = np.zeros((len(_COUNTS), len(key)), np.int64)
        for c, name in zip(counts, _COUNTS, strict=True):
            c[is_word if "before" in name else slice(None)] = np.concatenate([_unpack(x) for x in column(name)])
        return [len(k) for k in keys], key, more, is_word, counts

    def summed(key: np.ndarray, more: np.ndarray, is_word: np.ndarray, counts: np.ndarray) -> tuple[int, np.ndarray]:
        """Puts in ``counts`` the sums over equal words and pairs; how many words there are, and a place of each word, then of each pair."""
        firsts = []
        for kind in (is_word, ~is_word):
            counts[:, kind], first = _sums(key[kind], more[kind], counts[:, kind])
            firsts.append(np.flatnonzero(kind)[first])
        return len(firsts[0]), np.concatenate(firsts)

    def merge(t: pa.Table, group: int, width: int) -> pa.Table:
        _, key, more, is_word, counts = together(t)
        words, first = summed(key, more, is_word, counts)
        return pa.Table.from_batches(deal(group, words, key[first], more[first], counts[:, first], width)).combine_chunks()

    out_names = ["chunk", "part", *_COUNTS, "distinct", "total", "target_total"]
    out_types = [pa.int64(), pa.int32(), *[pa.binary()] * len(_COUNTS), *[pa.int64()] * 3]

    def meet(t: pa.Table, answers: pa.Table | None, width: int) -> pa.Table:
        column = lambda n: t.column(n).to_pylist()
        lengths, key, more, is_word, counts = together(t)
        if answers is None:
            # the mark before a text's first word is no word: nothing predicts it
            totals = [int(counts[0, is_word].sum()), int(counts[2, is_word].sum())]
            words, first = summed(key, more, is_word, counts)
            totals = [int((counts[0, first[:words]] > 0).sum()), *totals]
        else:
            # the group's words and pairs, in the order in which they were sent, with the counts of all chunks
            totals = [sum(answers.column(n).to_pylist()) for n in out_names[-3:]]
            words, first = summed(key, more, is_word, counts)
            sums = np.zeros((len(_COUNTS), len(first)), np.int64)
            known = {r["part"]: r for r in answers.to_pylist()}
            for part, w, p in _slices(key[first], words, parts, width):
                for c, name in zip(sums, _COUNTS, strict=True):
                    x = _unpack(known[part][name])
                    c[w], c[p] = x[: w.stop - w.start], 0 if "before" in name else x[w.stop - w.start :]
            joint, joint_more, joint_words = (np.concatenate([x, x[first]]) for x in (key, more, is_word))
            joint_counts = np.concatenate([np.zeros_like(counts), sums], 1)
            summed(joint, joint_more, joint_words, joint_counts)
            counts = joint_counts[:, : len(key)]
        out = []
        edge = np.cumsum([0, *lengths]).tolist()
        for i, (chunk, part, a, b, n) in enumerate(zip(column("chunk"), column("part"), edge[:-1], edge[1:], column("words"), strict=True)):
            own = [_pack(c[a : a + n] if "before" in name else c[a:b]) for c, name in zip(counts, _COUNTS, strict=True)]
            out.append((chunk, part, *own, *([0, 0, 0] if i else totals)))
        return pa.Table.from_batches([batch(out_names, out, out_types)])

    binary = ", ".join(f"{c} binary" for c in _COUNTS)
    row = f"part int, chunk long, words long, keys binary, more binary, {binary}"
    return exchange(chunks, send, merge, meet, parts, row, f"chunk long, part int, {binary}, distinct long, total long, target_total long")


def loss_differences(docs: DataFrame, id_col: str = "doc_id", text: str = "text", target: str = "target") -> DataFrame:
    """One row per row: id, n_words, the mean loss under each model (nats a word) and their difference (lower: more like the target).

    The models predict each word from the one before it (a mark at a text's start): P(w | v) = (n(v w) + BACKOFF P(w)) / (n(v .) +
    BACKOFF), P(w) = (n(w) + UNIFORM / V) / (n + UNIFORM). The target model counts the rows whose ``target`` is true, the
    background model all others; both share the V distinct words of all rows. So that they are matched, the background's counts are
    scaled to as many words as the target has: smoothing then weighs the same in both, and no text is left out. Without target rows,
    or without others, the models differ in nothing or in smoothing alone. The counts never meet in one place: each chunk of texts
    gets those of its own words and pairs.

    A text without words (null, empty) has null losses; a null ``target`` is false; a null id is kept. Repeated rows count each time
    and give repeated results; an empty table gives an empty one. Long texts are read whole, each in a chunk of its own.
    Other columns aren't read.
    """
    chunks = _chunks(docs, id_col, text, target)
    parts = max(1, -(-(chunks.agg(F.sum("size").alias("n")).first()["n"] or 0) // GROUP))
    totals = materialize(_totals(chunks, parts))
    width = fan_of(parts)[1]
    sums = totals.agg(*[F.sum(c).alias(c) for c in ("distinct", "total", "target_total")]).first()
    vocabulary = max(1, sums["distinct"] or 0)
    n_target = sums["target_total"] or 0
    n_other = (sums["total"] or 0) - n_target
    # without a target the background keeps its own size
    scale = n_target / n_other if n_other and n_target else 1.0
    names = [id_col, *_RESULT]
    schema = docs.select(id_col, *[F.lit(None).cast(t).alias(n) for n, t in zip(_RESULT, ("long", "double", "double", "double"), strict=True)]).schema

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {n: b.column(n)[i].as_py() for n in ("ends", "data", "part", *_COUNTS)}
                g = _Grams(row)
                counts = np.zeros((len(_COUNTS), len(g.key)))
                received = {part: k for k, part in enumerate(row["part"] or [])}
                for part, w, p in _slices(g.key, g.words, parts, width):
                    for c, name in zip(counts, _COUNTS, strict=True):
                        x = _unpack(row[name][received[part]])
                        c[w] = x[: w.stop - w.start]
                        if "before" not in name:
                            c[p] = x[w.stop - w.start :]
                seen, before, target_seen, target_before = counts
                losses = []
                for n, v, total in ((target_seen, target_before, n_target), (scale * (seen - target_seen), scale * (before - target_before), scale * n_other)):
                    p = (n[g.word] + UNIFORM / vocabulary) / (total + UNIFORM)
                    loss = np.log(v[g.before] + BACKOFF) - np.log(n[g.pair] + BACKOFF * p)
                    losses.append(np.bincount(g.doc, loss, len(g.n_words)) / np.maximum(g.n_words, 1))
                t, a = losses
                none = g.n_words == 0
                ids = b.column("ids").slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays([ids, pa.array(g.n_words.astype(np.int64)), *[pa.array(x, mask=none) for x in (t, a, t - a)]], names)

    answers = gathered(totals, "part", *_COUNTS)
    return chunks.select("chunk", "ids", "ends", "data").join(answers.hint("merge"), "chunk", "left").mapInArrow(finish, schema)
