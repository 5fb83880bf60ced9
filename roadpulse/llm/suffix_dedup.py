"""Removal of repeated byte strings by a distributed merge sort of suffixes that is aware of common prefixes.

The suffixes sorted are a sparse set that no repeat escapes: in each string of 50 bytes the run of 30 bytes with the
least hash is its anchor, so equal strings have equal anchors. Anchors that one document alone has can't
lie in a repeat and are left out. Chunks sort the suffixes at their anchors (50 bytes, then the 20 bytes before the
anchor, read backwards) into runs, front-code them and exchange them by ranges; loser trees merge
the runs, comparing two suffixes only beyond the prefix they are known to share, and give the array of common
prefixes of the whole range. From that array follows which strings around an anchor repeat: those whose right
part lies in one interval of common prefixes, and whose left part does likewise.

An anchor with RANGE suffixes or more (a line that very many documents share, with other text around it in each) would be one
group however large. Its suffixes are sent as their strings instead, up to 21 each: a suffix that stands for one string
alone, known once per run with its smallest id. These are dealt by hash of the whole string, merged by the same trees, and equal
neighbours of the merged array are one string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, mix, share
from .textchunks import Chunk, RunHash, batch, distinct_chunks, exchange, for_all_rows, gathered, group_starts, is_in, parts_for, rows_of, shared_hashes, squeeze, unpack48, unsqueeze

LENGTH = 50
ANCHOR = 30
LEFT = LENGTH - ANCHOR
#: A suffix: LENGTH bytes, LEFT bytes backwards, and the range of strings that have this anchor (each + 1).
WIDTH = LENGTH + LEFT + 2
#: Suffixes aimed at in a range; most ranges (each has a boundary that all tasks know); suffixes of a run for one in the sample.
RANGE = 200_000
MOST_RANGES = 4096
#: Most anchors whose suffixes are dealt as strings; all tasks know them (30 bytes and two numbers each).
MOST_HOT = 1 << 22
SAMPLED = 64
#: Suffixes with hot anchors whose strings are made together.
STRINGS_OF = 1 << 15
#: Runs that one set of loser trees merges, and its trees times runs.
FAN_IN = 8
TREES = 1 << 19

#: Bytes whose anchors are found together, and bits for a place among them.
_SEGMENT = 1 << 20
_PLACE = 21


# ---- anchors -----------------------------------------------------------------------------------


def _least(v: np.ndarray, n: int) -> np.ndarray:
    """Least of each n numbers in a row."""
    width = 1
    while width * 2 <= n:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    return np.minimum(v[: len(v) - (n - width)], v[n - width :]) if n > width else v


class Anchors:
    """The anchors of a chunk: place, hash, document, and the strings they stand for, which start from ``low`` to ``high`` bytes before."""

    def __init__(self, c: Chunk):
        found = []
        for base in range(0, max(len(c.data) - LENGTH + 1, 0), _SEGMENT):
            piece = c.data[base : base + _SEGMENT + LENGTH - 1]
            h = RunHash(piece)(slice(0, len(piece) - ANCHOR + 1), slice(ANCHOR, len(piece) + 1))
            # by hash, the leftmost of equal ones
            key = (h >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(h), dtype=np.uint64)
            least = (_least(key, LEFT + 1) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
            start = np.arange(len(least))
            doc = c.doc_of(base + start)
            inside = base + start + LENGTH <= c.ends[np.minimum(doc, len(c.ends) - 1)]
            start, least, doc = start[inside], least[inside], doc[inside]
            g = group_starts(least)
            if len(g):
                last = np.r_[g[1:], len(least)] - 1
                at = least[g]
                found.append((base + at, h[at], doc[g], at - start[last], at - start[g]))
        if found:
            self.at, self.hash, self.doc, self.low, self.high = (np.concatenate(x) for x in zip(*found, strict=True))
        else:
            self.at, self.hash, self.doc, self.low, self.high = np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3

    def take(self, mask: np.ndarray) -> Anchors:
        for name in ("at", "hash", "doc", "low", "high"):
            setattr(self, name, getattr(self, name)[mask])
        return self


def _cut(h: np.ndarray) -> np.ndarray:
    return h >> np.uint64(16)


def _suffixes(c: Chunk, a: Anchors) -> np.ndarray:
    """A row of WIDTH bytes for each anchor."""
    padded = np.concatenate([np.zeros(LEFT, np.uint8), c.data, np.zeros(LENGTH, np.uint8)])
    out = np.zeros((len(a.at), WIDTH), np.uint8)
    view = np.lib.stride_tricks.sliding_window_view
    out[:, :LENGTH] = view(padded, LENGTH)[a.at + LEFT]
    out[:, LENGTH : LENGTH + LEFT] = view(padded, LEFT)[a.at][:, ::-1]
    # bytes that none of the strings has don't count
    place = np.arange(LENGTH)
    out[:, :LENGTH][place >= (LENGTH - a.low)[:, None]] = 0
    out[:, LENGTH : LENGTH + LEFT][place[:LEFT] >= a.high[:, None]] = 0
    out[:, -2], out[:, -1] = a.low + 1, a.high + 1
    return out


# ---- sorted runs -------------------------------------------------------------------------------


def _as_words(s: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian numbers, which compare like the bytes."""
    wide = np.zeros((len(s), -(-s.shape[1] // 8) * 8), np.uint8)
    wide[:, : s.shape[1]] = s
    return wide.view(">u8").astype(np.uint64)


def _first_difference(x: np.ndarray) -> np.ndarray:
    """Leading zero bytes of numbers that aren't 0."""
    # the exponent of a float gives the highest bit; with the bit below it cleared no rounding carries beyond it
    highest = ((x & ~(x >> np.uint64(1))).astype(np.float64).view(np.int64) >> 52) - 1023
    return (63 - highest) >> 3


def compare(words: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether words[a] <= words[b], and their common prefix in bytes; the first ``known`` bytes are equal and are not read again."""
    width = words.shape[1]
    flat = words.reshape(-1)
    less, common = np.ones(len(a), bool), np.full(len(a), width * 8)
    open_ = (known < width * 8).nonzero()[0]
    known = known[open_]
    d = known >> 3
    one, two = a[open_] * width + d, b[open_] * width + d
    unread = np.uint64(0xFFFFFFFFFFFFFFFF) >> ((known & 7) << 3).astype(np.uint64)  # known bytes at the head of a number
    x, y = flat.take(one) & unread, flat.take(two) & unread
    differ = x != y
    less[open_] = x <= y
    hit = differ.nonzero()[0]
    common[open_[hit]] = d[hit] * 8 + _first_difference((x ^ y)[hit])
    on = (~differ & (d + 1 < width)).nonzero()[0]
    if len(on):  # the rest of the few that agree so far, at once
        open_, d = open_[on], d[on] + 1
        ahead = np.minimum(np.arange(width - int(d.min())), (width - 1 - d)[:, None])
        x, y = flat.take(ahead + (one[on] + 1)[:, None]), flat.take(ahead + (two[on] + 1)[:, None])
        place = (x != y).argmax(1)
        row = np.arange(len(on))
        x, y = x[row, place], y[row, place]
        hit = (x != y).nonzero()[0]
        less[open_] = x <= y
        common[open_[hit]] = (d + place)[hit] * 8 + _first_difference((x ^ y)[hit])
    return less, common


def common_prefixes(words: np.ndarray) -> np.ndarray:
    """Of each row with the row before; 0 for the first."""
    n = len(words)
    out = np.zeros(n, np.int64)
    if n > 1:
        at = np.arange(1, n)
        out[1:] = compare(words, at - 1, at, np.zeros(n - 1, np.int64))[1]
    return np.minimum(out, WIDTH)


def front_code(s: np.ndarray, common: np.ndarray) -> bytes:
    """Sorted rows, each without the prefix it shares with the row before."""
    tails = s[np.arange(WIDTH) >= common[:, None]]
    return squeeze(np.concatenate([common.astype(np.uint8), tails]))


def front_decode(b: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and their common prefixes."""
    raw = unsqueeze(b, np.uint8)
    common = raw[:n].astype(np.int64)
    tails = raw[n:]
    at = np.cumsum(np.r_[0, WIDTH - common])[:-1] - common
    out = np.empty((n, WIDTH), np.uint8)
    row = np.arange(n)
    for c in range(WIDTH):
        own = np.maximum.accumulate(np.where(common <= c, row, 0))
        out[:, c] = tails[at[own] + c]
    return out, common


def _keys(s: np.ndarray) -> np.ndarray:
    """Rows as strings that numpy sorts and searches."""
    return np.ascontiguousarray(s).view(f"S{WIDTH}").reshape(-1)


# ---- loser trees -------------------------------------------------------------------------------


def merge_runs(words: np.ndarray, s: np.ndarray, common: np.ndarray, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Order, and common prefixes in that order, of runs that lie one after the other and end at ``ends``.

    Many small loser trees work in step, each on its own range of suffixes: one step gives the next suffix of every tree. A
    node keeps the run that lost there with the prefix it shares with the winner. A suffix that comes up shares
    a known prefix with the one just given out; at each node the longer such prefix wins without a look at
    the suffixes, and equal ones are compared beyond it.
    """
    runs = len(ends)
    n = ends[-1] if ends else 0
    starts = [0, *ends[:-1]]
    if runs < 2:
        return np.arange(n), common
    leaves = 1 << (runs - 1).bit_length()
    keys = _keys(s)
    trees = int(max(1, min(TREES // leaves, n // (4 * leaves) + 1)))
    step = max(1, n // (8 * trees))
    sample = np.sort(np.concatenate([keys[a:b:step] for a, b in zip(starts, ends, strict=True)]))
    bounds = np.unique(sample[np.linspace(0, len(sample), trees, endpoint=False)[1:].astype(int)]) if trees > 1 else sample[:0]
    trees = len(bounds) + 1
    at, end = np.zeros((trees, leaves), np.int64), np.zeros((trees, leaves), np.int64)
    for r, (a, b) in enumerate(zip(starts, ends, strict=True)):
        cuts = a + np.searchsorted(keys[a:b], bounds) if len(bounds) else np.zeros(0, np.int64)
        at[:, r], end[:, r] = np.r_[a, cuts], np.r_[cuts, b]
    sizes = (end - at).sum(1)
    put = np.cumsum(np.r_[0, sizes])[:-1]
    order, shared = np.empty(n, np.int64), np.empty(n, np.int64)
    live = np.flatnonzero(sizes)
    at, end, put, left = at[live], end[live], put[live], sizes[live]
    firsts = put.copy()

    def play(i: np.ndarray, one: np.ndarray, h1: np.ndarray, two: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
        """Winner and loser of runs with known prefixes (-1: used up) in trees i, with their prefixes: the loser's is with the winner."""
        swap = h2 > h1
        same = np.flatnonzero((h1 == h2) & (h1 >= 0))
        if len(same):
            t = i[same]
            ok, common_ = compare(words, at[t, one[same]], at[t, two[same]], h1[same])
            swap[same] = ~ok
            h1, h2 = h1.copy(), h2.copy()
            h2[same] = np.where(ok, common_, h2[same])
            h1[same] = np.where(ok, h1[same], common_)
        return np.where(swap, two, one), np.where(swap, h2, h1), np.where(swap, one, two), np.where(swap, h1, h2)

    trees = len(live)
    run, known = np.tile(np.arange(leaves), (trees, 1)), np.where(at < end, 0, -1)
    loser, lost = np.zeros((trees, leaves), np.int64), np.zeros((trees, leaves), np.int64)
    width = leaves
    while width > 1:
        width //= 2
        i = np.repeat(np.arange(trees), width)
        w, hw, l, hl = play(i, run[:, ::2].reshape(-1), known[:, ::2].reshape(-1), run[:, 1::2].reshape(-1), known[:, 1::2].reshape(-1))  # noqa: E741
        loser[:, width : 2 * width], lost[:, width : 2 * width] = l.reshape(trees, width), hl.reshape(trees, width)
        run, known = w.reshape(trees, width), hw.reshape(trees, width)
    win, known = run[:, 0], known[:, 0]
    i = np.arange(trees)
    while trees:
        now = at[i, win]
        order[put], shared[put] = now, known
        put += 1
        left -= 1
        at[i, win] += 1
        if not left.all():
            on = left > 0
            at, end, put, left, loser, lost, win, now = (x[on] for x in (at, end, put, left, loser, lost, win, now))
            trees = len(at)
            i = np.arange(trees)
            if not trees:
                break
        h = np.where(at[i, win] < end[i, win], common[np.minimum(now + 1, n - 1)], -1)
        node = (leaves + win) // 2
        while node[0]:
            win, h, l, hl = play(i, win, h, loser[i, node], lost[i, node])  # noqa: E741
            loser[i, node], lost[i, node] = l, hl
            node //= 2
        known = h
    after = firsts[firsts > 0]
    if len(after):  # where one tree's range follows another's
        shared[after] = compare(words, order[after - 1], order[after], np.zeros(len(after), np.int64))[1]
    return order, np.minimum(shared, WIDTH)


def _merged(s: np.ndarray, common: np.ndarray, ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes of all runs, FAN_IN at a time."""
    words = _as_words(s)
    place = np.arange(len(s))
    while len(ends) > 1:
        pieces, start, new_ends = [], 0, []
        for k in range(0, len(ends), FAN_IN):
            some = ends[k : k + FAN_IN]
            part = slice(start, some[-1])
            o, h = merge_runs(words[part], s[part], common[part], [e - start for e in some])
            pieces.append((o + start, h))
            start = some[-1]
            new_ends.append(start)
        o, common = (np.concatenate(x) for x in zip(*pieces, strict=True))
        place, words, s, ends = place[o], words[o], s[o], new_ends
    return place, common


def repeats(s: np.ndarray, common: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each sorted suffix the set (bit by bit) of strings, by how far before the anchor they start, that a smaller id has too."""
    low, high = s[:, -2].astype(np.int64) - 1, s[:, -1].astype(np.int64) - 1
    before = np.ascontiguousarray(s[:, LENGTH : LENGTH + LEFT])
    by_left = np.argsort(before.view(f"S{LEFT}").reshape(-1), kind="stable")
    left_common = np.zeros(len(s), np.int64)
    if len(s) > 1:
        w = _as_words(before[by_left])
        left_common[1:] = compare(w, np.arange(len(s) - 1), np.arange(1, len(s)), np.zeros(len(s) - 1, np.int64))[1]
    mask = np.zeros(len(s), np.uint32)
    left = np.empty(len(s), np.int64)
    for j in range(LEFT + 1):
        right = np.cumsum(common < LENGTH - j)
        alone = np.bincount(right)[right] < 2
        sel = np.flatnonzero((low <= j) & (j <= high) & ~alone)
        if not len(sel):
            continue
        left[by_left] = np.cumsum(left_common < j) if j else 0
        key = right[sel] << 32 | left[sel]
        order = np.argsort(key, kind="stable")
        g = group_starts(key[order])
        least = np.empty(len(sel), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(ids[sel][order], g), np.diff(np.r_[g, len(sel)]))
        mask[sel[least < ids[sel]]] |= np.uint32(1 << j)
    return mask


def strings_of(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings of each suffix as suffixes that stand for one string alone, so that equal strings are equal rows, and whose they are."""
    low, high = s[:, -2].astype(np.int64) - 1, s[:, -1].astype(np.int64) - 1
    n = high - low + 1
    own = np.repeat(np.arange(len(s)), n)
    j = np.arange(len(own)) - (np.cumsum(n) - n)[own] + low[own]
    out = s[own]
    place = np.arange(LENGTH)
    out[:, :LENGTH][place >= (LENGTH - j)[:, None]] = 0
    out[:, LENGTH : LENGTH + LEFT][place[:LEFT] >= j[:, None]] = 0
    out[:, -2] = out[:, -1] = j + 1
    return out, own


# ---- the exchange ------------------------------------------------------------------------------

_RUN = "chunk long, n long, coded binary, least binary, sample binary, at binary, entry binary, low binary, high binary"


def _runs(chunks: DataFrame) -> DataFrame:
    """A sorted run for each chunk with anchors that another document has too, and where its members stand."""

    def emit(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = Anchors(c)
        return _cut(a.hash), a.doc, np.ones(len(a.at), bool)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            c = Chunk(row)
            a = Anchors(c)
            a.take(is_in(_cut(a.hash), [unpack48(x) for x in row["hits"]]))
            s = _suffixes(c, a)
            order = np.argsort(_keys(s), kind="stable")
            s = s[order]
            common = common_prefixes(_as_words(s))
            new = common < WIDTH  # equal suffixes of a chunk travel once, with their smallest id
            if not len(new):
                continue
            new[0] = True
            g = np.flatnonzero(new)
            ids = c.ids[a.doc[order]]
            entry = np.empty(len(order), np.int64)
            entry[order] = np.cumsum(new) - 1
            arrays = (np.minimum.reduceat(ids, g), s[g][c.chunk % SAMPLED :: SAMPLED], a.at.astype("<u4") if len(c.data) < 1 << 32 else a.at, entry.astype("<u4"), a.low.astype(np.uint8), a.high.astype(np.uint8))
            wide = arrays[2].dtype.itemsize == 8
            out = [c.chunk, len(g), front_code(s[g], common[g]), *[squeeze(x) for x in arrays]]
            out[5] = (b"8" if wide else b"4") + out[5]
            yield batch([f.split()[0] for f in _RUN.split(", ")], [tuple(out)], [pa.int64(), pa.int64(), *[pa.binary()] * 7])

    hits = gathered(shared_hashes(chunks, emit, parts_for(chunks)), "hits")
    return materialize(chunks.drop("keys").withColumn("keys", F.lit(b"")).join(hits, "chunk").mapInArrow(sort, _RUN))


def _anchors(s: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(s[:, :ANCHOR]).view(f"S{ANCHOR}").reshape(-1)


def _spread(s: np.ndarray) -> np.ndarray:
    """A hash of each row."""
    words = _as_words(s)
    h = np.zeros(len(s), np.uint64)
    for i in range(words.shape[1]):
        h = mix(h ^ words[:, i])
    return h


def _hot_anchors(runs: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors with about RANGE suffixes or more, sorted, and into how many parts the strings of each are split.

    Counted by Spark in the runs' samples. So that there are at most about MOST_HOT of them, they need more suffixes where ``total`` is over
    MOST_HOT * RANGE (some two million at a hundred terabytes of text, which is still one group).
    """
    least = max(RANGE, -(-total // MOST_HOT))
    if total < least:
        return np.zeros(0, f"S{ANCHOR}"), np.zeros(0, np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            anchor, n = np.unique(_anchors(unsqueeze(row["sample"], np.uint8).reshape(-1, WIDTH)), return_counts=True)
            yield batch(["anchor", "n"], list(zip(anchor.tolist(), n.tolist(), strict=True)), [pa.binary(), pa.int64()])

    counts = runs.select("sample").mapInArrow(count, "anchor binary, n long").groupBy("anchor").agg((F.sum("n") * SAMPLED).alias("n"))
    found = counts.filter(F.col("n") >= least).orderBy("anchor").toArrow()
    n = found.column("n").to_numpy()
    return np.array(found.column("anchor").to_pylist(), f"S{ANCHOR}"), -(-n * (LEFT + 1) // RANGE)


def _boundaries(runs: DataFrame, total: int) -> tuple[np.ndarray, int]:
    """Boundaries of ranges of about RANGE suffixes, at most MOST_RANGES of them, and into how many parts each is split by hash beyond that.

    From a sample of about 40 suffixes for each range.
    """
    ranges = max(1, min(MOST_RANGES, -(-total // RANGE)))
    if ranges == 1:
        return np.zeros(0, f"S{WIDTH}"), max(1, -(-total // (ranges * RANGE)))
    share = min(1.0, 40 * ranges * SAMPLED / total)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            x = unsqueeze(row["sample"], np.uint8).reshape(-1, WIDTH)
            rng = np.random.default_rng(row["chunk"])
            x = x[rng.random(len(x)) < share]
            yield batch(["s"], [(r.tobytes(),) for r in x], [pa.binary()])

    drawn = runs.select("chunk", "sample").mapInArrow(draw, "s binary").toArrow().column("s").to_pylist()
    s = np.sort(_keys(np.frombuffer(b"".join(drawn), np.uint8).reshape(-1, WIDTH))) if drawn else np.zeros(0, f"S{WIDTH}")
    bounds = s[np.linspace(0, len(s), ranges, endpoint=False)[1:].astype(int)] if len(s) else s
    # a boundary is cut after the anchor, so that suffixes with one anchor stay together
    short = np.unique(np.array([x[:ANCHOR] for x in bounds.tolist()], f"S{WIDTH}"))
    return short, max(1, -(-total // (ranges * RANGE)))


def _marks(runs: DataFrame) -> DataFrame:
    """(chunk, entries, masks): the strings of each run that a smaller id has in any run."""
    total = runs.agg(F.sum("n").alias("n")).first()["n"] or 0
    bounds, salts = _boundaries(runs, total)
    hot, parts = _hot_anchors(runs, total)
    ordinary = (len(bounds) + 1) * salts
    firsts = ordinary + np.cumsum(parts) - parts
    groups = ordinary + int(parts.sum())
    shared = share(runs.sparkSession, (bounds, hot, firsts, parts))  # at most MOST_RANGES suffixes and about MOST_HOT anchors

    names = ["part", "chunk", "n", "coded", "least", "entries", "owners", "own_least", "ranges"]
    types = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 6]

    def send_strings(chunk: int, s: np.ndarray, least: np.ndarray, entries: np.ndarray, place: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
        """The strings of suffixes with hot anchors, each once with its smallest id and with the suffixes it is in."""
        _, _, firsts, parts = shared()
        rows, own = strings_of(s)
        order = np.argsort(_keys(rows), kind="stable")
        rows, own = rows[order], own[order]
        new = common_prefixes(_as_words(rows)) < WIDTH
        new[0] = True
        g = np.flatnonzero(new)
        rows, at, ids = rows[g], place[own[g]], np.minimum.reduceat(least[own], g)
        ranges = firsts[at] + (_spread(rows) % parts[at].astype(np.uint64)).astype(np.int64)
        order = np.argsort(ranges // width, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        rows, ids, ranges = rows[order], ids[order], ranges[order]
        of = rank[np.cumsum(new) - 1]
        by_row = np.argsort(of, kind="stable")
        own, owners = own[by_row], np.bincount(of, minlength=len(rows))
        yield from deal(chunk, rows, common_prefixes(_as_words(rows)), ids, ranges, entries, width, own, owners, least)

    def deal(chunk: int, s: np.ndarray, common: np.ndarray, least: np.ndarray, ranges: np.ndarray, entries: np.ndarray, width: int, own: np.ndarray | None = None, owners: np.ndarray | None = None, own_least: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """Rows for each ``width`` ranges, by which ``s`` is sorted first. Of strings: ``owners`` gives how many suffixes each is in, ``own`` which."""
        part = ranges // width
        ends = np.r_[0, np.cumsum(owners)] if owners is not None else None
        cuts = group_starts(part)
        for a, b in zip(cuts, np.r_[cuts[1:], len(s)], strict=True):
            common[a] = 0
            mine = own[ends[a] : ends[b]] if owners is not None else slice(a, b)
            of_string = (squeeze(owners[a:b].astype("<u4")), squeeze(own_least[mine])) if owners is not None else (None, None)
            inner = squeeze(ranges[a:b].astype("<i4")) if width > 1 else None
            yield batch(names, [(int(part[a]), chunk, int(b - a), front_code(s[a:b], common[a:b]), squeeze(least[a:b]), squeeze(entries[mine].astype("<u4")), *of_string, inner)], types)

    def send(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
        bounds, hot, _, _ = shared()
        for row in rows_of(batches):
            s, common = front_decode(row["coded"], row["n"])
            least = unsqueeze(row["least"], "<i8")
            entries = np.arange(len(s))
            if len(hot):
                anchors = _anchors(s)
                at = np.minimum(np.searchsorted(hot, anchors), len(hot) - 1)
                is_hot = hot[at] == anchors
                some = np.flatnonzero(is_hot)
                for a in range(0, len(some), STRINGS_OF):
                    i = some[a : a + STRINGS_OF]
                    yield from send_strings(row["chunk"], s[i], least[i], i, at[i], width)
                if len(some):
                    entries = np.flatnonzero(~is_hot)
                    if not len(entries):
                        continue
                    s, least = s[entries], least[entries]
                    common = common_prefixes(_as_words(s))
            place = np.searchsorted(bounds, _keys(s), side="right")
            if salts > 1:
                place = place * salts + (_spread(s[:, :ANCHOR]) % np.uint64(salts)).astype(np.int64)
                order = np.argsort(place // width, kind="stable")
                s, least, place, entries = s[order], least[order], place[order], entries[order]
                common = common_prefixes(_as_words(s))
            yield from deal(row["chunk"], s, common, least, place, entries, width)

    def kinds(t: pa.Table) -> Iterator[tuple[bool, list[dict], np.ndarray, np.ndarray, list[int], np.ndarray, np.ndarray]]:
        """The suffixes, then the strings, of some rows: are they strings, rows, suffixes, ids, where rows end, sorted order and prefixes in common."""
        all_rows = t.to_pylist()
        for of_string in (False, True):
            rows = [r for r in all_rows if (r["owners"] is not None) == of_string]
            if rows:
                decoded = [front_decode(r["coded"], r["n"]) for r in rows]
                s, common = np.concatenate([x[0] for x in decoded]), np.concatenate([x[1] for x in decoded])
                del decoded
                ids = np.concatenate([unsqueeze(r["least"], "<i8") for r in rows])
                ends = np.cumsum([r["n"] for r in rows]).tolist()
                yield of_string, rows, s, ids, ends, *_merged(s, common, ends)

    def merge(t: pa.Table, group: int, width: int) -> pa.Table:
        """Equal suffixes of a group go on once, with their smallest id; entries are numbered in sorted order, suffixes first."""
        out, before = [], 0
        for of_string, rows, s, ids, _, place, shared_prefix in kinds(t):
            starts = np.flatnonzero(np.r_[True, shared_prefix[1:] < WIDTH])
            least = np.minimum.reduceat(ids[place], starts)
            ranges = np.concatenate([unsqueeze(r["ranges"], "<i4") for r in rows])[place[starts]].astype(np.int64)
            s, common, entries = s[place[starts]], shared_prefix[starts], before + np.arange(len(starts))
            before += len(starts)
            order = np.argsort(ranges // width, kind="stable")
            if (order[1:] < order[:-1]).any():
                s, least, ranges, entries = s[order], least[order], ranges[order], entries[order]
                common = common_prefixes(_as_words(s))
            alone = (np.arange(len(s)), np.ones(len(s), np.int64), least) if of_string else ()
            out += deal(group, s, common, least, ranges, entries, width, *alone)
        return pa.Table.from_batches(out).combine_chunks()

    def meet(t: pa.Table, answers: pa.Table | None, width: int) -> pa.Table:
        if answers is not None:
            entries = np.concatenate([np.zeros(0, "<u4"), *[unsqueeze(x, "<u4") for x in answers.column("entries").to_pylist()]])
            known_masks = np.concatenate([np.zeros(0, np.uint32), *[unsqueeze(x, np.uint32) for x in answers.column("masks").to_pylist()]])
        out, before = [], 0
        for of_string, rows, s, ids, ends, place, shared_prefix in kinds(t):
            starts = np.flatnonzero(np.r_[True, shared_prefix[1:] < WIDTH])
            smallest = np.empty(len(s), np.int64)
            smallest[place] = np.repeat(np.minimum.reduceat(ids[place], starts), np.diff(np.r_[starts, len(s)]))
            own = np.uint32(1) << (s[:, -2].astype(np.uint32) - np.uint32(1))
            if answers is None and not of_string:
                mask = np.empty(len(s), np.uint32)
                mask[place] = repeats(s[place], shared_prefix, ids[place])
            elif answers is None:
                mask = np.zeros(len(s), np.uint32)
            else:
                # what other groups have of each entry that went on, and all strings of a suffix that a smaller id has here
                found = np.zeros(before + len(starts), np.uint32)
                mine = (entries >= before) & (entries < before + len(starts))
                found[entries[mine]] = known_masks[mine]
                mask = np.empty(len(s), np.uint32)
                mask[place] = np.repeat(found[before:], np.diff(np.r_[starts, len(s)]))
                if not of_string:
                    every = (np.uint32(1) << s[:, -1].astype(np.uint32)) - own
                    mask |= np.where(smallest < ids, every, 0).astype(np.uint32)
            before += len(starts)
            for r, a, b in zip(rows, [0, *ends[:-1]], ends, strict=True):
                of, bits = unsqueeze(r["entries"], "<u4"), mask[a:b]
                if of_string:
                    owners = unsqueeze(r["owners"], "<u4")
                    earlier = (np.repeat(bits, owners) > 0) | (np.repeat(smallest[a:b], owners) < unsqueeze(r["own_least"], "<i8"))
                    bits = np.where(earlier, np.repeat(own[a:b], owners), 0).astype(np.uint32)
                if (some := bits > 0).any():
                    out.append({"chunk": r["chunk"], "entries": squeeze(of[some]), "masks": squeeze(bits[some])})
        return pa.Table.from_pylist(out, pa.schema([("chunk", pa.int64()), ("entries", pa.binary()), ("masks", pa.binary())]))

    row = "part int, chunk long, n long, coded binary, least binary, entries binary, owners binary, own_least binary, ranges binary"
    answers = exchange(runs.select("chunk", "n", "coded", "least"), send, merge, meet, groups, row, "chunk long, entries binary, masks binary")
    return gathered(answers, "entries", "masks")


def _removed(c: Chunk, row: dict) -> np.ndarray:
    """Which bytes of a chunk go."""
    if row["at"] is None:
        return np.zeros(len(c.data), bool)
    at = unsqueeze(row["at"][1:], "<u4" if row["at"][:1] == b"4" else "<i8").astype(np.int64)
    entry, low, high = (unsqueeze(row[k], t).astype(np.int64) for k, t in (("entry", "<u4"), ("low", np.uint8), ("high", np.uint8)))
    least = unsqueeze(row["least"], "<i8")
    mask = np.zeros(len(least), np.uint32)
    for e, m in zip(row["entries"] or [], row["masks"] or [], strict=True):
        np.bitwise_or.at(mask, unsqueeze(e, "<u4"), unsqueeze(m, np.uint32))
    own = mask[entry]
    later = c.ids[c.doc_of(at)] > least[entry]  # a smaller id has the same suffix in this chunk
    starts = [at[(low <= j) & (j <= high) & (later | (own >> np.uint32(j) & 1 > 0))] - j for j in range(LEFT + 1)]
    start = np.concatenate(starts)
    steps = np.bincount(start, minlength=len(c.data) + 1) - np.bincount(start + LENGTH, minlength=len(c.data) + 1)
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True, keep: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, spans, kept_sha256 and, if ``with_text``, kept_text.

    Removed is each byte of the UTF-8 text covered by a string of LENGTH bytes that also starts in a document with a smaller
    id, as the texts are in the input; matches never cross documents. spans: (start, length) of the maximal
    removed runs, in bytes. kept_text: the other bytes; what is left of a character that was cut goes. Null texts are
    empty; a null id stands after all others; rows with one id don't remove each other's bytes; repeated
    rows give repeated results. Other columns aren't read (``keep``: they come along as __rp_own_0, ... in place of the
    id); an empty table gives an empty one. Texts of any length are taken whole.
    """
    chunks = distinct_chunks(docs, id_col, text_col)
    runs = _runs(chunks)
    marks = materialize(_marks(runs))
    schema = "key binary, first_id long, n_bytes long, n_removed long, spans array<struct<start:long,length:long>>, kept_sha256 string" + ", kept_text string" * with_text

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])), pa.string(), pa.string()]
        names = ["key", "first_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept_text"]
        n = len(names) if with_text else len(names) - 1
        for row in rows_of(batches):
            c = Chunk(row)
            gone = _removed(c, row)
            out = []
            for i, (a, b) in enumerate(zip(c.starts, c.ends, strict=True)):
                off = gone[a:b]
                edges = np.flatnonzero(np.diff(np.r_[False, off, False])).reshape(-1, 2)
                kept = c.data[a:b][~off].tobytes() if len(edges) else c.data[a:b].tobytes()
                spans = [{"start": int(x), "length": int(y - x)} for x, y in edges]
                out.append((c.keys[i], int(c.ids[i]), int(b - a), int(off.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if with_text else None))
            for a in range(0, len(out), 500):
                yield batch(names[:n], [r[:n] for r in out[a : a + 500]], types[:n])

    members = runs.select("chunk", "least", "at", "entry", "low", "high").join(marks, "chunk", "left")
    by_text = materialize(chunks.join(members, "chunk", "left").mapInArrow(finish, schema))
    discard(chunks, runs, marks)
    span = F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("length"))
    whole = {"n_removed": F.col("n_bytes"), "spans": F.array(span), "kept_sha256": F.lit(hashlib.sha256(b"").hexdigest())} | ({"kept_text": F.lit("")} if with_text else {})
    return for_all_rows(docs, by_text, id_col, text_col, "n_bytes", LENGTH, whole, keep)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the text that ``remove_repeats`` leaves; rows that lose all of it go. Texts without repeats stay as they are."""
    out = remove_repeats(docs, id_col, text_col, keep=True)
    at = docs.columns.index(text_col)
    own = [F.col(f"__rp_own_{i}") for i in range(len(docs.columns))]
    own[at] = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(own[at])
    return out.filter((F.col("n_removed") == 0) | (F.col("kept_text") != "")).select(*[c.alias(n) for c, n in zip(own, docs.columns, strict=True)])
