"""Fill-in-middle transformation on ropes.

A text becomes a rope: a balanced tree over slices of its UTF-8 bytes whose nodes cache how many units and code points they hold.
It is split at two unit ranks and the three subtrees are put together anew between sentinels; no text is copied until the
new rope is written out. The inverse splits the new rope at the sentinels' code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of a hundred texts so many stay plain, and of a hundred others so many have the suffix first.
PLAIN_OF_100, SUFFIX_FIRST_OF_100 = 10, 20
SEED = 1

#: Bytes of a leaf.
LEAF = 4096

_PLAN = "n long, form string, prefix_chars long, middle_chars long, output string"


# ---- ropes --------------------------------------------------------------------------------------


@dataclass(frozen=True, slots=True)
class Leaf:
    """A slice of a text. ``inside``: its first code point continues the letters before it, so it begins no unit."""

    data: memoryview
    units: int
    chars: int
    inside: bool = False


@dataclass(frozen=True, slots=True)
class Node:
    left: Rope
    right: Rope
    units: int
    chars: int


Rope = Leaf | Node
EMPTY = Leaf(memoryview(b""), 0, 0)

_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True


def _starts(data: memoryview, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where code points and units begin: a unit is a run of ASCII letters or one other code point."""
    b = np.frombuffer(data, np.uint8)
    chars = (b & 0xC0) != 0x80
    letter = _LETTER[b]
    units = chars.copy()
    units[1:] &= ~(letter[1:] & letter[:-1])
    if inside and len(b):
        units[0] = False
    return chars, units


def join(a: Rope, b: Rope) -> Rope:
    if not a.chars:
        return b
    return Node(a, b, a.units + b.units, a.chars + b.chars) if b.chars else a


def rope(data: bytes | memoryview) -> Rope:
    """A balanced tree over leaves of ``LEAF`` bytes, cut between code points."""
    data = memoryview(data)
    if not len(data):
        return EMPTY
    chars, units = _starts(data, False)
    cuts = [0]
    while cuts[-1] + LEAF < len(data):
        at = cuts[-1] + LEAF
        while not chars[at]:
            at -= 1
        cuts.append(at)
    n_chars, n_units = (np.add.reduceat(x, cuts, dtype=np.int64).tolist() for x in (chars, units))
    level: list[Rope] = [Leaf(data[a:b], u, c, not bool(units[a])) for a, b, u, c in zip(cuts, [*cuts[1:], len(data)], n_units, n_chars, strict=True)]
    while len(level) > 1:
        level = [join(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def split(tree: Rope, rank: int, by: str = "units") -> tuple[Rope, Rope]:
    """Everything before the start of the unit (or code point: ``by="chars"``) with this rank, counted from 0, and the rest."""
    if rank <= 0:
        return EMPTY, tree
    if rank >= getattr(tree, by):
        return tree, EMPTY
    before: list[Rope] = []
    after: list[Rope] = []
    while isinstance(tree, Node):
        own = getattr(tree.left, by)
        # at the seam both go on to the right: letters that continue the left side's last unit stay with it
        if rank < own:
            after.append(tree.right)
            tree = tree.left
        else:
            before.append(tree.left)
            tree, rank = tree.right, rank - own
    chars, units = _starts(tree.data, tree.inside)
    at = int(np.flatnonzero(units if by == "units" else chars)[rank])
    left, right = EMPTY, tree
    if at:
        left = Leaf(tree.data[:at], int(units[:at].sum()), int(chars[:at].sum()), tree.inside)
        right = Leaf(tree.data[at:], int(units[at:].sum()), int(chars[at:].sum()), not bool(units[at]))
    for x in reversed(before):
        left = join(x, left)
    for x in reversed(after):
        right = join(right, x)
    return left, right


def leaves(tree: Rope) -> Iterator[memoryview]:
    stack = [tree]
    while stack:
        top = stack.pop()
        if isinstance(top, Node):
            stack += [top.right, top.left]
        else:
            yield top.data


def written(tree: Rope) -> bytes:
    return b"".join(leaves(tree))


def find(data: bytes, mark: bytes) -> int:
    """Rank of the code point at which ``mark`` first stands."""
    at = data.find(mark)
    return at if at < 0 else int(((np.frombuffer(data, np.uint8)[:at] & 0xC0) != 0x80).sum())


# ---- the transformation and its inverse ---------------------------------------------------------

_P, _S, _M = (rope(x) for x in (PREFIX, SUFFIX, MIDDLE))


def rearranged(tree: Rope, one: int, two: int, suffix_first: bool) -> tuple[Rope, int, int]:
    """The new rope, and the code points of prefix and middle: the prefix ends after ``one`` units, the middle after ``two``."""
    prefix, rest = split(tree, one)
    middle, suffix = split(rest, two - one)
    parts = [_S, suffix, _P, prefix, _M, middle] if suffix_first else [_P, prefix, _S, suffix, _M, middle]
    out = EMPTY
    for part in parts:
        out = join(out, part)
    return out, prefix.chars, middle.chars


def restored(data: bytes, suffix_first: bool) -> Rope:
    """The text before ``rearranged``. No sentinel occurs in it, and none can arise earlier across a seam, so the first of each is the one."""
    tree, marks = rope(data), (SUFFIX, PREFIX, MIDDLE) if suffix_first else (PREFIX, SUFFIX, MIDDLE)
    _, second, third = (find(data, m) for m in marks)
    size = len(PREFIX)
    rest, c = split(tree, third, "chars")
    a, b = split(rest, second, "chars")
    a, b, c = (split(x, size, "chars")[1] for x in (a, b, c))
    return join(join(b, c), a) if suffix_first else join(join(a, c), b)


def _transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (text, h1, h2, h3, h4, the other columns): the other columns with form, counts and output."""
    for b in small(batches):
        out: list[tuple] = []
        for text, h1, h2, h3, h4 in zip(b.column(0), *(b.column(i).to_pylist() for i in range(1, 5)), strict=True):
            data = text.as_buffer() if text.is_valid else b""
            tree, raw = rope(data), bytes(data)
            if not raw or h3 % 100 >= 100 - PLAIN_OF_100 or any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)):
                out.append((tree.units, "plain", None, None, raw))
                continue
            one, two = sorted((h1 % (tree.units + 1), h2 % (tree.units + 1)))
            last = h4 % 100 < SUFFIX_FIRST_OF_100
            new, p, m = rearranged(tree, one, two, last)
            out.append((tree.units, "spm" if last else "psm", p, m, written(new)))
        own = zip(*out, strict=True)
        made = [pa.array(list(x), t) for x, t in zip(own, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
        made[-1] = made[-1].cast(pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns[5:], *made], [*b.schema.names[5:], "n", "form", "prefix_chars", "middle_chars", "output"])


def _hashes(id_col: str, seed: int) -> list[Column]:
    """The first four 32-bit numbers of sha256("seed:id"); a null id counts as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"__rp_h{i}") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): each text cut at two unit ranks drawn from its id, and put together anew.

    A null text is taken as empty. Empty texts, texts that hold a sentinel, and one in ten of the others stay plain, with null counts.
    A null id is drawn as an id without digits. Equal ids are cut at ranks from the same numbers; repeated rows give repeated results, an
    empty table an empty one. A text of any length is taken whole, in the memory of a few copies of it. Other columns aren't read.
    Rows are transformed where they are; nothing is shuffled.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("__rp_text"), *_hashes(id_col, seed), F.col(id_col).alias("__rp_id"))
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    out = rows.mapInArrow(_transformed, f"__rp_id {kind}, {_PLAN}")
    return out.select(F.col("__rp_id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", "output")


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` (with output and form as of ``fill_in_middle``) with ``restored``: the texts that they were made of, from these two alone.

    Plain outputs are the texts themselves; a null output gives a null text. A column named ``restored`` is replaced.
    """
    names = [c for c in outputs.columns if c not in ("output", "restored")]

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("form") + 1
        for b in small(batches):
            texts = []
            for text, form in zip(b.column(0), b.column(at).to_pylist(), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else None
                texts.append(data if data is None or form not in ("psm", "spm") else written(restored(data, form == "spm")))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*b.schema.names, "restored"])

    own = outputs.select("output", *[F.col(f"`{c}`") for c in names])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return own.mapInArrow(back, f"{fields}, restored string").select(*[F.col(f"`{c}`") for c in outputs.columns if c != "restored"], "restored")
