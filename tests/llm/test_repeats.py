"""Removal of repeats, by words and by bytes, against plain loops over all windows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import substring_dedup, suffix_dedup, textchunks

SCHEMA = "doc_id long, text string, size long, `key` string, hits int"


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Fresh prose, shared passages at any offset, exact and near copies, repeats within a document, odd spaces, ties, nulls."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeiounrst é") for _ in range(rng.randint(1, 6))).strip() or "x"
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(k) for k in (49, 50, 51, 80, 130)]
    out = []
    for i in range(n):
        parts = [prose(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(rng.randint(0, 40))]
        text = rng.choice([" ", "\n", " \t "]).join(parts)
        if out and rng.random() < 0.3:
            text = rng.choice(out)[1] or ""
            if rng.random() < 0.5 and len(text) > 20:
                at = rng.randrange(len(text))
                text = text[:at] + "Z" + text[at + 3 :]
        out.append((i * 7 % n, text))
    out += [(500, None), (501, ""), (502, "  \n "), (503, passages[4]), (503, passages[4]), (504, "ab" * 400), (None, passages[3] + " end"), (505, "same " * 200)]
    return [(i, t, 5, "k", 3) for i, t in out]


def expected(rows, split, join, width):
    docs = [(textchunks.LAST_ID if r[0] is None else r[0], split(r[1] or "")) for r in rows]
    first = {}
    for i, w in docs:
        for k in range(len(w) - width + 1):
            x = join(w[k : k + width])
            first[x] = min(first.get(x, i), i)
    out = []
    for (i, w), r in zip(docs, rows, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[join(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = join([x for x, g in zip(w, gone, strict=True) if not g])
        spans = sum(b and not a for a, b in zip([False, *gone], gone, strict=False))
        out.append((-1 if r[0] is None else r[0], len(w), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def by_words(rows):
    return expected(rows, lambda t: re.findall(r"[^\x20\x09-\x0D]+", t), lambda w: " ".join(w).encode(), 50)


def by_bytes(rows):
    return expected(rows, lambda t: list(t.encode()), bytes, 50)


def collected(df, n):
    cols = [F.coalesce("doc_id", F.lit(-1)), n, "n_removed", F.size("spans"), "kept_sha256"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize(("chunk", "group", "fanout"), [(1000, 3000, 256), (1000, 2500, 5), (1000, 2500, 3), (20_000, 60_000, 256), (3 << 20, 9 << 20, 256)])
def test_words_match_brute_force(spark, monkeypatch, chunk, group, fanout):
    """With few rows to a step the exchange has two or three of them."""
    monkeypatch.setattr(textchunks, "CHUNK", chunk)
    monkeypatch.setattr(textchunks, "GROUP", group)
    monkeypatch.setattr(textchunks, "FANOUT", fanout)
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = substring_dedup.remove_repeats(docs)
    assert collected(out, "n_words") == by_words(rows)
    for r in out.select("kept_text", "kept_sha256").collect():
        assert hashlib.sha256(r[0].encode()).hexdigest() == r[1]


@pytest.mark.parametrize(("chunk", "ranges", "fanout"), [(1000, 50, 256), (1000, 50, 4), (1000, 80, 3), (1000, 4, 256), (20_000, 200, 256), (3 << 20, 400_000, 256)])
def test_bytes_match_brute_force(spark, monkeypatch, chunk, ranges, fanout):
    monkeypatch.setattr(textchunks, "CHUNK", chunk)
    monkeypatch.setattr(textchunks, "FANOUT", fanout)
    monkeypatch.setattr(textchunks, "MOST_TASKS", 64)
    monkeypatch.setattr(textchunks, "GROUP", chunk * 3)
    monkeypatch.setattr(suffix_dedup, "RANGE", ranges)
    monkeypatch.setattr(suffix_dedup, "SAMPLED", 3)
    monkeypatch.setattr(suffix_dedup, "MOST_RANGES", 8)
    monkeypatch.setattr(suffix_dedup, "FAN_IN", 5)
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 700)
    rows = corpus(seed=2)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert collected(suffix_dedup.remove_repeats(docs, with_text=False), "n_bytes") == by_bytes(rows)


@pytest.mark.parametrize(("chunk", "fanout"), [(500, 256), (500, 12), (4000, 256)])
def test_a_line_of_all_documents(spark, monkeypatch, chunk, fanout):
    """A line of 30 to 49 bytes with other text around it in each document: its suffixes are dealt as strings."""
    monkeypatch.setattr(textchunks, "FANOUT", fanout)
    hot = []
    found = suffix_dedup._hot_anchors
    monkeypatch.setattr(suffix_dedup, "_hot_anchors", lambda *a: hot.append(found(*a)) or hot[-1])
    monkeypatch.setattr(textchunks, "CHUNK", chunk)
    monkeypatch.setattr(textchunks, "GROUP", chunk * 3)
    for name, value in (("RANGE", 20), ("SAMPLED", 2), ("MOST_RANGES", 4), ("STRINGS_OF", 7)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(5)
    lines = ["# Licensed under the terms of the notice here", "\0" * 31 + "zero", "a line that many have, of forty-four bytes.."]
    rows = []
    for i in range(120):
        around = ["".join(rng.choice("ab\n") for _ in range(rng.randint(0, 9))) for _ in range(4)]
        text = around[0] + lines[0] + around[1] + (rng.choice(lines) if rng.random() < 0.5 else "") + around[2] + "".join(rng.choice("cdefg") for _ in range(30))
        rows.append((i * 7 % 120 if i % 9 else 3, text, 5, "k", 3))
    rows += [(None, lines[0] + "\n\n\n\n\nb", 5, "k", 3), (500, None, 5, "k", 3)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = by_bytes(rows)
    assert sum(r[2] > 0 for r in want) > 30
    assert collected(suffix_dedup.remove_repeats(docs, with_text=False), "n_bytes") == want
    assert len(hot[0][0]) > 0 and hot[0][1].max() > 1


def test_kept_text_is_what_is_left(spark):
    text = "é" * 40 + " tail"
    docs = spark.createDataFrame([(1, text), (2, "x" + "é" * 40)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got[1]["kept_text"] == text
    assert got[2]["kept_text"] == "x"
    assert [tuple(s) for s in got[2]["spans"]] == [(1, 80)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.remove_repeats(docs).count() == 0
    assert suffix_dedup.remove_repeats(docs).count() == 0


@pytest.mark.parametrize("runs", [2, 3, 9, 40])
def test_loser_trees_merge_sorted_runs(runs):
    rng = np.random.default_rng(runs)
    parts, prefixes = [], []
    for _ in range(runs):
        s = np.zeros((rng.integers(1, 200), suffix_dedup.WIDTH), np.uint8)
        s[:, : suffix_dedup.LENGTH] = rng.integers(97, 99, (len(s), suffix_dedup.LENGTH)) if rng.random() < 0.5 else np.repeat(rng.integers(97, 100, (len(s), 10)), 5, 1)
        s = s[np.argsort(suffix_dedup._keys(s), kind="stable")]
        parts.append(s)
        prefixes.append(suffix_dedup.common_prefixes(suffix_dedup._as_words(s)))
    s, common = np.concatenate(parts), np.concatenate(prefixes)
    ends = np.cumsum([len(p) for p in parts]).tolist()
    order, shared = suffix_dedup.merge_runs(suffix_dedup._as_words(s), s, common, ends)
    keys = suffix_dedup._keys(s)
    assert sorted(order.tolist()) == list(range(len(s)))
    assert (keys[order] == np.sort(keys)).all()
    assert (shared == suffix_dedup.common_prefixes(suffix_dedup._as_words(s[order]))).all()


def test_front_coding_round_trip():
    rng = np.random.default_rng(3)
    s = np.zeros((500, suffix_dedup.WIDTH), np.uint8)
    s[:, :20] = rng.integers(0, 3, (500, 20))
    s = s[np.argsort(suffix_dedup._keys(s))]
    common = suffix_dedup.common_prefixes(suffix_dedup._as_words(s))
    back, again = suffix_dedup.front_decode(suffix_dedup.front_code(s, common), len(s))
    assert (back == s).all() and (again == common).all()


@pytest.mark.parametrize("parts", [1, 2, 255, 256, 257, 4096, 65536, 65537, 10**7, 5 * 10**7])
def test_steps_of_an_exchange(parts):
    """A chunk sends FANOUT rows in a step at most, whatever the number of parts; the steps reach every part."""
    fan, width = textchunks.fan_of(parts)
    assert -(-parts // width) <= fan <= textchunks.FANOUT
    steps = 1
    while width > 1:
        assert width % fan == 0
        width, steps = width // fan, steps + 1
    assert fan**steps >= parts and (fan - 1) ** steps < parts or parts == 1
