"""Fingerprints, fill-in-middle and source divergence against plain loops and SQL."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roadpulse.llm import divergence, fill_in_middle, fingerprint, queries
from roadpulse.llm.common import mix

from ..compare import duck_rows, spark_rows
from .test_operators import in_duck, rows_of_all_kinds, table

SMALL = "/root/testdata/sf0.001"
EMPTY = "doc_id long, text string, lang string, source string"


# ---- fingerprints -------------------------------------------------------------------------------


def plain_levels(data):
    """Level of each window, each counted from nothing."""
    w = fingerprint.WINDOW
    weight = lambda c: round(c * math.log2(c) * 65536)
    return [max((5 * w * 65536 - sum(weight(c) for c in Counter(data[i : i + w]).values())) * 256 // (w * 65536), 0) for i in range(len(data) - w + 1)]


def plain_ranks(texts):
    counts = Counter(level for t in texts for level in plain_levels(t))
    order = sorted(range(fingerprint.LEVELS), key=lambda x: (counts[x], x))
    return {level: (r if level >= 256 else None) for r, level in enumerate(order)}


def plain_features(data, ranks):
    levels = plain_levels(data)
    wins = Counter()
    rounds = max(len(levels) - 63, 1) if levels else 0
    for a in range(rounds):
        own = [(ranks[x], a + i) for i, x in enumerate(levels[a : a + 64]) if ranks[x] is not None]
        if own:
            wins[min(own)[1]] += 1
    out = []
    for i in sorted(i for i, n in wins.items() if n >= min(rounds, 16)):
        h = np.zeros(1, np.uint64)
        for j in range(0, 32, 8):
            h = mix(h ^ np.frombuffer(data[i + j : i + j + 8], "<u8"))
        out.append(int(h[0]))
    return out or ([xxhash.xxh3_64_intdigest(data)] if data else [])


def plain_chain(data, ranks):
    """Filters as sets of bits."""
    found = plain_features(data, ranks)
    return [{(h >> (10 * k)) % 1024 for h in found[i : i + 80] for k in range(5)} for i in range(0, len(found), 80)]


def plain_hex(chain):
    return "".join(np.packbits([i in s for i in range(1024)]).tobytes().hex() for s in chain)


def plain_likeness(a, b):
    if not a or not b:
        return float(len(a) == len(b))

    def best(x, y):
        def one(s, t):
            most, chance = min(len(s), len(t)), len(s) * len(t) / 1024
            least = chance + 0.15 * (most - chance)
            return min(max((len(s & t) - least) / (most - least), 0), 1)

        return sum(len(s) * max(one(s, t) for t in y) for s in x) / sum(map(len, x))

    return (best(a, b) + best(b, a)) / 2 if len(a) == len(b) else best(a, b) if len(a) < len(b) else best(b, a)


def test_fingerprints_against_plain_loops(spark):
    rng = random.Random(3)
    rows = [r for r in rows_of_all_kinds(n=25) if r[1] is None or len(r[1]) < 4000]
    rows += [(500 + i, t, "en", "s", 1, "k", 2, 3, None, 4) for i, t in enumerate(["x" * 700, "ab" * 300, "".join(map(chr, range(32, 2000))), rng.randbytes(300).hex(), "a" * 31, "b" * 32, "c" * 95])]
    docs = table(spark, rows)
    got = sorted((tuple(r) for r in fingerprint.edit_report(docs).collect()), key=repr)
    # rows with equal ids follow in the order of length and hash
    hashes = {r["text"]: r["h"] for r in docs.select(F.coalesce("text", F.lit("")).alias("text")).distinct().withColumn("h", F.xxhash64("text")).collect()}
    ordered = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), len(r[1].encode()), hashes[r[1]]))
    ranks = plain_ranks([t.encode() for _, t in ordered])
    chains = {t: plain_chain(t.encode(), ranks) for _, t in ordered}
    want = []
    for (i, t), (_, after) in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
        k = len(t) // 3
        edited = t[: len(t) - k] + after[:k]
        made = plain_chain(edited.encode(), ranks)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), plain_hex(chains[t]), plain_hex(made), plain_likeness(chains[t], made), plain_likeness(chains[t], chains[after])))
    assert [r[:5] for r in got] == [r[:5] for r in sorted(want, key=repr)]
    for a, b in zip(got, sorted(want, key=repr), strict=True):
        assert a[5:] == pytest.approx(b[5:], abs=1e-12)


def test_fingerprints_tell_edits_from_other_texts(spark):
    rows = queries.op11_fingerprints(spark, "/root/testdata/sf0.01").toPandas()
    assert len(rows) == 1000 and rows["doc_id"].is_unique
    assert (rows["near_edited"] > rows["near_next"]).mean() > 0.97
    long = rows[rows["n_chars"] > 600]
    assert 0.55 < long["near_edited"].mean() < 0.75 and long["near_next"].mean() < 0.02


def test_fingerprints_of_special_tables(spark):
    empty = spark.createDataFrame([], EMPTY)
    assert fingerprint.edit_report(empty).count() == 0
    one = spark.createDataFrame([(7, "a text that stands alone " * 9, None, None)], EMPTY)
    (r,) = fingerprint.edit_report(one).collect()
    assert r["near_next"] == 1.0
    nulls = spark.createDataFrame([(1, None, None, None), (None, "", None, None)], EMPTY)
    assert [(r["n_chars"], r["fingerprint"], r["near_edited"], r["near_next"]) for r in fingerprint.edit_report(nulls).collect()] == [(0, "", 1.0, 1.0)] * 2
    ranks = fingerprint.fit_rarity(one)
    odd = one.selectExpr("doc_id", "text", "1 AS fingerprint", "2 AS part", "3 AS kind")
    out = fingerprint.fingerprints(odd, ranks)
    assert out.columns == ["doc_id", "text", "part", "kind", "fingerprint"] and out.first()["part"] == 2


def test_a_text_of_megabytes_and_many_rows_of_one_id(spark):
    rng = random.Random(5)
    long = " ".join(f"{rng.getrandbits(40):x}" for _ in range(250_000))
    docs = spark.createDataFrame([(1, long, None, None), (2, long[: len(long) // 2], None, None), *[(3, "the same text again and again, in many rows", None, None)] * 300], EMPTY).repartition(4)
    got = fingerprint.edit_report(docs).collect()
    same = [r for r in got if r["doc_id"] == 3]
    assert len(got) == 302 and len({r["fingerprint"] for r in same}) == 1 and sorted(r["near_next"] for r in same)[1] == 1.0
    (r,) = [r for r in got if r["doc_id"] == 2]
    assert r["near_next"] > 0.95  # half of the long text is in the long text
    units = fill_in_middle.fill_in_middle(docs)
    for r in fill_in_middle.restore(units).filter("doc_id < 3").collect():
        assert r["restored"] == (long if r["doc_id"] == 1 else long[: len(long) // 2])


# ---- fill-in-middle -----------------------------------------------------------------------------


def plain_middle(i, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return i, len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    last = h[3] % 100 < 20
    return i, len(units), "spm" if last else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if last else f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_and_back(spark):
    rows = rows_of_all_kinds()
    rows += [(900 + i, t, "en", "s", 1, "k", 2, 3, None, 4) for i, t in enumerate(["a<P>b c d", "<<S <M < P>", "<P", "x" * 9000, "é" * 5000, ("ab" * 3000 + "ß-") * 3, "<S<S<M<P" * 900])]
    docs = table(spark, rows)
    made = fill_in_middle.fill_in_middle(docs)
    assert spark_rows(made) == sorted((tuple(x[k] for k in (0, 2, 4, 1, 5, 3)) for x in (plain_middle(r[0], r[1]) for r in rows)), key=repr)
    back = fill_in_middle.restore(made.withColumn("restored", F.lit(1)))
    assert sorted(r["restored"] for r in back.select("restored").collect()) == sorted(r[1] or "" for r in rows)
    assert {r["form"] for r in made.collect()} == {"plain", "psm", "spm"}
    plain = fill_in_middle.fill_in_middle(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    assert fill_in_middle.fill_in_middle(spark.createDataFrame([], EMPTY)).count() == 0


def test_ropes(monkeypatch):
    monkeypatch.setattr(fill_in_middle, "LEAF", 5)
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("abzAZ <>-é日") for _ in range(rng.randint(0, 60)))
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        tree = fill_in_middle.rope(text.encode())
        assert (tree.units, tree.chars) == (len(units), len(text))
        k = rng.randint(0, len(units))
        a, b = fill_in_middle.split(tree, k)
        assert fill_in_middle.written(a).decode() == "".join(units[:k]) and (a.units, b.units) == (k, len(units) - k)
        c = rng.randint(0, len(text))
        a, b = fill_in_middle.split(tree, c, "chars")
        assert fill_in_middle.written(a).decode() == text[:c] and fill_in_middle.written(b).decode() == text[c:] and b.chars == len(text) - c
        one, two = sorted((rng.randint(0, len(units)), k))
        for last in (False, True):
            out, p, m = fill_in_middle.rearranged(tree, one, two, last)
            assert (p, m, out.units) == (len("".join(units[:one])), len("".join(units[one:two])), len(units) + 9)
            assert fill_in_middle.written(fill_in_middle.restored(fill_in_middle.written(out), last)).decode() == text


# ---- source divergence --------------------------------------------------------------------------


def plain_divergence(rows, least=3, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update({t: counts[g][t] for t in kept})

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = shares(counts[lang, source]), shares(whole)
        pairs, terms = [], []
        for other in sorted(s for x, s in groups if x == lang and s != source):
            r = shares(counts[lang, other])
            pairs.append((other, sum((p[t] - r[t]) ** 2 // r[t] for t in kept)))
        terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", pairs), ("term", terms)):
            ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, i) for i, (item, value) in enumerate(ranked[: None if part == "pair" else top], 1)]
    return sorted(out, key=repr)


def listed(df):
    return sorted((tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()), key=repr)


def test_divergence_against_plain_loops_and_sql(spark):
    rows = rows_of_all_kinds()
    rows += [(800 + i, t, lang, source, 1, "k", 2, 3, None, 4) for i, (t, lang, source) in enumerate([("Ünder_score ÉCOLE école a1b2c", "fr", "s"), ("école École a b c", "fr", "t"), ("école a\x00b c", "fr", "u"), (None, "fr", "void"), ("unique", "one", "only"), ("", None, None)])]
    docs = table(spark, rows)
    got = listed(divergence.source_divergence(docs))
    assert got == plain_divergence(rows)
    assert any(r[2] == "pair" and r[1] == "void" for r in got) and {r[2] for r in got} == {"pair", "term"}
    no_nul = docs.withColumn("text", F.replace("text", F.lit("\x00"), F.lit(" ")))
    columns, want = in_duck(no_nul, queries.ORACLE_SQL["op13_source_divergence"])
    assert columns == sorted(["lang", "source", "part", "item", "value", "rank"]) and spark_rows(divergence.source_divergence(no_nul)) == want
    assert listed(divergence.source_divergence(docs, least_docs=1, top=5)) == plain_divergence(rows, 1, 5)
    assert divergence.source_divergence(spark.createDataFrame([], EMPTY)).count() == 0
    nulls = spark.createDataFrame([(1, None, None, "a"), (2, None, None, None)], EMPTY)
    assert listed(divergence.source_divergence(nulls)) == [("", "", "pair", "a", 0, 1), ("", "a", "pair", "", 0, 1)]


def test_shares_of_huge_counts_are_exact(spark):
    n = 10**13 + 7
    got = spark.range(1).select(divergence._share(F.lit(n), F.lit(3 * n))).first()[0]
    assert got == 1 + 1_000_000_000 * (n + 1) // (3 * n)


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_source_divergence"])
def test_queries_match_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    columns, want = duck_rows(queries.ORACLE_SQL[name], SMALL)
    assert sorted(df.columns) == columns and spark_rows(df) == want
