"""The other operators and the pipeline against SQL, plain loops, exact round trips or held-out labels."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from roadpulse.llm import embedding_dedup, importance, lm_scoring, mixing, ngram_join, packing, quality_rules, queries, substring_dedup, suffix_dedup, textchunks, toxicity
from roadpulse.llm.common import mix

from ..compare import duck_rows, spark_rows
from .test_repeats import expected

SMALL = "/root/testdata/sf0.001"
#: Columns beside those of ``documents`` have names that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `key` string, tokens int, epoch int, label int, n int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_of_all_kinds(seed=1, n=50):
    """Prose with near and exact copies, repeated lines, symbols and odd spaces; nulls in each column; empty and long texts; repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "und", "la", *("".join(rng.choice("abdeiklnorstuß") for _ in range(rng.randint(2, 9))) for _ in range(300))]
    prose = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    texts = [prose(rng.randint(1, 120)) for _ in range(n)]
    for _ in range(n):
        w = rng.choice(texts).split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    line, eight = prose(7), prose(8)
    texts += [None, "", " \n\t", "one", "a b c d", "\n".join([line] * 9), f"{eight} x {eight} {prose(20)} {eight}", "# * $ " * 20, "a\x0bb\x0cc\rd\n" * 9, prose(2500), "日本語 é " * 30, "<|endoftext|> x", eight + " " * 5000]
    rng.shuffle(texts)
    out = [(i, t, rng.choice(["en", "de", None, "xx"]), rng.choice(["site_1", "site_1", "site_6", "odd", None]), 1, "k", 2, 3, None, 4) for i, t in enumerate(texts)]
    return [*out, *out[:6], (None, prose(40), None, None, None, None, None, None, None, None)]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def in_duck(docs, sql):
    db = duckdb.connect()
    db.register("documents", docs.toArrow())
    out = db.sql(sql)
    order = sorted(range(len(out.columns)), key=lambda i: out.columns[i])
    return [out.columns[i] for i in order], sorted((tuple(round(v, 12) if isinstance(v, float) else v for v in (r[i] for i in order)) for r in out.fetchall()), key=repr)


# ---- the queries that SQL can express ----------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    columns, want = duck_rows(queries.ORACLE_SQL[name], SMALL)
    assert sorted(df.columns) == columns
    assert spark_rows(df) == want


def test_quality_rules_on_all_kinds(spark):
    docs = table(spark, rows_of_all_kinds())
    assert spark_rows(quality_rules.quality_report(docs)) == in_duck(docs, queries.ORACLE_SQL["op1_quality_rules"])[1]
    kept = quality_rules.quality_filter(docs)
    assert kept.columns == docs.columns
    assert kept.count() == quality_rules.quality_report(docs).filter("kept").count()


def test_mixing_on_all_kinds(spark):
    docs = table(spark, [r for r in rows_of_all_kinds() if r[0] is None or r[0] > 5])
    out = mixing.mix_sources(docs)
    assert sorted(out.columns) == sorted(docs.columns)
    got = out.select("doc_id", "epoch", "lang", "source", mixing.token_count(F.col("text")).alias("n_tokens"))
    assert spark_rows(got) == in_duck(docs, queries.ORACLE_SQL["op4_mixing"])[1]


def test_mixing_gives_a_shortage_to_siblings_first(spark):
    sizes = spark.createDataFrame([("a", "x", 10), ("a", "y", 900), ("b", "z", 900)], "__rp_m_top string, __rp_m_leaf string, tokens long")
    got = {r["__rp_m_leaf"]: r["budget"] for r in mixing.leaf_budgets(sizes, ["top", "leaf"], {}, 0.5, 1).collect()}
    # 905 tokens: 452 for each domain; x can give only 10, so y takes what is left of its domain
    assert got == {"x": 10, "y": 442, "z": 452}


def test_native_operators_have_no_python(spark):
    docs = table(spark, rows_of_all_kinds(n=5))
    for df in (quality_rules.quality_report(docs), mixing.mix_sources(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


# ---- near duplicates -----------------------------------------------------------------------------


def roots(ids, pairs):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_texts(rows):
    """Links of all rows with words: (row, row) by place in the list."""
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]


def test_similarity_join_matches_all_pairs(spark, monkeypatch):
    rows = rows_of_all_kinds(seed=3)
    pairs = near_texts(rows)
    links = Counter(i for p in pairs for i in p)
    root = roots([r[0] for r in rows], [(rows[i][0], rows[j][0]) for i, j in pairs if None not in (rows[i][0], rows[j][0])])
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    want = Counter((r[0], first.get(r[1] or ""), links[k], root[r[0]], True if r[0] is None else root[r[0]] == r[0]) for k, r in enumerate(rows))
    assert len(pairs) > 50
    for block in (ngram_join.BLOCK, 3):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        got = ngram_join.similarity_join(table(spark, rows)).select("doc_id", "class_id", "n_links", "component_id", "kept").collect()
        assert Counter(map(tuple, got)) == want


def test_rows_that_share_an_id_keep_their_links(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    docs = table(spark, [(i, t, None, None, 1, "k", 2, 3, None, 4) for i, t in [(1, a + " x"), (1, b + " x"), (2, a), (3, b), (4, a + " y"), (4, a + " z"), (4, "c d e f g h")]])
    got = Counter((r["doc_id"], r["n_links"], r["component_id"], r["kept"]) for r in ngram_join.similarity_join(docs).collect())
    assert got == Counter([(1, 3, 1, True), (1, 1, 1, True), (2, 3, 1, False), (3, 1, 1, False), (4, 3, 1, False), (4, 3, 1, False), (4, 0, 4, True)])


def test_similarity_join_at_other_thresholds(spark):
    rng = random.Random(12)
    base = [[f"w{rng.randrange(5000)}" for _ in range(80)] for _ in range(8)]
    rows = []
    for i in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(9)):
            w[rng.randrange(80)] = f"w{rng.randrange(5000)}"
        rows.append((i, " ".join(w)))
    grams = [{tuple(t.split()[k : k + 5]) for k in range(76)} for _, t in rows]
    for threshold in (0.5, 0.3):
        links = Counter()
        for i in range(120):
            for j in range(i):
                if len(grams[i] & grams[j]) >= threshold * len(grams[i] | grams[j]):
                    links.update((i, j))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert {r["doc_id"]: r["n_links"] for r in ngram_join.similarity_join(docs, threshold=threshold).collect()} == {i: links[i] for i in range(120)}
    with pytest.raises(ValueError):
        ngram_join.band_width(0.05)


def test_embedding_links_match_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = rng.normal(size=16)
        rows += [((centre + rng.normal(size=16) * rng.choice([0.0, 0.05, 0.1, 0.2])) * rng.choice([1.0, 3.0]), [0, 1, None][c % 3 if c % 5 else 2]) for _ in range(25)]
    rows = [(i, [float(x) for x in v], y) for i, (v, y) in enumerate(rows)]
    rows += [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, [1.0, None], 0), (905, [float("inf")] + [1.0] * 15, 0), (906, [1.0, 2.0], 0), (907, [2.0, 4.0], 0)]
    rows += [rows[3], (None, rows[4][1], 1)]
    good = lambda v: v and None not in v and np.isfinite(v).all() and any(v)
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            (i, v, x), (j, w, y) = rows[a], rows[b]
            if None not in (i, j, x, y) and x == y and good(v) and good(w) and len(v) == len(w) and np.dot(v, w) / np.sqrt(np.dot(v, v) * np.dot(w, w)) >= 0.98:
                pairs.append((a, b))
    links = Counter(i for p in pairs for i in p)
    root = roots([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in pairs])
    want = Counter((r[0], links[k], root[r[0]], root[r[0]] == r[0]) for k, r in enumerate(rows))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, n int, codes string")
    got = embedding_dedup.near_duplicates(df, sample=100)
    assert len(pairs) > 500
    assert Counter(map(tuple, got.select("vec_id", "n_links", "component_id", "kept").collect())) == want


def test_embedding_probes_find_nearly_all_links(spark):
    """Many lists: recall against all pairs, among random vectors with partners just above the threshold; no link that isn't one."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=(1000, 64))
    away -= (away * x[:1000]).sum(1)[:, None] * x[:1000]
    c = rng.uniform(0.975, 0.99, 1000)[:, None]
    x = np.concatenate([x, c * x[:1000] + np.sqrt(1 - c * c) * away / np.linalg.norm(away, axis=1, keepdims=True)]).astype(np.float32)
    wide = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = ((wide @ wide.T) >= 0.98).sum(1) - 1
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, per_list=10).collect()}
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (links <= want).all() and links.sum() >= 0.97 * want.sum() > 1000
    assert all(got[i]["component_id"] == min(i, got[i]["component_id"]) and (links[i] > 0 or got[i]["kept"]) for i in got)


def test_embeddings_that_share_an_id(spark):
    a, b = [1.0] * 8, [1.0, -1.0] * 4
    near = lambda v: [x * 1.01 if i else x for i, x in enumerate(v)]
    df = spark.createDataFrame([(1, a, 0), (1, b, 0), (2, near(a), 0), (3, near(b), 0)], "vec_id long, embedding array<double>, label int")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


# ---- packing ---------------------------------------------------------------------------------------


def check_pieces(docs, pieces, slack):
    """Every document's ids are tiled by its pieces; sequences have no gaps and little padding."""
    slow = Tokenizer.from_file(queries.vocabulary_path())
    ids = {}
    for d, t in docs:
        ids.setdefault(d, np.array([*slow.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    copies = Counter(d for d, _ in docs)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(ids)
    for d, found in by_doc.items():
        seen = Counter()
        for r in found:
            part = ids[d][r["start"] : r["start"] + r["length"]]
            assert r["doc_tokens"] == len(ids[d]) and r["ids_crc32"] == zlib.crc32(part.tobytes()) and len(part) == r["length"] > 0
            seen[(r["start"], r["length"])] += 1
        assert set(seen.values()) == {copies[d]}
        spans = sorted(seen)
        assert [s for s, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]]
        assert sum(n for _, n in spans) == len(ids[d])
    total = 0
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert len(by_sequence) * 2048 <= total * (1 + slack) + 2048


def test_packing_round_trip(spark):
    rows = rows_of_all_kinds()
    out = packing.pack_documents(table(spark, rows), queries.vocabulary_path())
    check_pieces([(r[0], r[1]) for r in rows], out.collect(), 0.05)


# ---- models ----------------------------------------------------------------------------------------


def test_toxicity_finds_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    got = queries.op5_toxicity(spark, sf).join(labels, "doc_id").toPandas()
    assert got["score"].between(0, 1).all()
    held = got[got["held_out"]]
    assert (held["held_out"] == [zlib.crc32(str(d).encode()) % 3 == 1 for d in held["doc_id"]]).all()
    rank, bad = held["score"].rank(), held["toxic"] == 1
    n, m = bad.sum(), (~bad).sum()
    assert (rank[bad].sum() - n * (n + 1) / 2) / (n * m) > 0.95
    assert held["predicted"][~bad].mean() < 0.1


def test_toxicity_probabilities_match_plain_loops(spark, monkeypatch):
    """Both models from counts by words as strings; each adds up to one over all words."""
    monkeypatch.setattr(toxicity, "CALIBRATION", 0.0)
    monkeypatch.setattr(toxicity, "CLASS_DISCOUNTS", (least := 3.0,))
    monkeypatch.setattr(toxicity, "EXPLAINED", (explained := 4.0,))
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    bad = ["nastyone", "nastytwo", "nasty", "vile"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(20)) + (f" {rng.choice(bad)}, {rng.choice(bad)}!" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(200)]
    rows += [(900, None, 1), (901, "", 0)]
    n = [Counter(), Counter()]
    for _, t, y in rows:
        n[1 - y].update(set((t or "").replace(",", "").replace("!", "").split()))
    stem = lambda w: w[: toxicity.STEM]
    stems = [Counter(), Counter()]
    for c in (0, 1):
        for w, k in n[c].items():
            stems[c][stem(w)] += k
    total = [sum(x.values()) for x in n]

    def kept(counts, c, x):
        rate = (counts[1 - c][x] + 1) / (total[1 - c] + 1)
        return max(0, counts[c][x] - max(least, explained * total[c] * rate)) / total[c]

    words, heads = set(n[0]) | set(n[1]), set(stems[0]) | set(stems[1])
    spread = sum(min(stems[0][s] + stems[1][s], toxicity.DISCOUNT) for s in heads) / len(heads)
    both = {s: (max(stems[0][s] + stems[1][s] - toxicity.DISCOUNT, 0) + spread) / sum(total) for s in heads}
    of_stem = lambda c, s: kept(stems, c, s) + (1 - sum(kept(stems, c, x) for x in heads)) * both[s]
    p = lambda c, w: kept(n, c, w) + (1 - sum(kept(n, c, x) for x in words)) * of_stem(c, stem(w)) * (n[0][w] + n[1][w]) / (stems[0][stem(w)] + stems[1][stem(w)])
    for c in (0, 1):
        assert sum(p(c, w) for w in words) == pytest.approx(1)
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert len(model.words[0]) >= 3 and len(model.stems[0]) >= 1
    names = sorted(words)
    got = model.ratios(pa.array(names, pa.large_string()))
    assert np.allclose(got, [np.log(p(0, w)) - np.log(p(1, w)) for w in names], atol=1e-9)
    assert got[names.index("nastyone")] > 1 > np.abs([g for g, w in zip(got, names, strict=True) if w in vocabulary]).max()


def test_toxicity_query_contract(spark):
    out = queries.op5_toxicity(spark, SMALL)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert out.filter("held_out IS NULL OR score IS NULL OR predicted IS NULL").count() == 0


def test_toxicity_without_labels(spark):
    rows = table(spark, rows_of_all_kinds(n=5)).withColumn("toxic", F.lit(None).cast("int"))
    out = toxicity.score(rows, toxicity.fit(rows)).collect()
    assert len(out) == rows.count() and len({r["score"] for r in out}) == 1


def slots_of_importance(text):
    w = words(re.sub(r"([^\w\s]+|_+)", r" \1 ", text or ""))
    h = [xxhash.xxh3_64_intdigest(x.encode()) for x in w]
    pairs = [int(mix(np.array([(a * 0x9E3779B97F4A7C15 + b) % 2**64], np.uint64))[0]) for a, b in zip(h, h[1:], strict=False)]
    return [x % importance.SLOTS for x in h + pairs]


def with_target(spark, rows):
    return table(spark, rows).withColumn("target", F.col("doc_id") % 3 == 0)


def test_importance_weights_and_draw(spark):
    rows = rows_of_all_kinds()
    docs = with_target(spark, rows)
    slots = [slots_of_importance(r[1]) for r in rows]
    raw, chosen = np.ones(importance.SLOTS), np.ones(importance.SLOTS)
    for r, s in zip(rows, slots, strict=True):
        np.add.at(raw, s, 1)
        if r[0] is not None and r[0] % 3 == 0:
            np.add.at(chosen, s, 1)
    ratio = np.log(chosen / chosen.sum()) - np.log(raw / raw.sum())
    out = importance.gumbel_top_k(importance.log_weights(docs, importance.fit(docs)), 0.3).collect()
    # a text without n-grams has no weight and is never drawn
    weights = sorted((-1 if r[0] is None else r[0], ratio[s].sum() if s else -1e9) for r, s in zip(rows, slots, strict=True))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], -1e9 if r["log_weight"] is None else r["log_weight"]) for r in out)
    assert [d for d, _ in got] == [d for d, _ in weights]
    assert np.allclose([w for _, w in got], [w for _, w in weights], atol=1e-6)
    some = [r for r in out if r["gumbel_key"] is not None]
    assert len(some) == sum(1 for s in slots if s) < len(rows)
    k = round(0.3 * len(some))
    least = sorted((round(r["gumbel_key"] * 1e9) for r in some), reverse=True)[k - 1]
    assert {r["doc_id"] for r in out if r["kept"]} == {r["doc_id"] for r in some if round(r["gumbel_key"] * 1e9) >= least}
    assert sum(r["kept"] for r in out) >= k and not any(r["kept"] for r in out if r["log_weight"] is None)


def losses_by_strings(rows):
    """(id, n_words, target_loss, background_loss) of each row, from exact counts of words and pairs as strings; ids divisible by 3 are the target."""
    texts = [words(r[1]) for r in rows]
    one, before, two = ([Counter(), Counter()] for _ in range(3))
    for r, w in zip(rows, texts, strict=True):
        m = 1 if r[0] is not None and r[0] % 3 == 0 else 0
        one[m].update(w), before[m].update([None, *w][: len(w)]), two[m].update(zip([None, *w], w, strict=False))
    total = [sum(c.values()) for c in one]
    size = len(set(one[0]) | set(one[1]))
    scale = [total[1] / total[0], 1.0]

    def prob(a, b, m):
        p = (scale[m] * one[m][b] + 1000 / size) / (scale[m] * total[m] + 1000)
        return (scale[m] * two[m][a, b] + 100 * p) / (scale[m] * before[m][a] + 100)

    some = sorted(set(one[0]) | set(one[1]))
    for a in (None, some[0], some[-1], texts[0][-1] if texts[0] else None):
        for m in (0, 1):
            assert sum(prob(a, b, m) for b in some) == pytest.approx(1)
    loss = lambda w, m: np.mean([-np.log(prob(a, b, m)) for a, b in zip([None, *w], w, strict=False)]) if w else None
    return [(r[0], len(w), loss(w, 1), loss(w, 0)) for r, w in zip(rows, texts, strict=True)]


@pytest.mark.parametrize("chunk, group, fanout", [(lm_scoring.CHUNK, lm_scoring.GROUP, textchunks.FANOUT), (2000, 3000, textchunks.FANOUT), (4000, 5000, 6), (8000, 12000, 3)])
def test_loss_differences_match_counts_by_strings(spark, monkeypatch, chunk, group, fanout):
    monkeypatch.setattr(textchunks, "FANOUT", fanout)
    monkeypatch.setattr(lm_scoring, "CHUNK", chunk)
    monkeypatch.setattr(lm_scoring, "GROUP", group)
    rng = random.Random(8)
    rows = rows_of_all_kinds()
    # more distinct pairs than would fit in slots without sharing them
    rows += [(1000 + i, " ".join(f"w{rng.randrange(20000)}" for _ in range(400)), None, None, 1, "k", 2, 3, None, 4) for i in range(50)]
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(map(tuple, lm_scoring.loss_differences(with_target(spark, rows)).collect()), key=key)
    want = sorted(losses_by_strings(rows), key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    for g, w in zip(got, want, strict=True):
        if w[1]:
            assert np.allclose(g[2:], [w[2], w[3], w[2] - w[3]], rtol=0, atol=1e-9)
        else:
            assert g[2] is g[3] is g[4] is None


def test_lm_scoring_query_counts_by_strings(spark):
    good = {r[0] for r in spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").select("doc_id").collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    # ids divisible by 3 are the target of the plain counts
    ids = {d: 3 * k + (d not in good) for k, (d, _) in enumerate(docs)}
    want = {i: (t, b) for i, n, t, b in losses_by_strings([(ids[d], x) for d, x in docs]) if n}
    got = {ids[r["doc_id"]]: (r["target_loss"], r["background_loss"]) for r in queries.op10_lm_scoring(spark, SMALL).collect() if r["n_words"]}
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], rtol=0, atol=1e-9) for i in want)


def test_loss_differences_of_an_empty_table(spark):
    docs = table(spark, rows_of_all_kinds(n=5)).filter("false").withColumn("target", F.lit(True))
    assert lm_scoring.loss_differences(docs).count() == 0


@pytest.mark.parametrize("texts", [[None, None], ["", ""], [" \n", None]])
def test_tables_of_nulls_or_empty_texts_only(spark, texts):
    docs = table(spark, [(i, t, None, None, 1, "k", 2, 3, None, 4) for i, t in enumerate(texts)]).withColumns({"toxic": (F.col("doc_id") % 2).cast("int"), "target": F.col("doc_id") == 0})
    vectors = spark.createDataFrame([(1, None, 0), (2, [], 0)], "vec_id long, embedding array<float>, label int")
    assert {r["kept"] for r in quality_rules.quality_report(docs).collect()} == {False}
    assert sorted((r["doc_id"], r["n_links"], r["kept"]) for r in ngram_join.similarity_join(docs).collect()) == [(0, 0, True), (1, 0, True)]
    assert {r["doc_tokens"] for r in packing.pack_documents(docs, queries.vocabulary_path()).collect()} <= set(range(1, 10))
    assert mixing.mix_sources(docs).count() >= 2
    assert len({r["score"] for r in toxicity.score(docs, toxicity.fit(docs)).collect()}) == 1
    assert sorted(map(tuple, embedding_dedup.near_duplicates(vectors).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert {(r["log_weight"], r["kept"]) for r in importance.gumbel_top_k(importance.log_weights(docs, importance.fit(docs)), 0.5).collect()} == {(None, False)}
    assert {r["loss_difference"] for r in lm_scoring.loss_differences(docs).collect()} == {None}
    assert {r["n_removed"] for r in substring_dedup.remove_repeats(docs).collect()} == {r["n_removed"] for r in suffix_dedup.remove_repeats(docs).collect()} == {0}


def test_empty_tables(spark):
    docs = table(spark, rows_of_all_kinds(n=5)).filter("false").withColumn("toxic", F.lit(1)).withColumn("target", F.lit(True))
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for df in (
        quality_rules.quality_report(docs), ngram_join.similarity_join(docs), packing.pack_documents(docs, queries.vocabulary_path()), mixing.mix_sources(docs),
        toxicity.score(docs, toxicity.fit(docs)), embedding_dedup.near_duplicates(vectors), importance.gumbel_top_k(importance.log_weights(docs, importance.fit(docs)), 0.5),
        lm_scoring.loss_differences(docs),
    ):
        assert df.count() == 0


# ---- the pipeline ----------------------------------------------------------------------------------


def test_each_stage_of_the_pipeline(spark):
    docs = table(spark, rows_of_all_kinds(seed=4))
    stage = dict(corpus_pipeline.STAGES)
    step = lambda name, df: spark.createDataFrame(stage[name](spark, df, None).toArrow())

    good = step("quality rules", docs)
    sql = f"SELECT * FROM ({queries.ORACLE_SQL['op1_quality_rules']}) WHERE kept"
    assert sorted(r[0] for r in good.select(F.coalesce("doc_id", F.lit(-1))).collect()) == sorted(-1 if r is None else r for (r,) in in_duck(docs, f"SELECT doc_id FROM ({sql})")[1])

    single = step("n-gram Jaccard join", good)
    rows = [tuple(r) for r in good.collect()]
    root = roots([r[0] for r in rows], [(rows[i][0], rows[j][0]) for i, j in near_texts(rows) if None not in (rows[i][0], rows[j][0])])
    assert sorted(str(r["doc_id"]) for r in single.collect()) == sorted(str(i) for i, x in root.items() if i == x)

    cut = step("suffix-array dedup", single)
    rows = [tuple(r) for r in single.collect()]
    sizes = {(-1 if r[0] is None else r[0]): len((r[1] or "").encode()) for r in rows}
    gone = {i: n for i, _, n, _, _ in expected(rows, lambda t: list(t.encode()), bytes, 50)}
    left = {(-1 if r["doc_id"] is None else r["doc_id"]): r for r in cut.collect()}
    assert set(left) == {i for i, n in gone.items() if n < sizes[i]}
    assert all(len(r["text"].encode()) == sizes[i] - gone[i] and r["n_chars"] == len(r["text"]) for i, r in left.items() if "�" not in r["text"])

    mixed = step("mixing sources to target weights", cut)
    want = in_duck(cut, f"SELECT doc_id FROM ({queries.ORACLE_SQL['op4_mixing']})")[1]
    assert spark_rows(mixed.select("doc_id")) == want
    for df in (good, single, cut, mixed):
        assert df.columns == docs.columns

    pieces = stage["packing"](spark, mixed, None).collect()
    check_pieces([(r["doc_id"], r["text"]) for r in mixed.collect()], pieces, 0.3)


def test_near_duplicates_with_null_and_shared_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(1, a), (None, a), (7, a), (7, b), (None, c), (None, c), (8, d), (8, d), (9, d)]
    docs = table(spark, [(*r, None, None, 1, "k", 2, 3, None, 4) for r in rows])
    out = corpus_pipeline.drop_near_duplicates(spark, docs, None)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter([(1, a), (7, b), (None, c), (8, d)])


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
