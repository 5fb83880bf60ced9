"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, embedding_dedup, fill_in_middle, fingerprint, importance, lm_scoring, mixing, ngram_join, packing, quality_rules, substring_dedup, suffix_dedup, toxicity
from .common import read
from .ngrams import flagged


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(read(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_join(read(spark, sf_dir, "documents"))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file that is installed beside the tokenizer libraries on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary_path())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    labels = read(spark, sf_dir, "labels").filter(~held_out).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the labels that are drawn are some 24,000 rows of two numbers at every size: no text is shuffled to find theirs
    model = toxicity.fit(docs.filter(~held_out).join(F.broadcast(toxicity.drawn(labels)), "doc_id"))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "log_ratio")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", "spans")


def _with_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; ``target``: labelled as good."""
    good = read(spark, sf_dir, "labels").filter("quality = 1")
    return flagged(read(spark, sf_dir, "documents").select("doc_id", "text"), good, "doc_id", "target")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws as many documents as labels say are good."""
    model = importance.fit(_with_good(spark, sf_dir))
    share = read(spark, sf_dir, "labels").agg(F.avg(F.col("quality").cast("double")).alias("s")).first()["s"] or 0.0
    return importance.gumbel_top_k(importance.log_weights(read(spark, sf_dir, "documents"), model), share)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.loss_differences(_with_good(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "epoch", "lang", "source", mixing.token_count(F.col("text")).alias("n_tokens"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_report(read(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's texts and those restored from them, as digests."""
    out = fill_in_middle.restore(fill_in_middle.fill_in_middle(read(spark, sf_dir, "documents")))
    digest = lambda c: F.sha2(F.col(c), 256).alias(f"{c}_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_ngram_join": op2_ngram_join,
    "op3_packing": op3_packing,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_fingerprints": op11_fingerprints,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_source_divergence": op13_source_divergence,
}

_STOPS = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)


def _mixing_sql() -> str:
    """The same budgets level by level, then a plain running sum over each leaf."""
    levels = list(mixing.TREE)
    tree = r"""'domain' || coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 4, -1) AS domain, coalesce(lang, '?') AS language, coalesce(source, '?') AS origin"""
    out = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, {tree}, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n FROM documents),
leaf AS (SELECT domain, language, origin, sum(n)::HUGEINT AS tokens FROM d GROUP BY ALL),
b AS (SELECT floor(coalesce(sum(tokens), 0)::BIGINT * {mixing.BUDGET_SHARE}::DOUBLE)::HUGEINT AS budget FROM leaf)"""
    above, before = "b", []
    for level in levels:
        cols = [*before, level]
        cases = "".join(f" WHEN '{k}' THEN {w}" for k, w in mixing.WEIGHTS.get(level, {}).items())
        weight = f"CASE {level}{cases} ELSE 1 END" if cases else "1"
        part = f"PARTITION BY {', '.join(before)}" if before else ""
        join = f"JOIN {above} USING ({', '.join(before)})" if before else f", {above}"
        out += f""",
n_{level} AS (SELECT {', '.join(cols)}, sum(tokens)::HUGEINT * {mixing.MAX_EPOCHS} AS supply, ({weight})::HUGEINT AS weight FROM leaf GROUP BY {', '.join(cols)}),
o_{level} AS (SELECT n.*, budget, coalesce(sum(supply) OVER w, 0)::HUGEINT AS given,
  (sum(weight) OVER ({part} ORDER BY supply::DOUBLE / weight::DOUBLE, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS rest
  FROM n_{level} n {join} WINDOW w AS ({part} ORDER BY supply::DOUBLE / weight::DOUBLE, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s_{level} AS (SELECT *, supply * rest <= (budget - given) * weight AS short FROM o_{level}),
b_{level} AS (SELECT {', '.join(cols)}, CASE WHEN short THEN supply ELSE
  weight * (budget - coalesce(sum(supply) FILTER (short) OVER ({part}), 0)::HUGEINT) // (sum(weight) FILTER (NOT short) OVER ({part}))::HUGEINT END AS budget FROM s_{level})"""
        above, before = f"b_{level}", cols
    return out + f""",
l AS (SELECT domain, language, origin, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END::BIGINT AS whole, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
  FROM leaf JOIN {above} USING (domain, language, origin)),
k AS (SELECT d.*, whole, rest, md5('{mixing.SEED}|' || whole || '|' || coalesce(doc_id::VARCHAR, '?')) AS key FROM d JOIN l USING (domain, language, origin)),
t AS (SELECT *, whole + CASE WHEN rest > 0 AND sum(n) OVER (PARTITION BY domain, language, origin ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest THEN 1 ELSE 0 END AS times FROM k)
SELECT doc_id, unnest(range(0, times)) AS epoch, lang, source, n AS n_tokens FROM t WHERE times > 0"""


ORACLE_SQL = {
    "op1_quality_rules": rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
s AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM d),
g AS (SELECT rid, unnest(range(0, greatest(len(w) - 7, 0))) AS i, w FROM s),
k AS (SELECT rid, i, array_to_string(w[i + 1 : i + 8], ' ') AS x FROM g),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS n FROM k) WHERE n > 1),
v AS (SELECT rid, sum(least(8, i - p)) AS n FROM (SELECT rid, i, coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), -8) AS p FROM r) GROUP BY rid),
m AS (SELECT s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(w, lambda x: list_contains([{_STOPS}], x)))::BIGINT AS n_stops, len(ln)::BIGINT AS n_lines
  FROM s LEFT JOIN v USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(word_chars / n_words BETWEEN 2.5 AND 12.0 AND n_symbols / n_words <= 0.1
    AND n_stops / n_words >= 0.04 AND n_dup_lines / greatest(n_lines, 1) <= 0.5 AND n_repeat_words / n_words <= 0.3, false) AS kept,
  n_stops, n_lines
FROM b""",
    "op4_mixing": _mixing_sql(),
    "op12_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT *, len(u) AS n, [('0x' || h[8 * i + 1 : 8 * i + 8])::BIGINT for i in range(4)] AS k FROM d),
c AS (SELECT doc_id, t, u, n, least(k[1] % (n + 1), k[2] % (n + 1)) AS a, greatest(k[1] % (n + 1), k[2] % (n + 1)) AS b,
  CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR k[3] % 100 >= 90 THEN 'plain' WHEN k[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS x, array_to_string(u[a + 1 : b], '') AS y, array_to_string(u[b + 1 : n], '') AS z FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(x) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p""",
    "op13_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
x AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM x GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM x SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS kept, sum(n) AS n FROM k GROUP BY lang),
s AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (s.n + v.kept) AS p, 1 + 1000000000::HUGEINT * (k.n + 1) // (v.n + v.kept) AS q
  FROM s JOIN k ON k.lang = s.lang JOIN v ON v.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
o AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(o.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN o ON o.lang = a.lang AND o.source = a.source AND o.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM r QUALIFY part = 'pair' OR rank <= 200""",
}
