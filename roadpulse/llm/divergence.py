"""Source divergence audit: how the term shares of each source differ from those of every other source and of its language.

A baseline-correction inverted index. Most terms don't occur in most sources, so each ordered pair of sources starts at V times the
value of a term that neither has. Term postings then correct only what differs: terms of one source by its histogram of
counts (all terms with the same count are corrected alike), terms of both sources by joining postings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, small, split_words

#: Terms of a language are kept from this number of its documents on; the term report has so many ranks.
LEAST_DOCS = 3
TOP_TERMS = 200
#: Shares are whole parts of this, so that all arithmetic is exact.
UNIT = 1_000_000_000

_COUNTS = "lang string, source string, term string, n long, docs long"


def _letters() -> np.ndarray:
    """What becomes of each byte: ASCII other than letters separates terms, A to Z are lower-cased; bytes of other characters stay."""
    to = np.arange(256, dtype=np.uint8)
    to[:0x80] = 0x20
    for upper, lower in zip(range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1), strict=True):
        to[upper] = to[lower] = lower
    return to


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a batch of texts, and their offsets by text."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return split_words(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(ends - ends[0])), pa.py_buffer(_letters()[data])))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents by lang, source and term for each slice of a batch of (text, lang, source).

    A row with an empty term for every lang and source, so that those without terms are known too.
    """
    for b in small(batches, most=16 << 20):
        codes = [c.dictionary_encode() for c in (b.column(1), b.column(2))]
        lang, source = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in codes)
        groups, group = np.unique(lang * len(codes[1].dictionary) + source, return_inverse=True)
        flat, ends = _terms(b.column(0))
        coded = flat.dictionary_encode()
        size = max(len(coded.dictionary), 1)
        row = np.repeat(np.arange(b.num_rows), np.diff(ends))
        pairs, times = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        keys, cell = np.unique(group[pairs // size] * size + pairs % size, return_inverse=True)
        docs = np.bincount(cell, minlength=len(keys))
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, cell, times)
        of = np.concatenate([groups, groups[keys // size]])
        empty = pa.array([""] * len(groups), pa.large_string())
        zero = np.zeros(len(groups), np.int64)
        term = pa.concat_arrays([empty, coded.dictionary.take(pa.array(keys % size)).cast(pa.large_string())])
        yield pa.RecordBatch.from_arrays(
            [
                codes[0].dictionary.take(pa.array(of // len(codes[1].dictionary))).cast(pa.string()),
                codes[1].dictionary.take(pa.array(of % len(codes[1].dictionary))).cast(pa.string()),
                term.cast(pa.string()),
                pa.array(np.concatenate([zero, n])),
                pa.array(np.concatenate([zero, docs])),
            ],
            ["lang", "source", "term", "n", "docs"],
        )


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and rows that hold the term; null text, lang and source are ''.

    Every lang and source has a row with the empty term and n = 0.
    """
    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    return own.mapInArrow(_counted, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / total), exact for counts of any size; null where nothing is kept."""
    wide = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    rows = F.call_function("div", wide, F.nullif(total, F.lit(0)).cast("decimal(19,0)"))
    return rows + 1


def _value(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _pair_values(rated: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a language: as many rows as the result has.

    base + own(s, t) + other(s, t) + both(s, t): own and other correct the terms of one of the two as if the other had none of them;
    both corrects the terms of both. Each unordered pair of postings is made once and gives both orders.
    """
    a = groups.select("lang", "source", F.col("p0").alias("a0"), "kept")
    b = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("b0"))
    pairs = a.join(b, "lang").filter("source <> item")
    f00 = _value(F.col("a0"), F.col("b0"))
    base = pairs.select("lang", "source", "item", F.coalesce(F.col("kept") * f00, F.lit(0)).alias("value"))
    histogram = rated.groupBy("lang", "source", "n").agg(F.first("p").alias("p"), F.count("*").alias("m"), F.first("p0").alias("p0"))
    other = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    alone = histogram.join(other, "lang").filter("source <> other")
    p, p0, q0, m = (F.col(c) for c in ("p", "p0", "q0", "m"))
    alone = alone.select(
        "lang",
        F.explode(F.array(
            F.struct("source", F.col("other").alias("item"), (m * (_value(p, q0) - _value(p0, q0))).alias("value")),
            F.struct(F.col("other").alias("source"), F.col("source").alias("item"), (m * (_value(q0, p) - _value(q0, p0))).alias("value")),
        )).alias("x"),
    ).select("lang", "x.*")
    # the products of sums would not be exact, so each shared term is corrected for itself
    left = rated.select("lang", "term", "source", "p", "p0")
    right = rated.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    q = F.col("q")
    there = _value(p, q) - _value(p, q0) - _value(p0, q) + _value(p0, q0)
    back = _value(q, p) - _value(q, p0) - _value(q0, p) + _value(q0, p0)
    both = left.join(right, ["lang", "term"]).filter("source < item").groupBy("lang", "source", "item").agg(F.sum(there).alias("there"), F.sum(back).alias("back"))
    both = both.select("lang", F.explode(F.array(
        F.struct("source", "item", F.col("there").alias("value")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("value"))
    )).alias("x")).select("lang", "x.*")
    return base.unionByName(alone).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP_TERMS
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every lang and source that occurs.

    Part ``pair`` has each other source of the lang with the sum over the lang's kept terms of floor((p - q)**2 / q), p and q being the shares
    of the term in the two sources; part ``term`` has the ``top`` kept terms that the source holds more often than its lang does. Ranks
    count from 1 by falling value, equal values by item.

    Null text, lang and source are ''. A source without terms has shares of zero counts; a lang without kept terms has pairs of value 0
    and no terms. Repeated rows count as documents of their own. A text of any length is taken whole. An empty table gives an empty
    result; other columns aren't read. Counts are added up before they are shuffled; a hot source or term has at most one row for each term
    or source then. Terms of both sources of a pair are joined by term: as many rows as pairs of sources share terms.
    """
    counts = materialize(term_counts(docs, text_col, lang_col, source_col))
    here = Window.partitionBy("lang", "term")
    postings = counts.filter("term <> ''").withColumns({"in_docs": F.sum("docs").over(here), "lang_n": F.sum("n").over(here), "place": F.row_number().over(here.orderBy("source"))})
    postings = materialize(postings.filter(F.col("in_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n", F.when(F.col("place") == 1, 1).otherwise(0).alias("first")))
    sizes = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("firsts"))
    groups = counts.filter("term = ''").select("lang", "source").join(sizes, ["lang", "source"], "left").fillna(0, ["total", "firsts"])
    lang = Window.partitionBy("lang")
    groups = groups.withColumns({"kept": F.sum("firsts").over(lang), "lang_total": F.sum("total").over(lang)})
    groups = materialize(groups.select("lang", "source", "total", "lang_total", "kept", _share(F.lit(0).cast("long"), F.col("total") + F.col("kept")).alias("p0")))
    discard(counts)
    rated = postings.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "p0", _share(F.col("n"), F.col("total") + F.col("kept")).alias("p"), _share(F.col("lang_n"), F.col("lang_total") + F.col("kept")).alias("in_lang")
    )
    terms = rated.filter(F.col("p") > F.col("in_lang")).select("lang", "source", F.col("term").alias("item"), _value(F.col("p"), F.col("in_lang")).alias("value"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    terms = _ranked(terms).filter(F.col("rank") <= top).withColumn("part", F.lit("term")).select(*columns)
    pairs = _ranked(_pair_values(rated, groups)).withColumn("part", F.lit("pair")).select(*columns)
    out = materialize(pairs.unionByName(terms))
    discard(postings, groups)
    return out
