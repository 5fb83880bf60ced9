"""Quality rules: a threshold table compiled into one native Spark projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words_of

#: Function words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with in is it for as was on a by at or from this an are you "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "le la les de du et un une en que qui dans pour par sur au est pas avec "
    "el y los las se del por con no para es al lo su"
).split()
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """Keep a text only if ``least <= metric <= most``; a bound of None is open."""

    metric: str
    least: float | None = None
    most: float | None = None

    def passes(self, metrics: dict[str, Column]) -> Column:
        value, ok = metrics[self.metric], F.lit(True)
        if self.least is not None:
            ok = ok & (value >= F.lit(self.least))
        if self.most is not None:
            ok = ok & (value <= F.lit(self.most))
        return ok


#: The threshold table.
RULES = (
    Rule("n_words", least=20),
    Rule("repeat_word_ratio", most=0.3),
    Rule("mean_word_chars", least=2.5, most=12.0),
    Rule("symbols_per_word", most=0.1),
    Rule("stop_word_ratio", least=0.04),
    Rule("dup_line_ratio", most=0.5),
)

_T = "__rp_q_"


def _measured(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the raw measures in columns named ``__rp_q_*``.

    Array functions only; each step is its own projection so that no array is computed twice.
    """
    c = lambda name: F.col(_T + name)
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    steps = [
        {
            "words": words_of(F.col(text)),
            "lines": lines,
            "n_symbols": (F.size(F.split(whole, f"[{SYMBOLS}]")) - 1).cast("long"),
        },
        {
            "n_words": F.size(c("words")).cast("long"),
            "word_chars": F.length(F.array_join(c("words"), "")).cast("long"),
            "hashes": F.transform(c("words"), lambda w: F.xxhash64(w)),
            "n_stops": F.size(F.filter(c("words"), lambda w: w.isin(*STOP_WORDS))).cast("long"),
            "n_lines": F.size(c("lines")).cast("long"),
            "n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
        },
        # Windows stand for their 64-bit hashes: within one text a chance collision has probability n**2 / 2**65.
        # Runs of 2, 4 and 8 words are hashed by doubling.
        {"runs2": F.transform(c("hashes"), lambda h, i: F.xxhash64(h, F.get(c("hashes"), i + 1)))},
        {"runs4": F.transform(c("runs2"), lambda h, i: F.xxhash64(h, F.get(c("runs2"), i + 2)))},
        {
            "windows": F.transform(
                F.slice(c("runs4"), F.lit(1), F.greatest(c("n_words") - (WINDOW - 1), F.lit(0)).cast("int")),
                lambda h, i: F.xxhash64(h, F.get(c("runs4"), i + 4)),
            )
        },
        {
            "sorted": F.when(
                F.size(F.array_distinct(c("windows"))) < F.size(c("windows")),
                F.sort_array(F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        },
        {
            "repeats": F.sort_array(
                F.filter(
                    F.transform(
                        c("sorted"),
                        lambda s, i: F.when((s["h"] == F.get(c("sorted"), i - 1)["h"]) | (s["h"] == F.get(c("sorted"), i + 1)["h"]), s["i"]),
                    ),
                    lambda i: i.isNotNull(),
                )
            )
        },
        {
            "n_repeat_words": F.aggregate(
                c("repeats"),
                F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
                lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
            )["n"].cast("long"),
            # The row number keeps Spark from moving a filter on the results below the measures, where it would compute all of them again.
            "row": F.monotonically_increasing_id(),
        },
        {"n_repeat_words": F.when(c("row") >= 0, c("n_repeat_words"))},
    ]
    for step in steps:
        df = df.withColumns({_T + k: v for k, v in step.items()})
    return df


def _metrics() -> dict[str, Column]:
    c = lambda name: F.col(_T + name)
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return {
        "n_words": c("n_words"),
        "repeat_word_ratio": ratio(c("n_repeat_words"), c("n_words")),
        "mean_word_chars": ratio(c("word_chars"), c("n_words")),
        "symbols_per_word": ratio(c("n_symbols"), c("n_words")),
        "stop_word_ratio": ratio(c("n_stops"), c("n_words")),
        "dup_line_ratio": ratio(c("n_dup_lines"), c("n_lines")),
    }


def _base_failed() -> Column:
    return (F.col(_T + "n_words") < 20) | (100 * F.col(_T + "n_repeat_words") > 30 * F.col(_T + "n_words"))


def _kept(rules: tuple[Rule, ...]) -> Column:
    verdict = ~_base_failed()
    for rule in rules:
        verdict = verdict & rule.passes(_metrics())
    return verdict


def quality_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row with its measures, ``base_failed`` and ``kept``.

    A null text has no words, so it fails; an empty text likewise. Repeated rows give repeated
    results, an empty table an empty one. Other input columns are not read and don't appear. A text of any length is
    measured whole, in the memory of some arrays of its words.
    """
    df = _measured(df.select(F.col(id_col).alias(id_col), F.col(text_col).alias(text_col)), text_col)
    c = lambda name: F.col(_T + name).alias(name)
    return df.select(
        id_col, c("n_words"), c("word_chars"), c("n_symbols"), c("n_dup_lines"), c("n_repeat_words"),
        _base_failed().alias("base_failed"), _kept(rules).alias("kept"), c("n_stops"), c("n_lines"),
    )


def quality_filter(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass every rule, with all their own columns; rows with a null text go."""
    return _measured(df, text_col).filter(_kept(rules)).select(*[F.col(f"`{x}`") for x in df.columns])
