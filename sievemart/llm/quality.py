"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure is a count per text, every threshold a comparison of two counts
in whole numbers, so a verdict never depends on rounding.  No user function and
no shuffle: a text is judged where it is read, whatever its size.

Defined results: a NULL or blank text has no words and fails the base rules;
repeated rows and ties are judged each by itself; a NULL id stays NULL; other
columns are passed on by ``keep_good`` and ignored by ``quality_report``; an
empty table gives an empty result.  Repeated 8-word windows are told by 64-bit
hashes inside one text.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemart.llm.common import SPACES, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of four languages.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by this are at from or an he not have",
    "fr": "de la le et les des en un du une que pour est par dans qui avec pas sur au ce il ne se plus",
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als auch es an er",
    "es": "de la que el en y los se las del un por con no su una para es al lo como más o pero sus",
}


class Threshold(NamedTuple):
    """Holds if ``bound_num * base >= bound_den * measure`` (``at_most``), or ``<=``."""

    name: str
    measure: str
    sense: str  # "at_most" or "at_least"
    percent: int
    base: str


#: Judged before the table: a text that fails here is rejected whatever it holds.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: The production table; percents of the base count.
THRESHOLDS = (
    Threshold("short_words", "word_chars", "at_least", 300, "n_words"),
    Threshold("long_words", "word_chars", "at_most", 1000, "n_words"),
    Threshold("symbols", "n_symbols", "at_most", 10, "n_words"),
    Threshold("stop_words", "n_stop_words", "at_least", 4, "n_words"),
    Threshold("repeated_lines", "n_dup_lines", "at_most", 40, "n_lines"),
    Threshold("cut_lines", "n_cut_lines", "at_most", 30, "n_lines"),
    Threshold("bullet_lines", "n_bullet_lines", "at_most", 90, "n_lines"),
)

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines",
    "n_dup_lines", "n_cut_lines", "n_bullet_lines", "n_repeat_words",
)


def compiled(thresholds: Sequence[Threshold], m: Column) -> Column:
    """The names of the thresholds that the measures in struct ``m`` do not meet."""
    failed = []
    for rule in thresholds:
        left, right = m[rule.measure] * 100, m[rule.base] * rule.percent
        meets = {"at_most": left <= right, "at_least": left >= right}[rule.sense]
        failed.append(F.when(~meets, F.lit(rule.name)))
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def _stop_count(words: str) -> Column:
    forms = sorted(
        {w + end for text in STOP_WORDS.values() for w in text.split() for end in ("", ",", ".")}
    )
    return F.size(F.filter(words, lambda w: F.lower(w).isin(forms)))


def with_measures(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` plus a struct ``_m`` of the text's counts.

    ``rows`` must have no other column that starts with an underscore, but for
    what the caller wrapped; see ``_wrapped``.
    """
    first = rows.select(
        "*",
        F.coalesce(text, F.lit("")).alias("_text"),
        words_of(text).alias("_words"),
    )
    blank = F.lit(SPACES)
    lines = F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, blank) != "")
    hashed = first.select(
        "*",
        F.size("_words").alias("_n"),
        lines.alias("_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h1"),
    )
    # Hashes of 2, 4 and 8 words from two hashes of half the length each.
    for have in (1, 2, 4):
        left = f"slice(_h{have}, 1, greatest(_n - {2 * have - 1}, 0))"
        right = f"slice(_h{have}, {have + 1}, greatest(_n - {2 * have - 1}, 0))"
        hashed = hashed.withColumn(
            f"_h{2 * have}", F.expr(f"zip_with({left}, {right}, (a, b) -> xxhash64(a, b))")
        )
    repeats = hashed.withColumn(
        "_sorted",
        F.expr(
            f"CASE WHEN size(array_distinct(_h{WINDOW})) < size(_h{WINDOW})"
            f" THEN array_sort(transform(_h{WINDOW}, (h, i) -> struct(h AS h, i AS i))) END"
        ),
    )
    repeats = repeats.withColumn(
        "_same_next",
        F.expr(
            "zip_with(slice(_sorted, 1, size(_sorted) - 1), slice(_sorted, 2, size(_sorted) - 1),"
            " (a, b) -> a.h = b.h)"
        ),
    ).withColumn(
        "_places",
        F.expr(
            "sort_array(filter(zip_with(_sorted, zip_with(array_append(_same_next, false),"
            " array_prepend(_same_next, false), (a, b) -> a OR b),"
            " (x, twice) -> CASE WHEN twice THEN x.i END), p -> p IS NOT NULL))"
        ),
    )
    covered = (
        "coalesce(aggregate(zip_with(_places, array_append(slice(_places, 2, size(_places)),"
        f" _n), (a, b) -> least(b - a, {WINDOW})), 0L, (t, x) -> t + x), 0L)"
    )
    chars = F.char_length("_text")
    measures = {
        "n_words": F.col("_n"),
        "word_chars": F.char_length(F.translate("_text", SPACES, "")),
        "n_symbols": chars - F.char_length(F.translate("_text", SYMBOLS, "")),
        "n_stop_words": _stop_count("_words"),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_cut_lines": F.size(F.filter("_lines", lambda x: F.rtrim(x).rlike(r"(\.\.\.|…)$"))),
        "n_bullet_lines": F.size(F.filter("_lines", lambda x: F.ltrim(x).rlike(r"^[-*•]"))),
        "n_repeat_words": F.expr(covered),
    }
    struct = F.struct(*[measures[name].cast("long").alias(name) for name in MEASURES])
    return repeats.select(*rows.columns, struct.alias("_m"))


def _judged(rows: DataFrame, text: Column, thresholds: Sequence[Threshold]) -> DataFrame:
    """``rows`` plus ``_m``, ``_base_failed`` and ``_failed``."""
    m = F.col("_m")
    base = (m["n_words"] < MIN_WORDS) | (
        m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT
    )
    return with_measures(rows, text).select(
        "*", base.alias("_base_failed"), compiled(thresholds, m).alias("_failed")
    )


def quality_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    thresholds: Sequence[Threshold] = THRESHOLDS,
) -> DataFrame:
    """Per row: the id, all measures, both verdicts and the thresholds not met."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_raw"))
    return _judged(rows, F.col("_raw"), thresholds).select(
        F.col("_id").alias(id_col),
        *[F.col("_m")[name].alias(name) for name in MEASURES],
        F.col("_base_failed").alias("base_failed"),
        (~F.col("_base_failed") & (F.size("_failed") == 0)).alias("kept"),
        F.col("_failed").alias("failed_rules"),
    )


def keep_good(
    docs: DataFrame, text_col: str = "text", thresholds: Sequence[Threshold] = THRESHOLDS
) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text passes all rules."""
    rows = docs.select(F.struct("*").alias("_row"))
    judged = _judged(rows, F.col("_row")[text_col], thresholds)
    # Spark pushes a filter below the projections that compute what it tests, and
    # computes that again for every mention; a row number among them prevents it.
    numbered = judged.withColumn("_number", F.monotonically_increasing_id())
    passes = ~F.col("_base_failed") & (F.size("_failed") == 0) & (F.col("_number") >= 0)
    return numbered.filter(passes).select(
        *[F.col("_row")[c].alias(c) for c in docs.columns]
    )
