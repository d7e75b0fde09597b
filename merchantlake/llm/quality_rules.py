"""Quality rules: a table of thresholds compiled into one projection of counts and ratios.

Defined results: a null text has no words, as an empty one. A ratio over nothing is null, and a rule on a null
passes. Rows are judged one by one, whatever their length, so null or repeated ids change nothing, and an empty table gives an empty
result. Other columns of the input are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantlake.llm.common import WHITE, packed, text_of, words

# The symbols that count, and the base limits.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as with on by this are or be from an at was not "
    "der die das und von zu mit ist ein eine nicht auf den dem im für des sich auch "
    "le la les et un une en que qui pour dans sur du de au aux par est pas avec "
    "el los las y por para con se del no una como su lo más"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= part / whole <= high`` for documents of at least ``from_words`` words."""

    name: str
    part: str
    whole: str | None = None
    low: float | None = None
    high: float | None = None
    from_words: int = 0


RULES = (
    Rule("length", "n_words", high=1_000_000),
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.01, from_words=100),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.3),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
)


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """Names of the rules that a row fails, as one array expression."""

    def failed(rule: Rule) -> Column:
        value = F.col(rule.part)
        if rule.whole:
            value = value / F.nullif(F.col(rule.whole), F.lit(0))
        low = F.lit(False) if rule.low is None else value < rule.low
        high = F.lit(False) if rule.high is None else value > rule.high
        return F.when((F.col("n_words") >= rule.from_words) & (low | high), F.lit(rule.name))

    return F.array_compact(F.array(*[failed(r) for r in rules]))


def _repeated(sorted_windows: Column) -> Column:
    """Starts of the windows that occur twice or more, from windows sorted by content."""
    same = lambda x, i, by: x["h"] == F.get(sorted_windows, i + by)["h"]
    twice = F.filter(
        sorted_windows,
        lambda x, i: F.coalesce(same(x, i, -1), F.lit(False)) | F.coalesce(same(x, i, 1), F.lit(False)),
    )
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Words inside windows that begin at ``starts`` (ascending)."""
    zero = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        starts,
        zero,
        lambda s, x: F.struct(x.alias("at"), (s["n"] + F.least(F.lit(WINDOW), x - s["at"])).alias("n")),
        lambda s: s["n"],
    )


def quality_rules(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, stop_words: list[str] = STOP_WORDS
) -> DataFrame:
    """The input row as ``document``, its counts, the rules it fails, ``base_failed`` and ``kept``."""
    # Each step is used several times by the next one, so Spark keeps it and computes it once a row.
    steps = docs.select(packed(docs), text_of(F.col(f"`{text}`")).alias("t")).withColumns(
        {
            "w": words(F.col("t")),
            "lines": F.filter(F.split("t", "\n", -1), lambda x: F.trim(x, F.lit(WHITE)) != ""),
        }
    )
    size = lambda c: F.size(c).cast("bigint")
    steps = steps.withColumns(
        {
            "n_words": size("w"),
            "wh": F.transform("w", lambda x: F.xxhash64(x)),
            "word_chars": F.char_length(F.array_join("w", "")).cast("bigint"),
            "n_symbols": F.char_length(F.regexp_replace("t", f"[^{re.escape(SYMBOLS)}]+", "")).cast("bigint"),
            "n_lines": size("lines"),
            "n_dup_lines": size("lines") - size(F.array_distinct("lines")),
            "n_ellipsis_lines": size(F.filter("lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
            "n_bullet_lines": size(F.filter("lines", lambda x: F.substring(F.ltrim(x), 1, 1).isin(*"-*•"))),
        }
    )
    window = lambda i: F.struct(
        F.xxhash64(*[F.get("wh", i + k) for k in range(WINDOW)]).alias("h"), i.alias("i")
    )
    # Words are compared by their hashes, in the two spellings that a function word has.
    known = [F.xxhash64(F.lit(form)) for w in stop_words for form in dict.fromkeys((w, w.capitalize()))]
    steps = steps.withColumn("n_stop_words", size(F.filter("wh", lambda h: h.isin(known))))
    steps = steps.withColumn(
        "windows",
        F.when(
            F.size("wh") >= WINDOW, F.sort_array(F.transform(F.sequence(F.lit(0), F.size("wh") - WINDOW), window))
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    )
    steps = steps.withColumn("n_repeat_words", _covered(_repeated(F.col("windows"))))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    judged = F.struct(
        "document", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines",
        "n_ellipsis_lines", "n_bullet_lines",
        base_failed.alias("base_failed"), compile_rules(rules).alias("failed_rules"),
    )
    # As a row of a generator: a filter on the result would otherwise be moved below the steps and take copies of them
    # along, down into the functions over words, to be computed again for every word.
    return steps.select(F.inline(F.array(judged))).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
