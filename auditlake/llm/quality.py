"""Quality rules: a threshold table compiled to one projection of built-in functions.

Words are runs of anything but ASCII white space; lines are split at ``\\n``. NULL and
empty text have no words, so they fail the length rule. Each row is judged by itself:
repeated rows get equal verdicts, an empty table gives an empty one, and columns of the
input that share a name with a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.llm.native import words_of

# Frequent function words of the languages at hand, for the stop-word ratio.
STOP_WORDS = {
    "en": "the of and to in is it that was for on with as be by this are from or an not which at when".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como".split(),
}


@dataclass(frozen=True)
class Rule:
    """``feature`` must lie between the bounds; an open bound is None."""

    name: str
    feature: str
    least: float | None = None
    most: float | None = None


# The base rules come first; their names start with ``base_``.
RULES = (
    Rule("base_words", "n_words", least=50),
    Rule("base_repeats", "repeat_word_ratio", most=0.5),
    Rule("word_length", "mean_word_chars", least=2, most=15),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_word_ratio", least=0.02),
    Rule("dup_lines", "dup_line_ratio", most=0.5),
    Rule("bullet_lines", "bullet_line_ratio", most=0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", most=0.3),
)


FEATURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_stop_words",
    "n_lines",
    "mean_word_chars",
    "symbol_ratio",
    "stop_word_ratio",
    "dup_line_ratio",
    "repeat_word_ratio",
    "bullet_line_ratio",
    "ellipsis_line_ratio",
)


def stop_list() -> list[str]:
    small = {w for words in STOP_WORDS.values() for w in words}
    return sorted(small | {w.capitalize() for w in small})


def window_hash(*words: Column) -> Column:
    return F.xxhash64(*words)


def _covered(positions: Column, width: int) -> Column:
    """Places covered by spans of ``width`` at ascending start positions."""
    gap = F.transform(
        positions,
        lambda p, k: F.when(k + 1 < F.size(positions), F.least(F.get(positions, k + 1) - p, F.lit(width))).otherwise(width),
    )
    return F.aggregate(gap, F.lit(0).cast("bigint"), lambda total, n: total + n)


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts and ratios of each text, one row for a row, besides ``docs``' columns.

    Windows of three words are sorted by a hash that holds their position in its low
    bits, so equal windows are neighbours and no step is quadratic in the length of a
    text. Neighbours count as equal only if their words are; where words differ under one
    hash, all windows are asked.
    """
    stop = stop_list()
    has_word = r"[^\x20\x09-\x0D]"
    body = F.coalesce(F.col(text), F.lit(""))
    n, lines = F.size("_words"), F.size("_lines")
    share = lambda count, of: F.coalesce(F.try_divide(count.cast("double"), of), F.lit(0.0))
    matching = lambda pattern: F.size(F.filter("_lines", lambda line: line.rlike(pattern)))
    found = docs.withColumns(
        {
            "_words": words_of(F.col(text)),
            "_lines": F.filter(F.split(body, "\n"), lambda line: line.rlike(has_word)),
            "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("bigint"),
        }
    ).withColumns(
        {
            "n_words": n.cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_dup_lines": (lines - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(stop))).cast("bigint"),
            "bullet_line_ratio": share(matching(r"^\s*[-*•‣·]\s"), lines),
            "ellipsis_line_ratio": share(matching(r"(\.\.\.|…)\s*$"), lines),
            "n_lines": lines.cast("bigint"),
            # the low bits of a key are the position, the others the hash of the window
            "_low": F.expr("shiftleft(1L, length(bin(size(_words)))) - 1"),
        }
    ).drop("_lines")
    high = F.bitwise_not("_low")
    windows = F.transform(
        F.slice("_words", 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: window_hash(w, F.get("_words", i + 1), F.get("_words", i + 2)).bitwiseAND(high) + i,
    )

    def near(key: Column, other: Column) -> Column:
        return key.bitwiseXOR(other).bitwiseAND(high) == 0

    def same(key: Column, other: Column) -> Column:
        at, there = key.bitwiseAND(F.col("_low")).cast("int"), other.bitwiseAND(F.col("_low")).cast("int")
        equal = near(key, other)
        for k in range(3):
            equal = equal & (F.get("_words", at + k) == F.get("_words", there + k))
        return equal

    def found_at(w: Column, place: Column, side: Callable[[Column], Column]) -> Column:
        """Whether a window equals the one at a place, or another one on that side of it."""
        other = F.get("_sorted", place)
        return near(w, other) & (same(w, other) | F.exists("_sorted", lambda o: side(o) & same(w, o)))

    before = lambda w, k: found_at(w, k - 1, lambda o: o < w)
    either = lambda w, k: before(w, k) | found_at(w, k + 1, lambda o: o > w)
    at = F.sort_array(F.transform(F.filter("_sorted", either), lambda w: w.bitwiseAND(F.col("_low"))))
    found = found.withColumn("_sorted", F.sort_array(windows))
    found = found.withColumn("_repeats", F.size(F.filter("_sorted", before)))
    # most texts repeat no window and skip the second look
    found = found.withColumn("_again", F.when(F.col("_repeats") > 0, at)).drop("_words", "_sorted")
    found = found.withColumn("n_repeat_words", F.coalesce(_covered(F.col("_again"), 3), F.lit(0).cast("bigint")))
    found = found.withColumns(
        {
            "mean_word_chars": share(F.col("word_chars"), F.col("n_words")),
            "symbol_ratio": share(F.col("n_symbols"), F.col("n_words")),
            "stop_word_ratio": share(F.col("n_stop_words"), F.col("n_words")),
            "dup_line_ratio": share(F.col("n_dup_lines"), F.col("n_lines")),
            "repeat_word_ratio": share(F.col("n_repeat_words"), F.col("n_words")),
        }
    )
    # Out of a generator, a later filter on a feature stays above it. Pushed down, it would
    # hold all steps as one expression and repeat them for every window.
    measured = F.inline(F.array(F.struct(*FEATURES)))
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in FEATURES and c in found.columns]
    return found.select(*rest, measured)


def _broken(rule: Rule) -> Column:
    tests = []
    if rule.least is not None:
        tests.append(F.col(rule.feature) < rule.least)
    if rule.most is not None:
        tests.append(F.col(rule.feature) > rule.most)
    test = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return F.when(test, rule.name)


def judge(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Features of each text, the names of the rules it breaks, and the two verdicts."""
    failed = F.array_compact(F.array(*[_broken(r) for r in rules])).cast("array<string>")
    base = [r.name for r in rules if r.name.startswith("base_")]
    judged = features(docs, text).withColumn("failed_rules", failed)
    return judged.withColumns(
        {
            "base_failed": F.arrays_overlap("failed_rules", F.array(*[F.lit(b) for b in base])) if base else F.lit(False),
            "kept": F.size("failed_rules") == 0,
        }
    )
