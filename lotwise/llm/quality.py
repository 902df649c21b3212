"""Quality rules: a table of thresholds, compiled into one projection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import SPACE, let, packed, unused, words

#: Very common words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from he in is it not of on or she that the they this to was were which with you "
    "als auch auf aus bei das dem den der des die ein eine einer er es für ich im ist mit nicht sich sie und von wie zu "
    "au aux avec ce dans de du elle en est et il la le les ne ou par pas pour que qui se son sont sur un une vous "
    "al como con del el ella las lo los más no para pero por si sin su sus una y"
).split()
#: Taken off both ends of a word before it is looked up, and capitals that are then made small.
EDGE = ".,;:!?¡¿\"'()[]{}…«»“”„‘’*_-"
CAPITALS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZÁÉÍÑÓÖÚÜÄ", "abcdefghijklmnopqrstuvwxyzáéíñóöúüä")
#: Words of a repeat window: a power of two, as its hash is built by doubling.
WINDOW = 8
MAX_LENGTH = 1 << 30


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie between ``low`` and ``high``, both included; None is no bound."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: Metrics that the rules may name, over the base columns.
METRICS: dict[str, Callable[[], Column]] = {
    "words": lambda: F.col("n_words").cast("double"),
    "mean_word_chars": lambda: F.try_divide("word_chars", "n_words"),
    "symbols_per_word": lambda: F.try_divide("n_symbols", "n_words"),
    "stop_word_share": lambda: F.try_divide("n_stop_words", "n_words"),
    "duplicate_line_share": lambda: F.try_divide("n_dup_lines", "n_lines"),
    "ellipsis_line_share": lambda: F.try_divide("n_ellipsis_lines", "n_lines"),
    "bullet_line_share": lambda: F.try_divide("n_bullet_lines", "n_lines"),
}

RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 14.0),
    Rule("symbols", "symbols_per_word", None, 0.2),
    Rule("stop_words", "stop_word_share", 0.02, None),
    Rule("duplicate_lines", "duplicate_line_share", None, 0.5),
    Rule("ellipsis_lines", "ellipsis_line_share", None, 0.5),
    Rule("bullet_lines", "bullet_line_share", None, 0.9),
)
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows that occur twice or more, from the hash of each window in order.

    Only texts that hold a repeat sort their windows; a position covers the words up to the next one, at most a window.
    """

    def covered(all_hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(all_hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(sorted_pairs: Column) -> Column:
            def twice(pair: Column, k: Column) -> Column:
                other = lambda at: F.get(sorted_pairs, at)["h"].eqNullSafe(pair["h"])
                return other(k - 1) | other(k + 1)

            return F.sort_array(F.transform(F.filter(sorted_pairs, twice), lambda p: p["i"]))

        def spans(at: Column) -> Column:
            reach = lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))
            return F.aggregate(F.transform(at, reach), F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(pairs, repeats), spans)

    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(hashes, covered)).otherwise(
        F.lit(0).cast("long")
    )


def text_stats(docs: DataFrame) -> DataFrame:
    """``docs`` with the base columns: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and line counts.

    Base columns replace columns of the same name. Windows of a text are compared by XXH64 of their words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # A line counts if it holds a word.
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))
    # Columns of its own, under names that the table does not have.
    w, at_lines, h = (unused(docs, f"__{name}") for name in ("words", "lines", "windows"))
    n = F.size(w)
    # Hashes of 8 words from hashes of 4, of 2, of 1: a step joins each hash with the one that follows its words.
    join = lambda width: lambda h: F.zip_with(h, F.slice(h, width + 1, MAX_LENGTH), lambda a, b: F.xxhash64(a, b))
    hashes = F.transform(w, lambda x: F.xxhash64(x))
    for width in (1, 2, 4):
        hashes = let(hashes, join(width))
    windows = F.slice(hashes, 1, F.greatest(n - (WINDOW - 1), F.lit(0)))
    long = lambda c: c.cast("long")
    stop = [F.lit(w) for w in STOP_WORDS]
    base = {
        "n_words": long(n),
        "word_chars": long(F.length(F.array_join(w, ""))),
        "n_symbols": long(F.regexp_count(text, F.lit("[#*$%&|<>]"))),
        "n_stop_words": long(F.size(F.filter(w, lambda x: F.translate(F.btrim(x, F.lit(EDGE)), *CAPITALS).isin(*stop)))),
        "n_lines": long(F.size(at_lines)),
        "n_dup_lines": long(F.size(at_lines) - F.size(F.array_distinct(at_lines))),
        "n_ellipsis_lines": long(F.size(F.filter(at_lines, lambda x: x.rlike(rf"(\.\.\.|…)[{SPACE}]*$")))),
        "n_bullet_lines": long(F.size(F.filter(at_lines, lambda x: x.rlike(rf"^[{SPACE}]*[-*•·]")))),
        "n_repeat_words": _repeat_words(F.col(h)),
    }
    split = docs.withColumns({w: words(F.col("text")), at_lines: lines}).withColumn(h, windows)
    return split.withColumns(base).drop(w, at_lines, h)


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with the base columns, ``base_failed``, ``failed_rules`` (names) and ``kept``.

    ``rules`` is compiled into one projection; a ratio without a denominator (no words, no lines) breaks no rule.
    A text fails the base with fewer than 20 words or more than 30 percent of its words in repeated 8-word windows.

    Null and empty texts have no words and fail the base. Repeated rows get equal verdicts. An empty table gives an
    empty one. Added columns replace columns of the same name; all others are carried.
    """
    stats = text_stats(docs)
    broken = []
    for rule in rules:
        metric = METRICS[rule.metric]()
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (metric < F.lit(float(rule.low)))
        if rule.high is not None:
            bad = bad | (metric > F.lit(float(rule.high)))
        broken.append(F.when(bad, F.lit(rule.name)))
    failed = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    judged = stats.withColumns({"base_failed": base_failed, "failed_rules": failed})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def kept_documents(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with its columns as they are, also those named like base columns.

    The verdict drops rows as an explode of nothing: a filter would be pushed below the projections and compute the
    words of a text again for every metric that it uses.
    """
    rows = packed(docs, F.col("text"))
    once = F.explode(F.when(F.col("kept"), F.array(F.lit(True)))).alias("__once")
    return quality_rules(rows, rules).select("row", once).select("row.*")
