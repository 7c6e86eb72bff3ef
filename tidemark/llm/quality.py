"""Quality rules: a threshold table compiled into one projection.

``measures`` is one Spark expression that gives a struct of counts over the
words, lines and characters of a text; ``RULES`` is the threshold table.
``judge`` evaluates both in the row, with built-in functions only: no shuffle
and no user functions. The struct is laid out by a generator, so a filter on
``kept`` or any other result stays above it and nothing is computed twice.

Repeated 8-word windows are found by sorting 64-bit hashes of a text's own
windows (two different windows of one text agree with a chance of about
n^2 / 2^65).

Cases: null text has no words, every count is 0, and the base rule fails it;
the work for a very long text grows with its length (times log for the windows);
its words must fit in the memory of the task; nothing is ranked, so there are
no ties; repeated rows are judged row by row; an empty table gives an empty
table; all columns pass through, whatever their names, and the added ones
replace columns of their name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SPACE = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent words of the four languages (fixed list).
STOP_WORDS = (
    "the of and in to is was that for on with as by at from this it are be or an which he she not have has "
    "der die das und ist von mit den dem des ein eine im zu auf nicht für sich auch als "
    "le la les des une un et est pour dans que qui sur pas au avec ce par du de "
    "el los las del y en que por con para una su se no es al lo como más o a"
).split()


@dataclass(frozen=True)
class Rule:
    """A text fails when ``measure`` is below ``low`` or above ``high``."""

    measure: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        out = F.lit(True)
        if self.low is not None:
            out &= F.col(self.measure) >= self.low
        if self.high is not None:
            out &= F.col(self.measure) <= self.high
        return out


#: The threshold table.
RULES = (
    Rule("mean_word_length", 2.0, 12.0),
    Rule("symbol_ratio", high=0.2),
    Rule("exclaimed_ratio", high=0.3),
    Rule("stop_word_ratio", low=0.03),
    Rule("dup_line_ratio", high=0.6),
    Rule("same_as_before_ratio", high=0.2),
)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACE, " " * len(SPACE)), " "), "")


def count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(ws: Column, size: int = WINDOW) -> Column:
    """Words in windows of ``size`` words that the array holds twice or more, the first ones included."""
    last = F.size(ws) - size

    def covered(windows: Column) -> Column:
        # positions of windows whose hash stands beside an equal one in sorted order
        again = F.filter(
            F.transform(windows, lambda w, i: F.when((w["h"] == F.get(windows, i - 1)["h"]) | (w["h"] == F.get(windows, i + 1)["h"]), w["at"])),
            lambda at: at.isNotNull(),
        )
        start = F.struct(F.lit(-size).alias("at"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(F.array_sort(again), start, lambda s, at: F.struct(at.alias("at"), (s["n"] + F.least(at - s["at"], F.lit(size))).alias("n")))["n"]

    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(ws, i + 1, size)))

    def of(hs: Column) -> Column:
        pairs = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(_let(pairs, covered))

    return F.when(last < 1, F.lit(0).cast("long")).otherwise(_let(hashes, of))


def _same_as_before(ws: Column) -> Column:
    """Words equal to the word before them."""
    n = F.size(ws)
    return F.when(n < 2, 0).otherwise(F.size(F.filter(F.zip_with(F.slice(ws, 1, F.greatest(n - 1, F.lit(0))), F.slice(ws, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: a == b), lambda x: x)))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("mean_word_length", "symbol_ratio", "exclaimed_ratio", "stop_word_ratio", "dup_line_ratio", "same_as_before_ratio")


def measures(text: Column) -> Column:
    """The struct of COUNTS and MEASURES of a text."""

    def counted(t: Column, ws: Column, lines: Column) -> Column:
        values = {
            "n_words": F.size(ws).cast("long"),
            "word_chars": F.length(F.translate(t, SPACE, "")).cast("long"),
            "n_symbols": count_of(t, SYMBOLS),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": repeated_words(ws),
            "marks": count_of(t, "!"),
            "stop_words": F.size(F.filter(ws, lambda w: F.lower(w).isin(*STOP_WORDS))),
            "lines": F.size(lines),
            "same_as_before": _same_as_before(ws),
        }
        return F.struct(*(v.alias(k) for k, v in values.items()))

    def with_ratios(c: Column) -> Column:
        n = F.greatest(c["n_words"], F.lit(1)).cast("double")
        ratios = {
            "mean_word_length": c["word_chars"] / n,
            "symbol_ratio": c["n_symbols"] / n,
            "exclaimed_ratio": c["marks"] / n,
            "stop_word_ratio": c["stop_words"] / n,
            "dup_line_ratio": c["n_dup_lines"] / F.greatest(c["lines"], F.lit(1)),
            "same_as_before_ratio": c["same_as_before"] / n,
        }
        return F.struct(*(c[k].alias(k) for k in COUNTS), *(v.alias(k) for k, v in ratios.items()))

    def with_text(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
        return _let(words(t), lambda ws: _let(lines, lambda ls: _let(counted(t, ws, ls), with_ratios)))

    return _let(F.coalesce(text, F.lit("")), with_text)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with counts, measures, base_failed, failed (names of the rules that fail) and kept."""
    added = {*COUNTS, *MEASURES, "base_failed", "failed", "kept"}
    rest = [c for c in docs.columns if c not in added]
    measured = docs.select(*(F.col(f"`{c}`") for c in rest), F.inline(F.array(measures(F.col(f"`{text_col}`")))))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    names = F.array_compact(F.array(*(F.when(~r.passes(), F.lit(r.measure)) for r in rules)))
    return measured.withColumns({"base_failed": base, "failed": names}).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
