"""Line-first cleaning, in DataFrame functions only.

Each line is judged by itself: navigation (many bars), symbols, capitals, boilerplate
phrases, a repeat of an earlier line, a short line without closing punctuation. Failing lines are removed;
a text that loses too many of its words, or fails the base rules, is rejected.
All shares are compared in whole numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import ROW, packed, text_of, unpacked, words

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
LOWER = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
CLOSING = r"[.!?:;…。！？\"'”’»)\]]$"
PHRASES = (
    "all rights reserved|terms of (use|service)|privacy policy|cookie policy|accept cookies|"
    "click here|sign (in|up)|log in|enable javascript|share this|skip to content"
)
# A line with more capitals than small letters has a capital that no small letter follows
# before the next capital or the end.
SHOUTED = f"[{UPPER}][^{LOWER}]*([{UPPER}]|$)"
# A shorter line without closing punctuation is a heading or a menu entry.
OPEN_WORDS = 20
MAX_LOST_PERCENT = 40
RESULTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "lost_words", "clean_text", "kept",
]


def occurrences(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def repeated_words(w: Column) -> Column:
    """Words that lie in a window of three which the text holds more than once."""
    spots = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    prints = F.transform(spots, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return prints


def covered(prints: Column) -> Column:
    """Words under windows whose print occurs again, from all window prints in order."""
    in_order = F.sort_array(F.transform(prints, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(s: Column) -> Column:
        same = F.filter(
            s, lambda x, k: (x["h"] == F.get(s, k + 1)["h"]) | F.when(k > 0, x["h"] == F.get(s, F.greatest(k - 1, F.lit(0)))["h"]).otherwise(False)
        )
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    # One-element arrays name the steps, so that each is computed once.
    spots = F.transform(F.array(in_order), again)
    return F.get(F.transform(spots, total), F.lit(0))


def repeats(lines: Column) -> Column:
    """Per line in order, whether an earlier line equals it."""
    in_order = F.sort_array(F.transform(lines, lambda l, k: F.struct(l.alias("l"), k.alias("k"))))
    marked = F.transform(
        F.array(in_order),
        lambda s: F.transform(
            s, lambda x, j: F.struct(x["k"].alias("k"), ((j > 0) & (x["l"] == F.get(s, F.greatest(j - 1, F.lit(0)))["l"])).alias("again"))
        ),
    )
    return F.transform(F.sort_array(F.get(marked, F.lit(0))), lambda x: x["again"])


def judged(lines: Column, again: Column, symbols: Column, phrases: Column) -> Column:
    """Per line in order: line, its words, whether it fails.

    ``again`` says of each line whether it repeats one (null: none does), ``symbols`` and
    ``phrases`` whether the text holds any symbol or phrase at all; only then are they
    looked for in its lines. What a rule needs of a line is a field, so that it is computed
    once: functions inside ``transform`` are evaluated wherever they are written.
    """
    def facts(text: Column) -> Column:
        return F.transform(
            lines,
            lambda line, k: F.struct(
                line.alias("line"),
                F.size(words(line)).alias("n"),
                F.coalesce(F.get(text["again"], k), F.lit(False)).alias("again"),
                F.when(text["symbols"], occurrences(line, "|")).otherwise(0).alias("bars"),
                F.when(text["symbols"], occurrences(line, SYMBOLS)).otherwise(0).alias("symbols"),
                text["phrases"].alias("phrases"),
            ),
        )

    def verdict(x: Column) -> Column:
        line, n, bars = x["line"], x["n"], x["bars"]
        fails = (
            x["again"]
            | ((bars >= 3) & (5 * bars >= n))
            | (2 * x["symbols"] > n)
            | ((n < OPEN_WORDS) & ~F.rtrim(line).rlike(CLOSING))
            | (line.rlike(SHOUTED) & (occurrences(line, UPPER) > occurrences(line, LOWER)))
            | (x["phrases"] & F.lower(line).rlike(PHRASES))
        )
        return F.struct(line.alias("line"), n.alias("n"), ((n > 0) & fails).alias("fails"))

    # A one-element array names what is known of the whole text.
    whole = F.array(F.struct(again.alias("again"), symbols.alias("symbols"), phrases.alias("phrases")))
    return F.transform(F.get(F.transform(whole, facts), F.lit(0)), verdict)


def clean_lines(docs: DataFrame, text_col: str = "text", max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``lost_words`` (words of failing
    lines), ``clean_text`` (the other lines) and ``kept``.

    A null text has no words and fails the base rules like an empty one. Rows are judged
    one by one, so ties and repeats change nothing. Input columns named like a result are
    replaced by it.
    """
    text = text_of(f"{ROW}.`{text_col}`")
    read = docs.select(packed(docs)).select(ROW, words(text).alias("w"), F.split(text, "\n").alias("lines"), text.alias("t"))
    read = read.select(
        "*", repeated_words(F.col("w")).alias("prints"), F.filter("lines", lambda l: F.translate(l, " \t\n\x0b\x0c\r", "") != "").alias("full")
    )
    some = F.size(F.array_distinct("prints")) < F.size("prints")
    read = read.withColumn("n_symbols", occurrences(F.col("t"), SYMBOLS).cast("long"))
    read = read.withColumn("n_dup_lines", (F.size("full") - F.size(F.array_distinct("full"))).cast("long"))
    read = read.withColumn("phrases", F.lower("t").rlike(PHRASES))
    found = read.select(
        ROW,
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        F.when(some, covered(F.col("prints"))).otherwise(0).cast("long").alias("n_repeat_words"),
        judged(
            F.col("lines"), F.when(F.col("n_dup_lines") > 0, repeats(F.col("lines"))), F.col("n_symbols") > 0, F.col("phrases")
        ).alias("judged"),
    )
    bad = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost = F.aggregate("judged", F.lit(0).cast("long"), lambda a, x: a + F.when(x["fails"], x["n"]).otherwise(0))
    clean = F.array_join(F.transform(F.filter("judged", lambda x: ~x["fails"]), lambda x: x["line"]), "\n")
    found = found.withColumn("base_failed", bad).withColumn("lost_words", lost).withColumn("clean_text", clean)
    kept = ~F.col("base_failed") & (100 * F.col("lost_words") <= max_lost_percent * F.col("n_words"))
    return unpacked(found.withColumn("kept", kept), docs.columns, RESULTS)
