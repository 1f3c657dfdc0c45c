"""Quality rules: a threshold table compiled into one projection.

Counts of a text are plain column expressions; each row of ``RULES`` bounds a
ratio of two counts; ``kept`` is the conjunction. No user functions and no
shuffle: a document is judged where it is read.

Defined results: a null or empty text has all counts 0 and fails the base rule
(fewer than 10 words); repeated rows are judged alike; other columns pass
through; an empty table gives no rows. A ratio with a denominator of 0 is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import free_name, let, word_array

SYMBOLS = "#*$%&|<>"
GAPS = " \t\n\x0b\f\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Frequent function words of the corpus languages.
STOP_WORDS = {
    "de": "das dem den der des die ein eine im in ist mit nicht sich und von zu auf für",
    "en": "a and are as at be by for from in is it of on that the this to was with",
    "es": "con de del el en es la las los no para por que se su un una y lo al",
    "fr": "au dans de des du elle en est et il la le les pas pour que qui sur un une",
}

# (name, amount above, amount below, lowest, highest); None: no bound. One stop
# word is granted, one repeated line forgiven: ratios of short texts are coarse. From
# 20 words on, a text without any stop word is out, whatever the ratio grants.
RULES = (
    ("mean word length", "word_chars", "n_words", 1.5, 15.0),
    ("symbols per word", "n_symbols", "n_words", None, 0.1),
    ("exclamation marks per word", "n_marks", "n_words", None, 0.3),
    ("any stop word, from 20 words on", "n_stop_words + int(n_words < 20)", "1", 1, None),
    ("stop words", "n_stop_words + 1", "n_words", 0.02, None),
    ("repeated lines", "n_dup_lines - 1", "n_lines", None, 0.3),
)


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_positions(windows: Column) -> Column:
    """Sorted start numbers of the windows whose text occurs twice or more.

    ``windows`` is the sorted array of (text, start) structs.
    """

    def same(s: Column, j: Column, other: Column) -> Column:
        return F.coalesce(F.get(s, j)["w"] == F.get(s, other)["w"], F.lit(False))

    return let(
        windows,
        lambda s: F.sort_array(
            F.transform(
                F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(s, j, j - 1) | same(s, j, j + 1)),
                lambda j: F.get(s, j)["i"],
            )
        ),
    )


def repeat_words(ws: Column, window: int = WINDOW) -> Column:
    """Number of words that lie in a ``window``-word window found twice or more.

    Windows are first hashed; only a text in which two hashes agree compares the
    windows themselves (sorted with their positions), so the count is exact.
    """
    starts = F.sequence(F.lit(0), F.size(ws) - window)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(window)]))
    windows = F.sort_array(
        F.transform(starts, lambda i: F.struct(F.concat_ws(" ", F.slice(ws, i + 1, window)).alias("w"), i.alias("i")))
    )
    gaps = lambda p: F.transform(
        p, lambda x, j: F.when(j == 0, window).otherwise(F.least(F.lit(window), x - F.get(p, j - 1)))
    )
    covered = let(repeated_positions(windows), lambda p: F.aggregate(gaps(p), F.lit(0), lambda a, x: a + x))
    return (
        F.when(F.size(ws) <= window, 0)
        .when(F.size(F.array_distinct(hashes)) == F.size(ws) - window + 1, 0)
        .otherwise(covered)
    )


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts that the base rule and ``RULES`` use (long, null text: 0)."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: F.length(without(line, GAPS)) > 0)
    stop = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    of_words = let(
        word_array(F.col(text)),
        lambda ws: F.struct(
            F.size(ws).alias("n"),
            repeat_words(ws).alias("repeated"),
            F.size(F.filter(ws, lambda w: F.lower(w).isin(stop))).alias("stop"),
        ),
    )
    of_lines = let(lines, lambda ls: F.struct(F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup")))
    length = F.length(t)
    w, ls = free_name(df, "_words"), free_name(df, "_lines")
    read = df.withColumns({w: of_words, ls: of_lines})
    made = {
        "n_words": F.col(f"{w}.n"),
        "word_chars": F.length(without(t, GAPS)),
        "n_symbols": length - F.length(without(t, SYMBOLS)),
        "n_dup_lines": F.col(f"{ls}.dup"),
        "n_repeat_words": F.col(f"{w}.repeated"),
        "n_lines": F.col(f"{ls}.n"),
        "n_marks": length - F.length(without(t, "!")),
        "n_stop_words": F.col(f"{w}.stop"),
    }
    return read.withColumns({k: c.cast("long") for k, c in made.items()}).drop(w, ls)


def verdict(rules=RULES) -> Column:
    """The conjunction of the threshold table."""
    passed = F.lit(True)
    for _, above, below, lowest, highest in rules:
        ratio = F.when(F.expr(below) > 0, F.expr(above) / F.expr(below)).otherwise(0.0)
        if lowest is not None:
            passed = passed & (ratio >= lowest)
        if highest is not None:
            passed = passed & (ratio <= highest)
    return passed


def judge(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``df`` with its counts, ``base_failed`` and ``kept``."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    counted = counts(df, text).withColumn("base_failed", base)
    return counted.withColumn("kept", ~F.col("base_failed") & verdict(rules))
