"""Quality rules: a threshold table compiled into one Spark projection.

Each metric is a native expression over the text; each rule names a metric, a comparison and a bound. The table
compiles to one boolean per document - no user function, no shuffle, one pass over the text.

Defined cases: null and empty texts have no words (all counts 0, base failed); very long texts stay in one row and
cost n log n; repeated rows are judged alike; extra columns pass through, but one named like a metric or a verdict is
replaced by it (``kept_rows`` returns the rows as they came, whatever their columns are called).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, WS_CLASS, let, lines_of, text_or_empty, words_of

#: Frequent function words of the four languages served; a parameter of the operator.
STOP_WORDS = (
    "the of and to in a is that for it on with as was be by this are at from or an which not have "
    "de la le et les des en un une du que pour dans est sur par qui au avec ce "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch "
    "el los las y del se por con no para su al lo como una o pero"
).split()

#: (metric, comparison, bound): a document is kept when every line holds. A parameter of the operator.
THRESHOLDS = (
    ("n_words", ">=", 10.0),
    ("repeat_ratio", "<=", 0.20),
    ("mean_word_chars", ">=", 2.0),
    ("mean_word_chars", "<=", 14.0),
    ("symbol_ratio", "<=", 0.30),
    ("stop_word_ratio", ">=", 0.035),
    ("upper_ratio", "<=", 0.60),
    ("dup_line_ratio", "<=", 0.50),
)

_COMPARE = {
    ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
}


def repeated_words(words: Column, n: int = 5) -> Column:
    """Words covered by an ``n``-word window that occurs at least twice in the array, first occurrence included."""

    def covered(grams: Column) -> Column:
        pairs = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda x, k: (F.get(s, k - 1)["g"] == x["g"]) | (F.get(s, k + 1)["g"] == x["g"]),
            )
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def total(p: Column) -> Column:
            new = F.transform(p, lambda x, k: F.when(k == 0, n).otherwise(F.least(F.lit(n), x - F.get(p, k - 1))))
            return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(pairs, starts), total)

    def over(h: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(h) - (n - 1)), lambda i: F.xxhash64(F.slice(h, i, n)))
        return F.when(F.size(h) < n, F.lit(0).cast("long")).otherwise(
            let(
                grams,
                lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(covered(g)),
            )
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), over)


def metrics(docs: DataFrame, text_col: str = "text", stop_words=tuple(STOP_WORDS)) -> DataFrame:
    """``docs`` with the counts (long) and ratios (double) the rules refer to."""
    text = text_or_empty(text_col)
    words, has_word = F.col("__qr_words"), F.filter(
        lines_of(text), lambda x: F.length(F.btrim(x, F.lit(WS_CHARS))) > 0
    )
    stop = sorted(set(stop_words))
    counted = docs.withColumn("__qr_words", words_of(text)).withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.regexp_replace(text, WS_CLASS + "+", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_dup_lines": let(has_word, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
            "n_lines": F.size(has_word).cast("long"),
            "n_repeat_words": repeated_words(words).cast("long"),
            "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(stop))).cast("long"),
            "n_upper": F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long"),
        }
    )

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    return counted.withColumns(
        {
            "repeat_ratio": ratio("n_repeat_words", "n_words"),
            "mean_word_chars": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "n_words"),
            "stop_word_ratio": (F.col("n_stop_words") + 1) / (F.col("n_words") + 1),  # lenient on short texts
            "upper_ratio": ratio("n_upper", "word_chars"),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        }
    ).drop("__qr_words")


def compile_rules(thresholds=THRESHOLDS) -> Column:
    """One boolean: every row of the threshold table holds."""
    out = F.lit(True)
    for metric, op, bound in thresholds:
        out = out & _COMPARE[op](F.col(metric), F.lit(bound))
    return out


def quality_rules(docs: DataFrame, text_col: str = "text", thresholds=THRESHOLDS, stop_words=tuple(STOP_WORDS)):
    """``docs`` with the metrics, ``base_failed`` (fewer than 10 words, or over a fifth of them in repeated 5-word
    windows) and ``kept`` (base not failed and every threshold holds)."""
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        metrics(docs, text_col, stop_words)
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & compile_rules(thresholds))
    )


def kept_rows(docs: DataFrame, text_col: str = "text", thresholds=THRESHOLDS, stop_words=tuple(STOP_WORDS)) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged. The verdict feeds an outer explode of zero or one row: a plain
    filter on it would be pushed below the projection, where every metric is written out and computed once more."""
    judged = quality_rules(docs.select(F.struct("*").alias("__qr_row"), F.col(text_col).alias("text")), "text", thresholds, stop_words)
    one = F.explode_outer(F.when(F.col("kept"), F.array("__qr_row"))).alias("__qr_row")
    return judged.select(one).where("__qr_row is not null").select("__qr_row.*")
