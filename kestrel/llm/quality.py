"""Quality rules: a threshold table compiled into one Spark projection.

No user functions and no shuffle: every measure is an expression over the
row's own text.  Repeated three-word windows are found by sorting (hash,
position) pairs inside the row, so the cost is n log n in the words of a text.

Nulls and edge cases: a null or blank text has no words, all counts 0, fails
the base rule and is not kept.  Repeated rows are judged row by row.  Input
columns other than ``id_col`` and ``text_col`` are ignored, so clashing names
do no harm.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import SPACE, let, words

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that it for was with be this on by are from or as at not "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "le la les des et en un une du que est pour dans par sur au pas avec plus ce "
    "el los las y que del se por con para una su al lo como más no"
).split()

#: Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"

#: measure, comparison, bound: a text is rejected by each row that holds.
RULES: tuple[tuple[str, str, float], ...] = (
    ("mean_word_chars", "<", 2.0),
    ("mean_word_chars", ">", 15.0),
    ("symbol_ratio", ">", 0.1),
    ("stop_word_ratio", "<", 0.02),
    ("dup_line_ratio", ">", 0.5),
)

#: Base rule: at least so many words, at most this share in repeated windows.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _repeat_words(w: Column) -> Column:
    """Words that lie in a three-word window found at least twice in the text.

    A hash set tells whether any window repeats at all; only such texts sort.
    """
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: F.get(s, j - 1)["h"].eqNullSafe(x["h"])
                         | F.get(s, j + 1)["h"].eqNullSafe(x["h"]))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda a, i: F.struct(i.alias("last"),
                                  (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
            lambda a: a["n"])

    def some(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), covered))

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(hashes, some))


def measures(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: counts of the base rule and of the threshold table."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    word = SPACE.replace("[", "[^", 1)[:-1]
    base = docs.select(*[F.col(c) for c in keep], t.alias("_t"), words(F.col(text_col)).alias("_w"),
                       F.filter(F.split(t, "\n", -1), lambda x: x.rlike(word)).alias("_l"))
    w, lines = F.col("_w"), F.col("_l")
    stop = sorted({v for s in STOP_WORDS for v in (s, s.capitalize(), s.upper())})
    return base.select(
        *keep,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate(F.col("_t"), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        let(w, _repeat_words).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(w, lambda x: x.isin(stop))).cast("long").alias("n_stop"))


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


RATIOS = {
    "mean_word_chars": lambda: _ratio("word_chars", "n_words"),
    "symbol_ratio": lambda: _ratio("n_symbols", "n_words"),
    "stop_word_ratio": lambda: _ratio("n_stop", "n_words"),
    "dup_line_ratio": lambda: _ratio("n_dup_lines", "n_lines"),
}


def verdict(rules: tuple[tuple[str, str, float], ...] = RULES) -> Column:
    """True where no row of the threshold table rejects the text."""
    hits = [RATIOS[m]() < b if op == "<" else RATIOS[m]() > b for m, op, b in rules]
    return ~reduce(lambda a, b: a | b, hits, F.lit(False))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: tuple[tuple[str, str, float], ...] = RULES) -> DataFrame:
    """Counts, base rule and verdict per document, in one projection."""
    m = measures(docs, text_col, (id_col,))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return m.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
                    *[f().alias(k) for k, f in RATIOS.items()])
