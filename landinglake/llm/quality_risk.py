"""Quality rules whose cutoffs carry a guarantee on how many good documents they reject.

Every document gets one severity: the largest of its shares (symbols, capitals, exclamation marks,
repeated lines, repeated windows, words said twice), each in units of its rule. A document is
rejected when its severity exceeds the cutoff of its stratum (its language).

Cutoffs come from labelled documents, equal texts of a stratum as one, split by a hash of their
(least) id into a half that chooses and a half that certifies. What counts as lost is every good
document that would not be kept, by the fixed base rules of ``base_failed`` too. Going from the most
lenient level to the strictest, a level is certified while the exact binomial test on the good
documents of the certifying half rejects "at least ``risk`` of the stratum's good documents would be
lost" at ``error / strata`` (fixed-sequence testing within a stratum, Bonferroni across strata). So
with probability 1 - ``error`` no stratum with a certified level loses more than ``risk`` of its
good documents. Among certified levels the other half takes the one that separates bad from good
best, the more lenient one on ties. A stratum without a certified level rejects nothing by severity.

The base rules apply in any case. Where they alone lose more than ``risk``, no level is certified
and no bound can hold, as the rules aren't this module's to change; ``cutoffs`` gives such strata
``certified`` = 0 and shows in ``base_lost`` how many good documents of the half the rules reject.

DataFrame functions only. Text is read once, numbers are stored, and only these are joined with
the labels. Edge cases: a null text has no words (and so fails the base rules); a null stratum is a
stratum of its own; a document with several labels counts as bad if one says so; rows without a
doc_id have no label; copies of a text count as one trial, which is bad if one of them is; ties go
to the more lenient level; a very long text is split within its row; without labels nothing is
certified; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landinglake.llm.tables import stored

# White space as Java's regular expressions and translate write it.
SPACES = "[ \t\n\x0b\f\r]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words

# What each rule measures, and the share that makes a severity of 1.
UNITS = {"symbols": 0.05, "capitals": 0.25, "marks": 0.1, "lines": 0.4, "windows": 0.2,
         "doubled": 0.1}
# Levels of severity tried as cutoffs, lenient first.
LEVELS = (6.0, 4.0, 3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.25)
RISK = 0.02
ERROR = 0.05


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _windows(words: Column) -> Column:
    """Hashes of all windows of ``WINDOW`` words."""
    from_here = F.transform(words, lambda w, i: F.xxhash64(
        w, *(F.get(words, i + k) for k in range(1, WINDOW))))
    return F.slice(from_here, 1, F.size(words) - (WINDOW - 1))


def _repeated_at(placed: Column) -> Column:
    """Numbers of the windows whose hash occurs more than once, from sorted (hash, number)."""
    return F.sort_array(F.filter(F.transform(placed, lambda s, i: F.when(
        (s["h"] == F.get(placed, i - 1)["h"]) | (s["h"] == F.get(placed, i + 1)["h"]), s["i"])),
        lambda i: i.isNotNull()))


def _covered(at: Column) -> Column:
    """Words covered by windows that begin at these sorted numbers."""
    return F.aggregate(
        F.transform(at, lambda x, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"), lambda total, x: total + x)


def measure(docs: DataFrame, stratum: str = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    severity, digest of the text) and the columns ``carry`` for every row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", *carry, F.col(stratum).cast("string").alias("stratum"),
                       text.alias("text"))
    rows = rows.select("doc_id", *carry, "stratum", "text",
                       F.array_remove(F.split("text", SPACES), "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^ \t\n\x0b\f\r]"))
    windows = F.when(F.size("words") > WINDOW, _windows(F.col("words")))
    rows = rows.select(
        "doc_id", *carry, "stratum", F.size("words").cast("bigint").alias("n_words"),
        _count_of(F.col("text"), " \t\n\x0b\f\r").alias("spaces"), F.length("text").alias("length"),
        _count_of(F.col("text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        _count_of(F.col("text"), CAPITALS).alias("n_capitals"),
        _count_of(F.col("text"), "!").alias("n_marks"),
        F.size(F.filter("words", lambda w, i: w == F.get("words", i - 1))).alias("n_doubled"),
        F.xxhash64("text").alias("digest"), lines.alias("lines"), windows.alias("windows"))
    # Arrays that lambdas look into are columns of their own, made once per row. Only rows with a
    # repeated window sort theirs.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("placed", F.when(repeats, F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    rows = rows.withColumn("at", _repeated_at(F.col("placed")))
    repeated = F.coalesce(_covered(F.col("at")), F.lit(0)).cast("bigint")
    rows = rows.select(
        "doc_id", *carry, "stratum", "n_words", (F.col("length") - F.col("spaces")).cast("bigint")
        .alias("word_chars"), "n_symbols", "n_capitals", "n_marks", "n_doubled", "digest",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"))

    def share(part, whole, rule):
        return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0)) / UNITS[rule]

    severity = F.greatest(
        share("n_symbols", "word_chars", "symbols"), share("n_capitals", "word_chars", "capitals"),
        share("n_marks", "n_words", "marks"), share("n_dup_lines", "n_lines", "lines"),
        share("n_repeat_words", "n_words", "windows"), share("n_doubled", "n_words", "doubled"))
    failed = ((F.col("n_words") < LEAST_WORDS)
              | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    return rows.select("doc_id", *carry, "stratum", "n_words", "word_chars", "n_symbols",
                       "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       severity.alias("severity"), "digest")


def _binomial_tail(rejected: Column, total: Column, risk: float) -> Column:
    """P(Binomial(total, risk) <= rejected), summed in logarithms; 1 where that exceeds the mean."""
    first = total * math.log1p(-risk)
    state = F.struct(first.alias("term"), first.alias("sum"))

    def step(s, i):
        term = (s["term"] + F.log((total - i + 1) / i) + math.log(risk) - math.log1p(-risk))
        top = F.greatest(s["sum"], term)
        return F.struct(term.alias("term"),
                        (top + F.log1p(F.exp(-F.abs(s["sum"] - term)))).alias("sum"))

    summed = F.when(rejected == 0, F.exp(first)).otherwise(F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), F.greatest(rejected, F.lit(1).cast("bigint"))),
        state, step, lambda s: F.exp(s["sum"])))
    return F.when(rejected > total * risk, F.lit(1.0)).otherwise(summed)


def _certifies(doc_id: Column) -> Column:
    """Is a labelled document in the half that certifies?"""
    return F.substring(F.md5(doc_id.cast("string").cast("binary")), 1, 1) < "8"


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR,
            levels: tuple[float, ...] = LEVELS) -> DataFrame:
    """(stratum, n_good, base_lost, certified, cutoff) per stratum with labels: good texts that
    certify and how many of them fail the base rules, number of certified levels, and the chosen
    one, null if there is none."""
    marked = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # Labelled documents are few; equal texts have equal measures.
    texts = (measured.join(marked, "doc_id").filter("quality is not null")
             .groupBy("stratum", "digest").agg(
                 F.min("quality").alias("quality"), F.min("doc_id").alias("doc_id"),
                 F.max("severity").alias("severity"), F.max("base_failed").alias("base_failed")))
    rows = texts.select("stratum", "severity", "base_failed", (F.col("quality") > 0).alias("good"),
                        _certifies(F.col("doc_id")).alias("certifies"))

    def lost(condition):
        return F.array(*(F.count_if(condition & (F.col("base_failed") | (F.col("severity") > level)))
                         for level in levels))

    good, certifies = F.col("good"), F.col("certifies")
    counts = stored(rows.groupBy("stratum").agg(
        F.count_if(good & certifies).alias("n_good"),
        F.count_if(good & certifies & F.col("base_failed")).alias("base_lost"), lost(good & certifies).alias("lost"),
        F.count_if(good & ~certifies).alias("chose_good"), lost(good & ~certifies).alias("good"),
        F.count_if(~good & ~certifies).alias("chose_bad"), lost(~good & ~certifies).alias("bad"),
    ), "holdout")
    bound = error / max(1, counts.count())  # one row per stratum
    passed = F.transform("lost", lambda n: _binomial_tail(n, F.col("n_good"), risk) <= bound)
    failure = F.array_position(passed, False)
    certified = F.when(failure == 0, F.lit(len(levels))).otherwise(failure - 1).cast("int")
    each = F.transform(F.arrays_zip("good", "bad"), lambda n, i: F.struct(
        (F.coalesce(F.try_divide(n["bad"], F.col("chose_bad")), F.lit(0.0))
         - F.coalesce(F.try_divide(n["good"], F.col("chose_good")), F.lit(0.0))).alias("gain"),
        (-i).alias("lenient")))
    best = F.array_max(F.slice(each, 1, F.col("certified")))
    return counts.withColumn("certified", certified).select(
        "stratum", "n_good", "base_lost", "certified",
        F.when(best["gain"] > 0, F.get(F.array(*map(F.lit, levels)), -best["lenient"]))
        .alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK,
          error: float = ERROR, carry: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``measure`` with the stratum's ``cutoff`` and ``kept``, for every row of
    ``docs`` (doc_id, text and the stratum's column); ``labels`` has doc_id and quality (0, 1)."""
    measured = stored(measure(docs, stratum, carry), "measured")
    chosen = cutoffs(measured, labels, risk, error).select(
        F.col("stratum").alias("of"), F.col("cutoff"))
    joined = measured.join(chosen, F.col("stratum").eqNullSafe(F.col("of")), "left").drop("of")
    rejected = F.coalesce(F.col("severity") > F.col("cutoff"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected)
