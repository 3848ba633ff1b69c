"""Interaction audit of text filters: what each filter removes at each step of every order.

Each document is reduced to the mask of the filters it fails, and documents are counted per part
(a language) and mask. A mask is removed at the first of its filters in an order. The orders that
begin alike are neighbours when all orders are numbered lexicographically (by Lehmer code), so the
orders in which a mask goes at one step through one filter are intervals of numbers, one for each
way to put filters that the mask passes before it. The counts of the mask are added where such an
interval begins and taken off where it ends; a running sum over the order numbers then gives the
figures of every order without going through the orders of any mask.

Nothing that grows with the texts is gathered: a text is first met in the scan, which leaves its
digest, mask and id; equal texts are then brought together by digest after they have been counted
per id, part and label, so a text that a third of all documents share is a few rows. Rows without
an id meet no join.

Edge cases: a null or empty text has no words, so it fails ``A`` alone and ``E`` if another empty
text has a smaller id; very long texts are handled whole; a row without an id is no copy of another
and none is a copy of it; repeated rows of one id count as documents each, and are no copies of each
other, as neither id is smaller; labels repeated for one id count once, any 1 among them wins; a
null part is the empty string, as is an empty one; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import string
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landinglake.llm.tables import stored

# The filters, in the order of their bits, and what they test.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
MARKS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"

COUNTS = ("n", "good", "toxic")
_COPY = 1 << FILTERS.index("E")


def text_flags(words: Column, text: Column) -> Column:
    """Bits of the filters that look at a text alone: A to D."""
    n, chars = F.size(words), F.char_length(text)
    capitals = chars - F.char_length(F.translate(text, string.ascii_uppercase, ""))
    failing = (n < LEAST_WORDS,
               100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * n,
               100 * capitals > MOST_CAPITALS * chars,
               text.rlike(MARKS))
    return sum((F.when(test, 1 << bit).otherwise(0) for bit, test in enumerate(failing)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select(F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("part"),
                        text.alias("text"), F.array_remove(F.split(text, SPACE), "").alias("words"))
    # 256 bits stand for the text: equal texts always agree, others never in practice.
    seen = split.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                        text_flags(F.col("words"), F.col("text")).alias("flags"))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    key = ["digest", "part", "flags", "good", "toxic"]
    named = (seen.filter("id is not null").join(marks, "id", "left")
             .fillna(0, ["good", "toxic"]).groupBy("id", *key).agg(F.count(F.lit(1)).alias("n")))
    groups = named.groupBy(*key).agg(F.min(F.struct("id", "n")).alias("first"),
                                     F.sum("n").alias("n"))
    least = groups.withColumn("least", F.min("first.id").over(Window.partitionBy("digest")))
    originals = F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(F.lit(0))
    both = least.select("part", "flags", "good", "toxic", F.explode(F.array(
        F.struct(F.lit(0).alias("copy"), originals.alias("rows")),
        F.struct(F.lit(_COPY).alias("copy"), (F.col("n") - originals).alias("rows")))).alias("x"))
    unnamed = seen.filter("id is null").groupBy("part", "flags").agg(
        F.count(F.lit(1)).alias("rows"))
    counted = both.select("part", (F.col("flags") + F.col("x.copy")).alias("mask"),
                          F.col("x.rows").alias("n"), (F.col("x.rows") * F.col("good")).alias("good"),
                          (F.col("x.rows") * F.col("toxic")).alias("toxic"))
    counted = counted.unionByName(unnamed.select(
        "part", F.col("flags").alias("mask"), F.col("rows").alias("n"),
        F.lit(0).cast("bigint").alias("good"), F.lit(0).cast("bigint").alias("toxic")))
    return (counted.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in COUNTS))
            .filter("n > 0"))


def order_intervals() -> list[tuple[int, int, int, int, int]]:
    """(mask, step, bit, first order, order after the last): where each mask is removed.

    One interval per beginning of an order that a mask passes up to its last filter, which it
    fails. A beginning's first order follows from its Lehmer code.
    """
    size, found = len(FILTERS), []
    for step in range(1, size + 1):
        for begin in permutations(range(size), step):
            rest, first = list(range(size)), 0
            for place, bit in enumerate(begin, 1):
                first += rest.index(bit) * factorial(size - place)
                rest.remove(bit)
            last = first + factorial(size - step)
            passed = sum(1 << bit for bit in begin[:-1])
            found += [(mask, step, begin[-1], first, last) for mask in range(1 << size)
                      if mask >> begin[-1] & 1 and not mask & passed]
    return found


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley): one row per part, order and step; ``filter`` is the letter of the step.

    ``removed``, ``good_lost`` and ``toxic_lost`` count the documents the step removes, ``kept``
    those it leaves, ``redundant`` those that fail its filter but went before, ``unique_fails``
    those that fail no other filter, ``shapley`` what the filter removes in all orders together.
    """
    spark = docs.sparkSession
    counted = stored(masks(docs, labels), "masks")
    orders = ["".join(order) for order in permutations(FILTERS)]
    steps = spark.createDataFrame(
        [(rank, step, FILTERS.index(letter), order, letter) for rank, order in enumerate(orders)
         for step, letter in enumerate(order, 1)],
        "rank int, step int, bit int, filter_order string, filter string")
    intervals = spark.createDataFrame(order_intervals(),
                                      "mask int, step int, bit int, first int, last int")
    hits = counted.join(intervals, "mask")
    # Difference arrays: counts come in with the first order of an interval and go with its end.
    ends = hits.select("part", "step", F.explode(F.array(
        F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")),
        F.struct(F.col("last").alias("rank"), F.lit(-1).alias("sign")))).alias("end"), *COUNTS)
    ends = ends.groupBy("part", "step", F.col("end.rank").alias("rank")).agg(
        *(F.sum(F.col(c) * F.col("end.sign")).alias(c) for c in COUNTS))
    shapley = hits.groupBy("part", "bit").agg(
        F.sum(F.col("n") * (F.col("last") - F.col("first"))).alias("shapley"))
    fails = counted.select("part", "mask", "n", F.explode(F.sequence(
        F.lit(0), F.lit(len(FILTERS) - 1))).alias("bit"))
    here = F.expr("shiftright(mask, bit) & 1") == 1
    alone = F.col("mask") == F.expr("shiftleft(1, bit)")
    fails = fails.groupBy("part", "bit").agg(
        F.sum("n").alias("documents"), F.sum(F.when(here, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("unique_fails"))
    grid = fails.join(steps, "bit")
    over = Window.partitionBy("part", "step").orderBy("rank")
    before = Window.partitionBy("part", "rank").orderBy("step")
    summed = (grid.join(ends, ["part", "step", "rank"], "left").join(
        shapley, ["part", "bit"], "left").fillna(0, [*COUNTS, "shapley"])
        .withColumns({c: F.sum(c).over(over) for c in COUNTS}))
    return summed.select(
        "part", "filter_order", "step", "filter",
        (F.col("documents") - F.sum("n").over(before)).alias("kept"), F.col("n").alias("removed"),
        (F.col("failing") - F.col("n")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")
