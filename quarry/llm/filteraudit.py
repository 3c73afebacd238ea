"""Which filter removes what: a removal game over all coalitions of filters.

Every document is reduced to the set of filters it fails.  Counts of those sets, at most
``2 ** k`` a part, give the worth of a coalition: the documents that it removes.  The worths give
every step of every order as a difference of two coalitions, and the Hart-Mas-Colell potential

    P(S) = (worth(S) + sum of P(S without i) over i in S) / |S|

gives each filter's Shapley value as P(all) minus P(all without the filter).
"""

from __future__ import annotations

from fractions import Fraction
from functools import partial
from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The blanks that separate words.
_BLANKS = r"[\x20\x09-\x0D]+"
DUPLICATE = "E"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of one text by letter: A short, B repetitive, C capitals, D signs."""
    words = F.array_remove(F.split(text, _BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 200,
        "B": F.lit(100) * distinct < F.lit(50) * n,
        "C": F.lit(100) * capitals > F.lit(3) * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters they fail.

    Bit i of ``mask`` is the i-th letter of ``ABCDE``.  ``part`` is ``lang``, the empty string for
    null; a null text counts as empty.  E fails for a row with the text of a smaller doc_id in any
    part; a row without doc_id never fails it, and rows that repeat one doc_id do not fail by each
    other.  Repeated labels of a doc_id count once, with the largest.  Rows are counted before each
    shuffle, so that a text, a doc_id or a part with a large share of all rows sends few rows, and
    texts themselves are never shuffled.  Extra columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_filters(F.col("text")).values())]
    duplicate = 1 << len(bits)
    flagged = rows.select("doc_id", "part", sum(bits[1:], bits[0]).alias("mask"), F.sha2("text", 256).alias("digest"))
    counted = flagged.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))

    marks = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("string").alias("key"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    # rows without doc_id are spread by their texts; no label has such a key
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.col("digest")))
    marked = (counted.withColumn("key", key).join(marks, "key", "left")
              .select("doc_id", "part", "mask", "digest", "n", F.coalesce("good", F.lit(0)).alias("good"),
                      F.coalesce("toxic", F.lit(0)).alias("toxic")))
    known = F.col("doc_id").isNotNull()
    texts = (marked.groupBy("digest", "part", "mask", "good", "toxic")
             .agg(F.sum("n").alias("n"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("unnamed"),
                  F.min(F.when(known, F.struct("doc_id", "n"))).alias("low")))
    # the rows of one text are bounded by parts x labels now
    lowest = texts.groupBy("digest").agg(F.min("low.doc_id").alias("lowest"))
    first = F.col("unnamed") + F.when(F.col("low.doc_id") == F.col("lowest"), F.col("low.n")).otherwise(0)
    split = F.array(F.struct(F.col("mask").alias("mask"), first.alias("n")),
                    F.struct((F.col("mask") + duplicate).alias("mask"), (F.col("n") - first).alias("n")))
    cells = texts.join(lowest, "digest").select("part", "good", "toxic", F.inline(split))
    return (cells.filter("n > 0").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                 F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


def worths(counts: dict[int, int], k: int) -> list[int]:
    """Documents that each coalition removes: those that fail any of its filters."""
    return [sum(n for mask, n in counts.items() if mask & s) for s in range(1 << k)]


def potentials(worth: list[int], k: int) -> list[Fraction]:
    """Hart-Mas-Colell potential of every coalition; smaller coalitions come first."""
    p = [Fraction(0)] * (1 << k)
    for s in range(1, 1 << k):
        inside = [1 << i for i in range(k) if s >> i & 1]
        p[s] = (worth[s] + sum(p[s ^ bit] for bit in inside)) / Fraction(len(inside))
    return p


def part_steps(part: str, cells, letters: str) -> list[tuple]:
    """All orders and steps of one part from its (mask, n, good, toxic) cells."""
    k = len(letters)
    total = sum(c["n"] for c in cells)
    removed, good, toxic = (worths({c["mask"]: c[name] for c in cells}, k) for name in ("n", "good", "toxic"))
    potential = potentials(removed, k)
    everything = (1 << k) - 1
    only = {c["mask"]: c["n"] for c in cells}
    value = [int(factorial(k) * (potential[everything] - potential[everything ^ (1 << i)])) for i in range(k)]
    rows = []
    for order in permutations(range(k)):
        name, before = "".join(letters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            here = removed[after] - removed[before]
            rows.append((part, name, step, total - removed[after], here, removed[1 << i] - here, only.get(1 << i, 0),
                         good[after] - good[before], toxic[after] - toxic[before], value[i]))
            before = after
    return rows


SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def _steps(frames, letters: str):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for frame in frames:
        for part, cells in zip(frame["part"], frame["cells"]):
            yield pd.DataFrame(part_steps(part, cells, letters), columns=names)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step; see :func:`failure_counts` for the rules.

    ``kept`` documents are left after the step, ``removed`` go at it, ``redundant`` fail its filter
    but went earlier, ``unique_fails`` fail no other filter, ``good_lost`` and ``toxic_lost`` are the
    removed ones of these labels, ``shapley`` is the filter's Shapley value times the number of
    orders.  Without documents there is no part and no row.
    """
    counts = failure_counts(docs, labels)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    letters = "".join(text_filters(F.lit(""))) + DUPLICATE
    return parts.mapInPandas(partial(_steps, letters=letters), SCHEMA)
