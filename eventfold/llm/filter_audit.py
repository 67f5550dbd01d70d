"""What filters do together: survivors of every subset of them, and every order's steps, from one pass over the texts.

Each row's failures are a mask, one bit a filter. Rows are counted by (part, mask), which combines before the shuffle and leaves 2**k rows a part. A subset-zeta
transform over a part's array of counts gives, for each set of masks, the rows whose mask lies within it; what survives the filters of a subset F is that sum for the
complement of F. A step of an order is then a difference between two neighbouring subsets, for all rows or for those with a flag, and nothing is read again.

Everything is a DataFrame expression. Identical texts are told by SHA-256: the least id of each digest that occurs more than once is written first, so the join back is a
plain one that adaptive execution can split where a text has very many copies.

Defined results: a null text is empty; a null part is the empty string; a null id has no smaller id and is nobody's smaller id; rows that repeat an id are rows of their own,
and of such rows with equal texts none is smaller; a flag counts if any label of the row's id sets it; further columns are ignored; no rows give no parts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

GAP = r"[\x20\x09-\x0D]+"
LETTERS = "ABCDE"


def failures(text: Column) -> dict[str, Column]:
    """The conditions that a text alone decides."""
    words = F.array_remove(F.split(text, GAP), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def mask_of(fails: Sequence[Column]) -> Column:
    """Bit i is set where the i-th condition holds."""
    out = F.lit(0)
    for i, c in enumerate(fails):
        out = out + F.when(c, 1 << i).otherwise(0)
    return out


def marks(docs: DataFrame, labels: DataFrame, *, part: str = "lang") -> DataFrame:
    """part, mask, good, toxic of every row: the five conditions, the last of which looks at the whole table."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = store.cut(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
        .select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask_of(list(failures(F.col("text")).values())).alias("mask")),
        "audit-marks",
    )
    first = store.cut(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").select("digest", "least"), "audit-first")
    known = F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1))
    one = lambda c: F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("int")).alias(c)
    flags = store.cut(labels.where(known).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality"), one("toxic")), "audit-flags")
    late = F.when(F.col("least") < F.col("doc_id"), 1 << 4).otherwise(0)
    flag = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    told = rows.join(first, "digest", "left").select("doc_id", "part", (F.col("mask") + late).alias("mask"))
    return told.join(flags, "doc_id", "left").select("part", "mask", flag("quality").alias("good"), flag("toxic").alias("toxic"))


def zeta(counts: Column, k: int) -> Column:
    """Of an array with an entry for each of 2**k sets: for each set, the sum over its subsets. One pass a bit."""
    bits = F.array(*[F.lit(1 << i) for i in range(k)])
    step = lambda held, bit: F.transform(held, lambda x, i: F.when(i.bitwiseAND(bit) != 0, x + F.get(held, i.bitwiseXOR(bit))).otherwise(x))
    return F.aggregate(bits, counts, step)


def survivors(marked: DataFrame, k: int, flags: Sequence[str] = ("good", "toxic")) -> DataFrame:
    """A row for each part: rows and one column for each flag, arrays whose entry F counts the rows that no filter of the subset F fails."""
    sums = [F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in flags]]
    by_mask = marked.groupBy("part", "mask").agg(*sums)
    names = ["rows", *flags]
    held = by_mask.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct(*names)))).alias("held"))  # 2**k entries at most
    full = (1 << k) - 1
    sets = F.sequence(F.lit(0), F.lit(full))
    counts = lambda c: F.transform(sets, lambda m: F.coalesce(F.col("held")[m][c], F.lit(0).cast("long")))
    within = held.select("part", *[zeta(counts(c), k).alias(c) for c in names])
    return within.select("part", *[F.reverse(c).alias(c) for c in names])  # the complement of F is full - F


def orders(found: DataFrame, letters: str, flags: Mapping[str, str]) -> DataFrame:
    """part, filter_order, step and the counts of that step for all orders of the filters. found: what survivors gives; flags: the name of each flag's loss."""
    k, full = len(letters), (1 << len(letters)) - 1
    of = lambda name, subset: F.get(F.col(name), subset)
    bits = F.transform(F.split("filter_order", ""), lambda x: F.element_at(F.array(*[F.lit(1 << i) for i in range(k)]), F.instr(F.lit(letters), x)))
    # over all orders: as many as put the rest of a subset before a filter, for each subset without it
    weights = F.array(*[F.lit(factorial(n) * factorial(k - 1 - n)) for n in range(k)])
    without = F.filter(F.sequence(F.lit(0), F.lit(full)), lambda s: s.bitwiseAND(F.col("own")) == 0)
    gain = lambda s: F.get(weights, F.bit_count(s)) * (of("rows", s) - of("rows", s.bitwiseOR(F.col("own"))))
    spread = (
        found.withColumn("filter_order", F.explode(F.split(F.lit(",".join(map("".join, permutations(letters)))), ",")))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
        .withColumn("bits", bits)
        .withColumns({"own": F.element_at("bits", F.col("step")), "after": F.aggregate(F.slice("bits", 1, F.col("step")), F.lit(0), lambda a, b: a + b)})
        .withColumn("before", F.col("after") - F.col("own"))
    )
    removed = of("rows", F.col("before")) - of("rows", F.col("after"))
    fails = of("rows", F.lit(0)) - of("rows", F.col("own"))
    return spread.select(
        "part", "filter_order", "step",
        of("rows", F.col("after")).alias("kept"), removed.alias("removed"), (fails - removed).alias("redundant"),
        (of("rows", F.lit(full).bitwiseXOR(F.col("own"))) - of("rows", F.lit(full))).alias("unique_fails"),
        *[(of(c, F.col("before")) - of(c, F.col("after"))).alias(name) for c, name in flags.items()],
        F.aggregate(F.transform(without, gain), F.lit(0).cast("long"), lambda a, x: a + x).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, *, part: str = "lang") -> DataFrame:
    """The five filters over documents: a row for each part, order and step."""
    found = survivors(marks(docs, labels, part=part), len(LETTERS))
    return orders(store.cut(found, "audit-survivors"), LETTERS, {"good": "good_lost", "toxic": "toxic_lost"})
