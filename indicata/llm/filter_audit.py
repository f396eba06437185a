"""Audit of how text filters interact, over every order of applying them.

A document fails some of the five filters, which makes a mask of five bits.
What a filter removes in some order depends on the mask alone, so documents
are first counted by part and mask. Every such cell then folds once across
all orders with ``transform`` and ``aggregate``: the inner fold walks an order
with one flag (removed already or not) and appends a struct for each step, so
a cell makes 600 structs, weighted by its documents. The cells of a part, at
most 32, are merged by elementwise sums.

Texts are read once. Whether a text is a copy (filter E) is asked by its
SHA-256 with the row's id: the smallest id of a text is the one row that does
not fail, so a text in a third of all rows is aggregated before it moves and
its rows are dealt by id.

Defined results: a null text is empty, and a null source and an empty one are
one part. A null id is no smaller than any other: such a row is never a copy,
nor does it make others copies. Rows that repeat the smallest id of their text
all pass E. A document is good or toxic if any of its label rows says so;
labels without an id or a document count nowhere. Texts of any length are read
whole; an empty table gives no part. Columns other than id, text, source and
the labels are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from indicata.llm.common import WS, materialize

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

#: Filter A: fewest words; B: least distinct words in a hundred words; C: most
#: capitals in a hundred characters; D: characters that a text must not hold.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, BARRED = 200, 50, 2, "[#$%&*|]"

#: What is counted at each step.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

#: Salts that deal rows without an id in the join with labels.
SALTS = 4096


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, f"[{WS}]+"), "")
    fails = (F.size(words) < LEAST_WORDS,
             F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT,
             F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * MOST_CAPITALS,
             text.rlike(BARRED))
    mask = F.lit(0)
    for i, f in enumerate(fails):
        mask = mask + F.when(f, F.lit(1 << i)).otherwise(F.lit(0))
    return mask


def masks(documents: DataFrame) -> DataFrame:
    """``(doc_id, part, mask)`` of every document, all five filters."""
    text = F.coalesce("text", F.lit(""))
    rows = materialize(documents.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("sha"),
        text_mask(text).alias("mask")), "audit-masks")
    first = rows.filter("doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("doc_id"))
    first = first.select("sha", "doc_id", F.lit(True).alias("first"))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["sha", "doc_id"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))


def cells(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good ones and toxic ones by part and mask."""
    told = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic")).filter("good OR toxic")
    told = told.select("doc_id", F.lit(0).alias("salt"), "good", "toxic")
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("part", F.monotonically_increasing_id()), F.lit(SALTS))
                  .cast("int")).otherwise(0)
    return masked.withColumn("salt", salt).join(told, ["doc_id", "salt"], "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def fold() -> Column:
    """The 600 weighted structs of a cell ``(mask, n, good, toxic)``."""
    orders = F.array(*[F.array(*[F.lit(FILTERS.index(f)) for f in order]) for order in ORDERS])
    zero = F.lit(0).cast("long")

    def weigh(when: Column, weight: str) -> Column:
        return F.when(when, F.col(weight)).otherwise(zero)

    def step(state: Column, f: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1), f)
        fails = F.col("mask").bitwiseAND(bit) != 0
        gone = state["gone"]
        counted = F.struct(
            weigh(~gone & ~fails, "n").alias("kept"), weigh(~gone & fails, "n").alias("removed"),
            weigh(gone & fails, "n").alias("redundant"), weigh(F.col("mask") == bit, "n").alias("unique_fails"),
            weigh(~gone & fails, "good").alias("good_lost"), weigh(~gone & fails, "toxic").alias("toxic_lost"))
        return F.struct((gone | fails).alias("gone"),
                        F.concat(state["steps"], F.array(counted)).alias("steps"))

    kinds = ", ".join(f"{c}: bigint" for c in COUNTS)
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(f"array<struct<{kinds}>>").alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda s: s["steps"])))


def merge(folded: Column) -> Column:
    """Elementwise sums over the folded cells of a part, at most 32."""
    def add(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))
    return F.aggregate(F.slice(folded, 2, 32), folded[0], add)


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order and step: ``(part, filter_order, step)``, the
    counts of ``COUNTS`` and ``shapley``, the filter's removed over all orders."""
    folded = cells(masks(documents), labels).select("part", fold().alias("steps"))
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("cells")).select(
        "part", merge(F.col("cells")).alias("steps"))
    letters = F.array(*[F.lit(f) for order in ORDERS for f in order])
    totals = F.transform(F.array(*[F.lit(f) for f in FILTERS]), lambda letter: F.aggregate(
        F.zip_with("steps", letters, lambda s, own: F.when(own == letter, s["removed"]).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda a, x: a + x))
    rows = merged.select("part", totals.alias("totals"), F.posexplode("steps").alias("at", "s"))
    own = F.element_at(letters, F.col("at") + 1)
    order = F.element_at(F.array(*[F.lit(order) for order in ORDERS]), F.floor(F.col("at") / 5).cast("int") + 1)
    return rows.select("part", order.alias("filter_order"), (F.col("at") % 5 + 1).alias("step"),
                       *[F.col(f"s.{c}").alias(c) for c in COUNTS],
                       F.element_at("totals", F.ascii(own) - F.ascii(F.lit("A")) + 1).alias("shapley"))
