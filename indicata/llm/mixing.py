"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size is a multiplier between 0 and 2: every
document is taken ``floor`` times for certain and once more with the
fractional part as its inclusion probability. The flight phase moves these
probabilities through the null space of two constraints, the source's token
total and its document total, so that both stay what they are while units
reach 0 or 1 one by one. It runs in groups of at most a few hundred units;
each leaves at most two fractional units, which meet in the groups of the
next level, until one group of a source is left with at most two units: the
landing problem. It is settled over all documents of the source, counted by
size: units change sides until the token total is at its target or no unit
that is left is small enough.

Defined results: null and empty texts have size 0 and are taken as 0 words; a
null source is a source of its own, last in order; ties are settled by hashed
ids, so reruns and other partitionings agree; repeated rows are units of
their own; an empty table gives an empty result; columns of ``docs`` other
than id, source and text are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from indicata.llm.common import WS, attach, materialize, ship

#: Weights by place of the source in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Words of the mix over words of the corpus, and the most of any source.
SHARE, MOST = 1.5, 2.0
#: Units of a flight group; each leaves at most two to the next level.
GROUP = 400
#: Equal rows that one row numbers; groups that the units of a kind are dealt to.
NUMBERED, SALT = 1000, 256
EPS = 1e-9


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and tab .. return."""
    one = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"[\\t-\\r][{WS}]*| [{WS}]+", " "))
    return F.when(one == "", F.lit(0)).otherwise(
        F.octet_length(one) - F.octet_length(F.replace(one, F.lit(" "), F.lit(""))) + 1).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources (source, source_size, ..)`` with ``target``.

    Sources share ``share`` of all words by weight; none gets more than
    ``most`` times its size and the excess goes to the others by weight. In
    order of room per weight, the sources that stop form a prefix: one pass
    of running sums finds it. One row per source, so this table is small.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    every = Window.partitionBy(F.lit(0))
    by_room = Window.partitionBy(F.lit(0)).orderBy("_room", "_place")
    w = sources.withColumn("_place", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1) \
        .withColumn("_w", F.get(listed, (F.col("_place") % len(weights)).cast("int"))) \
        .withColumn("_room", most * F.col("source_size") / F.col("_w")) \
        .withColumn("_all", share * F.sum("source_size").over(every)) \
        .withColumn("_sum_w", F.sum("_w").over(every)) \
        .withColumn("_used", most * (F.sum("source_size").over(by_room) - F.col("source_size"))) \
        .withColumn("_left_w", F.col("_sum_w") - (F.sum("_w").over(by_room) - F.col("_w"))) \
        .withColumn("_level", (F.col("_all") - F.col("_used")) / F.col("_left_w")) \
        .withColumn("_stops", F.col("_room") <= F.col("_level")) \
        .withColumn("_final", F.max(F.when(~F.col("_stops"), F.col("_level"))).over(every))
    return w.withColumn("target", F.when(F.col("_stops"), most * F.col("source_size"))
                        .otherwise(F.col("_w") * F.col("_final")).cast("double")) \
        .drop("_place", "_w", "_room", "_all", "_sum_w", "_used", "_left_w", "_level", "_stops", "_final")


def flight(size: np.ndarray, p: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Move ``p`` through the null space of (size, 1) until at most two units
    are fractional. ``draw``: a fixed uniform number for each unit."""
    p = p.astype(float).copy()
    active: list[int] = []
    for i in range(len(p)):
        if EPS < p[i] < 1 - EPS:
            active.append(i)
        while len(active) >= 3 or len(active) == 2 and size[active[0]] == size[active[1]]:
            a, b = active[0], active[1]
            if size[a] == size[b]:
                use, u = (a, b), (1.0, -1.0)
            else:
                c = active[2]
                sa, sb, sc = float(size[a]), float(size[b]), float(size[c])
                use, u = (a, b, c), (sb - sc, sc - sa, sa - sb)
            up = min((1 - p[j]) / x if x > 0 else p[j] / -x for j, x in zip(use, u, strict=True) if x)
            down = min(p[j] / x if x > 0 else (1 - p[j]) / -x for j, x in zip(use, u, strict=True) if x)
            step = up if draw[i] * (up + down) < down else -down
            for j, x in zip(use, u, strict=True):
                p[j] += step * x
            for j in use:
                if p[j] <= EPS or p[j] >= 1 - EPS:
                    p[j] = 0.0 if p[j] <= EPS else 1.0
                    active.remove(j)
    return p


def landing(size: np.ndarray, p: np.ndarray, goal: float) -> np.ndarray:
    """Settle the last (at most two) fractional units: the choice that leaves
    the token total nearest to ``goal``."""
    p = p.copy()
    free = [i for i in range(len(p)) if EPS < p[i] < 1 - EPS]
    fixed = sum(float(size[i]) * p[i] for i in range(len(p)) if i not in free)
    options = [[(bits >> j) & 1 for j in range(len(free))] for bits in range(1 << len(free))]
    best = min(options, key=lambda o: (abs(
        fixed + sum(x * float(size[i]) for i, x in zip(free, o, strict=True)) - goal), o))
    for i, x in zip(free, best, strict=True):
        p[i] = float(x)
    return p


def evened(size: np.ndarray, up: np.ndarray, count: np.ndarray, off: float) -> np.ndarray:
    """How many units of each kind (size, taken once more or not) change sides
    so that a total that is ``off`` too large comes near its goal.

    ``size`` falls. Largest sizes go first, as many as fit. What is then left
    is less than any unit that could still change; one such unit may overshoot,
    which small ones on the other side make good.
    """
    def fit(off: float, flips: np.ndarray) -> float:
        side = np.flatnonzero((up == (off > 0)) & (size > 0) & (count > flips) & (size <= abs(off)))
        for i in side:
            k = min(count[i] - flips[i], int(abs(off) // size[i]))
            flips[i] += k
            off -= np.sign(off) * k * size[i]
        return off

    flips = np.zeros(len(size), np.int64)
    off = fit(off, flips)
    more = np.flatnonzero((up == (off > 0)) & (size > abs(off)) & (count > flips))
    if abs(off) >= 0.5 and len(more):
        other, i = flips.copy(), more[-1]
        other[i] += 1
        if abs(fit(off - np.sign(off) * size[i], other)) < abs(off):
            return other
    return flips


def _evened(most: float):
    def run(kinds: pd.DataFrame) -> pd.DataFrame:
        kinds = kinds.sort_values(["size", "up"], ascending=[False, True], kind="stable")
        size, up, sure = kinds["size"].to_numpy().astype(float), kinds["up"].to_numpy(), kinds["sure"].to_numpy()
        off = float(((sure + up) * size * kinds["n"]).sum() - kinds["target"].iloc[0])
        may = np.where((up == 1) | (sure + 1 <= most), kinds["n"], 0)
        kinds = kinds.assign(flips=evened(size, up == 1, may, off))
        return kinds[kinds["flips"] > 0][["_key", "size", "up", "n", "flips"]]
    return run


def settled(done: DataFrame, most: float) -> DataFrame:
    """``done`` with ``up`` (0 or 1): units of all of a source, not only those
    of its last group, change sides until its token total is at its target.

    A source is looked at as its counts by size and side; its distinct sizes
    are no more than the root of twice its words. The units of a kind that
    change are those of the smallest ``h``.
    """
    done = done.select("_id", "_no_id", "source", "_key", "text_hash", "size", "h", "source_size", "target",
                       "sure", F.round("p").cast("int").alias("up"))
    flips = materialize(
        done.groupBy("_key", "size", "up").agg(
            F.count("*").alias("n"), F.max("sure").alias("sure"), F.max("target").alias("target"))
        .groupBy("_key").applyInPandas(_evened(most), "_key string, size long, up int, n long, flips long"),
        "mix-flips")
    kind = ["_key", "size", "up"]
    some = attach(done.select(*kind, "h"), flips, kind, "n", F.col("h")).filter("flips is not null")
    # a kind may hold most of a source: its salts first send what each can add
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("h"))
    cuts = materialize(
        some.withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALT)))
        .withColumn("r", place(*kind, "salt")).filter("r <= flips")
        .withColumn("r", place(*kind)).filter("r = flips").select(*kind, "n", F.col("h").alias("cut")), "mix-cuts")
    turned = F.col("h") <= F.col("cut")
    return attach(done, cuts, kind, "n", F.col("h")).withColumn(
        "up", F.when(turned, 1 - F.col("up")).otherwise(F.col("up")))


def _level(last: bool):
    def run(units: pd.DataFrame) -> pd.DataFrame:
        units = units.sort_values(["h", "size"], kind="stable")
        size, p = units["size"].to_numpy().astype(float), units["p"].to_numpy()
        draw = (units["h"].to_numpy().view(np.uint64) >> np.uint64(11)) / float(1 << 53)
        moved = flight(size, p, draw)
        p = landing(size, moved, float(size @ p)) if last else moved
        return units.assign(p=p).drop(columns="g")
    return run


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
        weights=WEIGHTS, share: float = SHARE, most: float = MOST, group: int = GROUP) -> DataFrame:
    """One row per document: id, source, text_hash, size, source_size, target,
    copies, taken.

    ``copies`` is how often the document is taken; ``taken`` = copies * size.
    """
    id_type = docs.schema[id_col].dataType
    # equal rows are numbered, in blocks that many tasks count on from
    units = docs.select(
        F.coalesce(F.col(id_col), F.lit("0").cast(id_type)).alias("_id"),
        F.col(id_col).isNull().alias("_no_id"), F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("_key"),
        F.xxhash64(text).alias("text_hash"), word_count(F.col(text)).alias("size")) \
        .groupBy("_id", "_no_id", "source", "_key", "text_hash", "size").agg(F.count("*").alias("_n")) \
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / NUMBERED)))) \
        .repartition("_id", "text_hash", "_block") \
        .withColumn("_nth", F.explode(F.sequence(
            F.lit(1).cast("long"), F.least(F.lit(NUMBERED), F.col("_n") - NUMBERED * F.col("_block")))))
    units = materialize(units.withColumn(
        "h", F.xxhash64("_id", "_no_id", "_key", "text_hash", "_block", "_nth", F.lit("mix")))
        .drop("_n", "_block", "_nth"), "mix-sizes")
    sums = targets(units.groupBy("source", "_key").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n")), weights, share, most)
    sums = materialize(sums.withColumn("ratio", F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .drop("source"), "mix-targets")
    rows = attach(units, sums, ["_key"], "n", F.col("h")) \
        .withColumn("sure", F.floor(F.col("ratio") + EPS).cast("double")) \
        .withColumn("p", F.greatest(F.col("ratio") - F.col("sure"), F.lit(0.0))) \
        .withColumn("groups", F.ceil(F.col("n") / group).cast("long"))
    schema = rows.schema
    largest = sums.agg(F.max("n")).first()[0] or 0
    groups, level, done = -(-int(largest) // group), 0, None
    while True:
        last = groups <= 1
        key = F.pmod(F.xxhash64("h", "size", F.lit(level)), F.greatest("groups", F.lit(1)))
        moved = rows.withColumn("g", key).groupBy("_key", "g") \
            .applyInPandas(_level(last), schema)
        moved = materialize(moved, "mix-flight")
        whole = f"p <= {EPS} or p >= {1 - EPS}"
        ended = moved if last else moved.filter(whole)
        done = ended if done is None else done.union(ended)
        if last:
            break
        # every group leaves two units at most
        rows = moved.filter(f"not ({whole})").withColumn(
            "groups", F.ceil(F.col("groups") * 2 / group).cast("long"))
        groups, level = -(-groups * 2 // group), level + 1
    copies = (F.col("sure") + F.col("up")).cast("long")
    return settled(done, most).select(F.when(~F.col("_no_id"), F.col("_id")).alias(id_col), "source", "text_hash", "size", "source_size", "target",
                       copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
          **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken.

    Rows of the same id, source and text share out what they are taken
    together, the first of them one more where it does not come out even.
    """
    plan = mix(docs, id_col, source, text, **how)
    total = materialize(plan.groupBy(
        F.col(id_col).alias("_id"), F.col("source").alias("_source"), F.col("text_hash").alias("_hash"))
        .agg(F.sum("copies").cast("long").alias("_copies"), F.count("*").alias("_n"))
        .filter("_copies > 0"), "mix-copies")
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_i"), F.col(source).alias("_s"),
                       F.xxhash64(text).alias("_of")).join(
        total, F.col("_i").eqNullSafe(F.col("_id")) & F.col("_s").eqNullSafe(F.col("_source"))
        & (F.col("_of") == F.col("_hash")))
    turn = F.row_number().over(Window.partitionBy("_id", "_source", "_hash").orderBy(F.lit(0)))
    times = F.floor(F.col("_copies") / F.col("_n")) + (F.col("_turn") <= F.col("_copies") % F.col("_n")).cast("long")
    return rows.withColumn("_turn", turn).withColumn("_times", times).filter("_times > 0") \
        .withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))) \
        .select("_row.*")


ship(__name__)
