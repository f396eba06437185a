"""Row-frame windows over one long series without a single-task window.

``Window.orderBy(...)`` with no partition key (or one key holding most of
the rows) puts the whole series in one task. For frames bounded to the
last ``halo + 1`` rows (lag, moving statistics) the series can be cut into
chunks of ``chunk_rows`` consecutive rows, each chunk carrying a copy of
the last ``halo`` rows of the chunk before it. The window then runs per
chunk, in parallel, and the copies are dropped: every original row sees
exactly the rows it would see in the global window.

Steps, all DataFrame operations:

1. range-partition on (keys, order) and sort inside partitions; tag each
   row with its partition id and position (``monotonically_increasing_id``
   encodes both), then ``checkpoint()`` to the shared checkpoint folder so
   the tags are fixed even if a task is re-run;
2. count rows per (partition, keys) -- at most partitions x series rows --
   and turn the counts into offsets with a prefix sum;
3. global row number = offset + position; chunk = row number div chunk_rows;
4. rows in the last ``halo`` positions of a chunk are emitted twice
   (``explode``), once as halo of the next chunk;
5. window partitioned by (keys, chunk), then halo copies are removed.

The order key must be unique (add a tie-break column); ``halo`` must be at
least the deepest look-back of the window functions (1 for ``lag``, 29 for
a 30-row frame) and smaller than ``chunk_rows``.

Two kinds of frames have operators of their own:

* ``running`` (from the first row on): a chunk adds up to one row of partial
  results; an exclusive scan over these partials gives what lies before each
  chunk, and every row adds its own part of the chunk to that. The scan over
  partials is the same operator again when there are many of them.
* ``long_extremes`` (maximum and minimum of the last ``rows`` rows): the series
  is cut into blocks of ``rows`` rows. A frame spans the end of one block and
  the beginning of the next, so its extreme is that of the later block up to
  the row and of the earlier one from the frame's first row on. Both run once
  over each block, so a row costs the same for any length of the frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_POSITION_BITS = 33  # monotonically_increasing_id = (partition id << 33) + position


#: Bytes of input that one range partition holds.
PARTITION_BYTES = 128 << 20


def range_partitions(df: DataFrame) -> int:
    """Range partitions by the size of the input, as the optimizer knows it;
    at least the session's shuffle partitions. The checkpoint fixes the number,
    so it cannot be left to run time."""
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, -(-known // PARTITION_BYTES)) if known < 1 << 60 else least


def global_row_number(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (),
                      partitions: int | None = None) -> DataFrame:
    """Add ``_rn`` (0-based, per ``keys``) without a single-partition window."""
    n = partitions or range_partitions(df)
    sort_cols = [*keys, *order]
    tagged = (df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
                .withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_pid", F.spark_partition_id()))
    tagged = tagged.checkpoint(eager=True)
    tagged = tagged.withColumn(
        "_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _POSITION_BITS))
    stats = tagged.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"),
                                               F.min("_pos").alias("_first"))
    prior = (Window.partitionBy(*keys).orderBy("_pid")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = stats.withColumn("_off", F.coalesce(F.sum("_n").over(prior), F.lit(0))).drop("_n") \
        .select(F.col("_pid").alias("_o_pid"), *[F.col(k).alias(f"_o_{k}") for k in keys], "_first", "_off")
    # One row per (partition, series present in it). Without keys that is
    # one row per partition, a proven bound, so it is broadcast; with keys it
    # grows with the number of series and the join strategy is left to AQE.
    on = F.col("_pid") == F.col("_o_pid")
    for k in keys:  # a NULL key is a series of its own
        on = on & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    out = tagged.join(F.broadcast(offsets) if not keys else offsets, on)
    return out.withColumn("_rn", F.col("_off") + F.col("_pos") - F.col("_first")).drop(
        "_mid", "_pid", "_pos", "_off", "_first", "_o_pid", *[f"_o_{k}" for k in keys])


def chunked_window(df: DataFrame, order: Sequence[str], compute: Callable[[WindowSpec], dict[str, Column]],
                   halo: int, chunk_rows: int = 1_000_000, keys: Sequence[str] = (),
                   partitions: int | None = None) -> DataFrame:
    """Apply row-frame window columns ``compute(w)`` as if over
    ``Window.partitionBy(keys).orderBy(order)``, chunk by chunk."""
    if halo >= chunk_rows:
        raise ValueError("halo must be smaller than chunk_rows")
    numbered = global_row_number(df, order, keys, partitions)
    rn = F.col("_rn")
    chunk = F.floor(rn / F.lit(chunk_rows)).cast("long")
    in_tail = (rn % F.lit(chunk_rows)) >= F.lit(chunk_rows - halo)
    targets = F.when(in_tail, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    spread = (numbered.withColumn("_home", chunk)
                      .withColumn("_chunk", F.explode(targets)))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_rn")
    computed = spread.withColumns(compute(w))
    return (computed.filter(F.col("_chunk") == F.col("_home"))
                    .drop("_chunk", "_home", "_rn"))


#: What a running aggregate is made of: how a chunk's rows give a partial and
#: how partials are put together.
_PARTS = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}
_NEEDS = {"sum": ("sum",), "count": ("count",), "min": ("min",), "max": ("max",), "avg": ("sum", "count")}


def running(df: DataFrame, order: Sequence[str], values: dict[str, tuple[str, str]], keys: Sequence[str] = (),
            chunk_rows: int = 1_000_000, partitions: int | None = None) -> DataFrame:
    """Running aggregates from the first row of a series up to each row.

    ``values`` maps a new column to ``(function, column)``, where function is
    ``sum``, ``avg``, ``count``, ``min`` or ``max``; like the window functions
    they ignore NULLs. With a year among ``keys`` the aggregates are those of
    the year to date. No window is wider than a chunk, except over one partial
    row per chunk, of which there are at most ``chunk_rows`` in a series;
    beyond that the partials are scanned by chunks themselves.
    """
    unknown = {f for f, _ in values.values()} - set(_NEEDS)
    if unknown:
        raise ValueError(f"no running {sorted(unknown)}")
    numbered = global_row_number(df, order, keys, partitions) \
        .withColumn("_chunk", F.floor(F.col("_rn") / F.lit(chunk_rows)).cast("long"))
    parts = sorted({(part, c) for f, c in values.values() for part in _NEEDS[f]})
    name = {p: f"_p{i}" for i, p in enumerate(parts)}
    partials = numbered.groupBy(*keys, "_chunk").agg(*[_PARTS[part][0](c).alias(name[part, c]) for part, c in parts])
    before = _exclusive(partials, keys, {name[p]: p[0] for p in parts}, chunk_rows)
    on = F.col("_chunk") == F.col("_b_chunk")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    before = before.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col("_chunk").alias("_b_chunk"),
                           *[F.col(n).alias(f"_b{n}") for n in name.values()])
    w = Window.partitionBy(*keys, "_chunk").orderBy("_rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = numbered.withColumns({f"_w{name[part, c]}": _PARTS[part][0](c).over(w) for part, c in parts})
    joined = rows.join(before, on, "left")

    def total(part: str, c: str) -> Column:
        return _together(part, F.col(f"_b{name[part, c]}"), F.col(f"_w{name[part, c]}"))

    out = {new: total(f, c) if f != "avg" else
           F.try_divide(total("sum", c).cast("double"), total("count", c)) for new, (f, c) in values.items()}
    return joined.select(*df.columns, *[c.alias(new) for new, c in out.items()])


def _together(part: str, a: Column, b: Column) -> Column:
    if part in ("min", "max"):
        return (F.least if part == "min" else F.greatest)(a, b)  # both skip NULLs
    return F.coalesce(a + b, a, b)


def _exclusive(partials: DataFrame, keys: Sequence[str], parts: dict[str, str], chunk_rows: int) -> DataFrame:
    """Of each chunk what the chunks before it give together."""
    longest = partials.groupBy(*keys).count().agg(F.max("count").alias("n")).first()["n"] or 0
    if longest > chunk_rows:
        shifted = {f"_s{n}": (part if part != "count" else "sum", n) for n, part in parts.items()}
        scanned = running(partials.withColumnRenamed("_chunk", "_at"), ("_at",), shifted, keys, chunk_rows)
        prior = chunked_window(scanned, ("_at",), lambda w: {
            n: F.lag(f"_s{n}").over(w) for n in parts}, halo=1, chunk_rows=chunk_rows, keys=keys)
        return prior.select(*keys, F.col("_at").alias("_chunk"), *parts)
    w = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return partials.select(*keys, "_chunk", *[_PARTS[part][1](n).over(w).alias(n) for n, part in parts.items()])


def long_extremes(df: DataFrame, order: Sequence[str], value: str, rows: int, keys: Sequence[str] = (),
                  chunk_rows: int | None = None, partitions: int | None = None,
                  names: tuple[str, str] = ("max", "min")) -> DataFrame:
    """Maximum and minimum of the last ``rows`` rows (the current one included),
    as two new columns; constant work per row, whatever the frame's length."""
    blocks = max(8, -(-(chunk_rows or 1_000_000) // rows))  # blocks of a chunk
    numbered = global_row_number(df, order, keys, partitions)
    rn, size = F.col("_rn"), blocks * rows
    chunk = F.floor(rn / F.lit(size)).cast("long")
    in_tail = (rn % F.lit(size)) > F.lit(size - rows)  # the last rows - 1
    spread = numbered.withColumn("_home", chunk).withColumn(
        "_chunk", F.explode(F.when(in_tail, F.array(chunk, chunk + 1)).otherwise(F.array(chunk)))) \
        .withColumn("_block", F.floor(rn / F.lit(rows)).cast("long"))
    block = Window.partitionBy(*keys, "_chunk", "_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    forth, back = block.orderBy("_rn"), block.orderBy(F.desc("_rn"))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_rn")
    out = spread
    for name, best, either in ((names[0], F.max, F.greatest), (names[1], F.min, F.least)):
        out = out.withColumn(f"_to_{name}", best(value).over(forth)).withColumn(f"_from_{name}", best(value).over(back))
    out = out.withColumns({name: either(F.col(f"_to_{name}"), F.lag(f"_from_{name}", rows - 1).over(w))
                           for name, either in ((names[0], F.greatest), (names[1], F.least))})
    return out.filter(F.col("_chunk") == F.col("_home")).select(*df.columns, *names)
