"""Keep the newest ingestion of every observation key (bronze -> silver)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("_ingested_at",),
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the greatest ``order_by``, then greatest ``tie_break``.

    Rows of one ingestion batch share one timestamp, so ``tie_break`` names a
    column that makes the winner deterministic (e.g. a sequence number).

    ``row_number() == 1`` lets Catalyst insert a ``WindowGroupLimit`` on
    the map side of the shuffle, so every map task ships at most one row per
    key: a key holding a large share of the rows does not land whole in
    one reducer.
    """
    ordering = [F.col(c).desc_nulls_last() for c in (*order_by, *tie_break)]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return (df.withColumn("_rank", F.row_number().over(w))
              .filter(F.col("_rank") == 1)
              .drop("_rank"))
