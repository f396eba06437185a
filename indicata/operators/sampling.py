"""Samples that repeat: the rows whose keys have the smallest hashes.

The sample depends on the keys alone, not on files, tasks or order, and the
samples of parts merge to that of the whole: each task keeps its ``k`` best
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_hash(keys: Sequence[str]):
    """MD5 of the key texts, joined by ``|`` (NULL keys are left out)."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def bottom_k(df: DataFrame, k: int, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows (of each group ``by``) with the smallest key hashes; equal
    hashes go by the keys."""
    hashed = df.withColumn("_hash", key_hash(keys))
    if not by:
        return hashed.orderBy("_hash", *keys).limit(k).drop("_hash")
    w = Window.partitionBy(*by).orderBy("_hash", *keys)
    return hashed.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank", "_hash")
