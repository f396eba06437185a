"""Data-quality checks as aggregations (one pass per table, no collect).

Each check returns a small DataFrame of results with an ``aprovado``
(passed) flag; callers decide whether to fail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count per column in one aggregation; passes when zero."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "coluna", "nulos")
    return long.withColumn("aprovado", F.col("nulos") == 0)


def unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of key values that occur more than once (NULL keys excluded)."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    dups = (df.filter(present).groupBy(*keys).count().filter(F.col("count") > 1)
              .agg(F.count(F.lit(1)).alias("duplicadas")))
    return dups.select(F.lit(name).alias("tabela"), F.lit(",".join(keys)).alias("chave"),
                       "duplicadas", (F.col("duplicadas") == 0).alias("aprovado"))


def reconcile(counts: dict[str, tuple[DataFrame | int, DataFrame | int]], at_least: bool = False) -> DataFrame:
    """``{check: (expected, actual)}`` -> expected and actual row counts.

    A side is a table or a count that is known already (from the write).
    Tables are counted by aggregations; all counts are unioned and pivoted
    with conditional sums, so no join of the two is needed. Passes when the
    counts are equal, with ``at_least`` also when there are more.
    """
    parts = []
    for check, sides in counts.items():
        for side, table in zip(("esperado", "obtido"), sides, strict=True):
            if isinstance(table, int):
                known = next(t for pair in counts.values() for t in pair if not isinstance(t, int))
                rows = known.sparkSession.range(1).select(F.lit(table).cast("long").alias("linhas"))
            else:
                rows = table.agg(F.count(F.lit(1)).alias("linhas"))
            parts.append(rows.select(F.lit(check).alias("checagem"), F.lit(side).alias("lado"), "linhas"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    side = F.col("lado")
    out = u.groupBy("checagem").agg(
        F.sum(F.when(side == "esperado", F.col("linhas"))).alias("esperado"),
        F.sum(F.when(side == "obtido", F.col("linhas"))).alias("obtido"))
    ok = F.col("obtido") >= F.col("esperado") if at_least else F.col("obtido") == F.col("esperado")
    return out.withColumn("aprovado", ok)


def gold_report(gold: DataFrame, month: str, required: Sequence[str], min_rows: int = 2,
                time_col: str = "mes_ref") -> DataFrame:
    """End-to-end checks on the wide table in one aggregation:
    at least ``min_rows`` rows, exactly one row for ``month``, and no NULL
    among ``required`` in that row."""
    is_month = F.col(time_col) == F.lit(month).cast("date")
    any_null = F.lit(False)
    for c in required:
        any_null = any_null | F.col(c).isNull()
    agg = gold.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(is_month).alias("linhas_do_mes"),
        F.count_if(is_month & any_null).alias("nulos_obrigatorios"),
    )
    long = agg.unpivot([], ["linhas", "linhas_do_mes", "nulos_obrigatorios"], "checagem", "valor")
    c, v = F.col("checagem"), F.col("valor")
    passed = (F.when(c == "linhas", v >= min_rows)
               .when(c == "linhas_do_mes", v == 1)
               .otherwise(v == 0))
    return long.withColumn("aprovado", passed)
