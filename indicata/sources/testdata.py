"""Series analogs derived from the driver's TPC-H-like tables.

The reference ingests five economic series; the test tables hold orders
and line items. Each analog below turns a table into a bronze table of
``(serie, data, valor, _ingested_at, _source)`` rows so every operator runs
on data whose size grows with the scale factor:

* rate       per (supplier, ship day):   mean quantity / 1000 (a small daily %)
* fx         per (supplier, ship day):   mean extended price / 10,000
* inflation  per (supplier, ship month): 20 x mean(discount - tax)
* level      per order month:            total order price
* ratio      per order month:            share of orders in status 'P', in %
* events     per (user, day):            re-ingestions keyed by event time

Sums are taken over integer cents so the values are exact and repeat
bit-for-bit in any engine. Invalid values (NULL, NaN, negative, above
the upper bound) and a second, newer ingestion batch are planted by a
deterministic hash of the key, so filters and de-duplication have work to
do; no input row is dropped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.calendar import month_start, ntz_literal

# Fixed parameters of the analogs (shared with the SQL oracle).
EPOCH = "1992-01-01"
HASH_MULTIPLIER = 7
HASH_MODULUS = 211
FIRST_BATCH = dt.datetime(2024, 1, 1)
REVISION_BATCH = dt.datetime(2024, 1, 2)
REVISION_FACTOR = 1.01
REVISED_CODES = (0, 4)
SOURCE = "testdata"
# Which planted codes each kind receives: 0 NULL, 1 NaN, 2 negative, 3 above bound.
PLANTED = {"rate": (0, 1, 2, 3), "fx": (0, 1, 2), "inflation": (0, 1), "plain": ()}
RATE_SCALE = 1000.0
FX_SCALE = 1_000_000.0  # cents -> price / 10,000
INFLATION_SCALE = 5.0   # cents of (discount - tax) -> 20 x mean


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c: str):
    return F.round(F.col(c) * F.lit(100.0)).cast("bigint")


def _hash_code() -> F.Column:
    days = F.datediff(F.col("data"), F.lit(EPOCH).cast("date"))
    return F.pmod(F.col("serie") * F.lit(HASH_MULTIPLIER) + days, F.lit(HASH_MODULUS))


def _plant(raw: F.Column, code: F.Column, codes) -> F.Column:
    expr = None
    replacement = {0: F.lit(None).cast("double"), 1: F.lit(float("nan")),
                   2: -raw, 3: raw + F.lit(100.0)}
    for c in codes:
        cond = code == F.lit(c)
        expr = F.when(cond, replacement[c]) if expr is None else expr.when(cond, replacement[c])
    return raw if expr is None else expr.otherwise(raw)


def to_bronze(obs: DataFrame, kind: str, revise: bool = True) -> DataFrame:
    """Observations ``(serie, data, raw)`` -> bronze with planted defects and a revision batch.

    One pass: rows chosen for revision are emitted twice with ``explode``
    (first batch, then revision), so the source is scanned and aggregated
    once.
    """
    code = _hash_code()
    revised = code.isin(*REVISED_CODES) if revise else F.lit(False)
    batches = F.when(revised, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = obs.withColumn("_h", code).withColumn("_batch", F.explode(batches))
    first = F.col("_batch") == 0
    valor = F.when(first, _plant(F.col("raw"), F.col("_h"), PLANTED[kind])) \
             .otherwise(F.col("raw") * F.lit(REVISION_FACTOR))
    ingested = F.when(first, ntz_literal(FIRST_BATCH)).otherwise(ntz_literal(REVISION_BATCH))
    return rows.select("serie", "data", valor.alias("valor"), ingested.alias("_ingested_at"),
                       F.lit(SOURCE).alias("_source"))


def supplier_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the line items per (supplier, ship day); the three supplier
    analogs are projections or roll-ups of it."""
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_suppkey").alias("serie"), F.to_date("l_shipdate").alias("data"))
            .agg(F.sum("l_quantity").alias("quantity"), F.sum(_cents("l_extendedprice")).alias("price"),
                 F.sum(_cents("l_discount") - _cents("l_tax")).alias("net"), F.count(F.lit(1)).alias("n")))


def rate_observations(spark: SparkSession, sf_dir: str, days: DataFrame | None = None) -> DataFrame:
    days = supplier_days(spark, sf_dir) if days is None else days
    return days.select("serie", "data", (F.col("quantity") / F.col("n") / F.lit(RATE_SCALE)).alias("raw"))


def fx_observations(spark: SparkSession, sf_dir: str, days: DataFrame | None = None) -> DataFrame:
    days = supplier_days(spark, sf_dir) if days is None else days
    return days.select("serie", "data",
                       (F.col("price").cast("double") / F.col("n") / F.lit(FX_SCALE)).alias("raw"))


def inflation_observations(spark: SparkSession, sf_dir: str, days: DataFrame | None = None) -> DataFrame:
    """Integer sums, so a roll-up of days gives the month exactly."""
    if days is None:
        days = table(spark, sf_dir, "lineitem").select(
            F.col("l_suppkey").alias("serie"), F.col("l_shipdate").alias("data"),
            (_cents("l_discount") - _cents("l_tax")).alias("net"), F.lit(1).alias("n"))
    return (days.groupBy("serie", month_start("data").alias("data"))
                .agg((F.sum("net").cast("double") / F.sum("n") / F.lit(INFLATION_SCALE)).alias("raw")))


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the orders per month."""
    return (table(spark, sf_dir, "orders").groupBy(month_start("o_orderdate").alias("data"))
            .agg(F.sum(_cents("o_totalprice")).alias("price"),
                 F.count_if(F.col("o_orderstatus") == F.lit("P")).alias("open"), F.count(F.lit(1)).alias("n")))


def level_observations(spark: SparkSession, sf_dir: str, months: DataFrame | None = None) -> DataFrame:
    months = order_months(spark, sf_dir) if months is None else months
    return months.select(F.lit("level").alias("serie"), "data",
                         (F.col("price").cast("double") / F.lit(100.0)).alias("valor"))


def ratio_observations(spark: SparkSession, sf_dir: str, months: DataFrame | None = None) -> DataFrame:
    months = order_months(spark, sf_dir) if months is None else months
    return months.select(F.lit("ratio").alias("serie"), "data",
                         (F.lit(100.0) * F.col("open") / F.col("n")).alias("valor"))


def plain_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both plain analogs as one bronze table, from one pass over the orders."""
    both = order_months(spark, sf_dir).select("data", F.explode(F.create_map(
        F.lit("level"), F.col("price").cast("double") / F.lit(100.0),
        F.lit("ratio"), F.lit(100.0) * F.col("open") / F.col("n"))).alias("serie", "valor"))
    return plain_bronze(both.select("serie", "data", "valor"))


def plain_bronze(obs: DataFrame) -> DataFrame:
    return obs.withColumns({
        "_ingested_at": ntz_literal(FIRST_BATCH),
        "_source": F.lit(SOURCE),
    })


def rate_bronze(spark, sf_dir, days=None):
    return to_bronze(rate_observations(spark, sf_dir, days), "rate")


def fx_bronze(spark, sf_dir, days=None):
    return to_bronze(fx_observations(spark, sf_dir, days), "fx")


def inflation_bronze(spark, sf_dir, days=None):
    return to_bronze(inflation_observations(spark, sf_dir, days), "inflation")


def level_bronze(spark, sf_dir, months=None):
    return plain_bronze(level_observations(spark, sf_dir, months))


def ratio_bronze(spark, sf_dir, months=None):
    return plain_bronze(ratio_observations(spark, sf_dir, months))


def event_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as re-ingestions: (user, day) is the key, event time the version."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("serie"),
        F.to_date("ts").alias("data"),
        F.col("value").alias("valor"),
        F.col("ts").alias("_ingested_at"),
        F.col("event_id").alias("_seq"),
    )
