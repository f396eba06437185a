"""Wide monthly table: five monthly views left-joined on the month.

The policy-rate months drive the table (left side): a month present only
in another series is absent, a month missing in another series gives
NULLs.

Join strategy: a side keyed by the month alone has at most one row per
calendar month of the data (a few hundred rows for decades of history), a
bound that does not grow with the input volume, so it is broadcast
explicitly. Sides keyed by (series, month) grow with the number of series:
they are joined on shuffled keys, and a side whose windows are partitioned by
the series alone is shuffled once more after its monthly aggregation (a few
rows per series and month). AQE may still switch to a broadcast from the
measured size at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.functions.numeric import fisher_real_rate
from indicata.schemas import GOLD_COLUMNS


def left_join_all(base: DataFrame, others: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Chain of left equi-joins, each on its own key list.

    A side joined on ``mes_ref`` only is month-bounded and broadcast.
    """
    out = base
    for other, on in others:
        side = F.broadcast(other) if list(on) == ["mes_ref"] else other
        out = out.join(side, list(on), "left")
    return out


def gold_wide(rate_m: DataFrame, inflation_m: DataFrame, fx_m: DataFrame, level_m: DataFrame,
              ratio_m: DataFrame | None = None, keys: Sequence[str] = (),
              plain_keys: Sequence[str] = ()) -> DataFrame:
    """Join the monthly views and add the Fisher real rate.

    ``keys`` are the series keys shared by rate / inflation / fx views;
    ``plain_keys`` those of the level / ratio views (usually none). ``ratio_m``
    None: ``level_m`` is one view with both (``monthly.monthly_plain``).
    """
    on = (*keys, "mes_ref")
    plain_on = (*plain_keys, "mes_ref")
    joined = left_join_all(rate_m, [
        (inflation_m, on),
        (fx_m.drop("dollar_min_mes"), on),
        (level_m, plain_on),
        *([] if ratio_m is None else [(ratio_m, plain_on)]),
    ])
    joined = joined.withColumn(
        "juros_real_estimado", fisher_real_rate("selic_anualizada_mes", "ipca_12m"))
    return joined.select(*keys, *GOLD_COLUMNS)


def gold_left_join_two(rate_m: DataFrame, inflation_m: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The first link of the chain alone: rate months with their inflation."""
    return rate_m.join(inflation_m, [*keys, "mes_ref"], "left")


def point_lookup(gold: DataFrame, month: str) -> DataFrame:
    return gold.filter(F.col("mes_ref") == F.lit(month).cast("date"))
