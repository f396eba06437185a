"""Silver indicators against a plain-Python brute force on random series."""

import datetime as dt
import math
import statistics
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from indicata.plans import silver as S


def r(x, n):
    """Half-up rounding of the value to 10 decimals, then to ``n`` (the round_exact rule)."""
    if x is None:
        return None
    ten = Decimal(x).quantize(Decimal(1).scaleb(-10), ROUND_HALF_UP)
    return float(ten.quantize(Decimal(1).scaleb(-n), ROUND_HALF_UP))


def expected_fx(values):
    """values: list of (date, valor) of one series -> rows as the fx silver computes them."""
    valid = sorted((d, v) for d, v in values if v is not None and not math.isnan(v) and v > 0)
    out = []
    for i, (d, v) in enumerate(valid):
        prev = valid[i - 1][1] if i else None
        frame = [x for _, x in valid[max(0, i - 29): i + 1]]
        chg = r(v - prev, 4) if prev is not None else None
        pct = r((v - prev) / prev * 100, 4) if prev else None
        trend = "alta" if chg is not None and chg > 0.05 else ("queda" if chg is not None and chg < -0.05 else "estavel")
        out.append((d, v, chg, pct, r(sum(frame) / len(frame), 4), r(max(frame), 4), r(min(frame), 4), trend))
    return out


def expected_rate_vol(values):
    valid = sorted((d, v) for d, v in values if v is not None and not math.isnan(v) and 0 < v < 100)
    out = []
    for i, (d, v) in enumerate(valid):
        frame = [x for _, x in valid[max(0, i - 29): i + 1]]
        ytd = [x for dd, x in valid[: i + 1] if dd.year == d.year]
        vol = r(statistics.stdev(frame), 6) if len(frame) > 1 else None
        out.append((d, vol, r(sum(ytd) / len(ytd), 4)))
    return out


values_st = st.lists(st.one_of(st.none(), st.just(float("nan")),
                               st.integers(-5, 4000).map(lambda c: c / 100.0)), min_size=1, max_size=70)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(series=st.lists(values_st, min_size=1, max_size=3), start=st.integers(0, 400))
def test_silver_matches_brute_force(spark, series, start):
    base = dt.date(2023, 1, 1) + dt.timedelta(days=start)
    rows = [(f"s{k}", base + dt.timedelta(days=3 * i), v) for k, vals in enumerate(series) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "serie string, data date, valor double")
    fx = S.silver_fx(df, dedup=False).select("serie", "data", "valor", "variacao_abs", "variacao_pct", "media_movel_30d",
                                "max_30d", "min_30d", "tendencia").collect()
    got = sorted(tuple(x) for x in fx)
    want = sorted((f"s{k}",) + e for k, vals in enumerate(series)
                  for e in expected_fx([(base + dt.timedelta(days=3 * i), v) for i, v in enumerate(vals)]))
    assert got == want
    rate = S.silver_rate(df, dedup=False).select("serie", "data", "volatilidade_30d", "acumulado_ano").collect()
    got = sorted(tuple(x) for x in rate)
    want = sorted((f"s{k}",) + e for k, vals in enumerate(series)
                  for e in expected_rate_vol([(base + dt.timedelta(days=3 * i), v) for i, v in enumerate(vals)]))
    assert got == want
