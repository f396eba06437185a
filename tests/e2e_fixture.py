"""Five small series over two months, and the gold that follows from them by
plain arithmetic (no product code)."""

# kind -> (serie name, [(iso date, value)])
FIXTURE = {
    "rate": ("selic", [("2024-03-04", 0.05), ("2024-03-05", 0.03), ("2024-04-02", 0.06)]),
    "inflation": ("ipca", [("2024-03-01", 0.4), ("2024-04-01", 0.25)]),
    "fx": ("dollar", [("2024-03-04", 5.0), ("2024-03-06", 5.2), ("2024-04-03", 5.1)]),
    "level": ("pib", [("2024-03-01", 900.125), ("2024-04-01", 905.25)]),
    "ratio": ("inadimplencia", [("2024-03-01", 2.9), ("2024-04-01", 3.05)]),
}


def yearly(rate: float) -> float:
    return round((1 + rate / 100) ** 252 - 1, 6)


def real(nominal: float, inflation: float) -> float:
    return round(((1 + nominal / 100) / (1 + inflation / 100) - 1) * 100, 4)


_MARCH = (yearly(0.05) + yearly(0.03)) / 2 * 100
_APRIL = yearly(0.06) * 100

GOLD = {
    "2024-03-01": dict(selic_media_mes=0.04, selic_max_mes=0.05, selic_min_mes=0.03,
                       selic_anualizada_mes=_MARCH, ipca_acumulado_mes=0.4, ipca_12m=0.4,
                       dollar_medio_mes=5.1, dollar_max_mes=5.2, pib_valor_mes=900.125,
                       inadimplencia_media_mes=2.9, juros_real_estimado=real(_MARCH, 0.4)),
    "2024-04-01": dict(selic_media_mes=0.06, selic_max_mes=0.06, selic_min_mes=0.06,
                       selic_anualizada_mes=_APRIL, ipca_acumulado_mes=0.25, ipca_12m=0.65,
                       dollar_medio_mes=5.1, dollar_max_mes=5.1, pib_valor_mes=905.25,
                       inadimplencia_media_mes=3.05, juros_real_estimado=real(_APRIL, 0.65)),
}
