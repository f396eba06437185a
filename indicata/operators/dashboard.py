"""Dashboard texts: metric cards and insight sentences, as DataFrame columns.

Input is the output of ``latest_metric_change`` (one row per metric, or
per (series, metric)); the texts are built with column expressions, so
any number of series is handled by the same plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions.formatting import format_delta, format_metric, format_reference, two_decimals

# Fixed values (must equal the reference for right results).
# metric column -> (card label, value prefix, value suffix, change suffix)
METRIC_CARDS = {
    "selic_anualizada_mes": ("Selic anualizada", "", "%", " p.p."),
    "ipca_12m": ("IPCA 12 meses", "", "%", " p.p."),
    "juros_real_estimado": ("Juro real estimado", "", "%", " p.p."),
    "dollar_medio_mes": ("Dólar médio", "R$ ", "", ""),
    "pib_valor_mes": ("PIB mensal", "R$ ", " mi", " mi"),
    "inadimplencia_media_mes": ("Inadimplência", "", "%", " p.p."),
}
CARD_SEPARATOR = " · "
# Insight sentences: metric, rule applied to it, words for positive / other.
INSIGHT_INFLATION = ("ipca_12m", "acelerou", "desacelerou",
                     "O IPCA em 12 meses {word} {value} p.p. na última observação.")
INSIGHT_REAL_RATE = ("juros_real_estimado", "positivo", "negativo",
                     "O juro real anual estimado está {word}, em {value}%.")
INSIGHT_FX = ("dollar_medio_mes", "subiu", "recuou",
              "O dólar médio {word} R$ {value} frente ao mês anterior.")


def _pick(metric: Column, index: int) -> Column:
    expr = None
    for name, spec in METRIC_CARDS.items():
        cond = metric == F.lit(name)
        expr = F.when(cond, F.lit(spec[index])) if expr is None else expr.when(cond, F.lit(spec[index]))
    return expr


def metric_cards(latest: DataFrame) -> DataFrame:
    """One card per known metric: label with reference, value text, change text."""
    m = F.col("metric")
    known = latest.filter(m.isin(*METRIC_CARDS))
    label = F.concat(_pick(m, 0), F.lit(CARD_SEPARATOR), format_reference("mes_ref"))
    value = format_metric_dynamic("valor", _pick(m, 1), _pick(m, 2))
    delta = F.concat(format_delta("variacao"), _pick(m, 3))
    keys = [c for c in latest.columns if c not in ("metric", "valor", "variacao", "mes_ref")]
    return known.select(*keys, "metric", label.alias("rotulo"), value.alias("valor_texto"),
                        delta.alias("variacao_texto"))


def format_metric_dynamic(c: str, prefix: Column, suffix: Column) -> Column:
    """``format_metric`` with per-row prefix and suffix columns."""
    body = F.concat(prefix, two_decimals(c), suffix)
    return F.coalesce(body, format_metric(F.lit(None).cast("double")))


def _sentence(template: str, word: Column, value: Column) -> Column:
    head, rest = template.split("{word}")
    middle, tail = rest.split("{value}")
    return F.concat(F.lit(head), word, F.lit(middle), value, F.lit(tail))


def insight_sentences(latest: DataFrame) -> DataFrame:
    """Up to three sentences (per key) from the latest changes / values.

    Inflation and FX read the change; the real rate reads the latest value.
    A rule whose input is NULL gives no sentence.
    """
    m, v, chg = F.col("metric"), F.col("valor"), F.col("variacao")
    rules = []
    for spec, source in ((INSIGHT_INFLATION, chg), (INSIGHT_REAL_RATE, v), (INSIGHT_FX, chg)):
        name, pos, neg, template = spec
        word = F.when(source > 0, F.lit(pos)).otherwise(F.lit(neg))
        shown = source if spec is INSIGHT_REAL_RATE else F.abs(source)
        rules.append((name, _sentence(template, word, two_decimals(shown)), source))
    text = None
    for name, sentence, source in rules:
        cond = (m == F.lit(name)) & source.isNotNull()
        text = F.when(cond, sentence) if text is None else text.when(cond, sentence)
    keys = [c for c in latest.columns if c not in ("metric", "valor", "variacao", "mes_ref")]
    return (latest.select(*keys, F.col("metric").alias("regra"), text.alias("texto"))
                  .filter(F.col("texto").isNotNull()))
