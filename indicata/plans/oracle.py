"""DuckDB SQL equivalent of every registered query (the correctness oracle).

Plain SQL over the driver's views; it imports nothing from the code that it
checks. ``R(x, n)`` is the rounding that the registered queries are compared
with: ``round(x::DECIMAL(38,10), n)::DOUBLE``.
"""

from __future__ import annotations

EPOCH, HASH_MULTIPLIER, HASH_MODULUS = "1992-01-01", 7, 211
PLANTED = {"rate": (0, 1, 2, 3), "fx": (0, 1, 2), "inflation": (0, 1)}
REVISED_CODES, REVISION_FACTOR = (0, 4), 1.01
RATE_SCALE, FX_SCALE, INFLATION_SCALE = 1000.0, 1_000_000.0, 5.0
# Rate levels: below 6, 10, 14 percent a year, on the scale of the analog.


def R(expr: str, digits: int) -> str:
    return f"round(({expr})::DECIMAL(38,10), {digits})::DOUBLE"


def STABLE(expr: str) -> str:
    return R(expr, 8)


_RATE_T = [limit / RATE_SCALE for limit in (6.0, 10.0, 14.0)]
_H = f"((serie * {HASH_MULTIPLIER} + (data - DATE '{EPOCH}')) % {HASH_MODULUS})"
_TS1 = "TIMESTAMP '2024-01-01 00:00:00'"
_TS2 = "TIMESTAMP '2024-01-02 00:00:00'"
_REPL = {0: "NULL", 1: "'NaN'::DOUBLE", 2: "-raw", 3: "raw + 100.0::DOUBLE"}


def _plant(codes) -> str:
    if not codes:
        return "raw"
    whens = " ".join(f"WHEN {c} THEN {_REPL[c]}" for c in codes)
    return f"CASE h {whens} ELSE raw END"


def _bronze(name: str, obs_sql: str, kind: str) -> str:
    codes = PLANTED[kind]
    revised = ", ".join(str(c) for c in REVISED_CODES)
    return f"""{name}_obs AS ({obs_sql}),
{name}_coded AS (SELECT serie, data, raw, {_H} AS h FROM {name}_obs),
{name}_bronze AS (
  SELECT serie, data, {_plant(codes)} AS valor, {_TS1} AS _ingested_at, 'testdata' AS _source
  FROM {name}_coded
  UNION ALL
  SELECT serie, data, raw * {REVISION_FACTOR!r}::DOUBLE AS valor, {_TS2} AS _ingested_at,
         'testdata' AS _source
  FROM {name}_coded WHERE h IN ({revised})),
{name}_dedup AS (
  SELECT * FROM {name}_bronze
  QUALIFY row_number() OVER (PARTITION BY serie, data ORDER BY _ingested_at DESC) = 1)"""


_CENTS = "CAST(round({c} * 100.0::DOUBLE) AS BIGINT)"

RATE_OBS = ("SELECT l_suppkey AS serie, CAST(l_shipdate AS DATE) AS data, "
            f"sum(l_quantity) / count(*) / {RATE_SCALE!r}::DOUBLE AS raw "
            "FROM lineitem GROUP BY 1, 2")
FX_OBS = ("SELECT l_suppkey AS serie, CAST(l_shipdate AS DATE) AS data, "
          f"CAST(sum({_CENTS.format(c='l_extendedprice')}) AS DOUBLE) / count(*) "
          f"/ {FX_SCALE!r}::DOUBLE AS raw FROM lineitem GROUP BY 1, 2")
INFLATION_OBS = ("SELECT l_suppkey AS serie, CAST(date_trunc('month', l_shipdate) AS DATE) AS data, "
                 f"CAST(sum({_CENTS.format(c='l_discount')} - {_CENTS.format(c='l_tax')}) AS DOUBLE) "
                 f"/ count(*) / {INFLATION_SCALE!r}::DOUBLE AS raw FROM lineitem GROUP BY 1, 2")

RATE_BRONZE = _bronze("rate", RATE_OBS, "rate")
FX_BRONZE = _bronze("fx", FX_OBS, "fx")
INFLATION_BRONZE = _bronze("infl", INFLATION_OBS, "inflation")

LEVEL_SILVER = f"""level_silver AS (
  SELECT 'level' AS serie, CAST(date_trunc('month', o_orderdate) AS DATE) AS data,
         CAST(sum({_CENTS.format(c='o_totalprice')}) AS DOUBLE) / 100.0::DOUBLE AS valor
  FROM orders GROUP BY 2)"""
RATIO_SILVER = """ratio_silver AS (
  SELECT 'ratio' AS serie, CAST(date_trunc('month', o_orderdate) AS DATE) AS data,
         100.0::DOUBLE * count_if(o_orderstatus = 'P') / count(*) AS valor
  FROM orders GROUP BY 2)"""

RATE_SILVER = f"""{RATE_BRONZE},
rate_valid AS (
  SELECT serie, data, valor FROM rate_dedup
  WHERE valor IS NOT NULL AND NOT isnan(valor) AND valor > 0 AND valor < 100),
rate_silver AS (
  SELECT serie, data, valor,
    {R("valor - lag(valor) OVER w", 4)} AS variacao_pp,
    {R("pow(1.0::DOUBLE + valor / 100.0::DOUBLE, 252.0::DOUBLE) - 1.0::DOUBLE", 6)} AS taxa_anualizada,
    {R("avg(valor) OVER w30", 4)} AS media_movel_30d,
    {R("stddev_samp(valor) OVER w30", 6)} AS volatilidade_30d,
    {R("avg(valor) OVER wy", 4)} AS acumulado_ano,
    CASE WHEN valor < {_RATE_T[0]!r}::DOUBLE THEN 'baixo'
         WHEN valor < {_RATE_T[1]!r}::DOUBLE THEN 'moderado'
         WHEN valor < {_RATE_T[2]!r}::DOUBLE THEN 'alto' ELSE 'muito_alto' END AS nivel_taxa,
    CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
    CAST(quarter(data) AS INTEGER) AS trimestre, CAST(dayofweek(data) + 1 AS INTEGER) AS dia_semana
  FROM rate_valid
  WINDOW w AS (PARTITION BY serie ORDER BY data),
         w30 AS (PARTITION BY serie ORDER BY data ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
         wy AS (PARTITION BY serie, year(data) ORDER BY data
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

FX_SILVER = f"""{FX_BRONZE},
fx_valid AS (
  SELECT serie, data, valor FROM fx_dedup
  WHERE valor IS NOT NULL AND NOT isnan(valor) AND valor > 0),
fx_w AS (
  SELECT serie, data, valor,
    {R("valor - lag(valor) OVER w", 4)} AS variacao_abs,
    {R("CASE WHEN lag(valor) OVER w = 0 THEN NULL ELSE (valor - lag(valor) OVER w) / lag(valor) OVER w END * 100.0::DOUBLE", 4)} AS variacao_pct,
    {R("avg(valor) OVER w30", 4)} AS media_movel_30d,
    {R("max(valor) OVER w30", 4)} AS max_30d,
    {R("min(valor) OVER w30", 4)} AS min_30d,
    CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
    CAST(quarter(data) AS INTEGER) AS trimestre
  FROM fx_valid
  WINDOW w AS (PARTITION BY serie ORDER BY data),
         w30 AS (PARTITION BY serie ORDER BY data ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
fx_silver AS (
  SELECT serie, data, valor, variacao_abs, variacao_pct, media_movel_30d, max_30d, min_30d,
    CASE WHEN variacao_abs > 0.05::DOUBLE THEN 'alta'
         WHEN variacao_abs < -0.05::DOUBLE THEN 'queda' ELSE 'estavel' END AS tendencia,
    ano, mes, trimestre
  FROM fx_w)"""

INFLATION_SILVER = f"""{INFLATION_BRONZE},
infl_valid AS (
  SELECT serie, data, valor FROM infl_dedup WHERE valor IS NOT NULL AND NOT isnan(valor)),
infl_silver AS (
  SELECT serie, data, valor,
    {R("valor - lag(valor) OVER w", 4)} AS variacao_pp,
    {R("sum(valor) OVER w12", 4)} AS acumulado_12m,
    {R("sum(valor) OVER wy", 4)} AS acumulado_ano,
    CASE WHEN valor < 0.0::DOUBLE THEN 'deflacao' WHEN valor < 0.3::DOUBLE THEN 'controlada'
         WHEN valor < 0.6::DOUBLE THEN 'moderada' ELSE 'elevada' END AS pressao,
    CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
    CAST(quarter(data) AS INTEGER) AS trimestre
  FROM infl_valid
  WINDOW w AS (PARTITION BY serie ORDER BY data),
         w12 AS (PARTITION BY serie ORDER BY data ROWS BETWEEN 11 PRECEDING AND CURRENT ROW),
         wy AS (PARTITION BY serie, year(data) ORDER BY data
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _month(c: str = "data") -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


def _monthly_rate(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    g = f"GROUP BY {keys + ', ' if keys else ''}{_month()}"
    return f"""rate_m AS (
  SELECT {k}{_month()} AS mes_ref,
    {STABLE("avg(valor)")} AS selic_media_mes, max(valor) AS selic_max_mes,
    min(valor) AS selic_min_mes, {STABLE("avg(taxa_anualizada) * 100.0::DOUBLE")} AS selic_anualizada_mes
  FROM rate_silver {g})"""


def _monthly_inflation(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    g = f"GROUP BY {keys + ', ' if keys else ''}{_month()}"
    return f"""infl_m AS (
  SELECT {k}{_month()} AS mes_ref, {STABLE("sum(valor)")} AS ipca_acumulado_mes,
    max(acumulado_12m) AS ipca_12m
  FROM infl_silver {g})"""


def _monthly_fx(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    g = f"GROUP BY {keys + ', ' if keys else ''}{_month()}"
    return f"""fx_m AS (
  SELECT {k}{_month()} AS mes_ref, {STABLE("avg(valor)")} AS dollar_medio_mes,
    max(valor) AS dollar_max_mes, min(valor) AS dollar_min_mes
  FROM fx_silver {g})"""


LEVEL_M = f"""level_m AS (
  SELECT {_month()} AS mes_ref, {R("avg(valor)", 2)} AS pib_valor_mes FROM level_silver GROUP BY 1)"""
RATIO_M = f"""ratio_m AS (
  SELECT {_month()} AS mes_ref, {STABLE("avg(valor)")} AS inadimplencia_media_mes
  FROM ratio_silver GROUP BY 1)"""

ALL_SILVER = f"{RATE_SILVER},\n{FX_SILVER},\n{INFLATION_SILVER},\n{LEVEL_SILVER},\n{RATIO_SILVER}"

FISHER = R("((1.0::DOUBLE + rate_m.selic_anualizada_mes / 100.0::DOUBLE) "
           "/ (1.0::DOUBLE + infl_m.ipca_12m / 100.0::DOUBLE) - 1.0::DOUBLE) * 100.0::DOUBLE", 4)


def _gold_cte(keys: str = "") -> str:
    """Months of the rate, each other column looked up by month (and series)."""
    by = f"{keys}, mes_ref" if keys else "mes_ref"
    return f"""{ALL_SILVER},
{_monthly_rate(keys)},
{_monthly_inflation(keys)},
{_monthly_fx(keys)},
{LEVEL_M},
{RATIO_M},
gold AS (
  SELECT {by}, selic_media_mes, selic_max_mes, selic_min_mes, selic_anualizada_mes, ipca_acumulado_mes,
    ipca_12m, dollar_medio_mes, dollar_max_mes, pib_valor_mes, inadimplencia_media_mes,
    {FISHER} AS juros_real_estimado
  FROM rate_m LEFT JOIN infl_m USING ({by}) LEFT JOIN fx_m USING ({by})
    LEFT JOIN level_m USING (mes_ref) LEFT JOIN ratio_m USING (mes_ref))"""


GOLD = _gold_cte()
GOLD_BY_SERIES = _gold_cte("serie")

SILVER_RATE_COLS = ("serie, data, valor, variacao_pp, taxa_anualizada, media_movel_30d, "
                    "volatilidade_30d, acumulado_ano, nivel_taxa, ano, mes, trimestre, dia_semana")

ORACLE: dict[str, str] = {
    "dedup_latest": """
SELECT user_id AS serie, CAST(ts AS DATE) AS data, value AS valor, ts AS _ingested_at, event_id AS _seq
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""",
    "silver_rate": f"WITH {RATE_SILVER} SELECT {SILVER_RATE_COLS} FROM rate_silver",
    "silver_fx": f"WITH {FX_SILVER} SELECT * FROM fx_silver",
    "silver_inflation": f"WITH {INFLATION_SILVER} SELECT * FROM infl_silver",
    "silver_plain_monthly": f"WITH {LEVEL_SILVER}, {RATIO_SILVER} "
                            "SELECT * FROM level_silver UNION ALL SELECT * FROM ratio_silver",
    "monthly_rate": f"WITH {RATE_SILVER}, {_monthly_rate()} SELECT * FROM rate_m",
    "monthly_inflation": f"WITH {INFLATION_SILVER}, {_monthly_inflation()} SELECT * FROM infl_m",
    "monthly_fx": f"WITH {FX_SILVER}, {_monthly_fx()} SELECT * FROM fx_m",
    "monthly_level": f"WITH {LEVEL_SILVER}, {LEVEL_M} SELECT * FROM level_m",
    "monthly_ratio": f"WITH {RATIO_SILVER}, {RATIO_M} SELECT * FROM ratio_m",
    "gold_wide_monthly": f"WITH {GOLD} SELECT * FROM gold",
    "gold_by_series": f"WITH {GOLD_BY_SERIES} SELECT * FROM gold",
}


# ---------------------------------------------------------------- single operators
_WS = "WINDOW w AS (PARTITION BY serie ORDER BY data)"
_W30 = "(PARTITION BY serie ORDER BY data ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
_W12 = "(PARTITION BY serie ORDER BY data ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
_WY = "(PARTITION BY serie, year(data) ORDER BY data ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_ANO = "CAST(year(data) AS INTEGER) AS ano"
_RATE_LABEL = (f"CASE WHEN valor < {_RATE_T[0]!r}::DOUBLE THEN 'baixo' "
               f"WHEN valor < {_RATE_T[1]!r}::DOUBLE THEN 'moderado' "
               f"WHEN valor < {_RATE_T[2]!r}::DOUBLE THEN 'alto' ELSE 'muito_alto' END")
_CHANGE_ABS = f"""SELECT serie, data, valor, {R("valor - lag(valor) OVER w", 4)} AS variacao_abs
FROM fx_valid {_WS}"""

METRICS = ("selic_media_mes", "selic_max_mes", "selic_min_mes", "selic_anualizada_mes",
           "ipca_acumulado_mes", "ipca_12m", "dollar_medio_mes", "dollar_max_mes",
           "pib_valor_mes", "inadimplencia_media_mes", "juros_real_estimado")
_PRESENT = "(valor IS NOT NULL AND NOT isnan(valor))"


def _long(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    parts = [f"SELECT {k}mes_ref, '{m}' AS metric, {m} AS valor FROM gold" for m in METRICS]
    return "long AS (" + "\n  UNION ALL ".join(parts) + ")"


def _latest_change(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {k}metric"
    return f"""ranked AS (
  SELECT {k}metric, valor, mes_ref, {_PRESENT} AS present,
    row_number() OVER ({part} ORDER BY (valor IS NULL OR isnan(valor)), mes_ref DESC) AS rk
  FROM long),
lc AS (
  SELECT {k}metric,
    max(CASE WHEN rk = 1 AND present THEN valor END) AS valor,
    CASE WHEN count(CASE WHEN rk <= 2 AND present THEN 1 END) = 2
         THEN max(CASE WHEN rk = 1 THEN valor END) - max(CASE WHEN rk = 2 THEN valor END) END AS variacao,
    max(CASE WHEN rk = 1 AND present THEN mes_ref END) AS mes_ref
  FROM ranked GROUP BY {k}metric)"""


def _ref(c: str) -> str:
    return f"COALESCE(strftime({c}, '%m/%Y'), 'Sem referência')"


def _d2(c: str) -> str:
    return f"CAST(CAST({R(c, 2)} AS DECIMAL(18,2)) AS VARCHAR)"


_CARDS = """cards(metric, lbl, pre, suf, dsuf) AS (VALUES
  ('selic_anualizada_mes', 'Selic anualizada', '', '%', ' p.p.'),
  ('ipca_12m', 'IPCA 12 meses', '', '%', ' p.p.'),
  ('juros_real_estimado', 'Juro real estimado', '', '%', ' p.p.'),
  ('dollar_medio_mes', 'Dólar médio', 'R$ ', '', ''),
  ('pib_valor_mes', 'PIB mensal', 'R$ ', ' mi', ' mi'),
  ('inadimplencia_media_mes', 'Inadimplência', '', '%', ' p.p.'))"""

_INSIGHTS = f"""SELECT regra, texto FROM (
  SELECT metric AS regra, CASE
    WHEN metric = 'ipca_12m' AND variacao IS NOT NULL THEN 'O IPCA em 12 meses '
      || CASE WHEN variacao > 0 THEN 'acelerou' ELSE 'desacelerou' END || ' '
      || {_d2('abs(variacao)')} || ' p.p. na última observação.'
    WHEN metric = 'juros_real_estimado' AND valor IS NOT NULL THEN 'O juro real anual estimado está '
      || CASE WHEN valor > 0 THEN 'positivo' ELSE 'negativo' END || ', em ' || {_d2('valor')} || '%.'
    WHEN metric = 'dollar_medio_mes' AND variacao IS NOT NULL THEN 'O dólar médio '
      || CASE WHEN variacao > 0 THEN 'subiu' ELSE 'recuou' END || ' R$ '
      || {_d2('abs(variacao)')} || ' frente ao mês anterior.'
  END AS texto FROM lc) WHERE texto IS NOT NULL"""

_MISSING_COUNTS = ", ".join(["count_if(mes_ref IS NULL) AS mes_ref"]
                           + [f"count_if({c} IS NULL OR isnan({c})) AS {c}" for c in METRICS])


def _count(name: str, layer: str, rel: str) -> str:
    return f"SELECT '{name}' AS tabela, '{layer}' AS camada, count(*) AS linhas FROM {rel}"


ORACLE.update({
    "filter_valid_observations": f"WITH {RATE_SILVER} SELECT serie, data, valor FROM rate_valid",
    "change_abs": f"WITH {FX_SILVER} {_CHANGE_ABS}",
    "change_pct": f"""WITH {FX_SILVER} SELECT serie, data, valor,
  {R("CASE WHEN lag(valor) OVER w = 0 THEN NULL ELSE (valor - lag(valor) OVER w) / lag(valor) OVER w END * 100.0::DOUBLE", 4)} AS variacao_pct
FROM fx_valid {_WS}""",
    "moving_avg_30": f"WITH {RATE_SILVER} SELECT serie, data, valor, "
                     f"{R('avg(valor) OVER ' + _W30, 4)} AS media_movel_30d FROM rate_valid",
    "volatility_30": f"WITH {RATE_SILVER} SELECT serie, data, valor, "
                     f"{R('stddev_samp(valor) OVER ' + _W30, 6)} AS volatilidade_30d FROM rate_valid",
    "moving_extremes_30": f"WITH {FX_SILVER} SELECT serie, data, valor, "
                          f"{R('max(valor) OVER ' + _W30, 4)} AS max_30d, "
                          f"{R('min(valor) OVER ' + _W30, 4)} AS min_30d FROM fx_valid",
    "rolling_sum_12": f"WITH {INFLATION_SILVER} SELECT serie, data, valor, "
                      f"{R('sum(valor) OVER ' + _W12, 4)} AS acumulado_12m FROM infl_valid",
    "ytd_sum": f"WITH {INFLATION_SILVER} SELECT serie, data, valor, {_ANO}, "
               f"{R('sum(valor) OVER ' + _WY, 4)} AS acumulado_ano FROM infl_valid",
    "ytd_avg": f"WITH {RATE_SILVER} SELECT serie, data, valor, {_ANO}, "
               f"{R('avg(valor) OVER ' + _WY, 4)} AS acumulado_ano FROM rate_valid",
    "annualize_rate": f"""WITH {RATE_SILVER} SELECT serie, data, valor,
  {R("pow(1.0::DOUBLE + valor / 100.0::DOUBLE, 252.0::DOUBLE) - 1.0::DOUBLE", 6)} AS taxa_anualizada
FROM rate_valid""",
    "classify_rate_level": f"WITH {RATE_SILVER} SELECT serie, data, valor, {_RATE_LABEL} AS nivel_taxa "
                           "FROM rate_valid",
    "classify_pressure": f"""WITH {INFLATION_SILVER} SELECT serie, data, valor,
  CASE WHEN valor < 0.0::DOUBLE THEN 'deflacao' WHEN valor < 0.3::DOUBLE THEN 'controlada'
       WHEN valor < 0.6::DOUBLE THEN 'moderada' ELSE 'elevada' END AS pressao
FROM infl_valid""",
    "classify_trend": f"""WITH {FX_SILVER}, ca AS ({_CHANGE_ABS})
SELECT *, CASE WHEN variacao_abs > 0.05::DOUBLE THEN 'alta'
               WHEN variacao_abs < -0.05::DOUBLE THEN 'queda' ELSE 'estavel' END AS tendencia
FROM ca""",
    "calendar_parts": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS data,
  CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
  CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
  CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dia_semana
FROM orders""",
    "real_rate_fisher": f"WITH {GOLD_BY_SERIES} SELECT serie, mes_ref, selic_anualizada_mes, ipca_12m, "
                        "juros_real_estimado FROM gold",
    "gold_left_join_two": f"""WITH {RATE_SILVER}, {INFLATION_SILVER}, {_monthly_rate()}, {_monthly_inflation()}
SELECT rate_m.*, ipca_acumulado_mes, ipca_12m FROM rate_m
LEFT JOIN (SELECT * FROM infl_m WHERE mes_ref < DATE '1999-01-01') USING (mes_ref)""",
    "gold_point_lookup": f"WITH {GOLD} SELECT * FROM gold WHERE mes_ref = DATE '1996-01-01'",
    "gold_table_lookup": f"WITH {GOLD} SELECT * FROM gold WHERE mes_ref = DATE '1996-01-01'",
    "metric_valid_rows": f"WITH {GOLD_BY_SERIES}, {_long('serie')} "
                         f"SELECT serie, mes_ref, metric, valor FROM long WHERE {_PRESENT}",
    "latest_metric": f"""WITH {GOLD_BY_SERIES}, {_long('serie')}
SELECT serie, metric, arg_max(valor, CASE WHEN {_PRESENT} THEN mes_ref END) AS valor,
  max(CASE WHEN {_PRESENT} THEN mes_ref END) AS mes_ref,
  {_ref(f"max(CASE WHEN {_PRESENT} THEN mes_ref END)")} AS referencia
FROM long GROUP BY serie, metric""",
    "latest_metric_change": f"WITH {GOLD_BY_SERIES}, {_long('serie')}, {_latest_change('serie')} "
                            "SELECT * FROM lc",
    "last_n_months": f"WITH {GOLD_BY_SERIES} SELECT * FROM gold "
                     "QUALIFY row_number() OVER (PARTITION BY serie ORDER BY mes_ref DESC) <= 12",
    "newest_n": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders "
                "ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20",
    "sample_rows": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders "
                   "ORDER BY md5(o_orderkey::VARCHAR), o_orderkey LIMIT 20",
    "sample_by_group": """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) <= 20""",
    "union_batches": """SELECT o_orderkey, o_orderdate, o_totalprice, 1 AS lote FROM orders
WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_orderdate, o_totalprice, 2 AS lote FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
    "missing_by_column": f"""WITH {GOLD}, counts AS (SELECT {_MISSING_COUNTS} FROM gold)
SELECT coluna, valores_ausentes FROM (UNPIVOT counts ON COLUMNS(*) INTO NAME coluna VALUE valores_ausentes)
WHERE valores_ausentes > 0""",
    "latest_reference": f"WITH {GOLD} SELECT max(mes_ref) AS mes_ref, {_ref('max(mes_ref)')} AS referencia "
                        "FROM gold",
    "format_reference": f"""WITH {GOLD}, {_long('')}
SELECT metric, {_ref(f"max(CASE WHEN {_PRESENT} THEN mes_ref END)")} AS referencia
FROM long GROUP BY metric""",
    "format_metric_label": f"""WITH {GOLD}, {_long('')}, {_latest_change('')}, {_CARDS}
SELECT lc.metric, lbl || ' · ' || {_ref('mes_ref')} AS rotulo,
  COALESCE(pre || {_d2('valor')} || suf, 'Sem dados') AS valor_texto,
  (CASE WHEN variacao >= 0 THEN '+' ELSE '' END) || {_d2('variacao')} || dsuf AS variacao_texto
FROM lc JOIN cards ON lc.metric = cards.metric""",
    "insight_sentences": f"WITH {GOLD}, {_long('')}, {_latest_change('')} {_INSIGHTS}",
    "profile_rate": f"""WITH {RATE_SILVER}
SELECT serie, min(data) AS data_inicio, max(data) AS data_fim, count(*) AS total_linhas,
  {R("avg(valor)", 2)} AS selic_media, count(DISTINCT nivel_taxa) AS niveis_distintos
FROM rate_silver GROUP BY serie""",
    "profile_inflation": f"""WITH {INFLATION_SILVER}
SELECT serie, min(data) AS data_inicio, max(data) AS data_fim, count(*) AS total_linhas,
  {R("avg(acumulado_12m)", 2)} AS inflacao_12m_media
FROM infl_silver GROUP BY serie""",
    "profile_fx": f"""WITH {FX_SILVER}
SELECT serie, min(data) AS data_inicio, max(data) AS data_fim, count(*) AS total_linhas,
  {R("avg(valor)", 2)} AS dolar_medio, {R("max(valor)", 2)} AS dolar_max
FROM fx_silver GROUP BY serie""",
    "profile_rate_global": f"""WITH {RATE_SILVER}
SELECT min(data) AS data_inicio, max(data) AS data_fim, count(*) AS total_linhas,
  {R("avg(valor)", 2)} AS selic_media, count(DISTINCT nivel_taxa) AS niveis_distintos
FROM rate_silver""",
    "profile_inflation_global": f"""WITH {INFLATION_SILVER}
SELECT min(data) AS data_inicio, max(data) AS data_fim, count(*) AS total_linhas,
  {R("avg(acumulado_12m)", 2)} AS inflacao_12m_media
FROM infl_silver""",
    "profile_fx_global": f"""WITH {FX_SILVER}
SELECT min(data) AS data_inicio, max(data) AS data_fim, count(*) AS total_linhas,
  {R("avg(valor)", 2)} AS dolar_medio, {R("max(valor)", 2)} AS dolar_max
FROM fx_silver""",
    "profile_bronze": f"""WITH {RATE_BRONZE}
SELECT serie, count(*) AS total_registros, min(data) AS primeira_data, max(data) AS ultima_data,
  count_if(valor IS NULL) AS valores_nulos
FROM rate_bronze GROUP BY serie""",
    "label_distribution_rate": f"WITH {RATE_SILVER} SELECT nivel_taxa, count(*) AS ocorrencias, "
                               f"{STABLE('avg(valor)')} AS taxa_media FROM rate_silver GROUP BY 1",
    "label_distribution_inflation": f"WITH {INFLATION_SILVER} SELECT pressao, count(*) AS ocorrencias, "
                                    f"{STABLE('avg(valor)')} AS ipca_medio FROM infl_silver GROUP BY 1",
    "label_distribution_fx": f"WITH {FX_SILVER} SELECT tendencia, count(*) AS ocorrencias, "
                             f"{STABLE('avg(valor)')} AS dolar_medio FROM fx_silver GROUP BY 1",
    "distinct_years": "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders",
    "row_counts_by_layer": f"""WITH {GOLD}
{_count('bronze.rate', 'bronze', 'rate_bronze')}
UNION ALL {_count('bronze.fx', 'bronze', 'fx_bronze')}
UNION ALL {_count('bronze.inflation', 'bronze', 'infl_bronze')}
UNION ALL {_count('silver.rate', 'silver', 'rate_silver')}
UNION ALL {_count('silver.fx', 'silver', 'fx_silver')}
UNION ALL {_count('silver.inflation', 'silver', 'infl_silver')}
UNION ALL SELECT 'silver.plain', 'silver', (SELECT count(*) FROM level_silver) + (SELECT count(*) FROM ratio_silver)
UNION ALL {_count('gold.wide', 'gold', 'gold')}""",
})


# ---------------------------------------------------------------- ingestion, sinks, quality
_BRONZE_FULL = ("SELECT 'rate' AS kind, serie, data, valor, _ingested_at, _source, "
                "CAST(year(data) AS INTEGER) AS ano FROM rate_bronze")
_SILVER_INFL_COLS = "serie, data, valor, variacao_pp, acumulado_12m, acumulado_ano, pressao, ano, mes, trimestre"
_GOLD_REQUIRED = ("selic_media_mes", "ipca_acumulado_mes", "dollar_medio_mes", "pib_valor_mes",
                  "inadimplencia_media_mes", "juros_real_estimado")
_ANY_REQUIRED_NULL = " OR ".join(f"{c} IS NULL" for c in _GOLD_REQUIRED)


def _unique(table: str, keys: str, rel: str) -> str:
    present = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"""SELECT '{table}' AS tabela, '{keys}' AS chave, count(*) AS duplicadas, count(*) = 0 AS aprovado
FROM (SELECT {keys} FROM {rel} WHERE {present} GROUP BY {keys} HAVING count(*) > 1)"""


def _status(kind: str, bronze: str, silver: str) -> str:
    return f"""SELECT '{kind}' AS kind, b.serie, b.bronze_linhas, b.bronze_nulos,
  COALESCE(s.silver_linhas, 0) AS silver_linhas,
  CASE WHEN COALESCE(s.silver_linhas, 0) > 0 THEN 'ok' ELSE 'no_data' END AS status
FROM (SELECT serie, count(*) AS bronze_linhas, count_if(valor IS NULL) AS bronze_nulos
      FROM {bronze} GROUP BY serie) b
LEFT JOIN (SELECT serie, count(*) AS silver_linhas FROM {silver} GROUP BY serie) s ON b.serie = s.serie"""


_EV_W30 = "(ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"

ORACLE.update({
    "ingest_json_payload": """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS data,
  CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_quantity END AS valor
FROM lineitem""",
    "ingest_parse_coerce": """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS data,
  CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_quantity END AS valor,
  l_orderkey % 97 <> 0 AS valido
FROM lineitem""",
    "ingest_lookback_window": """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - 365
                                   AND (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""",
    "bronze_append_audit": f"WITH {RATE_BRONZE} {_BRONZE_FULL}",
    "schema_conform": f"WITH {RATE_BRONZE} {_BRONZE_FULL}",
    "silver_partition_overwrite": f"""WITH {INFLATION_SILVER}
SELECT serie, data, CASE WHEN ano = 1996 THEN {R("valor * 2.0::DOUBLE", 4)} ELSE valor END AS valor,
  variacao_pp, acumulado_12m, acumulado_ano, pressao, ano, mes, trimestre
FROM infl_silver""",
    "silver_full_overwrite": f"WITH {LEVEL_SILVER}, {RATIO_SILVER} "
                             "SELECT * FROM level_silver UNION ALL SELECT * FROM ratio_silver",
    "gold_materialize": f"WITH {GOLD} SELECT * FROM gold",
    "control_log_summary": """SELECT event_type AS table_name, 'ingest' AS process_name, 'events' AS source,
  'bronze' AS layer, count(*) AS row_count, min(ts) AS started_at, max(ts) AS finished_at,
  (epoch_us(max(ts)) - epoch_us(min(ts)))::DOUBLE / 1000000.0::DOUBLE AS duration_seconds,
  'success' AS status, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS dia
FROM events GROUP BY event_type, CAST(ts AS DATE)""",
    "quality_not_null": f"""WITH {GOLD}, c AS (
  SELECT count(*) - count(serie) AS serie, count(*) - count(data) AS data, count(*) - count(valor) AS valor
  FROM rate_bronze),
g AS (
  SELECT count(*) - count(mes_ref) AS mes_ref, count(*) - count(selic_media_mes) AS selic_media_mes,
    count(*) - count(selic_anualizada_mes) AS selic_anualizada_mes FROM gold)
SELECT coluna, nulos, nulos = 0 AS aprovado
FROM (UNPIVOT c ON serie, data, valor INTO NAME coluna VALUE nulos)
UNION ALL SELECT coluna, nulos, nulos = 0
FROM (UNPIVOT g ON mes_ref, selic_media_mes, selic_anualizada_mes INTO NAME coluna VALUE nulos)""",
    "quality_unique": f"""WITH {GOLD}
{_unique('bronze.rate', 'serie,data', 'rate_bronze')}
UNION ALL {_unique('bronze.rate', 'serie,data,_ingested_at', 'rate_bronze')}
UNION ALL {_unique('gold.wide', 'mes_ref', 'gold')}
UNION ALL {_unique('silver.rate', 'serie,data', 'rate_silver')}
UNION ALL {_unique('silver.fx', 'serie,data', 'fx_silver')}
UNION ALL {_unique('silver.inflation', 'serie,data', 'infl_silver')}""",
    "quality_reconcile_counts": f"""WITH {RATE_BRONZE}, {INFLATION_SILVER}, c AS (
  SELECT count(*) AS everything, count_if(_ingested_at = {_TS1}) AS first,
    (SELECT count(*) FROM infl_silver) AS silver FROM rate_bronze)
SELECT 'bronze.rate' AS checagem, everything AS esperado, everything AS obtido, everything = everything AS aprovado
FROM c UNION ALL SELECT 'bronze.rate.first', everything, first, everything = first FROM c
UNION ALL SELECT 'silver.inflation', silver, silver, silver = silver FROM c""",
    "quality_reconcile_at_least": f"""WITH {RATE_SILVER}, c AS (
  SELECT (SELECT count(*) FROM rate_bronze) AS b, (SELECT count(*) FROM rate_silver) AS s)
SELECT 'bronze covers silver' AS checagem, s AS esperado, b AS obtido, b >= s AS aprovado FROM c
UNION ALL SELECT 'silver covers bronze', b, s, s >= b FROM c""",
    "quality_report": f"""WITH {GOLD}, c AS (
  SELECT count(*) AS linhas, count_if(mes_ref = DATE '1996-01-01') AS linhas_do_mes,
         count_if(mes_ref = DATE '1996-01-01' AND ({_ANY_REQUIRED_NULL})) AS nulos_obrigatorios
  FROM gold)
SELECT checagem, valor,
  CASE checagem WHEN 'linhas' THEN valor >= 2 WHEN 'linhas_do_mes' THEN valor = 1 ELSE valor = 0 END AS aprovado
FROM (UNPIVOT c ON linhas, linhas_do_mes, nulos_obrigatorios INTO NAME checagem VALUE valor)""",
    "pipeline_run_status": f"""WITH {RATE_SILVER}, {FX_SILVER}, {INFLATION_SILVER}
{_status('rate', 'rate_bronze', 'rate_silver')}
UNION ALL {_status('fx', 'fx_bronze', 'fx_silver')}
UNION ALL {_status('inflation', 'infl_bronze', 'infl_silver')}""",
    "chunked_window_single_series": f"""SELECT event_id, ts, value,
  {R("value - lag(value) OVER (ORDER BY ts, event_id)", 4)} AS variacao,
  {R("avg(value) OVER " + _EV_W30, 4)} AS media_movel_30d,
  {R("max(value) OVER " + _EV_W30, 4)} AS max_30d,
  {R("min(value) OVER " + _EV_W30, 4)} AS min_30d,
  {R("stddev_samp(value) OVER " + _EV_W30, 6)} AS volatilidade_30d
FROM events""",
})


# ---------------------------------------------------------------- landed files, ordered and keyed results
_SERIES_W12 = "(PARTITION BY serie ORDER BY ts, event_id ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
_DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, o_orderstatus = 'F' AS f FROM orders"

ORACLE.update({
    "ingest_landed_files": """WITH landed AS (
  SELECT *, strftime(o_orderdate, '%Y-%m') = '1996-03' AS cut_off FROM orders)
SELECT o_orderstatus AS serie, CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END AS data,
  CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS valor,
  CASE WHEN o_orderkey % 97 = 0 THEN '31/02/' || year(o_orderdate)
       ELSE strftime(o_orderdate, '%d/%m/%Y') END AS data_texto,
  CASE WHEN o_orderkey % 97 = 0 THEN 'data inválida' END AS motivo
FROM landed WHERE NOT cut_off
UNION ALL
SELECT DISTINCT o_orderstatus, NULL::DATE, NULL::DOUBLE, NULL, 'payload ilegível' FROM landed WHERE cut_off""",
    "ingest_fixed_winner": """SELECT l_suppkey AS serie, CAST(date_trunc('month', l_shipdate) AS DATE) AS data,
  l_quantity AS valor
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey, date_trunc('month', l_shipdate)
  ORDER BY l_returnflag DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1""",
    "pipeline_landed_run": f"""WITH days AS ({_DAYS}),
n AS (SELECT count(DISTINCT d) AS all_days, count(DISTINCT d) FILTER (f) AS f_days,
        count(DISTINCT d) FILTER (NOT f) AS o_days, count(DISTINCT date_trunc('month', d)) AS months,
        count(DISTINCT date_trunc('month', d)) FILTER (f) AS f_months FROM days)
SELECT * FROM (
  SELECT 'bronze.rate' AS table_name, 'selic' AS serie, 'bronze' AS layer, f_days AS row_count,
    'success' AS status, 0::BIGINT AS quarentena FROM n
  UNION ALL SELECT 'bronze.rate', 'outra', 'bronze', o_days, 'success', 0 FROM n
  UNION ALL SELECT 'bronze.rate', 'antiga', 'bronze', 0, 'no_data', 0 FROM n
  UNION ALL SELECT 'bronze.fx', 'dollar', 'bronze', all_days, 'success', 0 FROM n
  UNION ALL SELECT 'bronze.fx', 'ruim', 'bronze', 0, 'error', 1 FROM n
  UNION ALL SELECT 'bronze.inflation', 'ipca', 'bronze', months, 'success', 0 FROM n
  UNION ALL SELECT 'bronze.plain', 'pib', 'bronze', months, 'success', 0 FROM n
  UNION ALL SELECT 'bronze.plain', 'inadimplencia', 'bronze', months, 'success', 0 FROM n
  UNION ALL SELECT 'bronze.plain', 'vazia', 'bronze', 0, 'no_data', 0 FROM n
  UNION ALL SELECT 'silver.rate', NULL, 'silver', f_days + o_days, 'success', NULL FROM n
  UNION ALL SELECT 'silver.fx', NULL, 'silver', all_days, 'success', NULL FROM n
  UNION ALL SELECT 'silver.inflation', NULL, 'silver', months, 'success', NULL FROM n
  UNION ALL SELECT 'silver.plain', NULL, 'silver', 2 * months, 'success', NULL FROM n
  UNION ALL SELECT 'gold', NULL, 'gold', f_months, 'success', NULL FROM n)""",
    "chunked_window_by_series": f"""WITH ev AS (
  SELECT CASE WHEN event_id % 10 <> 0 THEN user_id END AS serie, event_id, ts, value FROM events)
SELECT serie, event_id, ts, value,
  {R("value - lag(value) OVER (PARTITION BY serie ORDER BY ts, event_id)", 4)} AS variacao,
  {R("sum(value) OVER " + _SERIES_W12, 4)} AS soma_12
FROM ev""",
    "silver_rate_sorted": f"""WITH {RATE_SILVER}
SELECT serie, data, valor, row_number() OVER (ORDER BY serie, data) - 1 AS ordem FROM rate_silver""",
    "gold_sorted": f"""WITH {GOLD}
SELECT mes_ref, selic_media_mes, row_number() OVER (ORDER BY mes_ref) - 1 AS ordem FROM gold""",
})


# ---------------------------------------------------------------- published tables, long series, layouts
_EV_RUN = "(ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_EV_YEAR = "(PARTITION BY year(ts) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_EV_LONG = "(ORDER BY ts, event_id ROWS BETWEEN 9999 PRECEDING AND CURRENT ROW)"
_LINES = "(PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"

ORACLE.update({
    "ingest_split_files": ORACLE["ingest_landed_files"],
    "silver_vanished_partitions": f"""WITH {INFLATION_SILVER}
SELECT {_SILVER_INFL_COLS} FROM infl_silver WHERE NOT (ano = 1996 AND mes = 7)""",
    "incremental_current_state": f"WITH {RATE_BRONZE} SELECT serie, data, valor, _ingested_at FROM rate_dedup",
    "bronze_table_by_name": f"WITH {RATE_BRONZE} {_BRONZE_FULL}",
    "silver_rate_range": f"""WITH {RATE_SILVER}
SELECT serie, data, valor, media_movel_30d FROM rate_silver WHERE serie BETWEEN 3 AND 5""",
    "running_single_series": f"""SELECT event_id, ts, value, {R("sum(value) OVER " + _EV_RUN, 4)} AS soma,
  {R("avg(value) OVER " + _EV_RUN, 4)} AS media, count(value) OVER {_EV_RUN} AS n,
  min(value) OVER {_EV_RUN} AS menor, max(value) OVER {_EV_RUN} AS maior
FROM events""",
    "running_year_to_date": f"""SELECT event_id, ts, value, CAST(year(ts) AS INTEGER) AS ano,
  {R("sum(value) OVER " + _EV_YEAR, 4)} AS acumulado_ano, {R("avg(value) OVER " + _EV_YEAR, 4)} AS media_ano
FROM events""",
    "moving_extremes_long": f"""SELECT event_id, ts, value, max(value) OVER {_EV_LONG} AS maximo,
  min(value) OVER {_EV_LONG} AS minimo FROM events""",
    "product_rounding": f"""SELECT l_orderkey, l_linenumber, l_quantity,
  round(avg(l_quantity) OVER {_LINES.format(n=3)}, 1) AS media,
  round(l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity), 4) AS variacao,
  round(sum(l_quantity) OVER {_LINES.format(n=11)}, 4) AS soma, round(l_quantity / 4.0::DOUBLE, -1) AS dezena
FROM lineitem""",
})
