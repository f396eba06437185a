"""Explicit schemas for every layer (no inference anywhere).

Each table carries ``serie`` as its leading key so one table holds many
series of a kind. Column names follow the reference's tables so that
existing queries keep working.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw API payload: a JSON array of {data: "dd/MM/yyyy", valor: "text"}.
PAYLOAD_ITEM = T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("valor", T.StringType()),
])
PAYLOAD = T.ArrayType(PAYLOAD_ITEM)

# Parsed observation batch.
OBSERVATION = T.StructType([
    T.StructField("serie", T.StringType()),
    T.StructField("data", T.DateType()),
    T.StructField("valor", T.DoubleType()),
])

# Bronze: append-only, audit columns, partitioned by (kind, ano).
BRONZE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("serie", T.StringType()),
    T.StructField("data", T.DateType()),
    T.StructField("valor", T.DoubleType()),
    T.StructField("_ingested_at", T.TimestampNTZType()),
    T.StructField("_source", T.StringType()),
    T.StructField("ano", T.IntegerType()),
])

_SILVER_BASE = [
    T.StructField("serie", T.StringType()),
    T.StructField("data", T.DateType()),
    T.StructField("valor", T.DoubleType()),
]
_CAL = [
    T.StructField("ano", T.IntegerType()),
    T.StructField("mes", T.IntegerType()),
    T.StructField("trimestre", T.IntegerType()),
]

# Bronze as written by the pipeline: plus ``_seq``, the batch file and the row's
# place in it, so duplicates of one date inside one run have a fixed winner.
BRONZE_SEQ = T.StructType(BRONZE.fields + [T.StructField("_seq", T.StringType())])

# Rows that could not become observations, with their texts and the reason.
QUARANTINE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("serie", T.StringType()),
    T.StructField("arquivo", T.StringType()),
    T.StructField("data_texto", T.StringType()),
    T.StructField("valor_texto", T.StringType()),
    T.StructField("motivo", T.StringType()),
    T.StructField("_ingested_at", T.TimestampNTZType()),
    T.StructField("_seq", T.StringType()),
])

SILVER_RATE = T.StructType(_SILVER_BASE + [
    T.StructField("variacao_pp", T.DoubleType()),
    T.StructField("taxa_anualizada", T.DoubleType()),
    T.StructField("media_movel_30d", T.DoubleType()),
    T.StructField("volatilidade_30d", T.DoubleType()),
    T.StructField("acumulado_ano", T.DoubleType()),
    T.StructField("nivel_taxa", T.StringType()),
] + _CAL + [T.StructField("dia_semana", T.IntegerType())])

SILVER_FX = T.StructType(_SILVER_BASE + [
    T.StructField("variacao_abs", T.DoubleType()),
    T.StructField("variacao_pct", T.DoubleType()),
    T.StructField("media_movel_30d", T.DoubleType()),
    T.StructField("max_30d", T.DoubleType()),
    T.StructField("min_30d", T.DoubleType()),
    T.StructField("tendencia", T.StringType()),
] + _CAL)

SILVER_INFLATION = T.StructType(_SILVER_BASE + [
    T.StructField("variacao_pp", T.DoubleType()),
    T.StructField("acumulado_12m", T.DoubleType()),
    T.StructField("acumulado_ano", T.DoubleType()),
    T.StructField("pressao", T.StringType()),
] + _CAL)

SILVER_PLAIN = T.StructType(_SILVER_BASE)

GOLD_COLUMNS = (
    "mes_ref", "selic_media_mes", "selic_max_mes", "selic_min_mes", "selic_anualizada_mes",
    "ipca_acumulado_mes", "ipca_12m", "dollar_medio_mes", "dollar_max_mes",
    "pib_valor_mes", "inadimplencia_media_mes", "juros_real_estimado",
)

# Run record of one (table, process) execution.
CONTROL_RECORD = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("process_name", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("finished_at", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


def with_key_type(schema: T.StructType, key_type: T.DataType) -> T.StructType:
    """Same schema with ``serie`` retyped (testdata series keys are BIGINT)."""
    return T.StructType([
        T.StructField(f.name, key_type if f.name == "serie" else f.dataType, f.nullable)
        for f in schema.fields
    ])
