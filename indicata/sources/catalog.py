"""Series catalog: which series exist, their source code, kind and role.

The catalog is a handful of rows (one per configured series), so joining
it is a broadcast join with a bound that does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (must equal the reference for right results):
# series name, source series code, kind (silver builder), role in the wide table.
SERIES = (
    ("selic", 11, "rate", "rate"),
    ("ipca", 433, "inflation", "inflation"),
    ("dollar", 1, "fx", "fx"),
    ("pib", 4380, "plain", "level"),
    ("inadimplencia", 21082, "plain", "ratio"),
)
SCHEMA = "serie string, code int, kind string, role string"


def series_catalog(spark: SparkSession, extra: tuple = ()) -> DataFrame:
    """The catalog as a DataFrame; ``extra`` rows add series of the same shape."""
    return spark.createDataFrame(list(SERIES) + list(extra), SCHEMA)


def series_for_role(role: str, extra: tuple = ()) -> list[str]:
    """Series names that play ``role`` (e.g. the level series of the wide table)."""
    return [name for name, _, _, r in (*SERIES, *extra) if r == role]


def with_catalog(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Attach code / kind / role to rows keyed by ``serie`` (unknown series get NULLs)."""
    return df.join(F.broadcast(catalog), "serie", "left")
