"""Observation payloads: JSON arrays of ``{"data": "dd/MM/yyyy", "valor": "text"}``.

The reference fetches these over HTTP; here they are landed files (or a
text column) read by Spark. Parsing is column expressions only:
``from_json`` + ``posexplode_outer`` for the array, ``to_date`` / ``try_to_date``
for the date, a pattern and ``try_cast`` for the number (anything else, such
as ``N/D`` or ``NaN``, becomes NULL).

No input disappears: a payload that is not readable becomes one row with a
reason in ``motivo``, and so does every item without a valid date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indicata.functions.calendar import ntz_literal
from indicata.schemas import PAYLOAD, PAYLOAD_ITEM
from indicata.session import scratch_path

# Fixed values (must equal the reference for right results).
DATE_PATTERN = "dd/MM/yyyy"
PLACE_DIGITS = 10
# What counts as a number: a plain decimal, with an exponent at most.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?\s*$"

# Landed files of more bytes are read in ranges.
SPLIT_ABOVE = 32 << 20
# A flat JSON object up to its closing brace: what from_json reads in an array
# it reads alone (RFC 8259; only texts, numbers and literals as values).
_S = r"[ \t\r\n]*+"
_TEXT = r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
_VALUE = rf"(?:{_TEXT}|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)"
_MEMBER = rf"{_TEXT}{_S}:{_S}{_VALUE}{_S}"
_BODY = rf"\{{{_S}(?:{_MEMBER}(?:,{_S}{_MEMBER})*+)?"

# Reasons for quarantine.
UNREADABLE = "payload ilegível"
BAD_DATE = "data inválida"
# No reason for quarantine, but the series did land something.
EMPTY = "lote vazio"


def parse_date(c: Column | str, strict: bool = True) -> Column:
    """``dd/MM/yyyy`` text to DATE; strict raises on a bad date, permissive gives NULL."""
    x = F.col(c) if isinstance(c, str) else c
    return F.to_date(x, DATE_PATTERN) if strict else F.try_to_date(x, DATE_PATTERN)


def parse_number(c: Column | str) -> Column:
    """Text to DOUBLE; anything but a finite plain decimal becomes NULL."""
    x = F.col(c) if isinstance(c, str) else c
    number = x.try_cast("double")
    # The cast also takes names and suffixes (NaN, 1.5d); texts without letters
    # and blanks that it takes are plain decimals, only others need the pattern.
    plain = ~x.rlike("[^0-9.+-]") | x.rlike(NUMBER_PATTERN)
    return F.when((F.abs(number) < F.lit(float("inf"))) & plain, number)


def explode_payload(df: DataFrame, text_col: str = "payload", keep_empty: bool = False) -> DataFrame:
    """One row per array item of a JSON payload column: ``posicao``,
    ``data_texto``, ``valor_texto``; a payload that is NULL or not JSON is
    one row with ``motivo`` instead of none. ``keep_empty``: so is ``[]``."""
    keep = [c for c in df.columns if c != text_col]
    why = F.when(F.col("items").isNull(), F.lit(UNREADABLE)).when(F.size("items") == 0, F.lit(EMPTY))
    rows = df.select(*keep, F.from_json(F.col(text_col), PAYLOAD).alias("items")).select(
        *keep, why.alias("motivo"), F.posexplode_outer("items").alias("posicao", "item"))
    if not keep_empty:
        rows = rows.filter(~F.col("motivo").eqNullSafe(EMPTY))
    return rows.select(*keep, F.coalesce("posicao", F.lit(0)).alias("posicao"),
                       F.col("item.data").alias("data_texto"), F.col("item.valor").alias("valor_texto"),
                       "motivo")


def parse_observations(df: DataFrame, strict: bool = True, date_col: str = "data_texto",
                       value_col: str = "valor_texto") -> DataFrame:
    """Text columns -> ``data DATE``, ``valor DOUBLE``; other columns kept.

    Strict: an unreadable payload or a bad date raises. Permissive: the row
    keeps its texts and gets its reason in ``motivo`` (see ``split_quarantine``).
    """
    reason = F.col("motivo") if "motivo" in df.columns else F.lit(None).cast("string")
    keep = [c for c in df.columns if c not in (date_col, value_col, "motivo")]
    data = parse_date(date_col, strict)
    if strict:
        df = df.filter(~reason.eqNullSafe(EMPTY))
        raised = F.raise_error(reason).cast("date")
        return df.select(*keep, F.when(reason.isNotNull(), raised).otherwise(data).alias("data"),
                         parse_number(value_col).alias("valor"))
    return df.select(*keep, data.alias("data"), parse_number(value_col).alias("valor"),
                     date_col, value_col,
                     F.coalesce(reason, F.when(data.isNull(), F.lit(BAD_DATE))).alias("motivo"))


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Permissive mode: rows without a reason go on, the others to quarantine."""
    ok = F.col("motivo").isNull()
    return (parsed.filter(ok).drop("motivo", "data_texto", "valor_texto"),
            parsed.filter(~ok & (F.col("motivo") != EMPTY)))


def read_landed(spark: SparkSession, path: str, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Read landed payload files (each a JSON array) under ``path``.

    The series name is the parent folder of each file
    (``<path>/<serie>/<batch>.json``, or ``serie=<serie>``). A file is one text value, so one that
    holds no JSON is one unreadable payload and one with ``[]`` a row with
    the reason ``EMPTY``, so that its series is seen. ``_seq`` (batch file, place in
    its array) orders the rows of a run in the same way for any file sizes
    and task layout. Files over ``split_above`` bytes are read in byte ranges
    by many tasks (``read_split``), with the same rows.
    """
    size = F.col("_metadata.file_size")
    items = landed_items(_whole(spark, path, size <= split_above))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    if listed.select("path", "length").filter(F.col("length") > split_above).isEmpty():
        return items
    return items.unionByName(read_split(spark, path, size > split_above))


def _whole(spark: SparkSession, path: str, which: Column) -> DataFrame:
    """Files as one text each; ``which`` picks files by ``_metadata``, which
    Spark applies to the listing."""
    return (spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).filter(which)
                 .select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("_file")))


def read_split(spark: SparkSession, path: str, which: Column) -> DataFrame:
    """Items of landed arrays, each file read in byte ranges by several tasks.

    Spark's text reader cuts a file into ranges and these at every ``}``, which
    ends an item when items are flat objects. Each piece must have the exact
    form of an item at its place (``[{...``, then ``,{...``, at last ``]``), so
    a file whose pieces all pass is the array that they make up. The place of
    an item is that in its range plus what the ranges before it hold. A file
    with any other piece (a brace inside a text, a nested value, a broken end)
    goes through the whole-file reader, which decides what it is.
    """
    tagged = (spark.read.option("recursiveFileLookup", True).option("lineSep", "}").text(path).filter(which)
                   .select(F.col("value").alias("piece"), F.col("_metadata.file_path").alias("_file"),
                           F.col("_metadata.file_block_start").alias("_start"),
                           F.monotonically_increasing_id().alias("_mid")))
    p = F.col("piece")
    tagged = tagged.withColumn("form", F.when(p.rlike(rf"^{_S},{_S}{_BODY}\z"), "next")
                               .when(p.rlike(rf"^{_S}\[{_S}{_BODY}\z"), "first")
                               .when(p.rlike(rf"^{_S}\]{_S}\z"), "end").otherwise("odd"))
    staged = scratch_path(spark, "landed-pieces")
    tagged.write.parquet(staged)  # the tags are fixed from here on
    pieces = spark.read.schema(tagged.schema).parquet(staged)

    def at(form: str) -> Column:
        return F.when(F.col("form") == form, F.col("_mid"))

    ranges = pieces.groupBy("_file", "_start").agg(
        F.count("*").alias("n"), F.min("_mid").alias("low"), F.count_if(F.col("form") == "odd").alias("odd"),
        F.count(at("first")).alias("firsts"), F.min(at("first")).alias("first"),
        F.count(at("end")).alias("ends"), F.max(at("end")).alias("end"))
    of_file = Window.partitionBy("_file")  # a row for each range of a file
    earlier = of_file.orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    place = F.col("before") - F.col("low")
    plain = (F.sum("odd").over(of_file) == 0) & (F.sum("firsts").over(of_file) == 1) \
        & (F.sum("ends").over(of_file) == 1) & (F.min(place + F.col("first")).over(of_file) == 0) \
        & (F.max(place + F.col("end")).over(of_file) == F.sum("n").over(of_file) - 1)
    ranges = ranges.select(F.col("_file").alias("_f"), F.col("_start").alias("_s"), place.alias("shift"),
                           F.coalesce(plain, F.lit(False)).alias("plain"))
    odd = [r._f for r in ranges.filter("NOT plain").select("_f").distinct().collect()]  # large files, so few
    item = F.from_json(F.concat(F.regexp_replace(p, rf"^{_S}[\[,]", ""), F.lit("}")), PAYLOAD_ITEM)
    rows = pieces.filter("form IN ('first', 'next')") \
        .join(ranges.filter("plain"), (F.col("_file") == F.col("_f")) & (F.col("_start") == F.col("_s"))) \
        .withColumn("item", item)
    place = (F.col("_mid") + F.col("shift")).cast("int")
    split = _named(rows).select(
        "serie", "arquivo", F.col("item.data").alias("data_texto"), F.col("item.valor").alias("valor_texto"),
        F.lit(None).cast("string").alias("motivo"), _seq(place).alias("_seq"))
    if not odd:
        return split
    return split.unionByName(landed_items(_whole(spark, path, F.col("_metadata.file_path").isin(*odd))))


def _named(files: DataFrame) -> DataFrame:
    """Series and file name from the path in ``_file``."""
    parts = F.split(F.col("_file"), "/")
    return files.withColumns({"serie": F.regexp_replace(F.element_at(parts, -2), "^serie=", ""),
                              "arquivo": F.element_at(parts, -1)})


def _seq(place: Column) -> Column:
    return F.concat_ws("#", "arquivo", F.lpad(place.cast("string"), PLACE_DIGITS, "0"))


def landed_items(files: DataFrame) -> DataFrame:
    """Items of landed files ``(payload, _file)`` with ``serie``, ``arquivo``, ``_seq``."""
    items = explode_payload(_named(files).select("payload", "serie", "arquivo"), keep_empty=True)
    return items.withColumn("_seq", _seq(F.col("posicao"))).drop("posicao")


def first_of_file(seq_col: str) -> Column:
    """Whether a row of ``landed_items`` is the first of its file."""
    return F.col(seq_col).endswith("#" + "0" * PLACE_DIGITS)


def lookback(df: DataFrame, date_col: str, days: int, end: dt.date | None = None,
             year_col: str | None = "ano") -> DataFrame:
    """Rows whose day is within ``days`` before ``end`` (inclusive).

    ``end`` is the run date; when omitted it is the newest day in ``df``,
    fetched once as a single scalar. The bounds are then literals compared
    with the raw column, so Parquet row-group statistics (and partition
    pruning on date-partitioned tables) skip data outside the window; a
    scalar-subquery bound would only filter after reading.
    """
    c = F.col(date_col)
    if end is None:
        end = df.select(F.max(F.to_date(c)).alias("end")).first()["end"]
    if end is None:  # empty input
        return df.limit(0)
    start = dt.datetime.combine(end - dt.timedelta(days=days), dt.time())
    stop = dt.datetime.combine(end + dt.timedelta(days=1), dt.time())
    col_type = dict(df.dtypes)[date_col]
    if col_type == "date":
        cond = (c >= F.lit(start.date())) & (c < F.lit(stop.date()))
    else:
        lo, hi = ntz_literal(start), ntz_literal(stop)
        if col_type != "timestamp_ntz":
            lo, hi = lo.cast(col_type), hi.cast(col_type)
        cond = (c >= lo) & (c < hi)
    if year_col and year_col in df.columns:
        # tables partitioned by year: the implied bounds prune directories
        cond = cond & F.col(year_col).between(start.year, end.year)
    return df.filter(cond)
