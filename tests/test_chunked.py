"""Chunked windows equal the global window (row frames, halo rows)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from indicata.operators import windows as W
from indicata.operators.chunked import chunked_window, global_row_number
from tests.conftest import SF_SMALL


def compute(w):
    v = F.col("value")
    return {"chg": W.change(v, w), "avg": W.moving_avg(v, w, 30), "sd": W.moving_stddev(v, w, 30),
            "mx": W.moving_max(v, w, 30)}


def test_chunked_equals_global_single_series(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "value")
    got = chunked_window(ev, ("ts", "event_id"), compute, halo=29, chunk_rows=64, partitions=5)
    ref = ev.withColumns(compute(Window.orderBy("ts", "event_id")))
    assert got.count() == ev.count()
    assert got.exceptAll(ref.select(*got.columns)).count() == 0
    assert ref.select(*got.columns).exceptAll(got).count() == 0


def test_chunked_equals_global_per_series(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("user_id", "event_id", "ts", "value")
    got = chunked_window(ev, ("ts", "event_id"), compute, halo=29, chunk_rows=40, keys=("user_id",),
                         partitions=4)
    ref = ev.withColumns(compute(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    assert got.exceptAll(ref.select(*got.columns)).count() == 0
    assert got.count() == ev.count()


def test_row_numbers_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    rn = global_row_number(df, ("k",), partitions=7)
    assert rn.filter(F.col("_rn") != F.col("k")).count() == 0


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 120), chunk=st.integers(4, 40), halo_frac=st.floats(0.0, 0.9),
       parts=st.integers(1, 6), series=st.integers(1, 3))
def test_chunked_property(spark, n, chunk, halo_frac, parts, series):
    # contract: halo >= the deepest look-back of the window functions (lag needs 1)
    halo = max(1, min(chunk - 1, int(chunk * halo_frac)))
    rows = [(i % series, i, float((i * 37) % 11)) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, t int, value double")

    def comp(w):
        v = F.col("value")
        return {"chg": W.change(v, w), "avg": W.moving_avg(v, w, halo + 1), "mn": W.moving_min(v, w, halo + 1)}

    got = chunked_window(df, ("t",), comp, halo=halo, chunk_rows=chunk, keys=("k",), partitions=parts)
    ref = df.withColumns(comp(Window.partitionBy("k").orderBy("t")))
    assert got.count() == n
    assert got.exceptAll(ref.select(*got.columns)).count() == 0


def test_null_keys_are_a_series_of_their_own(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("a", 1, 5.0)], "k string, t int, value double")
    got = chunked_window(df, ("t",), lambda w: {"chg": W.change("value", w)}, halo=1, chunk_rows=4, keys=("k",))
    assert sorted((r.k or "", r.t, r.chg) for r in got.collect() if r.chg is not None) == [("", 2, 1.0)]
    assert got.count() == 3


# ---------------------------------------------------------------- unbounded and long frames
from indicata.operators.chunked import long_extremes, running

RUN = {"s": ("sum", "value"), "a": ("avg", "value"), "n": ("count", "value"), "lo": ("min", "value"), "hi": ("max", "value")}


def running_by_window(df, keys):
    w = Window.partitionBy(*keys).orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.col("value")
    return df.withColumns({"s": F.sum(v).over(w), "a": F.avg(v).over(w), "n": F.count(v).over(w),
                           "lo": F.min(v).over(w), "hi": F.max(v).over(w)})


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 150), chunk=st.integers(2, 40), parts=st.integers(1, 6), series=st.integers(1, 3))
def test_running_property(spark, n, chunk, parts, series):
    # quarters: sums are exact in any order; NULLs also at the start of a series
    rows = [(None if i % 7 == 5 else i % series, i, None if i % 5 < 2 else ((i * 37) % 11 - 5) / 4) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, t int, value double")
    got = running(df, ("t",), RUN, keys=("k",), chunk_rows=chunk, partitions=parts)
    ref = running_by_window(df, ("k",)).select(*got.columns)
    assert got.count() == n and got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_partials_are_scanned_by_chunks_when_there_are_many(spark):
    df = spark.range(300).select(F.col("id").alias("t"), ((F.col("id") * 31) % 17).cast("double").alias("value"))
    got = running(df, ("t",), RUN, chunk_rows=6, partitions=3)  # 50 partials, scanned by 6
    ref = running_by_window(df, ()).select(*got.columns)
    assert got.exceptAll(ref).count() == 0 and got.count() == 300


def test_running_has_no_window_over_the_series(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "value")
    got = running(ev, ("ts", "event_id"), RUN, chunk_rows=512)
    plan = got._jdf.queryExecution().executedPlan()
    plan.execute().count()
    text = plan.toString().split("== Initial Plan ==")[0]
    windows = [line for line in text.split("\n") if "Window [" in line and "value" in line]
    assert windows and all("_chunk" in w for w in windows)


def test_unknown_running_function(spark):
    import pytest
    with pytest.raises(ValueError, match="median"):
        running(spark.range(1), ("id",), {"m": ("median", "id")})


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 200), frame=st.integers(1, 30), chunk=st.integers(1, 60), series=st.integers(1, 3))
def test_long_extremes_property(spark, n, frame, chunk, series):
    rows = [(i % series, i, None if i % 6 == 1 else float((i * 53) % 29)) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, t int, value double")
    got = long_extremes(df, ("t",), "value", frame, keys=("k",), chunk_rows=chunk, partitions=3)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(-(frame - 1), 0)
    ref = df.withColumns({"max": F.max("value").over(w), "min": F.min("value").over(w)}).select(*got.columns)
    assert got.count() == n and got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_long_extremes_of_nan(spark):
    rows = [(i, float("nan") if i in (3, 50) else float(i % 13)) for i in range(90)]
    df = spark.createDataFrame(rows, "t int, value double")
    got = long_extremes(df, ("t",), "value", 10, chunk_rows=20, partitions=2)
    w = Window.orderBy("t").rowsBetween(-9, 0)
    ref = df.withColumns({"max": F.max("value").over(w), "min": F.min("value").over(w)}).select(*got.columns)
    assert got.exceptAll(ref).count() == 0
