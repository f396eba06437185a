"""Quality classifier by importance resampling of hashed n-grams.

Two generative models over hashed one- and two-word features: one of the raw
corpus (all rows), one of the target text (labelled rows of good quality that
are not toxic). The log of their ratio is a feature's importance. A
document's log weight is the worse of two readings, each scaled so that -1 is
where the held-out target documents end: its mean importance (text of another
make), and its words that the target clearly lacks (a few bad words in long
good text). The ``k`` largest of log weight plus Gumbel noise stay, k being the
number of documents whose weight is above that point.

Of the labelled rows at most LABELLED, those of the smallest hashed ids, are
used: two thirds fit the target model, one third sets the scale. Everything
else (raw model, weights, ranks) covers all rows.

Defined results: null and empty texts have no features and a log weight of 0
(the empty text gives no sign against it); labels with nulls are ignored, ids
with conflicting labels count as not target; without labels all documents
stay; repeated rows get the same weight and noise; rows whose key ties with
the last that stays, stay; an empty table gives an empty result; other columns
pass through ``resample`` untouched, those that clash with its own are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from indicata.llm.common import K1, materialize, mix, ship, slices, text_buffers, word_hashes

#: Hash buckets of features; most labelled rows used; part of the held-out
#: target documents beyond the scale of each reading.
BUCKETS, LABELLED, BEYOND = 1 << 19, 50_000, 0.005
#: Weight of the log weight against the Gumbel noise; buckets of the ranking.
SHARP, BINS = 20.0, 4096
#: Counts below what the raw model expects by so many deviations are a lack.
LACK = 2.5
#: Text that a worker takes at a time.
BYTES = 2 << 20


def features(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of single words and of pairs."""
    one = words % np.uint64(buckets)
    two = mix(words[:-1] * K1 + words[1:]) % np.uint64(buckets)
    return one.astype(np.int64), two.astype(np.int64)


def labelled(labels: DataFrame, id_col: str, most: int) -> DataFrame:
    """(id, target, held): at most ``most`` labelled ids, a third held out."""
    h = F.xxhash64("_l_id", F.lit("labelled"))
    rows = labels.filter(f"{id_col} is not null and quality is not null and toxic is not null") \
        .groupBy(F.col(id_col).alias("_l_id")) \
        .agg(((F.min("quality") == 1) & (F.max("toxic") == 0)).alias("_target")) \
        .orderBy(h, "_l_id").limit(most)
    return materialize(rows.withColumn("_held", F.pmod(h, F.lit(3)) == 0), "labelled")


def counts(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature counts of (all, fitted) rows, shaped (2, buckets): words, pairs.

    Tasks send their counts in segments that are summed as they stream in;
    the driver gets arrays of the fixed size ``buckets``.
    """
    part = 4096

    def count(batches):
        total = np.zeros((2, 2, buckets), np.int32)
        for b in batches:
            fit = np.array(b.column("_fit").to_pylist(), bool)
            raw, off = text_buffers(b.column("text"))
            for lo, hi in slices(off, BYTES):
                words, at = word_hashes(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                if not len(words):
                    continue
                one, two = features(words, buckets)
                doc = np.repeat(np.arange(hi - lo), np.diff(at))
                inside = doc[:-1] == doc[1:]
                for j, (f, of) in enumerate(((one, doc), (two[inside], doc[:-1][inside]))):
                    total[0, j] += np.bincount(f, minlength=buckets).astype(np.int32)
                    total[1, j] += np.bincount(f[fit[lo:hi][of]], minlength=buckets).astype(np.int32)
        for s in range(0, buckets, part):
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([total[:, :, s:s + part].tobytes()], pa.binary())],
                ["segment", "n"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[s] = sums.get(s, 0) + np.frombuffer(n, np.int32).astype(np.int64)
        for s, n in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([n.tobytes()], pa.binary())], ["segment", "n"])

    segments = -(-buckets // part)
    summed = rows.mapInArrow(count, "segment int, n binary").repartition(segments, "segment") \
        .mapInArrow(add, "segment int, n binary")
    out = np.zeros((2, 2, buckets))
    for s, n in summed.collect():
        out[:, :, s:s + part] = np.frombuffer(n, np.int64).reshape(2, 2, -1)
    return out[0], out[1]


def ratios(raw: np.ndarray, fit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log importance of words and pairs; of words also the clear lacks only."""
    scale = fit.sum() / max(raw.sum(), 1)
    expected = raw * scale
    mean = np.log((fit + 1) / (expected + 1))
    lack = np.log((fit[0] + 0.5) / (expected[0] + 0.5))
    short = (fit[0] - expected[0]) / np.sqrt(expected[0] + 1)
    return mean.astype(np.float32), np.where(short < -LACK, np.minimum(lack, 0), 0).astype(np.float32)


def _readings(batches, text: str, mean: np.ndarray, lack: np.ndarray, buckets: int):
    """The batches with the two readings of each row's text as columns."""
    for b in batches:
        raw, off = text_buffers(b.column(text))
        make, bad = np.zeros(len(off) - 1), np.zeros(len(off) - 1)
        for lo, hi in slices(off, BYTES):
            words, at = word_hashes(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            for i in range(hi - lo):
                w = words[at[i]:at[i + 1]]
                if len(w):
                    one, two = features(w, buckets)
                    make[lo + i] = (mean[0][one].sum() + mean[1][two].sum()) / (len(one) + len(two))
                    own = np.unique(one)
                    bad[lo + i] = lack[own].sum() / math.sqrt(len(own) + 20)
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(make), pa.array(bad)], [*b.schema.names, "_make", "_bad"])


def _top(keys: DataFrame, k: int) -> float | None:
    """The k-th largest key, found by counts in ever finer bins."""
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    if low is None or k <= 0:
        return None
    above = 0
    for _ in range(4):
        width = (high - low) / BINS
        if width <= 0 or low + width == low:
            break
        bins = keys.filter((F.col("key") >= low) & (F.col("key") <= high)).groupBy(F.least(
            F.floor((F.col("key") - low) / width), F.lit(BINS - 1)).cast("int").alias("bin")).count()
        for b, n in sorted(bins.collect(), reverse=True):
            if above + n >= k:
                low, high = low + b * width, low + (b + 1) * width
                break
            above += n
    return low


def weigh(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
          buckets: int = BUCKETS, most: int = LABELLED, beyond: float = BEYOND):
    """Fit both models and rank all rows.

    Returns (score, scores): a function that adds log_weight, key and kept to
    any frame with the two columns, and (id, log_weight, key, kept) of all rows.
    """
    known = labelled(labels, id_col, most)
    fit = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("text")) \
        .join(F.broadcast(known), F.col("_id") == F.col("_l_id"), "left") \
        .select("text", (F.coalesce("_target", F.lit(False)) & ~F.coalesce("_held", F.lit(True))).alias("_fit"))
    mean, lack = ratios(*counts(fit, buckets))

    def read(frame: DataFrame) -> DataFrame:
        schema = StructType([*frame.schema.fields, StructField("_make", DoubleType()),
                             StructField("_bad", DoubleType())])
        return frame.mapInArrow(lambda it: _readings(it, text, mean, lack, buckets), schema)

    slim = docs.select(F.col(id_col), F.col(text))
    scores = materialize(read(slim).select(
        id_col, F.xxhash64(id_col, text).alias("_h"), "_make", "_bad"), "weights")
    # at most a third of LABELLED rows
    held = scores.join(F.broadcast(known.filter("_target and _held")), F.col(id_col) == F.col("_l_id")) \
        .select("_make", "_bad").collect()
    ends = [min(float(np.quantile([r[j] for r in held], beyond)), -1e-6) if held else -math.inf
            for j in range(2)]

    def keyed(frame: DataFrame, h: Column) -> DataFrame:
        worse = F.lit(0.0)
        for name, end in zip(("_make", "_bad"), ends, strict=True):
            if math.isfinite(end):
                worse = F.least(worse, -F.col(name) / F.lit(end))
        u = (F.pmod(F.xxhash64(h, F.lit("gumbel")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        return frame.withColumn("log_weight", worse) \
            .withColumn("key", SHARP * F.col("log_weight") - F.log(-F.log(u)))

    ranked = keyed(scores, F.col("_h"))
    k = ranked.filter("log_weight > -1").count()
    last = _top(ranked.select("key"), k)
    kept = F.lit(False) if last is None else F.col("key") >= F.lit(last)

    def score(frame: DataFrame) -> DataFrame:
        own = frame.drop("_make", "_bad", "log_weight", "key", "kept")
        return keyed(read(own), F.xxhash64(id_col, text)).withColumn("kept", kept).drop("_make", "_bad")

    return score, ranked.withColumn("kept", kept).select(id_col, "log_weight", "key", "kept")


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
             **how) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    score, _ = weigh(docs, labels, id_col, text, **how)
    apart = {c: f"_own_{c}" for c in docs.columns if c.lower() in ("_make", "_bad", "log_weight", "key", "kept")}
    return score(docs.withColumnsRenamed(apart)).filter("kept").select(
        *[F.col(apart.get(c, c)).alias(c) for c in docs.columns])


ship(__name__)
