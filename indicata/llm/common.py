"""Helpers shared by the corpus operators.

``materialize`` cuts lineage with a written table in the shared folder,
``attach`` is a left join that survives a key holding a third of all rows,
``components`` finds connected components by alternating star contractions,
``repeated`` tells each chunk of packed keys which of them occur elsewhere,
and the numpy functions turn Arrow text buffers into word and shingle hashes.
"""

from __future__ import annotations

import hashlib
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from indicata.session import scratch_path

#: A key counts as heavy when it holds more than this part of all rows; so
#: there are at most this many heavy keys, whatever the size of the input.
HEAVY_PARTS = 1000

#: Most bytes in a batch of rows on its way to a Python worker, where the session
#: names none. Spark's own limits, 10,000 rows and 64 MB, are held several times
#: over for each task: by Arrow, by the buffer of its socket and by the worker.
BATCH = "4m"

#: Whitespace of the corpus contracts, as a regular expression class body.
WS = " \\t-\\r"


def ship(module: str) -> None:
    """Send a module's functions to Python workers by value.

    Executors then need no copy of this package on their path.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- lineage ----------------------------------------------------------------

def small_batches(spark: SparkSession) -> None:
    """From here on a batch of rows for a Python worker ends at ``BATCH``,
    unless the session has a limit of its own. It stays, as plans that the
    operators return run later."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, BATCH)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages then depend on files that every executor can reach, not on
    shuffle blocks that go with a lost executor.
    """
    path = scratch_path(df.sparkSession, name)
    small_batches(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables written by ``materialize`` that nothing reads any more."""
    for df in tables:
        spark, path = df.sparkSession, df._scratch_path
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize_bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``df`` in buckets of ``key``: several joins by ``key`` then shuffle
    its rows once, not once each."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    at = re.sub(r"\W", "_", name) + "_" + path[-12:]
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 10_000)  # Spark allows 100,000 buckets
    small_batches(spark)
    df.repartition(n, key).write.bucketBy(n, key).option("compression", "zstd").option("path", path).saveAsTable(at)
    out = spark.table(at)
    out._scratch_path, out._scratch_table = path, at
    return out


def drop_bucketed(df: DataFrame) -> None:
    """Delete a table of ``materialize_bucketed`` that nothing reads any more."""
    df.sparkSession.sql(f"DROP TABLE {df._scratch_table}")
    discard(df)


# -- joins and aggregates that survive hot keys -------------------------------

def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str,
           spread: Column) -> DataFrame:
    """Left join ``rows`` to ``groups`` (one row per key, ``size`` = its rows).

    Keys with more than a thousandth of all rows, of which there can be at
    most a thousand, are broadcast; their rows are then dealt by ``spread``
    in the shuffled join that serves all other keys. ``groups`` must be
    materialized. Columns of ``groups`` other than keys are null where no
    group fits. Null keys find no group and are dealt by ``spread`` as well.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    floor = total / HEAVY_PARTS
    extra = [c for c in groups.columns if c not in keys]
    heavy = groups.filter(F.col(size) > floor).select(
        *[F.col(k).alias(f"_h_{k}") for k in keys],
        *[F.col(c).alias(f"_h_{c}") for c in extra])
    light = groups.filter(F.col(size) <= floor).select(
        *[F.col(k).alias(f"_l_{k}") for k in keys],
        *[F.col(c).alias(f"_l_{c}") for c in extra],
        (F.col(size) % 1).cast("long").alias("_l_spread"))
    on_heavy = None
    for k in keys:
        on = F.col(k) == F.col(f"_h_{k}")
        on_heavy = on if on_heavy is None else on_heavy & on
    apart = F.col(f"_h_{size}").isNotNull()
    for k in keys:
        apart = apart | F.col(k).isNull()
    out = rows.join(F.broadcast(heavy), on_heavy, "left").withColumn(
        "_spread", F.when(apart, F.xxhash64(spread)).otherwise(F.lit(0).cast("long")))
    on_light = F.col("_spread") == F.col("_l_spread")
    for k in keys:
        on_light = on_light & (F.col(k) == F.col(f"_l_{k}"))
    return out.join(light, on_light, "left").select(
        *rows.columns,
        *[F.coalesce(f"_h_{c}", f"_l_{c}").alias(c) for c in extra])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a, b)``: rows (node, component).

    Alternating large-star and small-star contraction: every round rewires
    each node to the smallest node it knows, so stars form in a logarithmic
    number of rounds even on long chains. Before that, ranges of nodes are
    contracted block by block, which shortens chains of neighbours. Nodes whose
    only edge leads to a smaller node are set aside before every round and take
    that node's component in the end, so the joins of a round see the edges that
    are not settled yet, not all of them every time. Edges never leave the
    executors; hubs are joined with ``attach``. Nodes without an edge do not
    appear.
    """
    e = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct().repartitionByRange("u", "v").mapInArrow(contract, "u long, v long"), "edges")
    aside = []
    while True:
        leaves, rest = _leaves(e)
        discard(e)
        aside.append(leaves)
        if rest.isEmpty():
            break
        both = rest.select("u", "v").union(rest.select(F.col("v"), F.col("u")))
        low = materialize(both.groupBy("u").agg(
            F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")), "large")
        large = materialize(
            attach(both, low, ["u"], "n", F.col("v")).filter("v > u and v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        low2 = materialize(large.groupBy("u").agg(
            F.min("v").alias("m"), F.count("*").alias("n")), "small")
        e = materialize(
            attach(large, low2, ["u"], "n", F.col("v")).filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low2.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(rest, low, large, low2)
    # the last ones hang on roots; of the others, where that node went later
    named = aside.pop()
    while aside:
        leaves = aside.pop()
        groups = materialize(
            named.select(F.col("u").alias("v"), F.col("v").alias("root"))
            .join(leaves.groupBy("v").agg(F.count("*").alias("n")), "v"), "roots")
        named = named.union(materialize(
            attach(leaves, groups, ["v"], "n", F.col("u"))
            .select("u", F.coalesce("root", "v").alias("v")), "named"))
        discard(leaves, groups)
    return named.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        named.select(F.col("v"), F.col("v")).distinct())


def _leaves(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes u of ``e`` whose only edge leads to a smaller node v, as rows
    (u, v), and the other edges; both materialized."""
    leaves = materialize(
        e.select("u", "v").union(e.select(F.col("v"), F.col("u"))).groupBy("u")
        .agg(F.min("v").alias("v"), F.max("v").alias("hi")).filter("v = hi and v < u").select("u", "v"), "leaves")
    rest = e.select("u", "v", F.lit(0).alias("leaf")).union(leaves.select("u", "v", F.lit(1))) \
        .groupBy("u", "v").agg(F.max("leaf").alias("leaf")).filter("leaf = 0")
    return leaves, materialize(rest.select("u", "v"), "edges")


def contract(batches):
    """Edges of a batch as stars around the smallest node of each component."""
    for b in batches:
        up: dict[int, int] = {}

        def root(x: int, up=up) -> int:
            top = x
            while up.get(top, top) != top:
                top = up[top]
            while up.get(x, x) != top:
                up[x], x = top, up[x]
            return top

        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            u, v = root(u), root(v)
            up[max(u, v)] = up.setdefault(min(u, v), min(u, v))
        stars = [(x, root(x)) for x in up if root(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in stars], pa.int64()),
                                          pa.array([r for _, r in stars], pa.int64())], ["u", "v"])


# -- which keys occur more than once -----------------------------------------

def repeated(chunks: DataFrame, per_bucket: int = 2_000_000) -> DataFrame:
    """Keys that occur at least twice, told to the chunks that hold them.

    ``chunks``: (chunk string, n_keys long, keys binary of uint64). Returns
    (chunk, hits array<binary>): of each chunk its own keys that occur at
    least twice in all chunks together. Each chunk sends a key once (with a
    mark when it holds it twice), packed in binary rows by key range, so a
    key in every document costs one entry per chunk, never one per document.
    """
    total = chunks.agg(F.sum("n_keys")).first()[0] or 0
    n = max(1, -(-int(total) // per_bucket))

    def send(batches):
        for b in batches:
            for chunk, blob in zip(b["chunk"].to_pylist(), b["keys"].to_pylist(), strict=True):
                keys, count = np.unique(np.frombuffer(blob, np.uint64), return_counts=True)
                at = (keys >> np.uint64(40)) * np.uint64(n) >> np.uint64(24)
                cut = np.searchsorted(at, np.arange(n + 1, dtype=np.uint64))
                some = [i for i in range(n) if cut[i] < cut[i + 1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(some, pa.int32()), pa.array([chunk] * len(some), pa.string()),
                    pa.array([keys[cut[i]:cut[i + 1]].tobytes() for i in some], pa.binary()),
                    pa.array([np.packbits(count[cut[i]:cut[i + 1]] > 1).tobytes() for i in some],
                             pa.binary())], ["bucket", "chunk", "keys", "twice"])

    def settle(batches):
        by: dict[int, list] = {}
        for b in batches:
            for bucket, *rest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                by.setdefault(bucket, []).append(rest)
        for parts in by.values():
            keys = [np.frombuffer(k, np.uint64) for _, k, _ in parts]
            every = np.sort(np.concatenate(keys))
            more = every[1:][every[1:] == every[:-1]]
            out = []
            for k, (chunk, _, twice) in zip(keys, parts, strict=True):
                flag = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(k)).astype(bool)
                if len(more):
                    i = np.minimum(np.searchsorted(more, k), len(more) - 1)
                    flag |= more[i] == k
                if flag.any():
                    out.append((chunk, k[flag].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _ in out], pa.string()),
                     pa.array([k for _, k in out], pa.binary())], ["chunk", "hits"])

    sent = chunks.select("chunk", "keys").mapInArrow(
        send, "bucket int, chunk string, keys binary, twice binary")
    return sent.repartition(n, "bucket").mapInArrow(settle, "chunk string, hits binary") \
        .groupBy("chunk").agg(F.collect_list("hits").alias("hits"))


# -- words and shingles in numpy ----------------------------------------------

#: Bytes that separate words (space and 9 to 13), and A-Z folding.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
FOLD = np.arange(256, dtype=np.uint64)
FOLD[65:91] += np.uint64(32)
K1, K2, K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * K2
    h = h ^ (h >> np.uint64(33))
    h = h * K3
    return h ^ (h >> np.uint64(33))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = column.cast(pa.binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], (off - off[0]).astype(np.int64)


def word_hashes(raw: np.ndarray, off: np.ndarray):
    """Hashes of the folded words of all texts, and each text's first word.

    Words longer than 32 bytes are hashed whole with BLAKE2.
    """
    gap = SPACE[raw]
    before = np.empty(len(raw), bool)
    before[1:] = gap[:-1]
    after = np.empty(len(raw), bool)
    after[:-1] = gap[1:]
    edges = off[:-1][off[:-1] < off[1:]]
    before[edges] = True
    after[off[1:][off[:-1] < off[1:]] - 1] = True
    start = np.flatnonzero(~gap & before)
    end = np.flatnonzero(~gap & after) + 1
    size = end - start
    h = size.astype(np.uint64) * K1
    live = np.flatnonzero(size <= 32)
    for j in range(32):
        live = live[size[live] > j]
        if not len(live):
            break
        h[live] = (h[live] ^ FOLD[raw[start[live] + j]]) * K2
    for i in np.flatnonzero(size > 32):
        word = FOLD[raw[start[i]:end[i]]].astype(np.uint8).tobytes()
        h[i] = np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64)[0]
    return mix(h), np.searchsorted(start, off)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words (of all, where there are fewer)."""
    if not len(words):
        return words[:0]
    k = min(k, len(words))
    n = len(words) - k + 1
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h = (h + words[j:j + n]) * K1
        h ^= h >> np.uint64(29)
    return mix(h)


def few(batches, most: int = 512):
    """The rows of ``batches`` in small ones, for work on rows as Python objects,
    which take many times their size in Arrow."""
    for b in batches:
        for a in range(0, b.num_rows, most):
            yield b.slice(a, most)


def slices(off: np.ndarray, most: int):
    """Ranges of texts of at most ``most`` bytes together (or a single text)."""
    a = 0
    while a < len(off) - 1:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, b
        a = b


ship(__name__)
