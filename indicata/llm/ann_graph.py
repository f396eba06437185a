"""Approximate nearest neighbours with robust-pruned directed graphs.

Distinct vectors are dealt over shards of about SHARD vectors. In each shard
a directed graph is built: greedy searches from the entry points propose
neighbours for a point, and relaxed distance pruning (an edge goes when an
edge kept already is ALPHA times nearer to its end) keeps diverse ones. Every
query then runs a beam search in every shard, block of queries by block of
queries, and its best results are merged. Scores are exact inner products in
double precision; only which candidates are found is approximate. Every
valid vector is indexed, none is sampled.

For inner products of vectors of any length, a shard adds one coordinate that
gives all of its vectors the same length; there the nearest point is the one
of the largest inner product. A shard holds vectors of one layer of lengths
(a factor of two) and scales them by its power of two, so a few very long
vectors, or very large or small components, take no precision from others.

Defined results: vectors that are null, zero, empty, or hold null or
non-finite components, and rows without an id, take no part; vectors meet
only vectors of their own dimension; repeated rows (same id, same vector)
count once, as query and as candidate; copies of a vector under many ids are
one graph node that carries its smallest ids, as many as any result can
hold; ties go to the smaller id; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from indicata.llm.common import materialize, ship

SHARD, BLOCK = 4096, 2048
#: Out-degree, pool of a search, expansions at a time, relaxation of pruning.
DEGREE, POOL, WIDTH, ALPHA = 32, 64, 4, 1.2
#: Ids a node needs to carry for a result of k besides the query's own.
SALT = 8


def lifted(x: np.ndarray) -> np.ndarray:
    """The vectors with a last coordinate that makes them equally long."""
    square = np.einsum("ij,ij->i", x, x)
    return np.column_stack([x, np.sqrt(np.maximum(square.max(initial=0.0) - square, 0.0))]).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    """Each row by the power of two that brings its largest component to about 1."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def beam(x: np.ndarray, edges: np.ndarray, entry: np.ndarray, q: np.ndarray, pool: int,
         width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Greedy beam search of all queries at once: (ids, squared distances),
    nearest first, -1 where fewer were found."""
    m, rows = len(q), np.arange(len(q))[:, None]
    seen = np.zeros((m, len(x) + 1), bool)
    seen[:, -1] = True
    seen[:, entry] = True
    ids = np.full((m, pool + width * edges.shape[1]), -1)
    dist = np.full(ids.shape, np.inf, np.float32)
    used = np.ones(ids.shape, bool)
    square = np.einsum("ij,ij->i", x, x)
    k = min(len(entry), pool)
    ids[:, :k] = entry[:k]
    dist[:, :k] = square[entry[:k]] - 2 * (q @ x[entry[:k]].T)
    used[:, :k] = False
    while True:
        order = np.argsort(dist, axis=1, kind="stable")[:, :pool]
        ids[:, :pool], dist[:, :pool], used[:, :pool] = (a[rows, order] for a in (ids, dist, used))
        ids[:, pool:], dist[:, pool:], used[:, pool:] = -1, np.inf, True
        open_ = ~used[:, :pool]
        turn = open_ & (np.cumsum(open_, axis=1) <= width)
        row, col = np.nonzero(turn)
        if not len(row):
            break
        used[row, col] = True
        fresh = edges[ids[row, col]]
        who = np.repeat(row, fresh.shape[1])
        fresh = fresh.ravel()
        new = ~seen[who, fresh]
        who, fresh = who[new], fresh[new]
        flat = np.unique(who * (len(x) + 1) + fresh)
        who, fresh = np.divmod(flat, len(x) + 1)
        seen[who, fresh] = True
        place = pool + np.arange(len(who)) - np.searchsorted(who, who)
        ids[who, place] = fresh
        dist[who, place] = square[fresh] - 2 * np.einsum("ij,ij->i", x[fresh], q[who])
        used[who, place] = False
    return ids[:, :pool], dist[:, :pool] + np.einsum("ij,ij->i", q, q)[:, None]


def prune(x: np.ndarray, own: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse neighbours of the points ``own`` among ``cand`` (-1: none)."""
    out = np.full((len(own), degree), -1)
    for a in range(0, len(own), 256):
        me, c = own[a:a + 256], cand[a:a + 256]
        rows = np.arange(len(me))
        points = x[c]
        d = ((points - x[me][:, None]) ** 2).sum(axis=2)
        d[(c < 0) | (c == me[:, None])] = np.inf
        order = np.argsort(d, axis=1, kind="stable")
        c, d, points = c[rows[:, None], order], d[rows[:, None], order], points[rows[:, None], order]
        square = np.einsum("ijk,ijk->ij", points, points)
        between = square[:, :, None] + square[:, None] - 2 * points @ points.transpose(0, 2, 1)
        alive = np.isfinite(d)
        alive[:, 1:] &= c[:, 1:] != c[:, :-1]
        for r in range(degree):
            j = alive.argmax(axis=1)
            some = alive[rows, j]
            if not some.any():
                break
            out[a:a + 256, r] = np.where(some, c[rows, j], -1)
            alive &= alpha * alpha * between[rows, j] > d
            alive[rows, j] = False
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, pool: int = POOL,
          alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Graph over the (lifted) vectors: edges, entry points.

    Points come in, in a fixed random order, in batches as large as what is
    there; a second pass searches for every point again.
    """
    n = len(vectors)
    order = np.random.default_rng(7).permutation(n)
    centre = vectors.mean(axis=0)
    middle = int(((vectors - centre) ** 2).sum(axis=1).argmin())
    # a shard no larger than a pool is searched whole
    entry = np.arange(n) if n <= pool else np.unique(np.append(order[:7], middle))
    edges = np.full((n + 1, degree), n)
    first = min(n, 256)
    a, b = 0, first
    batches = []
    while a < n:
        batches.append(order[a:b])
        a, b = b, min(n, b + min(b, 1024))
    # pad points to the row of "no edge"
    for turn in range(2):
        for i, batch in enumerate(batches):
            if turn == 0 and i == 0:
                cand = np.tile(batch, (len(batch), 1))
            else:
                cand = np.concatenate([
                    np.vstack([beam(vectors, edges, entry, vectors[part], pool)[0]
                               for part in np.array_split(batch, -(-len(batch) // 512))]),
                    np.where(edges[batch] < n, edges[batch], -1)], axis=1)
            kept = prune(vectors, batch, cand, degree, alpha)
            edges[batch] = np.where(kept < 0, n, kept)
            link_back(vectors, edges, batch, kept, degree, alpha)
    return edges, entry


def link_back(x, edges, batch, kept, degree, alpha) -> None:
    """Add the reverse of new edges; points with too many are pruned again."""
    n = len(x)
    to, of = kept.ravel(), np.repeat(batch, kept.shape[1])
    to, of = to[kept.ravel() >= 0], of[kept.ravel() >= 0]
    d = ((x[to] - x[of]) ** 2).sum(axis=1)
    order = np.lexsort((d, to))
    to, of = to[order], of[order]
    place = np.arange(len(to)) - np.searchsorted(to, to)
    near = place < 2 * degree
    points = np.unique(to)
    cand = np.full((len(points), 3 * degree), -1)
    cand[np.searchsorted(points, to[near]), place[near]] = of[near]
    cand[:, 2 * degree:] = np.where(edges[points] < n, edges[points], -1)
    back = prune(x, points, cand, degree, alpha)
    edges[points] = np.where(back < 0, n, back)


def inner(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed in order."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * v[:, j]
    return out


def valid(vectors: DataFrame, id_col: str, vec: str) -> DataFrame:
    """Distinct (id, v, dim, layer) of the rows that take part; v as doubles.

    ``layer``: the whole number nearest to the binary logarithm of the length,
    so that vectors of length one, give or take rounding, share one.
    """
    v = F.transform(vec, lambda c: c.cast("double"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    part = F.aggregate("v", F.lit(0.0), lambda s, c: s + F.pow(c / F.col("top"), F.lit(2.0)))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")) \
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull()) \
        .filter(~bad & F.exists("v", lambda c: c != 0)) \
        .withColumn("dim", F.size("v")).distinct() \
        .withColumn("top", F.array_max(F.transform("v", lambda c: F.abs(c)))) \
        .withColumn("layer", F.round(F.log2("top") + F.log2(part) / 2).cast("int")).drop("top")


def index(rows: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """Graphs of all shards: (dim, layer, shard, blobs); ``rows`` as from ``valid``."""
    salted = Window.partitionBy("v", "salt").orderBy("id")
    whole = Window.partitionBy("v").orderBy("id")
    nodes = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT))) \
        .withColumn("r", F.row_number().over(salted)).filter(F.col("r") <= k + 1).drop("r") \
        .withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= k + 1) \
        .groupBy("dim", "layer", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    nodes = materialize(nodes, "ann-nodes")
    sizes = materialize(nodes.groupBy("dim", "layer").agg(
        F.ceil(F.count("*") / shard).cast("int").alias("shards")), "ann-shards")
    every = int(sizes.agg(F.sum("shards")).first()[0] or 1)
    # a number of partitions of its own keeps graphs from being built in one task
    dealt = nodes.join(sizes, ["dim", "layer"]).withColumn(
        "shard", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")).drop("shards") \
        .repartition(every, "dim", "layer", "shard")

    def graph(part: pd.DataFrame) -> pd.DataFrame:
        part = part.iloc[part["ids"].map(lambda i: i[0]).argsort(kind="stable")]
        v = np.array(part["v"].tolist(), np.float64)
        layer = int(part["layer"].iloc[0])
        edges, entry = build(lifted(np.ldexp(v, -layer)))
        ids = part["ids"].tolist()
        return pd.DataFrame({
            "dim": [part["dim"].iloc[0]], "layer": [layer], "shard": [part["shard"].iloc[0]],
            "vectors": [v.tobytes()],
            "edges": [edges.astype(np.int32).tobytes()], "entry": [entry.astype(np.int32).tobytes()],
            "ids": [np.concatenate(ids).astype(np.int64).tobytes()],
            "counts": [np.array([len(i) for i in ids], np.int32).tobytes()]})

    return materialize(dealt.groupBy("dim", "layer", "shard").applyInPandas(
        graph, "dim int, layer int, shard int, vectors binary, edges binary, entry binary, ids binary, "
               "counts binary"), "ann-graphs")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id",
            vec: str = "embedding", shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose id ``every`` divides."""
    rows = materialize(valid(vectors, id_col, vec), "ann-rows")
    graphs = index(rows, k, shard)
    asked = rows.filter(F.pmod(F.col("id"), F.lit(every)) == 0)
    blocks = -(-asked.count() // block) or 1
    queries = asked.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")) \
        .groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v")).alias("queries"))
    # a block of queries meets a shard: as many rows as blocks times shards
    met = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) \
        .join(queries, ["dim", "block"])

    def search(batches):
        for b in batches:
            for r in b.to_pylist():
                dim = r["dim"]
                v = np.frombuffer(r["vectors"], np.float64).reshape(-1, dim)
                edges = np.frombuffer(r["edges"], np.int32).reshape(len(v) + 1, -1)
                counts = np.frombuffer(r["counts"], np.int32)
                ids, begin = np.frombuffer(r["ids"], np.int64), np.concatenate([[0], np.cumsum(counts)])
                x, entry = lifted(np.ldexp(v, -r["layer"])), np.frombuffer(r["entry"], np.int32)
                for a in range(0, len(r["queries"]), 512):
                    part = r["queries"][a:a + 512]
                    own = np.array([p["id"] for p in part])
                    q = np.array([p["v"] for p in part], np.float64)
                    point = np.column_stack([unit(q), np.zeros(len(q))]).astype(np.float32)
                    found, _ = beam(x, edges, entry, point, max(POOL, 2 * k))
                    who, col = np.nonzero(found >= 0)
                    node = found[who, col]
                    score = inner(q[who], v[node])
                    who, score = np.repeat(who, counts[node]), np.repeat(score, counts[node])
                    at = np.concatenate([[0], np.cumsum(counts[node])])
                    vec_id = ids[np.arange(at[-1]) - np.repeat(at[:-1] - begin[node], counts[node])]
                    other = vec_id != own[who]
                    who, score, vec_id = who[other], score[other], vec_id[other]
                    order = np.lexsort((vec_id, -score, who))
                    who, score, vec_id = who[order], score[order], vec_id[order]
                    top = np.arange(len(who)) - np.searchsorted(who, who) < k
                    who = who[top]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[who], pa.int64()),
                         pa.array([q[w].tobytes() for w in who], pa.binary()),
                         pa.array(vec_id[top], pa.int64()), pa.array(score[top], pa.float64())],
                        ["query_id", "v", "vec_id", "score"])

    hits = met.repartition("dim", "layer", "shard", "block").mapInArrow(
        search, "query_id long, v binary, vec_id long, score double")
    best = Window.partitionBy("query_id", "v").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


ship(__name__)
