"""Suffix-array dedup of repeated byte strings by two-stage sorting.

Bytes covered by a string of LENGTH bytes that also starts anywhere else are
removed. Every string is dealt to the bucket of the smallest hash among its
GRAM-byte grams; equal strings have equal grams, so they meet in one bucket.
Neighbouring strings mostly share their bucket, so what is dealt are
stretches of text, each with the starts of its strings; only stretches whose
bucket occurs again anywhere move on, and equal stretches are one with a
count. In a bucket the suffixes at these starts are sorted in two stages: those smaller
than their successors directly, the rest induced by scanning the buckets of
first bytes in order. Adjacent common prefixes then tell which strings occur
twice or more.

A bucket with more than a thousandth of all stretches is not gathered: each
of its strings is asked for by a hash of its whole bytes, packed by hash range
(see ``repeated``), so neither copies nor unlike strings around a common gram
meet in one task.

Defined results: null and empty texts have no bytes; texts shorter than a
string lose nothing; repeated rows are texts of their own, so their strings
occur again; an empty table gives an empty result; columns other than id and
text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from indicata.llm.common import (HEAVY_PARTS, K2, attach, discard, materialize, repeated, ship, slices,
                                 text_buffers)

LENGTH, GRAM = 200, 40
#: Starts in a stretch; strings of crowded buckets that a worker asks for at a time.
RUN, ASKED = 1024, 200_000
#: Text that a worker hashes at a time, and sorts at a time.
BYTES, BLOCK = 2 << 20, 4 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        ones = np.full(max(n, BYTES + (1 << 16)), BASE, np.uint64)
        ones[0] = 1
        _POWERS["up"] = np.multiply.accumulate(ones)
        ones[1:] = BACK
        _POWERS["down"] = np.multiply.accumulate(ones)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from every position."""
    n = len(raw) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.multiply(raw, up, out=total[1:])
    np.cumsum(total, out=total)
    h = total[gram:] - total[:n]
    h *= down[:n]
    h ^= h >> np.uint64(32)
    h *= K2
    h ^= h >> np.uint64(29)
    return h


def window_min(h: np.ndarray, w: int) -> np.ndarray:
    """Smallest of every ``w`` neighbours."""
    n = len(h) - w + 1
    if n <= 0:
        return h[:0]
    size = -(-len(h) // w) * w
    pad = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    pad[:len(h)] = h
    rows = pad.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1:w - 1 + n])


def stretches(raw: np.ndarray, off: np.ndarray, length: int, gram: int):
    """(key, text, first start in it, starts) of runs of one bucket, and the
    keys of runs in which the gram itself comes again."""
    h = gram_hashes(raw, gram)
    least = window_min(h, length - gram + 1)
    n = np.maximum(np.diff(off) - length + 1, 0)
    if not len(least):
        none = np.zeros(0, np.int64)
        return least, none, none, none, least
    change = np.empty(len(least), bool)
    change[0] = True
    np.not_equal(least[1:], least[:-1], out=change[1:])
    some = n > 0
    change[off[:-1][some]] = True
    past = (off[:-1] + n)[some]  # from here to the next text strings would cross the border
    change[past[past < len(least)]] = True
    new = np.flatnonzero(change)
    count = np.diff(np.append(new, len(least)))
    doc = np.searchsorted(off, new, "right") - 1
    inside = new - off[doc] < n[doc]
    new, count, doc = new[inside], count[inside], doc[inside]
    # the gram leaves the window, yet the smallest stays: it is there again
    gone = np.flatnonzero(h[:len(least) - 1] == least[:-1])
    again = np.unique(least[gone[~change[gone + 1]]])
    parts = -(-count // RUN)
    first = np.repeat(new, parts) + RUN * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    count = np.minimum(np.repeat(new + count, parts) - first, RUN)
    doc = np.repeat(doc, parts)
    return least[first], doc, first - off[doc], count, again


def chunked(docs: DataFrame, id_col: str, text: str, length: int, gram: int) -> DataFrame:
    """Packed rows of a few megabytes of text each: its documents (id, text
    hash) and their stretches."""
    def run(batches):
        part, n_chunk = TaskContext.get().partitionId(), 0
        for b in batches:
            raw, off = text_buffers(b.column(2))
            for lo, hi in slices(off, BYTES):
                key, doc, at, count, again = stretches(
                    raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], length, gram)
                blob = lambda x, t: pa.array([np.asarray(x).astype(t).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{part}-{n_chunk}"]),
                    *[pa.array([b.column(i).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64()))
                      for i in (0, 1)],
                    blob(key, np.uint64), blob(doc, np.int32), blob(at, np.int32), blob(count, np.int16),
                    blob(again, np.uint64), pa.array([len(key)], pa.int64())],
                    ["chunk", "ids", "hashes", "keys", "doc", "at", "count", "again", "n_keys"])
                n_chunk += 1

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"),
                       F.col(text).alias("text"))
    return slim.mapInArrow(run, "chunk string, ids array<long>, hashes array<long>, keys binary, "
                                "doc binary, at binary, count binary, again binary, n_keys long")


def found(chunks: DataFrame) -> DataFrame:
    """(id, th, keys, at, count): of each document the stretches whose bucket
    occurs again."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                hits = np.sort(np.concatenate([np.frombuffer(h, np.uint64) for h in r["hits"]]))
                keys = np.frombuffer(r["keys"], np.uint64)
                ok = np.flatnonzero(hits[np.minimum(np.searchsorted(hits, keys), len(hits) - 1)] == keys)
                doc = np.frombuffer(r["doc"], np.int32)[ok]
                edge = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]]))
                packed = [[np.frombuffer(r[c], t)[ok[a:z]].tobytes()
                           for a, z in zip(edge[:-1], edge[1:], strict=True)]
                          for c, t in (("keys", np.uint64), ("at", np.int32), ("count", np.int16))]
                which = doc[edge[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c][i] for i in which], pa.int64()) for c in ("ids", "hashes")]
                    + [pa.array(p, pa.binary()) for p in packed], ["id", "th", "keys", "at", "count"])

    sent = chunks.select("chunk", "n_keys", F.concat("keys", "again").alias("keys"))
    return chunks.drop("again", "n_keys").join(repeated(sent), "chunk") \
        .mapInArrow(run, "id long, th long, keys binary, at binary, count binary") \
        .dropDuplicates(["id", "th"])


def contexts(texts: DataFrame, length: int, crowded: np.ndarray) -> DataFrame:
    """(id, th, h, at, bytes) of the stretches of ``texts`` outside crowded
    buckets."""
    def run(batches):
        for b in batches:
            rows: list[list] = [[], [], [], [], []]
            size = 0
            for rid, th, text, keys, at, count in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = text.encode()
                key = np.frombuffer(keys, np.uint64)
                ok = ~np.isin(key, crowded)
                spots = list(zip(key[ok].view(np.int64).tolist(), np.frombuffer(at, np.int32)[ok].tolist(),
                                 np.frombuffer(count, np.int16)[ok].tolist(), strict=True))
                rows[0] += [rid] * len(spots)
                rows[1] += [th] * len(spots)
                rows[2] += [k for k, _, _ in spots]
                rows[3] += [a for _, a, _ in spots]
                rows[4] += [data[a:a + n + length - 1] for _, a, n in spots]
                size += sum(n + length for _, _, n in spots)
                if size > BLOCK:
                    yield _stretch_rows(rows)
                    rows, size = [[], [], [], [], []], 0
            yield _stretch_rows(rows)

    return texts.select("id", "th", "text", "keys", "at", "count") \
        .mapInArrow(run, "id long, th long, h long, at int, bytes binary") \
        .withColumn("c", F.xxhash64("bytes"))


def _stretch_rows(rows: list[list]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=True)],
                                      ["id", "th", "h", "at", "bytes"])


def crowded_covers(texts: DataFrame, length: int, crowded: np.ndarray) -> DataFrame:
    """(id, th, at, cover): covered ranges by the strings of crowded buckets
    whose 64-bit hash occurs again."""
    def ask(batches):
        part, n_chunk, held, size = TaskContext.get().partitionId(), 0, [], 0

        def packed():
            blob = lambda x: pa.array([np.concatenate(x).tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays([
                pa.array([f"{part}-{n_chunk}"]),
                *[pa.array([[h[i] for h in held]], pa.list_(pa.int64())) for i in (0, 1)],
                blob([np.full(len(h[2]), i, np.int32) for i, h in enumerate(held)]),
                blob([h[2].astype(np.int32) for h in held]), blob([h[3] for h in held]),
                pa.array([size], pa.int64())], ["chunk", "ids", "hashes", "doc", "at", "keys", "n_keys"])

        for b in batches:
            for rid, th, text, keys, at, count in zip(*(c.to_pylist() for c in b.columns), strict=True):
                some = np.flatnonzero(np.isin(np.frombuffer(keys, np.uint64), crowded))
                if not len(some):
                    continue
                data = text.encode()
                at, count = (np.frombuffer(x, t)[some].tolist() for x, t in ((at, np.int32), (count, np.int16)))
                starts = np.concatenate([np.arange(a, a + n) for a, n in zip(at, count, strict=True)])
                for i in range(0, len(starts), ASKED):
                    now = starts[i:i + ASKED]
                    names = b"".join(hashlib.blake2b(data[a:a + length], digest_size=8).digest()
                                     for a in now.tolist())
                    held.append((rid, th, now, np.frombuffer(names, np.uint64)))
                    size += len(now)
                    if size >= ASKED:
                        yield packed()
                        n_chunk, held, size = n_chunk + 1, [], 0
        if held:
            yield packed()

    def cover(batches):
        for b in batches:
            for r in b.to_pylist():
                hits = np.sort(np.concatenate([np.frombuffer(h, np.uint64) for h in r["hits"]]))
                keys = np.frombuffer(r["keys"], np.uint64)
                ok = hits[np.minimum(np.searchsorted(hits, keys), len(hits) - 1)] == keys
                doc, at = (np.frombuffer(r[c], np.int32)[ok] for c in ("doc", "at"))
                edge = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]]))
                which = doc[edge[:-1]].tolist()
                yield pa.RecordBatch.from_arrays([
                    *[pa.array([r[c][i] for i in which], pa.int64()) for c in ("ids", "hashes")],
                    pa.array([0] * len(which), pa.int32()),
                    pa.array([runs(np.sort(at[a:z]), length).astype(np.int32).tobytes()
                              for a, z in zip(edge[:-1], edge[1:], strict=True)], pa.binary())],
                    ["id", "th", "at", "cover"])

    asked = materialize(texts.select("id", "th", "text", "keys", "at", "count").mapInArrow(
        ask, "chunk string, ids array<long>, hashes array<long>, doc binary, at binary, keys binary, "
             "n_keys long"), "suffix-asked")
    return asked.drop("n_keys").join(repeated(asked.select("chunk", "n_keys", "keys")), "chunk") \
        .mapInArrow(cover, "id long, th long, at int, cover binary").distinct()


def sort_suffixes(data: bytes, end: np.ndarray, group: np.ndarray, wanted: np.ndarray,
                  depth: int) -> np.ndarray:
    """The ``wanted`` positions by group, in the order of their suffixes, to
    ``depth``.

    ``end``, ``group``: of every position the end of its own stretch and its
    bucket. Stage one sorts the wanted suffixes that are smaller than their
    successors; stage two scans the buckets of first bytes in order and
    appends, for every suffix it passes, the one that starts a byte earlier
    if that is a larger one. Both keep the order inside every group, which is
    all that is asked for, so the direct sort runs group by group.
    """
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(raw[1:].astype(np.int16) - raw[:-1])
    step[end - 1] = 1
    # a run of one byte goes the way that its end goes
    place = np.arange(n)
    turn = np.minimum.accumulate(np.where(step != 0, place, n)[::-1])[::-1]
    small = step[np.minimum(turn, n - 1)] > 0
    # the larger ones need their successors up to the next smaller one
    stop = np.minimum.accumulate(np.where(small, place, n)[::-1])[::-1]
    need = np.cumsum(np.bincount(wanted, minlength=n + 1)
                     - np.bincount(stop[wanted] + 1, minlength=n + 1)[:n + 1])[:n] > 0
    direct = np.flatnonzero(need & small)
    keys = [data[i:min(i + depth, e)] for i, e in zip(direct.tolist(), end[direct].tolist(), strict=True)]
    of = group[direct]
    edge = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])).tolist() if len(of) else [0]
    get, order = keys.__getitem__, []
    for a, z in zip(edge[:-1], edge[1:], strict=True):
        order += sorted(range(a, z), key=get)
    direct = direct[np.array(order, np.int64)]
    del keys, get, order
    direct = direct[np.argsort(raw[direct], kind="stable")]
    heads = np.searchsorted(raw[direct], np.arange(257))
    larger = need & ~small
    queue: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        parts, wave = [], np.concatenate(queue[c]) if queue[c] else np.zeros(0, np.int64)
        while len(wave):
            parts.append(wave)
            before = wave[wave > 0] - 1
            wave = before[larger[before] & (raw[before] == c)]
        parts.append(direct[heads[c]:heads[c + 1]])
        queue[c] = []
        bucket = np.concatenate(parts)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[larger[before] & (raw[before] > c)]
        first = raw[before]
        if not len(first):
            continue
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        edge = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        for a, z in zip(edge, [*edge[1:], len(first)], strict=True):
            queue[first[a]].append(before[a:z])
    every = np.concatenate(out) if out else np.zeros(0, np.int64)
    real = np.zeros(n, bool)
    real[wanted] = True
    every = every[real[every]]
    return every[np.argsort(group[every], kind="stable")]


def repeats(parts: list[bytes], counts: np.ndarray, length: int,
            buckets: np.ndarray | None = None) -> list[np.ndarray]:
    """Of each stretch the starts of strings that occur at least twice.

    ``buckets``: numbers, not falling, of stretches whose strings can be equal.
    """
    data = b"".join(parts)
    size = np.array([len(p) for p in parts])
    edge = np.concatenate([[0], np.cumsum(size)])
    starts = size - length + 1
    which = np.repeat(np.arange(len(parts)), starts)
    wanted = np.arange(len(which)) - np.repeat(np.cumsum(starts) - starts, starts) + edge[which]
    buckets = np.zeros(len(parts), np.int32) if buckets is None else buckets.astype(np.int32)
    order = sort_suffixes(data, np.repeat(edge[1:], size), np.repeat(buckets, size), wanted, length)
    same = np.zeros(len(order), bool)
    before = b""
    for j, i in enumerate(order.tolist()):
        now = data[i:i + length]
        same[j] = now == before
        before = now
    group = np.cumsum(~same) - 1
    of = np.searchsorted(edge, order, "right") - 1
    twice = np.bincount(group, weights=counts[of])[group] >= 2
    order = np.sort(order[twice])
    of = np.searchsorted(edge, order, "right") - 1
    cut = np.searchsorted(of, np.arange(len(parts) + 1))
    return [order[cut[i]:cut[i + 1]] - edge[i] for i in range(len(parts))]


def runs(starts: np.ndarray, length: int) -> np.ndarray:
    """Covered ranges (begin, end) of strings at sorted ``starts``."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    new = np.concatenate([[True], np.diff(starts) > length])
    begin = starts[new]
    stop = np.append(starts[np.flatnonzero(new)[1:] - 1], starts[-1]) + length
    return np.column_stack([begin, stop])


def judged(distinct: DataFrame, length: int) -> DataFrame:
    """(h, c, n, cover): of distinct stretches (h, bytes, n) the covered ranges."""
    def run(batches):
        held, size, last = [], 0, None

        def settle(rows):
            h = np.array([r[0] for r in rows], np.int64)
            got = repeats([r[1] for r in rows], np.array([r[3] for r in rows]), length,
                          np.cumsum(np.concatenate([[0], h[1:] != h[:-1]])))
            some = [(r, runs(s, length)) for r, s in zip(rows, got, strict=True) if len(s)]
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r, _ in some], pa.int64()), pa.array([r[2] for r, _ in some], pa.int64()),
                pa.array([r[3] for r, _ in some], pa.int64()),
                pa.array([s.astype(np.int32).tobytes() for _, s in some], pa.binary())],
                ["h", "c", "n", "cover"])

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size > BLOCK and r[0] != last:
                    yield settle(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[1])
                last = r[0]
        if held:
            yield settle(held)

    return distinct.repartition("h").sortWithinPartitions("h").select("h", "bytes", "c", "n") \
        .mapInArrow(run, "h long, c long, n long, cover binary")


def clean(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
          gram: int = GRAM, keep: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans,
    kept_sha256 and, with ``keep``, kept (the remaining bytes)."""
    chunks = materialize(chunked(docs, id_col, text, length, gram), "suffix-chunks")
    slim = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_th"),
                       F.coalesce(text, F.lit("")).alias("text"))
    hits = found(chunks)
    joined = slim.join(hits, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_th") == F.col("th")), "left")
    parted = materialize(joined.select(
        F.col("_id").alias("id"), F.col("_th").alias("th"), "text", "keys", "at", "count"), "suffix-texts")
    discard(chunks)
    touched = parted.filter("keys is not null")
    crowded = crowded_keys(touched)
    pieces = materialize(contexts(touched, length, crowded), "suffix-stretches")
    distinct = pieces.groupBy("h", "bytes", "c").agg(F.count("*").alias("n"))
    covers = materialize(judged(distinct, length), "suffix-covers")
    spots = attach(pieces.select("id", "th", "h", "at", "c"), covers,
                   ["h", "c"], "n", F.xxhash64("id", "th", "at")).filter("cover is not null").select("id", "th", "at", "cover")
    if len(crowded):
        spots = spots.union(crowded_covers(touched, length, crowded))
    by_doc = spots.groupBy("id", "th").agg(F.collect_list(F.struct("at", "cover")).alias("covers")) \
        .select(F.col("id").alias("_id"), F.col("th").alias("_th"), "covers")
    cut = parted.select("id", "th", "text").join(
        by_doc, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left") \
        .select("id", "text", "covers")

    def run(batches):
        for b in batches:
            rows = []
            for text, covers in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                data = left = text.encode()
                removed = spans = 0
                if covers:
                    ranges = np.concatenate([np.frombuffer(c["cover"], np.int32).reshape(-1, 2) + c["at"]
                                             for c in covers])
                    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
                    reach = np.maximum.accumulate(ranges[:, 1])
                    new = np.flatnonzero(np.concatenate([[True], ranges[1:, 0] > reach[:-1]]))
                    begin, stop = ranges[new, 0].tolist(), reach[np.append(new[1:] - 1, len(reach) - 1)].tolist()
                    removed, spans = sum(stop) - sum(begin), len(begin)
                    left = b"".join(data[a:z] for a, z in zip([0, *stop], [*begin, len(data)], strict=True))
                rows.append((len(data), removed, spans, hashlib.sha256(left).hexdigest(), left if keep else None))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = cut.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                              "kept binary").withColumnRenamed("id", id_col)
    return out if keep else out.drop("kept")


def crowded_keys(touched: DataFrame) -> np.ndarray:
    """Buckets with more than a thousandth of all stretches (so at most a
    thousand of them)."""
    def count(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                keys, n = np.unique(np.frombuffer(blob, np.uint64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["h", "n"])

    counts = materialize(touched.select("keys").mapInArrow(count, "h long, n long")
                         .groupBy("h").agg(F.sum("n").alias("n")).filter("n > 20"), "suffix-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.filter(F.col("n") > total / HEAVY_PARTS).select("h").collect()
    return np.array([r[0] for r in rows], np.int64).view(np.uint64)


ship(__name__)
