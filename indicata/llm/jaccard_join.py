"""N-gram Jaccard join with set-relation skipping.

A document's set is its distinct word shingles. Work is skipped by relations
between sets, never by leaving rows out:

* documents with the same set are one set;
* a set whose lowest-hashed shingles other sets hardly hold has no partner:
  for every size there is a number of shared ones that a partner implies
  (see ``needed``), and most documents have fewer; only the others go on;
* of those, only the shingles that another one of them holds count from then
  on; a set with too few of them has no partner;
* the index lists hold the sets by their first few shingles in an order that
  puts common ones last, fewer in the part of the smaller set of a pair than
  in that of the larger; a pair that links meets in a list;
* every set first meets one hub, the set it shares most lists with, and the
  overlap is counted exactly; sets that links connect have one label, and a
  list whose sets all have the same one is done;
* in a list with several labels most sets have one of them as a rule; the
  others then meet a few sets of that label, chosen anew in each round, so a
  family of thousands that are near one another is connected by some of its
  links and never paired;
* what is left are sets outside the label that most of a list has: only they
  are held against the list's other sets, each pair in the first list that both
  are in. Lists are cut into blocks by set size, and blocks that cannot hold a
  partner are not visited; position in the list order bounds the overlap;
* two sets measured against the same hub get their answer from it where the
  bound that follows leaves no doubt;
* a set's shingles are also marked in a few hundred bits: a bit that only one
  set of a pair has stands for a shingle that the other lacks, so the bits bound
  the overlap from above, and pairs that cannot link are not put together;
* only the pairs left are counted.

Of hubs or main labels with equal counts any one serves: they decide what work
is skipped, never which links are found. Shingles and sets are told apart by
64-bit hashes.

Defined results: A-Z are folded, other letters are not; with fewer words than
a shingle the whole sequence is the one shingle; null and empty texts and
texts of whitespace have the empty set, link with nothing and are their own
component; a null id is never the smallest of its component (a component of
null ids only has none); repeated rows are linked as copies; an empty table
gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from indicata.llm.common import (K1, K3, attach, components, discard, materialize, mix, repeated,
                                 shingle_hashes, ship, slices, text_buffers, word_hashes)

#: Words of a shingle, threshold in percent.
WORDS, PERCENT = 5, 75
#: Text that a worker takes at a time; shingles counted together at a time.
BYTES, TOGETHER = 4 << 20, 1_000_000
#: Percent of a set's shingles that are compared beyond the first few that any
#: two linked sets must share.
BEYOND = 15
#: The order puts at most so many common shingles last. Any order gives the
#: same links; this one makes short lists.
COMMON, SEEN = 1 << 18, 3
#: Rounds in which sets meet others of a list's main label: how many each, and
#: how many are drawn from a list. What is left by then links to few or none.
ROUNDS = ((32, 3),)
#: Longest index of a set that is carried along to find a pair's first list;
#: pairs of longer ones may come up in several lists and are made distinct.
CARRIED = 256
#: Longs of the marks of a set's shingles; any number gives the same links.
MARKS = [f"w{i}" for i in range(8)]
#: Text of which a worker makes sets at a time.
PIECE = 512 << 10
#: Input bytes to a bucket of shingles.
BUCKET = 8 << 20


def first_few(n: int, percent: int) -> int:
    """Of sets that reach the threshold, the first this many shingles of both,
    in any common order, have one in common."""
    return n - -(-percent * n // 100) + 1


def beyond(n: int) -> int:
    return BEYOND * n // 100


def needed(n: int, percent: int) -> int:
    """How many of its first ``first_few + beyond`` shingles a set shares with
    any partner, at least, where the partner looks at its own first ones too.

    The j-th shingle that both hold has at most j plus those the other lacks
    before it, so it is among the first ones of both for every j up to 1 +
    beyond(size) of the smaller, which has at least ``percent`` of n.
    """
    return 1 + beyond(-(-percent * n // 100))


def sets_of(raw: np.ndarray, off: np.ndarray, k: int):
    """The sorted distinct shingles of every text."""
    words, at = word_hashes(raw, off)
    every = shingle_hashes(words, k) if len(words) >= k else words[:0]
    for i in range(len(off) - 1):
        a, b = at[i], at[i + 1]
        h = every[a:b - k + 1] if b - a >= k else shingle_hashes(words[a:b], k)
        h = np.sort(h)
        yield h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def sets_by_piece(raw: np.ndarray, off: np.ndarray, k: int):
    """``sets_of`` a long stretch of texts, with the working memory of a piece."""
    for a, b in slices(off, PIECE):
        yield from sets_of(raw[off[a]:off[b]], off[a:b + 1] - off[a], k)


def marks(keys: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Bits of each of ``n`` sets, from its shingles."""
    out = np.zeros((n, len(MARKS)), np.uint64)
    bit = mix(keys) % np.uint64(64 * len(MARKS))
    np.bitwise_or.at(out, (row, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    return out.view(np.int64)


def set_id(u: np.ndarray) -> int:
    """64-bit name of a set."""
    with np.errstate(over="ignore"):
        s = np.add.reduce(mix(u ^ K3)) + np.uint64(len(u)) * K1
    return int(mix(np.array([s], np.uint64)).view(np.int64)[0])


def settled(docs: DataFrame, id_col: str, text: str, k: int, percent: int) -> DataFrame:
    """What every few megabytes of text know of their sets, materialized.

    Each chunk sends its sets' first shingles, packed by hash range, to the
    buckets; a shingle that several of its sets hold goes once. Buckets answer
    which came from elsewhere too. Rows: one per chunk with its documents, sets
    and own counts, and answers (chunk, answer: set numbers).
    """
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    n = min(max(1, size // BUCKET), 1 << 16) if size < 1 << 60 \
        else 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # bytes of a hash that keep chance meetings rare; a meeting costs only time
    width = min(8, math.ceil((math.log2(max(size, 2)) + 8) / 8))
    none = 0xFFFF

    def send(batches):
        part, n_chunk = TaskContext.get().partitionId(), 0
        for b in batches:
            raw, off = text_buffers(b.column(2))
            for lo, hi in slices(off, BYTES):
                for lo, hi in ((i, min(hi, i + none)) for i in range(lo, hi, none)):  # noqa: B020
                    name = f"{part}-{n_chunk}"
                    n_chunk += 1
                    of, size, first = [], [], {}
                    for u in sets_by_piece(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], k):
                        s = set_id(u)
                        of.append(s)
                        size.append(len(u))
                        if len(u) and s not in first:
                            first[s] = u[:first_few(len(u), percent) + beyond(len(u))]
                    keys = np.concatenate([*first.values(), np.zeros(0, np.uint64)])
                    idx = np.repeat(np.arange(len(first)), [len(u) for u in first.values()])
                    order = np.argsort(keys)
                    keys, idx = keys[order], idx[order]
                    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
                    count = np.diff(np.append(at, len(keys))).astype(np.int64)
                    local = np.bincount(idx[np.repeat(count > 1, count)], minlength=len(first))
                    sent, whose = keys[at], np.where(count > 1, none, idx[at]).astype(np.uint16)
                    bucket = (sent >> np.uint64(40)) * np.uint64(n) >> np.uint64(24)
                    cut = np.searchsorted(bucket, np.arange(n + 1, dtype=np.uint64))
                    short = (sent >> np.uint64(64 - 8 * width)).view(np.uint8).reshape(-1, 8)[:, :width]
                    some = [i for i in range(n) if cut[i] < cut[i + 1]]
                    rows = [(i, name, short[cut[i]:cut[i + 1]].tobytes(), whose[cut[i]:cut[i + 1]].tobytes())
                            for i in some]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([r[j] for r in rows], t) for j, t in enumerate(
                            (pa.int32(), pa.string(), pa.binary(), pa.binary()))),
                         *(pa.nulls(len(rows), t) for t in META)], NAMES)
                    sizes = dict(zip(of, size, strict=True))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([zlib.crc32(name.encode()) % n], pa.int32()), pa.array([name]),
                        pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                        pa.array([b.column(0).slice(lo, hi - lo).to_pylist()], META[0]),
                        pa.array([b.column(1).slice(lo, hi - lo).to_pylist()], META[0]),
                        pa.array([of], META[0]), pa.array([size], META[0]), pa.array([list(first)], META[0]),
                        pa.array([[needed(sizes[s], percent) for s in first]], META[0]),
                        pa.array([local.tolist()], META[0])], NAMES)

    def settle(batches):
        by: dict[int, list] = {}
        for b in batches:
            meta = b.filter(pc.is_valid(b.column(4)))
            if len(meta):
                yield pa.RecordBatch.from_arrays([*meta.columns[1:2], *meta.columns[4:],
                                                  pa.nulls(len(meta), pa.binary())], ANSWER)
            for bucket, chunk, keys, whose in zip(*(c.to_pylist() for c in b.columns[:4]), strict=True):
                if keys is not None:
                    by.setdefault(bucket, []).append((chunk, keys, whose))
        for parts in by.values():
            keys = []
            for _, short, _ in parts:
                wide = np.zeros((len(short) // width, 8), np.uint8)
                wide[:, :width] = np.frombuffer(short, np.uint8).reshape(-1, width)
                keys.append(wide.view(np.uint64).ravel())
            every = np.sort(np.concatenate(keys))
            more = np.unique(every[1:][every[1:] == every[:-1]])
            out = []
            for key, (chunk, _, whose) in zip(keys, parts, strict=True):
                whose = np.frombuffer(whose, np.uint16)
                if len(more):
                    again = more[np.minimum(np.searchsorted(more, key), len(more) - 1)] == key
                    mine = whose[again & (whose != none)]
                    if len(mine):
                        out.append((chunk, mine.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in out], pa.string()), *(pa.nulls(len(out), t) for t in META),
                 pa.array([w for _, w in out], pa.binary())], ANSWER)

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"),
                       F.col(text).alias("text"))
    listed = ", ".join(f"{c} array<long>" for c in COLUMNS)
    sent = slim.mapInArrow(send, f"bucket int, chunk string, keys binary, whose binary, {listed}")
    return materialize(sent.repartition(n, "bucket").mapInArrow(
        settle, f"chunk string, {listed}, answer binary"), "jaccard-settled")


COLUMNS = ("ids", "hashes", "of", "size", "sets", "need", "local")
META = [pa.list_(pa.int64())] * len(COLUMNS)
NAMES = ["bucket", "chunk", "keys", "whose", *COLUMNS]
ANSWER = ["chunk", *COLUMNS, "answer"]


def candidates(known: DataFrame) -> DataFrame:
    """(s): sets that share enough of their first shingles to have a partner."""
    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["sets"]:
                    got = np.array(r["local"], np.int64)
                    for a in r["answers"]:
                        got += np.bincount(np.frombuffer(a, np.uint16), minlength=len(got))
                    out += [s for s, g, n in zip(r["sets"], got, r["need"], strict=True) if g >= n]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["s"])

    answers = known.filter("answer is not null").groupBy("chunk").agg(F.collect_list("answer").alias("answers"))
    return known.filter("sets is not null").select("chunk", "sets", "need", "local") \
        .join(answers, "chunk", "left") \
        .withColumn("answers", F.coalesce("answers", F.expr("cast(array() as array<binary>)"))) \
        .select("sets", "need", "local", "answers").mapInArrow(run, "s long").distinct()


def common_shingles(items: DataFrame, most: int) -> np.ndarray:
    """Common shingles of the sets, rarest first; at most ``most``.

    A task reports what it sees SEEN times among a few million shingles.
    """
    def count(batches):
        kept, size = [], 0

        def flush():
            h = np.sort(np.concatenate(kept))
            at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            n = np.diff(np.append(at, len(h)))
            often = n >= SEEN
            return pa.RecordBatch.from_arrays([pa.array(h[at][often]), pa.array(n[often])], ["h", "n"])

        for b in batches:
            kept.append(b.column(0).flatten().to_numpy())
            size += len(kept[-1])
            if size > TOGETHER:
                yield flush()
                kept, size = [], 0
        if size:
            yield flush()

    top = items.select("items").mapInArrow(count, "h long, n long") \
        .groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "h").limit(most)
    rows = materialize(top, "common-shingles").orderBy("n", "h").toArrow()
    return rows.column("h").to_numpy().view(np.uint64) if len(rows) else np.zeros(0, np.uint64)


def cores(items: DataFrame, percent: int) -> DataFrame:
    """(s, n, t, items, marks): of each set the ``t`` shingles that another one
    holds; without the sets that have too few of them for any partner."""
    def pack(batches):
        part, n_chunk = TaskContext.get().partitionId(), 0
        for b in batches:
            ends = np.cumsum([len(x) for x in b.column(2)])
            for lo, hi in slices(np.concatenate([[0], ends]), 50_000):
                c = b.slice(lo, hi - lo)
                keys = c.column(2).flatten().to_numpy()
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{part}-{n_chunk}"]), *(pa.array([x.tobytes()], pa.binary()) for x in (
                        c.column(0).to_numpy(), c.column(1).to_numpy(), keys)),
                    pa.array([len(keys)], pa.int64())], ["chunk", "sets", "ns", "keys", "n_keys"])
                n_chunk += 1

    def keep(batches):
        for b in batches:
            for r in b.to_pylist():
                hits = np.sort(np.concatenate([np.frombuffer(h, np.uint64) for h in r["hits"]]))
                keys = np.frombuffer(r["keys"], np.uint64)
                sets, ns = np.frombuffer(r["sets"], np.int64), np.frombuffer(r["ns"], np.int32)
                row = np.repeat(np.arange(len(ns)), ns)
                ok = hits[np.minimum(np.searchsorted(hits, keys), len(hits) - 1)] == keys
                t = np.bincount(row[ok], minlength=len(ns))
                fit = 100 * t >= percent * ns
                ok &= fit[row]
                bits = marks(keys[ok], (np.cumsum(fit) - 1)[row[ok]], int(fit.sum()))
                yield pa.RecordBatch.from_arrays([
                    pa.array(sets[fit]), pa.array(ns[fit]), pa.array(t[fit].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(t[fit])]), pa.int32()),
                                             pa.array(keys[ok].view(np.int64))),
                    *(pa.array(np.ascontiguousarray(bits[:, i])) for i in range(len(MARKS)))],
                    ["s", "n", "t", "items", *MARKS])

    packed = materialize(items.mapInArrow(
        pack, "chunk string, sets binary, ns binary, keys binary, n_keys long"), "jaccard-packed")
    return packed.drop("n_keys").join(repeated(packed.select("chunk", "n_keys", "keys")), "chunk") \
        .mapInArrow(keep, "s long, n int, t int, items array<long>, " + ", ".join(f"{w} long" for w in MARKS))


def lists(sets: DataFrame, percent: int, common: np.ndarray) -> DataFrame:
    """Entries (sig, s, n, t, pos, small) of each set's first shingles, rare
    first; ``small``: the set may be the smaller one of a pair that meets here.

    A pair needs an overlap of percent * (both sizes) / (100 + percent): at
    least ``percent`` of the larger size, and twice that share of the smaller.
    """
    order = np.argsort(common)
    by_hash = common[order]

    def ranked(u: np.ndarray) -> np.ndarray:
        if not len(by_hash):
            return u
        at = np.minimum(np.searchsorted(by_hash, u), len(by_hash) - 1)
        often = by_hash[at] == u
        return np.concatenate([u[~often], common[np.sort(order[at[often]])]])

    def run(batches):
        for b in batches:
            s, n, t = (b.column(i).to_numpy().astype(np.int64) for i in range(3))
            most = t - -(-percent * n // 100) + 1
            least = t - -(-2 * percent * n // (100 + percent)) + 1
            first = [ranked(i.values.to_numpy().view(np.uint64))[:m]
                     for i, m in zip(b.column(3), most.tolist(), strict=True)]
            length = [len(p) for p in first]
            row = np.repeat(np.arange(len(first)), length)
            pos = np.concatenate([np.arange(i, dtype=np.int32) for i in length])
            keys = np.concatenate(first).view(np.int64)
            for a in range(0, len(row), 50_000):
                r, p = row[a:a + 50_000], pos[a:a + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a:a + 50_000]), pa.array(s[r]), pa.array(n[r].astype(np.int32)),
                     pa.array(t[r].astype(np.int32)), pa.array(p), pa.array(p < least[r])],
                    ["sig", "s", "n", "t", "pos", "small"])

    return sets.select("s", "n", "t", "items").mapInArrow(
        run, "sig long, s long, n int, t int, pos int, small boolean")


def contents(docs: DataFrame, wanted: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """(s, n, items) of the wanted sets (s, id, th), one row each, from a text
    that has the set."""
    def run(batches):
        for b in batches:
            raw, off = text_buffers(b.column(1))
            for lo, hi in slices(off, BYTES):
                got = list(sets_by_piece(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], k))
                flat = np.concatenate([*got, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([len(u) for u in got], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, got)]), pa.int32()),
                                              pa.array(flat))], ["s", "n", "items"])

    found = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_th"),
                        F.col(text).alias("_text")) \
        .join(wanted, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_th") == F.col("th"))) \
        .dropDuplicates(["_id", "_th"]).select("s", "_text")
    return found.mapInArrow(run, "s long, n int, items array<long>")


def counted(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """``pairs (a, b)`` with the exact overlap ``o`` and both sizes."""
    a = items.select(F.col("s").alias("a"), F.col("n").alias("na"), F.col("items").alias("ia"))
    b = items.select(F.col("s").alias("b"), F.col("n").alias("nb"), F.col("items").alias("ib"))
    return pairs.join(a, "a").join(b, "b").select(
        "a", "b", "na", "nb", F.size(F.array_intersect("ia", "ib")).alias("o"))


def relabel(labels: DataFrame, links: DataFrame, same: bool = False) -> DataFrame:
    """``labels (s, c)`` after ``links (a, b)`` of sets: sets of one label are
    connected, and what links to one label mostly gets one (two steps of the
    smallest label around). ``same``: every set is its own label so far."""
    if same:
        ends = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    else:
        a, b = (labels.select(F.col("s").alias(x), F.col("c").alias(y)) for x, y in (("a", "u"), ("b", "v")))
        ends = links.join(a, "a").join(b, "b").filter("u <> v").select("u", "v")
    ends = materialize(ends.union(ends.select("v", "u")).distinct(), "jaccard-ends")
    low = ends.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    lower = ends.join(low.select(F.col("u").alias("v"), "m"), "v").groupBy("u").agg(F.min("m").alias("m"))
    return materialize(labels.join(lower, F.col("c") == F.col("u"), "left").select(
        "s", F.coalesce("m", "c").alias("c")), "jaccard-labels")


def open_lists(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries of the lists whose sets have several labels, with their label
    ``c`` and the one that most sets of the list have, ``bulk``."""
    told = entries.drop("hub").join(labels, "s")
    bulk = told.groupBy("sig", "c").agg(F.count("*").alias("k")).groupBy("sig").agg(
        F.max_by("c", "k").alias("bulk"), F.count("*").alias("labels")).filter("labels > 1").drop("labels")
    return materialize(told.join(bulk, "sig"), "jaccard-told")


def meetings(told: DataFrame, most: int, draws: int) -> DataFrame:
    """Pairs (a, b): each set outside its lists' main label and up to ``most``
    sets of that label, those drawn in most of its lists first."""
    drawn = told.filter("c = bulk").groupBy("sig").agg(F.array(*[
        F.min_by("s", F.xxhash64("s", "sig", F.lit(i))) for i in range(draws)]).alias("m")) \
        .select("sig", F.explode(F.array_distinct("m")).alias("b"))
    asked = told.filter("c <> bulk").select("sig", F.col("s").alias("a")).join(drawn, "sig") \
        .groupBy("a", "b").agg(F.count("*").alias("k"))
    best = Window.partitionBy("a").orderBy(F.desc("k"), "b")
    return asked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most).select("a", "b")


def grouped(docs: DataFrame, id_col: str, text: str, k: int, percent: int) -> DataFrame:
    """One row per row of ``docs``: id, th (hash of the text), n (shingles)
    and, in a component of several rows, ``rows`` (those of its set) and
    ``first``: the smallest id, and text hash of that id, of the component."""
    known_sets = settled(docs, id_col, text, k, percent)
    rows = known_sets.filter("sets is not null") \
        .select(F.explode(F.arrays_zip("ids", "hashes", "of", "size")).alias("r")) \
        .select(F.col("r.ids").alias("id"), F.col("r.hashes").alias("th"), F.col("r.of").alias("s"),
                F.col("r.size").alias("n"))
    # the smallest id with a text of it; of null ids only, the smallest text hash
    smallest = (F.min("id").alias("id"), F.coalesce(F.min_by("th", "id"), F.min("th")).alias("th"))
    held = materialize(rows.filter("n > 0").groupBy("s").agg(*smallest, F.count("*").alias("rows")), "jaccard-held")
    wanted = candidates(known_sets).join(held, "s").select("s", "id", "th")
    items = materialize(cores(contents(docs, wanted, id_col, text, k), percent), "jaccard-cores")

    # lists of shingles that at least two sets hold, each with a hub
    raw = materialize(lists(items, percent, common_shingles(items, COMMON)), "jaccard-entries")
    shared = materialize(raw.groupBy("sig").agg(
        F.min("s").alias("hub"), F.max("s").alias("_last")).filter("hub <> _last").drop("_last"),
        "jaccard-shared")
    entries = materialize(raw.join(shared, "sig"), "jaccard-lists")
    discard(raw)
    best = entries.filter("s <> hub").groupBy("s", "hub").agg(F.count("*").alias("c")) \
        .groupBy(F.col("s").alias("a")).agg(F.max_by("hub", "c").alias("b"))

    enough = f"100 * o >= {percent} * (na + nb - o)"
    met = materialize(counted(best, items), "jaccard-hubs")
    near = met.filter(enough).select("a", "b")
    labels = relabel(items.select("s", F.col("s").alias("c")), near, same=True)
    for most, draws in ROUNDS:
        some = meetings(open_lists(entries, labels), most, draws)
        found = materialize(counted(some, items).filter(enough).select("a", "b"), "jaccard-met")
        near, labels = near.union(found), relabel(labels, found)
    # what is known of each set: its hub and the overlap
    known = items.select("s", *MARKS).join(met.select(F.col("a").alias("s"), F.col("b").alias("h"), "o"), "s", "left") \
        .select("s", F.coalesce("h", "s").alias("h"), "o", *MARKS)
    told = open_lists(entries, labels)
    index = told.groupBy("s").agg(F.collect_set("sig").alias("all"),
                                  F.collect_set(F.when(F.col("small"), F.col("sig"))).alias("few"))
    index = index.select("s", *[F.when(F.size("all") <= CARRIED, F.col(c)).alias(c) for c in ("all", "few")])
    told = materialize(told.join(known, "s").join(index, "s").withColumns({
        "o": F.coalesce("o", "t"), "rest": F.col("c") != F.col("bulk"),
        "size_class": F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)))}), "jaccard-open")
    names = ("s", "n", "t", "pos", "c", "h", "o", "rest", *MARKS)
    left = told.filter("small").select("sig", "size_class", "few", *[F.col(c).alias(f"{c}a") for c in names])
    right = told.select("sig", F.explode(F.array(F.col("size_class"), F.col("size_class") - 1))
                        .alias("size_class"), "all", *[F.col(c).alias(f"{c}b") for c in names])
    reach = f"{percent} * (na + nb)"
    whole = 100 + percent
    lack = lambda x, y: " + ".join(f"bit_count({w}{x} & ~{w}{y})" for w in MARKS)
    fits = (
        "ca <> cb and (na < nb or (na = nb and sa < sb))"
        f" and 100 * na >= {percent} * nb and {whole} * least(ta, tb) >= {reach}"
        f" and {whole} * (least(posa, posb) + 1 + least(ta - 1 - posa, tb - 1 - posb)) >= {reach}"
        " and ha <> sb and hb <> sa"
        f" and (ha <> hb or {whole} * (least(oa, ob) + least(ta - oa, tb - ob)) >= {reach})"
        f" and {whole} * least(ta - ({lack('a', 'b')}), tb - ({lack('b', 'a')})) >= {reach}"
        " and coalesce(array_min(array_intersect(few, all)) = sig, true)")

    def meet(some: DataFrame, others: DataFrame) -> DataFrame:
        return some.join(others, ["sig", "size_class"]).filter(fits) \
            .select(F.col("sa").alias("a"), F.col("sb").alias("b"))

    pairs = meet(left.filter("resta"), right).union(meet(left.filter("not resta"), right.filter("restb"))).distinct()
    late = counted(materialize(pairs, "jaccard-pairs"), items).filter(enough).select("a", "b")
    joined = materialize(components(near.union(late)), "jaccard-components")

    # the first row of a component (null ids last), and the rows of its sets
    member = held.join(joined.select(F.col("node").alias("s"), "component"), "s", "left") \
        .withColumn("component", F.coalesce("component", "s"))
    lowest = member.groupBy("component").agg(*smallest, F.sum("rows").alias("all")) \
        .filter("all > 1").select("component", F.struct("id", "th").alias("first"))
    groups = materialize(member.join(lowest, "component").select("s", "rows", "first"), "jaccard-groups")
    return attach(rows.withColumn("s", F.when(F.col("n") > 0, F.col("s"))), groups, ["s"], "rows",
                  F.xxhash64("id", "th"))


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = WORDS,
            percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id."""
    alone = F.col("rows").isNull()
    return grouped(docs, id_col, text, k, percent).select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = WORDS,
               percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component: the smallest id's (of a
    component of null ids only, one of those; of several texts under that id,
    one of those; any of its rows, where it is repeated). Rows are told apart
    by id and text; those without shingles all stay."""
    found = grouped(docs, id_col, text, k, percent).filter("rows is not null") \
        .select(F.col("id").alias("_id"), F.col("th").alias("_th"),
                (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th"))).alias("kept"))
    judged = materialize(found.groupBy("_id", "_th", "kept").agg(F.count("*").alias("n")), "jaccard-judged")
    of = lambda some: F.col("_i").eqNullSafe(some["_id"]) & (F.col("_t") == some["_th"])
    gone, again = judged.filter("not kept"), judged.filter("kept and n > 1")
    left = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_i"),
                       F.xxhash64(text).alias("_t"))
    left = left.join(gone, of(gone), "left_anti")
    if not again.isEmpty():
        left = left.join(again, of(again), "left_anti").unionByName(
            left.join(again, of(again), "left_semi").dropDuplicates(["_i", "_t"]))
    return left.select("_row.*")


ship(__name__)
