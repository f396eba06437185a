"""Packing by cutting-stock column generation.

Texts become token ids and are cut into whole sequences and one rest. The
rests are a cutting-stock problem: how to fill sequences of LENGTH with
pieces of given lengths. It is solved over the histogram of piece lengths (at
most LENGTH / GRID classes, whatever the corpus): a linear program over
patterns, to which a knapsack dynamic program adds the column of the best
price until none is left. The patterns, rounded down, are laid over the pieces
by their rank in their class; the few pieces beyond, as many as there are
patterns at most, are placed by best fit in the same way. Only the histogram
and the patterns are on the driver; token ids never move.

Defined results: null and empty texts are one piece, the end id alone; texts
of any length are cut into sequences; ties and repeated rows are pieces of
their own with ranks of their own; an empty table gives an empty result;
columns other than id and text are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from indicata.llm.common import materialize, ship

LENGTH, GRID = 2048, 4
#: Texts that a worker holds as Python strings at a time.
ROWS = 64
#: Id that ends every document.
END = 1
#: Fixed value: how a byte-level vocabulary splits text before its merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose class is the same in every version of the tables; texts
#: with others go to the tokenizer's own library.
SETTLED = re.compile("[\\x00-\u024f\u0370-\u03ff\u0400-\u04ff\u2000-\u206f\u20a0-\u20bf\u4e00-\u9fff]*")


def byte_ranks(vocabulary: str) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids, if merges apply in the order of ids.

    That holds for byte-level vocabularies whose pre-tokenizer is the plain
    split above; for any other file there are no ranks.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) \
        and not split.get("add_prefix_space") and not spec["normalizer"] and model["type"] == "BPE"
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    if not plain or any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte.values())}
    return {bytes(byte[ch] for ch in t): i for t, i in model["vocab"].items() if i < 256 + len(pairs)}


class Encoder:
    """Ids of a text, as the vocabulary's tokenizer gives them, as
    little-endian unsigned 32-bit integers; an added token's string in a text
    is that token.

    Byte-level vocabularies are merged by rank, which gives the same ids in a
    fraction of the time; everything else, and every text that holds an added
    token's string, goes to the tokenizer itself, which is loaded for the first
    such text.
    """

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary
        with open(vocabulary, encoding="utf-8") as f:
            added = [re.escape(t["content"]) for t in json.load(f).get("added_tokens") or ()]
        self.added = re.compile("|".join(added) or "(?!)")
        ranks = byte_ranks(vocabulary)
        self.fast = ranks and tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks,
                                                special_tokens={})

    @cached_property
    def model(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.vocabulary)

    def ids(self, text: str | None) -> bytes:
        if not text:
            out = []
        elif self.fast and SETTLED.fullmatch(text) and not self.added.search(text):
            out = self.fast.encode_ordinary(text)
        else:
            out = self.model.encode(text, add_special_tokens=False).ids
        return np.array([*out, END], "<u4").tobytes()


def strings(column: pa.Array):
    """The values of a column, a few at a time as Python's own."""
    for a in range(0, len(column), ROWS):
        yield from column.slice(a, ROWS).to_pylist()


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text",
           length: int = LENGTH, grid: int = GRID) -> DataFrame:
    """Pieces of every document with their class, task and rank in both."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        part, encoder, seen = TaskContext.get().partitionId(), Encoder(vocabulary), {}
        for b in batches:
            rows = {k: [] for k in ("i", "start", "length", "crc", "total", "class", "rank")}
            for i, ids in enumerate(map(encoder.ids, strings(b.column(1)))):
                total, view = len(ids) // 4, memoryview(ids)
                for start in range(0, total, length):
                    n = min(length, total - start)
                    kind = -(-n // grid)
                    if n == length:
                        kind = 0
                    seen[kind] = rank = seen.get(kind, -1) + 1
                    for k, v in zip(rows, (i, start, n, zlib.crc32(view[4 * start:4 * (start + n)]),
                                           total, kind, rank), strict=True):
                        rows[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows.pop("i"), pa.int64())),
                 *[pa.array(v, pa.int64()) for v in rows.values()],
                 pa.array([part] * len(rows["start"]), pa.int64())],
                ["id", "start", "length", "crc", "total", "class", "rank", "part"])

    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, f"id {id_type}, start long, length long, crc long, total long, "
             "class long, rank long, part long")


def knapsack(value: np.ndarray, room: int) -> tuple[float, dict[int, int]]:
    """Best filling of ``room`` with any number of items; item u has size u."""
    best, pick = np.zeros(room + 1), np.zeros(room + 1, int)
    for c in range(1, room + 1):
        worth = value[1:c + 1] + best[c - 1::-1][:c]
        u = int(worth.argmax())
        if worth[u] > best[c - 1]:
            best[c], pick[c] = worth[u], u + 1
        else:
            best[c] = best[c - 1]
    out: dict[int, int] = {}
    c = room
    while c > 0:
        if pick[c]:
            out[int(pick[c])] = out.get(int(pick[c]), 0) + 1
            c -= pick[c]
        else:
            c -= 1
    return float(best[room]), out


def start(demand: dict[int, int], room: int) -> list[dict[int, int]]:
    """A first basis: fullest patterns of the sizes left, long pieces first.

    Each is used until a size runs out, so its column has an entry for that
    size and none for sizes that ran out before: the basis is triangular.
    """
    left, columns = {k: float(n) for k, n in demand.items()}, []
    while left:
        longest = max(left)
        value = np.zeros(room + 1)
        value[list(left)] = np.array(list(left)) ** 1.02
        _, pattern = knapsack(value, room - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[s] / n for s, n in pattern.items())
        empty = [s for s, n in pattern.items() if left[s] - n * times <= 1e-9 * demand[s]]
        columns.append(pattern)
        columns += [{s: room // s} for s in empty[1:]]
        left = {s: n - pattern.get(s, 0) * times for s, n in left.items() if s not in empty}
    return columns


def solve(demand: dict[int, int], room: int, gap: float = 5e-4) -> list[tuple[dict[int, int], float]]:
    """Linear program of the cutting stock: patterns and how often, fractional.

    Revised simplex from the patterns of ``start``; the knapsack prices
    columns. It ends within ``gap`` of a lower bound (the better of the
    pieces' sum and the value that the prices prove), or after three columns
    a size.
    """
    demand = {s: n for s, n in demand.items() if n > 0}
    sizes = sorted(demand)
    if not sizes:
        return []
    row = {s: i for i, s in enumerate(sizes)}

    def dense(pattern):
        out = np.zeros(len(sizes))
        for s, n in pattern.items():
            out[row[s]] = n
        return out

    columns = start(demand, room)
    inverse = np.linalg.inv(np.array([dense(c) for c in columns]).T)
    x = np.maximum(inverse @ np.array([float(demand[s]) for s in sizes]), 0.0)
    low = sum(s * n for s, n in demand.items()) / room
    for _ in range(3 * len(sizes)):
        if x.sum() <= low * (1 + gap):
            break
        value = np.zeros(room + 1)
        value[sizes] = np.maximum(inverse.sum(axis=0), 0.0)
        worth, pattern = knapsack(value, room)
        low = max(low, x.sum() / worth)
        if worth <= 1 + gap:
            break
        way = inverse @ dense(pattern)
        able = way > 1e-9
        ratio = np.full(len(sizes), np.inf)
        ratio[able] = x[able] / way[able]
        out = int(ratio.argmin())
        step = ratio[out]
        x = np.maximum(x - step * way, 0.0)
        x[out] = step
        pivot = inverse[out] / way[out]
        inverse -= np.outer(way, pivot)
        inverse[out] = pivot
        columns[out] = pattern
    return list(zip(columns, x.tolist(), strict=True))


def rounded(demand: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns that use up ``demand`` exactly.

    Fractional patterns are rounded down; what is left (fewer pieces than
    patterns times pieces in a pattern) is placed by best fit, longest first.
    """
    left, out = {k: n for k, n in demand.items() if n > 0}, []
    for pattern, times in solve(demand, room):
        times = min([int(times + 1e-6), *(left[s] // n for s, n in pattern.items())])
        if times > 0:
            out.append((pattern, times))
            for s, n in pattern.items():
                left[s] -= n * times
    open_at: list[list[dict[int, int]]] = [[] for _ in range(room + 1)]
    for s in sorted(left, reverse=True):
        for _ in range(left[s]):
            at = next((r for r in range(s, room + 1) if open_at[r]), None)
            bin_ = open_at[at].pop() if at is not None else {}
            bin_[s] = bin_.get(s, 0) + 1
            open_at[(room if at is None else at) - s].append(bin_)
    return out + [(b, 1) for bins in open_at for b in bins]


def plan(histogram: dict[int, int], length: int, grid: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (class, first rank, last rank + 1, copies, first sequence)."""
    rows, used, sequence = [], {}, 0
    whole = histogram.get(0, 0)
    if whole:
        rows.append((0, 0, whole, whole, 0))
        sequence = whole
    rest = {k: n for k, n in histogram.items() if k}
    for pattern, times in rounded(rest, length // grid):
        for kind, n in pattern.items():
            first = used.get(kind, 0)
            used[kind] = first + n * times
            rows.append((kind, first, first + n * times, times, sequence))
        sequence += times
    return rows


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text",
         length: int = LENGTH, grid: int = GRID) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    spark = docs.sparkSession
    cut = materialize(pieces(docs, vocabulary, id_col, text, length, grid), "pack-pieces")
    counts = materialize(cut.groupBy("part", "class").agg(F.count("*").alias("n")), "pack-counts")
    # one row per class, LENGTH / GRID at most
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    before = counts.select("part", "class", (F.sum("n").over(
        Window.partitionBy("class").orderBy("part")) - F.col("n")).alias("before"))
    patterns = spark.createDataFrame(
        plan(histogram, length, grid), "kind long, first long, stop long, copies long, base long")
    ranked = cut.join(before, ["part", "class"]).withColumn("at", F.col("before") + F.col("rank"))
    # the plan has a bounded number of rows: classes times patterns that use one
    placed = ranked.join(F.broadcast(patterns), (F.col("class") == F.col("kind"))
                         & (F.col("at") >= F.col("first")) & (F.col("at") < F.col("stop")))
    slot = (F.col("at") - F.col("first"))
    placed = placed.withColumn("sequence_id", F.col("base") + slot % F.col("copies")) \
        .withColumn("slot", F.floor(slot / F.col("copies")))
    inside = Window.partitionBy("sequence_id").orderBy(F.col("class").desc(), "slot")
    return placed.withColumn("offset", F.sum("length").over(inside) - F.col("length")).select(
        F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"),
        F.col("total").alias("doc_tokens"), "sequence_id", "offset")


ship(__name__)
