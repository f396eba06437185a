"""Exact dedup, Jaccard join, suffix dedup and chaining against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from indicata.llm import chaining, chunk_recipes, common, jaccard_join, suffix_dedup
from indicata.llm.common import attach, components, materialize
from tests.llm.cases import documents, empty, prose, values

SPACE = re.compile("[\x20\x09-\x0d]+")
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    df, rows = documents(spark)
    return df.cache(), rows


def exact(rows):
    norm = [(r[0], SPACE.sub(" ", r[1] or "")) for r in rows]
    groups = defaultdict(list)
    for i, t in norm:
        groups[t].append(i)
    out = []
    for i, t in norm:
        keep = min((x for x in groups[t] if x is not None), default=None)
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_recipes_equal_brute_force(docs):
    assert values(chunk_recipes.dedup(docs[0]), *COLUMNS) == exact(docs[1])


def test_colliding_chunk_hashes_are_told_apart(docs):
    clash = chunk_recipes.dedup(docs[0], hash_of=lambda c: F.length(c).cast("long"))
    assert values(clash, *COLUMNS) == exact(docs[1])


def test_chunks_concatenate_to_the_text(spark):
    df, _ = documents(spark)
    norm = chunk_recipes.normalised(F.col("text"))
    bad = df.select(norm.alias("t"), F.concat_ws("", chunk_recipes.chunks_of(norm)).alias("c"))
    assert bad.filter("t <> c").count() == 0


def test_keep_first_keeps_one_row_of_each_text(docs):
    left = chunk_recipes.keep_first(docs[0])
    assert left.columns == docs[0].columns
    texts = [SPACE.sub(" ", r.text or "") for r in left.collect()]
    assert sorted(texts) == sorted({SPACE.sub(" ", r[1] or "") for r in docs[1]})


def jaccard(rows):
    def words(t):
        return WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
    sets = [frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
            for w in (words(r[1]) for r in rows)]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    low = defaultdict(lambda: None)
    for i, r in enumerate(rows):
        if r[0] is not None and (low[find(i)] is None or r[0] < low[find(i)]):
            low[find(i)] = r[0]
    return sorted(((r[0], len(s), low[find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def test_jaccard_classes_equal_brute_force(docs):
    got = values(jaccard_join.classes(docs[0]), "doc_id", "n_shingles", "component_id")
    assert got == jaccard(docs[1])


def test_jaccard_classes_on_the_driver_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert values(jaccard_join.classes(df), "doc_id", "n_shingles", "component_id") == jaccard(rows)


def test_jaccard_keeps_one_of_each_class(docs):
    left = jaccard_join.keep_first(docs[0])
    classes = {r[2] for r in jaccard(docs[1]) if r[0] is not None}
    assert {r.doc_id for r in left.filter("doc_id is not null").collect()} == classes


def test_jaccard_keeps_rows_by_id_and_text(spark):
    """Null and repeated ids: one row of each class, and every row in none."""
    import random
    rnd = random.Random(5)
    a, b, c, d, e, f, g = (prose(rnd, 60) for _ in range(7))
    rows = [(1, a), (None, f"{a} more"), (None, b), (None, c),  # a null id near a row with an id
            (2, f"{a} again"), (2, d),                          # one text of a repeated id is near
            (None, e), (None, f"{e} more"), (None, e),          # null ids only
            (7, f), (7, f"{f} more"), (8, f"{f} again"),        # two texts of the smallest id
            (9, g), (9, g), (9, f"{g} more"), (None, ""), (None, ""), (3, None), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in jaccard_join.keep_first(df).collect()]
    lone = [(1, a), (None, b), (None, c), (2, d), (None, ""), (None, ""), (3, None), (3, None)]
    groups = [[(None, e), (None, f"{e} more")], [(7, f), (7, f"{f} more")], [(9, g), (9, f"{g} more")]]
    assert sorted((x for x in got if x in lone), key=repr) == sorted(lone, key=repr)
    assert [sum(x in group for x in got) for group in groups] == [1, 1, 1]
    assert len(got) == len(lone) + 3


def test_first_shingles_of_linked_sets_meet(spark):
    """``needed`` is a true lower bound, on random pairs at the threshold."""
    import random
    rnd = random.Random(4)
    for _ in range(3000):
        both, a, b = rnd.randint(1, 60), rnd.randint(0, 15), rnd.randint(0, 15)
        if 100 * both < 75 * (both + a + b):
            continue
        pool = rnd.sample(range(10000), both + a + b)
        x, y = sorted(pool[:both + a]), sorted(pool[:both] + pool[both + a:])
        head = lambda s: set(s[:jaccard_join.first_few(len(s), 75) + jaccard_join.beyond(len(s))])
        assert len(head(x) & head(y)) >= jaccard_join.needed(len(x), 75)


def suffix(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        left = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not p for g, p in zip(gone, b"\0" + bytes(gone[:-1]), strict=True)) if t else 0
        out.append((r[0], len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


DIGEST = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffix_dedup_equals_brute_force(docs):
    got = suffix_dedup.clean(docs[0])
    assert values(got, *DIGEST) == suffix(docs[1], 200)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())


def test_suffix_dedup_of_many_near_copies(spark):
    """Crowded buckets are dealt in finer ones and give the same result."""
    import random
    rnd = random.Random(2)
    base = [f"w{rnd.randint(0, 999)}" for _ in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        words[rnd.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert values(suffix_dedup.clean(df, keep=False), *DIGEST) == suffix(rows, 200)


def test_suffix_dedup_of_a_hot_passage_in_unlike_texts(spark, monkeypatch):
    """The unlike edges of a common passage do not gather in one bucket."""
    import random
    rnd = random.Random(6)
    own = lambda: "".join(rnd.choice("abcdefghij ") for _ in range(150))
    passage = "".join(rnd.choice("abcdefghij ") for _ in range(230))
    rows = [(i, own() + passage + own()) for i in range(300)]
    rows += [(1000 + i, t) for i, t in rows[:60]] + [(None, rows[0][1]), (None, passage), (5, passage + passage)]
    most, judged = [], suffix_dedup.judged

    def watched(distinct, length):
        most.append(distinct.groupBy("h").count().agg(F.max("count")).first()[0] or 0)
        return judged(distinct, length)

    monkeypatch.setattr(suffix_dedup, "judged", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert values(suffix_dedup.clean(df, keep=False), *DIGEST) == suffix(rows, 200)
    assert most[0] <= 30


def test_two_stage_sorting_orders_suffixes():
    import random

    import numpy as np
    rnd = random.Random(3)
    for _ in range(200):
        parts = [bytes(rnd.choice(b"abc"[:rnd.randint(1, 3)]) for _ in range(rnd.randint(5, 40)))
                 for _ in range(rnd.randint(1, 5))]
        size = [len(p) for p in parts]
        end = np.repeat(np.cumsum(size), size)
        wanted = np.array([i for i in range(sum(size)) if end[i] - i >= 5])
        data = b"".join(parts)
        order = suffix_dedup.sort_suffixes(data, end, np.zeros(len(data), np.int32), wanted, 5)
        assert sorted(order.tolist()) == wanted.tolist()
        keys = [data[i:i + 5] for i in order.tolist()]
        assert keys == sorted(keys)


def test_passages_cover_shared_runs_and_leave_others(docs):
    got = chaining.passages(docs[0]).collect()
    rows = [r for r in docs[1] if r[0] is not None and r[1]]
    runs = defaultdict(set)
    for r in rows:
        w = WORD.findall(r[1].lower())
        for i in range(len(w) - 49):
            runs[tuple(w[i:i + 50])].add(r[0])
    shared = {i for s in runs.values() if len(s) > 1 for i in s}
    assert shared <= {r.doc_id for r in got} | {r.other_id for r in got}
    cls = {r.doc_id: r.class_id for r in got} | {r.other_id: r.class_id for r in got}
    assert all(len({cls[i] for i in s}) == 1 for s in runs.values() if len(s) > 1)
    words = {r[0]: set(WORD.findall((r[1] or "").lower())) for r in rows}
    for r in got:
        assert r.other_id < r.doc_id and r.matched >= 40 and r.identity >= 0.75
        assert len(words[r.doc_id] & words[r.other_id]) > 1 or words[r.doc_id] == words[r.other_id]


def test_chain_gives_up_matches_out_of_order():
    import numpy as np
    a, b = np.array([0, 10, 20, 30, 40]), np.array([0, 10, 500, 30, 40])
    best = chaining.chains(a, b, 8, 0.1, 1)[0]
    assert best.tolist() == [0, 1, 3, 4]


def test_fuzzy_passage_is_aligned(spark):
    import random
    rnd = random.Random(8)
    words = [f"w{rnd.randint(0, 9999)}" for _ in range(80)]
    other = [*words[:30], "new", *words[30:50], *words[52:]]
    df = spark.createDataFrame([(1, "start here " + " ".join(words)), (2, " ".join(other) + " ends there")],
                               "doc_id long, text string")
    r = chaining.passages(df).first()
    assert (r.doc_id, r.other_id, r.class_id) == (2, 1, 1)
    assert (r.start, r.stop, r.other_start, r.other_stop) == (0, 79, 2, 82)
    assert r.matched == 80 - 3


def test_sets_of_an_unlinked_family_are_not_counted_pair_by_pair(spark, monkeypatch):
    """150 sets that nearly link with each other, and two linked pairs among them."""
    import random
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rnd.sample(range(5, 95), 2):
            words[at] = f"x{i}-{at}"
        rows.append((i, words))
    rows += [(200, [*rows[7][1], "end"]), (201, [*rows[30][1][1:], "end", "here"])]
    sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} for i, w in rows}
    top = {i: i for i in sets}
    linked = [(a, b) for a in sets for b in sets if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in linked:
            top[a] = top[b] = min(top[a], top[b])
    made = []
    counted = jaccard_join.counted
    monkeypatch.setattr(jaccard_join, "ROUNDS", ())
    monkeypatch.setattr(jaccard_join, "counted", lambda p, i: made.append(p.count()) or counted(p, i))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.classes(df).collect()}
    assert got == {i: (len(sets[i]), top[i]) for i in sets}
    assert made[-1] < 1_000 < 150 * 149 // 2


def test_marks_never_hide_a_link():
    import numpy as np
    rnd = np.random.default_rng(4)
    for n in (3, 40, 300, 3000):
        a = rnd.integers(0, 2 ** 63, n, dtype=np.uint64)
        b = np.concatenate([a[:n - n // 5], rnd.integers(0, 2 ** 63, n // 8, dtype=np.uint64)])
        bits = jaccard_join.marks(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2).view(np.uint64)
        only = int(np.bitwise_count(bits[0] & ~bits[1]).sum()), int(np.bitwise_count(bits[1] & ~bits[0]).sum())
        assert len(np.intersect1d(a, b)) <= min(len(a) - only[0], len(b) - only[1])


def test_passage_is_found_behind_nearer_holders_of_its_seeds(spark):
    """Texts 1 and 99 share 60 words; the texts between quote 35 of them, too
    few for a passage, so nobody links with its neighbours."""
    import random
    rnd = random.Random(5)
    some = lambda n: [f"w{rnd.randint(0, 99999)}" for _ in range(n)]
    run = some(60)
    rows = [(1, some(50) + run + some(50)), (99, some(70) + run + some(20))]
    for i in range(2, 99):
        at = i % 26
        rows.append((i, some(40) + run[at:at + 35] + some(40)))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = [(r.doc_id, r.other_id, r.start, r.stop, r.matched) for r in chaining.passages(df).collect()]
    assert got == [(99, 1, 70, 130, 60)]


def test_classes_are_those_of_all_pairs(spark, monkeypatch):
    """Against every pair of texts chained and aligned by itself, with long lists in blocks."""
    import random
    monkeypatch.setattr(chaining, "BLOCK", 3)
    rnd = random.Random(6)
    some = lambda n: [f"w{rnd.randint(0, 99999)}" for _ in range(n)]
    runs = [some(70) for _ in range(4)]
    rows = []
    for i in range(48):
        words = some(rnd.randint(5, 30))
        for run in rnd.sample(runs, rnd.randint(1, 2)):
            n = rnd.choice([24, 30, 36, 36, 48])
            at = rnd.randint(0, 70 - n)
            words += run[at:at + n] + some(rnd.randint(5, 30))
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame([*rows, *((i + 100, t) for i, t in rows[:6])], "doc_id long, text string")
    got = chaining.passages(df).collect()
    cls = {r.doc_id: r.class_id for r in got} | {r.other_id: r.class_id for r in got}
    linked = []
    every = [(r.doc_id, r.text) for r in df.collect()]
    for a, ta in every:
        for b, tb in every:
            if a < b:
                pair = spark_free_passages(ta, tb)
                linked += [(a, b)] if pair else []
    top = {i: i for i, _ in every}
    for _ in every:
        for a, b in linked:
            top[a] = top[b] = min(top[a], top[b])
    assert cls == {i: top[i] for i in {x for p in linked for x in p}}


def spark_free_passages(ta, tb):
    import numpy as np

    from indicata.llm.common import word_hashes
    sides = []
    for t in (ta, tb):
        raw = np.frombuffer(t.encode(), np.uint8)
        words, at = word_hashes(raw, np.array([0, len(raw)], np.int64))
        sides.append((words, dict(zip(*(x.tolist() for x in next(chaining.seeds(
            words, at, chaining.SEED, chaining.WINDOW_))), strict=True))))
    (wa, sa), (wb, sb) = sides
    both = sorted(set(sa) & set(sb))
    pa_, pb = np.array([sa[h] for h in both], np.int64), np.array([sb[h] for h in both], np.int64)
    for path in chaining.chains(pa_, pb, chaining.SEED, chaining.GAP, chaining.LEAST // 2):
        a0, a1, b0, b1, good = chaining.aligned(wa, wb, pa_[path], pb[path], chaining.SEED)
        if good >= chaining.LEAST and good >= chaining.SAME * max(a1 - a0, b1 - b0):
            return True
    return False


@pytest.mark.parametrize("run", [chunk_recipes.dedup, jaccard_join.classes, suffix_dedup.clean,
                                 chaining.passages, chunk_recipes.keep_first, jaccard_join.keep_first])
def test_empty_tables(spark, run):
    assert run(empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")) \
        .union(spark.createDataFrame([(1000, 1001), (1001, 1001)], "a long, b long"))
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}


def test_joins_of_components_read_settled_edges_once(spark, monkeypatch):
    """Two groups, every node hung on one of a tenth of its id: joins were given all edges in every round."""
    seen = []
    real = common.attach
    monkeypatch.setattr(common, "contract", lambda batches: batches)
    monkeypatch.setattr(common, "attach", lambda rows, *a: seen.append(rows.count()) or real(rows, *a))
    edges = [(g + i, g + i // 10) for g in (0, 10_000) for i in range(1, 1500)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {g + i: g for g in (0, 10_000) for i in range(1500)}
    assert len(got) == 3000 and sum(seen) < 2 * len(edges)


def test_components_of_random_graphs(spark, monkeypatch):
    """Without the first contraction, so that rounds do all; edges may come twice, either way round."""
    import random
    monkeypatch.setattr(common, "contract", lambda batches: batches)
    rnd = random.Random(11)
    edges, top = [], {}
    for g in range(20):
        nodes = rnd.sample(range(100 * g, 100 * g + 100), 30)
        for _ in range(rnd.randint(5, 45)):
            edges.append((rnd.choice(nodes), rnd.choice(nodes[:rnd.choice((2, 30))])))
    edges += [(b, a) for a, b in edges[::7]] + edges[::5]
    for a, b in edges:
        if a != b:
            top[a], top[b] = a, b
    for _ in top:
        for a, b in edges:
            if a != b:
                top[a] = top[b] = min(top[a], top[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in got) == sorted(top.items())


def test_texts_with_a_short_line_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Lines of 19 words hold seeds too near for a chain; a pair is tried only where it shares three of them."""
    import random
    rnd = random.Random(12)
    some = lambda n: [f"w{rnd.randint(0, 999999)}" for _ in range(n)]
    rows, pairs = [], []
    for g in range(6):
        line = some(19)
        rows += [(100 * g + i, " ".join(some(60) + line + some(60))) for i in range(30)]
    # a pair whose run of 60 words holds the last line must still be found
    run = some(20) + line + some(21)
    rows += [(i, " ".join(some(40) + run + some(40))) for i in (900, 901)]
    real = chaining.apart
    monkeypatch.setattr(chaining, "apart", lambda *a: [got := real(*a), pairs.append(got[0].count())][0])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.other_id, r.matched) for r in chaining.passages(df).collect()]
    assert got == [(901, 900, 60)] and pairs[0] < 200


def test_marks_of_seeds_share_a_bit_where_ranges_share_a_seed():
    import numpy as np
    rnd = np.random.default_rng(5)
    h = rnd.integers(0, 2 ** 63, 40, dtype=np.uint64)
    lo, hi = rnd.integers(0, 41, (2, 300))
    got = chaining.marks(h, lo, hi)
    for i in range(300):
        assert (got[i] == 0) == (lo[i] >= hi[i])
        for j in range(i):
            if max(lo[i], lo[j]) < min(hi[i], hi[j]):
                assert got[i] & got[j]
    assert len(chaining.marks(h, lo[:0], hi[:0])) == 0


def test_attach_deals_a_heavy_key_over_tasks(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1500, 7).when(F.col("id") < 2990, F.col("id")).alias("k"), "id")
    groups = materialize(rows.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("m")), "t")
    got = attach(rows, groups, ["k"], "n", F.col("id"))
    assert got.count() == 3000
    assert got.filter("k = 7 and (n <> 1500 or m <> 0)").count() == 0
    assert got.filter("k is null and n is null").count() == 10 and got.filter("n is null").count() == 10


def test_edges_of_a_group_of_copies_are_few(spark, monkeypatch):
    """Every text of a group with many neighbours keeps about one edge, and the
    groups stay linked as they were."""
    monkeypatch.setattr(chaining, "SALT", 4)
    edges = {(i, j) for g in (0, 1000) for i in range(g + 1, g + 200) for j in range(max(g, i - 9), i)}
    found = spark.createDataFrame(sorted(edges), "id long, other_id long").repartition(16)
    few = chaining.forest(found)
    got = [tuple(r) for r in few.collect()]
    assert len(edges) > 3000 and len(got) < 4 * 400
    classes = {r.node: r.component for r in common.components(few).collect()}
    assert classes == {i: g for g in (0, 1000) for i in range(g, g + 200)}


def test_texts_in_buckets_are_joined_without_a_shuffle_of_their_rows(spark):
    """Both rounds of alignment read the texts by id; they are dealt out once."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(i, f"text {i}") for i in range(100)] + [(3, None)], "id long, text string")
        texts = common.materialize_bucketed(df, "id", "test-texts")
        asked = spark.createDataFrame([(i, i) for i in range(0, 100, 3)], "id long, n long")
        joined = texts.join(asked.groupBy("id").agg(F.max("n").alias("n")), "id")
        assert joined.count() == 35
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(id") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    common.drop_bucketed(texts)
    assert not spark.catalog.tableExists(texts._scratch_table)


def test_batches_to_workers_are_bounded_in_bytes(spark):
    """10,000 texts are no bound; a limit that the session names is kept."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def largest() -> int:
        def size(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])
        rows = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text")).mapInArrow(size, "n long")
        return max(r["n"] for r in common.materialize(rows, "sizes").collect())

    before = spark.conf.getAll.get(key)
    try:
        spark.conf.unset(key)
        assert largest() < 5 << 20
        spark.conf.set(key, "1m")
        assert largest() < 2 << 20
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def test_few_keeps_every_row_in_order():
    rows = pa.RecordBatch.from_pydict({"a": list(range(1300))})
    got = list(common.few([rows, rows.slice(0, 0), rows.slice(7, 1)]))
    assert [b.num_rows for b in got] == [512, 512, 276, 1]
    assert [x for b in got for x in b.column(0).to_pylist()] == [*range(1300), 7]
