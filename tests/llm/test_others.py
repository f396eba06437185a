"""Personal data, url filters, mixing, packing, importance, graphs, pipeline."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from indicata.llm import (ann_graph, chunk_recipes, importance, jaccard_join, mixing, packing, pii, queries,
                           url_filters)
from tests.conftest import SF_SMALL
from tests.llm.cases import documents, empty, values
from tools.oracle_check import compare, duck

WORD = re.compile("[^\x20\x09-\x0d]+")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    df, rows = documents(spark)
    return df.cache(), rows


# -- personal data ------------------------------------------------------------

def base_spans(text):
    """The four base kinds by their plain expressions."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 9 <= len(digits(m.group())) <= 15]


PIECES = st.lists(st.sampled_from(["@", ".", "-", "+", " ", "a", "b.c", "1", "25", "4111 1111 1111 1111", "1.2.3.4",
                                   "é", "\n", "+1 (555) 123-4567", "x@y.zz", "(", ")", "256.1.1.1"]), max_size=14)


@settings(max_examples=400, deadline=None)
@given(PIECES)
def test_base_spans_equal_the_plain_expressions(parts):
    text = "".join(parts)
    assert [s[:3] for s in pii.find(text) if s[0] in pii.KINDS[:pii.BASE]] == base_spans(text)


def test_checksums_and_context():
    kinds = lambda text: [(k, round(s, 1)) for k, *_, s in pii.find(text)]
    assert kinds("account GB82 WEST 1234 5698 7654 32") == [("iban", 1.0)]
    assert kinds("GB82 WEST 1234 5698 7654 33") == []
    assert kinds("number 123-45-6789") == [] and kinds("my SSN is 123-45-6789") == [("ssn", 0.7)]
    assert kinds("4111111111111111") == [("card", 0.7)] and kinds("4111111111111112") == []


def test_long_runs_are_scanned_in_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "a@" * 150_000, "+1" * 150_000):
        pii.find(text)


def test_pii_query(spark):
    text = "write to ann@example.org from 10.0.0.1, call +1 (555) 123-4567"
    df = spark.createDataFrame([(1, text, "x"), (2, None, None), (3, "", "")], "doc_id long, text string, spans string")
    found = pii.detect(df)
    got = {r.doc_id: r for r in pii.summary(found).collect()}
    want = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text))
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone, got[1].spans) == (1, 1, 0, 1, want)
    assert got[1].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert got[2].base_sha256 == hashlib.sha256(b"").hexdigest() == got[3].base_sha256
    assert found.filter("doc_id = 1").first().redacted == "write to [EMAIL] from [IP], call [PHONE]"


# -- urls -----------------------------------------------------------------------

def test_url_rules(spark):
    urls = [None, "", "nourl", "http://EXAMPLE.com/en/a", "http://www.example.com/en/a?x=/fr/", "http://a.b.net/es/1",
            "http://net/fr/", "http://notnet/fr/", "http://x.net/english", "ftp://example.com", "http://example.com#/en/",
            "http://x.org/casino", "http://x.org/casinos", "http://ads.x.org", "http://www.example.com/en",
            "http://a://b.com/en/", "http://x.org/é/Casino/日", "http://" + "a" * 20000 + ".com/x"]
    df = spark.createDataFrame([(i, u, "c", "d") for i, u in enumerate(urls)] + [(3, urls[3], "c", "d")],
                               "page_id long, url string, host string, verdict string")
    rules = [*(url_filters.site_rule(*r) for r in url_filters.SITE_RULES),
             *(url_filters.word_rule(w) for w in url_filters.BLOCK_WORDS)]
    got = url_filters.judge(df, rules).collect()
    assert len(got) == len(urls) + 1

    def judged(u):
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate(str.maketrans(url_filters.UPPER, url_filters.LOWER)), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in url_filters.SITE_RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if fits:
            return (host, path, *max(fits)[1:])
        tokens = set(re.split("[^a-z0-9]+", (host + path).lower()))
        return host, path, None, "block" if tokens & set(url_filters.BLOCK_WORDS) else "allow"

    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == judged(urls[r.page_id]), urls[r.page_id]
    assert url_filters.judge(df.limit(0), rules).count() == 0
    names = ["_row", "page", "row_no", "token", "rule_no", "pattern", "site", "s", "w"]
    wide = url_filters.judge(df.withColumns({c: F.lit(c) for c in names}), rules)
    assert wide.columns == ["page_id", "url", *names, "host", "path", "rule", "verdict"]
    assert wide.select(*names).distinct().collect() == [tuple(names)]
    assert sorted(map(repr, wide.drop(*names).collect())) == sorted(map(repr, got))


# -- mixing ---------------------------------------------------------------------

def test_mix_meets_targets(spark):
    rnd = random.Random(5)
    rows = [(i, " w" * rnd.randint(0, 60), rnd.choice(["a", "b", "c", "d", None, "é"]) if i % 3 else "hot")
            for i in range(3000)]
    df = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(df, group=50).collect()
    assert len(got) == 3002
    sizes, targets, taken = defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        sizes[r.source] += r.size
        targets[r.source] = r.target
        taken[r.source] += r.taken
    total = sum(sizes.values())
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free = [s for s in order if targets[s] < 2 * sizes[s] - 1e-6]
    level = {round(targets[s] / weight[s], 4) for s in free}
    assert len(level) == 1 and all(targets[s] <= 2 * sizes[s] + 1e-6 for s in order)
    assert all(abs(taken[s] - targets[s]) <= 60 for s in order)
    again = mixing.mix(df.repartition(2), group=50)
    assert values(again, "doc_id", "source", "copies") == sorted(((r.doc_id, r.source, r.copies) for r in got), key=repr)


@pytest.mark.parametrize("first", [True, False])
def test_mix_lands_over_all_documents_of_a_source(spark, first):
    name = "a" if first else "c"
    rows = [(i, "w " * 10, name) for i in range(300)] + [(900, "w " * 1500, name)]
    rows += [(1000 + i, "w " * 7, "b") for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 10
    assert got.filter("taken > 2 * size").isEmpty()


def test_equal_rows_of_a_mix_spread_over_groups(spark):
    df = spark.range(5000).selectExpr("cast(null as long) doc_id", "'one two' text", "'s' source") \
        .union(spark.range(5000).selectExpr("id", "'one two three' text", "'t' source"))
    got = mixing.mix(df)
    assert got.count() == 10000
    for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 3


def test_units_change_sides_up_to_the_goal():
    for seed in range(200):
        rnd = np.random.default_rng(seed)
        size = np.repeat(np.sort(rnd.choice(np.arange(1, 60), 8, replace=False))[::-1], 2).astype(float)
        up, count = np.tile([False, True], 8), rnd.integers(0, 5, 16)
        off = float(rnd.integers(-150, 150)) + rnd.random()
        flips = mixing.evened(size, up, count, off)
        assert (flips >= 0).all() and (flips <= count).all()
        after = off + (np.where(up, -size, size) * flips).sum()
        assert abs(after) <= abs(off)
        spare = size[(count > flips) & (up == (after > 0))]
        assert not (spare <= abs(after)).any()


def test_stages_stand_columns_of_any_name(spark, docs):
    names = ["_id", "_i", "_t", "_th", "_of", "_sha", "_row", "_hash", "_source", "_turn", "log_weight", "_make"]
    df = docs[0].withColumns({c: F.lit(i) for i, c in enumerate(names)})
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    for stage, plain in ((chunk_recipes.keep_first, True), (jaccard_join.keep_first, True), (mixing.mixed, False),
                         (lambda d: importance.resample(d, labels), True)):
        out = stage(df)
        assert out.columns == df.columns
        assert out.select(*names).distinct().collect() == [tuple(range(len(names)))]
        if plain:
            assert out.count() == stage(docs[0]).count()


def test_mix_of_awkward_documents(docs):
    got = mixing.mix(docs[0]).collect()
    assert len(got) == len(docs[1])
    want = sorted(((r[0], len(WORD.findall(r[1] or ""))) for r in docs[1]), key=repr)
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == want
    rows = mixing.mixed(docs[0])
    assert rows.columns == docs[0].columns and rows.count() == sum(r.copies for r in got)


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(0)
    size, p = rng.integers(1, 500, 300).astype(float), np.full(300, 0.37)
    moved = mixing.flight(size, p, rng.random(300))
    assert moved.sum() == pytest.approx(p.sum()) and size @ moved == pytest.approx(size @ p)
    assert ((moved > 1e-9) & (moved < 1 - 1e-9)).sum() <= 2


# -- packing --------------------------------------------------------------------

def packed_right(pieces, texts):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(VOCABULARY)
    ids = [model.encode(t or "", add_special_tokens=False).ids + [packing.END] for t in texts]
    want = sorted((zlib.crc32(np.array(x[i:i + 2048], "<u4").tobytes()), i, len(x[i:i + 2048]), len(x))
                  for x in ids for i in range(0, len(x), 2048))
    assert sorted((r.ids_crc32, r.start, r.length, r.doc_tokens) for r in pieces) == want
    by = defaultdict(list)
    for r in pieces:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return 1 - sum(r.length for r in pieces) / (2048 * len(by))


def test_pieces_hold_every_id_once(docs):
    packed_right(packing.pack(docs[0], VOCABULARY).collect(), [r[1] for r in docs[1]])


def test_added_tokens_in_a_text_are_one_id(spark):
    texts = ["<|endoftext|>", "one<|endoftext|> two", "<|endoftext|><|endoftext|> \n", "<|endoftext",
             "日本 😀 <|endoftext|> é", "ten words " * 3000 + "<|endoftext|>" + " ten words" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed_right(packing.pack(df, VOCABULARY).collect(), texts)


def test_driver_tables_are_packed_with_little_padding(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r.text for r in df.collect()]
    assert packed_right(packing.pack(df, VOCABULARY).collect(), texts) < 0.005


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=list(" \n\ta1é'sreß.!?…日😀́²\x85\x1c<|>"), max_size=40))
def test_ranks_give_the_tokenizers_ids(text):
    global _ENCODER
    _ENCODER = globals().get("_ENCODER") or packing.Encoder(VOCABULARY)
    assert _ENCODER.fast.encode_ordinary(text) == _ENCODER.model.encode(text, add_special_tokens=False).ids


def test_column_generation_beats_its_start():
    """A histogram whose greedy patterns waste room: columns must be priced in."""
    demand = {44: 100, 33: 100, 23: 200, 12: 100}
    room = 100
    bound = sum(s * n for s, n in demand.items()) / room
    solved = packing.solve(demand, room, gap=1e-9)
    got = {s: sum(p.get(s, 0) * x for p, x in solved) for s in demand}
    assert all(got[s] == pytest.approx(n) for s, n in demand.items())
    assert bound <= sum(x for _, x in solved) + 1e-9 <= 141
    whole = packing.rounded(demand, room)
    assert {s: sum(p.get(s, 0) * x for p, x in whole) for s in demand} == demand
    assert all(sum(s * n for s, n in p.items()) <= room for p, _ in whole)


# -- importance -------------------------------------------------------------------

def test_importance_separates_labelled_documents(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    _, scores = importance.weigh(docs, labels)
    assert scores.count() == docs.count()
    held = scores.join(labels, "doc_id").groupBy("quality", "toxic").agg(
        F.avg(F.col("kept").cast("double")).alias("kept")).collect()
    kept = {(r.quality, r.toxic): r.kept for r in held}
    assert kept[1, 0] > 0.97 and kept[1, 1] < 0.15 and kept[0, 0] < 0.1


def test_importance_of_awkward_documents(spark, docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (5, 0, 0), (6, None, None), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    left = importance.resample(docs[0], labels)
    assert left.columns == docs[0].columns
    none = importance.resample(docs[0], labels.limit(0))
    assert none.count() == len(docs[1])
    assert importance.resample(empty(spark), labels).count() == 0


def test_top_key_is_the_kth(spark):
    rnd = random.Random(9)
    keys = [rnd.gauss(0, 50) for _ in range(5000)]
    df = spark.createDataFrame([(k,) for k in keys], "key double")
    for k in (1, 17, 4999, 5000):
        last = importance._top(df, k)
        assert sum(x >= last for x in keys) == k


# -- neighbours -------------------------------------------------------------------

def test_neighbours_of_driver_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = defaultdict(list)
    for r in ann_graph.nearest(df, shard=128).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hits = 0
    queries_ = [i for i, v in enumerate(ids) if v % 20 == 0]
    for i in queries_:
        score = x @ x[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:20]
        mine = got[ids[i]]
        assert len(mine) == 20 and mine == sorted(mine, key=lambda p: (-p[1], p[0]))
        where = {v: j for j, v in enumerate(ids)}
        assert all(s == pytest.approx(score[where[v]], abs=1e-12) for v, s in mine)
        hits += len({ids[j] for j in order} & {v for v, _ in mine})
    assert hits / (20 * len(queries_)) >= 0.9


@pytest.mark.parametrize("odd", [[1e3], [1e4, 1e-4], [1e22, 1e150, 1e-30]])
def test_neighbours_beside_vectors_of_odd_lengths(spark, odd):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(1500, 16))
    for i, f in enumerate(odd):
        x[7 + i] *= f
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in ann_graph.nearest(df, shard=256).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for i in range(0, 1500, 20):
        score = x @ x[i]
        order = [j for j in np.argsort(-score, kind="stable") if j != i][:20]
        assert len(got[i]) == 20
        hits += len(set(order) & got[i])
    assert hits / (20 * 75) >= 0.95


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, [2.0, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, []),
            (40, [1.0, 2.0, 3.0])] + [(100 + 7 * i, [1.0, 0.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann_graph.nearest(df, shard=4).collect()}
    assert got[0, 1] == (6, 2.0) and got[0, 2] == (7, 1.0) and got[0, 3] == (20, 1.0)
    assert [got[20, k][0] for k in range(1, 5)] == [6, 0, 7, 100]
    assert sum(q == 0 for q, _ in got) == 20 and not any(q == 40 for q, _ in got)
    assert ann_graph.nearest(df.limit(0)).count() == 0


# -- registered queries and the pipeline ---------------------------------------------

@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, key):
    con = duck(SF_SMALL)
    assert compare(spark, SF_SMALL, key, queries.QUERIES[key], queries.ORACLE[key], con)["status"] == "ok"


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES if k.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES


def test_pipeline_stages_take_effect(spark):
    sf, docs = "/root/testdata/sf0.01", None
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, out = docs.columns, {}
    from indicata.llm.common import materialize
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = materialize(stage(spark, docs, sf), f"test-{name}")
        assert name == "pack" or docs.columns == columns
    space = re.compile("[\x20\x09-\x0d]+")
    norm = lambda df: [space.sub(" ", r.text) for r in df.collect()]
    quality, exact = norm(out["quality"]), norm(out["exact"])
    assert sorted(exact) == sorted(set(quality)) and len(exact) < len(quality)
    from tests.llm.test_copies import jaccard
    classes = jaccard([(r.doc_id, r.text) for r in out["exact"].collect()])
    assert sorted(r.doc_id for r in out["near"].collect()) == sorted({c for *_, c in classes})
    mixed = defaultdict(int)
    for r in out["mix"].collect():
        mixed[r.doc_id] += 1
    plan = {r.doc_id: r.copies for r in mixing.mix(out["near"]).collect() if r.copies}
    assert mixed == plan
    assert packed_right(out["pack"].collect(), [r.text for r in out["mix"].collect()]) < 0.02
    assert {n for n, _ in corpus_pipeline.STAGES} == set(out)


def test_plain_texts_are_packed_without_the_tokenizers_library():
    """It is loaded for the first text that needs it; a batch's texts become
    Python strings a few at a time."""
    encoder = packing.Encoder(VOCABULARY)
    assert encoder.ids("plain text") and "model" not in vars(encoder)
    token = next(iter(encoder.model.get_added_tokens_decoder().values())).content
    assert encoder.added.search(f"a {token} b")
    texts = [None, *map(str, range(200)), ""]
    assert list(packing.strings(pa.array(texts))) == texts
