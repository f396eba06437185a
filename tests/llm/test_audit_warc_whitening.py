"""Filter audit, WARC bundles and whitening against brute force."""

import hashlib
import io
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from indicata.llm import filter_audit, queries, warc, whitening
from tests.conftest import SF_SMALL
from tests.llm.cases import documents, empty, prose, values
from tools.oracle_check import compare, duck

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    df, rows = documents(spark)
    return df.cache(), rows


@pytest.mark.parametrize("key", ["op11_filter_audit", "op12_warc_bundles"])
def test_query_matches_oracle(spark, key):
    r = compare(spark, SF_SMALL, key, queries.QUERIES[key], queries.ORACLE[key], duck(SF_SMALL))
    assert r["status"] == "ok", r


# -- filter audit ---------------------------------------------------------------

LABELS = [(0, 1, 0), (1, 0, 1), (2, 1, 1), (3, 0, 0), (3, 1, None), (5, None, 1), (500, 1, 0), (None, 1, 1), (9999, 1, 1)]


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = defaultdict(list)
    for i, t, _, source, *_ in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t),
                 "E": i is not None and i > least[t]}
        parts[source or ""].append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out = []
    for part, members in parts.items():
        found, total = {}, defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            alive = members
            for step, f in enumerate(order, 1):
                lost = [m for m in alive if f in m[0]]
                left = [m for m in alive if f not in m[0]]
                fail = [m for m in members if f in m[0]]
                found[order, step] = (len(left), len(lost), len(fail) - len(lost), sum(m[0] == {f} for m in members),
                                      sum(m[1] for m in lost), sum(m[2] for m in lost))
                total[f] += len(lost)
                alive = left
        out += [(part, order, step, *v, total[order[step - 1]]) for (order, step), v in found.items()]
    return sorted(out)


AUDIT = ("part", "filter_order", "step", *filter_audit.COUNTS, "shapley")


def test_audit_equals_brute_force(spark, docs):
    rnd = __import__("random").Random(3)
    more = [(700 + i, t, None, ("s1", "", None)[i % 3], 1, "", 1, 1, 1) for i, t in enumerate(
        ["A B C " * 80, prose(rnd, 300), prose(rnd, 300) + " #", "the same word " * 90 + "$", prose(rnd, 260).upper()] * 2)]
    more += [(None, more[1][1], None, "s1", 1, "", 1, 1, 1)] * 3 + [more[1]] * 3
    rows = docs[1] + more
    df = docs[0].unionByName(spark.createDataFrame(more, docs[0].schema))
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert values(filter_audit.audit(df, labels), *AUDIT) == sorted(brute_audit(rows, LABELS), key=repr)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty(spark), labels).count() == 0


def test_audit_without_labels_and_with_clashing_columns(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(1, "x", "s", 1, 2, 3), (2, "x", "s", 1, 2, 3)],
                               "doc_id long, text string, source string, mask int, part int, salt int")
    got = filter_audit.audit(df, labels)
    assert got.count() == 600 and got.agg({"good_lost": "max"}).first()[0] == 0
    first = got.filter("filter_order = 'EABCD' and step = 1").first()
    assert (first.kept, first.removed, first.unique_fails, first.shapley) == (1, 1, 0, 60)


# -- WARC -------------------------------------------------------------------------

def test_bundles_hold_every_page(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 4000)
    long = "<p>" + "long page é日😀 " * 30
    rows = [(5, "http://a/1", long), (3, "http://a/2", long), (9, None, long), (None, "http://a/3", long),
            (3, "http://a/2", long), (4, "http://a/b\r\nX: y\r\n\r\n", "short"), (6, "http://a/é", "short"),
            (7, "http://a", None), (8, "http://b", ""), (10, "u", "a" * 100), (11, "u", "a" * 100), (12, "u", "a" * 99),
            (13, "u", "a" * 99), (None, None, "b" * 500), (None, None, "b" * 500), (14, "u", "WARC/1.1\r\n\r\n" * 50),
            (15, "big", "x\r\n\r\n" * 300_000)]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows],
                                  "page_id long, url string, html string, row int, digest int").repartition(3)
    folder, index = warc.write_archive(pages, str(tmp_path / "archive"))
    got = warc.read_archive(folder, index).collect()
    count = defaultdict(list)
    for i, url, html in rows:
        count[html or ""].append(i)
    want = []
    for html, ids in count.items():
        ids.sort(key=lambda i: (i is None, i))
        raw = html.encode()
        for k, i in enumerate(ids):
            again = k > 0 and len(raw) >= 100
            want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
                         ids[0] if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) \
        == sorted(want, key=repr)
    by_record = {r.record_id: r for r in got}
    assert len(by_record) == len(rows)
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest and r.refers_to_record is None
        else:
            head = by_record[r.refers_to_record]
            assert head.record_type == "response" and head.payload_digest == r.payload_digest
    assert sorted(r.url for r in got if r.page_id == 4) == ["http://a/b%0D%0AX:%20y%0D%0A%0D%0A"]
    # any Zstandard reader sees one stream of records; frames stand alone
    for path in (tmp_path / "archive").iterdir():
        blob = path.read_bytes()
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(blob), read_across_frames=True).read()
        fields, block, at = warc.parse_record(memoryview(plain), 0)
        assert fields["WARC-Type"] == "warcinfo" and at < len(plain)
    entries = index.collect()
    assert len({(e.bundle, e.frame) for e in entries}) > 2 and any(e.offset > 0 for e in entries)
    some = spark.createDataFrame([(4,), (15,), (15,), (77,)], "page_id long")
    assert sorted((r.page_id, len(r.payload)) for r in warc.fetch(folder, index, some).collect()) == [(4, 5), (15, 1_500_000)]


def test_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text " * 100)], "page_id long, url string, html string")
    data = warc.record_bytes("urn:page:1:0", "u", "0" * 64, 500, b"text " * 100, None, warc.DATE)
    with pytest.raises(ValueError, match="damaged"):
        warc._records(memoryview(data), True)
    folder, index = warc.write_archive(pages, str(tmp_path / "archive"))
    (path,) = (tmp_path / "archive").iterdir()
    path.write_bytes(path.read_bytes()[:-1] + b"x")
    with pytest.raises(Exception, match="no seek table"):
        warc.read_archive(folder, index).collect()


def test_files_that_no_index_names_are_not_read(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text " * 100)], "page_id long, url string, html string")
    folder, index = warc.write_archive(pages, str(tmp_path / "archive"))
    (tmp_path / "archive" / "left-behind.warc.zst").write_bytes(b"half a frame")
    assert warc.read_archive(folder, index).count() == 1


def test_no_page_makes_no_bundle(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    folder, index = warc.write_archive(none, str(tmp_path / "archive"))
    assert warc.read_archive(folder, index).count() == 0 and not list((tmp_path / "archive").iterdir())


# -- whitening ----------------------------------------------------------------------

def agree(a, k=4):
    values, vectors = whitening.components(a, k)
    k = min(k, len(a))
    norm = max(np.abs(a).max(), 1e-300) * len(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], rtol=0, atol=1e-13 * norm)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * norm


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 10_000), st.sampled_from([1e-30, 1.0, 1e30]))
def test_components_of_random_matrices(d, seed, size):
    x = np.random.default_rng(seed).standard_normal((d + 3, d))
    agree(x.T @ x * size)


@pytest.mark.parametrize("a", [
    np.eye(6), np.zeros((5, 5)), np.diag([3.0, 3, 3, 1, 0]), np.diag([1.0, 1 + 1e-15, 2, 2, 2]), np.array([[2.0]]),
    np.array([[1.0, 2], [2, 1]]), np.ones((30, 30)), np.ones((9, 9)) + np.eye(9) * 1e-9,
    np.diag(np.full(20, 2.0)) + np.diag(np.ones(19), 1) + np.diag(np.ones(19), -1), -np.eye(4),
    np.diag([5.0, 5, 5, 5, 5, 5, 1, 1])], ids=str)
def test_components_of_clusters_and_splits(a):
    agree(a)


def test_components_of_a_wide_matrix():
    x = np.random.default_rng(1).standard_normal((900, 300)) * np.geomspace(1, 1e-6, 300)
    agree(x.T @ x)


def brute_whiten(rows, k=4):
    usable = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows
              if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted(set(tuple(x) for _, x in usable))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[c * n - s for c, s in zip(x, sums, strict=True)] for x in fit], float) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {}
    for i, x in usable:
        exact = [n * c - s for c, s in zip(x, sums, strict=True)]
        out.setdefault(i, []).append((sum(c * c for c in exact), np.abs(np.array(exact, float) / n @ u / np.sqrt(e))))
    return n, e / np.trace(v), out


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((120, 7)) * [5, 3, 2, 1, .5, .2, .1] + 40
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(0, base[0].tolist()), (500, base[1].tolist())] * 40
    rows += [(None, base[2].tolist()), (901, None), (902, [1.0, None] + [0.0] * 5), (903, [float("nan")] * 7),
             (904, [float("-inf")] + [0.0] * 6), (905, [-0.0] * 7), (906, [0.0] * 7), (907, [2e3] + [0.0] * 6)]
    odd = [(908, [1.0, 2.0]), (909, [])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + odd],
                               "vec_id long, embedding array<double>, x int, part int").repartition(5)
    got = whitening.whiten(df).collect()
    n, explained, want = brute_whiten(rows)
    seen = defaultdict(dict)
    for r in got:
        assert r.n == n and r.identity_error < 1e-4
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        seen[r.vec_id].setdefault((r.deviation, r.component), []).append(r.whitened)
    assert set(seen) == set(want)
    for i, (deviation, white) in ((i, w[0]) for i, w in want.items()):
        for c in range(1, 5):
            mine = seen[i][deviation if deviation < 2 ** 63 else None, c]
            assert len(mine) == len(want[i])
            assert np.allclose(np.abs(mine), white[c - 1], rtol=1e-6, atol=1e-6)


def test_whitening_signs_are_one_for_all_rows(spark):
    rows = [(i, [float(i), -2.0 * i, 0.5]) for i in range(-10, 11)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    first = sorted((r.vec_id, r.whitened) for r in got if r.component == 1)
    steps = np.diff([w for _, w in first])
    assert (np.sign(steps) == np.sign(steps[0])).all() and abs(first[10][1]) < 1e-9
    flat = [r for r in got if r.component == 3]
    assert {r.whitened for r in flat} == {None} and {r.explained for r in flat} == {0.0}
    assert {r.component for r in got} == {1, 2, 3}


def test_whitening_of_little_or_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).collect()
    assert len(one) == 6 and {(r.n, r.deviation, r.whitened, r.explained) for r in one} == {(1, 0, None, None)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-2 ** 40, 2 ** 40) | st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=4),
       st.integers(1, 10 ** 7), st.lists(st.integers(-2 ** 62, 2 ** 62) | st.integers(-999, 999), min_size=3, max_size=3))
def test_deviations_are_exact(rows, n, sums):
    want = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in rows]
    assert whitening.deviations(np.array(rows, np.int64), n, sums) == [w if w < 2 ** 63 else None for w in want]


def test_sums_of_any_size(spark):
    big = 2 ** 63 - 1
    df = spark.createDataFrame([([big, -5],)] * 9 + [([-big - 1, 7],)] * 2, "x array<long>").repartition(4)
    assert whitening.exact_sums(df, 2) == (11, [9 * big - 2 * (big + 1), -31])


def test_huge_entries_stop_at_the_ends_of_a_long(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 3.0]), (4, [1.7e308, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 8 and {r.n for r in got} == {3}  # rows 1 and 4 are one vector on the grid
    assert all(r.deviation is None for r in got if r.vec_id != 3)
    assert {r.whitened for r in got if r.component == 2} == {None}  # below double precision beside the first
