"""Whitening and embedding near-duplicates against whole matrices."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import embeddings, whitening
from orderloom.llm.common import table
from orderloom.llm.queries import llm_oracles, llm_queries

SF = "/root/testdata/sf0.01"
ODD = [
    (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (None, [1.0, 1e-9, 0.0]), (3, None), (4, []), (5, [None, 1.0, 2.0]),
    (6, [float("nan"), 1.0, 0.0]), (7, [float("inf"), 1.0, 0.0]), (8, [0.0, 0.0, 0.0]), (9, [0.0, 1.0, 0.0]), (10, [1e300, 0.0, 0.0]), (11, [0.0, 1.0]),
]
SCHEMA = "vec_id long, embedding array<double>"


@pytest.fixture(scope="module")
def odd(spark):
    names = ("id", "n", "first", "_vector", "lead", "tile", "n_links", "component_id", "links", "root", "width", "component")
    return spark.createDataFrame(ODD, SCHEMA).select("*", *[F.lit(1).alias(c) for c in names]).cache()


def _rows(frame):
    return sorted(frame.select("vec_id", "embedding").collect(), key=lambda r: r.vec_id)


def _fixed(rows):
    return np.array([[math.floor(1024 * c) + 100_000 for c in r.embedding] for r in rows], dtype=np.int64)


def test_scatter_is_exact_for_every_sign_and_size():
    chance = np.random.default_rng(1)
    for high in (1, 2, 1000, 1 << 31, 1 << 62):
        for rows in (1, 63, 64, 65, 200):
            x = chance.integers(-high, high, (rows, 3))
            sums, cross = whitening.scatter(x)
            big = x.astype(object)
            assert list(sums) == list(big.sum(axis=0)) and (cross == big.T @ big).all()


def test_whitening_equals_numpy(spark):
    rows = _rows(table(spark, SF, "embeddings"))
    x = _fixed(rows)
    n, s = len(x), x.sum(axis=0)
    found = llm_queries()["op12_embedding_whitening"](spark, SF).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in found] == [(r.vec_id, k) for r in rows for k in range(1, 9)]
    assert [r.deviation for r in found[::8]] == ((n * x - s) ** 2).sum(axis=1).tolist() and {r.n for r in found} == {n}
    e, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    e, axes = e[::-1], axes[:, ::-1]
    white = (x - s / n) @ axes[:, :8] / np.sqrt(e[:8])
    ours = np.array([r.whitened for r in found]).reshape(n, 8)
    for k in range(8):
        assert min(abs(ours[:, k] - white[:, k]).max(), abs(ours[:, k] + white[:, k]).max()) < 1e-9
    assert np.allclose([r.explained for r in found[:8]], e[:8] / e.sum(), rtol=1e-9)
    error = np.abs(np.cov(ours.T, bias=True) - np.eye(8)).max()
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error <= 1e-4 and error <= 1e-4


def test_whitening_of_odd_rows(odd):
    found = whitening.whitening(odd.filter("vec_id is null or vec_id <> 10")).collect()
    # Of 1, 2, 2, null, 8 and 9 two dimensions vary; the third component has no variance.
    assert sorted({r.vec_id for r in found}, key=str) == [1, 2, 8, 9, None] and {r.n for r in found} == {6}
    assert {r.whitened is None for r in found if r.component == 3} == {True}
    assert {r.whitened is None for r in found if r.component < 3} == {False} and found[0].identity_error < 1e-9
    huge = whitening.whitening(odd).collect()
    assert {r.deviation for r in huge} == {None} and {r.n for r in huge} == {7}


def test_whitening_of_nothing(spark, odd):
    assert whitening.whitening(odd.limit(0)).count() == 0
    assert whitening.whitening(odd.filter("vec_id = 3")).count() == 0
    one = whitening.whitening(odd.filter("vec_id = 9")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, 0.0)] * 3


def _brute(rows, threshold=0.95):
    """(n_links, component_id) of every row by the whole matrix of cosines."""
    width = max((len(r.embedding) for r in rows if r.embedding), default=0)
    vectors = []
    for r in rows:
        v = [*(r.embedding or []), *[0.0] * (width - len(r.embedding or []))]
        fine = r.embedding is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)
        vectors.append(np.array(v) / max(map(abs, v)) if fine else None)
    near = [[a is not None and b is not None and a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold for b in vectors] for a in vectors]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, row in enumerate(near):
            for j, link in enumerate(row):
                if link and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    out = []
    for i, r in enumerate(rows):
        ids = [o.vec_id for j, o in enumerate(rows) if root[j] == root[i] and o.vec_id is not None]
        out.append((r.vec_id, sum(near[i]) - bool(near[i][i]), min(ids, default=None)))
    return sorted(out, key=str)


def _got(frame):
    rows = frame.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted([(r.vec_id, r.n_links, r.component_id) for r in rows], key=str)


def test_odd_vectors(odd):
    assert _got(embeddings.near_duplicates(odd)) == _brute(odd.collect())
    assert embeddings.near_duplicates(odd.limit(0)).count() == 0
    assert _got(embeddings.near_duplicates(odd.filter("vec_id = 8"))) == [(8, 0, 8)]


@pytest.mark.parametrize("tile", [3, 7, 64])
def test_small_tiles_lose_no_link(spark, tile):
    """Chains, a dense group, copies, and pairs at the threshold exactly, over many tiles."""
    chance = np.random.default_rng(tile)
    base = chance.normal(size=(12, 5))
    rows = [*(base[k % 12] + 0.15 * chance.normal(size=5) for k in range(150)), *[base[0]] * 9]
    rows += [np.array(v, float) for v in ([1, 0, 0, 0, 0], [19, 6, 1, 1, 1], [19, -6, 1, 1, 1], [1, 0, 0, 0, 1e-12])]
    frame = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(rows)], SCHEMA)
    brute = _brute(frame.collect())
    assert any(n > 5 for _, n, _ in brute) and _got(embeddings.near_duplicates(frame, tile=tile)) == brute


def test_threshold_and_table(spark):
    frame = table(spark, SF, "embeddings")
    assert _got(embeddings.near_duplicates(frame, threshold=0.3, tile=100)) == _brute(frame.collect(), 0.3)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({llm_oracles()['op13_embedding_near_dedup']})").fetchall())
    got = llm_queries()["op13_embedding_near_dedup"](spark, SF)
    assert sorted(tuple(r) for r in got.select("vec_id", "n_links", "component_id", "kept").collect()) == want
