import numpy as np
import pytest

from loomwork.llm import rp_forest

SCHEMA = "vec_id long, embedding array<float>, label int, id long, w int"


def clusters(n, dim, seed, spread):
    """Background vectors, and groups whose members lie around the threshold."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for g in range(0, n // 2, 10):
        x[g : g + 10] = x[g] + spread * rng.standard_normal((10, dim))
    return x.astype(np.float32)


def brute(x):
    y = x.astype(np.float64)
    y /= np.sqrt((y * y).sum(1, keepdims=True))
    link = y @ y.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(link, label[None, :], len(x)).min(1))
        if (new == label).all():
            return link.sum(1), label
        label = new


@pytest.mark.parametrize("cell", [64, 4096])
def test_equals_brute_force(spark, monkeypatch, cell):
    """Spread 0.3 puts cosines on both sides of 0.9; small cells deal leaves out."""
    monkeypatch.setattr(rp_forest, "CELL", cell)
    x = clusters(1500, 32, 4, 0.3)
    df = spark.createDataFrame([(i, v.tolist(), 0, 1, 1) for i, v in enumerate(x)], SCHEMA)
    got = rp_forest.embedding_links(df, leaf=100).orderBy("vec_id").collect()
    links, label = brute(x)
    mine = np.array([r["n_links"] for r in got])
    assert (mine <= links).all() and links.sum() > 1000
    assert mine.sum() >= 0.99 * links.sum()
    if (mine == links).all():
        assert [r["component_id"] for r in got] == label.tolist()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]),
        (9, []), (10, [1.0, 0.0, 0.0]), (11, [1e38, 1e38]), (12, [1e-40, 1e-40]), (13, [-1.0, 0.0]), (None, [1.0, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, 0, 1, 1) for i, v in rows], SCHEMA)
    got = rp_forest.embedding_links(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    assert by[1] == [(3, 1, True)] and by[2] == [(3, 1, False)] and by[3] == [(3, 1, False)] * 2
    for i in (4, 5, 6, 7, 8, 9, 10, 13):
        assert by[i] == [(0, i, True)]
    assert by[11] == [(1, 11, True)] and by[12] == [(1, 11, False)]
    assert by[None] == [(0, None, None)]
    assert rp_forest.embedding_links(spark.createDataFrame([], SCHEMA)).count() == 0


def test_spilled_leaves_cover_both_sides():
    x = rp_forest.unit_rows(clusters(500, 16, 2, 0.1))
    tree = rp_forest.fit_tree(x, 3, 1)
    row, path = tree.leaves(x)
    assert set(row) == set(range(500)) and len(row) > 500 and path.max() < 8


def test_doubles_and_repeated_ids(spark):
    """Numbers beyond 32 bits keep their direction; rows of one id stay rows of their own."""
    rows = [(1, [1e300, 0.0]), (2, [1e300, 0.0]), (3, [1e-300, 1e-320]), (4, [0.0, 1e300]), (9, [1.0, 1.0]), (9, [-1.0, 0.2]), (9, [-1.0, 0.2])]
    got = rp_forest.embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    told = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got)
    assert told == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, 4), (9, 0, 9), (9, 1, 9), (9, 1, 9)]


def planted(n, seed):
    """Vectors of 64 numbers, each twentieth with a partner of a cosine on either side of 0.9."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 64))
    m = n // 20
    x[n - m :] = x[:m] + rng.standard_normal((m, 64)) * rng.uniform(0.1, 0.55, (m, 1))
    x = x.astype(np.float32)
    y = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    links = set()
    for i in range(0, n, 2000):
        a, b = np.nonzero(y[i : i + 2000] @ y.T >= 0.9)
        links |= {(int(p) + i, int(q)) for p, q in zip(a, b) if p + i < q}
    return x, links


@pytest.mark.parametrize("leaf", [150, 20])
def test_recall_of_planted_pairs(spark, leaf):
    """64 numbers, trees of 8 and 11 levels; the deeper ones go on below the fitted cuts."""
    x, links = planted(20_000, 11)
    depth = rp_forest.depth_for(len(x), leaf, 0.9, rp_forest.SPILL)
    assert depth == {150: 8, 20: 12}[leaf] and rp_forest.fit_tree(rp_forest.unit_rows(x), depth, 1).depth > np.log2(len(x) / rp_forest.NODE) - 2
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in rp_forest.embedding_links(df, leaf=leaf).collect()}
    assert len(links) > 700
    found = [got[a]["component_id"] == got[b]["component_id"] for a, b in links]
    assert np.mean(found) >= 0.97
    assert sum(r["n_links"] for r in got.values()) <= 2 * len(links)
    linked = {v for pair in links for v in pair}
    assert all(r["n_links"] == 0 and r["component_id"] == v for v, r in got.items() if v not in linked)


def test_sketches_bound_the_angle():
    x = rp_forest.unit_rows(clusters(800, 48, 3, 0.3) ** 3)
    q = rp_forest.sketch_rows(x)
    parts = rp_forest._Comparison(rp_forest.Index(), 0.9, 0, np.zeros(len(x), int), q)
    assert (np.arccos(np.clip((x * parts.unit).sum(1), -1, 1)) <= parts.error + 1e-7).all()
    cosine, sure_pairs, all_pairs = x @ x.T, set(), set()
    for a, b, sure, _ in parts.links():
        all_pairs |= set(zip(a.tolist(), b.tolist()))
        sure_pairs |= set(zip(a[sure].tolist(), b[sure].tolist()))
    want = {(i, j) for i, j in zip(*np.nonzero(cosine >= 0.9)) if i < j}
    assert sure_pairs <= want <= all_pairs


def test_trees_follow_the_depth():
    few, many = (rp_forest.trees_for(d, 0.9, rp_forest.SPILL, 0.93) for d in (6, 20))
    assert rp_forest.trees_for(0, 0.9, rp_forest.SPILL, 0.93) == 1 and 4 <= few < many < 64
    assert rp_forest.depth_for(10**12, rp_forest.LEAF, 0.9, rp_forest.SPILL) > 30
