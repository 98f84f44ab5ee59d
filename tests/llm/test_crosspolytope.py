import numpy as np
import pytest

from barloom.llm import crosspolytope
from tests.llm.conftest import union_find


def brute(rows, least=0.9):
    x = np.array([v for _, v in rows], dtype=np.float64)
    norm = np.linalg.norm(x, axis=1)
    close = x @ x.T >= least * norm[:, None] * norm[None, :]
    np.fill_diagonal(close, False)
    roots = union_find(len(rows), zip(*np.nonzero(close)))
    return {rows[i][0]: (int(close[i].sum()), rows[roots[i]][0]) for i in range(len(rows))}


@pytest.mark.parametrize("tile", [8, 1024])
@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_equal_brute_force_also_in_crowded_cells(spark, monkeypatch, tile, kind):
    random = np.random.default_rng(7)
    hot = random.normal(size=32)
    rows = [hot + random.normal(size=32) * 0.15 for _ in range(60)] + [hot] * 5 + [hot * 2]
    rows += list(random.normal(size=(80, 32)))
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(rows)]
    monkeypatch.setattr(crosspolytope, "tile_units", lambda *a, f=crosspolytope.tile_units, **k: f(*a, tile=tile))
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in crosspolytope.near_duplicate_vectors(df).collect()}
    assert got == brute(rows)


def test_recall_at_the_threshold():
    random = np.random.default_rng(1)
    a = random.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = random.normal(size=(2000, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * b
    (home_a, near_a), (home_b, near_b) = (crosspolytope.cells(x, 6, 2, 2) for x in (a, b))
    meet = (home_a == home_b) | (home_a[:, :, None] == near_b).any(2) | (home_b[:, :, None] == near_a).any(2)
    assert meet.any(1).mean() > 0.97


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(crosspolytope.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(crosspolytope.hadamard(crosspolytope.hadamard(x)), x)


def test_edge_cases(spark):
    schema = "vec_id long, embedding array<float>, label int, node string, weight string, component_id string"
    one, other = [1.0, 2.0, 3.0], [1.0, 2.0]
    rows = [(1, one), (2, one), (2, one), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0])]
    rows += [(7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (9, other), (None, one), (10, [-1.0, -2.0, -3.0])]
    df = spark.createDataFrame([(*r, 0, "x", "x", "x") for r in rows], schema)
    got = crosspolytope.near_duplicate_vectors(df).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert by_id[1] == [(2, 1, True)] and by_id[2] == [(2, 1, False)] * 2
    assert all(by_id[k] == [(0, k, True)] for k in range(3, 11))
    assert by_id[None] == [(0, None, False)]
    assert crosspolytope.near_duplicate_vectors(df.limit(0)).collect() == []
