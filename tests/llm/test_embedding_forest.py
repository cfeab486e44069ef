import numpy as np
import pytest

from telemetra.llm import embedding_forest as ef

SCHEMA = "vec_id long, embedding array<float>, label int, leaf string"


def make(seed=0, dense=120):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.standard_normal(32).astype(np.float32), int(i % 3)) for i in range(300)]
    centre = rng.standard_normal(32)
    rows += [(1000 + i, (centre + 0.05 * rng.standard_normal(32)).astype(np.float32), 1) for i in range(dense)]
    rows += [(2000 + i, (rows[i][1] + 0.08 * rng.standard_normal(32)).astype(np.float32), rows[i][2]) for i in range(60)]
    rows += [(3000 + i, rows[i][1], rows[i][2]) for i in range(10)]          # exact copies
    rows += [(4000 + i, rows[i][1] * np.float32(2), rows[i][2]) for i in range(5)]  # same direction
    return rows


def brute(rows):
    unit = np.array([v.astype(np.float64) / np.linalg.norm(v.astype(np.float64)) for _, v, _ in rows])
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    ids = np.array([r[0] for r in rows])
    root = ef.forest(len(ids), *np.nonzero(np.triu(near)))
    return {int(ids[k]): (int(near[k].sum()), int(ids[root == root[k]].min())) for k in range(len(ids))}


@pytest.mark.parametrize("leaf, tile", [(512, 1024), (16, 32)])
def test_equals_brute_force(spark, monkeypatch, leaf, tile):
    monkeypatch.setattr(ef, "TILE", tile)
    monkeypatch.setattr(ef.fit_forest, "__defaults__", (ef.TREES, leaf))
    rows = make()
    data = spark.createDataFrame([(i, v.tolist(), c, "x") for i, v, c in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id) for r in ef.embedding_forest(data).collect()}
    want = brute(rows)
    assert sum(n for n, _ in got.values()) >= 0.999 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert {i: c for i, (_, c) in got.items()} == {i: c for i, (_, c) in want.items()}


def test_odd_vectors_link_with_nothing(spark):
    one, nan = [1.0, 0.0, 2.0], float("nan")
    rows = [(1, one, 0, ""), (2, one, 0, ""), (3, one, None, ""), (4, None, 0, ""), (5, [0.0] * 3, 0, ""),
            (6, [1.0, None, 2.0], 0, ""), (7, [1.0, nan, 2.0], 0, ""), (8, [1.0, 0.0], 0, ""), (9, one, 1, ""),
            (10, [], 0, ""), (None, one, 0, ""), (2, one, 0, "")]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept)
                 for r in ef.embedding_forest(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0, None, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False)] + [
        (i, 0, i, True) for i in range(3, 11)]
    assert ef.embedding_forest(spark.createDataFrame([], SCHEMA)).count() == 0
