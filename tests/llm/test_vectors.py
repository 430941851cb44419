import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import inverted_index, nn_descent

from .conftest import components

SCHEMA = "vec_id long, embedding array<float>, label int, node string, copies int"


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "n", 2) for i, v in rows], SCHEMA).repartition(3)

    return make


def clustered(n=600, size=16, seed=4):
    """Random vectors, groups of near copies at all distances around the limit, exact copies, and vectors that take no part."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, size))
    for k in range(0, n // 2):
        rows[k] = rows[n - 1 - k % 40] + rng.normal(size=size) * rng.uniform(0, 0.5)
    rows[100:160] = rows[100]
    rows = rows.astype(np.float32)
    rows[200] *= np.float32(1e18)
    out = [(i, r.tolist()) for i, r in enumerate(rows)]
    out[5] = (5, None)
    out[6] = (6, [])
    out[7] = (7, [0.0] * size)
    out[8] = (8, [float("nan")] + [1.0] * (size - 1))
    out[9] = (9, [float("inf")] + [1.0] * (size - 1))
    out[10] = (10, [None] + [1.0] * (size - 1))
    out[11] = (11, [1.0, 2.0])
    return out


def usable(rows, size):
    return {i: np.array(v, dtype=np.float64) for i, v in rows if v and len(v) == size and None not in v and np.isfinite(v).all() and np.any(v)}


def test_links_against_brute_force(table):
    rows = clustered()
    good = usable(rows, 16)
    ids = sorted(good)
    x = np.array([good[i] for i in ids])
    n = np.sqrt((x * x).sum(1))
    links = (x @ x.T / n[:, None] / n[None, :]) >= 0.95
    np.fill_diagonal(links, False)
    names = components(len(ids), zip(*np.nonzero(links), strict=True))
    found = {r["vec_id"]: r for r in inverted_index.near_duplicates(table(rows), inverted_index.Links(block=64)).collect()}
    assert set(found) == {i for i, _ in rows}
    total = sum(found[i]["n_links"] for i in ids)
    assert total <= links.sum() and total >= 0.97 * links.sum()
    assert np.mean([found[i]["component_id"] == ids[names[k]] for k, i in enumerate(ids)]) > 0.97
    for i in set(found) - set(ids):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_copies_and_small_tables(table):
    found = inverted_index.near_duplicates(table([(3, [1, 0]), (1, [1, 0]), (2, [2, 0]), (9, [0, 1]), (None, [1, 0])])).collect()
    assert {tuple(r) for r in found} == {(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (9, 0, 9, True), (None, 0, None, True)}
    assert inverted_index.near_duplicates(table([])).count() == 0
    assert inverted_index.near_duplicates(table([(1, None)])).collect()[0]["n_links"] == 0


def test_blocks_do_not_change_the_counts(table):
    rows = table(clustered(300))
    whole, cut = (sorted(map(tuple, inverted_index.near_duplicates(rows, inverted_index.Links(block=b, recall=1.0)).collect()), key=str) for b in (4096, 16))
    assert whole == cut


def brute_neighbours(good, is_query, most):
    ids = np.array(sorted(good))
    x = np.array([good[i] for i in ids])
    for k, i in enumerate(ids):
        if is_query(i):
            d = np.sqrt(((x - x[k]) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, d)) if j != k][:most]
            yield i, [(int(ids[j]), float(d[j])) for j in order]


def test_neighbours_against_brute_force(table):
    rows = [(i, v) for i, v in clustered(900) if i != 200]
    good = usable(rows, 16)
    found = {}
    for r in nn_descent.search(table(rows), F.col("vec_id") % 10 == 0, how=nn_descent.Descent(degree=12, group=60, centres=64)).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for i, truth in brute_neighbours(good, lambda i: i % 10 == 0, 10):
        own = sorted(found.pop(i))
        assert [r for r, _, _ in own] == list(range(1, 11))
        scores = [(s, v) for _, v, s in own]
        assert scores == sorted(scores) and i not in [v for _, v in scores]
        assert all(s == pytest.approx(np.sqrt(((good[v] - good[i]) ** 2).sum()), rel=1e-12, abs=1e-12) for s, v in scores)
        hits += len({v for _, v in scores} & {j for j, _ in truth})
        total += 10
    assert not found
    assert hits / total >= 0.9


def test_few_candidates(table):
    rows = [(0, [1, 0]), (1, [1, 0]), (2, [0, 1]), (3, [3, 0]), (100, [1, 0]), (4, None), (None, [1, 1])]
    found = sorted(map(tuple, nn_descent.search(table(rows), F.col("vec_id") % 100 == 0).collect()))
    root = 2**0.5
    assert found == [
        (0, 1, 1, 0.0), (0, 2, 100, 0.0), (0, 3, 2, root), (0, 4, 3, 2.0),
        (100, 1, 0, 0.0), (100, 2, 1, 0.0), (100, 3, 2, root), (100, 4, 3, 2.0),
    ]
    assert nn_descent.search(table([]), F.col("vec_id") % 100 == 0).count() == 0
    assert nn_descent.search(table([(0, [1.0])]), F.col("vec_id") % 100 == 0).count() == 0


def near_copies(n, size=64, seed=6):
    """Different vectors at a cosine of 0.9999 to one centre, closer than the step of their bytes."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=size)
    step = rng.normal(size=(n, size)) * np.linalg.norm(centre) / np.sqrt(size) * 0.01414
    return [(i, r.tolist()) for i, r in enumerate((centre + step).astype(np.float32))]


def test_neighbours_in_a_group_of_near_copies(table):
    rows = near_copies(400)
    good = usable(rows, 64)
    found = {}
    for r in nn_descent.search(table(rows), F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = [len(found[i] & {j for j, _ in truth}) / 10 for i, truth in brute_neighbours(good, lambda i: i % 20 == 0, 10)]
    assert np.mean(hits) >= 0.95


def test_recall_is_measured_by_the_true_neighbours(spark):
    """The query itself and nodes that are as near as the true ones by bytes are no hits."""
    truth = {1: list(range(10, 20)), 2: list(range(20, 30))}
    rows = [(1, [1, *range(10, 19)], [0.0] * 10), (2, [2, 50, *range(20, 29)], [0.0] * 11)]
    state = spark.createDataFrame(rows, "q long, seen array<long>, dists array<float>")
    enough = lambda share: nn_descent.measured(truth, 1000, nn_descent.Descent(recall=share))(state, 64)
    assert enough(0.9) and not enough(0.91)


def test_true_neighbours_of_a_sample(spark):
    rows = near_copies(50, 8) + [(100, [9.0] * 8), (101, [9.0] * 7 + [10.0]), (102, [10.0] + [9.0] * 7)]
    distinct = spark.createDataFrame(rows, "node long, embedding array<float>").repartition(3)
    found = nn_descent.exact_top(distinct, [(0, rows[0][1]), (100, rows[50][1])], 8, 2)
    assert sorted(found[0]) == sorted(j for j, _ in next(brute_neighbours(usable(rows, 8), lambda i: i == 0, 2))[1])
    assert sorted(found[100]) == [101, 102]
