import numpy as np
import pytest
from tests.llm.vector_cases import frame, rows, unit

from quarterline.llm import vector_dedup


def usable(i, v, lab):
    return i is not None and lab is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)


def brute(data, least=0.93):
    n = len(data)
    ok = [usable(*x) for x in data]
    links = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and data[i][2] == data[j][2] and len(data[i][1]) == len(data[j][1]):
                x, y = (np.array(data[k][1], float) / max(map(abs, data[k][1])) for k in (i, j))
                links[i, j] = x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least
    parent = {data[i][0]: data[i][0] for i in range(n) if ok[i]}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in zip(*np.nonzero(links)):
        a, b = sorted((root(data[i][0]), root(data[j][0])))
        parent[b] = a
    out = []
    for i, (vec, _, _) in enumerate(data):
        c = root(vec) if ok[i] else vec
        out.append((vec, int(links[i].sum()), c, vec == c))
    return sorted(out, key=str)


def got(df, **options):
    return sorted(map(tuple, vector_dedup.near_duplicates(df, **options).collect()), key=str)


def test_against_all_pairs(spark):
    data = rows()
    assert got(frame(spark, data)) == brute(data)


@pytest.mark.parametrize("least,width,grid,part", [(0.5, 4, 1, 7), (0.99, 5, 3, 16), (0.0, 24, 2, 9)])
def test_parts_of_cells_and_other_thresholds(spark, least, width, grid, part):
    """Cells far larger than a part: every pair of parts meets once."""
    data = rows(seed=9)
    assert got(frame(spark, data), least=least, width=width, grid=grid, part=part) == brute(data, least)


def test_pairs_at_the_threshold_are_decided_in_double_precision(spark):
    r = np.random.default_rng(1)
    data = []
    for i in range(60):  # angles within the rounding error of the threshold
        x = unit(r, 32)
        y = unit(r, 32)
        y -= (x @ y) * x
        y /= np.linalg.norm(y)
        c = 0.93 + (i - 29.5) * 3e-7
        data += [(2 * i, x.tolist(), i), (2 * i + 1, (c * x + np.sqrt(1 - c * c) * y).tolist(), i)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    want = brute(data)
    assert got(df) == want and {n for _, n, _, _ in want} == {0, 1}


def test_large_group_of_near_copies(spark):
    r = np.random.default_rng(2)
    base = unit(r, 64)
    data = [(i, (base + 0.01 * r.standard_normal(64)).tolist(), 0) for i in range(400)] + [(1000 + i, base.tolist(), 0) for i in range(300)]
    out = vector_dedup.near_duplicates(frame(spark, data), part=64).collect()
    assert all(x["n_links"] == 699 and x["component_id"] == 0 for x in out) and len(out) == 700


def test_empty_table(spark):
    assert got(frame(spark, [])) == []


def test_only_unusable_rows(spark):
    assert got(frame(spark, [(1, None, 0), (None, [1.0], 0), (2, [0.0], None)])) == sorted([(1, 0, 1, True), (None, 0, None, True), (2, 0, 2, True)], key=str)
