import math

import pytest
from pyspark.sql import functions as F
from tests.llm.vector_cases import frame, rows

from quarterline.llm import hard_negatives


def brute(data, every=10, low=30, high=90, positives=5, negatives=10):
    best = {}
    for i, v, lab in data:
        if i is None or lab is None or not v or not all(c is not None and math.isfinite(c) for c in v):
            continue
        row = (lab, [math.floor(256 * c) for c in v])
        best[i] = min(best.get(i, row), row)
    out = []
    for a, (lab, q) in best.items():
        if a % every:
            continue
        s = {i: sum(x * y for x, y in zip(q, p)) for i, (_, p) in best.items() if i != a and len(p) == len(q)}
        order = sorted(s, key=lambda i: (-s[i], i))
        for p in [i for i in order if best[i][0] == lab][:positives]:
            fit = [i for i in order if best[i][0] != lab and low * s[p] <= 100 * s[i] <= high * s[p]][:negatives]
            out += [(a, p, k + 1, i, s[p], s[i]) for k, i in enumerate(fit)]
    return sorted(out)


def got(df, every=10, **options):
    return sorted(map(tuple, hard_negatives.mined(df, F.col("vec_id") % every == 0, **options).collect()))


#: Components of 1e30, scaled, have no whole number of 64 bits: such rows raise.
DATA = [x for x in rows() if x[0] != 212]


@pytest.mark.parametrize("block", [16_384, 13])
def test_against_all_pairs(spark, block):
    want = brute(DATA)
    assert len(want) > 100
    assert got(frame(spark, DATA), block=block) == want


def test_ties_and_repeated_rows(spark):
    """Equal scores on both sides of a window's edge, scores of zero, negatives with smaller ids than their positive."""
    data = [(i, [float(i % 3), 1.0, 0.0], i % 4) for i in range(60)] + [(i, [0.0, 0.0, 1.0], 1 - i % 2) for i in range(60, 90)] + [(30, [9.0, 9.0, 9.0], 3), (90, [0.0, 0.0, 0.0], 2)]
    want = brute(data)
    assert got(frame(spark, data), block=7) == want and any(x[4] == 0 for x in want)


def test_label_expression_and_options(spark):
    data = [(i, v, lab) for i, v, lab in DATA if i is not None]
    moved = [(i, v, None if lab is None else (lab + 1) % 3 if i % 7 == 0 else lab) for i, v, lab in data]
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    assert got(frame(spark, data), label=label, positives=2, negatives=3, low=10, high=99) == brute(moved, low=10, high=99, positives=2, negatives=3)


def test_wide_components(spark):
    data = [(i, [v * 1e5 for v in (1.0, i / 7, -i / 3)], i % 2) for i in range(40)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    assert got(df, block=8) == brute(data)
    with pytest.raises(Exception, match="62 bits"):
        got(spark.createDataFrame([(0, [1e300], 0), (1, [1e300], 0)], "vec_id long, embedding array<double>, label int"))


def test_empty_table_and_no_anchor(spark):
    assert got(frame(spark, [])) == []
    assert got(frame(spark, [x for x in DATA if x[0]]), every=1009) == []
    with pytest.raises(ValueError):
        got(frame(spark, []), high=100)
