"""Window operators against straightforward loops on random small inputs."""

from decimal import Decimal

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarterline.operators import datasets
from quarterline.operators.growth import with_growth
from quarterline.schemas import FEATURE_COLUMNS

histories = st.dictionaries(
    keys=st.sampled_from(["AAA", "BBB", "CCC"]),
    values=st.lists(st.integers(min_value=-50, max_value=50), min_size=0, max_size=12),
    min_size=1,
)


def _periods(n):
    return [f"Q{i % 4 + 1} {2015 + i // 4}" for i in range(n)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(histories, st.integers(min_value=1, max_value=5))
def test_sequence_windows_bruteforce(spark, hist, k):
    rows = []
    for t, vals in hist.items():
        for p, v in zip(_periods(len(vals)), vals, strict=True):
            feats = [Decimal(v)] * len(FEATURE_COLUMNS)
            rows.append((t, p, *feats, float(v > 0), Decimal(v)))
    cols = ", ".join(f"{c} decimal(10,4)" for c in FEATURE_COLUMNS)
    schema = f"ticker string, fiscal_period string, {cols}, eps_status double, eps_surprise decimal(10,4)"
    m = spark.createDataFrame(rows, schema)
    got = sorted((r.ticker, r.target_period, tuple(w.qoq_rev for w in r.window), r.label)
                 for r in datasets.sequence_windows(m, k=k).collect())
    expected = []
    for t, vals in hist.items():
        ps = _periods(len(vals))
        for i in range(len(vals) - k):                       # the reference's loop
            expected.append((t, ps[i + k], tuple(float(v) for v in vals[i:i + k]), float(vals[i + k] > 0)))
    assert got == sorted(expected)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(histories)
def test_growth_bruteforce(spark, hist):
    rows = [(t, p, Decimal(v)) for t, vals in hist.items() for p, v in zip(_periods(len(vals)), vals, strict=True)]
    df = spark.createDataFrame(rows, "ticker string, fiscal_period string, revenue decimal(10,4)")
    got = {(r.ticker, r.fiscal_period): (r.qoq_rev, r.yoy_rev, r.momentum)
           for r in with_growth(df, "revenue", "rev").collect()}
    for t, vals in hist.items():
        s = pd.Series([float(v) for v in vals])

        def pct(cur, prev):
            return None if prev is None or prev == 0 else (cur - prev) / prev * 100

        yoy = [pct(s[i], s[i - 4] if i >= 4 else None) for i in range(len(s))]
        for i, p in enumerate(_periods(len(vals))):
            q, y, mo = got[(t, p)]
            exp_q = pct(s[i], s[i - 1] if i >= 1 else None)
            exp_m = None if i < 8 or yoy[i] is None or yoy[i - 4] is None else yoy[i] - yoy[i - 4]
            for g, e in ((q, exp_q), (y, yoy[i]), (mo, exp_m)):
                assert (g is None) == (e is None)
                if e is not None:
                    assert abs(float(g) - e) < 1e-9
