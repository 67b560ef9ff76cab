"""Identities the published feature matrices satisfy."""

import pytest
from pyspark.sql import functions as F

from quarterline.operators.growth import quarter_window
from quarterline.plans.queries import features_of, matrix_of, statements_of


@pytest.fixture(scope="module")
def feats(spark, sf_small):
    return features_of(spark, sf_small).toPandas()


def test_pt1_momentum_is_yoy_difference(spark, sf_small):
    f = features_of(spark, sf_small)
    w = quarter_window()
    chk = f.select("momentum", (F.col("yoy_rev") - F.lag("yoy_rev", 4).over(w)).alias("d")).where("momentum is not null")
    worst = chk.select(F.max(F.abs(F.col("momentum") - F.col("d"))).alias("m")).first().m
    assert float(worst) <= 1e-4 + 1e-12


def test_pt2_roe_decomposition(feats):
    f = feats.dropna(subset=["roe", "net_margin", "asset_turn", "de_ratio"])
    f = f[(f.roe.astype(float).abs() > 1)]
    lhs = f.roe.astype(float)
    rhs = f.net_margin.astype(float) * f.asset_turn.astype(float) * (1 + f.de_ratio.astype(float))
    assert ((lhs - rhs).abs() / lhs.abs()).max() < 2e-3


def test_pt3_quarterly_growth_compounds_to_yearly(spark, sf_small):
    f = features_of(spark, sf_small)
    w = quarter_window()
    g = 1 + F.col("qoq_rev") / 100
    prod = g * F.lag(g, 1).over(w) * F.lag(g, 2).over(w) * F.lag(g, 3).over(w)
    chk = f.select(((prod - 1) * 100 - F.col("yoy_rev")).alias("d")).where("d is not null")
    assert float(chk.select(F.max(F.abs("d"))).first()[0]) < 5e-3


def test_pt4_consensus_growth_compounds_to_yearly(spark, sf_small):
    from quarterline.operators.growth import consensus_growth
    from quarterline.plans.queries import estimates_of

    g = consensus_growth(estimates_of(spark, sf_small))
    w = quarter_window()
    step = 1 + F.col("qoq_eps") / 100
    prod = step * F.lag(step, 1).over(w) * F.lag(step, 2).over(w) * F.lag(step, 3).over(w)
    chk = g.select(((prod - 1) * 100 - F.col("yoy_eps")).alias("d"), F.col("yoy_eps")).where("d is not null")
    rel = chk.select(F.max(F.abs("d") / F.greatest(F.lit(1), F.abs("yoy_eps")))).first()[0]
    assert float(rel) < 5e-3


def test_pt5_label_is_sign_of_surprise(spark, sf_small):
    m = matrix_of(spark, sf_small)
    bad = m.where("(eps_surprise > 0 and eps_status != 1.0) or (eps_surprise < 0 and eps_status != 0.0)")
    assert bad.count() == 0
    assert m.where("eps_surprise is not null").count() > 0


def test_pt6_position_differs_from_key_alignment(spark, sf_small):
    from quarterline.sources import fixtures as fx

    key = features_of(spark, sf_small).select("ticker", "fiscal_period", "eps_surprise")
    pos = features_of(spark, sf_small, alignment="position", universe=fx.universe(spark, sf_small)).select(
        "ticker", "fiscal_period", F.col("eps_surprise").alias("pos_surprise"))
    differing = key.join(pos, ["ticker", "fiscal_period"]).where(
        "not (eps_surprise <=> pos_surprise)").count()
    assert differing > 0
    # Same ticker order on both sides -> identical pairing wherever both exist.
    same = features_of(spark, sf_small, alignment="position").select(
        "ticker", "fiscal_period", F.col("eps_surprise").alias("pos_surprise"))
    assert statements_of(spark, sf_small).count() == same.count()


def test_expected_fixture_counts(spark, sf_small):
    f = features_of(spark, sf_small)
    counts = {r.eps_status: r["count"] for r in f.groupBy("eps_status").count().collect()}
    assert counts == {"beat": 212, "miss": 58, None: 10}
    assert f.where("momentum is null").count() == 80
