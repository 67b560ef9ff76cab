"""Load positions and the position-aligned comparison."""

import random

import pandas as pd
from pyspark.sql import functions as F

from quarterline.operators.align import eps_compare_position, sequential_position


def test_sequential_position_matches_global_row_number(spark):
    rng = random.Random(7)
    rows = [(t, q, rng.random()) for t in rng.sample(range(1000), 300) for q in range(rng.randint(1, 6))]
    df = spark.createDataFrame(rows, "ticker int, q int, v double")
    for asc in (True, False):
        got = sequential_position(df, "ticker", ["ticker"], [F.col("q")], ascending=asc, blocks=7).toPandas()
        pdf = pd.DataFrame(rows, columns=["ticker", "q", "v"]).sort_values(["ticker", "q"], ascending=[asc, True])
        pdf["position"] = range(1, len(pdf) + 1)
        merged = got.merge(pdf, on=["ticker", "q"], suffixes=("", "_exp"))
        assert len(merged) == len(rows)
        assert (merged.position == merged.position_exp).all()


def test_position_alignment_pairs_by_load_order(spark):
    st = spark.createDataFrame([("A", "Q1 2020", 1.0), ("A", "Q2 2020", 2.0), ("B", "Q1 2020", 3.0)],
                               "ticker string, fiscal_period string, eps double")
    es = spark.createDataFrame([("A", "Q1 2020", 10.0), ("B", "Q1 2020", 30.0), ("B", "Q2 2020", 40.0)],
                               "ticker string, fiscal_period string, consensus_eps double")
    universe = spark.createDataFrame([("B", 1), ("A", 2)], "ticker string, list_pos int")   # B listed first
    got = {r.position: (r.ticker, r.est_ticker, r.consensus_eps)
           for r in eps_compare_position(st, es, universe, blocks=2).collect()}
    assert got == {1: ("A", "B", 30.0), 2: ("A", "B", 40.0), 3: ("B", "A", 10.0)}
