"""Model keys: rows produced, probabilities valid, deterministic under a seed."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarterline.operators import metrics


def test_mlp_predictions_deterministic(spark, sf_small):
    from quarterline.operators import datasets, models
    from quarterline.plans.queries import YEAR_SPLITS, matrix_of

    data = datasets.row_dataset(datasets.split_by_year(matrix_of(spark, sf_small), YEAR_SPLITS)).orderBy("ticker", "fiscal_period").coalesce(1)

    def scored():
        model = models.fit_row_classifier(data.where("split = 'train'"), max_iter=50)
        return models.score(model, data.where("split <> 'train'"), ["ticker", "fiscal_period", "split", "label"])

    a = scored()
    rows = a.collect()
    assert len(rows) > 0
    assert all(0.0 <= r.probability <= 1.0 and r.prediction in (0.0, 1.0) for r in rows)
    key = lambda r: (r.ticker, r.fiscal_period)
    assert [r.prediction for r in sorted(rows, key=key)] == [r.prediction for r in sorted(scored().collect(), key=key)]
    checked = entry.queries()["mlp_predictions"](spark, sf_small).collect()
    assert checked and all(r.in_range and r.consistent for r in checked)
    acc = metrics.accuracy_by_split(a).collect()
    assert {r.split for r in acc} <= {"val", "test"}


def test_parameter_count(spark, sf_small):
    from quarterline.operators import datasets, models
    from quarterline.plans.queries import YEAR_SPLITS, matrix_of

    rows = datasets.row_dataset(datasets.split_by_year(matrix_of(spark, sf_small), YEAR_SPLITS))
    model = models.fit_row_classifier(rows, max_iter=5)
    assert models.parameter_count(model) == 13 * 16 + 16 + 16 * 8 + 8 + 8 * 2 + 2


def test_sequence_predictions(spark, sf_small):
    rows = entry.queries()["sequence_predictions"](spark, sf_small).collect()
    assert len(rows) > 0 and {r.split for r in rows} <= {"val", "test"}


def test_bce_matches_definition(spark):
    df = spark.createDataFrame([("a", 2.0, 1.0), ("a", -3.0, 0.0), ("a", 0.0, 1.0)], "split string, logit double, label double")
    got = metrics.bce_by_split(df).first().bce
    import math
    exp = sum(-(y * math.log(1 / (1 + math.exp(-z))) + (1 - y) * math.log(1 - 1 / (1 + math.exp(-z))))
              for z, y in [(2.0, 1.0), (-3.0, 0.0), (0.0, 1.0)]) / 3
    assert abs(got - exp) < 1e-12
    assert df.select(F.lit(1)).count() == 3


def test_stored_models_are_judged_by_their_own_scores(spark, tmp_path):
    """A learnable set: the stored model, read back, beats the majority on rows it has not seen, and says the same."""
    from pyspark.ml import PipelineModel

    from quarterline.operators import models
    from quarterline.schemas import FEATURE_COLUMNS

    noise = [F.rand(10 + i).alias(c) for i, c in enumerate(FEATURE_COLUMNS)]
    rows = spark.range(0, 900, numPartitions=1).select("id", *noise)
    rows = rows.withColumn("label", (F.col(FEATURE_COLUMNS[0]) + F.col(FEATURE_COLUMNS[3]) > 0.8).cast("double"))
    rows = rows.withColumn("split", F.when(F.col("id") % 3 == 0, "test").otherwise("train"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    model = models.fit_row_classifier(rows.where("split = 'train'"), max_iter=60)
    models.store_model(model, rows, str(tmp_path / "m"))
    keep = ["id", "split", "label"]
    fresh = models.stored_scores(spark.newSession(), str(tmp_path / "m"), keep)
    assert sorted(map(tuple, fresh.collect())) == sorted(map(tuple, models.score(model, rows, keep).collect()))
    scored = fresh.withColumn("logit", models.probability_logit())
    accuracy = {r.split: r.accuracy for r in metrics.accuracy_by_split(scored).collect()}
    bce = {r.split: r.bce for r in metrics.bce_by_split(scored).collect()}
    share = rows.where("split = 'test'").agg(F.avg("label")).first()[0]
    floor = 100 * max(share, 1 - share)
    assert accuracy["test"] > floor + 10 and bce["test"] < 0.4
    assert models.parameter_count(PipelineModel.load(str(tmp_path / "m" / "model"))) == 378


def test_model_metrics_per_split(spark, sf_small):
    rows = entry.queries()["model_metrics"](spark, sf_small).collect()
    assert {r.model for r in rows} == {"row", "sequence"} and {r.split for r in rows} <= {"train", "val", "test"}
    assert all(0 <= r.accuracy <= 100 and r.bce >= 0 and 50 <= r.majority <= 100 for r in rows)
    assert all(r.accuracy >= r.majority for r in rows if r.split == "train")
