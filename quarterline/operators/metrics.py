"""Whole-split evaluation metrics (A3, A4, M6): grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def linear_logit(weights: dict[str, float], bias: float = 0.0) -> Column:
    """``bias + sum(w * x)`` over the named columns: a linear scoring layer.

    NULL inputs count as 0, as an imputed feature would.
    """
    z = F.lit(float(bias))
    for name, w in weights.items():
        z = z + F.lit(float(w)) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    return z


def accuracy_by_split(df: DataFrame, by: Sequence[str] = ("split",), label: str = "label",
                      prediction: str = "prediction") -> DataFrame:
    """(by..., n, accuracy) with accuracy = 100 * matches / rows (A3)."""
    hit = F.when(F.col(prediction) == F.col(label), F.lit(1.0)).otherwise(F.lit(0.0))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), (F.avg(hit) * 100).alias("accuracy"))


def bce_by_split(df: DataFrame, by: Sequence[str] = ("split",), label: str = "label",
                 logit: str = "logit") -> DataFrame:
    """(by..., n, bce): mean binary cross-entropy on logits, stable form (A4).

    ``max(z, 0) - z*y + log(1 + exp(-|z|))`` equals the logits loss of the
    reference without overflow for large |z|.
    """
    z, y = F.col(logit), F.col(label)
    loss = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("bce"))
