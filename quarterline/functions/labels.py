"""Beat/miss labels and logit scoring expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def beat_miss(eps: ColumnOrName, consensus: ColumnOrName, matched: Column | None = None) -> Column:
    """``CASE WHEN eps > consensus THEN 'beat' ELSE 'miss' END``.

    The ELSE branch swallows equality and NULL operands.  When ``matched``
    is given, an actual with no consensus row at all stays NULL (the
    reference only updates rows its join matched).
    """
    label = F.when(_col(eps) > _col(consensus), F.lit("beat")).otherwise(F.lit("miss"))
    if matched is not None:
        label = F.when(matched, label)
    return label


def final_label(status: ColumnOrName, surprise: ColumnOrName) -> Column:
    """Numeric training label: sign of the surprise, else the text label.

    surprise > 0 -> 1.0, surprise < 0 -> 0.0; otherwise (zero or NULL
    surprise) 'beat' -> 1.0 and 'miss' -> 0.0, NULL stays NULL.  Also
    accepts a status that is already numeric text ('1.0' / '0.0').
    """
    s = _col(surprise)
    st = _col(status).cast("string")
    text_value = (
        F.when(F.lower(st) == "beat", F.lit(1.0))
        .when(F.lower(st) == "miss", F.lit(0.0))
        .otherwise(st.try_cast("double"))
    )
    return F.when(s > 0, F.lit(1.0)).when(s < 0, F.lit(0.0)).otherwise(text_value).cast("double")


def sigmoid(logit: ColumnOrName) -> Column:
    """Logistic function ``1 / (1 + exp(-z))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(logit)))


def predict_from_logit(logit: ColumnOrName) -> Column:
    """Hard 0/1 label: half-to-even rounding of the sigmoid (0.5 -> 0)."""
    return F.bround(sigmoid(logit), 0)
