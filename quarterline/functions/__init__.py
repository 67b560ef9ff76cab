"""Column-level helpers (built-in Spark expressions only, no UDFs)."""

from quarterline.functions.labels import beat_miss, final_label, predict_from_logit, sigmoid
from quarterline.functions.numeric import STORE_TYPE, pct_change, ratio, to_store
from quarterline.functions.periods import (
    period_order,
    period_parts,
    period_type,
    quarter_label,
    quarter_text,
    year_text,
)

__all__ = [
    "STORE_TYPE",
    "beat_miss",
    "final_label",
    "pct_change",
    "period_order",
    "period_parts",
    "period_type",
    "predict_from_logit",
    "quarter_label",
    "quarter_text",
    "ratio",
    "sigmoid",
    "to_store",
    "year_text",
]
