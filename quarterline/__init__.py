"""quarterline: Spark-native quarterly fundamentals features.

Wide financial statements and analyst-estimate snapshots go in; tidy
per-company, per-quarter facts, growth / margin / return / leverage /
liquidity / turnover features, beat-miss labels, and row or sequence
datasets for Spark ML come out.  Every operator is a plain
``DataFrame -> DataFrame`` function whose work runs on Spark.
"""

from quarterline.session import build_session, cluster_conf, shared_dir

__all__ = ["build_session", "cluster_conf", "shared_dir"]
__version__ = "0.1.0"
