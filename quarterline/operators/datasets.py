"""Training datasets from the feature matrix.

Row datasets are projections; sequence datasets are one window per ticker
(``collect_list`` of the k previous rows), so the only shuffle is the hash
exchange on ticker and a ticker's history never leaves its partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.functions.periods import period_parts
from quarterline.schemas import FEATURE_COLUMNS

LABEL = "eps_status"


def distinct_tickers(df: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Distinct tickers (A1)."""
    return df.select(ticker).distinct()


def with_period_parts(df: DataFrame, period: str = "fiscal_period") -> DataFrame:
    year, quarter = period_parts(period)
    return df.withColumn("year", year).withColumn("quarter", quarter)


def split_by_year(matrix: DataFrame, splits: dict[str, Sequence[int]], period: str = "fiscal_period") -> DataFrame:
    """Add ``split`` by the year text contained in the period.

    ``splits`` maps split name -> years, e.g. ``{"train": [2021, 2022],
    "val": [2023], "test": [2024]}``.  Rows in no split are left out, as
    the reference writes only the three files.
    """
    expr = None
    for name, years in splits.items():
        cond = F.lit(False)
        for y in years:
            cond = cond | F.col(period).contains(str(y))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return matrix.withColumn("split", expr).where(F.col("split").isNotNull())


def row_dataset(matrix: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = LABEL,
                null_policy: str = "drop", dtype: str = "double") -> DataFrame:
    """Features as doubles (``dtype="float"``: 32 bits, X10) plus a double label (M1).

    ``null_policy="drop"`` keeps rows whose features and label are all
    present (the reference fed NaN to its network); ``"keep"`` keeps all.
    """
    out = matrix.select(
        *[c for c in matrix.columns if c not in features and c != label],
        *[F.col(c).cast(dtype).alias(c) for c in features],
        F.col(label).cast("double").alias("label"),
    )
    if null_policy == "drop":
        out = out.dropna(subset=[*features, "label"])
    elif null_policy != "keep":
        raise ValueError("null_policy must be 'drop' or 'keep'")
    return out


def null_feature_rows(matrix: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Rows with at least one NULL feature and how many are NULL (M7)."""
    n_null = sum((F.col(c).isNull().cast("int") for c in features), F.lit(0))
    return matrix.select("ticker", "fiscal_period", n_null.alias("n_null_features")).where(
        F.col("n_null_features") > 0
    )


def sequence_windows(matrix: DataFrame, k: int = 7, features: Sequence[str] = FEATURE_COLUMNS,
                     label: str = LABEL, carried: Sequence[str] = ()) -> DataFrame:
    """k consecutive quarters of features -> the next quarter's label.

    Output: ticker, target_period, label, window (array of k structs of
    the features, oldest first).  A ticker with <= k rows yields none.
    Rows are ordered by parsed (year, quarter); rows without a ticker are
    left out, and a period that does not parse raises: a window over the
    rows around it would not be of consecutive quarters.  Structs are
    collected (not bare values) so NULL features keep their slot.
    ``carried``: columns of the target row to keep beside.
    """
    df = with_period_parts(matrix.where(F.col("ticker").isNotNull()))
    message = F.concat(F.lit("period does not parse: "), F.coalesce(F.col("fiscal_period"), F.lit("NULL")))
    parsed = F.col("year").isNotNull() & F.col("quarter").isNotNull()
    df = df.where(F.when(parsed, True).otherwise(F.raise_error(message).cast("boolean")))
    w = Window.partitionBy("ticker").orderBy("year", "quarter", "fiscal_period").rowsBetween(-k, -1)
    packed = F.struct(*[F.col(c).cast("double").alias(c) for c in features])
    seq = df.select(
        "ticker",
        F.col("fiscal_period").alias("target_period"),
        "year",
        "quarter",
        F.col(label).cast("double").alias("label"),
        F.collect_list(packed).over(w).alias("window"),
        *carried,
    )
    return seq.where(F.size("window") == k)


def sequence_tail(matrix: DataFrame, k: int = 7) -> DataFrame:
    """The last k rows of each ticker: all that later windows can look back on."""
    df = with_period_parts(matrix.where(F.col("ticker").isNotNull()))
    latest = Window.partitionBy("ticker").orderBy(F.desc("year"), F.desc("quarter"), F.desc("fiscal_period"))
    return df.withColumn("__n", F.row_number().over(latest)).where(F.col("__n") <= k).select(*matrix.columns)


def sequence_increment(tail: DataFrame, new: DataFrame, k: int = 7, features: Sequence[str] = FEATURE_COLUMNS,
                       label: str = LABEL) -> tuple[DataFrame, DataFrame]:
    """(windows whose target is one of the ``new`` rows, the tail after them): what a new quarter adds to a stored
    sequence data set, from the stored tail and the new rows alone.

    ``tail`` is ``sequence_tail`` of the rows before; together with the windows stored so far the result equals
    ``sequence_windows`` of all rows.  A new row that is not later than its ticker's tail would change windows that
    are stored already: it raises.
    """
    marked = tail.withColumn("__new", F.lit(False)).unionByName(new.withColumn("__new", F.lit(True)))
    parts = with_period_parts(marked.where(F.col("ticker").isNotNull()))
    w = Window.partitionBy("ticker").orderBy("year", "quarter", "fiscal_period")
    late = ~F.col("__new") & F.coalesce(F.lag("__new").over(w), F.lit(False)) | F.col("__new") & ~F.coalesce(F.lag("__new").over(w), F.lit(True)) & (
        F.col("fiscal_period").eqNullSafe(F.lag("fiscal_period").over(w)))
    message = F.concat(F.lit("a row of a quarter that is stored already for "), F.col("ticker").cast("string"))
    checked = parts.withColumn("__late", late).where(F.when(F.col("__late"), F.raise_error(message).cast("boolean")).otherwise(True)).drop("__late", "year", "quarter")
    windows = sequence_windows(checked, k, features, label, ["__new"]).where("__new").drop("__new")
    return windows, sequence_tail(checked.drop("__new"), k)


def explode_windows(seqs: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """One row per (sequence, step): step 1 is the oldest quarter of the window."""
    cols = [c for c in seqs.columns if c != "window"]
    out = seqs.select(*cols, F.posexplode("window").alias("pos", "f"))
    return out.select(*cols, (F.col("pos") + 1).alias("step"), *[F.col(f"f.{c}").alias(c) for c in features])


def flatten_windows(seqs: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Window as one array<double> (k x features, oldest first) for ML."""
    flat = F.flatten(F.transform("window", lambda s: F.array(*[s[c] for c in features])))
    return seqs.withColumn("seq_features", flat).drop("window")


def split_by_target(seqs: DataFrame, val_start: tuple[int, int], test_start: tuple[int, int]) -> DataFrame:
    """Split sequences by target quarter (F5): before val_start -> train,
    [val_start, test_start) -> val, from test_start -> test.

    The reference's boundaries are (2023, 3) and (2024, 1).
    """
    def before(y: int, q: int):
        return (F.col("year") < y) | ((F.col("year") == y) & (F.col("quarter") < q))

    split = (
        F.when(before(*val_start), F.lit("train"))
        .when(before(*test_start), F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return seqs.withColumn("split", split)
