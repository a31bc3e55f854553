"""Forward-return labels (W5) and the training table.

``lead`` over (pair ORDER BY ts) reuses the pair features' partitioning when
chained in one plan.  The reference labels the last ``horizon`` bars of every
pair 0 (a null comparison falls to ``otherwise``); ``tail="zero"`` keeps that,
``tail="drop"`` removes those rows instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Label horizon in bars and the dataset columns.
HORIZON = 3
DATASET_COLS = ["ts", "pair", "beta", "alpha", "spread", "zscore", "label"]


def label_forward(features: DataFrame, horizon: int = HORIZON, tail: str = "drop",
                  price: str = "a_close", key: str = "pair", chunk_rows: int | None = 2048) -> DataFrame:
    """ret_fwd = (price[t+h] - price[t]) / price[t], label = 1 if ret_fwd > 0 else 0.
    ``lead`` runs chunked (bounded tasks) unless ``chunk_rows`` is None."""
    from .windowing import chunked_windows
    if tail not in ("zero", "drop"):
        raise ValueError("tail must be 'zero' or 'drop'")

    def build(d, w):
        return d.withColumn("_future", F.lead(price, horizon).over(w))

    if "_future" in features.columns:      # computed upstream in the features' own pass
        df = features
    elif chunk_rows:
        df = chunked_windows(features, [key], "ts", 0, horizon, build, chunk_rows=chunk_rows)
    else:
        df = build(features, Window.partitionBy(key).orderBy("ts"))
    if tail == "drop":
        df = df.filter(F.col("_future").isNotNull())
    ret = F.try_divide(F.col("_future") - F.col(price), F.col(price))
    df = df.withColumn("ret_fwd", ret).withColumn(
        "label", F.when(F.col("ret_fwd") > F.lit(0.0), F.lit(1)).otherwise(F.lit(0)).cast("int"))
    return df.drop("_future")


def build_dataset(features: DataFrame, horizon: int = HORIZON, tail: str = "drop",
                  chunk_rows: int | None = 2048) -> DataFrame:
    """ts, pair, beta, alpha, spread, zscore, label with any-null rows dropped."""
    return label_forward(features, horizon, tail, chunk_rows=chunk_rows).select(*DATASET_COLS).na.drop("any")


def dataset_from_bars(bars: DataFrame, pairs: DataFrame, horizon: int = HORIZON, tail: str = "drop",
                      mode: str = "rolling", chunk_rows: int | None = 2048) -> DataFrame:
    """Pair features and forward labels in one windowed pass (one ordinal scan,
    one exchange), then the dataset projection."""
    from .features import pair_features
    feats = pair_features(bars, pairs, mode, chunk_rows=chunk_rows, label_horizon=horizon)
    return build_dataset(feats, horizon, tail, chunk_rows)
