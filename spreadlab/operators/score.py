"""Batch scoring (M7) and signal-table alignment (K3).

Scoring is a projection: standardise, dot product, sigmoid, threshold -- plain
column expressions inside whole-stage codegen, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.mathfn import linear_score, score_signal, sigmoid
from ..functions.text import by_alias, first_present, require_columns

# Names that stand for the same column, the preferred one first.
NAMES = {"ts": ("ts", "timestamp"), "symbol": ("symbol", "pair"), "prob": ("prob", "proba")}

# Fixed value: scoring window in days.
DAYS_BACK = 14

# Fixed model for the model-free scoring query (our own constants, stated as
# values): features, coefficients, intercept, scaler mean and scale.
FIXED_MODEL = {
    "name": "fixed_lr",
    "features": ["beta", "alpha", "spread", "zscore"],
    "coef": [0.8, -0.3, -25.0, -0.6],
    "intercept": 0.05,
    "mean": [1.0, 0.0, 0.0, 0.0],
    "scale": [0.3, 0.5, 0.01, 1.0],
}


def with_id_columns(df: DataFrame) -> DataFrame:
    """A ``ts`` timestamp and, where the frame names one, a ``symbol``."""
    ids = {"ts": by_alias(df, "time", NAMES["ts"]).cast("timestamp")}
    if first_present(df, NAMES["symbol"]):
        ids["symbol"] = by_alias(df, "symbol", NAMES["symbol"])
    kept = [c for c in df.columns if c not in ids and c != "timestamp"]
    return df.select(*[c.alias(n) for n, c in ids.items()], *kept)


def score(df: DataFrame, model: dict, keep: list[str] | None = None) -> DataFrame:
    """ts, symbol, [keep...], prob (float), signal (int); missing feature -> prob
    null -> signal 0."""
    require_columns(df, model["features"], f"scoring with {model.get('name', 'the model')}")
    prob = sigmoid(linear_score(list(model["features"]), model["coef"], model["mean"], model["scale"], model["intercept"]))
    carried = [*(n for n in ("ts", "symbol") if n in df.columns), *(keep or [])]
    return df.select(*carried, prob.cast("float").alias("prob"), score_signal(prob).alias("signal"))


def save_model(record: DataFrame, path: str) -> str:
    """K6: the one-row model record as a JSON document."""
    record.coalesce(1).write.mode("overwrite").json(path)
    return path


MODEL_SCHEMA = ("name string, format string, framework string, features array<string>, label string, "
                "coef array<double>, intercept double, scaler struct<mean: array<double>, scale: array<double>>, "
                "metrics struct<auc: double>")


def load_model(spark, path: str) -> dict:
    """K7: read a model record (explicit schema), require format json_lr,
    zero scale -> 1.  One row to the driver: the coefficients become literals."""
    rec = spark.read.schema(MODEL_SCHEMA).json(path).first()
    if rec is None or rec["format"] != "json_lr":
        raise ValueError(f"{path} holds no json_lr model record")
    scale = [1.0 if (x is None or x == 0.0) else float(x) for x in rec["scaler"]["scale"]]
    return {"name": rec["name"], "features": list(rec["features"]), "coef": [float(x) for x in rec["coef"]],
            "intercept": float(rec["intercept"]), "mean": [float(x) for x in rec["scaler"]["mean"]],
            "scale": scale}


def align_to(scored: DataFrame, target_cols: list[str]) -> DataFrame:
    """K3: scored rows under the names that the target table uses."""
    def there(name: str) -> str:
        return next((n for n in NAMES[name] if n in target_cols), name)

    return scored.select("ts", *[F.col(n).alias(there(n)) for n in ("symbol", "prob")], "signal")
