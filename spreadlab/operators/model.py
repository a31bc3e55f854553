"""Training-side operators: feature discovery, exact stratified split, scaler
statistics, logistic regression (Newton aggregates), rank-sum AUC and champion pick.

Nothing is collected to the driver except the fitted coefficients (one row).
The split and the AUC need ranks; both are computed with bounded tasks:
rows are cut into ordered buckets, bucket counts are prefix-summed, and ranks
inside a bucket come from a window over (class, bucket) only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.mathfn import linear_score, sigmoid
from .prefix import running_sum

# Feature discovery types and skipped names, test fraction, seed.
NUMERIC_TYPES = {"double", "float", "int", "bigint", "smallint", "tinyint"}
SKIP_COLS = {"label", "ts", "timestamp", "symbol", "pair", "id"}
TEST_FRACTION = 0.2
SEED = 42


def numeric_features(df: DataFrame, label: str = "label", skip=SKIP_COLS) -> list[str]:
    """Numeric columns that are not ids, time or the label (schema only)."""
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() in NUMERIC_TYPES and f.name not in skip and f.name != label]


def cast_features(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """P10 + F1: features as double (the reference uses float32; we keep double
    and cast at the sink), label as int, rows with any null dropped."""
    out = df.withColumns({c: F.col(c).cast("double") for c in features})
    out = out.withColumn(label, F.col(label).cast("int"))
    return out.na.drop("any", subset=features + [label])


def cap_sample(df: DataFrame, cap: int, seed: int = SEED) -> DataFrame:
    """Bernoulli down-sample to about ``cap`` rows (count taken after the
    null drop).  Optional: training runs distributed on the whole split."""
    n = df.count()
    return df if n <= cap else df.sample(False, cap / n, seed)


def split_key(df: DataFrame, seed: int = SEED) -> DataFrame:
    """Portable order key: md5 of (pair | epoch seconds | seed) as hex text."""
    key = F.concat_ws("|", F.col("pair"), F.unix_seconds("ts").cast("string"), F.lit(str(seed)))
    return df.withColumn("_split_key", key).withColumn("_h", F.md5("_split_key"))


def stratified_split(df: DataFrame, label: str = "label", test_fraction: float = TEST_FRACTION,
                     seed: int = SEED, prefix_len: int = 4) -> DataFrame:
    """Exact per-class split.  Within each class rows are ordered by the
    md5 key; the first n_c - ceil(test_fraction * n_c) rows train.

    Ranks are exact without a per-class task: rows are bucketed by the first
    ``prefix_len`` hex digits of the hash (uniform, so buckets are balanced),
    bucket counts are prefix-summed per class, and the rank inside a bucket
    comes from a window over (class, bucket)."""
    h = split_key(df, seed).withColumn("_b", F.substring("_h", 1, prefix_len))
    counts = h.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w_prev = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        label, "_b",
        F.coalesce(F.sum("_cnt").over(w_prev), F.lit(0)).alias("_before"),
        F.sum("_cnt").over(Window.partitionBy(label)).alias("_n_class"))
    w_in = Window.partitionBy(label, "_b").orderBy("_h", "_split_key")
    ranked = h.join(counts, [label, "_b"]).withColumn(
        "_rank", F.col("_before") + F.row_number().over(w_in))
    n_test = F.ceil(F.col("_n_class") * F.lit(float(test_fraction)))
    return ranked.withColumn("is_train", F.col("_rank") <= F.col("_n_class") - n_test).drop(
        "_split_key", "_h", "_b", "_before", "_n_class", "_rank")


def scaler_stats(train: DataFrame, features: list[str]) -> DataFrame:
    """A10: mean and population std per feature (std 0 -> 1), one aggregate pass,
    returned long (feature, mean, scale)."""
    aggs = []
    for c in features:
        aggs += [F.avg(c).alias(f"m__{c}"), F.stddev_pop(c).alias(f"s__{c}")]
    wide = train.agg(*aggs)
    stack = ", ".join(f"'{c}', `m__{c}`, `s__{c}`" for c in features)
    long = wide.selectExpr(f"stack({len(features)}, {stack}) AS (feature, mean, std)")
    return long.select("feature", "mean",
                       F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")).alias("scale"))


def standardize(df: DataFrame, features: list[str], stats: list[tuple[str, float, float]]) -> DataFrame:
    """M4: (x - mean) / scale per feature as column expressions."""
    lut = {f: (m, s) for f, m, s in stats}
    return df.withColumns({c: (F.col(c) - F.lit(lut[c][0])) / F.lit(lut[c][1]) for c in features})


def auc(df: DataFrame, label: str = "label", score: str = "prob", group: str | None = None,
        n_buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC by rank sums with average ranks for ties:

        AUC = sum over distinct scores v of pos(v) * (neg(< v) + neg(v) / 2) / (P * N)

    ``neg(< v)`` is a running total over distinct scores.  The scan cuts them into
    range-partition buckets (sampled boundaries), so buckets hold about equally
    many distinct scores however the scores are spread.  Groups (e.g. candidate
    names) are evaluated in the same pass.  Output: [group,] auc, n_pos, n_neg."""
    g = [group] if group else []
    per = (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
           .groupBy(*g, score)
           .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
                F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg")))
    scanned = running_sum(per, g, [score], {"cum_neg": "neg"}, None, n_buckets)
    contrib = F.col("pos").cast("double") * (
        (F.col("cum_neg") - F.col("neg")).cast("double") + F.col("neg").cast("double") / F.lit(2.0))
    out = scanned.groupBy(*g).agg(F.sum(contrib).alias("_num"), F.sum("pos").alias("n_pos"),
                                  F.sum("neg").alias("n_neg"))
    # one class absent -> AUC undefined -> null (never a division error)
    return out.select(*g, F.try_divide(F.col("_num"), F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
                                       ).alias("auc"), "n_pos", "n_neg")


def fit_logreg(spark: SparkSession, train: DataFrame, features: list[str], label: str = "label",
               max_iter: int = 50, c: float = 1.0, tol: float = 1e-10):
    """M5: L2 logistic regression on standardised features by Newton steps.

    Minimises  0.5 |w|^2 + C * sum(logloss)  with the intercept unpenalised.  A step is one
    aggregate of the loss, its gradient and its Hessian ((d+1)(d+2)/2 sums, combined on the
    map side); the driver solves the (d+1)-square system.  The loss that comes with a step's
    sums is that of the point it starts from: where it rose, the step is halved.  Stops when no
    coefficient moves by ``tol``; an error when ``max_iter`` steps don't get there, without
    rows, or with rows of one class only.  Rows with a
    null or NaN feature or a null label don't take part.
    Returns (coef list, intercept, stats list)."""
    import numpy as np

    whole = F.col(label).isNotNull()
    for f in features:
        whole = whole & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    train = train.filter(whole).select(*features, F.col(label).cast("double").alias(label)).persist()   # spills to disk
    try:
        low, high = train.select(F.min(label), F.max(label)).first()
        if low is None or low == high:
            raise ValueError("empty training set" if low is None else "training rows of one class only")
        stats_rows = scaler_stats(train, features).collect()          # one row per feature
        stats = [(r["feature"], float(r["mean"]), float(r["scale"])) for r in stats_rows]
        z = [f"_z{i}" for i in range(len(features) + 1)]
        scaled = standardize(train, features, stats).select(
            *[F.col(f).alias(n) for f, n in zip(features, z)], F.lit(1.0).alias(z[-1]), F.col(label).alias("_y"))
        cells = [(i, j) for i in range(len(z)) for j in range(i + 1)]
        penalty = np.array([1.0 / c] * len(features) + [0.0])

        def sums(w):
            """Loss, gradient and Hessian at ``w``, divided by C."""
            score = sum((F.lit(float(v)) * F.col(n) for v, n in zip(w, z)), F.lit(0.0))
            at = scaled.withColumn("_s", score).withColumn("_p", sigmoid(F.col("_s")))
            loss = F.greatest(F.col("_s"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_s"))) - F.col("_y") * F.col("_s")
            weight = F.col("_p") * (F.lit(1.0) - F.col("_p"))
            row = at.agg(F.sum(loss), *[F.sum((F.col("_p") - F.col("_y")) * F.col(n)) for n in z],
                         *[F.sum(weight * F.col(z[i]) * F.col(z[j])) for i, j in cells]).first()
            hess = np.diag(penalty)
            for (i, j), v in zip(cells, row[1 + len(z):]):
                hess[i, j] += v
                if i != j:
                    hess[j, i] += v
            return row[0] + 0.5 * float(penalty @ w ** 2), np.array(row[1: 1 + len(z)]) + penalty * w, hess

        w, step, before = np.zeros(len(z)), np.zeros(len(z)), np.inf
        for _ in range(max_iter):
            loss, grad, hess = sums(w)
            if loss > before * (1 + 1e-12) + 1e-300:
                step = step / 2
                w = w - step                                        # back half of the way
                if np.abs(step).max() < tol:
                    break
                continue
            step = -np.linalg.lstsq(hess, grad, rcond=None)[0]
            before, w = loss, w + step
            if np.abs(step).max() < tol:
                break
        else:
            raise ValueError(f"no convergence in {max_iter} steps")
    finally:
        train.unpersist()
    return [float(x) for x in w[:-1]], float(w[-1]), stats


def score_with(df: DataFrame, features: list[str], coef, intercept, stats) -> DataFrame:
    means = [m for _, m, _ in stats]
    scales = [s for _, _, s in stats]
    return df.withColumn("prob", sigmoid(linear_score(features, coef, means, scales, intercept)))


def model_record(spark: SparkSession, name: str, features, coef, intercept, stats, auc_value,
                 label: str = "label") -> DataFrame:
    """K6: the model record as a one-row DataFrame."""
    schema = ("name string, format string, framework string, features array<string>, label string, "
              "coef array<double>, intercept double, scaler struct<mean: array<double>, scale: array<double>>, "
              "metrics struct<auc: double>")
    row = (name, "json_lr", "spark", list(features), label, list(coef), float(intercept),
           ([m for _, m, _ in stats], [s for _, _, s in stats]), (auc_value,))
    return spark.createDataFrame([row], schema)


def best_candidate(candidates: DataFrame) -> DataFrame:
    """Highest AUC, ties by name; a record without name or uri is invalid."""
    valid = candidates.filter(F.col("name").isNotNull() & F.col("uri").isNotNull())
    return valid.orderBy(F.desc("auc"), F.asc("name")).limit(1)


CANDIDATES = "best_model struct<name: string, auc: double, uri: string>, candidates array<struct<name: string, auc: double, uri: string>>"


def save_candidates(candidates: DataFrame, path: str) -> str:
    """K6: the candidates (name, auc, uri) and the best of them as one JSON document.  It holds one
    entry a trained model."""
    each = F.array_sort(F.collect_list(F.struct("name", "auc", "uri")))
    named = F.col("name").isNotNull() & F.col("uri").isNotNull()
    # the order of ``best_candidate``, as one aggregate: highest AUC, then least name
    best = F.min_by(F.when(named, F.struct("name", "auc", "uri")), F.when(named, F.struct(-F.col("auc"), "name")))
    candidates.agg(best.alias("best_model"), each.alias("candidates")).coalesce(1).write.mode("overwrite").json(path)
    return path


def load_candidates(spark: SparkSession, path: str) -> DataFrame:
    """K6: (name, auc, uri, is_best) of a candidates document; an error when it names no best model."""
    doc = spark.read.schema(CANDIDATES).json(path)
    valid = F.col("best_model.name").isNotNull() & F.col("best_model.uri").isNotNull()
    checked = F.when(valid, F.col("candidates")).otherwise(
        F.raise_error(F.lit("the document names no best model")).cast("array<struct<name: string, auc: double, uri: string>>"))
    return (doc.select("best_model", F.explode(checked).alias("c"))
            .select("c.name", "c.auc", "c.uri", ((F.col("c.name") == F.col("best_model.name")) & (F.col("c.uri") == F.col("best_model.uri"))).alias("is_best")))
