import datetime as dt

import numpy as np
import pytest
import pandas as pd
from pyspark.sql import functions as F

from spreadlab.operators import model as mdl
from spreadlab.operators import score as sc
from spreadlab.operators.prefix import running_sum


def _auc_brute(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    if not pos or not neg:
        return None
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_ties_and_groups(spark):
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 2, 400).tolist()
    scores = np.round(rng.random(400), 1).tolist()  # many ties
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, prob double")
    got = mdl.auc(df, "label", "prob", n_buckets=8).first()
    assert abs(got["auc"] - _auc_brute(labels, scores)) < 1e-12
    grp = spark.createDataFrame([("g1", l, s) for l, s in zip(labels, scores)]
                                + [("g2", l, 0.5) for l in labels], "g string, label int, prob double")
    out = {r["g"]: r["auc"] for r in mdl.auc(grp, "label", "prob", group="g").collect()}
    assert abs(out["g1"] - _auc_brute(labels, scores)) < 1e-12
    assert out["g2"] == 0.5  # all-equal probabilities


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, prob double")
    assert mdl.auc(df).first()["auc"] is None


def test_running_sum_matches_cumsum(spark):
    rng = np.random.default_rng(5)
    n = 500
    keys = rng.choice(["a", "b"], n).tolist()
    order = rng.permutation(n).tolist()
    vals = rng.integers(-50, 50, n).tolist()
    df = spark.createDataFrame(list(zip(keys, order, vals)), "k string, o long, v long")
    out = running_sum(df, ["k"], ["o"], {"cs": "v"}, F.floor(F.col("o") / 37)).toPandas()
    pdf = pd.DataFrame({"k": keys, "o": order, "v": vals}).sort_values(["k", "o"])
    pdf["cs"] = pdf.groupby("k")["v"].cumsum()
    m = out.merge(pdf, on=["k", "o"], suffixes=("", "_ref"))
    assert len(m) == n and (m["cs"] == m["cs_ref"]).all()


def _dataset(spark, n=300, seed=2):
    rng = np.random.default_rng(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        x1, x2 = rng.normal(), rng.normal()
        p = 1 / (1 + np.exp(-(1.5 * x1 - 0.7 * x2)))
        rows.append((t0 + dt.timedelta(minutes=5 * i), "A||B" if i % 2 else "C||D", float(x1), float(x2),
                     float(rng.normal()), float(rng.normal()), int(rng.random() < p)))
    return spark.createDataFrame(rows, "ts timestamp, pair string, beta double, alpha double, spread double, "
                                       "zscore double, label int")


def test_stratified_split_exact(spark):
    df = _dataset(spark)
    sp = mdl.stratified_split(df, prefix_len=1).toPandas()
    for lab, g in sp.groupby("label"):
        n = len(g)
        assert g["is_train"].sum() == n - int(np.ceil(0.2 * n))
    sp2 = mdl.stratified_split(df, prefix_len=3).toPandas()
    key = ["ts", "pair"]
    assert sp.sort_values(key)["is_train"].tolist() == sp2.sort_values(key)["is_train"].tolist()


def test_logreg_matches_newton(spark):
    df = _dataset(spark, 400)
    feats = ["beta", "alpha"]
    coef, b, stats = mdl.fit_logreg(spark, df, feats)
    pdf = df.toPandas()
    X = pdf[feats].to_numpy()
    mu, sd = X.mean(0), X.std(0)
    Z = np.column_stack([(X - mu) / sd, np.ones(len(X))])
    y = pdf["label"].to_numpy()
    w = np.zeros(3)
    reg = np.array([1.0, 1.0, 0.0])  # C = 1, intercept unpenalised
    for _ in range(50):
        p = 1 / (1 + np.exp(-Z @ w))
        g = Z.T @ (p - y) + reg * w
        H = Z.T @ (Z * (p * (1 - p))[:, None]) + np.diag(reg)
        w -= np.linalg.solve(H, g)
    assert np.allclose(coef, w[:2], atol=1e-9) and abs(b - w[2]) < 1e-9


def test_logreg_of_separable_and_unfit_rows(spark):
    far = [(float(i), float(i % 3), int(i >= 50)) for i in range(100)]     # separable: the penalty bounds it
    df = spark.createDataFrame(far, "beta double, alpha double, label int")
    coef, b, stats = mdl.fit_logreg(spark, df, ["beta", "alpha"], c=1000.0)
    scored = mdl.score_with(df, ["beta", "alpha"], coef, b, stats).collect()
    assert all((r["prob"] >= 0.5) == (r["label"] == 1) for r in scored) and np.isfinite(coef).all()
    gaps = df.union(spark.createDataFrame([(float("nan"), 1.0, 1), (None, 1.0, 0), (1.0, 1.0, None)], df.schema))
    again, b2, _ = mdl.fit_logreg(spark, gaps, ["beta", "alpha"], c=1000.0)
    assert np.allclose(coef, again, atol=1e-9) and abs(b - b2) < 1e-9
    for rows in (df.limit(0), df.filter("label = 1")):
        with pytest.raises(ValueError):
            mdl.fit_logreg(spark, rows, ["beta", "alpha"])


def test_score_by_hand_and_nan(spark):
    df = _dataset(spark, 200).withColumnRenamed("pair", "symbol")
    df = df.union(spark.createDataFrame([(dt.datetime(2025, 1, 1), "X", None, 0.0, 0.0, 0.0, 0)], df.schema))
    m = sc.FIXED_MODEL
    got = {(r["ts"], r["symbol"]): r for r in sc.score(df, m).collect()}
    for r in df.collect():
        g = got[(r["ts"], r["symbol"])]
        if r["beta"] is None:
            assert g["prob"] is None and g["signal"] == 0
            continue
        z = m["intercept"] + sum(w * (r[f] - mu) / s for f, w, mu, s in zip(m["features"], m["coef"], m["mean"], m["scale"]))
        p = 1 / (1 + np.exp(-z))
        assert abs(g["prob"] - p) < 1e-6
        assert g["signal"] == (1 if p >= 0.55 else -1 if p <= 0.45 else 0)


def test_auc_buckets_with_an_outlier(spark):
    """One far score must not squeeze the others into one bucket."""
    from pyspark.sql import functions as F
    df = spark.range(20000).select((F.col("id") % 2).cast("int").alias("label"),
                                   F.when(F.col("id") == 0, F.lit(1e12)).otherwise(F.rand(3)).alias("prob"))
    pdf = df.toPandas()
    ranks = pdf["prob"].rank()
    pos = pdf["label"] == 1
    want = (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert abs(mdl.auc(df).first()["auc"] - want) < 1e-12
    sizes = df.repartitionByRange(16, "prob").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.max() < 2 * sizes.mean()


def test_align_and_best_candidate(spark):
    scored = spark.createDataFrame([(dt.datetime(2024, 1, 1), "A", 0.7, 1)],
                                   "ts timestamp, symbol string, prob float, signal int")
    assert sc.align_to(scored, ["ts", "pair", "proba", "signal"]).columns == ["ts", "pair", "proba", "signal"]
    cands = spark.createDataFrame([("m1", 0.6, "u1"), ("m0", 0.6, "u0"), ("m2", 0.5, "u2"), ("bad", 0.9, None)],
                                  "name string, auc double, uri string")
    assert mdl.best_candidate(cands).first()["name"] == "m0"


def test_numeric_features(spark):
    df = _dataset(spark, 5)
    assert mdl.numeric_features(df) == ["beta", "alpha", "spread", "zscore"]


def test_running_sum_range_buckets_with_burst(spark):
    # one key holds most rows, many of them at the same instant (a burst)
    rows_ = [("hot", 5, i, (i % 7) - 3) for i in range(3000)] + [("hot", t, 10_000 + t, 1) for t in range(6, 600)]
    rows_ += [("cold", t, 20_000 + t, 2) for t in range(50)]
    df = spark.createDataFrame(rows_, "k string, t long, id long, v long")
    out = running_sum(df, ["k"], ["t", "id"], {"cs": "v"}, bucket=None, n_buckets=16).toPandas()
    pdf = pd.DataFrame(rows_, columns=["k", "t", "id", "v"]).sort_values(["k", "t", "id"])
    pdf["cs"] = pdf.groupby("k")["v"].cumsum()
    m = out.merge(pdf, on=["k", "t", "id"], suffixes=("", "_ref"))
    assert len(m) == len(rows_) and (m["cs"] == m["cs_ref"]).all()
