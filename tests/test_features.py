import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from spreadlab.operators import dataset as ds
from spreadlab.operators import features as feat


def _series(spark, sym, closes, start=dt.datetime(2024, 1, 1), step_min=5):
    return [(sym, start + dt.timedelta(minutes=step_min * i), float(c)) for i, c in enumerate(closes)]


def test_short_series(spark):
    data = []
    for n, sym in [(1, "S1"), (2, "S2"), (48, "S48"), (49, "S49")]:
        data += _series(spark, sym, [100 + (i % 7) for i in range(n)])
    df = spark.createDataFrame(data, "symbol string, ts timestamp, close double")
    f = feat.symbol_features(df)
    s1 = f.filter("symbol = 'S1'").first()
    assert s1["ret_1"] is None and s1["ma_5"] == 100.0 and s1["vol_12"] is None and s1["z_48"] == 0.0
    # partial frames are averaged over what exists (min periods 1)
    s2 = f.filter("symbol = 'S2'").orderBy("ts").collect()
    assert s2[1]["ma_48"] == 100.5
    last = f.filter("symbol = 'S49'").orderBy(F.desc("ts")).first()
    closes = np.array([100 + (i % 7) for i in range(49)], dtype=float)
    window = closes[-48:]
    assert abs(last["ma_48"] - window.mean()) < 1e-9
    z = (closes[-1] - window.mean()) / window.std(ddof=1)
    assert abs(last["z_48"] - z) < 1e-9


def test_non_positive_price(spark):
    data = _series(spark, "A", [100.0, 0.0, -1.0, 101.0])
    df = spark.createDataFrame(data, "symbol string, ts timestamp, close double")
    r = [x["ret_1"] for x in feat.symbol_features(df).orderBy("ts").collect()]
    assert r[0] is None and r[1] is None and r[2] is None and r[3] is None


def _pair_feats(spark, n):
    data = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=5 * i), "A||B", 100.0 + i, 1.0, 0.0, 0.1, 0.2)
            for i in range(n)]
    return spark.createDataFrame(data, "ts timestamp, pair string, a_close double, beta double, alpha double, "
                                       "spread double, zscore double")


def test_label_tail(spark):
    for n in (3, 4):
        zero = ds.build_dataset(_pair_feats(spark, n), tail="zero").orderBy("ts").collect()
        drop = ds.build_dataset(_pair_feats(spark, n), tail="drop").collect()
        assert len(zero) == n and all(r["label"] == 0 for r in zero[-3:])
        assert len(drop) == n - 3
        if n == 4:
            assert zero[0]["label"] == 1 and drop[0]["label"] == 1


def test_pair_features_static_matches_numpy(spark):
    rng = np.random.default_rng(3)
    b = 100 + np.cumsum(rng.normal(0, 0.5, 200))
    a = np.exp(0.3 + 0.9 * np.log(b) + rng.normal(0, 0.002, 200))
    start = dt.datetime(2024, 1, 1)
    data = [("A", start + dt.timedelta(minutes=5 * i), float(a[i])) for i in range(200)]
    data += [("B", start + dt.timedelta(minutes=5 * i), float(b[i])) for i in range(200)]
    bars = spark.createDataFrame(data, "symbol string, ts timestamp, close double")
    pairs = spark.createDataFrame([("A", "B")], "sym_a string, sym_b string")
    f = feat.pair_features(bars, pairs, "static").orderBy("ts").collect()
    slope, icpt = np.polyfit(np.log(b), np.log(a), 1)
    assert abs(f[0]["beta"] - slope) < 1e-8 and abs(f[0]["alpha"] - icpt) < 1e-8
    roll = feat.pair_features(bars, pairs, "rolling").orderBy("ts").collect()
    s2, i2 = np.polyfit(np.log(b[100 - 47:101]), np.log(a[100 - 47:101]), 1)
    assert abs(roll[100]["beta"] - s2) < 1e-8 and abs(roll[100]["alpha"] - i2) < 1e-8
    assert roll[0]["beta"] is None and roll[0]["zscore"] == 0.0
    assert math.isclose(f[10]["spread"], math.log(a[10]) - icpt - slope * math.log(b[10]), abs_tol=1e-9)


def test_chunked_windows_equal_unchunked(spark):
    rng = np.random.default_rng(11)
    start = dt.datetime(2024, 1, 1)
    data = []
    for sym, n in (("A", 700), ("B", 650), ("C", 40)):
        px = 100 + np.cumsum(rng.normal(0, 0.5, n))
        # irregular spacing: gaps must not matter, frames are rows
        t = start
        for i in range(n):
            t += dt.timedelta(minutes=5 * int(rng.integers(1, 4)))
            data.append((sym, t, float(px[i])))
    bars = spark.createDataFrame(data, "symbol string, ts timestamp, close double")
    key = ["symbol", "ts"]
    a = feat.symbol_features(bars, chunk_rows=None).toPandas().sort_values(key).reset_index(drop=True)
    b = feat.symbol_features(bars, chunk_rows=60).toPandas().sort_values(key).reset_index(drop=True)
    assert len(a) == len(b) == len(data)
    for c in feat.FEATURE_COLS:
        assert np.allclose(a[c].astype(float), b[c].astype(float), equal_nan=True, rtol=0, atol=1e-12), c
    aligned = spark.createDataFrame([(s, t, c) for s, t, c in data if s != "C"] +
                                    [("D", t, c * 1.5) for s, t, c in data if s == "A"],
                                    "symbol string, ts timestamp, close double")
    pairs = spark.createDataFrame([("A", "D")], "sym_a string, sym_b string")
    k2 = ["pair", "ts"]
    pa = feat.pair_features(aligned, pairs, "rolling", chunk_rows=None).toPandas().sort_values(k2).reset_index(drop=True)
    pb = feat.pair_features(aligned, pairs, "rolling", chunk_rows=100).toPandas().sort_values(k2).reset_index(drop=True)
    for c in ("beta", "alpha", "spread", "zscore"):
        assert np.allclose(pa[c].astype(float), pb[c].astype(float), equal_nan=True, rtol=0, atol=1e-9), c
    la = ds.label_forward(pa.pipe(lambda d: spark.createDataFrame(d)), chunk_rows=None).toPandas().sort_values(k2)
    lb = ds.label_forward(pa.pipe(lambda d: spark.createDataFrame(d)), chunk_rows=5).toPandas().sort_values(k2)
    assert la["label"].tolist() == lb["label"].tolist() and len(la) == len(lb)


def test_chunks_of_uneven_days_carry_every_row_a_frame_reaches(spark):
    from pyspark.sql import Window

    from spreadlab.operators.windowing import chunked_windows
    rng = np.random.default_rng(23)
    data = []
    for key in "abcd":
        day = dt.datetime(2024, 1, 1)
        for _ in range(60):
            day += dt.timedelta(days=int(rng.integers(1, 4)))
            for i in range(int(rng.choice([1, 1, 1, 2, 3, 30]))):       # single rows, then a full day
                data.append((key, day + dt.timedelta(minutes=i), float(rng.normal())))
    data.append((None, dt.datetime(2024, 1, 1), 1.0))
    df = spark.createDataFrame(data, "k string, ts timestamp, v double")

    def build(d, w):
        near = w.rowsBetween(-7, 4)
        return d.withColumns({"n": F.count("v").over(near), "s": F.sum("v").over(near), "p": F.lag("v", 7).over(w), "f": F.lead("v", 4).over(w)})

    def got(d):
        return sorted((r["k"], r["ts"], r["n"], round(r["s"], 9), str(r["p"]), str(r["f"])) for r in d.collect())

    want = got(build(df.filter("k IS NOT NULL"), Window.partitionBy("k").orderBy("ts")))
    for size in (1, 12, 10_000):
        out = chunked_windows(df, ["k"], "ts", 7, 4, build, chunk_rows=size)
        assert out.columns == ["k", "ts", "v", "n", "s", "p", "f"]
        assert got(out) == want
