import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from spreadlab.operators import screen


def _bars(spark, series: dict, start=dt.datetime(2024, 1, 1), skip=None):
    data = []
    for sym, vals in series.items():
        for i, v in enumerate(vals):
            if skip and (sym, i) in skip:
                continue
            ts = start + dt.timedelta(hours=i)
            data.append((sym, ts, float(v), ts.date()))
    return spark.createDataFrame(data, "symbol string, ts timestamp, close double, date date")


def _planted(n=600, seed=7):
    rng = np.random.default_rng(seed)
    b = 100 + np.cumsum(rng.normal(0, 1, n))
    a = 2 * b + rng.normal(0, 1, n)
    c = 100 + np.cumsum(rng.normal(0, 1, n))
    return a, b, c


def test_planted_pairs(spark):
    a, b, c = _planted()
    bars = _bars(spark, {"a": a, "b": b, "c": c})
    out = {(r["sym_a"], r["sym_b"]) for r in screen.screen_pairs(bars, "2024-01-26", days=60).collect()}
    assert ("a", "b") in out
    assert ("a", "c") not in out and ("b", "c") not in out


def test_tau_matches_numpy(spark):
    a, b, c = _planted()
    bars = _bars(spark, {"a": a, "b": b, "c": c})
    st = {(r["sym_a"], r["sym_b"]): r for r in screen.screen_stats(bars, "2024-01-26", 60).collect()}
    r = st[("a", "b")]
    X = np.column_stack([np.ones_like(b), b])
    coef, *_ = np.linalg.lstsq(X, a, rcond=None)
    e = a - X @ coef
    x, y = e[:-1], np.diff(e)
    rho = (x @ y) / (x @ x)
    ssr = ((y - rho * x) ** 2).sum()
    tau = rho / np.sqrt(ssr / (len(y) - 1) / (x @ x))
    assert abs(r["beta"] - coef[1]) < 1e-9 and abs(r["alpha"] - coef[0]) < 1e-7
    assert abs(r["tau"] - tau) < 1e-6
    assert abs(r["corr"] - np.corrcoef(a, b)[0, 1]) < 1e-12


def test_constant_series_and_leading_gap(spark):
    a, b, c = _planted(200)
    const = np.full(200, 5.0)
    late = 100 + np.arange(200) * 0.1
    bars = _bars(spark, {"a": a, "b": b, "k": const, "late": late}, skip={("late", 0), ("late", 1)})
    stats = screen.screen_stats(bars, "2024-01-10", 60)
    syms = {r["sym_a"] for r in stats.collect()} | {r["sym_b"] for r in stats.collect()}
    assert "late" not in syms  # leading gap drops the whole symbol
    gated = {(r["sym_a"], r["sym_b"]) for r in screen.screen_gate(stats).collect()}
    assert not any("k" in p for p in gated)  # constant series never passes


def test_ffill_inner_gap(spark):
    bars = _bars(spark, {"a": [1, 2, 3, 4], "b": [5, 6, 7, 8], "c": [9, 10, 11, 12]}, skip={("b", 2)})
    g = screen.ffill_grid(bars).filter(F.col("symbol") == "b").orderBy("ts").collect()
    assert [r["close"] for r in g] == [5.0, 6.0, 6.0, 8.0]
    assert [r["close_prev"] for r in g] == [None, 5.0, 6.0, 6.0]


def test_not_enough_symbols(spark):
    bars = _bars(spark, {"a": [1, 2], "b": [3, 4]})
    try:
        screen.screen_stats(bars, "2024-01-02", 60)
    except ValueError:
        pass
    else:
        raise AssertionError("expected ValueError")


def test_aic_lag_runs(spark):
    a, b, c = _planted(300)
    bars = _bars(spark, {"a": a, "b": b, "c": c})
    out = {(r["sym_a"], r["sym_b"]): r for r in screen.screen_stats(bars, "2024-01-14", 60, "aic", 0.7).collect()}
    assert out[("a", "b")]["tau"] < -3.3 and out[("a", "b")]["pvalue"] < 0.05


def test_any_number_of_blocks_gives_the_same_pairs(spark):
    rng = np.random.default_rng(9)
    series = {f"s{i:02d}": 100 + np.cumsum(rng.normal(0, 1, 50)) for i in range(12)}
    filled = screen.filled_series(_bars(spark, series))
    got = {}
    for blocks in (1, 4, 16):
        rows = screen.pair_stats(filled, 1, blocks=blocks).collect()
        got[blocks] = {(r["sym_a"], r["sym_b"]): (r["n"], r["corr"], r["beta"], r["tau"]) for r in rows}
        assert len(rows) == len(got[blocks]) == 66 and all(a < b for a, b in got[blocks])
    for pair, want in got[1].items():
        assert np.allclose(got[4][pair], want, atol=1e-9) and np.allclose(got[16][pair], want, atol=1e-9)
        assert abs(want[1] - np.corrcoef(series[pair[0]], series[pair[1]])[0, 1]) < 1e-12


def _twin(e, k):
    """tau of the regression with k lagged differences, by plain least squares."""
    d = np.diff(e)
    x = np.column_stack([e[k:-1]] + [d[k - i: len(d) - i] for i in range(1, k + 1)])
    y = d[k:]
    coef, *_ = np.linalg.lstsq(x, y, rcond=None)
    rest = y - x @ coef
    s2 = rest @ rest / (len(y) - x.shape[1])
    return coef[0] / np.sqrt(s2 * np.linalg.inv(x.T @ x)[0, 0]), len(y), rest @ rest


def test_adf_matches_least_squares():
    rng = np.random.default_rng(4)
    e = np.zeros(300)
    for t in range(1, 300):
        e[t] = 0.8 * e[t - 1] + rng.normal()
    for k in (0, 2, 5):
        lags, nobs, tau = screen.adf_statistic(e, k)
        assert (lags, nobs) == (k, len(e) - 1 - k) and abs(tau - _twin(e, k)[0]) < 1e-9
    top = screen.max_lag(len(e))
    assert top == int(np.ceil(12 * 3 ** 0.25))
    aic = []
    for k in range(top + 1):                      # common sample: the first rows of shorter lags are left out
        _, n, ssr = _twin(e[top - k:], k)
        aic.append(n * (np.log(2 * np.pi * ssr / n) + 1) + 2 * (k + 1))
    lags, _, tau = screen.adf_statistic(e, "aic")
    assert lags == int(np.argmin(aic)) and abs(tau - _twin(e, lags)[0]) < 1e-9
    assert screen.adf_statistic(np.zeros(50), "aic") == (None, None, None)


def test_the_bound_prunes_and_loses_no_pair(spark):
    rng = np.random.default_rng(17)
    walks = [100 + np.cumsum(rng.normal(0, 1, 120)) for _ in range(12)]
    noise = [100 + rng.normal(0, 1, 120) for _ in range(8)]             # nothing in the low coefficients
    series = {f"s{i:02d}": v for i, v in enumerate([*walks, *noise, 3 * noise[0] + rng.normal(0, 0.5, 120), np.full(120, 7.0)])}
    filled = screen.filled_series(_bars(spark, series))
    every = {(r["sym_a"], r["sym_b"]): tuple(r) for r in screen.pair_stats(filled, 0, blocks=3).collect()}
    gated = {(r["sym_a"], r["sym_b"]): tuple(r) for r in screen.pair_stats(filled, 0, 0.7, blocks=3).collect()}
    want = {k for k, r in every.items() if r[3] is not None and abs(r[3]) >= 0.7}
    assert set(gated) == want and ("s12", "s20") in want and len(every) == 22 * 21 // 2
    for k in want:
        assert np.allclose(gated[k][2:], every[k][2:], rtol=0, atol=1e-9)
    share = screen.pruned_share(filled, 0.7, blocks=3).first()
    assert share["pairs"] == len(every) and 0 < share["pruned"] <= len(every) - len(want)
    flat = every[("s00", "s21")]                                          # b constant: no fit
    assert flat[3] is None and flat[6] is None and flat[-1] is None


def test_no_lag_statistic_of_nearly_equal_legs(spark):
    rng = np.random.default_rng(3)
    b = 100 + np.cumsum(rng.normal(0, 1, 400))
    a = 2 * b + rng.normal(0, 1e-4, 400)
    c = 100 + np.cumsum(rng.normal(0, 1, 400))
    got = {(r["sym_a"], r["sym_b"]): r for r in screen.screen_stats(_bars(spark, {"a": a, "b": b, "c": c}), "2024-01-18", 60).collect()}
    for x, y in (("a", "b"), ("a", "c"), ("b", "c")):
        u, v = {"a": a, "b": b, "c": c}[x], {"a": a, "b": b, "c": c}[y]
        design = np.column_stack([np.ones_like(v), v])
        e = u - design @ np.linalg.lstsq(design, u, rcond=None)[0]
        assert abs(got[(x, y)]["tau"] - _twin(e, 0)[0]) < 1e-6 * abs(got[(x, y)]["tau"])


def test_a_batch_of_searches_equals_single_ones():
    rng = np.random.default_rng(8)
    e = np.zeros((7, 160))
    for t in range(2, 160):
        e[:, t] = np.linspace(0.3, 0.95, 7) * e[:, t - 1] - 0.2 * e[:, t - 2] + rng.normal(0, 1, 7)
    e[3] = 0.0
    e[5] = np.tile([1.0, -1.0], 80)                                       # its differences determine its level
    for lags in ("aic", 0, 3):
        k, rows, tau = screen.adf_batch(e, lags, np.ones(7))
        assert np.isnan(k[3]) and np.isnan(rows[3]) and np.isnan(tau[3])
        for i in (0, 1, 2, 4, 6):
            assert (int(k[i]), int(rows[i])) == screen.adf_statistic(e[i], lags, 1.0)[:2]
            assert abs(tau[i] - _twin(e[i], int(k[i]))[0]) < 1e-9
    assert screen.adf_statistic(e[5], 3)[2] is None
    assert screen.adf_statistic(np.array([1.0, 2.0, 1.5, 2.5]), 3) == (3, 0, None)


def test_blocks_follow_the_universe():
    assert [screen.blocks_for(n) for n in (3, 64, 65, 1024, 8192, 8193, 100_000)] == [1, 1, 2, 16, 16, 17, 196]
