"""Pair screening: dense price series, all-pairs correlation and the Engle-Granger
cointegration test.

Plan
----
* ``filled_series``: one row per symbol with its forward-filled closes on the
  grid of all bar times of the window.  A row's length is the number of distinct
  bar times (60 days of hourly bars: 1,440), whatever the tick volume; the grid
  itself is one small array, a scalar subquery of the plan.
* ``pair_stats``: symbols are dealt by hash to blocks, every unordered pair of
  blocks is a cell, and a cell's two sides meet in one task, where numpy matrix
  products over the centred series give every moment of all its pairs.  The number
  of blocks follows the counted universe (``blocks_for``), so a cell holds at most
  about 2 x ``BLOCK_SERIES`` series; no row per (pair, time) ever exists.
* With a correlation gate most pairs are excluded before their products are formed:
  ``COEFS`` cosine coefficients of a unit series and the length of what they leave
  out bound every correlation from above (``corr_bound``).
* The test runs in the same cell on the pairs past the gate: with no lag from three
  inner products of a pair, with lags from Gram matrices of all pairs of a symbol at
  once, whose triangular factor holds the residual sums of every lag order.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.mathfn import SCREEN_MIN_ABS_CORR, SCREEN_P_MAX, eg_pvalue, eg_tau_threshold

# Fixed value: screening window in days.
DAYS_WINDOW = 60
BLOCK_SERIES = 512       # series of one side of a cell
COEFS = 24               # cosine coefficients of the correlation bound
CHUNK_VALUES = 1 << 22   # doubles of one batch of lagged designs (32 MB)


def blocks_for(symbols: int) -> int:
    """Blocks of a universe: 64 series a block up to 16 blocks, then fuller blocks,
    then as many blocks of ``BLOCK_SERIES`` as it takes."""
    return max(1, min(16, -(-symbols // 64)), -(-symbols // BLOCK_SERIES))


def recent(df: DataFrame, as_of: str, days: int = DAYS_WINDOW, date_col: str = "date") -> DataFrame:
    """rows with date >= as_of - days (pushed to the parquet scan when stored)."""
    return df.filter(F.col(date_col) >= F.date_sub(F.lit(as_of).cast("date"), days))


def recent_ts(df: DataFrame, as_of: str, days: int, ts_col: str = "ts", date_col: str = "date") -> DataFrame:
    """rows with ts >= as_of - days (timestamp arithmetic).  A table partitioned
    by date is cut by its date first, so older partitions aren't opened."""
    if date_col in df.columns:
        df = recent(df, as_of, days, date_col)
    start = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return df.filter(F.col(ts_col) >= start)


def symbol_list(bars: DataFrame) -> list[str]:
    """Distinct symbols, sorted: the columns of the wide close matrix."""
    return [r[0] for r in bars.select("symbol").distinct().orderBy("symbol").collect()]


def pivot_close(bars: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    """A1: wide close matrix, one row per ts, one column per symbol.  Passing the
    symbol list skips Spark's value-discovery job."""
    symbols = symbols if symbols is not None else symbol_list(bars)
    return (bars.select("ts", "symbol", "close")
            .groupBy("ts").pivot("symbol", symbols).agg(F.max("close")))


def filled_series(bars: DataFrame) -> DataFrame:
    """J8 + W7: (symbol, grid array<timestamp>, closes array<double>): every symbol on
    every bar time of the frame, forward filled; a symbol without a close at the
    first bar time is left out whole."""
    grid = bars.select(F.array_sort(F.collect_set("ts"))).scalar()
    own = (bars.where(F.col("close").isNotNull()).groupBy("symbol", "ts").agg(F.max("close").alias("close"))
           .groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("ts", "close"))).alias("own"))
           .select("symbol", F.col("own.ts").alias("at"), F.col("own.close").alias("close"), grid.alias("grid")))

    def fill(batches):
        for b in batches:
            for i in range(b.num_rows):
                at, grid_ = (b.column(c)[i].values.cast(pa.int64()).to_numpy() for c in (1, 3))
                if not len(at) or at[0] > grid_[0]:
                    continue
                last = np.searchsorted(at, grid_, side="right") - 1
                closes = b.column(2)[i].values.to_numpy(zero_copy_only=False)[last]
                yield pa.record_batch([b.column(0).slice(i, 1), b.column(3).slice(i, 1), pa.array([closes])],
                                      names=["symbol", "grid", "closes"])

    return own.mapInArrow(fill, "symbol string, grid array<timestamp>, closes array<double>")


def ffill_grid(bars: DataFrame) -> DataFrame:
    """J8 + W7 in long form: ts, symbol, close and the close before it."""
    series = filled_series(bars)
    before = F.concat(F.array(F.lit(None).cast("double")), F.slice("closes", 1, F.size("closes") - 1))
    return (series.select("symbol", F.explode(F.arrays_zip(F.col("grid").alias("ts"), F.col("closes").alias("close"),
                                                           before.alias("close_prev"))).alias("x"))
            .select("x.ts", "symbol", "x.close", "x.close_prev"))


STATS_SCHEMA = ("sym_a string, sym_b string, n long, corr double, std_a double, std_b double, beta double, "
                "alpha double, r2 double, lags int, nobs long, tau double")


def pair_stats(series: DataFrame, lags: int | str = 0, min_abs_corr: float | None = None,
               blocks: int = 16) -> DataFrame:
    """Per pair (a < b): n, corr, std, hedge fit a = alpha + beta b, and the residual
    unit-root statistic with ``lags`` lagged differences (a number, or "aic" for the
    search).  Pairs below ``min_abs_corr`` are left out when it is given."""
    out_cols = [c.split() for c in STATS_SCHEMA.split(", ")]

    def cell(t: pa.Table) -> pa.Table:
        found = [r for r in cell_pairs(t) if len(r["sym_a"])]
        kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "int": pa.int32()}
        return pa.table({c: pa.concat_arrays([pa.array(r[c], kinds[k], from_pandas=True) for r in found] or [pa.array([], kinds[k])])
                         for c, k in out_cols})

    def cell_pairs(t: pa.Table):
        own, x, y, names, values = _sides(t)
        legs = Legs(values)
        left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
        for i in left:                                      # a row of the cell at a time: memory stays linear
            others = right[names[right] > names[i]] if x == y else right
            if min_abs_corr is not None and len(others):
                others = others[corr_bound(legs, i, others) >= min_abs_corr - 1e-9]
            if len(others):
                yield pair_rows(names, legs, i, others, lags, min_abs_corr)

    stats = _cells(series, blocks).groupBy("x", "y").applyInArrow(cell, STATS_SCHEMA)
    return stats.withColumn("pvalue", eg_pvalue(F.col("tau")))


def pruned_share(series: DataFrame, min_abs_corr: float = SCREEN_MIN_ABS_CORR, blocks: int = 16) -> DataFrame:
    """(pairs, pruned): all pairs of the universe, and those that the bound alone
    keeps from the exact test of ``min_abs_corr``."""
    def cell(t: pa.Table) -> pa.Table:
        own, x, y, names, values = _sides(t)
        legs = Legs(values)
        left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
        n = cut = 0
        for i in left:
            others = right[names[right] > names[i]] if x == y else right
            n += len(others)
            cut += int((corr_bound(legs, i, others) < min_abs_corr - 1e-9).sum())
        return pa.table({"pairs": pa.array([n], pa.int64()), "pruned": pa.array([cut], pa.int64())})

    each = _cells(series, blocks).groupBy("x", "y").applyInArrow(cell, "pairs long, pruned long")
    return each.agg(F.sum("pairs").alias("pairs"), F.sum("pruned").alias("pruned"))


def _cells(series: DataFrame, blocks: int) -> DataFrame:
    own = F.expr(f"CAST(pmod(xxhash64(symbol), {blocks}) AS INT)")
    return (series.select("symbol", "closes", own.alias("own"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            .select(F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "symbol", "closes"))


def _sides(t: pa.Table):
    names = np.array(t.column("symbol").to_pylist(), dtype=object)
    values = t.column("closes").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(names), -1)
    return t.column("own").to_numpy(), t.column("x")[0].as_py(), t.column("y")[0].as_py(), names, values


class Legs:
    """The series of a cell, centred, with the sums of each that its pairs share."""

    def __init__(self, values: np.ndarray):
        self.n = values.shape[1]
        self.mean = values.mean(axis=1)
        self.z = values - self.mean[:, None]
        self.square = np.einsum("ij,ij->i", self.z, self.z)                      # sum z_t z_t
        self.next = np.einsum("ij,ij->i", self.z[:, :-1], self.z[:, 1:])         # sum z_{t-1} z_t
        k = np.arange(1, min(COEFS, self.n - 1) + 1)[:, None]
        basis = np.sqrt(2.0 / self.n) * np.cos(np.pi * k * (np.arange(self.n) + 0.5) / self.n)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.coef = np.nan_to_num(self.z @ basis.T / np.sqrt(self.square)[:, None])
        self.rest = np.sqrt(np.clip(1.0 - np.einsum("ij,ij->i", self.coef, self.coef), 0.0, 1.0))


def corr_bound(legs: Legs, i: int, others: np.ndarray) -> np.ndarray:
    """|corr| is at most this: the part within the coefficients, plus the largest
    product that the two remainders can have."""
    return np.abs(legs.coef[others] @ legs.coef[i]) + legs.rest[others] * legs.rest[i]


def pair_rows(names, legs: Legs, i: int, others: np.ndarray, lags, gate: float | None) -> dict:
    """Columns of the pairs of series ``i`` with ``others``; the lesser name is leg a."""
    n, z = legs.n, legs.z
    p = z[i]
    ahead, behind = np.append(0.0, p[:-1]), np.append(p[1:], 0.0)
    cross, fwd, back = (z[others] @ np.column_stack([p, ahead, behind])).T     # p_t q_t, p_{t-1} q_t, p_t q_{t-1}
    is_a = names[others] > names[i]
    a, b = np.where(is_a, i, others), np.where(is_a, others, i)
    va, vb = legs.square[a], legs.square[b]
    flat = (va == 0) | (vb == 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = np.where(flat, np.nan, cross / np.sqrt(va * vb))
        beta = np.where(vb == 0, np.nan, cross / vb)
        r2 = np.where(vb == 0, np.nan, np.where(va == 0, 1.0, corr ** 2))
    if gate is not None:
        kept = np.abs(corr) >= gate
        others, a, b, va, vb, flat, corr, beta, r2, cross, fwd, back = (
            v[kept] for v in (others, a, b, va, vb, flat, corr, beta, r2, cross, fwd, back))
    lag_n, nobs, tau = np.full(len(a), np.nan), np.full(len(a), np.nan), np.full(len(a), np.nan)
    steep = np.flatnonzero(~flat)
    if lags == 0:
        # sums over the residual z_a - beta z_b from the sums of its legs
        with np.errstate(invalid="ignore"):
            first, last = z[a, 0] - beta * z[b, 0], z[a, -1] - beta * z[b, -1]
            whole = va - 2 * beta * cross + beta ** 2 * vb
            lagged = legs.next[a] - beta * (fwd + back) + beta ** 2 * legs.next[b]
        sxx = whole - last ** 2
        lag_n[steep], nobs[steep], tau[steep] = (v[steep] for v in _no_lag(sxx, lagged - sxx, whole - first ** 2 - 2 * lagged + sxx, n, va / n))
        steep = steep[~(sxx[steep] > 1e-4 * va[steep])]      # digits cancel: from the residual itself
    step = max(1, CHUNK_VALUES // (n * (3 + (max_lag(n) if lags == "aic" else int(lags)))))
    for at in range(0, len(steep), step):
        c = steep[at: at + step]
        lag_n[c], nobs[c], tau[c] = adf_batch(z[a[c]] - beta[c, None] * z[b[c]], lags, va[c] / n)
    return {"sym_a": names[a], "sym_b": names[b], "n": np.full(len(a), n), "corr": corr, "std_a": np.sqrt(va / n),
            "std_b": np.sqrt(vb / n), "beta": beta, "alpha": legs.mean[a] - beta * legs.mean[b], "r2": r2,
            "lags": lag_n, "nobs": nobs, "tau": tau}


def max_lag(n: int) -> int:
    """Largest lag of the search: ceil(12 (n / 100)^(1/4)), as far as the rows allow."""
    return max(0, min(int(math.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 2))


def _no_lag(sxx, sxy, syy, n: int, scale):
    """(lags, rows, tau) of  De_t = rho e_{t-1} + noise  from its sums."""
    live = (sxx > 1e-12 * (n - 1) * (scale + 1e-300)) & (n >= 4)
    with np.errstate(divide="ignore", invalid="ignore"):
        ssr = syy - sxy ** 2 / sxx
        tau = np.where(live & (ssr > 0) & (n - 1 > 2), sxy / np.sqrt(ssr / (n - 2) * sxx), np.nan)
    return np.where(live, 0.0, np.nan), np.where(live, n - 1.0, np.nan), tau


def _factor(gram: np.ndarray) -> np.ndarray:
    """Lower triangular factors of a stack of Gram matrices, a column at a time; a
    column that depends on those before it gets a zero pivot and no weight."""
    low = np.zeros_like(gram)
    size = np.einsum("mii->mi", gram)
    for j in range(gram.shape[1]):
        rest = gram[:, j:, j] - np.einsum("mik,mk->mi", low[:, j:, :j], low[:, j, :j])
        pivot = np.where(rest[:, 0] > 1e-13 * size[:, j], rest[:, 0], 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            low[:, j:, j] = np.where(pivot[:, None] > 0, rest / np.sqrt(pivot)[:, None], 0.0)
    return low


def _design(e: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Rows of the regression with ``k`` lagged differences, as a stack of
    [differences 1..k, level, response] x rows."""
    d = np.diff(e, axis=1)
    n = e.shape[1]
    return np.stack([*[d[:, k - i: n - 1 - i] for i in range(1, k + 1)], e[:, k: n - 1], d[:, k:]], axis=1), n - 1 - k


def adf_batch(e: np.ndarray, lags: int | str, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lags, rows, tau) of  De_t = rho e_{t-1} + sum_i g_i De_{t-i} + noise, without a
    constant, for each row of ``e`` (NaN: none).

    "aic" tries 0..max_lag on the common sample: with the level before the differences
    and the response last, the squares of the factor's last row are what each regressor
    takes off the residual sum, so one factor serves every order.  The best order is
    refitted on all rows it allows, differences first, so that the level's pivot is
    what they leave of it.  A series that is constant against ``scale`` (its leg's
    variance) has no statistic, nor one whose level the differences determine."""
    m, n = e.shape
    if lags == 0:
        x, d = e[:, :-1], np.diff(e, axis=1)
        return _no_lag(*(np.einsum("ij,ij->i", u, v) for u, v in ((x, x), (x, d), (d, d))), n, scale)
    order, rows, tau = np.full(m, np.nan), np.full(m, np.nan), np.full(m, np.nan)
    live = np.flatnonzero((np.einsum("ij,ij->i", e[:, :-1], e[:, :-1]) > 1e-12 * (n - 1) * (scale + 1e-300)) & (n >= 4))
    if not len(live):
        return order, rows, tau
    if lags == "aic":
        top = max_lag(n)
        x, t = _design(e[live], top)
        x = x[:, [top, *range(top), top + 1]]
        low = _factor(x @ x.transpose(0, 2, 1))
        ssr = np.einsum("mi,mi->m", x[:, -1], x[:, -1])[:, None] - np.cumsum(low[:, -1, :-1] ** 2, axis=1)
        tried = np.arange(top + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            aic = np.where((ssr > 0) & (t > tried + 1), t * (np.log(2 * math.pi * ssr / t) + 1) + 2 * (tried + 1), np.inf)
        order[live] = np.argmin(aic, axis=1)
    else:
        order[live] = int(lags)
    for k in np.unique(order[live]).astype(int):
        c = np.flatnonzero(order == k)
        if n - 1 - k <= 0:
            rows[c] = 0
            continue
        x, t = _design(e[c], k)
        low = _factor(x @ x.transpose(0, 2, 1))
        rows[c] = t
        if t > k + 2:
            level, cross, rest = low[:, k, k], low[:, k + 1, k], low[:, k + 1, k + 1]
            with np.errstate(divide="ignore", invalid="ignore"):
                tau[c] = np.where((level > 0) & (rest > 0), cross / (rest / math.sqrt(t - k - 1)), np.nan)
    return order, rows, tau


def adf_statistic(e: np.ndarray, lags: int | str = "aic", scale: float = 0.0) -> tuple[int | None, int | None, float | None]:
    """(lags, rows, tau) of one series; see ``adf_batch``."""
    k, rows, tau = (v[0] for v in adf_batch(np.asarray(e, dtype=float)[None, :], lags, np.array([scale])))
    return tuple(None if np.isnan(v) else kind(v) for v, kind in ((k, int), (rows, int), (tau, float)))


def screen_stats(bars_1h: DataFrame, as_of: str, days: int = DAYS_WINDOW, lags: int | str = 0,
                 min_abs_corr: float | None = None) -> DataFrame:
    """Per-pair statistics over the window; an error when fewer than three symbols trade."""
    win = recent(bars_1h, as_of, days).select("symbol", "ts", "close")
    symbols = win.select(F.count_distinct("symbol")).first()[0]
    if symbols < 3:
        raise ValueError("screening needs bars of at least three symbols in the window")
    return pair_stats(filled_series(win), lags, min_abs_corr, blocks_for(symbols))


def screen_gate(stats: DataFrame, min_abs_corr: float = SCREEN_MIN_ABS_CORR,
                p_max: float = SCREEN_P_MAX) -> DataFrame:
    """non-constant legs, |corr| >= min, p < p_max (decided on tau < tau*)."""
    tau_star = eg_tau_threshold(p_max)
    return stats.filter((F.col("std_a") != 0) & (F.col("std_b") != 0)
                        & (F.abs("corr") >= F.lit(min_abs_corr))
                        & F.col("tau").isNotNull() & (F.col("tau") < F.lit(tau_star)))


def screen_pairs(bars_1h: DataFrame, as_of: str, days: int = DAYS_WINDOW, min_abs_corr: float = SCREEN_MIN_ABS_CORR,
                 p_max: float = SCREEN_P_MAX, lags: int | str = "aic") -> DataFrame:
    """M1: (sym_a, sym_b, corr, pvalue) of the pairs that pass the screen; the
    cointegration test searches its lags by default."""
    stats = screen_stats(bars_1h, as_of, days, lags, min_abs_corr)
    return screen_gate(stats, min_abs_corr, p_max).select("sym_a", "sym_b", "corr", "pvalue")


def pair_symbols(pairs: DataFrame) -> DataFrame:
    """Sorted distinct legs of a pair table (slash removed)."""
    legs = pairs.select(F.explode(F.array("sym_a", "sym_b")).alias("symbol"))
    return legs.select(F.replace("symbol", F.lit("/"), F.lit("")).alias("symbol")).distinct()
