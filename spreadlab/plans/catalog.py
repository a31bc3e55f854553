"""Query catalog: every implemented operator as a (spark, sf_dir) -> DataFrame
callable, plus the independent DuckDB statement that checks it.

Inputs are always the driver tables (or data Spark derives from them), so the
work of every query grows with the scale factor.  Exported timestamps are cast
to TIMESTAMP_NTZ so both engines agree on wall-clock UTC values.
"""

from __future__ import annotations

import atexit
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import ntz_columns
from ..session import scratch_path
from ..sources import sinks, state, surrogate, tables
from ..operators import report
from . import oracle_sql as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

AS_OF = "2024-01-31"


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return ntz_columns(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def r6(c):
    """Round a double output to 6 decimals (exports are compared after rounding)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------
_STAGED: dict[tuple, tuple] = {}


def staged(spark: SparkSession, key: tuple, build: Callable[[], DataFrame], partition: str | None = None) -> DataFrame:
    """Write a derived table once per session to the shared checkpoint folder and
    read it back (the bronze/silver tables of the reference).  Later queries
    read the table instead of re-deriving it, and the lineage is cut, so a lost
    executor never forces a recompute from the raw events.  Time tables are
    partitioned by ``date``: a trailing window opens only its own days.  The
    tables are removed when the process ends."""
    k = (spark.sparkContext.applicationId, *key)
    path, schema = _STAGED.get(k, (None, None))
    if path is not None and not _complete(spark, path):   # folder cleaned meanwhile: rebuild
        path = None
    if path is None:
        path = scratch_path(spark, "-".join(str(x).strip("/").replace("/", "_") for x in key))
        df = build()
        if partition:
            sinks.write_partitions(df, path, partition)
        else:
            df.write.mode("overwrite").parquet(path)
        if not _STAGED:
            atexit.register(_drop_staged)
        schema = df.schema
        _STAGED[k] = path, schema
    return spark.read.schema(schema).parquet(path)         # an empty table has a schema too


def _complete(spark: SparkSession, path: str) -> bool:
    return sinks.exists(spark, f"{path}/_SUCCESS")


def _drop_staged() -> None:
    """Remove the staged tables of a session that is still alive at exit."""
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    for k, (path, _) in _STAGED.items():
        if k[0] == spark.sparkContext.applicationId:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def bars(spark, sf_dir, width_s, with_close_id=False) -> DataFrame:
    """Staged surrogate bars (always with the closing tick id, pruned when unused)."""
    df = staged(spark, ("bars", sf_dir, width_s),
                lambda: surrogate.surrogate_bars(tables.events(spark, sf_dir), width_s, True), "date")
    return df if with_close_id else df.drop("close_event_id")


def bars_direct(spark, sf_dir, width_s) -> DataFrame:
    return surrogate.surrogate_bars(tables.events(spark, sf_dir), width_s)


def signals_single(spark, sf_dir) -> DataFrame:
    """Model-free signals per (symbol, 5-minute bar)."""
    return surrogate.surrogate_signals(bars(spark, sf_dir, 300, with_close_id=True))


BAR_COLS = ["symbol", "ts", "open", "high", "low", "close", "volume", "date"]


# ---------------------------------------------------------------------------
# bars
# ---------------------------------------------------------------------------
@query("bars_1h", O.with_ctes(["bars1h"],
       "SELECT symbol, ts, open, high, low, close, volume, date FROM bars1h"))
def q_bars_1h(spark, sf_dir):
    """Surrogate hourly OHLCV bars."""
    return bars_direct(spark, sf_dir, 3600).select(*BAR_COLS)


@query("bars_5m", O.with_ctes(["bars5m"],
       "SELECT symbol, ts, open, high, low, close, volume, date FROM bars5m"))
def q_bars_5m(spark, sf_dir):
    """Surrogate 5-minute OHLCV bars."""
    return bars_direct(spark, sf_dir, 300).select(*BAR_COLS)


# ---------------------------------------------------------------------------
# report, single-symbol mode
# ---------------------------------------------------------------------------
O.CTE["sig1"] = """sig1 AS (
  SELECT ts, symbol,
         CASE WHEN p > 0.55 THEN 1 WHEN p < 0.45 THEN -1 ELSE 0 END AS signal
  FROM (SELECT ts, symbol, CAST((close_event_id * 37) % 101 AS DOUBLE) / 100.0::DOUBLE AS p FROM bars5m))"""
O.DEPS["sig1"] = ["bars5m"]
O.CTE["px"] = "px AS (SELECT ts, symbol, close FROM bars5m)"
O.DEPS["px"] = ["bars5m"]
O.CTE["px5"] = """px5 AS (
  SELECT symbol, ts5, arg_max(close, ts) AS close
  FROM (SELECT symbol, ts, close, make_timestamp((epoch_us(ts) // 300000000) * 300000000) AS ts5 FROM px)
  GROUP BY symbol, ts5)"""
O.DEPS["px5"] = ["px"]
O.CTE["nb"] = """nb AS (
  SELECT * FROM (
    SELECT symbol, ts5, close,
           lead(close) OVER (PARTITION BY symbol ORDER BY ts5) AS close_next,
           lead(ts5) OVER (PARTITION BY symbol ORDER BY ts5) AS ts5_next
    FROM px5) WHERE close IS NOT NULL)"""
O.DEPS["nb"] = ["px5"]
O.CTE["single_rows"] = """single_rows AS (
  SELECT s.symbol, s.ts5, s.signal, p.close, p.close_next,
         (p.close_next - p.close) / p.close AS ret,
         (p.close_next - p.close) / p.close * s.signal AS pnl
  FROM (SELECT symbol, make_timestamp((epoch_us(ts) // 300000000) * 300000000) AS ts5, signal
        FROM sig1,
             (SELECT greatest((SELECT min(ts) FROM sig1), (SELECT min(ts) FROM px)) AS o_start,
                     least((SELECT max(ts) FROM sig1), (SELECT max(ts) FROM px)) AS o_end) b
        WHERE b.o_end > b.o_start
          AND make_timestamp((epoch_us(ts) // 300000000) * 300000000) BETWEEN b.o_start AND b.o_end) s
  JOIN nb p ON p.symbol = s.symbol AND p.ts5 = s.ts5
  WHERE p.close_next IS NOT NULL)"""
O.DEPS["single_rows"] = ["sig1", "px", "nb"]


def _single_rows(spark, sf_dir):
    sig = report.single_signals(signals_single(spark, sf_dir))
    px = report.normalize_prices(bars(spark, sf_dir, 300))
    return report.single_pnl(sig, px)


@query("single_pnl_daily", O.with_ctes(["single_rows"], """
SELECT CAST(ts5 AS DATE) AS date, count(*) AS rows, round(sum(pnl), 6) AS sum_pnl, round(avg(pnl), 6) AS avg_pnl
FROM single_rows GROUP BY CAST(ts5 AS DATE)"""))
def q_single_pnl_daily(spark, sf_dir):
    """Single-symbol next-bar PnL per day (R2 + A3)."""
    d = report.pnl_daily(_single_rows(spark, sf_dir))
    return d.select("date", "rows", r6("sum_pnl").alias("sum_pnl"), r6("avg_pnl").alias("avg_pnl"))


# ---------------------------------------------------------------------------
# screening (hourly bars, 60-day window)
# ---------------------------------------------------------------------------
from ..functions.mathfn import SCREEN_MIN_ABS_CORR  # noqa: E402
from ..operators import screen  # noqa: E402


def _win_sql(days: int) -> str:
    return f"""win AS (SELECT symbol, ts, close, date FROM bars1h
  WHERE date >= CAST(DATE '{AS_OF}' - INTERVAL {days} DAY AS DATE))"""


O.CTE["win"] = _win_sql(60)
O.DEPS["win"] = ["bars1h"]
O.CTE["filled"] = """grid AS (
  SELECT t.ts, s.symbol, w.close
  FROM (SELECT DISTINCT ts FROM win) t CROSS JOIN (SELECT DISTINCT symbol FROM win) s
  LEFT JOIN win w ON w.ts = t.ts AND w.symbol = s.symbol),
filled0 AS (
  SELECT ts, symbol, last_value(close IGNORE NULLS) OVER (
      PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cf
  FROM grid),
filled AS (
  SELECT ts, symbol, cf AS close, lag(cf) OVER (PARTITION BY symbol ORDER BY ts) AS close_prev
  FROM filled0 WHERE symbol NOT IN (SELECT symbol FROM filled0 WHERE cf IS NULL))"""
O.DEPS["filled"] = ["win"]
O.CTE["pr"] = """pr AS (
  SELECT a.ts, a.symbol AS sym_a, b.symbol AS sym_b, a.close AS a, b.close AS b,
         a.close_prev AS a_prev, b.close_prev AS b_prev
  FROM filled a JOIN filled b ON a.ts = b.ts AND a.symbol < b.symbol)"""
O.DEPS["pr"] = ["filled"]
O.CTE["stats"] = f"""st0 AS (
  SELECT sym_a, sym_b, count(*) AS n, corr(a, b) AS corr, stddev_pop(a) AS std_a, stddev_pop(b) AS std_b,
         regr_slope(a, b) AS beta, regr_intercept(a, b) AS alpha, regr_r2(a, b) AS r2,
         var_pop(a_prev) AS v_p
  FROM pr GROUP BY sym_a, sym_b),
resid AS (
  SELECT p.sym_a, p.sym_b, p.ts, p.a - s.alpha - s.beta * p.b AS e
  FROM pr p JOIN st0 s ON p.sym_a = s.sym_a AND p.sym_b = s.sym_b),
lagged AS (
  SELECT sym_a, sym_b, lag(e) OVER (PARTITION BY sym_a, sym_b ORDER BY ts) AS x,
         e - lag(e) OVER (PARTITION BY sym_a, sym_b ORDER BY ts) AS y
  FROM resid),
adf AS (
  SELECT sym_a, sym_b, count(*) AS n1, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy
  FROM lagged WHERE x IS NOT NULL GROUP BY sym_a, sym_b),
st1 AS (
  SELECT s.*, CASE WHEN d.sxx > 1e-12::DOUBLE * d.n1 * (s.v_p + 1e-300::DOUBLE) AND d.n1 > 2
                        AND d.syy - d.sxy * d.sxy / d.sxx > 0
                   THEN (d.sxy / d.sxx) / sqrt((d.syy - d.sxy * d.sxy / d.sxx) / (d.n1 - 1) / d.sxx) END AS tau
  FROM st0 s JOIN adf d ON s.sym_a = d.sym_a AND s.sym_b = d.sym_b),
stats AS (SELECT *, {O.eg_pvalue_sql('tau')} AS pvalue FROM st1)"""
O.DEPS["stats"] = ["pr"]
O.CTE["screened_no_lag"] = f"""screened_no_lag AS (
  SELECT sym_a, sym_b, corr, pvalue FROM stats
  WHERE std_a <> 0 AND std_b <> 0 AND abs(corr) >= 0.7::DOUBLE
    AND tau IS NOT NULL AND tau < {O.TAU_AT_5_PERCENT}::DOUBLE)"""
O.DEPS["screened_no_lag"] = ["stats"]


def _window_bars(spark, sf_dir, days=60):
    return screen.recent(bars(spark, sf_dir, 3600), AS_OF, days)


def _stats(spark, sf_dir):
    """Pair statistics of the window (no lags in the test), staged once per session."""
    return staged(spark, ("pair_stats", sf_dir), lambda: screen.screen_stats(bars(spark, sf_dir, 3600), AS_OF, 60))


def _aic_stats(spark, sf_dir):
    """Statistics of the correlated pairs with the lag search, staged once per session."""
    return staged(spark, ("pair_stats_aic", sf_dir), lambda: screen.screen_stats(
        bars(spark, sf_dir, 3600), AS_OF, 60, "aic", SCREEN_MIN_ABS_CORR))


@query("recent_60d", O.with_ctes(["win"], "SELECT symbol, ts, close, date FROM win"))
def q_recent_60d(spark, sf_dir):
    """hourly bars of the trailing 60 days before the as-of date."""
    return _window_bars(spark, sf_dir, 60).select("symbol", "ts", "close", "date")


O.CTE["win10"] = _win_sql(10).replace("win AS", "win10 AS", 1)
O.DEPS["win10"] = ["bars1h"]


@query("recent_10d", O.with_ctes(["win10"], "SELECT symbol, ts, close, date FROM win10"))
def q_recent_10d(spark, sf_dir):
    """F3 with a 10-day window (the cut is active)."""
    return _window_bars(spark, sf_dir, 10).select("symbol", "ts", "close", "date")


@query("pivot_close", O.with_ctes(["win"],
       "SELECT ts, " + ", ".join(f"max(close) FILTER (WHERE symbol = '{x}') AS {x}"
                                 for x in ("click", "error", "purchase", "signup", "view")) + " FROM win GROUP BY ts"))
def q_pivot_close(spark, sf_dir):
    """A1: wide close matrix (ts x symbol) of the screening window."""
    return screen.pivot_close(_window_bars(spark, sf_dir))


@query("ffill_grid", O.with_ctes(["filled"], "SELECT ts, symbol, close, close_prev FROM filled"))
def q_ffill_grid(spark, sf_dir):
    """J8 + W7: dense grid, forward-filled, leading-gap symbols dropped."""
    return screen.ffill_grid(_window_bars(spark, sf_dir))


@query("corr_pairs", O.with_ctes(["stats"], """
SELECT sym_a, sym_b, n, round(corr, 6) AS corr, round(std_a, 6) AS std_a, round(std_b, 6) AS std_b FROM stats"""))
def q_corr_pairs(spark, sf_dir):
    """Pearson correlation and population std per pair on filled levels."""
    s = _stats(spark, sf_dir)
    return s.select("sym_a", "sym_b", "n", r6("corr").alias("corr"), r6("std_a").alias("std_a"),
                    r6("std_b").alias("std_b"))


@query("hedge_beta", O.with_ctes(["stats"], """
SELECT sym_a, sym_b, round(beta, 6) AS beta, round(alpha, 6) AS alpha, round(r2, 6) AS r2 FROM stats"""))
def q_hedge_beta(spark, sf_dir):
    """OLS hedge ratio a = alpha + beta b per pair."""
    s = _stats(spark, sf_dir)
    return s.select("sym_a", "sym_b", r6("beta").alias("beta"), r6("alpha").alias("alpha"), r6("r2").alias("r2"))


@query("eg_tau", O.with_ctes(["stats"], """
SELECT sym_a, sym_b, round(tau, 6) AS tau, round(pvalue, 6) AS pvalue FROM stats"""))
def q_eg_tau(spark, sf_dir):
    """M2 (lag 0): Engle-Granger tau and MacKinnon p-value per pair."""
    s = _stats(spark, sf_dir)
    return s.select("sym_a", "sym_b", r6("tau").alias("tau"), r6("pvalue").alias("pvalue"))


@query("screened_pairs", O.with_ctes(["screened_no_lag"], """
SELECT sym_a, sym_b, round(corr, 6) AS corr, round(pvalue, 6) AS pvalue FROM screened_no_lag"""))
def q_screened_pairs(spark, sf_dir):
    """M1: pairs passing |corr| >= 0.7 and p < 0.05, without lags in the test."""
    p = screen.screen_gate(_stats(spark, sf_dir))
    return p.select("sym_a", "sym_b", r6("corr").alias("corr"), r6("pvalue").alias("pvalue"))


# The lag search by elimination: a pair's Gram matrix is one list, a step of the recursion
# takes a column out of it, and its last cell is then the residual sum of that order.
def _eliminate_sql(name: str, gram: str, steps: str) -> str:
    return f"""{name} AS (
  SELECT sym_a, sym_b, 0 AS s, w, m FROM {gram}
  UNION ALL
  SELECT sym_a, sym_b, s + 1, w,
         [m[x + 1] - m[(x // w) * w + s + 1] * m[s * w + x % w + 1] / m[s * w + s + 1] for x in range(w * w)]
  FROM {name} WHERE s < {steps})"""


def _gram_sql(name: str, cells: str) -> str:
    return f"""{name} AS (
  SELECT sym_a, sym_b, any_value(w) AS w, list(g ORDER BY i, j) AS m FROM (
    SELECT u.sym_a, u.sym_b, u.j AS i, v.j, any_value(u.w) AS w, sum(u.v * v.v) AS g
    FROM {cells} u JOIN {cells} v ON u.sym_a = v.sym_a AND u.sym_b = v.sym_b AND u.t = v.t
    GROUP BY u.sym_a, u.sym_b, u.j, v.j)
  GROUP BY sym_a, sym_b)"""


O.CTE["aic"] = f"""ar AS MATERIALIZED (
  SELECT *, e - lag(e) OVER w AS d, lag(e) OVER w AS x, row_number() OVER w - 2 AS t,
         count(*) OVER (PARTITION BY sym_a, sym_b) AS n
  FROM (SELECT r.* FROM resid r JOIN stats s ON r.sym_a = s.sym_a AND r.sym_b = s.sym_b
        WHERE s.std_a <> 0 AND s.std_b <> 0 AND abs(s.corr) >= {SCREEN_MIN_ABS_CORR}::DOUBLE)
  WINDOW w AS (PARTITION BY sym_a, sym_b ORDER BY ts)),
an AS (
  SELECT DISTINCT sym_a, sym_b, n,
         greatest(0, least(CAST(ceil(12.0::DOUBLE * pow(n / 100.0::DOUBLE, 0.25::DOUBLE)) AS BIGINT), n // 2 - 2)) AS top
  FROM ar),
asearch AS MATERIALIZED (
  SELECT y.sym_a, y.sym_b, y.t, k.j, top + 2 AS w,
         CASE WHEN k.j = 0 THEN y.x WHEN k.j = top + 1 THEN y.d ELSE z.d END AS v
  FROM ar y JOIN an ON y.sym_a = an.sym_a AND y.sym_b = an.sym_b
  JOIN (SELECT unnest(range(200)) AS j) k ON k.j <= top + 1
  LEFT JOIN ar z ON z.sym_a = y.sym_a AND z.sym_b = y.sym_b AND z.t = y.t - k.j
  WHERE y.t >= top),
{_gram_sql("agram", "asearch")},
{_eliminate_sql("aelim", "agram", "w - 1")},
apick AS (
  SELECT sym_a, sym_b, arg_min(k, (aic, k)) AS k FROM (
    SELECT r.sym_a, r.sym_b, s - 1 AS k,
           (n - 1 - top) * (ln(2 * pi() * m[w * w] / (n - 1 - top)) + 1) + 2 * s AS aic
    FROM aelim r JOIN an ON r.sym_a = an.sym_a AND r.sym_b = an.sym_b WHERE s > 0 AND m[w * w] > 0 AND n - 1 - top > s)
  GROUP BY sym_a, sym_b),
arefit AS MATERIALIZED (
  SELECT y.sym_a, y.sym_b, y.t, l.j, p.k + 2 AS w,
         CASE WHEN l.j = p.k THEN y.x WHEN l.j = p.k + 1 THEN y.d ELSE z.d END AS v
  FROM ar y JOIN apick p ON y.sym_a = p.sym_a AND y.sym_b = p.sym_b
  JOIN (SELECT unnest(range(200)) AS j) l ON l.j <= p.k + 1
  LEFT JOIN ar z ON z.sym_a = y.sym_a AND z.sym_b = y.sym_b AND z.t = y.t - l.j - 1
  WHERE y.t >= p.k),
{_gram_sql("fgram", "arefit")},
{_eliminate_sql("felim", "fgram", "w - 2")},
aic AS (
  SELECT f.sym_a, f.sym_b, s.corr, CAST(w - 2 AS INTEGER) AS lags, an.n - 1 - (w - 2) AS nobs,
         m[w * w - 1] / sqrt((m[w * w] - m[w * w - 1] * m[w * w - 1] / m[(w - 1) * w - 1]) / (an.n - 2 - 2 * (w - 2))
                             * m[(w - 1) * w - 1]) AS tau
  FROM felim f JOIN an ON f.sym_a = an.sym_a AND f.sym_b = an.sym_b
  JOIN stats s ON s.sym_a = f.sym_a AND s.sym_b = f.sym_b WHERE f.s = w - 2)"""
O.DEPS["aic"] = ["stats"]


@query("eg_tau_aic", O.with_ctes(["aic"], f"""
SELECT sym_a, sym_b, lags, round(tau, 6) AS tau, round({O.eg_pvalue_sql('tau')}, 6) AS pvalue, CAST(nobs AS BIGINT) AS nobs
FROM aic"""))
def q_eg_tau_aic(spark, sf_dir):
    """M2 with the lag search on the correlated pairs."""
    return _aic_stats(spark, sf_dir).select(
        "sym_a", "sym_b", "lags", r6("tau").alias("tau"), r6("pvalue").alias("pvalue"), "nobs")


O.CTE["screened"] = f"""screened AS (
  SELECT sym_a, sym_b, corr, {O.eg_pvalue_sql('tau')} AS pvalue FROM aic
  WHERE tau IS NOT NULL AND tau < {O.TAU_AT_5_PERCENT}::DOUBLE)"""
O.DEPS["screened"] = ["aic"]


@query("screened_pairs_aic", O.with_ctes(["screened"], """
SELECT sym_a, sym_b, round(corr, 6) AS corr, round(pvalue, 6) AS pvalue FROM screened"""))
def q_screened_pairs_aic(spark, sf_dir):
    """M1 as the library runs it by default (``screen_pairs``): lags by AIC."""
    p = screen.screen_pairs(bars(spark, sf_dir, 3600), AS_OF, 60)
    return p.select("sym_a", "sym_b", r6("corr").alias("corr"), r6("pvalue").alias("pvalue"))


@query("screened_symbols", O.with_ctes(["screened"], """
SELECT DISTINCT replace(symbol, '/', '') AS symbol FROM (
  SELECT sym_a AS symbol FROM screened UNION ALL SELECT sym_b FROM screened)"""))
def q_screened_symbols(spark, sf_dir):
    """Sorted distinct legs of the screened pairs."""
    return screen.pair_symbols(screen.screen_gate(_aic_stats(spark, sf_dir)))


@query("corr_gate", O.with_ctes(["stats"], f"""
SELECT sym_a, sym_b, n, round(corr, 6) AS corr, round(beta, 6) AS beta, round(tau, 6) AS tau FROM stats
WHERE std_a <> 0 AND std_b <> 0 AND abs(corr) >= {SCREEN_MIN_ABS_CORR}::DOUBLE"""))
def q_corr_gate(spark, sf_dir):
    """The pairs past the correlation gate; the rest are excluded by the bound
    on their coefficients or by the exact product."""
    s = screen.screen_stats(bars(spark, sf_dir, 3600), AS_OF, 60, 0, SCREEN_MIN_ABS_CORR)
    return s.select("sym_a", "sym_b", "n", r6("corr").alias("corr"), r6("beta").alias("beta"), r6("tau").alias("tau"))


O.CTE["lag2"] = """l2 AS (
  SELECT sym_a, sym_b, lag(e) OVER w AS x0, lag(e) OVER w - lag(e, 2) OVER w AS x1,
         lag(e, 2) OVER w - lag(e, 3) OVER w AS x2, e - lag(e) OVER w AS y
  FROM resid WINDOW w AS (PARTITION BY sym_a, sym_b ORDER BY ts)),
g2 AS (
  SELECT sym_a, sym_b, count(*) AS n, sum(x0*x0) AS a, sum(x0*x1) AS b, sum(x0*x2) AS c, sum(x1*x1) AS d, sum(x1*x2) AS f,
         sum(x2*x2) AS g, sum(x0*y) AS p, sum(x1*y) AS q, sum(x2*y) AS r, sum(y*y) AS yy
  FROM l2 WHERE x2 IS NOT NULL GROUP BY sym_a, sym_b),
inv2 AS (
  SELECT *, a*(d*g - f*f) - b*(b*g - f*c) + c*(b*f - d*c) AS det, d*g - f*f AS i00, c*f - b*g AS i01, b*f - c*d AS i02,
         a*g - c*c AS i11, b*c - a*f AS i12, a*d - b*b AS i22
  FROM g2),
fit2 AS (
  SELECT *, (i00*p + i01*q + i02*r) / det AS rho, (i01*p + i11*q + i12*r) / det AS h1, (i02*p + i12*q + i22*r) / det AS h2
  FROM inv2),
lag2 AS (
  SELECT sym_a, sym_b, n, rho / sqrt((yy - rho*p - h1*q - h2*r) / (n - 3) * i00 / det) AS tau FROM fit2)"""
O.DEPS["lag2"] = ["stats"]


@query("eg_tau_lag2", O.with_ctes(["lag2"], f"""
SELECT sym_a, sym_b, CAST(n AS BIGINT) AS nobs, round(tau, 6) AS tau, round({O.eg_pvalue_sql('tau')}, 6) AS pvalue FROM lag2"""))
def q_eg_tau_lag2(spark, sf_dir):
    """M2 with two lagged differences: the least-squares path of the lag search."""
    s = screen.screen_stats(bars(spark, sf_dir, 3600), AS_OF, 60, lags=2)
    return s.select("sym_a", "sym_b", "nobs", r6("tau").alias("tau"), r6("pvalue").alias("pvalue"))


# ---------------------------------------------------------------------------
# 5-minute features, pair features, dataset
# ---------------------------------------------------------------------------
from ..operators import dataset as ds  # noqa: E402
from ..operators import features as feat  # noqa: E402


def _screened(spark, sf_dir):
    """The screened-pairs table (silver), staged once per session for the
    stages that consume it (5-minute restriction, pair features, dataset)."""
    return staged(spark, ("screened", sf_dir),
                  lambda: screen.screen_gate(_aic_stats(spark, sf_dir)).select("sym_a", "sym_b", "corr", "pvalue")
                  ).select("sym_a", "sym_b")


def _restricted_5m(spark, sf_dir):
    """5-minute bars of the screened symbols."""
    return ingest.restrict_to_screened(bars(spark, sf_dir, 300), _screened(spark, sf_dir))


O.CTE["legs"] = """legs AS (SELECT sym_a AS symbol FROM screened UNION SELECT sym_b FROM screened)"""
O.DEPS["legs"] = ["screened"]
O.CTE["r5"] = """r5 AS (SELECT * FROM bars5m WHERE symbol IN (SELECT symbol FROM legs))"""
O.DEPS["r5"] = ["legs", "bars5m"]


@query("restrict_screened", O.with_ctes(["r5"],
       "SELECT symbol, ts, open, high, low, close, volume, date FROM r5"))
def q_restrict_screened(spark, sf_dir):
    """5-minute bars restricted to the symbols of the screened pairs."""
    return _restricted_5m(spark, sf_dir).select(*BAR_COLS)


@query("restrict_screened_empty", O.with_ctes(["bars5m"],
       "SELECT symbol, ts, open, high, low, close, volume, date FROM bars5m"))
def q_restrict_screened_empty(spark, sf_dir):
    """J6 with an empty pair table: every bar passes."""
    none = _screened(spark, sf_dir).filter(F.lit(False))
    return ingest.restrict_to_screened(bars(spark, sf_dir, 300), none).select(*BAR_COLS)


O.CTE["feat"] = """f0 AS (
  SELECT ts, symbol, close, date,
         CASE WHEN close > 0 THEN ln(close) END
           - CASE WHEN lag(close) OVER w > 0 THEN ln(lag(close) OVER w) END AS ret_1
  FROM r5 WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
feat AS (
  SELECT ts, symbol, close, date, ret_1,
         avg(close) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma_5,
         avg(close) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ma_12,
         avg(close) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS ma_24,
         avg(close) OVER (w ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS ma_48,
         stddev_samp(ret_1) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS vol_12,
         stddev_samp(ret_1) OVER (w ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS vol_48,
         CASE WHEN stddev_samp(close) OVER (w ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) > 1e-12::DOUBLE
              THEN (close - avg(close) OVER (w ROWS BETWEEN 47 PRECEDING AND CURRENT ROW))
                   / stddev_samp(close) OVER (w ROWS BETWEEN 47 PRECEDING AND CURRENT ROW)
              ELSE 0.0::DOUBLE END AS z_48
  FROM f0 WINDOW w AS (PARTITION BY symbol ORDER BY ts))"""
O.DEPS["feat"] = ["r5"]
FEATURE_OUT = ["ret_1", "ma_5", "ma_12", "ma_24", "ma_48", "vol_12", "vol_48", "z_48"]


def _features_5m(spark, sf_dir):
    return feat.symbol_features(_restricted_5m(spark, sf_dir))


@query("features_5m", O.with_ctes(["feat"], "SELECT ts, symbol, round(close, 6) AS close, date, "
       + ", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_OUT) + " FROM feat"))
def q_features_5m(spark, sf_dir):
    """Log return, rolling means, rolling vol, rolling z of close."""
    f = _features_5m(spark, sf_dir)
    return f.select("ts", "symbol", r6("close").alias("close"), "date", *[r6(c).alias(c) for c in FEATURE_OUT])


@query("latest_n", O.with_ctes(["feat"], """
SELECT ts, symbol, round(close, 6) AS close, round(z_48, 6) AS z_48 FROM feat ORDER BY ts DESC, symbol LIMIT 10"""))
def q_latest_n(spark, sf_dir):
    """O2: the 10 most recent feature rows (top-k report)."""
    f = feat.latest(_features_5m(spark, sf_dir), 10)
    return f.select("ts", "symbol", r6("close").alias("close"), r6("z_48").alias("z_48"))


def _pf_sql(name: str, mode: str) -> str:
    if mode == "static":
        fit = "regr_slope(la, lb) OVER (PARTITION BY pair) AS beta, regr_intercept(la, lb) OVER (PARTITION BY pair) AS alpha"
        few = ""
    else:
        fit = ("regr_slope(la, lb) OVER (PARTITION BY pair ORDER BY ts ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS beta, "
               "regr_intercept(la, lb) OVER (PARTITION BY pair ORDER BY ts ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS alpha, "
               "regr_count(la, lb) OVER (PARTITION BY pair ORDER BY ts ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS obs")
        few = " OR obs < 12"
    return f"""{name}_legs AS (
  SELECT a.ts, a.symbol AS symbol_a, b.symbol AS symbol_b, a.symbol || '||' || b.symbol AS pair,
         a.close AS a_close, ln(a.close) AS la, ln(b.close) AS lb
  FROM bars5m a JOIN screened s ON a.symbol = s.sym_a
  JOIN bars5m b ON b.symbol = s.sym_b AND b.ts = a.ts),
{name}_fit AS (SELECT *, {fit} FROM {name}_legs),
{name}_fit2 AS (SELECT * REPLACE (CASE WHEN isnan(beta) OR isnan(alpha){few} THEN NULL ELSE beta END AS beta,
                                   CASE WHEN isnan(beta) OR isnan(alpha){few} THEN NULL ELSE alpha END AS alpha)
               FROM {name}_fit),
{name}_sp AS (SELECT *, la - alpha - beta * lb AS spread FROM {name}_fit2),
{name} AS (
  SELECT ts, pair, symbol_a, symbol_b, a_close, beta, alpha, spread,
         CASE WHEN stddev_samp(spread) OVER w > 1e-12::DOUBLE
              THEN (spread - avg(spread) OVER w) / stddev_samp(spread) OVER w ELSE 0.0::DOUBLE END AS zscore
  FROM {name}_sp WINDOW w AS (PARTITION BY pair ORDER BY ts ROWS BETWEEN 47 PRECEDING AND CURRENT ROW))"""


O.CTE["pfs"] = _pf_sql("pfs", "static")
O.DEPS["pfs"] = ["screened", "bars5m"]
O.CTE["pfr"] = _pf_sql("pfr", "rolling")
O.DEPS["pfr"] = ["screened", "bars5m"]
PF_OUT = ["a_close", "beta", "alpha", "spread", "zscore"]


def _pair_features(spark, sf_dir, mode):
    return feat.pair_features(bars(spark, sf_dir, 300), _screened(spark, sf_dir), mode)


@query("pair_features_static", O.with_ctes(["pfs"], "SELECT ts, pair, "
       + ", ".join(f"round({c}, 6) AS {c}" for c in PF_OUT) + " FROM pfs"))
def q_pair_features_static(spark, sf_dir):
    """W8 static: one full-sample log-price fit per screened pair, rolling z of the spread."""
    f = _pair_features(spark, sf_dir, "static")
    return f.select("ts", "pair", *[r6(c).alias(c) for c in PF_OUT])


@query("pair_features_rolling", O.with_ctes(["pfr"], "SELECT ts, pair, "
       + ", ".join(f"round({c}, 6) AS {c}" for c in PF_OUT) + " FROM pfr"))
def q_pair_features_rolling(spark, sf_dir):
    """W8 rolling: trailing 48-bar log-price fit per screened pair, rolling z of the spread."""
    f = _pair_features(spark, sf_dir, "rolling")
    return f.select("ts", "pair", *[r6(c).alias(c) for c in PF_OUT])


def _ds_sql(tail: str) -> str:
    drop = "WHERE fut IS NOT NULL" if tail == "drop" else ""
    return f"""ds_{tail} AS (SELECT * FROM (
  SELECT ts, pair, beta, alpha, spread, zscore,
         CAST(CASE WHEN (fut - a_close) / a_close > 0 THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM (SELECT *, lead(a_close, 3) OVER (PARTITION BY pair ORDER BY ts) AS fut FROM pfr) {drop})
  WHERE ts IS NOT NULL AND pair IS NOT NULL AND beta IS NOT NULL AND alpha IS NOT NULL
      AND spread IS NOT NULL AND zscore IS NOT NULL)"""


O.CTE["ds_zero"] = _ds_sql("zero")
O.DEPS["ds_zero"] = ["pfr"]
O.CTE["ds_drop"] = _ds_sql("drop")
O.DEPS["ds_drop"] = ["pfr"]
DS_OUT = ["beta", "alpha", "spread", "zscore"]


def _dataset(spark, sf_dir, tail="drop", stage=True):
    """The training table (gold dataset), staged once per session for the
    training/scoring stages that read it."""
    build = lambda: ds.dataset_from_bars(bars(spark, sf_dir, 300), _screened(spark, sf_dir), tail=tail)
    if not stage:
        return build()
    return staged(spark, ("dataset", sf_dir, tail), lambda: build().withColumn("date", F.to_date("ts")), "date")


for _tail in ("zero", "drop"):
    def _make(tail):
        @query(f"dataset_{tail}_tail", O.with_ctes([f"ds_{tail}"], "SELECT ts, pair, "
               + ", ".join(f"round({c}, 6) AS {c}" for c in DS_OUT) + f", label FROM ds_{tail} "
               "WHERE ts IS NOT NULL AND pair IS NOT NULL AND beta IS NOT NULL AND alpha IS NOT NULL "
               "AND spread IS NOT NULL AND zscore IS NOT NULL"))
        def q(spark, sf_dir):
            d = _dataset(spark, sf_dir, tail, stage=False)
            return d.select("ts", "pair", *[r6(c).alias(c) for c in DS_OUT], "label")
        q.__doc__ = f"W5: forward-return label over 3 bars, tail={tail}."
        return q
    _make(_tail)


# ---------------------------------------------------------------------------
# report, pair mode (flagship)
# ---------------------------------------------------------------------------
def _pair_signals(spark, sf_dir):
    """Model-free signals of the screened pairs (the gold signals table, staged once
    per session): leg A's signal per 5-minute bar, with the pair's full-sample
    log-price beta."""
    def build():
        betas = feat.pair_betas(bars(spark, sf_dir, 300), _screened(spark, sf_dir))
        sig = signals_single(spark, sf_dir).withColumnRenamed("symbol", "symbol_a")
        return (sig.join(betas, "symbol_a").select("ts", "symbol_a", "symbol_b", "beta", "signal")
                .withColumn("date", F.to_date("ts")))
    return staged(spark, ("pair_signals", sf_dir), build, "date").drop("date")


def _pair_rows(spark, sf_dir, **kw):
    sig = report.detect_pairs(_pair_signals(spark, sf_dir))
    px = report.normalize_prices(bars(spark, sf_dir, 300))
    return report.pair_pnl(sig, px, **kw)


O.CTE["psig"] = """pb AS (
  SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, regr_slope(ln(a.close), ln(b.close)) AS beta
  FROM screened s JOIN bars5m a ON a.symbol = s.sym_a JOIN bars5m b ON b.symbol = s.sym_b AND a.ts = b.ts
  GROUP BY a.symbol, b.symbol),
psig AS (SELECT s.ts, p.symbol_a, p.symbol_b, p.beta, s.signal FROM sig1 s JOIN pb p ON p.symbol_a = s.symbol)"""
O.DEPS["psig"] = ["sig1", "bars5m", "screened"]
O.CTE["pair_rows"] = """psig5 AS (
  SELECT make_timestamp((epoch_us(ts) // 300000000) * 300000000) AS ts5, symbol_a, symbol_b, beta, signal
  FROM psig, (SELECT greatest((SELECT min(ts) FROM psig), (SELECT min(ts) FROM px)) AS o_start,
                     least((SELECT max(ts) FROM psig), (SELECT max(ts) FROM px)) AS o_end) b
  WHERE b.o_end > b.o_start
    AND make_timestamp((epoch_us(ts) // 300000000) * 300000000) BETWEEN b.o_start AND b.o_end
    AND beta IS NOT NULL AND beta >= 0.1 AND beta <= 10.0),
pj AS (
  SELECT s.*, a.close AS close_a, a.close_next AS close_next_a, a.ts5_next AS ts5_next_a,
         b.close AS close_b, b.close_next AS close_next_b, b.ts5_next AS ts5_next_b
  FROM psig5 s JOIN nb a ON a.symbol = s.symbol_a AND a.ts5 = s.ts5
  JOIN nb b ON b.symbol = s.symbol_b AND b.ts5 = s.ts5
  WHERE a.close_next IS NOT NULL AND b.close_next IS NOT NULL),
pd AS (
  SELECT *, CASE WHEN close_next_a > 0 THEN ln(close_next_a) END - CASE WHEN close_a > 0 THEN ln(close_a) END AS dln_a,
            CASE WHEN close_next_b > 0 THEN ln(close_next_b) END - CASE WHEN close_b > 0 THEN ln(close_b) END AS dln_b
  FROM pj),
pair_rows AS (
  SELECT ts5, symbol_a, symbol_b, beta, signal, dln_a - beta * dln_b AS ret_pair,
         signal * CASE WHEN close_a + abs(beta) * close_b > 0 THEN dln_a - beta * dln_b ELSE 0.0::DOUBLE END AS pnl,
         symbol_a || '||' || symbol_b AS pair, ts5_next_a, ts5_next_b
  FROM pd WHERE abs(dln_a) <= 0.5 AND abs(dln_b) <= 0.5)"""
O.DEPS["pair_rows"] = ["psig", "px", "nb"]


@query("pair_pnl_rows", O.with_ctes(["pair_rows"], """
SELECT ts5, symbol_a, symbol_b, round(beta, 6) AS beta, signal, round(ret_pair, 6) AS ret_pair, round(pnl, 6) AS pnl
FROM pair_rows"""))
def q_pair_pnl_rows(spark, sf_dir):
    """Next-bar pair PnL rows (the pair_pnl_5m view)."""
    r = _pair_rows(spark, sf_dir)
    return r.select("ts5", "symbol_a", "symbol_b", r6("beta").alias("beta"), "signal",
                    r6("ret_pair").alias("ret_pair"), r6("pnl").alias("pnl"))


@query("pair_pnl_strict_next", O.with_ctes(["pair_rows"], """
SELECT ts5, symbol_a, symbol_b, round(pnl, 6) AS pnl FROM pair_rows
WHERE ts5_next_a = ts5 + INTERVAL 5 MINUTE AND ts5_next_b = ts5 + INTERVAL 5 MINUTE"""))
def q_pair_pnl_strict_next(spark, sf_dir):
    """R1 with strict_next: the next bar must be exactly one bucket later for both legs."""
    r = _pair_rows(spark, sf_dir, strict_next=True)
    return r.select("ts5", "symbol_a", "symbol_b", r6("pnl").alias("pnl"))


def _agg_sql(src: str, key: str | None, key_expr: str | None = None) -> str:
    aggs = "count(*) AS rows, round(sum(pnl), 6) AS sum_pnl, round(avg(pnl), 6) AS avg_pnl"
    if key is None:
        return f"SELECT {aggs} FROM {src}"
    return f"SELECT {key_expr or key} AS {key}, {aggs} FROM {src} GROUP BY {key_expr or key}"


def _aggs_out(df, key=None):
    cols = ([key] if key else []) + ["rows", r6("sum_pnl").alias("sum_pnl"), r6("avg_pnl").alias("avg_pnl")]
    return df.select(*cols)


@query("pair_pnl_total", O.with_ctes(["pair_rows"], _agg_sql("pair_rows", None)))
def q_pair_pnl_total(spark, sf_dir):
    """A2: total pair PnL (rows, sum, mean)."""
    return _aggs_out(report.pnl_total(_pair_rows(spark, sf_dir)))


@query("pair_pnl_daily", O.with_ctes(["pair_rows"], _agg_sql("pair_rows", "date", "CAST(ts5 AS DATE)")))
def q_pair_pnl_daily(spark, sf_dir):
    """A3: pair PnL per UTC day (flagship)."""
    return _aggs_out(report.pnl_daily(_pair_rows(spark, sf_dir)), "date")


@query("pair_pnl_by_pair", O.with_ctes(["pair_rows"], _agg_sql("pair_rows", "pair")))
def q_pair_pnl_by_pair(spark, sf_dir):
    """A4/O3: pair PnL per pair, best first."""
    return _aggs_out(report.pnl_by(_pair_rows(spark, sf_dir), "pair"), "pair")


@query("pnl_grouping_sets", O.with_ctes(["pair_rows"], """
SELECT CAST(ts5 AS DATE) AS date, pair, CAST(grouping(CAST(ts5 AS DATE), pair) AS BIGINT) AS grouping_level,
       count(*) AS rows, round(sum(pnl), 6) AS sum_pnl, round(avg(pnl), 6) AS avg_pnl
FROM pair_rows GROUP BY GROUPING SETS ((), (CAST(ts5 AS DATE)), (pair))"""))
def q_pnl_grouping_sets(spark, sf_dir):
    """Total, daily and per-pair PnL in one aggregation pass."""
    g = report.pnl_grouping_sets(_pair_rows(spark, sf_dir), "pair")
    return g.select("date", "pair", F.col("grouping_level").cast("long").alias("grouping_level"), "rows",
                    r6("sum_pnl").alias("sum_pnl"), r6("avg_pnl").alias("avg_pnl"))


@query("single_pnl_total", O.with_ctes(["single_rows"], _agg_sql("single_rows", None)))
def q_single_pnl_total(spark, sf_dir):
    """A2 single mode: total next-bar PnL."""
    return _aggs_out(report.pnl_total(_single_rows(spark, sf_dir)))


@query("single_pnl_by_symbol", O.with_ctes(["single_rows"], _agg_sql("single_rows", "symbol")))
def q_single_pnl_by_symbol(spark, sf_dir):
    """A4 single mode: PnL per symbol, best first."""
    return _aggs_out(report.pnl_by(_single_rows(spark, sf_dir), "symbol"), "symbol")


@query("prices_5m", O.with_ctes(["px5"], "SELECT symbol, ts5, round(close, 6) AS close FROM px5"))
def q_prices_5m(spark, sf_dir):
    """The prices_5m view (one close per symbol and 5-minute bucket)."""
    p = report.prices_5m(report.normalize_prices(bars(spark, sf_dir, 300)))
    return p.select("symbol", "ts5", r6("close").alias("close"))


@query("next_bar", O.with_ctes(["nb"], """
SELECT symbol, ts5, round(close, 6) AS close, round(close_next, 6) AS close_next, ts5_next FROM nb"""))
def q_next_bar(spark, sf_dir):
    """Next close and next bucket per symbol."""
    n = report.next_bar(report.prices_5m(report.normalize_prices(bars(spark, sf_dir, 300))))
    return n.select("symbol", "ts5", r6("close").alias("close"), r6("close_next").alias("close_next"), "ts5_next")


@query("overlap_span", O.with_ctes(["psig", "px"], """
SELECT (SELECT min(ts) FROM psig) AS sig_min_ts, (SELECT max(ts) FROM psig) AS sig_max_ts,
       (SELECT count(*) FROM psig) AS sig_rows,
       (SELECT min(ts) FROM px) AS px_min_ts, (SELECT max(ts) FROM px) AS px_max_ts,
       (SELECT count(*) FROM px) AS px_rows,
       greatest((SELECT min(ts) FROM psig), (SELECT min(ts) FROM px)) AS overlap_start,
       least((SELECT max(ts) FROM psig), (SELECT max(ts) FROM px)) AS overlap_end"""))
def q_overlap_span(spark, sf_dir):
    """Spans of signals and prices and their overlap (one row)."""
    sig = _pair_signals(spark, sf_dir)
    px = report.normalize_prices(bars(spark, sf_dir, 300))
    s, p = report.span(sig), report.span(px)
    both = s.select(F.col("min_ts").alias("sig_min_ts"), F.col("max_ts").alias("sig_max_ts"),
                    F.col("rows").alias("sig_rows"),
                    p.select(F.min("min_ts")).scalar().alias("px_min_ts"),
                    p.select(F.max("max_ts")).scalar().alias("px_max_ts"),
                    p.select(F.max("rows")).scalar().alias("px_rows"))
    return both.withColumns({"overlap_start": F.greatest("sig_min_ts", "px_min_ts"),
                             "overlap_end": F.least("sig_max_ts", "px_max_ts")})


@query("leg_union", O.with_ctes(["psig"], """
SELECT symbol_a AS symbol FROM psig WHERE beta >= 0.1 AND beta <= 10.0
UNION SELECT symbol_b FROM psig WHERE beta >= 0.1 AND beta <= 10.0"""))
def q_leg_union(spark, sf_dir):
    """Distinct legs of the pair signals that pass the beta bounds."""
    s = _pair_signals(spark, sf_dir).filter(F.col("beta").between(0.1, 10.0))
    return s.select(F.col("symbol_a").alias("symbol")).union(s.select(F.col("symbol_b").alias("symbol"))).distinct()


@query("random_n", O.with_ctes(["px5"], """
SELECT symbol, ts5, round(close, 6) AS close FROM px5
ORDER BY md5(symbol || '|' || CAST(CAST(epoch(ts5) AS BIGINT) AS VARCHAR) || '|7') LIMIT 50"""))
def q_random_n(spark, sf_dir):
    """50 random rows of the prices_5m view (the sampling operator)."""
    p = report.prices_5m(report.normalize_prices(bars(spark, sf_dir, 300)))
    drawn = report.random_rows(p, [F.col("symbol"), F.unix_seconds("ts5")], 50, seed=7)
    return drawn.select("symbol", "ts5", r6("close").alias("close"))


# ---------------------------------------------------------------------------
# training and scoring
# ---------------------------------------------------------------------------
from ..operators import model as mdl  # noqa: E402
from ..operators import score as sc  # noqa: E402

FEATS = ["beta", "alpha", "spread", "zscore"]
_md5_key = "pair || '|' || CAST(CAST(epoch(ts) AS BIGINT) AS VARCHAR) || '|' || '42'"
O.CTE["split"] = f"""split AS (
  SELECT *, rn <= n_class - CAST(ceil(n_class * 0.2::DOUBLE) AS BIGINT) AS is_train FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5({_md5_key}), {_md5_key}) AS rn,
           count(*) OVER (PARTITION BY label) AS n_class
    FROM ds_drop))"""
O.DEPS["split"] = ["ds_drop"]


def _split(spark, sf_dir):
    d = mdl.cast_features(_dataset(spark, sf_dir, "drop"), FEATS)
    return mdl.stratified_split(d)


@query("stratified_split", O.with_ctes(["split"], "SELECT ts, pair, label, is_train FROM split"))
def q_stratified_split(spark, sf_dir):
    """Exact 80/20 split per label class by a portable md5 order."""
    return _split(spark, sf_dir).select("ts", "pair", "label", "is_train")


@query("scaler_stats", O.with_ctes(["split"], " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, "
    f"round(CASE WHEN stddev_pop({c}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({c}) END, 6) AS scale "
    f"FROM split WHERE is_train" for c in FEATS)))
def q_scaler_stats(spark, sf_dir):
    """A10: mean and population std per feature on the training rows."""
    s = mdl.scaler_stats(_split(spark, sf_dir).filter("is_train"), FEATS)
    return s.select("feature", r6("mean").alias("mean"), r6("scale").alias("scale"))


def _fixed_lin_sql() -> str:
    """The fixed model's linear score, its published constants stated as values."""
    return ("(0.05::DOUBLE + 0.8::DOUBLE * ((beta - 1.0::DOUBLE) / 0.3::DOUBLE) + -0.3::DOUBLE * ((alpha - 0.0::DOUBLE) / 0.5::DOUBLE)"
            " + -25.0::DOUBLE * ((spread - 0.0::DOUBLE) / 0.01::DOUBLE) + -0.6::DOUBLE * ((zscore - 0.0::DOUBLE) / 1.0::DOUBLE))")


O.CTE["scored"] = f"""scored AS (
  SELECT ts, pair AS symbol, label, 1.0::DOUBLE / (1.0::DOUBLE + exp(-{_fixed_lin_sql()})) AS p FROM ds_drop)"""
O.DEPS["scored"] = ["ds_drop"]


def _scored_all(spark, sf_dir):
    d = sc.with_id_columns(_dataset(spark, sf_dir, "drop"))
    m = sc.FIXED_MODEL
    prob = mdl.sigmoid(mdl.linear_score(m["features"], m["coef"], m["mean"], m["scale"], m["intercept"]))
    return d.select("ts", "symbol", "label", prob.alias("p"))


@query("score_fixed_model", O.with_ctes(["scored"], f"""
SELECT ts, symbol, CAST(p AS FLOAT) AS prob,
       CAST(CASE WHEN p IS NULL OR isnan(p) THEN 0 WHEN p >= 0.55 THEN 1 WHEN p <= 0.45 THEN -1 ELSE 0 END AS INTEGER) AS signal
FROM scored WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY"""))
def q_score_fixed_model(spark, sf_dir):
    """M7 + F4: fixed logistic model scored as column expressions over the last 14 days."""
    d = screen.recent_ts(sc.with_id_columns(_dataset(spark, sf_dir, "drop")), AS_OF, sc.DAYS_BACK)
    return sc.score(d, sc.FIXED_MODEL)


@query("align_target", O.with_ctes(["scored"], f"""
SELECT ts, symbol AS pair, CAST(p AS FLOAT) AS proba,
       CAST(CASE WHEN p IS NULL OR isnan(p) THEN 0 WHEN p >= 0.55 THEN 1 WHEN p <= 0.45 THEN -1 ELSE 0 END AS INTEGER) AS signal
FROM scored WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY"""))
def q_align_target(spark, sf_dir):
    """K3: scored rows aligned to a legacy (ts, pair, proba, signal) target table."""
    d = screen.recent_ts(sc.with_id_columns(_dataset(spark, sf_dir, "drop")), AS_OF, sc.DAYS_BACK)
    return sc.align_to(sc.score(d, sc.FIXED_MODEL), ["ts", "pair", "proba", "signal"])


_auc_sql_body = """
  SELECT {g} CASE WHEN np * nn > 0 THEN
           round((sum(CASE WHEN label = 1 THEN r ELSE 0 END) - np * (np + 1) / 2.0::DOUBLE) / (np * nn), 6) END AS auc,
         CAST(np AS BIGINT) AS n_pos, CAST(nn AS BIGINT) AS n_neg
  FROM (SELECT *, rank() OVER (PARTITION BY {pg} ORDER BY s) + (count(*) OVER (PARTITION BY {pg}, s) - 1) / 2.0::DOUBLE AS r,
               sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY {pg}) AS np,
               sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY {pg}) AS nn
        FROM {src} WHERE s IS NOT NULL)
  GROUP BY {g} np, nn"""


@query("auc_rank", O.with_ctes(["scored"], "SELECT auc, n_pos, n_neg FROM (" + _auc_sql_body.format(
    g="", pg="1", src="(SELECT 1 AS one, label, p AS s FROM scored)") + ")"))
def q_auc_rank(spark, sf_dir):
    """Exact ROC AUC (average ranks for ties) of the fixed model on the dataset."""
    a = mdl.auc(_scored_all(spark, sf_dir), "label", "p")
    return a.select(r6("auc").alias("auc"), "n_pos", "n_neg")


O.CTE["cands"] = """cands AS (
  SELECT 'fixed_lr' AS name, label, round(p, 9) AS s FROM scored
  UNION ALL SELECT 'beta', label, round(beta, 9) FROM ds_drop
  UNION ALL SELECT 'neg_zscore', label, round(-zscore, 9) FROM ds_drop
  UNION ALL SELECT 'neg_spread', label, round(-spread, 9) FROM ds_drop)"""
O.DEPS["cands"] = ["scored", "ds_drop"]


def _candidates(spark, sf_dir):
    # candidate scores are rounded to 1e-9 so that float noise (e.g. the exact
    # two-point fits at a pair's first bars) cannot reorder tied scores
    s = _scored_all(spark, sf_dir).select(F.lit("fixed_lr").alias("name"), "label", F.round("p", 9).alias("s"))
    d = _dataset(spark, sf_dir, "drop")
    parts = [s, d.select(F.lit("beta").alias("name"), "label", F.round("beta", 9).alias("s")),
             d.select(F.lit("neg_zscore").alias("name"), "label", F.round(-F.col("zscore"), 9).alias("s")),
             d.select(F.lit("neg_spread").alias("name"), "label", F.round(-F.col("spread"), 9).alias("s"))]
    from functools import reduce
    allc = reduce(lambda a, b: a.unionByName(b), parts)
    return mdl.auc(allc, "label", "s", group="name").withColumn(
        "uri", F.concat(F.lit("models/candidates/"), F.col("name")))


@query("candidate_aucs", O.with_ctes(["cands"], "SELECT name, auc, n_pos, n_neg FROM (" + _auc_sql_body.format(
    g="name,", pg="name", src="cands") + ")"))
def q_candidate_aucs(spark, sf_dir):
    """A11 per candidate in one pass (grouped rank-sum AUC)."""
    return _candidates(spark, sf_dir).select("name", r6("auc").alias("auc"), "n_pos", "n_neg")


@query("best_candidate", O.with_ctes(["cands"], "SELECT name, auc, 'models/candidates/' || name AS uri FROM ("
       + _auc_sql_body.format(g="name,", pg="name", src="cands") + ") ORDER BY auc DESC, name LIMIT 1"))
def q_best_candidate(spark, sf_dir):
    """champion = highest AUC (ties by name)."""
    c = _candidates(spark, sf_dir).select("name", r6("auc").alias("auc"), "uri")
    return mdl.best_candidate(c)


@query("candidates_document", O.with_ctes(["cands"], "SELECT name, auc, 'models/candidates/' || name AS uri, "
       "row_number() OVER (ORDER BY auc DESC, name) = 1 AS is_best FROM (" + _auc_sql_body.format(g="name,", pg="name", src="cands") + ")"))
def q_candidates_document(spark, sf_dir):
    """K6: the candidates and the best of them written as a document and read back."""
    path = mdl.save_candidates(_candidates(spark, sf_dir).select("name", r6("auc").alias("auc"), "uri"), scratch_path(spark, "candidates"))
    return mdl.load_candidates(spark, path)


O.CTE["newton"] = "tz AS MATERIALIZED (SELECT CAST(label AS DOUBLE) AS y, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1.0::DOUBLE ELSE stddev_pop({c}) OVER () END) AS z{i}"
    for i, c in enumerate(FEATS, 1)) + f", 1.0::DOUBLE AS z{len(FEATS) + 1} FROM split WHERE is_train),\n" + O.logistic_newton_sql(
        "tz", FEATS)
O.DEPS["newton"] = ["split"]


@query("logreg_coefficients", O.with_ctes(["newton"], " UNION ALL ".join(
    f"SELECT '{c}' AS term, round(w{i}, 6) AS coef FROM newton" for i, c in enumerate([*FEATS, "intercept"], 1))))
def q_logreg_coefficients(spark, sf_dir):
    """M5: coefficients of the fit on standardised features (SQL: unrolled Newton steps)."""
    train = _split(spark, sf_dir).filter("is_train")
    coef, intercept, _ = mdl.fit_logreg(spark, train, FEATS)
    terms = F.array(*[F.struct(F.lit(n).alias("term"), F.lit(c).alias("coef"))
                      for n, c in zip([*FEATS, "intercept"], [*coef, intercept])])
    return spark.range(1).select(F.inline(terms)).select("term", r6("coef").alias("coef"))


@query("fit_logreg")
def q_fit_logreg(spark, sf_dir):
    """M5/M6/K6: logistic regression on the training split, AUC on the
    held-out split, emitted as the model record (rows-only check)."""
    split = _split(spark, sf_dir).persist()   # read by the fit and by the held-out AUC
    try:
        feats = mdl.numeric_features(split.drop("is_train"))   # P8: beta, alpha, spread, zscore
        train, test = split.filter("is_train"), split.filter(~F.col("is_train"))
        coef, intercept, stats = mdl.fit_logreg(spark, train, feats)
        scored = mdl.score_with(test, feats, coef, intercept, stats)
        auc_v = mdl.auc(scored, "label", "prob").first()["auc"]
    finally:
        split.unpersist()
    return mdl.model_record(spark, "logreg_spark", feats, coef, intercept, stats, auc_v)


# ---------------------------------------------------------------------------
# ingest: epoch rule, cleaning, slicing, unions, watermarks, upserts
# ---------------------------------------------------------------------------
from ..functions.text import canonical_timeframe  # noqa: E402
from ..functions.timefn import epoch_to_timestamp  # noqa: E402
from ..sources import bars as ingest  # noqa: E402


def _epoch_sql(v: str) -> str:
    guard = 9223372036854775
    return (f"(CASE WHEN {v} IS NULL THEN NULL "
            f"WHEN {v} > 1000000000000000000 THEN make_timestamp({v} // 1000) "
            f"WHEN {v} > 1000000000000 THEN (CASE WHEN abs({v}) <= {guard // 1000} THEN make_timestamp({v} * 1000) END) "
            f"ELSE (CASE WHEN abs({v}) <= {guard // 1000000} THEN make_timestamp({v} * 1000000) END) END)")


@query("normalize_epoch", f"""
SELECT event_id, {_epoch_sql('s')} AS ts_s, {_epoch_sql('ms')} AS ts_ms, {_epoch_sql('ns')} AS ts_ns,
       {_epoch_sql('us')} AS ts_us
FROM (SELECT event_id, epoch_us(ts) // 1000000 AS s, epoch_us(ts) // 1000 AS ms,
             epoch_us(ts) * 1000 AS ns, epoch_us(ts) AS us FROM events)""")
def q_normalize_epoch(spark, sf_dir):
    """Per-row epoch unit rule on second, millisecond, nanosecond and
    microsecond encodings of event times (microseconds are read as ms by the
    rule, fall outside the nanosecond range and become null)."""
    e = tables.read_table(spark, sf_dir, "events", ["event_id", "ts"])
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    raw = e.select("event_id", F.expr("unix_micros(cast(ts as timestamp)) div 1000000").alias("s"),
                   F.expr("unix_micros(cast(ts as timestamp)) div 1000").alias("ms"),
                   (us * F.lit(1000)).alias("ns"), us.alias("us"))
    return raw.select("event_id", *[epoch_to_timestamp(F.col(c)).alias(f"ts_{c}") for c in ("s", "ms", "ns", "us")])


O.CTE["raw1h"] = """raw1h AS (
  SELECT upper(symbol) || '/USDT' AS "SYMBOL", epoch_ms(ts) AS "TIMESTAMP", open AS "Open", high AS "High",
         low AS "Low", close AS "Close", volume AS "Volume" FROM bars1h)"""
O.DEPS["raw1h"] = ["bars1h"]


def _raw_1h(spark, sf_dir):
    """A raw landing file as an exchange client would write it (upper-case names,
    epoch-ms time, slash symbols), derived from the surrogate hourly bars."""
    b = bars(spark, sf_dir, 3600)
    return b.select(F.concat(F.upper("symbol"), F.lit("/USDT")).alias("SYMBOL"),
                    F.unix_millis("ts").alias("TIMESTAMP"), F.col("open").alias("Open"),
                    F.col("high").alias("High"), F.col("low").alias("Low"),
                    F.col("close").alias("Close"), F.col("volume").alias("Volume"))


@query("clean_bars", O.with_ctes(["raw1h"], """
SELECT replace("SYMBOL", '/', '') AS symbol, make_timestamp("TIMESTAMP" * 1000) AS ts,
       round("Open", 6) AS open, round("High", 6) AS high, round("Low", 6) AS low, round("Close", 6) AS close,
       round("Volume", 6) AS volume, CAST(make_timestamp("TIMESTAMP" * 1000) AS DATE) AS date
FROM raw1h WHERE "SYMBOL" IS NOT NULL AND "TIMESTAMP" IS NOT NULL AND "Open" IS NOT NULL AND "High" IS NOT NULL
  AND "Low" IS NOT NULL AND "Close" IS NOT NULL AND "Volume" IS NOT NULL"""))
def q_clean_bars(spark, sf_dir):
    """Lower-case names, timestamp -> ts by the epoch rule, slash-free
    symbols, any-null rows dropped, date added."""
    c = ingest.clean_bars(_raw_1h(spark, sf_dir))
    return c.select("symbol", "ts", *[r6(x).alias(x) for x in ingest.OHLCV], "date")


@query("slice_limit", O.with_ctes(["bars1h"], """
SELECT symbol, ts, round(close, 6) AS close FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM bars1h
  WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-25 23:00:00')
WHERE rn <= 200"""))
def q_slice_limit(spark, sf_dir):
    """Time-range slice then at most 200 earliest bars per symbol (the fetch limit)."""
    b = bars(spark, sf_dir, 3600)
    s = ingest.slice_bars(b, F.lit("2024-01-05 00:00:00").cast("timestamp"),
                          F.lit("2024-01-25 23:00:00").cast("timestamp"), 200)
    return s.select("symbol", "ts", r6("close").alias("close"))


O.CTE["tagged"] = """tagged AS (
  SELECT '1h' AS timeframe, symbol, ts, close FROM bars1h
  UNION ALL SELECT '5m', symbol, ts, close FROM bars5m)"""
O.DEPS["tagged"] = ["bars1h", "bars5m"]


def _tagged(spark, sf_dir):
    b1 = bars(spark, sf_dir, 3600).select(F.lit("60m").alias("tf"), "symbol", "ts", "close")
    b5 = bars(spark, sf_dir, 300).select(F.lit("M5").alias("tf"), "symbol", "ts", "close")
    u = ingest.union_bars(spark, [b1, b5])
    return u.select(canonical_timeframe(F.col("tf")).alias("timeframe"), "symbol", "ts", "close")


@query("union_bars", O.with_ctes(["tagged"], "SELECT timeframe, symbol, ts, round(close, 6) AS close FROM tagged"))
def q_union_bars(spark, sf_dir):
    """1h and 5m bars in one frame, timeframe labels canonicalised
    ('60m' -> '1h', 'M5' -> '5m')."""
    return _tagged(spark, sf_dir).select("timeframe", "symbol", "ts", r6("close").alias("close"))


@query("watermark_max", O.with_ctes(["tagged"], """
SELECT timeframe, symbol, epoch_ms(max(ts)) AS wm_ms FROM tagged GROUP BY timeframe, symbol"""))
def q_watermark_max(spark, sf_dir):
    """High-watermark (epoch ms) per (timeframe, symbol)."""
    return ingest.watermarks(_tagged(spark, sf_dir))


@query("incremental_filter", O.with_ctes(["tagged"], """
SELECT t.timeframe, t.symbol, t.ts, round(t.close, 6) AS close FROM tagged t
LEFT JOIN (SELECT timeframe, symbol, epoch_ms(max(ts)) AS wm_ms FROM tagged
           WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY timeframe, symbol) w
  ON w.timeframe = t.timeframe AND w.symbol = t.symbol
WHERE epoch_ms(t.ts) > coalesce(w.wm_ms, -4611686018427387904)"""))
def q_incremental_filter(spark, sf_dir):
    """Bars later than the watermark of an earlier run (ingested up to 2024-01-20)."""
    t = _tagged(spark, sf_dir)
    wm = ingest.watermarks(t.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp")))
    return ingest.newer_than(t, wm).select("timeframe", "symbol", "ts", r6("close").alias("close"))


@query("incremental_runs", O.with_ctes(["tagged"], """
SELECT timeframe, symbol, ts, round(close, 6) AS close, CAST(ts AS DATE) AS date,
       epoch_ms(max(ts) OVER (PARTITION BY timeframe, symbol)) AS wm_ms FROM tagged"""))
def q_incremental_runs(spark, sf_dir):
    """Three runs over a growing source with the watermark document between them; the second
    dies after its bars are in the table and before its watermarks are."""
    base = scratch_path(spark, "incremental")
    t = _tagged(spark, sf_dir).withColumn("date", F.to_date("ts"))
    for until, dies in (("2024-01-10", False), ("2024-01-20", True), ("2024-02-10", False)):
        part = t.where(F.col("date") < F.lit(until).cast("date"))
        if dies:
            new = ingest.newer_than(part, state.read_watermarks(spark, f"{base}/state"))
            sinks.merge_partitions(spark, f"{base}/bars", new, ["timeframe", "symbol", "ts"], [], "run")
        else:
            state.incremental_run(spark, part, f"{base}/bars", f"{base}/state")
    return (spark.read.parquet(f"{base}/bars").join(state.read_watermarks(spark, f"{base}/state"), ["timeframe", "symbol"])
            .select("timeframe", "symbol", "ts", r6("close").alias("close"), "date", "wm_ms"))


@query("features_evolved", O.with_ctes(["feat"], """
SELECT ts, symbol, date, round(close, 6) AS close, round(ma_5, 6) AS ma_5,
       CASE WHEN date >= DATE '2024-01-16' THEN round(z_48, 6) END AS z_48 FROM feat"""))
def q_features_evolved(spark, sf_dir):
    """K4: a feature table whose later partitions bring a column that the earlier ones lack."""
    path = scratch_path(spark, "features_evolved")
    f = _features_5m(spark, sf_dir).select("ts", "symbol", "date", "close", "ma_5", "z_48")
    later = F.col("date") >= F.lit("2024-01-16").cast("date")
    state.write_evolved(f.where(~later).drop("z_48"), path)
    state.write_evolved(f.where(later), path)
    return state.read_evolved(spark, path).select("ts", "symbol", "date", r6("close").alias("close"), r6("ma_5").alias("ma_5"),
                                                  r6("z_48").alias("z_48"))


O.CTE["ups"] = """ups_t AS (SELECT symbol, ts, open, high, low, close, volume, date FROM bars1h WHERE date < DATE '2024-01-20'),
ups_s AS (SELECT symbol, ts, open, high, low, close * 1.001::DOUBLE AS close, volume, date FROM bars1h
          WHERE date >= DATE '2024-01-15'),
ups AS (SELECT * FROM ups_t t WHERE NOT EXISTS (SELECT 1 FROM ups_s s WHERE s.symbol = t.symbol AND s.ts = t.ts)
        UNION ALL SELECT * FROM ups_s)"""
O.DEPS["ups"] = ["bars1h"]


def _upsert_inputs(spark, sf_dir):
    b = bars(spark, sf_dir, 3600).select(*BAR_COLS)
    target = b.filter(F.col("date") < F.lit("2024-01-20").cast("date"))
    source = b.filter(F.col("date") >= F.lit("2024-01-15").cast("date")).withColumn(
        "close", F.col("close") * F.lit(1.001))
    return target, source


@query("upsert_bars", O.with_ctes(["ups"], """
SELECT symbol, ts, round(open, 6) AS open, round(close, 6) AS close, date FROM ups"""))
def q_upsert_bars(spark, sf_dir):
    """Key upsert of a corrected, overlapping batch into the bar table
    partitioned by date; only the batch's dates are read and written."""
    target, source = _upsert_inputs(spark, sf_dir)
    table = scratch_path(spark, "upsert_bars")
    sinks.write_partitions(target, table)
    sinks.merge_partitions(spark, table, source.withColumn("seq", F.lit(2)), ["symbol", "ts"], "seq", "batch-2")
    u = spark.read.parquet(table)
    return u.select("symbol", "ts", r6("open").alias("open"), r6("close").alias("close"), "date")


O.CTE["upp"] = """upp_base AS (
  SELECT ts, symbol, CAST((close_event_id * 37) % 101 AS DOUBLE) / 100.0::DOUBLE AS p FROM bars5m),
upp_t AS (SELECT ts, symbol, CAST(p AS FLOAT) AS prob,
                 CAST(CASE WHEN p >= 0.55 THEN 1 WHEN p <= 0.45 THEN -1 ELSE 0 END AS INTEGER) AS signal
          FROM upp_base WHERE ts < TIMESTAMP '2024-01-20 00:00:00'),
upp_s AS (SELECT ts, symbol, CAST(1.0::DOUBLE - p AS FLOAT) AS prob,
                 CAST(CASE WHEN 1.0::DOUBLE - p >= 0.55 THEN 1 WHEN 1.0::DOUBLE - p <= 0.45 THEN -1 ELSE 0 END AS INTEGER) AS signal
          FROM upp_base WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'),
upp AS (SELECT CASE WHEN t.symbol IS NOT NULL THEN t.ts ELSE s.ts END AS ts,
               CASE WHEN t.symbol IS NOT NULL THEN t.symbol ELSE s.symbol END AS symbol,
               CASE WHEN s.symbol IS NOT NULL THEN s.prob ELSE t.prob END AS prob,
               CASE WHEN s.symbol IS NOT NULL THEN s.signal ELSE t.signal END AS signal
        FROM upp_t t FULL OUTER JOIN upp_s s ON t.symbol = s.symbol AND t.ts = s.ts)"""
O.DEPS["upp"] = ["bars5m"]


@query("upsert_partial", O.with_ctes(["upp"], "SELECT ts, symbol, prob, signal FROM upp"))
def q_upsert_partial(spark, sf_dir):
    """K2: signal-table upsert that updates only prob and signal on matched keys."""
    from ..functions.mathfn import score_signal
    base = bars(spark, sf_dir, 300, with_close_id=True).select(
        "ts", "symbol", (F.pmod(F.col("close_event_id") * F.lit(37), F.lit(101)).cast("double")
                         / F.lit(100.0)).alias("p"))
    target = base.filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp")).select(
        "ts", "symbol", F.col("p").cast("float").alias("prob"), score_signal(F.col("p")).alias("signal"))
    newp = F.lit(1.0) - F.col("p")
    source = base.filter(F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp")).select(
        "ts", "symbol", newp.cast("float").alias("prob"), score_signal(newp).alias("signal"))
    return sinks.upsert_partial(target, source, ["symbol", "ts"], ["prob", "signal"])


@query("typical_price", O.with_ctes(["bars5m"], """
SELECT ts, symbol, round((open + high + low) / 3.0::DOUBLE, 6) AS close FROM bars5m"""))
def q_typical_price(spark, sf_dir):
    """Price source without a close column -> (open + high + low) / 3."""
    b = bars(spark, sf_dir, 300).select(F.col("ts").alias("timestamp"), F.col("symbol").alias("ticker"),
                                        "open", "high", "low")
    p = report.normalize_prices(b)
    return p.select("ts", "symbol", r6("close").alias("close"))


@query("normalize_prices", O.with_ctes(["bars5m"], "SELECT ts, symbol, round(close, 6) AS close FROM bars5m"))
def q_normalize_prices(spark, sf_dir):
    """Aliased price source (time, instrument) normalised to (ts, symbol, close)."""
    b = bars(spark, sf_dir, 300).select(F.col("ts").alias("time"), F.col("symbol").alias("instrument"), "close")
    p = report.normalize_prices(b)
    return p.select("ts", "symbol", r6("close").alias("close"))


@query("split_pair", O.with_ctes(["screened"], """
SELECT label, list_extract(parts, 1) AS symbol_a, list_extract(parts, 2) AS symbol_b FROM (
  SELECT label, string_split(regexp_replace(label, '[,|\\s]+', '|', 'g'), '|') AS parts FROM (
    SELECT sym_a || '||' || sym_b AS label FROM screened
    UNION ALL SELECT sym_a || ',' || sym_b FROM screened
    UNION ALL SELECT sym_a || ' ' || sym_b FROM screened
    UNION ALL SELECT sym_a || sym_b FROM screened))"""))
def q_split_pair(spark, sf_dir):
    """Pair labels in four spellings split into legs; an
    unsplittable label gives a null leg instead of an error."""
    from ..functions.text import split_pair
    p = _screened(spark, sf_dir)
    labels = p.select(F.explode(F.array(
        F.concat_ws("||", "sym_a", "sym_b"), F.concat_ws(",", "sym_a", "sym_b"),
        F.concat_ws(" ", "sym_a", "sym_b"), F.concat("sym_a", "sym_b"))).alias("label"))
    a, b = split_pair(F.col("label"))
    return labels.select("label", a.alias("symbol_a"), b.alias("symbol_b"))


@query("ordered_dedupe", """
SELECT event_type AS symbol, min(event_id) AS first_pos FROM events GROUP BY event_type""")
def q_ordered_dedupe(spark, sf_dir):
    """U4: order-preserving dedupe: each symbol once, at its first position."""
    e = tables.read_table(spark, sf_dir, "events", ["event_id", "event_type"])
    return (e.groupBy(F.col("event_type").alias("symbol")).agg(F.min("event_id").alias("first_pos"))
            .orderBy("first_pos"))


# ---------------------------------------------------------------------------
# JSON documents and streaming ingest
# ---------------------------------------------------------------------------
from ..sources import screened as scr  # noqa: E402
from ..streaming import ingest as stream  # noqa: E402


@query("read_screened_json", O.with_ctes(["screened"], """
SELECT symbol, CAST(row_number() OVER (ORDER BY symbol) - 1 AS INTEGER) AS pos FROM (
  SELECT DISTINCT replace(s, '/', '') AS symbol FROM (
    SELECT sym_a AS s FROM screened UNION ALL SELECT sym_b FROM screened))"""))
def q_read_screened_json(spark, sf_dir):
    """K5 + S11: export the screened symbols as {"symbols": [...]} and read the
    document back with the polymorphic reader (VARIANT on the executors)."""
    path = scratch_path(spark, "pairs_screened_json")
    sinks.export_symbols_json(_screened(spark, sf_dir), path)
    return scr.read_screened(spark, path).select("symbol", "pos")


@query("read_pair_list", O.with_ctes(["screened"], """
SELECT DISTINCT s AS symbol FROM (SELECT sym_a AS s FROM screened UNION ALL SELECT sym_b FROM screened)"""))
def q_read_pair_list(spark, sf_dir):
    """{"pairs": [[a, b]]} lines of the screened pairs -> distinct symbols."""
    path = scratch_path(spark, "pair_list_json")
    scr.write_pair_list(_screened(spark, sf_dir), path)
    return scr.read_pair_list(spark, path, bars(spark, sf_dir, 300), lines=True)


@query("read_screened_deep", O.with_ctes(["legs"], "SELECT symbol FROM legs"))
def q_read_screened_deep(spark, sf_dir):
    """The symbols six ``data`` levels down a document."""
    path = scratch_path(spark, "screened_deep_json")
    legs = _screened(spark, sf_dir).select(F.explode(F.array("sym_a", "sym_b")).alias("s")).distinct()
    doc = F.struct(F.sort_array(F.collect_list("s")).alias("top_symbols"))
    for _ in range(6):
        doc = F.struct(doc.alias("data"))
    legs.agg(doc.alias("data")).coalesce(1).write.json(path)
    return scr.read_screened(spark, path).select("symbol")


@query("read_screened_wide", """
SELECT DISTINCT event_type || '_' || CAST(user_id AS VARCHAR) AS symbol FROM events WHERE user_id IS NOT NULL""")
def q_read_screened_wide(spark, sf_dir):
    """Documents of pair objects that hold a ``data`` key each; only levels above the pairs count."""
    path = scratch_path(spark, "screened_wide_json")
    e = tables.read_table(spark, sf_dir, "events", ["event_type", "user_id", "value"]).where("user_id IS NOT NULL")
    entry = F.struct(F.concat_ws("_", "event_type", F.col("user_id").cast("string")).alias("symbol"),
                     F.struct(F.max("value").alias("data")).alias("data"))
    each = e.groupBy("event_type", "user_id").agg(entry.alias("entry"))
    each.groupBy("user_id").agg(F.struct(F.collect_list("entry").alias("selected_pairs")).alias("data")).select("data").write.json(path)
    return scr.read_screened(spark, path).select("symbol")


O.CTE["wide_universe"] = """wide_universe AS (
  SELECT event_type || '_' || CAST(user_id % 40 AS VARCHAR) AS symbol FROM events GROUP BY 1)"""


def _wide_universe(spark, sf_dir):
    """A universe of more than a hundred symbols: event type x user bucket."""
    e = tables.read_table(spark, sf_dir, "events", ["event_type", "user_id"])
    return e.select(F.concat_ws("_", "event_type", (F.col("user_id") % 40).cast("string")).alias("symbol"))


@query("pair_list_universe", O.with_ctes(["wide_universe"], "SELECT symbol FROM wide_universe"))
def q_pair_list_universe(spark, sf_dir):
    """S13 without a pair file: the whole universe, however many symbols."""
    return scr.read_pair_list(spark, scratch_path(spark, "no_pair_list"), _wide_universe(spark, sf_dir))


@query("symbol_limit", O.with_ctes(["wide_universe"], "SELECT symbol FROM wide_universe ORDER BY symbol LIMIT 50"))
def q_symbol_limit(spark, sf_dir):
    """A limit on the fallback universe that the caller asks for."""
    return scr.read_pair_list(spark, scratch_path(spark, "no_pair_list"), _wide_universe(spark, sf_dir), 50)


@query("load_screened_missing", O.with_ctes(["bars5m"], "SELECT DISTINCT symbol FROM bars5m"))
def q_load_screened_missing(spark, sf_dir):
    """S12 without a symbol file: the fallback universe."""
    return scr.load_screened(spark, scratch_path(spark, "no_symbols"), bars(spark, sf_dir, 300)).select("symbol")


O.CTE["land"] = """land AS (
  SELECT 1 AS seq, symbol, ts, close, date FROM bars1h WHERE date < DATE '2024-01-12'
  UNION ALL SELECT 2, symbol, ts, close * 0.999::DOUBLE, date FROM bars1h
            WHERE date >= DATE '2024-01-10' AND date <= DATE '2024-01-22'
  UNION ALL SELECT 3, symbol, ts, close * 1.002::DOUBLE, date FROM bars1h WHERE date >= DATE '2024-01-20')"""
O.DEPS["land"] = ["bars1h"]


STREAM_SQL = O.with_ctes(["land"], """
SELECT upper(symbol) || 'USDT' AS symbol, ts, round(close, 6) AS close, date FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, ts ORDER BY seq DESC) AS rn FROM land) WHERE rn = 1""")


def _landing_batches(spark, sf_dir):
    """Three overlapping landing batches: the later ones correct earlier bars, the second
    downwards and with times in seconds."""
    b = bars(spark, sf_dir, 3600)
    d = F.col("date")
    batches = [(1, d < F.lit("2024-01-12").cast("date"), 1.0),
               (2, (d >= F.lit("2024-01-10").cast("date")) & (d <= F.lit("2024-01-22").cast("date")), 0.999),
               (3, d >= F.lit("2024-01-20").cast("date"), 1.002)]
    for seq, cond, factor in batches:
        yield b.filter(cond).select(
            F.concat(F.upper("symbol"), F.lit("/USDT")).alias("SYMBOL"),
            (F.unix_seconds("ts") if seq == 2 else F.unix_millis("ts")).alias("TIMESTAMP"),
            F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
            (F.col("close") * F.lit(factor)).alias("Close"), F.col("volume").alias("Volume"),
            F.lit(seq).cast("long").alias("seq"))


@query("stream_ingest", STREAM_SQL)
def q_stream_ingest(spark, sf_dir):
    """Three overlapping landing batches drained by a file stream with
    availableNow; foreachBatch upserts each micro-batch into the bar table."""
    landing, table, ckpt = stream.stream_ingest_dirs(scratch_path(spark, "stream_ingest"))
    for rows in _landing_batches(spark, sf_dir):
        rows.write.mode("append").parquet(landing)
    stream.stream_ingest(spark, landing, table, ckpt, max_files_per_trigger=8)
    t = stream.current_table(spark, table)
    return t.select("symbol", "ts", r6("close").alias("close"), "date")


@query("stream_ingest_stateful", STREAM_SQL)
def q_stream_ingest_stateful(spark, sf_dir):
    """The same batches through keyed state into an append-only log; the query runs
    after each batch, the last time from a fresh checkpoint."""
    landing, table, ckpt = stream.stream_ingest_dirs(scratch_path(spark, "stream_stateful"))
    for i, rows in enumerate(_landing_batches(spark, sf_dir)):
        rows.write.mode("append").parquet(landing)
        stream.stateful_ingest(spark, landing, table, ckpt if i < 2 else f"{ckpt}_fresh", max_files_per_trigger=64)
    t = stream.newest_bars(spark, table)
    return t.select("symbol", "ts", r6("close").alias("close"), "date")


# ---------------------------------------------------------------------------
# table pick, model record round trip, report over scored signals
# ---------------------------------------------------------------------------
@query("price_source_pick", O.with_ctes(["bars5m"], "SELECT ts, symbol, round(close, 6) AS close FROM bars5m"))
def q_price_source_pick(spark, sf_dir):
    """S14 + P2: first existing price table of an ordered candidate list (the
    features view is absent, the bronze bars view exists), normalised."""
    bars(spark, sf_dir, 300).createOrReplaceTempView("spreadlab_bronze_ohlcv_5m")
    df, _ = tables.first_table(spark, ["spreadlab_silver_features_5m", "spreadlab_bronze_ohlcv_5m"])
    p = report.normalize_prices(df)                             # the plan is resolved: the name may go
    spark.catalog.dropTempView("spreadlab_bronze_ohlcv_5m")
    return p.select("ts", "symbol", r6("close").alias("close"))


@query("model_roundtrip", ORACLE["score_fixed_model"])
def q_model_roundtrip(spark, sf_dir):
    """K6 + K7 + M7: write the model record as JSON, read it back (format check,
    zero-scale guard) and score the last 14 days with the loaded constants."""
    m = sc.FIXED_MODEL
    stats = list(zip(m["features"], m["mean"], m["scale"]))
    rec = mdl.model_record(spark, m["name"], m["features"], m["coef"], m["intercept"], stats, None)
    path = scratch_path(spark, "model_json")
    sc.save_model(rec, path)
    loaded = sc.load_model(spark, path)
    d = screen.recent_ts(sc.with_id_columns(_dataset(spark, sf_dir, "drop")), AS_OF, sc.DAYS_BACK)
    return sc.score(d, loaded)


O.CTE["ssig"] = f"""ssig AS (
  SELECT ts, list_extract(parts, 1) AS symbol_a, list_extract(parts, 2) AS symbol_b, beta,
         CAST(CASE WHEN p IS NULL OR isnan(p) THEN 0 WHEN p >= 0.55 THEN 1 WHEN p <= 0.45 THEN -1 ELSE 0 END AS INTEGER) AS signal
  FROM (SELECT ts, string_split(regexp_replace(pair, '[,|\\s]+', '|', 'g'), '|') AS parts, beta,
               1.0::DOUBLE / (1.0::DOUBLE + exp(-{_fixed_lin_sql()})) AS p
        FROM ds_drop WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY))"""
O.DEPS["ssig"] = ["ds_drop"]
O.CTE["scored_rows"] = O.pair_rows_sql("ssig", "scored_rows")
O.DEPS["scored_rows"] = ["ssig", "px", "nb"]


@query("scored_pair_pnl_daily", O.with_ctes(["scored_rows"], _agg_sql("scored_rows", "date", "CAST(ts5 AS DATE)")))
def q_scored_pair_pnl_daily(spark, sf_dir):
    """M7 -> R1 -> A3: the report over model signals.  Scored rows carry the
    pair label and the rolling beta, so pair mode works end to end."""
    d = screen.recent_ts(sc.with_id_columns(_dataset(spark, sf_dir, "drop")), AS_OF, sc.DAYS_BACK)
    sig = sc.score(d, sc.FIXED_MODEL, keep=["pair", "beta"]).drop("symbol")
    px = report.normalize_prices(bars(spark, sf_dir, 300))
    rows = report.pair_pnl(report.detect_pairs(sig), px)
    return _aggs_out(report.pnl_daily(rows), "date")


# ---------------------------------------------------------------------------
# input forms, sinks and orders
# ---------------------------------------------------------------------------
@query("candles_to_bars", O.with_ctes(["bars1h"], """
SELECT epoch_ms(ts) AS ts, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close,
       round(CASE WHEN date_part('hour', ts) <> 3 THEN volume END, 6) AS volume, symbol, '1h' AS timeframe
FROM bars1h WHERE date_part('hour', ts) <> 5"""))
def q_candles_to_bars(spark, sf_dir):
    """Raw candle arrays to typed rows; a null price drops the row, a null volume stays."""
    b = bars(spark, sf_dir, 3600)
    candle = F.array(F.unix_millis("ts").cast("double"), F.when(F.hour("ts") != 5, F.col("open")), "high", "low", "close",
                     F.when(F.hour("ts") != 3, F.col("volume")))
    out = ingest.candles_to_bars(b.select(candle.alias("candle"), "symbol", F.lit("60m").alias("timeframe")))
    return out.select("ts", *[r6(c).alias(c) for c in ingest.OHLCV], "symbol", "timeframe")


@query("signal_from_proba", O.with_ctes(["sig1"], "SELECT ts, symbol, signal FROM sig1"))
def q_signal_from_proba(spark, sf_dir):
    """Signals derived from probabilities (strict thresholds), with aliased columns."""
    s = signals_single(spark, sf_dir).select(F.col("ts").alias("timestamp"), F.col("symbol").alias("pair"), "proba")
    return report.single_signals(s)


@query("pair_aliases", O.with_ctes(["pair_rows"], _agg_sql("pair_rows", "date", "CAST(ts5 AS DATE)")))
def q_pair_aliases(spark, sf_dir):
    """P5: pair signals under other accepted names give the same report."""
    s = _pair_signals(spark, sf_dir).toDF("timestamp", "leg_a", "leg_b", "hedge_ratio", "pred")
    rows = report.pair_pnl(report.detect_pairs(s), report.normalize_prices(bars(spark, sf_dir, 300)))
    return _aggs_out(report.pnl_daily(rows), "date")


@query("pair_label_signals", O.with_ctes(["psig"], """
SELECT ts, symbol_a, symbol_b, CAST(NULL AS DOUBLE) AS beta, signal FROM psig"""))
def q_pair_label_signals(spark, sf_dir):
    """A pair label without a hedge ratio has a null beta."""
    s = _pair_signals(spark, sf_dir).select("ts", F.concat_ws(", ", "symbol_a", "symbol_b").alias("pair_id"),
                                            F.col("signal").alias("action"))
    return report.detect_pairs(s)


@query("run_report", O.with_ctes(["pair_rows"], """
SELECT 'pair' AS mode, pair, count(*) AS rows, round(sum(pnl), 6) AS sum_pnl, round(avg(pnl), 6) AS avg_pnl
FROM pair_rows GROUP BY pair"""))
def q_run_report(spark, sf_dir):
    """The report driver over labelled pair signals and aliased prices."""
    s = _pair_signals(spark, sf_dir).select("ts", F.concat_ws("||", "symbol_a", "symbol_b").alias("pair"), "beta", "signal")
    px = bars(spark, sf_dir, 300).select(F.col("ts").alias("datetime"), F.col("symbol").alias("ticker"), "close")
    out = report.run_report(s, px)
    return _aggs_out(out["by_key"], "pair").select(F.lit(out["mode"]).alias("mode"), "*")


@query("report_views", ORACLE["pair_pnl_rows"])
def q_report_views(spark, sf_dir):
    """K8: the published views, read by name and dropped again."""
    report.publish_views(_pair_rows(spark, sf_dir), bars(spark, sf_dir, 300))
    r = spark.table("pair_pnl_5m")
    out = r.select("ts5", "symbol_a", "symbol_b", r6("beta").alias("beta"), "signal",
                   r6("ret_pair").alias("ret_pair"), r6("pnl").alias("pnl"))
    for view in ("pair_pnl_5m", "prices_5m"):
        spark.catalog.dropTempView(view)
    return out


@query("row_audit", O.with_ctes(["bars5m"], "SELECT 'bars_5m' AS name, count(*) AS rows FROM bars5m"))
def q_row_audit(spark, sf_dir):
    """Rows counted while the table is written, without a second pass."""
    seen, audit = sinks.count_rows(bars(spark, sf_dir, 300), "bars_5m")
    sinks.write_table(seen, scratch_path(spark, "audited"))
    return spark.createDataFrame([("bars_5m", audit.get["rows"])], "name string, rows long")


@query("table_roundtrip", O.with_ctes(["bars1h"], """
SELECT symbol, ts, round(close, 6) AS close, date FROM bars1h WHERE date >= DATE '2024-01-10' AND date < DATE '2024-01-20'"""))
def q_table_roundtrip(spark, sf_dir):
    """A table written by date and read back with its schema; the date filter prunes partitions."""
    path = sinks.write_partitions(bars(spark, sf_dir, 3600), scratch_path(spark, "bars_by_date"))
    b = ingest.read_bars(spark, path, ingest.BAR_SCHEMA)
    b = b.filter((F.col("date") >= F.lit("2024-01-10").cast("date")) & (F.col("date") < F.lit("2024-01-20").cast("date")))
    return b.select("symbol", "ts", r6("close").alias("close"), "date")


@query("by_symbol_time", O.with_ctes(["bars1h"], "SELECT symbol, ts, round(close, 6) AS close FROM bars1h"))
def q_by_symbol_time(spark, sf_dir):
    """Bars ordered by symbol and time."""
    return ingest.sort_bars(bars(spark, sf_dir, 3600)).select("symbol", "ts", r6("close").alias("close"))


@query("only_symbols", O.with_ctes(["bars5m"], """
SELECT symbol, ts, round(close, 6) AS close FROM bars5m WHERE symbol IN ('click', 'view')"""))
def q_only_symbols(spark, sf_dir):
    """bars of the listed symbols, an error if there were none."""
    b = ingest.require_rows(ingest.only_symbols(bars(spark, sf_dir, 300), ["click", "view"]), "the symbol filter")
    return b.select("symbol", "ts", r6("close").alias("close"))


@query("string_ts", """
SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN date_trunc('second', ts) END AS ts FROM events""")
def q_string_ts(spark, sf_dir):
    """X11: text times are parsed, other text becomes null."""
    e = tables.read_table(spark, sf_dir, "events", ["event_id", "ts"])
    text = F.when(F.col("event_id") % 10 == 0, F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    raw = e.select("event_id", text.alias("time_text"))
    return raw.select("event_id", ingest.normalize_ts(raw, "time_text").alias("ts"))


@query("numeric_text", O.with_ctes(["bars1h"], """
SELECT symbol, ts, round(open, 6) AS open FROM bars1h WHERE date_part('hour', ts) <> 7"""))
def q_numeric_text(spark, sf_dir):
    """Prices that are no numbers become null and their rows go."""
    b = bars(spark, sf_dir, 3600)
    text = F.when(F.hour("ts") == 7, F.lit("n/a")).otherwise(F.col("open").cast("string"))
    out = ingest.clean_bars(b.drop("date").withColumn("open", text))
    return out.select("symbol", "ts", r6("open").alias("open"))


@query("standardized", O.with_ctes(["split"], "SELECT ts, pair, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM split WHERE is_train)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1.0::DOUBLE "
    f"ELSE stddev_pop({c}) END FROM split WHERE is_train), 6) AS {c}" for c in FEATS) + " FROM split"))
def q_standardized(spark, sf_dir):
    """M4: features standardised with the training rows' statistics."""
    split = _split(spark, sf_dir)
    stats = [tuple(r) for r in mdl.scaler_stats(split.filter("is_train"), FEATS).collect()]    # one row per feature
    return mdl.standardize(split, FEATS, stats).select("ts", "pair", *[r6(c).alias(c) for c in FEATS])
