"""Rolling bar features (W1-W4) and pair spread features.

All windows share one specification per key (``symbol`` or ``pair``) ordered
by ``ts``; Catalyst folds the columns into two Window operators over a single
exchange and sort.  Frames are bounded (at most 48 rows), and rows per key are
bars -- bounded by the calendar (one per bar interval), not by tick volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.mathfn import guarded_z, safe_log
from ..functions.text import pair_label

# Rolling window lengths in bars (means, volatilities, z-score).
MA_WINDOWS = (5, 12, 24, 48)
VOL_WINDOWS = (12, 48)
Z_WINDOW = 48
MIN_OBS = 12          # bars a rolling hedge fit needs
BAR_NUMERIC = ("open", "high", "low", "close", "volume")


def cast_bars(df: DataFrame) -> DataFrame:
    """Typed projection of a bar source; bad text becomes null (try_cast)."""
    out = df.withColumns({"ts": F.col("ts").cast("timestamp"), "symbol": F.col("symbol").cast("string")})
    return out.withColumns({c: F.col(c).try_cast("double") for c in BAR_NUMERIC if c in df.columns})


def _symbol_columns(df: DataFrame, w) -> DataFrame:
    def frame(n):
        return w.rowsBetween(-(n - 1), Window.currentRow)

    df = df.withColumn("ret_1", safe_log(F.col("close")) - safe_log(F.lag("close").over(w)))
    cols = {f"ma_{n}": F.avg("close").over(frame(n)) for n in MA_WINDOWS}
    cols.update({f"vol_{n}": F.stddev_samp("ret_1").over(frame(n)) for n in VOL_WINDOWS})
    mean_z = F.avg("close").over(frame(Z_WINDOW))
    std_z = F.stddev_samp("close").over(frame(Z_WINDOW))
    cols["z_48"] = guarded_z(F.col("close"), mean_z, std_z)
    return df.withColumns(cols)


FEATURE_COLS = ["ret_1"] + [f"ma_{n}" for n in MA_WINDOWS] + [f"vol_{n}" for n in VOL_WINDOWS] + ["z_48"]


def symbol_features(bars: DataFrame, chunk_rows: int | None = 2048) -> DataFrame:
    """ts, symbol, close, [date], ret_1, ma_5/12/24/48, vol_12/48, z_48.

    With ``chunk_rows`` the windows run chunked (every task bounded by the
    chunk size whatever the symbol skew); ``None`` uses one partition per symbol."""
    from .windowing import chunked_windows
    df = cast_bars(bars)
    reach = max(max(MA_WINDOWS), max(VOL_WINDOWS) + 1, Z_WINDOW) - 1  # vol over ret_1 needs one more row
    if chunk_rows:
        df = chunked_windows(df, ["symbol"], "ts", reach, 0, _symbol_columns, chunk_rows=chunk_rows)
    else:
        df = _symbol_columns(df, Window.partitionBy("symbol").orderBy("ts"))
    keep = ["ts", "symbol", "close"] + (["date"] if "date" in bars.columns else [])
    return df.select(*keep, *FEATURE_COLS)


def latest(df: DataFrame, n: int = 10, ts: str = "ts", tiebreak: str = "symbol") -> DataFrame:
    """O2: the n most recent rows (top-k; TakeOrderedAndProject, no global sort)."""
    return df.orderBy(F.desc(ts), F.asc(tiebreak)).limit(n)


def pair_legs(bars: DataFrame, pairs: DataFrame) -> DataFrame:
    """Both legs of every pair at equal ts (inner: strict alignment).

    ``pairs`` is the screened pair table (sym_a, sym_b); its size is bounded by
    the symbol universe, and AQE broadcasts it when it measures small."""
    px = bars.select("symbol", "ts", "close")
    a = px.join(pairs.select(F.col("sym_a").alias("symbol"), "sym_b"), "symbol").select(
        F.col("symbol").alias("symbol_a"), F.col("sym_b").alias("symbol_b"), "ts",
        F.col("close").alias("a_close"))
    b = px.select(F.col("symbol").alias("symbol_b"), "ts", F.col("close").alias("b_close"))
    return a.join(b, ["symbol_b", "ts"], "inner").withColumn(
        "pair", pair_label(F.col("symbol_a"), F.col("symbol_b")))


def _spread_columns(df: DataFrame, w, mode: str, window: int, horizon: int | None = None,
                    min_obs: int = MIN_OBS) -> DataFrame:
    """beta, alpha (rolling mode), spread and zscore over window spec ``w``;
    with ``horizon`` also the leg-A close ``horizon`` bars ahead (``_future``)."""
    roll = w.rowsBetween(-(window - 1), Window.currentRow)
    if horizon:
        df = df.withColumn("_future", F.lead("a_close", horizon).over(w))
    if mode == "rolling":
        # OLS intercept = mean(ln a) - beta * mean(ln b) over the same frame (rows
        # where both legs are defined): one co-moment aggregate instead of two
        both = F.col("la").isNotNull() & F.col("lb").isNotNull()
        enough = F.count(F.when(both, F.lit(1))).over(roll) >= F.lit(min_obs)
        beta = F.when(enough, F.regr_slope("la", "lb").over(roll))
        df = df.withColumns({
            "beta": beta,
            "alpha": F.when(beta.isNotNull(), F.avg(F.when(both, F.col("la"))).over(roll)
                            - beta * F.avg(F.when(both, F.col("lb"))).over(roll))})
    df = df.withColumn("spread", F.col("la") - F.col("alpha") - F.col("beta") * F.col("lb"))
    return df.withColumn("zscore", guarded_z(F.col("spread"), F.avg("spread").over(roll),
                                             F.stddev_samp("spread").over(roll)))


def pair_features(bars: DataFrame, pairs: DataFrame, mode: str = "rolling", window: int = Z_WINDOW,
                  chunk_rows: int | None = 2048, label_horizon: int | None = None,
                  min_obs: int = MIN_OBS) -> DataFrame:
    """Ts, pair, symbol_a, symbol_b, a_close, beta, alpha, spread, zscore.

    spread = ln a - alpha - beta ln b, where (alpha, beta) is the OLS fit of
    ln a on ln b: one fit per pair (``static``: a grouped aggregate joined
    back, uses the whole sample) or over the trailing ``window`` bars
    (``rolling``, no look-ahead; null while the window holds fewer than
    ``min_obs`` bars: a line through two or three points is noise, and its
    intercept cancels to few digits).  zscore is the rolling z of the spread with
    the W4 guard.  With ``chunk_rows`` the rolling windows run chunked (tasks
    bounded by the chunk size, see ``operators.windowing``); ``None`` uses one
    window partition per pair.  ``label_horizon`` adds ``_future`` (the leg-A
    close that many bars ahead) in the same pass, for the dataset."""
    from .windowing import chunked_windows
    if mode not in ("static", "rolling"):
        raise ValueError(f"mode must be 'static' or 'rolling', got {mode!r}")
    legs = pair_legs(bars, pairs).withColumns({
        "la": safe_log(F.col("a_close")), "lb": safe_log(F.col("b_close"))})
    if mode == "static":
        fit = legs.groupBy("pair").agg(F.regr_slope("la", "lb").alias("beta"),
                                       F.regr_intercept("la", "lb").alias("alpha"))
        legs = legs.join(fit, "pair")
        reach = window - 1
    else:
        reach = 2 * (window - 1)  # spread window over rolling-fit window
    fwd = label_horizon or 0
    if chunk_rows:
        out = chunked_windows(legs, ["pair"], "ts", reach, fwd,
                              lambda d, w: _spread_columns(d, w, mode, window, label_horizon, min_obs),
                              chunk_rows=chunk_rows, write_once=True)
    else:
        out = _spread_columns(legs, Window.partitionBy("pair").orderBy("ts"), mode, window, label_horizon, min_obs)
    extra = ["_future"] if label_horizon else []
    return out.select("ts", "pair", "symbol_a", "symbol_b", "a_close", "beta", "alpha", "spread", "zscore", *extra)


def pair_betas(bars: DataFrame, pairs: DataFrame) -> DataFrame:
    """Full-sample log-price hedge ratio of the given pairs (sym_a, sym_b)."""
    return (pair_legs(bars, pairs).groupBy("symbol_a", "symbol_b")
            .agg(F.regr_slope(safe_log(F.col("a_close")), safe_log(F.col("b_close"))).alias("beta")))
