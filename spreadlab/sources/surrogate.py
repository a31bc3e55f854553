"""Market bars derived from the driver's ``events`` table.

The test tables hold no market data, so ticks are derived from events
(``symbol = event_type``) and aggregated into OHLCV bars.  Three symbols follow
a common time trend plus stationary noise, two follow a drifting walk, which
gives both cointegrated and non-cointegrated pairs.

Scale notes: the walk price needs a running total per symbol; that runs as a
two-pass bucketed scan (``operators.prefix.running_sum``), never as one task
per symbol.  Bars are a group-by with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import floor_time
from ..operators.prefix import running_sum

# Fixed values of the surrogate price rule:
#   trend symbols  click, error, purchase:
#       price = 100 + (seconds since 2024-01-01T00:00:00Z) / 36000 + value * 0.25
#   walk symbols   signup, view:
#       price = 100 + 1000 * running sum(value) / total sum(value),
#       running sum ordered by (ts, event_id)
#   value has two decimals, so sums are taken exactly in integer cents.
TREND_SYMBOLS = ("click", "error", "purchase")
WALK_SYMBOLS = ("signup", "view")
ORIGIN_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z in microseconds
TREND_SECONDS = 36000.0
NOISE_WEIGHT = 0.25
WALK_SCALE = 1000.0
BASE_PRICE = 100.0


def events_ticks(events: DataFrame, bucket_seconds: int | None = None) -> DataFrame:
    """(symbol, ts, event_id, price, cents) -- one tick per event.

    The walk symbols' running total uses range-partition buckets by default
    (bounded tasks even for a burst of events at one instant); a fixed time
    bucket width can be given instead."""
    e = events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id"),
        F.col("value"),
        F.round(F.col("value") * F.lit(100.0)).cast("long").alias("cents"),
    )
    trend = e.filter(~F.col("symbol").isin(*WALK_SYMBOLS)).select(
        "symbol", "ts", "event_id", "cents",
        (F.lit(BASE_PRICE)
         + ((F.unix_micros("ts") - F.lit(ORIGIN_US)).cast("double") / F.lit(1e6)) / F.lit(TREND_SECONDS)
         + F.col("value") * F.lit(NOISE_WEIGHT)).alias("price"))
    walk = e.filter(F.col("symbol").isin(*WALK_SYMBOLS))
    bucket = floor_time(F.col("ts"), bucket_seconds) if bucket_seconds else None
    totals = walk.groupBy("symbol").agg(F.sum("cents").alias("tot_cents"))      # of the raw events
    walk = running_sum(walk, ["symbol"], ["ts", "event_id"], {"cum_cents": "cents"}, bucket)
    walk = walk.join(totals, "symbol").select(
        "symbol", "ts", "event_id", "cents",
        (F.lit(BASE_PRICE) + F.lit(WALK_SCALE) * F.col("cum_cents").cast("double")
         / F.col("tot_cents").cast("double")).alias("price"))
    return trend.unionByName(walk)


def tick_order_key(ts: str = "ts", event_id: str = "event_id"):
    """Exact order key of (ts, event_id) as one decimal(38,0):
    unix_micros(ts) * 10^20 + (event_id + 2^63).  The shifted id lies in
    [0, 2^64) < 10^20, so the packed value orders exactly like the pair, and
    unix_micros needs at most 18 digits.  A fixed-width key lets min_by/max_by
    run as a hash aggregate with map-side partial aggregation (a struct key
    forces a sort-based aggregate)."""
    d = "decimal(38,0)"
    return (F.unix_micros(ts).cast(d) * F.lit(str(10 ** 20)).cast(d)
            + (F.col(event_id).cast(d) + F.lit(str(2 ** 63)).cast(d)))


def ticks_to_bars(ticks: DataFrame, width_s: int, with_close_id: bool = False) -> DataFrame:
    """OHLCV bars of ``width_s`` seconds: open/close = first/last tick by (ts, event_id)."""
    order = tick_order_key()
    aggs = [
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        (F.sum("cents").cast("double") / F.lit(100.0)).alias("volume"),
    ]
    if with_close_id:
        aggs.append(F.max_by("event_id", order).alias("close_event_id"))
    bars = (ticks.withColumn("bar_ts", floor_time(F.col("ts"), width_s))
            .groupBy("symbol", "bar_ts").agg(*aggs)
            .withColumnRenamed("bar_ts", "ts"))
    cols = ["symbol", "ts", "open", "high", "low", "close", "volume"]
    if with_close_id:
        cols.append("close_event_id")
    return bars.select(*cols, F.to_date("ts").alias("date"))


def surrogate_bars(events: DataFrame, width_s: int, with_close_id: bool = False) -> DataFrame:
    return ticks_to_bars(events_ticks(events), width_s, with_close_id)


def surrogate_signals(bars_with_id: DataFrame) -> DataFrame:
    """Model-free signals for report tests: prob = ((close_event_id * 37) % 101) / 100
    (integer arithmetic), signal by the report's strict 0.55 / 0.45 rule."""
    from ..functions.mathfn import proba_signal
    prob = (F.pmod(F.col("close_event_id") * F.lit(37), F.lit(101)).cast("double") / F.lit(100.0))
    return bars_with_id.select("ts", "symbol", prob.alias("proba")).withColumn(
        "signal", proba_signal(F.col("proba")))
