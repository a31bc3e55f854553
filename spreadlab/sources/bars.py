"""Bar ingest: name and timestamp normalisation, cleaning, raw candles,
slicing, unions and high-watermarks (S1-S10).

Everything is a projection, filter or small aggregate over the bar files;
the epoch-unit rule is a per-row column expression, so no driver-side pandas
pass is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, NumericType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType, DoubleType, LongType)

from ..functions.text import canonical_symbol, canonical_timeframe, lower_columns, require_columns
from ..functions.timefn import epoch_to_timestamp, epoch_unit, parse_timestamp_string

BAR_SCHEMA = StructType([
    StructField("symbol", StringType()), StructField("ts", TimestampType()),
    StructField("open", DoubleType()), StructField("high", DoubleType()),
    StructField("low", DoubleType()), StructField("close", DoubleType()),
    StructField("volume", DoubleType()), StructField("date", DateType()),
])
RAW_SCHEMA = StructType([
    StructField("ts", LongType()), StructField("open", DoubleType()), StructField("high", DoubleType()),
    StructField("low", DoubleType()), StructField("close", DoubleType()), StructField("volume", DoubleType()),
    StructField("symbol", StringType()), StructField("timeframe", StringType()),
])
REQUIRED = ["symbol", "open", "high", "low", "close", "volume", "ts"]
OHLCV = ["open", "high", "low", "close", "volume"]


def read_bars(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet bar scan (explicit schema when known: no inference job)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def normalize_ts(df: DataFrame, col: str, rule: str = "row") -> Column:
    """S3: timestamp from instant, wall-clock, epoch number or text.

    ``rule="row"`` decides the epoch unit per value (order independent);
    ``rule="first"`` decides it once from the first non-null value in file
    order, as the reference does (a scalar subquery, no driver round trip)."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, TimestampType):
        return c
    if isinstance(dtype, TimestampNTZType):
        return c.cast("timestamp")
    if isinstance(dtype, NumericType):
        if rule == "first":
            first = df.select(F.first(col, ignorenulls=True)).scalar()
            return epoch_to_timestamp(c, epoch_unit(first))
        return epoch_to_timestamp(c)
    return parse_timestamp_string(c.cast("string"))


def clean_bars(df: DataFrame, rule: str = "row", keep: tuple[str, ...] = ()) -> DataFrame:
    """S2 + S3 + S4 + S5: lower-case names, ts from ts|timestamp, required
    columns, slash-free symbol, any-null rows dropped, ``date`` added.  Columns
    in ``keep`` (lower-case names) go along unchanged and may be null."""
    df = lower_columns(df)
    src = "ts" if "ts" in df.columns else ("timestamp" if "timestamp" in df.columns else None)
    if src is None:
        raise ValueError(f"bars need a ts or timestamp column, found {df.columns}")
    df = df.withColumn("ts", normalize_ts(df, src, rule))
    require_columns(df, REQUIRED, "bars")
    out = df.select(canonical_symbol(F.col("symbol")).alias("symbol"), "ts",
                    *[F.col(c).try_cast("double").alias(c) for c in OHLCV], *keep)
    return out.na.drop("any", subset=REQUIRED).withColumn("date", F.to_date("ts"))


def sort_bars(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Bars ordered by (symbol, time); a presentation order for exports."""
    return df.orderBy("symbol", ts)


def only_symbols(df: DataFrame, symbols) -> DataFrame:
    """rows of the listed symbols (pushed to the scan as an IN filter)."""
    return df.filter(F.col("symbol").isin(list(symbols)))


def restrict_to_screened(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Bars of the legs of the screened pairs; all bars when no pair is screened.
    The emptiness test is a scalar subquery of the same plan, not a driver job."""
    legs = (pairs.select(F.explode(F.array("sym_a", "sym_b")).alias("symbol"))
            .select(canonical_symbol(F.col("symbol")).alias("symbol"), F.lit(True).alias("_leg")).distinct())
    none = pairs.select(F.count("*")).scalar() == 0
    return df.join(legs, "symbol", "left").filter(F.col("_leg").isNotNull() | none).drop("_leg").select(*df.columns)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """the frame itself, or an error when it has no row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows left after filtering")
    return df


def candles_to_bars(df: DataFrame, candle: str = "candle", symbol: str = "symbol",
                    timeframe: str = "timeframe") -> DataFrame:
    """Raw [ts_ms, o, h, l, c, v] arrays -> typed rows; null O/H/L/C drops,
    a null volume is kept."""
    arr = F.col(candle)
    out = df.select(
        F.get(arr, 0).try_cast("long").alias("ts"),
        *[F.get(arr, i + 1).try_cast("double").alias(c) for i, c in enumerate(OHLCV)],
        F.col(symbol).cast("string").alias("symbol"),
        canonical_timeframe(F.col(timeframe)).alias("timeframe"))
    return out.na.drop("any", subset=["open", "high", "low", "close"])


def slice_bars(df: DataFrame, since: Column | None = None, until: Column | None = None,
               limit: int | None = None, ts: str = "ts") -> DataFrame:
    """Ts >= since, ts <= until, then at most ``limit`` earliest bars per symbol.
    The ``row_number() <= limit`` filter is planned as a per-partition group
    limit before the exchange (WindowGroupLimit), so only ``limit`` rows per
    symbol and task are shuffled."""
    out = df
    if since is not None:
        out = out.filter(F.col(ts) >= since)
    if until is not None:
        out = out.filter(F.col(ts) <= until)
    if limit is not None:
        w = Window.partitionBy("symbol").orderBy(ts)
        out = out.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit).drop("_rn")
    return out


def union_bars(spark: SparkSession, frames: list[DataFrame], schema: StructType = RAW_SCHEMA) -> DataFrame:
    """Union by name; an empty list gives an empty frame with the schema."""
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def watermarks(df: DataFrame, ts: str = "ts", keys=("timeframe", "symbol")) -> DataFrame:
    """High-watermark (epoch ms) per (timeframe, symbol)."""
    return df.groupBy(*keys).agg(F.unix_millis(F.max(ts)).alias("wm_ms"))


def newer_than(df: DataFrame, wm: DataFrame, ts: str = "ts", keys=("timeframe", "symbol")) -> DataFrame:
    """Rows strictly later than their key's watermark (all rows of unseen keys).
    The watermark table has one row per key; AQE broadcasts it by measured size."""
    j = df.join(wm, list(keys), "left")
    return j.filter(F.unix_millis(F.col(ts)) > F.coalesce(F.col("wm_ms"), F.lit(-(2 ** 62)))).drop("wm_ms")
