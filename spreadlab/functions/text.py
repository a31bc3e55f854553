"""String column expressions: symbols, pair labels, timeframes, column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pair labels are written "A||B"; a pair label is split on any
# run of commas, bars or white space.  Timeframe spellings accepted by the
# fetcher: 1h, 60m, h1 -> 1h and 5m, m5 -> 5m.
PAIR_SEP = "||"
PAIR_SPLIT_RUNS = r"[,\|\s]+"
TIMEFRAMES = {"1h": ("1h", "60m", "h1"), "5m": ("5m", "m5")}


def canonical_symbol(col: Column) -> Column:
    """'BTC/USDT' -> 'BTCUSDT'."""
    return F.replace(col.cast("string"), F.lit("/"), F.lit(""))


def pair_label(a: Column, b: Column) -> Column:
    return F.concat_ws(PAIR_SEP, a, b)


def split_pair(label: Column) -> tuple[Column, Column]:
    """Leg A and leg B of a pair label; a label that does not split gives a
    null leg (``get`` rather than ``getItem``: no out-of-bounds error under ANSI)."""
    parts = F.split(F.regexp_replace(label, PAIR_SPLIT_RUNS, "|"), r"\|")
    return F.get(parts, 0), F.get(parts, 1)


def canonical_timeframe(col: Column) -> Column:
    """Canonical timeframe label; an unsupported spelling raises at run time."""
    tf = F.lower(F.trim(col))
    expr = None
    for canon, spellings in TIMEFRAMES.items():
        cond = tf.isin(*spellings)
        expr = F.when(cond, F.lit(canon)) if expr is None else expr.when(cond, F.lit(canon))
    return expr.otherwise(F.raise_error(F.concat(F.lit("Unsupported timeframe: "), col.cast("string"))))


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name (plan-time rename, no data pass)."""
    return df.toDF(*[c.lower() for c in df.columns])


def require_columns(df: DataFrame, cols, what: str = "input") -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}; found {df.columns}")
    return df


def first_present(df: DataFrame, names) -> str | None:
    return next((c for c in names if c in df.columns), None)


def by_alias(df: DataFrame, what: str, aliases) -> Column:
    """The first of ``aliases`` that the frame has, as a column; an error names them all."""
    found = first_present(df, aliases)
    if found is None:
        raise ValueError(f"no {what} column: one of {', '.join(aliases)} is needed, found {df.columns}")
    return F.col(found)
