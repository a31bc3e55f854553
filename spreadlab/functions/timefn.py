"""Time helpers as JVM-side column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must agree with the reference's timestamp rules:
#   an epoch number above 1e18 is nanoseconds, above 1e12 milliseconds,
#   otherwise seconds (both comparisons strict);
#   results must fit the 64-bit nanosecond range 1677-09-21 .. 2262-04-11,
#   anything outside becomes null.
NS_THRESHOLD = 1_000_000_000_000_000_000
MS_THRESHOLD = 1_000_000_000_000
NS_RANGE_MAX_US = 9_223_372_036_854_775  # int64 nanoseconds, in microseconds
US_PER_S = 1_000_000


def _in_ns_range(us: Column) -> Column:
    return (us >= F.lit(-NS_RANGE_MAX_US)) & (us <= F.lit(NS_RANGE_MAX_US))


def _to_micros(col: Column, unit: str) -> Column:
    """Epoch number -> microseconds in exact decimal arithmetic, null when out of range."""
    x = col.try_cast("decimal(38,6)")
    factor = {"ns": F.lit(0.001).cast("decimal(4,3)"),
              "ms": F.lit(1000).cast("decimal(4,0)"),
              "s": F.lit(US_PER_S).cast("decimal(7,0)")}[unit]
    us = F.floor(x * factor)
    return F.when(F.abs(us) <= F.lit(NS_RANGE_MAX_US), us.cast("long"))


def epoch_to_timestamp(col: Column, unit: str | Column | None = None) -> Column:
    """Epoch number -> timestamp.

    ``unit=None`` applies the threshold rule per row (order independent);
    a literal unit or a unit column (e.g. decided once per column, as the
    reference does from the first non-null value) can be passed instead.
    Values outside the 64-bit nanosecond range become null.
    """
    if unit is None:
        unit = epoch_unit(col)
    if isinstance(unit, str):
        us = _to_micros(col, unit)
    else:
        us = (F.when(unit == "ns", _to_micros(col, "ns"))
              .when(unit == "ms", _to_micros(col, "ms"))
              .when(unit == "s", _to_micros(col, "s")))
    return F.when(_in_ns_range(us), F.timestamp_micros(us))


def epoch_unit(col: Column) -> Column:
    x = col.cast("double")
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x > F.lit(float(NS_THRESHOLD)), F.lit("ns"))
            .when(x > F.lit(float(MS_THRESHOLD)), F.lit("ms"))
            .otherwise(F.lit("s")))


def parse_timestamp_string(col: Column) -> Column:
    """String -> UTC timestamp, unparseable text -> null (never raises)."""
    return F.coalesce(
        F.try_to_timestamp(col),
        F.try_to_timestamp(col, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")),
        F.try_to_timestamp(col, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX")),
    )


def floor_time(ts: Column, width_s: int) -> Column:
    """Start of the ``width_s``-second bucket holding ``ts`` (floor, epoch aligned)."""
    us = F.unix_micros(ts)
    w = F.lit(int(width_s) * US_PER_S)
    return F.timestamp_micros(us - F.pmod(us, w))


def floor_to_5m(ts: Column) -> Column:
    return floor_time(ts, 300)


def ntz_columns(df, cols=None):
    """Cast every (or the listed) instant timestamp column to TIMESTAMP_NTZ."""
    from pyspark.sql.types import TimestampType
    names = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names}) if names else df
