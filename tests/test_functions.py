import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from spreadlab.functions.mathfn import eg_pvalue, eg_tau_threshold, norm_cdf, safe_log
from spreadlab.functions.text import canonical_timeframe, split_pair
from spreadlab.functions.timefn import epoch_to_timestamp, floor_to_5m


def test_epoch_units(spark):
    # FIXTURES epoch frame: s, ms, ns, exactly 1e12, 1e15 (µs), null
    vals = [(1, 1_704_067_200), (2, 1_704_067_200_123), (3, 1_704_067_200_123_456_789),
            (4, 1_000_000_000_000), (5, 1_704_067_200_000_000), (6, None)]
    df = spark.createDataFrame(vals, "id int, v long")
    out = dict((r[0], r[1]) for r in df.select("id", epoch_to_timestamp(F.col("v")).cast("timestamp_ntz")).collect())
    assert out[1] == dt.datetime(2024, 1, 1)
    assert out[2] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert out[3] == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    # exactly 1e12 is not > 1e12: seconds, far outside the 64-bit ns range -> null
    assert out[4] is None
    # microseconds are read as milliseconds (no µs branch) -> out of range -> null
    assert out[5] is None
    assert out[6] is None


def test_epoch_first_value_rule(spark):
    from spreadlab.sources.bars import normalize_ts
    df = spark.createDataFrame([(1, 1_704_067_200_000), (2, 1_704_067_200)], "id int, ts long")
    first = dict(r for r in df.select("id", normalize_ts(df, "ts", "first").cast("timestamp_ntz")).collect())
    row = dict(r for r in df.select("id", normalize_ts(df, "ts", "row").cast("timestamp_ntz")).collect())
    assert first[1] == dt.datetime(2024, 1, 1) and first[2] == dt.datetime(1970, 1, 20, 17, 21, 7, 200000)
    assert row[2] == dt.datetime(2024, 1, 1)


def test_string_timestamps(spark):
    from spreadlab.sources.bars import normalize_ts
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-01T10:00:00+02:00",), ("junk",)], "ts string")
    got = [r[0] for r in df.select(normalize_ts(df, "ts").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 8), None]


def test_floor_5m(spark):
    df = spark.createDataFrame([("2024-01-01 10:07:59",)], "s string")
    got = df.select(floor_to_5m(F.col("s").cast("timestamp")).cast("timestamp_ntz")).first()[0]
    assert got == dt.datetime(2024, 1, 1, 10, 5)


def test_safe_log(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (math.e,), (None,)], "x double")
    assert [r[0] for r in df.select(safe_log(F.col("x"))).collect()] == [None, None, 1.0, None]


def test_norm_cdf_and_pvalue(spark):
    df = spark.createDataFrame([(-3.336,), (-3.044,), (-3.896,), (-20.0,), (1.0,), (0.0,)], "t double")
    got = [r[0] for r in df.select(eg_pvalue(F.col("t"))).collect()]
    assert abs(got[0] - 0.05) < 1e-3 and abs(got[1] - 0.10) < 1e-3 and abs(got[2] - 0.01) < 1e-3
    assert got[3] == 0.0 and got[4] == 1.0
    z = [r[0] for r in df.select(norm_cdf(F.col("t"))).collect()]
    for x, v in zip([-3.336, -3.044, -3.896, -20.0, 1.0, 0.0], z):
        assert abs(v - 0.5 * (1 + math.erf(x / math.sqrt(2)))) < 1e-7
    t = eg_tau_threshold(0.05)
    assert -3.34 < t < -3.33


def test_split_pair_labels(spark):
    df = spark.createDataFrame([("A||B",), ("A,B",), ("A B",), ("AUSDT",)], "label string")
    a, b = split_pair(F.col("label"))
    got = [tuple(r) for r in df.select(a, b).collect()]
    assert got == [("A", "B"), ("A", "B"), ("A", "B"), ("AUSDT", None)]


def test_canonical_timeframe(spark):
    df = spark.createDataFrame([("1h",), ("60m",), ("H1",), ("5m",), ("m5",)], "tf string")
    assert [r[0] for r in df.select(canonical_timeframe(F.col("tf"))).collect()] == ["1h", "1h", "1h", "5m", "5m"]
    bad = spark.createDataFrame([("15m",)], "tf string")
    with pytest.raises(Exception):
        bad.select(canonical_timeframe(F.col("tf"))).collect()
