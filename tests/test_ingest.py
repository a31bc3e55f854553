import datetime as dt

import pytest
from pyspark.sql import functions as F

from spreadlab.sources import bars as ingest
from spreadlab.sources import sinks
from conftest import rows

T0 = 1_704_067_200_000  # 2024-01-01 in ms


def test_clean_bars_dirty_frame(spark):
    # one null in each of 7 columns, non-numeric text, a slash symbol
    data = [
        ("A/B", T0, "1", "2", "0.5", "1.5", "10"),
        (None, T0, "1", "2", "0.5", "1.5", "10"),
        ("X", None, "1", "2", "0.5", "1.5", "10"),
        ("X", T0, None, "2", "0.5", "1.5", "10"),
        ("X", T0, "1", None, "0.5", "1.5", "10"),
        ("X", T0, "1", "2", None, "1.5", "10"),
        ("X", T0, "1", "2", "0.5", None, "10"),
        ("X", T0, "1", "2", "0.5", "1.5", None),
        ("Y", T0, "abc", "2", "0.5", "1.5", "10"),
    ]
    df = spark.createDataFrame(data, "Symbol string, Timestamp long, Open string, High string, Low string, "
                                     "Close string, Volume string")
    out = ingest.clean_bars(df)
    assert out.columns == ["symbol", "ts", "open", "high", "low", "close", "volume", "date"]
    got = out.collect()
    assert len(got) == 1
    assert got[0]["symbol"] == "AB" and got[0]["date"] == dt.date(2024, 1, 1)


def test_clean_bars_requires_ts(spark):
    df = spark.createDataFrame([("A", 1.0)], "symbol string, close double")
    try:
        ingest.clean_bars(df)
    except ValueError as e:
        assert "ts" in str(e)
    else:
        raise AssertionError("expected ValueError")


def _bars(spark, data):
    return spark.createDataFrame(data, "symbol string, ts timestamp, close double, v int")


def test_upsert_semantics_and_idempotence(spark):
    t = dt.datetime
    target = _bars(spark, [("A", t(2024, 1, 1, 0), 1.0, 1), ("A", t(2024, 1, 1, 1), 2.0, 1),
                           ("B", t(2024, 1, 1, 0), 5.0, 1)])
    source = _bars(spark, [("A", t(2024, 1, 1, 1), 2.5, 2),   # existing key changed
                           ("C", t(2024, 1, 1, 0), 7.0, 2),   # new key
                           ("B", t(2023, 12, 31, 23), 4.0, 2),  # late key
                           ("C", t(2024, 1, 1, 0), 7.5, 3),   # duplicate key in source: latest wins
                           ("D", None, 1.0, 2)])              # null ts: never matches, inserted
    once = sinks.upsert(target, source, ["symbol", "ts"], order="v")
    got = rows(once, "symbol", "ts", "close")
    assert got == sorted([("A", t(2024, 1, 1, 0), 1.0), ("A", t(2024, 1, 1, 1), 2.5), ("B", t(2024, 1, 1, 0), 5.0),
                          ("B", t(2023, 12, 31, 23), 4.0), ("C", t(2024, 1, 1, 0), 7.5), ("D", None, 1.0)],
                         key=lambda r: (r[0], r[1] or t(1, 1, 1)))
    src_no_null = source.filter(F.col("ts").isNotNull())
    a = sinks.upsert(target, src_no_null, ["symbol", "ts"], order="v")
    b = sinks.upsert(a, src_no_null, ["symbol", "ts"], order="v")
    assert rows(a) == rows(b)  # second run is a no-op


def test_upsert_partial_keeps_other_columns(spark):
    t = dt.datetime
    target = spark.createDataFrame([(t(2024, 1, 1), "A", 0.2, -1, "keep")],
                                   "ts timestamp, symbol string, prob double, signal int, note string")
    source = spark.createDataFrame([(t(2024, 1, 1), "A", None, 0), (t(2024, 1, 2), "A", 0.9, 1)],
                                   "ts timestamp, symbol string, prob double, signal int")
    out = sinks.upsert_partial(target, source, ["symbol", "ts"], ["prob", "signal"])
    got = rows(out, "ts", "symbol", "prob", "signal", "note")
    # matched: null update is kept as null (not coalesced); new key: inserted with note null
    assert got == [(t(2024, 1, 1), "A", None, 0, "keep"), (t(2024, 1, 2), "A", 0.9, 1, None)]


def test_slice_and_limit(spark):
    t = dt.datetime
    df = _bars(spark, [("A", t(2024, 1, 1, h), float(h), 0) for h in range(10)]
               + [("B", t(2024, 1, 1, h), float(h), 0) for h in range(3)])
    out = ingest.slice_bars(df, F.lit(t(2024, 1, 1, 2)), F.lit(t(2024, 1, 1, 8)), limit=4)
    got = rows(out, "symbol", "close")
    assert got == [("A", 2.0), ("A", 3.0), ("A", 4.0), ("A", 5.0), ("B", 2.0)]


def test_watermarks_and_incremental(spark):
    t = dt.datetime
    df = spark.createDataFrame([("1h", "A", t(2024, 1, 1, 0)), ("1h", "A", t(2024, 1, 1, 1)),
                                ("1h", "B", t(2024, 1, 1, 0))], "timeframe string, symbol string, ts timestamp")
    wm = ingest.watermarks(df.filter(F.col("ts") < F.lit(t(2024, 1, 1, 1))))
    assert rows(wm) == [("1h", "A", 1_704_067_200_000), ("1h", "B", 1_704_067_200_000)]
    new = ingest.newer_than(df, wm.filter(F.col("symbol") == "A"))
    assert rows(new, "symbol", "ts") == [("A", t(2024, 1, 1, 1)), ("B", t(2024, 1, 1, 0))]


def test_candles_to_bars(spark):
    df = spark.createDataFrame([([float(T0), 1.0, 2.0, 0.5, 1.5, None], "A/B", "60m"),
                                ([float(T0), None, 2.0, 0.5, 1.5, 3.0], "A/B", "1h")],
                               "candle array<double>, symbol string, timeframe string")
    out = ingest.candles_to_bars(df).collect()
    assert len(out) == 1 and out[0]["volume"] is None and out[0]["timeframe"] == "1h"


def test_union_bars_empty(spark):
    out = ingest.union_bars(spark, [])
    assert out.count() == 0 and out.columns == [f.name for f in ingest.RAW_SCHEMA.fields]


def test_upsert_partial_refuses_several_source_rows(spark):
    """Two source rows for one target row are an error; null keys match nothing."""
    target = spark.createDataFrame([("A", 1, 0.1, 0), ("B", 1, 0.2, 0)], "symbol string, ts int, prob double, signal int")
    twice = spark.createDataFrame([("A", 1, 0.5, 1), ("A", 1, 0.6, 1)], "symbol string, ts int, prob double, signal int")
    with pytest.raises(Exception, match="several source rows match"):
        sinks.upsert_partial(target, twice, ["symbol", "ts"], ["prob", "signal"]).collect()
    nulls = spark.createDataFrame([(None, 1, 0.5, 1), (None, 1, 0.6, 1), ("B", 1, 0.9, 1)], "symbol string, ts int, prob double, signal int")
    got = sorted(map(tuple, sinks.upsert_partial(target, nulls, ["symbol", "ts"], ["prob", "signal"]).collect()), key=str)
    assert got == sorted([("A", 1, 0.1, 0), ("B", 1, 0.9, 1), (None, 1, 0.5, 1), (None, 1, 0.6, 1)], key=str)


def test_watermark_document_and_growing_table(spark, tmp_path):
    from spreadlab.sources import state
    base = str(tmp_path / "state")
    assert state.read_watermarks(spark, base).collect() == []
    wm = spark.createDataFrame([("1h", "A/B", 5), ("1h", "C", 7), ("5m", "A/B", 1)], state.WATERMARKS)
    for add in (0, 10):
        state.publish_watermarks(wm.withColumn("wm_ms", wm.wm_ms + add), base)
    assert sorted(map(tuple, state.read_watermarks(spark, base).collect())) == [("1h", "A/B", 15), ("1h", "C", 17), ("5m", "A/B", 11)]
    path = str(tmp_path / "table")
    state.write_evolved(spark.createDataFrame([(1, 1.0, "d1"), (2, 2.0, "d2")], "k bigint, x double, date string"), path)
    state.write_evolved(spark.createDataFrame([(3, "new", "d2")], "k int, y string, date string"), path)
    got = sorted((r.k, r.x, r.y, r.date) for r in state.read_evolved(spark, path).collect())
    assert got == [(1, 1.0, None, "d1"), (3, None, "new", "d2")]
    for bad in ("k string, date string", "k double, date string"):
        with pytest.raises(ValueError, match="column k"):
            state.write_evolved(spark.createDataFrame([], bad), path)
    assert state.read_evolved(spark, path).count() == 2


def test_candidates_document(spark, tmp_path):
    from spreadlab.operators import model as mdl
    schema = "name string, auc double, uri string"
    c = spark.createDataFrame([("b", 0.7, "u/b"), ("a", 0.7, "u/a"), ("z", 0.1, "u/z"), (None, 0.9, "u"), ("q", 0.8, None)], schema)
    path = mdl.save_candidates(c, str(tmp_path / "c"))
    got = {r.name: r.is_best for r in mdl.load_candidates(spark, path).where("name IS NOT NULL AND uri IS NOT NULL").collect()}
    assert got == {"b": False, "a": True, "z": False} and mdl.best_candidate(c).first().name == "a"
    empty = mdl.save_candidates(c.where("uri IS NULL"), str(tmp_path / "e"))
    with pytest.raises(Exception, match="no best model"):
        mdl.load_candidates(spark, empty).collect()
