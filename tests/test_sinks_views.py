import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from spreadlab.operators import model as mdl
from spreadlab.operators import report
from spreadlab.sources import sinks, tables

T = dt.datetime(2024, 1, 1)


def _px(spark):
    data = [(T + dt.timedelta(minutes=5 * i), s, 100.0 + i + (3 if s == "B" else 0)) for i in range(10) for s in "AB"]
    return spark.createDataFrame(data, "ts timestamp, symbol string, close double")


def test_run_report_modes_and_views(spark):
    px = _px(spark)
    pair_sig = spark.createDataFrame([(T + dt.timedelta(minutes=5 * i), "A||B", 1.0, 0.7) for i in range(10)],
                                     "ts timestamp, pair string, beta double, proba double")
    out = report.run_report(pair_sig, px)
    assert out["mode"] == "pair" and out["total"].first()["rows"] == 9
    report.publish_views(out["rows"], px, out["mode"])
    assert spark.sql("SELECT count(*) FROM pair_pnl_5m").first()[0] == 9
    assert spark.sql("SELECT count(*) FROM prices_5m").first()[0] == 20
    single = spark.createDataFrame([(T + dt.timedelta(minutes=5 * i), "A", 1) for i in range(10)],
                                   "timestamp timestamp, symbol string, action int")
    out2 = report.run_report(single, px)
    assert out2["mode"] == "single" and out2["by_key"].first()["symbol"] == "A"


def test_write_table_partitioned_and_count_rows(spark):
    d = tempfile.mkdtemp(prefix="spreadlab-sink-", dir="/tmp")
    px = _px(spark).withColumn("date", F.to_date("ts"))
    path = sinks.write_table(px, os.path.join(d, "bars"), partition_by=["date"])
    assert os.path.isdir(os.path.join(path, "date=2024-01-01"))
    back = spark.read.parquet(path).filter(F.col("date") == F.lit("2024-01-01").cast("date"))
    assert back.count() == 20
    observed, obs = sinks.count_rows(back)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 20


def test_ensure_and_first_table(spark):
    d = tempfile.mkdtemp(prefix="spreadlab-tbl-", dir="/tmp")
    t = tables.ensure_table(spark, "spreadlab_t_signals", "ts TIMESTAMP, symbol STRING, prob FLOAT, signal INT",
                            os.path.join(d, "signals"))
    assert t.columns == ["ts", "symbol", "prob", "signal"]
    df, name = tables.first_table(spark, ["spreadlab_missing_tbl", "spreadlab_t_signals"])
    assert name == "spreadlab_t_signals"
    spark.sql("DROP TABLE spreadlab_t_signals")


def test_cap_sample(spark):
    df = spark.range(1000)
    assert mdl.cap_sample(df, 5000).count() == 1000
    n = mdl.cap_sample(df, 100).count()
    assert 50 < n < 160


def test_upsert_table_stage_and_publish(spark):
    from spreadlab.sources import bars as ingest
    d = tempfile.mkdtemp(prefix="spreadlab-up-", dir="/tmp")
    t0 = [("A", T + dt.timedelta(hours=h), 1.0, 1.0, 1.0, float(h), 1.0, (T + dt.timedelta(hours=h)).date())
          for h in range(4)]
    first = spark.createDataFrame(t0, ingest.BAR_SCHEMA)
    v1 = sinks.upsert_table(spark, None, first, ["symbol", "ts"], "volume", partition_by=["date"])
    src = spark.createDataFrame([("A", T + dt.timedelta(hours=3), 1.0, 1.0, 1.0, 9.0, 1.0, T.date()),
                                 ("A", T + dt.timedelta(hours=5), 1.0, 1.0, 1.0, 5.0, 1.0, T.date())],
                                ingest.BAR_SCHEMA)
    v2 = sinks.upsert_table(spark, v1, src, ["symbol", "ts"], "volume", partition_by=["date"])
    got = sorted((r["ts"].hour, r["close"]) for r in ingest.read_bars(spark, v2).collect())
    assert got == [(0, 0.0), (1, 1.0), (2, 2.0), (3, 9.0), (5, 5.0)]
    assert v1 != v2 and ingest.read_bars(spark, v1).count() == 4  # earlier version untouched


def test_merge_partitions_touches_only_the_batch_dates(spark):
    from spreadlab.sources import bars as ingest
    d = tempfile.mkdtemp(prefix="spreadlab-up-", dir="/tmp")
    day = dt.timedelta(days=1)
    rows_ = [("A", T + i * day, 1.0, 1.0, 1.0, float(i), 1.0, (T + i * day).date()) for i in range(5)]
    table = sinks.write_partitions(spark.createDataFrame(rows_, ingest.BAR_SCHEMA), os.path.join(d, "bars"))

    def files():
        return {os.path.join(b, f) for b, _, fs in os.walk(table) for f in fs if "date=" in b and f.startswith("part-")}

    before = files()
    src = spark.createDataFrame([("A", T + 2 * day, 1.0, 1.0, 1.0, 0.5, 1.0, (T + 2 * day).date()),
                                 ("B", T + 2 * day, 1.0, 1.0, 1.0, 7.0, 1.0, (T + 2 * day).date())], ingest.BAR_SCHEMA)
    sinks.merge_partitions(spark, table, src, ["symbol", "ts"], "close", "one")
    got = sorted((r["symbol"], r["ts"].day, r["close"]) for r in spark.read.parquet(table).collect())
    assert got == [("A", 1, 0.0), ("A", 2, 1.0), ("A", 3, 0.5), ("A", 4, 3.0), ("A", 5, 4.0), ("B", 3, 7.0)]
    assert len(before & files()) == 4
