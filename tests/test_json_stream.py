import json
import os
import tempfile

import pytest

from spreadlab.sources.screened import load_screened, read_pair_list, read_screened


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_screened_shapes(spark):
    d = tempfile.mkdtemp(prefix="spreadlab-json-", dir="/tmp")
    cases = {
        "a.json": (json.dumps({"data": {"selected_pairs": [{"symbol1": "AAA/USDT", "symbol2": "BBB"}, "CCC",
                                                           {"pair": "DDD"}, {"base": "", "s1": "EEE", "quote": 5}]}}),
                   ["AAA/USDT", "BBB", "CCC", "DDD", "EEE"]),
        "b.json": ('{"symbols": ["X1", 3, "X2"]}\nnot json\n{"top_symbols": ["X2", "X3"]}\n', ["X1", "X2", "X3"]),
        "c.json": ('["Z1", "Z2", "Z1"]', ["Z1", "Z2"]),
        "d.json": ('{"selected_symbols": [], "pairs": ["P1", {"symbol": "P2"}]}', ["P1", "P2"]),
        "f.json": (json.dumps({"data": {"data": {"data": {"data": {"data": {"data": {"symbols": ["D1", "D2"]}}}}}}}), ["D1", "D2"]),
        "g.json": (json.dumps({"x": {"data": 1}, "data": [{"s1": "L1", "s2": "L2"}, "L1"]}), ["L1", "L2"]),
        "e.json": ('{\n  "symbols": [\n    "M1",\n    "M2"\n  ]\n}\n', ["M1", "M2"]),
    }
    for name, (text, want) in cases.items():
        p = _write(d, name, text)
        assert [r["symbol"] for r in read_screened(spark, p).collect()] == want, name


def test_screened_fallback(spark):
    d = tempfile.mkdtemp(prefix="spreadlab-json-", dir="/tmp")
    p = _write(d, "empty.json", '{"other": 1}')
    fb = spark.createDataFrame([("U1",), ("U2",), ("U1",)], "symbol string")
    assert sorted(r["symbol"] for r in load_screened(spark, p, fb).collect()) == ["U1", "U2"]


def test_pair_list(spark):
    d = tempfile.mkdtemp(prefix="spreadlab-json-", dir="/tmp")
    p = _write(d, "pairs.json", json.dumps({"pairs": [["B", "A"], ["A", "C"], ["X"], ["Q", "R", "S"]]}))
    bars = spark.createDataFrame([("Z",)], "symbol string")
    assert sorted(r["symbol"] for r in read_pair_list(spark, p, bars).collect()) == ["A", "B", "C"]
    p2 = _write(d, "none.json", json.dumps({"symbols": ["A"]}))
    bars2 = spark.createDataFrame([(f"S{i:02d}",) for i in range(60)], "symbol string")
    for path in (p2, os.path.join(d, "missing.json")):
        assert read_pair_list(spark, path, bars2).count() == 60
    assert [r["symbol"] for r in read_pair_list(spark, p2, bars2, 5).collect()] == [f"S{i:02d}" for i in range(5)]
    assert load_screened(spark, os.path.join(d, "missing.json"), bars2).count() == 60


T0 = 1_704_067_200_000
LATER = [
    [("A/USDT", T0 + h * 3_600_000, 1.0, 2.0, 0.5, 10.0 + h, 10.0, 1) for h in range(5)],
    [("A/USDT", T0 // 1000 + h * 3600, 1.0, 2.0, 0.5, 4.0 + h, 10.0, 2) for h in range(3, 8)],      # seconds, lower
    [("B/USDT", T0, 1.0, 2.0, 0.5, 3.0, 10.0, 3), ("A/USDT", T0 + 3_600_000, 1.0, 2.0, 0.5, 2.0, 10.0, 3)],
]
WANT = {("AUSDT", 0): 10.0, ("AUSDT", 1): 2.0, ("AUSDT", 2): 12.0, ("BUSDT", 0): 3.0, **{("AUSDT", h): 4.0 + h for h in range(3, 8)}}


def _table(spark, table):
    from spreadlab.streaming import ingest as stream
    return {(r["symbol"], r["ts"].hour): r["close"] for r in stream.current_table(spark, table).collect()}


@pytest.mark.parametrize("per_trigger", [1, 8])
def test_stream_keeps_the_newest_landing_row(spark, per_trigger):
    """Corrections that are lower win, also when one micro-batch holds a key twice."""
    from spreadlab.streaming import ingest as stream
    landing, table, ckpt = stream.stream_ingest_dirs(tempfile.mkdtemp(prefix="spreadlab-stream-", dir="/tmp"))
    for b in LATER:
        spark.createDataFrame(b, stream.LANDING_SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    for _ in range(2):                                  # the second drain finds no new file and changes nothing
        stream.stream_ingest(spark, landing, table, ckpt, max_files_per_trigger=per_trigger)
        assert _table(spark, table) == WANT


def test_late_file_does_not_undo_a_correction(spark):
    from spreadlab.streaming import ingest as stream
    _, table, _ = stream.stream_ingest_dirs(tempfile.mkdtemp(prefix="spreadlab-stream-", dir="/tmp"))
    for i in (0, 2, 1):
        stream.merge_batch(spark, spark.createDataFrame(LATER[i], stream.LANDING_SCHEMA), i, table)
    assert _table(spark, table) == WANT


def test_crash_between_stage_and_publish(spark, monkeypatch):
    """A batch that dies while it publishes is published from its stage by the retry,
    not merged again from the half-written table."""
    from spreadlab.sources import sinks
    from spreadlab.streaming import ingest as stream
    _, table, _ = stream.stream_ingest_dirs(tempfile.mkdtemp(prefix="spreadlab-stream-", dir="/tmp"))
    stream.merge_batch(spark, spark.createDataFrame(LATER[0], stream.LANDING_SCHEMA), 0, table)

    def die(df, path, partition="date"):
        sinks_publish(df.limit(1), path, partition)     # half of it
        raise OSError("lost")

    sinks_publish = sinks.write_partitions
    batch = spark.createDataFrame(LATER[1] + LATER[2][1:], stream.LANDING_SCHEMA)
    monkeypatch.setattr(sinks, "write_partitions", die)
    with pytest.raises(OSError):
        stream.merge_batch(spark, batch, 1, table)
    assert _table(spark, table) != {k: v for k, v in WANT.items() if k[0] == "AUSDT"}
    monkeypatch.setattr(sinks, "write_partitions", sinks_publish)
    stream.merge_batch(spark, batch, 1, table)
    assert _table(spark, table) == {k: v for k, v in WANT.items() if k[0] == "AUSDT"}


def test_a_new_run_loses_nothing(spark):
    """Two runs over one table, the second from a fresh checkpoint with batch numbers from 0 again."""
    from spreadlab.streaming import ingest as stream
    base = tempfile.mkdtemp(prefix="spreadlab-stream-", dir="/tmp")
    _, table, _ = stream.stream_ingest_dirs(base)
    for i, rows in enumerate([LATER[0], LATER[2] + LATER[1]]):
        landing = os.path.join(base, f"landing{i}")
        spark.createDataFrame(rows, stream.LANDING_SCHEMA).coalesce(1).write.parquet(landing)
        stream.stream_ingest(spark, landing, table, os.path.join(base, f"ckpt{i}"))
    assert _table(spark, table) == WANT
    assert not os.listdir(f"{table}_staging")


def test_a_new_run_mends_what_a_dead_one_left(spark, monkeypatch):
    """A run that died while it published is not retried; the next run's first batch merges its stage."""
    from spreadlab.sources import sinks
    from spreadlab.streaming import ingest as stream
    _, table, _ = stream.stream_ingest_dirs(tempfile.mkdtemp(prefix="spreadlab-stream-", dir="/tmp"))
    stream.merge_batch(spark, spark.createDataFrame(LATER[0], stream.LANDING_SCHEMA), 0, table)
    publish = sinks.write_partitions

    def die(df, path, partition="date"):
        publish(df.limit(1), path, partition)
        raise OSError("lost")

    monkeypatch.setattr(sinks, "write_partitions", die)
    with pytest.raises(OSError):
        stream.merge_batch(spark, spark.createDataFrame(LATER[1], stream.LANDING_SCHEMA), 1, table)
    monkeypatch.setattr(sinks, "write_partitions", publish)
    stream.merge_batch(spark, spark.createDataFrame(LATER[2], stream.LANDING_SCHEMA), 0, table)
    assert _table(spark, table) == WANT


def test_stateful_ingest(spark):
    """State drops what is older; a restart, a fresh checkpoint and compaction leave the bars as they are."""
    from spreadlab.streaming import ingest as stream
    landing, table, ckpt = stream.stream_ingest_dirs(tempfile.mkdtemp(prefix="spreadlab-stream-", dir="/tmp"))

    def bars():
        rows = stream.newest_bars(spark, table).collect()
        assert len({(r["symbol"], r["ts"]) for r in rows}) == len(rows)
        return {(r["symbol"], r["ts"].hour): r["close"] for r in rows}

    for i in (0, 2, 1):
        spark.createDataFrame(LATER[i], stream.LANDING_SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        stream.stateful_ingest(spark, landing, table, ckpt)
    assert bars() == WANT
    logged = spark.read.parquet(table).count()
    assert logged == sum(map(len, LATER))
    old = [LATER[0][0][:7] + (0,), LATER[0][1][:7] + (None,)]           # older than what is held
    spark.createDataFrame(old, stream.LANDING_SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    stream.stateful_ingest(spark, landing, table, ckpt)
    assert spark.read.parquet(table).count() == logged and bars() == WANT
    stream.stateful_ingest(spark, landing, table, f"{ckpt}_fresh", max_files_per_trigger=8)
    assert spark.read.parquet(table).count() > logged and bars() == WANT
    dates = [r[0] for r in spark.read.parquet(table).select("date").distinct().collect()]
    stream.compact_dates(spark, table, dates)
    assert spark.read.parquet(table).count() == len(WANT) and bars() == WANT


def test_documents_with_many_data_keys_and_deep_levels(spark):
    d = tempfile.mkdtemp(prefix="spreadlab-json-", dir="/tmp")
    many = _write(d, "many.json", json.dumps({"pairs": [{"symbol": f"S{i}", "data": {"data": i}} for i in range(10_000)]}))
    assert [r["symbol"] for r in read_screened(spark, many).collect()] == [f"S{i}" for i in range(10_000)]
    doc = {"symbols": ["DEEP"]}
    for _ in range(200):
        doc = {"data": doc, "symbols": []}
    lines = [json.dumps(doc), json.dumps({"data": ["L1"]}), "no json", json.dumps({"data": {"data": 5}, "pairs": ["P"]})]
    deep = _write(d, "deep.json", "\n".join(lines))
    assert [r["symbol"] for r in read_screened(spark, deep).collect()] == ["DEEP", "L1", "P"]


def test_pair_lines(spark):
    from spreadlab.sources.screened import write_pair_list
    d = tempfile.mkdtemp(prefix="spreadlab-json-", dir="/tmp")
    pairs = spark.createDataFrame([("B", "A"), ("A", "C")], "sym_a string, sym_b string").repartition(2)
    path = write_pair_list(pairs, os.path.join(d, "pairs"))
    bars = spark.createDataFrame([("Z",)], "symbol string")
    assert sorted(r["symbol"] for r in read_pair_list(spark, path, bars, lines=True).collect()) == ["A", "B", "C"]
