"""Incremental bar ingest with Structured Streaming.

New landing files are picked up by a file stream (``availableNow`` drains
what is there and stops; the timer loop of the reference becomes a scheduled
trigger), cleaned with the batch rules, and upserted into the bar table by
``foreachBatch``.  Every row carries its landing sequence (``seq``) from the file
to the table; of the rows of one key the newest sequence stays, whatever the
values are.

The bar table is parquet partitioned by ``date``.  A micro-batch touches only
the dates it carries: the current rows of those partitions (partition
pruning) are merged with the batch -- newer landing sequence wins, so a late
file cannot overwrite a newer correction -- staged, and written back with
dynamic partition overwrite; then the stage goes.  The cost of a batch is the
size of its partitions, not of the table.  A stage that is still there when the
next batch of any run begins (with the same checkpoint, or a fresh one) is merged
with it, so a crash in the middle of publishing loses nothing.  The checkpoint
and staging folders live under the cluster's shared ``spark.checkpoint.dir``.

``stateful_ingest`` reads and rewrites no partition at all.  Keyed state of the
query holds the newest landing sequence of every bar, a (symbol, date) an entry;
a micro-batch appends the bars that are new or newer to a log partitioned by date,
and ``newest_bars`` takes the newest row of each key from it (one grouped aggregate
under a pruned scan).  An entry that no bar has touched for ``keep_ms`` expires: a bar
that comes later still is appended and competes by its sequence when it is read, so
neither expiry, nor a batch that is appended twice, nor a fresh checkpoint over an old
log changes the result.  ``compact_dates`` rewrites the dates that have settled.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType, DoubleType

from ..sources.bars import clean_bars
from ..sources.sinks import dedupe_latest, exists, merge_partitions

LANDING_SCHEMA = StructType([
    StructField("SYMBOL", StringType()), StructField("TIMESTAMP", LongType()),
    StructField("Open", DoubleType()), StructField("High", DoubleType()), StructField("Low", DoubleType()),
    StructField("Close", DoubleType()), StructField("Volume", DoubleType()), StructField("seq", LongType()),
])
KEYS = ["symbol", "ts"]


def current_table(spark: SparkSession, table_dir: str) -> DataFrame | None:
    return spark.read.parquet(table_dir) if exists(spark, table_dir) else None


def merge_batch(spark: SparkSession, batch: DataFrame, batch_id: int, table_dir: str) -> None:
    """foreachBatch body: clean (the landing sequence goes along), merge with the
    touched date partitions, publish."""
    merge_partitions(spark, table_dir, clean_bars(batch, keep=("seq",)), KEYS, "seq", f"batch-{batch_id}",
                     versioned=True)


def stream_ingest(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint: str,
                  max_files_per_trigger: int = 1):
    """Run the incremental ingest over everything in ``landing_dir`` and stop."""
    stream = (spark.readStream.schema(LANDING_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(landing_dir))
    q = (stream.writeStream
         .foreachBatch(lambda df, bid: merge_batch(spark, df, bid, table_dir))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q


def stream_ingest_dirs(base: str) -> tuple[str, str, str]:
    return (os.path.join(base, "landing"), os.path.join(base, "table"), os.path.join(base, "_checkpoint"))


# -- keyed state ---------------------------------------------------------------------
BAR = "symbol string, date date, ts timestamp, open double, high double, low double, close double, volume double, seq bigint"
KEEP_MS = 30 * 24 * 3600 * 1000
NO_SEQ = np.iinfo(np.int64).min


def newer_rows(key, frames: Iterator[pd.DataFrame], state: GroupState, keep_ms: int = KEEP_MS) -> Iterator[pd.DataFrame]:
    """Rows whose landing sequence is not older than the one held for their (symbol, date, ts).
    The state is two packed arrays: the bar times of one day and the newest sequence of each."""
    if state.hasTimedOut:
        state.remove()
        return
    frame = pd.concat(frames, ignore_index=True)
    at = frame["ts"].astype("datetime64[us]").astype("int64").to_numpy()
    seq = frame["seq"].astype("Int64").fillna(NO_SEQ).astype("int64").to_numpy()
    known = dict(zip(*(np.frombuffer(x, np.int64).tolist() for x in state.get))) if state.exists else {}
    newest = pd.Series(seq).groupby(at).max()
    news = {t: n for t, n in zip(newest.index.tolist(), newest.tolist()) if n >= known.get(t, NO_SEQ)}
    take = np.array([news.get(t) == n for t, n in zip(at.tolist(), seq.tolist())], dtype=bool)
    known |= news
    state.update(tuple(np.array(list(x), dtype=np.int64).tobytes() for x in (known, known.values())))
    state.setTimeoutDuration(keep_ms)
    yield frame[take]


def stateful_ingest(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint: str,
                    max_files_per_trigger: int = 1, keep_ms: int = KEEP_MS):
    """Append what is new in ``landing_dir`` to the bar log and stop."""
    landed = (spark.readStream.schema(LANDING_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(landing_dir))
    columns = [c.strip().split()[0] for c in BAR.split(",")]
    newer = (clean_bars(landed, keep=("seq",)).select(*columns).groupBy("symbol", "date")
             .applyInPandasWithState(functools.partial(newer_rows, keep_ms=keep_ms), BAR, "at binary, seq binary", "append",
                                     GroupStateTimeout.ProcessingTimeTimeout))

    def append(batch: DataFrame, _: int) -> None:
        batch.hint("rebalance", F.col("date")).write.mode("append").partitionBy("date").parquet(table_dir)

    # expired entries go with the next batch that has rows; batches without rows would follow each
    # other for ever, since a processing-time timeout always asks for one more
    no_data = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(no_data)
    spark.conf.set(no_data, "false")
    try:
        q = (newer.writeStream.foreachBatch(append).outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set(no_data, before)
    q.awaitTermination()
    return q


def newest_bars(spark: SparkSession, table_dir: str) -> DataFrame:
    """The bars of a log: of each (symbol, ts) the row of the newest landing sequence.
    Filters on symbol, ts or date reach the scan (they are the grouping keys)."""
    log = spark.read.schema(BAR).parquet(table_dir)
    return dedupe_latest(log, ["symbol", "ts", "date"], "seq")


def compact_dates(spark: SparkSession, table_dir: str, dates: list) -> None:
    """Rewrite these dates of a log with one row a bar (staged first, so it may be run again)."""
    rows = newest_bars(spark, table_dir).where(F.col("date").isin(dates))
    merge_partitions(spark, table_dir, rows, KEYS, "seq", "compact", versioned=True)
