"""Chunked windows: bounded-frame window functions without a task per key.

``Window.partitionBy(key)`` gives every key to one task.  A key that holds a
large share of the rows (or too few keys for the cores) then serialises the
work.  Frames here are bounded (at most ``back`` rows behind and ``fwd`` rows
ahead of the current row), so each key's ordered rows can be cut into chunks, each
carrying copies of the rows its frames reach (halo rows).  Window functions
evaluated over ``partitionBy(key, chunk)`` then see exactly the frame the
unchunked window would see for every row of the chunk's core, and halo rows are
dropped afterwards.

A chunk is a run of whole buckets (by default UTC days) that begin within the same
``chunk_rows`` rows of the key, and its halo is whole buckets too, so where a row goes
follows from its key and bucket alone: a small map made from the counts per
(key, bucket).  The rows themselves need no ordinal and no scan; they meet the map
in an equi-join (a broadcast while the map measures small) and move once, to their
chunk.  A task is bounded by ``chunk_rows`` plus the halo plus one bucket: choose a
bucket that a task can hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import checkpoint_dir

BUCKET, CHUNK, OWN = "_bucket", "_chunk", "_own"


def chunk_map(df: DataFrame, keys: list[str], bucket: Column, back: int, fwd: int, chunk_rows: int) -> DataFrame:
    """(keys, bucket, own, chunks): the chunk of each bucket and all chunks that need its rows.

    With a bucket's rows at positions start .. end - 1 of its key, a later bucket needs
    them if it starts below end + back, an earlier one if it ends above start - fwd.
    Chunk numbers rise with the position, so the last (first) such bucket bounds them."""
    counts = df.groupBy(*keys, bucket.alias(BUCKET)).agg(F.count(F.lit(1)).alias("_n"))
    by_key = Window.partitionBy(*keys)
    w = by_key.orderBy(BUCKET)
    end = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at = counts.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_n"))
    at = at.withColumn(OWN, F.floor(F.col("_start") / F.lit(chunk_rows)).cast("long"))
    first = last = F.col(OWN)
    if back:
        reach = F.max(OWN).over(by_key.orderBy("_start").rangeBetween(0, back - 1))
        at = at.withColumn("_reach", reach)
        last = F.coalesce(F.lead("_reach").over(w), last)
    if fwd:
        since = F.min(OWN).over(by_key.orderBy("_end").rangeBetween(1 - fwd, 0))
        at = at.withColumn("_since", since)
        first = F.coalesce(F.lag("_since").over(w), first)
    return at.select(*keys, BUCKET, OWN, F.sequence(first, last).alias("_chunks"))


def chunked_windows(df: DataFrame, keys: list[str], order: str, back: int, fwd: int,
                    build: Callable[[DataFrame, WindowSpec], DataFrame],
                    bucket: Column | None = None, chunk_rows: int = 2048,
                    partitions: int | None = None, write_once: bool = False) -> DataFrame:
    """Apply ``build(frame, w)`` -- window columns defined with ``w`` and frames
    reaching at most ``back`` rows back and ``fwd`` rows ahead (chained windows
    add their reaches) -- with tasks bounded by chunk, halo and bucket.

    ``bucket`` is a coarse bucket that rises with ``order`` (default: the UTC day of
    ``order``); keys are expected unique on keys + order, and rows with a null key or
    order are dropped.  ``df`` is read twice (its keys for the counts, then its rows), so it must
    give the same rows each time; ``write_once`` writes it first, for rows that come out of a
    join, which would run twice.  The chunks are hash-placed on ``partitions`` partitions
    (default ``spark.sql.shuffle.partitions``) with an explicit repartition: it
    satisfies the window's distribution (no extra exchange) and keeps AQE from
    coalescing a small but CPU-heavy window stage into a couple of tasks."""
    bucket = bucket if bucket is not None else F.to_date(F.col(order))
    if write_once:
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    where = chunk_map(df, keys, bucket, back, fwd, chunk_rows)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.withColumn(BUCKET, bucket).join(where, [*keys, BUCKET])
              .withColumn(CHUNK, F.explode("_chunks")).repartition(n, *keys, CHUNK))
    out = build(tagged, Window.partitionBy(*keys, CHUNK).orderBy(order))
    return out.filter(F.col(CHUNK) == F.col(OWN)).drop(BUCKET, CHUNK, OWN, "_chunks")
