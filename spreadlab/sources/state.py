"""State that runs keep between each other (S10) and tables whose columns grow (K4).

The watermark document is ``{timeframe: {symbol: epoch ms}}``.  Every run writes it
to a folder of its own, numbered upwards, and only after its bars are in the table; the
newest folder with a success mark is the state.  A run that dies between the two
leaves the older state: the next one takes the same bars again, and the keyed upsert
puts them where they are, so nothing is lost and nothing comes twice.

A growing table keeps its columns in a document beside it, so that a read needs no
footer of old files: columns added later are null in old partitions.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .bars import newer_than, watermarks
from .sinks import _path, exists, merge_partitions, write_partitions

WATERMARKS = "timeframe string, symbol string, wm_ms bigint"


def _versions(spark: SparkSession, base: str) -> list[str]:
    """Complete version folders under ``base``, oldest first (one small listing)."""
    p, fs = _path(spark, base)
    names = sorted(str(x.getPath().getName()) for x in fs.listStatus(p)) if fs.exists(p) else []
    return [f"{base}/{n}" for n in names if n.startswith("v") and exists(spark, f"{base}/{n}/_SUCCESS")]


def _next_version(spark: SparkSession, base: str) -> str:
    done = _versions(spark, base)
    return f"{base}/v{int(done[-1].rsplit('/v', 1)[1]) + 1 if done else 0:09d}"


def read_watermarks(spark: SparkSession, base: str) -> DataFrame:
    """(timeframe, symbol, wm_ms) of the newest watermark document; no rows without one."""
    done = _versions(spark, base)
    if not done:
        return spark.createDataFrame([], WATERMARKS)
    doc = spark.read.text(done[-1]).select(F.from_json("value", "map<string,map<string,bigint>>").alias("m"))
    return (doc.select(F.explode("m").alias("timeframe", "by"))
            .select("timeframe", F.explode("by").alias("symbol", "wm_ms")))


def publish_watermarks(wm: DataFrame, base: str) -> str:
    """Write the state of (timeframe, symbol), a line a timeframe, as the next version.
    A line holds one number a symbol: its size is the universe's."""
    path = _next_version(wm.sparkSession, base)
    lines = (wm.groupBy("timeframe").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("symbol", "wm_ms")))).alias("by"))
             .select(F.to_json(F.create_map("timeframe", "by")).alias("value")))
    lines.write.mode("overwrite").text(path)
    return path


def incremental_run(spark: SparkSession, source: DataFrame, table_dir: str, state_dir: str, token: str = "run") -> None:
    """Bars of ``source`` (timeframe, symbol, ts, date, ...) later than their watermark go into the
    table; then the watermarks move on."""
    old = read_watermarks(spark, state_dir)
    merge_partitions(spark, table_dir, newer_than(source, old), ["timeframe", "symbol", "ts"], [], token)
    seen = watermarks(spark.read.parquet(table_dir)) if exists(spark, table_dir) else old
    publish_watermarks(seen.unionByName(old).groupBy("timeframe", "symbol").agg(F.max("wm_ms").alias("wm_ms")), state_dir)


# -- K4 ------------------------------------------------------------------------------
def _columns(spark: SparkSession, path: str) -> StructType | None:
    done = _versions(spark, f"{path}_columns")
    return StructType.fromJson(json.loads(spark.read.text(done[-1], wholetext=True).first()[0])) if done else None


def write_evolved(df: DataFrame, path: str, partition: str = "date") -> str:
    """K4: overwrite the partitions that ``df`` holds; columns that are new to the table are added
    to it, columns that ``df`` lacks are null in these partitions, integers and floats are widened
    to the table's type.  A type that the table's can't hold is an error and nothing is written."""
    spark = df.sparkSession
    old = _columns(spark, path)
    new = StructType(list(old.fields) if old else [])
    known = {f.name: f.dataType for f in new}
    widened = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4, "float": 11, "double": 12}
    for f in df.schema:
        if f.name not in known:
            new.add(f.name, f.dataType)
            continue
        a, b = f.dataType.simpleString(), known[f.name].simpleString()
        fits = a in widened and b in widened and (widened[a] < 10) == (widened[b] < 10) and widened[a] <= widened[b]
        if a != b and not fits:
            raise ValueError(f"column {f.name}: {a} doesn't go into the table's {b}")
    have = set(df.columns)
    rows = df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in new])
    if old is None or len(new) > len(old):             # before the rows: old files read as null under more columns
        spark.createDataFrame([(new.json(),)], "value string").coalesce(1).write.text(_next_version(spark, f"{path}_columns"))
    return write_partitions(rows, path, partition)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """K4: the table with all columns it has ever been given."""
    return spark.read.schema(_columns(spark, path)).parquet(path)
