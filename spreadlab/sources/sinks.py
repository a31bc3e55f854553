"""Sinks: key upserts without a transactional table format, overwrite, JSON
exports, model records, views and row-count audits.

MERGE INTO needs a table format with row-level operations; on plain parquet
the same result is a left-anti join plus a union, written to a fresh folder
and then published (never overwriting a path that the plan is reading).
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def dedupe_latest(source: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order`` (among equal orders
    the greatest row value, so that any run keeps the same one).  A grouped
    ``max_by`` is partially aggregated map-side, so a key with many duplicates
    never lands whole in one task."""
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.dropDuplicates(keys)
    payload = F.struct(*[F.col(c) for c in rest])
    by = [order] if isinstance(order, str) else list(order)
    return (source.groupBy(*keys).agg(F.max_by(payload, F.struct(*by, payload)).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """K1: matched -> the source row replaces the target row; not matched -> insert.
    ``order`` says which of several source rows of one key is the latest; it need
    not be a column of the target.  Null keys never match (SQL ``=``), so they
    are always inserted."""
    src = dedupe_latest(source, keys, order).select(*target.columns)
    matched = src.select(*keys).na.drop("any", subset=keys)
    kept = target.join(matched, keys, "left_anti")
    return kept.unionByName(src)


def upsert_partial(target: DataFrame, source: DataFrame, keys: list[str], set_cols: list[str]) -> DataFrame:
    """K2: matched -> update only ``set_cols`` (null updates kept), not matched ->
    insert the source's columns; other target columns stay as they are.  Several source
    rows of one key that the target has are an error, raised while the plan runs (a merge
    can't tell which of them is meant); null keys match nothing and are all inserted."""
    t = target.withColumn("_t_hit", F.lit(True))
    each = F.struct(*[F.col(c) for c in [*keys, *set_cols]])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # a grouped count, combined on the map side; rows with a null key stay as they are
    one = (source.where(known).groupBy(*[F.col(k).alias(f"_s_{k}") for k in keys])
           .agg(F.count("*").alias("_s_n"), F.max_by(F.struct(*[F.col(c) for c in set_cols], F.lit(1).alias("_one")), each).alias("_s_row"))
           .select(*[f"_s_{k}" for k in keys], *[F.col(f"_s_row.{c}").alias(f"_s_{c}") for c in set_cols], "_s_n"))
    rest = source.where(~known).select(*[F.col(c).alias(f"_s_{c}") for c in [*keys, *set_cols]],
                                       F.lit(1).cast("bigint").alias("_s_n"))
    s = one.unionByName(rest).withColumn("_s_hit", F.lit(True))
    cond = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    j = t.join(s, cond, "full_outer")
    several = F.raise_error(F.concat(F.lit("several source rows match a target row: "),
                                     F.to_json(F.struct(*[F.col(f"_s_{k}").alias(k) for k in keys]))))
    j = j.withColumn("_s_hit", F.when(F.col("_s_n") > 1, several.cast("boolean")).otherwise(F.col("_s_hit")))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.when(F.col("_t_hit"), F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c))
        elif c in set_cols:
            out.append(F.when(F.col("_s_hit"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("_t_hit"), F.col(c)).alias(c))
    return j.select(*out)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """K4/K9: overwrite a table folder (optionally partitioned, e.g. by date)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def merge_partitions(spark: SparkSession, table_dir: str, source: DataFrame, keys: list[str],
                     order: str | list[str], token: str, partition: str = "date", versioned: bool = False) -> None:
    """K1/K9: upsert into a table partitioned by ``partition``, touching only the
    partitions that the source names; the cost follows the batch.  One writer a table.

    The merged partitions are staged first, then published, then the stage goes: a stage
    that is still there belongs to a run that died while it overwrote partitions.
    ``versioned``: the order column is part of the table and old rows compete with it, so
    whatever whole stages are found, of any run, are merged in again and nothing of a
    half-published batch is lost.  Otherwise a source row always wins, and a run that finds
    the whole stage of its own ``token`` publishes that."""
    root = f"{table_dir.rstrip('/')}_staging"
    whole = _whole_stages(spark, root, None if versioned else token)
    stage = f"{root}/{token}-{uuid.uuid4().hex[:12]}"
    if versioned or not whole:
        waiting = [spark.read.parquet(w) for w in whole]
        source = functools.reduce(lambda a, b: a.unionByName(b.select(*a.columns)), waiting, source)
        # bounded by the calendar: the dates of one batch
        touched = [r[0] for r in source.select(partition).distinct().collect()]
        if not touched:
            return
        if exists(spark, table_dir):
            old = spark.read.parquet(table_dir).filter(F.col(partition).isin(touched))     # partition pruning
            if versioned:
                merged = dedupe_latest(old.unionByName(source.select(*old.columns)), keys, order)
            else:
                merged = upsert(old, source, keys, order)
        else:
            merged = dedupe_latest(source, keys, order)
        merged.write.parquet(stage)                            # never read and overwrite one path
    else:
        stage = whole[-1]
    write_partitions(spark.read.parquet(stage), table_dir, partition)
    for done in {stage, *whole}:
        _path(spark, done)[1].delete(_path(spark, done)[0], True)


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _whole_stages(spark: SparkSession, root: str, token: str | None) -> list[str]:
    """Stages under ``root`` that were written to the end (of ``token``, or all)."""
    p, fs = _path(spark, root)
    if not fs.exists(p):
        return []
    names = sorted(str(x.getPath().getName()) for x in fs.listStatus(p))
    return [f"{root}/{n}" for n in names if (token is None or n.rsplit("-", 1)[0] == token) and exists(spark, f"{root}/{n}/_SUCCESS")]


def write_partitions(df: DataFrame, path: str, partition: str = "date") -> str:
    """Overwrite the partitions that ``df`` holds.  Rows are rebalanced by partition
    value: few files a partition, and Spark splits one that is large.  (A dynamic
    overwrite leaves no _SUCCESS file; a new table is written in the plain way.)"""
    how = "dynamic" if exists(df.sparkSession, path) else "static"
    (df.hint("rebalance", F.col(partition)).write.mode("overwrite")
     .option("partitionOverwriteMode", how).partitionBy(partition).parquet(path))
    return path


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def upsert_table(spark: SparkSession, target_path: str | None, source: DataFrame, keys: list[str],
                 order: str | list[str], partition_by: list[str] | None = None) -> str:
    """Upsert of a table without partitions: the merged table goes to a new folder,
    which the caller publishes as the current version (see ``merge_partitions``
    for partitioned tables)."""
    out = scratch_path(spark, "upsert")
    if target_path is None:
        merged = dedupe_latest(source, keys, order)
    else:
        merged = upsert(spark.read.parquet(target_path), source, keys, order)
    write_table(merged, out, partition_by)
    return out


def export_symbols_json(pairs: DataFrame, path: str) -> str:
    """K5: {"symbols": [sorted distinct legs]} written as one JSON document."""
    legs = pairs.select(F.explode(F.array("sym_a", "sym_b")).alias("s"))
    doc = legs.select(F.replace("s", F.lit("/"), F.lit("")).alias("s")).distinct().agg(
        F.sort_array(F.collect_list("s")).alias("symbols"))
    doc.coalesce(1).write.mode("overwrite").json(path)
    return path


def count_rows(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Row count gathered while the plan runs (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
