"""Small shared pieces of the training-data operators."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path
from ..sources.tables import read_table


ROWS_PER_TASK = 20_000
DROP_BITS = 24           # 2 MiB


def saved(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder the cluster names.

    ``narrow``: rows of a few numbers.  Their count is observed while they are
    written, and the result is read in tasks of at least ``ROWS_PER_TASK`` rows: the
    many small steps of an operator then don't take the session's full shuffle
    width each (never more tasks than were written, and as many for large results)."""
    checkpoint_dir(df.sparkSession)
    if not narrow:
        return df.checkpoint(eager=True)
    seen = Observation()
    out = df.observe(seen, F.count("*").alias("n")).checkpoint(eager=True)
    return out.coalesce(max(1, -(-seen.get["n"] // ROWS_PER_TASK)))


def sized(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table that is probably small and read it back: its size is
    known when the next join is planned, so it is broadcast below Spark's limit
    without shuffling the other side first, and joined by shuffles beyond it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, columns) -> DataFrame:
    return read_table(spark, sf_dir, name, list(columns))


def held_out(doc_id: Column) -> Column:
    """The fold rule of the labelled tables: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def drop_marked(docs: DataFrame, marked: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                repeated: DataFrame | None = None) -> DataFrame:
    """Rows of ``docs`` without a row in ``marked`` (columns __id and __digest, see
    ``digest_of``; null ids compare equal); of the rows with a key in ``repeated``
    one stays.

    A bit table of fixed size over the keys' digests parts the rows while they are
    read: those it doesn't hold go on as they are, without a shuffle; the others
    (the keys' own rows and a few false hits) are joined with the keys."""
    keys = marked.select("__id", "__digest", F.lit(True).alias("__out"))
    if repeated is not None:
        keys = keys.unionByName(repeated.select("__id", "__digest", F.lit(False).alias("__out")))
    keys = saved(keys.distinct(), narrow=True)
    bits = docs.sparkSession.sparkContext.broadcast(bloom_bits(keys, "__digest", DROP_BITS))
    tagged = docs.withColumn("__dg", digest_of(F.col(text_col)))
    at = tagged.columns.index("__dg")

    def part(held: bool):
        def run(batches):
            for b in batches:
                hit = bloom_has(bits.value, b.column(at).to_numpy().view(np.uint64))
                yield b.filter(pa.array(hit == held))
        return tagged.mapInArrow(run, tagged.schema)

    out = keys.where("__out").select("__id", "__digest")
    some = part(True)
    some = some.join(out, some[id_col].eqNullSafe(out["__id"]) & (some["__dg"] == out["__digest"]), "left_anti")
    if repeated is not None:
        some = some.dropDuplicates([id_col, "__dg"])
    return part(False).unionByName(some).drop("__dg")


def digest_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def digest_ids(parts: Column) -> Column:
    """sha256 (lower-case hex) of a comma-joined string array."""
    return F.sha2(F.concat_ws(",", parts), 256)


def bloom_bits(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bit table of fixed size 2**bits holding every value of ``column`` (low bits).
    The table's size does not depend on the data: 2**bits / 8 bytes."""
    word = F.shiftrightunsigned(F.col(column), 6).bitwiseAND(F.lit((1 << (bits - 6)) - 1))
    rows = (hashes.select(word.alias("w"), F.expr(f"shiftleft(1L, CAST({column} & 63 AS INT))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())   # at most 2**(bits-6) rows of two numbers
    table_ = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table_[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(np.uint64)
    return table_


def bloom_has(table_: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which uint64 hashes may be in the bit table."""
    w = (h >> np.uint64(6)) & np.uint64(len(table_) - 1)
    return (table_[w.astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1


def stable_seed(*parts) -> int:
    return int.from_bytes(hashlib.sha256("|".join(map(str, parts)).encode()).digest()[:8], "big")
