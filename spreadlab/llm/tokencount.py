"""Token counts by a separator scan over flat token files.

``write_flat`` turns texts into token identifiers and writes them as flat files:
16-bit little-endian numbers, an end-of-document identifier after each text, no
index.  (Spark's text writer does it: the bytes of a text's tokens are the line,
the identifier is the line separator.)  ``count_tokens`` reads such files back in
blocks, finds the identifier with a vectorised comparison, and stitches texts
that cross blocks with a prefix scan over the blocks of each file: running
counts number the texts, the running position of the last separator gives each
text its start.

A file is read by one task, so files are kept small by the writer
(``ROWS_PER_FILE`` texts); any flat file up to Spark's 2 GB limit on binary
content can be counted.

Cases: null and empty texts have 0 tokens; the identifier never comes out of a
text (the strings of special tokens are ordinary text); tokens after a file's
last separator are a text of their own; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
END_OF_TEXT = 50256
BLOCK = 1 << 18          # tokens
ROWS_PER_FILE = 5000

_ENCODERS: dict = {}


def encoder(folder: str = TOKENIZERS, name: str = VOCABULARY):
    """Byte-pair encoder of a public vocabulary file, once per process."""
    if (folder, name) not in _ENCODERS:
        import base64
        import importlib.util
        import os

        import tiktoken
        spec = importlib.util.spec_from_file_location("public_tokenizers", os.path.join(folder, "__init__.py"))
        public = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(public)
        with open(os.path.join(folder, name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[(folder, name)] = tiktoken.Encoding("public", pat_str=public.PATTERN, mergeable_ranks=ranks,
                                                      special_tokens={})
    return _ENCODERS[(folder, name)]


def write_flat(docs: DataFrame, path: str, text_col: str = "text", folder: str = TOKENIZERS,
               name: str = VOCABULARY, end: int = END_OF_TEXT) -> None:
    """Write the tokens of every text as flat 16-bit files with ``end`` after each text."""

    def run(batches):
        enc = encoder(folder, name)
        for b in batches:
            out = [np.asarray(enc.encode_ordinary(t or ""), dtype="<u2").tobytes() for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array(out, pa.binary())], names=["tokens"])

    separator = int(end).to_bytes(2, "little").decode("latin-1")
    (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "tokens binary")
     .select(F.col("tokens").cast("string").alias("value"))
     .write.option("lineSep", separator).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", ROWS_PER_FILE).text(path))


def scan_blocks(spark: SparkSession, path: str, end: int = END_OF_TEXT, block: int = BLOCK) -> DataFrame:
    """(file, block, first, n_tokens, ends): separator positions of every block, in the file's tokens."""

    def run(batches):
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                tokens = np.frombuffer(content.as_buffer(), dtype="<u2")
                for i, lo in enumerate(range(0, len(tokens), block)):
                    part = tokens[lo: lo + block]
                    ends = np.flatnonzero(part == end) + lo
                    yield pa.record_batch(
                        [pa.array([file]), pa.array([i], pa.int64()), pa.array([lo], pa.int64()),
                         pa.array([len(part)], pa.int64()), pa.array([ends.tolist()], pa.list_(pa.int64()))],
                        names=["file", "block", "first", "n_tokens", "ends"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(
        run, "file string, block bigint, first bigint, n_tokens bigint, ends array<bigint>")


def count_tokens(spark: SparkSession, path: str, end: int = END_OF_TEXT, block: int = BLOCK) -> DataFrame:
    """(file, doc_index, first_token, n_tokens) of every text of the flat files."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (scan_blocks(spark, path, end, block)
              .withColumn("done", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)))
              .withColumn("open", F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(before) + 1, F.lit(0).cast("bigint")))
              .withColumn("stop", F.col("first") + F.col("n_tokens"))
              .withColumn("final", F.max("stop").over(Window.partitionBy("file")) == F.col("stop")))
    tail = F.col("final") & (F.coalesce(F.try_element_at("ends", F.lit(-1)) + 1, F.col("open")) < F.col("stop"))
    ends = F.when(tail, F.concat("ends", F.array("stop"))).otherwise(F.col("ends"))
    each = blocks.select("file", "done", "open", "ends", F.posexplode(ends).alias("i", "at"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.try_element_at("ends", F.col("i")) + 1)
    return each.select("file", (F.col("done") + F.col("i")).cast("bigint").alias("doc_index"),
                       start.alias("first_token"), (F.col("at") - start).alias("n_tokens"))


def report(docs: DataFrame) -> DataFrame:
    """Counts of a table's texts through flat files in the shared folder, by file number."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_flat(docs, path)
    number = (F.regexp_extract("file", r"part-(\d+)-", 1).cast("bigint") * 100000
              + F.coalesce(F.regexp_extract("file", r"-c(\d+)", 1).try_cast("bigint"), F.lit(0)))
    return count_tokens(spark, path).select(number.alias("file_no"), "doc_index", "first_token", "n_tokens")
