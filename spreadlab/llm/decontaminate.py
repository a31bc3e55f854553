"""Benchmark decontamination: prefix-filtered set join of documents with the
word windows of benchmark items.

A window is ``window`` consecutive words of an item; an item with fewer words
(but not none) is one window.  Each window is a set of short shingles (runs of
three words, fewer if the window is shorter) ordered by rarity in the corpus.
For exact containment the necessary prefix of that order is one shingle: a
document that holds the window holds its rarest shingle.  So

1. one scan of the texts counts how often the benchmark's shingles occur;
2. each window keeps its rarest shingle and that shingle's offset;
3. a second scan emits the places where a document has a prefix shingle, with
   the words around it, and a join on the shingle proposes (place, window);
4. the length bound (the window must lie inside the document) and the position
   bound (start = place - offset) leave one place per pair, where the words are
   compared exactly.

Both scans test shingles against a bit table of fixed size (``BLOOM_BITS``), so
what is broadcast does not grow with the benchmark or the corpus; a false hit
only costs a failed comparison.

Cases: a null or word-less text has no words and no hits; a null or word-less
item has no windows; an item with a null id marks words but is not listed;
repeated rows are judged row by row; repeated items count once; an empty
benchmark leaves every document clean; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom_bits, bloom_has, digest_ids, digest_of, drop_marked, saved
from .textvec import Words, chunks, list_array, signed

WINDOW = 10
SHINGLE = 3
BLOOM_BITS = 22          # 512 KiB

_WINDOWS = "item_id string, words string, n int, shingles array<bigint>"
_HITS = ("rowkey string, doc_id {kind}, digest bigint, n_words bigint, "
         "places array<struct<h:bigint,pos:bigint,first:bigint,ctx:string>>")


def benchmark_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per (item, distinct window): its words, length and shingles in order."""

    def cut(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            for lo, _, data, offs in chunks(b.column(1)):
                w = Words(data, offs)
                out = {"item_id": [], "words": [], "n": []}
                sh: list[np.ndarray] = []
                grams = {k: _grams(w, k) for k in range(1, SHINGLE + 1)}
                for d in range(len(w.count)):
                    first, count = int(w.first[d]), int(w.count[d])
                    if not count:
                        continue
                    size = min(window, count)
                    k = min(SHINGLE, size)
                    text = w.words(first, first + count)
                    for s in range(count - size + 1):
                        out["item_id"].append(ids[lo + d])
                        out["words"].append(" ".join(text[s: s + size]))
                        out["n"].append(size)
                        sh.append(grams[k][first + s: first + s + size - k + 1])
                if out["n"]:
                    flat = np.concatenate(sh)
                    yield pa.record_batch(
                        [pa.array(out["item_id"], pa.string()), pa.array(out["words"], pa.string()),
                         pa.array(out["n"], pa.int32()),
                         list_array(signed(flat), np.array([len(x) for x in sh]))],
                        names=["item_id", "words", "n", "shingles"])

    src = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(cut, _WINDOWS).distinct()


def _grams(w: Words, k: int) -> np.ndarray:
    """Hash of the k words from each word on (runs over a text's end are never used)."""
    n = len(w)
    h = np.full(n, np.uint64(k), dtype=np.uint64)
    for j in range(k):
        part = np.zeros(n, dtype=np.uint64)
        part[: max(n - j, 0)] = w.hash[j:]
        h = h * np.uint64(0x9FB21C651E98DF25) + part
    from .textvec import mix
    return mix(h)


def _sizes(windows: DataFrame) -> list[int]:
    """Shingle lengths in use (at most SHINGLE values)."""
    return sorted(r[0] for r in windows.select(F.least(F.col("n"), F.lit(SHINGLE)).alias("k")).distinct().collect())


def _runs(w: Words, sizes: list[int], bits: np.ndarray):
    """(word position in the chunk, hash) of the runs that the bit table may hold."""
    at, hs = [], []
    for k in sizes:
        h = _grams(w, k)
        room = np.repeat(w.first + w.count, w.count) - np.arange(len(w)) >= k
        ok = np.flatnonzero(room & bloom_has(bits, h))
        at.append(ok)
        hs.append(h[ok])
    return np.concatenate(at) if at else np.zeros(0, np.int64), np.concatenate(hs) if hs else np.zeros(0, np.uint64)


def shingle_counts(docs: DataFrame, bits, sizes: list[int], text_col: str) -> DataFrame:
    """How often the corpus has each shingle that the bit table may hold."""

    def count(batches):
        for b in batches:
            for _, _, data, offs in chunks(b.column(0)):
                w = Words(data, offs)
                _, h = _runs(w, sizes, bits.value)
                if len(h):
                    u, c = np.unique(h, return_counts=True)
                    yield pa.record_batch([pa.array(signed(u)), pa.array(c, pa.int64())], names=["h", "n"])

    return (docs.select(F.col(text_col).alias("text")).mapInArrow(count, "h bigint, n bigint")
            .groupBy("h").agg(F.sum("n").alias("seen")))


def prefix_places(docs: DataFrame, bits, sizes: list[int], window: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document with the places of prefix shingles and the words around them."""
    kind = docs.schema[id_col].dataType.simpleString()

    def find(batches):
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            dig = b.column(2)
            for lo, hi, data, offs in chunks(b.column(1)):
                w = Words(data, offs)
                at, h = _runs(w, sizes, bits.value)
                order = np.argsort(at, kind="stable")
                at, h = at[order], h[order]
                doc = w.doc[at]
                lo_w = np.maximum(at - (window - 1), w.first[doc])
                hi_w = np.minimum(at + window, w.first[doc] + w.count[doc])
                ctx = [" ".join(w.words(a, z)) for a, z in zip(lo_w.tolist(), hi_w.tolist())]
                places = pa.StructArray.from_arrays(
                    [pa.array(signed(h)), pa.array(at - w.first[doc], pa.int64()),
                     pa.array(lo_w - w.first[doc], pa.int64()), pa.array(ctx, pa.string())],
                    names=["h", "pos", "first", "ctx"])
                off = np.zeros(hi - lo + 1, np.int32)
                np.cumsum(np.bincount(doc, minlength=hi - lo), out=off[1:])
                keys = [f"{part}:{seq + i}" for i in range(hi - lo)]
                seq += hi - lo
                yield pa.record_batch(
                    [pa.array(keys, pa.string()), b.column(0).slice(lo, hi - lo), dig.slice(lo, hi - lo),
                     pa.array(w.count, pa.int64()), pa.ListArray.from_arrays(pa.array(off), places)],
                    names=["rowkey", "doc_id", "digest", "n_words", "places"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      digest_of(F.col(text_col)).alias("digest"))
    return src.mapInArrow(find, _HITS.format(kind=kind))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, digest, n_words, n_hit, items (sorted ids), spans
    ([first word, end word) of each hit run), contaminated."""
    sc = docs.sparkSession.sparkContext
    windows = saved(benchmark_windows(items, window, item_col, item_text))
    sizes = _sizes(windows)
    each = windows.select("item_id", "words", "n", F.posexplode("shingles").alias("off", "h"))
    known = sc.broadcast(bloom_bits(each, "h", BLOOM_BITS))
    seen = shingle_counts(docs, known, sizes, text_col)
    prefix = saved(each.join(seen, "h", "left")
                   .groupBy("item_id", "words", "n")
                   .agg(F.min_by(F.struct("h", "off"), F.struct(F.coalesce("seen", F.lit(0)), "h", "off")).alias("p"))
                   .select("item_id", "words", "n", F.col("p.h").alias("h"), F.col("p.off").alias("off")))
    rare = sc.broadcast(bloom_bits(prefix, "h", BLOOM_BITS))
    rows = saved(prefix_places(docs, rare, sizes, window, id_col, text_col))
    found = rows.select("rowkey", "n_words", F.explode("places").alias("x")).select("rowkey", "n_words", "x.*")
    start = F.col("pos") - F.col("off")
    same = F.array_join(F.slice(F.split("ctx", " "), (F.col("start") - F.col("first") + 1).cast("int"), F.col("n")), " ")
    hits = (found.join(prefix, "h")
            .withColumn("start", start)
            .where((F.col("start") >= F.col("first")) & (F.col("start") + F.col("n") <= F.col("n_words")))
            .where(same == F.col("words")))
    run = F.struct(F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("z"))
    per = hits.groupBy("rowkey").agg(F.array_sort(F.collect_set(run)).alias("runs"),
                                     F.array_sort(F.collect_set("item_id")).alias("items"))
    out = rows.select("rowkey", "doc_id", "digest", "n_words").join(per, "rowkey", "left")
    none = F.array().cast("array<struct<a:bigint,z:bigint>>")
    spans = F.aggregate(
        F.coalesce("runs", none), none,
        lambda acc, r: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["z"] >= r["a"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1),
                                       F.array(F.struct(F.element_at(acc, -1)["a"].alias("a"),
                                                        F.greatest(F.element_at(acc, -1)["z"], r["z"]).alias("z")))))
        .otherwise(F.concat(acc, F.array(r))))
    out = out.withColumn("spans", spans)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, r: s + r["z"] - r["a"])
    return out.select("doc_id", "digest", "n_words", n_hit.alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans",
                      (n_hit > 0).alias("contaminated"))


def decontamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest columns of ``decontaminate``."""
    return decontaminate(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        digest_ids(F.col("items")).alias("items_sha256"), "contaminated")


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Documents without a word inside a benchmark window, all columns as they were."""
    hit = decontaminate(docs, items, window, id_col, text_col).where("contaminated")
    return drop_marked(docs, hit.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")),
                       id_col, text_col)
