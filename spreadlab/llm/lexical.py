"""Ranked lexical search by Block-Max MaxScore over sharded posting lists.

Scores are whole numbers.  N documents hold a term at all, L is the number of all
their terms, n a document's, df the documents that hold a term, tf its occurrences
in one.  A term weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))), a document has
m = 75 + (25 n N) div L, and scores w ((10^9 tf) div (1000 tf + 12 m)) summed over
the terms of a query, repeats included.

1. One scan of the texts keeps, of every document, its length and the frequencies of
   the terms that some query may hold (a bit table of fixed size tells them).
2. Documents with such terms are dealt to shards by row.  A shard's index has a list a
   term, in document order, cut into blocks of ``POSTINGS``: gaps and frequencies in
   the fewest bytes that hold them, with the block's first and last document and its
   largest impact in the open.
3. A shard answers blocks of ``QUERIES`` queries.  Lists come by falling global bound
   (weight times largest impact).  While the bounds of the lists to come reach the
   threshold they are essential: any document of theirs may rank, and they are read
   whole.  After that no new document can enter; for the others the block maxima of
   the remaining lists bound what a document can still gain, documents whose bound
   stays below the threshold go before a block is unpacked, and only blocks with a
   document left are.  The threshold is the k-th best score so far, from the start the
   k-th best of the first shard.
4. The shards' heaps (k a query and shard at most) merge in a ranked window, which
   Spark cuts to k rows a task before the shuffle.

Shards are as many as the documents need for ``SHARD_DOCS`` each, up to ``SPREAD``;
beyond that they grow until one has ``SHARD_POSTINGS``.

Cases: null, empty and term-less texts are no documents; null and term-less items have
no rows; terms in no document and terms that all hold (w = 0) add nothing; score 0 isn't
listed; equal scores rank by document id, null ids last; rows with one id are
documents of their own; items with equal id and text are one, items with one id and two
texts are ranked each; very long texts are read whole (the index holds query terms only);
empty tables give no rows; other columns are ignored, whatever their names.  Terms are
told apart by 64 bits of their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bloom_bits, bloom_has, sized
from .textvec import Words, chunks, list_array, signed

TOP = 20
POSTINGS = 128
SHARD_DOCS, SPREAD, SHARD_POSTINGS = 8192, 1024, 8_000_000
QUERIES = 512
BLOOM_BITS = 22          # 512 KiB
DOCS_BLOCK = 8192
NO_ID = np.iinfo(np.int64).max

_INDEX = "shard bigint, term bigint, block int, first int, last int, n int, top bigint, payload binary"


# -- texts ---------------------------------------------------------------------------
def queries_of(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(qid, item_id, terms with repeats) of every distinct item with a term."""
    kind = items.schema[id_col].dataType.simpleString()

    def cut(batches):
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo, hi, data, offs in chunks(b.column(1)):
                w = Words(data, offs)
                ids = np.arange(seq, seq + hi - lo) + (part << 32)
                seq += hi - lo
                yield pa.record_batch([pa.array(ids, pa.int64()), b.column(0).slice(lo, hi - lo),
                                       list_array(signed(w.hash), w.count)], names=["qid", "item_id", "terms"])

    src = items.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    return src.mapInArrow(cut, f"qid bigint, item_id {kind}, terms array<bigint>").where(F.size("terms") > 0)


def term_rows(docs: DataFrame, bits, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document: its length and the terms that the bit table may hold."""

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in chunks(b.column(1)):
                w = Words(data, offs)
                at = np.flatnonzero(bloom_has(bits.value, w.hash))
                doc, h = w.doc[at], w.hash[at]
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                new = np.flatnonzero(np.concatenate([np.ones(min(len(doc), 1), bool), (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]))
                tf = np.diff(np.append(new, len(doc)))
                per = np.bincount(doc[new], minlength=hi - lo)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(w.count, pa.int64()),
                                       list_array(signed(h[new]), per), list_array(tf, per, pa.int32())],
                                      names=["doc_id", "n", "terms", "tfs"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id bigint, n bigint, terms array<bigint>, tfs array<int>").where("n > 0")


# -- index ---------------------------------------------------------------------------
def _narrow(values: np.ndarray) -> np.ndarray:
    top = int(values.max())
    return values.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")


def pack_block(ords: np.ndarray, tfs: np.ndarray) -> bytes:
    """Gaps and frequencies, each in the fewest bytes that hold them."""
    gaps, tf = _narrow(np.diff(ords, prepend=ords[0])), _narrow(tfs)
    return bytes([gaps.itemsize, tf.itemsize]) + gaps.tobytes() + tf.tobytes()


def unpack_block(payload: bytes, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    g, t = payload[0], payload[1]
    gaps = np.frombuffer(payload, f"<u{g}", n, 2)
    return np.cumsum(gaps, dtype=np.int64) + first, np.frombuffer(payload, f"<u{t}", n, 2 + g * n).astype(np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _index_shard(t: pa.Table) -> pa.Table:
    """Posting blocks of a shard's terms; rows with a null term hold its documents' ids and m."""
    shard = t.column("shard")[0].as_py()
    t = t.combine_chunks()
    ids = t.column("doc_id").fill_null(NO_ID).to_numpy()
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    ids, m = ids[order], t.column("m").to_numpy()[order]
    lists = t.column("terms").combine_chunks()
    per = np.diff(lists.offsets.to_numpy())
    term = lists.flatten().to_numpy()
    tf = t.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
    owner = np.repeat(rank, per)
    by = np.lexsort((owner, term))
    term, tf, owner = term[by], tf[by], owner[by]
    start = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    within = np.arange(len(term)) - np.repeat(start, np.diff(np.append(start, len(term))))
    cut = np.flatnonzero(within % POSTINGS == 0)
    end = np.append(cut[1:], len(term))
    top = np.maximum.reduceat(impact(tf, m[owner]), cut)
    docs = range(0, len(ids), DOCS_BLOCK)
    columns = {
        "term": [*term[cut].tolist(), *[None for _ in docs]],
        "block": [*(within[cut] // POSTINGS).tolist(), *[k // DOCS_BLOCK for k in docs]],
        "first": [*owner[cut].tolist(), *docs],
        "last": [*owner[end - 1].tolist(), *[min(k + DOCS_BLOCK, len(ids)) - 1 for k in docs]],
        "n": [*(end - cut).tolist(), *[min(DOCS_BLOCK, len(ids) - k) for k in docs]],
        "top": [*top.tolist(), *[0 for _ in docs]],
        "payload": [*[pack_block(owner[a:z], tf[a:z]) for a, z in zip(cut.tolist(), end.tolist())],
                    *[ids[k: k + DOCS_BLOCK].tobytes() + m[k: k + DOCS_BLOCK].tobytes() for k in docs]]}
    kinds = {"term": pa.int64(), "top": pa.int64(), "payload": pa.binary()}
    return pa.table({"shard": pa.repeat(pa.scalar(shard, pa.int64()), len(columns["n"]))}
                    | {k: pa.array(v, kinds.get(k, pa.int32())) for k, v in columns.items()})


def build_index(rows: DataFrame, n_docs: int, n_terms: int, shards: int) -> DataFrame:
    """Sharded index of the documents in ``rows`` (``term_rows``) that hold a term."""
    m = F.call_function("div", F.col("n").cast("decimal(18,0)") * F.lit(25 * n_docs).cast("decimal(20,0)"),
                        F.lit(max(n_terms, 1)).cast("decimal(20,0)"))
    dealt = (rows.where(F.size("terms") > 0).withColumn("row", F.monotonically_increasing_id())
             .select(F.pmod(F.xxhash64("row"), F.lit(shards).cast("bigint")).alias("shard"), "doc_id", (m + 75).alias("m"),
                     "terms", "tfs"))
    return dealt.groupBy("shard").applyInArrow(_index_shard, _INDEX)


# -- search --------------------------------------------------------------------------
class Shard:
    """Posting blocks of one shard; unpacked blocks are kept while it answers."""

    def __init__(self, t: pa.Table):
        t = t.sort_by([("term", "ascending"), ("block", "ascending")]).combine_chunks()
        null = t.column("term").is_null()
        ids = [(np.frombuffer(p, np.int64, n), np.frombuffer(p, np.int64, n, 8 * n))
               for p, n in zip(*[t.filter(null).column(c).to_pylist() for c in ("payload", "n")])]
        self.ids = np.concatenate([x for x, _ in ids])
        self.m = np.concatenate([x for _, x in ids])
        t = t.filter(pa.compute.invert(null))
        self.first, self.last, self.n, self.top = (t.column(c).to_numpy() for c in ("first", "last", "n", "top"))
        self.payload = t.column("payload")
        term = t.column("term").to_numpy()
        start = np.flatnonzero(np.concatenate([np.ones(min(len(term), 1), bool), term[1:] != term[:-1]]))
        self.lists = {int(term[a]): (int(a), int(z)) for a, z in zip(start, np.append(start[1:], len(term)))}
        self.bound = {k: int(self.top[a:z].max()) for k, (a, z) in self.lists.items()}
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.open:
            ords, tf = unpack_block(self.payload[i].as_py(), int(self.first[i]), int(self.n[i]))
            self.open[i] = ords, impact(tf, self.m[ords])
        return self.open[i]

    def blocks(self, which) -> tuple[np.ndarray, np.ndarray]:
        got = [self.block(i) for i in which]
        return np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])

    def best(self, terms, weights, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(ordinals, scores) of the k best documents with a score of at least ``floor``."""
        lists = sorted(((w * self.bound[t], w, *self.lists[t]) for t, w in zip(terms, weights) if t in self.lists), reverse=True)
        left = sum(x[0] for x in lists)
        score = np.zeros(len(self.ids), dtype=np.int64)
        threshold, i = max(floor, 1), 0
        while i < len(lists) and left >= threshold:                        # essential lists
            bound, w, a, z = lists[i]
            ords, imp = self.blocks(range(a, z))
            score[ords] += w * imp
            left -= bound
            i += 1
            if len(score) >= k:
                threshold = max(threshold, int(np.partition(score, -k)[-k]))
        found = np.flatnonzero(score + left >= threshold) if left < threshold else np.arange(len(score))
        rest = lists[i:]
        at = np.zeros((len(rest), len(found)), dtype=np.int64)
        gain = np.zeros((len(rest), len(found)), dtype=np.int64)
        for j, (_, w, a, z) in enumerate(rest):                           # block maxima, nothing unpacked
            b = a + np.searchsorted(self.last[a:z], found)
            inside = b < z
            inside[inside] = self.first[b[inside]] <= found[inside]
            at[j] = np.where(inside, b, -1)
            gain[j, inside] = w * self.top[b[inside]]
        ahead = gain.sum(axis=0)
        for j, (_, w, a, z) in enumerate(rest):
            keep = score[found] + ahead >= threshold
            if not keep.all():
                found, at, gain, ahead = found[keep], at[:, keep], gain[:, keep], ahead[keep]
            ahead = ahead - gain[j]
            here = np.unique(at[j])
            here = here[here >= 0]
            if not len(here):
                continue
            ords, imp = self.blocks(here.tolist())
            place = np.minimum(np.searchsorted(ords, found), len(ords) - 1)
            hit = ords[place] == found
            score[found[hit]] += w * imp[place[hit]]
            if len(found) >= k:
                threshold = max(threshold, int(np.partition(score[found], -k)[-k]))
        found = found[score[found] >= threshold]
        order = np.lexsort((found, -score[found]))[:k]                      # ordinals ascend with the ids
        return found[order], score[found[order]]


def _answer(k: int):
    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"qid": [], "doc_id": [], "score": []}
        if index.num_rows and asked.num_rows:
            shard = Shard(index)
            for row in asked.column("asked").to_pylist():
                for q in row:
                    at, score = shard.best(q["terms"], q["weights"], k, q["floor"])
                    out["qid"] += [q["qid"]] * len(at)
                    out["doc_id"] += shard.ids[at].tolist()
                    out["score"] += score.tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})
    return run


def search(index: DataFrame, queries: DataFrame, shards: int, blocks: int, k: int = TOP) -> DataFrame:
    """(qid, doc_id, score): the heaps of all shards for ``queries`` (qid, qblock, terms, weights, floor),
    dealt to ``blocks`` query blocks."""
    wanted = queries.select("qblock", F.explode("terms").alias("term")).distinct()
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    lists = (index.where(F.col("term").isNotNull()).join(wanted, "term")
             .unionByName(index.where(F.col("term").isNull()).withColumn("qblock", every)))
    asked = (queries.select(*[F.col(c).alias(c) for c in queries.columns]).groupBy("qblock").agg(F.collect_list(F.struct("qid", "terms", "weights", "floor")).alias("asked"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))))
    return (lists.groupBy("shard", "qblock").cogroup(asked.groupBy("shard", "qblock"))
            .applyInArrow(_answer(k), "qid bigint, doc_id bigint, score bigint"))


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    spark = docs.sparkSession
    asked = sized(queries_of(items, item_col, item_text), "lexical-queries")
    terms = asked.select("qid", F.explode("terms").alias("term")).groupBy("qid", "term").agg(F.count("*").alias("times"))
    bits = spark.sparkContext.broadcast(bloom_bits(terms, "term", BLOOM_BITS))
    rows = sized(term_rows(docs, bits, id_col, text_col), "lexical-documents")
    held = (rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
            .join(terms.select("term").distinct(), "term", "left_semi"))
    held = sized(held, "lexical-terms")
    size = rows.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms"),
                    F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("postings")).first()
    n_docs = size["docs"]
    shards = max(1, min(-(-n_docs // SHARD_DOCS), SPREAD), -(-size["postings"] // SHARD_POSTINGS))
    ratio = F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(F.lit(1000.0) * F.log(ratio)).cast("bigint")
    blocks = -(-asked.count() // QUERIES) or 1
    queries = (terms.join(held.withColumn("w", weight).where("w > 0"), "term")
               .groupBy("qid").agg(F.collect_list(F.struct("term", (F.col("w") * F.col("times")).alias("weight"))).alias("x"))
               .select("qid", F.pmod(F.xxhash64("qid"), F.lit(blocks).cast("bigint")).alias("qblock"),
                       F.col("x.term").alias("terms"), F.col("x.weight").alias("weights"), F.lit(1).cast("bigint").alias("floor")))
    queries = sized(queries, "lexical-weights")
    index = sized(build_index(rows, n_docs, size["terms"], shards), "lexical-index")
    best = Window.partitionBy("qid").orderBy(F.col("score").desc(), "doc_id")
    if shards > 1:                                        # the first shard's k-th score is a floor for all
        first = search(index.where("shard = 0"), queries, 1, blocks, k).withColumn("rank", F.row_number().over(best))
        floors = sized(first.where(F.col("rank") == k).select("qid", F.col("score").alias("reached")), "lexical-floors")
        queries = queries.join(floors, "qid", "left").withColumn("floor", F.coalesce("reached", "floor")).drop("reached")
        queries = sized(queries, "lexical-weights")
    top = (search(index, queries, shards, blocks, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
    return top.join(asked.select("qid", "item_id"), "qid").select(
        "item_id", "rank", F.nullif("doc_id", F.lit(int(NO_ID))).alias("doc_id"), "score")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return ranked(docs, items)
