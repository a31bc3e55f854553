"""MinHash near-dedup with ProbMinHash signatures.

A text is its five-word shingles with a weight each: 1 however often it comes
(``weights="one"``, the default: the similarity of the shingle sets), or its number of
occurrences (``weights="count"``).  Every shingle is a Poisson process whose rate is
its weight: its arrivals, drawn from a generator seeded by the shingle, fall on
uniformly chosen registers, and a register keeps its earliest arrival.  A shingle
stops as soon as its next arrival is later than the latest register of the text.  Two
texts agree in a register with their probability Jaccard similarity, the very one that
step 3 verifies; at equal weights it is the Jaccard similarity of the sets.

1. One scan gives each text its exact digest and ``BANDS`` band keys of ``ROWS``
   registers (a pair at 0.8 shares no band with probability 7e-6).  Equal word
   sequences collapse to one representative first.
2. In each band bucket every text is paired with the bucket's least and greatest
   text (linear in the bucket, however large).  Buckets whose texts these links
   don't join get a second look: every two texts of different components are
   compared register by register in blocks of at most ``BLOCK`` texts, and pairs
   whose registers agree enough (a true pair fails this with probability below
   1e-4) may be linked.  First a spanning forest of them is proposed.  In buckets where
   a link of the forest isn't verified the blocks are laid out again, with the
   shingles of the texts: the pairs that still lie in different components are verified
   on the spot, the most similar first, and only links that join two components leave
   the block, so what is written grows with the texts and not with their pairs.
3. Proposed pairs are verified exactly (similarity at least 0.8), and connected
   components of the verified pairs are the classes.

Ids must cast to bigint.  Very long texts are one row of shingles; blocks hold at most
``BLOCK`` texts and, of longer texts, about ``BLOCK_SHINGLES`` shingles.

Cases: texts without words (null too) are classes of their own; texts of one to
four words are one shingle; rows with one id and one text are one document; rows
with a null id join the class of their text but never name it unless no row has
an id (class_id is null then); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom_bits, bloom_has, digest_of, drop_marked, saved, sized
from .components import components
from .textvec import Words, chunks, list_array, mix, signed, unsigned

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
NEED_BITS = 24           # 2 MiB
CHUNK = 1_000_000

_SIG = ("doc_id {kind}, digest bigint, h1 bigint, h2 bigint, n bigint, bands array<bigint>, regs binary")


def weighted_shingles(words: Words, k: int = SHINGLE, weights: str = "one"):
    """(text, shingle hash, weight) sorted by text and hash, shingles distinct."""
    doc, _, h = words.shingles(k)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    if not len(doc):
        return doc, h, np.zeros(0)
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]))
    times = np.diff(np.append(new, len(doc))).astype(float)
    return doc[new], h[new], times if weights == "count" else np.ones(len(new))


def similarity(a: np.ndarray, b: np.ndarray, wa: np.ndarray | None = None, wb: np.ndarray | None = None) -> float:
    """Probability Jaccard similarity of two weighted sets (distinct members; without weights: Jaccard):
    the sum over common x of 1 / sum over y of max(wa(y) / wa(x), wb(y) / wb(x))."""
    if wa is None:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return common / max(len(a) + len(b) - common, 1)
    every = np.union1d(a, b)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a)], y[np.searchsorted(every, b)] = wa, wb
    ratio = np.divide(x, y, out=np.full(len(every), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    from_here = np.append(np.cumsum(x[order][::-1])[::-1], 0)
    before = np.append(0, np.cumsum(y[order]))
    both = (x > 0) & (y > 0)
    at = np.searchsorted(ratio[order], ratio[both])
    return float((1 / (from_here[at] / x[both] + before[at] / y[both])).sum())


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, texts: int, m: int) -> np.ndarray:
    """ProbMinHash registers, (texts, m) uint64; 0 rows for texts without shingles."""
    first = np.full(texts * m, np.inf)
    owner = np.zeros(texts * m, dtype=np.uint64)
    live = np.arange(len(doc))
    clock = np.zeros(len(doc))
    step = 0
    while len(live):
        step += 1
        r = mix(h[live] + np.uint64(step * 0xD1B54A32D192ED03 % (1 << 64)))
        u = ((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        clock = clock - np.log(u) / weight[live]
        slot = doc[live] * m + (mix(r ^ np.uint64(0xA5A5A5A5)) % np.uint64(m)).astype(np.int64)
        better = np.flatnonzero(clock < first[slot])
        if len(better):
            s, t = slot[better], clock[better]
            np.minimum.at(first, s, t)
            won = t == first[s]
            owner[s[won]] = mix(h[live[better[won]]])
        last = first.reshape(texts, m).max(axis=1) if step < 4 or step % 4 == 0 else last
        stay = clock < last[doc[live]]
        live, clock = live[stay], clock[stay]
    return owner.reshape(texts, m)


def band_keys(regs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) uint64 key of each band."""
    r = regs.reshape(len(regs), bands, rows)
    h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(regs), bands)).copy()
    for j in range(rows):
        h = mix(h * np.uint64(31) + r[:, :, j])
    return h


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             bands: int = BANDS, rows: int = ROWS, weights: str = "one") -> DataFrame:
    """Digest, band keys and packed registers (2 bytes each) of every text; one scan."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in chunks(b.column(1), CHUNK):
                w = Words(data, offs)
                doc, h, weight = weighted_shingles(w, shingle, weights)
                regs = signatures(doc, h, weight, hi - lo, bands * rows)
                keys = band_keys(regs, bands, rows)
                n = np.bincount(doc, minlength=hi - lo)
                some = n > 0
                per = np.where(some, bands, 0)
                h1 = w.text_hash()
                total = np.zeros(len(h) + 1, np.uint64)
                np.cumsum(mix(h ^ np.uint64(0x77)), out=total[1:])
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                h2 = mix(total[cut[1:]] - total[cut[:-1]])
                packed = (regs & np.uint64(0xFFFF)).astype(np.uint16)
                yield pa.record_batch(
                    [b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(signed(h1)),
                     pa.array(signed(h2)), pa.array(n, pa.int64()), list_array(signed(keys[some].ravel()), per),
                     pa.array([r.tobytes() for r in packed], pa.binary())],
                    names=["doc_id", "digest", "h1", "h2", "n", "bands", "regs"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      digest_of(F.col(text_col)).alias("digest"))
    return src.mapInArrow(run, _SIG.format(kind=kind))


def shingle_sets(docs: DataFrame, need, id_col: str, text_col: str, shingle: int, weights: str = "one") -> DataFrame:
    """(node, set, weight) of the texts whose id the bit table may hold; weight is empty when all are 1."""

    def run(batches):
        for b in batches:
            ids = np.asarray(b.column(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            want = bloom_has(need.value, mix(ids.view(np.uint64)))
            sub = b.filter(pa.array(want))
            for lo, hi, data, offs in chunks(sub.column(1), CHUNK):
                doc, h, weight = weighted_shingles(Words(data, offs), shingle, weights)
                per = np.bincount(doc, minlength=hi - lo)
                times = list_array(weight.astype(np.int64), per) if weights == "count" else \
                    list_array(np.zeros(0, np.int64), np.zeros(hi - lo, np.int64))
                yield pa.record_batch([sub.column(0).slice(lo, hi - lo), list_array(signed(h), per), times],
                                      names=["node", "set", "weight"])

    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("node"),
                                                       F.col(text_col).alias("text"))
    return src.mapInArrow(run, "node bigint, set array<bigint>, weight array<bigint>").where(F.size("set") > 0)


def _members(sets, weights) -> tuple[np.ndarray, np.ndarray | None]:
    """Values of a row's set and weight lists (Arrow scalars)."""
    w = weights.values.to_numpy()
    return sets.values.to_numpy(), w.astype(float) if len(w) else None


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose shingles have the similarity."""

    def run(batches):
        for t in batches:
            if t.num_rows:
                ok = []
                for sa, wa, sb, wb in zip(*[t.column(i) for i in range(2, 6)]):
                    (a, x), (b, y) = _members(sa, wa), _members(sb, wb)
                    ok.append(similarity(a, b, x, y) >= threshold)
                yield t.select(["a", "b"]).filter(pa.array(ok))

    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb"), F.col("weight").alias("wb")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa"), F.col("weight").alias("wa")), "a"))
    return both.select("a", "b", "sa", "wa", "sb", "wb").mapInArrow(run, "a bigint, b bigint")


def _agreeing(pairs: DataFrame, regs: DataFrame, registers: int, floor: float) -> DataFrame:
    """(a, b) of the proposed pairs whose share of equal registers is at least ``floor``."""

    def run(batches):
        for t in batches:
            if t.num_rows:
                x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint16).reshape(-1, registers) for c in (2, 3))
                yield t.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= floor))

    both = (pairs.join(regs.select(F.col("node").alias("b"), F.col("regs").alias("rb")), "b")
            .join(regs.select(F.col("node").alias("a"), F.col("regs").alias("ra")), "a"))
    return both.select("a", "b", "ra", "rb").mapInArrow(run, "a bigint, b bigint")


def _mixed_buckets(shared: DataFrame, comp: DataFrame) -> DataFrame:
    """(bucket, node, n, label, p, q, side) of the texts between the ends of the buckets
    in which these hold more than one label; ``side`` is 0 for the texts of the bucket's
    most frequent label (in q blocks) and 1 for the others (in p)."""
    each = saved(shared.where("node <> lo AND node <> hi").select("bucket", "node", "n").join(comp, "node", "left")
                 .select("bucket", "node", "n", F.coalesce("label", "node").alias("label")), narrow=True)
    # written before the join, which then has no known partitioning: Spark can split a hot bucket
    most = saved(each.groupBy("bucket", "label").agg(F.count("*").alias("texts"), F.sum("n").alias("n"))
                 .groupBy("bucket").agg(F.max(F.struct("texts", "label", "n")).alias("m"),
                                        F.sum("texts").alias("texts"), F.sum("n").alias("n"))
                 .select("bucket", F.col("m.label").alias("top"),
                         _blocks(F.col("m.texts"), F.col("m.n")).alias("q"),
                         _blocks(F.col("texts") - F.col("m.texts"), F.col("n") - F.col("m.n")).alias("p")).where("p > 0"), narrow=True)
    return (each.join(most, "bucket")
            .select("bucket", "node", "n", "label", "p", "q", (F.col("label") != F.col("top")).cast("int").alias("side")))


def _blocks(texts, shingles):
    return F.ceil(F.greatest(texts / BLOCK, F.least(texts, shingles / BLOCK_SHINGLES))).cast("int")


def _look(mixed: DataFrame, rows: DataFrame, registers: int, floor: float, threshold: float | None) -> DataFrame:
    """Second look: (bucket, a, b) of texts of one bucket and different labels, block by block.
    Texts outside the most frequent label meet each other and all of that label; texts of one
    label are linked already.  The links span what agrees in two blocks: agreeing registers
    without ``threshold``; with it, ``rows`` holds the shingles too and every link is verified."""
    mine = F.expr("CAST(IF(side = 1, pmod(xxhash64(node, bucket), p), p + pmod(xxhash64(node, bucket), q)) AS INT)")
    last = F.expr("IF(side = 1, p + q, p) - 1")
    each = (mixed.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
            .select("bucket", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "node", "label")
            .join(rows, "node"))

    def look(t: pa.Table) -> pa.Table:
        t = t.sort_by("node").combine_chunks()
        mine, node, label = (t.column(c).to_numpy() for c in ("mine", "node", "label"))
        x, y = t.column("x")[0].as_py(), t.column("y")[0].as_py()
        r = np.frombuffer(b"".join(t.column("regs").to_pylist()), np.uint16).reshape(-1, registers)
        i_all, j_all, s_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        places = np.arange(len(node))
        for i in places:
            peers = places[i + 1:]
            peers = peers[label[peers] != label[i]]
            if x != y:
                peers = peers[mine[peers] != mine[i]]
            s = (r[peers] == r[i]).mean(axis=1)
            peers, s = peers[s >= floor], s[s >= floor]
            i_all.append(np.full(len(peers), i))
            j_all.append(peers)
            s_all.append(s)
        i, j, s = np.concatenate(i_all), np.concatenate(j_all), np.concatenate(s_all)
        if threshold is None:
            at = _forest(label[i], label[j], s)
        else:
            members = {k: _members(t.column("set")[k], t.column("weight")[k]) for k in np.union1d(i, j).tolist()}

            def check(k: int) -> bool:
                (a, wa), (b, wb) = members[int(i[k])], members[int(j[k])]
                return similarity(a, b, wa, wb) >= threshold
            at = _spanning(label[i], label[j], s, check)
        i, j = i[at], j[at]
        return pa.table({"bucket": pa.array(np.full(len(i), t.column("bucket")[0].as_py()), pa.int64()),
                         "a": pa.array(node[i], pa.int64()), "b": pa.array(node[j], pa.int64())})

    return each.groupBy("bucket", "x", "y").applyInArrow(look, "bucket bigint, a bigint, b bigint").distinct()


def _forest(a: np.ndarray, b: np.ndarray, s: np.ndarray) -> list[int]:
    """Places of the edges (a, b) of a spanning forest, the largest ``s`` first."""
    return _spanning(a, b, s, lambda k: True)


def _spanning(a: np.ndarray, b: np.ndarray, s: np.ndarray, check) -> list[int]:
    """Places of the edges (a, b) that span those passing ``check``, the largest ``s`` first;
    it is asked only where the two sides are still apart."""
    group: dict = {}

    def top(i):
        while group.setdefault(i, i) != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    out = []
    for k in np.argsort(-s, kind="stable").tolist():
        i, j = top(int(a[k])), top(int(b[k]))
        if i != j and check(k):
            group[j] = i
            out.append(k)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, weights: str = "one") -> DataFrame:
    """One row per input row: doc_id, digest, class_id (least id of the class)."""
    if weights not in ("one", "count"):
        raise ValueError("weights: one or count")
    sc = docs.sparkSession.sparkContext
    registers = bands * rows
    floor = threshold - 4 * (threshold * (1 - threshold) / registers) ** 0.5
    sk = sized(sketches(docs, id_col, text_col, shingle, bands, rows, weights), "sketches")
    some = sk.where(F.col("n") > 0)
    texts = saved(some.where(F.col("doc_id").isNotNull()).groupBy("h1", "h2")
                  .agg(F.min(F.col("doc_id").cast("bigint")).alias("node"), F.min("n").alias("n"),
                       F.min_by(F.struct("bands", "regs"), "doc_id").alias("s")))
    regs = texts.select("node", F.col("s.regs").alias("regs"))
    members = texts.select("node", "n", F.explode("s.bands").alias("bucket"))
    ends = members.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    shared = saved(members.join(ends, "bucket"), narrow=True)
    star = (shared.where("node <> lo").select(F.col("lo").alias("a"), F.col("node").alias("b"))
            .unionByName(shared.where("node <> hi").select(F.col("node").alias("a"), F.col("hi").alias("b")))
            .distinct())

    def sets_of(nodes: DataFrame) -> DataFrame:
        need = sc.broadcast(bloom_bits(nodes.mapInArrow(_mixed, "h bigint"), "h", NEED_BITS))
        return shingle_sets(docs, need, id_col, text_col, shingle, weights)

    def exact(near: DataFrame) -> DataFrame:
        """The pairs whose shingles have the similarity."""
        return _verified(near, sets_of(near.select(F.explode(F.array("a", "b")).alias("node"))), threshold)

    first = saved(exact(saved(_agreeing(star, regs, registers, floor), narrow=True)), narrow=True)
    comp = saved(components(first), narrow=True)

    def joined_by(edges: DataFrame) -> DataFrame:
        return saved(components(comp.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(edges)), narrow=True)

    near = saved(_look(_mixed_buckets(shared, comp), regs, registers, floor, None), narrow=True)
    if not near.isEmpty():
        good = saved(exact(near.select("a", "b").distinct()), narrow=True)
        failed = saved(near.join(good, ["a", "b"], "left_anti").select("bucket").distinct(), narrow=True)
        comp = joined_by(good)
        if not failed.isEmpty():                       # where a link failed, it can't stand for the others
            again = saved(_mixed_buckets(shared.join(failed, "bucket", "left_semi"), comp), narrow=True)
            whole = regs.join(sets_of(again.select("node").distinct()), "node")
            comp = joined_by(saved(_look(again, whole, registers, floor, threshold).select("a", "b").distinct(), narrow=True))
    # saved: read without a known partitioning, the join below can split a text with very many copies
    named = saved(texts.join(comp, "node", "left")
                  .select("h1", "h2", F.coalesce("label", "node").alias("class_id"))
                  .groupBy("h1", "h2").agg(F.min("class_id").alias("class_id")), narrow=True)
    joined = (some.select("doc_id", "digest", "h1", "h2").join(named, ["h1", "h2"], "left")
              .select("doc_id", "digest", "class_id"))
    return joined.unionByName(sk.where(F.col("n") == 0).select("doc_id", "digest",
                                                               F.col("doc_id").cast("bigint").alias("class_id")))


def _mixed(batches):
    """splitmix64 of node ids, as the bit table is asked for them."""
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        yield pa.record_batch([pa.array(signed(mix(unsigned(ids))))], names=["h"])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class stays: the one that names it."""
    found = saved(near_duplicates(docs, id_col, text_col), narrow=True).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "class_id")
    same = F.coalesce(F.col("__id").cast("bigint") == F.col("class_id"), F.lit(False))
    repeated = found.groupBy("__id", "__digest").count().where("count > 1")
    return drop_marked(docs, found.where(F.col("class_id").isNotNull() & ~same), id_col, text_col, repeated)


def report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "class_id")
