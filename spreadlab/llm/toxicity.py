"""Toxicity: a two-state linear-chain conditional random field over words.

Training uses a bounded, hash-ordered sample of labelled rows (``MAX_POSITIVE``
and ``MAX_NEGATIVE`` rows whose text has at most ``MAX_CHARS`` characters).
Token labels come from the documents' labels: a word, or a 4- or 5-byte word
beginning, is offensive if it stands in many different surroundings in toxic
documents, and in several of them, and (nearly) nowhere in clean ones; counting
surroundings keeps words of one much-copied document out.  The field's potentials
(hashed word, beginning and ending features; transitions) are fitted by
gradient steps on the exact log-likelihood, with forward-backward marginals.

Scoring is one scan without a shuffle: forward-backward over each whole text
gives every word's marginal; the document score is a logistic function of the
largest marginal and the sum of the marginals of at least 0.5; the words with such
a marginal give the offending offsets (code points).

Cases: null and word-less texts score as the empty text does; repeated rows are
scored row by row; of several labels for one id the largest holds; without both
classes in the sample every document gets the base rate; extra columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .textvec import _B, _B_INV, _BYTE_VALUE, Words, _powers, chunks, mix

MAX_POSITIVE = 2000
MAX_NEGATIVE = 4000
MAX_CHARS = 60_000
TABLE_BITS = 20
EPOCHS = 4
MIN_STEPS = 32          # small samples are gone over more often
CHUNK = 1_000_000

_MASK = np.uint64((1 << TABLE_BITS) - 1)
_PREFIXES = (3, 4, 5)


class ToxicWords(Words):
    """Words with the hashes of their beginnings and endings."""

    __slots__ = ("parts",)

    def __init__(self, data, offsets):
        super().__init__(data, offsets)
        low, n = self.data, len(self.data)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[low] * _powers(_B, n), out=total[1:])
        inv = _powers(_B_INV, n + 1)
        size = self.end - self.start
        self.parts = []
        for k in _PREFIXES:
            stop = np.minimum(self.start + k, self.end)
            h = (total[stop] - total[self.start]) * inv[self.start]
            self.parts.append(mix(h ^ np.uint64(k << 8)) * (size >= k).astype(np.uint64))
        begin = np.maximum(self.end - 3, self.start)
        self.parts.append(mix(((total[self.end] - total[begin]) * inv[begin]) ^ np.uint64(0x5F)))

    def features(self, words=slice(None)):
        """Table slots of the words, one feature at a time."""
        for i, h in enumerate([self.hash, *self.parts]):
            yield (mix(h[words] + np.uint64(i * 0x9E37)) & _MASK).astype(np.int32)


class SampleWords:
    """Words of a sample of texts, cut chunk by chunk: only word-sized arrays are kept."""

    features = ToxicWords.features

    def __init__(self, texts: list):
        cut = [ToxicWords(data, offs) for _, _, data, offs in chunks(pa.array(texts, pa.large_string()))]
        self.hash = np.concatenate([w.hash for w in cut])
        self.parts = [np.concatenate(p) for p in zip(*[w.parts for w in cut])]
        self.count = np.concatenate([w.count for w in cut])
        self.first = np.cumsum(self.count) - self.count
        self.doc = np.repeat(np.arange(len(self.count)), self.count)

    def __len__(self) -> int:
        return len(self.hash)


class Layout:
    """Words of many texts in time-major order: step t of every text that has one."""

    def __init__(self, doc: np.ndarray, pos: np.ndarray, count: np.ndarray):
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(count), np.int64)
        rank[order] = np.arange(len(count))
        longest = int(count.max()) if len(count) else 0
        live = len(count) - np.searchsorted(np.sort(count), np.arange(longest), "right")
        self.base = np.concatenate([[0], np.cumsum(live)])
        self.slot = self.base[pos] + rank[doc]

    def marginals(self, unary: np.ndarray, trans: np.ndarray):
        """(node marginals, forward log-odds, backward log-odds), time-major in and out."""
        base = self.base
        fwd, bwd = np.empty_like(unary), np.zeros_like(unary)
        (t00, t01), (t10, t11) = trans
        prev = None
        for t in range(len(base) - 1):
            a, z = base[t], base[t + 1]
            u = unary[a:z]
            if prev is None:
                cur = u + 0.0
            else:
                p = prev[: z - a]
                cur = u + np.logaddexp(p + t11, t01) - np.logaddexp(p + t10, t00)
            fwd[a:z] = cur
            prev = cur
        for t in range(len(base) - 3, -1, -1):
            a, z, y = base[t], base[t + 1], base[t + 2]
            m = y - z
            q = unary[z:y] + bwd[z:y]
            bwd[a: a + m] = np.logaddexp(t11 + q, t10) - np.logaddexp(t01 + q, t00)
        return _sigmoid(fwd + bwd), fwd, bwd


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def token_labels(words: ToxicWords | SampleWords, toxic: np.ndarray) -> np.ndarray:
    """0/1 label of every word from the labels of the texts."""
    n = len(words)
    before = np.zeros(n, np.uint64)
    after = np.zeros(n, np.uint64)
    if n > 1:
        same = words.doc[1:] == words.doc[:-1]
        before[1:] = words.hash[:-1] * same
        after[:-1] = words.hash[1:] * same
    around = mix(before * np.uint64(3) + after)
    of_toxic = toxic[words.doc] == 1
    ratio = max((~of_toxic).sum(), 1) / max(of_toxic.sum(), 1)
    label = np.zeros(n, dtype=bool)
    for key in (words.hash, words.parts[1], words.parts[2]):      # word, 4 and 5 bytes
        ok = key != 0
        kinds, idx = np.unique(key[ok], return_inverse=True)
        def distinct(sel, beside):
            if not sel.any():
                return np.zeros(len(kinds))
            _, one = np.unique(mix(idx[sel].astype(np.uint64) * np.uint64(0x9E3779B1) ^ mix(beside[ok][sel])),
                               return_index=True)
            return np.bincount(idx[sel][one], minlength=len(kinds))

        bad = distinct(of_toxic[ok], around)
        texts = distinct(of_toxic[ok], words.doc.astype(np.uint64))
        clean = distinct(~of_toxic[ok], around)
        expected = bad * ratio                                     # were the word as common in clean texts
        offensive = (bad >= 3) & (texts >= 2) & (expected >= 12) & (clean <= 0.02 * expected)
        hit = np.zeros(n, dtype=bool)
        hit[np.flatnonzero(ok)] = offensive[idx]
        label |= hit
    return label & of_toxic


def fit(texts: list, toxic: np.ndarray, rate: float | None = None, seed: int = 7, span: int = 128) -> dict:
    """Potentials and the document-level logistic function; ``rate``: share of toxic
    documents among all labelled ones (the sample's, if None)."""
    rng = np.random.default_rng(seed)
    weights = np.zeros(1 << TABLE_BITS, dtype=np.float32)
    trans = np.zeros((2, 2))
    model = {"weights": weights, "trans": trans, "doc": np.zeros(3)}
    positive = int((toxic == 1).sum())
    if not len(texts) or positive in (0, len(texts)):
        rate = (positive + 0.5) / (len(texts) + 1)
        model["doc"] = np.array([np.log(rate / (1 - rate)), 0.0, 0.0])
        return model
    words = SampleWords(texts)
    label = token_labels(words, toxic).astype(np.float64)
    kinds, first, idx = np.unique(words.hash, return_index=True, return_inverse=True)
    feats = np.stack(list(words.features(first)))                   # features of word kinds
    words.parts = []                                                # not needed any more
    piece = words.doc * (1 << 32) + (np.arange(len(words)) - words.first[words.doc]) // span   # windows of span words
    starts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])) if len(words) else np.zeros(0, int)
    sizes = np.diff(np.concatenate([starts, [len(words)]]))
    has = np.add.reduceat(label, starts) > 0 if len(starts) else np.zeros(0, bool)
    keep = np.flatnonzero(has | (rng.random(len(starts)) < 0.35))   # windows without a labelled word are many
    grad_sq = np.full(1 << TABLE_BITS, 1e-6)
    tr_sq = np.full((2, 2), 1e-6)
    base = np.log(0.01 / 0.99)
    bias, bias_sq = base, 1e-6
    w64 = weights.astype(np.float64)
    lots = max(1, len(keep) // 512)
    for _ in range(max(EPOCHS, -(-MIN_STEPS // lots))):
        for lot in np.array_split(rng.permutation(keep), lots):
            size = sizes[lot]
            which = np.repeat(np.arange(len(lot)), size)
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at = np.repeat(starts[lot], size) + step
            lay = Layout(which, step, size)
            kind = idx[at]
            unary_kind, back = np.unique(kind, return_inverse=True)
            u = bias + w64[feats[:, unary_kind]].sum(0)[back]
            um = np.empty(len(u))
            um[lay.slot] = u
            marg, fwd, bwd = lay.marginals(um, trans)
            y = np.empty(len(u))
            y[lay.slot] = label[at]
            err = marg - y
            g_kind = np.bincount(back, weights=err[lay.slot], minlength=len(unary_kind))
            g = np.bincount(feats[:, unary_kind].ravel(), weights=np.tile(g_kind, len(feats)),
                            minlength=1 << TABLE_BITS) / 512 + 1e-7 * w64
            touched = np.flatnonzero(g)
            grad_sq[touched] += g[touched] ** 2
            w64[touched] -= 0.25 * g[touched] / np.sqrt(grad_sq[touched])
            gb = err.sum() / 512
            bias_sq += gb * gb
            bias -= 0.25 * gb / np.sqrt(bias_sq)
            gt = np.zeros((2, 2))
            for t in range(len(lay.base) - 2):
                a, z, e = lay.base[t], lay.base[t + 1], lay.base[t + 2]
                m = e - z
                f, q = fwd[a: a + m], um[z:e] + bwd[z:e]
                p = np.stack([np.full(m, trans[0, 0]), trans[0, 1] + q, f + trans[1, 0], f + trans[1, 1] + q])
                p = np.exp(p - p.max(0))
                p /= p.sum(0)
                y0, y1 = y[a: a + m], y[z:e]
                emp = np.stack([(1 - y0) * (1 - y1), (1 - y0) * y1, y0 * (1 - y1), y0 * y1])
                gt += (p - emp).sum(1).reshape(2, 2) / 512
            tr_sq += gt ** 2
            trans -= 0.1 * gt / np.sqrt(tr_sq)
    model["weights"], model["bias"], model["trans"] = w64.astype(np.float32), bias, trans
    of_kind = bias + w64.astype(np.float32)[feats].sum(0, dtype=np.float64)
    del w64, grad_sq, piece, label
    top, total, _ = _score_words(words, model, of_kind[idx])
    x = np.stack([np.ones(len(texts)), top, np.log1p(total)], axis=1)
    beta = np.zeros(3)
    ridge = np.diag([1e-6, 1e-2, 1e-2]) * len(texts) / 100
    rate = positive / len(texts) if rate is None else min(max(rate, 1e-4), 1 - 1e-4)
    share = np.where(toxic == 1, rate / positive, (1 - rate) / (len(texts) - positive)) * len(texts)
    for _ in range(25):                                             # Newton steps
        p = _sigmoid(x @ beta)
        h = (x * (share * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(3)
        beta -= np.linalg.solve(h, x.T @ (share * (p - (toxic == 1))) + ridge @ beta)
    model["doc"] = beta
    return model


def _score_words(words: ToxicWords | SampleWords, model: dict, unary: np.ndarray | None = None):
    """Per text: largest marginal, sum of the marginals of at least 0.5 (small ones add
    up in long texts); and every word's marginal."""
    docs = len(words.count)
    top, total = np.zeros(docs), np.zeros(docs)
    if not len(words) or "bias" not in model:
        return top, total, np.zeros(len(words))
    if unary is None:
        unary = np.full(len(words), model["bias"])
        for slots in words.features():
            unary += model["weights"][slots]
    pos = np.arange(len(words)) - words.first[words.doc]
    lay = Layout(words.doc, pos, words.count)
    um = np.empty(len(unary))
    um[lay.slot] = unary
    marg = lay.marginals(um, model["trans"])[0][lay.slot]
    some = words.count > 0
    top[some] = np.maximum.reduceat(marg, words.first[some])
    total[some] = np.add.reduceat(np.where(marg >= 0.5, marg, 0.0), words.first[some])
    return top, total, marg


def score_chunk(data: np.ndarray, offs: np.ndarray, model: dict):
    """(scores, span starts, span ends, spans per text) of a chunk; offsets in code points."""
    words = ToxicWords(data, offs)
    top, total, marg = _score_words(words, model)
    b = model["doc"]
    score = _sigmoid(b[0] + b[1] * top + b[2] * np.log1p(total))
    hot = np.flatnonzero(marg >= 0.5)
    if not len(hot):
        z = np.zeros(0, np.int64)
        return score, z, z, np.zeros(len(offs) - 1, np.int64)
    joined = np.concatenate([[False], (np.diff(hot) == 1) & (words.doc[hot[1:]] == words.doc[hot[:-1]])])
    first = hot[~joined]
    last = hot[np.concatenate([np.flatnonzero(~joined)[1:] - 1, [len(hot) - 1]])]
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    origin = chars[offs[words.doc[first]]]
    return (score, chars[words.start[first]] - origin, chars[words.end[last]] - origin,
            np.bincount(words.doc[first], minlength=len(offs) - 1))


def known_labels(labels: DataFrame, label_col: str) -> DataFrame:
    """(doc_id, y) outside the held-out fold."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(label_col).alias("y")))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """Bounded sample of labelled texts outside the held-out fold: (y, text)."""
    known = known_labels(labels, label_col)
    order = F.xxhash64(F.col("doc_id"), F.lit(17))
    pick = (known.where("y = 1").orderBy(order, "doc_id").limit(MAX_POSITIVE)
            .unionByName(known.where("y = 0").orderBy(order, "doc_id").limit(MAX_NEGATIVE)))
    texts = docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= MAX_CHARS)
    # at most MAX_POSITIVE + MAX_NEGATIVE rows of two numbers
    return texts.join(F.broadcast(pick), "doc_id").select("doc_id", "y", "text")


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> dict:
    """Fit on the bounded sample, in one task; the model's size is fixed."""
    rate = known_labels(labels, label_col).agg(F.avg("y")).first()[0]

    def run(batches):
        rows = [pa.Table.from_batches([b]) for b in batches]
        tab = pa.concat_tables(rows) if rows else None
        if tab is None or not tab.num_rows:
            model = fit([], np.zeros(0))
        else:
            tab = tab.sort_by([("doc_id", "ascending"), ("text", "ascending")])
            seen: set = set()                       # an id's row counts once
            keep = [not (i in seen or seen.add(i)) for i in tab.column("doc_id").to_pylist()]
            tab = tab.filter(pa.array(keep))
            model = fit(tab.column("text").to_pylist(), np.array(tab.column("y").to_pylist()), rate)
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    sample = training_rows(docs, labels, label_col).repartition(1)
    row = sample.mapInArrow(run, "model binary").first()
    return pickle.loads(row[0]) if row else fit([], np.zeros(0))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score, predicted, spans [(start, end)] in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in chunks(b.column(1), CHUNK):
                s, a, z, per = score_chunk(data, offs, shared.value)
                off = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
                spans = pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["start", "end"]))
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(s, pa.float64()),
                                       pa.array((s >= 0.5).astype(np.int32)), spans],
                                      names=["doc_id", "score", "predicted", "spans"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, score double, predicted int, "
                             "spans array<struct<start:bigint,end:bigint>>"))


def keep_clean(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """Documents that are not predicted toxic, all columns as they were; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            keep = [score_chunk(data, offs, shared.value)[0] < 0.5 for _, _, data, offs in chunks(b.column(at), CHUNK)]
            if keep:
                yield b.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
                                     F.to_json("spans").alias("spans"))
