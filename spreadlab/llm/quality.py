"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

A text's indicators are its word runs of one and two words, its runs of one to
three token shapes (case, digits, symbols, last character, equal to the token
before, three-token run seen before in the text), and levels of a few shares of
those.  Each indicator is scaled by its class log-count ratio; a linear
hinge-loss model over the scaled indicators is fitted by dual coordinate
descent and drawn towards the plain ratios (``BLEND``); a logistic function of
the margin, fitted on sample rows the margins were not fitted on, gives the score.

Training uses a bounded, hash-ordered sample (``MAX_PER_CLASS`` labelled rows of
each class whose text has at most ``MAX_CHARS`` characters); scoring is one scan of
the whole texts without a shuffle.

Cases: null texts score as empty ones; repeated rows are scored row by row; of
several labels for one id the largest holds; without both classes in the sample
every text gets the base rate; extra columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .textvec import IS_TOKEN, Words, chunks, mix

MAX_PER_CLASS = 2500
MAX_CHARS = 60_000
TABLE_BITS = 18
BLEND = 0.25
PASSES = 8
THRESHOLD = 0.3
CHUNK = 1_000_000

_MASK = np.uint64((1 << TABLE_BITS) - 1)


def _per_token(w: Words, flag: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
    return total[w.end] - total[w.start]


def indicators(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, slot) pairs, sorted."""
    w = Words(data, offs, IS_TOKEN, lower=False)
    texts, n = len(offs) - 1, len(w)
    per_doc = [mix(np.minimum(np.log2(w.count + 1).astype(np.uint64), 20) + np.uint64(1 << 20))]
    docs = [np.arange(texts)]
    if n:
        upper = _per_token(w, (data >= 65) & (data <= 90))
        alpha = upper + _per_token(w, (data >= 97) & (data <= 122)) + _per_token(w, data >= 128)
        digit = _per_token(w, (data >= 48) & (data <= 57))
        size = w.end - w.start
        symbol = size - alpha - digit
        last = data[w.end - 1]
        last_kind = np.where(last >= 128, 1, np.where((last >= 48) & (last <= 57), 2,
                                                      np.where(((last | 32) >= 97) & ((last | 32) <= 122), 3, last)))
        again = np.zeros(n, bool)
        again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
        run = w.hash.copy()
        run[: n - 2] = mix(w.hash[: n - 2] * np.uint64(7) + w.hash[1: n - 1] * np.uint64(5) + w.hash[2:])
        order = np.lexsort((np.arange(n), run, w.doc))
        seen = np.zeros(n, bool)
        same = (run[order[1:]] == run[order[:-1]]) & (w.doc[order[1:]] == w.doc[order[:-1]])
        seen[order[1:]] = same
        shape = (last_kind.astype(np.uint64) | (np.minimum(upper, 2).astype(np.uint64) << np.uint64(8))
                 | ((upper == alpha).astype(np.uint64) << np.uint64(10))
                 | (np.minimum(symbol, 4).astype(np.uint64) << np.uint64(11))
                 | ((digit > 0).astype(np.uint64) << np.uint64(14)) | (again.astype(np.uint64) << np.uint64(15))
                 | (seen.astype(np.uint64) << np.uint64(16)) | ((alpha == 0).astype(np.uint64) << np.uint64(17)))
        for base, k_max, salt in ((w.hash, 2, 11), (mix(shape), 3, 29)):
            h = np.zeros(n, np.uint64)
            for k in range(1, k_max + 1):
                part = np.zeros(n, np.uint64)
                part[: n - k + 1] = base[k - 1:] if n >= k else 0
                h = mix(h * np.uint64(131) + part + np.uint64(salt * k))
                room = np.repeat(w.first + w.count, w.count) - np.arange(n) >= k
                per_doc.append(h[room])
                docs.append(w.doc[room])
        some = np.flatnonzero(w.count > 0)
        for i, flag in enumerate((seen, again, symbol > 1, (upper == alpha) & (alpha > 1), alpha == 0, size > 14)):
            share = np.add.reduceat(flag.astype(np.float64), w.first[some]) / w.count[some]
            level = np.minimum((share * 10).astype(np.uint64), 9) + (share > 0).astype(np.uint64)
            per_doc.append(mix(level + np.uint64((i + 2) << 20)))
            docs.append(some)
    slot = np.concatenate(per_doc) & _MASK
    key = np.unique((np.concatenate(docs).astype(np.uint64) << np.uint64(TABLE_BITS)) | slot)
    return (key >> np.uint64(TABLE_BITS)).astype(np.int64), (key & _MASK).astype(np.int64)


def _matrix(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(slots, offsets) of a list of texts."""
    slots, sizes = [], []
    for lo, hi, data, offs in chunks(pa.array(texts, pa.large_string()), CHUNK):
        doc, slot = indicators(data, offs)
        slots.append(slot)
        sizes.append(np.bincount(doc, minlength=hi - lo))
    return np.concatenate(slots), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def descend(slots, offs, rows, y, ratio, passes=PASSES, cost=1.0, seed=3) -> np.ndarray:
    """Dual coordinate descent for the hinge loss over ratio-scaled indicators; y in -1, 1."""
    rng = np.random.default_rng(seed)
    w = np.zeros(len(ratio))
    alpha = np.zeros(len(rows))
    norm = np.array([max((ratio[slots[offs[i]: offs[i + 1]]] ** 2).sum(), 1e-9) for i in rows])
    for _ in range(passes):
        for j in rng.permutation(len(rows)):
            i = rows[j]
            s = slots[offs[i]: offs[i + 1]]
            g = y[i] * (w[s] * ratio[s]).sum() - 1
            new = min(max(alpha[j] - g / norm[j], 0.0), cost)
            if new != alpha[j]:
                w[s] += (new - alpha[j]) * y[i] * ratio[s]
                alpha[j] = new
    return w


def fit(texts: list, label: np.ndarray, rate: float | None = None) -> dict:
    positive = int((label == 1).sum())
    if not texts or positive in (0, len(texts)):
        p = (positive + 0.5) / (len(texts) + 1) if rate is None else min(max(rate, 0.01), 0.99)
        return {"w": np.zeros(1 << TABLE_BITS, np.float32), "a": 0.0, "b": float(np.log(p / (1 - p)))}
    slots, offs = _matrix(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(offs))
    size = 1 << TABLE_BITS
    good = np.bincount(slots[label[owner] == 1], minlength=size) + 1.0
    bad = np.bincount(slots[label[owner] == 0], minlength=size) + 1.0
    ratio = np.log((good / (positive + 2)) / (bad / (len(texts) - positive + 2)))
    y = np.where(label == 1, 1.0, -1.0)
    part = mix(np.arange(len(texts), dtype=np.uint64)) % np.uint64(4) == 0

    def weights(rows):
        w = descend(slots, offs, rows, y, ratio)
        return (BLEND * w + (1 - BLEND) * np.abs(w).mean()) * ratio

    def margins(w, rows):
        sums = np.add.reduceat(w[slots], offs[:-1]) * (np.diff(offs) > 0)
        return sums[rows]

    outside = np.flatnonzero(part)
    held = margins(weights(np.flatnonzero(~part)), outside)
    w = weights(np.arange(len(texts)))
    scale = np.abs(held).mean() + 1e-9
    x = np.stack([held / scale, np.ones(len(held))], axis=1)
    t = label[outside] == 1
    rate = positive / len(texts) if rate is None else min(max(rate, 0.01), 0.99)
    share = np.where(t, rate / max(t.mean(), 1e-6), (1 - rate) / max((~t).mean(), 1e-6))
    ab = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        h = (x * (share * p * (1 - p))[:, None]).T @ x + np.eye(2) * 0.05
        ab -= np.linalg.solve(h, x.T @ (share * (p - t)) + 0.05 * ab)
    return {"w": w.astype(np.float32), "a": float(ab[0] / scale), "b": float(ab[1])}


def score_chunk(data: np.ndarray, offs: np.ndarray, model: dict) -> np.ndarray:
    doc, slot = indicators(data, offs)
    m = np.bincount(doc, weights=model["w"][slot], minlength=len(offs) - 1)
    return 1 / (1 + np.exp(-np.clip(model["a"] * m + model["b"], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> dict:
    """Fit on the bounded sample, in one task; the model's size is fixed."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(label_col).alias("y")))
    rate = known.agg(F.avg("y")).first()[0]
    order = F.xxhash64(F.col("doc_id"), F.lit(29))
    pick = (known.where("y = 1").orderBy(order, "doc_id").limit(MAX_PER_CLASS)
            .unionByName(known.where("y = 0").orderBy(order, "doc_id").limit(MAX_PER_CLASS)))
    rows = (docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= MAX_CHARS)
            .join(F.broadcast(pick), "doc_id").select("doc_id", "y", "text"))   # pick: 2 * MAX_PER_CLASS small rows

    def run(batches):
        parts = [pa.Table.from_batches([b]) for b in batches]
        tab = pa.concat_tables(parts) if parts else None
        if tab is None or not tab.num_rows:
            model = fit([], np.zeros(0), rate)
        else:
            tab = tab.sort_by([("doc_id", "ascending"), ("text", "ascending")])
            seen: set = set()
            tab = tab.filter(pa.array([not (i in seen or seen.add(i)) for i in tab.column("doc_id").to_pylist()]))
            model = fit(tab.column("text").to_pylist(), np.array(tab.column("y").to_pylist()), rate)
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    row = rows.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(row[0]) if row else fit([], np.zeros(0), rate)


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, data, offs in chunks(b.column(1), CHUNK):
                s = score_chunk(data, offs, shared.value)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(s),
                                       pa.array((s >= threshold).astype(np.int32))],
                                      names=["doc_id", "score", "predicted"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, score double, predicted int"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                                                   "score", "predicted")
