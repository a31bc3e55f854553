"""Token ids in a compact binary format: Simple-8b word-aligned coding.

Ids are packed into 64-bit words.  The top four bits of a word are its selector;
the other sixty hold as many ids as the selector says, all with the same number of
bits.  Selector 0 is the escape: ids of more than 60 bits lie one after another in
an area of their own, and the word's payload says how many come next.

A file row is a block of whole documents (``BLOCK`` ids and more; a longer document
is a block of its own): the words, the escape area, the id position at which each
``GROUP``-th word begins, and the ids and ends of its documents.  So a block decodes
without its neighbours, all words of one selector at once, and a slice of it from
the nearest offset.  The rows are written as Parquet: it splits, has no size limit
on files, and reads only the columns asked for.

``write_ids`` deals the documents to ranges of ascending id, encodes each range
in order and numbers the ids inside it; ``read_ids`` decodes the files and adds
the totals of the ranges before (one number a range, as many as the shuffle has
partitions).

Encoding: byte-level vocabularies encode each piece that the pre-tokenizer cuts on
its own, so the ids of a piece are looked up and the library is asked only for
pieces that a process hasn't met (at most ``PIECES`` are remembered, told apart by
64 bits of their bytes).  Texts with characters outside ``_PLAIN``, texts holding the string of an added token, and
vocabularies of another kind are encoded whole.  Tests compare both ways.

Cases: null and empty texts are the end id alone; very long texts are one block, as
large as their own ids; null document ids come first; rows with one id (equal or
not) are documents of their own, ordered by text digest; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .textvec import chunks, list_array, span_hashes

VOCABULARY = "byte_bpe_50k.json"
END = 2
BLOCK = 1 << 15
GROUP = 256
PIECES = 2_000_000
RUN = 500                # new pieces encoded as one text

# Fixed values: (ids, bits) of selectors 1 to 15.
PACKINGS = [(120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15),
            (3, 20), (2, 30), (1, 60)]
_LIMITS = np.array([1 << b for b in range(60)], dtype=np.uint64)
_COUNTS = np.array([0] + [c for c, _ in PACKINGS], dtype=np.int64)
_WIDTHS = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)


# -- the code ------------------------------------------------------------------------
def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, escaped ids, id position of every ``GROUP``-th word) of uint64 ids."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    place = np.arange(n)
    width = np.full(n + PACKINGS[0][0], 64, dtype=np.uint8)          # what follows the last id fits no word
    width[:n] = _WIDTHS[ids.astype(np.int64)] if n and int(ids.max()) < len(_WIDTHS) else np.searchsorted(_LIMITS, ids, "right")
    big = ids >> np.uint64(60) > 0
    width[:n][big] = 64
    # a packing of more ids has fewer bits, so where it fits all packings of fewer ids fit as well
    fitting = np.zeros(n, dtype=np.uint8)
    widest, reach = width, 1                                         # widest of ``reach`` ids from each on
    for count, bits in reversed(PACKINGS):
        while reach < count:
            more = min(reach, count - reach)
            widest, reach = np.maximum(widest[: len(widest) - more], widest[more:]), reach + more
        fits = widest[:n] <= bits
        if not fits.any():
            break
        fitting += fits
    choice = np.where(fitting > 0, len(PACKINGS) + 1 - fitting.astype(np.int64), 0)
    step = _COUNTS[choice]
    if big.any():
        ahead = np.minimum.accumulate(np.where(big, n, place)[::-1])[::-1]
        step[big] = (ahead - place)[big]
    onward = (place + step).tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i = onward[i]
    at = np.array(starts, dtype=np.int64)
    chosen = choice[at]
    words = np.where(chosen == 0, step[at], 0).astype(np.uint64)
    for s in np.unique(chosen[chosen > 0]).tolist():
        count, bits = PACKINGS[s - 1]
        mine = np.flatnonzero(chosen == s)
        if bits:
            shifts = (np.arange(count) * bits).astype(np.uint64)
            words[mine] = np.bitwise_or.reduce(ids[at[mine, None] + np.arange(count)] << shifts, axis=1)
        words[mine] |= np.uint64(s << 60)
    return words, ids[big], at[::GROUP].astype(np.int32)


def unpack(words: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    """All ids of the words; ``escaped`` holds what their escapes refer to, in order."""
    words = np.asarray(words, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = np.where(selector == 0, (words & np.uint64((1 << 60) - 1)).astype(np.int64), _COUNTS[selector])
    ends = np.cumsum(count)
    first = ends - count
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    used = 0
    for i in np.flatnonzero(selector == 0).tolist():
        out[first[i]: ends[i]] = escaped[used: used + count[i]]
        used += int(count[i])
    for s in np.unique(selector[selector > 0]).tolist():
        c, bits = PACKINGS[s - 1]
        if bits:
            mine = np.flatnonzero(selector == s)
            shifts = (np.arange(c) * bits).astype(np.uint64)
            out[first[mine, None] + np.arange(c)] = (words[mine, None] >> shifts) & np.uint64((1 << bits) - 1)
    return out


def unpack_slice(words: np.ndarray, escaped: np.ndarray, marks: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """ids[lo:hi] of a block, decoding only the groups of words that hold them."""
    if lo >= hi:
        return np.zeros(0, np.uint64)
    a, z = int(np.searchsorted(marks, lo, "right")) - 1, int(np.searchsorted(marks, hi, "left"))
    before = words[: a * GROUP]
    skipped = before[before >> np.uint64(60) == 0]
    part = unpack(words[a * GROUP: z * GROUP], escaped[int((skipped & np.uint64((1 << 60) - 1)).sum()):])
    return part[lo - int(marks[a]): hi - int(marks[a])]


# -- encoding ------------------------------------------------------------------------
_PLAIN = re.compile("[\\t-\\r -~À-ÖØ-öø-ɏ]*")
_LETTER, _DIGIT, _OTHER, _SPACE = range(4)
#: classes of the bytes of _PLAIN's characters; all its characters outside ASCII are letters
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = _LETTER
_CLASS[9:14] = _CLASS[32] = _SPACE


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of plain texts begin that the byte-level pre-tokenizer cuts: runs of one
    class with the blank before them, English contractions, and the rest of white space."""
    n = len(data)
    kind = _CLASS[data]
    head = np.zeros(n + 3, dtype=bool)
    head[offsets] = True
    start = head.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    edge = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~head[1:n]) if n > 1 else np.zeros(0, np.int64)
    start[edge] = True                                        # the last white space before a run
    start[edge[data[edge] == 32] + 1] = False                 # goes with it, if it is a blank
    ahead = np.concatenate([data, np.zeros(3, np.uint8)])
    q = np.flatnonzero((data == 39) & start[:n] & ~head[1: n + 1])
    q = q[(_CLASS[ahead[q + 1]] == _LETTER)]
    one = q[np.isin(ahead[q + 1], np.frombuffer(b"stmd", np.uint8))]
    two = q[~head[q + 2]]
    pair = ahead[two + 1].astype(np.int32) * 256 + ahead[two + 2]
    two = two[np.isin(pair, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")])]
    for at, size in ((one, 2), (two, 3)):
        start[at + 1] = False
        start[at + size] = True
    return np.flatnonzero(start[:n])


class Encoder:
    """Ids of texts, with a bounded memory of pieces."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec.get("pre_tokenizer") or {}
        self.by_piece = (spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
                         and not cut.get("add_prefix_space"))
        self.added = [x["content"] for x in spec.get("added_tokens") or []]
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, i in vocabulary.items():         # a byte-level token has a character a byte
            self.bytes_of[i] = len(token)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)             # hashes of pieces, ascending
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype=np.uint32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Ids of new pieces.  Words behind a blank are encoded many to a text, since the
        pre-tokenizer cuts before every blank, and told apart by the bytes of their ids."""
        alone = [i for i, p in enumerate(pieces) if p[0] != 32 or _CLASS[p[-1]] != _LETTER]
        mark = np.ones(len(pieces), dtype=bool)
        mark[alone] = False
        words = np.flatnonzero(mark).tolist()
        runs = [words[i: i + RUN] for i in range(0, len(words), RUN)]
        flat = [*self.whole([b"".join([pieces[i] for i in r]).decode() for r in runs]),
                *self.whole([pieces[i].decode() for i in alone])]
        ids = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        order = np.array([*words, *alone], dtype=np.int64)
        stops = np.cumsum([len(pieces[i]) for i in order.tolist()])
        ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), stops) + 1
        first = np.concatenate([[0], ends[:-1]])
        known = np.concatenate([self.known, hashes[order]])
        by = np.argsort(known, kind="stable")
        self.first = np.concatenate([self.first, first + len(self.ids)])[by]
        self.size = np.concatenate([self.size, ends - first])[by]
        self.known, self.ids = known[by], np.concatenate([self.ids, ids])

    def plain(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each of some plain texts."""
        start = piece_starts(data, offsets)
        hashes = span_hashes(data, start, np.append(start[1:], len(data)))
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > PIECES:
            self.forget()
        new = np.flatnonzero(~np.isin(distinct, self.known, assume_unique=True))
        if len(new):
            raw, stop = data.tobytes(), np.append(start[1:], len(data))
            places = at[new]
            self.learn(distinct[new], [raw[a:z] for a, z in zip(start[places].tolist(), stop[places].tolist())])
        place = np.searchsorted(self.known, distinct)[back]
        size = self.size[place]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        out = self.ids[np.repeat(self.first[place] - ends + size, size) + np.arange(total)]
        cut = np.concatenate([[0], ends])[np.searchsorted(start, offsets)].tolist()
        return [out[a:z] for a, z in zip(cut, cut[1:])]

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of every text of a string column without nulls."""
        texts = column.to_pylist()
        easy = [self.by_piece and _PLAIN.fullmatch(t) is not None and not any(a in t for a in self.added) for t in texts]
        plain = [ids for _, _, data, offsets in chunks(column.filter(pa.array(easy, pa.bool_()))) for ids in self.plain(data, offsets)]
        whole = self.whole([t for t, e in zip(texts, easy) if not e])
        of = {True: iter(plain), False: iter(whole)}
        return [next(of[e]) for e in easy]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str) -> Encoder:
    if name not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # a task has one core
        _ENCODERS[name] = Encoder(SparkFiles.get(name))
    return _ENCODERS[name]


def vocabulary_file(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# -- files ---------------------------------------------------------------------------
def _blocks(ends: np.ndarray, block: int):
    """Runs of whole documents of at least ``block`` ids (the last may have fewer)."""
    lo, n = 0, len(ends)
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = min(int(np.searchsorted(ends, base + block)) + 1, n)
        yield lo, hi
        lo = hi


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", file: str | None = None,
              end: int = END, block: int = BLOCK) -> None:
    """Encode every text, ``end`` after each, into block files in ascending document id."""
    spark = docs.sparkSession
    file = file or vocabulary_file()
    spark.sparkContext.addFile(file)
    name = os.path.basename(file)
    kind = docs.schema[id_col].dataType.simpleString()
    stop = np.array([end], dtype=np.uint32)

    def run(batches):
        from pyspark import TaskContext
        part, number, first = TaskContext.get().partitionId(), 0, 0
        enc = _encoder(name)
        for b in batches:
            texts = enc.encode(b.column(1))
            ends = np.cumsum([len(t) + 1 for t in texts])
            for lo, hi in _blocks(ends, block):
                ids = np.concatenate([x for t in texts[lo:hi] for x in (t, stop)])
                words, escaped, marks = pack(ids)
                stops = ends[lo:hi] - (ends[lo - 1] if lo else 0)
                yield pa.record_batch(
                    [pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([first], pa.int64()),
                     pa.array([len(ids)], pa.int64()), pa.array([words.astype("<u8").tobytes()], pa.binary()),
                     pa.array([escaped.astype("<u8").tobytes()], pa.binary()),
                     list_array(marks, np.array([len(marks)]), pa.int32()),
                     pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), b.column(0).slice(lo, hi - lo)),
                     list_array(stops, np.array([hi - lo]))],
                    names=["part", "block", "first", "n_ids", "words", "escaped", "marks", "doc_ids", "ends"])
                number, first = number + 1, first + len(ids)

    # the last key parts rows that are equal in id and text, so a hot id is dealt out too
    keyed = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .withColumn("digest", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id()))
    order = [F.col("id").asc_nulls_first(), "digest", "row"]
    (keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
     .mapInArrow(run, f"part int, block bigint, first bigint, n_ids bigint, words binary, escaped binary, "
                      f"marks array<int>, doc_ids array<{kind}>, ends array<bigint>")
     .write.parquet(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files at ``path``."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()        # one row a shuffle partition
    base, rows = 0, []
    for r in sorted(totals):
        rows.append((r["part"], base))
        base += r["n"]
    before = spark.createDataFrame(rows, "part int, base bigint")

    def run(batches):
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(2, 5)]
            for i, (words, escaped, first) in enumerate(zip(*cols)):
                ids = unpack(np.frombuffer(words, "<u8"), np.frombuffer(escaped, "<u8")).astype("<u4")
                ends = b.column(1)[i].values.to_numpy()
                starts = np.concatenate([[0], ends[:-1]])
                raw = memoryview(ids.view(np.uint8))
                crc = [zlib.crc32(raw[4 * a: 4 * z]) for a, z in zip(starts.tolist(), ends.tolist())]
                yield pa.record_batch([b.column(0)[i].values, pa.array(first + starts, pa.int64()),
                                       pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (files.join(before, "part")
            .select("doc_ids", "ends", "words", "escaped", (F.col("first") + F.col("base")).alias("first"))
            .mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"))


def report(docs: DataFrame) -> DataFrame:
    """Digest of every document's ids, written to the shared folder and read back."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, path)
    return read_ids(docs.sparkSession, path)
