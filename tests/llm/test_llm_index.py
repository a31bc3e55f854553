"""Ranked search, packed token ids, source divergence: brute force, round trips and edge frames."""
import functools
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_check import digest

from conftest import SF001
from spreadlab.llm import divergence, lexical, oracles, tokenids

# -- ranked search -----------------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_ranked(docs, items, k):
    held = [(d, Counter(words(t)), len(words(t))) for d, t in docs if words(t)]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in dict.fromkeys((i, t or "") for i, t in items):
        scored = []
        for d, c, n in held:
            m, s = 75 + 25 * n * n_docs // n_terms, 0
            for t in words(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        scored.sort(key=lambda x: x[:3])
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(scored[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [3, 20])
def test_ranked_search_matches_brute_force(spark, monkeypatch, k):
    """Many shards, short blocks: bounds, block maxima, floors and merges against every score."""
    monkeypatch.setattr(lexical, "SHARD_DOCS", 60)
    monkeypatch.setattr(lexical, "POSTINGS", 4)
    monkeypatch.setattr(lexical, "QUERIES", 5)
    monkeypatch.setattr(lexical, "DOCS_BLOCK", 16)
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(120)]
    p = 1 / np.arange(1, 121)
    docs = [(int(i), " ".join(rng.choice(vocabulary, size=rng.integers(1, 60), p=p / p.sum()))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(90)]                               # ties
    items = [(i, " ".join(rng.choice(vocabulary, size=12))) for i in range(18)]
    a = spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id long, text string, shard int, rank int").repartition(5)
    b = spark.createDataFrame([(*i, "x") for i in items], "item_id int, text string, qid string")
    got = sorted((tuple(r) for r in lexical.ranked(a, b, k).collect()), key=str)
    assert got == brute_ranked(docs, items, k)


def test_ranked_search_edges(spark):
    docs = [(1, "Alpha beta, BETA!"), (1, "alpha"), (2, None), (3, ""), (None, "beta ünï Ünï"), (4, "-- ..."), (5, "gamma " * 70_000),
            (6, "alpha beta gamma delta"), (None, "beta ünï Ünï")]
    items = [("a", "beta alpha beta"), ("a", "beta alpha beta"), ("a", "gamma"), ("b", None), ("c", "!!"), (None, "ÜNÏ nowhere"),
             ("d", "nowhere"), ("e", "ünï delta")]
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    got = sorted((tuple(r) for r in lexical.report(a, b).collect()), key=str)
    assert got == brute_ranked(docs, items, 20)
    assert lexical.report(a.limit(0), b).collect() == [] == lexical.report(a, b.limit(0)).collect()


def test_common_terms_weigh_nothing(spark):
    """df = N: a term in all documents has the weight ln((2N+2)/(2N+1)), floored to 0 from 1,000 documents on."""
    a = spark.range(1200).selectExpr("id AS doc_id", "concat('every d', id) AS text")
    b = spark.createDataFrame([(1, "every"), (2, "every d7")], "item_id int, text string")
    got = [tuple(r)[:3] for r in lexical.report(a, b).collect()]
    assert got == [(2, 1, 7)]


def test_search_skips_blocks():
    """The block maxima keep most blocks of a long list packed."""
    rng = np.random.default_rng(1)
    n = 20_000
    rare = rng.choice(n, 30, replace=False)
    terms = [[1, 2] if i in set(rare.tolist()) else [1] for i in range(n)]
    t = pa.table({"shard": pa.array([0] * n, pa.int64()), "doc_id": pa.array(range(n), pa.int64()),
                  "m": pa.array(rng.integers(76, 200, n), pa.int64()), "terms": pa.array(terms, pa.list_(pa.int64())),
                  "tfs": pa.array([[int(1 + rng.integers(3)) for _ in x] for x in terms], pa.list_(pa.int32()))})
    shard = lexical.Shard(lexical._index_shard(t))
    at, score = shard.best([1, 2], [10, 9000], 20, 1)
    full = np.zeros(n, np.int64)
    for term, w in ((1, 10), (2, 9000)):
        ords, imp = shard.blocks(range(*shard.lists[term]))
        full[ords] += w * imp
    assert score.tolist() == sorted(full.tolist(), reverse=True)[:20] and (full[at] == score).all()
    again = lexical.Shard(lexical._index_shard(t))
    again.best([1, 2], [10, 9000], 20, 1)
    assert len(again.open) < 0.5 * len(again.first)


# -- token ids ---------------------------------------------------------------------------
@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2 ** 64 - 1)), max_size=400),
       st.integers(0, 400), st.integers(0, 400))
def test_packed_ids_round_trip(ids, lo, hi):
    ids = np.array(ids, dtype=np.uint64)
    words_, escaped, marks = tokenids.pack(ids)
    assert (tokenids.unpack(words_, escaped) == ids).all()
    lo, hi = min(lo, len(ids)), min(hi, len(ids))
    assert (tokenids.unpack_slice(words_, escaped, marks, lo, hi) == ids[lo:hi]).all()


def test_packings_and_slices():
    for count, bits in tokenids.PACKINGS:
        words_, escaped, _ = tokenids.pack(np.full(count, (1 << bits) - 1, np.uint64))
        assert len(words_) == 1 and not len(escaped)
    rng = np.random.default_rng(2)
    ids = np.where(rng.random(20_000) < 0.01, rng.integers(2 ** 61, 2 ** 63, 20_000), rng.integers(0, 50_000, 20_000)).astype(np.uint64)
    words_, escaped, marks = tokenids.pack(ids)
    assert len(marks) > 10
    for lo, hi in [(0, 20_000), (0, 1), (19_999, 20_000), (777, 5_555), (5_000, 5_000)]:
        assert (tokenids.unpack_slice(words_, escaped, marks, lo, hi) == ids[lo:hi]).all()


ODD = ["", None, "one", "it's we'll 'tis ''s 'S", "a  b\t\n c \n", "<|endoftext|> x<|endoftext|>", "é" * 3000, "naïve Straße 12½ ²",
       "日本語 текст   x", "\x1c\x1d \x85 \x00", "😀 👩‍👩‍👧 é", "x" * 9000, "1 " * 30_000, "a" * 5 + " " * 5000 + "b", "ÿĀɏɐʼn ×÷"]


def plain_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenids.vocabulary_file())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def want_digests(rows):
    out, start = [], 0
    for (d, _), ids in zip(rows, plain_ids([t for _, t in rows])):
        raw = np.array([*ids, 2], "<u4").tobytes()
        out.append((d, start, len(ids) + 1, zlib.crc32(raw)))
        start += len(ids) + 1
    return out


@pytest.mark.parametrize("block", [1, tokenids.BLOCK])
def test_token_files_round_trip(spark, tmp_path, block):
    rows = [(i * 3, t) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, digest string, row int").repartition(4, "text")
    path = str(tmp_path / "ids")
    tokenids.write_ids(docs, path, block=block)
    assert sorted(map(tuple, tokenids.read_ids(spark, path).collect())) == want_digests(rows)
    for r in spark.read.parquet(path).collect():
        ids = tokenids.unpack(np.frombuffer(r.words, "<u8"), np.frombuffer(r.escaped, "<u8"))
        assert len(ids) == r.n_ids == r.ends[-1]


def test_token_files_edges(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (1, "other"), (None, "no id"), (0, None)], "doc_id int, text string")
    out = tokenids.report(docs).collect()
    by_start = sorted(out, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == [None, 0, 1, 1, 1]
    assert [r.start for r in by_start] == np.concatenate([[0], np.cumsum([r.n_tokens for r in by_start])[:-1]]).tolist()
    assert tokenids.report(docs.limit(0)).collect() == []


def test_token_digests_of_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    want = want_digests(sorted(map(tuple, docs.collect())))
    assert sorted(map(tuple, tokenids.report(docs).collect())) == want


def test_pieces_equal_whole_texts():
    enc = tokenids.Encoder(tokenids.vocabulary_file())
    points = [c for c in range(0x2500) if not 0xD800 <= c < 0xE000]
    texts = [f"a {chr(c)}b{chr(c)}{chr(c)} 1{chr(c)}  {chr(c)}.{chr(c)}'s{chr(c)}" for c in points]
    texts += ["", "'", "''s", "x's'd're 've'll", "'r", "'re", "'s", " 's", "\n's\n\n", "a'", "'sé", "a\t \n b", "  ", " \n", "\n\nx  y ", "l'l'll"]
    for _ in range(2):                       # pieces unknown, then known
        got = enc.encode(pa.array(texts))
        assert [g.tolist() for g in got] == [w.tolist() for w in enc.whole(texts)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab'srtvelmd 1.,\n\té", max_size=30), max_size=6))
def test_pieces_of_any_plain_text(texts):
    enc = _plain_encoder()
    assert [g.tolist() for g in enc.encode(pa.array(texts, pa.string()))] == [w.tolist() for w in enc.whole(texts)]


@functools.cache
def _plain_encoder():
    return tokenids.Encoder(tokenids.vocabulary_file())


# -- source divergence -------------------------------------------------------------------
def duck(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, source VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    cur = con.execute(sql)
    return digest([c[0] for c in cur.description], cur.fetchall())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, n int, term string")


def test_divergence_matches_sql(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TERMS", 3)
    monkeypatch.setattr(divergence, "HELD", 40)
    rng = np.random.default_rng(3)
    vocabulary = ["Der", "die", "DAS", "über", "Über", "a1b", "x_y", "日本", "e", "ff", "zz-top", "q's"]
    rows = []
    for i in range(300):
        lang, source = ["de", "en", None][i % 3], [None, "s1", "s2", "s3", ""][int(rng.integers(5))]
        rows.append((lang, source, " ".join(rng.choice(vocabulary, size=int(rng.integers(0, 40))))))
    rows += [("de", "dumb", None), ("de", "dumb", ""), ("fr", "only", "un deux"), ("it", "a", "x"), ("it", "b", "123"), ("de", "s1", "die " * 30_000)]
    out = divergence.report(frame(spark, rows).repartition(4))
    got = [tuple(r) for r in out.collect()]
    assert digest(out.columns, got) == duck(rows, oracles.OP13)
    assert [r[4] for r in got if r[0] == "it"] == [0, 0] and not [r for r in got if r[0] == "fr"]


def test_divergence_of_an_empty_table(spark):
    assert divergence.report(frame(spark, [("a", "b", "c")]).limit(0)).collect() == []


def test_frequencies():
    text = "Über die x1y_Z É 日本語 a b\x7f{|}~"
    want = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER)))
    assert {k.decode(): n for k, n in divergence.frequencies(text.encode()).items()} == want
