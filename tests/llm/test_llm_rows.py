"""Mixing, personal data, token counts, vector search: brute force and edge frames."""
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from oracle_check import digest

from conftest import SF001, SF01
from spreadlab.llm import mixing, oracles, pivots, privacy, tokencount


# -- mixing --------------------------------------------------------------------
def poisson_twin(rate, seed, ident):
    parts = max(math.ceil(rate / 32), 1)
    mean, total = rate / parts, 0
    for j in range(1, parts + 1):
        h = hashlib.md5(f"{seed}|{ident}|{j}".encode()).hexdigest()
        u = (int(h[:13], 16) + 0.5) / (1 << 52)
        n, p = 0, math.exp(-mean)
        c = p
        while c <= u and n < 1000:
            n += 1
            p *= mean / n
            c += p
        total += n
    return total


def test_mixing_matches_inversion(spark):
    rows = [(i, "big" if i < 900 else "small", f"t{i}") for i in range(1000)] + [(None, None, None), (5000, None, "")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, source string, text string, n int")
    shares = {"big": 0.3, "small": 0.6, "absent": 0.1}
    out = mixing.mix_sources(docs, shares).collect()
    rate = {"big": 0.3 / 0.9 * 1002 / 900, "small": 0.6 / 0.9 * 1002 / 100}
    want = {d: poisson_twin(rate[s], mixing.SEED, d) for d, s, _ in rows if s}
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r.copy)
    assert {d: sorted(c) for d, c in got.items()} == {d: list(range(1, n + 1)) for d, n in want.items() if n}
    assert [r.shuffle_key for r in out] == sorted(r.shuffle_key for r in out)
    share = sum(r.source == "small" for r in out) / len(out)
    assert abs(share - 0.6 / 0.9) < 0.06


def test_mixing_large_rates_and_edges(spark):
    docs = spark.createDataFrame([(i, "a" if i else "b", "x") for i in range(400)] + [(7, "a", "x")],
                                 "doc_id long, source string, text string")
    out = mixing.mix_sources(docs, {"a": 0.5, "b": 0.5}).groupBy("doc_id", "source").count().collect()
    b = next(r["count"] for r in out if r.source == "b")
    assert b == poisson_twin(0.5 * 401 / 1, mixing.SEED, 0) and 120 < b < 290
    seven = next((r["count"] for r in out if r.doc_id == 7), 0)
    assert seven == 2 * poisson_twin(0.5 * 401 / 400, mixing.SEED, 7)
    assert mixing.report(docs.limit(0)).collect() == []
    equal = mixing.mix_sources(docs.where("doc_id <> 7"))
    assert equal.count() > 0


def test_mixing_sql_twin(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    cur = con.execute(oracles.OP3)
    want = digest([c[0] for c in cur.description], cur.fetchall())
    out = mixing.report(spark.read.parquet(f"{SF01}/documents.parquet"))
    assert digest(out.columns, [tuple(r) for r in out.collect()]) == want


# -- personal data ---------------------------------------------------------------
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c)
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def brute_base(text):
    spans = []
    for kind, pattern in STATED.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                spans.append((kind, m.start(), m.end()))
    return spans


def check_base(rows, out):
    want = sorted(((d, *[sum(s[0] == k for s in brute_base(t)) for k in STATED],
                    hashlib.sha256(",".join("%s:%d:%d" % s for s in brute_base(t)).encode()).hexdigest()) for d, t in rows),
                  key=str)
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in out), key=str)
    assert got == want


TRICKY = [
    "a@b.c._x@d.e é +1 (988) 555-2485 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 5 6 7 +12345678901234567 +1 2345678",
    "x" * 20000 + "@" + "y" * 20000 + ".z", "1" * 30000, "1 " * 20000, "+1" + "." * 20000 + "2",
    "😀 me@host.example.com😀 10.0.0.1 aa@bb aa@.b @b.c a@b.c.d-e.f%g@h.i", "", None, "4111111111111111@x.y",
    "+1 4111 1111 1111 1111", "1.2.3", "a+b@c.d+e@f.g", "00000000000000000000001.1.1.1",
]


def test_base_spans_on_tricky_texts(spark):
    rows = list(enumerate(TRICKY)) + [(None, "x@y.zz"), (3, "x@y.zz")]
    docs = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, base int, key string")
    check_base(rows, privacy.report(docs).collect())
    assert privacy.report(docs.limit(0)).collect() == []


def test_base_spans_on_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    out = privacy.report(docs).collect()
    check_base([tuple(r) for r in docs.collect()], out)
    for r in out:
        base = [s for s in r.spans.split(",") if s and not s.startswith("term")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def disclosing_twin(rows):
    """{text: term spans} from the stated statistics, in plain Python."""
    texts = {t for _, t in rows if t}
    gap = re.compile("[^0-9A-Za-z\u0080-￿]+")
    word = re.compile("[0-9A-Za-z\u0080-￿]+")
    has = {w: 0 for t in texts for w in ()}
    for t in texts:
        for w in set(gap.split(t.lower())):
            has[w] = has.get(w, 0) + 1
    beside, owners = {}, {}
    for t in texts:
        base = brute_base(t)
        free = {}
        for m in word.finditer(t):
            if not any(b[1] < m.end() and m.start() < b[2] for b in base):
                free.setdefault(m[0].lower(), set()).add(m.span())
        for k, s, e in base:
            v = t[s:e].lower() if k == "email" else t[s:e] if k == "ip" else re.sub("[^0-9]", "", t[s:e])
            owners.setdefault((k, v), set()).add(t)
            for w, places in free.items():
                beside.setdefault(((k, v), w), {})[t] = places
    out = {}
    n_texts = len({t or "" for _, t in rows})
    for (v, w), places in beside.items():
        n, n_t = len(places), max(has.get(w, 0), len(places))
        if n >= privacy.MIN_SUPPORT and -math.log2(n / n_t) <= privacy.MAX_BITS and \
                math.log2(n / n_t) - math.log2(len(owners[v]) / n_texts) >= privacy.MIN_GAIN - 1e-12:
            for t, spans in places.items():
                out.setdefault(t, set()).update(spans)
    return out


def test_disclosing_terms_match_brute_force(spark):
    rows = [(i, f"Call agent zorblax at z{i % 2}@corp.example.com about row{i} please") for i in range(8)]
    rows += [(100 + i, f"plain text number {i} with please and about and call inside") for i in range(60)]
    rows += [(200, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = disclosing_twin(rows)
    assert want
    for r in privacy.report(docs).collect():
        terms = {tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("term")}
        assert terms == want.get(dict(rows)[r.doc_id], set()), r.doc_id
    clean = {r.doc_id: r.text for r in privacy.sanitise(docs).collect()}
    assert len(clean) == len(rows)
    assert all(clean[100 + i] == rows[8 + i][1] for i in range(60))
    assert "@" not in clean[0] and "[EMAIL]" in clean[0] and "zorblax" not in clean[0] and "[TERM]" in clean[0]


def check_terms(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = disclosing_twin(rows)
    for r in privacy.report(docs).collect():
        terms = {tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("term")}
        assert terms == want.get(dict(rows)[r.doc_id], set()), r.doc_id
    return want, {r.doc_id: r.text for r in privacy.sanitise(docs).collect()}


def test_terms_far_from_the_entity_are_marked_everywhere(spark):
    fill = "common filler words of every text "
    rows = [(i, f"Jane Zorbax writes {fill * (9 + i)} to jane@corp.example.com {fill * 300}signed zorbax, row{i}")
            for i in range(6)]
    rows += [(50 + i, f"{fill}and jane number{i}") for i in range(40)] + [(99, None), (98, "")]
    rows += [(90, f"{fill}zorbax without an address"), (91, "10.0.0.1 " + fill)]
    want, clean = check_terms(spark, rows)
    assert all(len(want[rows[i][1]]) >= 2 for i in range(6))
    assert not any("zorbax" in clean[i].lower() for i in range(6)) and "zorbax" in clean[90]
    assert all("common filler" in clean[i] for i in range(6)) and clean[50] == rows[6][1]


def test_terms_of_shared_entities_match_brute_force(spark):
    """Entities that share texts, texts of several entities, terms in other texts, mixed scripts, repeated rows."""
    rng = random.Random(5)
    rows = []
    for i in range(160):
        people = rng.sample(range(9), rng.choice([0, 0, 1, 1, 2, 3]))
        parts = [f"p{p}@mail.example.org" if p % 2 else f"10.0.{p}.7" for p in people]
        parts += [f"Näme{p}" for p in people if rng.random() < 0.8] + [f"team{p // 3}" for p in people]
        parts += [f"w{rng.randrange(25)}" for _ in range(rng.randrange(30))] + ["x10.0.2.7y"] * (i % 40 == 0)
        rng.shuffle(parts)
        rows.append((i, rng.choice([" ", ", ", " 😀 "]).join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(30)]
    want, _ = check_terms(spark, rows)
    assert sum(map(len, want.values())) > 20


def test_sanitise_keeps_rows_and_columns(spark):
    rows = [(1, "x@y.zz and x4111 1111 1111 1111 end", "en", "s", 0), (2, None, None, None, None), (3, "", "en", "s", 0),
            (None, "10.0.0.1", "en", "s", 8), (1, "x@y.zz and x4111 1111 1111 1111 end", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = privacy.sanitise(docs)
    assert out.dtypes == docs.dtypes
    texts = sorted((str(r.doc_id), r.text) for r in out.collect() if r.text)
    assert [t for d, t in texts if d == "1"] == ["[EMAIL] and x[CARD] end"] * 2
    assert ("None", "[IP]") in texts


# -- token counts --------------------------------------------------------------------
@pytest.mark.parametrize("block", [tokencount.BLOCK, 7])
def test_token_counts_round_trip(spark, tmp_path, block):
    texts = ["", "one", "two words", "x <|endoftext|> y", "é" * 50, "a " * 3000, None, "last"]
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, tokens int").coalesce(1)
    path = str(tmp_path / f"flat{block}")
    tokencount.write_flat(docs, path)
    enc = tokencount.encoder()
    got = tokencount.count_tokens(spark, path, block=block).orderBy("file", "doc_index").collect()
    assert [r.n_tokens for r in got] == [len(enc.encode_ordinary(t or "")) for t in texts]
    assert [r.doc_index for r in got] == list(range(len(texts)))
    raw = b"".join(r.content for r in spark.read.format("binaryFile").load(path + "/part-*").collect())
    flat = np.frombuffer(raw, "<u2")
    for r, t in zip(got, texts):
        assert enc.decode(flat[r.first_token: r.first_token + r.n_tokens].tolist()) == (t or "")


def test_token_scan_of_foreign_files(spark, tmp_path):
    """Texts across many blocks, a file without a last separator, a file of separators, an empty file."""
    end = tokencount.END_OF_TEXT
    files = {"part-0": [1, 2, end, 3] + [5] * 40, "part-1": [end, end, end], "part-2": [], "part-3": [end] + [9] * 30 + [end]}
    for name, tokens in files.items():
        (tmp_path / name).write_bytes(np.array(tokens, "<u2").tobytes())
    got = {}
    for r in tokencount.count_tokens(spark, str(tmp_path), block=8).collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.doc_index, r.first_token, r.n_tokens))
    assert {k: sorted(v) for k, v in got.items()} == {
        "part-0": [(0, 0, 2), (1, 3, 41)], "part-1": [(0, 0, 0), (1, 1, 0), (2, 2, 0)], "part-3": [(0, 0, 0), (1, 1, 30)]}


def test_token_report_counts_every_document(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    enc = tokencount.encoder()
    want = sorted(len(enc.encode_ordinary(r.text)) for r in docs.select("text").collect())
    assert sorted(r.n_tokens for r in tokencount.report(docs).collect()) == want
    assert tokencount.report(docs.limit(0)).collect() == []


# -- vector search --------------------------------------------------------------------
def brute_top(rows, k=5, every=50):
    vec = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vec.setdefault(i, set()).add(tuple(math.floor(256 * x) for x in v))
    flat = [(i, v) for i, s in vec.items() for v in s]
    out = []
    for q, qv in flat:
        if q % every == 0:
            scored = sorted(((-sum(a * b for a, b in zip(qv, v)), i) for i, v in flat if i != q and len(v) == len(qv)))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 64)
    monkeypatch.setattr(pivots, "QUERIES", 4)
    monkeypatch.setattr(pivots, "SEED", 40)
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * (1 + i % 3)]) for i in range(800)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]              # ties
    docs = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in pivots.top_k(docs).collect())
    assert got == brute_top(rows)


def test_top_k_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, [1.0, 1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (50, [0.0, 0.0]),
            (100, [1.0]), (None, [1.0, 1.0]), (1, [1.0, 1.0]), (6, []), (150, []), (7, [1e6, -1e6])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in pivots.top_k(docs).collect()) == brute_top(rows)
    assert pivots.top_k(docs.limit(0)).collect() == []


def test_top_k_prunes(spark):
    """Clustered vectors: the bounds skip most annuli and the result stays exact."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 6)) * 8
    rows = [(i, (centres[i % 20] + rng.normal(size=6) * 0.05).tolist()) for i in range(2000)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in pivots.top_k(docs).collect()) == brute_top(rows)
    base = pivots.quantised(docs, "vec_id", "embedding")
    plans, _ = pivots.build(base)
    q = np.array([[math.floor(256 * x) for x in rows[0][1]]], float)
    allowed = plans[6].bounds(q)[0] >= max(sum(a * math.floor(256 * b) for a, b in zip(q[0], v)) for _, v in rows[1:])
    assert plans[6].n[allowed].sum() < 0.8 * len(rows)
