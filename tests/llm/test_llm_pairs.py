"""Near-duplicates, decontamination, license scans: brute force and edge frames."""
import math
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from oracle_check import digest
from pyspark.sql import functions as F

from conftest import SF001
from spreadlab.llm import decontaminate, licenses, neardup, oracles
from spreadlab.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def shingles(t, k=5):
    w = words(t)
    return {tuple(w[i: i + k]) for i in range(max(len(w) - k + 1, min(len(w), 1)))}


def brute_classes(rows, threshold=0.8):
    """{row number: least id of its class} by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    share = defaultdict(int)
    for group in by.values():
        for a in range(len(group)):
            for b in range(a):
                share[group[b], group[a]] += 1
    for (a, b), n in share.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            top[find(b)] = find(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(rows))]


def frame(spark, rows, cols="doc_id long, text string"):
    return spark.createDataFrame(rows, cols)


def test_near_duplicates_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    want = dict(zip([r[0] for r in rows], brute_classes(rows)))
    got = {r.doc_id: r.class_id for r in neardup.report(docs).collect()}
    assert got == want
    assert len(set(want.values())) < len(want)


def edited(rng, vocabulary, n, changes):
    base = [vocabulary[i] for i in rng.integers(0, len(vocabulary), n)]
    out = [base]
    for c in changes:
        w = list(base)
        for i in rng.choice(n, c, replace=False):
            w[i] = vocabulary[rng.integers(0, len(vocabulary))] + "x"
        out.append(w)
    return [" ".join(w) for w in out]


def test_near_copies_at_the_threshold(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, n = [], 0
    for g in range(40):
        for t in edited(rng, vocabulary, int(rng.integers(60, 300)), [1, 2, 3, 5, 9]):
            rows.append((n, t))
            n += 1
    got = {r.doc_id: r.class_id for r in neardup.report(frame(spark, rows)).collect()}
    assert got == dict(zip(range(n), brute_classes(rows)))


def test_near_duplicate_edges(spark):
    long = " ".join(f"t{i}" for i in range(30000))
    rows = [(1, "a b c d e f g"), (2, "A b, c d e f g!"), (3, None), (4, ""), (5, "..."), (6, "one two"),
            (7, "one two"), (8, "one three"), (None, "a b c d e f g"), (9, long), (10, long + " tail"),
            (1, "a b c d e f g"), (None, "nobody names this text at all")]
    docs = frame(spark, [(d, t, "x", 0) for d, t in rows], "doc_id long, text string, class_id string, h1 int")
    got = sorted(((r.doc_id, r.class_id) for r in neardup.report(docs).collect()), key=str)
    want = sorted([(1, 1), (1, 1), (2, 1), (None, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 6), (8, 8), (9, 9), (10, 9),
                   (None, None)], key=str)
    assert got == want
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 4, 5, 6, 8, 9, None]
    assert neardup.report(docs.limit(0)).collect() == []


def test_hot_near_copy_group(spark):
    """A large group of near copies, and one of exact copies, stay whole."""
    base = [f"k{i}" for i in range(80)]
    rows = [(i, " ".join(base[:70] + [f"z{i}"] + base[70:])) for i in range(300)]
    rows += [(1000 + i, "the very same text in every one of these rows") for i in range(300)]
    rows += [(5000 + i, " ".join(f"q{i}_{j}" for j in range(40))) for i in range(20)]
    got = {r.doc_id: r.class_id for r in neardup.report(frame(spark, rows)).collect()}
    assert {got[i] for i in range(300)} == {0}
    assert {got[1000 + i] for i in range(300)} == {1000}
    assert all(got[5000 + i] == 5000 + i for i in range(20))


def test_near_copy_of_one_member_of_a_large_group(spark):
    """Near copies of single members, too far from all the others, join a hot group."""
    base = [f"k{i}" for i in range(200)]
    rows = []
    for i in range(400):
        w = list(base)
        w[int(np.random.default_rng(i).integers(10, 190))] = f"z{i}"
        rows.append((i, w))
    for i in range(150, 170):
        w = list(rows[i][1])
        at = w.index(f"z{i}")
        free = [j for j in range(12, 188, 11) if abs(j - at) > 10]
        for j in free[:: len(free) // 4][:4]:
            w[j] = f"y{i}_{j}"
        rows.append((1000 + i, w))
    rows = sorted((d if d < 200 else d + 5000 if d < 1000 else d - 700, " ".join(w)) for d, w in rows)
    want = dict(zip([d for d, _ in rows], brute_classes(rows)))
    assert set(want.values()) == {0}
    assert {r.doc_id: r.class_id for r in neardup.report(frame(spark, rows)).collect()} == want


def test_estimates_do_not_stand_for_links(spark):
    """Texts that share a much-repeated line agree in nearly all weighted registers, yet
    only the true pairs among them are linked."""
    line = " ".join(f"q{i}" for i in range(15))
    rows = [(d, " ".join([line] * 300 + [f"o{d}_{j}" for j in range(2)]))
            for d in [*range(20), *range(100, 140), *range(300, 320)]]
    rows += [(100 + d, t + "x") for d, t in rows if 100 <= d < 140]
    want = dict(zip([d for d, _ in rows], brute_classes(rows)))
    assert len(set(want.values())) == 80
    assert {r.doc_id: r.class_id for r in neardup.report(frame(spark, rows)).collect()} == want


def test_failed_forest_links_are_looked_behind(spark, monkeypatch):
    """Where a proposed forest isn't verified, all other pairs still are tried."""
    rng = np.random.default_rng(5)
    base = [f"k{i}" for i in range(150)]
    rows = []
    for i in range(60):                                # similarity about 0.75 between families, 0.9 inside
        w = list(base)
        for j in (10, 70):
            w[j + int(rng.integers(0, 40))] = f"f{i // 2}_{j}"
        if i % 2:
            w = rows[-1][1].split()
            w[140] = f"s{i}"
        rows.append((i, " ".join(w)))
    want = dict(zip([d for d, _ in rows], brute_classes(rows)))
    assert len(set(want.values())) > 5
    real = neardup._forest                             # the least likely links first
    monkeypatch.setattr(neardup, "_forest", lambda a, b, s: real(a, b, -s))
    assert {r.doc_id: r.class_id for r in neardup.report(frame(spark, rows)).collect()} == want


def test_repeated_lines_match_brute_force(spark):
    """A line repeated often in one of two texts counts once, in the sketch as in the similarity."""
    rows = []
    for g in range(24):
        base = " ".join(f"b{g}_{i}" for i in range(100))
        line = " ".join(f"l{g}_{i}" for i in range(10))
        rows += [(2 * g, base), (2 * g + 1, " ".join([base] + [line] * (20, 50, 100)[g % 3]))]
    want = dict(zip([d for d, _ in rows], brute_classes(rows)))
    assert all(want[2 * g + 1] == 2 * g for g in range(24))
    assert {r.doc_id: r.class_id for r in neardup.report(frame(spark, rows)).collect()} == want


def plain_similarity(x, y):
    """Probability Jaccard similarity as defined, x and y: {member: weight}."""
    every = set(x) | set(y)
    return sum(1 / sum(max(x.get(t, 0) / x[c], y.get(t, 0) / y[c]) for t in every) for c in set(x) & set(y))


def test_similarity_is_the_probability_jaccard():
    rng = np.random.default_rng(11)
    for _ in range(60):
        a, b = (np.unique(rng.integers(0, 30, rng.integers(1, 25))).astype(np.uint64) for _ in range(2))
        x, y = (rng.integers(1, 6, len(m)).astype(float) for m in (a, b))
        want = plain_similarity(dict(zip(a.tolist(), x)), dict(zip(b.tolist(), y)))
        assert abs(neardup.similarity(a, b, x, y) - want) < 1e-9
        sets = neardup.similarity(a, b)
        assert abs(sets - len(set(a) & set(b)) / len(set(a) | set(b))) < 1e-12
        assert abs(neardup.similarity(a, b, np.ones(len(a)), np.ones(len(b))) - sets) < 1e-9


def test_weights_by_occurrences(spark):
    """Sketched and verified by the weighted similarity: a repeated line may part what the sets join, and join what they part."""
    rng = np.random.default_rng(12)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    line, rows = [word() for _ in range(12)], []
    for g in range(12):
        base = [word() for _ in range(60)]
        for reps, changed in ((0, 0), (1, 0), (30, 0), (40, 0), (30, 1), (1, 2)):
            w = list(base)
            for i in rng.choice(60, changed, replace=False):
                w[i] = word()
            rows.append((len(rows), " ".join(w + line * reps)))
    bags = []
    for _, t in rows:
        w = words(t)
        bag = defaultdict(int)
        for i in range(len(w) - 4):
            bag[tuple(w[i: i + 5])] += 1
        bags.append(bag)
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            s = plain_similarity(bags[i], bags[j])
            assert abs(s - 0.8) > 1e-9
            if s >= 0.8:
                x, y = sorted((find(i), find(j)))
                top[y] = x
    want = [find(i) for i in range(len(rows))]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame(spark, rows), weights="count").collect()}
    assert [got[i] for i in range(len(rows))] == want
    assert want != brute_classes(rows)


def test_block_links_are_verified_and_few(spark):
    """Texts just under the threshold: many pairs agree, few are links; what leaves the blocks grows with the texts."""
    rng = np.random.default_rng(14)
    vocabulary = [f"v{i}" for i in range(5000)]
    out = {}
    for n in (60, 120):
        rows = list(enumerate(edited(rng, vocabulary, 130, [3] * n)))
        t = frame(spark, rows)
        sk = neardup.sketches(t).select(F.col("doc_id").alias("node"), "n", "regs")
        sets = neardup.shingle_sets(t, spark.sparkContext.broadcast(np.full(1 << 10, 2 ** 64 - 1, np.uint64)), "doc_id", "text", 5)
        mixed = sk.select(F.lit(1).cast("bigint").alias("bucket"), "node", "n", F.col("node").alias("label"),
                          F.lit(2).alias("p"), F.lit(1).alias("q"), F.lit(1).alias("side"))
        links = neardup._look(mixed, sk.select("node", "regs").join(sets, "node"), 150, 0.6, 0.8).collect()
        grams = [shingles(x) for _, x in rows]
        for r in links:
            a, b = grams[r.a], grams[r.b]
            assert len(a & b) / len(a | b) >= 0.8
        out[n] = len(links)
        comp = {r.node: r.label for r in components(spark.createDataFrame([(r.a, r.b) for r in links], "a long, b long")).collect()}
        assert [comp.get(i, i) for i in range(len(rows))] == brute_classes(rows)
    assert out[120] < 3 * out[60] and out[120] <= 3 * 121


def test_bands_at_the_threshold():
    """A pair at 0.8 shares no band with a probability below one in ten thousand."""
    assert (1 - 0.8 ** neardup.ROWS) ** neardup.BANDS < 1e-4


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 62, 600).astype(np.uint64)
    both = [(a[:500], np.ones(500)), (a[100:], np.ones(500))]
    m = 4096
    doc = np.repeat([0, 1], 500)
    regs = neardup.signatures(doc, np.concatenate([x[0] for x in both]), np.concatenate([x[1] for x in both]), 2, m)
    assert abs((regs[0] == regs[1]).mean() - 400 / 600) < 0.04


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (7, 3)]
    got = {r.node: r.label for r in components(frame(spark, edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 150: 100, 200: 100}
    assert components(frame(spark, [], "a long, b long")).collect() == []


# -- decontamination ---------------------------------------------------------
def oracle_op2(docs, items):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    if docs:
        con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    if items:
        con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    cur = con.execute(oracles.OP2)
    return digest([c[0] for c in cur.description], cur.fetchall())


@pytest.mark.parametrize("items", [
    [(1, "alpha beta gamma delta eps zeta eta theta iota kappa lam mu"), (2, "short item here"), (3, "x"), (4, None),
     (5, ""), (2, "short item here"), (11, "Alpha BETA gamma delta eps zeta eta theta iota kappa")],
    [],
])
def test_decontamination_edges(spark, items):
    docs = [(1, "x alpha beta gamma delta eps zeta eta theta iota kappa lam y"), (2, None), (3, ""),
            (4, "a short, ITEM here; short item"), (5, "short item here short item here"), (None, "x"), (1, "clean words"),
            (6, "alpha beta gamma delta eps zeta eta theta iota"), (7, "word " * 20000 + "short item here"),
            (8, "é x É")]
    frame_docs = frame(spark, [(d, t, 1, "z") for d, t in docs], "doc_id long, text string, h int, words string")
    out = decontaminate.decontamination_report(frame_docs, frame(spark, items, "item_id long, text string"))
    got = digest(out.columns, [tuple(r) for r in out.collect()])
    assert got == oracle_op2(docs, items)
    kept = decontaminate.drop_contaminated(frame_docs, frame(spark, items, "item_id long, text string"))
    assert kept.columns == frame_docs.columns
    bad = {(r.doc_id, r.n_words) for r in out.where("contaminated").collect()}
    assert sorted([r.doc_id for r in kept.collect()], key=str) == \
        sorted([d for d, t in docs if (d, len(words(t))) not in bad], key=str)


def test_decontamination_matches_sql(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text")
    out = decontaminate.decontamination_report(docs, items)
    rows = [tuple(r) for r in out.collect()]
    assert digest(out.columns, rows) == oracle_op2([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert any(r[-1] for r in rows)
    assert decontaminate.decontamination_report(docs.limit(0), items).collect() == []


# -- licenses ----------------------------------------------------------------
def brute_licenses(text, templates):
    """Templates of which some window holds 0.8 of the shingles."""
    w, found = words(text), set()
    for name, t in templates.items():
        want, tw = shingles(t), words(t)
        size = 2 * (1 << max(len(tw) - 1, 4).bit_length())
        for lo in range(0, max(len(w), 1)):
            if len(shingles(" ".join(w[lo: lo + size])) & want) >= 0.8 * len(want):
                found.add(name)
                break
    return sorted(found)


def test_licenses_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.licenses for r in licenses.scan(docs).collect()}
    rows = [tuple(r) for r in docs.collect()]
    assert any(got.values())
    for d, t in rows:
        assert got[d] == brute_licenses(t, licenses.TEMPLATES), d


def test_license_spans_and_edges(spark):
    mit = licenses.TEMPLATES["MIT"]
    notice = licenses.TEMPLATES["MIT-notice"]
    rows = [(1, f"é head. {mit}. Then more. {mit}"), (2, None), (3, ""), (4, "Released under the"),
            (5, "pad " * 3000 + notice.replace("copy", "copie") + " pad" * 3000), (1, "clean"), (None, mit.upper())]
    docs = frame(spark, [(d, t, "q") for d, t in rows], "doc_id long, text string, spans string")
    out = [(r.doc_id, r.licenses, [(s.id, s.start, s.end) for s in r.spans]) for r in licenses.scan(docs).collect()]
    text = rows[0][1]
    first = next(o for o in out if o[0] == 1 and o[1])
    assert [text[a:z] for _, a, z in first[2]] == [mit, mit]
    assert next(o for o in out if o[0] is None)[1] == ["MIT"]
    assert next(o for o in out if o[0] == 5)[1] == brute_licenses(rows[4][1], licenses.TEMPLATES) == ["MIT-notice"]
    assert sorted(str(o[0]) for o in out if not o[1]) == ["1", "2", "3", "4"]
    assert licenses.report(docs.limit(0)).collect() == []


def test_every_template_is_found_at_every_offset(spark):
    """Whole, and with as many shingles gone from one end as containment allows."""
    rng, rows, want = random.Random(3), [], {}
    for name, t in sorted(licenses.TEMPLATES.items()):
        w = words(t)
        n = max(len(w) - 4, 1)
        spare = n - math.ceil(0.8 * n)
        for at in range(2 << (len(w) - 1).bit_length()):
            for part in {tuple(w), tuple(w[spare:]), tuple(w[: len(w) - spare])}:
                pad = [f"w{rng.randrange(10 ** 6)}" for _ in range(at + 150)]
                want[len(rows)] = name
                rows.append((len(rows), " ".join([*pad[:at], *part, *pad[at:]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lost = [want[r.doc_id] for r in licenses.scan(docs).collect() if want[r.doc_id] not in r.licenses]
    assert lost == []


def test_bands_meet_their_bound():
    for size in (16, 32, 64, 1024):
        window = 2 * size - 4
        for n in range(max(size // 2 - 3, 5), size - 3):
            shared = math.ceil(0.8 * n)
            assert (1 - shared / (window + n - shared)) ** licenses.bands(n, window) <= licenses.MISS


def test_templates_of_any_size_by_parameter(spark):
    long = " ".join(f"clause{i}" for i in range(9000))
    docs = spark.createDataFrame([(1, "intro " * 700 + long + " end"), (2, long[: len(long) // 2]), (3, "tiny note")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.scan(docs, {"long": long, "tiny": "Tiny note", "none": ""}).collect()}
    assert got == {1: ["long"], 2: [], 3: ["tiny"]}
