"""The pipeline's stages against plain-Python twins, and the shape of the plans."""
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF001
from spreadlab.llm import mixing, privacy, queries, toxicity
from spreadlab.llm.textvec import mix as mix64
from test_llm_pairs import brute_classes, words
from test_llm_rows import brute_base, disclosing_twin, poisson_twin

NAMES = ["toxicity", "near_duplicates", "decontamination", "personal_data", "mixing"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """[(name, rows before, rows after)], each stage written and read as the pipeline does."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    extra = docs.limit(3).withColumn("doc_id", F.col("doc_id") + 100000)      # copies under other ids
    odd = spark.createDataFrame([(900001, None, None, None, None), (900002, "", "en", "src0", 0), (None, "x y", "en", None, 3)],
                                docs.schema)
    docs = docs.unionByName(extra).unionByName(odd).unionByName(docs.limit(1))     # and a repeated row
    path = str(tmp_path_factory.mktemp("pipe"))
    docs.write.parquet(f"{path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{path}/{t}.parquet")
    out, docs = [], spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, path).write.parquet(f"{path}/out/{name}")
        docs = spark.read.parquet(f"{path}/out/{name}")
        out.append((name, before, docs.collect(), docs.columns))
    return out, path


def test_names_and_columns(stages):
    assert [s[0] for s in stages[0]] == NAMES == [n for n, _ in corpus_pipeline.STAGES]
    for name, _, _, columns in stages[0][:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def keys(rows):
    return sorted([(str(r.doc_id), r.text or "") for r in rows])


def naive_score(text, model):
    """Forward-backward word by word, and the document's logistic function."""
    import pyarrow as pa
    from spreadlab.llm.textvec import chunks
    (_, _, data, offs), = chunks(pa.array([text or ""]), 1 << 60)
    w = toxicity.ToxicWords(data, offs)
    n = len(w)
    b = model["doc"]
    top = total = 0.0
    if n and "bias" in model:
        slots = list(w.features())
        u = [model["bias"] + float(sum(np.float64(model["weights"][f[i]]) for f in slots)) for i in range(n)]
        t = model["trans"]
        add = np.logaddexp
        f = [(0.0, u[0])]
        for i in range(1, n):
            p = f[-1]
            f.append((add(p[0] + t[0][0], p[1] + t[1][0]), u[i] + add(p[0] + t[0][1], p[1] + t[1][1])))
        g = [(0.0, 0.0)]
        for i in range(n - 1, 0, -1):
            q = g[-1]
            g.append((add(t[0][0] + q[0], t[0][1] + u[i] + q[1]), add(t[1][0] + q[0], t[1][1] + u[i] + q[1])))
        m = [1 / (1 + math.exp(-max(min(a[1] + z[1] - a[0] - z[0], 500), -500))) for a, z in zip(f, reversed(g))]
        top, total = max(m), sum(x for x in m if x >= 0.5)
    return 1 / (1 + math.exp(-(b[0] + b[1] * top + b[2] * math.log1p(total))))


def test_toxicity_stage(spark, stages):
    rows, path = stages
    _, before, after, _ = rows[0]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic"))
    assert keys(after) == keys([r for r in before if naive_score(r.text, model) < 0.5])
    assert 0.7 * len(before) < len(after) < len(before)


def test_near_duplicate_stage(stages):
    _, before, after, _ = stages[0][1]
    classes = brute_classes([(r.doc_id, r.text) for r in before])
    want = {(str(r.doc_id), r.text or "") for r, c in zip(before, classes) if c is None or c == r.doc_id
            or not words(r.text)}
    assert keys(after) == sorted(want)
    assert len(after) < len(before)


def test_decontamination_stage(spark, stages):
    rows, path = stages
    _, before, after, _ = rows[2]
    windows = set()
    for (t,) in spark.read.parquet(f"{path}/benchmark.parquet").select("text").collect():
        w = words(t)
        size = min(10, len(w))
        windows |= {tuple(w[i: i + size]) for i in range(len(w) - size + 1) if w}
    sizes = {len(w) for w in windows}

    def clean(t):
        w = words(t)
        return not any(tuple(w[i: i + k]) in windows for k in sizes for i in range(len(w) - k + 1))

    assert keys(after) == keys([r for r in before if clean(r.text)])


def test_personal_data_stage(stages):
    _, before, after, _ = stages[0][3]
    terms = disclosing_twin([(r.doc_id, r.text) for r in before])

    def masked(t):
        if not t:
            return t
        spans = sorted([(s, e, k) for k, s, e in brute_base(t)] + [(s, e, "term") for s, e in terms.get(t, ())],
                       key=lambda x: (x[0], x[1], privacy.KINDS.index(x[2])))
        out, at = "", 0
        for s, e, k in spans:
            if s >= at:
                out += t[at:s] + f"[{k.upper()}]"
            at = max(at, e)
        return out + t[at:]

    assert sorted((str(r.doc_id), masked(r.text) or "", r.source) for r in before) == \
        sorted((str(r.doc_id), r.text or "", r.source) for r in after)
    assert all(r.n_chars == len(r.text) for r in after if r.text and "[" in r.text)
    assert not any(re.search(r"[a-z0-9]@[a-z0-9-]+\.[a-z]", r.text or "") for r in after)


def test_mixing_stage(stages):
    _, before, after, _ = stages[0][4]
    size = {}
    for r in before:
        size[r.source] = size.get(r.source, 0) + 1
    weight = sum(math.sqrt(n) for n in size.values())
    want = {}
    for r in before:
        rate = math.sqrt(size[r.source]) / weight * len(before) / size[r.source]
        n = poisson_twin(rate, mixing.SEED, "-" if r.doc_id is None else r.doc_id)
        if n:
            want[r.doc_id] = n
    got = {}
    for r in after:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want
    assert all(math.isclose(r.rate, math.sqrt(size[r.source]) / weight * len(before) / size[r.source]) for r in after)


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF001).collect(), docs.schema) if name != "mixing" \
            else stage(spark, docs, SF001)
        assert docs.count() == 0, name


def test_plans_have_no_cross_joins_and_native_ones_no_python(spark):
    for name in ("op2_decontaminate", "op3_mix_sources", "op6_pivot_top_k", "op9_private_data"):
        df = queries.QUERIES[name](spark, SF001)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        if name in ("op3_mix_sources", "op9_private_data"):
            assert not re.search("Python|Pandas|Arrow", plan), name


def test_mix64_is_splitmix():
    assert int(mix64(np.array([0x9E3779B97F4A7C15], dtype=np.uint64))[0]) == 0xE220A8397B1DCDAF
