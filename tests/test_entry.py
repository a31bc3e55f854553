import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from oracle_check import TABLES, digest

SF = "/root/testdata/sf0.01"
ROWS_ONLY = {"eg_tau_aic", "screened_pairs_aic", "fit_logreg"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    out = df.collect()
    assert len(out) > 0
    assert df.columns == ["date", "rows", "sum_pnl", "avg_pnl"]


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) - set(entry.LLM_QUERIES) == ROWS_ONLY


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_training_data_operators(tmp_path, pipeline):
    """A copy of the library without the removable folders still imports, with or without the pipeline file."""
    here = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(here, "spreadlab"), tmp_path / "spreadlab", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])]:
        if os.path.exists(os.path.join(here, name)):
            shutil.copy(os.path.join(here, name), tmp_path)
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); "
            "assert not e.LLM_QUERIES and 'pipeline' not in q; print(len(q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) == len(set(entry.queries()) - set(entry.LLM_QUERIES))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["bars_1h", "screened_pairs", "features_5m", "pair_pnl_daily", "auc_rank",
                                  "upsert_bars", "normalize_epoch", "pnl_grouping_sets", "eg_tau_lag2",
                                  "read_screened_deep", "pair_list_universe", "restrict_screened_empty", "stream_ingest"])
def test_oracle_subset(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    h1, _ = digest(sdf.columns, [tuple(r) for r in sdf.collect()])
    h2, _ = digest(dcols, cur.fetchall())
    assert sorted(sdf.columns) == sorted(dcols)
    assert h1 == h2
