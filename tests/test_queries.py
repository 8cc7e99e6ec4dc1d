"""Every registered query against its SQL twin, and the shape of key plans."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, connect  # noqa: E402
from dqlake.queries import QUERIES  # noqa: E402
from dqlake.queries.silver_store import store  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["study_id", "site_id"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF).startswith(("ok", "rows only"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["subject_summary", "lab_monitoring", "data_quality_metrics", "validate_labs",
                                  "scd2_history", "reconciliation", "relation_profile"])
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_read_only_what_is_needed(spark):
    """A rollup of accepted visits reads its own columns and pushes the routing filter."""
    df = store(spark, SF).valid("visits").groupBy("study_id").count()
    text = plan(df)
    assert "ReadSchema: struct<study_id:string,_is_valid:boolean>" in text
    assert "EqualTo(_is_valid,true)" in text or "IsNotNull(_is_valid)" in text


def test_entry_without_what_the_corpus_operators_need(tmp_path):
    """A missing third-party package takes only the corpus operators down."""
    import subprocess

    code = ("import sys; sys.modules['xxhash'] = None; sys.modules['tokenizers'] = None; import warnings; "
            "warnings.simplefilter('ignore'); import __spark_entry__ as e; q = e.queries(); "
            "assert 'site_performance' in q and not any(n.startswith('op') and n[2].isdigit() for n in q)")
    root = str(Path(__file__).resolve().parents[1])
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
