"""Every query against its SQL on the smallest tables; those without SQL must give rows."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect

NO_SQL = {
    "additive_seasonal_forecast", "boosted_tree_forecast", "feature_importance", "sequence_regression", "batch_scoring", "rolling_refit_metrics",
}


# The text operators have tests of their own.
OWN = {n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(OWN & set(entry.oracle_sql())))
def test_equals_sql(spark, con, small, name):
    assert compare(spark, con, name, small) is None


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_gives_rows(spark, small, name):
    assert entry.queries()[name](spark, small).count() > 0


def test_every_query_is_checked():
    assert OWN == OWN & set(entry.oracle_sql()) | NO_SQL


@pytest.mark.parametrize("missing", ["xxhash", "ahocorasick", "public_tokenizers", "corpus_pipeline", "loadgauge.llm"])
def test_other_queries_stay_without_an_optional_module(missing):
    """In a process of its own, with the module made impossible to import."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries())"
    root = str(Path(entry.__file__).parent)
    made = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert OWN <= set(made.stdout.split()), made.stderr


def test_entry(spark):
    assert entry.entry(spark).columns == ["site", "ds", "y", "is_anomaly", "strategy", "replicas", "cost", "dropped"]
