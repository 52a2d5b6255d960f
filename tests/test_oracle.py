"""Every registered query against its SQL twin, over whole tables."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from compare import differences, open_tables

from hydroflow.plans.oracle import ORACLE
from hydroflow.plans.queries import QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    return open_tables(sf_dir)


def test_every_twin_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, sf_dir, tables, name):
    assert differences(spark, tables, QUERIES[name], ORACLE[name], sf_dir) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_model_query_has_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry():
    import __spark_entry__ as contract

    assert QUERIES.items() <= contract.queries().items()
    assert ORACLE.items() <= contract.oracle_sql().items()


def test_the_core_loads_without_the_training_data_operators():
    """As where a library that only they need is absent."""
    code = (
        "import sys; sys.modules['xxhash'] = None; sys.modules['hydroflow.llm'] = None\n"
        "import __spark_entry__ as contract\n"
        "from hydroflow.plans.queries import QUERIES\n"
        "assert contract.queries() == QUERIES"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
