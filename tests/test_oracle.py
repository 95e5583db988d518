"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as contract
import check
from workload.case import CASES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", list(CASES))
def test_matches_sql(spark, con, name):
    problem = check.compare(
        spark, con, name, SF, contract.queries()[name], contract.oracle_sql()[name]
    )
    assert problem == "", problem


def test_every_double_is_rounded(spark):
    for name in ("ab_analysis", "cuped", "did", "event_study", "metric_overall"):
        df = CASES[name].run(spark, SF)
        doubles = {c for c, t in df.dtypes if t == "double"}
        assert doubles == set(CASES[name].digits), name


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 6
