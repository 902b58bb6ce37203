"""Every registered query against its DuckDB oracle (sf0.001 for speed)."""

import pytest

import __spark_entry__ as entry_mod
from oracle_check import compare, duck

from conftest import SF_SMALL

from songpulse.session import checkpoint_root

from songpulse.plans.queries import REGISTRY

QUERIES = {k: v for k, v in entry_mod.queries().items() if k in REGISTRY}
ORACLE = {k: v for k, v in entry_mod.oracle_sql().items() if k in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


# Only the top-k report has a row limit; every other query runs over whole tables.
LIMIT_IS_THE_FEATURE = {"preview_10"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    limited = any(op in plan for op in ("GlobalLimit", "CollectLimit", "TakeOrderedAndProject", "LocalLimit"))
    assert limited == (name in LIMIT_IS_THE_FEATURE), plan[:300]
    # Inputs are the driver tables, or what Spark derived from them under the checkpoint folder.
    def norm(path):
        return "/" + path.replace("file:", "").lstrip("/")

    root = norm(checkpoint_root(spark))
    files = [norm(f) for f in df.inputFiles()]
    assert files and all(f.startswith(SF_SMALL) or f.startswith(root) for f in files), files[:3]
    problems, n = compare(df, con, ORACLE[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["genre", "tweet_time", "count"]
    assert df.count() > 0
