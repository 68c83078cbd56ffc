"""Every registered query with an oracle agrees with DuckDB on the smallest
test tables; plans contain no Python UDF evaluation."""

import pytest

from regmine.plans.catalog import ORACLE, QUERIES
from regmine.plans.verify import compare, duck_connect

from conftest import SF_SMALL

pytestmark = pytest.mark.usefixtures("shared_mining")


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], con)
    assert r["match"], r


@pytest.mark.parametrize("name", ["q0_state_profile", "e13_export_summary", "g17_concentration_index",
                                  "h2_pearson_matrix", "i13_generate_rules", "j4_stratified_split"])
def test_no_python_udf_in_plan(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_entry_smoke(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    assert df.count() > 0
    assert set(ent.oracle_sql()) <= set(ent.queries())
