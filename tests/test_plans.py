"""Plan hygiene over every registered query: nothing but aggregate outputs
(compressed tables) is funnelled into a single partition, and no Python
evaluation node appears."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from regmine.plans.catalog import QUERIES
from regmine.plans.inspect import python_udf_nodes, single_partition_violations

from conftest import SF_SMALL

pytestmark = pytest.mark.usefixtures("shared_mining")

FORESTS = {"j6_train_forest", "j7_predict", "j8_forest_report", "j10_feature_importance",
           "j11_compare_models", "j6_forest_model3_importance", "j8_forest_model3_report",
           "j6_forest_features", "j7_predict_rows", "j8_forest_supports", "j10_importance_features",
           "j6_forest_model3_names", "j8_forest_model3_supports"}


def test_checker_flags_global_window_over_rows(spark):
    df = spark.range(1000).withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert single_partition_violations(df)


def test_checker_accepts_global_aggregate(spark):
    assert not single_partition_violations(spark.range(1000).agg(F.sum("id")))


def _single(df):
    """Violations, but for tables that ``materialize`` has written: their
    producing plans are checked before they are written (below)."""
    return [b for b in single_partition_violations(df) if not b.startswith(("Scan parquet", "Scan ExistingRDD"))]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FORESTS))
def test_query_plan_is_scale_safe(spark, name, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    seen = []
    write = DataFrameWriter.parquet

    def checked(self, *args, **kwargs):
        seen.append((_single(self._df), python_udf_nodes(self._df)))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", checked)
    df = QUERIES[name](spark, SF_SMALL)
    for bad, python in [*seen, (_single(df), python_udf_nodes(df))]:
        assert bad == [] and python == []
