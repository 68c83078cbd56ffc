"""Metamorphic properties: relabelling, partition count, product relations."""

from pyspark.sql import functions as F

from regmine import schema as S
from regmine.operators import clean as E
from regmine.operators import stats as G
from regmine.sources.registry import registry_view

from conftest import SF_SMALL


def test_diversity_invariant_to_relabelling(spark):
    rows = [(x,) for x in "aaabbbbccd"]
    a = G.diversity(spark.createDataFrame(rows, "c string"), "c").drop("variable").collect()[0]
    relab = [({"a": "z", "b": "y", "c": "x", "d": "w"}[x],) for (x,) in rows]
    b = G.diversity(spark.createDataFrame(relab, "c string"), "c").drop("variable").collect()[0]
    assert a == b


def test_mode_and_spread_invariant_to_partitioning(spark):
    rows = [(float(i % 13), str(i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, c string")
    for n in (1, 3, 8):
        d = df.repartition(n)
        assert G.spread_stats(d, "x").collect() == G.spread_stats(df.coalesce(1), "x").collect()
        assert G.mode_table(d, ["c"]).collect() == G.mode_table(df.coalesce(1), ["c"]).collect()


def test_general_flags_equal_temporal_plus_withheld(spark):
    raw = registry_view(spark, SF_SMALL)
    g = E.general_product(raw)
    t = E.temporal_product(g)
    withheld = g.where(F.col(S.BIRTH).eqNullSafe(S.WITHHELD))
    assert g.count() == t.count() + withheld.count()
    # the null-date counts of the general rows split exactly between the two parts
    for c in S.DATE_COLUMNS:
        ng = g.where(F.col(c).isNull()).count()
        assert ng == t.where(F.col(c).isNull()).count() + withheld.where(F.col(c).isNull()).count()
    # withheld rows carry no parsed dates, so chronology flags live only in temporal
    assert withheld.where(F.col(S.BIRTH + "_DT").isNotNull()).count() == 0


def test_minimum_information_rows_removed_once(spark):
    raw = registry_view(spark, SF_SMALL)
    from regmine.operators import block as B2
    before = raw.count()
    after = B2.drop_minimum_info(raw).count()
    summary = B2.minimum_info_summary(raw).collect()[0]
    assert before - after == summary.minimum_info
    assert B2.drop_minimum_info(B2.drop_minimum_info(raw)).count() == after


def test_queries_invariant_to_shuffle_partitions(spark):
    from regmine.plans import catalog as CAT
    names = ["q0_state_profile", "g1_mode_table", "g17_concentration_index", "k1_spearman_matrix",
             "i7_apriori", "i13_generate_rules", "j4_stratified_split_rows", "h3_flag_category_correlation"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = {}
    try:
        for parts in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            results[parts] = {n: sorted(tuple(r) for r in CAT.QUERIES[n](spark, SF_SMALL).collect())
                              for n in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for n in names:
        assert results["1"][n] == results["13"][n], n
