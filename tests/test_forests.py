"""Property checks for the forest queries (their trees have no SQL form)."""

import math
import re

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

from regmine import schema as S
from regmine.operators import classify as J
from regmine.operators import forest
from regmine.plans import catalog as CAT

from conftest import SF_SMALL


def test_forest_report_consistent(spark):
    model, test, feats = CAT.forest(spark, SF_SMALL)
    pred = J.predict(model, test, "ESTATUS_VICTIMA")
    rep = {r["class"]: r for r in J.classification_report(pred, "ESTATUS_VICTIMA").collect()}
    n_test = test.count()
    classes = [c for c in rep if c not in ("accuracy", "macro avg", "weighted avg")]
    assert sum(rep[c].support for c in classes) == n_test == rep["accuracy"].support
    acc = pred.agg(F.avg((F.col("ESTATUS_VICTIMA") == F.col("predicted")).cast("double"))).first()[0]
    assert abs(rep["accuracy"].f1 - round(acc, 6)) < 1e-6
    imp = [r.importance for r in J.feature_importance(model, feats).collect()]
    assert len(imp) == len(feats) and math.isclose(sum(imp), 1.0, abs_tol=1e-9)


def test_model3_three_classes_and_leak(spark):
    model, test, names = CAT.forest_model3(spark, SF_SMALL)
    assert sorted(model.stages[0].labels) == ["CONFIDENCIAL", "DESAPARECIDA", "NO LOCALIZADA"]
    top = J.feature_importance(model, names, 3).collect()
    assert any(r.feature == "SEXO_CONFIDENCIAL" for r in top)


def test_model3_on_the_registry_as_read(spark):
    _, test, names = CAT.forest_model3(spark, SF_SMALL)
    raw = CAT.raw(spark, SF_SMALL)
    want = J.random_split(raw, 0.3, 42, S.ID).where(F.col(J.SPLIT) == "test")
    assert sorted(r[0] for r in test.select(S.ID).collect()) == sorted(r[0] for r in want.select(S.ID).collect())
    states = {f"{S.STATE}_{r[0]}" for r in raw.select(S.STATE).distinct().collect()}
    assert any(x != x.upper() for x in states)                   # as read: lower case, outer blanks
    assert {x for x in names if x.startswith(S.STATE + "_")} <= states
    assert any(x != x.upper() for x in names if x in states)


def test_onehot_forest_tries_every_threshold(spark):
    rows = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("cat"), (F.col("id") % 200).cast("double").alias("x"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("y"))
    model, names = J.train_forest_onehot(rows, ["cat"], ["x"], "y", num_trees=5, weight_col=None)
    at = names.index("x")
    cuts = set(re.findall(rf"feature {at} <= ([0-9.]+)", model.stages[-1].toDebugString))
    assert len(cuts) > 31                                        # 32 bins allow 31


def test_null_category_has_zero_dummies(spark):
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("cat"),
        F.lit(None).cast("string").alias("none"), F.col("id").cast("double").alias("x"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("y"))
    model, names = J.train_forest_onehot(rows, ["cat", "none"], ["x"], "y", num_trees=2, weight_col=None)
    assert names == ["x", "cat_a", "cat_b"]
    new = spark.createDataFrame([("a", None, 1.0, "odd"), (None, None, 2.0, "odd"), ("z", "q", 3.0, "odd")],
                                "cat string, none string, x double, y string")
    got = [r.features.toArray().tolist() for r in model.transform(new).orderBy("x").collect()]
    assert got == [[1, 1, 0], [2, 0, 0], [3, 0, 0]]


def test_two_class_forests_predict_after_an_observation(spark):
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("cat"), (F.col("id") % 7).cast("double").alias("x"),
        F.when(F.col("id") % 3 == 0, "even").otherwise("odd").alias("y"))
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 300}
    codes = J.train_forest(rows, ["x"], "y", num_trees=2, max_depth=3, weight_col=None)
    onehot, _ = J.train_forest_onehot(rows, ["cat"], ["x"], "y", num_trees=2, max_depth=3, weight_col=None)
    for model in (codes, onehot):
        got = J.predict(model, rows, "y").select("predicted").collect()
        assert len(got) == 300 and {r[0] for r in got} <= {"even", "odd"}


def test_label_codes_number_values_per_column_null_last(spark):
    rows = spark.createDataFrame([("b", 2), (None, 1), ("a", 2), ("b", None), ("", 10)], "s string, n int")
    enc, codes = J.label_encode(rows, ["s", "n"])
    got = sorted(map(tuple, codes.collect()), key=lambda r: (r[0], r[2]))
    assert got == [("n", "1", 0), ("n", "10", 1), ("n", "2", 2), ("n", None, 3),
                   ("s", "", 0), ("s", "a", 1), ("s", "b", 2), ("s", None, 3)]
    assert {(r.s, r.n, r.s_idx, r.n_idx) for r in enc.collect()} == {
        ("b", 2, 2.0, 2.0), (None, 1, 3.0, 0.0), ("a", 2, 1.0, 2.0), ("b", None, 2.0, 3.0), ("", 10, 0.0, 1.0)}


def test_training_rows_are_dealt_over_all_cores(spark):
    rows = spark.range(0, 60000, 1, 1).select(
        (F.col("id") % 50).cast("double").alias("x"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"),
        F.lit(1.0).alias("weight"), F.col("id").alias("unused"))
    cores = spark.sparkContext.defaultParallelism
    dealt = J._dealt(rows, ["y", "x", "weight"], 60000, 1, 100)
    assert dealt.columns == ["y", "x", "weight"] and dealt.rdd.getNumPartitions() == 2 * cores
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 2 * cores and max(r[1] for r in sizes) <= 2 * 60000 / (2 * cores)
    # a task's rows stay bounded at any size, whatever the cores
    for n in (10 ** 6, 10 ** 8):
        assert n * (150 + 4 * 158 + 800) / J._parts(n, 158, 100, 4) <= 128 << 20


def test_onehot_forest_equals_the_one_on_attributes(spark):
    rows = spark.range(2000).select(
        F.concat(F.lit("c"), F.col("id") * 7 % 11).alias("cat"), (F.col("id") * 13 % 97).cast("double").alias("x"),
        F.when(F.col("id") == 0, "rare").otherwise("often").alias("once"),
        F.concat(F.lit("y"), (F.col("id") * 7 % 11 + F.col("id") * 13 % 97) % 3).alias("y"))
    plain, names = J.train_forest_onehot(rows, ["cat", "once"], ["x"], "y", num_trees=5, max_depth=6, weight_col=None)
    at = rows.count()
    dealt = J._dealt(rows, ["y", "cat", "once", "x"], at, len(names), 5)
    front = PipelineModel(stages=plain.stages[:-1])
    named = J._grow(front, front.transform(dealt), None, numTrees=5, maxDepth=6, maxBins=98, seed=42)
    assert "attrs" in front.transform(dealt).schema["features"].metadata["ml_attr"]
    assert plain.stages[-1].totalNumNodes == named.stages[-1].totalNumNodes
    a, b = ([m.featureImportances.toArray() for m in (plain.stages[-1], named.stages[-1])])
    assert abs(a - b).max() < 1e-9
    p, q = ([r[0] for r in m.transform(rows).orderBy("x", "cat").select("prediction").collect()] for m in (plain, named))
    assert p == q


def test_onehot_sample_holds_all_rows(spark):
    # one row in 20,000 has its own category: a sample of 10,000 rows may miss it
    rows = spark.range(20000).select(
        F.when(F.col("id") == 7, "odd").otherwise("even").alias("cat"), (F.col("id") % 5).cast("double").alias("x"),
        F.when(F.col("id") == 7, "a").otherwise("b").alias("y"))
    model, names = J.train_forest_onehot(rows, ["cat"], ["x"], "y", num_trees=20, max_depth=2, weight_col=None)
    assert model.stages[-1].featureImportances.toArray()[names.index("cat_odd")] > 0
    assert model.stages[-1].getMaxBins() ** 2 >= 20000


def _coded(spark, n=60000):
    """Rows whose class follows from the first two columns but for every seventh; few values, many copies."""
    a, x, i = F.col("id") * 7 % 11, F.col("id") * 13 % 17, F.col("id")
    odd = ((a < 4) & (x > 9)) | ((a >= 8) & (x <= 3))
    return spark.range(n).select(
        a.cast("double").alias("a"), x.cast("double").alias("x"),
        F.when(i % 5 > 0, F.concat(F.lit("c"), i % 5)).alias("cat"), F.lit("one").alias("same"),
        F.when(odd == (i % 7 > 0), "u").otherwise("v").alias("y"), F.when(i % 3 == 0, 2.0).otherwise(1.0).alias("weight"))


def _refuse(*args, **kwargs):
    raise AssertionError("the library's trainer got the rows")


def test_many_rows_grow_on_folded_rows(spark, monkeypatch):
    rows = _coded(spark)
    folded = forest.fold(rows.withColumn("label", F.lit(0.0)), ["a", "x"], "weight")
    assert folded.count() == 11 * 17 * 2 and folded.agg(F.sum("__n")).first()[0] == 60000
    monkeypatch.setattr(J, "_dealt", _refuse)                   # one copy of each row and tree before
    model = J.train_forest(rows, ["a", "x"], "y", num_trees=20, max_depth=6)
    again = J.train_forest(rows.repartition(7), ["a", "x"], "y", num_trees=20, max_depth=6)
    onehot, names = J.train_forest_onehot(rows, ["cat", "same"], ["a", "x"], "y", num_trees=20, max_depth=6)
    cuts = lambda m: [t.toDebugString.split("\n", 1)[1] for t in m.stages[-1].trees]
    assert cuts(model) == cuts(again)                                               # repeatable
    assert len({tuple(t.featureImportances.toArray()) for t in model.stages[-1].trees}) > 1      # bootstraps differ
    assert names == ["a", "x", "cat_c1", "cat_c2", "cat_c3", "cat_c4", "same_one"]
    assert model.stages[-1].getNumTrees == 20 and model.stages[-1].numFeatures == 2
    for m in (model, onehot):
        good = J.predict(m, rows, "y").agg(F.avg((F.col("y") == F.col("predicted")).cast("double"))).first()[0]
        assert good > 0.8 and all(t.depth <= 6 for t in m.stages[-1].trees)
        imp = m.stages[-1].featureImportances.toArray()
        assert math.isclose(imp.sum(), 1.0, abs_tol=1e-9) and imp[:2].sum() > 0.9


def test_parts_give_the_same_cuts_as_one(monkeypatch):
    rng = np.random.default_rng(3)
    layout = forest.Layout([np.arange(5.0), np.arange(300.0)], [["p", "q", "r"]], 3)
    codes = np.stack([rng.integers(0, b, 4000) for b in layout.bins]).astype("<u2")
    part = forest.Part([{"block": 0, "codes": codes.tobytes(), "label": ((codes[0] + codes[2]) % 3).astype("u1").tobytes(),
                         "weight": rng.choice([0.5, 2.0], 4000).astype("<f8").tobytes(), "count": np.ones(4000, "<i8").tobytes()}], 3)
    m, everything = 40, (rng.integers(0, 40, 4000).astype(np.int32), np.arange(4000, dtype=np.int32), part.weight)
    mask = layout.chosen(42, 7, 5, m)
    used = layout.used(mask)
    assert (mask.sum(axis=1) == 3).all() and layout.features == 5
    whole = forest._best(layout, mask, used, forest._counted(layout, part, used, 0, m, everything))
    monkeypatch.setattr(forest, "COUNT_BYTES", 1 << 15)
    ranges, found = list(forest._ranges(layout, used, 2)), []
    assert len(ranges) > 5 and ranges[0][0] == 0 and ranges[-1][1] == m
    for low, high in ranges:
        halves = [[v[h::2] for v in everything] for h in (0, 1)]
        counts = sum(forest._counted(layout, part, used, low, high, x) for x in halves)
        found.append(forest._best(layout, mask[low:high], used[low:high], counts))
    assert np.allclose(whole, np.concatenate(found))
    # against every cut, one by one
    gini = lambda w: 1 - sum((x / sum(w)) ** 2 for x in w) if sum(w) else 0.0
    at, weigh = everything[0], lambda ok: [part.weight[ok & (part.label == c)].sum() for c in range(3)]
    for node in range(m):
        mine, most = at == node, 0.0
        for f in np.flatnonzero(mask[node]).tolist():
            sides = [codes[f] > k for k in range(layout.bins[f] - 1)] if f < 2 else [codes[2] == f - 2]
            for right in sides:
                lw, rw, tw = weigh(mine & ~right), weigh(mine & right), weigh(mine)
                if sum(lw) and sum(rw):
                    most = max(most, gini(tw) - sum(lw) / sum(tw) * gini(lw) - sum(rw) / sum(tw) * gini(rw))
        assert math.isclose(whole[node, 2], most, abs_tol=1e-9)


def test_several_parts_grow_a_forest_like_one(spark, monkeypatch):
    rows = _coded(spark)
    monkeypatch.setattr(forest, "PART_ROWS", 150)
    monkeypatch.setattr(forest, "COUNT_BYTES", 2000)
    model = J.train_forest(rows, ["a", "x"], "y", num_trees=8, max_depth=5)
    good = J.predict(model, rows, "y").agg(F.avg((F.col("y") == F.col("predicted")).cast("double"))).first()[0]
    assert good > 0.8 and len(model.stages[-1].trees) == 8


def test_training_data_that_cannot_be_coded_goes_to_the_library(spark, monkeypatch):
    monkeypatch.setattr(forest, "grow", _refuse)
    rows = _coded(spark)
    assert J.train_forest(rows, ["a", "x"], "y", num_trees=1, max_depth=2, max_bins=8)
    monkeypatch.setattr(forest, "MAX_CODES", 10)
    assert J.train_forest(rows, ["a", "x"], "y", num_trees=1, max_depth=2)
