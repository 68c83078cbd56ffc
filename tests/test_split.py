"""Splits: exact sizes, disjoint and complete, stable under repartitioning."""

from pyspark.sql import functions as F

from regmine.operators import classify as J


def test_stratified_exact_and_stable(spark):
    rows = [(str(i), "A" if i % 10 else "B") for i in range(2003)]
    df = spark.createDataFrame(rows, "ID_VICTIMA string, y string")
    a = J.stratified_split(df, "y", 0.2, 42, bucket_digits=2)
    b = J.stratified_split(df.repartition(7), "y", 0.2, 42, bucket_digits=2)
    ca = {(r.split, r.y): r["count"] for r in a.groupBy("split", "y").count().collect()}
    assert ca[("test", "A")] + ca[("test", "B")] == 401  # ceil(0.2 * 2003)
    assert ca[("test", "B")] in (40, 41)
    assert a.count() == 2003 and a.select("ID_VICTIMA").distinct().count() == 2003
    sa = {r.ID_VICTIMA: r.split for r in a.collect()}
    sb = {r.ID_VICTIMA: r.split for r in b.collect()}
    assert sa == sb


def test_report_zero_division(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "a")], "y string, predicted string")
    rep = {r["class"]: r for r in J.classification_report(df, "y").collect()}
    assert rep["b"].precision == 0.0 and rep["b"].recall == 0.0
    assert rep["accuracy"].f1 == round(2 / 3, 6)


def test_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "y string")
    w = {r.y: r.weight for r in J.class_weights(df, "y").collect()}
    assert w == {"a": round(4 / 6, 6), "b": 2.0}


def test_more_bucket_digits_same_split(spark):
    rows = [(str(i), "A" if i % 4 else "B") for i in range(1500)]
    df = spark.createDataFrame(rows, "ID_VICTIMA string, y string")
    a = {r.ID_VICTIMA: r.split for r in J.stratified_split(df, "y", 0.2, 7, bucket_digits=1).collect()}
    b = {r.ID_VICTIMA: r.split for r in J.stratified_split(df, "y", 0.2, 7, bucket_digits=5).collect()}
    assert a == b
