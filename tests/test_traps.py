"""Edge cases on tiny literal frames, one per semantic trap of the source
project (null vs sentinel, floored delay, band edges, parsing, coercion,
normalisation, ties, constants, diversity, concentration, skew/kurtosis)."""

import math

import pytest
from pyspark.sql import functions as F

from regmine import schema as S
from regmine.functions.bands import age_band_expr, term_band_expr
from regmine.functions.dates import floor_days_between, safe_timestamp
from regmine.functions.numeric import safe_long
from regmine.functions.text import normalize_text
from regmine.operators import concentration as C
from regmine.operators import correlate as H
from regmine.operators import features as FE
from regmine.operators import stats as G


def col(df, name):
    if isinstance(name, int):
        return [r[name] for r in df.collect()]
    return [r[0] for r in df.select(name).collect()]


def test_null_vs_sentinel_filter(spark):
    df = spark.createDataFrame([(None,), ("CONFIDENCIAL",), ("A",)], "SEXO string")
    df = df.withColumns({"ESTATUS_VICTIMA": F.lit("X"), "MUNICIPIO": F.lit("Y")})
    kept = sorted(col(FE.exclude_sentinel(df), "SEXO"), key=lambda x: (x is not None, x))
    assert kept == [None, "A"]


def test_delay_floor(spark):
    rows = [("2020-01-01 10:00:00", "2020-01-01 09:00:00"), ("2020-01-01 10:00:00", "2020-01-01 10:00:00"),
            ("2020-01-01 01:00:00", "2020-01-02 00:00:00"), ("2020-01-01 10:00:00", "2020-01-02 10:00:00")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        F.to_timestamp("a").alias("a"), F.to_timestamp("b").alias("b"))
    assert col(df.select(floor_days_between(F.col("a"), F.col("b"))), 0) == [-1, 0, 0, 1]


def test_age_band_edges(spark):
    df = spark.createDataFrame([(11.0,), (11.2,), (17.0,), (59.5,), (60.0,), (None,)], "a double")
    got = col(df.select(age_band_expr(F.col("a"))), 0)
    assert got == ["0-11", "12-17", "12-17", "60+", "60+", "DESCONOCIDO"]


def test_term_band_edges(spark):
    df = spark.createDataFrame([(y,) for y in (1993, 1994, 1999, 2000, 2029, 2030)], "y int")
    df = df.select(F.make_timestamp(F.col("y"), F.lit(6), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("t"))
    got = col(df.select(term_band_expr(F.col("t"))), 0)
    assert got == ["DESCONOCIDO", S.TERM_LABELS[0], S.TERM_LABELS[0], S.TERM_LABELS[1], S.TERM_LABELS[5],
                   "DESCONOCIDO"]


def test_date_parse(spark):
    vals = ["2025-09-28 4:40:00", "CONFIDENCIAL", "2020-02-31 00:00:00", "0021-01-01 00:00:00"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    bounded = col(df.select(safe_timestamp(F.col("s"), S.TIMESTAMP_FORMAT)), 0)
    assert bounded[0] is not None and bounded[1:] == [None, None, None]
    free = col(df.select(safe_timestamp(F.col("s"), S.TIMESTAMP_FORMAT, None, None)), 0)
    assert free[3] is not None


def test_numeric_coercion(spark):
    df = spark.createDataFrame([("99",), ("9.0",), ("x",), (None,), ("9.5",)], "s string")
    assert col(df.select(safe_long(F.col("s"))), 0) == [99, 9, None, None, None]


def test_normalise(spark):
    df = spark.createDataFrame([("\t a  b\n",), ("a  b",)], "s string")
    assert col(df.select(normalize_text(F.col("s"))), 0) == ["A B", "A B"]


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "v string")
    r = G.mode_table(df, ["v"]).collect()[0]
    assert r["mode"] == "a" and r["count"] == 2 and r["pct"] == 50.0


def test_correlation_with_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0)], "x double, y double")
    rows = {(r.var_a, r.var_b): r.r for r in H.pearson_matrix(df, ["x", "y"]).collect()}
    assert rows[("x", "y")] is None and rows[("x", "x")] == 1.0


def test_diversity(spark):
    one = spark.createDataFrame([("a",)] * 3, "c string")
    r = G.diversity(one, "c").collect()[0]
    assert (r.gini, r.evenness) == (0.0, 0.0)
    four = spark.createDataFrame([(x,) for x in "abcd"], "c string")
    r = G.diversity(four, "c").collect()[0]
    assert (r.gini, r.entropy, r.evenness) == (0.75, 2.0, 1.0)


@pytest.mark.parametrize("values,expected", [([0, 0, 0, 10], 1.0), ([5, 5, 5, 5], 0.0), ([7], None),
                                             ([0, 0], None)])
def test_concentration(spark, values, expected):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert C.concentration_index(df, "x").collect()[0].r == expected


def test_concentration_matches_sorted_formula(spark):
    import numpy as np
    xs = [0, 0, 1, 1, 1, 2, 5, 9, 9, 30, 0, 4]
    df = spark.createDataFrame([(float(v),) for v in xs], "x double")
    x = np.sort(np.array(xs, dtype=float))
    fi = np.arange(1, len(x) + 1) / len(x)
    qi = np.cumsum(x) / x.sum()
    ref = (fi[:-1] - qi[:-1]).sum() / fi[:-1].sum()
    assert math.isclose(C.concentration_index(df, "x").collect()[0].r, round(ref, 6), abs_tol=1e-6)
    trap = 1 - 2 * ((qi.sum() - (qi[0] + qi[-1]) / 2) / len(x))
    assert math.isclose(C.concentration_trapezoid(df, "x").collect()[0].r, round(trap, 6), abs_tol=1e-6)


def test_concentration_partition_invariant(spark):
    xs = [(float(v % 17),) for v in range(500)]
    a = C.concentration_index(spark.createDataFrame(xs, "x double").repartition(1), "x").collect()[0].r
    b = C.concentration_index(spark.createDataFrame(xs, "x double").repartition(7), "x").collect()[0].r
    assert a == b


def test_skew_kurtosis_bias_corrected(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 4, 9, 9)], "x double")
    r = G.shape_stats(df, "x").collect()[0]
    assert math.isclose(r.skewness, 0.271668, abs_tol=1e-6)
    assert math.isclose(r.kurtosis, -2.946492, abs_tol=1e-6)


def test_running_sums_over_many_ranges(spark):
    from regmine.operators.concentration import running_sums
    rows = [(float(i), float(i % 7 + 1)) for i in range(5000)]
    got = {r.v: r.cum_c for r in running_sums(spark.createDataFrame(rows, "v double, c double"), "v", ["c"]).collect()}
    total, want = 0.0, {}
    for v, c in rows:
        total += c
        want[v] = total
    assert got == want


def test_spearman_against_pandas(spark):
    import pandas as pd
    rows = [(float(i % 53), float((i * 7) % 31), None if i % 10 == 0 else float(i % 5)) for i in range(800)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r[0], r[1]): r[3] for r in H.spearman_matrix(df, ["a", "b", "c"]).collect()}
    ref = pd.DataFrame(rows, columns=["a", "b", "c"]).corr(method="spearman")
    assert abs(got[("a", "b")] - round(ref.loc["a", "b"], 6)) < 1e-6
    assert abs(got[("b", "c")] - round(ref.loc["b", "c"], 6)) < 1e-6


def test_counts_beyond_64_bit_products(spark):
    """Value tables with counts of 1e11: products of counts exceed 64 bits."""
    big = 10 ** 11
    vct = spark.createDataFrame([(0.0, big, 0, 0.0), (1.0, big, big, float(big)), (3.0, 2 * big, 2 * big, 7.0 * big)],
                                "v double, c long, a long, cum_sum double")
    s = C._sums(C._with_n(vct)).first()
    # limit of the index for many records: 1 - 2 * area under the Lorenz line
    area = 0.25 * (1 / 7) / 2 + 0.5 * (1 / 7 + 1) / 2
    assert abs((1 - 2 * s.T0 / ((s.N - 1) * s.S)) - (1 - 2 * area)) < 1e-9
    assert abs((1 - 2 * ((s.T1 / s.S - (s.xmin / s.S + 1) / 2) / s.N)) - (1 - 2 * area)) < 1e-9


def test_gini_impurity_of_large_counts(spark, monkeypatch):
    from regmine.operators import stats as G
    counts = spark.createDataFrame([("a", 10 ** 11), ("b", 3 * 10 ** 11)], "value string, c long")
    monkeypatch.setattr(G, "_proportions", lambda *a: counts)
    assert G.gini_impurity(counts, "value").first().gini == 0.375


def test_numeric_category_correlation_with_a_large_mean(spark):
    rows = [(1e9 + i % 2, "odd" if i % 2 else "even") for i in range(1000)]
    got = {r.category: r.r for r in H.numeric_category_correlation(
        spark.createDataFrame(rows, "x double, k string"), "x", "k").collect()}
    assert got == {"odd": 1.0, "even": -1.0}


def test_report_counts_a_class_that_is_only_predicted(spark):
    from regmine.operators import classify as J
    pred = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "b")], "y string, predicted string")
    rep = {r["class"]: r for r in J.classification_report(pred, "y").collect()}
    assert rep["c"].support == 0 and rep["c"].precision == 0.0
    assert rep["macro avg"].precision == 0.666667


def test_csv_by_header_name_quotes_and_malformed_rows(spark, tmp_path):
    from regmine.sources import io as IO
    p = tmp_path / "in.csv"
    p.write_text('B,A,C\nb1,"x ""q"", y",\nb2,NA,"c,2"\n')
    got = [tuple(r) for r in IO.read_registry_text(spark, str(p), ["A", "B"]).collect()]
    assert got == [('x "q", y', "b1"), ("NA", "b2")]
    assert [r.A for r in IO.read_registry(spark, str(p), ["A"]).collect()] == ['x "q", y', None]
    with pytest.raises(ValueError):
        IO.read_registry_text(spark, str(p), ["A", "Z"])
    p.write_text("A,B\na1,b1\na2,b2,extra\na3\n")
    rep = {r.A: r._malformed for r in IO.read_registry_text(spark, str(p), ["A", "B"], malformed="report").collect()}
    assert rep["a1"] is None and rep["a2"] == "a2,b2,extra" and rep["a3"] == "a3"
    with pytest.raises(Exception):
        IO.read_registry_text(spark, str(p), ["A", "B"]).collect()
    df = spark.createDataFrame([('say ""hi""', ' a, "b" '), ("", None)], "A string, B string")
    IO.write_csv(df, str(tmp_path / "out"))
    back = sorted(map(tuple, IO.read_registry_text(spark, str(tmp_path / "out"), ["A", "B"]).collect()), key=repr)
    assert back == sorted(map(tuple, df.collect()), key=repr)


def test_dummy_items_long_form(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "i long, k string")
    assert sorted(map(tuple, H.dummy_items(df, "i", "k").collect())) == [(1, "k_a"), (3, "k_b")]
