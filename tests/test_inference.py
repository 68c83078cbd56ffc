"""Types, date formats and order statistics found from the data."""
import random
import statistics

from pyspark.sql import functions as F

from regmine.operators import inference as IN
from regmine.operators import quantiles as Q
from regmine.operators import stats as G


def test_type_lattice(spark):
    rows = [("1", "1", "1", None, "x", " 7 ", "99999999999999999999"), ("-2", None, "2.5", None, "3", "+8", "1"),
            ("+3", "3", ".5e-3", None, None, "9", "2")]
    df = spark.createDataFrame(rows, "i string, inull string, d string, none string, t string, sp string, big string")
    got = {r["column"]: (r["type"], r["has_null"]) for r in IN.column_types(df).collect()}
    assert got == {"i": ("integer", False), "inull": ("decimal", True), "d": ("decimal", False),
                   "none": ("decimal", True), "t": ("text", True), "sp": ("integer", False), "big": ("decimal", False)}
    typed = IN.cast_inferred(df)
    assert dict(typed.dtypes)["sp"] == "bigint" and sorted(r.sp for r in typed.collect()) == [7, 8, 9]
    assert {r["type"] for r in IN.column_types(df.where("false")).collect()} == {"decimal"}


def test_dates_without_a_declared_format(spark):
    rows = [("2001-02-03", "13/02/2001", "02/03/2001"), ("2001-02-30", "01/02/2001", "12/31/2001"),
            ("2001-02-04 10:00:00", "2001-02-03", None), (None, "CONFIDENCIAL", "x")]
    df = spark.createDataFrame(rows, "iso string, dayfirst string, monthfirst string").withColumn("none", F.lit("n/a"))
    cols = ["iso", "dayfirst", "monthfirst", "none"]
    assert IN.date_formats(df, cols) == {"iso": ("9999-99-99", "yyyy-MM-dd"),
                                         "dayfirst": ("99/99/9999", "dd/MM/yyyy"),
                                         "monthfirst": ("99/99/9999", "MM/dd/yyyy")}
    out = IN.parse_dates_inferred(df, cols)
    got = [tuple(str(r[c + "_DT"])[:10] if r[c + "_DT"] else None for c in cols) for r in out.collect()]
    assert sorted(got, key=str) == sorted([("2001-02-03", "2001-02-13", "2001-02-03", None),
                                           (None, "2001-02-01", "2001-12-31", None),
                                           (None, None, None, None), (None, None, None, None)], key=str)


def test_quantiles_of_distinct_values_without_percentile_buffers(spark, monkeypatch):
    """As many values as rows; each stage holds ranges, the source is read once."""
    rnd = random.Random(4)
    xs = [rnd.uniform(-1e6, 1e6) for _ in range(5001)]
    df = spark.createDataFrame([(x, i % 2) for i, x in enumerate(xs)] + [(None, 0)], "x double, g int").repartition(5)
    used = []
    monkeypatch.setattr(F, "percentile", lambda *a: used.append(a))
    monkeypatch.setattr(F, "median", lambda *a: used.append(a))
    r = Q.summary(Q.ranked_values(df, "x"), q1=0.25, med=0.5, q3=0.75).first()
    cuts = statistics.quantiles(xs, n=4, method="inclusive")
    assert (r.n, r.med) == (5001, statistics.median(xs)) and not used
    assert all(abs(a - b) < 1e-6 for a, b in zip((r.q1, r.med, r.q3, r.mean, r["std"]),
                                                 (*cuts, statistics.fmean(xs), statistics.stdev(xs))))
    per = {r.g: r for r in Q.summary(Q.ranked_values(df, "x", ["g"]), ["g"], med=0.5).collect()}
    for g in (0, 1):
        own = [x for i, x in enumerate(xs) if i % 2 == g]
        assert per[g].n == len(own) and abs(per[g].med - statistics.median(own)) < 1e-6
    box = {r.g: r for r in G.box_stats(df, "x", by="g").collect()}
    assert box[0].n == 2501 and box[0].outliers == 0


def test_order_statistics_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    r = G.spread_stats(df, "x").first()
    assert r.q1 is None and r.variance is None and G.location_stats(df, "x").first().n == 0
    assert G.box_stats(df, "x").first().n == 0 and G.sigma_band(df, "x").first().n == 0


def test_sources_are_read_once(spark, tmp_path):
    """Rows scanned from the source files, by the scan's own accumulator."""
    path = str(tmp_path / "src")
    spark.range(4000).select((F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 3).alias("g")) \
        .repartition(4).write.parquet(path)
    read = spark.sparkContext.accumulator(0)
    for run in (lambda d: G.location_stats(d, "x"), lambda d: G.spread_stats(d, "x"), lambda d: G.box_stats(d, "x"),
                lambda d: G.box_stats(d, "x", "g"), lambda d: G.histogram(d, "x", 10), lambda d: G.sigma_band(d, "x"),
                lambda d: G.mode_table(d, ["g"])):
        seen = spark.sparkContext.accumulator(0)
        src = spark.read.parquet(path)

        def each(batches, seen=seen):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        run(src.mapInArrow(each, src.schema)).collect()
        read.add(seen.value)
        assert seen.value == 4000
    assert read.value == 7 * 4000
