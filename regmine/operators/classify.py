"""Imbalance-aware classification (J1-J13) on Spark ML.

Splits are decided by an md5 hash of a stable key, so they do not change
with partitioning or task retries.  The exact per-class cut never sorts a
whole class in one task: rows are counted per (class, hash bucket), running
sums run over the bucket table, and only the one bucket of each class that holds
its cut is ranked; all rows are then compared with the cut.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regmine.functions.numeric import broadcast_bounded, broadcast_checked, scalars, r6, try_ratio
from regmine.operators import forest
from regmine.operators.concentration import running_sums
from regmine.session import materialize

SPLIT = "split"


def label_codes(df: DataFrame, cols: list[str]) -> DataFrame:
    """J1 as a table: (column, value, code) for every distinct value, null
    last.  One pass over the rows finds the distinct (column, value) pairs; they
    are numbered over ranges of (column, value), so no task or driver holds the
    values of a column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    found = materialize(df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
                        .select("column", "value", F.col("value").isNull().alias("__null"),
                                F.lit(1).cast("long").alias("one")))
    ranked = materialize(running_sums(found, ["column", "__null", "value"], ["one"]))
    first = ranked.groupBy("column").agg(F.min("cum_one").alias("__first"))  # one row per column
    return ranked.join(F.broadcast(first), "column").select(
        "column", "value", (F.col("cum_one") - F.col("__first")).alias("code"))


def label_encode(df: DataFrame, cols: list[str], suffix: str = "_idx"):
    """Codes by sorted value (0..k-1, null last), like a label encoder.
    Returns (encoded df with ``<col><suffix>`` plain doubles, the code table).
    Plain doubles carry no nominal metadata: a forest treats the codes as
    ordinal values, as a label-encoded matrix would be."""
    codes = materialize(label_codes(df, cols))
    sizes = {r[0]: r[1] for r in codes.groupBy("column").count().collect()}  # one row per column
    out = df
    for c in cols:
        table = codes.where(F.col("column") == c).select(
            F.col("value").alias("__value"), F.col("code").cast("double").alias(c + suffix))
        side = broadcast_bounded(table, sizes.get(c, 0))
        out = out.join(side, F.col(c).cast("string").eqNullSafe(F.col("__value")), "left").drop("__value")
    return out, codes


def class_distribution(df: DataFrame, label: str, split: str | None = None) -> DataFrame:
    """Count and percent per class (per split part when given).  The class
    counts are written, totals come from them."""
    keys = [split] if split else []
    g = materialize(df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("count")))
    if split:
        tot = g.groupBy(split).agg(F.sum("count").alias("__t"))
        g = g.join(tot, split)
        pct = try_ratio(F.col("count") * 100, F.col("__t"))
    else:
        pct = try_ratio(F.col("count") * 100, scalars(g.agg(F.sum("count").alias("n")))["n"])
    return g.select(*keys, label, "count", r6(pct).alias("pct"))


def _hash(id_col: str, seed: int):
    return F.md5(F.concat_ws("#", F.col(id_col).cast("string"), F.lit(str(seed))))


def stratified_split(df: DataFrame, label: str | None, test_frac: float = 0.2, seed: int = 42,
                     id_col: str = "ID_VICTIMA", bucket_digits: int = 4) -> DataFrame:
    """Exact stratified split.  The test part holds ceil(frac * N) rows,
    shared among classes as floor(n_test * n_c / N) plus one extra row for the
    largest remainders (ties by class); within a class the rows with the
    smallest hash of (id, seed) go to test.  ``label=None`` -> unstratified.
    Ids are unique; ``bucket_digits`` is the least number of hex digits of the
    hash bucket, it grows with the largest class.

    The source is read twice: once for the narrow (class, hash, id) table, from
    which each class's cut -- the hash and id of its last test row -- is found
    by bucket counts and one ranked bucket per class, and once for the rows,
    which are compared with their class's cut."""
    import math
    cls = F.coalesce(F.col(label).cast("string"), F.lit("\u0000null")) if label else F.lit("")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    keys = materialize(df.select(cls.alias("__cls"), _hash(id_col, seed).alias("__h"), key.alias("__key")))
    per = materialize(keys.groupBy("__cls").agg(F.count(F.lit(1)).alias("__n")))
    t = per.agg(F.sum("__n"), F.max("__n")).first()
    tot, n_max = float(t[0] or 0), t[1] or 0
    n_test = F.ceil(F.lit(float(test_frac)) * F.lit(tot))
    exact = n_test * F.col("__n") / F.lit(tot)
    per = per.withColumns({"__base": F.floor(exact), "__frac": exact - F.floor(exact)})
    rem = n_test - scalars(per.agg(F.sum("__base").alias("b")))["b"]
    wr = Window.orderBy(F.desc("__frac"), "__cls")  # one row per class
    per = per.withColumn("__t", (F.col("__base") + F.when(F.row_number().over(wr) <= rem, 1)
                                 .otherwise(0)).cast("long")).select("__cls", "__t")
    # the ranked bucket holds ~n_c / 16^d rows and the bucket table 16^d rows per
    # class; 16^d ~ sqrt(n_c) balances the two
    digits = max(bucket_digits, math.ceil(math.log(max(n_max, 1)) / (2 * math.log(16))))
    bucket = F.substring("__h", 1, digits)
    wb = Window.partitionBy("__cls").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    edge = (keys.groupBy("__cls", bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__bn"))
            .withColumn("__cum", F.sum("__bn").over(wb)).join(per, "__cls")
            .where((F.col("__cum") >= F.col("__t")) & (F.col("__cum") - F.col("__bn") < F.col("__t")))
            .select("__cls", "__b", (F.col("__t") - F.col("__cum") + F.col("__bn")).alias("__take")))
    we = Window.partitionBy("__cls").orderBy("__h", "__key")
    cuts = (keys.withColumn("__b", bucket).join(broadcast_checked(edge), ["__cls", "__b"])
            .withColumn("__rn", F.row_number().over(we)).where(F.col("__rn") == F.col("__take"))
            .select("__cls", F.struct(F.col("__h").alias("h"), F.col("__key").alias("k")).alias("__cut")))
    cuts = materialize(cuts)  # one row per class
    rows = df.withColumn("__cls", cls).join(broadcast_checked(cuts), "__cls", "left")
    mine = F.struct(_hash(id_col, seed).alias("h"), key.alias("k"))
    return rows.withColumn(SPLIT, F.when(mine <= F.col("__cut"), F.lit("test")).otherwise(F.lit("train"))).drop(
        "__cls", "__cut")


def random_split(df: DataFrame, test_frac: float = 0.3, seed: int = 42,
                 id_col: str = "ID_VICTIMA") -> DataFrame:
    """Unstratified seeded split with exactly ceil(frac * N) test rows."""
    return stratified_split(df, None, test_frac, seed, id_col)


def _weighted_classes(df: DataFrame, label: str) -> DataFrame:
    """(label, count, weight) from class counts that are written once."""
    per = materialize(df.groupBy(label).agg(F.count(F.lit(1)).alias("count")))
    t = scalars(per.agg(F.sum("count").cast("double").alias("N"), F.count(F.lit(1)).cast("double").alias("K")))
    return per.select(label, "count", (t["N"] / (t["K"] * F.col("count"))).alias("weight"))


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight N / (K * n_c) per row (one small class table joined back)."""
    per = _weighted_classes(df, label).select(label, F.col("weight").alias(out))
    return df.join(broadcast_checked(per), label)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """J5 as a table: (class, count, weight)."""
    return _weighted_classes(df, label).select(label, "count", r6(F.col("weight")).alias("weight"))


def train_forest(train: DataFrame, features: list[str], label: str, num_trees: int = 100,
                 max_depth: int = 12, max_bins: int | None = None, seed: int = 42,
                 weight_col: str | None = "weight", subsampling_rate: float = 1.0):
    """Random forest on numeric feature columns (label-encoded codes are
    plain doubles, i.e. ordinal).  Returns (fitted PipelineModel).  Over 50,000
    rows the trees grow on folded rows (``forest``), fewer go to the library.

    ``max_depth`` bounds the trees (the library allows at most 30); by default
    ``max_bins`` is the largest number of codes of a feature, so every code can
    be a threshold."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    seen = train.agg(F.count(F.lit(1)), *[F.max(c).alias(c) for c in features]).first()
    if max_bins is None:
        max_bins = max([64, *[int(v) + 2 for v in seen[1:] if v is not None]])
    lab = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc")
    vec = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    kept = [label, *features, *([weight_col] if weight_col else [])]
    front = Pipeline(stages=[lab, vec]).fit(train)
    model = _folded(front, train, features, [], [], weight_col, seen[0], num_trees, max_depth, max_bins, seed,
                    subsampling_rate)
    if model is not None:
        return model
    rows = front.transform(_dealt(train, kept, seen[0], len(features), num_trees))
    return _grow(front, rows, weight_col, numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins, seed=seed,
                 subsamplingRate=subsampling_rate)


_FEW_ROWS = 50_000  # up to so many are left to the library where they lie


def _folded(front, train: DataFrame, ordinal: list[str], cats: list[str], labels: list, weight_col: str | None, n: int,
            num_trees: int, max_depth: int, max_bins: int, seed: int, rate: float = 1.0):
    """``front`` and a forest grown on equal rows folded, or None where the rows
    are few or a column has more values than bins (or than 16-bit codes)."""
    from pyspark.ml import PipelineModel
    if n <= _FEW_ROWS or len(front.stages[0].labels) > forest.MAX_CLASSES or max(map(len, labels), default=0) > forest.MAX_CODES:
        return None
    folded = forest.fold(front.stages[0].transform(train), [*ordinal, *cats], weight_col)
    values = forest.values_of(folded, ordinal)
    if values is None or max(map(len, values), default=0) > max_bins:
        return None
    return PipelineModel(stages=[*front.stages, forest.grow(
        folded, values, cats, labels, ordinal, len(front.stages[0].labels), num_trees, max_depth, max_bins, seed, rate)])


_TASK_BYTES = 128 << 20


def _parts(n: int, width: int, num_trees: int, cores: int) -> int:
    """Tasks of a training pass: two for each core, more where one would hold
    over 128 MB of rows.  The library keeps a row as one integer for each slot
    and two for each tree (bootstrap count and node)."""
    return max(2 * cores, math.ceil(n * (150 + 4 * width + 8 * num_trees) / _TASK_BYTES))


def _dealt(train: DataFrame, cols: list[str], n: int, width: int, num_trees: int) -> DataFrame:
    """The n training rows, only ``cols``, dealt evenly over the tasks of the
    training passes.  Files of the small coded rows are far fewer than cores.
    Rows are ordered in each task: bootstrap counts and node ids go by the
    row's place, which a task that runs again has to find unchanged.  Up to
    50,000 rows stay where they lie."""
    if n <= _FEW_ROWS:
        return train.select(*dict.fromkeys(cols))
    parts = _parts(n, width, num_trees, train.sparkSession.sparkContext.defaultParallelism)
    cols = list(dict.fromkeys(cols))
    return train.select(*cols).repartition(parts).sortWithinPartitions(*cols)


def _grow(front, rows: DataFrame, weight_col: str | None, **params):
    """``front`` and a random forest fitted on its label and features, as one
    pipeline.  Each row's node is kept per tree, so that a level does not walk
    the trees from their roots.  The model is copied, which leaves out its
    training summary: that of two classes keeps the session, which cannot be
    sent to the predicting tasks once it has observed a table
    (``materialize_with``)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import RandomForestClassifier
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", bootstrap=True,
                                featureSubsetStrategy="sqrt", cacheNodeIds=True, **params)
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    return PipelineModel(stages=[*front.stages, rf.fit(rows).copy()])


def predict(model, df: DataFrame, label: str) -> DataFrame:
    """Predictions with the class name restored."""
    from pyspark.ml.feature import IndexToString
    labels = model.stages[0].labels
    out = model.transform(df)
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=labels)
    return back.transform(out)


def confusion_matrix(pred: DataFrame, label: str, predicted: str = "predicted") -> DataFrame:
    """Counts per (actual, predicted)."""
    return pred.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))


def classification_report(pred: DataFrame, label: str, predicted: str = "predicted") -> DataFrame:
    """J8 + J9: precision, recall, F1, support per class -- the classes of both
    sides, so one that is only predicted has support 0 and counts in the macro
    average -- then accuracy, macro and weighted averages (undefined ratios -> 0)."""
    cm = materialize(confusion_matrix(pred, label, predicted))  # one row per pair of classes
    act = cm.groupBy(F.col("actual").alias("cls")).agg(F.sum("count").alias("support"),
                                                      F.sum(F.when(F.col("actual") == F.col("predicted"),
                                                                   F.col("count")).otherwise(0)).alias("tp"))
    prd = cm.groupBy(F.col("predicted").alias("cls")).agg(F.sum("count").alias("npred"))
    per = act.join(prd, "cls", "full").select(
        "cls", F.coalesce("support", F.lit(0)).alias("support"), F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("npred", F.lit(0)).alias("npred"))
    z = F.lit(0.0)
    p = F.coalesce(try_ratio(F.col("tp"), F.col("npred")), z)
    r = F.coalesce(try_ratio(F.col("tp"), F.col("support")), z)
    f1 = F.coalesce(try_ratio(2 * p * r, p + r), z)
    per = per.select(F.col("cls").alias("class"), p.alias("precision"), r.alias("recall"),
                     f1.alias("f1"), F.col("support").cast("long").alias("support"), "tp")
    summ = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                   F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                   F.sum(F.col("precision") * F.col("support")).alias("wp"),
                   F.sum(F.col("recall") * F.col("support")).alias("wr"),
                   F.sum(F.col("f1") * F.col("support")).alias("wf"))
    nd = F.col("n").cast("double")
    extra = summ.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("tp") / nd).alias("f1"),
                 F.col("n").cast("long").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1"),
                 F.col("n").cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), (F.col("wp") / nd).alias("precision"),
                 (F.col("wr") / nd).alias("recall"), (F.col("wf") / nd).alias("f1"),
                 F.col("n").cast("long").alias("support")))))
    allrows = per.drop("tp").unionByName(extra)
    return allrows.select("class", r6(F.col("precision")).alias("precision"),
                          r6(F.col("recall")).alias("recall"), r6(F.col("f1")).alias("f1"), "support")


def accuracy(pred: DataFrame, label: str, predicted: str = "predicted") -> DataFrame:
    """Share of rows predicted correctly."""
    return pred.agg(r6(F.avg((F.col(label) == F.col(predicted)).cast("double"))).alias("accuracy"))


def feature_importance(model, names: list[str], k: int | None = None) -> DataFrame:
    """Forest importances sorted descending (bounded by feature count)."""
    rf = model.stages[-1]
    imp = rf.featureImportances.toArray().tolist()
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(names, [float(v) for v in imp])),
                               "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(k) if k else df


def compare_models(reports: dict[str, DataFrame], minority: str) -> DataFrame:
    """One row per model: accuracy, macro F1, minority precision/recall/F1."""
    rows = []
    for name, rep in reports.items():
        rows.append(rep.agg(
            F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
            F.max(F.when(F.col("class") == "macro avg", F.col("f1"))).alias("macro_f1"),
            F.max(F.when(F.col("class") == minority, F.col("precision"))).alias("minority_precision"),
            F.max(F.when(F.col("class") == minority, F.col("recall"))).alias("minority_recall"),
            F.max(F.when(F.col("class") == minority, F.col("f1"))).alias("minority_f1"))
            .select(F.lit(name).alias("model"), "*"))
    return reduce(DataFrame.unionByName, rows)


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of always predicting the most frequent class."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("c"))
    return per.agg(r6(F.max("c") / F.sum("c")).alias("baseline_accuracy"))


def group_majority_predict(train: DataFrame, test: DataFrame, group: str, label: str,
                           predicted: str = "predicted") -> DataFrame:
    """Rule-based reference prediction: the most frequent training class of the
    row's group (ties -> smallest class; unseen group -> overall majority).
    Deterministic, so reports built on it can be checked exactly."""
    g = train.groupBy(group, label).agg(F.count(F.lit(1)).alias("c"))
    best = g.groupBy(group).agg(F.min(F.struct((-F.col("c")).alias("n"), F.col(label).alias("v")))
                                .alias("b")).select(group, F.col("b.v").alias("__p"))
    overall = scalars(train.groupBy(label).agg(F.count(F.lit(1)).alias("c"))
               .agg(F.min(F.struct((-F.col("c")).alias("n"), F.col(label).alias("v"))).alias("b"))
               .select(F.col("b.v").alias("v")))["v"]
    return (test.join(broadcast_checked(best), group, "left")
            .withColumn(predicted, F.coalesce("__p", overall)).drop("__p"))


def train_forest_onehot(train: DataFrame, categorical: list[str], numeric: list[str], label: str,
                        num_trees: int = 100, max_depth: int = 12, seed: int = 42,
                        weight_col: str | None = "weight", max_bins: int | None = None):
    """J6 (model 3): sparse one-hot categories (never a dense dummy table) plus
    numeric columns; returns (PipelineModel, feature names).  A null category,
    like one that training never met, has zeros in all dummies of its column; a
    column without any value has none.

    ``max_bins`` is the largest number of bins of a numeric column, by default
    one for every distinct value.  The library picks thresholds from a sample of
    max(max_bins^2, 10,000) rows; the default is large enough for all rows, up
    to 46,340^2.  Where the sample holds all rows, the dummies are trained as
    plain 0/1 numbers: the same cuts and the same forest as with their two-value
    attributes, which the library counts several times slower."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    found = train.agg(F.count(F.lit(1)).alias("__n"),
                      *[F.max(F.col(c).isNotNull()).alias(c) for c in categorical],
                      *[F.count_distinct(c).alias(c) for c in numeric]).first()
    n = found["__n"]
    if max_bins is None:
        max_bins = max([32, min(math.isqrt(n) + 1, _MAX_SAMPLE_ROOT), *[found[c] + 1 for c in numeric]])
    kept = [label, *categorical, *numeric, *([weight_col] if weight_col else [])]
    categorical = [c for c in categorical if found[c]]
    # "keep" adds a last category for null and unknown values, which dropLast leaves out
    idx = StringIndexer(inputCols=categorical, outputCols=[c + "__i" for c in categorical],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=[c + "__i" for c in categorical],
                        outputCols=[c + "__v" for c in categorical], dropLast=True)
    lab = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc")
    vec = VectorAssembler(inputCols=numeric + [c + "__v" for c in categorical], outputCol="features",
                          handleInvalid="keep")
    front = Pipeline(stages=[lab, *([idx, ohe] if categorical else []), vec]).fit(train)
    # slot names from the assembled vector's attribute metadata (bounded by
    # the number of features)
    meta = front.transform(train).schema["features"].metadata["ml_attr"]
    slots = {}
    for group in meta["attrs"].values():
        for a in group:
            slots[a["idx"]] = a.get("name", str(a["idx"]))
    names = [slots.get(i, str(i)).replace("__v_", "_") for i in range(meta["num_attrs"])]
    model = _folded(front, train, numeric, categorical, [list(x) for x in front.stages[1].labelsArray] if categorical else [],
                    weight_col, n, num_trees, max_depth, max_bins, seed)
    if model is not None:
        return model, names
    rows = front.transform(_dealt(train, kept, n, len(names), num_trees))
    if n <= 10_000 or (max_bins <= _MAX_SAMPLE_ROOT and n <= max_bins ** 2):
        rows = rows.withColumn("features", F.col("features").alias("features", metadata={}))
    model = _grow(front, rows, weight_col, numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins, seed=seed)
    return model, names


_MAX_SAMPLE_ROOT = 46_340  # the library squares max_bins as a 32-bit integer
