"""Association rules (I13-I21) built from the itemset table.

Consequents grow level by level.  A rule's confidence only falls when items move
from its antecedent to its consequent, so consequents of m items are made from
pairs of kept consequents of m - 1 items of the same itemset, and one that misses
the confidence bound takes all that contain it with it.  Long itemsets therefore
cost as much as they have rules, not 2^k splits.  Supports come from equi-joins
on a canonical text key.  Multi-item consequents are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmine.functions.numeric import r6
from regmine.operators.itemsets import item_key
from regmine.session import materialize_with

# Fixed labels of the lift reading.
LIFT_POSITIVE = "Asociación positiva"
LIFT_INDEPENDENT = "Independencia"
LIFT_NEGATIVE = "Asociación negativa"


def _grown(kept: DataFrame, m: int) -> DataFrame:
    """Consequents of m positions from kept ones of m - 1 that share all but
    their last position."""
    head = F.slice("cons", 1, m - 2) if m > 2 else F.array().cast("array<int>")
    a = kept.select("__id", head.alias("head"), F.element_at("cons", -1).alias("x"), F.col("cons").alias("first"))
    b = kept.select("__id", head.alias("head"), F.element_at("cons", -1).alias("y"))
    return a.join(b, ["__id", "head"]).where(F.col("x") < F.col("y")).select(
        "__id", F.concat("first", F.array("y")).alias("cons"))


def generate_rules(itemsets: DataFrame, n_transactions: int,
                   min_confidence: float = 0.70) -> DataFrame:
    """(antecedents, consequents, antecedent_support, consequent_support,
    support, confidence, lift, freq) for confidence >= min_confidence.
    ``itemsets`` holds every subset of its sets, as mining gives them."""
    sets, seen = materialize_with(
        itemsets.where(F.col("k") >= 2).select(F.monotonically_increasing_id().alias("__id"), "items", "freq", "k"),
        longest=F.max("k"))
    sup = itemsets.select(item_key("items").alias("key"), F.col("freq").alias("f"))
    inside = lambda x, i: F.array_contains("cons", i)
    outside = lambda x, i: ~F.array_contains("cons", i)
    cand = sets.select("__id", F.posexplode("items").alias("at", "item")).select("__id", F.array("at").alias("cons"))
    levels, m = [], 1
    while True:
        split = cand.join(sets, "__id").where(F.size("cons") < F.col("k")).select(
            "__id", "cons", "freq", item_key(F.filter("items", outside)).alias("key"))
        kept, found = materialize_with(
            split.join(sup, "key").where(F.col("freq") / F.col("f") >= min_confidence)
            .select("__id", "cons", F.col("f").alias("fa")), n=F.count(F.lit(1)))
        levels.append(kept)
        m += 1
        if not found["n"] or m >= (seen["longest"] or 0):
            break
        cand = _grown(kept, m)
    rules = reduce(DataFrame.unionByName, levels).join(sets, "__id").select(
        F.filter("items", outside).alias("antecedents"), F.filter("items", inside).alias("consequents"), "freq", "fa")
    n = F.lit(float(n_transactions))
    conf = F.col("freq") / F.col("fa")
    return rules.join(sup, item_key("consequents") == F.col("key")).select(
        "antecedents", "consequents", (F.col("fa") / n).alias("antecedent_support"),
        (F.col("f") / n).alias("consequent_support"), (F.col("freq") / n).alias("support"),
        conf.alias("confidence"), (conf / (F.col("f") / n)).alias("lift"), "freq")


def _any_contains(arr: str, text: str) -> Column:
    return F.exists(arr, lambda x: x.contains(text))


def single_consequent(rules: DataFrame) -> DataFrame:
    """One-item consequents (array size, robust to commas in values)."""
    return rules.where(F.size("consequents") == 1)


def consequent_on(rules: DataFrame, column: str) -> DataFrame:
    """Rules whose consequent text starts with the column name."""
    return rules.where(F.array_join(F.array_sort("consequents"), ", ").startswith(column))


def filter_rules(rules: DataFrame, ant=None, cons=None, min_lift: float | None = 1.0,
                 min_conf: float | None = None, min_sup: float | None = None) -> DataFrame:
    """I16: antecedent / consequent must contain every given text in some item;
    thresholds; ordered by lift descending."""
    cond = F.lit(True)
    for t in ([ant] if isinstance(ant, str) else (ant or [])):
        cond = cond & _any_contains("antecedents", t)
    for t in ([cons] if isinstance(cons, str) else (cons or [])):
        cond = cond & _any_contains("consequents", t)
    if min_lift is not None:
        cond = cond & (F.col("lift") >= min_lift)
    if min_conf is not None:
        cond = cond & (F.col("confidence") >= min_conf)
    if min_sup is not None:
        cond = cond & (F.col("support") >= min_sup)
    return rules.where(cond).orderBy(F.desc("lift"))


def trivial_mask(consequent_text: str = "ENTIDAD", unknown: str = "SE DESCONOCE") -> Column:
    return (_any_contains("consequents", consequent_text) | _any_contains("antecedents", unknown)
            | _any_contains("consequents", unknown))


def drop_trivial_rules(rules: DataFrame, consequent_text: str = "ENTIDAD",
                       unknown: str = "SE DESCONOCE") -> DataFrame:
    """Drop rules concluding the state, or mentioning the unknown value."""
    return rules.where(~trivial_mask(consequent_text, unknown))


def interpret_lift(rules: DataFrame) -> DataFrame:
    """Positive / independent / negative association label."""
    return rules.withColumn("interpretacion_lift",
                            F.when(F.col("lift") > 1, F.lit(LIFT_POSITIVE))
                            .when(F.col("lift") == 1, F.lit(LIFT_INDEPENDENT))
                            .otherwise(F.lit(LIFT_NEGATIVE)))


def rule_funnel(rules: DataFrame, min_lift: float = 1.2) -> DataFrame:
    """Total rules -> lift >= min_lift -> and non-trivial, one pass."""
    lifted = F.col("lift") >= min_lift
    return rules.agg(F.count(F.lit(1)).alias("total"), F.count_if(lifted).alias("lifted"),
                     F.count_if(lifted & ~trivial_mask()).alias("non_trivial"))


# Fixed pattern presets: (antecedent texts, consequent texts).
PATTERNS = {
    "p1": (["SEXENIO_DESAPARICION"], ["SEXENIO_REGISTRO"]),
    "p2": (["ENTIDAD"], ["SEXENIO"]),
    "p3": (["SEXO"], []),
    "p3_state": (["SEXO"], ["ENTIDAD"]),
    "p3_age": (["SEXO"], ["GRUPO_EDAD"]),
    "p4": (["GRUPO_EDAD"], []),
}


def pattern(rules: DataFrame, name: str, min_lift: float = 1.2) -> DataFrame:
    """The named pattern query (I16 preset)."""
    ant, cons = PATTERNS[name]
    return filter_rules(rules, ant or None, cons or None, min_lift=min_lift)


def rule_text(rules: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Rules as sorted ', '-joined text with rounded measures."""
    return rules.select(
        F.array_join(F.array_sort("antecedents"), ", ").alias("antecedents"),
        F.array_join(F.array_sort("consequents"), ", ").alias("consequents"),
        r6(F.col("support")).alias("support"), r6(F.col("confidence")).alias("confidence"),
        r6(F.col("lift")).alias("lift"), *(extra or []))


def max_lift_by_term(rules: DataFrame, min_lift: float = 1.2) -> DataFrame:
    """For term -> same-term rules, the maximum lift per term and the age
    groups that appear in those rules."""
    p1 = filter_rules(rules, "SEXENIO_DESAPARICION", "SEXENIO_REGISTRO", min_lift=min_lift)
    term_d = F.element_at(F.filter("antecedents", lambda x: x.startswith("SEXENIO_DESAPARICION=")), 1)
    term_r = F.element_at(F.filter("consequents", lambda x: x.startswith("SEXENIO_REGISTRO=")), 1)
    same = p1.select(F.substring_index(term_d, "=", -1).alias("term"),
                     F.substring_index(term_r, "=", -1).alias("term_r"), "lift",
                     F.filter(F.concat("antecedents", "consequents"),
                              lambda x: x.startswith("GRUPO_EDAD=")).alias("ages"))
    same = same.where(F.col("term") == F.col("term_r"))
    rows = same.select("term", "lift", F.explode_outer("ages").alias("age"))
    return rows.groupBy("term").agg(
        r6(F.max("lift")).alias("max_lift"),
        F.array_join(F.array_sort(F.collect_set("age")), ", ").alias("age_groups"))
