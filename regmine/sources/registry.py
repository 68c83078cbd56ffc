"""Derive the 11-column text registry from the star-schema test tables.

The mapping is pure integer arithmetic on keys and dates so that an
independent SQL engine can rebuild it row for row.  ``k`` is the order key;
the first matching rule of each column wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regmine import schema as S


# Columns the registry reads from each source table, with their stored types:
# an explicit read schema skips schema inference (a footer-reading job per
# table per query) and prunes the scan to exactly these columns.
SOURCE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
    "lineitem": "l_orderkey BIGINT, l_shipdate TIMESTAMP_NTZ",
}


def load_table(spark: SparkSession, sf_dir: str, name: str, typed: bool = False) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if typed and name in SOURCE_SCHEMAS:
        return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def _fmt_day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def _fmt_ts(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def registry_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows (one per order), every column text, sentinels in place."""
    from regmine.session import ensure_utc
    ensure_utc(spark)
    orders = load_table(spark, sf_dir, "orders", typed=True).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customer = load_table(spark, sf_dir, "customer", typed=True).select("c_custkey", "c_nationkey")
    nation = load_table(spark, sf_dir, "nation", typed=True).select("n_nationkey", "n_name")
    # Earliest ship date per order: partial aggregation before the shuffle,
    # output hash-partitioned on the order key that the next join uses.  The
    # table has one row per order, so it grows with the data: join it as a
    # shuffled hash join on the order key (orders is shuffled once, ship keeps
    # its partitioning), never as a broadcast.  This also spreads the per-row
    # registry expressions over all partitions even when a scan is one split.
    ship = (load_table(spark, sf_dir, "lineitem", typed=True)
            .groupBy("l_orderkey").agg(F.min("l_shipdate").alias("ship"))
            .hint("shuffle_hash"))
    b = (orders
         .join(ship, orders.o_orderkey == ship.l_orderkey, "left")
         .join(customer, orders.o_custkey == customer.c_custkey)
         .join(nation, customer.c_nationkey == nation.n_nationkey))

    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    day0 = F.col("o_orderdate")
    name = F.col("n_name")
    spaced = F.replace(name, F.lit("_"), F.lit(" "))
    conf = (k % 11) == 0
    unk = (k % 7) == 0
    muni_no = (cust % 50 + 1).cast("string")

    def plus_days(n: Column) -> Column:
        return F.timestamp_add("DAY", n, day0)

    source = (F.when(k % 13 == 0, F.lit(S.UNKNOWN))
              .when(cust % 5 == 0, F.concat(F.lit("COMISION LOCAL DE "), name))
              .when(cust % 5 == 1, F.concat(F.lit("FISCALIA GENERAL DE "), name))
              .when(cust % 5 == 2, F.concat(F.lit("PROCURADURIA DE "), name))
              .when(cust % 5 == 3, F.concat(F.lit("SUBPROCURADURIA DE "), name))
              .otherwise(F.lit("PORTAL")))
    birth = (F.when(conf, F.lit(S.WITHHELD))
             .when(k % 23 == 0, F.lit(None).cast("string"))
             .when(k % 29 == 0, F.lit("31/02/1980"))
             .when(k % 31 == 0, _fmt_day(plus_days(F.lit(400))))
             .otherwise(_fmt_day(plus_days(-((cust * 37 + k) % 33000)))))
    sex = (F.when(conf, F.lit(S.WITHHELD))
           .when(k % 241 == 0, F.lit("INDETERMINADO"))
           .when((cust + k) % 4 == 0, F.lit("MUJER"))
           .otherwise(F.lit("HOMBRE")))
    disappeared = (F.when(conf, F.lit(S.WITHHELD))
                   .when(k % 37 == 0, F.lit(None).cast("string"))
                   .otherwise(_fmt_ts(F.timestamp_add("SECOND", (k * 61) % 86400, day0))))
    reg_secs = (k * 47) % 86400
    registered = (F.when(conf, F.lit(S.WITHHELD))
                  .when((k % 41 == 0) | F.col("ship").isNull(), F.lit(None).cast("string"))
                  .when(k % 5 == 0, _fmt_ts(F.timestamp_add("SECOND", reg_secs, F.col("ship"))))
                  .otherwise(_fmt_ts(F.timestamp_add(
                      "SECOND", reg_secs, F.timestamp_add("DAY", k % 9, day0)))))
    status = (F.when(conf, F.lit(S.WITHHELD))
              .when((F.col("o_orderstatus") == "F") & (k % 3 == 0), F.lit("NO LOCALIZADA"))
              .otherwise(F.lit("DESAPARECIDA")))
    state_code = (F.when(unk | (k % 997 == 1), F.lit(99))
                  .otherwise(F.col("n_nationkey") + 1)).cast("string")
    state = (F.when(unk, F.lit(S.UNKNOWN))
             .when(k % 101 == 0, F.concat(
                 F.lit(" "), F.lower(F.replace(name, F.lit("_"), F.lit("  "))), F.lit(" ")))
             .otherwise(spaced))
    muni_code = F.when(conf, F.lit(999)).otherwise(cust % 50 + 1).cast("string")
    muni = (F.when(conf, F.lit(S.WITHHELD))
            .when(k % 53 == 0, F.lit(S.UNKNOWN))
            .otherwise(F.concat(spaced, F.lit(" M"), muni_no)))
    return b.select(
        k.cast("string").alias(S.ID), source.alias(S.SOURCE), birth.alias(S.BIRTH),
        sex.alias(S.SEX), disappeared.alias(S.DISAPPEARED), registered.alias(S.REGISTERED),
        status.alias(S.STATUS), state_code.alias(S.STATE_CODE), state.alias(S.STATE),
        muni_code.alias(S.MUNI_CODE), muni.alias(S.MUNI))
