"""Balanced contiguous shards by global byte prefix sums (operator 8).

Rows are put in one global order (text hash, then id, size and checksum, so
equal texts lie side by side), range-partitioned, and summed inside each
partition.  Per-partition totals give each partition's offset; a row's byte
interval in the whole corpus is then known, and the corpus is cut at equal
targets.  Shards are contiguous in that order, their sizes differ by less than
two rows' sizes, and no group is ever gathered: a text that is a third of all
rows is spread over partitions by its ids.

Null text counts as no bytes; null ids sort first; repeated rows are placed one
after the other (they are interchangeable); an empty table gives no rows; a
shard may be empty when one row is larger than the target.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regmine.llm.common import id_and_text, id_type, write_shared

ROW_BYTES = 8            # bytes a row takes besides its text


def _running(batches):
    """Byte and row prefix of each row inside its sorted partition."""
    import numpy as np
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    size_before = rows_before = 0
    for b in batches:
        size = b.column(1).to_numpy()
        ends = np.cumsum(size) + size_before
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(np.full(len(size), part), pa.int64()),
             pa.array(ends - size, pa.int64()),
             pa.array(np.arange(rows_before, rows_before + len(size)), pa.int64())],
            names=["doc_id", "size", "text_crc32", "part", "local_bytes", "local_row"])
        if len(size):
            size_before, rows_before = int(ends[-1]), rows_before + len(size)


def shard_by_bytes(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law ('bytes'), shard
    (0 .. n_shards-1), slot (row number in its shard, gapless from 0),
    grown_shard (null: this law does not define it) and first_byte (bytes
    before the row in the global order)."""
    src = id_and_text(docs, id_col, text_col)
    text = F.coalesce("text", F.lit(""))
    narrow = write_shared(src.select(
        "doc_id", (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h")), "shard-sizes")
    ordered = (narrow.repartitionByRange("h", "doc_id", "size", "text_crc32")
               .sortWithinPartitions("h", "doc_id", "size", "text_crc32")
               .select("doc_id", "size", "text_crc32"))
    rows = write_shared(ordered.mapInArrow(
        _running, f"doc_id {id_type(src)}, size bigint, text_crc32 bigint, part bigint, "
                  "local_bytes bigint, local_row bigint"), "shard-prefix")
    # one row per partition: the totals and their prefix sums are small
    totals = rows.groupBy("part").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                            F.sum("b").over(everything).alias("total"))
    k = F.lit(int(n_shards)).cast("decimal(20,0)")
    # the middle of the row's byte interval decides; kept exact in decimals
    middle = (F.col("first_byte") * 2 + F.col("size")).cast("decimal(20,0)")
    placed = (rows.join(F.broadcast(offsets), "part")
              .withColumn("first_byte", F.col("b0") + F.col("local_bytes"))
              .withColumn("row", F.col("n0") + F.col("local_row"))
              .withColumn("shard", F.least(F.lit(int(n_shards) - 1), F.floor(
                  middle * k / (F.col("total") * 2).cast("decimal(20,0)")).cast("int"))))
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "first_byte")
