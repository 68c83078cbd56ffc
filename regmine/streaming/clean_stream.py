"""Incremental cleaning of newly arriving registry files.

The source project is batch-only; this is a by-product, not a new operator:
the cleaning and validation steps (D3, D5, E1-E4, E6, E7, E9, E10) are
row-local, so the very same functions run unchanged on a streaming
DataFrame.  Aggregates (statistics, mining) stay batch jobs over the written
products.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regmine import schema as S
from regmine.operators import clean as E
from regmine.sources.io import text_schema


def clean_stream(spark: SparkSession, source_dir: str, product: str = "temporal",
                 max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming DataFrame of the cleaned product for CSV files landing in
    ``source_dir`` (explicit all-text schema, no inference)."""
    raw = (spark.readStream.schema(text_schema(S.RAW_COLUMNS)).option("header", True)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(source_dir))
    g = E.general_product(raw)
    if product == "general":
        return E.project_general(E.serialize_dates(g, "general"))
    return E.project_temporal(E.serialize_dates(E.temporal_product(g), "temporal"))


def start_clean_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                       product: str = "temporal", available_now: bool = True):
    """Append cleaned rows as Parquet; the checkpoint folder (shared storage)
    makes the query restartable after a failure with exactly-once output."""
    w = (clean_stream(spark, source_dir, product).writeStream.format("parquet")
         .option("path", sink_dir).option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
