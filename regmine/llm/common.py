"""Helpers shared by the operators: column choice, shared scratch tables, rows."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regmine.session import checkpoint_dir

TOKENIZER_FILE = "byte_bpe_50k.json"
_WRITTEN: list = []


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, as (doc_id, text); extra columns
    of any name are left behind, so they cannot clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def id_type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def texts_of(column, step: int = 256):
    """Strings of an Arrow column, a few at a time (null: empty)."""
    for i in range(0, len(column), step):
        for v in column.slice(i, step).to_pylist():
            yield v or ""


def bytes_of(column, step: int = 256):
    """UTF-8 bytes of an Arrow string column, a few at a time (null: empty)."""
    for i in range(0, len(column), step):
        for v in column.slice(i, step).cast(pa.binary()).to_pylist():
            yield v or b""


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: Largest table, by counted rows times a row's bytes, that a join sends to all.
BROADCAST_BYTES = 16 << 20


def sent_if_small(table: DataFrame, row_bytes: int) -> DataFrame:
    """``table`` (written) for a broadcast join if it is counted to be small;
    else as it is, and the join shuffles."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def write_shared(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of spark.checkpoint.dir
    and read it back: lineage is cut, every executor sees the files, and a lost
    executor costs only the tasks it had.  ``release`` removes the tables."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    # zstd works in pooled buffers; the default codec keeps direct memory per
    # reader, which adds up over many small partitions
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, tag: str) -> str:
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove the scratch tables written so far (call it when the results that
    read them are no longer needed).  Returns how many were removed."""
    jvm, n = spark.sparkContext._jvm, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _WRITTEN:
        p = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n
