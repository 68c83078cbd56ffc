"""Training-order materialisation of token sequences (operator 7).

Documents are encoded, each followed by an end mark, joined per input partition
and cut into sequences of ``stride`` ids (the last of a partition is padded).
A keyed Feistel permutation with cycle-walking gives every sequence a place in
the training order; ranges of places are shards, and each shard is written in
order as records of a fixed stride, so record r begins at byte r * stride *
width and reading can resume anywhere.

The permutation's domain is known before anything is encoded: a partition has at
most (text bytes + rows) / stride + 1 sequences, as no id covers less than a
byte.  So the texts are encoded once and the ids are shuffled once; places that
no sequence takes are closed up by the shards' prefix counts, which keeps the
permutation's order and gives gapless global slots.

Null and empty texts are one end mark; repeated rows are written repeatedly; an
empty table gives no shard.  A shard is written under a name of its attempt and
then moved, so a lost executor or a second attempt leaves whole files only.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regmine.llm import bpe
from regmine.llm.common import id_and_text, shared_path, texts_of, write_shared

ROUNDS = 6


def _round(x, key, r):
    x = (x + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2 ** 64)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def feistel(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Keyed permutation of [0, size): a balanced Feistel network on the next
    even number of bits, walked on until the value is below ``size``."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    out = np.asarray(index, dtype=np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> shift, x & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_round(right, key, r) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


def materialise(docs: DataFrame, tokenizer_path: str, key: int, stride: int = 1024, end_id: int = 2,
                shard_places: int = 8192, id_col: str = "doc_id", text_col: str = "text", width: int = 2,
                folder: str | None = None) -> DataFrame:
    """Write the shards into ``folder`` (default: a new one in the shared
    checkpoint folder; any URI that pyarrow can write) and return one row per
    sequence: slot (global, gapless), shard, record (its place in the shard),
    part and idx (where it was cut), n_tokens (without padding), ids_crc32 (of
    the written record) and path."""
    spark = docs.sparkSession
    src = id_and_text(docs, id_col, text_col).select("text")
    folder = folder or shared_path(spark, "shards")
    dtype = np.dtype(f"<u{width}")
    end = np.array([end_id], dtype=dtype)

    # an upper bound of the sequences of each input partition; one row each
    bounds = (src.select(F.spark_partition_id().alias("part"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1)
                         .alias("b")).groupBy("part").agg(F.floor(F.sum("b") / stride).alias("n")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bounds = bounds.select("part", (F.col("n") + 1).alias("n"),
                           F.coalesce(F.sum(F.col("n") + 1).over(before), F.lit(0)).alias("base")).collect()
    size = sum(r["n"] for r in bounds)
    base = spark.sparkContext.broadcast({r["part"]: (r["base"], r["n"]) for r in bounds})

    def cut(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        encode = bpe.library_encoder(tokenizer_path)
        squeeze = zstandard.ZstdCompressor(level=1)      # the shuffle carries about two thirds of the ids' bytes
        first, most = base.value.get(part, (0, 0))
        rest, idx = np.zeros(0, dtype=dtype), 0

        def rows(ids, pad=False):
            nonlocal idx
            n = len(ids) // stride
            tokens = [stride] * n
            if pad and len(ids) % stride:
                tokens.append(len(ids) % stride)
                ids = np.concatenate([ids, np.zeros(stride - len(ids) % stride, dtype=dtype)])
                n += 1
            if idx + n > most:
                raise RuntimeError("an input partition has changed between two reads of it")
            place = feistel(np.arange(first + idx, first + idx + n), size, key) if n else np.zeros(0, np.int64)
            packed = [squeeze.compress(ids[i * stride:(i + 1) * stride].tobytes()) for i in range(n)]
            out = pa.RecordBatch.from_arrays(
                [pa.array(place // shard_places, pa.int64()), pa.array(place, pa.int64()),
                 pa.array(np.full(n, part), pa.int64()), pa.array(np.arange(idx, idx + n), pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array(packed, pa.binary())],
                names=["shard", "place", "part", "idx", "n_tokens", "ids"])
            idx += n
            return out

        for b in batches:
            got, held = [rest], len(rest)
            for text in texts_of(b.column(0)):
                ids = np.asarray(encode(text))
                if len(ids) and int(ids.max()) >> 8 * width:
                    raise ValueError(f"id {int(ids.max())} needs more than {width} bytes; give a larger width")
                ids = ids.astype(dtype)
                got += [ids, end]
                held += len(ids) + 1
                if held > (1 << 20):
                    got = np.concatenate(got)
                    whole = len(got) // stride * stride
                    yield rows(got[:whole])
                    got = [got[whole:]]
                    held = len(got[0])
            got = np.concatenate(got)
            whole = len(got) // stride * stride
            yield rows(got[:whole])
            rest = got[whole:]
        yield rows(rest, pad=True)

    dealt = (src.mapInArrow(cut, "shard bigint, place bigint, part bigint, idx bigint, n_tokens bigint, ids binary")
             .repartition("shard").sortWithinPartitions("shard", "place"))

    def write(batches):
        from pyarrow import fs
        swell = zstandard.ZstdDecompressor()
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        shard, out, record, temp = None, None, 0, None

        def close():
            out.close()
            files.move(temp, f"{root}/shard-{shard:08d}.bin")

        for b in batches:
            rows = []
            for s, _, part, idx, n, packed in zip(*(b.column(i).to_pylist() for i in range(6))):
                if s != shard:
                    if out is not None:
                        close()
                    shard, record = s, 0
                    temp = f"{root}/.{uuid.uuid4().hex}"
                    out = files.open_output_stream(temp)
                raw = swell.decompress(packed)
                out.write(raw)
                rows.append((s, record, part, idx, n, zlib.crc32(raw)))
                record += 1
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["shard", "record", "part", "idx", "n_tokens", "ids_crc32"])
        if out is not None:
            close()

    written = write_shared(dealt.mapInArrow(write, "shard bigint, record bigint, part bigint, idx bigint, "
                                                   "n_tokens bigint, ids_crc32 bigint"), "shard-records")
    # one row per shard
    sizes = written.groupBy("shard").agg(F.count("*").alias("n"))
    first = sizes.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return written.join(first, "shard").select(
        (F.col("first") + F.col("record")).alias("slot"), "shard", "record", "part", "idx", "n_tokens", "ids_crc32",
        F.concat(F.lit(f"{folder}/shard-"), F.lpad(F.col("shard").cast("string"), 8, "0"), F.lit(".bin")).alias("path"))


def read_records(path: str, first: int, count: int, stride: int = 1024, width: int = 2) -> np.ndarray:
    """Records ``first`` .. of a shard, by one seek: array (count, stride)."""
    from pyarrow import fs
    files, place = fs.FileSystem.from_uri(path)
    with files.open_input_file(place) as f:
        f.seek(first * stride * width)
        raw = f.read(count * stride * width)
    return np.frombuffer(raw, dtype=f"<u{width}").reshape(-1, stride)
