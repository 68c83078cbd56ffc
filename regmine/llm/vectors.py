"""Integer vectors: the common first step of the operators on embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 2.0 ** 52            # larger scaled components are clipped to it


def finite(vec: Column) -> Column:
    """The vector is there and holds no null and no non-finite entry."""
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: float, *keep: Column) -> DataFrame:
    """(vec_id, x array<bigint>, kept columns) of the rows with a finite vector:
    x = floor(scale * component), the component as double."""
    src = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"), *keep)
    floor = lambda c: F.floor(F.greatest(F.least(F.lit(float(scale)) * c, F.lit(LIMIT)), F.lit(-LIMIT)))
    return (src.where(finite(F.col("v"))).withColumn("x", F.transform("v", floor)).drop("v"))


def by_length(column):
    """(length, row numbers, matrix) of an Arrow column of integer lists, one
    entry for each length that occurs."""
    values = column.values.to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy()
    size = np.diff(ends)
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        yield d, at, values[ends[at][:, None] + np.arange(d)]
