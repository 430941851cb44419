"""What both operators on embeddings share: which vectors take part, and each different vector once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dimension(vectors: DataFrame) -> int:
    """The most frequent length of a vector that is not empty, the smaller at a tie; 0 without vectors."""
    sizes = vectors.groupBy(F.size("embedding").alias("n")).count().filter("n > 0")
    found = sizes.orderBy(F.desc("count"), "n").first()
    return found["n"] if found else 0


def takes_part(embedding: Column, size: int) -> Column:
    """Whether a vector has the dimension, only finite components, and one that is not 0."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) == size) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; large components are scaled first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True)) if len(x) else x


def bounded_sample(frame: DataFrame, key: str, column: str, most: int, size: int) -> np.ndarray:
    """At most ``most`` vectors, by a hash of their key, so that reruns agree."""
    rows = frame.select(F.xxhash64(key).alias("h"), column).orderBy("h").limit(most).collect()
    return np.array([r[column] for r in rows], dtype=np.float64).reshape(-1, size)
