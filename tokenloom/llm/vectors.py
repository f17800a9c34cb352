"""Integer vectors from tables of embeddings, and exact squared distances between them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.arrow import quoted

COMPONENTS = 64
# Larger components than this could make a squared distance that is no long.
LARGEST = 1 << 27
# Up to this, products and sums of them are exact as doubles too.
EXACT = 1 << 21


def integer_vectors(table: DataFrame, scale: int, key: str, vector: str, components: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """vec_id, the columns ``keep``, and v: floor(scale * x) of every component.

    Rows whose vector is null, has another number of components, or holds a null, NaN
    or infinity are dropped. A component beyond ``LARGEST`` fails the job by name.
    """
    v = quoted(vector)

    def bad(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    def scaled(x: Column) -> Column:
        n = F.floor(x.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(n) <= LARGEST, n).otherwise(F.raise_error(F.lit("vector component out of range"))).cast("int")

    whole = table.where(v.isNotNull()).where((F.size(v) == components) & ~F.exists(v, bad))
    return whole.select(quoted(key).alias("vec_id"), *(quoted(c) for c in keep), F.transform(v, scaled).alias("v"))


def matrix(column: pa.Array, components: int) -> np.ndarray:
    """A list column of whole vectors as rows of integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, components)


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distance of every point to every centre, as integers."""
    largest = max((int(np.abs(a).max()) for a in (points, centres) if a.size), default=0)
    if largest <= EXACT:
        # Every product and sum below is a whole number under 2^53.
        p, c = points.astype(float), centres.astype(float)
        found = (p * p).sum(1)[:, None] - 2 * (p @ c.T) + (c * c).sum(1)[None, :]
        return found.astype(np.int64)
    steps = [((points - c) ** 2).sum(1) for c in centres]
    return np.stack(steps, 1) if steps else np.zeros((len(points), 0), np.int64)


def floored_means(sums: np.ndarray, counts: np.ndarray, old: np.ndarray) -> np.ndarray:
    """floor(sum / count) by component; what has no members stays as it is."""
    filled = counts > 0
    out = old.copy()
    out[filled] = sums[filled] // counts[filled, None]
    return out


def joined_numbers(values: np.ndarray) -> str:
    return ",".join(map(str, values.reshape(-1).tolist()))
