"""Element-wise sums of arrays that tasks emit as partial results."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_by_position(partials: DataFrame, keys: list[str], values: str) -> DataFrame:
    """Add arrays of equal length per key: one row per (key, position)."""
    spread = partials.select(*keys, F.posexplode(values).alias("pos", "value"))
    return spread.groupBy(*keys, "pos").agg(F.sum("value").alias("value"))


def collect_vectors(partials: DataFrame, keys: list[str], values: str, length: int) -> dict:
    """The summed arrays on the driver, keyed by tuple. For statistics of a fixed size only."""
    result: dict[tuple, np.ndarray] = {}
    for row in sum_by_position(partials, keys, values).collect():
        key = tuple(row[: len(keys)])
        result.setdefault(key, np.zeros(length))[row["pos"]] = row["value"]
    return result


def matrix(column: pa.Array) -> np.ndarray:
    """Arrow column of equally long lists as a two-dimensional float array; a NULL list is a row of NaN, and NULL lists alone have no width."""
    whole = column.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.unique(column.value_lengths().drop_null().to_numpy(zero_copy_only=False))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths.tolist()}")
    out = np.full((len(column), int(lengths[0]) if len(lengths) else 0), np.nan)
    if out.shape[1]:
        out[whole] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, out.shape[1])
    return out


def list_column(rows: np.ndarray) -> pa.Array:
    """Two-dimensional float array as an Arrow list column."""
    n, width = rows.shape
    offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1)))
