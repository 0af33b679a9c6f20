"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, not all zero and without null, NaN or infinite components."""
    c = F.col(vector)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(c.isNotNull() & ~bad & F.exists(c, lambda x: x != 0), F.lit(False))


def matrix(data: bytes, rows: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(rows, -1)
