"""Vectors of a table, those that take part, as blocks of numbers inside tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def takes_part(vector: Column) -> Column:
    """If a vector is there, isn't zero, and has finite components only."""
    v = vector.cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """The rows that take part, as id and v (an array of doubles). A null id takes no part."""
    return vectors.where(takes_part(F.col(vector)) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))


def matrix(column: pd.Series) -> np.ndarray:
    """Vectors of one length as rows; no vector gives no row and one column."""
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
