"""A Gaussian kernel as columns: random Fourier features in front of a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@lru_cache(maxsize=4)
def _waves(gamma: float, size: int, dims: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and phases of the features; the same numbers wherever they are made."""
    draw = np.random.Generator(np.random.PCG64(seed))
    return draw.normal(0.0, np.sqrt(2.0 * gamma), (dims, size)), draw.uniform(0.0, 2.0 * np.pi, size)


#: Numbers that are made at a time.
_CHUNK = 1 << 17


def _in_chunks(batches: Iterator[pd.Series], gamma: float, size: int, dims: int, seed: int) -> Iterator[pd.Series]:
    """Features of the vectors in some thousand numbers at a time, however many rows a batch has."""
    directions, phases = _waves(gamma, size, dims, seed)
    rows = max(_CHUNK // max(size, dims), 1)
    for x in batches:
        for start in range(0, len(x), rows):
            out = np.stack(x.iloc[start : start + rows].to_numpy()) @ directions
            out += phases
            np.cos(out, out=out)
            out *= np.sqrt(2.0 / size)
            yield pd.Series(list(out))


class FourierFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Vectors whose inner products approach exp(-gamma * squared distance) as ``size`` grows.

    Each feature is sqrt(2 / size) * cos(direction . x + phase) with normal directions and uniform phases drawn from
    ``seed``. The map is a row's own: no statistics are gathered and nothing is shuffled. What a model saves are the
    five parameters alone. All vectors must have ``dims`` components.
    """

    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "column of features", TypeConverters.toString)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)
    dims = Param(Params._dummy(), "dims", "components of a vector", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of directions and phases", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="waves", gamma=1.0, size=512, dims=1, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol="features", outputCol="waves", gamma=1.0, size=512, dims=1, seed=42)

    @property
    def numFeatures(self) -> int:
        """Components of a vector that the map takes."""
        return self.getOrDefault("dims")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gamma, size, dims, seed = (self.getOrDefault(p) for p in ("gamma", "size", "dims", "seed"))
        if gamma <= 0 or size < 1 or dims < 1:
            raise ValueError("gamma, size and dims must be positive")

        @F.pandas_udf("array<double>")
        def waves(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            return _in_chunks(batches, gamma, size, dims, seed)

        made = array_to_vector(waves(vector_to_array(F.col(self.getOrDefault("inputCol")))))
        return dataset.withColumn(self.getOrDefault("outputCol"), made)
