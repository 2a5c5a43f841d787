"""Feature maps that let a linear SVM stand in for a kernel SVM.

Exact kernel training needs all pairs of rows; these maps approximate the
kernel by an inner product of fixed width, so training stays one pass per
iteration over the rows.

* ``rbf``: random Fourier features (Rahimi and Recht 2007)
* ``poly``: all products of three features, weighted so that the cubic kernel comes out exactly
* ``sigmoid``: Nystroem map on landmark rows, chosen among the rows that the map is fitted on
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import ElementwiseProduct, PolynomialExpansion
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KERNELS = ("linear", "poly", "rbf", "sigmoid")
DEGREE = 3
RBF_ERROR = 0.1  # that the kernel may be off by
WIDEST = 1 << 14  # random features, whatever the error
ALIKE = 8  # times as wide or spreads off that folds may lie and still share a map
BLOCKS = {"rbf": 96}  # rows mapped at once where a block made in one step is best kept in a core's cache


class KernelMap(Transformer, HasInputCol, HasOutputCol):
    """Maps a vector column with ``function`` (rows x features -> rows x width)."""

    @keyword_only
    def __init__(self, *, function=None, inputCol="scaled_features", outputCol="mapped_features"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.function = function

    def _transform(self, dataset: DataFrame) -> DataFrame:
        function = self.function

        @F.pandas_udf("array<double>")
        def mapped(rows: pd.Series) -> pd.Series:
            return pd.Series(list(function(np.stack(rows.to_numpy()))))

        return dataset.withColumn(
            self.getOutputCol(), array_to_vector(mapped(vector_to_array(self.getInputCol())))
        )


def rbf_map(features: int, width: int = 128, seed: int = 42):
    """Gamma is 1 / features, which suits standardised inputs."""
    rng = np.random.default_rng(seed)
    weights = rng.normal(scale=np.sqrt(2.0 / features), size=(features, width))
    phase = rng.uniform(0.0, 2.0 * np.pi, size=width)
    turns = {np.dtype(float): np.concatenate([weights, phase[None]])}

    def mapped(x: np.ndarray) -> np.ndarray:
        if x.dtype not in turns:
            turns[x.dtype] = turns[np.dtype(float)].astype(x.dtype)
        z = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1) @ turns[x.dtype]
        np.cos(z, out=z)
        z *= x.dtype.type(np.sqrt(2.0 / width))
        return z

    return mapped


def rbf_width(features: int, error: float = RBF_ERROR, points: int = 64, seed: int = 7) -> int:
    """The least power of two of random features whose kernel is off by at most ``error``.

    Measured on all pairs of a fixed set of standard-normal points, as standardised rows are.
    """
    x = np.random.default_rng(seed).normal(size=(points, features))
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / features)
    width = 128
    while width < WIDEST:
        z = rbf_map(features, width)(x)
        if np.abs(z @ z.T - exact).max() <= error:
            break
        width *= 2
    return width


def map_width(kernel: str, features: int, landmarks: int = 64) -> int:
    """Features of a kernel's map, the most it can have for ``sigmoid``."""
    widths = {"linear": lambda: features, "poly": lambda: math.comb(features + DEGREE - 1, DEGREE), "rbf": lambda: rbf_width(features)}
    return widths[kernel]() if kernel in widths else landmarks


def cubic(spark: SparkSession, features: int) -> PipelineModel:
    """Exact features of the kernel (x.y / features) ** 3: weighted products of three features.

    Spark's polynomial expansion gives the products; which ones they are is read off its
    image of distinct primes.  Lower degrees get no weight.
    """
    primes = [p for p in range(2, 30 * features + 10) if all(p % q for q in range(2, int(p**0.5) + 1))][:features]
    expansion = PolynomialExpansion(degree=DEGREE, inputCol="scaled_features", outputCol="products")
    row = spark.createDataFrame([(Vectors.dense(primes),)], ["scaled_features"])
    weights = []
    for value in expansion.transform(row).first()["products"].toArray().astype(np.int64).tolist():
        powers = []
        for p in primes:
            powers.append(0)
            while value % p == 0:
                value, powers[-1] = value // p, powers[-1] + 1
        full = sum(powers) == DEGREE
        weights.append(math.sqrt(math.factorial(DEGREE) / math.prod(map(math.factorial, powers)) / features**DEGREE) if full else 0.0)
    weighted = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="products", outputCol="mapped_features")
    return PipelineModel([expansion, weighted])


def cubic_map(features: int):
    """The features of ``cubic`` that have a weight, for blocks of rows.

    Products of two features are made once.  Those of three are the products of each feature with
    the pairs from it on, which lie side by side.
    """
    first = list(itertools.accumulate(range(features, 0, -1), initial=0))  # of the pairs that begin with a feature
    width = math.comb(features + DEGREE - 1, DEGREE)
    twice, thrice = math.sqrt(1 / 2), math.sqrt(1 / 3)  # of equal features there are fewer orders
    scale = math.sqrt(math.factorial(DEGREE) / features**DEGREE)

    def mapped(x: np.ndarray) -> np.ndarray:
        columns, kind = np.ascontiguousarray(x.T), x.dtype.type
        pairs, found, at = np.empty((first[-1], len(x)), x.dtype), np.empty((width, len(x)), x.dtype), 0
        for i, own in enumerate(columns):
            np.multiply(columns[i:], own, out=pairs[first[i] : first[i + 1]])
            pairs[first[i]] *= kind(twice)
        for i, own in enumerate(columns):
            products = found[at : at + first[-1] - first[i]]
            np.multiply(pairs[first[i] :], own * kind(scale), out=products)
            products[0] *= kind(thrice)
            products[1 : features - i] *= kind(twice)
            at += len(products)
        return found.T

    return mapped


class CubicFolds:
    """The cubic maps of differently scaled rows as linear functions of the map of rows that are scaled in common.

    ``scales`` has a mean and the inverse of a spread for each fold, ``common`` those of all rows.  A fold's values
    are an affine function of the common ones, so a product of three is a sum of products of the common values
    and one.  Models of all folds are thus scored on one map.
    """

    def __init__(self, common: tuple[np.ndarray, np.ndarray], scales: Mapping[int, tuple[np.ndarray, np.ndarray]]):
        self.mean, self.inverse = common
        features = len(self.mean)
        self.turns = {}
        for f, (mean, inverse) in scales.items():
            own = np.divide(inverse, self.inverse, out=np.zeros(features), where=self.inverse > 0)
            self.turns[f] = np.concatenate([np.diag(own), ((self.mean - mean) * inverse)[:, None]], axis=1)
        self.inner, self.outer = _Triples(features), _Triples(features + 1)
        self.mapped = cubic_map(features + 1)

    def alike(self) -> bool:
        """Whether no fold is scaled so much otherwise that sums of the common products lose digits that matter."""
        return max(np.abs(turn).max() for turn in self.turns.values()) < ALIKE

    def map(self, x: np.ndarray, kind: type = float) -> np.ndarray:
        scaled = (x - self.mean) * self.inverse
        return self.mapped(np.concatenate([scaled, np.ones((len(x), 1))], axis=1).astype(kind, copy=False))

    def lifted(self, fold: int, weights: np.ndarray) -> np.ndarray:
        """Weights of common features that score as ``weights`` of the fold's features do."""
        cube = self.inner.cube(weights * self.inner.sizes / self.inner.orders)
        return self.outer.listed(_turned(cube, self.turns[fold].T)) * self.outer.orders / self.outer.sizes

    def lowered(self, fold: int, sums: np.ndarray) -> np.ndarray:
        """Sums of the fold's features from the same sums of common features."""
        cube = self.outer.cube(sums / self.outer.sizes)
        return self.inner.listed(_turned(cube, self.turns[fold])) * self.inner.sizes


class _Triples:
    """Values of triples in the order of ``cubic_map`` and as symmetric cubes."""

    def __init__(self, features: int):
        self.features = features
        self.places = np.array(list(itertools.combinations_with_replacement(range(features), DEGREE))).T
        self.at = np.zeros((features,) * DEGREE, int)
        for order in itertools.permutations(range(DEGREE)):
            self.at[tuple(self.places[list(order)])] = np.arange(self.places.shape[1])
        self.orders = np.bincount(self.at.ravel())
        self.sizes = np.sqrt(self.orders / features**DEGREE)  # what a feature of ``cubic_map`` has beside its product

    def cube(self, values: np.ndarray) -> np.ndarray:
        return values[self.at]

    def listed(self, cube: np.ndarray) -> np.ndarray:
        return cube[tuple(self.places)]


def _turned(cube: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """The cube with ``turn`` applied along each of its sides."""
    for _ in range(DEGREE):
        cube = np.tensordot(cube, turn, axes=(0, 1))
    return cube


def sigmoid_map(landmarks: np.ndarray):
    """Nystroem map for tanh(gamma x.y); the kernel may be indefinite, so magnitudes are used."""
    gamma = 1.0 / landmarks.shape[1]
    values, vectors = np.linalg.eigh(np.tanh(gamma * landmarks @ landmarks.T))
    size = np.abs(values)
    keep = size > 1e-10 * size.max()
    root = vectors[:, keep] / np.sqrt(size[keep])
    return lambda x: np.tanh(gamma * x @ landmarks.T.astype(x.dtype)) @ root.astype(x.dtype)


class SigmoidLandmarks(Estimator):
    """Fits the sigmoid map on ``count`` rows of the frame it is given, so on no held-out row."""

    def __init__(self, key: str, count: int):
        super().__init__()
        self.key, self.count = key, count

    def _fit(self, dataset: DataFrame) -> KernelMap:
        return KernelMap(function=sigmoid_map(landmark_rows(dataset, self.key, self.count)))


def landmark_rows(scaled: DataFrame, key: str, count: int, vector: str = "scaled_features") -> np.ndarray:
    """A fixed number of rows in the order of a hash of their key."""
    rows = scaled.orderBy(F.xxhash64(key), key).limit(count).select(vector).collect()
    return np.array([row[0].toArray() for row in rows])
