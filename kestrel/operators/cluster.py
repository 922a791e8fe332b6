"""K-means clustering (M9-M11) with spark.ml.

Training is distributed (each iteration is one pass that aggregates per-centre
sums on the executors); only the ``k`` centres live on the driver, as part of
the model.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_features(df: DataFrame, array_col: str, output: str = "features") -> DataFrame:
    """Numeric array column -> dense vector column (keeps the other columns)."""
    return df.withColumn(output, array_to_vector(F.col(array_col).cast("array<double>")))


def fit(df: DataFrame, k: int = 3, max_iter: int = 10, seed: int = 1, features: str = "features") -> KMeansModel:
    """M9: fit k-means (k = 3, 10 iterations as in the original job; ml defaults differ)."""
    return KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features).fit(df)


def centers(model: KMeansModel, spark: SparkSession) -> DataFrame:
    """``(cluster, center)`` rows; ``k`` rows taken from the model itself."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def predict(model: KMeansModel, df: DataFrame) -> DataFrame:
    """Add the int ``prediction`` (index of the nearest centre)."""
    return model.transform(df)
