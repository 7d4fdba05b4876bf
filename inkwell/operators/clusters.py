"""KMeans over standardised scores."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame

METRICS = ["cer", "jacc_multi", "ratios_mean"]


def clustered(scores: DataFrame, k: int = 3, standardise: bool = True, seed: int = 0) -> DataFrame:
    """scores (no nulls in METRICS) with a ``cluster`` of 0 to k - 1; an empty table stays empty."""
    wide = VectorAssembler(inputCols=METRICS, outputCol="raw").transform(scores)
    points = "raw"
    if standardise:
        wide = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True).fit(wide).transform(wide)
        points = "scaled"
    return KMeans(k=k, seed=seed, featuresCol=points, predictionCol="cluster").fit(wide).transform(wide).drop("raw", "scaled")
