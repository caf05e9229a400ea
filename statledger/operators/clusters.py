"""K-means segments and centroid-distance anomalies with MLlib."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.operators.quantile import nth_smallest
from statledger.session import written


def _fitted(features: DataFrame, cols: Sequence[str], k: int, seed: int, **fit):
    means = KMeans(
        k=k,
        seed=seed,
        featuresCol="_scaled",
        predictionCol="segment",
        initMode="k-means||",
        **fit,
    )
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(cols), outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
            means,
        ]
    )
    return pipeline.fit(features)


def kmeans_segments(
    features: DataFrame, cols: Sequence[str], k: int, seed: int = 1, **fit
) -> DataFrame:
    """``features`` with the segment of each row, clustered on standardised columns.

    ``fit`` goes to ``KMeans``: ``maxIter``, ``tol`` and the like.
    """
    features = written(features, "features")
    model = _fitted(features, cols, k, seed, **fit)
    return model.transform(features).drop("_raw", "_scaled")


def anomaly_flags(
    features: DataFrame,
    cols: Sequence[str],
    k: int,
    contamination: float = 0.02,
    seed: int = 1,
    keep: Sequence[str] = (),
    **fit,
) -> DataFrame:
    """Each row's normalised distance to its nearest centroid, and the farthest flagged.

    The distance to a centroid is divided by the root mean square distance of
    the rows assigned to it. Rows farther than the ``1 - contamination`` quantile
    are flagged. Centroids are plan literals: ``k`` vectors, whatever the
    input's size. Features and scores are stored, because several passes read them.
    ``keep`` names columns that tell whose row it is.
    """
    features = written(features.select(*keep, *cols), "features")
    model = _fitted(features, cols, k, seed, **fit)
    centres = model.stages[-1].clusterCenters()
    point = vector_to_array("_scaled")

    def distance(centre) -> Column:
        squares = [(point[i] - F.lit(float(x))) ** 2 for i, x in enumerate(centre)]
        return F.sqrt(sum(squares[1:], squares[0]))

    measured = model.transform(features).withColumns(
        {f"_d{i}": distance(c) for i, c in enumerate(centres)}
    )
    assigned = F.element_at(
        F.array(*[F.col(f"_d{i}") for i in range(len(centres))]), F.col("segment") + 1
    )
    spread = (
        measured.groupBy("segment")
        .agg(F.sqrt(F.avg(assigned**2)).alias("radius"))
        .collect()  # at most k rows
    )
    radius = {r.segment: r.radius for r in spread}
    normal = [
        F.col(f"_d{i}") / F.lit(radius[i]) for i in range(len(centres)) if radius.get(i)
    ]
    # A segment without spread holds equal rows only; their distance is 0.
    nearest = F.least(*normal) if len(normal) > 1 else (normal[0] if normal else F.lit(0.0))
    exact = F.when(assigned == 0, F.lit(0.0)).otherwise(nearest)
    scored = written(
        measured.select(*keep, *cols, "segment", exact.alias("normalized_distance")), "scores"
    )
    cut = nth_smallest(
        scored, "normalized_distance", math.ceil(scored.count() * (1 - contamination))
    )
    return scored.withColumn("is_anomaly", F.col("normalized_distance") > F.lit(cut))
