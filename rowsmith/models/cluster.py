"""Clustering and cluster profiles."""

from __future__ import annotations

import numpy as np

from pyspark.ml.clustering import KMeans
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.operators.ordered import elbow
from rowsmith.operators.stats import group_median
from rowsmith.session import side_by_side


def kmeans(k: int, seed: int = 42, features: str = "features", prediction: str = "cluster") -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol=prediction)


def nearest_centre(vector: Column, centres: list[list[float]]) -> Column:
    """Index of the closest centre, as column arithmetic (first one on a tie)."""

    def squared(centre):
        gaps = F.zip_with(vector, F.array(*[F.lit(float(v)) for v in centre]), lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g)

    dist = F.array(*[squared(c) for c in centres])
    return (F.array_position(dist, F.array_min(dist)) - 1).cast("int")


def elbow_scan(df: DataFrame, ks=range(2, 10), seed: int = 42, features: str = "features") -> DataFrame:
    """Sum of squared distances to the centre for every number of clusters."""
    rows = df.select(features).persist()
    try:
        tasks = [lambda k=k: (k, float(kmeans(k, seed, features).fit(rows).summary.trainingCost)) for k in ks]
        cost = side_by_side(df.sparkSession, tasks)
    finally:
        rows.unpersist()
    return df.sparkSession.createDataFrame(cost, "k int, cost double")


def best_k(scan: DataFrame) -> int | None:
    return elbow(scan, "k", "cost").first()["elbow"]


def cluster_profile(df: DataFrame, cluster: str, cols) -> DataFrame:
    """Median of every column and the number of rows per cluster."""
    sizes = df.groupBy(cluster).agg(F.count("*").alias("size"))
    return group_median(df, [cluster], cols).join(sizes, cluster)


class WardTree:
    """Hierarchical clustering of a table of any size through micro-clusters.

    k-means first reduces the rows to at most ``micro`` weighted centres; Ward
    merges then run on that bounded list. ``linkage`` is the merge table.
    """

    def __init__(self, micro: int = 200, seed: int = 42, features: str = "features"):
        self.micro, self.seed, self.features = micro, seed, features

    def fit(self, df: DataFrame) -> "WardTree":
        model = kmeans(self.micro, self.seed, self.features, "__micro").fit(df)
        sizes = {r["__micro"]: r["count"] for r in model.transform(df).groupBy("__micro").count().collect()}
        self.model = model
        self.ids = sorted(sizes)
        centres = np.array([model.clusterCenters()[i] for i in self.ids])
        weights = np.array([float(sizes[i]) for i in self.ids])
        self.merges = _ward_merges(centres, weights)
        return self

    def linkage(self, spark) -> DataFrame:
        """(step, left, right, distance, size); leaves are numbered from 0, merges follow."""
        rows = [(i, *m) for i, m in enumerate(self.merges)]
        return spark.createDataFrame(rows, "step int, left int, right int, distance double, size bigint")

    def labels(self, k: int) -> list[int]:
        """Cluster of every leaf when the tree is cut into ``k`` parts."""
        n = len(self.ids)
        group = {i: [i] for i in range(n)}
        for step, (a, b, _, _) in enumerate(self.merges[: max(n - k, 0)]):
            group[n + step] = group.pop(a) + group.pop(b)
        label = [0] * n
        for c, (_, leaves) in enumerate(sorted(group.items(), key=lambda g: min(g[1]))):
            for leaf in leaves:
                label[leaf] = c
        return label

    def assign(self, df: DataFrame, k: int, out: str = "cluster") -> DataFrame:
        place = dict(zip(self.ids, self.labels(k)))
        spot = F.get(F.array(*[F.lit(place.get(i, -1)) for i in range(max(place) + 1)]), F.col("__micro"))
        return self.model.transform(df).withColumn(out, spot).drop("__micro")


def _ward_merges(centres: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, float, int]]:
    """Greedy merges by the smallest growth of within-cluster spread (bounded input)."""
    n = len(centres)
    centre, weight, name = centres.astype(float).copy(), weights.astype(float).copy(), list(range(n))
    gap = ((centre[:, None, :] - centre[None, :, :]) ** 2).sum(axis=2)
    cost = 2 * np.outer(weight, weight) / np.add.outer(weight, weight) * gap
    np.fill_diagonal(cost, np.inf)
    merges = []
    for step in range(n - 1):
        i, j = sorted(np.unravel_index(np.argmin(cost), cost.shape))
        a, b = sorted((name[i], name[j]))
        merges.append((int(a), int(b), float(np.sqrt(cost[i, j])), int(weight[i] + weight[j])))
        centre[i] = (weight[i] * centre[i] + weight[j] * centre[j]) / (weight[i] + weight[j])
        weight[i] += weight[j]
        name[i] = n + step
        cost[j, :] = cost[:, j] = np.inf
        live = np.isfinite(cost).any(axis=1) | (np.arange(n) == i)
        live[j] = False
        d = ((centre - centre[i]) ** 2).sum(axis=1)
        row = np.where(live, 2 * weight * weight[i] / (weight + weight[i]) * d, np.inf)
        row[i] = np.inf
        cost[i, :] = cost[:, i] = row
    return merges
