"""Clusters of observations: k-means sweep, quality scores, projection, profiles."""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.functions.numbers import half_even
from tideline.operators.distribution import group_profile
from tideline.operators.lloyd import Fit, fit_all
from tideline.sources.reports import load_model, save_model
from tideline.operators.stages import (
    CLUSTER, VECTOR, Axes, NearestCentre, Scale, SignedAxes, fit_scale, profile_texts,
)
from tideline.session import stable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED, RESTARTS = 42, 10
BLOCK_ROWS = 2048  # a block has no fewer rows, unless there are not so many
BLOCK_CELLS = 1 << 22  # numbers of a block: 32 MB of coordinates, or of sums
TILE = (512, 1024)  # distances held at once
SUMS = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("other", pa.int64()), ("total", pa.float64())])


def vectors(
    df: DataFrame, features: Sequence[str], fit_on: DataFrame | None = None
) -> DataFrame:
    """Add the z-scores of ``features`` as a vector; a missing number counts as 0."""
    return fit_scale(df if fit_on is None else fit_on, features).transform(df)


def _points(df: DataFrame, column: str) -> DataFrame:
    """The vectors as one array column."""
    return df.select(vector_to_array(column).alias("point"))


def _model(fit: Fit, column: str = VECTOR) -> NearestCentre:
    return NearestCentre(
        centres=json.dumps(fit.centres.tolist()), cost=fit.cost, featuresCol=column
    )


def kmeans_fit(
    df: DataFrame, k: int, restarts: int = RESTARTS, seed: int = SEED, column: str = VECTOR
) -> NearestCentre:
    """Best of several seeded starts by within-cluster sum of squares, the first one on ties."""
    return _model(fit_all(stable(_points(df, column)), [k], restarts, seed)[k], column)


def _elements(df: DataFrame, label: str, point: str | Sequence[str]) -> DataFrame:
    """Rows (label, axis, x): one per point and dimension."""
    if isinstance(point, str):
        return df.select(F.col(label).alias("label"), F.posexplode(point).alias("axis", "x"))
    cells = [
        F.struct(F.lit(i).alias("axis"), F.col(c).cast("double").alias("x"))
        for i, c in enumerate(point)
    ]
    return df.select(F.col(label).alias("label"), F.inline(F.array(*cells)))


def cluster_moments(df: DataFrame, label: str, point: str | Sequence[str]) -> DataFrame:
    """Rows (label, axis, n, mean, ss): centre and sum of squares by dimension."""
    x = F.col("x").cast("double")
    return _elements(df, label, point).groupBy("label", "axis").agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("ss")
    )


def inertia(df: DataFrame, label: str, point: str | Sequence[str], digits: int = 2) -> DataFrame:
    """Sum of squared distances to the own centre."""
    return cluster_moments(df, label, point).agg(half_even(F.sum("ss"), digits).alias("inertia"))


def calinski_harabasz(
    df: DataFrame, label: str, point: str | Sequence[str], digits: int = 2
) -> DataFrame:
    """Between-cluster over within-cluster variance."""
    axes = cluster_moments(df, label, point).groupBy("axis").agg(
        F.sum("ss").alias("within"),
        F.sum("n").alias("n"),
        F.count("*").alias("k"),
        # weighted spread of the centres: sum n*m^2 around the weighted mean
        F.collect_list(F.struct("n", "mean")).alias("centres"),  # one entry per cluster
    )
    grand = F.aggregate(
        "centres", F.lit(0.0), lambda s, c: s + c["n"] * c["mean"]
    ) / F.col("n")
    between = F.aggregate(
        "centres", F.lit(0.0),
        lambda s, c: s + c["n"] * (c["mean"] - F.col("grand")) * (c["mean"] - F.col("grand")),
    )
    sums = axes.withColumn("grand", grand).withColumn("between", between).agg(
        F.sum("between").alias("b"), F.sum("within").alias("w"),
        F.max("n").alias("n"), F.max("k").alias("k"),
    )
    score = F.try_divide(F.col("b") / (F.col("k") - 1), F.col("w") / (F.col("n") - F.col("k")))
    return sums.select(
        half_even(F.when((F.col("k") > 1) & (F.col("n") > F.col("k")), score), digits).alias(
            "calinski_harabasz"
        )
    )


def _block(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Ids, labels, points, their squares, the distinct labels and who has which."""
    label = rows.column("label").to_numpy()
    x = np.asarray(rows.column("point").combine_chunks().flatten(), np.float64).reshape(len(label), -1)
    labels, codes = np.unique(label, return_inverse=True)
    member = np.zeros((len(label), len(labels)))
    member[np.arange(len(label)), codes] = 1.0
    return rows.column("id").to_numpy(), label, x, (x * x).sum(axis=1), labels, member


def _block_sums(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Distances between the points of two blocks, or within one, summed by point and cluster."""
    same = key[0].as_py() == key[1].as_py()
    if not left.num_rows or not (same or right.num_rows):
        return SUMS.empty_table()
    id_a, label_a, x, sx, labels_a, member_a = _block(left)
    id_b, label_b, y, sy, labels_b, member_b = _block(left if same else right)
    to_a, to_b = np.zeros((len(x), len(labels_b))), np.zeros((len(y), len(labels_a)))
    for r in range(0, len(x), TILE[0]):
        for c in range(0, len(y), TILE[1]):
            i, j = slice(r, r + TILE[0]), slice(c, c + TILE[1])
            square = sx[i, None] + sy[None, j]
            least = 1e-12 * square
            square -= 2.0 * (x[i] @ y[j].T)
            # equal points: what is left of the subtraction is rounding
            square[square < least] = 0.0
            away = np.sqrt(square, out=square)
            to_a[i] += away @ member_b[j]
            if not same:
                to_b[j] += away.T @ member_a[i]
    sides = [(id_a, label_a, labels_b, to_a)] + ([] if same else [(id_b, label_b, labels_a, to_b)])
    return pa.concat_tables([
        pa.table([np.repeat(i, len(o)), np.repeat(own, len(o)), np.tile(o, len(i)), t.ravel()], schema=SUMS)
        for i, own, o, t in sides
    ])


def block_count(rows: int, dims: int, clusters: int, tasks: int) -> int:
    """Blocks as large as a task can hold two of, so that few copies of a point are moved.

    A table that fits fewer is cut into enough pairs of blocks for ``tasks``.
    """
    most = max(BLOCK_ROWS, min(BLOCK_CELLS // max(dims, 1), BLOCK_CELLS // max(clusters, 1)))
    return max(1, math.ceil(rows / most), min(math.ceil(rows / BLOCK_ROWS), math.isqrt(4 * tasks)))


def silhouette_euclidean(
    df: DataFrame, id: str, label: str, point: str, digits: int | None = 4,
    block_rows: int | None = None,
) -> DataFrame:
    """Mean silhouette with Euclidean distances, exact, cost in the square of the rows.

    Points are hashed into even blocks; each task takes one pair of blocks, each
    pair once, and returns one sum per point and cluster, never the pairs.
    Points without a label take no part.
    """
    points = df.select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(point).cast("array<double>").alias("point"),
    ).where(F.col("label").isNotNull())
    sizes = points.groupBy(F.col("label").alias("other")).agg(
        F.count("*").alias("n"), F.max(F.size("point")).alias("dims")
    )
    facts = sizes.agg(F.sum("n").alias("n"), F.max("dims").alias("dims"), F.count("*").alias("k")).first()
    n = facts.n or 0
    if block_rows is None:
        tasks = df.sparkSession.sparkContext.defaultParallelism
        blocks = block_count(n, facts.dims or 1, facts.k, tasks)
    else:
        blocks = max(1, math.ceil(n / block_rows))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    # a point meets its own block and those after it on the left, those before it on the right
    left = points.withColumn("i", block).withColumn(
        "j", F.explode(F.sequence(F.col("i"), F.lit(blocks - 1)))
    )
    right = points.withColumn("j", block).where("j > 0").withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("j") - 1))
    )
    sums = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(
        _block_sums, "id long, label long, other long, total double"
    )
    sizes = sizes.drop("dims")
    # one row per cluster
    near = (
        sums.groupBy("id", "label", "other").agg(F.sum("total").alias("total"))
        .join(F.broadcast(sizes), "other")
        .groupBy("id")
        .agg(
            F.max(F.when(F.col("other") == F.col("label"), F.col("n"))).alias("own"),
            F.max(
                F.when(
                    F.col("other") == F.col("label"), F.try_divide(F.col("total"), F.col("n") - 1)
                )
            ).alias("a"),
            F.min(F.when(F.col("other") != F.col("label"), F.col("total") / F.col("n"))).alias(
                "b"
            ),
        )
    )
    # a cluster of one point scores 0
    score = F.when(F.col("own") == 1, 0.0).otherwise(
        F.coalesce(
            F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")),
            F.when(F.col("b").isNotNull(), 0.0),
        )
    )
    out = near.agg(F.avg(score).alias("silhouette"))
    return out if digits is None else out.withColumn("silhouette", half_even("silhouette", digits))


def silhouette_squared(
    df: DataFrame, label: str, vector: str, digits: int | None = 4
) -> DataFrame:
    """Mean silhouette with squared distances, linear in the rows."""
    score = ClusteringEvaluator(
        predictionCol="_label", featuresCol=vector, distanceMeasure="squaredEuclidean"
    ).evaluate(df.withColumn("_label", F.col(label).cast("double")))
    out = df.sparkSession.createDataFrame([(float(score),)], "silhouette double")
    return out if digits is None else out.withColumn("silhouette", half_even("silhouette", digits))


@dataclass
class Sweep:
    """Scores per k, the chosen k and its model; the first of equal scores wins."""

    scores: list[dict]
    best_k: int
    model: NearestCentre

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(s["k"], s["silhouette"], s["calinski_harabasz"], s["inertia"],
              s["k"] == self.best_k) for s in self.scores],
            "k int, silhouette_score double, calinski_harabasz_score double, inertia double, "
            "is_best boolean",
        )


def kmeans_sweep(
    df: DataFrame, id: str, features: Sequence[str], k_min: int = 2, k_max: int = 7,
    restarts: int = RESTARTS, seed: int = SEED, silhouette: str = "squared",
) -> Sweep:
    """Fit each k on z-scores and choose the highest silhouette.

    All starts of all k share the scans of the table, one a round.
    Scores use squared distances, in linear time; ``silhouette="euclidean"``
    compares all pairs of rows.  A k that leaves one populated cluster has none.
    """
    if silhouette not in ("euclidean", "squared"):
        raise ValueError("silhouette is euclidean or squared")
    data = stable(vectors(df, features).select(F.col(id).alias("_id"), VECTOR))
    fits = fit_all(_points(data, VECTOR), range(k_min, k_max + 1), restarts, seed)
    scores, best, chosen = [], None, None
    for k, fit in fits.items():
        model = _model(fit)
        placed = model.transform(data).withColumn("_point", vector_to_array(VECTOR))
        if silhouette == "euclidean":
            score = silhouette_euclidean(placed, "_id", CLUSTER, "_point", None)
        else:
            score = silhouette_squared(placed, CLUSTER, VECTOR, None)
        s = score.first().silhouette
        spread = calinski_harabasz(placed, CLUSTER, "_point").first().calinski_harabasz
        scores.append(
            {"k": k, "silhouette": None if s is None else round(s, 4), "calinski_harabasz": spread,
             "inertia": round(fit.cost, 2)}
        )
        if chosen is None or (s is not None and (best is None or s > best)):
            best, chosen = s, (k, model)
    return Sweep(scores, *chosen)


@dataclass
class Projection:
    model: object
    signs: list[float]
    variance: list[float]

    def frame(self, spark: SparkSession) -> DataFrame:
        """Share of the variance that each axis explains."""
        return spark.createDataFrame(
            [(i + 1, v) for i, v in enumerate(self.variance)],
            "component int, explained_variance double",
        )

    def stages(self, digits: int | None = 3) -> list:
        return [self.model, SignedAxes(signs=self.signs, digits=-1 if digits is None else digits)]

    def apply(self, df: DataFrame, digits: int | None = 3) -> DataFrame:
        """Add ``pca_1``, ``pca_2`` and so on."""
        return PipelineModel(self.stages(digits)).transform(df)


def _covariance(df: DataFrame, column: str) -> np.ndarray:
    """Covariance of a vector column from matrix products, one row of sums a task.

    Products of some thousand rows and sums of these keep all but the last digits;
    row after row the error grows with the rows, and axes of almost equal variance turn with it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, 0.0, 0.0
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(0).flatten(), np.float64).reshape(batch.num_rows, -1)
                n, total, square = n + len(x), total + x.sum(axis=0), square + x.T @ x
        if n:
            sums = pa.array([[float(n), *total, *square.ravel()]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([sums], ["sums"])

    parts = df.select(vector_to_array(column).alias("point")).mapInArrow(run, "sums array<double>")
    sums = [math.fsum(cells) for cells in zip(*[r.sums for r in parts.collect()])]
    dims = math.isqrt(len(sums) - 1)  # after the count there are dims * (dims + 1) sums
    n, mean = sums[0], np.array(sums[1 : 1 + dims]) / sums[0]
    square = np.array(sums[1 + dims :]).reshape(dims, dims)
    return (square - n * np.outer(mean, mean)) / max(n - 1, 1)


def pca_project(df: DataFrame, k: int = 2, column: str = VECTOR) -> Projection:
    """Principal axes of a centred vector column; the largest loading of each is positive."""
    sizes, axes = np.linalg.eigh(_covariance(df, column))
    sizes, axes = np.maximum(sizes[::-1], 0.0), axes[:, ::-1][:, :k]
    signs = [1.0 if axes[np.abs(axes[:, i]).argmax(), i] >= 0 else -1.0 for i in range(k)]
    shares = sizes[:k] / (sizes.sum() or 1.0)
    model = Axes(axes=json.dumps(axes.T.tolist()), inputCol=column)
    return Projection(model, signs, [round(float(v), 4) for v in shares])


def cluster_profiles(df: DataFrame, cluster: str = CLUSTER, **columns: str) -> DataFrame:
    return group_profile(df, cluster, **columns)


def cluster_points(
    placed: DataFrame, profiles: DataFrame, projection: Projection, order: Sequence[str],
    keep: Sequence[str], n: int | None = 200,
) -> DataFrame:
    """Points with coordinates and the label of their cluster; ``n`` for a scatter plot."""
    points = projection.apply(placed)
    if n is not None:
        points = points.orderBy(*order).limit(n)
    # one profile per cluster
    labels = profiles.select(CLUSTER, F.col("label").alias("cluster_name"))
    return points.join(F.broadcast(labels), CLUSTER, "left").select(
        *keep, "pca_1", "pca_2", CLUSTER, "cluster_name"
    )


def cluster_pipeline(
    scale: Scale, model: NearestCentre, profiles: DataFrame, projection: Projection | None = None
) -> PipelineModel:
    """Scaling, nearest centre, coordinates and profile texts as one model."""
    axes = [] if projection is None else projection.stages()
    return PipelineModel([scale, model, *axes, profile_texts(profiles)])


def assign_cluster(
    contexts: DataFrame, features: Sequence[str], fit_on: DataFrame, model: NearestCentre,
    profiles: DataFrame, projection: Projection | None = None,
) -> DataFrame:
    """Cluster, profile texts and coordinates of new rows, scaled like ``fit_on``."""
    pipeline = cluster_pipeline(fit_scale(fit_on, features), model, profiles, projection)
    return pipeline.transform(contexts).drop(VECTOR)


@dataclass
class ClusterSuite:
    """What clustering learned: the pipeline that places new rows, and the facts about it."""

    pipeline: PipelineModel
    scores: list[dict]
    best_k: int
    variance: list[float]

    def assign(self, contexts: DataFrame) -> DataFrame:
        """Cluster, profile texts and coordinates of new rows."""
        return self.pipeline.transform(contexts).drop(VECTOR)


def save_clusters(spark: SparkSession, suite: ClusterSuite, path: str) -> str:
    """One folder for the pipeline and one for the facts."""
    save_model(suite.pipeline, f"{path}/pipeline")
    about = {"scores": suite.scores, "best_k": suite.best_k, "variance": suite.variance}
    text = spark.createDataFrame([(json.dumps(about),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/about")
    return path


def load_clusters(spark: SparkSession, path: str) -> ClusterSuite:
    about = json.loads(spark.read.text(f"{path}/about", wholetext=True).first().value)
    return ClusterSuite(load_model(f"{path}/pipeline"), **about)


def nearest_centre(
    df: DataFrame, features: Sequence[str], centres: Mapping[int, Sequence[float]]
) -> DataFrame:
    """Index of and distance to the nearest of the given centres; the lowest index on ties."""
    cells = []
    for name, centre in sorted(centres.items()):
        square = F.lit(0.0)
        for c, m in zip(features, centre):
            gap = F.col(c).cast("double") - F.lit(float(m))
            square = square + gap * gap
        cells.append(F.struct(square.alias("d"), F.lit(name).alias("c")))
    best = F.array_min(F.array(*cells))
    return df.withColumn("_best", best).withColumns(
        {CLUSTER: F.col("_best.c"), "distance": F.sqrt("_best.d")}
    ).drop("_best")
