"""Pipeline stages for clusters that can be saved: scaling, nearest centre, axis signs, profile texts.

Each keeps what it learned in its parameters, so that a ``PipelineModel`` of them
is written and read like any other.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from tideline import presets as P
from tideline.functions.numbers import half_even

VECTOR, CLUSTER, AXES = "_vector", "cluster", "_pca"


def _param(name: str, doc: str, convert) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=convert)


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def _take(self, **given) -> None:
        self._set(**{k: v for k, v in given.items() if v is not None})

    def of(self, param: Param):
        return self.getOrDefault(param)


class Scale(_Stage):
    """z-scores as a vector; a missing number or column counts as 0."""

    features = _param("features", "input columns", TypeConverters.toListString)
    means = _param("means", "their means", TypeConverters.toListFloat)
    scales = _param("scales", "their deviations", TypeConverters.toListFloat)
    outputCol = _param("outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, features=None, means=None, scales=None, outputCol=VECTOR):
        super().__init__()
        self._take(**self._input_kwargs)
        self._setDefault(outputCol=VECTOR)

    def _transform(self, df: DataFrame) -> DataFrame:
        cells = []
        for name, mean, scale in zip(self.of(self.features), self.of(self.means), self.of(self.scales)):
            x = F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)
            cells.append((x - F.lit(mean)) / F.lit(scale))
        return df.withColumn(self.of(self.outputCol), array_to_vector(F.array(*cells)))


def fit_scale(df: DataFrame, features: Sequence[str], column: str = VECTOR) -> Scale:
    """Means and population deviations from one pass; a constant column is only centred."""
    aggs = []
    for i, name in enumerate(features):
        x = F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)
        aggs += [F.avg(x).alias(f"m{i}"), F.when(F.min(x) < F.max(x), F.stddev_pop(x)).alias(f"s{i}")]
    facts = df.agg(*aggs).first()
    n = range(len(features))
    return Scale(
        features=list(features), means=[facts[f"m{i}"] or 0.0 for i in n],
        scales=[facts[f"s{i}"] or 1.0 for i in n], outputCol=column,
    )


class NearestCentre(_Stage):
    """Index of the nearest centre by Euclidean distance, the lowest on ties."""

    centres = _param("centres", "JSON list of centres", TypeConverters.toString)
    cost = _param("cost", "sum of squared distances at the fit", TypeConverters.toFloat)
    featuresCol = _param("featuresCol", "vector column", TypeConverters.toString)
    predictionCol = _param("predictionCol", "index column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, centres=None, cost=None, featuresCol=VECTOR, predictionCol=CLUSTER):
        super().__init__()
        self._take(**self._input_kwargs)
        self._setDefault(featuresCol=VECTOR, predictionCol=CLUSTER)

    def clusterCenters(self) -> list[list[float]]:
        return json.loads(self.of(self.centres))

    def _transform(self, df: DataFrame) -> DataFrame:
        point = vector_to_array(F.col(self.of(self.featuresCol)))
        best = []
        for i, centre in enumerate(self.clusterCenters()):
            square = F.lit(0.0)
            for axis, m in enumerate(centre):
                gap = F.get(F.col("_point"), F.lit(axis)) - F.lit(float(m))
                square = square + gap * gap
            best.append(F.struct(square.alias("d"), F.lit(i).alias("c")))
        return df.withColumn("_point", point).withColumn(
            self.of(self.predictionCol), F.array_min(F.array(*best))["c"]
        ).drop("_point")


class Axes(_Stage):
    """Coordinates of a vector on given axes."""

    axes = _param("axes", "JSON list of axes", TypeConverters.toString)
    inputCol = _param("inputCol", "vector column", TypeConverters.toString)
    outputCol = _param("outputCol", "projected vector", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, axes=None, inputCol=VECTOR, outputCol=AXES):
        super().__init__()
        self._setDefault(inputCol=VECTOR, outputCol=AXES)
        self._take(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumn("_point", vector_to_array(F.col(self.of(self.inputCol))))
        cells = []
        for axis in json.loads(self.of(self.axes)):
            x = F.lit(0.0)
            for i, share in enumerate(axis):
                x = x + F.get(F.col("_point"), F.lit(i)) * F.lit(float(share))
            cells.append(x)
        return out.withColumn(self.of(self.outputCol), array_to_vector(F.array(*cells))).drop("_point")


class SignedAxes(_Stage):
    """``pca_1``, ``pca_2`` and so on from projected coordinates, with the sign of each axis."""

    signs = _param("signs", "1 or -1 per axis", TypeConverters.toListFloat)
    digits = _param("digits", "decimals, -1 for all", TypeConverters.toInt)
    inputCol = _param("inputCol", "projected vector", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, signs=None, digits=3, inputCol=AXES):
        super().__init__()
        self._setDefault(digits=3, inputCol=AXES)
        self._take(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        source, digits = self.of(self.inputCol), self.of(self.digits)
        out = df.withColumn(source, vector_to_array(source))
        for i, sign in enumerate(self.of(self.signs)):
            value = F.get(source, F.lit(i)) * sign
            out = out.withColumn(f"pca_{i + 1}", value if digits < 0 else half_even(value, digits))
        return out.drop(source)


class ProfileTexts(_Stage):
    """Label, description and advice of the row's cluster; the unknown persona where it has none."""

    texts = _param("texts", "JSON object: index to the three texts", TypeConverters.toString)
    clusterCol = _param("clusterCol", "index column", TypeConverters.toString)

    NAMES = ("label", "description", "recommended_action")

    @keyword_only
    def __init__(self, *, texts=None, clusterCol=CLUSTER):
        super().__init__()
        self._setDefault(clusterCol=CLUSTER)
        self._take(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        known = json.loads(self.of(self.texts))
        cluster, out = F.col(self.of(self.clusterCol)).cast("int"), {}
        for part, (name, missing) in enumerate(zip(self.NAMES, (P.UNKNOWN_PERSONA, "", ""))):
            # one text per cluster
            told = [F.when(cluster == int(k), F.lit(v[part])) for k, v in known.items()]
            out[name] = F.coalesce(*told, F.lit(missing))
        return df.withColumns(out)


def profile_texts(profiles: DataFrame, cluster: str = CLUSTER) -> ProfileTexts:
    """``profiles`` has one row per cluster."""
    rows = profiles.select(F.col(cluster).alias("c"), *ProfileTexts.NAMES).collect()
    texts = {str(r["c"]): [r[n] for n in ProfileTexts.NAMES] for r in rows if r["c"] is not None}
    return ProfileTexts(texts=json.dumps(texts), clusterCol=cluster)
