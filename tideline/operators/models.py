"""Training, comparing and applying demand models with Spark ML."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline import presets as P
from tideline.functions.numbers import clip, half_even
from tideline.operators.evaluation import (
    class_weights, classification_metrics, label_index, regression_metrics,
)
from tideline.operators.trees import Bins, HistogramTrees
from tideline.session import ensure_checkpoint_dir, side_by_side
from tideline.sources.reports import load_model, save_model

RAW, SCALED, TARGET, INDEX, WEIGHT = "_raw", "_scaled", "_target", "_class", "_weight"
SEED = 42


@dataclass(frozen=True)
class Candidate:
    """A model to try; ``build(spec)`` returns its estimator."""

    name: str
    build: Callable[["TrainSize"], Estimator]
    scaled: bool = False
    weighted: bool = False


@dataclass(frozen=True)
class TrainSize:
    rows: int
    trees: int = 100
    rounds: int = 100


def fit_linear(size: TrainSize) -> Estimator:
    return LinearRegression(regParam=0.0)


def fit_forest_reg(size: TrainSize) -> Estimator:
    return HistogramTrees(trees=size.trees, maxDepth=10, seed=SEED)


def fit_gbt_reg(size: TrainSize) -> Estimator:
    return HistogramTrees(boosted=True, trees=size.rounds, stepSize=0.08, maxDepth=4, seed=SEED)


def fit_logistic(size: TrainSize, c: float = 1.0) -> Estimator:
    """L2 with strength 1/C over the summed loss.

    Spark's loss is a mean and its scaler uses the sample deviation; both are
    made up for in the penalty.
    """
    n = max(2, size.rows)
    return LogisticRegression(
        regParam=(n - 1) / (c * n * n), elasticNetParam=0.0, standardization=False, maxIter=1000
    )


def fit_forest_clf(size: TrainSize) -> Estimator:
    return HistogramTrees(classify=True, trees=size.trees, maxDepth=8, subset=True, seed=SEED)


def fit_gbt_clf(size: TrainSize) -> Estimator:
    return HistogramTrees(
        classify=True, boosted=True, trees=size.rounds, stepSize=0.08, maxDepth=3, seed=SEED
    )


# --- Fixed values: candidate names, in the order that settles ties ---
REGRESSORS = [
    Candidate("Linear Regression", fit_linear, scaled=True),
    Candidate("Random Forest Regressor", fit_forest_reg),
    Candidate("Gradient Boosting Regressor", fit_gbt_reg),
]
CLASSIFIERS = [
    Candidate("Logistic Regression", fit_logistic, scaled=True),
    Candidate("Random Forest Classifier", fit_forest_clf, weighted=True),
    Candidate("Gradient Boosting Classifier", fit_gbt_clf),
]
FOREST_CLASSIFIER = "Random Forest Classifier"


@dataclass(frozen=True)
class SuiteSpec:
    """What a suite predicts, from what, and within which limits."""

    name: str
    features: Sequence[str]
    target: str
    label: str | None = None
    limits: tuple[float, float] = (0, 300)
    floor: float = 0.0
    average: str = "binary"
    regressors: Sequence[Candidate] = tuple(REGRESSORS)
    classifiers: Sequence[Candidate] = tuple(CLASSIFIERS[:2])
    extra_classes: Sequence = ()
    trees: int = 100
    rounds: int = 100


SPORTS_SUITE = SuiteSpec(
    "sports", P.SPORTS_FEATURES, "sports_visitor_count", "sports_overcrowded_flag", (0, 300),
    0.0, classifiers=tuple(CLASSIFIERS),
)
FOOD_SUITE = SuiteSpec(
    "food", P.FOOD_FEATURES, "food_orders_demand", "food_risk_category", (10, 500), 10.0,
    average="weighted", extra_classes=(P.SHORTAGE, P.BALANCED),
)
LIBRARY_SUITE = SuiteSpec(
    "library", P.LIBRARY_FEATURES, "library_occupancy", "library_high_demand_flag", (10, 360),
    10.0,
)


@dataclass
class FittedSuite:
    spec: SuiteSpec
    prep: list[Transformer]
    models: dict[str, Model] = field(default_factory=dict)
    best_regressor: str | None = None
    best_classifier: str | None = None
    classes: list = field(default_factory=list)
    constant_class: object = None
    report: list[dict] = field(default_factory=list)

    @property
    def degenerate(self) -> bool:
        return bool(self.spec.label) and not any(
            c.name in self.models for c in self.spec.classifiers
        )

    def pipeline(self, name: str) -> PipelineModel:
        return PipelineModel(stages=[*self.prep, self.models[name]])

    def report_frame(self, spark: SparkSession) -> DataFrame:
        """Rows per candidate and metric set, the best ones marked."""
        return model_report(spark, [self])

    def predict_with(self, candidate: str, df: DataFrame) -> DataFrame:
        """Raw predictions of one candidate, classes as their index, with all of ``df``."""
        rows = _prepared(df, self.spec)
        for stage in self.prep:
            rows = stage.transform(rows)
        out = self.models[candidate].transform(rows)
        return out.select(*df.columns, "prediction")

    def predict(self, contexts: DataFrame) -> DataFrame:
        """Best predictions for a table of contexts.

        A feature the table lacks, or a NULL, counts as 0.  Adds
        ``predicted_value`` (floored, 1 digit), and with a classifier
        ``predicted_class`` and, for two classes, ``probability`` (3 digits).
        """
        spec = self.spec
        filled = {}
        for c in spec.features:
            if c in contexts.columns:
                filled[f"_f_{c}"] = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            else:
                filled[f"_f_{c}"] = F.lit(0.0)
        rows = contexts.withColumns(filled)
        for stage in self.prep:
            rows = stage.transform(rows)
        model = self.models[self.best_regressor].copy()
        model.setPredictionCol("_value")
        rows = model.transform(rows)
        value = clip(half_even("_value", 1), spec.floor, None)
        out = {"predicted_value": value}
        drop = ["_value", *filled, RAW, SCALED]
        if spec.label and self.degenerate:
            out["predicted_class"] = F.lit(self.constant_class)
            out["probability"] = F.lit(None).cast("double")
        elif spec.label:
            clf = self.models[self.best_classifier].copy()
            clf.setPredictionCol("_index").setProbabilityCol("_probs")
            clf.setRawPredictionCol("_margin")
            rows = clf.transform(rows)
            names = F.array(*[F.lit(c) for c in self.classes])
            out["predicted_class"] = F.get(names, F.col("_index").cast("int"))
            second = F.get(vector_to_array("_probs"), F.lit(1))
            out["probability"] = half_even(
                second if len(self.classes) == 2 else F.lit(None).cast("double"), 3
            )
            drop += ["_index", "_probs", "_margin"]
        return rows.withColumns(out).drop(*drop)


def _prepared(df: DataFrame, spec: SuiteSpec) -> DataFrame:
    return df.withColumns({f"_f_{c}": F.col(c).cast("double") for c in spec.features})


def _known(spec: SuiteSpec, others: Sequence[FittedSuite]) -> dict[str, Model]:
    """Models of regressors that other suites fitted on the same features and target."""
    found = {}
    for o in others:
        same = lambda s: (list(s.features), s.target, s.trees, s.rounds)
        if same(o.spec) == same(spec):
            theirs = [c for c in o.spec.regressors if c.name in o.models]
            found.update({c.name: o.models[c.name] for c in theirs if c in tuple(spec.regressors)})
    return found


def _bin_once(ready: DataFrame, estimators: Sequence[Estimator]) -> None:
    """Ensembles share their binned rows; those for a label that rows lack bin the others."""
    trees = [e for e in estimators if isinstance(e, HistogramTrees)]
    if len(trees) < 2:
        return
    labels = sorted({e.getLabelCol() for e in trees})
    weights = [e.getWeightCol() for e in trees if e.isSet(e.weightCol)]
    lacking = ready.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in labels]).first()
    whole = [c for c in labels if not lacking[c]]
    if whole:
        bins = Bins.of(ready, RAW, whole, weights[0] if weights else None)
        for e in trees:
            e.bins = bins


def train_suite(
    train: DataFrame, test: DataFrame, spec: SuiteSpec, others: Sequence[FittedSuite] = ()
) -> FittedSuite:
    """Fit every candidate on ``train``, compare on ``test``, keep the best of each kind.

    Only metrics and models reach the driver.  The training part is kept in
    memory and on disk for the time of the fits, as every tree level reads it.
    Regressors that ``others``, suites of the same ``train``, fitted to the same
    features and target are the same models and not fitted again.
    """
    ensure_checkpoint_dir(train.sparkSession)
    inputs = [f"_f_{c}" for c in spec.features]
    assembler = VectorAssembler(inputCols=inputs, outputCol=RAW)
    columns = [F.col(spec.target).cast("double").alias(TARGET)]
    if spec.label:
        columns.append(F.col(spec.label))
    ready = assembler.transform(_prepared(train, spec)).select(RAW, *columns)
    scaler = StandardScaler(inputCol=RAW, outputCol=SCALED, withMean=True, withStd=True).fit(ready)
    fitted = FittedSuite(spec, [assembler, scaler])

    ready = scaler.transform(ready)
    if spec.label:
        indexed = label_index(train, test, spec.label, spec.extra_classes)
        indexed = indexed.orderBy("label_index").collect()
        fitted.classes = [r[spec.label] for r in indexed]
        ready = ready.withColumn(INDEX, _class_index(spec.label, fitted.classes))
        weights = {r[spec.label]: r.weight for r in class_weights(train, spec.label).collect()}
        pairs = [F.when(F.col(spec.label) == k, F.lit(w)) for k, w in weights.items()]
        ready = ready.withColumn(WEIGHT, F.coalesce(*pairs, F.lit(1.0)))
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = TrainSize(ready.count(), spec.trees, spec.rounds)
        wanted = [(c, TARGET) for c in spec.regressors]
        if spec.label and len(weights) < 2:
            fitted.constant_class = next(iter(weights), None)
        elif spec.label:
            wanted += [(c, INDEX) for c in spec.classifiers]
        known, estimators = _known(spec, others), []
        missing = [(c, label) for c, label in wanted if label != TARGET or c.name not in known]
        for c, label in missing:
            estimator = c.build(size).setFeaturesCol(SCALED if c.scaled else RAW)
            if c.weighted:
                estimator = estimator.setWeightCol(WEIGHT)
            estimators.append(estimator.setLabelCol(label))
        _bin_once(ready, estimators)
        models = side_by_side(
            train.sparkSession, [lambda e=e: e.fit(ready) for e in estimators]
        )
        new = {c.name: m for (c, _), m in zip(missing, models)}
        fitted.models = {c.name: new[c.name] if c.name in new else known[c.name] for c, _ in wanted}
    finally:
        ready.unpersist()

    tested = assembler.transform(_prepared(test, spec)).select(RAW, *columns)
    _compare(fitted, scaler.transform(tested))
    return fitted


def _class_index(label: str, classes: Sequence) -> Column:
    position = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label))
    return (position - 1).cast("double")


def _compare(fitted: FittedSuite, test: DataFrame) -> None:
    """Metrics of all candidates from one pass over the test part each kind."""
    spec = fitted.spec
    if spec.regressors:
        _compare_numbers(fitted, test)
    if spec.label:
        _compare_classes(fitted, test)


def _compare_numbers(fitted: FittedSuite, test: DataFrame) -> None:
    spec, scored = fitted.spec, test
    for i, c in enumerate(spec.regressors):
        model = fitted.models[c.name].copy()
        scored = model.setPredictionCol(f"_p{i}").transform(scored)
    cells = [
        F.struct(
            F.lit(i).alias("ord"), F.col(TARGET).alias("label"),
            clip(f"_p{i}", *[float(x) for x in spec.limits]).alias("prediction"),
        )
        for i in range(len(spec.regressors))
    ]
    rows = scored.select(F.inline(F.array(*cells)))
    best = None
    for r in regression_metrics(rows, by=["ord"]).orderBy("ord").collect():
        name = spec.regressors[r.ord].name
        fitted.report.append(
            {"suite": spec.name, "kind": "regression", "candidate": name, "ord": r.ord,
             "mae": r.mae, "rmse": r.rmse, "r2": r.r2}
        )
        if best is None or (r.r2 is not None and r.r2 > best):
            best, fitted.best_regressor = (r.r2 if r.r2 is not None else float("-inf")), name


def _compare_classes(fitted: FittedSuite, test: DataFrame) -> None:
    spec = fitted.spec
    if fitted.degenerate:
        n = test.count()
        for i, c in enumerate(spec.classifiers):
            fitted.report.append(
                {"suite": spec.name, "kind": "classification", "candidate": c.name, "ord": i,
                 "accuracy": 1.0, "precision": 1.0, "recall": 1.0, "f1": 1.0,
                 "degenerate": True, "confusion": json.dumps([[n]])}
            )
        names = [c.name for c in spec.classifiers]
        fitted.best_classifier = FOREST_CLASSIFIER if FOREST_CLASSIFIER in names else names[0]
        return
    scored = test.withColumn("_y", _class_index(spec.label, fitted.classes))
    for i, c in enumerate(spec.classifiers):
        model = fitted.models[c.name].copy()
        model.setPredictionCol(f"_p{i}").setProbabilityCol(f"_q{i}").setRawPredictionCol(f"_m{i}")
        scored = model.transform(scored).drop(f"_q{i}", f"_m{i}")
    cells = [
        F.struct(
            F.lit(i).alias("ord"), F.col("_y").cast("int").alias("label"),
            F.col(f"_p{i}").cast("int").alias("prediction"),
        )
        for i in range(len(spec.classifiers))
    ]
    pairs = scored.select(F.inline(F.array(*cells))).persist(StorageLevel.MEMORY_AND_DISK)
    positive = fitted.classes.index(1) if 1 in fitted.classes else len(fitted.classes) - 1
    metrics = classification_metrics(
        pairs, by=["ord"], average=spec.average, positive=positive
    ).orderBy("ord").collect()
    counts = pairs.groupBy("ord", "label", "prediction").count().collect()
    pairs.unpersist()
    best = -1.0
    for r in metrics:
        name = spec.classifiers[r.ord].name
        cells = {(x.label, x.prediction): x["count"] for x in counts if x.ord == r.ord}
        seen = sorted({i for pair in cells for i in pair if i is not None})
        table = [[cells.get((a, b), 0) for b in seen] for a in seen]
        fitted.report.append(
            {"suite": spec.name, "kind": "classification", "candidate": name, "ord": r.ord,
             "accuracy": r.accuracy, "precision": r.precision, "recall": r.recall, "f1": r.f1,
             "degenerate": False, "confusion": json.dumps(table)}
        )
        if r.f1 > best:
            best, fitted.best_classifier = r.f1, name


REPORT_SCHEMA = (
    "suite string, kind string, candidate string, ord int, mae double, rmse double, r2 double, "
    "accuracy double, precision double, recall double, f1 double, degenerate boolean, "
    "confusion string, is_best boolean"
)


def model_report(spark: SparkSession, suites: Sequence[FittedSuite]) -> DataFrame:
    """One row per suite and candidate, with metrics and the best marked."""
    rows = []
    for s in suites:
        for r in s.report:
            best = s.best_regressor if r["kind"] == "regression" else s.best_classifier
            rows.append({**r, "is_best": r["candidate"] == best})
    names = [c.split()[0] for c in REPORT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], REPORT_SCHEMA)


def feature_importance(
    spark: SparkSession, fitted: FittedSuite, candidate: str, digits: int = 4
) -> DataFrame:
    """Rows (feature, importance), sorted; impurity shares of trees, weights of linear models."""
    model = fitted.models[candidate]
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif getattr(model, "numClasses", 2) > 2:
        values = model.coefficientMatrix.toArray()[0]
    else:
        values = model.coefficients.toArray()
    rows = [(f, float(v)) for f, v in zip(fitted.spec.features, values)]
    out = spark.createDataFrame(rows, "feature string, importance double")
    return out.withColumn("importance", half_even("importance", digits)).orderBy(
        F.desc("importance"), "feature"
    )


def all_importances(
    spark: SparkSession, suites: Sequence[FittedSuite], digits: int = 4
) -> DataFrame:
    """Rows (suite, candidate, feature, importance) of every fitted model of the suites."""
    parts = [
        feature_importance(spark, s, name, digits).select(
            F.lit(s.spec.name).alias("suite"), F.lit(name).alias("candidate"),
            "feature", "importance",
        )
        for s in suites for name in s.models
    ]
    return reduce(DataFrame.unionByName, parts)


def save_suite(spark: SparkSession, fitted: FittedSuite, path: str) -> str:
    """One folder per model and a description."""
    names = list(fitted.models)
    for i, name in enumerate(names):
        save_model(fitted.pipeline(name), f"{path}/model={i}")
    about = {
        "models": names, "best_regressor": fitted.best_regressor,
        "best_classifier": fitted.best_classifier, "classes": fitted.classes,
        "constant_class": fitted.constant_class, "report": fitted.report,
    }
    text = spark.createDataFrame([(json.dumps(about),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/about")
    return path


def load_suite(spark: SparkSession, spec: SuiteSpec, path: str) -> FittedSuite:
    about = json.loads(spark.read.text(f"{path}/about", wholetext=True).first().value)
    fitted = FittedSuite(spec, [])
    for i, name in enumerate(about.pop("models")):
        *fitted.prep, fitted.models[name] = load_model(f"{path}/model={i}").stages
    for key, value in about.items():
        setattr(fitted, key, value)
    return fitted
