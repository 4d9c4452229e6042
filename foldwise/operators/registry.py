"""Named model candidates: a classifier and a regressor factory each. Nothing is evaluated from text."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import InheritableThread
from pyspark.ml import Estimator, Model
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.boosting import FEATURES, LABEL, PREDICTION, Boosted, Settings
SEED = 42
RAW = "ridge_scores"
#: The most features that MLlib's normal equations take.
NORMAL_FEATURES = 4096
#: Driver threads that submit the fits of one model's classes.
CLASS_THREADS = 8


def in_parallel(tasks: Sequence[Callable], parallelism: int) -> list:
    """Run driver-side fits side by side; a few threads submit jobs, executors do the work."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(lambda t: _inherited(t), tasks))


def _inherited(task: Callable):
    box: list = []

    def run():
        try:
            box.append((True, task()))
        except Exception as e:
            box.append((False, e))

    thread = InheritableThread(target=run)
    thread.start()
    thread.join()
    done, value = box[0]
    if not done:
        raise value
    return value


def vector_width(df: DataFrame) -> int:
    """Length of the feature vectors: from the column's metadata, else from the first row."""
    known = df.schema[FEATURES].metadata.get("ml_attr", {}).get("num_attrs")
    if known:
        return known
    row = df.select(F.size(vector_to_array(FEATURES))).first()
    return row[0] if row else 0


class Ridge(Estimator):
    """Least squares with penalty ``alpha * |w|^2`` on unscaled features.

    MLlib divides its penalty by the row count and by the label's standard deviation, so the
    parameter is derived from both; its normal equations need one pass over the rows. They
    hold a square of the features on the driver, so vectors above ``widest`` are fitted by
    iterations instead, where MLlib takes the sample's standard deviation.
    """

    def __init__(
        self, alpha: float = 1.0, label: str = LABEL, prediction: str = PREDICTION, widest: int = NORMAL_FEATURES
    ):
        super().__init__()
        self.alpha, self.label, self.prediction, self.widest = float(alpha), label, prediction, widest

    def _fit(self, df: DataFrame):
        narrow = vector_width(df) <= self.widest
        spread = F.stddev_pop(self.label) if narrow else F.stddev_samp(self.label)
        n, spread = df.agg(F.count(self.label), spread).first()
        return R.LinearRegression(
            featuresCol=FEATURES, labelCol=self.label, predictionCol=self.prediction,
            solver="normal" if narrow else "l-bfgs", elasticNetParam=0.0, standardization=False,
            regParam=self.alpha * (spread or 0.0) / max(n, 1),
        ).fit(df)


class RidgeClassifier(Estimator):
    """Ridge on a +1/-1 target per class; the class with the largest score wins."""

    def __init__(self, alpha: float = 1.0, classes: int = 2):
        super().__init__()
        self.alpha, self.classes = alpha, classes

    def _fit(self, df: DataFrame) -> RidgeClassifierModel:
        def fit(i: int):
            signed = df.withColumn("_sign", F.when(F.col(LABEL) == i, 1.0).otherwise(-1.0))
            return Ridge(self.alpha, "_sign", f"_score_{i}").fit(signed)

        classes = [1] if self.classes <= 2 else range(self.classes)
        models = in_parallel([lambda i=i: fit(i) for i in classes], CLASS_THREADS)
        return RidgeClassifierModel(models, self.classes)


class RidgeClassifierModel(Model):
    """Adds the array ``ridge_scores`` (one score per class) and the predicted class."""

    def __init__(self, models, classes: int):
        super().__init__()
        self.models, self.classes = models, classes

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [m.getPredictionCol() for m in self.models]
        for m in self.models:
            df = m.transform(df)
        if self.classes <= 2:
            scores = F.array(-F.col(names[0]), F.col(names[0]))
            # A score of exactly 0 is the negative class.
            best = F.when(F.col(names[0]) > 0, 1.0).otherwise(0.0)
        else:
            scores = F.array(*names)
            best = (F.array_position(F.array(*names), F.greatest(*names)) - 1).cast("double")
        return df.withColumns({RAW: scores, PREDICTION: best}).drop(*names)


@dataclass(frozen=True)
class Candidate:
    """``classifier(classes, **params)`` and ``regressor(**params)``."""

    classifier: Callable[..., Estimator] | None
    regressor: Callable[..., Estimator] | None

    def build(self, task: str, classes: int = 2, **params) -> Estimator:
        make = self.classifier if task == "classification" else self.regressor
        if make is None:
            raise ValueError(f"no {task} form")
        return make(classes, **params) if task == "classification" else make(**params)


def _cols(**params):
    return {"featuresCol": FEATURES, "labelCol": LABEL, "predictionCol": PREDICTION, **params}


def _one_vs_rest(base, classes: int):
    return C.OneVsRest(
        classifier=base, featuresCol=FEATURES, labelCol=LABEL, predictionCol=PREDICTION,
        parallelism=min(classes, CLASS_THREADS),
    )


# The names that users of boosted trees know, and ours.
BOOSTED_NAMES = {
    "n_estimators": "rounds", "iterations": "rounds", "maxIter": "rounds",
    "learning_rate": "rate", "stepSize": "rate",
    "max_depth": "depth", "depth": "depth", "maxDepth": "depth", "num_leaves": "leaves",
    "min_child_samples": "min_rows", "minInstancesPerNode": "min_rows", "min_child_weight": "min_weight",
    "subsample": "row_share", "subsamplingRate": "row_share", "colsample_bytree": "column_share",
    "l2_leaf_reg": "penalty", "reg_lambda": "penalty", "max_bin": "bins", "random_state": "seed",
}


def boosted_settings(defaults: Settings, params: Mapping) -> Settings:
    """``defaults`` changed by parameters under any known name."""
    return replace(defaults, **{BOOSTED_NAMES.get(name, name): value for name, value in params.items()})


def _boosted(defaults: Settings) -> Candidate:
    """Gradient-boosted trees; several classes share a softmax."""
    return Candidate(
        lambda classes, **params: Boosted(boosted_settings(defaults, params), classes),
        lambda **params: Boosted(boosted_settings(defaults, params)),
    )


def _linear(elastic: float) -> Candidate:
    return Candidate(
        lambda classes, **p: C.LogisticRegression(
            **_cols(**({"elasticNetParam": elastic, "regParam": 0.01} | p))),
        lambda **p: R.LinearRegression(**_cols(**({"elasticNetParam": elastic, "regParam": 0.1} | p))),
    )


def _svm(classes: int, **params):
    base = C.LinearSVC(**_cols(**({"regParam": 0.01} | params)))
    if classes <= 2:
        return base
    return _one_vs_rest(base, classes)


class Perceptron(Estimator):
    """Multi-layer perceptron whose input layer is sized from the assembled features."""

    def __init__(self, classes: int, hidden: int = 16, **params):
        super().__init__()
        self.classes, self.hidden, self.extra = classes, hidden, params

    def _fit(self, df: DataFrame):
        return C.MultilayerPerceptronClassifier(
            **_cols(layers=[vector_width(df), self.hidden, max(self.classes, 2)], seed=SEED, **self.extra)
        ).fit(df)


# Registry names, and the default limits, rate, rounds and penalty of the boosted families.
REGISTRY: dict[str, Candidate] = {
    "xgb": _boosted(Settings(rounds=100, rate=0.3, depth=6, min_weight=1.0, penalty=1.0)),
    "lgb": _boosted(Settings(rounds=100, rate=0.1, depth=None, leaves=31, min_rows=20, min_weight=1e-3, penalty=0.0)),
    "cat": _boosted(Settings(rounds=1000, rate=0.03, depth=6, penalty=3.0)),
    "ridge": Candidate(
        lambda classes, **p: RidgeClassifier(classes=classes, **p), lambda **p: Ridge(**p)),
    "random_forest": Candidate(
        lambda classes, **p: C.RandomForestClassifier(**_cols(**({"seed": SEED, "numTrees": 100} | p))),
        lambda **p: R.RandomForestRegressor(**_cols(**({"seed": SEED, "numTrees": 100} | p))),
    ),
    "logistic": Candidate(
        lambda classes, **p: C.LogisticRegression(**_cols(**({"regParam": 0.01} | p))), None),
    "linear": Candidate(None, lambda **p: R.LinearRegression(**_cols(**p))),
    "lasso": _linear(1.0),
    "elastic_net": _linear(0.5),
    "tree": Candidate(
        lambda classes, **p: C.DecisionTreeClassifier(**_cols(**({"seed": SEED} | p))),
        lambda **p: R.DecisionTreeRegressor(**_cols(**({"seed": SEED} | p))),
    ),
    "linear_svm": Candidate(_svm, None),
    "naive_bayes": Candidate(
        lambda classes, **p: C.NaiveBayes(**_cols(**({"modelType": "gaussian"} | p))), None),
    "mlp": Candidate(lambda classes, **p: Perceptron(classes, **p), None),
}
BASELINES = ("xgb", "lgb", "cat", "ridge")
FALLBACK = "random_forest"


def candidate(name: str) -> Candidate:
    """The named candidate, or the fallback for an unknown name."""
    return REGISTRY.get(name, REGISTRY[FALLBACK])
