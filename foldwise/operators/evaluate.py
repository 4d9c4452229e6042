"""Cross-validation, out-of-fold predictions, leaderboards and scoring of new tables."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler, VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators import encode, folds, metrics, schema
from foldwise.operators.budget import within
from foldwise.operators.preprocess import (
    MISSING, CategoryImputer, CategoryImputerModel, NumericPreparer, NumericPreparerModel, date_parts,
    fit_categories_by_fold, fit_scaling_by_fold,
)
from foldwise.operators.registry import FEATURES, LABEL, PREDICTION, RAW, candidate, in_parallel
from foldwise.session import materialise, written

#: Classes a target may have; their list is kept on the driver.
MAX_CLASSES = 1000
#: Rows x feature columns of one task of a fit: a fit runs many short jobs, in which the start of a task costs more than less.
CELLS = 1 << 20
#: Rows x feature columns of one task, however few shuffle partitions the session has: MLlib keeps its rows as objects.
MOST_CELLS = 1 << 23
#: Rows x feature columns up to which a fold's vectors are kept for all passes and folds are fitted side by side.
#: Beyond, they are made from the prepared rows in every pass: kept, they are a copy of the table a fold.
KEPT_CELLS = 1 << 29
KEY, FOLD, SCORE, PROBABILITIES = "key", "fold", "score", "probabilities"
INNER_SEED = 4242
#: Held out instead of a fold: the training rows are all rows.
NO_FOLD = -1


@dataclass
class Prepared:
    """A keyed frame with label and folds, and how its columns are to be prepared."""

    frame: DataFrame
    target: str
    task: str
    numeric: list[str]
    one_hot: list[str]
    by_target: list[str]
    classes: list = field(default_factory=list)
    folds: int = 5
    #: Rows x feature columns, 0 if they were not counted.
    cells: int = 0

    @property
    def large(self) -> bool:
        return self.cells > KEPT_CELLS

    def persist(self) -> Prepared:
        self.frame = self.frame.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def unpersist(self) -> None:
        self.frame.unpersist()


def as_features(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """Booleans to 0/1 and times to their parts; columns without a role are dropped."""
    roles = schema.infer_roles(df, exclude)
    new = {c: F.col(c).cast("int") for c in roles.boolean}
    for c in roles.temporal:
        new |= date_parts(c)
    return schema.normalise_nan(df.withColumns(new) if new else df).drop(
        *roles.temporal, *roles.other
    )


def prepare(
    df: DataFrame, target: str, key: Column, task: str | None = None, k: int = 5,
    drop: Sequence[str] = (), one_hot_limit: int = encode.ONE_HOT_LIMIT, stratified: bool = True,
    cleaned: bool = True,
) -> Prepared:
    """Keyed, labelled and folded frame. The key is no feature; the target is encoded once.

    The rows are spread by key once, because every fit passes over them many times; the tasks
    are as many as their number asks for, up to the session's shuffle partitions, unless those
    are so few that a task had over MOST_CELLS. Date parts, labels and folds by key alone are added
    after that, so that the shuffle is no wider than the table.
    """
    df = schema.drop_null_target(df, target).withColumn(KEY, key)
    features = [c for c in df.columns if c not in (target, KEY, *drop)]
    df = df.select(KEY, target, *features)
    if cleaned:
        names = schema.clean_names(features)
        df = df.toDF(KEY, target, *names)
        features = names
    task = task or schema.infer_task(df, target)
    raw, df = df, as_features(df, [KEY, target])
    roles = schema.infer_roles(df, [KEY, target])
    rows, routes = encode.count_and_route(df, roles.categorical, one_hot_limit)
    cells = rows * (len(roles.numeric) + len(roles.categorical))
    most = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(cells / MOST_CELLS))
    tasks = max(1, min(most, math.ceil(cells / CELLS)))
    by_class = task == "classification" and stratified
    classes: list = []
    if task == "classification":
        classes = [r[0] for r in df.select(target).distinct().orderBy(target).take(MAX_CLASSES + 1)]
        if len(classes) > MAX_CLASSES:
            raise ValueError(f"{target} has over {MAX_CLASSES} classes")
    seen = df
    if not by_class:
        df = as_features(raw.repartition(tasks, KEY), [KEY, target])
    if task == "classification":
        df = encode.encode_label(df, target, LABEL, seen).drop(target)
    else:
        df = df.withColumn(LABEL, F.col(target).cast("double")).drop(target)
    if by_class:
        df = folds.stratified_kfold(df, LABEL, F.col(KEY), k).repartition(tasks, KEY)
    else:
        df = folds.kfold(df, F.col(KEY), k)
    return Prepared(
        df, target, task, roles.numeric,
        [c for c in roles.categorical if routes[c] == "one_hot"],
        [c for c in roles.categorical if routes[c] == "target"], classes, k, cells,
    )


def preparation(
    p: Prepared, impute: str = "median", scale: str | None = "standard", fitted: Sequence[Model] = (),
) -> list:
    """Stages from raw columns to the feature vector; an unseen category is all zeros.

    ``fitted`` are the first stages, if :func:`fit_by_fold` made them; target-encoded columns
    depend on the training rows' own folds and are always fitted here.
    """
    encoded = [f"{c}_target" for c in p.by_target]
    numeric, hot = [*p.numeric, *encoded], [f"{c}_hot" for c in p.one_hot]
    index = [f"{c}_index" for c in p.one_hot]
    if fitted:
        stages = [*fitted, *([NumericPreparer(encoded, impute, scale)] if encoded else [])]
    else:
        stages = [NumericPreparer(numeric, impute, scale)]
        if p.one_hot:
            stages += [
                CategoryImputer(p.one_hot),
                StringIndexer(inputCols=p.one_hot, outputCols=index, handleInvalid="keep",
                              stringOrderType="alphabetAsc"),
            ]
    if p.one_hot:
        stages.append(OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True, handleInvalid="error"))
    return [*stages, VectorAssembler(inputCols=[*numeric, *hot], outputCol=FEATURES)]


def fit_by_fold(p: Prepared, held: Sequence[int] | None = None) -> list[list[Model]]:
    """Per fold, or fold in ``held``, the imputation, scaling and category stages fitted on the other folds.

    Every statistic of all folds comes from one pass over the rows, not from a pass per fold.
    """
    held = range(p.folds) if held is None else held
    scalings = fit_scaling_by_fold(p.frame, p.numeric, FOLD, "median", held)
    categories = fit_categories_by_fold(p.frame, p.one_hot, held, FOLD)
    out = []
    for i in held:
        stages: list[Model] = [NumericPreparerModel({c: scalings[c][i] for c in p.numeric})]
        if p.one_hot:
            found = categories[i]
            stages += [
                CategoryImputerModel({c: MISSING if found[c][0] is None else found[c][0] for c in p.one_hot}),
                # One indexer a column: a joint one pads shorter label lists with nulls.
                *[
                    StringIndexerModel.from_labels(
                        found[c][1] or [MISSING], c, f"{c}_index", handleInvalid="keep"
                    )
                    for c in p.one_hot
                ],
            ]
        out.append(stages)
    return out


def encode_by_target(p: Prepared, train: DataFrame, others: Sequence[DataFrame]):
    """Target-encode the wide categories: training rows out of fold, other rows by all of train."""
    if not p.by_target:
        return train, list(others)
    model = encode.TargetEncoder(p.by_target, LABEL).fit(train)
    others = [model.transform(o) for o in others]
    train = folds.kfold(train, F.col(KEY), 5, INNER_SEED, "_inner")
    for c in p.by_target:
        train = encode.target_encode_oof(train, c, LABEL, "_inner", name=f"{c}_target")
    return train.drop("_inner"), others


def with_score(scored: DataFrame, classes: int = 2) -> DataFrame:
    """Score of the positive class (probability, raw score or prediction) and class scores."""
    have = set(scored.columns)
    if "probability" in have:
        values, calibrated = vector_to_array("probability"), True
    elif RAW in have:
        values, calibrated = F.col(RAW), False
    elif "rawPrediction" in have:
        values, calibrated = vector_to_array("rawPrediction"), False
    else:
        return scored.withColumn(SCORE, F.col(PREDICTION))
    out = scored.withColumn(SCORE, F.get(values, F.lit(1)))
    return out.withColumn(PROBABILITIES, values) if calibrated or classes > 2 else out


def output_columns(p: Prepared, scored: DataFrame, *keep: str) -> DataFrame:
    if p.task == "classification":
        scored = with_score(scored, len(p.classes))
    else:
        scored = scored.withColumn(SCORE, F.col(PREDICTION))
    if PROBABILITIES not in scored.columns:
        scored = scored.withColumn(PROBABILITIES, F.lit(None).cast("array<double>"))
    return scored.select(KEY, *keep, PREDICTION, SCORE, PROBABILITIES)


def fit_fold(p: Prepared, estimator: Estimator, i: int, stages=None) -> tuple[PipelineModel, DataFrame]:
    """Everything fitted on the other folds, and the rows of fold ``i`` scored."""
    train, valid = folds.split_fold(p.frame, i)
    train, (valid,) = encode_by_target(p, train, [valid])
    stages = stages or preparation(p, fitted=fit_by_fold(p, [i])[0])
    model = Pipeline(stages=[*stages, estimator]).fit(train)
    return model, model.transform(valid)


@contextmanager
def fold_vectors(p: Prepared, i: int, fitted: Sequence[Model] = ()):
    """Preparation fitted on the other folds, with training and held-out vectors, kept for all models if they are not too many."""
    train, valid = folds.split_fold(p.frame, i)
    train, (valid,) = encode_by_target(p, train, [valid])
    prep = Pipeline(stages=preparation(p, fitted=fitted)).fit(train)
    train = prep.transform(train).select(KEY, LABEL, FEATURES)
    valid = prep.transform(valid).select(KEY, FOLD, LABEL, FEATURES)
    kept = [] if p.large else [f.persist(StorageLevel.MEMORY_AND_DISK) for f in (train, valid)]
    try:
        yield prep, train, valid
    finally:
        for f in kept:
            f.unpersist()


def keep(p: Prepared, df: DataFrame) -> DataFrame:
    """Rows of ``p`` with what was found for them, written once: of a large table by columns, which takes a fraction of the disk."""
    return written(df) if p.large else materialise(df)


Builders = Mapping[str, Callable[[], Estimator]]


def predict_folds(
    p: Prepared, builders: Builders, parallelism: int = 1, fitted: Sequence[Sequence[Model]] | None = None,
    deadline: float | None = None,
) -> tuple[DataFrame | None, dict[str, str], dict[str, PipelineModel]]:
    """Out-of-fold predictions of several models, each row by models that never saw it.

    The preparation of all folds is fitted in one pass, and the predictions are written once, so metrics read them and not the models again. A model that fails in any fold is
    left out and reported. Models run side by side on a fold's vectors; folds do when there
    are more threads than models. ``fitted`` is what :func:`fit_by_fold` made, if it is known. What
    has not ended by ``deadline`` (of ``time.monotonic``) is cancelled and fails with ``timeout``;
    models that ended stay, if ``parallelism`` leaves them a thread beside those that hang. Returns the long table ``(model, key, fold, label, prediction,
    score, probabilities)``, the errors, and the last fold's fitted pipelines.
    """
    side_by_side = 1 if p.large else max(1, parallelism // max(len(builders), 1))
    if deadline is not None and parallelism > 1:
        side_by_side = p.folds  # or a fit that hangs in one fold would keep the others from theirs
    spark = p.frame.sparkSession
    try:
        fitted = fitted or within(spark, deadline, lambda: fit_by_fold(p))
    except Exception as e:
        return None, {name: str(e) or repr(e) for name in builders}, {}

    def one_fold(i: int) -> list:
        try:
            return vectors_of(i)
        except Exception as e:  # the preparation failed, for every model
            return [(name, None, str(e) or repr(e)) for name in builders]

    def vectors_of(i: int) -> list:
        with fold_vectors(p, i, fitted[i]) as (prep, train, valid):

            def fit_and_score(name: str):
                model = builders[name]().fit(train)
                scored = output_columns(p, model.transform(valid), FOLD, LABEL)
                return keep(p, scored.select(F.lit(name).alias("model"), "*")), model

            def run(name: str):
                try:
                    scored, model = within(spark, deadline, lambda: fit_and_score(name))
                    return name, scored, PipelineModel([*prep.stages, model])
                except Exception as e:
                    return name, None, str(e) or repr(e)

            return in_parallel([lambda n=n: run(n) for n in builders], parallelism)

    errors: dict[str, str] = {}
    parts: dict[str, list[DataFrame]] = {name: [] for name in builders}
    last: dict[str, PipelineModel] = {}
    for fold in in_parallel([lambda i=i: one_fold(i) for i in range(p.folds)], side_by_side):
        for name, scored, model in fold:
            if scored is None:
                errors[name] = model
            else:
                parts[name].append(scored)
                last[name] = model
    whole = [part for name, found in parts.items() if name not in errors for part in found]
    out = None
    for part in whole:
        out = part if out is None else out.unionByName(part)
    return out, errors, {n: m for n, m in last.items() if n not in errors}


def out_of_fold(
    p: Prepared, build: Callable[[], Estimator], parallelism: int = 1
) -> tuple[DataFrame, PipelineModel]:
    """Out-of-fold predictions of one model and its last fold's pipeline."""
    oof, errors, models = predict_folds(p, {"model": build}, parallelism)
    if errors:
        raise ValueError(errors["model"])
    return oof.drop("model"), models["model"]


def scorer_names(p: Prepared) -> tuple[str, ...]:
    """The metrics that :func:`scores_of` makes for a task."""
    if p.task == "regression":
        return tuple(metrics.REGRESSION_SCORERS)
    return metrics.BINARY_SCORERS if len(p.classes) <= 2 else (*metrics.MULTICLASS_SCORERS, "neg_log_loss")


def scores_of(p: Prepared, oof: DataFrame, by: Sequence[str] = (FOLD,), only: str | None = None) -> DataFrame:
    """Metrics per fold in long form ``(fold, metric, value)``; higher is better for each.

    The log loss is NULL for models whose class scores are no probabilities. ``only`` names the one
    metric that is wanted; the passes for others are left out.
    """
    by = list(by)
    if only is not None and p.task == "classification" and len(p.classes) <= 2 and only in ("accuracy", "f1", "roc_auc"):
        if only == "roc_auc":
            scores = metrics.roc_auc(oof, by, LABEL, SCORE)
        else:
            scores = metrics.binary_report(metrics.binary_counts(oof, by, LABEL, PREDICTION))
        return metrics.to_leaderboard(scores, (only,), by)
    if only is not None:
        return scores_of(p, oof, by).where(F.col("metric") == only)
    if p.task == "regression":
        report = metrics.regression_report(oof, by, LABEL, PREDICTION)
        return metrics.to_leaderboard(report, metrics.REGRESSION_SCORERS, by)
    loss = metrics.to_leaderboard(
        metrics.log_loss(oof, by, LABEL, PROBABILITIES), ("neg_log_loss",), by
    )
    if len(p.classes) <= 2:
        report = metrics.binary_report(metrics.binary_counts(oof, by, LABEL, PREDICTION))
        auc = metrics.roc_auc(oof, by, LABEL, SCORE)
        return metrics.to_leaderboard(
            report.select(*by, "accuracy", "f1").join(auc, by), ("accuracy", "f1", "roc_auc"), by
        ).unionByName(loss)
    report = metrics.multiclass_report(metrics.confusion(oof, by, LABEL, PREDICTION), by)
    out = metrics.to_leaderboard(report, ("accuracy", "f1_macro", "f1_micro"), by)
    codes = [float(i) for i in range(len(p.classes))]
    scored = oof.where(F.col(PROBABILITIES).isNotNull())
    auc = metrics.roc_auc_one_vs_rest(scored, codes, by, LABEL, PROBABILITIES)
    return out.unionByName(metrics.to_leaderboard(auc, ("roc_auc",), by)).unionByName(loss)


BOARD_SCHEMA = "model string, fold int, metric string, value double, error string"


def leaderboard(
    p: Prepared, names: Sequence[str], params: Mapping[str, Mapping] | None = None,
    parallelism: int = 1, budget: float | None = None,
) -> DataFrame:
    """``(model, fold, metric, value, error)``; a model that fails is reported, not dropped.

    A model that is not done after ``budget`` seconds is cancelled; its error is ``timeout``.
    """
    builders = {
        n: lambda n=n: candidate(n).build(p.task, len(p.classes), **dict((params or {}).get(n, {})))
        for n in names
    }
    deadline = None if budget is None else time.monotonic() + budget
    oof, errors, _ = predict_folds(p, builders, parallelism, deadline=deadline)
    failed = p.frame.sparkSession.createDataFrame([(n, None, None, None, e) for n, e in errors.items()], BOARD_SCHEMA)
    if oof is None:
        return failed
    board = scores_of(p, oof, ("model", FOLD)).select(
        "model", FOLD, "metric", "value", F.lit(None).cast("string").alias("error")
    )
    return board.unionByName(failed)


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the assembled features, from the vector's metadata."""
    attrs = df.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {})
    flat = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [name for _, name in flat]


def importances(model: PipelineModel, transformed: DataFrame) -> DataFrame:
    """``(feature, importance)`` of the last stage: importances, or absolute weights."""
    last = model.stages[-1]
    names = feature_names(model, transformed)
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray().tolist()
    elif hasattr(last, "coefficients"):
        values = [abs(v) for v in last.coefficients.toArray().tolist()]
    else:
        raise TypeError(f"{type(last).__name__} has no importances")
    names = names if len(names) == len(values) else [f"f{i}" for i in range(len(values))]
    return transformed.sparkSession.createDataFrame(
        list(zip(names, map(float, values), strict=True)), "feature string, importance double"
    )


def slicer_by_importance(model: PipelineModel, output: str = "selected") -> VectorSlicer:
    """Keep features whose importance reaches the mean."""
    values = model.stages[-1].featureImportances.toArray()
    keep = [i for i, v in enumerate(values) if v >= values.mean()]
    return VectorSlicer(inputCol=FEATURES, outputCol=output, indices=keep)


def refit(p: Prepared, estimator: Estimator) -> Callable[[DataFrame], DataFrame]:
    """Fit on all rows; returns a scorer of tables that carry ``key`` and the features.

    The category encoder is fitted once too, however many tables are scored.
    """
    train, _ = encode_by_target(p, p.frame, [])
    stages = preparation(p, fitted=fit_by_fold(p, [NO_FOLD])[0])
    model = Pipeline(stages=[*stages, estimator]).fit(train)
    encoder = encode.TargetEncoder(p.by_target, LABEL).fit(p.frame) if p.by_target else None

    def score(test: DataFrame) -> DataFrame:
        return output_columns(p, model.transform(encoder.transform(test) if encoder else test))

    return score


def align_test(p: Prepared, test: DataFrame, key: Column) -> DataFrame:
    """A new table with its names cleaned and its columns shaped like the training features."""
    keyed = test.withColumn("_row_key", key)
    names = schema.clean_names(test.columns)
    keyed = keyed.toDF(*names, KEY)
    features = [*p.numeric, *p.one_hot, *p.by_target]
    return schema.align_to_train(as_features(keyed, [KEY]), features, [KEY])


class LogTarget(Estimator):
    """Fit a regressor on ``log1p`` of the label and predict on the original scale."""

    def __init__(self, estimator: Estimator):
        super().__init__()
        self.estimator = estimator

    def _fit(self, df: DataFrame):
        label = F.when(F.col(LABEL) > -1, F.log1p(LABEL)).otherwise(
            F.raise_error(F.lit("a label of -1 or below has no logarithm")).cast("double")
        )
        inner = self.estimator.fit(df.withColumn(LABEL, label))
        return LogTargetModel(inner)


class LogTargetModel(PipelineModel):
    def __init__(self, inner):
        super().__init__([inner])

    def _transform(self, df: DataFrame) -> DataFrame:
        out = super()._transform(df)
        return out.withColumn(PREDICTION, F.expm1(PREDICTION))


def ridge_closed_form(df: DataFrame, x: str, y: str, alpha: float, fold: str = FOLD) -> DataFrame:
    """One-feature ridge for every fold from one aggregate of per-fold moments.

    Centred sums of the training folds merge from those of each fold, and the held-out error
    follows from the held-out moments, so the rows are read once.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    rows = df.groupBy(fold).agg(
        F.count(a).alias("n"), F.avg(a).alias("mx"), F.avg(b).alias("my"),
        F.var_pop(a).alias("vx"), F.var_pop(b).alias("vy"), F.covar_pop(a, b).alias("cxy"),
    ).where(F.col("n") > 0).collect()
    out = []
    for held in rows:
        train = [r for r in rows if r[fold] != held[fold]]
        n = sum(r["n"] for r in train)
        if not n:
            continue
        mx = sum(r["n"] * r["mx"] for r in train) / n
        my = sum(r["n"] * r["my"] for r in train) / n
        sxx = sum(r["n"] * (r["vx"] + (r["mx"] - mx) ** 2) for r in train)
        sxy = sum(r["n"] * (r["cxy"] + (r["mx"] - mx) * (r["my"] - my)) for r in train)
        slope = sxy / (sxx + alpha)
        intercept = my - slope * mx
        bias = held["my"] - slope * held["mx"] - intercept
        mse = held["vy"] - 2 * slope * held["cxy"] + slope**2 * held["vx"] + bias**2
        out.append((held[fold], slope, intercept, mse))
    return df.sparkSession.createDataFrame(
        out, f"`{fold}` int, slope double, intercept double, mse double"
    )
