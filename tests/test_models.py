"""Model selection: coverage, leakage, failures, search."""

import math
import time

import pytest
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from foldwise.operators import evaluate, metrics, parzen, tuning
from foldwise.operators.registry import REGISTRY, Candidate, Ridge, RidgeClassifier


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(400).select(
        "id", ((F.col("id") * 37 % 101) / 10).alias("x"),
        F.when(F.col("id") % 9 != 0, (F.col("id") * 11 % 13).cast("double")).alias("gap"),
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("cat"),
        F.concat(F.lit("w"), (F.col("id") % 150).cast("string")).alias("wide"),
        (F.col("id") % 2 == 0).alias("flag"), F.timestamp_seconds(F.col("id") * 86400).alias("t"),
        F.when((F.col("id") * 37 % 101) > 50, "yes").otherwise("no").alias("y"),
    ).persist()


@pytest.fixture(scope="module")
def prepared(frame):
    return evaluate.prepare(frame, "y", F.col("id"), k=3, drop=["id"]).persist()


def test_prepare_routes_columns(prepared):
    assert prepared.task == "classification" and prepared.classes == ["no", "yes"]
    assert prepared.one_hot == ["cat"] and prepared.by_target == ["wide"]
    assert "flag" in prepared.numeric and "t_year" in prepared.numeric
    assert prepared.frame.count() == 400


def test_every_row_is_predicted_once_by_another_fold(prepared):
    oof, model = evaluate.out_of_fold(prepared, lambda: REGISTRY["tree"].build("classification", 2))
    assert oof.count() == oof.select("key").distinct().count() == 400
    assert oof.where(~F.col("score").between(0, 1)).count() == 0
    scores = {r["metric"]: r["value"] for r in metrics.mean_scores(
        evaluate.scores_of(prepared, oof), ["metric"]).collect()}
    assert scores["roc_auc"] > 0.95
    i = evaluate.importances(model, model.transform(
        evaluate.encode_by_target(prepared, prepared.frame, [])[0]))
    top = i.orderBy(F.desc("importance")).first()
    assert top["feature"] == "x" and i.agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_held_out_labels_do_not_reach_the_fit(prepared):
    def vectors(frame):
        p = evaluate.Prepared(**{**prepared.__dict__, "frame": frame})
        with evaluate.fold_vectors(p, 0) as (_, _, valid):
            return {r["key"]: r["features"] for r in valid.select("key", "features").collect()}

    flipped = prepared.frame.withColumn(
        "label", F.when(F.col("fold") == 0, 1 - F.col("label")).otherwise(F.col("label")))
    assert vectors(prepared.frame) == vectors(flipped)


def test_failing_model_is_reported(prepared, monkeypatch):
    def broken(classes, **params):
        raise RuntimeError("cannot build")

    monkeypatch.setitem(REGISTRY, "broken", Candidate(broken, None))
    board = evaluate.leaderboard(prepared, ["tree", "broken"], parallelism=2).collect()
    assert {r["error"] for r in board if r["model"] == "broken"} == {"cannot build"}
    assert len([r for r in board if r["model"] == "tree"]) == 3 * len(metrics.BINARY_SCORERS)
    assert [r.error for r in evaluate.leaderboard(prepared, ["broken"]).collect()] == ["cannot build"]


def test_ridge_equals_closed_form(spark):
    df = spark.range(60).select((F.col("id") % 7).cast("double").alias("x"),
                                (F.col("id") * 3 % 11 + F.col("id") % 7).cast("double").alias("label"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), Ridge(2.5)]).fit(df)
    r = df.agg(F.covar_pop("x", "label") * 60, F.var_pop("x") * 60).first()
    assert model.stages[-1].coefficients[0] == pytest.approx(r[0] / (r[1] + 2.5))


def test_ridge_classifier_of_three_classes(spark):
    df = spark.range(90).select((F.col("id") % 3).cast("double").alias("label"), "id")
    df = df.select("label", *[
        (F.when(F.col("label") == i, 1.0).otherwise(0.0) + (F.col("id") % 5) / 50).alias(f"x{i}")
        for i in range(3)])
    df = VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(df)
    out = RidgeClassifier(1.0, 3).fit(df).transform(df)
    assert out.where("prediction <> label").count() == 0
    assert evaluate.with_score(out, 3).first()["probabilities"] is not None


def test_scoring_a_drifted_table(prepared, frame):
    score = evaluate.refit(prepared, REGISTRY["logistic"].build("classification", 2, maxIter=5))
    test = frame.drop("y", "gap").withColumn("extra", F.lit("z")).withColumn(
        "cat", F.when(F.col("id") < 10, "unseen").otherwise(F.col("cat")))
    out = score(evaluate.align_test(prepared, test, F.col("id")))
    assert out.count() == 400 and out.where(~F.col("score").between(0, 1)).count() == 0


def test_log_target_predicts_on_its_own_scale(frame):
    df = frame.select("id", "x", F.expm1(F.col("x") / 5).alias("price"))
    p = evaluate.prepare(df, "price", F.col("id"), "regression", 3, ["id"])
    oof, _ = evaluate.out_of_fold(p, lambda: evaluate.LogTarget(Ridge(1e-6)))
    report = metrics.regression_report(oof).first()
    assert report["r2"] > 0.999


def test_search_is_seeded_pruned_and_budgeted(prepared):
    space = {"maxDepth": ("int", 1, 4), "minInstancesPerNode": ("int", 1, 20)}
    a = tuning.search(prepared, "tree", 2, space=space)
    assert {r["status"] for r in a.collect()} == {"ok"}
    assert [r["params"] for r in a.orderBy("trial").collect()] == [
        {k: float(v) for k, v in parzen.propose(space, [], t, 42).items()} for t in range(2)]
    best = tuning.best_params(a, space)
    assert set(best) == set(space) and all(isinstance(v, int) for v in best.values())
    loss = tuning.search(prepared, "tree", 1, "neg_log_loss", space=space).first()
    assert loss["status"] == "ok" and loss["score"] < 0
    none = tuning.search(prepared, "unknown", 2)
    assert {r["status"] for r in none.collect()} == {"pruned"} and tuning.best_params(none, space) is None
    late = tuning.search(prepared, "tree", 2, space=space, budget=0)
    assert {r["status"] for r in late.collect()} == {"skipped"}


class Hanging(Estimator):
    """One task that takes far longer than any test where ``hangs`` is 1, else a plain tree."""

    def __init__(self, hangs):
        super().__init__()
        self.hangs = hangs

    def _fit(self, df):
        if self.hangs:
            wait = F.udf(lambda x: time.sleep(600) or x, "double")
            df.coalesce(1).select(F.sum(wait("label"))).collect()
        return REGISTRY["tree"].build("classification", 2, maxDepth=2).fit(df)


def test_hanging_trials_end_with_the_budget_and_others_survive(prepared, monkeypatch):
    monkeypatch.setitem(REGISTRY, "hanging", Candidate(lambda classes, hangs: Hanging(hangs), None))
    begun = time.monotonic()
    space = {"hangs": ("int", 0, 1)}
    rows = tuning.search(prepared, "hanging", 5, "accuracy", budget=40, space=space, parallelism=4, seed=3, startup=4).collect()
    status = {r.trial: r.status for r in rows}
    assert time.monotonic() - begun < 80 and {"ok", "timeout"} <= set(status.values())
    assert all((r.status == "ok") == (r.params["hangs"] == 0 and r.score is not None) for r in rows if r.trial < 4)
    assert status[4] == "skipped"
    board = evaluate.leaderboard(prepared, ["hanging", "tree"], {"hanging": {"hangs": 1}}, 2, budget=30).collect()
    assert {r.error for r in board if r.model == "hanging"} == {"timeout"}
    assert len([r for r in board if r.model == "tree" and r.error is None]) == 3 * len(metrics.BINARY_SCORERS)


def test_every_space_builds_its_family():
    for name, space in tuning.SPACES.items():
        for t in range(5):
            drawn = parzen.propose(space, [], t, 7)
            found = REGISTRY[name]
            made = [found.build(task, 3, **drawn) for task, make in (
                ("classification", found.classifier), ("regression", found.regressor)) if make]
            assert made
    settings = REGISTRY["lgb"].build("classification", 2, **parzen.propose(tuning.SPACES["lgb"], [], 0, 7)).settings
    assert 20 <= settings.leaves <= 150 and 3 <= settings.depth <= 10 and settings.min_rows >= 10 and settings.row_share >= 0.5
    assert REGISTRY["cat"].build("regression", l2_leaf_reg=7.5, depth=4).settings.penalty == 7.5


def bowl(params):
    return -((math.log10(params["rate"]) + 1.5) ** 2) - ((params["depth"] - 8) / 4) ** 2 - (params["share"] - 0.9) ** 2


def test_densities_beat_random_draws_and_are_reproducible():
    space = {"rate": ("log", 1e-3, 1.0), "depth": ("int", 1, 12), "share": ("float", 0.0, 1.0)}

    def best(seed, startup):
        finished = []
        for t in range(50):
            params = parzen.propose(space, finished, t, seed, startup)
            assert 1e-3 <= params["rate"] <= 1 and 1 <= params["depth"] <= 12 and 0 <= params["share"] <= 1
            finished.append((bowl(params), params))
        return max(f[0] for f in finished), finished

    by_density = [best(seed, 10)[0] for seed in range(20)]
    at_random = [best(seed, 51)[0] for seed in range(20)]
    assert sum(by_density) > sum(at_random) / 2 and sum(a > b for a, b in zip(by_density, at_random)) >= 15
    assert best(3, 10)[1] == best(3, 10)[1]


def test_density_is_one_and_places_undo_draws():
    d = parzen.Density([0.1, 0.1, 0.95, 0.0])
    assert sum(d(i / 2000) for i in range(2000)) / 2000 == pytest.approx(1, abs=5e-3)
    assert all(0 <= d.sample(a / 7, b / 7) <= 1 for a in range(7) for b in range(7))
    for kind, low, high in (("log", 0.01, 0.3), ("int", 3, 10), ("float", 0.5, 1.0)):
        for u in (0.02, 0.4, 0.99):
            value = parzen.draw(kind, low, high, u)
            assert parzen.draw(kind, low, high, parzen.place(kind, low, high, value)) == pytest.approx(value)


def test_draws_stay_in_range():
    for u in (0.0, 0.5, 1 - 2**-32):
        assert 3 <= parzen.draw("int", 3, 10, u) <= 10
        assert 0.01 <= parzen.draw("log", 0.01, 0.3, u) <= 0.3
        assert 0.5 <= parzen.draw("float", 0.5, 1.0, u) <= 1.0
