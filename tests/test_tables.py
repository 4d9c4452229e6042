"""Names, tasks, texts, profiles, preparation, metrics and outputs on small frames."""

import logging
import math

import pytest
from pyspark.sql import functions as F

from foldwise.functions import numeric, text
from foldwise.operators import (
    encode, evaluate, folds, metrics, output, preprocess, profile, schema, select,
)
from foldwise.sources import sinks, tables


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def of(spark, data, expr):
    df = spark.createDataFrame([(v,) for v in data], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


# --- names and schema -----------------------------------------------------------------
def test_clean_names_keep_unicode_and_resolve_collisions():
    assert schema.clean_names(["a b", "a-b", "é(x)", "ab"]) == ["a_b", "ab", "éx", "ab_2"]


def test_roles(spark):
    df = spark.sql("select 1 as i, 1.5D as d, true as b, 'x' as s, current_date() as t, array(1) as a")
    roles = schema.infer_roles(df)
    assert (roles.numeric, roles.boolean, roles.categorical) == (["i", "d"], ["b"], ["s"])
    assert (roles.temporal, roles.other) == (["t"], ["a"])


def test_task_counts_all_rows_when_few_do_not_decide(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("late"),
        (F.col("id") % 19).alias("nineteen"), (F.col("id") % 20).alias("twenty"),
        F.lit(None).cast("int").alias("nothing"),
    ).coalesce(1)
    assert schema.infer_tasks(df, df.columns) == {
        "late": "regression", "nineteen": "classification", "twenty": "regression",
        "nothing": "classification",
    }


def test_missing_target_is_an_error(spark):
    with pytest.raises(ValueError, match="not found"):
        schema.require_column(spark.range(1), "y")


def test_align_fills_and_drops(spark):
    test = spark.createDataFrame([(7, "x", 1)], "key long, extra string, b int")
    assert schema.align_to_train(test, ["a", "b"], ["key"]).collect()[0].asDict() == {"key": 7, "a": 0, "b": 1}


# --- text -----------------------------------------------------------------------------
def test_slug(spark):
    data = ["a b/c", " main ", "--..", "", None, "X_1.2-y", "é"]
    assert of(spark, data, text.slug) == [
        "a-b-c", "default", "default", "default", "default", "X_1.2-y", "default"]


def test_dataset_name(spark):
    data = ["data/t/train.csv", "data/train.csv", "x/y/train.csv", "train.csv", "/train.csv",
            "./data/t/a.csv", "/data/t/a.csv", "data/.hidden", "a.b.csv", "data/t/u/v.csv"]
    assert of(spark, data, text.dataset_name) == [
        "t", "train", "y", "train", "train", "t", "t", "hidden", "a.b", "t"]
    assert of(spark, ["a/data/t", "data", "x"], text.segment_after) == ["t", None, None]


def test_code_blocks(spark):
    data = ["hi\n```python\na = 1\n```\nbye\n```python\nb\n```", "  x = 1 ", "", "```python\n\n```"]
    assert of(spark, data, text.extract_code) == ["a = 1", "x = 1", None, None]
    assert of(spark, data[:1] + ["```python\na\n```"], text.without_code) == [
        "hi\n\nbye", "No reasoning provided by LLM."]


def test_truncation_keeps_short_text(spark):
    data = ["abcdef", "abc"]
    assert of(spark, data, lambda c: text.truncate_head(c, 3, "~")) == ["abc~", "abc"]
    assert of(spark, data, lambda c: text.truncate_tail(c, 3, "~")) == ["~def", "abc"]
    assert of(spark, [" a\nb \n"], text.one_line) == ["a b"]


def test_json_number_flags_bad_records(spark):
    data = ['{"k": 1.5}', '{"j": 1}', '{"k": 1', '{"k": "x"}', None, '{"k": "2"}']
    got = of(spark, data, lambda c: text.json_number(c, "k"))
    assert [tuple(r) for r in got] == [
        (1.5, "ok"), (None, "missing_key"), (None, "malformed"), (None, "malformed"),
        (None, "malformed"), (2.0, "ok")]


def test_to_number(spark):
    assert of(spark, ["1.5", "x", None, "NaN"], numeric.to_number) == [1.5, 0.0, 0.0, 0.0]


# --- profile --------------------------------------------------------------------------
def test_skewness_is_bias_corrected(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 10)], "x double")
    assert df.select(numeric.corrected_skewness(F.col("x"))).first()[0] == pytest.approx(1.7636, abs=1e-4)
    for data in ([1.0, 2.0], [3.0, 3.0, 3.0]):
        df = spark.createDataFrame([(x,) for x in data], "x double")
        assert df.select(numeric.corrected_skewness(F.col("x"))).first()[0] is None


def test_missing_counts_nan_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r["column"]: (r["n_missing"], r["pct_missing"]) for r in profile.missing_profile(df).collect()}
    assert got == {"x": (2, 66.67), "s": (1, 33.33)}
    empty = profile.missing_profile(df.limit(0), only_missing=False).collect()
    assert [(r["n_rows"], r["pct_missing"]) for r in empty] == [(0, None), (0, None)]


def test_mutual_information(spark):
    rows = [("a", "x", "u"), ("a", "x", "v"), ("b", "y", "u"), ("b", "y", "v")]
    df = spark.createDataFrame(rows, "same string, y string, other string")
    got = {r["column"]: r["mi"] for r in profile.mutual_information(df, ["same", "other"], "y").collect()}
    assert got["same"] == pytest.approx(math.log(2)) and got["other"] == pytest.approx(0, abs=1e-12)


def test_constant_column_has_no_correlation(spark):
    df = spark.range(5).select(F.lit(1.0).alias("c"), "id", (F.col("id") * 2).alias("y"))
    got = {r["column"]: r["corr"] for r in profile.correlations(df, "y").collect()}
    assert got["c"] is None and got["id"] == pytest.approx(1)


def test_report_renders(spark):
    df = spark.createDataFrame([(i, i / 2, "ab"[i % 2]) for i in range(30)], "k long, x double, y string")
    md = profile.render_markdown(profile.profile_report(df, "y", F.col("k")))
    assert "- task: classification" in md and "- a: 15 (50.00%)" in md and "Correlation" in md


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    samples = [values(profile.seeded_sample(df.repartition(n), F.col("id")), "id") for n in (1, 4, 16)]
    assert samples[0] == samples[1] == samples[2]


# --- preparation ----------------------------------------------------------------------
def test_scaling_of_odd_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None), (float("nan"), 5.0, None), (3.0, None, None)], "a double, b double, c double")
    got = preprocess.NumericPreparer(["a", "b", "c"]).fit(df).transform(df).collect()
    assert [r["a"] for r in got] == pytest.approx([-1.2247449, 0, 1.2247449])
    assert [(r["b"], r["c"]) for r in got] == [(0.0, 0.0)] * 3
    flagged = preprocess.NumericPreparer(["b"], "mean", None, True).fit(df).transform(df)
    assert [r["b_missing"] for r in flagged.collect()] == [0, 0, 1]


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    assert preprocess.fit_modes(df, ["s"]) == {"s": "a"}


def test_one_hot_is_zero_for_unseen_and_guards_width(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    model = encode.OneHot(["s"]).fit(train)
    got = model.transform(spark.createDataFrame([("a",), ("z",), (None,)], "s string")).collect()
    assert [(r["s_a"], r["s_b"]) for r in got] == [(1, 0), (0, 0), (0, 0)]
    with pytest.raises(ValueError, match="more than 1"):
        encode.OneHot(["s"], limit=1).fit(train)


def test_target_encoding_never_sees_its_own_fold(spark):
    rows = [(i, "ab"[i % 2], i % 3, float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, c string, fold int, y double")
    flipped = df.withColumn("y", F.when(F.col("fold") == 0, 1 - F.col("y")).otherwise(F.col("y")))
    one = encode.target_encode_oof(df, "c", "y").where("fold = 0").orderBy("id")
    two = encode.target_encode_oof(flipped, "c", "y").where("fold = 0").orderBy("id")
    assert values(one, "encoded") == values(two, "encoded")
    a = df.where("fold <> 0 and c = 'a'")
    n, s = a.count(), a.agg(F.sum("y")).first()[0]
    prior = df.where("fold <> 0").agg(F.avg("y")).first()[0]
    assert one.where("c = 'a'").first()["encoded"] == pytest.approx((s + 10 * prior) / (n + 10))


def test_scaling_by_fold_never_sees_its_own_fold(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") % 5).cast("int").alias("fold"))
    moved = df.withColumn("x", F.when(F.col("fold") == 2, F.col("x") + 1000).otherwise(F.col("x")))
    a = preprocess.fit_scaling_by_fold(df, ["x"])["x"][2]
    b = preprocess.fit_scaling_by_fold(moved, ["x"])["x"][2]
    assert (a.center, a.scale) == (b.center, b.scale)


def test_chi_square_and_variance(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 2.0), ("b", 3.0, 2.0)], "y string, x double, c double")
    assert select.variance_threshold(df, ["x", "c"]) == ["x"]
    got = {r["column"]: r["score"] for r in select.chi_square(df, ["x", "c"], "y").collect()}
    assert got["x"] == pytest.approx((2 - 10 / 3) ** 2 / (10 / 3) + (3 - 5 / 3) ** 2 / (5 / 3))
    assert got["c"] == pytest.approx(0)


def test_time_blocks_are_ordered(spark):
    df = spark.range(600).select(F.timestamp_seconds(F.col("id") * 3600).alias("t"))
    blocks = folds.time_blocks(df, "t", 5).groupBy("block").agg(F.min("t"), F.max("t"), F.count("t"))
    rows = sorted(tuple(r) for r in blocks.collect())
    assert [r[0] for r in rows] == list(range(6)) and all(r[3] == 100 for r in rows)
    assert all(a[2] < b[1] for a, b in zip(rows, rows[1:], strict=False))


# --- metrics --------------------------------------------------------------------------
def test_binary_report_on_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    r = metrics.binary_report(metrics.binary_counts(df)).first()
    assert (r["f1"], r["sensitivity"], r["specificity"], r["accuracy"]) == (0.0, 0.0, 1.0, 1.0)


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.3)], "label int, score double")
    assert metrics.roc_auc(df).first()["roc_auc"] is None


def test_macro_f1_counts_classes_that_are_only_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "b")], "label string, prediction string")
    r = metrics.multiclass_report(metrics.confusion(df)).first()
    assert (r["n"], r["classes"]) == (3, 2)
    assert r["f1_macro"] == pytest.approx((2 / 3 + 1 + 0) / 3)
    assert r["accuracy"] == r["f1_micro"] == pytest.approx(2 / 3)


def test_weighted_scores_equal_row_scores(spark):
    rows = [(i % 2, (i * 7 % 10) / 10) for i in range(40)]
    df = spark.createDataFrame(rows, "label int, score double")
    weighted = df.groupBy("label", "score").agg(F.count(F.lit(1)).alias("n"))
    a, b = metrics.binary_scores(df).first(), metrics.binary_scores(weighted, weight="n").first()
    assert a.asDict() == pytest.approx(b.asDict())


# --- outputs --------------------------------------------------------------------------
def test_threshold_is_inclusive_and_guarded(spark):
    raw = spark.createDataFrame([(1, 0.5), (2, 0.49)], "id int, p double")
    assert values(output.format_predictions(raw, "0/1"), "p") == [(1,), (0,)]
    assert values(output.format_predictions(raw, "true/false"), "p") == [(True,), (False,)]
    for bad in ([(1, 1.5), (2, 0.2)], [(1, None), (2, 0.2)], [(1, float("nan")), (2, 0.2)]):
        df = spark.createDataFrame(bad, "id int, p double")
        assert output.format_predictions(df, "0/1").schema["p"].dataType.simpleString() == "double"
    ints = spark.createDataFrame([(1, 1)], "id int, p int")
    assert values(output.format_predictions(ints, "true/false"), "p") == [(1,)]


def test_class_outputs(spark, caplog):
    raw = spark.createDataFrame([(1, 0.4, 0.4, 0.2), (2, 0.1, 0.2, 0.7)], "id int, class_0 double, class_1 double, class_2 double")
    got = output.format_predictions(raw, "multiclass_class", ["row", "y"], "t", ["x", "y", "z"])
    assert got.columns == ["row", "y"] and values(got, "y") == [("x",), ("z",)]
    assert output.format_predictions(raw, "multiclass_class", None, "t", ["x", "y", "z"]).columns == ["id", "t"]
    with caplog.at_level(logging.WARNING):
        out = output.format_predictions(raw, "multiclass_prob", ["row", "a"])
    assert out.columns == ["row", "a", "class_1", "class_2"] and "4 columns" in caplog.text
    with pytest.raises(ValueError, match="unknown kind"):
        output.format_predictions(raw, "x")


# --- sources --------------------------------------------------------------------------
def test_sinks_round_trip(spark, tmp_path):
    base = str(tmp_path)
    assert tables.read_if_present(spark, f"{base}/none.csv") is None
    sinks.write_csv(spark.sql("select 1 as id, 'a' as s"), f"{base}/t.csv")
    assert tables.column_names(spark, f"{base}/t.csv") == ["id", "s"]
    assert tables.read_if_present(spark, f"{base}/t.csv").first().asDict() == {"id": 1, "s": "a"}
    sinks.write_metrics(spark, f"{base}/m", "one", 0.5)
    (tmp_path / "m" / "bad.json").write_text('{"run": "two"}\n{"run": \n')
    got = {r["run"]: (r["cv_score"], r["status"]) for r in sinks.read_metrics(spark, f"{base}/m").collect()}
    assert got["one"] == (0.5, "ok") and got["two"] == (None, "missing_key") and got[None][1] == "malformed"
    sinks.write_params(spark, f"{base}/p", "tree", 0.7, "roc_auc", {"maxDepth": 3})
    assert sinks.read_params(spark, f"{base}/p").first()["best_params"] == {"maxDepth": 3.0}
    assert sinks.read_runs(spark, f"{base}/r").count() == 0
    with pytest.raises(ValueError, match="unknown run columns"):
        sinks.append_runs(spark.sql("select 1 as other"), f"{base}/r")


def test_duplicate_keys_are_found(spark):
    with pytest.raises(ValueError, match="not unique"):
        tables.assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), F.col("k"))
    tables.assert_unique(spark.range(10), F.col("id"))


def test_registry_imports_without_a_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 90"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=str(evaluate.__file__).rsplit("/foldwise/", 1)[0])
