import re

import duckdb
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from heliotab.plans import queries, reports, search, telemetry, training, trees
from heliotab.schemas import NUMERIC_FEATURES
from heliotab.sources import testbed
from heliotab.workspace import stored

SF_DIR = "/root/testdata/sf0.01"  # smaller tables have no habitable planet


@pytest.fixture(scope="module")
def planets(spark):
    return stored(training.labelled(testbed.planets(spark, SF_DIR)), "training-test")


@pytest.fixture(scope="module")
def model(planets):
    return training.build_pipeline(training.forest(numTrees=10, maxDepth=5)).fit(planets)


def test_metrics_equal_the_evaluator(model, planets):
    scored = training.score(model, planets)
    ours = reports.classification_metrics(scored, "label", "predicted_label").first()
    names = {
        "accuracy": "accuracy",
        "weightedPrecision": "weighted_precision",
        "weightedRecall": "weighted_recall",
        "f1": "f1",
    }
    for theirs, name in names.items():
        evaluator = MulticlassClassificationEvaluator(labelCol="label_index", metricName=theirs)
        assert ours[name] == pytest.approx(evaluator.evaluate(scored), abs=1e-12)
    assert ours.n_rows == planets.count() and ours.accuracy > 0.8


def test_metrics_without_rows(planets):
    none = planets.filter("false").withColumn("predicted_label", F.col("label"))
    assert reports.classification_metrics(none, "label", "predicted_label").first().accuracy == 0.0


def test_pipeline_order(model):
    assert len(model.stages) == 8
    assert isinstance(model.stages[2], StringIndexerModel)
    assert training.label_order(model) == ["non_habitable", "uncertain", "habitable"]


def test_fitting_is_repeatable(model, planets):
    again = training.build_pipeline(training.forest(numTrees=10, maxDepth=5)).fit(planets)
    left, right = (training.score(m, planets).select("name", "prediction") for m in (model, again))
    assert left.exceptAll(right).count() == 0


def test_saved_model_predicts_the_same(spark, model, planets, tmp_path):
    paths = [f"{tmp_path}/a", f"{tmp_path}/b"]
    training.save_model(model, *paths)
    training.save_model(model, *paths)  # overwrites
    loaded = training.load_model(spark, f"{tmp_path}/missing", paths[1])
    left, right = (training.score(m, planets).select("name", "predicted_label") for m in (model, loaded))
    assert left.exceptAll(right).count() == 0
    assert training.load_model(spark, f"{tmp_path}/x", f"{tmp_path}/y") is None


def test_unseen_categories_and_gaps(model, planets):
    odd = planets.limit(5).withColumn("star_type", F.lit("quasar")).withColumn(
        "atmosphere_o2", F.lit(None).cast("double")
    )
    labels = {r.predicted_label for r in training.score(model, odd).collect()}
    assert labels <= {"habitable", "uncertain", "non_habitable", "unknown"}


def test_readings_have_no_label_column(spark, model, sf_dir):
    readings = testbed.readings(spark, sf_dir).drop("label")
    predicted = telemetry.with_model(telemetry.enrich(readings), model)
    assert predicted.filter("ml_predicted_label IS NULL").count() == 0


def test_grid_and_folds(planets):
    assert len(training.full_grid(training.forest())) == 18
    marked = training.with_split(planets)
    share = marked.filter("split = 'train'").count() / planets.count()
    assert share == pytest.approx(training.TRAIN_SHARE, abs=0.03)
    moved = training.with_split(planets.repartition(7))
    assert marked.select("name", "split").exceptAll(moved.select("name", "split")).count() == 0
    train, test = training.train_test(planets)
    assert train.count() + test.count() == planets.count()
    assert train.join(test, "name").count() == 0
    left, right = training.random_train_test(planets)
    assert left.count() + right.count() == planets.count()


@pytest.fixture(scope="module")
def found(planets):
    classifier = training.forest(bootstrap=False)
    grid = [{classifier.numTrees: 1, classifier.maxDepth: depth} for depth in (2, 6, 5)]
    return search.run(planets, classifier, grid, folds=3)


def test_search_equals_cross_validation(spark, planets, found):
    """Features fitted once per fold and shared give the accuracies of a fit per setting."""
    classifier = training.forest(bootstrap=False)
    usual = CrossValidator(
        estimator=training.build_pipeline(classifier),
        estimatorParamMaps=[{classifier.numTrees: 1, classifier.maxDepth: depth} for depth in (2, 6, 5)],
        evaluator=MulticlassClassificationEvaluator(labelCol="label_index", metricName="accuracy"),
        numFolds=3, foldCol="fold", parallelism=3,
    ).fit(stored(training.with_folds(planets, 3), "folds"))
    ours = {r.setting: r.accuracy for r in search.averages(found.counts).collect()}
    assert [ours[i] for i in range(3)] == pytest.approx(list(usual.avgMetrics), abs=1e-12)
    best = training.forest_of(usual.bestModel)
    row = search.best_params(found).first()
    assert (row.num_trees, row.max_depth, row.min_instances) == (1, best.getMaxDepth(), 1) and row.max_depth in (5, 6)
    assert row.accuracy == max(usual.avgMetrics) and ours[0] < row.accuracy
    left, right = (training.score(m, planets).select("name", "predicted_label") for m in (found.best, usual.bestModel))
    assert left.exceptAll(right).count() == 0


def test_sql_over_the_predictions_gives_averages_and_winner(spark, planets, found, tmp_path):
    found.counts.coalesce(1).write.parquet(f"{tmp_path}/counts")
    rows = duckdb.sql(f"""
        SELECT setting, avg(accuracy) AS accuracy FROM (
         SELECT setting, fold, sum(CASE WHEN label = predicted THEN n ELSE 0 END) / sum(n) AS accuracy
         FROM '{tmp_path}/counts/*.parquet' GROUP BY setting, fold) GROUP BY setting ORDER BY accuracy DESC, setting""").fetchall()
    ours = search.report(found).orderBy("place").collect()
    assert [r[0] for r in rows] == [r.setting for r in ours] and found.best_setting == rows[0][0]
    assert [r[1] for r in rows] == pytest.approx([r.accuracy for r in ours], abs=1e-12)
    assert [r.params for r in found.settings.orderBy("setting").collect()] == [f"maxDepth={d}, numTrees=1" for d in (2, 6, 5)]
    # Every labelled row is held out once for each setting, in its own fold.
    per_fold = training.with_folds(planets, 3).groupBy("fold", "label").count()
    held_out = found.counts.groupBy("setting", "fold", "label").agg(F.sum("n").alias("count"))
    for setting in range(3):
        assert held_out.where(F.col("setting") == setting).drop("setting").exceptAll(per_fold).count() == 0


def test_equal_averages_go_to_the_first_setting(spark):
    rows = [(s, f, "a", p, n) for s in (0, 1, 2) for f in (0, 1) for p, n in (("a", 3), ("b", 1 if s else 2))]
    ranked = search.ranking(spark.createDataFrame(rows, search.COUNTS)).orderBy("place").collect()
    assert [(r.setting, round(r.accuracy, 9)) for r in ranked] == [(1, 0.75), (2, 0.75), (0, 0.6)]


def test_importance_names(model, planets):
    ranked = training.feature_importance(model, planets, threshold=-1.0).collect()
    names = [r.feature for r in ranked]
    assert len(names) == 14 + len(NUMERIC_FEATURES) and names[-15:] == NUMERIC_FEATURES
    assert sum(r.importance for r in ranked) == pytest.approx(1.0)
    kept = training.feature_importance(model, planets).collect()
    assert 0 < len(kept) < len(ranked) and all(r.importance > 0.01 for r in kept)


def test_importances_of_the_node_table(spark, model, planets):
    nodes = trees.node_table(spark, training.forest_of(model))
    ours = {r.feature: r.importance for r in trees.importances(nodes).collect()}
    theirs = training.forest_of(model).featureImportances.toArray().tolist()
    assert [ours.get(i, 0.0) for i in range(len(theirs))] == pytest.approx(theirs, abs=1e-12)
    forest = training.forest_of(model)
    assert nodes.count() == forest.totalNumNodes and nodes.select("tree").distinct().count() == forest.getNumTrees
    inner = nodes.where("feature IS NOT NULL")
    assert inner.where("left IS NULL OR right IS NULL OR gain <= 0").count() == 0
    children = inner.select("tree", F.explode(F.array("left", "right")).alias("node")).join(nodes, ["tree", "node"])
    assert children.count() == nodes.where("node > 0").count()


def test_importances_without_a_split(spark):
    nodes = spark.createDataFrame([(0, 0, None, 5.0, None)], "tree int, node int, feature int, rows double, gain double")
    assert trees.importances(nodes).count() == 0
    more = [(0, 0, 3, 8.0, 0.25), (0, 1, 4, 4.0, 0.5), (1, 0, None, 8.0, None), (2, 0, 4, 8.0, 0.5)]
    nodes = spark.createDataFrame(more, "tree int, node int, feature int, rows double, gain double")
    assert {r.feature: r.importance for r in trees.importances(nodes).collect()} == {3: 0.25, 4: 0.75}


def test_fit_deals_rows_to_bounded_partitions(planets, monkeypatch):
    """What a task holds does not grow with the table, and files and cores do not change the forest."""
    monkeypatch.setattr(training, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(training, "FEW_TASKS", 1)
    n = planets.count()
    one, many = (training.spread(planets.repartition(k)) for k in (1, 5))
    parts = one.rdd.glom().map(lambda rows: [r.name for r in rows]).collect()
    assert len(parts) == -(-n // 50) > 1 and sum(map(len, parts)) == n and max(map(len, parts)) < 100
    assert parts == many.rdd.glom().map(lambda rows: [r.name for r in rows]).collect()
    small = training.forest(numTrees=3, maxDepth=3)
    # Means of the scaler are added up in another order: thresholds agree but for their last digits.
    forests = [training.forest_of(training.fit(planets.repartition(k), small)).toDebugString.split("\n", 1)[1] for k in (1, 5)]
    left, right = (re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m[0]):.6f}", f) for f in forests)
    assert left == right


def test_best_params_searches_the_whole_grid_over_five_folds(spark, monkeypatch):
    def stop(rows, classifier=None, grid=None, folds=5, **_):
        assert classifier is None and grid is None and rows.count() > 0
        raise RuntimeError(f"{folds} folds")

    monkeypatch.setattr(search, "run", stop)
    with pytest.raises(RuntimeError, match="^5 folds$"):
        queries.best_params(spark, SF_DIR)


def test_search_fits_one_forest_for_settings_of_other_sizes(planets, monkeypatch):
    """all 18 settings are tried on every fold, from two forests a fold and not from eighteen."""
    fitted, usual = [], RandomForestClassifier.fit

    def counted(self, rows, params=None):
        fitted.append((self.getNumTrees(), self.getMaxDepth(), self.getMinInstancesPerNode()))
        return usual(self, rows, params)

    monkeypatch.setattr(RandomForestClassifier, "fit", counted)
    classifier = training.forest()
    sizes = [(n, d, m) for n in (2, 3, 5) for d in (2, 3, 4) for m in (1, 2)]
    grid = [dict(zip((classifier.numTrees, classifier.maxDepth, classifier.minInstancesPerNode), s, strict=True)) for s in sizes]
    found = search.run(planets, classifier, grid, folds=2)
    assert sorted(fitted[:-1]) == [(5, 4, 1)] * 2 + [(5, 4, 2)] * 2
    held_out = found.counts.groupBy("setting").agg(F.sum("n").alias("n")).collect()
    assert [r.setting for r in sorted(held_out)] == list(range(18)) and {r.n for r in held_out} == {planets.count()}
    assert search.report(found).count() == 18
    single = [{classifier.numTrees: n} for n in (1, 2, 3)]
    assert [part for _, part in search.families(classifier, single)] == [[0], [1, 2]]


def test_parts_of_a_forest_predict_like_forests(planets):
    """the first trees vote as Spark's trees do, and trees that stop early as trees fitted to that depth."""
    vectors = stored(Pipeline(stages=training.feature_stages()).fit(planets).transform(planets), "vectors")
    whole = training.forest(numTrees=6, maxDepth=5).fit(vectors)
    ours = search.predictions(whole, vectors.select("name", "label", "features"), [(3, 5), (6, 5)]).collect()
    rows = vectors.select("features").collect()
    probabilities = [[np.array(tree.predictProbability(r.features)) for r in rows] for tree in whole.trees]
    for place, n in ((0, 3), (1, 6)):
        theirs = [int(sum(tree[i] for tree in probabilities[:n]).argmax()) for i in range(len(rows))]
        assert sum(a.predicted[place] != b for a, b in zip(ours, theirs, strict=True)) == 0
    assert [r.predicted[1] for r in ours] == [int(r.prediction) for r in whole.transform(vectors).collect()]
    same = dict(bootstrap=False, featureSubsetStrategy="all", numTrees=2)
    deep = training.forest(maxDepth=6, **same).fit(vectors)
    for depth in (1, 3, 6):
        short = training.forest(maxDepth=depth, **same).fit(vectors)
        theirs = [int(r.prediction) for r in short.transform(vectors).collect()]
        assert [r.predicted[0] for r in search.predictions(deep, vectors, [(2, depth)]).collect()] == theirs
        nodes = trees.node_table(vectors.sparkSession, deep).toPandas()
        ends = {(t, e) for t, tree in nodes.sort_values("node").groupby("tree") for e in trees._ends(tree, depth)[tree["left"].isna()]}
        assert len(ends) == sum((tree.numNodes + 1) // 2 for tree in short.trees)


def test_fits_at_a_time_are_bounded_by_what_they_hold(planets, monkeypatch):
    """over a large table fits run one after the other."""
    sizes, usual = [], search.ThreadPool
    monkeypatch.setattr(search, "ThreadPool", lambda processes: sizes.append(processes) or usual(processes))
    monkeypatch.setattr(search, "HELD_WEIGHTS", 2 * 2 * planets.count())
    classifier = training.forest(maxDepth=2)
    for n in (2, 3):
        search.run(planets, classifier, [{classifier.numTrees: n}], folds=2, parallelism=4)
    assert sizes == [2, 1]


def test_best_params_searches_the_labels_of_the_rules(spark, planets, monkeypatch):
    """the labels of the planet table, three of them, and all labelled rows in every fold's search."""
    usual = search.run

    def small(rows, classifier=None, grid=None, folds=5, **_):
        left = rows.groupBy("name", "label").count()
        right = training.labelled(testbed.planets(spark, SF_DIR)).groupBy("name", "label").count()
        assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0
        assert rows.select("label").distinct().count() == 3
        forest = training.forest()
        grid = [{forest.numTrees: n, forest.maxDepth: 4, forest.minInstancesPerNode: 1} for n in (2, 4)]
        return usual(rows, forest, grid, folds)

    monkeypatch.setattr(search, "run", small)
    monkeypatch.setattr(training, "GRID_TREES", [2, 4])
    (row,) = queries.best_params(spark, SF_DIR).collect()
    n = training.labelled(testbed.planets(spark, SF_DIR)).count()
    assert row.asDict() == dict(
        n_settings=2, n_folds=5, n_held_out=n, known_trees=True, known_depth=True, known_instances=True, is_best=True
    )


def test_search_keeps_the_nodes_of_rows(planets, monkeypatch):
    """F4 F5: a level of the trees starts where the last one ended; the trees are the same."""
    kept, usual = [], RandomForestClassifier.fit

    def seen(self, rows, params=None):
        kept.append(self.getCacheNodeIds())
        return usual(self, rows, params)

    vectors = training.spread(stored(Pipeline(stages=training.feature_stages()).fit(planets).transform(planets), "vectors"))
    left, right = (training.forest(numTrees=4, maxDepth=5, cacheNodeIds=c).fit(vectors).toDebugString.split("\n", 1)[1] for c in (True, False))
    assert left == right
    monkeypatch.setattr(RandomForestClassifier, "fit", seen)
    classifier = training.forest(maxDepth=2)
    search.run(planets, classifier, [{classifier.numTrees: 2}], folds=2)
    assert kept == [True, True, False]
