"""The jobs end to end: catalogue, training, and the stream that applies the model."""

import pytest
from pyspark.sql import functions as F

from heliotab import vocab
from heliotab.jobs import build_catalog, stream, train
from heliotab.plans import catalog, telemetry, training
from heliotab.schemas import BATCH_RESULT, PLANETS
from heliotab.sources import terms, testbed, wire
from heliotab.streaming import streams

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def workplace(spark, tmp_path_factory):
    """Nested systems in the existing wording, and the tables built from them."""
    root = str(tmp_path_factory.mktemp("jobs"))
    raw = terms.to_wording(testbed.planets_raw(spark, SF_DIR).drop("planet_id", "system_id"))
    nested = catalog.nest(raw, ["system_name", "star_type", "star_age_gy"], F.lit(0))
    nested.write.json(f"{root}/systems.json")
    build_catalog.run(spark, f"{root}/systems.json", f"{root}/tables", wording=True)
    return root


def test_catalogue_equals_the_query(spark, workplace):
    names = [f.name for f in PLANETS.fields]
    expected = terms.to_wording(testbed.planets(spark, SF_DIR).select(*names))
    built = catalog.read_planets_csv(spark, f"{workplace}/tables/planets")
    assert sorted(map(str, built.collect())) == sorted(map(str, expected.collect()))
    stars = spark.read.option("header", True).csv(f"{workplace}/tables/star_systems")
    assert stars.count() == 100
    assert {r.star_type for r in stars.collect()} < set(vocab.STAR_TYPES.values())
    listed = spark.read.option("header", True).csv(f"{workplace}/tables/reports/candidates")
    assert listed.count() == expected.filter("habitable_candidate_int = 1").count() > 20


@pytest.fixture(scope="module")
def trained(spark, workplace):
    planets = terms.to_codes(catalog.read_planets_csv(spark, f"{workplace}/tables/planets"))
    classifier = training.forest()
    grid = [{classifier.numTrees: 5, classifier.maxDepth: 4}]
    results = [f"{workplace}/result{i}" for i in range(2)]
    models = [f"{workplace}/model{i}" for i in range(2)]
    train.run(spark, planets, results, models, grid, classifier, folds=2)
    return results, models


def test_training_writes_results_and_models(spark, trained):
    results, models = trained
    first, second = (spark.read.parquet(path) for path in results)
    assert first.columns == BATCH_RESULT and first.count() == 2000
    assert first.exceptAll(second).count() == 0
    assert all(training.load_model(spark, path) is not None for path in models)


def test_stream_job_applies_the_model(spark, workplace, trained, sf_dir):
    _, models = trained
    topic = f"{workplace}/topic"
    readings = terms.to_wording(telemetry.project_raw(testbed.readings(spark, sf_dir)))
    wire.encode(readings).write.parquet(topic)
    out = f"{workplace}/out"
    options = stream.parse(
        f"--replay {topic} --checkpoint {out}/cp --interval once --wording --raw {out}/raw"
        f" --processed {out}/a --processed {out}/b --documents {out}/docs --snapshots {out}/epochs"
        f" --model {out}/missing --model {models[1]}".split()
    )
    stream.run(spark, streams.replay(spark, topic), options)
    processed = spark.read.parquet(f"{out}/a")
    assert processed.count() == readings.count() == spark.read.parquet(f"{out}/b").count()
    classes = {r[0] for r in processed.select("habitability_class").distinct().collect()}
    assert classes <= set(vocab.SCORE_CLASSES.values())
    labels = {r[0] for r in processed.select("ml_predicted_label").distinct().collect()}
    assert labels <= {*vocab.LABELS.values(), vocab.UNKNOWN} and "probability" in processed.columns
    assert "probability" not in spark.read.json(f"{out}/docs").columns
    raw = spark.read.parquet(f"{out}/raw").drop("run", "batch")
    assert raw.exceptAll(readings.select(*raw.columns)).count() == 0
