import os

import pytest
from pyspark.sql import functions as F

from heliotab.plans import training
from heliotab.sinks import batch, staged


def read(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).collect())


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


@pytest.fixture
def target(spark, tmp_path):
    path = f"{tmp_path}/result"
    batch.write_parquet(frame(spark, 1, 2), path)
    return path


def beside(target):
    return sorted(os.listdir(os.path.dirname(target)))


def test_a_failed_job_leaves_the_earlier_result(spark, target):
    broken = frame(spark, *range(100)).repartition(4).withColumn("v", F.when(F.col("v") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        batch.write_parquet(broken, target)
    assert read(spark, target) == [1, 2] and beside(target) == ["result"]
    batch.write_parquet(frame(spark, 3), target)
    assert read(spark, target) == [3] and beside(target) == ["result"]


def test_csv_and_first_writes_too(spark, tmp_path):
    path = f"{tmp_path}/new/folder/out"
    batch.write_csv(frame(spark, 5), path)
    assert [r.v for r in spark.read.option("header", True).csv(path).collect()] == ["5"]
    assert not os.path.exists(f"{path}/{staged.DONE}")


@pytest.mark.parametrize("after, want", [(0, [1, 2]), (1, [7])])
def test_a_swap_that_was_cut_off_is_settled(spark, target, monkeypatch, after, want):
    """The process ends before the first or before the second rename."""
    rename, calls = staged._Folder.rename, []

    def cut(self, source, to):
        if len(calls) == after:
            raise KeyboardInterrupt
        calls.append(to)
        rename(self, source, to)

    monkeypatch.setattr(staged._Folder, "rename", cut)
    with pytest.raises(KeyboardInterrupt):
        batch.write_parquet(frame(spark, 7), target)
    monkeypatch.setattr(staged._Folder, "rename", rename)
    assert os.path.exists(target) == (after == 0)
    staged.settle(spark, target)
    assert read(spark, target) == want
    batch.write_parquet(frame(spark, 8), target)
    assert read(spark, target) == [8]


def test_without_a_complete_new_result_the_old_one_comes_back(spark, target):
    os.rename(target, f"{os.path.dirname(target)}/.result.old-x")
    frame(spark, 9).write.parquet(f"{os.path.dirname(target)}/.result.staged-x")  # its job never said that it was done
    staged.settle(spark, target)
    assert read(spark, target) == [1, 2]


def test_models_are_replaced_and_settled(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("a",), ("b",), ("a",)], "kind string")
    first, second = (training.Pipeline(stages=[training.indexer("kind", name)]).fit(rows) for name in ("x", "y"))
    path = f"{tmp_path}/model"
    training.save_model(first, path)
    training.save_model(second, path)
    assert training.load_model(spark, path).stages[0].getOutputCol() == "y"

    class Unwritable:
        def write(self):
            return self

        def save(self, folder):
            raise OSError("disk is full")

    with pytest.raises(OSError, match="disk is full"):
        training.save_model(Unwritable(), path)
    assert training.load_model(spark, path).stages[0].getOutputCol() == "y"
    os.rename(path, f"{tmp_path}/.model.old-1")
    assert training.load_model(spark, path).stages[0].getOutputCol() == "y"
