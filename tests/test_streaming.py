import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from heliotab.jobs import stream as job
from heliotab.plans import queries, telemetry, training
from heliotab.schemas import MODEL_COLUMNS, SENSOR_READING
from heliotab.sources import testbed, topic, wire
from heliotab.streaming import sinks, streams
from heliotab.workspace import stored

FIELDS = [f.name for f in SENSOR_READING.fields]


@pytest.fixture(scope="module")
def topic_dir(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("topic"))
    readings = telemetry.project_raw(testbed.readings(spark, sf_dir))
    wire.encode(readings).repartition(5).write.mode("overwrite").parquet(path)
    return path


@pytest.fixture(scope="module")
def batch_rows(spark, topic_dir):
    messages = spark.read.parquet(topic_dir)
    return _rows(telemetry.enrich(wire.decode(messages)))


def _rows(df):
    columns = [*FIELDS, "habitability_score", "habitability_class", "alerts"]
    return Counter(map(str, df.select(*columns).collect()))


def _stream(spark, topic_dir, max_files=2):
    return streams.enriched_stream(streams.replay(spark, topic_dir, max_files), stamp=False)


def test_stream_equals_batch(spark, topic_dir, batch_rows, tmp_path):
    stream = streams.enriched_stream(streams.replay(spark, topic_dir, max_files=2))
    query = streams.append_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/cp", "enriched", "once")
    streams.await_all(spark, [query])
    assert _rows(spark.read.parquet(f"{tmp_path}/out")) == batch_rows
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3


def test_fan_out_writes_every_sink_once(spark, topic_dir, batch_rows, tmp_path):
    named = {
        "raw": sinks.raw_sink(f"{tmp_path}/raw"),
        "processed": sinks.parquet_sink(f"{tmp_path}/processed"),
        "documents": sinks.document_sink(f"{tmp_path}/documents"),
        "snapshots": sinks.snapshot_sink(f"{tmp_path}/snapshots"),
    }
    stream = _stream(spark, topic_dir)
    streams.await_all(spark, [streams.to_sinks(stream, named, f"{tmp_path}/cp", interval="once")])
    assert _rows(spark.read.parquet(f"{tmp_path}/processed")) == batch_rows
    raw = spark.read.parquet(f"{tmp_path}/raw")
    assert set(raw.columns) == {*FIELDS, "batch", "run"} and raw.count() == batch_rows.total()
    times = spark.read.parquet(f"{tmp_path}/processed").groupBy("batch").agg(
        F.countDistinct("processed_at").alias("n"), F.count("processed_at").alias("known")
    )
    assert all(r.n == 1 and r.known > 0 for r in times.collect())
    documents = spark.read.json(f"{tmp_path}/documents")
    assert documents.count() == batch_rows.total()
    assert documents.select("_batch_id").distinct().count() == 3
    assert documents.filter("_batch_id <> batch OR _inserted_at IS NULL").count() == 0
    for name in ("raw", "processed"):
        snapshots = spark.read.option("header", True).csv(f"{tmp_path}/snapshots/{name}")
        assert snapshots.count() == batch_rows.total()
        assert snapshots.select("epoch").distinct().count() == 3


def test_failed_batch_is_repeated_without_duplicates(spark, topic_dir, batch_rows, tmp_path):
    """A sink fails in the second batch after another sink has written it; the restart repairs."""
    broken = {"now": True}

    def unreliable(batch, batch_id):
        if batch_id == 1 and broken["now"]:
            raise RuntimeError("store is down")
        sinks.parquet_sink(f"{tmp_path}/second")(batch, batch_id)

    named = {"first": sinks.parquet_sink(f"{tmp_path}/first"), "second": unreliable}

    def run():
        query = streams.to_sinks(_stream(spark, topic_dir), named, f"{tmp_path}/cp", interval="once")
        streams.await_all(spark, [query])

    with pytest.raises(Exception, match="store is down"):
        run()
    broken["now"] = False
    run()
    for name in ("first", "second"):
        assert _rows(spark.read.parquet(f"{tmp_path}/{name}")) == batch_rows


def test_new_checkpoint_keeps_earlier_output(spark, topic_dir, batch_rows, tmp_path):
    named = {
        "out": sinks.parquet_sink(f"{tmp_path}/out"),
        "documents": sinks.document_sink(f"{tmp_path}/documents"),
        "snapshots": sinks.snapshot_sink(f"{tmp_path}/snapshots"),
    }
    for checkpoint in ("one", "two"):
        query = streams.to_sinks(_stream(spark, topic_dir), named, f"{tmp_path}/{checkpoint}", interval="once")
        streams.await_all(spark, [query])
    out = spark.read.parquet(f"{tmp_path}/out")
    assert _rows(out) == batch_rows + batch_rows
    assert out.select("run").distinct().count() == 2 and out.filter("run = 'none'").count() == 0
    assert spark.read.json(f"{tmp_path}/documents").count() == 2 * batch_rows.total()
    snapshots = spark.read.option("header", True).csv(f"{tmp_path}/snapshots/raw")
    assert snapshots.count() == 2 * batch_rows.total()


def test_backlog_is_worked_off_in_bounded_batches(spark, topic_dir, batch_rows, tmp_path):
    """As the job reads it: more files than one batch may hold."""
    options = job.parse(
        ["--replay", topic_dir, "--checkpoint", f"{tmp_path}/cp", "--interval", "once", "--max-files", "1",
         "--processed", f"{tmp_path}/out"]
    )
    job.run(spark, streams.replay(spark, options.replay, options.max_files), options)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert _rows(out) == batch_rows and out.select("batch").distinct().count() == 5
    assert streams.MAX_FILES > 0 and topic.source_options("h", "t")["maxOffsetsPerTrigger"] == str(topic.MAX_OFFSETS)


def test_restart_reads_only_new_messages(spark, topic_dir, batch_rows, tmp_path):
    source, named = f"{tmp_path}/topic", {"out": sinks.parquet_sink(f"{tmp_path}/out")}
    messages = spark.read.parquet(topic_dir)
    for part in ("key < 'm'", "key >= 'm'", "false"):
        messages.filter(part).write.mode("append").parquet(source)
        query = streams.to_sinks(_stream(spark, source), named, f"{tmp_path}/cp", interval="once")
        streams.await_all(spark, [query])
    assert _rows(spark.read.parquet(f"{tmp_path}/out")) == batch_rows


def test_separate_queries(spark, topic_dir, batch_rows, tmp_path):
    named = {n: sinks.parquet_sink(f"{tmp_path}/{n}") for n in ("a", "b")}
    queries = streams.to_separate_queries(_stream(spark, topic_dir), named, f"{tmp_path}/cp", "once")
    streams.await_all(spark, queries)
    for name in named:
        assert _rows(spark.read.parquet(f"{tmp_path}/{name}")) == batch_rows


def test_timed_trigger_and_console(spark, topic_dir, tmp_path, capsys):
    stream = _stream(spark, topic_dir, max_files=None)
    named = {"console": sinks.console_sink(rows=3)}
    query = streams.to_sinks(stream, named, f"{tmp_path}/cp", "console", "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert query.name == "console"
    shown = capsys.readouterr().out
    assert "ml_prediction" in shown and "only showing top 3 rows" in shown


def test_empty_batches_write_nothing(spark, tmp_path):
    def refuse(batch, batch_id):
        raise AssertionError("an empty batch must not reach a sink")

    sinks.fan_out({"x": refuse})(spark.createDataFrame([], "a int"), 0)


def test_documents_leave_model_columns_out(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2.0, 3.0)], "tick int, prediction double, label_index double")
    sinks.document_sink(str(tmp_path))(frame, 4)
    document = spark.read.json(f"{tmp_path}/run=none/batch=4").first().asDict()
    assert document["_batch_id"] == 4 and not set(document) & set(MODEL_COLUMNS)


def test_stars_join_on_a_stream(spark, topic_dir, tmp_path):
    readings = wire.decode(streams.replay(spark, topic_dir))
    stream = telemetry.with_stellar_physics(spark, readings).select("planet_name", "tick", "flux_now")
    query = streams.append_parquet(stream, f"{tmp_path}/o", f"{tmp_path}/c", interval="once")
    streams.await_all(spark, [query])
    still = telemetry.with_stellar_physics(spark, wire.decode(spark.read.parquet(topic_dir)))
    total = F.round(F.sum("flux_now"), 3)
    assert spark.read.parquet(f"{tmp_path}/o").agg(total).first() == still.agg(total).first()


def _files(folder, ending):
    return [f for _, _, names in os.walk(folder) for f in names if f.endswith(ending)]


def test_text_outputs_are_compressed(spark, topic_dir, tmp_path):
    """Field names repeat in every document: uncompressed output took 945 bytes a reading."""
    named = {"documents": sinks.document_sink(f"{tmp_path}/documents"), "snapshots": sinks.snapshot_sink(f"{tmp_path}/snapshots")}
    streams.await_all(spark, [streams.to_sinks(_stream(spark, topic_dir), named, f"{tmp_path}/cp", interval="once")])
    assert _files(f"{tmp_path}/documents", ".json.gz") and not _files(f"{tmp_path}/documents", ".json")
    assert _files(f"{tmp_path}/snapshots", ".csv.gz") and not _files(f"{tmp_path}/snapshots", ".csv")


def test_single_sink_stores_no_batch(spark, topic_dir, batch_rows, tmp_path, monkeypatch):
    """A batch for one sink is computed while it is written; an empty one leaves no folder."""
    def no_persist(*_):
        raise AssertionError("the batch was stored")

    monkeypatch.setattr(type(spark.range(1)), "persist", no_persist)
    stream = _stream(spark, topic_dir)
    for name, part in (("all", stream), ("none", stream.filter("tick < 0"))):
        named = {"out": sinks.parquet_sink(f"{tmp_path}/{name}")}
        query = streams.to_sinks(part, named, f"{tmp_path}/cp-{name}", interval="once")
        streams.await_all(spark, [query])
        assert sum(p["numInputRows"] for p in query.recentProgress) == batch_rows.total()
    assert _rows(spark.read.parquet(f"{tmp_path}/all")) == batch_rows
    assert not _files(f"{tmp_path}/none", ".parquet")


def test_publication_is_one_batch_of_many_files(spark, sf_dir, tmp_path):
    """Written and read by several tasks, also where a publication has fewer rows than files."""
    messages = wire.encode(testbed.readings(spark, sf_dir).select("planet_name", "tick")).persist()
    files, topic = queries._files_per_batch(spark), f"{tmp_path}/topic"
    for part in (messages.repartition(3), messages.filter("false"), messages.limit(1), messages.repartition(2 * files)):
        queries._append_batch(part, topic)
    assert len(_files(topic, ".parquet")) == 4 * files > 4
    stream = _stream(spark, topic, files)
    streams.await_all(spark, [streams.to_sinks(stream, {"out": sinks.parquet_sink(f"{tmp_path}/out")}, f"{tmp_path}/cp", interval="once")])
    got = {r["batch"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/out").groupBy("batch").count().collect()}
    n = messages.count()
    assert got == {0: n, 2: 1, 3: n}


def test_topic_of_one_publication_fits_one_batch(spark, sf_dir, monkeypatch):
    """Whatever the number of tasks: documents carry the number of their batch."""
    readings = testbed.readings(spark, sf_dir)
    monkeypatch.setattr(testbed, "readings", lambda *_: readings.repartition(streams.MAX_FILES + 6))
    assert 1 < len(_files(queries._published(spark, sf_dir), ".parquet")) <= streams.MAX_FILES


def test_fields_that_are_not_read_change_no_result(spark, topic_dir):
    """F8 F22 F24: the named fields are all that the results are made of, and only they are read."""
    messages = spark.read.parquet(topic_dir)
    model = training.fit(stored(testbed.planets(spark, "/root/testdata/sf0.01"), "planets"), training.forest(numTrees=2, maxDepth=4))

    def predicted(readings):
        return telemetry.with_model(telemetry.assess(readings, True), model).select("habitability_score", "alerts", "ml_predicted_label")

    uses = [
        (telemetry.CONSOLE_FIELDS, lambda r: telemetry.project_console(telemetry.with_model(telemetry.assess(r, True), None))),
        ([*telemetry.ASSESSED_FIELDS, *telemetry.MODEL_FIELDS], predicted),
        (telemetry.STELLAR_FIELDS, lambda r: telemetry.with_stellar_physics(spark, r).select("flux_now", "radiation_now", "locked_now")),
    ]
    for fields, use in uses:
        part = wire.decode(messages, only=fields)
        assert part.columns == FIELDS and Counter(map(str, use(part).collect())) == Counter(map(str, use(wire.decode(messages)).collect()))
        assert part.drop(*fields).dropna("all").isEmpty()


def test_damage_outside_of_the_read_fields(spark):
    """F8 F22 F24: a broken message stays all NULL, whatever is read of it."""
    values = ['{"tick":3,"source":"a"}', '{"tick":3,"source":"a', '{"tick":"x","source":"a"}', None, "[]"]
    messages = spark.createDataFrame([(v,) for v in values], "value string")
    assert [r.tick for r in wire.decode(messages, only=["tick"]).collect()] == [r.tick for r in wire.decode(messages).collect()]
    assert [r.source for r in wire.decode(messages, only=["tick"]).collect()] == [None] * 5


def test_readings_of_a_raw_sink_are_a_stream(spark, topic_dir, batch_rows, tmp_path):
    """what the raw sink has committed is enriched once, also what comes later, and not decoded again."""
    for again in (False, True):
        raw = streams.append_parquet(wire.decode(streams.replay(spark, topic_dir, 2)), f"{tmp_path}/raw", f"{tmp_path}/raw-cp", interval="once")
        streams.await_all(spark, [raw])
        readings = streams.sunk_readings(spark, f"{tmp_path}/raw", 2)
        query = streams.append_parquet(streams.enriched_readings(readings), f"{tmp_path}/out", f"{tmp_path}/cp", interval="once")
        streams.await_all(spark, [query])
        assert _rows(spark.read.parquet(f"{tmp_path}/out")) == batch_rows
        assert "from_json" not in readings._jdf.queryExecution().logical().toString()


def test_messages_are_decoded_for_one_of_three_sinks(spark, sf_dir, monkeypatch):
    """the two processed sinks of the query start from the readings of the raw one."""
    decoded, usual = [], wire.decode
    monkeypatch.setattr(wire, "decode", lambda *args, **kw: decoded.append(1) or usual(*args, **kw))
    sinks_of = queries.stream_parquet_append(spark, sf_dir).groupBy("sink").count().collect()
    assert len(decoded) == 1 and len(sinks_of) == 3 and len({r["count"] for r in sinks_of}) == 1


def test_topic_files_keep_no_dictionary_of_messages(spark, sf_dir, tmp_path):
    parquet = pytest.importorskip("pyarrow.parquet")
    messages = spark.range(2000).selectExpr("'p' AS key", "concat('{\"tick\":', id, '}') AS value")
    queries._append_messages(messages.coalesce(1), str(tmp_path / "topic"))
    (file,) = (tmp_path / "topic").glob("*.parquet")
    columns = parquet.ParquetFile(file).metadata.row_group(0)
    assert columns.column(0).has_dictionary_page and not columns.column(1).has_dictionary_page


def test_several_sinks_hold_no_batch_in_memory(spark, topic_dir, batch_rows, tmp_path, monkeypatch):
    """the others read what the first parquet sink wrote, or a stored table that is gone afterwards."""
    def no_persist(*_):
        raise AssertionError("the batch was held")

    monkeypatch.setattr(type(spark.range(1)), "persist", no_persist)
    made = []
    monkeypatch.setattr(sinks, "work_dir", lambda *_: made.append(f"{tmp_path}/stored-{len(made)}") or made[-1])
    table = {"raw": sinks.raw_sink(f"{tmp_path}/raw"), "processed": sinks.parquet_sink(f"{tmp_path}/processed")}
    text = {n: sinks.document_sink(f"{tmp_path}/{n}") for n in ("documents", "copies")}
    for name, named in (("one", table | text), ("two", text)):
        stream = _stream(spark, topic_dir)
        streams.await_all(spark, [streams.to_sinks(stream, named, f"{tmp_path}/cp-{name}", interval="once")])
        assert len(made) == (0 if name == "one" else 3) and not any(map(os.path.exists, made))
    processed = spark.read.parquet(f"{tmp_path}/processed")
    assert _rows(processed) == batch_rows
    assert Counter(map(str, spark.read.parquet(f"{tmp_path}/raw").select(*FIELDS).collect())) == Counter(
        map(str, processed.select(*FIELDS).collect()))
    for name in text:
        assert _rows(spark.read.schema(processed.schema).json(f"{tmp_path}/{name}")) == batch_rows + batch_rows


def test_snapshots_are_made_in_one_pass(spark, tmp_path, monkeypatch):
    """the lines of plain CSV files, every file with its header, from a batch that is computed once."""
    names = ['a,"b"', "", " x ", "#c", "d\\", None, "é", "tab\t"]
    values = [{"planet_name": n, "tick": i, "mass_earth": [1.5, -0.0, 1e-9, None][i % 4]} for i, n in enumerate(names * 3)]
    readings = spark.createDataFrame(values, SENSOR_READING).coalesce(2)
    computed = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    batch = telemetry.assess(readings.mapInArrow(seen, SENSOR_READING), True)
    monkeypatch.setitem(sinks.TEXT, "maxRecordsPerFile", 5)
    sinks.fan_out({"snapshots": sinks.snapshot_sink(f"{tmp_path}/s")})(batch, 7)
    assert computed.value == len(values)
    columns = {"raw": FIELDS, "processed": [*FIELDS, "habitability_score", "habitability_class", "alerts"]}
    for name, fields in columns.items():
        batch.select(*fields).write.csv(f"{tmp_path}/plain-{name}", header=True)
        header, *lines = (r.value for r in spark.read.text(f"{tmp_path}/plain-{name}").collect())
        expected = Counter(line for line in lines if line != header)
        folder = f"{tmp_path}/s/{name}/run=none/epoch=7"
        files = _files(folder, ".csv.gz")
        texts = [[r.value for r in spark.read.text(f"{folder}/{f}").collect()] for f in files]
        assert len(files) >= 6 and all(t[0] == header and len(t) <= 6 for t in texts)
        assert sum((Counter(t[1:]) for t in texts), Counter()) == expected and expected.total() == len(values)
    sinks.fan_out({"snapshots": sinks.snapshot_sink(f"{tmp_path}/s")})(batch.limit(3), 7)
    assert spark.read.csv(f"{tmp_path}/s/raw/run=none/epoch=7", header=True).count() == 3  # a repeated batch replaces
    assert os.listdir(f"{tmp_path}/s") and not [d for d in os.listdir(f"{tmp_path}/s") if d.startswith("_")]


def test_topic_goes_as_it_is_read(spark, topic_dir, batch_rows, tmp_path):
    """files of earlier batches are deleted while later ones are read; nothing is lost."""
    spark.read.parquet(topic_dir).repartition(5).write.parquet(f"{tmp_path}/topic")
    messages = streams.replay(spark, f"{tmp_path}/topic", 1, spend=True)
    query = streams.append_parquet(streams.enriched_stream(messages), f"{tmp_path}/out", f"{tmp_path}/cp", interval="once")
    streams.await_all(spark, [query])
    assert _rows(spark.read.parquet(f"{tmp_path}/out")) == batch_rows
    assert len(_files(f"{tmp_path}/topic", ".parquet")) < 5


def test_appended_readings_are_all_that_stays(spark, sf_dir, tmp_path, monkeypatch):
    """the topic is deleted after the raw sink, the sinks' files are zstd, and the setting for shuffles is as before."""
    monkeypatch.setattr(queries, "work_dir", lambda _, purpose: f"{tmp_path}/{purpose}")
    counts = {r["sink"]: r["count"] for r in queries.stream_parquet_append(spark, sf_dir).groupBy("sink").count().collect()}
    n = testbed.readings(spark, sf_dir).count()
    assert counts == {"raw": n, "processed_a": n, "processed_b": n}
    assert not os.path.exists(f"{tmp_path}/topic") and spark.conf.get(queries.SPENT_SHUFFLES) == "false"
    assert all(f.endswith(".zstd.parquet") for f in _files(f"{tmp_path}/appended", ".parquet"))
