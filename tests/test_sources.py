import json

import pytest
from pyspark.sql import functions as F

from heliotab import schemas, storage, workspace
from heliotab.plans import catalog, telemetry
from heliotab.sinks import batch
from heliotab.sources import dims, testbed, topic, wire


def _messages(spark, *values):
    return spark.createDataFrame([("k", v) for v in values], "key string, value string")


def test_malformed_messages_are_kept_as_empty_rows(spark):
    whole = {f.name: 1 for f in schemas.SENSOR_READING.fields}
    whole |= {n: "x" for n in ("planet_name", "system_name", "star_type", "planet_type", "timestamp", "source")}
    values = [
        json.dumps(whole), "{ not json", json.dumps(whole)[:200], None, "", "{}",
        json.dumps(whole | {"gravity_g": "heavy"}), json.dumps(whole | {"gravity_g": float("nan")}),
        json.dumps({"planet_name": "only"}), json.dumps(whole | {"extra": 5}),
    ]
    rows = wire.decode(_messages(spark, *values)).collect()
    assert len(rows) == len(values)
    full, empty = rows[0], tuple([None] * 33)
    assert full.gravity_g == 1.0 and full.tick == 1 and full.planet_name == "x"
    for i in (1, 2, 3, 4, 5):
        assert tuple(rows[i]) == empty, i
    for i in (6, 7):
        assert rows[i].gravity_g is None and rows[i].tick == 1
    assert rows[8].planet_name == "only" and rows[8].tick is None
    assert rows[9] == full
    scored = telemetry.enrich(wire.decode(_messages(spark, "broken"))).first()
    assert (scored.habitability_score, scored.habitability_class, scored.alerts) == (
        0.0, "non_habitable", "NOMINAL",
    )


def test_binary_values_decode(spark):
    text = json.dumps({"planet_name": "Zoë", "tick": 3})
    raw = _messages(spark, text).withColumn("value", F.col("value").cast("binary"))
    row = wire.decode(raw).first()
    assert (row.planet_name, row.tick) == ("Zoë", 3)


def test_encoding_keeps_null_fields(spark):
    frame = spark.createDataFrame([("a", None)], "planet_name string, tick int")
    message = wire.encode(frame).first()
    assert message.key == "a" and json.loads(message.value) == {"planet_name": "a", "tick": None}


def test_event_time(spark):
    texts = ["2024-01-01T00:00:07.179575+00:00", "2024-01-01T02:00:00+02:00", "soon", None]
    frame = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    micros = wire.with_event_time(frame).select(F.unix_micros("event_time")).collect()
    assert [r[0] for r in micros] == [1704067207179575, 1704067200000000, None, None]


def test_topic_options():
    assert topic.source_options("host:9092", "sensors") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "sensors",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(topic.MAX_OFFSETS),
    }
    options = topic.source_options("h", "t", "earliest", max_offsets_per_trigger=1000)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "1000"


def test_storage_settings():
    assert storage.object_store_conf_from({}) == {}
    open_store = storage.object_store_conf("http://store:9000")
    assert open_store["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert not any("key" in name for name in open_store)
    env = {"OBJECT_STORE_ENDPOINT": "e", "OBJECT_STORE_ACCESS_KEY": "a", "OBJECT_STORE_SECRET_KEY": "s"}
    assert storage.object_store_conf_from(env)["spark.hadoop.fs.s3a.secret.key"] == "s"


def test_work_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (workspace.work_dir(spark, "x") for _ in range(2))
    assert first.startswith(root) and first != second


def test_local_catalogue_file(spark, tmp_path):
    assert catalog.load_local_planets(spark, str(tmp_path / "absent")).collect() == []
    path = str(tmp_path / "planets.csv")
    rows = [("a", "s", "red_dwarf", "ocean", "1.5", "2", "3", "0.9", "10.5", "true")]
    columns = ("name system_name star_type planet_type distance_au mass_earth radius_km gravity_g "
               "avg_temp_celsius has_water").split()  # fmt: skip
    batch.write_csv(spark.createDataFrame(rows, columns), path)
    planet = catalog.load_local_planets(spark, path).first()
    assert planet.has_water is True and planet.retains_atmosphere is True
    assert (planet.atmosphere_n2, planet.magnetic_field, planet.source) == (0.0, False, "local")
    assert [f.name for f in schemas.SOURCE_PLANETS.fields] == planet.__fields__


def test_inferred_and_explicit_scan_agree(spark, sf_dir, tmp_path):
    path = str(tmp_path / "planets")
    names = [f.name for f in schemas.PLANETS.fields]
    batch.write_csv(testbed.planets(spark, sf_dir).select(*names), path)
    explicit = catalog.read_planets_csv(spark, path)
    inferred = catalog.read_planets_csv(spark, path, infer=True)
    assert explicit.schema == schemas.PLANETS
    assert sorted(map(str, explicit.collect())) == sorted(map(str, inferred.collect()))


def test_sources_can_be_chosen(spark, sf_dir):
    usable = testbed.archive(spark, sf_dir)
    assert catalog.normalize_archive(usable).count() > catalog.ARCHIVE_LIMIT
    archive = catalog.normalize_archive(usable, catalog.ARCHIVE_LIMIT)
    assert archive.count() == catalog.ARCHIVE_LIMIT
    assert archive.schema.simpleString() == schemas.SOURCE_PLANETS.simpleString()
    local = archive.withColumn("source", F.lit("local"))
    both = catalog.union_sources(local, archive, "both")
    assert both.count() == 2 * catalog.ARCHIVE_LIMIT
    assert catalog.union_sources(local, archive, "local").select("source").distinct().count() == 1
    assert catalog.union_sources(local, archive, "nasa").first().source == "nasa"
    with pytest.raises(ValueError):
        catalog.union_sources(local, archive, "elsewhere")


def test_archive_extract_file(spark, sf_dir, tmp_path):
    archive = testbed.archive(spark, sf_dir)
    shuffled = archive.select(*reversed(archive.columns), F.lit("x").alias("further"))
    shuffled.write.option("header", True).csv(f"{tmp_path}/extract")
    read = catalog.read_archive(spark, f"{tmp_path}/extract")
    assert read.schema == schemas.ARCHIVE
    assert sorted(map(str, read.collect())) == sorted(map(str, archive.select(*read.columns).collect()))


@pytest.mark.parametrize("wanted", ["luminosity", "tidal_lock_au", "xuv_factor", "hz_inner_au"])
def test_unlisted_star_type_is_an_error_whatever_is_read(spark, wanted):
    planets = spark.createDataFrame([("a", "quasar")], "name string, star_type string")
    with pytest.raises(Exception, match="unlisted star_type: quasar"):
        catalog.with_star_type(spark, planets, zone=True).select(wanted).collect()


@pytest.mark.parametrize("wanted", ["base_albedo", "habitable_candidate"])
def test_unlisted_planet_type_is_an_error_whatever_is_read(spark, wanted):
    planets = spark.createDataFrame([("a", None)], "name string, planet_type string")
    with pytest.raises(Exception, match="unlisted planet_type: NULL"):
        catalog.with_planet_type(spark, planets).select(wanted).collect()


def test_nesting_is_bounded_and_reversible(spark, sf_dir):
    raw = testbed.planets_raw(spark, sf_dir)
    nested = catalog.nest(raw, ["system_id"], F.floor(F.col("planet_id") / 4))
    assert nested.agg(F.max(F.size("planets"))).first()[0] <= 4
    flat = catalog.flatten(nested).select(*raw.columns)
    assert sorted(map(str, flat.collect())) == sorted(map(str, raw.collect()))


def test_planet_defaults(spark):
    frame = spark.createDataFrame([("a", None, None)], "name string, gravity_g double, has_water boolean")
    filled = catalog.fill_planet_defaults(frame).first().asDict()
    assert filled == {"name": "a", **catalog.PLANET_DEFAULTS}


def test_dimensions(spark):
    assert dims.star_types(spark).count() == 7
    assert dims.planet_types(spark).filter("habitable_candidate").count() == 3
    profiles = dims.sensor_profiles(spark)
    assert profiles.count() == 48 and profiles.filter("lo > hi").count() == 0
    assert dims.sensor_profiles_wide(spark).count() == 8


def test_table_schemas(spark, sf_dir):
    assert len(schemas.SENSOR_READING) == 33 and len(schemas.PLANETS) == 33
    assert len(schemas.STAR_SYSTEMS) == 12 and len(schemas.BATCH_RESULT) == 16
    stars = catalog.star_system_table(spark, testbed.systems(spark, sf_dir))
    assert stars.schema.simpleString() == schemas.STAR_SYSTEMS.simpleString()


def test_damaged_messages_are_not_parsed_for_their_order_number(spark, sf_dir):
    """a message is parsed once, when it is decoded."""
    from heliotab.plans.queries import QUERIES

    for name in ("decode_json_readings", "decode_quality"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "get_json_object" not in plan and "from_json" in plan.lower()


def test_columns_beside_the_message(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "n bigint, planet_name string")
    kept = wire.encode(rows, beside=["n"]).collect()
    assert [(r.key, r.value, r.n) for r in kept] == [("a", '{"n":1,"planet_name":"a"}', 1), ("b", '{"n":null,"planet_name":"b"}', None)]
