import math
import random

import pytest
from pyspark.sql import functions as F

from heliotab.functions import physics
from heliotab.functions.rounding import with_rounded
from heliotab.plans import catalog, telemetry
from heliotab.sources import dims


def _evaluate(spark, column, **values):
    schema = ", ".join(f"{name} double" for name in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


def test_rounding_equals_python(spark):
    rng = random.Random(7)
    values = [k - 273.15 for k in range(40, 3000)] + [i / 16 for i in range(-3000, 3000)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(3000)]
    values += [rng.randint(0, 10**7) / 1000 + 0.0005 for _ in range(3000)]
    values += [1e15 + 0.3, 1e18, -1e18, 0.0, -0.04, 5e-324, None]
    for digits in (0, 1, 2, 4, 6):
        frame = spark.createDataFrame([(v,) for v in values], "x double")
        rounded = with_rounded(frame, {"y": (F.col("x"), digits)}).collect()
        for x, y in rounded:
            assert y == (None if x is None else round(x, digits)), (x, digits)


def test_rounding_of_nan_is_null(spark):
    frame = spark.createDataFrame([(float("nan"),)], "x double")
    assert with_rounded(frame, {"y": (F.col("x"), 1)}).first().y is None


@pytest.mark.parametrize(
    "luminosity, inner, outer",
    # Golden values of published star tables.
    [(1.0, 0.75, 1.77), (0.01, 0.075, 0.177), (50000.0, 167.7051, 395.784), (0.3, 0.4108, 0.9695),
     (0.001, 0.0237, 0.056), (3.0, 1.299, 3.0657), (1000.0, 23.7171, 55.9723)],
)
def test_habitable_zone(spark, luminosity, inner, outer):
    frame = spark.createDataFrame([(luminosity,)], "l double")
    zone = {"i": (physics.hz_inner("l"), 4), "o": (physics.hz_outer("l"), 4)}
    got = with_rounded(frame, zone).first()
    assert (got.i, got.o) == (inner, outer)


def test_no_positive_distance(spark):
    for distance in (0.0, -1.0):
        assert _evaluate(spark, physics.equilibrium_temperature("l", "d", "a"), l=1.0, d=distance, a=0.3) == 9999.0
        assert _evaluate(spark, physics.stellar_flux("l", "d"), l=1.0, d=distance) == 99999.0


def test_temperature_of_earth(spark):
    got = _evaluate(spark, physics.equilibrium_temperature("l", "d", "a"), l=1.0, d=1.0, a=0.3)
    assert got == pytest.approx(278.0 * 0.7**0.25 - 273.15)


@pytest.mark.parametrize("precision, smallest", [(physics.CATALOG, 1e-4), (physics.TELEMETRY, 1e-6)])
def test_radiation(spark, precision, smallest):
    def dose(l, d, x, n2, magnetic):
        column = physics.surface_radiation("l", "d", "x", str(magnetic).lower(), "n", precision)
        return _evaluate(spark, column, l=l, d=d, x=x, n=n2)

    assert dose(1.0, 1.0, 1.0, 78.0, False) == pytest.approx(1e-4)
    assert dose(1.0, 1.0, 1.0, 78.0, True) == pytest.approx(1e-5)
    assert dose(1.0, 0.0, 1.0, 78.0, False) == pytest.approx(1e-4 / smallest)
    assert dose(1.0, 1.0, 1.0, 0.0, False) == pytest.approx(1e-2)  # nitrogen counts at least 0.01
    assert dose(1e-9, 9.0, 1.0, 78.0, True) == 1e-5  # lowest dose
    assert dose(1.0, None, 1.0, 78.0, False) is None


def test_atmosphere_and_tide(spark):
    for gravity, temp, kept in [(0.39, 0.0, False), (0.4, 0.0, True), (0.4, 150.0, True),
                                (0.79, 150.1, False), (0.8, 900.0, True)]:
        assert _evaluate(spark, physics.retains_atmosphere("g", "t"), g=gravity, t=temp) is kept
    assert _evaluate(spark, physics.tidally_locked("d", "x"), d=0.3, x=0.3) is True
    assert _evaluate(spark, physics.in_habitable_zone("d", "a", "b"), d=1.77, a=0.75, b=1.77) is True


def test_size_classes(spark):
    for radius, mass, kind in [(1.49, 1.9, "terrestrial"), (1.5, 1.9, "super_earth"),
                               (1.0, 2.0, "super_earth"), (2.4, 10.0, "gas"), (2.5, 1.0, "gas"),
                               (6.0, 1.0, "gas_giant")]:
        assert _evaluate(spark, physics.size_class("r", "m"), r=radius, m=mass) == kind


def test_units(spark):
    assert _evaluate(spark, physics.celsius("k"), k=None) == pytest.approx(26.85)
    assert _evaluate(spark, physics.radius_km("r"), r=2.0) == 12742.0
    assert _evaluate(spark, physics.surface_gravity("m", "r"), m=8.0, r=2.0) == 2.0
    assert _evaluate(spark, physics.percent_to_ppm("p"), p=-1.0) == 0.0
    expected = 20 + 5 * math.sin(0.3)
    assert _evaluate(spark, physics.expected_temperature("b", "t"), b=20.0, t=3.0) == pytest.approx(expected)


def test_planet_types_must_be_listed(spark):
    frame = spark.createDataFrame([("lava",), ("plasma",)], "planet_type string")
    with pytest.raises(Exception, match="unlisted planet_type: plasma"):
        catalog.with_planet_type(spark, frame).collect()


def test_unlisted_stars_and_planets_fall_back(spark):
    stars = spark.createDataFrame([("white_dwarf",), ("quasar",), (None,)], "star_type string")
    got = {r.star_type: r.luminosity for r in telemetry.with_star_fallback(spark, stars).collect()}
    assert got == {"white_dwarf": 0.001, "quasar": 1.0, None: 1.0}
    columns = ", ".join(f"{c} double" for c in dims.SENSORS.values())
    readings = spark.createDataFrame(
        [("gas", 500.0, 9999.9, 0.0, 5.0, 2.1, None), ("odd", 100.0, 99.0, 0.3, 50.0, 5.0, 4.9)],
        f"planet_type string, {columns}",
    )
    checked = telemetry.with_sensor_ranges(spark, readings).orderBy("planet_type").collect()
    assert [r.sensors_out for r in checked] == [2, 3]
    assert checked[0].pressure_out == checked[0].seismic_out == 1
    assert checked[0].magnetic_ut_out == 0
