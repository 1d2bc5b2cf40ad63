"""Physical quantities, the same on batch and stream.

Arguments are column names or SQL expressions.  Results are not rounded yet; ``with_rounded``
stores them with the digits given here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_CELSIUS_K = 273.15
EARTH_RADIUS_KM = 6371.0

# Decimals that each quantity is stored with.
TEMPERATURE_DIGITS = 1
ZONE_DIGITS = 4
RADIATION_DIGITS = 6
RADIUS_DIGITS = 1
GRAVITY_DIGITS = 3
PERCENT_DIGITS = 2
PPM_DIGITS = 1


@dataclass(frozen=True)
class Precision:
    """Digits of the stellar flux and the smallest squared distance used for radiation."""

    flux_digits: int
    min_distance_sq: str


CATALOG = Precision(flux_digits=4, min_distance_sq="1e-4D")
TELEMETRY = Precision(flux_digits=6, min_distance_sq="1e-6D")


def equilibrium_temperature(luminosity: str, distance_au: str, albedo: str) -> Column:
    """Black-body temperature in Celsius; 9999 without a positive distance."""
    kelvin = (
        f"278D * pow({luminosity}, 0.25D) * pow(1D - {albedo}, 0.25D) / sqrt({distance_au})"
    )
    return F.expr(
        f"CASE WHEN {distance_au} <= 0 THEN 9999D ELSE {kelvin} - {ZERO_CELSIUS_K}D END"
    )


def hz_inner(luminosity: str) -> Column:
    return F.expr(f"0.75D * sqrt({luminosity})")


def hz_outer(luminosity: str) -> Column:
    return F.expr(f"1.77D * sqrt({luminosity})")


def stellar_flux(luminosity: str, distance_au: str) -> Column:
    """Flux relative to Earth's; 99999 without a positive distance."""
    flux = f"{luminosity} / ({distance_au} * {distance_au})"
    return F.expr(f"CASE WHEN {distance_au} <= 0 THEN 99999D ELSE {flux} END")


def surface_radiation(
    luminosity: str,
    distance_au: str,
    xuv_factor: str,
    magnetic: str,
    n2_pct: str,
    precision: Precision = CATALOG,
) -> Column:
    """mSv/h at the surface; a magnetic field keeps nine tenths away, nitrogen the rest.

    Nitrogen counts relative to Earth's 78 percent, at least 0.01.  ``greatest`` skips NULL, so
    unknown inputs are ruled out first.
    """
    known = " AND ".join(f"{x} IS NOT NULL" for x in (distance_au, luminosity, xuv_factor, n2_pct))
    flux = f"{luminosity} / greatest({distance_au} * {distance_au}, {precision.min_distance_sq})"
    shield = f"CASE WHEN {magnetic} THEN 0.1D ELSE 1D END"
    pressure = f"greatest({n2_pct} / 78D, 0.01D)"
    dose = f"{flux} * {xuv_factor} * 0.0001D * {shield} / {pressure}"
    return F.expr(f"CASE WHEN {known} THEN greatest({dose}, 0.00001D) END")


def tidally_locked(distance_au: str, tidal_lock_au: str) -> Column:
    return F.expr(f"{distance_au} <= {tidal_lock_au}")


def retains_atmosphere(gravity_g: str, temperature_c: str) -> Column:
    return F.expr(f"NOT ({gravity_g} < 0.4D OR ({temperature_c} > 150 AND {gravity_g} < 0.8D))")


def in_habitable_zone(distance_au: str, inner_au: str, outer_au: str) -> Column:
    return F.expr(f"{distance_au} BETWEEN {inner_au} AND {outer_au}")


def expected_temperature(base_c: str, tick: str) -> Column:
    """Reference temperature plus the day cycle of five degrees."""
    return F.expr(f"{base_c} + sin({tick} * 0.1D) * 5D")


def celsius(kelvin: str) -> Column:
    """Kelvin to Celsius; a missing value counts as 300 K."""
    return F.expr(f"coalesce({kelvin}, 300D) - {ZERO_CELSIUS_K}D")


def radius_km(earth_radii: str) -> Column:
    return F.expr(f"{earth_radii} * {EARTH_RADIUS_KM}D")


def surface_gravity(earth_masses: str, earth_radii: str) -> Column:
    return F.expr(f"{earth_masses} / nullif({earth_radii} * {earth_radii}, 0D)")


def size_class(earth_radii: str, earth_masses: str) -> Column:
    return F.expr(
        f"CASE WHEN {earth_radii} < 1.5D AND {earth_masses} < 2 THEN 'terrestrial'"
        f" WHEN {earth_radii} < 2.5D AND {earth_masses} < 10 THEN 'super_earth'"
        f" WHEN {earth_radii} < 6 THEN 'gas' ELSE 'gas_giant' END"
    )


def measured_percent(percent: str) -> Column:
    """A gas share as sensors report it: not negative."""
    return F.expr(f"if({percent} < 0, 0D, {percent})")


def percent_to_ppm(percent: str) -> Column:
    return measured_percent(percent) * 10000.0
