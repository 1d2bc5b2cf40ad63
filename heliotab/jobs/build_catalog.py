"""Nested systems to the star and planet tables, with the usual reports.

    spark-submit -m heliotab.jobs.build_catalog --systems systems.json --out /tables

Every input row is one system: system_name, star_type, star_age_gy and an array ``planets``.  The
reports are written whole, as CSV below ``reports``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..plans import catalog, reports
from ..schemas import PLANETS
from ..session import job_session
from ..sinks import batch
from ..sources import terms
from ..workspace import stored

NESTED = (
    "system_name string, star_type string, star_age_gy double, planets array<struct<"
    "name: string, planet_type: string, distance_au: double, radius_km: double, "
    "mass_earth: double, gravity_g: double, atmosphere_o2: double, atmosphere_co2: double, "
    "atmosphere_n2: double, has_water: boolean, magnetic_field: boolean, moons: int>>"
)


def build(nested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Star table and planet table of nested systems in either wording."""
    spark = nested.sparkSession
    systems = terms.to_codes(nested)
    stars = catalog.star_system_table(spark, systems.drop("planets"))
    raw = terms.to_codes(catalog.flatten(systems))
    planets = catalog.planet_table(spark, raw).select(*[f.name for f in PLANETS.fields])
    return stars, planets


def run(spark: SparkSession, systems_path: str, out: str, wording: bool = False) -> None:
    stars, planets = build(spark.read.schema(NESTED).json(systems_path))
    if wording:
        stars, planets = terms.to_wording(stars), terms.to_wording(planets)
    batch.write_csv(stars, f"{out}/star_systems")
    batch.write_csv(planets, f"{out}/planets")
    # All reports read one columnar copy, not the text again.
    written = stored(terms.to_codes(catalog.read_planets_csv(spark, f"{out}/planets")), "catalog")
    named = {
        "profile": reports.profile_counts(written),
        "labels": reports.distribution(written, "label"),
        "labels_by_star": reports.cross_distribution(written, "star_type", "label"),
        "candidates": reports.candidates(written),
        "radiation": reports.radiation_ranking(written),
    }
    batch.write_reports(named, f"{out}/reports")


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--systems", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--wording", action="store_true", help="write the existing wording")
    options = parser.parse_args()
    run(job_session("heliotab-catalog"), options.systems, options.out, options.wording)


if __name__ == "__main__":
    main()
