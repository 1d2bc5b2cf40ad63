"""Independent SQL for the queries, in the DuckDB dialect over the given tables.

``printf`` with a fixed number of digits rounds a double by its exact binary value, as the
engine does; adding 0.0 turns a negative zero into zero.
"""

from __future__ import annotations


def rnd(expression: str, digits: int) -> str:
    return f"(CAST(printf('%.{digits}f', {expression}) AS DOUBLE) + 0.0)"


_READING_FIELDS = """planet_name, system_name, star_type, planet_type, distance_au, mass_earth,
 radius_km, temperature_c, avg_temp_celsius, gravity_g, stellar_flux, surface_radiation_msv_h,
 radiation_msv_h, wind_speed_kmh, pressure_hpa, vegetation_index, humidity_pct, seismic_activity,
 magnetic_field_ut, atmosphere_o2, atmosphere_co2, atmosphere_n2, o2_pct, co2_ppm, has_water_int,
 magnetic_field_int, in_hz_int, tidally_locked_int, retains_atmosphere_int,
 habitable_candidate_int, tick, timestamp, source"""

_PLANET_FIELDS = """system_name, star_type, star_luminosity, star_age_gy, xuv_factor, flare_risk,
 name, planet_type, distance_au, radius_km, mass_earth, gravity_g, avg_temp_celsius, stellar_flux,
 surface_radiation_msv_h, tidally_locked, retains_atmosphere, atmosphere_o2, atmosphere_co2,
 atmosphere_n2, has_water, magnetic_field, moons, in_habitable_zone, albedo, habitable_candidate,
 has_water_int, magnetic_field_int, in_hz_int, habitable_candidate_int, tidally_locked_int,
 retains_atmosphere_int, label"""

_STATE = """CASE WHEN l_orderkey % 13 = 0 THEN 'missing' WHEN l_orderkey % 11 = 0 THEN 'malformed'
  WHEN l_orderkey % 7 = 0 THEN 'mismatched' ELSE 'intact' END"""

_VIEWS = f"""WITH star_types AS (
 SELECT CAST(a AS INTEGER) AS star_idx, b AS star_type, CAST(c AS DOUBLE) AS luminosity,
  CAST(d AS INTEGER) AS temp_k, CAST(e AS DOUBLE) AS mass_solar, CAST(f AS DOUBLE) AS lifespan_gy,
  g AS color, CAST(h AS DOUBLE) AS xuv_factor, CAST(i AS DOUBLE) AS flare_risk,
  CAST(j AS DOUBLE) AS tidal_lock_au, CAST(k AS DOUBLE) AS min_age_gy
 FROM (VALUES
  (0,'red_dwarf',0.01,3200,0.3,100.0,'red',10.0,0.6,0.3,2.0),
  (1,'orange_dwarf',0.3,4500,0.7,30.0,'orange',2.0,0.2,0.15,1.0),
  (2,'yellow_dwarf',1.0,5778,1.0,10.0,'yellow',1.0,0.1,0.05,1.0),
  (3,'white_dwarf',0.001,25000,0.6,999.0,'white',50.0,0.0,0.5,0.0),
  (4,'blue_giant',50000.0,30000,20.0,0.01,'blue',100000.0,0.0,0.0,0.0),
  (5,'red_giant',1000.0,3700,5.0,0.1,'red',5.0,0.05,0.0,0.0),
  (6,'subgiant',3.0,6000,1.5,5.0,'yellow',1.5,0.08,0.05,1.0)) AS t(a,b,c,d,e,f,g,h,i,j,k)),
planet_types AS (
 SELECT a AS planet_type, CAST(b AS DOUBLE) AS base_albedo, c AS habitable_candidate
 FROM (VALUES ('terrestrial',0.30,true),('super_earth',0.35,true),('ocean',0.20,true),
  ('gas',0.52,false),('gas_giant',0.52,false),('ice_dwarf',0.70,false),('lava',0.10,false)) AS t(a,b,c)),
profiles AS (
 SELECT a AS planet_type, b AS sensor, CAST(c AS DOUBLE) AS lo, CAST(d AS DOUBLE) AS hi FROM (VALUES
  ('terrestrial','wind_speed',20,80),('terrestrial','pressure',900,1100),('terrestrial','vegetation',0,0.6),
  ('terrestrial','humidity',10,80),('terrestrial','seismic',0,4),('terrestrial','magnetic_ut',20,60),
  ('ocean','wind_speed',30,120),('ocean','pressure',1000,1100),('ocean','vegetation',0.4,0.9),
  ('ocean','humidity',80,100),('ocean','seismic',0,3),('ocean','magnetic_ut',25,55),
  ('super_earth','wind_speed',50,200),('super_earth','pressure',1100,2000),('super_earth','vegetation',0,0.4),
  ('super_earth','humidity',20,70),('super_earth','seismic',1,6),('super_earth','magnetic_ut',30,90),
  ('gas','wind_speed',500,2000),('gas','pressure',10000,100000),('gas','vegetation',0,0),
  ('gas','humidity',0,5),('gas','seismic',0,2),('gas','magnetic_ut',100,1000),
  ('gas_giant','wind_speed',800,3000),('gas_giant','pressure',50000,500000),('gas_giant','vegetation',0,0),
  ('gas_giant','humidity',0,2),('gas_giant','seismic',0,1),('gas_giant','magnetic_ut',500,5000),
  ('ice_dwarf','wind_speed',0,30),('ice_dwarf','pressure',0.1,10),('ice_dwarf','vegetation',0,0),
  ('ice_dwarf','humidity',0,5),('ice_dwarf','seismic',0,2),('ice_dwarf','magnetic_ut',1,15),
  ('lava','wind_speed',100,500),('lava','pressure',50,500),('lava','vegetation',0,0),
  ('lava','humidity',0,2),('lava','seismic',5,10),('lava','magnetic_ut',5,30),
  ('unknown','wind_speed',0,100),('unknown','pressure',100,1000),('unknown','vegetation',0,0.2),
  ('unknown','humidity',0,50),('unknown','seismic',0,5),('unknown','magnetic_ut',5,50)) AS t(a,b,c,d)),
systems AS (
 SELECT s_suppkey AS system_id, s_name AS system_name, t.star_type,
  CAST((s_suppkey * 37 + 11) % 130 AS DOUBLE) / 10 AS star_age_gy
 FROM supplier JOIN star_types t ON t.star_idx =
  CASE WHEN s_suppkey % 10 < 7 THEN s_suppkey % 10 WHEN s_suppkey % 10 = 7 THEN 2
   WHEN s_suppkey % 10 = 8 THEN 1 ELSE 6 END),
stars AS (
 SELECT system_name, s.star_type, luminosity AS star_luminosity, temp_k AS star_temp_k,
  mass_solar AS star_mass_solar, star_age_gy, lifespan_gy AS star_lifespan_gy, color AS star_color,
  xuv_factor, flare_risk, {rnd("0.75::DOUBLE * sqrt(luminosity)", 4)} AS hz_inner_au,
  {rnd("1.77::DOUBLE * sqrt(luminosity)", 4)} AS hz_outer_au
 FROM systems s JOIN star_types USING (star_type)),
planets_raw AS (
 SELECT p.p_partkey AS planet_id, p.p_name || ' ' || CAST(p.p_partkey AS VARCHAR) AS name,
  s.system_id, s.system_name, s.star_type, s.star_age_gy,
  CASE WHEN p.p_size % 12 < 4 THEN 'terrestrial' WHEN p.p_size % 12 < 6 THEN 'ocean'
   WHEN p.p_size % 12 < 8 THEN 'super_earth' WHEN p.p_size % 12 = 8 THEN 'gas'
   WHEN p.p_size % 12 = 9 THEN 'gas_giant' WHEN p.p_size % 12 = 10 THEN 'ice_dwarf'
   ELSE 'lava' END AS planet_type,
  {rnd('''sqrt(t.luminosity) * CASE WHEN p.p_partkey % 3 = 1
    THEN 0.803::DOUBLE + CAST((p.p_partkey * 17) % 16 AS DOUBLE) / 100
    ELSE 0.253::DOUBLE + CAST((p.p_partkey * 17) % 41 AS DOUBLE) / 20 END''', 6)} AS distance_au,
  CAST(2000 + (p.p_partkey * 131) % 9000 AS DOUBLE) AS radius_km,
  CAST(3 + (p.p_partkey * 19) % 400 AS DOUBLE) / 100 AS mass_earth,
  CAST(2 + (p.p_partkey * 13) % 29 AS DOUBLE) / 10 AS gravity_g,
  CAST((p.p_partkey * 7) % 33 AS DOUBLE) AS atmosphere_o2,
  CAST((p.p_partkey * 11) % 13 AS DOUBLE) AS atmosphere_co2,
  CAST(30 + (p.p_partkey * 29) % 70 AS DOUBLE) AS atmosphere_n2,
  p.p_partkey % 3 <> 0 AS has_water, (p.p_partkey // 2) % 5 >= 1 AS magnetic_field,
  CAST(p.p_partkey % 36 AS INTEGER) AS moons
 FROM part p JOIN systems s ON s.system_id = p.p_partkey % (SELECT count(*) FROM supplier)
 JOIN star_types t ON t.star_type = s.star_type),
physics AS (
 SELECT q.*, luminosity AS star_luminosity, xuv_factor, flare_risk, lifespan_gy, min_age_gy,
  base_albedo AS albedo, habitable_candidate,
  {rnd('''278.0::DOUBLE * power(luminosity, 0.25::DOUBLE) * power(1.0::DOUBLE - base_albedo, 0.25::DOUBLE)
    / sqrt(distance_au) - 273.15::DOUBLE''', 1)} AS avg_temp_celsius,
  {rnd("luminosity / power(distance_au, 2)", 4)} AS stellar_flux,
  {rnd('''greatest(0.00001::DOUBLE, luminosity / greatest(power(distance_au, 2), 0.0001::DOUBLE)
    * xuv_factor * 0.0001::DOUBLE * CASE WHEN magnetic_field THEN 0.1::DOUBLE ELSE 1.0::DOUBLE END
    / greatest(0.01::DOUBLE, atmosphere_n2 / 78.0::DOUBLE))''', 6)} AS surface_radiation_msv_h,
  distance_au <= tidal_lock_au AS tidally_locked,
  distance_au BETWEEN {rnd("0.75::DOUBLE * sqrt(luminosity)", 4)}
   AND {rnd("1.77::DOUBLE * sqrt(luminosity)", 4)} AS in_habitable_zone
 FROM planets_raw q JOIN star_types t ON t.star_type = q.star_type
 JOIN planet_types k ON k.planet_type = q.planet_type),
flagged AS (
 SELECT *, CAST(has_water AS INTEGER) AS has_water_int,
  CAST(magnetic_field AS INTEGER) AS magnetic_field_int, CAST(in_habitable_zone AS INTEGER) AS in_hz_int,
  CAST(habitable_candidate AS INTEGER) AS habitable_candidate_int,
  CAST(tidally_locked AS INTEGER) AS tidally_locked_int,
  CAST(retains_atmosphere AS INTEGER) AS retains_atmosphere_int
 FROM (SELECT *, CASE WHEN gravity_g < 0.4 THEN false
   WHEN avg_temp_celsius > 150 AND gravity_g < 0.8 THEN false ELSE true END AS retains_atmosphere
  FROM physics)),
planets AS (
 SELECT *, CASE WHEN label_rule LIKE 'r%' THEN 'non_habitable' ELSE label_rule END AS label
 FROM (SELECT *, CASE WHEN NOT habitable_candidate THEN 'r1'
   WHEN avg_temp_celsius < -80 OR avg_temp_celsius > 80 THEN 'r2'
   WHEN stellar_flux > 10 THEN 'r3' WHEN surface_radiation_msv_h > 5 THEN 'r4'
   WHEN star_age_gy < min_age_gy THEN 'r5' WHEN lifespan_gy < 1 THEN 'r6'
   WHEN NOT retains_atmosphere THEN 'r7' WHEN tidally_locked AND NOT magnetic_field THEN 'r8'
   WHEN NOT in_habitable_zone THEN 'r9'
   WHEN avg_temp_celsius >= -10 AND avg_temp_celsius <= 50 AND stellar_flux >= 0.25
    AND stellar_flux <= 1.5 AND atmosphere_o2 >= 15 AND atmosphere_n2 >= 50 AND has_water
    AND magnetic_field AND surface_radiation_msv_h <= 0.5 AND star_age_gy >= 2
    AND gravity_g >= 0.4 AND gravity_g <= 2.5 AND atmosphere_co2 <= 5 THEN 'habitable'
   WHEN (has_water OR in_habitable_zone) AND atmosphere_o2 >= 5 AND surface_radiation_msv_h <= 2
    AND avg_temp_celsius >= -30 AND avg_temp_celsius <= 70 THEN 'uncertain'
   ELSE 'r10' END AS label_rule FROM flagged)),
readings AS (
 SELECT l_orderkey, l_linenumber, p.planet_id, p.name AS planet_name, p.system_name,
  CASE WHEN l_suppkey % 25 = 0 THEN 'unlisted' ELSE p.star_type END AS star_type, p.planet_type,
  p.distance_au, p.mass_earth, p.radius_km,
  {rnd("p.avg_temp_celsius + (l_quantity - 25) / 5", 2)} AS temperature_c, p.avg_temp_celsius,
  p.gravity_g, p.stellar_flux, p.surface_radiation_msv_h,
  p.surface_radiation_msv_h AS radiation_msv_h, l_extendedprice / 160 AS wind_speed_kmh,
  900 + l_quantity * 4 AS pressure_hpa, l_discount * 10 AS vegetation_index,
  l_quantity * 2 AS humidity_pct,
  CAST((l_orderkey + l_linenumber) % 37 AS DOUBLE) / 4 AS seismic_activity,
  20 + l_tax * 500 AS magnetic_field_ut,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE p.atmosphere_o2 END AS atmosphere_o2,
  p.atmosphere_co2, p.atmosphere_n2,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE p.atmosphere_o2 END AS o2_pct,
  p.atmosphere_co2 * 10000 AS co2_ppm, p.has_water_int,
  CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE p.magnetic_field_int END AS magnetic_field_int,
  p.in_hz_int, p.tidally_locked_int, p.retains_atmosphere_int, p.habitable_candidate_int,
  l_linenumber AS tick, l_shipdate AS event_time,
  strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp,
  CASE WHEN l_returnflag = 'R' THEN 'catalog' ELSE 'local' END AS source, p.label
 FROM lineitem JOIN planets p ON p.planet_id = l_partkey),
points AS (
 SELECT *,
  CASE WHEN in_hz_int = 1 THEN 20.0 ELSE 0.0 END AS pts_zone,
  CASE WHEN avg_temp_celsius BETWEEN -10 AND 50 THEN 20.0 WHEN avg_temp_celsius BETWEEN -30 AND 65 THEN 10.0
   WHEN avg_temp_celsius BETWEEN -60 AND 80 THEN 3.0 ELSE 0.0 END AS pts_temperature,
  CASE WHEN stellar_flux BETWEEN 0.25 AND 1.5 THEN 15.0 WHEN stellar_flux BETWEEN 0.1 AND 3 THEN 7.0
   WHEN stellar_flux <= 8 THEN 2.0 ELSE 0.0 END AS pts_flux,
  CASE WHEN atmosphere_o2 BETWEEN 18 AND 25 THEN 15.0 WHEN atmosphere_o2 BETWEEN 12 AND 30 THEN 8.0
   WHEN atmosphere_o2 >= 5 THEN 3.0 ELSE 0.0 END AS pts_oxygen,
  CASE WHEN has_water_int = 1 THEN 10.0 ELSE 0.0 END AS pts_water,
  CASE WHEN magnetic_field_int = 1 THEN 10.0 WHEN tidally_locked_int = 1 THEN -10.0 ELSE 0.0 END AS pts_magnetic,
  CASE WHEN surface_radiation_msv_h <= 0.1 THEN 10.0 WHEN surface_radiation_msv_h <= 0.5 THEN 6.0
   WHEN surface_radiation_msv_h <= 2 THEN 2.0 WHEN surface_radiation_msv_h <= 5 THEN -5.0 ELSE 0.0 END AS pts_radiation,
  CASE WHEN atmosphere_n2 >= 70 THEN 5.0 WHEN atmosphere_n2 >= 40 THEN 2.0 ELSE 0.0 END AS pts_nitrogen,
  CASE WHEN atmosphere_co2 > 10 THEN -15.0 WHEN atmosphere_co2 > 5 THEN -8.0
   WHEN atmosphere_co2 > 2 THEN -3.0 ELSE 0.0 END AS pts_carbon_dioxide,
  CASE WHEN gravity_g BETWEEN 0.7 AND 1.5 THEN 3.0 WHEN gravity_g BETWEEN 0.4 AND 2.5 THEN 1.0
   WHEN gravity_g < 0.4 THEN -10.0 ELSE 0.0 END AS pts_gravity,
  CASE WHEN humidity_pct BETWEEN 20 AND 80 THEN 5.0 WHEN humidity_pct >= 10 THEN 2.0 ELSE 0.0 END AS pts_humidity,
  CASE planet_type WHEN 'ocean' THEN 5.0 WHEN 'terrestrial' THEN 3.0 WHEN 'super_earth' THEN 1.0 ELSE 0.0 END AS pts_planet_type,
  CASE WHEN seismic_activity >= 8 THEN -15.0 WHEN seismic_activity >= 6 THEN -8.0
   WHEN seismic_activity >= 4 THEN -3.0 ELSE 0.0 END AS pts_seismic,
  CASE WHEN wind_speed_kmh > 500 THEN -15.0 WHEN wind_speed_kmh > 200 THEN -5.0 ELSE 0.0 END AS pts_wind,
  least(5.0::DOUBLE, coalesce(vegetation_index * 5, 0.0)) AS pts_vegetation,
  CASE WHEN habitable_candidate_int = 0 THEN 'not_candidate' WHEN stellar_flux > 10 THEN 'flux'
   WHEN surface_radiation_msv_h > 5 THEN 'radiation'
   WHEN avg_temp_celsius < -80 OR avg_temp_celsius > 80 THEN 'temperature'
   WHEN retains_atmosphere_int = 0 THEN 'no_atmosphere'
   WHEN tidally_locked_int = 1 AND magnetic_field_int = 0 THEN 'locked_unshielded' END AS eliminated_by
 FROM readings),
scored AS (
 SELECT *, CASE WHEN habitability_score >= 60 THEN 'habitable'
   WHEN habitability_score >= 30 THEN 'uncertain' ELSE 'non_habitable' END AS habitability_class
 FROM (SELECT *, CASE WHEN eliminated_by IS NOT NULL THEN 0.0::DOUBLE ELSE
   round(greatest(0.0::DOUBLE, least(100.0::DOUBLE, CAST(pts_zone + pts_temperature + pts_flux
    + pts_oxygen + pts_water + pts_magnetic + pts_radiation + pts_nitrogen + pts_carbon_dioxide
    + pts_gravity + pts_humidity + pts_planet_type + pts_seismic + pts_wind AS DOUBLE)
    + pts_vegetation)), 1) END AS habitability_score FROM points)),
alarmed AS (
 SELECT *, CASE WHEN len(alert_list) = 0 THEN 'NOMINAL' ELSE array_to_string(alert_list, ' | ') END AS alerts
 FROM (SELECT *, list_filter([
   CASE WHEN temperature_c > 80 THEN 'TEMP_HIGH' WHEN temperature_c < -80 THEN 'TEMP_LOW' END,
   CASE WHEN surface_radiation_msv_h > 5 THEN 'RAD_LETHAL' WHEN surface_radiation_msv_h > 2 THEN 'RAD_HIGH' END,
   CASE WHEN seismic_activity >= 7 THEN 'QUAKE' END, CASE WHEN wind_speed_kmh > 400 THEN 'STORM' END,
   CASE WHEN atmosphere_o2 < 5 THEN 'O2_LOW' END, CASE WHEN stellar_flux > 10 THEN 'FLUX_FATAL' END,
   CASE WHEN tidally_locked_int = 1 THEN 'TIDAL_LOCK' END], lambda x: x IS NOT NULL) AS alert_list
  FROM scored)),
archive AS (
 SELECT s_name AS hostname, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS pl_name,
  'G' || CAST(p_size % 10 AS VARCHAR) AS st_spectype, CAST(p_size AS DOUBLE) / 25 AS st_lum,
  CAST(p_partkey % 130 AS DOUBLE) / 10 AS st_age,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 0.053::DOUBLE + CAST((p_partkey * 17) % 97 AS DOUBLE) / 40 END AS pl_orbsmax,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 0.5::DOUBLE + CAST((p_partkey * 7) % 90 AS DOUBLE) / 10 END AS pl_rade,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 0.3::DOUBLE + CAST((p_partkey * 19) % 150 AS DOUBLE) / 10 END AS pl_bmasse,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(150 + (p_partkey * 23) % 900 AS DOUBLE) END AS pl_eqt,
  CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE 1 END AS default_flag
 FROM part JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)),
archive_planets AS (
 SELECT pl_name AS name, hostname AS system_name, 'unknown' AS star_type,
  CASE WHEN pl_rade < 1.5 AND pl_bmasse < 2 THEN 'terrestrial' WHEN pl_rade < 2.5 AND pl_bmasse < 10
   THEN 'super_earth' WHEN pl_rade < 6 THEN 'gas' ELSE 'gas_giant' END AS planet_type,
  pl_orbsmax AS distance_au, pl_bmasse AS mass_earth, {rnd("pl_rade * 6371", 1)} AS radius_km,
  {rnd("pl_bmasse / power(pl_rade, 2)", 3)} AS gravity_g,
  {rnd("pl_eqt - 273.15::DOUBLE", 1)} AS avg_temp_celsius, 0.0::DOUBLE AS atmosphere_o2,
  0.0::DOUBLE AS atmosphere_co2, 0.0::DOUBLE AS atmosphere_n2, false AS has_water,
  false AS magnetic_field, false AS in_habitable_zone, true AS retains_atmosphere,
  false AS habitable_candidate, 'nasa' AS source
 FROM archive WHERE default_flag = 1 AND pl_eqt IS NOT NULL AND pl_orbsmax IS NOT NULL
  AND pl_bmasse IS NOT NULL AND pl_rade IS NOT NULL),
local_planets AS (
 SELECT name, system_name, star_type, planet_type, distance_au, mass_earth, radius_km, gravity_g,
  avg_temp_celsius, atmosphere_o2, atmosphere_co2, atmosphere_n2, has_water, magnetic_field,
  in_habitable_zone, retains_atmosphere, habitable_candidate, 'local' AS source FROM planets)
"""

_ENRICHED_FIELDS = f"{_READING_FIELDS}, habitability_score, habitability_class, alerts"
_KEY = "l_orderkey, l_linenumber, planet_id"

_WORDING = """
 CASE {0} WHEN 'red_dwarf' THEN 'Naine rouge' WHEN 'orange_dwarf' THEN 'Naine orange'
  WHEN 'yellow_dwarf' THEN 'Naine jaune' WHEN 'white_dwarf' THEN 'Naine blanche'
  WHEN 'blue_giant' THEN 'Geante bleue' WHEN 'red_giant' THEN 'Geante rouge'
  WHEN 'subgiant' THEN 'Sous-geante' WHEN 'terrestrial' THEN 'Tellurique'
  WHEN 'super_earth' THEN 'Super-Terre' WHEN 'ocean' THEN 'Ocean' WHEN 'gas' THEN 'Gazeuse'
  WHEN 'gas_giant' THEN 'Geante gazeuse' WHEN 'ice_dwarf' THEN 'Naine glacee'
  WHEN 'lava' THEN 'Lave' ELSE {0} END AS {0}"""

# Each sensor: profile name, reading column.
_SENSORS = {
    "wind_speed": "wind_speed_kmh",
    "pressure": "pressure_hpa",
    "vegetation": "vegetation_index",
    "humidity": "humidity_pct",
    "seismic": "seismic_activity",
    "magnetic_ut": "magnetic_field_ut",
}

_NUMERIC = """distance_au, stellar_flux, radius_km, mass_earth, gravity_g, avg_temp_celsius,
 surface_radiation_msv_h, atmosphere_o2, atmosphere_co2, atmosphere_n2, has_water_int,
 magnetic_field_int, in_hz_int, tidally_locked_int, retains_atmosphere_int"""
_NUMERIC_LIST = [c.strip() for c in _NUMERIC.split(",")]
_EXACT = "CASE WHEN habitable_candidate THEN 'habitable' ELSE 'non_habitable' END"


def _out(sensor: str) -> str:
    column = _SENSORS[sensor]
    return (
        f"CAST(coalesce({column} < {sensor}.lo OR {column} > {sensor}.hi, false) AS INTEGER)"
    )


_BODIES = {
    "dim_star_types": """SELECT t.*, count(system_id) AS n_systems
 FROM star_types t LEFT JOIN systems s ON s.star_type = t.star_type GROUP BY ALL""",
    "dim_planet_types": """SELECT t.*, count(planet_id) AS n_planets
 FROM planet_types t LEFT JOIN planets_raw s ON s.planet_type = t.planet_type GROUP BY ALL""",
    "dim_sensor_profiles": f"""SELECT p.planet_type, p.sensor, p.lo, p.hi, observed_min, observed_max
 FROM profiles p LEFT JOIN ({" UNION ALL ".join(
     f"SELECT planet_type, '{s}' AS sensor, min({c}) AS observed_min, max({c}) AS observed_max"
     f" FROM readings GROUP BY planet_type" for s, c in _SENSORS.items())}) o
 ON o.planet_type = p.planet_type AND o.sensor = p.sensor""",
    "scan_csv_planets": f"SELECT {_PLANET_FIELDS} FROM planets",
    "sink_csv_roundtrip": "SELECT * FROM stars",
    "load_local_catalog": """SELECT * REPLACE (0.0::DOUBLE AS atmosphere_n2, true AS retains_atmosphere)
 FROM local_planets""",
    "flatten_catalog": "SELECT * FROM planets_raw",
    "normalize_archive": "SELECT * FROM archive_planets ORDER BY system_name, name LIMIT 30",
    "normalize_archive_all": "SELECT * FROM archive_planets",
    "union_sources": "SELECT * FROM local_planets UNION ALL SELECT * FROM archive_planets",
    "encode_wire": f"SELECT planet_name AS key, {_READING_FIELDS} FROM readings",
    "decode_json_readings": "SELECT " + ", ".join(
        f"CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE {c} END AS {c}"
        for c in _READING_FIELDS.replace("\n", "").split(", ")) + " FROM readings",
    "decode_event_props": "SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events",
    "parse_event_time": "SELECT event_id, epoch_us(ts) AS event_micros FROM events",
    "project_raw_readings": f"SELECT {_READING_FIELDS} FROM readings",
    "enrich_readings": f"SELECT {_KEY}, {_ENRICHED_FIELDS} FROM alarmed",
    "enrich_readings_wording": f"""SELECT * REPLACE ({_WORDING.format("star_type")},
 {_WORDING.format("planet_type")},
 CASE habitability_class WHEN 'habitable' THEN '🟢 habitable' WHEN 'uncertain' THEN '🟡 inconnue'
  ELSE '🔴 non_habitable' END AS habitability_class,
 replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(alerts,
  'TEMP_HIGH', '🔥 TEMPERATURE CRITIQUE'), 'TEMP_LOW', '🧊 FROID EXTREME'),
  'RAD_LETHAL', '☢️  RADIATION LETALE'), 'RAD_HIGH', '⚠️  RADIATION ELEVEE'),
  'QUAKE', '🌋 SEISME MAJEUR'), 'STORM', '🌪️  TEMPETE EXTREME'), 'O2_LOW', '😮 O2 INSUFFISANT'),
  'FLUX_FATAL', '☀️  FLUX STELLAIRE FATAL'), 'TIDAL_LOCK', '🔒 VERROUILLAGE MAREE'),
  'NOMINAL', '✅ RAS') AS alerts) FROM (SELECT {_ENRICHED_FIELDS} FROM alarmed)""",
    "predict_without_model": f"""SELECT {_KEY}, habitability_score,
 CAST(NULL AS VARCHAR) AS ml_predicted_label FROM scored""",
    "filter_labelled": "SELECT planet_id, label FROM planets WHERE planet_id % 7 <> 0",
    "report_candidates": """SELECT name, star_type, distance_au, avg_temp_celsius, stellar_flux,
 surface_radiation_msv_h, tidally_locked, in_habitable_zone, planet_type, label
 FROM planets WHERE habitable_candidate""",
    "flags_to_int": """SELECT planet_id, has_water, magnetic_field, in_habitable_zone,
 habitable_candidate, tidally_locked, retains_atmosphere, has_water_int, magnetic_field_int,
 in_hz_int, habitable_candidate_int, tidally_locked_int, retains_atmosphere_int FROM planets""",
    "habitability_class": """SELECT habitability_class, count(*) AS n,
 round(sum(habitability_score), 1) AS score_sum FROM scored GROUP BY habitability_class""",
    "fill_planet_defaults": """SELECT pl_name AS name, coalesce(pl_orbsmax, 1.0::DOUBLE) AS distance_au,
 coalesce(pl_bmasse, 1.0::DOUBLE) AS mass_earth, coalesce(pl_eqt - 273, 20.0::DOUBLE) AS avg_temp_celsius,
 'unknown' AS star_type, 'unknown' AS planet_type, 6371.0::DOUBLE AS radius_km,
 1.0::DOUBLE AS gravity_g, 0.0::DOUBLE AS atmosphere_o2, 0.0::DOUBLE AS atmosphere_co2,
 78.0::DOUBLE AS atmosphere_n2, false AS has_water, false AS magnetic_field,
 false AS in_habitable_zone, true AS retains_atmosphere, false AS habitable_candidate,
 'local' AS source FROM archive""",
    "join_star_types": """SELECT s.*, luminosity, temp_k, mass_solar, lifespan_gy, color, xuv_factor,
 flare_risk, tidal_lock_au, min_age_gy FROM systems s JOIN star_types t USING (star_type)""",
    "join_planet_types": """SELECT planet_id, name, planet_type, base_albedo, habitable_candidate
 FROM planets_raw JOIN planet_types USING (planet_type)""",
    "join_star_fallback": f"""SELECT {_KEY}, r.star_type, coalesce(luminosity, 1.0::DOUBLE) AS luminosity,
 coalesce(xuv_factor, 1.0::DOUBLE) AS xuv_factor, coalesce(tidal_lock_au, 0.05::DOUBLE) AS tidal_lock_au
 FROM readings r LEFT JOIN star_types t ON t.star_type = r.star_type""",
    "planets_with_system": """SELECT planet_id, name, system_name, planet_type, distance_au,
 star_luminosity, star_temp_k, star_mass_solar, star_lifespan_gy, star_color, xuv_factor,
 flare_risk, hz_inner_au, hz_outer_au
 FROM planets_raw JOIN stars USING (system_name)""",
    "hz_interval_join": """SELECT planet_id, p.system_name, distance_au, hz_inner_au, hz_outer_au
 FROM planets_raw p JOIN stars s ON s.system_name = p.system_name
 AND distance_au >= hz_inner_au AND distance_au <= hz_outer_au""",
    "sensor_range_check": f"""SELECT {_KEY}, r.planet_type, {", ".join(_SENSORS.values())},
 {", ".join(f"{_out(s)} AS {s}_out" for s in _SENSORS)},
 {" + ".join(_out(s) for s in _SENSORS)} AS sensors_out FROM readings r
 {" ".join(f"JOIN profiles {s} ON {s}.planet_type = r.planet_type AND {s}.sensor = '{s}'"
           for s in _SENSORS)}""",
    "equilibrium_temperature": "SELECT planet_id, distance_au, albedo, avg_temp_celsius FROM planets",
    "stellar_flux": "SELECT planet_id, distance_au, star_luminosity, stellar_flux FROM planets",
    "surface_radiation": "SELECT planet_id, xuv_factor, surface_radiation_msv_h FROM planets",
    "tidal_lock": "SELECT planet_id, star_type, distance_au, tidally_locked FROM planets",
    "atmosphere_retention": "SELECT planet_id, gravity_g, retains_atmosphere FROM planets",
    "label_planets": "SELECT planet_id, name, star_type, planet_type, label FROM planets",
    "label_reasons": "SELECT planet_id, label_rule, label FROM planets",
    "planet_table": f"SELECT planet_id, {_PLANET_FIELDS} FROM planets",
    "habitable_zone": "SELECT system_name, star_luminosity, hz_inner_au, hz_outer_au FROM stars",
    "temperature_residual": f"""SELECT {_KEY}, tick, temperature_c, avg_temp_celsius,
 round(avg_temp_celsius + sin(tick * 0.1::DOUBLE) * 5, 6) AS expected_temp_c,
 round(temperature_c - (avg_temp_celsius + sin(tick * 0.1::DOUBLE) * 5), 6) AS temp_residual_c
 FROM readings""",
    "composition_units": f"""SELECT {_KEY}, {rnd("greatest(atmosphere_o2, CASE WHEN atmosphere_o2 IS NOT NULL THEN 0 END)", 2)} AS atmosphere_o2,
 {rnd("greatest(atmosphere_co2, 0)", 2)} AS atmosphere_co2, {rnd("greatest(atmosphere_n2, 0)", 2)} AS atmosphere_n2,
 {rnd("greatest(atmosphere_o2, CASE WHEN atmosphere_o2 IS NOT NULL THEN 0 END)", 2)} AS o2_pct,
 {rnd("greatest(atmosphere_co2 * 10000, 0)", 1)} AS co2_ppm FROM readings""",
    "size_class": """SELECT pl_name, pl_rade, pl_bmasse,
 CASE WHEN pl_rade < 1.5 AND pl_bmasse < 2 THEN 'terrestrial' WHEN pl_rade < 2.5 AND pl_bmasse < 10
  THEN 'super_earth' WHEN pl_rade < 6 THEN 'gas' ELSE 'gas_giant' END AS planet_type FROM archive""",
    "habitability_score": f"SELECT {_KEY}, habitability_score, habitability_class FROM scored",
    "score_breakdown": f"""SELECT {_KEY}, {", ".join(f"CAST({p} AS DOUBLE) AS {p}" for p in (
        "pts_zone pts_temperature pts_flux pts_oxygen pts_water pts_magnetic pts_radiation "
        "pts_nitrogen pts_carbon_dioxide pts_gravity pts_humidity pts_planet_type pts_seismic "
        "pts_wind pts_vegetation").split())},
 eliminated_by, habitability_score FROM scored""",
    "alerts": f"SELECT {_KEY}, alerts FROM alarmed",
    "alert_counts": """SELECT alert, count(*) AS n FROM (SELECT unnest(CASE WHEN len(alert_list) = 0
 THEN ['NOMINAL'] ELSE alert_list END) AS alert FROM alarmed) GROUP BY alert""",
    "decode_labels": """SELECT p_partkey, prediction, CASE prediction WHEN 0 THEN 'habitable'
 WHEN 1 THEN 'uncertain' WHEN 2 THEN 'non_habitable' ELSE 'unknown' END AS predicted_label
 FROM (SELECT p_partkey, CASE WHEN p_size % 9 <> 0 THEN CAST(p_size % 5 AS DOUBLE) END AS prediction FROM part)""",
    "profile_counts": """SELECT count(*) AS n_planets, count(DISTINCT system_name) AS n_systems
 FROM planets_raw""",
    "label_distribution": "SELECT label, count(*) AS n FROM planets GROUP BY label",
    "labels_by_star": "SELECT star_type, label, count(*) AS n FROM planets GROUP BY ALL",
    "labels_by_planet_type": "SELECT planet_type, label, count(*) AS n FROM planets GROUP BY ALL",
    "system_summary": """SELECT system_name, star_type, count(*) AS n_planets,
 count(*) FILTER (label = 'habitable') AS n_habitable,
 count(*) FILTER (label = 'uncertain') AS n_uncertain,
 count(*) FILTER (label = 'non_habitable') AS n_non_habitable
 FROM planets GROUP BY system_name, star_type""",
    "radiation_ranking": """SELECT name, star_type, distance_au, surface_radiation_msv_h,
 magnetic_field, label FROM planets ORDER BY surface_radiation_msv_h DESC, name LIMIT 20""",
    "planets_by_orbit": """SELECT system_name, name, star_type, planet_type, distance_au,
 avg_temp_celsius, stellar_flux, surface_radiation_msv_h, in_habitable_zone, atmosphere_o2,
 has_water_int, gravity_g, tidally_locked, retains_atmosphere, label, label AS predicted_label
 FROM planets ORDER BY system_name, distance_au, name LIMIT 100""",
    "batch_report": """SELECT name, star_type, planet_type, stellar_flux, surface_radiation_msv_h,
 avg_temp_celsius, in_habitable_zone, label, label AS predicted_label
 FROM planets WHERE CAST('0x' || substr(md5(name), 1, 8) AS BIGINT) >= 3650722201""",
    "classification_metrics": """, confusion AS (
 SELECT label, habitability_class AS pred, count(*) AS n FROM scored GROUP BY ALL),
by_label AS (SELECT label AS class, sum(n) AS actual FROM confusion GROUP BY label),
by_pred AS (SELECT pred AS class, sum(n) AS predicted FROM confusion GROUP BY pred),
per_class AS (
 SELECT class, actual, coalesce(n, 0) / actual AS recall,
  CASE WHEN coalesce(predicted, 0) = 0 THEN 0 ELSE coalesce(n, 0) / predicted END AS precision
 FROM by_label LEFT JOIN by_pred USING (class)
 LEFT JOIN (SELECT label AS class, n FROM confusion WHERE label = pred) USING (class)),
total AS (SELECT sum(actual) AS n FROM by_label)
SELECT CAST(any_value(t.n) AS BIGINT) AS n_rows, round(sum(actual * recall) / any_value(t.n), 9) AS accuracy,
 round(sum(actual * precision) / any_value(t.n), 9) AS weighted_precision,
 round(sum(actual * recall) / any_value(t.n), 9) AS weighted_recall,
 round(sum(actual * CASE WHEN precision + recall = 0 THEN 0
  ELSE 2 * precision * recall / (precision + recall) END) / any_value(t.n), 9) AS f1
FROM per_class, total t""",
    "feature_moments": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std"
        " FROM planets" for c in _NUMERIC_LIST),
    "sink_parquet_roundtrip": """SELECT system_name, name, star_type, planet_type, distance_au,
 avg_temp_celsius, stellar_flux, surface_radiation_msv_h, in_habitable_zone, atmosphere_o2,
 has_water_int, gravity_g, tidally_locked, retains_atmosphere, label, label AS predicted_label,
 destination FROM planets, (VALUES ('first'), ('second')) AS d(destination)""",
    "stream_replay_wire": f"SELECT {_READING_FIELDS} FROM readings",
    "stream_enrich": f"""SELECT {_ENRICHED_FIELDS}, CAST(NULL AS VARCHAR) AS ml_predicted_label
 FROM alarmed""",
    "stream_parquet_append": f"""SELECT {_ENRICHED_FIELDS}, CAST(NULL AS VARCHAR) AS ml_predicted_label, sink
 FROM alarmed, (VALUES ('processed_a'), ('processed_b')) AS s(sink)
 UNION ALL SELECT {_READING_FIELDS}, NULL, NULL, NULL, NULL, 'raw' FROM readings""",
    "stream_console_projection": """SELECT planet_name, star_type, planet_type, stellar_flux,
 surface_radiation_msv_h, avg_temp_celsius, temperature_c, atmosphere_o2, in_hz_int,
 tidally_locked_int, habitability_score, habitability_class,
 CAST(NULL AS VARCHAR) AS ml_prediction, alerts FROM alarmed""",
    "stream_static_physics": f"""SELECT planet_name, r.star_type, tick, timestamp,
 {rnd("coalesce(luminosity, 1) / power(distance_au, 2)", 6)} AS flux_now,
 {rnd('''greatest(0.00001::DOUBLE, coalesce(luminosity, 1) / greatest(power(distance_au, 2), 0.000001::DOUBLE)
   * coalesce(xuv_factor, 1) * 0.0001::DOUBLE * CASE WHEN magnetic_field_int = 1 THEN 0.1::DOUBLE ELSE 1.0::DOUBLE END
   / greatest(0.01::DOUBLE, atmosphere_n2 / 78.0::DOUBLE))''', 6)} AS radiation_now,
 CAST(distance_au <= coalesce(tidal_lock_au, 0.05::DOUBLE) AS INTEGER) AS locked_now
 FROM readings r LEFT JOIN star_types t ON t.star_type = r.star_type""",
    "stream_document_sink": f"""SELECT {_ENRICHED_FIELDS}, CAST(NULL AS VARCHAR) AS ml_predicted_label,
 CAST(0 AS BIGINT) AS _batch_id FROM alarmed""",
    "stream_epoch_snapshots": f"""SELECT {_ENRICHED_FIELDS}, 'processed' AS snapshot FROM alarmed
 UNION ALL SELECT {_READING_FIELDS}, NULL, NULL, NULL, 'raw' FROM readings""",
    "stream_fanout": f"""SELECT {_ENRICHED_FIELDS}, CAST(NULL AS VARCHAR) AS ml_predicted_label, sink
 FROM alarmed, (VALUES ('processed_a'), ('processed_b'), ('documents')) AS s(sink)
 UNION ALL SELECT {_READING_FIELDS}, NULL, NULL, NULL, NULL, 'raw' FROM readings""",
    "stream_batches": """SELECT count(*) AS n, true AS one_time, true AS all_known
 FROM readings GROUP BY l_orderkey % 3""",
    "scan_csv_problems": """, marked AS (
 SELECT planet_id % 13 = 0 AS mass, planet_id % 17 = 0 AS moons, planet_id % 19 = 0 AS line FROM planets)
SELECT 'mass_earth' AS problem, count(*) AS n FROM marked WHERE mass UNION ALL
SELECT 'moons', count(*) FROM marked WHERE moons UNION ALL SELECT 'line', count(*) FROM marked WHERE line UNION ALL
SELECT 'none', count(*) FROM marked WHERE NOT (mass OR moons OR line)""",
    "scan_csv_clean": f"""SELECT {_PLANET_FIELDS} FROM planets
 WHERE planet_id % 13 <> 0 AND planet_id % 17 <> 0 AND planet_id % 19 <> 0""",
    "sink_staged_overwrite": """SELECT name, label, 'kept' AS result FROM planets
 UNION ALL SELECT name, upper(label), 'replaced' FROM planets""",
    "decode_quality": f"""SELECT state, count(*) AS n, CAST(sum(CASE WHEN state IN ('intact', 'mismatched') THEN 1 ELSE 0 END) AS BIGINT) AS names,
 CAST(sum(CASE WHEN state = 'intact' THEN 1 ELSE 0 END) AS BIGINT) AS ticks FROM (SELECT {_STATE} AS state FROM readings) GROUP BY state""",
    "stream_committed_batches": """SELECT state, sink, count(*) AS n, CAST(sum(tick) AS BIGINT) AS ticks
 FROM readings, (VALUES ('failed', 1), ('repaired', 3)) AS t(state, parts), (VALUES ('first'), ('second'), ('third')) AS s(sink)
 WHERE l_orderkey % 3 < parts GROUP BY state, sink""",
    "stream_batch_metrics": f"""SELECT CAST(b AS BIGINT) AS batch, count(state) AS "rows", count(*) FILTER (state = 'intact') AS intact,
 count(*) FILTER (state = 'mismatched') AS mismatched, count(*) FILTER (state = 'malformed') AS malformed,
 count(*) FILTER (state = 'missing') AS missing
FROM (VALUES (0), (1), (2)) AS v(b) LEFT JOIN (
 SELECT CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE 2 END AS b, {_STATE} AS state FROM readings) r USING (b) GROUP BY b""",
    "stream_progress": """, batches AS (
 SELECT CAST(l_orderkey % 3 AS BIGINT) AS batch, count(*) AS n FROM readings GROUP BY 1)
SELECT 'whole' AS query, 'batch' AS event, batch, n AS "rows" FROM batches
UNION ALL SELECT 'broken', 'batch', batch, n FROM batches WHERE batch = 0
UNION ALL SELECT query, event, NULL, NULL FROM (VALUES ('whole', 'started'), ('whole', 'ended'),
 ('broken', 'started'), ('broken', 'failed')) AS e(query, event)""",
    "stream_restart": f"""SELECT {_ENRICHED_FIELDS}, CAST(NULL AS VARCHAR) AS ml_predicted_label
 FROM alarmed""",
    "string_index": """, counts AS (
 SELECT 'star_type' AS column_name, star_type AS category, count(*) AS n FROM planets_raw GROUP BY ALL
 UNION ALL SELECT 'planet_type', planet_type, count(*) FROM planets_raw GROUP BY ALL)
SELECT column_name, category, n,
 CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, category) - 1 AS DOUBLE) AS idx
FROM counts""",
    "one_hot": """, star_rank AS (
 SELECT star_type, row_number() OVER (ORDER BY count(*) DESC, star_type) - 1 AS r, count(*) OVER () AS k
 FROM planets GROUP BY star_type),
planet_rank AS (
 SELECT planet_type, row_number() OVER (ORDER BY count(*) DESC, planet_type) - 1 AS r, count(*) OVER () AS k
 FROM planets GROUP BY planet_type)
SELECT planet_id, p.star_type, p.planet_type,
 repeat('0,', s.r) || '1' || repeat(',0', s.k - s.r - 1) AS star_slots,
 repeat('0,', q.r) || '1' || repeat(',0', q.k - q.r - 1) AS planet_slots
FROM planets p JOIN star_rank s ON s.star_type = p.star_type
JOIN planet_rank q ON q.planet_type = p.planet_type""",
    "assemble_features": f"""SELECT planet_id, (SELECT CAST(count(DISTINCT star_type)
 + count(DISTINCT planet_type) + {len(_NUMERIC_LIST)} AS INTEGER) FROM planets) AS n_slots,
 2.0::DOUBLE AS encoded_sum, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERIC_LIST)}
 FROM planets""",
    "scale_features": "SELECT planet_id, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}" for c in _NUMERIC_LIST)
    + " FROM planets",
    "stratified_folds": """SELECT planet_id, name, label, CAST((row_number() OVER (PARTITION BY label
 ORDER BY CAST('0x' || substr(md5(name), 1, 8) AS BIGINT), name) - 1) % 5 AS INTEGER) AS fold FROM planets""",
    "train_predict": f"""SELECT count(*) AS n_rows, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS weighted_precision,
 1.0::DOUBLE AS weighted_recall, 1.0::DOUBLE AS f1
 FROM planets WHERE CAST('0x' || substr(md5(name), 1, 8) AS BIGINT) >= 3650722201""",
    "score_all": f"""SELECT system_name, name, star_type, planet_type, distance_au,
 avg_temp_celsius, stellar_flux, surface_radiation_msv_h, in_habitable_zone, atmosphere_o2,
 has_water_int, gravity_g, tidally_locked, retains_atmosphere, {_EXACT} AS label,
 {_EXACT} AS predicted_label FROM planets""",
    "predicted_system_summary": f"""SELECT system_name, star_type, count(*) AS n_planets,
 count(*) FILTER ({_EXACT} = 'habitable') AS n_habitable, CAST(0 AS BIGINT) AS n_uncertain,
 count(*) FILTER ({_EXACT} = 'non_habitable') AS n_non_habitable
 FROM planets GROUP BY system_name, star_type""",
    "feature_importance": """, star_rank AS (
 SELECT 'star_type_vec_' || star_type AS feature, row_number() OVER (ORDER BY count(*) DESC, star_type) AS r
 FROM planets GROUP BY star_type),
planet_rank AS (
 SELECT 'planet_type_vec_' || planet_type AS feature, row_number() OVER (ORDER BY count(*) DESC, planet_type) AS r
 FROM planets GROUP BY planet_type),
parts AS (SELECT 1 AS part, r, feature FROM star_rank UNION ALL SELECT 2, r, feature FROM planet_rank
 UNION ALL SELECT 3, r, feature FROM (VALUES """ + ", ".join(
        f"({i}, '{c}')" for i, c in enumerate(_NUMERIC_LIST)) + """) AS n(r, feature))
SELECT CAST(row_number() OVER (ORDER BY part, r) - 1 AS INTEGER) AS slot, feature, 1.0::DOUBLE AS total,
 true AS is_share FROM parts""",
    "cross_validate": f""", grid AS (
 SELECT CAST(row_number() OVER (ORDER BY t, d, m) - 1 AS INTEGER) AS setting,
  'maxDepth=' || d || ', minInstancesPerNode=' || m || ', numTrees=' || t AS params
 FROM (VALUES (50), (100), (200)) AS a(t), (VALUES (4), (6), (8)) AS b(d), (VALUES (1), (2)) AS c(m)),
folds AS (SELECT label, CAST((row_number() OVER (PARTITION BY label
  ORDER BY CAST('0x' || substr(md5(name), 1, 8) AS BIGINT), name) - 1) % 5 AS INTEGER) AS fold
 FROM (SELECT name, {_EXACT} AS label FROM planets)),
held_out AS (SELECT fold, label, count(*) AS n FROM folds GROUP BY fold, label)
SELECT setting, fold, label, label AS predicted, n, params, 1.0::DOUBLE AS accuracy FROM grid, held_out""",
    "best_params": """SELECT CAST(18 AS BIGINT) AS n_settings, CAST(5 AS BIGINT) AS n_folds, count(label) AS n_held_out, true AS known_trees,
 true AS known_depth, true AS known_instances, true AS is_best FROM planets""",
    "importance_threshold": """, cells AS (
 SELECT has_water AS w, in_habitable_zone AS z, CAST(count(*) AS DOUBLE) AS n FROM planets GROUP BY ALL),
sums AS (SELECT sum(n) AS a, sum(n) FILTER (w) AS w, sum(n) FILTER (z) AS z, sum(n) FILTER (w AND z) AS h FROM cells),
-- Gini impurity of a node of x rows, y of them habitable, times x: 2 * y * (x - y) / x.
decrease AS (SELECT *, 2 * h * (a - h) / a - 2 * h * (w - h) / w AS by_water, 2 * h * (a - h) / a - 2 * h * (z - h) / z AS by_zone FROM sums),
parts AS (
 SELECT unnest(['has_water_int', 'in_hz_int']) AS feature,
  unnest(CASE WHEN by_zone > by_water THEN [2 * h * (z - h) / z, by_zone] ELSE [by_water, 2 * h * (w - h) / w] END) AS d FROM decrease)
SELECT feature, round(d / sum(d) OVER (), 6) AS importance FROM parts""",
    "stream_predict": f"""SELECT planet_name, tick, timestamp, habitability_class,
 CASE WHEN habitable_candidate_int = 1 THEN 'habitable' ELSE 'non_habitable' END AS ml_predicted_label FROM alarmed""",
    "alert_codes": f"""SELECT {_KEY}, CAST(generate_subscripts(alert_list, 1) - 1 AS INTEGER) AS position,
 unnest(alert_list) AS code FROM alarmed WHERE len(alert_list) > 0
 UNION ALL SELECT {_KEY}, NULL, NULL FROM alarmed WHERE len(alert_list) = 0""",
    "model_roundtrip": "SELECT count(*) AS n, count(*) AS n_same FROM planets",
    "hash_split": """SELECT planet_id, name, CASE WHEN
 CAST('0x' || substr(md5(name), 1, 8) AS BIGINT) < 3650722201 THEN 'train' ELSE 'test' END AS split
 FROM planets_raw""",
}

ORACLES = {name: _VIEWS + body for name, body in _BODIES.items()}

# The same views over readings in which some measures are missing.
ORACLES["assess_nan"] = _VIEWS.replace("readings AS (", "whole_readings AS (", 1).replace(
    "points AS (",
    """readings AS (SELECT * REPLACE (
 CASE WHEN l_orderkey % 7 <> 0 THEN stellar_flux END AS stellar_flux,
 CASE WHEN l_orderkey % 5 <> 0 THEN temperature_c END AS temperature_c,
 CASE WHEN l_orderkey % 3 <> 0 THEN seismic_activity END AS seismic_activity) FROM whole_readings),
points AS (""", 1) + f"SELECT {_KEY}, habitability_score, habitability_class, alerts FROM alarmed"
