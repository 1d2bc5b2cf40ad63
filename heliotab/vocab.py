"""Names of star types, planet types, classes and alerts, and their wording in existing data.

Inside the engine every term is a plain ASCII code.  Topics, CSV files and dashboards
that already exist use the wording on the right; ``sources.terms`` translates between the two.
"""

# Star types.
STAR_TYPES = {
    "red_dwarf": "Naine rouge",
    "orange_dwarf": "Naine orange",
    "yellow_dwarf": "Naine jaune",
    "white_dwarf": "Naine blanche",
    "blue_giant": "Geante bleue",
    "red_giant": "Geante rouge",
    "subgiant": "Sous-geante",
    "unknown": "Unknown",
}

# Planet types.
PLANET_TYPES = {
    "terrestrial": "Tellurique",
    "super_earth": "Super-Terre",
    "ocean": "Ocean",
    "gas": "Gazeuse",
    "gas_giant": "Geante gazeuse",
    "ice_dwarf": "Naine glacee",
    "lava": "Lave",
    "unknown": "Unknown",
}

# Star colours.
STAR_COLORS = {
    "red": "rouge",
    "orange": "orange",
    "yellow": "jaune",
    "white": "blanche",
    "blue": "bleue",
}

# Labels of the catalogue and of the classifier.
LABELS = {
    "habitable": "habitable",
    "uncertain": "inconnue",
    "non_habitable": "non_habitable",
}

# Classes shown next to the score.
SCORE_CLASSES = {
    "habitable": "🟢 habitable",
    "uncertain": "🟡 inconnue",
    "non_habitable": "🔴 non_habitable",
}

# Alert texts, in the order in which they are raised.
ALERTS = {
    "TEMP_HIGH": "🔥 TEMPERATURE CRITIQUE",
    "TEMP_LOW": "🧊 FROID EXTREME",
    "RAD_LETHAL": "☢️  RADIATION LETALE",
    "RAD_HIGH": "⚠️  RADIATION ELEVEE",
    "QUAKE": "🌋 SEISME MAJEUR",
    "STORM": "🌪️  TEMPETE EXTREME",
    "O2_LOW": "😮 O2 INSUFFISANT",
    "FLUX_FATAL": "☀️  FLUX STELLAIRE FATAL",
    "TIDAL_LOCK": "🔒 VERROUILLAGE MAREE",
    "NOMINAL": "✅ RAS",
}

ALERT_SEPARATOR = " | "
UNKNOWN = "unknown"
HABITABLE, UNCERTAIN, NON_HABITABLE = LABELS
