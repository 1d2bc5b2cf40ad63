"""Translation between the engine's codes and the wording of existing data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab

_COLUMNS = {
    "star_type": vocab.STAR_TYPES,
    "planet_type": vocab.PLANET_TYPES,
    "star_color": vocab.STAR_COLORS,
    "label": vocab.LABELS,
    "predicted_label": vocab.LABELS,
    "ml_predicted_label": vocab.LABELS,
    "ml_prediction": vocab.LABELS,
    "habitability_class": vocab.SCORE_CLASSES,
}


def _replace_terms(df: DataFrame, reverse: bool) -> DataFrame:
    for column, terms in _COLUMNS.items():
        if column in df.columns:
            changed = {a: b for a, b in terms.items() if a != b}
            if reverse:
                changed = {b: a for a, b in changed.items()}
            if changed:
                df = df.replace(changed, subset=[column])
    return df


def _alert_texts(alerts: Column) -> Column:
    texts = F.create_map(*[F.lit(x) for pair in vocab.ALERTS.items() for x in pair])
    codes = F.split(alerts, r" \| ")
    return F.array_join(F.transform(codes, lambda code: texts[code]), vocab.ALERT_SEPARATOR)


def to_codes(df: DataFrame) -> DataFrame:
    """Existing wording to codes; terms outside the vocabulary stay as they are."""
    return _replace_terms(df, reverse=True)


def to_wording(df: DataFrame) -> DataFrame:
    """Codes to existing wording, alert texts included."""
    df = _replace_terms(df, reverse=False)
    if "alerts" in df.columns:
        df = df.withColumn("alerts", _alert_texts(F.col("alerts")))
    return df
