"""Decimal rounding of doubles by their exact binary value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPLITTER = "134217729D"  # 2**27 + 1 cuts a double into two halves whose products are exact
_ALL_WHOLE = "4503599627370496D"  # from 2**52 on, a double has no fraction left to round


def with_rounded(df: DataFrame, quantities: dict[str, tuple[Column, int]]) -> DataFrame:
    """Add columns given as name -> (expression, digits), rounded half to even.

    ``F.round`` rounds the shortest decimal text of a double, so 726.85 (slightly above the tie
    in binary) and 226.85 (slightly below) both go up.  Stored catalogues were rounded on the
    binary value; kelvin to Celsius puts every whole kelvin next to such a tie, so the choice is
    visible in the data.  Here the exact error of ``x * 10**digits`` decides the ties.

    The steps are plain double arithmetic, so no row makes a decimal object.  NULL travels through
    them as NaN, which needs no checks and keeps the generated method small enough for the JVM to
    compile; a NaN result is NULL again at the end.
    """
    scale = {name: f"{10**digits}D" for name, (_, digits) in quantities.items()}
    steps = [
        {"{x}": None},
        {"_{x}_scaled": "{x} * {s}", "_{x}_high": "{x} * {k} - ({x} * {k} - {x})"},
        {
            "_{x}_nearest": "rint(_{x}_scaled)",
            "_{x}_error": "(_{x}_high * {s} - _{x}_scaled) + ({x} - _{x}_high) * {s}",
        },
        {"_{x}_off": "_{x}_scaled - _{x}_nearest"},
        {
            "{x}": "nanvl(if(abs(_{x}_scaled) >= {whole}, {x}, (_{x}_nearest + if(abs(_{x}_off)"
            " = 0.5D AND _{x}_off * _{x}_error > 0, 2D * _{x}_off, 0D)) / {s}), NULL)"
        },
    ]
    for step in steps:
        added = {}
        for x, (column, _) in quantities.items():
            names = {"x": x, "s": scale[x], "k": _SPLITTER, "whole": _ALL_WHOLE}
            for name, sql in step.items():
                known = F.coalesce(column, F.lit(float("nan")))
                known = F.greatest(known, known)  # in a method of its own, see rules.own_method
                added[name.format(**names)] = F.expr(sql.format(**names)) if sql else known
        df = df.withColumns(added)
    return df.drop(
        *[f"_{x}_{part}" for x in quantities for part in "scaled high nearest error off".split()]
    )
