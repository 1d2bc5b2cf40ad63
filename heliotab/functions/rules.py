"""Rule sets are ordered data: (SQL predicate, result).  Here they become columns.

A predicate that is NULL does not fire, so a missing measure never triggers a rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, object]]


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else f"{value!r}D"


def first_match_sql(rules: Rules, default: object = None) -> str:
    """The result of the first predicate that holds, as a CASE expression."""
    branches = " ".join(f"WHEN {predicate} THEN {_literal(result)}" for predicate, result in rules)
    return f"CASE {branches} ELSE {_literal(default)} END"


def first_match(rules: Rules, default: object = None) -> Column:
    return F.expr(first_match_sql(rules, default))


def any_match_sql(rules: Rules) -> str:
    return " OR ".join(f"({predicate})" for predicate, _ in rules)


def own_method(sql: str) -> str:
    """The same value, computed in a method of its own.

    Spark generates one method for all projections of a stage, and the JVM does not compile methods
    above 8000 bytes.  An expression that is used twice in a projection is computed once, in a separate
    method if it is long: hence the greatest of the value and itself.  For expressions that are
    always evaluated; inside a CASE branch it would be computed twice.
    """
    return f"greatest({sql}, {sql})"
