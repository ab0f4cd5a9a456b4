"""Column helpers that shape the optimized plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, expr: Column, name: str, keep: tuple[str, ...] | list[str]) -> DataFrame:
    """``df`` projected to ``keep`` plus ``expr`` as ``name``, evaluated once.

    Catalyst pushes filters below projections by substituting the projected
    expression into the predicate; for an expensive expression (parsing a
    whole JSON document) that is referenced many times by the checks above,
    this multiplies the parse per row. A one-element ``explode`` is a plan
    node predicates cannot be pushed through, so the value is computed once
    per row and every later reference reads the column. One output row per
    input row; a null value stays a row.
    """
    return df.select(*[F.col(k) for k in keep], F.explode(F.array(expr)).alias(name))
