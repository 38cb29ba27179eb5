"""Plan shaping shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns by expressions that are evaluated once per row.

    A filter on a plain projected column is pushed below the projection with the expression copied
    into it, so costly text or JSON work would run twice. Values that come out of a generator are
    not copied.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    row = F.array(F.struct(*[e.alias(n) for n, e in cols.items()]))
    return df.select(*keep, F.inline(row))
