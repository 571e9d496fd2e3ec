"""Rounding rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_even(value: Column, places: int = 2) -> Column:
    """Scale, round half to even, unscale: the rule of numeric array libraries."""
    scale = float(10**places)
    return F.rint(value * scale) / scale


def whole_half_even(value: Column) -> Column:
    return F.bround(value).cast("bigint")
