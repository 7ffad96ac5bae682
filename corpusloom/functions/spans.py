"""Matches of a regex as native arrays, and their offsets."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def matches(text: Column, pattern: str, groups: dict[str, int] | None = None) -> Column:
    """array<struct<gap, match, ...>>: every match with the text between it and the one before, and named groups ('' where a group is
    absent). A last element, whose match is null, has the text after the last match."""
    found = [F.split(text, pattern, -1), *(F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, *(groups or {}).values()))]
    return F.arrays_zip(*(c.alias(k) for c, k in zip(found, ["gap", "match", *(groups or {})], strict=True)))


def start_of(keys: list[str], order: str, gap: Column, size: Column) -> Column:
    """0-based offset of each match among rows, one a match: all gaps up to it and all matches before it, as running sums."""
    upto = Window.partitionBy(*keys).orderBy(order)
    before = F.sum(size).over(upto.rowsBetween(Window.unboundedPreceding, -1))
    return F.sum(gap).over(upto.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(before, F.lit(0))
