"""Expected slots, what covers them, and coverage figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spine(entities: DataFrame, key: str, first: Column | int, last: Column | int, kinds: Sequence[str] = (), year: str = "year") -> DataFrame:
    """Entity x year (x kind); a range that is empty gives no slots."""
    lo, hi = (x if isinstance(x, Column) else F.lit(x) for x in (first, last))
    out = entities.where(lo <= hi).select(key, F.explode(F.sequence(lo, hi)).alias(year))
    return out.withColumn("kind", F.explode(F.array(*map(F.lit, kinds)))) if kinds else out


def covered(slots: DataFrame, facts: DataFrame, on: Sequence[str]) -> DataFrame:
    return slots.join(facts, list(on), "left_semi")


def missing(slots: DataFrame, facts: DataFrame, on: Sequence[str]) -> DataFrame:
    return slots.join(facts, list(on), "left_anti")


def rate(part: Column, whole: Column) -> Column:
    """Per cent to two places, 0 of nothing."""
    return F.when(whole > 0, F.bround(100.0 * part / whole, 2)).otherwise(F.lit(0.0))


def cascade_sources(slots: DataFrame, sources: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Each source is asked only for the slots that the ones before left open."""
    out = None
    for facts in sources:
        hits = facts.join(slots, list(on), "left_semi")
        slots = slots.join(hits, list(on), "left_anti")
        out = hits if out is None else out.unionByName(hits)
    return out
