"""Busy spells: trips of a key that follow one another without a long gap."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def busy_spells(rows: DataFrame, keys: list[str], at: str, gap: str, measures: list[Column]) -> DataFrame:
    """Per key and spell: begins, ends (the last row's time plus the gap), and the measures over its rows.

    A row belongs to the spell before it while no more than the gap has passed since
    that spell's last row; a later one begins a new spell. Rows without
    a time are left out, NULL keys are a key. Works on a batch and, behind a
    watermark, on a stream, with the same result.
    """
    spell = F.session_window(at, gap)
    found = rows.where(F.col(at).isNotNull()).groupBy(*keys, spell.alias("_spell")).agg(*measures)
    return found.withColumns({"begins": F.col("_spell.start"), "ends": F.col("_spell.end")}).drop("_spell")


def spells_of_instants(rows: DataFrame, keys: list[str], at: str, gap_seconds: int, measure: str) -> DataFrame:
    """The same spells of a batch with the sum of `measure`, for keys that hold a large share of all rows.

    Rows of one instant are added up before the shuffle; what is sorted per key
    is instants, of which a key has as many as seconds with a pickup, not trips.
    """
    instants = rows.where(F.col(at).isNotNull()).groupBy(*keys, at).agg(F.count("*").alias("_rows"), F.sum(measure).alias("_sum"))
    measures = [F.sum("_rows").alias("row_count"), F.sum("_sum").alias(measure), F.count("*").alias("instants")]
    return busy_spells(instants, keys, at, f"{gap_seconds} seconds", measures)
