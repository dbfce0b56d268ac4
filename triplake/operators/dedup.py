"""Removing records that no attribute tells apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from triplake.functions.keys import content_identity

# Attributes outside the content fingerprint, in the order that picks the survivor.
SURVIVOR_ORDER = ("source_file", "ingested_at", "is_shared_ride")


def numbered_copies(df: DataFrame, name: str, within: Sequence[str] = ()) -> DataFrame:
    """The rows with their place, from 1, among those of the same content (and the same columns `within`)."""
    by, first = ", ".join([*content_identity(), *within]), ", ".join(SURVIVOR_ORDER)
    return df.selectExpr("*", f"row_number() OVER (PARTITION BY {by} ORDER BY {first}) AS {name}")


def one_per_content(df: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Keep one row per record content (and columns `within`), the same one on every run.

    Asking for the first row only lets Spark cut each task's rows to one per
    content before the shuffle as well as after it, so a content that makes up
    a large part of the data never gathers in one task.
    """
    return numbered_copies(df, "_first", within).where("_first = 1").drop("_first")
