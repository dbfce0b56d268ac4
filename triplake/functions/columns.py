"""Expressions for optional columns, text tokens and zone-free clock arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def optional_col(df: DataFrame, *names: str) -> str:
    """The column under any of the spellings, NULL when the frame has none.

    Letter case is ignored, as sources change it between months. Several
    matches are merged, the first non-NULL value wins.
    """
    wanted = {name.lower() for name in names}
    found = [f"`{name}`" for name in df.columns if name.lower() in wanted]
    if len(found) > 1:
        return f"coalesce({', '.join(found)})"
    return found[0] if found else "NULL"


def token_flag(value: str, true_tokens: Sequence[str], false_tokens: Sequence[str]) -> str:
    """Boolean from text tokens (case matters); any other text is NULL."""

    def is_one_of(tokens: Sequence[str]) -> str:
        listed = ", ".join(f"'{token}'" for token in tokens)
        return f"cast({value} AS string) IN ({listed})"

    return f"CASE WHEN {is_one_of(true_tokens)} THEN true WHEN {is_one_of(false_tokens)} THEN false END"


def epoch_second(ts: str) -> str:
    """Whole seconds since 1970 of a zone-less timestamp, whatever the session zone.

    Casting through a zoned timestamp would lose or gain an hour at clock changes.
    """
    return f"(unix_date(cast({ts} AS date)) * 86400L + hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}))"


def seconds_between(start: str, end: str) -> str:
    """Difference of the whole seconds of two zone-less timestamps."""
    return f"({epoch_second(end)} - {epoch_second(start)})"


def lasts_at_most(start: str, end: str, seconds: int) -> str:
    """seconds_between(start, end) <= seconds, deciding almost every row by one subtraction.

    Between the limit and one second above it, dropping the fractions gets the
    difference down to the limit exactly when they did not shrink from start to end.
    """
    fraction = "extract(SECOND FROM {}) % 1"
    return (
        f"({end} - {start} <= INTERVAL '{seconds}' SECOND"
        f" OR ({end} - {start} < INTERVAL '{seconds + 1}' SECOND"
        f" AND {fraction.format(end)} >= {fraction.format(start)}))"
    )
