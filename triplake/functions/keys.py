"""SHA-256 keys: what a record says, and which ride it is about."""

from __future__ import annotations

from collections.abc import Sequence

# Fields of each key in order, their separator and the text for NULL.
RECORD_FIELDS = (
    "taxi_type",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "provider_id",
    "trip_distance",
    "fare_amount",
)
RIDE_FIELDS = (
    "taxi_type",
    "provider_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
)
SEPARATOR = "|"
NULL_TEXT = "null"

_DOUBLE_FIELDS = ("trip_distance", "fare_amount")
_TEXT_FIELDS = ("taxi_type", "provider_id")


def _as_text(name: str) -> str:
    return f"coalesce(cast({name} AS string), '{NULL_TEXT}')"


def _digest(names: Sequence[str]) -> str:
    return f"sha2(concat_ws('{SEPARATOR}', {', '.join(map(_as_text, names))}), 256)"


# Fingerprint of a record's content: when, where, who, how far, for how much.
RECORD_HASH = _digest(RECORD_FIELDS)

# Identity of a ride. Distance and money are left out: they are measured, not agreed.
RIDE_KEY = _digest(RIDE_FIELDS)


def content_identity() -> list[str]:
    """Grouping expressions that fall together exactly where RECORD_HASH does.

    Grouping by the fields themselves spares a shuffle the 64-character digest.
    Timestamps and integers print one text per value and never the NULL text, so
    they stay as they are. Text may itself be the NULL text. Doubles go by their
    text, because grouping merges 0.0 with -0.0 and the digest does not.
    """
    by_text = _DOUBLE_FIELDS + _TEXT_FIELDS
    return [_as_text(name) if name in by_text else name for name in RECORD_FIELDS]
