"""Where the monthly files of each category are."""

from __future__ import annotations

from dataclasses import dataclass

from triplake.config import FILE_PREFIXES, Settings


@dataclass(frozen=True)
class MonthFile:
    """One month of one category. The month comes from the name, not from the data."""

    path: str
    name: str
    year: int
    month: int


def month_files(settings: Settings, taxi_type: str) -> list[MonthFile]:
    files = []
    for year, month in settings.year_months:
        name = f"{FILE_PREFIXES[taxi_type]}_{year:04d}-{month:02d}.parquet"
        files.append(MonthFile(f"{settings.landing}/{taxi_type}/{name}", name, year, month))
    return files
