from triplake.sources.canonical import to_canonical
from triplake.sources.files import MonthFile, month_files
from triplake.sources.ingest import read_months, union_all, union_months

__all__ = ["MonthFile", "month_files", "read_months", "to_canonical", "union_all", "union_months"]
