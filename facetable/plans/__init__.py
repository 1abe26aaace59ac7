"""The facade over one table, and the queries that show each part at work."""

from facetable.plans.expose import ModeNotEnabled, TableHandle, open_table

__all__ = ["ModeNotEnabled", "TableHandle", "open_table"]
