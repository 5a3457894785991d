from kestrel.sources.tables import table, TABLES
from kestrel.sources import adapters

__all__ = ["table", "TABLES", "adapters"]
