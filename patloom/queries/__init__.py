"""The registered queries over the given tables, each with the SQL that must agree with it."""

from patloom.queries import archives, filters, keys, names, records, sinks, texts
from patloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "archives", "filters", "keys", "names", "records", "sinks", "texts"]
