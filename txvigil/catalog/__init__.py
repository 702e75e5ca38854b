"""Every operator as a query over the given tables, and the same in SQL."""

from txvigil.catalog.oracles import ORACLES
from txvigil.catalog.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
