"""Registered queries: each runs an operator or mart over the given tables; SQL for the same rows is in ``oracle``."""

from creaseline.queries.matches import QUERIES as _MATCHES
from creaseline.queries.oracle import ORACLE_SQL
from creaseline.queries.warehouse import QUERIES as _WAREHOUSE

QUERIES = _MATCHES | _WAREHOUSE

__all__ = ["ORACLE_SQL", "QUERIES"]
