"""All named queries."""

from txlake.workload import dimensions, landing, loads, preparation, streams, transactions
from txlake.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "dimensions", "landing", "loads", "preparation", "streams", "transactions"]
