"""The registered queries over the test tables, each beside the SQL it must agree with."""

from quillsift.workload import cleaning, flows, loading, relational, storage
from quillsift.workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "cleaning", "flows", "loading", "relational", "storage"]
