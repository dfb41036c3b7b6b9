"""Registered queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from auditlake.queries.registry import ORACLES, QUERIES
from auditlake.queries import archive, checks, fields, files, operations, reports, streams, windows  # noqa: F401  (register)

__all__ = ["ORACLES", "QUERIES"]
