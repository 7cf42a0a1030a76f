"""Every query of the engine with the SQL that must give the same rows."""

from ledgerloom.registry import projections, relations, scans, schema_ops, streams

_MODULES = (scans, schema_ops, projections, relations, streams)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
