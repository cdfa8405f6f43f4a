"""Named queries over the sample tables, each with an independent SQL statement."""

from retinue.catalog import inputs, outputs, scalars, searches, users

_MODULES = (inputs, users, searches, scalars, outputs)

QUERIES = {name: q for m in _MODULES for name, q in m.catalog.queries.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.catalog.sql.items()}
