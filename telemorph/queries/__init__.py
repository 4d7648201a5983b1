"""Registered queries and the SQL each of them is checked against."""

from telemorph.queries import registry

registry.load_all()

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
