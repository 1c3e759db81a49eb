"""Runnable queries with the SQL that states the same result."""

from corpusloom.catalog import cleaning, files, formats, generation, incremental, judging, planning, responses

_MODULES = (files, planning, responses, cleaning, judging, formats, incremental, generation)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
