"""Registered queries over the graph view, and the SQL that gives the same rows."""

from . import core, graph, jobs, learning, more, staged  # noqa: F401  each module registers its queries
from .view import ORACLE_SQL, QUERIES  # noqa: F401
