"""The library run over the given tables. Importing the package registers all queries."""

from feedloom.lens import feeds, jobs, lookups, taxonomies, texts  # noqa: F401
from feedloom.lens.registry import ORACLE, QUERIES  # noqa: F401
