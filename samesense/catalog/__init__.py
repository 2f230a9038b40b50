"""Named queries over the supplied tables, one or more per operator."""

from samesense.catalog import replies, scalars, similarity, tables  # noqa: F401
from samesense.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
