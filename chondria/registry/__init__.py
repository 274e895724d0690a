"""Queries over the driver tables and the SQL that checks them."""

from chondria.registry.queries import QUERIES
from chondria.registry.oracle import ORACLE
from chondria.registry import file_oracle, files

__all__ = ["ORACLE", "QUERIES", "file_oracle", "files"]
