"""The registered queries, the SQL they are checked against, and their landing folders."""

from landinglake.registry.oracles import ORACLES
from landinglake.registry.queries import QUERIES, flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
