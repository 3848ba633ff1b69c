"""landinglake: landing folders to queryable lake tables, on Spark."""

from landinglake.session import build_session

__all__ = ["build_session"]
__version__ = "0.1.0"
