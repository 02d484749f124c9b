"""Vector analytics on Spark DataFrames."""

from nearspan.config import IndexConfig
from nearspan.index import VectorIndex
from nearspan.plans.search import Limits

__all__ = ["IndexConfig", "Limits", "VectorIndex"]
