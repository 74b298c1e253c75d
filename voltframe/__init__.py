"""Power-grid model analytics on Spark DataFrames."""

from voltframe.model import GridModel

__all__ = ["GridModel"]
