"""Player-behaviour analytics on Spark DataFrames."""

from playerlens.settings import Settings

__all__ = ["Settings"]
