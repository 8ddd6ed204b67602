"""feedfold: turn change feeds into current-state tables with Spark DataFrames."""

from feedfold.options import Options

__all__ = ["Options"]
