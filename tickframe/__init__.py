"""tickframe: tick and event time series on PySpark DataFrames."""

from tickframe.session import prepare

__all__ = ["prepare"]
