"""Product and business analytics operators over Spark DataFrames."""

from growthkit.session import get_session

__all__ = ["get_session"]
