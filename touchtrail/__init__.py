"""Single-touch marketing credit over web-analytics events, on Spark DataFrames."""

from touchtrail.params import Params
from touchtrail.session import configure, get_session

__all__ = ["Params", "configure", "get_session"]
