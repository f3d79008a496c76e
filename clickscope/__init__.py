"""clickscope: visit-log and ad-click analytics on Spark DataFrames.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
built-in Spark SQL expressions; nothing runs until the caller acts.
"""

from clickscope.params import TaskParams

__all__ = ["TaskParams"]
