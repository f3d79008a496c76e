"""Successor of each row inside a group in a total order (``lead``), safe
when one group holds a large share of all rows.

Every group is cut into slices of neighbouring rows (a minute of its actions,
say), and the window sorts one slice, not one group.  The last row of each
slice then takes the first value of the group's next slice from a second window
over one row per slice, whose size is bounded by the number of slices, not by
rows.  There is one path for groups of every size: nothing is counted first,
and a null group or slice is one like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_in_group(df: DataFrame, group: str, order: Sequence[str], value: str, out: str = "next_value",
                  *, slice_by: Column) -> DataFrame:
    """``df`` plus ``out`` = ``value`` of the next row of the same ``group`` in
    ``order`` (null for a group's last row).  ``order`` must be a total order
    inside a group (end it with a unique id).

    ``slice_by`` must never fall as ``order`` rises (nulls first), such as a prefix
    of a time text that the order begins with; rows of one group and slice
    are sorted in one task."""
    inside = Window.partitionBy(group, "_slice").orderBy(*order)
    own = (df.withColumn("_slice", slice_by)
           .select("*", F.lead(value).over(inside).alias(out), F.lead(F.lit(True)).over(inside).alias("_more"),
                   F.first(value).over(inside).alias("_first")))
    across = Window.partitionBy(group).orderBy("_slice")
    ends = own.where("_more IS NULL").withColumn(out, F.lead("_first").over(across))
    cols = [*df.columns, out]
    return own.where("_more").select(*cols).unionByName(ends.select(*cols))
