"""Row numbers and group minima where one group may hold any share of the rows.

A window over a group is one task. Here rows are laid out in ranges of (group, order) first, so a large group
spans many ranges, whatever its rows have in common. Numbers are counted inside (range, group) and shifted by the group's
rows in earlier ranges. A boundary between two ranges cuts at most one group, so the shifts are a table of no more rows
than there are ranges, found by looking at the cut groups only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.plans.workspace import stored

PART = "__part"


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


@dataclass(frozen=True)
class RangeLayout:
    """Rows with the number of their range; ``keys`` led the order of the ranges, NULLs first.

    ``ends`` holds the keys' first and last values of each range: two rows per range.
    """

    frame: DataFrame
    keys: list[str]
    ends: list[tuple[int, tuple]]

    def _cut(self, group: list[str]) -> DataFrame | None:
        """The groups at a boundary, at most one per range, or None; ``group`` is a prefix of the keys."""
        parts: dict[tuple, set[int]] = {}
        for part, values in self.ends:
            parts.setdefault(values[: len(group)], set()).add(part)
        cut = [values for values, of in parts.items() if len(of) > 1]
        if not cut:
            return None
        types = T.StructType([T.StructField(f"__{c}", self.frame.schema[c].dataType) for c in group])
        return self.frame.sparkSession.createDataFrame(cut, types)

    def _of_cut(self, group: list[str], *measures: Column) -> DataFrame | None:
        """Measures per (range, cut group), None where no group is cut."""
        cut = self._cut(group)
        if cut is None:
            return None
        rows = self.frame.join(F.broadcast(cut), _same(group, [f"__{c}" for c in group]), "left_semi")
        return rows.groupBy(PART, *group).agg(*measures)

    def _beside(self, df: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
        """``df`` with the columns of a table that is bounded by the number of ranges."""
        names = [f"__of_{c}" for c in on]
        right = F.broadcast(small.withColumnsRenamed(dict(zip(on, names))))
        return df.join(right, _same(on, names), "left").drop(*names)

    def with_row_number(self, df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
        """``row_number`` over (group, order), which together lead the layout's keys."""
        inside = F.row_number().over(Window.partitionBy(PART, *group).orderBy(*order))
        counts = self._of_cut(group, F.count("*").alias("n"))
        if counts is None:
            return df.withColumn(name, inside)
        earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        shifts = counts.select(PART, *group, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__shift"))
        counted = self._beside(df.withColumn(name, inside), shifts, [PART, *group])
        return counted.withColumn(name, F.col(name) + F.coalesce("__shift", F.lit(0))).drop("__shift")

    def with_minimum(self, df: DataFrame, group: list[str], value: Column, name: str) -> DataFrame:
        """The smallest ``value`` of each group, which leads the layout's keys."""
        inside = df.withColumn(name, F.min(value).over(Window.partitionBy(PART, *group)))
        least = self._of_cut(group, F.min(value).alias("m"))
        if least is None:
            return inside
        met = self._beside(inside, least.groupBy(*group).agg(F.min("m").alias("__least")), group)
        return met.withColumn(name, F.coalesce("__least", name)).drop("__least")


def range_layout(df: DataFrame, keys: list[str], group: list[str]) -> RangeLayout:
    """``df`` written in ranges of ``keys``, of which ``group`` is the longest prefix to number or reduce by.

    Rows with equal keys are told apart, so they can be divided too. Two values of ``group`` per range go to the driver.
    """
    told = df.withColumn("__id", F.monotonically_increasing_id())
    ranges = told.repartitionByRange(*keys, "__id").drop("__id")
    frame = stored(ranges.withColumn(PART, F.spark_partition_id()), "layout")
    here = F.struct(*group)
    both = frame.groupBy(PART).agg(F.min(here).alias("low"), F.max(here).alias("high")).collect()
    ends = [(r[PART], tuple(r[side])) for r in both for side in ("low", "high")]
    return RangeLayout(frame, keys, ends)
