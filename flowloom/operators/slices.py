"""Looking at rows before and behind along each key's time, for keys of any size.

A window over a key sorts all its rows in one task. Here a key's time is cut into
slices, and rows are sorted by key and slice, so a key that holds most rows is spread
over as many tasks as its time has slices. What crosses from one slice to another is
one row a slice: it is taken from aggregates, handed on along each key, and put into
the slice that needs it as a row of its own. Keys may be null. Rows of one key and
time are in the order of the columns given after the time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Microseconds of a slice.
SLICE = 60_000_000
_CUT, _EDGE, _SEEN = "_slice", "_edge", "_seen"


def _sliced(rows: DataFrame, order: list[str], width: int) -> DataFrame:
    taken = {c.lower() for c in rows.columns}
    if taken & {_CUT, _EDGE, _SEEN}:
        raise ValueError(f"columns can't be named {_CUT}, {_EDGE} or {_SEEN}")
    return rows.withColumn(_CUT, F.floor(F.col(order[0]) / width))


def _with_edges(cut: DataFrame, edges: DataFrame, keys: list[str], seen) -> DataFrame:
    """Rows and, among them, what was handed on to their slice."""
    others = [c for c in cut.columns if c not in (*keys, _CUT)]
    handed = edges.select(*keys, _CUT, *[F.lit(None).cast(cut.schema[c].dataType).alias(c) for c in others], F.lit(True).alias(_EDGE), F.col("_handed").alias(_SEEN))
    return cut.withColumn(_EDGE, F.lit(False)).withColumn(_SEEN, seen).unionByName(handed)


def with_neighbour(rows: DataFrame, keys: list[str], order: list[str], value: Column, name: str, ahead: bool = False, width: int = SLICE) -> DataFrame:
    """rows with `name`: the value of the row before (ahead: after) of the same key, null if there is none. order: the time, then columns that settle ties."""
    cut = _sliced(rows, order, width)
    # a struct, so that a value that is null is one
    boxed = F.struct(value.alias("v"))
    edge = (F.min_by if ahead else F.max_by)(boxed, F.struct(*order))
    by_slice = Window.partitionBy(*keys).orderBy(_CUT)
    edges = cut.groupBy(*keys, _CUT).agg(edge.alias("_last"))
    edges = edges.withColumn("_handed", (F.lead if ahead else F.lag)("_last").over(by_slice)).where("_handed is not null")
    both = _with_edges(cut, edges, keys, boxed)
    # what was handed on comes before a slice's rows, or after them
    within = Window.partitionBy(*keys, _CUT).orderBy(F.col(_EDGE) if ahead else ~F.col(_EDGE), *order)
    found = both.withColumn(_SEEN, (F.lead if ahead else F.lag)(_SEEN).over(within)).where(~F.col(_EDGE))
    return found.withColumn(name, F.col(f"{_SEEN}.v")).drop(_CUT, _EDGE, _SEEN)


def with_last(rows: DataFrame, keys: list[str], order: list[str], value: Column, name: str, width: int = SLICE) -> DataFrame:
    """rows with `name`: the value of the last row of the same key up to it that has one."""
    cut = _sliced(rows, order, width)
    by_slice = Window.partitionBy(*keys).orderBy(_CUT).rowsBetween(Window.unboundedPreceding, -1)
    edges = cut.groupBy(*keys, _CUT).agg(F.max_by(value, F.when(value.isNotNull(), F.struct(*order))).alias("_last"))
    edges = edges.withColumn("_handed", F.last("_last", ignorenulls=True).over(by_slice)).where("_handed is not null")
    both = _with_edges(cut, edges, keys, value)
    within = Window.partitionBy(*keys, _CUT).orderBy(~F.col(_EDGE), *order).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn(name, F.last(_SEEN, ignorenulls=True).over(within)).where(~F.col(_EDGE))
    return found.drop(_CUT, _EDGE, _SEEN)
