"""Values of the lines around each line, in document order, also where a document is too long for one task.

A table of lines has the columns source and line_no. Without segments a document is one group of a window. With
segments of n line numbers each, windows run inside a segment only; what a segment passes on to its neighbours is one
row a segment, and a window over these short rows, joined back, completes the values. A document of any length is then
as many groups as it has segments, and no task sees more than one segment of it at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = "__segment"


class Kind(NamedTuple):
    """How a value comes about: inside a segment, what a segment passes on, over the segments' rows, and both together."""

    inside: Callable[[Column], Column]
    passed: Callable[[Column], Column]
    over: Callable[[Column], Column]
    joined: Callable[[Column, Column], Column]


def _order(*by: str):
    return Window.partitionBy("source", *by)


def _frames(w, order: str) -> tuple:
    """The order, and its frames: before, up to here, after and all. What comes after is what comes before from the
    other end: a frame that reaches to the end would be summed up anew for every line."""
    up, down = w.orderBy(order), w.orderBy(F.desc(order))
    return up, up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(Window.unboundedPreceding, 0), down.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _kinds(segmented: bool) -> dict[str, Kind]:
    w, w_before, w_here, w_after, w_all = _frames(_order(SEGMENT) if segmented else _order(), "line_no")
    s, s_before, _, s_after, s_all = _frames(_order(), SEGMENT)
    line = F.col("line_no")

    def full(c: Column) -> Column:
        return F.when(c.isNotNull(), line)

    def first_known(inner: Column, carried: Column) -> Column:
        return F.coalesce(inner, carried)

    def boxed(c: Column) -> Column:
        return F.struct(c.alias("v"))

    return {
        # The line before and the line after, whatever it holds.
        "before": Kind(lambda c: F.lag(boxed(c)).over(w), lambda c: F.max_by(boxed(c), line), lambda p: F.lag(p).over(s), lambda i, p: F.coalesce(i, p)["v"]),
        "after": Kind(lambda c: F.lead(boxed(c)).over(w), lambda c: F.min_by(boxed(c), line), lambda p: F.lead(p).over(s), lambda i, p: F.coalesce(i, p)["v"]),
        # The last value before, up to and the first value after the line that isn't null.
        "last_before": Kind(lambda c: F.last(c, ignorenulls=True).over(w_before), lambda c: F.max_by(c, full(c)), lambda p: F.last(p, ignorenulls=True).over(s_before), first_known),
        "last_here": Kind(lambda c: F.last(c, ignorenulls=True).over(w_here), lambda c: F.max_by(c, full(c)), lambda p: F.last(p, ignorenulls=True).over(s_before), first_known),
        "first_after": Kind(lambda c: F.last(c, ignorenulls=True).over(w_after), lambda c: F.min_by(c, full(c)), lambda p: F.last(p, ignorenulls=True).over(s_after), first_known),
        # Sums up to the line, and the document's first row, least and greatest value.
        "sum": Kind(lambda c: F.sum(c).over(w_here), F.sum, lambda p: F.sum(p).over(s_before), lambda i, p: i + F.coalesce(p, F.lit(0))),
        "first": Kind(lambda c: F.first(boxed(c)).over(w_all), lambda c: F.min_by(boxed(c), line), lambda p: F.first(p).over(s_all), lambda i, p: F.coalesce(p, i)["v"]),
        "least": Kind(lambda c: F.min(c).over(w_all), F.min, lambda p: F.min(p).over(s_all), lambda i, p: F.least(i, p)),
        "greatest": Kind(lambda c: F.max(c).over(w_all), F.max, lambda p: F.max(p).over(s_all), lambda i, p: F.greatest(i, p)),
    }


def with_neighbours(lines: DataFrame, wanted: dict[str, tuple[str, Column]], segment: int | None = None) -> DataFrame:
    """Adds the columns of wanted, name: (kind, expression on a line). segment: line numbers of a segment, None for
    whole documents."""
    kinds = _kinds(segment is not None)
    if segment is None:
        none = F.lit(None)
        return lines.withColumns({name: kinds[kind].joined(kinds[kind].inside(c), none) for name, (kind, c) in wanted.items()})
    rows = lines.withColumn(SEGMENT, F.floor((F.col("line_no") - 1) / segment).cast("long"))
    rows = rows.withColumns({f"__v_{name}": c for name, (_, c) in wanted.items()})
    inside = rows.withColumns({f"__i_{name}": kinds[kind].inside(F.col(f"__v_{name}")) for name, (kind, _) in wanted.items()})
    passed = rows.groupBy("source", SEGMENT).agg(*[kinds[kind].passed(F.col(f"__v_{name}")).alias(f"__p_{name}") for name, (kind, _) in wanted.items()])
    passed = passed.select(F.col("source").alias("__source"), F.col(SEGMENT).alias("__at"), *[kinds[kind].over(F.col(f"__p_{name}")).alias(f"__c_{name}") for name, (kind, _) in wanted.items()])
    both = inside.join(passed, F.col("source").eqNullSafe(F.col("__source")) & (F.col(SEGMENT) == F.col("__at")), "left")
    return both.select(*lines.columns, *[kinds[kind].joined(F.col(f"__i_{name}"), F.col(f"__c_{name}")).alias(name) for name, (kind, _) in wanted.items()])
