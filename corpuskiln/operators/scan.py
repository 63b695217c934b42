"""Running folds over a total order, cut into ranges: sums, least and greatest values, counts, last values."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.sources import sinks

PART = "__part"


class Fold(NamedTuple):
    """What is folded: ``kind`` is sum, min, max or last; ``upto`` is 0 with the row itself and -1 without it."""

    kind: str
    value: Column
    upto: int = 0


def _total(fold: Fold, order: list[str]) -> Column:
    if fold.kind == "last":
        return F.max_by(F.struct(fold.value.alias("v")), F.struct(*order))
    return {"sum": F.sum, "min": F.min, "max": F.max}[fold.kind](fold.value)


def _along(kind: str, value: Column) -> Column:
    return {"sum": F.sum, "min": F.min, "max": F.max, "last": F.last}[kind](value)


def _joined(kind: str, before: Column, here: Column) -> Column:
    """The fold of what lies before a range and of what lies in it; either is null where nothing was folded."""
    if kind == "sum":
        return F.when(before.isNull(), here).otherwise(before + F.coalesce(here, F.lit(0)))
    return {"min": F.least(before, here), "max": F.greatest(before, here), "last": F.coalesce(here, before)}[kind]


def ranges(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``rows`` dealt out by ranges of ``by`` and ``order`` and stored, so that every later read sees the same ranges; ``PART`` is the number of a row's range."""
    return sinks.stored(rows.repartitionByRange(*by, *order).withColumn(PART, F.spark_partition_id()), "ranges")


def running(rows: DataFrame, by: list[str], order: list[str], folds: Mapping[str, Fold], totals: Mapping[str, Fold] | None = None) -> DataFrame:
    """``rows`` with each fold of ``folds`` along ``order`` within each group ``by``, and each of ``totals`` over the whole group.

    ``order`` must be total within a group (of equal rows the order is arbitrary). No task sees a whole group: each folds its range,
    and what the ranges before it give to its first group, one row per range at most, is broadcast. ``rows`` may come from
    ``ranges`` or from an earlier call and are then not dealt out again. A fold over no rows or of nulls only is null; no rows give no rows.
    """
    totals = totals or {}
    cut = rows if PART in rows.columns else ranges(rows, by, order)
    cut = cut.withColumns({f"__v_{n}": F.struct(f.value.alias("v")) if f.kind == "last" else f.value for n, f in folds.items()})
    of_part = cut.groupBy(PART, *by).agg(F.count(F.lit(1)).alias("__n"), *(_total(f, order).alias(f"__t_{n}") for n, f in {**folds, **totals}.items()))
    earlier = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    carry = of_part.select(
        F.col(PART).alias("__at"),
        *(F.col(f"`{k}`").alias(f"__of_{k}") for k in by),
        F.count(F.lit(1)).over(earlier).alias("__seen"),
        *((F.last(F.col(f"__t_{n}"), ignorenulls=True) if f.kind == "last" else _along(f.kind, F.col(f"__t_{n}"))).over(earlier).alias(f"__c_{n}") for n, f in folds.items()),
    ).where("__seen > 0").drop("__seen")  # only the first group of a range has begun before it
    same = F.col(PART) == F.col("__at")
    for k in by:
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__of_{k}"))
    window = lambda f: Window.partitionBy(PART, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, f.upto)
    folded = cut.withColumns({f"__f_{n}": _along(f.kind, F.col(f"__v_{n}")).over(window(f)) for n, f in folds.items()})
    out = folded.join(F.broadcast(carry), same, "left") if folds else folded
    done = {n: _joined(f.kind, F.col(f"__c_{n}"), F.col(f"__f_{n}")) for n, f in folds.items()}
    out = out.withColumns({n: c["v"] if folds[n].kind == "last" else c for n, c in done.items()})
    if totals:
        whole = Window.partitionBy(*by)
        sums = of_part.select(F.col(PART).alias("__on"), *(F.col(f"`{k}`").alias(f"__by_{k}") for k in by), *(_along(f.kind, F.col(f"__t_{n}")).over(whole).alias(n) for n, f in totals.items()))
        met = F.col(PART) == F.col("__on")
        for k in by:
            met = met & F.col(f"`{k}`").eqNullSafe(F.col(f"__by_{k}"))
        out = out.join(sums, met)  # keys are a range and a group, so no key is larger than a range
    return out.select(*(F.col(f"`{c}`") for c in rows.columns if c != PART), PART, *folds, *totals)


def number_rows(rows: DataFrame, *order: str, name: str = "no", by: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` numbered from 0 in a total order, within each ``by`` if given, without one task that sees them all; only keys are moved twice.

    Rows that are equal in ``by`` and ``order`` are numbered in any order.
    """
    out = running(rows, list(by), list(order), {name: Fold("sum", F.lit(1).cast("long"), 0)})
    return out.withColumn(name, F.col(name) - 1).drop(PART)
