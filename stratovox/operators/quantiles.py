"""Exact quantiles without a sort: one scan brackets the wanted ranks, a second one counts the values inside.

The first scan gives the number of rows and, from Spark's mergeable summaries, values that surely lie on both sides of each
wanted rank. The second one counts how many rows lie below each bracket and how often each value inside occurs, a few
thousandths of the rows at most (or one value, however often it occurs). What is left is narrowed by histograms of that small table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.plans.scratch import saved

#: The summary's accuracy: ranks are within a ``ACCURACY``-th of the rows.
ACCURACY = 10_000
#: Distinct values that the driver looks at, and bins of a histogram.
FEW = 4096


def _ranked(counts: DataFrame, rank: int) -> float:
    """The value at a rank (from 0) of a table ``value, n``, by histograms until few values are left."""
    for _ in range(200):
        ends = counts.agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("values")).first()
        if ends["values"] <= FEW:
            for r in counts.orderBy("value").collect():
                if rank < r["n"]:
                    return r["value"]
                rank -= r["n"]
            raise ValueError("a rank beyond the rows")
        width = (ends["high"] - ends["low"]) / FEW
        bins = F.least(F.floor((F.col("value") - ends["low"]) / width), F.lit(FEW - 1)) if width > 0 and math.isfinite(width) else None
        if bins is None:  # values too close, or too far apart, for even bins: halve by the middle value
            middle = counts.agg(F.percentile_approx("value", 0.5)).first()[0]
            bins = (F.col("value") > middle).cast("long") if middle < ends["high"] else (F.col("value") >= ends["high"]).cast("long")
        for r in counts.groupBy(bins.alias("bin")).agg(F.sum("n").alias("n")).orderBy("bin").collect():
            if rank < r["n"]:
                counts = counts.where(bins == r["bin"])
                break
            rank -= r["n"]
    raise RuntimeError("values that no histogram tells apart")


def exact_quantiles(rows: DataFrame, value: str | Column, shares: list[float]) -> list[float]:
    """The exact quantiles at some shares from 0 to 1, linear between ranks; none if there are no values. Nulls and not-a-number are left out."""
    column = F.col(value) if isinstance(value, str) else value
    found = rows.select((column.cast("double") + 0.0).alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    margin = 2.0 / ACCURACY
    marks = [min(max(s + d, 0.0), 1.0) for s in shares for d in (-margin, margin)]
    first = found.agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.percentile_approx("value", marks, ACCURACY).alias("marks")).first()
    if not (n := first["n"]):
        return []
    ends = (first["low"], first["high"])
    places = [s * (n - 1) for s in shares]
    # few rows are counted whole; else a summary's ranks are off by half the margin at most, which leaves room for rounding
    asked = [ends if n <= 4 * ACCURACY else (first["marks"][2 * k] if s > margin else ends[0], first["marks"][2 * k + 1] if s < 1 - margin else ends[1]) for k, s in enumerate(shares)]
    brackets: list[tuple[float, float]] = []
    for low, high in sorted(asked):
        if brackets and low <= brackets[-1][1]:
            brackets[-1] = (brackets[-1][0], max(high, brackets[-1][1]))
        else:
            brackets.append((low, high))
    zone, within = F.lit(0), F.lit(False)
    for low, high in brackets:
        zone, within = zone + (F.col("value") > high).cast("int"), within | F.col("value").between(low, high)
    counts = saved(found.groupBy(zone.alias("zone"), F.when(within, F.col("value")).alias("value")).agg(F.count("*").alias("n")), "ranks")
    sizes = {(r["zone"], r["inside"]): r["n"] for r in counts.groupBy("zone", F.col("value").isNotNull().alias("inside")).agg(F.sum("n").alias("n")).collect()}

    def at(rank: int) -> float:
        for k in range(len(brackets)):
            rank -= sizes.get((k, False), 0)  # between the bracket before and this one
            if rank < sizes.get((k, True), 0):
                return _ranked(counts.where((F.col("zone") == k) & F.col("value").isNotNull()).select("value", "n"), rank)
            rank -= sizes.get((k, True), 0)
        raise ValueError("a rank outside of its bracket")

    known = {r: at(r) for r in sorted({r for h in places for r in (math.floor(h), math.ceil(h))})}
    return [known[math.floor(h)] + (known[math.ceil(h)] - known[math.floor(h)]) * (h - math.floor(h)) if known[math.ceil(h)] != known[math.floor(h)] else known[math.floor(h)] for h in places]


def normalised(rows: DataFrame, value: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """``value`` shifted and scaled so that its quantile ``low`` becomes 0 and ``high`` becomes 1; unchanged columns else. Null where both quantiles are equal."""
    found = exact_quantiles(rows, value, [low, high])
    if not found:
        return rows.withColumn(value, F.col(value).cast("double"))
    width = found[1] - found[0]
    return rows.withColumn(value, (F.col(value).cast("double") - found[0]) / F.lit(width) if width else F.lit(None).cast("double"))
