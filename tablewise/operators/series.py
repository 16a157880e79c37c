"""Change points of counts over time."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import stable_round
from ..plans.lineage import materialize


def best_segments(x: np.ndarray, penalty: float) -> list[int]:
    """Starts of the segments of ``x`` for which the squared distances to the
    segments' means plus ``penalty`` a segment are least.

    ``best[t]`` is the least cost of the first t values. A start j whose cost
    without a further segment is above best[t] can never be the better start
    for a later end, as a segment cut at t costs no more than whole, and is
    pruned. Ties go to the earliest start.
    """
    s, q = (np.concatenate(([0.0], np.cumsum(v))) for v in (x, x * x))
    best, start = np.empty(len(x) + 1), np.zeros(len(x) + 1, np.int64)
    best[0] = -penalty
    open_ = np.array([0])
    for t in range(1, len(x) + 1):
        ds = s[t] - s[open_]
        cost = best[open_] + ((q[t] - q[open_]) - ds * ds / (t - open_))
        k = int(cost.argmin())
        best[t], start[t] = cost[k] + penalty, open_[k]
        open_ = np.append(open_[cost <= best[t]], t)
    cuts = [int(start[len(x)])]
    while cuts[-1] > 0:
        cuts.append(int(start[cuts[-1]]))
    return cuts[::-1]


def _with(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _starts(x: Column, penalty: Column) -> Column:
    """`best_segments` of an array of doubles, as an expression."""
    start = lambda j, best, s, q: F.struct(j.alias("j"), best.alias("best"), s.alias("s"), q.alias("q"))
    zero = F.lit(0.0)
    first = F.struct(zero.alias("s"), zero.alias("q"), F.lit(0).alias("t"), penalty.alias("p"),
                     F.array(start(F.lit(0), -penalty, zero, zero)).alias("open"),
                     F.array().cast("array<int>").alias("start"))

    def step(acc: Column, v: Column) -> Column:
        s, q, t = acc["s"] + v, acc["q"] + v * v, acc["t"] + 1
        costs = F.transform(acc["open"], lambda o: o["best"] + ((q - o["q"]) - (s - o["s"]) * (s - o["s"]) / (t - o["j"])))
        return _with(costs, lambda c: _with(F.array_min(c), lambda least: F.struct(
            s.alias("s"), q.alias("q"), t.alias("t"), acc["p"].alias("p"),
            F.concat(F.filter(acc["open"], lambda o, i: F.get(c, i) <= least + acc["p"]),
                     F.array(start(t, least + acc["p"], s, q))).alias("open"),
            F.concat(acc["start"], F.array(F.get(acc["open"], (F.array_position(c, least) - 1).cast("int"))["j"])).alias("start"))))

    def back(acc: Column, _: Column) -> Column:
        at = F.get(acc["start"], acc["at"] - 1)
        return F.when(acc["at"] == 0, acc).otherwise(F.struct(
            at.alias("at"), F.concat(F.array(at), acc["cuts"]).alias("cuts"), acc["start"].alias("start")))
    starts = F.aggregate(x, first, step, lambda acc: acc["start"])
    return _with(starts, lambda all_: F.aggregate(all_, F.struct(
        F.size(all_).alias("at"), F.array().cast("array<int>").alias("cuts"), all_.alias("start")), back, lambda acc: acc["cuts"]))


def count_change_points(rows: DataFrame, group: str, time: str, unit: str = "day", factor: float = 1.0,
                        digits: int = 6) -> DataFrame:
    """Segments of steady counts per group: group, ``segment`` (from 1),
    ``first`` and ``last`` (timestamps of units), ``units``, ``mean``.

    Rows are counted per group and ``unit`` (hour, day or week) before any
    shuffle, and units without rows between a group's first and last count 0.
    So a series is as long as the calendar, however many rows a group holds;
    one task segments it. The segmentation is the optimal one of
    `best_segments`, by expressions in the JVM, with a penalty of ``factor`` x variance x log(units).

    Defined cases: rows without a time are left out; a null group is a group
    like any other; a group of one unit, or of equal counts, is one segment;
    an empty table gives no rows.
    """
    # Units are numbered from a value's own fields, never through the session
    # zone. Weeks start on Mondays: 1969-12-29 starts the week of day 0.
    day, hour = F.unix_date(F.col(time).cast("date")).cast("long"), F.hour(F.col(time))
    number = {"hour": day * 24 + hour, "day": day, "week": F.floor((day + 3) / 7)}[unit]
    counts = (rows.where(F.col(time).isNotNull()).select(F.col(group).alias("g"), number.cast("long").alias("u"))
              .groupBy("g", "u").agg(F.count(F.lit(1)).alias("n")))

    by_unit = materialize(counts.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("u", "n"))).alias("c")))
    # Units without rows follow the unit before them, as zeros.
    gap = lambda e, i: F.coalesce(F.get("c", i + 1)["u"] - e["u"] - 1, F.lit(0)).cast("int")
    x = F.flatten(F.transform("c", lambda e, i: F.concat(F.array(e["n"].cast("double")),
                                                        F.array_repeat(F.lit(0.0), gap(e, i)))))
    series = materialize(by_unit.select("g", F.get("c", F.lit(0))["u"].alias("low"), x.alias("x")))
    n = F.size("x")
    total, squares = (F.aggregate("x", F.lit(0.0), f) for f in (lambda s, v: s + v, lambda s, v: s + v * v))
    variance = (squares - total * total / n) / n
    cuts = materialize(series.withColumn("_v", variance).select(
        "g", "low", "x", F.when(F.col("_v") > 0, _starts(F.col("x"), F.lit(factor) * F.col("_v") * F.log(n)))
        .otherwise(F.array(F.lit(0))).alias("at")))
    pieces = cuts.select("g", "low", "x", F.concat("at", F.array(n)).alias("ends"), F.posexplode("at").alias("i", "a"))
    b = F.get("ends", F.col("i") + 1)
    found = pieces.select("g", (F.col("i") + 1).alias("segment"), (F.col("low") + F.col("a")).alias("first"),
                          (F.col("low") + b - 1).alias("last"), (b - F.col("a")).cast("long").alias("units"),
                          F.aggregate(F.slice("x", F.col("a") + 1, b - F.col("a")), F.lit(0.0), lambda s, v: s + v).alias("total"))

    def when(c: str) -> Column:
        u = F.col(c)
        date = F.date_from_unix_date({"hour": F.floor(u / 24), "day": u, "week": u * 7 - 3}[unit].cast("int"))
        return F.make_timestamp_ntz(F.year(date), F.month(date), F.dayofmonth(date),
                                    F.pmod(u, F.lit(24)).cast("int") if unit == "hour" else F.lit(0), F.lit(0), F.lit(0))
    return found.select(F.col("g").alias(group), "segment", when("first").alias("first"), when("last").alias("last"),
                        "units", stable_round(F.col("total") / F.col("units"), digits).alias("mean"))
