"""Exact ranks and quantiles of values with counts, without sorting any group in one task.

A group's distinct values are cut into ranges at approximate quantiles. The rows of each range are counted first, so a
value's rank is what the ranges before it hold plus its place in its own range; only a range is ever sorted as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import staged

#: Ranges that a group's values are cut into, and the accuracy of the cuts; neither changes a result.
RANGES, ACCURACY = 256, 10_000


def ranked(sizes: DataFrame, by: Sequence[str], value: str, n: str) -> DataFrame:
    """`sizes` (one row a group and value, no null values) with _before, the rows of smaller values in the group, and
    _total, all its rows. `sizes` is read several times: stage it. The groups are few, as they are weeks or features."""
    cuts = F.percentile_approx(value, F.array(*(F.lit(k / RANGES) for k in range(1, RANGES))), F.lit(ACCURACY)).alias("_cuts")
    group = list(by)
    found = sizes.groupBy(*group).agg(cuts) if group else sizes.agg(cuts)
    placed = sizes.join(F.broadcast(found), group) if group else sizes.join(F.broadcast(found))
    placed = placed.withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(*group, "_range").agg(F.sum(n).alias("_in"))
    ranges = ranges.withColumn("_below", F.coalesce(F.sum("_in").over(earlier), F.lit(0))).withColumn("_total", F.sum("_in").over(Window.partitionBy(*group))).drop("_in")
    inside = Window.partitionBy(*group, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("_inner", F.coalesce(F.sum(n).over(inside), F.lit(0))).join(ranges, [*group, "_range"])
    return out.withColumn("_before", F.col("_below") + F.col("_inner")).drop("_range", "_below", "_inner")


def quantiles(df: DataFrame, features: Mapping[str, Column], at: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles of each feature, interpolated between neighbours; nulls are left out, no values give None.

    Two values of each feature and quantile come to the driver.
    """
    each = F.array(*(F.struct(F.lit(name).alias("feature"), c.cast("double").alias("v")) for name, c in features.items()))
    sizes = staged(df.select(F.inline(each)).where("v IS NOT NULL").groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n")), "sizes")
    rows = ranked(sizes, ["feature"], "v", "n")
    places = [f(F.lit(float(q)) * (F.col("_total") - 1)) for q in at for f in (F.floor, F.ceil)]
    wanted = None
    for place in places:
        here = (F.col("_before") <= place) & (place < F.col("_before") + F.col("n"))
        wanted = here if wanted is None else wanted | here
    found: dict[str, list] = {}
    for r in rows.where(wanted).select("feature", "v", "n", "_before", "_total").collect():
        found.setdefault(r.feature, []).append(r)

    def value(rows: list, q: float) -> float:
        place = q * (rows[0]["_total"] - 1)
        of = lambda k: next(r.v for r in rows if r["_before"] <= k < r["_before"] + r.n)
        low, high = of(math.floor(place)), of(math.ceil(place))
        part = place - math.floor(place)
        return low if low == high else (1 - part) * low + part * high

    return {name: [value(found[name], q) if name in found else None for q in at] for name in features}
