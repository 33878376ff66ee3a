"""The silhouette of a table of any size: all pairs of its distinct points, in blocks, one task for each pair of blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import staged

#: Points of a block, and rows and columns of a tile that is held at once.
BLOCK, TILE = 32_768, (256, 512)


def _sums(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a, the summed distances to the rows of b by the columns of `of_b`, and for each of b those to a by `of_a`."""
    out_a, out_b = np.zeros((len(a), of_b.shape[1])), np.zeros((len(b), of_a.shape[1]))
    middle = a.mean(0)
    a, b = a - middle, b - middle
    # a product gives the squares of the distances
    left = np.column_stack([a, (a * a).sum(1), np.ones(len(a))])
    right = np.column_stack([-2 * b, np.ones(len(b)), (b * b).sum(1)])
    for at in range(0, len(a), TILE[0]):
        rows = slice(at, at + TILE[0])
        for to in range(0, len(b), TILE[1]):
            columns = slice(to, to + TILE[1])
            d = left[rows] @ right[columns].T
            np.sqrt(np.maximum(d, 0, out=d), out=d)
            out_a[rows] += d @ of_b[columns]
            out_b[columns] += d.T @ of_a[rows]
    return out_a, out_b


def silhouette(df: DataFrame, point: str, label: str) -> DataFrame:
    """One row, silhouette: the mean over all rows, exact up to the order of sums; null where fewer than two labels are.

    Rows of one point and label count by their number, so repeats cost nothing. A row alone in its cluster counts 0.
    """
    rows = df.groupBy(F.col(point).alias("x"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    rows = staged(rows.withColumn("p", F.xxhash64("x", "label")), "points")
    sizes = rows.groupBy("label").agg(F.sum("n").alias("size"))
    blocks = max(1, -(-rows.count() // BLOCK))
    dealt = rows.withColumn("at", F.pmod("p", F.lit(blocks)).cast("int"))
    # each block meets itself and those after it; a pair's sums count for both sides
    first = dealt.withColumn("i", F.col("at")).withColumn("j", F.explode(F.sequence(F.col("at"), F.lit(blocks - 1))))
    second = dealt.withColumn("j", F.col("at")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("at")))).where("i != j")
    pairs = first.unionByName(second).select("i", "j", "at", "x", "label", "n")

    def block(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        lists = table.column("x").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        points = lists.flatten().to_numpy().reshape(len(lists), -1)
        labels, n, at = (table.column(c).to_numpy() for c in ("label", "n", "at"))
        parts = [np.flatnonzero(at == k) for k in dict.fromkeys((i, j))]
        mine, other = parts[0], parts[-1]
        if not len(mine) or not len(other):
            return table.select(["x", "label", "n"]).slice(0, 0).append_column("other", table.column("label").slice(0, 0)).append_column("total", pa.array([], pa.float64()))
        names, to = np.unique(labels, return_inverse=True)
        one = np.zeros((len(to), len(names)))
        one[np.arange(len(to)), to] = n
        found = _sums(points[mine], points[other], one[mine], one[other])
        out = []
        for rows, total in zip(parts, found, strict=False):
            each = table.select(["x", "label", "n"]).take(np.repeat(rows, len(names)))
            out.append(each.append_column("other", pa.array(np.tile(names, len(rows)), table.schema.field("label").type)).append_column("total", pa.array(total.ravel())))
        return pa.concat_tables(out)

    kind = df.select(label).schema[0].dataType.simpleString()
    met = pairs.groupBy("i", "j").applyInArrow(block, f"x array<double>, label {kind}, n bigint, other {kind}, total double")
    each = met.groupBy("x", "label", "other").agg(F.first("n").alias("n"), F.sum("total").alias("total"))
    # labels are few, as their means are taken pairwise
    each = each.join(F.broadcast(sizes.withColumnRenamed("label", "other")), "other")
    own = F.col("label") == F.col("other")
    gaps = each.groupBy("x", "label").agg(F.first("n").alias("n"), F.max(F.when(own, F.col("total") / F.nullif(F.col("size") - 1, F.lit(0)))).alias("i"), F.min(F.when(~own, F.col("total") / F.col("size"))).alias("o"))
    most = F.greatest("o", "i")
    value = F.when(F.col("i").isNull(), 0.0).when(most == 0, 0.0).otherwise((F.col("o") - F.col("i")) / most)
    return gaps.agg((F.sum(value * F.col("n")) / F.sum(F.when(value.isNotNull(), F.col("n")))).alias("silhouette"))
