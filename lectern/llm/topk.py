"""Exact inner-product search with an impact-ordered index, a score at a time.

Vectors are integers. In a block of rows, the index keeps for each component the rows' values in quantised levels, each
level a posting segment. A query takes the segments in descending impact (its component times the segment's best value)
and adds them to upper bounds of the rows' scores; rows that a component's segments haven't reached yet are bounded by
that component's next segment. As segments are taken from the best on, that is the better of the next segment and the
row's own one, so a component is added to all rows by whole-array operations. At each step the best rows so far are scored
exactly: rows whose bound is below the k-th of those scores are proven out and left out of further steps, the others are
possible members. The walk stops once the possible members are few, at the last posting at the latest, and then only they
are scored exactly, however many they are.

Rows and queries are dealt into blocks of bounded size by hash, and each pair of blocks is one group, so no task holds
all queries or all rows. Each pair gives k rows a query at most, from which the k best of all blocks are taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import staged

SCALE, LEVEL = 256, 4
#: Rows and queries of a block.
ROW_BLOCK, QUERY_BLOCK = 8_192, 8_192
#: Shares of the postings after which the bounds are looked at; the last is all of them.
STEPS = (0.6, 0.8, 0.9, 0.95, 1.0)
#: The share of a block's rows that are few: the walk goes on while more are possible.
FEW = 0.02
#: Integers below have an exact value in single precision.
EXACT = 1 << 24


class Index:
    """Posting segments of one block of rows: for each component the rows by level, in runs of one array.

    A component's segments stand in ascending order of value, so those with the highest impact for a query are the last
    ones where its component is positive, and the first ones where it is negative: what a walk has taken of a component
    is one run. asked and rescored count the queries and the rows that were scored exactly for them.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.asked = self.rescored = 0
        n, dims = self.vectors.shape
        values = np.ascontiguousarray(self.vectors.T)
        rows = np.argsort(values, axis=1, kind="stable")
        values = np.take_along_axis(values, rows, axis=1).ravel()
        level, place = np.floor_divide(values, LEVEL), np.arange(dims * n)
        new = np.ones(dims * n, dtype=bool)
        new[1:] = (level[1:] != level[:-1]) | (place[1:] % max(n, 1) == 0)
        start = np.flatnonzero(new)
        end = np.append(start[1:], dims * n)[: len(start)]
        self.size, self.dim = end - start, start // max(n, 1)
        self.least, self.most = values[start], values[end - 1]
        # each component's run of segments, and for each component what a row's segment is at most, then the same with all signs turned
        self.first = np.searchsorted(self.dim, np.arange(dims + 1))
        # single precision, where it has the integers exactly; what the sums lose is added to the bounds
        self.reach = np.abs(self.vectors).max(axis=0, initial=0)
        self.best_of = np.empty((2 * dims, n), dtype=np.float32 if self.reach.max(initial=0) < EXACT else np.float64)
        np.put_along_axis(self.best_of[:dims], rows, np.repeat(self.most, self.size).reshape(dims, n), axis=1)
        np.put_along_axis(self.best_of[dims:], rows, np.repeat(-self.least, self.size).reshape(dims, n), axis=1)

    def exact(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (self.vectors[rows] @ query).astype(np.int64)

    def possible(self, query: np.ndarray, k: int, own: int | None) -> np.ndarray:
        """The rows that the bounds leave as possible members of the k best."""
        n, dims = self.vectors.shape
        live = np.flatnonzero(query)
        segments = np.flatnonzero(query[self.dim])
        at = query[self.dim[segments]]
        # impacts of one component's segments all differ, so the order needn't be stable
        order = segments[np.argsort(-np.where(at > 0, at * self.most[segments], at * self.least[segments]))]
        reached = np.cumsum(self.size[order])
        up, weight, of = query[live] > 0, np.abs(query[live]), np.where(query[live] > 0, live, dims + live)
        kind = self.best_of.dtype if weight.max() < EXACT else np.dtype(np.float64)
        lost = 2 * len(live) * float(np.finfo(kind).eps) * float(weight @ self.reach[live])
        own_rows = self.ids == own if own is not None else np.zeros(n, dtype=bool)
        members, whole = np.flatnonzero(~own_rows), True
        for share in STEPS:
            upto = int(np.searchsorted(reached, share * reached[-1])) + 1
            counts = np.bincount(self.dim[order[:upto]], minlength=dims)[live]
            left = counts < self.first[live + 1] - self.first[live]
            rest = np.where(up, self.most[np.maximum(self.first[live + 1] - counts - 1, 0)], -self.least[np.minimum(self.first[live] + counts, len(self.least) - 1)])
            rest = np.where(left, rest, -np.inf)
            bound = np.full(n if whole else len(members), lost, dtype=kind)
            part = np.empty(len(bound), dtype=kind)
            for d, most, w in zip(of, rest.astype(kind), weight.astype(kind), strict=True):
                np.maximum(self.best_of[d] if whole else self.best_of[d].take(members), most, out=part)
                np.multiply(part, w, out=part)
                np.add(bound, part, out=bound)
            bound = bound[members] if whole else bound
            if len(members) <= k:
                break
            top = members[np.argpartition(-bound, min(4 * k, len(members) - 1))[: 4 * k]]
            members = members[bound >= np.partition(self.exact(query, top), -k)[-k]]
            if len(members) <= max(8 * k, FEW * n):
                break
            whole = whole and 2 * len(members) > n
        return members

    def best(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with the query's own id, ties to smaller ids."""
        rows = self.possible(query, k, own) if len(self.ids) > 4 * k and np.any(query) else np.arange(len(self.ids))
        if own is not None:
            rows = rows[self.ids[rows] != own]
        self.asked += 1
        self.rescored += len(rows)
        scores = self.exact(query, rows)
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[order]], scores[order]


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and integer vector (as doubles) of the rows that take part: no null id or vector, no null or non-finite component."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull()).where(~bad)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("v"))


def search(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, id, score: the k best rows of each row whose id is divisible by `every`, the query's own id left out.

    Ties go to the smaller id; repeated rows are candidates of their own. Vectors of other lengths count as filled up
    with zeros. A query without candidates has no rows, as has an empty table.
    """
    rows = staged(usable(df, id_col, vector_col), "vectors")
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    queries = rows.where(F.col("id") % every == 0)
    row_blocks = max(1, -(-n // row_block))
    query_blocks = max(1, -(-queries.count() // query_block))
    dims = dims or 0
    spread = F.xxhash64("id", "v")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = rows.select(F.lit(False).alias("query"), "id", "v", F.pmod(spread, F.lit(row_blocks)).cast("int").alias("rb"), each(query_blocks).alias("qb"))
    right = queries.select(F.lit(True).alias("query"), "id", "v", each(row_blocks).alias("rb"), F.pmod(spread, F.lit(query_blocks)).cast("int").alias("qb"))

    def block(table: pa.Table) -> pa.Table:
        lists = table.column("v").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        lengths = np.diff(lists.offsets.to_numpy())
        vectors = np.zeros((len(lengths), dims))
        values = lists.flatten().to_numpy(zero_copy_only=False)
        at = np.repeat(np.arange(len(lengths)), lengths)
        vectors[at, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
        ids, asks = table.column("id").to_numpy(), table.column("query").to_numpy()
        index = Index(ids[~asks], vectors[~asks])
        out: list[list] = [[], [], []]
        for own, query in zip(ids[asks], vectors[asks], strict=True):
            got, scores = index.best(query, k, own)
            out[0] += [own] * len(got)
            out[1] += got.tolist()
            out[2] += scores.tolist()
        return pa.table([pa.array(c, type=pa.int64()) for c in out], names=["query_id", "id", "score"])

    found = left.unionByName(right).groupBy("rb", "qb").applyInArrow(block, "query_id bigint, id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
