"""Exact top-k inner products by aggregation of sorted lists without random access.

Every component has a list of the candidates sorted by it. Queries read it from the end that their
own component favours, in steps that halve what is unread; the queries of a block read in step, so an
entry is read once for all of them. What has been read of a candidate gives, with the lists' last
entries for the unread rest, a lower bound of its score, and with the entries last read an upper one.
Once no more than a few candidates have an upper bound that reaches the k-th lower bound, a query
stops and the scores of these are resolved.

Candidates and queries are dealt out in blocks; each pair of blocks is one task of bounded memory, and
a query's best of all candidate blocks are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimforge.llm.common import store
from claimforge.llm.multi_index import matrix, usable

SCALE = 64
CANDIDATES, QUERIES = 16_384, 256
#: Steps that halve the unread part of the lists; what is left then is read in one.
STEPS = 4
#: Candidates, as a multiple of k, that are resolved instead of read on.
RESOLVED = 16


class Reader:
    """One end of all sorted lists of a block, and what has been read from it."""

    def __init__(self, order: np.ndarray, values: np.ndarray, end: np.ndarray):
        #: ``order[i, j]`` is the candidate of the i-th entry of list j, ``values[i, j]`` its component.
        self.order, self.values, self.end = order, values, end
        self.depth, self.lists = 0, np.arange(values.shape[1])
        self.known, self.read = np.zeros(values.shape), np.zeros(values.shape, bool)

    def read_to(self, depth: int) -> None:
        """Read every list on to ``depth`` entries."""
        if depth > self.depth:
            at = self.order[self.depth : depth], self.lists
            self.known[at] = self.values[self.depth : depth]
            self.read[at] = True
            self.depth = depth

    def bounds(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (candidate, query) of the part of the scores that these lists give."""
        known, unread = self.known @ weights.T, (~self.read).astype(np.float64)
        front = self.values[self.depth - 1]
        return known + unread @ (weights * self.end).T, known + unread @ (weights * front).T


class Lists:
    """The sorted lists of one block of candidates, read by many queries in step."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, values: np.ndarray):
        self.ids, self.rows, self.values = ids, rows, values
        order = np.argsort(values, axis=0, kind="stable")
        ordered = np.take_along_axis(values, order, axis=0)
        self.ends = Reader(order[::-1], ordered[::-1], ordered[0]), Reader(order, ordered, ordered[-1])
        self.largest = np.abs(values).max(axis=0)

    def scores(self, alive: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Integer scores; where they may be beyond 64 bits in between, by Python's integers, held at the ends of a long."""
        if float(np.abs(query) @ self.largest) < 2**53:
            return (self.values[alive] @ query).astype(np.int64)
        left, right = ([[int(x) for x in r] for r in m.tolist()] for m in (self.values[alive], query[None]))
        sums = (sum(x * y for x, y in zip(r, right[0], strict=True)) for r in left)
        return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in sums], np.int64)

    def top(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (ids, scores) of the k best, by score and then smaller id; its ``own`` row is no candidate."""
        n = len(self.ids)
        out: list = [None] * len(queries)
        left = np.arange(len(queries))
        for step in range(STEPS + 1):
            depth = n if step == STEPS else max(1, n - (n >> (step + 1)))
            low = high = 0.0
            for reader, weights in zip(self.ends, (np.maximum(queries[left], 0), np.minimum(queries[left], 0)), strict=True):
                reader.read_to(depth)
                parts = reader.bounds(weights)
                low, high = low + parts[0], high + parts[1]
            going = []
            for column, i in enumerate(left.tolist()):
                other = self.rows != own[i]
                bar, top = np.where(other, low[:, column], -np.inf), high[:, column]
                if n > k:
                    # a margin for the rounding of sums of doubles
                    least = np.partition(bar, n - k)[n - k] - 1e-12 * float(np.abs(queries[i]) @ self.largest)
                    alive = np.flatnonzero((top >= least) & other)
                else:
                    alive = np.flatnonzero(other)
                if depth < n and len(alive) > RESOLVED * k:
                    going.append(i)
                    continue
                scores = self.scores(alive, queries[i])
                best = np.lexsort((self.ids[alive], -scores.astype(object) if len(scores) and scores.min() == -(2**63) else -scores))[:k]
                out[i] = (self.ids[alive][best], scores[best])
            left = np.array(going, np.int64)
            if not len(left):
                break
        return out


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE, candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """The ``k`` highest integer inner products for each vector whose id is divisible by ``every``.

    Components are turned into floor(scale * x) first, as doubles, which hold them exactly. Returns
    ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``; ties go to the smaller id. A query row is no
    candidate of its own; with fewer candidates than ``k``, all are returned.

    Vectors null or with null or non-finite components take no part; zero vectors do. Rows that repeat an
    id are candidates each, and queries each with ranks of their own. A vector meets vectors of its own
    length only. A score beyond a long is the nearest long. Other columns are not carried. An empty table
    gives an empty one.
    """
    index = usable(vectors, vec_id, embedding, zeros=True)
    n, n_queries = index.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    blocks, groups = max(1, math.ceil(n / candidates)), max(1, math.ceil(n_queries / queries))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("int")

    def whole(column: pa.ChunkedArray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.clip(np.floor(scale * matrix(column)), -np.finfo(np.float64).max, np.finfo(np.float64).max)

    def run(_key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, scores, owners, rows = [], [], [], []
        if left.num_rows and right.num_rows:
            lists = Lists(left.column("vec_id").to_numpy(), left.column("row").to_numpy(), whole(left.column("vec")))
            own = right.column("query_row").to_numpy()
            for row, q, (i, s) in zip(own.tolist(), right.column("query_id").to_pylist(), lists.top(whole(right.column("query")), own, k), strict=True):
                ids.append(i)
                scores.append(s)
                owners.append(np.full(len(i), q))
                rows.append(np.full(len(i), row))
        join = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64())
        return pa.table({"query_row": join(rows), "query_id": join(owners), "vec_id": join(ids), "score": join(scores)})

    sized = index.withColumn("size", F.octet_length("vec"))
    left = sized.select("row", "vec_id", "vec", "size", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    right = sized.filter(F.col("vec_id") % every == 0).select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("vec").alias("query"), "size", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), group.alias("group"))
    keys = ["size", "block", "group"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every twentieth of ``embeddings``."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


OP7_SQL = """
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding::double[], lambda x: floor(64 * x)) as w from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.r, q.vec_id as query_id, c.vec_id, list_inner_product(q.w, c.w)::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and c.r <> q.r and len(c.w) = len(q.w))
select query_id, (row_number() over (partition by r order by score desc, vec_id))::int as rank, vec_id, score
from s qualify rank <= 20
"""
