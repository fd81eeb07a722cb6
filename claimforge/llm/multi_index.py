"""Approximate nearest neighbours with an inverted multi-index.

1. Two codebooks of ``CENTROIDS`` are fitted, one for each half of the vectors, to a bounded sample.
   Every vector is indexed under its pair of nearest centroids.
2. A query walks through the pairs by the sum of their two distances, with a heap, until the pairs
   that it has met hold enough vectors.
3. The entries of these pairs are reranked by the exact distance. Work is dealt out by the first
   centroid, and a centroid with many vectors is split by a hash of their rows; so are the queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimforge.llm.common import store

CENTROIDS = 32
#: Vectors that the codebooks are fitted to, about; a hash of the row picks them.
SAMPLE = 20_000
#: A query goes on until its pairs hold this share of all vectors and, besides, so many vectors for each
#: neighbour that it wants. Vectors without clusters need a large share for a recall over 0.9; clustered ones
#: reach it with far less.
SHARE, SPARE = 0.5, 10
#: Vectors in one part of a first centroid, about.
PART = 16_384
#: Queries in one group that meets a part, about, and in one task that walks through the pairs.
QUERIES, WALKS = 4_096, 1_024


def usable(vectors: DataFrame, vec_id: str, embedding: str, zeros: bool) -> DataFrame:
    """(row, vec_id, vec) with the doubles of usable vectors as bytes; ``row`` tells rows of one id apart.

    Left out are null ids, null or empty vectors, those with null or non-finite components, and zero
    vectors unless ``zeros``.
    """
    v = F.col(embedding).cast("array<double>")
    good = F.col(vec_id).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if not zeros:
        good = good & F.exists(v, lambda x: x != 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            raw, ends = np.asarray(lists.flatten(), np.float64).tobytes(), 8 * np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
            vecs = pa.array([raw[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), vecs], names=["row", "vec_id", "vec"])

    rows = vectors.filter(F.coalesce(good, F.lit(False))).select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    return store(rows.mapInArrow(run, "row long, vec_id long, vec binary"), "vectors")


def matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1))


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from distinct rows; an empty centroid moves to the row farthest from its own."""
    rows = np.unique(x, axis=0)
    c = rows[np.random.default_rng(seed).permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        d = squares(x, c)
        near = d.argmin(1)
        n = np.bincount(near, minlength=len(c))
        sums = np.stack([np.bincount(near, x[:, j], len(c)) for j in range(x.shape[1])], 1)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
        far = np.argsort(-d.min(1))
        c[n == 0] = x[far[: int((n == 0).sum())]]
    return c


def traverse(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Pairs a * K + b by first[a] + second[b], until they hold ``wanted`` vectors."""
    oa, ob = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    fa, fb = first[oa].tolist(), second[ob].tolist()
    heap, met, out, held = [(fa[0] + fb[0], 0, 0)], {(0, 0)}, [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        pair = int(oa[i]) * len(fb) + int(ob[j])
        if counts[pair]:
            out.append(pair)
            held += int(counts[pair])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(fa) and q < len(fb) and (p, q) not in met:
                met.add((p, q))
                heapq.heappush(heap, (fa[p] + fb[q], p, q))
    return out


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id", embedding: str = "embedding", centroids: int = CENTROIDS, share: float = SHARE, spare: int = SPARE, queries: int = QUERIES) -> DataFrame:
    """The ``k`` nearest vectors found for each vector whose id is divisible by ``every``.

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, the Euclidean distance of the original
    vectors in double precision; ties go to the smaller id. A query row is no candidate of its own.

    Vectors null, zero or with null or non-finite components take no part. Rows that repeat an id are
    candidates each, and queries each with ranks of their own. A vector is near only to vectors of its own
    length; each length has an index of its own, so lengths should be few. Other columns are not carried.
    An empty table gives an empty one. A task holds about ``PART`` vectors and ``queries`` queries. The
    driver holds the lengths and, for one length at a time, the sample, the codebooks and
    ``centroids ** 2`` counts.
    """
    rows = usable(vectors, vec_id, embedding, zeros=False)
    size = F.octet_length("vec")
    found = rows.sparkSession.createDataFrame([], "query_row long, query_id long, vec_id long, score double")
    for r in rows.groupBy(size.alias("bytes")).agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).orderBy("bytes").collect():
        if r["q"]:
            found = found.unionByName(candidates(rows.filter(size == r["bytes"]), r["n"], r["q"], k, every, centroids, share, spare, queries))
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def candidates(index: DataFrame, total: int, n_queries: int, k: int, every: int, centroids: int, share: float, spare: int, queries: int) -> DataFrame:
    """The best of each part for each query, of an index of ``total`` vectors of one length."""
    groups = max(1, -(-n_queries // queries))
    draw = F.pmod(F.xxhash64("row", F.lit(31)), F.lit(1 << 20))
    sample = index.filter(draw < min(1.0, SAMPLE / total) * (1 << 20)).orderBy("row").select("vec").toArrow()
    if not sample.num_rows:
        sample = index.limit(1).select("vec").toArrow()
    x = matrix(sample.column("vec"))
    half = x.shape[1] // 2
    books = (k_means(x[:, :half], centroids), k_means(x[:, half:], centroids))
    size = len(books[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                v = matrix(batch.column("vec"))
                a, b = (squares(part, c).argmin(1).astype(np.int32) for part, c in ((v[:, :half], books[0]), (v[:, half:], books[1])))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(a), pa.array(b)], names=["row", "vec_id", "vec", "a", "b"])

    entries = store(index.select("row", "vec_id", "vec").mapInArrow(assign, "row long, vec_id long, vec binary, a int, b int"), "entries")
    counts = np.zeros(len(books[0]) * size, np.int64)
    for r in entries.groupBy("a", "b").count().collect():
        counts[r["a"] * size + r["b"]] = r["count"]
    wanted = int(np.ceil(share * total)) + spare * k + 1
    parts = np.maximum(1, -(-counts.reshape(-1, size).sum(1) // PART))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, q, raw in zip(*(batch.column(c).to_pylist() for c in ("row", "vec_id", "vec")), strict=True):
                v = np.frombuffer(raw)[None]
                pairs = traverse(squares(v[:, :half], books[0])[0], squares(v[:, half:], books[1])[0], counts, wanted)
                by_first: dict[int, list[int]] = {}
                for p in pairs:
                    by_first.setdefault(p // size, []).append(p % size)
                out += [(row, q, raw, a, part, bs) for a, bs in by_first.items() for part in range(int(parts[a]))]
            columns = zip(*out, strict=True) if out else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_row", "query_id", "query", "a", "part", "bs"])

    def rerank(_key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, float]] = []
        if left.num_rows and right.num_rows:
            rows, ids, b, v = *(left.column(c).to_numpy() for c in ("row", "vec_id", "b")), matrix(left.column("vec"))
            order = np.lexsort((ids, b))
            rows, ids, b, v = rows[order], ids[order], b[order], v[order]
            edge = np.searchsorted(b, np.arange(size + 1))
            for row, q, raw, bs in zip(*(right.column(c).to_pylist() for c in ("query_row", "query_id", "query", "bs")), strict=True):
                at = np.concatenate([np.arange(edge[i], edge[i + 1]) for i in bs])
                at = at[rows[at] != row]
                d = np.sqrt(((v[at] - np.frombuffer(raw)) ** 2).sum(1))
                if len(d) > k:
                    close = d <= np.partition(d, k - 1)[k - 1]
                    at, d = at[close], d[close]
                best = np.lexsort((ids[at], d))[:k]
                found += [(row, q, int(i), float(s)) for i, s in zip(ids[at[best]], d[best], strict=True)]
        columns = list(zip(*found, strict=True)) if found else [()] * 4
        kinds = {"query_row": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({name: pa.array(c, t) for (name, t), c in zip(kinds.items(), columns, strict=True)})

    cuts = F.element_at(F.array(*(F.lit(int(n)) for n in parts)), F.col("a") + 1)
    placed = entries.withColumn("part", F.pmod(F.xxhash64("row"), cuts).cast("int"))
    asked = entries.filter(F.col("vec_id") % every == 0).select("row", "vec_id", "vec").repartition(max(8, -(-n_queries // WALKS)))
    probes = asked.mapInArrow(probe, "query_row long, query_id long, query binary, a int, part int, bs array<int>")
    # each part of the vectors meets each group of the queries in a task of its own
    placed = placed.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    probes = probes.withColumn("group", F.pmod(F.xxhash64("query_row", F.lit(1)), F.lit(groups)).cast("int"))
    return placed.groupBy("a", "part", "group").cogroup(probes.groupBy("a", "part", "group")).applyInArrow(rerank, "query_row long, query_id long, vec_id long, score double")


def op5_multi_index_ann(spark, sf_dir: str) -> DataFrame:
    """The 10 nearest of ``embeddings`` found for every hundredth of them."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
