"""Similarity join on word shingles with Bayesian pruning of MinHash candidates.

1. Every text becomes its set of five-word shingles; texts with equal sets are one node.
2. Nodes that agree on a band of MinHash values are candidates. Each bucket gives a star of edges to
   its least node, and the components of these stars bound where links can be.
3. Inside a component, in blocks of bounded size, pairs are compared on their MinHash values a few at
   a time and dropped once the posterior probability of reaching the threshold is below a tolerance.
4. The rest is verified on the exact sets. A block returns link counts and a spanning forest of its
   links, never the pairs; the components of these forests are the classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimforge.llm.common import connected_components, discard, quoted, slices, store, tag

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 28, 4  # a pair at the threshold shares no band with probability 4e-7
STEP, TOLERANCE = 16, 1e-6
BLOCK = 256
HASHES = BANDS * ROWS


class WordHashes(dict):
    """64-bit hashes of words; emptied when it has 200,000."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


HASH_OF = WordHashes()


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` lower-cased words; fewer words make one run."""
    found = (text or "").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(HASH_OF.__getitem__, found), np.uint64, len(found))
    n = max(1, len(w) - size + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(size, len(w))):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k : k + n]
    return np.unique(mixed(h))


@lru_cache(maxsize=None)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 1 << 64, HASHES, np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, HASHES, np.uint64)


def minhash(s: np.ndarray) -> np.ndarray:
    a, b = permutations()
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 512):  # a block that stays in the cache
        out = np.minimum(out, (a[:, None] * s[None, i : i + 512] + b[:, None]).min(1))
    return (mixed(out) >> np.uint64(32)).astype(np.uint32)


@lru_cache(maxsize=None)
def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For each count of compared values, the fewest matches with which a pair stays.

    With a uniform prior the similarity after m of n matches is Beta(m + 1, n - m + 1).
    """
    x = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(x) + (n - m) * np.log1p(-x)
            p = np.exp(log - log.max())
            if p[x >= threshold].sum() / p.sum() >= tolerance:
                out.append(m)
                break
    return out


def row_key(doc_id: str, text: str) -> list[Column]:
    """dh and th, which stand for a row: hashes of its id and its text."""
    return [F.xxhash64(F.col(doc_id).cast("string")).alias("dh"), F.xxhash64(F.col(text)).alias("th")]


def node_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, node, bands, dh, th): node identifies the shingle set; null for texts without words. dh and th stand for the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in (part for whole in batches for part in slices(whole, whole.column(1))):
            nodes, bands = [], []
            for value in texts:
                s = shingles(value)
                if not len(s):
                    nodes.append(None)
                    bands.append(None)
                    continue
                nodes.append(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True))
                v = minhash(s).reshape(BANDS, ROWS).astype(np.uint64)
                h = np.arange(BANDS, dtype=np.uint64)
                for k in range(ROWS):
                    h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + v[:, k])
                bands.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), batch.column(2), batch.column(3)], names=["doc_id", "node", "bands", "dh", "th"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text, *row_key(doc_id, text)).mapInArrow(run, f"doc_id {kind}, node long, bands array<long>, dh long, th long")


def signed_rows(rows: DataFrame) -> DataFrame:
    """(root, node, n, parts, text) to (root, node, n, parts, sig, shingles); other texts of an id go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in (part for whole in batches for part in slices(whole, whole.column("text"))):
            keep, sigs, sets = [], [], []
            for i, (node, value) in enumerate(zip(batch.column("node").to_pylist(), texts, strict=True)):
                s = shingles(value)
                if int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) == node:
                    keep.append(i)
                    sigs.append(minhash(s).tobytes())
                    sets.append(s.tobytes())
            picked = batch.select(["root", "node", "n", "parts"]).take(pa.array(keep, pa.int32()))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(sigs, pa.binary()), pa.array(sets, pa.binary())], names=["root", "node", "n", "parts", "sig", "shingles"])

    return rows.mapInArrow(run, "root long, node long, n long, parts int, sig binary, shingles binary")


def surviving(sig: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose posterior stays above the tolerance at every step of the comparison."""
    matches = np.zeros(len(a), np.int32)
    for k, m in enumerate(least):
        part = slice(k * STEP, (k + 1) * STEP)
        matches = matches + (sig[a, part] == sig[b, part]).sum(1)
        stay = matches >= m
        a, b, matches = a[stay], b[stay], matches[stay]
    return a, b


def links(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(node, n_links, peer) from blocks of members; peer is a node of the same linked group."""
    least = least_matches(threshold, tolerance)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        nodes, at = np.unique(table.column("node").to_numpy(), return_index=True)
        column = {c: table.column(c).take(pa.array(at)) for c in ("part", "n", "sig", "shingles")}
        part, n = column["part"].to_numpy(), column["n"].to_numpy()
        sig = np.stack([np.frombuffer(x, np.uint32) for x in column["sig"].to_pylist()])
        sets = [np.frombuffer(x, np.uint64) for x in column["shingles"].to_pylist()]
        size = np.array([len(s) for s in sets])
        if i == j:
            left, right = np.triu_indices(len(nodes), 1)
        else:
            left, right = (x.ravel() for x in np.meshgrid(np.flatnonzero(part == i), np.flatnonzero(part == j), indexing="ij"))
        close = np.minimum(size[left], size[right]) >= threshold * np.maximum(size[left], size[right])
        left, right = surviving(sig, left[close], right[close], least)
        count, up = np.zeros(len(nodes), np.int64), list(range(len(nodes)))

        def top(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for x, y in zip(left.tolist(), right.tolist(), strict=True):
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if both >= threshold * (size[x] + size[y] - both):
                count[x] += n[y]
                count[y] += n[x]
                p, q = top(x), top(y)
                up[max(p, q)] = min(p, q)
        linked = np.flatnonzero(count)
        peers = np.array([nodes[top(x)] for x in linked.tolist()], np.int64)
        return pa.table({"node": nodes[linked], "n_links": count[linked], "peer": peers})

    return members.groupBy("root", "i", "j").applyInArrow(run, "node long, n_links long, peer long")


def classes_of_rows(docs: DataFrame, doc_id: str, text: str, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK, nulls: bool = False) -> DataFrame:
    """(doc_id, dh, th, node, keep, n_links) for every row; ``keep`` is the least row of its class, null without words."""
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "dh", "th")  # a null id is the greatest
    rows = store(node_rows(docs if nulls else docs.filter(F.col(doc_id).isNotNull()), doc_id, text), "nodes")
    nodes = store(rows.filter("node is not null").groupBy("node").agg(F.min(least).alias("first"), F.count("*").alias("n"), F.max("bands").alias("bands")), "sets")
    bands = nodes.select("node", F.explode("bands").alias("band"))
    buckets = bands.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("size")).filter("size > 1").drop("size")
    stars = bands.join(buckets, "band").filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    forest = connected_components(stars)
    inside = forest.unionByName(forest.select(F.col("root").alias("node"), "root").distinct())
    parts = inside.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    wanted = nodes.select("node", "n", "first.dh", "first.th").join(inside, "node").join(parts, "root")
    source = docs.select(*row_key(doc_id, text), F.col(doc_id).isNull().alias("none"), F.col(text).alias("text"))
    if nulls:  # many copies without an id have one key
        source = source.filter("not none").unionByName(source.filter("none").dropDuplicates(["dh", "th"]))
    members = store(signed_rows(source.join(wanted.hint("shuffle_hash"), ["dh", "th"]).select("root", "node", "n", "parts", "text")), "members")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = (
        members.withColumn("part", part)
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select("root", "node", "n", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "sig", "shingles")
    )
    found = store(links(placed, threshold, tolerance), "links")
    discard(members)
    classes = connected_components(found.select(F.col("node").alias("a"), F.col("peer").alias("b")))
    counted = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    whole = (
        nodes.select("node", "first", "n")
        .join(classes, "node", "left")
        .join(counted, "node", "left")
        .select("node", "first", F.coalesce("root", "node").alias("root"), (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    )
    heads = whole.groupBy("root").agg(F.min("first").alias("keep"))
    by_node = whole.join(heads, "root").select("node", "keep", "n_links")
    return rows.select("doc_id", "dh", "th", "node").join(by_node, "node", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Classes of documents linked by Jaccard similarity of at least ``threshold``, and link counts.

    Returns one row per row of ``docs``: the id, ``class_id`` (the least id of its class) and
    ``n_links``, the number of other rows at or above the threshold, copies included.

    Null, empty and blank texts have no shingles: each is a class of its own without links. A text
    of fewer than five words is one shingle. Rows with a null id are left out; with ``nulls`` they take
    part as any other, have the greatest id, and the class id is null if none of its rows has one. Rows that repeat an
    id count row by row in the links, and share a class if their texts do. Other columns are not
    carried. An empty table gives an empty one.

    Equal sets are one node, so copies are never paired. A component of m different sets is compared
    in blocks of about ``block`` of them, (m / block) ** 2 / 2 tasks: its memory is bounded, its time is
    that of counting all its links.
    """
    named = classes_of_rows(docs, doc_id, text, **options)
    return named.select(F.col("doc_id").alias(doc_id), F.coalesce("keep.doc_id", "doc_id").alias("class_id"), "n_links")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", one_row: bool = False, **options) -> DataFrame:
    """``docs`` without those that are in the class of a smaller id; rows with a null id stay.

    A row goes by its id and text, so other rows of its id stay. With ``one_row`` exactly one row of each
    class stays, of rows with a null id and of repeated rows too; texts without words all stay.
    """
    rows = classes_of_rows(docs, doc_id, text, nulls=one_row, **options).filter("node is not null")
    same = (F.col("dh") == F.col("keep.dh")) & (F.col("th") == F.col("keep.th"))
    if not one_row:
        same = F.col("doc_id") == F.col("keep.doc_id")
    keys, times, goes = [tag("dh"), tag("th")], tag("times"), tag("goes")
    keyed = docs.withColumns(dict(zip(keys, row_key(doc_id, text), strict=True)))
    marks = rows.groupBy(*(F.col(c).alias(k) for c, k in zip(("dh", "th"), keys, strict=True))).agg(F.count("*").alias(times), F.max(~same).alias(goes))
    if not one_row:
        return keyed.join(marks.filter(goes), keys, "left_anti").select(*map(quoted, docs.columns))
    marks = store(marks.filter((F.col(times) > 1) | F.col(goes)), "marks")
    single = keyed.join(marks, keys, "left_anti")
    repeated = keyed.join(marks.filter(~F.col(goes)), keys, "left_semi").dropDuplicates(keys)
    return single.unionByName(repeated).select(*map(quoted, docs.columns))


def op10_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``documents``."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), nulls=True)
