"""Packing token sequences by patterns whose repeat counts come from non-negative least squares.

1. Every document becomes token pieces no longer than the sequence; their lengths give a histogram
   of at most ``size`` counts, the only thing the driver sees.
2. All patterns of one to three lengths that fill a sequence exactly are enumerated, their repeat
   counts fitted to the histogram by non-negative least squares, and rounded down.
3. What the rounded patterns leave over is packed best-fit, longest first, as counts of lengths.
4. Pieces take the slots of their length in the order of their rank. Ranks are local ones plus
   offsets by partition, so no length is ever gathered in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimforge.llm import subword
from claimforge.llm.common import slices, store

SIZE = 2048


def patterns(size: int, lengths: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: none), descending, that sum to ``size``; only ``lengths`` occur."""
    have = np.zeros(size + 1, bool)
    have[lengths] = True
    a, b = np.meshgrid(lengths, np.append(lengths, 0), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = size - a - b
    ok = (a >= b) & (c >= 0) & (b >= c)
    a, b, c = a[ok], b[ok], c[ok]
    return np.stack([a, b, c], 1)[have[c] | (c == 0)]


def fit(rows: np.ndarray, histogram: np.ndarray, steps: int = 200) -> np.ndarray:
    """Non-negative least squares for repeat counts, by accelerated projected gradients.

    ``rows`` holds each pattern's lengths, so a product with the pattern matrix is a gather or a
    weighted count. Residuals are weighted by length: an unpacked long piece costs more.
    """
    size = len(histogram) - 1
    weight = np.sqrt(np.arange(size + 1) / size)
    weight[0] = 0

    def used(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(rows[:, k], x, size + 1) for k in range(3))

    w2 = weight**2
    norm = 0.0
    v = np.ones(len(rows))
    for _ in range(15):  # the largest eigenvalue, for the step
        v = (w2 * used(v))[rows].sum(1)
        norm = np.linalg.norm(v)
        v /= norm or 1
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        grad = (w2 * (used(y) - histogram))[rows].sum(1)
        nxt = np.maximum(0, y - grad / (1.05 * norm or 1))
        t_nxt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = nxt + (t - 1) / t_nxt * (nxt - x), nxt, t_nxt
    return x


def best_fit(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack counts of lengths best-fit, longest first; returns (lengths, times) of the sequences.

    All sequences with the same content and room are handled at once, so the work depends on the
    number of different lengths and not on the number of pieces.
    """
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def add(room: int, content: tuple[int, ...], n: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((content, n))

    done = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                content, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
                k = min(n, left)
                if n > k:
                    add(room, content, n - k)
            else:
                per = size // length
                room, content = size, ()
                k = -(-left // per)
                if k > 1 or left > per:  # whole sequences of this length, then the last one
                    k = left // per
                    add(size - per * length, (length,) * per, k)
                    left -= k * per
                    continue
                k = 1
            add(room - length, (*content, length), k)
            left -= k
    for room in list(open_):
        done += open_[room]
    return done


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, times) for all pieces of a histogram, each piece placed exactly once."""
    counts = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        counts[length] += n
    whole = int(counts[size])
    counts[size] = 0
    out = [((size,), whole)] if whole else []
    lengths = np.flatnonzero(counts)
    if len(lengths):
        rows = patterns(size, lengths)
        if len(rows):
            times = np.floor(fit(rows, counts.astype(float))).astype(np.int64)
            for i in np.argsort(-times):
                if not times[i]:
                    break
                need: dict[int, int] = {}
                for x in rows[i][rows[i] > 0].tolist():
                    need[x] = need.get(x, 0) + 1
                n = min([int(times[i]), *(int(counts[x]) // k for x, k in need.items())])
                if n:
                    out.append((tuple(rows[i][rows[i] > 0].tolist()), n))
                    for x, k in need.items():
                        counts[x] -= n * k
        out += best_fit({int(x): int(counts[x]) for x in np.flatnonzero(counts)}, size)
    return out


def slots(planned: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length its runs of ranks: where they start, the first sequence and the place in it."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for lengths, n in planned:
        at = 0
        for x in lengths:
            r = taken.get(x, 0)
            runs.setdefault(x, []).append((r, first, at))
            taken[x] = r + n
            at += x
        first += n
    flat = [(x, *run) for x in sorted(runs) for run in runs[x]]
    table = np.array(flat, np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 44) + table[:, 1], "rank": table[:, 1], "first": table[:, 2], "at": table[:, 3]}


def pieces(docs: DataFrame, vocabulary: str, size: int, end_id: int, doc_id: str, text: str) -> DataFrame:
    """Token pieces of every row, with the partition they were made in and their rank by length there."""
    schema = f"`{doc_id}` {docs.schema[doc_id].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, part int, local_rank long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ranks = TaskContext.get().partitionId(), [0] * (size + 1)
        for batch, texts in (part for whole in batches for part in slices(whole, whole.column(1))):
            rows = []
            for key, value in zip(batch.column(0), texts, strict=True):
                ids = np.append(subword.encode(vocabulary, value), end_id).astype("<u4")
                end = len(ids) % size or size
                start = 0
                for k in range(-(-len(ids) // size)):
                    n = end - start
                    rows.append((key.as_py(), k, start, n, zlib.crc32(ids[start:end].tobytes()), part, ranks[n]))
                    ranks[n] += 1
                    start, end = end, end + size
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 7, [batch.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()], strict=True)],
                names=[doc_id, "piece", "start", "length", "ids_crc32", "part", "local_rank"],
            )

    return docs.select(doc_id, text).mapInArrow(run, schema)


def pack(docs: DataFrame, vocabulary: str | None = None, size: int = SIZE, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all rows of ``docs`` into as few sequences of at most ``size`` tokens as it can.

    A row is its token ids and then ``end_id``. Rows longer than ``size`` are cut into pieces of
    ``size`` of which the first may be shorter. Returns one row per piece: the id, ``piece``,
    ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``.

    A null text is an empty one, a single ``end_id``. Null and repeated ids are packed row by row.
    Other columns of ``docs`` are not carried, so their names cannot clash. An empty table gives an
    empty table. Which of the pieces of one length take which slot depends on the order of the input
    files only. The driver holds the histogram (at most ``size`` counts) and the patterns in use (at
    most ``size ** 2 / 12``), whatever the size of the input.
    """
    made = store(pieces(docs, vocabulary or subword.default_path(), size, end_id, doc_id, text), "pieces")
    by_part = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(histogram, size))
    before = by_part.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            i = np.searchsorted(table["key"], (length << 44) + rank, "right") - 1
            made_here = [pa.array(table["first"][i] + rank - table["rank"][i]), pa.array(table["at"][i])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made_here], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    ranked = made.join(before.drop("n"), ["length", "part"]).select(
        doc_id, "piece", "start", "length", "ids_crc32", (F.col("local_rank") + F.coalesce("before", F.lit(0))).alias("rank")
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.drop("rank").schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Packs all ``documents`` into sequences of 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
