"""Delimited text with quoted line breaks, read in many splits, with the numbers of its records.

Whether a line starts a record depends on all quotes before it, so a reader that looks for it alone reads a
file in one task. Here every split first tells its lines and quotes, and how many records start in it if it begins
outside of quotes or inside; sums over these few numbers, in the order of the splits, then give each split its
first record's number. Only records that span lines are shuffled, to be put together.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Start:
    """Where a split begins: inside quotes or not, and the number of records and lines before it."""

    quoted: bool
    records: int
    lines: int


class Lines:
    """Lines of splits in the order in which tasks read them; what is counted goes on over the batches of a split."""

    def __init__(self) -> None:
        self.at: int | None = None
        self.quotes = self.lines = 0
        self.records = [0, 0]

    def runs(self, batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray, bool]]:
        """(split, lines, quotes before each, quotes in each, whether the split is new) for each stretch of lines of one split."""
        starts, values = batch.column("start").to_numpy(), batch.column("value")
        cuts = [0, *(np.flatnonzero(np.diff(starts)) + 1).tolist(), len(starts)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            new = int(starts[a]) != self.at
            if new:
                self.at, self.quotes, self.lines, self.records = int(starts[a]), 0, 0, [0, 0]
            part = values.slice(a, b - a)
            own = pc.count_substring(part, '"').to_numpy(zero_copy_only=False).astype(np.int64)
            before = self.quotes + np.cumsum(own) - own
            yield self.at, part, before, own, new
            self.quotes += int(own.sum())
            self.lines += b - a

    @staticmethod
    def filled(part: pa.Array) -> np.ndarray:
        """Lines that hold something; empty ones between records are none."""
        return pc.greater(pc.binary_length(pc.utf8_rtrim(part, "\r")), 0).to_numpy(zero_copy_only=False)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_block_start").alias("start"))


def starts(lines: DataFrame) -> dict[int, Start]:
    """The start of every split of a file: one small row for each is what the driver sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out = Lines(), {}
        for batch in batches:
            for at, part, before, own, _ in state.runs(batch):
                found = out.setdefault(at, [0, 0, 0, 0])
                filled = Lines.filled(part)
                found[0] += len(part)
                found[1] += int(own.sum())
                found[2] += int((filled & (before % 2 == 0)).sum())
                found[3] += int((filled & (before % 2 == 1)).sum())
        columns = list(zip(*([at, *found] for at, found in out.items()), strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["start", "lines", "quotes", "outside", "inside"])

    found, at = {}, Start(False, 0, 0)
    for r in sorted(lines.mapInArrow(run, "start long, lines long, quotes long, outside long, inside long").collect()):
        found[r["start"]] = at
        at = Start(at.quoted ^ bool(r["quotes"] % 2), at.records + r["inside" if at.quoted else "outside"], at.lines + r["lines"])
    return found


def records(spark: SparkSession, path: str) -> DataFrame:
    """``number`` (from 1, the header's) and ``value``, the text of each record of a file of UTF-8 text.

    Quotes are doubled inside quoted values, and lines end with a line feed, with or without a carriage return. Lines that are
    empty between records are skipped and not numbered. A byte order mark at the start is left out.
    """
    lines = text_lines(spark, path)
    known = starts(lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = Lines(), 0
        for batch in batches:
            for at, part, before, own, new in state.runs(batch):
                start = known[at]
                seen = 0 if new else seen
                open_before = (before + start.quoted) % 2 == 1
                open_after = (before + own + start.quoted) % 2 == 1
                begins = ~open_before & Lines.filled(part)
                number = start.records + seen + np.cumsum(begins)
                seen += int(begins.sum())
                keep = begins | open_before
                line = start.lines + state.lines + np.arange(len(part))
                chosen = pa.array(keep)
                columns = [pa.array(number, pa.int64()), pa.array(line, pa.int64()), pa.array(begins & ~open_after), part]
                yield pa.RecordBatch.from_arrays([x.filter(chosen) for x in columns], names=["number", "line", "whole", "value"])

    found = lines.mapInArrow(run, "number long, line long, whole boolean, value string")
    pieces = F.array_sort(F.collect_list(F.struct("line", "value")))  # the lines of one record
    spanning = found.filter("not whole").groupBy("number").agg(F.array_join(F.transform(pieces, lambda x: x.value), "\n").alias("value"))
    every = found.filter("whole").select("number", "value").unionByName(spanning)
    return every.select("number", F.regexp_replace(F.regexp_replace("value", "\r$", ""), "^﻿", "").alias("value"))


def read_records(spark: SparkSession, path: str, columns: tuple[str, ...], number: str) -> DataFrame:
    """The records of a file as text columns, with their numbers; a header that differs is an error.

    Empty values are null and white space stays. Missing values at the end of a record are null.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = records(spark, path)
    options = {"quote": '"', "escape": '"', "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "multiLine": "true", "maxCharsPerColumn": "-1"}
    parsed = rows.select(F.col("number").alias(number), F.from_csv("value", schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "), options).alias("r"))
    first = rows.filter("number = 1").select("value").collect()
    header = next(csv.reader(io.StringIO(first[0]["value"], newline="")), []) if first else []
    if tuple(header) != tuple(columns):
        raise ValueError(f"{path}: the header is {header}, not {list(columns)}")
    return parsed.filter(F.col(number) > 1).select(number, *(F.when(F.col("r")[c] != "", F.col("r")[c]).alias(c) for c in columns))
