"""Exact token counts at every prefix of a text by dynamic programming.

The byte-pair encoding of ``w[:i]`` ends in the one vocabulary entry ``t = w[j:i]`` for which the
last token of ``w[:j]`` followed by ``t`` encodes to just these two. So ``count[i] = count[j] + 1``
gives the count of every prefix in one pass, and truncation and budget questions are look-ups.

Texts fall into chunks, each a word with the space before it, that encode independently. The distinct new
chunks of a batch get their prefix tables together, one position of all pieces at a time in numpy; the
tables are kept by chunk, and totals and cuts of texts are read off them.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from claimforge.llm import subword
from claimforge.llm.common import numbered

#: Entries that a worker keeps of counts by piece and of compatible token pairs.
CACHE = 400_000


#: Longest piece, in bytes, whose table is made together with others.
SHORT = 24
#: Characters of texts that are worked on together, about.
TOGETHER = 4_000_000
#: A space between white space, or after it at the end.
AMID = re.compile(r"\s (?!\S)")
#: Slots, a power of two, that remember whether a pair of tokens is compatible.
PAIR_SLOTS = 1 << 20


class Tables(dict):
    """Prefix tables by piece, made on demand and emptied when there are ``CACHE`` of them."""

    def __init__(self, table):
        self.table = table

    def __missing__(self, piece: str) -> list[int]:
        if len(self) >= CACHE:
            self.clear()
        t = self[piece] = self.table(piece.encode())
        return t


class Chunks(dict):
    """Token counts by chunk, from the tables of its pieces; emptied when there are ``CACHE`` of them."""

    def __init__(self, split, tables: Tables):
        self.split, self.tables = split, tables

    def __missing__(self, chunk: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        n = self[chunk] = sum(self.tables[p][-1] for p in self.split(chunk))
        return n


class PrefixCounter:
    """Prefix tables of texts under one vocabulary."""

    def __init__(self, path: str):
        enc = subword.load(path)
        self.special = {s: enc.encode_single_token(s) for s in enc.special_tokens_set}
        self.ranks = {t: enc.encode_single_token(t) for t in enc.token_byte_values()}
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        self.reach: dict[bytes, int] = {}  # by its last two bytes, the length of the longest token
        for t in self.ranks:
            self.reach[t[-2:]] = max(self.reach.get(t[-2:], 1), len(t))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.tables = Tables(self.table)
        self.split = subword.splitter()
        self.chunks = Chunks(self.split.findall, self.tables)
        self.trie()

    def trie(self) -> None:
        """States of a trie of the vocabulary: ``step[state * 256 + byte]`` and the token that ends there (-1: none)."""
        step, ends = [{}], [-1]
        for t, i in self.ranks.items():
            at = 0
            for c in t:
                at = step[at].setdefault(c, len(step))
                if at == len(step):
                    step.append({})
                    ends.append(-1)
            ends[at] = i
        # states with successors come first, so that only they need a row; the last of these rows has none
        order = sorted(range(len(step)), key=lambda k: not step[k])
        place = {k: n for n, k in enumerate(order)}
        rows = sum(map(bool, step))
        self.rows, self.step = rows, np.full((rows + 1) * 256, -1, np.int32)
        self.ends = np.array([ends[k] for k in order], np.int32)
        for n, k in enumerate(order[:rows]):
            for c, to in step[k].items():
                self.step[n * 256 + c] = place[to]
        self.root = place[0]
        self.slots = np.full(PAIR_SLOTS, -1, np.int64)

    def fit_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`fits` of many pairs; what a slot remembers is checked against the whole pair."""
        key = a.astype(np.int64) << 20 | b
        slot = (key * 0x5851F42D4C957F2D >> 33) & (PAIR_SLOTS - 1)
        known = self.slots[slot]
        miss = np.flatnonzero(known >> 1 != key)
        if len(miss):
            new, at = np.unique(key[miss], return_inverse=True)
            ok = np.fromiter((self.fits(k >> 20, k & (1 << 20) - 1) for k in new.tolist()), np.int64, len(new))
            known[miss] = new[at] << 1 | ok[at]
            self.slots[slot[miss]] = known[miss]
        return (known & 1).astype(bool)

    def fill(self, pieces: list[str]) -> None:
        """Prefix tables of many pieces that have none; those of up to ``SHORT`` bytes together."""
        if len(self.tables) + len(pieces) > CACHE:
            self.tables.clear()
        by_length: dict[int, list[str]] = defaultdict(list)
        for p in pieces:
            by_length[len(p) if p.isascii() else len(p.encode())].append(p)
        for n, same in by_length.items():
            if n <= SHORT:
                data = np.frombuffer("".join(same).encode(), np.uint8).reshape(-1, n)
                self.tables.update(zip(same, self.same_length(data), strict=True))

    def same_length(self, data: np.ndarray) -> list[list[int]]:
        """Tables of the rows of a matrix of bytes: every position of all rows at once."""
        m, n = data.shape
        token = np.full((n, n + 1, m), -1, np.int32)  # the token that starts at j and ends at i
        for j in range(n):
            live, state = np.arange(m), np.full(m, self.root, np.int32)
            for i in range(j, n):
                state = self.step[np.minimum(state, self.rows) * 256 + data[live, i]]
                on = state >= 0
                live, state = live[on], state[on]
                if not len(live):
                    break
                token[j, i + 1, live] = self.ends[state]
        last, count = np.full((n + 1, m), -1, np.int32), np.zeros((n + 1, m), np.int32)
        for i in range(1, n + 1):
            left = np.arange(m)
            for j in range(i):
                t = token[j, i, left]
                ok = t >= 0
                if j and ok.any():
                    at = np.flatnonzero(ok)
                    ok[at] = self.fit_pairs(last[j, left[at]], t[at])
                done = left[ok]
                last[i, done], count[i, done] = t[ok], count[j, done] + 1
                left = left[~ok]
                if not len(left):
                    break
        return count.T.tolist()

    def prepare(self, chunks: Iterable[str]) -> None:
        """Make the prefix tables of all pieces of all new ones of the chunks."""
        new = set(chunks) - self.chunks.keys()
        if len(self.chunks) + len(new) > CACHE:
            self.chunks.clear()
        split, tables = self.split.findall, self.tables
        parts = {c: split(c) for c in new}
        self.fill(list(set(chain.from_iterable(parts.values())) - tables.keys()))
        self.chunks.update((c, tables[p[0]][-1] if len(p) == 1 else sum(tables[x][-1] for x in p)) for c, p in parts.items())

    def chunked(self, text: str) -> list[str]:
        """Chunks that encode independently: cuts are before a space with no white space on one of its sides."""
        first, *rest = text.split(" ")
        out = [first]
        if not AMID.search(text):
            out += [" " + chunk for chunk in rest]
            return out
        for chunk in rest:
            if chunk and not chunk[0].isspace() or out[-1] and not out[-1][-1].isspace():
                out.append(" " + chunk)
            else:
                out[-1] += " " + chunk
        return out

    def merged(self, data: bytes) -> list[bytes]:
        """Plain byte-pair merging, for pairs of tokens only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 30))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            x, y = self.bytes_of[a], self.bytes_of[b]
            ok = self.pairs[a, b] = self.merged(x + y) == [x, y]
        return ok

    def table(self, piece: bytes) -> list[int]:
        """Token counts of ``piece[:i]`` for i = 0 ... len(piece), in time linear in the piece."""
        n, get, reach = len(piece), self.ranks.get, self.reach
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            for j in range(max(0, i - reach.get(piece[max(0, i - 2) : i], 1)), i):
                t = get(piece[j:i])
                if t is not None and (j == 0 or self.fits(last[j], t)):
                    last[i], count[i] = t, count[j] + 1
                    break
        return count

    def pieces(self, text: str, lazy: bool = False) -> Iterator[tuple[str, str, bool]]:
        """(piece, white space that stands just before it, whether it is a special string)."""
        at = 0
        while text is not None and at <= len(text):
            found = [(text.find(s, at), s) for s in self.special if s in text]
            end, mark = min(((i, s) for i, s in found if i >= 0), default=(len(text), ""))
            run = ""
            part = text[at:end]
            for piece in (m.group() for m in self.split.finditer(part)) if lazy else self.split.findall(part):
                yield piece, run, False
                run = piece if piece.isspace() else ""
            if mark:
                yield mark, "", True
            at = end + len(mark) + (not mark)

    def inside(self, piece: str, run: str) -> list[int]:
        """Tokens that the first 1, 2, ... characters of a piece add when the text ends there.

        A text that ends in white space has all of it in one piece, and an unfinished
        contraction is a quote and a letter; all other cuts leave the pieces as they are.
        """
        table, out, at = self.tables[piece], [], 0
        white = len(piece) - len(piece.lstrip())
        for k, c in enumerate(piece, 1):
            at += len(c.encode())
            if run and k <= white:
                out.append(self.tables[run + piece[:k]][-1] - self.tables[run][-1])
            elif k == 2 and piece in ("'re", "'ve", "'ll"):
                out.append(self.tables["'"][-1] + self.tables[piece[1]][-1])
            else:
                out.append(table[at])
        return out

    def prefixes(self, text: str) -> list[int]:
        """Exact token counts of ``text[:i]`` for i = 0 ... len(text)."""
        out, base = [0], 0  # base: tokens of the pieces so far, as the whole text has them
        for piece, run, mark in self.pieces(text):
            if mark:  # until it is whole, a special string is ordinary text after what precedes it
                end = len(out) - 1
                head = text[self.segment_start(text, end) : end]
                start = base - self.total(head)
                out += [start + n for n in self.prefixes(head + piece[:-1])[len(head) + 1 :]] + [base + 1]
                base += 1
            else:
                out += [base + n for n in self.inside(piece, run)]
                base += self.tables[piece][-1]
        return out

    def segment_start(self, text: str, end: int) -> int:
        """Where the stretch of ordinary text that stops at ``end`` begins."""
        return max((text.rfind(s, 0, end) + len(s) for s in self.special if s in text[:end]), default=0)

    def total(self, text: str, chunks: list[str] | None = None) -> int:
        """Tokens of the whole text: the last prefix. ``chunks`` are the text's if they are known."""
        if not any(s in text for s in self.special):
            return sum(map(self.chunks.__getitem__, chunks or self.chunked(text)))
        return sum(1 if mark else self.tables[piece][-1] for piece, _, mark in self.pieces(text))

    def within(self, text: str, limit: int, chunks: list[str] | None = None) -> int:
        """Characters of the longest prefix of at most ``limit`` tokens, from the stored counts.

        Cuts inside a special string are not offered.
        """
        total = chars = best = over = 0
        if not any(s in text for s in self.special):  # whole chunks first, as long as one more fits
            chunks = (chunks or self.chunked(text))[: limit + 3]  # each has a token or more, but for an empty first one
            n = np.cumsum(np.fromiter(map(self.chunks.__getitem__, chunks), np.int64, len(chunks)))
            # two chunks back, so that white space that joins the next piece is seen
            whole = max(0, int(np.searchsorted(n, limit, side="right")) - 2)
            total, chars = (int(n[whole - 1]), sum(map(len, chunks[:whole]))) if whole else (0, 0)
            best, text = chars, text[chars:]
        for piece, run, mark in self.pieces(text, lazy=True):
            added = 1 if mark else self.tables[piece][-1]
            if total + added <= limit and not over:
                best = chars + len(piece)
            elif not mark:
                best = max([best, *(chars + k for k, n in enumerate(self.inside(piece, run), 1) if total + n <= limit)])
            if total + added > limit:
                over += 1
                if over == 2:  # joined white space may still fit after the first piece that does not
                    break
            total, chars = total + added, chars + len(piece)
        return best


    def counts(self, texts: list[str], limit: int) -> tuple[list[int], list[int]]:
        """Totals, and characters of the longest prefixes within the limit; new tables are made together."""
        totals, fits, start = [], [], 0
        while start < len(texts):
            stop = size = 0
            for stop in range(start, len(texts)):
                size += len(texts[stop])
                if size >= TOGETHER:
                    break
            group = texts[start : stop + 1]
            chunks = list(map(self.chunked, group))
            self.prepare(chain.from_iterable(chunks))
            found = list(map(self.total, group, chunks))
            totals += found
            fits += [self.within(t, limit, c) if n > limit else len(t) for t, c, n in zip(group, chunks, found, strict=True)]
            start = stop + 1
        return totals, fits


@lru_cache(maxsize=None)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(
    docs: DataFrame, vocabulary: str | None = None, limit: int = 512, text: str = "text", prefixes: bool = False
) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fits_chars`` to every row of ``docs``.

    ``fits_chars`` is the length in characters of the longest prefix within ``limit`` tokens, and
    with ``prefixes`` the column ``prefix_tokens`` holds the count of every character prefix.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows and ids are counted row by row.
    Columns of ``docs`` with the names of results are replaced; all others stay. An empty table
    gives an empty table. A text of any length is counted whole, in linear time; a batch of rows
    is bounded in bytes by Arrow.
    """
    path = vocabulary or subword.default_path()
    made = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType()), StructField("fits_chars", LongType())]
    made += [StructField("prefix_tokens", ArrayType(IntegerType()))] * prefixes
    names = [f.name for f in made]
    kept = docs.drop(*names)
    schema, at = StructType([*kept.schema, *made]), kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dp = counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            totals, fits = dp.counts(texts, limit)
            columns = [
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(totals, pa.int64()),
                pa.array([n > limit for n in totals]),
                pa.array(fits, pa.int64()),
            ] + ([pa.array([dp.prefixes(t) for t in texts], pa.list_(pa.int32()))] if prefixes else [])
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return numbered(kept).mapInArrow(run, schema)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit", "fits_chars")
