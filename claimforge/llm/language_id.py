"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of ``ORDER`` characters over a bounded, hashed sample of its documents.
All models share sorted arrays of n-gram hashes, one per order, with a row of log-probabilities (a
column per language) for each hash: one binary search finds an n-gram for all languages. A text's
language is that of the lowest cross-entropy per character; the margin to the runner-up is turned
into a score, and each language's own range of cross-entropies tells what to reject.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from claimforge.llm.common import crc_mod, numbered, store

ORDER = 4
#: Documents per language that its model is fitted to, about; a hash of the id picks them.
SAMPLE = 2_000
DISCOUNT = 0.75
#: Characters that are scored at a time: bounds the memory of a text of any length.
CHUNK = 1 << 18
UNDETERMINED = "und"
#: Of a language's own sample, the share that its rejection threshold gives up.
REJECTED = 0.005

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=None)
def letters() -> np.ndarray:
    """For every code point its lower case if it is a letter, else a space."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def codes(text: str) -> np.ndarray:
    """Lower-cased letters as code points, and one space for each run of other characters."""
    a = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = a == 32
    space[1:] &= space[:-1]
    space[:1] = False
    return a[~space]


def hashes(a: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 ... order, hashes of the n characters that end at each place (spaces before the text)."""
    padded = np.concatenate([np.full(order - 1, 32, np.uint64), a.astype(np.uint64)])
    out, h = [], np.zeros(len(a), np.uint64)
    for n in range(1, order + 1):
        # the nearest character first, so a longer n-gram extends the hash of the shorter one
        h = (h ^ (padded[order - n : len(padded) - n + 1] + np.uint64(n))) * M1
        h = h ^ (h >> np.uint64(29))
        out.append(h)
    return out


class Sorted:
    """A sorted array of hashes; hashes are uniform, so their top bits tell nearly where they are."""

    BITS = 18

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.iinfo(np.uint64).max)
        top = (keys >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.start = np.searchsorted(top, np.arange(1 << self.BITS)).astype(np.int32)
        self.longest = int(np.bincount(top, minlength=1).max()) if len(keys) else 0

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is, and whether it is there at all."""
        i = self.start.take((h >> np.uint64(64 - self.BITS)).astype(np.int32))
        for _ in range(self.longest):
            i = i + (self.keys.take(i) < h)
        return i, self.keys.take(i) == h


class Model:
    """Languages, their calibration, and for each order sorted hashes with log2-probabilities."""

    def __init__(self, languages: list[str], tables: list[tuple[np.ndarray, np.ndarray]], backoff: list[tuple[np.ndarray, np.ndarray]], floor: np.ndarray):
        self.languages, self.floor = languages, floor
        self.tables = [(Sorted(k), v) for k, v in tables]
        self.backoff = [(Sorted(k), v) for k, v in backoff]
        self.slope, self.ceiling = 30.0, np.full(len(languages), np.inf)

    def bits(self, a: np.ndarray) -> np.ndarray:
        """Summed -log2 p of the characters under each language."""
        total = np.zeros(len(self.languages))
        order = len(self.tables)
        lead = order - 1
        padded = np.concatenate([np.full(lead, 32, a.dtype), a])
        for start in range(0, len(a), CHUNK):
            hs = hashes(padded[start : start + lead + CHUNK], order)
            at = np.arange(lead, len(hs[0]))
            for n in range(order, 0, -1):  # places whose n-gram no language has seen go on to the shorter one
                keys, logs = self.tables[n - 1]
                if not len(at):
                    break
                i, hit = keys.find(hs[n - 1][at])
                total -= logs.take(i[hit], 0).sum(0)
                at = at[~hit]
                if n > 1 and len(at):  # the weight that an unseen character has after this context
                    contexts, weight = self.backoff[n - 1]
                    j, seen = contexts.find(hs[n - 2][at - 1])
                    total -= weight.take(j[seen], 0).sum(0)
            total -= len(at) * self.floor
        return total

    def entropies(self, text: str | None) -> np.ndarray | None:
        """Bits per character by language; None for a text without letters."""
        if not text:
            return None
        a = codes(text)
        if not (a != 32).any():
            return None
        return self.bits(a) / len(a)


def kneser_ney(counts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], languages: list[str]) -> Model:
    """Interpolated probabilities from, for each order, sorted (hash, context hash, suffix hash, counts by language)."""
    k = len(languages)
    tables, backoff = [], []
    lower_keys, lower_p = np.empty(0, np.uint64), np.empty((0, k))
    floor = np.full(k, 1e-4)
    for n, (keys, context, suffix, c) in enumerate(counts, 1):
        if n < len(counts):  # below the highest order an n-gram counts by the characters that precede it
            up_keys, _, up_suffix, up_c = counts[n]
            c = np.zeros_like(c)
            np.add.at(c, np.searchsorted(keys, up_suffix), (up_c > 0).astype(c.dtype))
            del up_keys
        ctx, inverse = np.unique(context, return_inverse=True)
        total, types = np.zeros((len(ctx), k)), np.zeros((len(ctx), k))
        np.add.at(total, inverse, c)
        np.add.at(types, inverse, (c > 0).astype(float))
        gamma = np.where(total > 0, DISCOUNT * types / np.maximum(total, 1e-9), 1.0)
        if n == 1:
            base = np.broadcast_to(floor, c.shape)
        else:
            i = np.minimum(np.searchsorted(lower_keys, suffix), max(0, len(lower_keys) - 1))
            base = lower_p[i]
        p = np.maximum(c - DISCOUNT, 0) / np.maximum(total, 1e-9)[inverse] + gamma[inverse] * base
        tables.append((keys, np.log2(np.maximum(p, 1e-12))))
        backoff.append((ctx, np.log2(np.maximum(gamma, 1e-12))))
        lower_keys, lower_p = keys, p
    return Model(languages, tables, backoff, np.log2(np.full(k, 1e-6)))


def gram_counts(sample: DataFrame, languages: list[str]) -> DataFrame:
    """(n, gram, context, suffix, lang, c) of the sample, added up in tasks first."""
    index = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, lang, grams, contexts, suffixes, c in batch_counts(batch, index):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), n, np.int32)), pa.array(grams.view(np.int64)), pa.array(contexts.view(np.int64)), pa.array(suffixes.view(np.int64)), pa.array(np.full(len(grams), lang, np.int32)), pa.array(c.astype(np.int64))],
                    names=["n", "gram", "context", "suffix", "lang", "c"],
                )

    made = sample.select("text", "lang").mapInArrow(run, "n int, gram long, context long, suffix long, lang int, c long")
    return made.groupBy("n", "gram", "lang").agg(F.first("context").alias("context"), F.first("suffix").alias("suffix"), F.sum("c").alias("c"))


def batch_counts(batch: pa.RecordBatch, index: dict[str, int]):
    """Counts of n-grams by language; a text has spaces before it and one after it, and meets no other text."""
    by_lang: dict[int, list[np.ndarray]] = {}
    for t, x in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
        a = codes(t or "")
        if (a != 32).any():
            by_lang.setdefault(index[x], []).append(np.pad(a, (ORDER - 1, 1), constant_values=32))
    for lang, parts in by_lang.items():
        hs = hashes(np.concatenate(parts), ORDER)
        starts = np.cumsum([0] + [len(x) for x in parts])
        real = np.ones(starts[-1], bool)
        real[(starts[:-1, None] + np.arange(ORDER - 1)).ravel()] = False
        at = np.flatnonzero(real)
        for n in range(1, ORDER + 1):
            grams, first, c = np.unique(hs[n - 1][at], return_index=True, return_counts=True)
            first = at[first]
            # the same places without their last character: the context of an n-gram
            context = hs[n - 2][first - 1] if n > 1 else np.zeros(len(grams), np.uint64)
            suffix = hs[n - 2][first] if n > 1 else np.zeros(len(grams), np.uint64)
            yield n, lang, grams, context, suffix, c


def fit(docs: DataFrame, per_language: int = SAMPLE) -> Model | None:
    """Fit to ``(doc_id, text, lang)`` rows; those with a null text or language are left out."""
    known = docs.filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    share = F.element_at(F.create_map(*(x for k in languages for x in (F.lit(k), F.lit(min(1.0, per_language / sizes[k]))))), F.col("lang"))
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(61)), F.lit(1 << 20))
    sample = store(known.filter(draw < share * (1 << 20)).select("doc_id", "text", "lang"), "sample")
    grams = gram_counts(sample, languages).toPandas()  # bounded by the sample
    counts = []
    for n in range(1, ORDER + 1):
        part = grams[grams["n"] == n]
        keys, first, inverse = np.unique(part["gram"].to_numpy().view(np.uint64), return_index=True, return_inverse=True)
        c = np.zeros((len(keys), len(languages)))
        np.add.at(c, (inverse, part["lang"].to_numpy()), part["c"].to_numpy())
        context, suffix = (part[x].to_numpy().view(np.uint64)[first] for x in ("context", "suffix"))
        counts.append((keys, context, suffix, c))
    model = kneser_ney(counts, languages)
    calibrate(model, sample)
    return model


def calibrate(model: Model, sample: DataFrame) -> None:
    """Fit the slope of the score to the sample's margins, and each language's rejection threshold."""
    index = {x: i for i, x in enumerate(model.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(index[x], *two_best(e), float(e[index[x]])) for t, x in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True) if (e := model.entropies(t)) is not None]
            names = ["lang", "best", "margin", "own"]
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 4, kinds, strict=True)], names=names)

    seen = sample.select("text", "lang").mapInArrow(run, "lang int, best int, margin double, own double").toPandas()
    if len(seen):
        margin, right = seen["margin"].to_numpy(), (seen["best"] == seen["lang"]).to_numpy()
        slopes = np.geomspace(1, 200, 40)
        p = np.clip(1 / (1 + np.exp(-np.clip(slopes[:, None] * margin, 0, 50))), 1e-9, 1 - 1e-9)
        model.slope = float(slopes[np.argmax((np.log(p) * right + np.log1p(-p) * ~right).sum(1))])
        for i in range(len(model.languages)):
            own = seen["own"].to_numpy()[seen["lang"].to_numpy() == i]
            if len(own):
                model.ceiling[i] = np.quantile(own, 1 - REJECTED) + 0.5


def two_best(e: np.ndarray) -> tuple[int, float]:
    best = int(e.argmin())
    rest = np.delete(e, best)
    return best, float(rest.min() - e[best]) if len(rest) else math.inf


def languages(docs: DataFrame, train: DataFrame, text: str = "text", per_language: int = SAMPLE) -> DataFrame:
    """Add ``lang_pred``, ``score``, ``bits`` and ``rejected`` to every row of ``docs``; ``text`` is dropped.

    ``lang_pred`` is the language of the lowest cross-entropy, ties to the first by code point.
    ``score`` rises from 0.5 to 1 with the margin to the runner-up, at a slope fitted to the sample.
    ``rejected`` marks texts whose cross-entropy is beyond the calibrated threshold of the language.

    Null texts and texts without a letter get ``und``, score 0, null bits, not rejected. If there is
    nothing to learn from, every row does. Columns of ``docs`` with the names of results are replaced.
    Repeated rows are predicted row by row. An empty table gives an empty one. Texts of any length are
    scored whole, in chunks.
    """
    model = fit(train, per_language)
    base = docs.drop("lang_pred", "score", "bits", "rejected")
    made = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("bits", DoubleType()), StructField("rejected", BooleanType())]
    at, schema = base.columns.index(text), StructType([*(f for f in base.schema if f.name != text), *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(at).to_pylist():
                e = model.entropies(t) if model else None
                if e is None:
                    out.append((UNDETERMINED, 0.0, None, False))
                    continue
                best, margin = two_best(e)
                score = 1 / (1 + math.exp(-min(50.0, model.slope * margin)))
                out.append((model.languages[best], score, float(e[best]), bool(e[best] > model.ceiling[best])))
            rest = [c for i, c in enumerate(batch.columns) if i != at]
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            found = [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [()] * 4, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*rest, *found], names=schema.names)

    return numbered(base).mapInArrow(run, schema)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all ``documents``, learnt from two thirds of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    scored = languages(docs.select("doc_id", "text", held.alias("held_out")), docs.filter(~held))
    return scored.select("doc_id", "held_out", "lang_pred", "score", "bits", "rejected")
