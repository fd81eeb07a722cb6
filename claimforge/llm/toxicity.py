"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

1. A bounded sample of labelled rows is drawn by a hash of the ids and split into two halves.
2. Words and word beginnings get smoothed log-odds from the sample; the strongest make the lexicons.
   Features of one half use the lexicon of the other half, so the trees see honest densities.
3. Gradient-boosted trees are fitted to the features, and an isotonic map from their probability to
   the share of toxic rows on rows that the trees have not seen.
4. Every text is scored whole, in one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from claimforge.llm.common import crc_mod, discard, quoted, release, slices, store

#: Labelled rows that a model is fitted to at most, about; a hash of the id picks them.
SAMPLE = 20_000
#: Entries of a learnt lexicon at most.
LEXICON = 4_096
PREFIXES = (4, 5, 6)
NEAR = 5

# General insults, and pronouns and verbs of address.
INSULTS = frozenset("idiot moron stupid dumb loser scum trash pathetic worthless disgusting clown fool jerk imbecile creep pig idioten dumm abschaum trottel imbécile crétin ordure minable inútil basura estúpido".split())
ADDRESS = frozenset("you your yours yourself youre u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
STAND_INS = str.maketrans("013457@$!", "oieastasi")

WORD = re.compile(r"\w+")
# starts where a run of letters starts and gives nothing back, so a run of any length is read twice at most
MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[\d@$!*#_]++[^\W\d_]++")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
NAMES = ("hits", "hit_rate", "strongest", "mean_weight", "insult_rate", "near_address", "address_rate", "capital_rate", "shout_rate", "exclaim_rate", "mark_rate", "digit_rate", "masked_rate", "masked_hits", "log_words")

CLASS = np.zeros(65536, np.uint8)  # 1 capital, 2 ! or ?, 3 other mark, 4 digit; code points beyond count as none
for _c in range(1, 65535):
    _s = chr(_c)
    CLASS[_c] = 1 if _s.isupper() else 2 if _s in "!?" else 4 if _s.isdigit() else 3 if _s.isprintable() and not _s.isalnum() and not _s.isspace() else 0


def terms(text: str) -> set[str]:
    """The distinct words of a text and, marked by ``^``, their beginnings."""
    words = set(WORD.findall(text.lower()))
    return words | {f"^{w[:n]}" for w in words for n in PREFIXES if len(w) > n}


class Weights(dict):
    """Weight of a word: the greatest of its own and its beginnings', or 0; remembered."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) >= 150_000:
            self.clear()
        get = self.lexicon.get
        w = self[word] = max([get(word, 0.0), *(get(f"^{word[:n]}", 0.0) for n in PREFIXES if len(word) > n)])
        return w


def features(text: str, weights: Weights) -> list[float]:
    """The dense features of a whole text, in the order of ``NAMES``."""
    words = WORD.findall(text.lower())
    n = len(words)
    w = np.fromiter(map(weights.__getitem__, words), np.float64, n)
    hit = np.flatnonzero(w)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(CLASS[np.minimum(codes, 65535)], minlength=5) / max(1, len(codes))
    address = np.array([i for i, x in enumerate(words) if x in ADDRESS], np.int64)
    near = 0
    if len(hit) and len(address):
        i = np.searchsorted(address, hit)
        gap = np.minimum(np.abs(address[np.minimum(i, len(address) - 1)] - hit), np.abs(address[np.maximum(i - 1, 0)] - hit))
        near = int((gap <= NEAR).sum())
    masked = MASKED.findall(text)
    plain = [x.lower().translate(STAND_INS) for x in masked]
    counts = Counter(words)
    return [
        math.log1p(len(hit)), len(hit) / max(1, n), float(w.max(initial=0.0)), float(w[hit].mean()) if len(hit) else 0.0,
        sum(counts[x] for x in INSULTS if x in counts) / max(1, n), near / max(1, len(hit)), len(address) / max(1, n),
        float(kinds[1]), len(SHOUTED.findall(text)) / max(1, n), *map(float, kinds[2:5]),
        len(masked) / max(1, n), math.log1p(sum(weights[x] > 0 or x in INSULTS for x in plain)), math.log1p(n),
    ]


def feature_rows(docs: DataFrame, text: str, lexicons: list[dict[str, float]]) -> DataFrame:
    """``docs`` with ``features`` and without ``text``, or with it if it is a field of their column ``row``.

    The column ``half`` says which lexicon a row uses.
    """
    place = docs.schema["row"].dataType.fieldNames().index(text) if "row" in docs.columns else None
    kept = [f for f in docs.schema if place is not None or f.name != text]

    def inside(batch: pa.RecordBatch) -> pa.Array:
        return batch.column(text) if place is None else batch.column("row").flatten()[place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [Weights(x) for x in lexicons]
        for batch, texts in (part for whole in batches for part in slices(whole, inside(whole))):
            halves = batch.column("half").to_pylist()
            made = pa.array([features(t or "", weights[h]) for t, h in zip(texts, halves, strict=True)], pa.list_(pa.float64()))
            rest = [f.name for f in kept]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in rest), made], names=[*rest, "features"])

    return docs.mapInArrow(run, StructType([*kept, StructField("features", ArrayType(DoubleType()))]))


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, half, toxic, n): documents of the sample with a term, added up in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            rows = zip(batch.column("text").to_pylist(), batch.column("half").to_pylist(), batch.column("toxic").to_pylist(), strict=True)
            for t, h, y in rows:
                found.update((x, h, y) for x in terms(t or ""))
        keys = list(zip(*found, strict=True)) if found else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int32()), pa.array(keys[2], pa.int32()), pa.array(list(found.values()), pa.int64())],
            names=["term", "half", "toxic", "n"],
        )

    return sample.select("text", "half", "toxic").mapInArrow(run, "term string, half int, toxic int, n long").groupBy("term", "half", "toxic").agg(F.sum("n").alias("n"))


def lexicon(counts: DataFrame, n: dict[tuple[int, int], int], halves: tuple[int, ...]) -> dict[str, float]:
    """The terms with the highest certain log-odds of toxic rows in the given halves."""
    toxic, other = (sum(n.get((h, y), 0) for h in halves) for y in (1, 0))
    own = counts.filter(F.col("half").isin(*halves)).groupBy("term").agg(*(F.sum(F.when(F.col("toxic") == y, F.col("n")).otherwise(0)).alias(c) for y, c in ((1, "a"), (0, "b"))))
    odds = F.log((F.col("a") + 0.5) / (toxic + 1.0)) - F.log((F.col("b") + 0.5) / (other + 1.0))
    error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = own.filter("a >= 2").withColumn("odds", odds).withColumn("least", odds - error).filter("least > 1").orderBy(F.desc("least"), "term").limit(LEXICON)
    return {r["term"]: r["odds"] for r in best.select("term", "odds").collect()}


class Model:
    """Lexicon, trees and calibration; ``share`` is all there is if the sample has one class only."""

    def __init__(self, share: float, words: dict[str, float] | None = None, trees=None, calibration=None):
        self.share, self.words, self.trees, self.calibration = share, words, trees, calibration

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """(row, score): all columns of ``docs`` as one, whatever their names, and the score (0 to 1)."""
        whole = docs.select(F.struct(*(docs[quoted(c)].alias(c) for c in docs.columns)).alias("row"))
        if self.trees is None:
            return whole.select("row", F.lit(self.share).alias("score"))
        rows = feature_rows(whole.withColumn("half", F.lit(0)), text, [self.words]).drop("half")
        raw = self.trees.transform(rows.withColumn("features", array_to_vector("features")))
        out = self.calibration.transform(raw.withColumn("p", vector_to_array("probability")[1]))
        return out.select("row", F.least(F.greatest(F.col("calibrated"), F.lit(0.0)), F.lit(1.0)).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit to rows of ``labels`` (doc_id, toxic 0/1) that have a document.

    Rows of ``labels`` with a null id or label are left out; an id with several labels counts as
    toxic if one of them says so.
    """
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, sample / max(1, known.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20))
    part = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(10)).cast("int")
    picked = known.filter(draw < share * (1 << 20)).withColumn("half", part % 2).withColumn("calibrate", part >= 7)
    # about ``sample`` rows of an id, a label and two numbers: a bounded side
    rows = store(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), "sample")
    n = {(r["half"], r["toxic"]): r["n"] for r in rows.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = (sum(v for (_, y), v in n.items() if y == k) for k in (1, 0))
    if not toxic or not other:
        return Model(toxic / max(1, toxic + other))
    counts = store(term_counts(rows), "terms")
    both, *cross = (lexicon(counts, n, h) for h in ((0, 1), (1,), (0,)))
    made = store(feature_rows(rows, "text", cross), "features")
    discard(rows)
    discard(counts)
    features = made
    made = made.withColumn("features", array_to_vector("features")).withColumn("label", F.col("toxic").cast("double")).coalesce(4)
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.3, maxBins=32, seed=7, checkpointInterval=-1, minInstancesPerNode=2)
    seen = made.filter("not calibrate")
    if seen.select("label").distinct().count() < 2:
        seen = made
    model = trees.fit(seen)
    unseen = model.transform(made.filter("calibrate")).withColumn("p", vector_to_array("probability")[1]).select("p", "label")
    ends = made.sparkSession.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "p double, label double")
    calibration = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="calibrated").fit(unseen.unionByName(ends).coalesce(1))
    discard(features)
    release(made.sparkSession)
    return Model(toxic / (toxic + other), both, model, calibration)


def scored_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = 5, fold: int = 0) -> DataFrame:
    """(row, score): every row of ``docs``, its columns of any names as one, with its score."""
    return fit(docs, labels.filter(~(crc_mod("doc_id", folds) == fold)), sample).score(docs)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = 5, fold: int = 0) -> DataFrame:
    """Score every row of ``docs``; learn from labels outside the held-out fold only.

    Returns every column of ``docs`` but ``text``, with ``held_out``, ``score`` and ``predicted``; columns of
    ``docs`` with these three names are replaced, and all others stay. Held out are ids whose crc32 modulo ``folds`` is ``fold`` (null ids are not held out, and
    have no labels). Null and empty texts have all features 0 and get the score of such a text. Repeated
    rows are scored row by row. Without labels of both classes every score is their share (0 if there
    are none). An empty table gives an empty one.
    """
    held = crc_mod("doc_id", folds) == fold
    out = scored_rows(docs.drop("held_out", "score", "predicted"), labels, sample, folds, fold)
    return out.select("row.*", "score").drop("text").withColumn("held_out", F.coalesce(held, F.lit(False))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity scores of all ``documents``, learnt from ``labels``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")
