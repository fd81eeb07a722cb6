import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimforge.llm import toxicity as m
from claimforge.llm.toxicity import toxicity


def corpus(n=600):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmn") for _ in range(rng.randrange(3, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.25
        w = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        for _ in range(rng.randrange(1, 4) if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(("zorkish", "quibble", "vexo" + rng.choice(words))))
        rows.append((i, " ".join(w), "en", 0.5))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = corpus()
    odd = [(9000, None, "en", 0.5), (9001, "", None, 0.5), (None, "abc zorkish", "en", 0.5), (9002, "abc " * 50_000, "en", 0.5), (9002, "abc " * 50_000, "en", 0.5)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score double")
    known = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity(docs, known).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert {r.predicted for r in got if r.doc_id in (9000, 9001, 9002)} == {0}


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity(docs, none).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    learnt = any(zlib.crc32(str(i).encode()) % 5 for i in (1, 2))
    assert [r.score for r in toxicity(docs, one).collect()] == [float(learnt)] * 2
    assert toxicity(docs.limit(0), none).count() == 0


def plain_features(text, lexicon):
    """The features by their definitions, a word and a character at a time."""
    words = re.findall(r"\w+", text.lower())
    weigh = lambda w: max([lexicon.get(w, 0.0)] + [lexicon.get("^" + w[:k], 0.0) for k in m.PREFIXES if len(w) > k])
    hits = [i for i, w in enumerate(words) if weigh(w)]
    weights = [weigh(words[i]) for i in hits]
    address = [i for i, w in enumerate(words) if w in m.ADDRESS]
    n, size = max(1, len(words)), max(1, len(text))
    masked = re.findall(r"[^\W\d_]+[\d@$!*#_]+[^\W\d_]+", text)
    plain = [x.lower().translate(m.STAND_INS) for x in masked]
    mark = lambda c: c.isprintable() and not (c.isalnum() or c.isspace() or c in "!?" or c.isupper())
    return [
        math.log1p(len(hits)), len(hits) / n, max(weights, default=0.0), sum(weights) / max(1, len(hits)),
        sum(w in m.INSULTS for w in words) / n, sum(any(abs(i - j) <= m.NEAR for j in address) for i in hits) / max(1, len(hits)), len(address) / n,
        sum(c.isupper() for c in text) / size, len(re.findall(r"\b[A-Z]{3,}\b", text)) / n,
        sum(c in "!?" for c in text) / size, sum(map(mark, text)) / size, sum(c.isdigit() for c in text) / size,
        len(masked) / n, math.log1p(sum(weigh(x) > 0 or x in m.INSULTS for x in plain)), math.log1p(len(words)),
    ]


def walk(lines, x):
    """The prediction of a tree in Spark's printed form, whose lines are read in order."""
    line = next(lines)
    if line.startswith("Predict:"):
        return float(line.split(":")[1])
    feature, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = walk(lines, x)
    next(lines)
    high = walk(lines, x)
    return low if x[int(feature)] <= float(bound) else high


def test_scores_equal_a_plain_walk_of_the_trees(spark):
    rows, labels = corpus(400)
    texts = [t for _, t, _, _ in rows[:60]] + ["", "YOU are a ZORKISH f00l!!", "“Was?” — zork1sh… ÉCOLE 12", "you quibble " * 30, "st_upid 1d1ot du vexoabc"]
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    model = m.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.words and any(w.startswith("^vexo") for w in model.words)
    got = {r.i: r.score for r in model.score(spark.createDataFrame(list(enumerate(texts)), "i long, text string")).select("row.i", "score").collect()}
    bounds, values = (np.array(model.calibration.boundaries.toArray()), np.array(model.calibration.predictions.toArray()))
    assert (np.diff(bounds) >= 0).all() and (np.diff(values) >= 0).all() and values[0] >= 0 and values[-1] <= 1
    trees = [t.toDebugString for t in model.trees.trees]
    for i, t in enumerate(texts):
        x = plain_features(t, model.words)
        assert np.allclose(x, m.features(t, m.Weights(model.words)), atol=1e-12)
        margin = sum(w * walk(iter([y.strip() for y in d.splitlines() if y.strip()][1:]), x) for w, d in zip(model.trees.treeWeights, trees, strict=True))
        p = 1 / (1 + math.exp(-2 * margin))
        assert abs(got[i] - np.interp(p, bounds, values)) < 1e-9


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("abéZ日_019@$!*# .\n"), max_size=30))
def test_masked_words_equal_the_plain_pattern(text):
    assert m.MASKED.findall(text) == re.findall(r"[^\W\d_]+[\d@$!*#_]+[^\W\d_]+", text)


@pytest.mark.parametrize("text", ["x" * 1_000_000, "X" * 1_000_000, "日" * 1_000_000, "x" * 500_000 + "@" * 500_000, "x1" * 500_000, "_" * 1_000_000], ids=["letters", "capitals", "cjk", "marks", "mixed", "underscores"])
def test_long_runs_take_linear_time(text):
    began = time.perf_counter()
    made = m.features(text, m.Weights({"x": 1.0}))
    assert len(made) == len(m.NAMES) and all(map(math.isfinite, made)) and time.perf_counter() - began < 4
