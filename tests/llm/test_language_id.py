import math
import random

import numpy as np
from pyspark.sql import functions as F

from claimforge.llm.language_id import ORDER, languages


def corpus():
    rng = random.Random(4)
    alphabets = {"aa": "abcdeé ", "bb": "defghi ", "cc": "ñopqrs "}
    rows = []
    for i in range(240):
        x = ("aa", "bb", "cc")[i % 3]
        rows.append((i, "".join(rng.choice(alphabets[x]) for _ in range(rng.choice((30, 200)))), x, "s"))
    return rows


def test_held_out_accuracy_and_odd_texts(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    odd = spark.createDataFrame([(900, None, None, "s"), (901, "", "aa", "s"), (902, "123 !?", "bb", "s"), (903, "dcbae" * 60_000, "aa", "s"), (None, "ghi", None, "s"), (904, "漢字", None, "s")], df.schema)
    train = df.filter("doc_id % 4 <> 1").unionByName(odd.filter("lang is null"))
    got = {r.doc_id: r for r in languages(df.filter("doc_id % 4 = 1").drop("lang").unionByName(odd.drop("lang")), train).collect()}
    assert all(got[i].lang_pred == x for i, _, x, _ in rows if i % 4 == 1)
    assert [got[i].lang_pred for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "aa", "bb"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[904].rejected and not got[1].rejected
    assert languages(df.limit(0), train).count() == 0
    assert {r.lang_pred for r in languages(df, train.limit(0)).collect()} == {"und"}


def test_probabilities_sum_to_one(spark):
    from claimforge.llm import language_id as m

    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, score string").filter("lang = 'aa'")
    model = m.fit(df)
    text = df.first().text
    a = m.codes(text)[:9]
    letters = [ord(c) for c in "abcdeé "]
    before = model.bits(a)[0]
    total = sum(2.0 ** (before - model.bits(np.append(a, np.uint32(c)))[0]) for c in letters)
    assert 0.97 < total <= 1.0 + 1e-6 and math.isfinite(total) and ORDER == 4


def spelled(text):
    """Lower-cased letters and a space for each run of other characters."""
    out = ""
    for c in text:
        x = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
        out += "" if x == " " and out.endswith(" ") else x
    return out


class Plain:
    """Interpolated Kneser-Ney over dictionaries of strings."""

    def __init__(self, rows, discount=0.75):
        self.d, self.langs = discount, sorted({x for _, x in rows})
        self.seen = [{} for _ in range(ORDER + 1)]
        for text, lang in rows:
            s = " " * (ORDER - 1) + spelled(text) + " "
            for i in range(ORDER - 1, len(s)):
                for n in range(1, ORDER + 1):
                    c = self.seen[n].setdefault(s[i - n + 1 : i + 1], {})
                    c[lang] = c.get(lang, 0) + 1
        self.counts = [None] * (ORDER + 1)
        self.counts[ORDER] = self.seen[ORDER]
        for n in range(1, ORDER):
            self.counts[n] = {g: {} for g in self.seen[n]}
            for longer, by_lang in self.seen[n + 1].items():
                for lang in by_lang:
                    c = self.counts[n][longer[1:]]
                    c[lang] = c.get(lang, 0) + 1
        self.after = [{} for _ in range(ORDER + 1)]
        for n in range(1, ORDER + 1):
            for g, c in self.counts[n].items():
                for lang in self.langs:
                    t = self.after[n].setdefault((g[:-1], lang), [0, 0])
                    t[0] += c.get(lang, 0)
                    t[1] += c.get(lang, 0) > 0

    def gamma(self, n, context, lang):
        total, types = self.after[n].get((context, lang), (0, 0))
        return self.d * types / total if total else 1.0

    def p(self, n, g, lang):
        base = 1e-4 if n == 1 else self.p(n - 1, g[1:], lang)
        total = self.after[n][g[:-1], lang][0]
        own = max(self.counts[n][g].get(lang, 0) - self.d, 0) / total if total else 0.0
        return own + self.gamma(n, g[:-1], lang) * base

    def bits(self, text, lang):
        s, out = " " * (ORDER - 1) + spelled(text), 0.0
        for i in range(ORDER - 1, len(s)):
            for n in range(ORDER, 0, -1):
                g = s[i - n + 1 : i + 1]
                if g in self.counts[n]:
                    out -= math.log2(max(self.p(n, g, lang), 1e-12))
                    break
                if n > 1:
                    out -= math.log2(self.gamma(n, g[:-1], lang))
            else:
                out -= math.log2(1e-6)
        return out


def test_equals_plain_kneser_ney(spark, monkeypatch):
    from claimforge.llm import language_id as m

    rows = [(t, x) for _, t, x, _ in corpus()[:60]] + [("A bad cab, 12 dab!", "aa"), ("...", "bb"), ("", "cc"), ("Éé", "aa")]
    df = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)
    model = m.fit(df, per_language=10**6)
    plain = Plain([(t, x) for t, x in rows if any(c.isalpha() for c in t)])
    monkeypatch.setattr(m, "CHUNK", 7)  # texts of many chunks
    for text in [t for t, _ in rows[:9]] + ["zebra", "q", "(abc) x9y", "dcba ponm", "Ünïcode 漢 bed"]:
        got = model.bits(m.codes(text))
        assert np.allclose(got, [plain.bits(text, x) for x in model.languages], rtol=1e-9), text


def test_columns_of_odd_names_and_types_stay(spark):
    train = spark.createDataFrame([(i, "abc abd " * 9 if i % 2 else "xyz xyw " * 9, "aa" if i % 2 else "bb") for i in range(40)], "doc_id long, text string, lang string")
    df = spark.createDataFrame([(1, "abc abd")], "doc_id long, text string").withColumn("odd `name", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("nested", F.struct(F.lit(1).alias("x y"), F.lit("z").alias("`")))
    (row,) = languages(df, train).collect()
    assert row["odd `name"] == 1 and row["nested"]["x y"] == 1 and row["lang_pred"] == "aa"
