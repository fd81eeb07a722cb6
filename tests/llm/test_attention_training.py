"""The attention learns from all windows of all training documents, and its gradient is that of its loss."""

from types import SimpleNamespace

import numpy as np

from claimforge.llm import attention_lm, subword
from claimforge.llm.attention_lm import CONTEXT, DIM, EDGE, MEMBERS, NONE, STRIDE, Attention, cut_windows, fit, id_counts, lm_scores, long_windows


def test_documents_outside_the_start_are_learnt(spark):
    """With no document picked for the start, the model was untrained and its vocabulary arbitrary."""
    path = subword.default_path()
    df = spark.createDataFrame([(i, "alpha beta gamma " * 2_000) for i in range(200)], "doc_id long, text string")
    model = fit(df, path, documents=0, steps=0)
    ids = subword.encode(path, " alpha beta gamma" * 30).astype(np.int64)
    assert (model.local[ids] != model.other).all()
    assert model.scores([ids])[0] / len(ids) > -5  # over -8 untrained


def test_counts_are_of_all_documents(spark):
    path = subword.default_path()
    texts = ["one two", "two été " * 50, "", "one"]
    got = id_counts(spark.createDataFrame([(t,) for t in texts], "text string"), path)
    want = np.bincount(np.concatenate([subword.encode(path, t) for t in texts]).astype(int), minlength=len(got))
    assert (got == want).all()


def test_windows_of_stretches_are_those_of_the_text():
    for n in (0, 1, 15, 16, 63, 64, 65, 128, 129, 300):
        ids = np.arange(n, dtype=np.int32)
        x, y, _ = cut_windows([ids], NONE, EDGE, EDGE)
        parts = list(long_windows(ids, 4 * STRIDE))
        assert (np.concatenate([p[0] for p in parts]) == x).all() and (np.concatenate([p[1] for p in parts]) == y).all()


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(0)
    model = Attention(np.ones(60))
    x, y, _ = model.windows([model.local[rng.integers(0, 50, 40)] for _ in range(3)])
    _, g = model.gradient(x, y)
    for name, v in model.p.items():
        i = np.unravel_index(np.abs(g[name]).argmax(), v.shape)
        old, losses = v[i], []
        for step in (1e-2, -1e-2):
            v[i] = old + step
            losses.append(-model.forward(x, y).sum() / (y >= 0).sum())
        v[i] = old
        assert np.isclose((losses[0] - losses[1]) / 2e-2, g[name][i], rtol=0.05, atol=1e-4), name


def test_texts_are_encoded_once(spark, monkeypatch):
    """Each pass over the texts encoded them anew: the counts, the rounds and the scores."""
    made = spark.sparkContext.accumulator(0)
    plain = attention_lm.subword.encode

    def counted(path, text):
        made.add(1)
        return plain(path, text)

    monkeypatch.setattr(attention_lm, "subword", SimpleNamespace(encode=counted, load=subword.load, default_path=subword.default_path))
    rows = spark.createDataFrame([(i, f"alpha beta {i}") for i in range(40)], "doc_id long, text string")
    assert lm_scores(rows, steps=2).count() == 40 and made.value == 40


def test_core_equals_its_definition():
    """Keys and values from tables of ids, and the softmax in parts, against one position at a time in doubles."""
    rng = np.random.default_rng(4)
    model = Attention(np.ones(60))
    x, y, _ = model.windows([model.local[rng.integers(0, 50, n)] for n in (3, 40, 2_100)])
    got, p = model.forward(x, y), {k: v.astype(float) for k, v in model.p.items()}
    for w in (0, 1, 3, len(x) - 1):
        h = p["E"][x[w]] + p["P"]
        for t in np.flatnonzero(y[w] >= 0):
            at = CONTEXT + t
            last = h[at] + p["E1"][x[w, at - 1]] + p["E2"][x[w, at - 2]]
            seen = np.flatnonzero(x[w, : at + 1] != model.pad)
            a = np.exp(last @ p["Q"] @ (h[seen] @ p["K"]).T * DIM**-0.5)
            out = last + (a / a.sum()) @ h[seen] @ p["V"] @ p["O"]
            group, member = divmod(int(y[w, t]), MEMBERS)
            first, second = out @ p["C"] + p["c"], out @ p["M"][group] + p["m"][group]
            want = first[group] - np.log(np.exp(first).sum()) + second[member] - np.log(np.exp(second).sum())
            assert np.isclose(got[w, t], want, rtol=1e-4)


def test_ids_give_the_text_back():
    """Words to score are read from the ids."""
    path = subword.default_path()
    for t in ("", " \t\n\r ", "é\u0000 日本語 ￿", "a<|endoftext|> B", "İ ÀÉ ß " * 50):
        assert subword.load(path).decode_bytes(subword.encode(path, t).tolist()) == t.encode()
