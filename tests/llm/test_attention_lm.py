import math
import zlib
from collections import Counter

import numpy as np

from claimforge.llm import subword
from claimforge.llm.attention_lm import BLOCK, CONTEXT, LN10, SPAN, STRIDE, Attention, fit, lm_scores, words_of


def small():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 40, n) for n in (0, 1, 15, 16, 17, 100)]
    model = Attention(np.bincount(np.concatenate(texts), minlength=60).astype(float))
    model.train([t.astype(np.int32) for t in texts], 30)
    return model, texts


def test_windows_score_each_token_once():
    model, texts = small()
    got = model.scores(texts)
    for t, score in zip(texts, got, strict=True):
        tokens, total = [model.start, *model.local[t]], 0.0
        targets = [*model.local[t], model.end]
        for i, y in enumerate(targets):  # one token at a time, from the window that scores it
            start = i // STRIDE * STRIDE
            x = np.full((1, SPAN), model.pad)
            for j in range(SPAN):
                at = start - CONTEXT + j
                if 0 <= at <= i:
                    x[0, j] = tokens[at]
            z = np.full((1, STRIDE), -1)
            z[0, i - start] = y
            total += model.forward(x, z).sum()
        assert math.isclose(score, total + model.rare[t].sum(), rel_tol=1e-4, abs_tol=1e-3)


def test_next_token_probabilities_sum_to_one():
    model, texts = small()
    x, y, _ = model.windows([model.local[texts[3]]])
    total = 0.0
    for k in range(model.pad):
        z = np.full_like(y[:1], -1)
        z[0, 5] = k
        total += math.exp(model.forward(x[:1], z)[0, 5])
    assert math.isclose(total, 1, rel_tol=1e-3)
    rare = [i for i in range(59) if model.local[i] == model.other]
    assert not rare or math.isclose(sum(math.exp(model.rare[i]) for i in rare), 1, rel_tol=1e-6)


def test_base_equals_brute_force(spark):
    rows = [(i, f"The cat {'sat ' * (i % 5)} word{i % 7} w{i} x É", "s") for i in range(60)] + [(60, None, "s"), (61, "  ", "s"), (None, "new cat", "s"), (5, "The", "s"), (62, "long " * 20_000, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _, _ in rows]
    counts = Counter(w for (_, t, _), h in zip(rows, held, strict=True) if not h for w in [*words_of(t), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for (i, t, _), h in zip(rows, held, strict=True):
        mine = [*words_of(t), None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in mine)
        want.append((i or -1, h, len(mine), sum(counts[w] > 0 for w in mine), n, round(base, 6)))
    for frequent in (3, 1000):
        got = lm_scores(df, steps=20, frequent=frequent).collect()
        assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
        assert all(r.score < 0 for r in got)
    assert lm_scores(df.limit(0), steps=5).count() == 0


def test_blocks_add_up_to_texts():
    model, texts = small()
    long = np.random.default_rng(2).integers(0, 59, 5 * BLOCK)
    for t in [*texts, long, long[:-1], long[: BLOCK + 1]]:
        blocks = model.block_scores([t])[0]
        assert len(blocks) == len(t) // BLOCK + 1
        whole = model.windows([model.local[t]])
        assert math.isclose(blocks.sum(), model.forward(*whole[:2]).sum() + model.rare[t].sum(), rel_tol=1e-4)


def test_memory_equals_brute_force(spark):
    """Counts of blocks after blocks over all training rows but a row's own, with the attention as prior."""
    long = " ".join(f"word{i}" for i in range(150))
    rows = [(1, long), (2, long), (3, long + " and more"), (4, "short"), (5, None), (6, "the " * 400), (None, "x " + long), (7, long), (None, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in lm_scores(df, steps=10).collect():
        got.setdefault((r.doc_id, r.n_tokens), []).append(r.score)
    train = df.filter("doc_id is null or crc32(cast(cast(doc_id as string) as binary)) % 5 <> 1")
    model, path = fit(train, subword.default_path(), steps=10), subword.default_path()
    texts = [(i, zlib.crc32(str(i).encode()) % 5 == 1 if i else False, subword.encode(path, t).astype(np.int64)) for i, t in rows]
    split = lambda t: [*(tuple(t[i : i + BLOCK].tolist()) for i in range(0, len(t) - len(t) % BLOCK, BLOCK)), (*t[len(t) - len(t) % BLOCK :].tolist(), "end")]
    for k, (i, held, t) in enumerate(texts):
        others = [split(u) for n, (_, h, u) in enumerate(texts) if n != k and not h]
        after = Counter((a, b) for o in others for a, b in zip([None, *o], o))
        before = Counter(a for o in others for a in o[:-1])
        want, last = 0.0, None
        for b, lnp in zip(split(t), model.block_scores([t])[0], strict=True):
            alpha, n = (max(1, len(others)), len(others)) if last is None else (1, before[last])
            want += math.log10((after[last, b] + alpha * math.exp(lnp)) / (n + alpha)) if after[last, b] else (math.log(alpha) + lnp - math.log(n + alpha)) / LN10
            last = b
        assert any(math.isclose(want, x, rel_tol=1e-5) for x in got[i, len(words_of(rows[k][1])) + 1])
    twice = max(got[1, 151] + got[2, 151])
    assert twice > -10


def test_training_takes_windows_of_long_texts(spark):
    """A text far longer than the bound is trained on by some of its windows."""
    df = spark.createDataFrame([(i, "alpha beta gamma " * 20_000) for i in range(3)], "doc_id long, text string")
    model = fit(df, subword.default_path(), windows=500, steps=60)
    ids = subword.encode(subword.default_path(), " alpha beta gamma" * 30).astype(np.int64)
    assert model.scores([ids])[0] / len(ids) > -1.5
