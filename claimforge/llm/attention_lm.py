"""Language-model scores from a causal self-attention model on subword ids, and a unigram base.

The model has two parts. Attention gives the prior of every block of ``BLOCK`` ids. The blocks of all training documents, counted after the block before them,
are its memory: a block's probability is (c + alpha * prior) / (n + alpha), with c its count after that
block, n the count of that block, and alpha 1 (for first blocks the number of training documents). A
training text is scored by the counts of the other rows, without its own.

The texts are encoded once; their ids are stored and read by all passes. The attention is trained in numpy on all windows of all training documents. A bounded sample gives its start
only; then, in ``ROUNDS`` rounds over equal shares of the documents, every task trains its own copy on the
windows of its rows, and the parameters are averaged, weighted by windows. Its vocabulary and the frequencies
of other ids are counted over all training documents. The attention reads windows of ``CONTEXT +
STRIDE`` positions of which it scores the last ``STRIDE``; windows overlap by ``CONTEXT``, so each token is
scored once and sees at least that many tokens before it. Windows of many texts are scored together
with one masked attention. The softmax has two levels (class, then member of the class) over the most
frequent ids; an id that is not among them is "other" and then itself by its smoothed frequency.

The base needs the count of every word of the training documents. Counts are added up in tasks,
then by word. The most frequent words, a bounded number, go to every task; all others are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from claimforge.llm import subword
from claimforge.llm.common import crc_mod, discard, release, slices, store

CLASSES, MEMBERS = 64, 64
DIM = 32
CONTEXT, STRIDE = 8, 16
SPAN = CONTEXT + STRIDE
#: In windows of bare ids: no id, and the start or the end of a text.
NONE, EDGE = -1, -2
#: Ids of a block of the memory, whole windows.
BLOCK = 4 * STRIDE
#: Documents on whose windows the attention starts, about; a hash of the id picks them.
SAMPLE = 1_500
#: Windows of these that are used, about; a hash of the document and the place picks them.
SAMPLE_WINDOWS = 190_000
STEPS, BATCH, RATE = 2_000, 160, 6e-3
#: The rounds over all windows: shares of the documents, windows of a step, those held to be shuffled, the first rate.
ROUNDS, ROUND_BATCH, ROUND_HELD, ROUND_RATE = 4, 512, 16_384, 4e-3
#: Parameters that are added up in one group.
CHUNK = 1 << 16
#: Windows whose attention, and positions whose softmax, is worked out at a time.
WINDOWS, ROWS = 128, 2_048
#: Words whose counts go to every task.
FREQUENT = 200_000
#: Distinct words that a task holds before it hands on their counts.
HELD = 300_000
LN10 = float(np.log(10))


def cut_windows(texts: list[np.ndarray], pad: int, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (n, SPAN), targets (n, STRIDE; -1: none), and the number of windows of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = -(-(lengths + 1) // STRIDE)
    total = int(counts.sum()) * STRIDE
    inputs, targets = np.full(total, pad, np.int32), np.full(total, -1, np.int32)
    at = np.concatenate([[0], np.cumsum(counts)]) * STRIDE
    flat = np.concatenate([np.empty(0, np.int32), *texts])
    place = np.arange(len(flat)) + np.repeat(at[:-1] - (np.cumsum(lengths) - lengths), lengths)
    inputs[at[:-1]] = start
    inputs[place + 1] = flat
    targets[place] = flat
    targets[at[:-1] + lengths] = end
    new = inputs.reshape(-1, STRIDE)
    before = np.full((len(new), CONTEXT), pad, np.int32)
    before[1:] = new[:-1, STRIDE - CONTEXT :]
    before[at[:-1] // STRIDE] = pad
    return np.concatenate([before, new], 1), targets.reshape(-1, STRIDE), counts


def long_windows(ids: np.ndarray, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Inputs and targets of all windows of a text of any length, some at a time, with ``NONE`` and ``EDGE`` in them."""
    for a in range(0, len(ids) + 1, most):
        x, y, _ = cut_windows([ids[max(0, a - STRIDE) : a + most]], NONE, EDGE, EDGE)
        part = slice(1 if a else 0, -1 if a + most <= len(ids) else None)  # the stretch before gives context, the one after its own windows
        yield x[part], y[part]


def sums_by_id(places: np.ndarray, d: np.ndarray, size: int) -> np.ndarray:
    """(size, width): the sums of the rows of ``d`` that belong to each id; ``places`` has id * width + column for each number."""
    return np.bincount(places.ravel(), d.ravel(), size * d.shape[-1]).reshape(size, -1).astype(np.float32)


class Attention:
    """One head of causal self-attention with a residual path and a two-level softmax."""

    def __init__(self, frequency: np.ndarray, seed: int = 1):
        vocabulary = len(frequency) - 1  # the last one is the end of a text
        order = np.argsort(-frequency[:vocabulary], kind="stable")[: CLASSES * MEMBERS - 2]
        self.end, self.other = 0, 1
        self.local = np.full(vocabulary, self.other, np.int32)
        self.local[order] = np.arange(2, len(order) + 2)
        rare = np.where(self.local == self.other, frequency[:vocabulary], 0) + 0.5
        self.rare = np.where(self.local == self.other, np.log(rare / max(1.0, rare[self.local == self.other].sum())), 0.0)
        self.pad, self.start = CLASSES * MEMBERS, CLASSES * MEMBERS + 1
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale=DIM**-0.5: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "E": draw(CLASSES * MEMBERS + 2, DIM, scale=0.3), "E1": draw(CLASSES * MEMBERS + 2, DIM, scale=0.1), "E2": draw(CLASSES * MEMBERS + 2, DIM, scale=0.1), "P": draw(SPAN, DIM, scale=0.1), "Q": draw(DIM, DIM), "K": draw(DIM, DIM), "V": draw(DIM, DIM), "O": draw(DIM, DIM, scale=0.1),
            "C": draw(DIM, CLASSES), "c": np.zeros(CLASSES, np.float32), "M": draw(CLASSES, DIM, MEMBERS), "m": np.zeros((CLASSES, MEMBERS), np.float32),
        }
        t, s = np.arange(SPAN)[None, :], np.arange(STRIDE)[:, None] + CONTEXT
        self.mask = (t <= s).astype(np.float32)

    def windows(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return cut_windows(texts, self.pad, self.start, self.end)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What each id and each place adds to a key, met with the query's matrix, and to a value, met with the output's; and the matrix of both."""
        p = self.p
        both = np.concatenate([p["K"] @ p["Q"].T * np.float32(DIM**-0.5), p["V"] @ p["O"]], 1)
        return p["E"] @ both, p["P"] @ both, both

    def attend(self, x: np.ndarray, tables: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """The state of every position that is scored, and what it is made of."""
        p, n = self.p, len(x)
        kv = tables[0].take(x, 0)
        kv += tables[1]
        k, v = kv[:, :, :DIM], kv[:, :, DIM:]
        last = p["E"].take(x[:, CONTEXT:], 0)
        last += p["P"][CONTEXT:]
        last += p["E1"].take(x[:, CONTEXT - 1 : -1], 0)
        last += p["E2"].take(x[:, CONTEXT - 2 : -2], 0)
        a = last @ k.transpose(0, 2, 1)
        np.minimum(a, 30, out=a)
        np.exp(a, out=a)
        a *= self.mask
        a *= (x != self.pad).astype(np.float32)[:, None, :]
        a *= (1 / (a.reshape(-1, SPAN) @ np.ones(SPAN, np.float32) + np.float32(1e-9))).reshape(n, STRIDE, 1)
        h = a @ v
        h += last
        return h, last, k, v, a

    def softmax(self, h: np.ndarray, targets: np.ndarray, keep: bool = False):
        """ln p of the targets; with ``keep``, the gradients of their mean loss by the states and by the two levels."""
        p = self.p
        y = targets.ravel()
        sel = np.flatnonzero(y >= 0)
        order = np.argsort((y[sel] // MEMBERS).astype(np.int8), kind="stable")  # members of a class together
        sel = sel[order]
        group, member = np.divmod(y[sel], MEMBERS)
        bounds = np.searchsorted(group, np.arange(CLASSES + 1)).tolist()
        hs = np.ones((len(sel), DIM + 1), np.float32)  # the last column meets the biases
        hs[:, :DIM] = h.take(sel, 0)
        c, m = np.concatenate([p["C"], p["c"][None]]), np.concatenate([p["M"], p["m"][:, None]], 1)
        own, sums = np.empty(len(sel), np.float32), np.empty((len(sel), 2), np.float32)
        if keep:
            gc, gm, dhs, share = np.zeros_like(c), np.zeros_like(m), np.empty((len(sel), DIM), np.float32), np.float32(1 / max(1, len(sel)))
        z, ones, g = np.empty((min(ROWS, len(sel)), 2, CLASSES), np.float32), np.ones(CLASSES, np.float32), 0
        for at in range(0, len(sel), ROWS):
            end = min(at + ROWS, len(sel))
            part, zs, rows = hs[at:end], z[: end - at], np.arange(end - at)
            spans = []
            for g in range(int(group[at]), int(group[end - 1]) + 1):
                if (i := max(at, bounds[g])) < (j := min(end, bounds[g + 1])):
                    spans.append((g, i - at, j - at))
            np.matmul(part, c, out=zs[:, 0])
            for g, i, j in spans:
                np.matmul(part[i:j], m[g], out=zs[i:j, 1])
            if zs.max() > 60:
                np.minimum(zs, 60, out=zs)
            gs, ms = group[at:end], member[at:end]
            np.add(zs[rows, 0, gs], zs[rows, 1, ms], out=own[at:end])
            np.exp(zs, out=zs)
            np.matmul(zs.reshape(-1, CLASSES), ones, out=sums[at:end].reshape(-1))
            if keep:
                zs *= (share / sums[at:end])[:, :, None]
                zs[rows, 0, gs] -= share
                zs[rows, 1, ms] -= share
                gc += part.T @ zs[:, 0]
                d = np.matmul(zs[:, 0], p["C"].T, out=dhs[at:end])
                for g, i, j in spans:
                    gm[g] += part[i:j].T @ zs[i:j, 1]
                    d[i:j] += zs[i:j, 1] @ p["M"][g].T
        logp = np.zeros(targets.size, np.float64)
        logp[sel] = own - np.log(sums).sum(1)
        logp = logp.reshape(targets.shape)
        if not keep:
            return logp
        dh = np.zeros((targets.size, DIM), np.float32)
        dh[sel] = dhs
        return logp, dh, {"C": gc[:DIM], "c": gc[DIM], "M": gm[:, :DIM], "m": gm[:, DIM]}

    def forward(self, x: np.ndarray, targets: np.ndarray, tables: tuple[np.ndarray, ...] | None = None) -> np.ndarray:
        """ln p of the targets (0 where there is none)."""
        tables = tables or self.tables()
        h = np.empty((len(x), STRIDE, DIM), np.float32)
        for at in range(0, len(x), WINDOWS):
            h[at : at + WINDOWS] = self.attend(x[at : at + WINDOWS], tables)[0]
        return self.softmax(h.reshape(-1, DIM), targets)

    def gradient(self, x: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        p, n, tables = self.p, len(x), self.tables()
        parts = [self.attend(x[at : at + WINDOWS], tables) for at in range(0, n, WINDOWS)]
        logp, dh, g = self.softmax(np.concatenate([h for h, *_ in parts]).reshape(-1, DIM), targets, keep=True)
        dh = dh.reshape(n, STRIDE, DIM)
        dlast, dkv = np.empty((n, STRIDE, DIM), np.float32), np.empty((n, SPAN, 2 * DIM), np.float32)
        for at, (_, last, k, v, a) in zip(range(0, n, WINDOWS), parts, strict=True):
            rows = slice(at, at + len(last))
            ds = dh[rows] @ v.transpose(0, 2, 1)
            ds *= a
            ds -= a * (ds.reshape(-1, SPAN) @ np.ones(SPAN, np.float32)).reshape(-1, STRIDE, 1)
            np.matmul(ds, k, out=dlast[rows])
            np.matmul(ds.transpose(0, 2, 1), last, out=dkv[rows, :, :DIM])
            np.matmul(a.transpose(0, 2, 1), dh[rows], out=dkv[rows, :, DIM:])
        dlast += dh
        size, both = len(p["E"]), tables[2]
        h0 = p["E"].take(x, 0)
        h0 += p["P"]
        dboth = h0.reshape(-1, DIM).T @ dkv.reshape(-1, 2 * DIM)
        dx = (dkv.reshape(-1, 2 * DIM) @ both.T).reshape(n, SPAN, DIM)
        dx[:, CONTEXT:] += dlast
        g["P"] = dx.sum(0)
        places = x[:, :, None].astype(np.intp) * DIM + np.arange(DIM)
        for name, ids, d in (("E", places, dx), ("E1", places[:, CONTEXT - 1 : -1], dlast), ("E2", places[:, CONTEXT - 2 : -2], dlast)):
            g[name] = sums_by_id(ids, d, size)
        dkq, dvo = dboth[:, :DIM] * np.float32(DIM**-0.5), dboth[:, DIM:]
        g["K"], g["Q"], g["V"], g["O"] = dkq @ p["Q"], dkq.T @ p["K"], dvo @ p["O"].T, p["V"].T @ dvo
        return -logp.sum() / max(1, int((targets >= 0).sum())), g

    def train(self, texts: list[np.ndarray], steps: int = STEPS, seed: int = 2) -> list[float]:
        """Train on all windows of whole texts."""
        x, y, _ = self.windows([self.local[t] for t in texts])
        return self.train_windows(x, y, steps, seed)

    def train_windows(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 2) -> list[float]:
        """Adam over shuffled windows; the rate falls to 0."""
        rng = np.random.default_rng(seed)
        picks = (rng.integers(0, len(x), BATCH) for _ in range(steps if len(x) else 0))
        return self.descend(((x[p], y[p]) for p in picks), lambda step: RATE * (1 - step / (steps + 1)))

    def descend(self, batches: Iterable[tuple[np.ndarray, np.ndarray]], rate_at: Callable[[int], float], short: int = 50) -> list[float]:
        """Adam over the batches; the first steps are ``short``."""
        whole, at = np.concatenate([v.ravel() for v in self.p.values()]), 0
        for k, v in self.p.items():  # one array, so that a step goes through memory once
            self.p[k] = whole[at : at + v.size].reshape(v.shape)
            at += v.size
        means, squares, spare = np.zeros_like(whole), np.zeros_like(whole), np.empty(CHUNK, np.float32)
        losses = []
        for step, (x, y) in enumerate(batches, 1):
            loss, g = self.gradient(x, y)
            losses.append(loss)
            rate = rate_at(step) * min(1, step / short)
            made = np.concatenate([g[k].ravel() for k in self.p])
            for at in range(0, len(whole), CHUNK):
                d, m, s = (v[at : at + CHUNK] for v in (made, means, squares))
                t = spare[: len(d)]
                m *= 0.9
                s *= 0.99
                s += np.multiply(np.multiply(d, d, out=t), 0.01, out=t)
                d *= 0.1
                m += d
                np.sqrt(s, out=t)
                t *= (1 - 0.99**step) ** -0.5
                t += 1e-8
                np.divide(m, t, out=t)
                t *= rate / (1 - 0.9**step)
                whole[at : at + CHUNK] -= t
        return losses

    def local_windows(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows of bare ids as those of the model."""
        return np.where(x >= 0, self.local[x], np.where(x == EDGE, self.start, self.pad)), np.where(y >= 0, self.local[y], np.where(y == EDGE, self.end, NONE))

    def block_scores(self, texts: list[np.ndarray], at_once: int = 512) -> list[np.ndarray]:
        """ln p of each block of whole texts given as subword ids; an empty text is an immediate end."""
        out: list[np.ndarray] = []
        tables = self.tables()
        start = 0
        while start < len(texts):  # as many texts at a time as make some windows
            stop, n = start, 0
            while stop < len(texts) and n < 4096 * STRIDE:
                n += len(texts[stop])
                stop += 1
            group = texts[start:stop]
            x, y, counts = self.windows([self.local[t] for t in group])
            total = np.concatenate([self.forward(x[i : i + at_once], y[i : i + at_once], tables).sum(1) for i in range(0, len(x), at_once)])
            for t, part in zip(group, np.split(total, np.cumsum(counts)[:-1]), strict=True):
                whole = np.add.reduceat(part, np.arange(0, len(part), BLOCK // STRIDE))
                rare = self.rare[t]
                if rare.any():
                    first = np.arange(0, len(t), BLOCK)
                    whole[: len(first)] += np.add.reduceat(rare, first)
                out.append(whole)
            start = stop
        return out

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """ln p of whole texts under the attention alone."""
        return np.array([b.sum() for b in self.block_scores(texts)])


def fit(docs: DataFrame, vocabulary: str, documents: int = SAMPLE, windows: int = SAMPLE_WINDOWS, steps: int = STEPS) -> Attention:
    """The model of all windows of ``(doc_id, text)`` rows, or of such rows that are dealt and encoded.

    It starts from about ``windows`` hashed windows of about ``documents`` hashed rows, in ``steps`` steps on the driver;
    then tasks train it on every window of every row. What is collected is bounded: that start, a count for each id
    and the parameters.
    """
    known = (docs if "ids" in docs.columns else encoded(dealt(docs), vocabulary)).filter("size is not null")
    kind = id_kind(vocabulary)
    n = known.count()
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(91)), F.lit(1 << 24))
    picked = known.withColumn("draw", draw).filter(F.col("draw") < min(1.0, documents / max(1, n)) * (1 << 24))
    # an id has two bytes or more in most texts; a third of the share is room for those of one
    held = (picked.agg(F.sum("size")).first()[0] or 0) / 2.5 / STRIDE
    share = min(1.0, windows / max(1.0, held))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for d, t in zip(batch.column("draw").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                x, y, _ = cut_windows([np.frombuffer(t, kind).astype(np.int32)], NONE, EDGE, EDGE)
                found += [(d, w, x[w].tobytes(), y[w].tobytes()) for w in np.flatnonzero(np.random.default_rng(d).random(len(x)) < share).tolist()]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True) if found else [()] * 4, kinds, strict=True)], names=["draw", "place", "x", "y"])

    rows = sorted((r["draw"], r["place"], bytes(r["x"]), bytes(r["y"])) for r in picked.select("draw", "ids").mapInArrow(cut, "draw long, place long, x binary, y binary").toLocalIterator())
    x, y = (np.frombuffer(b"".join(r[k] for r in rows), np.int32).reshape(-1, width) for k, width in ((2, SPAN), (3, STRIDE)))
    model = Attention(id_counts(known, vocabulary))
    model.train_windows(*model.local_windows(x, y), steps if rows else 0)
    for r in range(ROUNDS if n else 0):
        train_share(known.filter(F.col("round") == r), vocabulary, model, ROUND_RATE * (1 - r / ROUNDS))
    return model


def id_kind(vocabulary: str) -> str:
    """The numpy kind of stored ids."""
    return "<u2" if subword.load(vocabulary).n_vocab <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` with the subword ids of its texts as bytes, ``ids``, in place of ``text``; unchanged if it has them. Ids give the text back."""
    if "ids" in docs.columns:
        return docs
    kind, kept = id_kind(vocabulary), [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in (part for whole in batches for part in slices(whole, whole.column("text"))):
            ids = [subword.encode(vocabulary, t).astype(kind).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(ids, pa.binary())], names=[*(f.name for f in kept), "ids"])

    return docs.mapInArrow(run, StructType([*kept, StructField("ids", BinaryType())]))


def dealt(docs: DataFrame) -> DataFrame:
    """``docs`` with what the training asks of a text besides its ids: its ``size`` in bytes, null without a text, and its round."""
    return docs.withColumns({"size": F.octet_length("text").cast("long"), "round": F.pmod(F.xxhash64("text", "doc_id"), F.lit(ROUNDS)).cast("int")})


def id_counts(docs: DataFrame, vocabulary: str) -> np.ndarray:
    """How often each subword id occurs in all texts, and a last 0 for the end."""
    size, kind = subword.load(vocabulary).n_vocab + 1, id_kind(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, np.int64)
        for batch in batches:
            for _, ids in slices(batch, batch.column(0)):
                found += np.bincount(np.frombuffer(b"".join(ids), kind), minlength=size)
        ids = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found[ids])], names=["id", "c"])

    out = np.zeros(size)
    for r in encoded(docs, vocabulary).select("ids").mapInArrow(run, "id long, c long").groupBy("id").agg(F.sum("c").alias("c")).toLocalIterator():
        out[r["id"]] = r["c"]
    return out


def train_share(docs: DataFrame, vocabulary: str, model: Attention, rate: float) -> None:
    """Every task trains a copy of the model on all windows of its rows; the model becomes their average, weighted by windows."""
    stored = id_kind(vocabulary)

    def batches_of(texts: Iterator[bytes], rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, n = [], 0

        def give() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            x, y = model.local_windows(*(np.concatenate(c) for c in zip(*held, strict=True)))
            order = rng.permutation(len(x))
            for at in range(0, len(x), ROUND_BATCH):
                yield x[order[at : at + ROUND_BATCH]], y[order[at : at + ROUND_BATCH]]

        for t in texts:
            for x, y in long_windows(np.frombuffer(t, stored).astype(np.int32)):
                held.append((x, y))
                n += len(x)
                if n >= ROUND_HELD:
                    yield from give()
                    held, n = [], 0
        if n:
            yield from give()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = 0

        def counted() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            nonlocal windows
            texts = (t for batch in batches for _, part in slices(batch, batch.column(0)) for t in part)
            for x, y in batches_of(texts, np.random.default_rng(TaskContext.get().partitionId())):
                windows += len(x)
                yield x, y

        model.descend(counted(), lambda _: rate, short=5)
        if windows:
            flat = np.concatenate([v.ravel() for v in model.p.values()]).astype(np.float64) * windows
            chunks = [flat[at : at + CHUNK].tobytes() for at in range(0, len(flat), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks)), pa.int32()), pa.array([windows] * len(chunks), pa.int64()), pa.array(chunks, pa.binary())], names=["chunk", "windows", "sums"])

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, windows, total = 0, 0, 0.0
        for batch in parts:
            for row in batch.to_pylist():
                chunk, windows, total = row["chunk"], windows + row["windows"], total + np.frombuffer(row["sums"])
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([windows], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "windows", "sums"])

    kind = "chunk int, windows long, sums binary"
    found = sorted((r["chunk"], r["windows"], bytes(r["sums"])) for r in encoded(docs, vocabulary).select("ids").mapInArrow(run, kind).groupBy("chunk").applyInArrow(add, kind).collect())
    if found:
        flat, at = np.concatenate([np.frombuffer(sums) / windows for _, windows, sums in found]).astype(np.float32), 0
        for k, v in model.p.items():
            model.p[k] = flat[at : at + v.size].reshape(v.shape)
            at += v.size


def block_keys(ids: np.ndarray, row: int) -> tuple[list[int], list[int]]:
    """For each block of a text the hashes of it after the block before it, and of that block alone.

    Before the first block nothing stands; the hash of the row, which no block has, takes its place.
    """
    raw = ids.astype(np.uint32).tobytes()
    blocks = [raw[i : i + 4 * BLOCK] for i in range(0, len(raw) + 1, 4 * BLOCK)]
    blocks[-1] += b"end"
    before = [xxhash.xxh64_intdigest(b, 1) for b in blocks]
    sign = lambda h: h - (1 << 64) if h >> 63 else h
    keys = [sign(xxhash.xxh64_intdigest(b, before[i - 1] if i else 2)) for i, b in enumerate(blocks)]
    return keys, [sign(xxhash.xxh64_intdigest(str(row).encode(), 3)), *map(sign, before[:-1])]


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than ASCII white space, with A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all texts; tasks add up first and hold a bounded number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        give = lambda: pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "c"])
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found.update(words_of(t))
                if len(found) >= HELD:
                    yield give()
                    found.clear()
        yield give()

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def least_count(counts: DataFrame, most: int) -> int:
    """A count that at most ``most`` words reach, from a histogram of a bounded number of steps."""
    step = lambda c: F.floor(F.log(c.cast("double")) * 40)
    held, least = 0, 1 << 62
    for r in sorted(counts.groupBy(step(F.col("c")).alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect(), key=lambda r: -r["step"]):
        held += r["n"]
        if held > most:
            break
        least = r["least"]
    return least


def scored_rows(docs: DataFrame, frequent: dict[bytes, int], model: Attention, vocabulary: str) -> DataFrame:
    """Per row: the base's sum over frequent words, the other words with counts, and the blocks with the attention's ln p."""
    stored = id_kind(vocabulary)
    block_kind = pa.list_(pa.struct([("key", pa.int64()), ("before", pa.int64()), ("times", pa.int64()), ("times_before", pa.int64()), ("lnp", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId() << 36, 0
        logs = {w: math.log10(c + 0.5) for w, c in frequent.items()}
        decode = subword.load(vocabulary).decode_bytes
        for batch, texts in (part for whole in batches for part in slices(whole, whole.column("ids"), 2_000_000)):
            ids = [np.frombuffer(t, stored).astype(np.int64) for t in texts]
            n_tokens, known, base, rare = [], [], [], []
            for t in ids:
                n, found, total, others = 0, 0, 0.0, []
                for w, c in Counter(decode(t.tolist()).lower().split()).items():
                    n += c
                    log = logs.get(w)
                    if log is None:
                        others.append({"word": w, "tf": c})
                    else:
                        found += c
                        total += c * log
                n_tokens.append(n + 1)
                known.append(found)
                base.append(total)
                rare.append(others)
            rows = np.arange(at, at + len(ids)) + part
            at += len(ids)
            blocks = []
            for row, t, lnp in zip(rows.tolist(), ids, model.block_scores(ids), strict=True):
                keys, before = block_keys(t, row)
                times, times_before = Counter(keys), Counter(before)
                blocks.append([{"key": k, "before": b, "times": times[k], "times_before": times_before[b], "lnp": p} for k, b, p in zip(keys, before, lnp.tolist(), strict=True)])
            made = [pa.array(rows), batch.column("doc_id"), batch.column("held_out"), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int64())]))), pa.array(blocks, block_kind)]
            yield pa.RecordBatch.from_arrays(made, names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "rare", "blocks"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return encoded(docs, vocabulary).select("doc_id", "held_out", "ids").mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, rare array<struct<word: binary, tf: bigint>>, blocks array<struct<key: bigint, before: bigint, times: bigint, times_before: bigint, lnp: double>>")


def remembered(scored: DataFrame, texts: int) -> DataFrame:
    """(row, score): log10 p of every row's blocks under the memory with the attention as its prior.

    ``texts`` is the number of training rows. A row's own blocks are not counted for it.
    """
    blocks = scored.select("row", "held_out", F.posexplode("blocks").alias("i", "b")).select("row", "held_out", "i", "b.*")
    learnt = blocks.filter("not held_out")
    counts = learnt.groupBy("key").agg(F.count("*").alias("c"))
    contexts = learnt.filter("i > 0").groupBy("before").agg(F.count("*").alias("n"))
    own = lambda times: F.when(F.col("held_out"), 0).otherwise(F.col(times))
    met = blocks.join(counts, "key", "left").join(contexts, "before", "left")
    c = F.coalesce("c", F.lit(0)) - own("times")
    others = F.lit(texts) - F.when(F.col("held_out"), 0).otherwise(1)
    first = F.col("i") == 0
    n = F.when(first, others).otherwise(F.coalesce("n", F.lit(0)) - own("times_before"))
    alpha = F.when(first, F.greatest(others, F.lit(1))).otherwise(1)
    unseen = F.log10(alpha) + F.col("lnp") / LN10
    term = F.when(c > 0, F.log10(c + alpha * F.exp("lnp"))).otherwise(unseen) - F.log10(n + alpha)
    return met.groupBy("row").agg(F.sum(term).alias("score"))


def lm_scores(docs: DataFrame, vocabulary: str | None = None, folds: int = 5, fold: int = 1, steps: int = STEPS, frequent: int = FREQUENT) -> DataFrame:
    """log10 probabilities of every row's text under the model and under the word unigram base.

    Learns from rows whose crc32 of the id modulo ``folds`` is not ``fold``; a null id is none of
    the held out. Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``. The score of a training row leaves out its own blocks. Null and blank texts have one token, the end. Repeated rows are scored
    row by row. Other columns are not carried. An empty table gives an empty one; if there is nothing
    to learn from, the base is uniform and the model untrained. Texts of any length are scored whole.
    """
    path = vocabulary or subword.default_path()
    rows = docs.withColumn("held_out", F.coalesce(crc_mod("doc_id", folds) == fold, F.lit(False))).select("doc_id", "text", "held_out")
    counts = store(word_counts(rows.filter("not held_out")), "words")
    rows = store(encoded(dealt(rows), path), "ids")  # read by every round and by the scores
    train = rows.filter("not held_out")
    ends = train.count()
    distinct, tokens = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    v, n = distinct + (ends > 0), tokens + ends
    head = {bytes(r["word"]): r["c"] for r in counts.filter(F.col("c") >= least_count(counts, frequent)).collect()}
    scored = store(scored_rows(rows, head, fit(train.select("doc_id", "size", "round", "ids"), path, steps=steps), path), "scored")
    discard(rows)
    rest = (
        scored.select("row", F.explode("rare").alias("r"))
        .select("row", "r.word", "r.tf")
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("seen"))
    )
    release(docs.sparkSession)
    whole = remembered(scored, ends)
    zero = F.lit(0)
    end = float(np.log10(ends + 0.5))
    norm = float(np.log10(n + 0.5 * (v + 1)))
    flat = scored.select("row", "doc_id", "held_out", "n_tokens", "known", "base")
    return flat.join(rest, "row", "left").join(whole, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("seen", zero) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + end - F.col("n_tokens") * norm).alias("base_score"),
        "score",
    )


def op9_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Scores of all ``documents`` under a model and a base learnt from four fifths of them."""
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
