import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from claimforge.llm import subword
from claimforge.llm.packing import pack, plan


def test_plan_places_all():
    rng = np.random.default_rng(3)
    for n in (0, 1, 40, 5000):
        histogram = Counter(rng.integers(1, 257, n).tolist())
        out = plan(histogram, 256)
        placed = Counter()
        for lengths, k in out:
            assert sum(lengths) <= 256
            for x in lengths:
                placed[x] += k
        assert placed == histogram
        total = sum(x * k for x, k in histogram.items())
        assert sum(k for _, k in out) <= 1.02 * total / 256 + 2


def test_round_trip(spark):
    texts = [None, "", "a", "the cat sat " * 40, "word " * 3000, "<|endoftext|> x"] + [f"text {i} " * (i % 90) for i in range(400)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(3, "again", 1)], "doc_id long, text string, offset int").repartition(3)
    rows = pack(df, size=128).collect()
    t = Tokenizer.from_file(subword.default_path())
    for i in (0, 4, 5, 200):
        ids = np.array([*t.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.start for r in mine] == np.cumsum([0] + [r.length for r in mine])[:-1].tolist() and sum(r.length for r in mine) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in mine)
        assert all(r.length == 128 for r in mine[1:])
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    assert len(sequences) <= 1.03 * sum(r.length for r in rows) / 128 + 2
    assert pack(df.limit(0)).count() == 0


def fewest(lengths, size):
    """The least number of sequences, by trying every place of every piece."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) > best or i == len(lengths):
            best = min(best, len(rooms))
            return
        for r in {r for r in rooms if r >= lengths[i]}:
            rest = list(rooms)
            rest.remove(r)
            place(i + 1, [*rest, r - lengths[i]])
        place(i + 1, [*rooms, size - lengths[i]])

    place(0, [])
    return best


def test_plan_against_exact_packing():
    rng = np.random.default_rng(8)
    more = []
    for _ in range(120):
        lengths = sorted(rng.integers(1, 17, rng.integers(1, 10)).tolist(), reverse=True)
        more.append(sum(n for _, n in plan(Counter(lengths), 16)) - fewest(lengths, 16))
    assert min(more) == 0 and max(more) <= 1 and sum(more) <= 6
